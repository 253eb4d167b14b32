"""The operators' queries in DuckDB SQL, where SQL can state them."""

from airshed.llm.divergence import LEAST_DOCUMENTS, TOP
from airshed.llm.lines import MIN_SITES
from airshed.llm.mixing import BLOCK, SHARD_DOCUMENTS, SHARD_WORDS

_HEX = "(('0x' || substr({0}, {1}, 8))::bigint)"
_ID = "coalesce(doc_id::varchar, '')"

OP4 = f"""
with recursive sizes as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size
  from documents),
src as (select source, sum(size)::bigint as source_size, count(*) as docs from sizes group by 1),
w as (select *, row_number() over (order by source nulls last) as place from src),
w2 as (select *, ([5.0, 2.0, 1.0]::double[])[(place - 1) % 3 + 1] as weight, source_size * 3.0::double as lim from w),
w3 as (select *, lim / weight as per, sum(source_size) over () as total, sum(weight) over () as allw from w2),
w4 as (select *, coalesce(sum(lim) over o, 0.0) as full_, coalesce(sum(weight) over o, 0.0) as used
  from w3 window o as (order by per, place rows between unbounded preceding and 1 preceding)),
w5 as (select *, (total - full_) / (allw - used) as level from w4),
lvl as (select arg_min(level, (per, place)) as common from w5 where level <= per),
t as (select source, source_size, docs, place, case when common is null then lim else least(lim, common * weight) end as target
  from w5 cross join lvl),
seats as (select round(sum(source_size) / {BLOCK})::bigint as n, sum(target) as s from t),
q as (select place, target / (2 * j + 1) as quotient, j from t cross join seats,
  lateral (select unnest(range(0, (ceil(target / greatest(s, 1) * (n + (select count(*) from t) / 2.0)) + 2)::bigint)) as j) where target > 0),
r as (select place, row_number() over (order by quotient desc, place, j) as rank from q),
awards as (select place, count(*) as quota from r where rank <= (select n from seats) group by 1),
g as (select t.*, coalesce(quota, 0) as quota, ceil(greatest(source_size / {SHARD_WORDS}.0, docs / {SHARD_DOCUMENTS}.0))::bigint as shards
  from t left join awards using (place)),
d as (select s.doc_id, s.size, g.*, md5('17:' || {_ID}) as h, {_HEX.format(f"md5('17:' || {_ID})", 1)} % shards as shard
  from sizes s join g on s.source is not distinct from g.source),
sh as (select place, shard, ceil(sum(size) / {BLOCK}.0)::bigint as nb, sum(size) as ssize, any_value(quota) as quota,
  any_value(source_size) as of_ from d group by 1, 2),
sh2 as (select place, shard, nb, greatest(nb, 1) as n,
  coalesce(least(floor(quota * ssize / of_ + 0.5), 3 * nb), 0)::bigint as sq,
  {_HEX.format("md5('17:' || place || ':' || shard)", 1)} % greatest(nb, 1) + 1 as shift from sh),
l as (select d.*, n, sq // n as passes, sq % n as rest, shift,
  coalesce(sum(size) over (partition by place, shard order by {_HEX.format("h", 9)}, doc_id nulls first, size
    rows between unbounded preceding and 1 preceding), 0)::bigint as first from d join sh2 using (place, shard)),
u as (select *, first // {BLOCK} + shift as x0, (first + size) // {BLOCK} + shift as x1 from l)
select doc_id, size, source_size, target, (passes * size
  + {BLOCK} * ((x1 - 1) * rest // n) + case when (x1 * rest) % n < rest then (first + size) % {BLOCK} else 0 end
  - {BLOCK} * ((x0 - 1) * rest // n) - case when (x0 * rest) % n < rest then first % {BLOCK} else 0 end)::bigint as taken from u
"""

OP5 = """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding::double[], lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding::double[], lambda x: x <> 0)) > 0),
edges as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and len(a.e) = len(b.e)
  and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, e.b from reach r join edges e on r.b = e.a),
comp as (select a as vec_id, min(b) as component_id from reach group by 1),
n as (select a as vec_id, count(*) as n_links from edges group by 1)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from comp left join n using (vec_id)
"""

_BLANK = "regexp_replace(line, '[ \\t\\r]+', '', 'g') = ''"

OP6 = f"""
with l as (select doc_id, coalesce('s' || source, '-') as site, unnest(string_split(text, chr(10))) as line,
  generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
common as (select line, min(doc_id) as first_doc from l where not ({_BLANK}) group by 1 having count(distinct site) >= {MIN_SITES}),
m as (select l.*, common.line is not null and l.doc_id is not null and l.doc_id <> first_doc as gone from l left join common using (line)),
k as (select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed,
  coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '') as text from m group by 1)
select d.doc_id, coalesce(n_lines, 0)::int as n_lines, coalesce(n_removed, 0)::int as n_removed,
  sha256(coalesce(case when n_removed > 0 then k.text else d.text end, '')) as kept_sha256
from documents d left join k on k.doc_id = d.doc_id
"""

_WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"

OP8 = f"""
with w as (select doc_id, {_WORDS.format("text")} as words from documents),
win as (select doc_id, s, array_to_string(words[s:s + 49], ' ') as win
  from (select doc_id, words, unnest(range(1, len(words) - 48)) as s from w)),
firsts as (select win, min(doc_id) as first_doc from win group by 1),
gone as (select distinct doc_id, unnest(range(s, s + 50)) as i from win join firsts using (win) where first_doc < doc_id),
g as (select doc_id, list(i) as cut from gone group by 1),
k as (select w.doc_id, len(words) as n_words, coalesce(len(cut), 0) as n_removed,
  case when cut is null then words else list_filter(list_transform(words, lambda x, i:
    case when list_contains(cut, i) then null else x end), lambda x: x is not null) end as kept
  from w left join g using (doc_id))
select doc_id, coalesce(n_words, 0)::bigint as n_words, n_removed::bigint as n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) as kept_sha256 from k
"""

OP10 = f"""
with recursive w as (select doc_id, {_WORDS.format(
    "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as words from documents),
s as (select doc_id, list_distinct(case when len(words) >= 5
    then list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
    when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as set_ from w),
n as (select doc_id, coalesce(len(set_), 0) as n from s),
x as (select doc_id, unnest(set_) as h from s),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from x a join x b using (h) where a.doc_id < b.doc_id group by 1, 2),
near as (select a, b from pairs join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 75 * (na.n + nb.n - c)),
edges as (select a, b from near union all select b, a from near),
reach as (select doc_id as a, doc_id as b from documents union select r.a, e.b from reach r join edges e on r.b = e.a),
comp as (select a as doc_id, min(b) as component_id from reach group by 1)
select doc_id, n::bigint as n_shingles, component_id, doc_id = component_id as kept from n join comp using (doc_id)
"""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BOTH = "(a.p - b.p) * (a.p - b.p) // (a.p + b.p)"

OP11 = f"""
with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words from documents),
t as (select id, lang, source, unnest(words) as w from d),
k as (select lang, w from t group by 1, 2 having count(distinct id) >= {LEAST_DOCUMENTS}),
g as (select distinct lang, source from d),
c as (select lang, source, w, count(*) as n from t group by 1, 2, 3),
f as (select g.lang, g.source, k.w, coalesce(n, 0) as n from g join k using (lang) left join c using (lang, source, w)),
p as (select *, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over o + 2 * count(*) over o)::hugeint as p from f
  window o as (partition by lang, source)),
m as (select lang, w, sum(n) as n from f group by 1, 2),
q as (select *, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over o + 2 * count(*) over o)::hugeint as p from m
  window o as (partition by lang)),
s as (select a.lang, a.source, b.source as item, sum({_BOTH}) as value
  from p a join p b on a.lang = b.lang and a.w = b.w and a.source <> b.source group by 1, 2, 3),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select a.lang, a.source, 'term' as part, a.w as item, {_BOTH} as value
  from p a join q b on a.lang = b.lang and a.w = b.w where a.n > 0 and a.p > b.p),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value::bigint as value, rank::int as rank from r where part = 'pair' or rank <= {TOP}
"""

OP12 = f"""
with d as (select doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as words
  from documents),
n as (select doc_id, len(words)::bigint as n from d where len(words) > 0),
total as (select count(*)::bigint as docs, sum(n)::bigint as tokens from n),
q as (select distinct item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as w
  from benchmark),
tf as (select doc_id, w, count(*)::bigint as tf from (select doc_id, unnest(words) as w from d) semi join q using (w) group by 1, 2),
weight as (select w, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as weight
  from tf cross join total group by 1),
x as (select item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // tokens))))::bigint as score
  from q join weight using (w) join tf using (w) join n using (doc_id) cross join total group by 1, 2),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from x where score > 0)
select item_id, rank::int as rank, doc_id, score from r where rank <= 10
"""

ORACLES = {"op4_mixing": OP4, "op5_vectors": OP5, "op6_lines": OP6, "op8_repeats": OP8, "op10_minhash": OP10,
           "op11_divergence": OP11, "op12_ranking": OP12}
