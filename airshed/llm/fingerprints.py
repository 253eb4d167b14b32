"""Bottom-k fingerprints of a text's word shingles.

A fingerprint holds the k smallest distinct hashes of a text's shingles of five words.
Fingerprints of parts merge into the fingerprint of the whole (smallest k of the
union), and from two of them follow estimates of resemblance, containment and the
number of distinct shingles.  DataFrame functions only.

Hashes have 48 bits, so a fingerprint is written as 12 hexadecimal digits per hash.
With k = 128 the standard error of a resemblance r is sqrt(r (1 - r) / 128), 0.044 at
most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed.session import kept

K = 128
SHINGLE = 5
BITS = 48
SPACE = r"[\x20\x09-\x0D]+"


def word_list(text: Column) -> Column:
    """Words between ASCII white space; none for a null or empty text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Hashes of all runs of ``size`` words; a shorter text is one shingle, no word none."""
    def at(i: Column) -> Column:
        return F.shiftrightunsigned(
            F.xxhash64(*[F.get(words, i + j) for j in range(size)]), 64 - BITS)

    n = F.size(words)
    last = F.greatest(n - size, F.lit(0))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), at)).otherwise(
        F.array().cast("array<bigint>"))


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    """Add ``out``, the sorted k smallest hashes of the text's shingles.

    Each step is a projection of its own, so words are split once.
    """
    df = df.withColumn("_words", word_list(F.col(text)))
    df = df.withColumn("_hashes", shingle_hashes(F.col("_words")))
    return df.withColumn(out, smallest(F.col("_hashes"), k)).drop("_words", "_hashes")


def merge(parts: DataFrame, by: list[str], fingerprint: str, k: int = K) -> DataFrame:
    """One fingerprint per group of rows, of whatever size.

    Only the k smallest hashes of a group leave a task: the limit on row_number is
    applied before the shuffle as well.  Groups without any hash are absent.
    """
    hashes = parts.select(*by, F.explode(fingerprint).alias("_h")).distinct()
    order = Window.partitionBy(*by).orderBy("_h")
    low = hashes.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
    return low.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(fingerprint))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the part of the union's k smallest that both have.

    Two empty fingerprints are alike (1), an empty and a filled one are not (0).
    """
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(
        (k - 1) / (F.element_at(a, k) / float(2**BITS)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of a's shingles that b has; 1 where a has none."""
    r, na, nb = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return F.when(na == 0, 1.0).otherwise(F.least(F.lit(1.0), r / (1 + r) * (na + nb) / na))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), BITS // 4, "0")), "")


#: Digits of an id: neighbours are found within groups of 1,024 ids, then among the groups'
#: first ids, and so on; the last level has at most 2 ** 16 rows.
LEVELS = (10, 20, 32, 48)


def next_ids(ids: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Rows (id, next) from distinct non-null long ids; after the last comes the first."""
    if not levels:
        everything = Window.partitionBy()
        return ids.select("id", F.coalesce(F.lead("id").over(Window.orderBy("id")),
                                           F.min("id").over(everything)).alias("next"))
    group = F.shiftright("id", levels[0])
    inside = ids.select(
        "id", group.alias("_g"),
        F.lead("id").over(Window.partitionBy(group).orderBy("id")).alias("_in"))
    heads = ids.groupBy(group.alias("_g")).agg(F.min("id").alias("id"))
    after = next_ids(heads.select("id"), levels[1:])
    after = after.select(F.shiftright("id", levels[0]).alias("_g"), F.col("next").alias("_head"))
    return inside.join(after, "_g").select("id", F.coalesce("_in", "_head").alias("next"))


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K
                   ) -> DataFrame:
    """Fingerprints of every text and of its edited text: the second half replaced by the
    first as many characters of the next document, in ascending order of the key.

    One row per input row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, distinct_shingles, edited_containment.  A null text is an
    empty one.  Rows that share a key are each compared with the document of the next
    larger key (of several, the smallest text); a single key is its own next document.
    Rows with a null key have no place in the order and an empty next document.  An
    empty table gives no rows.

    Texts are shuffled once, by groups of 1,024 neighbouring ids; the next document is then
    the next row.  The first document of a group is sent to the group before it as well:
    which ones these are is known from the ids alone.
    """
    rows = docs.select(docs[key].cast("long").alias("id"),
                       F.coalesce(docs[text], F.lit("")).alias("text"))
    group = F.shiftright("id", LEVELS[0])
    heads = rows.filter("id is not null").groupBy(group.alias("_g")).agg(F.min("id").alias("id"))
    order = next_ids(heads.select("id"), LEVELS[1:])
    # One row per group; kept, so that Spark knows its size when it plans the join.
    order = kept(order.select(F.col("next").alias("id"), group.alias("_g")), "neighbours")
    # Rows without a key are dealt out by their text.
    spread = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("bigint"))
    own = rows.select("id", "text", group.alias("_g"), spread.alias("_s"), F.lit(False).alias("_more"))
    after = rows.join(order, "id").select(
        "id", "text", "_g", F.lit(0).cast("bigint").alias("_s"), F.lit(True).alias("_more"))
    rows = own.unionByName(after)

    by_group = Window.partitionBy("_g", "_s").orderBy("_more", "id", "text")
    rows = rows.withColumn("_n", F.lead(F.struct("id", "text", "_more")).over(by_group))
    # Of rows that share a key the last one has the next larger key behind it.
    same = Window.partitionBy("_g", "_s", "_more", "id")
    larger = F.when(F.col("_n._more") | (F.col("_n.id") > F.col("id")), F.col("_n.text"))
    rows = rows.withColumn("_text", F.first(larger, ignorenulls=True).over(same)).filter("not _more")
    rows = rows.select("id", "text", F.char_length("text").alias("n_chars"),
                       F.coalesce("_text", F.lit("")).alias("_text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("_edited", F.concat(
        F.col("text").substr(F.lit(1), F.col("n_chars") - half), F.col("_text").substr(F.lit(1), half)))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    for column, out in (("text", "fp"), ("_edited", "_efp"), ("_text", "_nfp")):
        rows = with_fingerprint(rows, column, out, k).drop(column)
    own, edited, following = F.col("fp"), F.col("_efp"), F.col("_nfp")
    return rows.select(
        F.col("id").alias(key), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        as_text(own).alias("fingerprint"), as_text(edited).alias("edited_fingerprint"),
        resemblance(own, edited, k).alias("near_edited"),
        resemblance(own, following, k).alias("near_next"),
        distinct_count(own, k).alias("distinct_shingles"),
        containment(own, edited, k).alias("edited_containment"),
    )
