"""Near-duplicate documents by one-permutation MinHash, confirmed on whole shingle sets.

1. Every text becomes its set of 5-word shingle hashes.  One permutation fills 128 bins
   with the smallest hash of each; an empty bin borrows from a filled one, chosen by a
   random order of its own (optimal densification).  32 bands of 4 bins give bucket keys.
2. Documents with equal sets are one class, represented by the smallest key.
3. In a bucket, every representative is joined to the smallest one: a star, so the
   number of candidate pairs grows with the rows and not with their square.
4. Stars are confirmed on whole sets.  Hot centres are split over tasks.
5. A star only tests pairs with its centre, which may be unlike two members that are alike.
   So in a bucket of more than two, all members of different components are compared by the
   low bytes of their bins.
6. Where stars or bins with likeness of at least a half connect documents that are still in
   different components, all pairs between those components are tested on whole sets, in
   blocks of documents of similar set size; a pair of blocks that is in one component
   already is left out.

At likeness 0.75 a pair shares no band with probability 5e-6, and fewer than half of its
bins with less than 1e-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from airshed.llm import graphs
from airshed.llm.memory import given_back
from airshed.llm.words import WordHashes, mix, shingles
from airshed.session import kept

SHINGLE = 5
BINS, BANDS = 128, 32
#: Link from this percentage of intersection to union.
PERCENT = 75
#: Stars, and bins of one bucket, from this percentage on connect documents for the test of all pairs.
NEAR_PERCENT = 50
BLOCK = 256
_ORDER = np.stack([np.random.default_rng(1000 + i).permutation(BINS) for i in range(BINS)])


def signature(distinct: np.ndarray) -> np.ndarray:
    """One smallest hash per bin; ``distinct`` is sorted and not empty."""
    shift = np.uint64(64 - int(np.log2(BINS)))
    bins = (distinct >> shift).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    out = np.zeros(BINS, dtype=np.uint64)
    filled = np.zeros(BINS, dtype=bool)
    out[bins[first]] = distinct[first]
    filled[bins[first]] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        lender = np.argmax(filled[_ORDER[empty]], axis=1)
        out[empty] = out[_ORDER[empty, lender]]
    return out


def band_keys(bins: np.ndarray) -> np.ndarray:
    rows = bins.reshape(BANDS, -1)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return out.view(np.int64)


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, n, sa, sb, bands, bins) per document; sa and sb are 128 bits of the whole
    set, ``bins`` the low bytes of its signature."""
    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for t in batch["text"]:
                s = shingles(hashes.of(t or "", lower=True), SHINGLE)
                if len(s):
                    a = int(s.sum(dtype=np.uint64)) ^ (len(s) << 40)
                    b = int(mix(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64))
                    pair = np.array([a & (2**64 - 1), b], dtype=np.uint64).view(np.int64)
                    bins = signature(s)
                    out.append((len(s), pair[0], pair[1], band_keys(bins), bins.astype(np.uint8).tobytes()))
                else:
                    out.append((0, 0, 0, np.zeros(0, dtype=np.int64), b""))
            n, sa, sb, bands, bins = zip(*out) if out else ([], [], [], [], [])
            yield pd.DataFrame({"key": batch["key"], "n": np.array(n, dtype=np.int64),
                                "sa": np.array(sa, dtype=np.int64), "sb": np.array(sb, dtype=np.int64),
                                "bands": list(bands), "bins": list(bins)})

    return rows.mapInPandas(given_back(run), "key long, n long, sa long, sb long, bands array<bigint>, bins binary")


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """Rows (bucket, doc, centre, members) of the buckets with two documents or more, from
    rows (bucket, doc)."""
    centres = (
        buckets.groupBy("bucket").agg(F.min("doc").alias("centre"), F.max("doc").alias("_last"),
                                      F.count(F.lit(1)).alias("members"))
        .filter("centre < _last").drop("_last")
    )
    return buckets.join(centres, "bucket")


def star_edges(shared: DataFrame) -> DataFrame:
    """Distinct rows (a, b): member and centre, from rows of ``shared_buckets``."""
    return shared.filter("doc <> centre").select(F.col("doc").alias("a"), F.col("centre").alias("b")).distinct()


def _grouped(rows: DataFrame, keys: list[str], last: list[Column],
             work: Callable[[pd.DataFrame], list[tuple]], out: str) -> DataFrame:
    """``work`` over each group of rows, from a stream sorted by the keys.

    One worker holds one group at a time, without the cost of a call per group.
    """
    names = [f.split()[0] for f in out.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None

        def done(frame: pd.DataFrame) -> pd.DataFrame:
            found = [row for _, group in frame.groupby(keys, sort=False) for row in work(group)]
            return pd.DataFrame(found, columns=names)

        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(frame):
                continue
            end = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
            rest = frame[end]
            yield done(frame[~end])
        if rest is not None:
            yield done(rest)

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, *last)
    return dealt.mapInPandas(given_back(run, _forget), out)


_HASHES = WordHashes()


def _forget() -> None:
    _HASHES.clear()


def _sets(group: pd.DataFrame) -> list[np.ndarray]:
    return [shingles(_HASHES.of(t or "", lower=True), SHINGLE) for t in group["text"]]


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 rows in bounded pieces."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[at]
    owner, column = owner[use], number[at[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out, width = np.zeros((n, n), dtype=np.float64), 4096
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        m = np.zeros((n, width), dtype=np.float32)
        m[owner[a:b], column[a:b] - start] = 1
        out += m @ m.T
    return out


def _check_star(group: pd.DataFrame) -> list[tuple]:
    """Rows (a, b, common, joined) of one centre and its members, near ones only."""
    sets = _sets(group)
    ids, centre = group["doc"].to_numpy(), group["centre"].iloc[0]
    heads = [s for i, s in zip(ids, sets) if i == centre]
    out = []
    for i, s in zip(ids, sets):
        if i == centre or not len(s):
            continue
        for head in heads:
            common = int(np.isin(s, head, assume_unique=True).sum())
            joined = len(s) + len(head) - common
            if 100 * common >= NEAR_PERCENT * joined:
                out.append((int(i), int(centre), common, joined))
    return out


def check_stars(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """The near ones of the edges, with sizes of intersection and union of whole sets."""
    parts = edges.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("a"), F.col("parts"))
    members = edges.join(parts, "b").select(F.col("b").alias("centre"), part.alias("part"), F.col("a").alias("doc"))
    centres = parts.select(F.col("b").alias("centre"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                           F.col("b").alias("doc"))
    tasks = members.unionByName(centres).join(texts.hint("merge"), "doc")
    return _grouped(tasks, ["centre", "part"], [], _check_star, "a long, b long, common long, joined long")


def _check_blocks(group: pd.DataFrame) -> list[tuple]:
    """Links between documents of two blocks that have different labels."""
    sets = _sets(group)
    ids, label = group["doc"].to_numpy(), group["label"].to_numpy()
    side = group["side"].to_numpy()
    size = np.array([len(s) for s in sets], dtype=np.float64)
    common = _common(sets)
    joined = size[:, None] + size[None, :] - common
    good = (100 * common >= PERCENT * joined) & (label[:, None] != label[None, :]) & (ids[:, None] > ids[None, :])
    # Two blocks: only pairs across; one block (side 0 alone): all pairs.
    if side.max() > 0:
        good &= (side[:, None] != side[None, :])
    rows, cols = np.nonzero(good & (joined > 0))
    return [(int(ids[i]), int(ids[j])) for i, j in zip(rows, cols)]


def block_tasks(docs: DataFrame) -> DataFrame:
    """Rows (cluster, i, j, side, doc, label) from (cluster, doc, label, n).

    Documents of a cluster's largest label are one kind, all others the other kind.
    Blocks hold one kind and one size class (classes are a factor of 4/3 wide, so sets
    alike by 0.75 lie in the same or neighbouring ones).  Every block of the other kind
    meets itself and the later blocks of its class and the next, and the blocks of the
    largest label in its own and both neighbouring classes.
    """
    labels = docs.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("c"))
    clusters = labels.groupBy("cluster").agg(
        F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("all"))
    clusters = clusters.filter("kinds > 1 and all > 2").select("cluster", F.col("top.label").alias("main"))
    rows = docs.join(clusters, "cluster").select(
        "cluster", "doc", "label", (F.col("label") == F.col("main")).alias("main"),
        F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / PERCENT))).alias("width"))
    counts = rows.groupBy("cluster", "main", "width").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    rows = rows.join(counts, ["cluster", "main", "width"])
    block = F.pmod(F.xxhash64("doc"), F.col("blocks"))
    rows = rows.select("cluster", "doc", "label", "main", "width", block.alias("block"))

    kind = counts.select("cluster", "main", "width", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    one = kind.filter("not main").select("cluster", F.col("width").alias("iw"), F.col("block").alias("ib"))
    two = kind.select("cluster", F.col("main").alias("jm"), F.col("width").alias("jw"), F.col("block").alias("jb"),
                      F.explode(F.array(F.col("width") - 1, F.col("width"), F.col("width") + 1)).alias("iw"))
    pairs = one.join(two, ["cluster", "iw"]).filter(
        "jm or jw > iw or (jw = iw and jb >= ib)")
    ends = F.inline(F.array(
        F.struct(F.lit(False).alias("main"), F.col("iw").alias("width"), F.col("ib").alias("block"), F.lit(0).alias("side")),
        F.struct(F.col("jm").alias("main"), F.col("jw").alias("width"), F.col("jb").alias("block"), F.lit(1).alias("side"))))
    name = F.concat_ws(":", "iw", "ib", "jm", "jw", "jb")
    same = "side = 1 and not main and width = iw and block = ib"
    ends = pairs.select("cluster", name.alias("pair"), "iw", "ib", ends).filter(f"not ({same})")
    return ends.join(rows, ["cluster", "main", "width", "block"]).select(
        "cluster", "pair", "side", "doc", "label")


def _check_bins(group: pd.DataFrame) -> list[tuple]:
    """Stars (a, b) over the documents of different labels that agree in enough bins."""
    ids, label, side = (group[c].to_numpy() for c in ("doc", "label", "side"))
    if (label == label[0]).all():
        return []
    bins = np.frombuffer(b"".join(group["bins"]), dtype=np.uint8).reshape(-1, BINS)
    same = np.stack([np.count_nonzero(bins == row, axis=1) for row in bins])
    near = (100 * same >= NEAR_PERCENT * BINS) & (label[:, None] != label[None, :])
    if side.max() > 0:
        near &= (side[:, None] != side[None, :])
    root = np.arange(len(ids))
    while True:
        least = np.minimum(root, np.where(near, root[None, :], len(ids)).min(axis=1))
        if (least == root).all():
            break
        root = least
    return [(int(ids[i]), int(ids[j])) for i, j in enumerate(root) if ids[i] != ids[j]]


def bin_edges(shared: DataFrame, labels: DataFrame, sizes: DataFrame, bins: DataFrame) -> DataFrame:
    """Distinct rows (a, b) that connect all documents of one bucket, but different labels,
    that agree in half of their bins.

    ``shared`` is of ``shared_buckets``; a bucket of two is a star that was tested.  The
    others are one task up to ``BLOCK`` members, larger ones meet in pairs of blocks.
    """
    rows = shared.filter("members > 2").join(labels, "doc", "left").select(
        F.col("bucket").alias("cluster"), "doc", "members", F.coalesce("label", "doc").alias("label"))
    rows = kept(rows, "crowded")
    mixed = rows.groupBy("cluster").agg(F.min("label").alias("_a"), F.max("label").alias("_z"))
    rows = rows.join(mixed.filter("_a < _z").select("cluster"), "cluster")
    small = rows.filter(F.col("members") <= BLOCK).select(
        "cluster", F.lit("").alias("pair"), F.lit(0).alias("side"), "doc", "label")
    large = kept(rows.filter(F.col("members") > BLOCK).join(sizes, "doc").select("cluster", "doc", "label", "n"), "crowds")
    tasks = small.unionByName(block_tasks(large)).join(bins.hint("merge"), "doc")
    return _grouped(tasks, ["cluster", "pair"], [], _check_bins, "a long, b long").distinct()


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= 75 * union of their sets of 5-word
    shingles (A-Z lower-cased; fewer words are one shingle).  A text that is null or has no
    word is linked with nothing.  ``component_id`` is the smallest key reachable, ``kept``
    tells whether it is the row's own.  Rows that share a key are one document, linked if
    any of its texts is; rows with a null key are linked with nothing, have no component
    and are kept.  An empty table gives no rows.
    """
    sig = kept(signatures(docs, key, text), "signatures")
    full = sig.filter("n > 0 and key is not null")
    # Kept, so that the join deals both sides itself and a hot class can be split.
    classes = kept(full.groupBy("sa", "sb", "n").agg(F.min("key").alias("rep")), "classes")
    full = full.join(classes, ["sa", "sb", "n"])
    member = full.groupBy("key").agg(F.min("rep").alias("rep"), F.max("rep").alias("rep2"))
    reps = full.filter("key = rep")
    buckets = reps.select(F.col("key").alias("doc"), F.explode("bands").alias("bucket"))
    shared = kept(shared_buckets(buckets), "buckets")
    edges = kept(star_edges(shared), "edges")

    wanted = edges.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    texts = docs.select(docs[key].cast("long").alias("doc"), docs[text].alias("text"))
    # Neither side has a proven bound, so none is broadcast at any size.
    texts = texts.join(wanted.hint("merge"), "doc")
    # Rows that share a key may share their text as well.
    texts = kept(texts, "texts")
    near = kept(check_stars(edges, texts), "stars")
    links = near.filter(f"100 * common >= {PERCENT} * joined").select("a", "b").unionByName(
        member.filter("rep <> rep2").select(F.col("rep").alias("a"), F.col("rep2").alias("b")))
    comps = kept(graphs.components(links), "components")

    sizes = reps.groupBy(F.col("key").alias("doc")).agg(F.max("n").alias("n"))
    labels = comps.select(F.col("node").alias("doc"), F.col("component").alias("label"))
    alike = bin_edges(shared, labels, sizes, reps.select(F.col("key").alias("doc"), "bins"))
    clusters = graphs.components(near.select("a", "b").unionByName(alike), "clusters")
    tasks = block_tasks(
        clusters.withColumnRenamed("node", "doc").join(labels, "doc", "left")
        .select(F.col("component").alias("cluster"), "doc", F.coalesce("label", "doc").alias("label"))
        .join(sizes, "doc"))
    found = _grouped(tasks.join(texts.hint("merge"), "doc"), ["cluster", "pair"], [], _check_blocks, "a long, b long")
    found = kept(found.distinct(), "links")
    if not found.isEmpty():
        stars = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
        comps = graphs.components(stars.unionByName(found))

    member = member.select(F.col("key").alias("_key"), "rep").join(
        comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "_key", F.coalesce("component", "rep").alias("component"))
    component = F.coalesce("component", "key")
    return sig.join(member, sig["key"] == member["_key"], "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))
