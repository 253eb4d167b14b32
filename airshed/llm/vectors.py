"""Near-duplicate vectors by p-stable hashing, confirmed by exact cosines.

Normalised vectors are projected on random Gaussian directions; eight projections,
shifted and cut into cells of width 1, make the key of a bucket, and there are 32 tables of
such keys.  Vectors of cosine 0.98 are at most 0.2 apart, so they share a cell of one
projection with probability 0.84, and a bucket of some table with probability 0.9999.

Equal vectors are one class first, with the number of its copies.  Buckets are compared in
blocks of 512 by cosine in double precision; a pair counts in the first table that
brings it together, so no pair is ever listed.  Out of a block come one count per vector
and one edge per vector to the smallest of its local group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from airshed.llm import graphs
from airshed.llm.minhash import _grouped
from airshed.llm.words import mix
from airshed.session import kept

COSINE = 0.98
TABLES, PROJECTIONS, WIDTH = 32, 8, 1.0
BLOCK = 512


def table_keys(unit: np.ndarray, group: np.ndarray, tables: int, projections: int, width: float) -> np.ndarray:
    """One 64-bit key per row and table; ``group`` keeps labels and lengths apart."""
    draw = np.random.default_rng(7919 + unit.shape[1])
    directions = draw.standard_normal((unit.shape[1], tables * projections))
    shift = draw.uniform(0, width, tables * projections)
    cells = np.floor((unit @ directions + shift) / width).astype(np.int64).view(np.uint64)
    cells = cells.reshape(len(unit), tables, projections)
    key = np.arange(1, tables + 1, dtype=np.uint64)[None, :] + mix(group)[:, None]
    for i in range(projections):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, i])
    return key.view(np.int64)


def _usable(v) -> np.ndarray | None:
    if v is None:
        return None
    try:
        x = np.asarray(v, dtype=np.float64)
    except (TypeError, ValueError):  # a null component in a list of objects
        return None
    return x if x.size and np.isfinite(x).all() and np.abs(x).max() > 0 else None


def _scaled(x: np.ndarray) -> np.ndarray:
    """Unit rows; scaling by the largest component first avoids overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def hashed(rows: DataFrame, tables: int, projections: int, width: float) -> DataFrame:
    """Rows (id, same, copy, vector, keys) of the usable vectors among (id, label, vector).

    ``same`` and ``copy`` are 128 bits of label and components; zeros have one sign.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            found = [(i, lab, x) for i, lab, v in zip(batch["id"], batch["label"], batch["vector"])
                     if lab is not None and lab == lab and (x := _usable(v)) is not None]
            by_length: dict[int, list] = {}
            for f in found:
                by_length.setdefault(len(f[2]), []).append(f)
            for length, part in by_length.items():
                values = np.stack([x for *_, x in part]) + 0.0
                group = np.array([xxhash.xxh3_64_intdigest(f"{length}:{lab}") for _, lab, _ in part], dtype=np.uint64)
                keys = table_keys(_scaled(values), group, tables, projections, width)
                raw = [v.astype("<f8").tobytes() for v in values]
                digest = [xxhash.xxh3_128_intdigest(r, seed=int(g)) for r, g in zip(raw, group)]
                low = np.array([d & (2**64 - 1) for d in digest], dtype=np.uint64).view(np.int64)
                high = np.array([d >> 64 for d in digest], dtype=np.uint64).view(np.int64)
                yield pd.DataFrame({"id": np.array([i for i, *_ in part], dtype=np.int64), "same": low, "copy": high,
                                    "vector": raw, "keys": list(keys)})

    return rows.mapInPandas(run, "id long, same long, copy long, vector binary, keys array<bigint>")


def _compare(least: float):
    def work(group: pd.DataFrame) -> list[tuple]:
        """Rows (id, links, root) of one pair of blocks of a bucket."""
        ids, copies = group["id"].to_numpy(), group["copies"].to_numpy()
        side, table = group["side"].to_numpy(), int(group["place"].iloc[0])
        unit = _scaled(np.stack([np.frombuffer(v, dtype="<f8") for v in group["vector"]]))
        near = unit @ unit.T >= least
        np.fill_diagonal(near, False)
        if side.max() > 0:  # two blocks: only pairs across
            near &= side[:, None] != side[None, :]
        if not near.any():
            return []
        first = near.copy()
        keys = np.stack(group["keys"].to_list())
        for t in range(table):
            first &= keys[:, t][:, None] != keys[:, t][None, :]
        links = first @ copies
        root, before = np.arange(len(ids)), None
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), dtype=np.int64)
        rank[order] = np.arange(len(ids))
        root = rank.copy()
        while before is None or (root != before).any():
            before = root.copy()
            root = np.minimum(root, np.where(near, root[None, :], len(ids)).min(axis=1))
        keep = near.any(axis=1)
        return [(int(i), int(n), int(r)) for i, n, r in zip(ids[keep], links[keep], ids[order][root[keep]])]

    return work


def link_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 least: float = COSINE, tables: int = TABLES, projections: int = PROJECTIONS,
                 width: float = WIDTH) -> DataFrame:
    """One row per input row: key, n_links, component_id, kept.

    Vectors of equal, non-null label and equal length are linked from cosine ``least`` on.
    A vector that is null, empty, zero or holds a null, NaN or infinite component is linked
    with nothing, like one whose label or key is null; a null key has no component and is
    kept.  Of rows that share a key the one that sorts first counts for all.  An empty
    table gives no rows.
    """
    plain = rows.select(rows[key].cast("long").alias("id"), rows[label].cast("string").alias("label"),
                        rows[vector].cast("array<double>").alias("vector"))
    known = kept(hashed(plain.filter("id is not null"), tables, projections, width), "vectors")
    one = known.groupBy("id").agg(F.min(F.struct("same", "copy")).alias("m")).select("id", "m.same", "m.copy")
    classes = one.groupBy("same", "copy").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    members = one.join(classes, ["same", "copy"])
    reps = known.join(classes.withColumnRenamed("rep", "id"), ["id", "same", "copy"]).dropDuplicates(["id"])
    reps = kept(reps.select("id", "copies", "vector", "keys"), "vector-classes")

    buckets = reps.select("id", F.posexplode("keys").alias("place", "bucket"))
    counts = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "bucket", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    tasks = buckets.join(counts, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    # Every row meets its own block once and every other block once.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    tasks = tasks.select("id", "place", "bucket", "block", other.alias("with")).select(
        "id", "place", "bucket", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
        (F.col("block") > F.col("with")).cast("int").alias("side"))
    tasks = tasks.join(reps, "id")
    found = kept(_grouped(tasks, ["bucket", "i", "j"], [], _compare(least), "id long, links long, root long"), "links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comps = graphs.components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_rep = links.join(comps.withColumnRenamed("node", "id"), "id", "left").withColumnRenamed("id", "rep")
    members = members.join(per_rep, "rep", "left").select(
        F.col("id").alias("_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component"))
    out = rows.select(rows[key].cast("long").alias("id")).join(members, F.col("id") == F.col("_id"), "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
