"""Cross-site boilerplate: lines that stand on many sites.

Lines are keyed by 128 hash bits.  The sites of a line are counted by HyperLogLog
sketches, built in every task and merged by the aggregation, so a line on a third of
all documents is one small sketch per task.  Lines whose estimate lies near the
threshold are counted exactly.  A boilerplate line goes from every document but the
first that has it, so that one copy of each text stays in the corpus.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from airshed.session import kept

#: Sites from which on a line is boilerplate.
MIN_SITES = 10
#: Registers are 2 ** LG_K.  BAND is five standard errors of a full sketch.  Sketches of few
#: sites are no full ones: up to 2 ** LG_K / 32 = 128 sites they list 26 hash bits of each, so
#: a line of MIN_SITES sites falls out of the band only if two of ten hashes agree in two ways
#: at once; with MIN_SITES beyond 128 the band is what it says.
LG_K = 12
BAND = 5 * 1.04 / 2 ** (LG_K / 2)


ADDED = ("_lines", "_blank_before", "_removed")


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def _blank(line: Column) -> Column:
    return F.regexp_replace(line, r"[ \t\r]+", "") == ""


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def occurrences(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """Rows (doc, site, line) for every line that is not blank; no site is a site."""
    named = F.when(F.col("_site").isNull(), "-").otherwise(F.concat(F.lit("s"), F.col("_site")))
    return (
        docs.select(docs[key].alias("doc"), docs[site].cast("string").alias("_site"),
                    F.explode(split_lines(docs[text])).alias("_line"))
        .filter(~_blank(F.col("_line")))
        .select("doc", named.alias("site"), _key(F.col("_line")).alias("line"))
    )


def line_sketches(rows: DataFrame) -> DataFrame:
    """One HyperLogLog sketch of sites per line, and the first document with it."""
    return rows.groupBy("line").agg(
        F.hll_sketch_agg("site", LG_K).alias("sketch"), F.min("doc").alias("first_doc"))


def merge_sketches(parts: DataFrame) -> DataFrame:
    """Sketches of several parts of a corpus, merged per line."""
    return parts.groupBy("line").agg(
        F.hll_union_agg("sketch").alias("sketch"), F.min("first_doc").alias("first_doc"))


def boilerplate(rows: DataFrame, sketches: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Rows (line, first_doc) of the lines on at least ``min_sites`` sites."""
    estimate = F.hll_sketch_estimate("sketch")
    low, high = min_sites * (1 - BAND) - 1, min_sites * (1 + BAND) + 1
    # Kept, so that the joins below shuffle for themselves and hot lines can be split.
    rated = kept(sketches.select("line", "first_doc", estimate.alias("sites")).filter(
        F.col("sites") >= low), "line-sites")
    near = rated.filter(F.col("sites") <= high)
    exact = (
        rows.join(near.select("line"), "line", "left_semi")
        .groupBy("line", "site").agg(F.lit(1).alias("_one"))
        .groupBy("line").agg(F.count(F.lit(1)).alias("exact"))
    )
    return (
        rated.join(exact, "line", "left")
        .filter((F.col("sites") > high) | (F.col("exact") >= min_sites))
        .select("line", "first_doc")
    )


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source",
          min_sites: int = MIN_SITES) -> DataFrame:
    """The input rows and columns, with ``text`` freed of boilerplate lines, and three
    more columns: ``_lines``, ``_blank_before`` (no line but blank ones) and ``_removed``.

    Lines are compared as they stand; blank ones are neither counted nor removed.  The
    first document is the smallest key.  A null text stays null with no lines, a null
    key keeps its lines (it can be in no document's place, but counts as an
    occurrence), a null site is a site of its own.  Rows with one key are one document:
    what leaves one leaves all.  Other columns pass through, but for those named like the
    three new ones, which are replaced.  An empty table gives no rows.
    """
    rows = occurrences(docs, key, text, site)
    lines = kept(boilerplate(rows, line_sketches(rows), min_sites), "boilerplate")
    hits = (
        rows.join(lines, "line").filter(F.col("doc") != F.col("first_doc"))
        .groupBy("doc").agg(F.collect_set("line").alias("gone"))
    )
    # Positions, since the documents may have columns named like ours.
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = F.col(names[docs.columns.index(text)])
    joined = docs.toDF(*names).join(hits, F.col(names[docs.columns.index(key)]) == F.col("doc"), "left")
    parts = split_lines(own)
    gone = F.coalesce(F.col("gone"), F.array().cast(hits.schema["gone"].dataType))
    left = F.filter(parts, lambda line: _blank(line) | ~F.array_contains(gone, _key(line)))
    changed = F.size(gone) > 0
    kept_columns = [(n, c) for n, c in zip(names, docs.columns) if c not in ADDED]
    return joined.select(
        *[F.when(changed, F.array_join(left, "\n")).otherwise(own) if c == text else F.col(n) for n, c in kept_columns],
        F.coalesce(F.size(parts), F.lit(0)),
        F.coalesce(F.forall(parts, _blank), F.lit(True)),
        F.when(changed, F.size(parts) - F.size(left)).otherwise(0),
    ).toDF(*[c for _, c in kept_columns], *ADDED)


def all_blank(text: Column) -> Column:
    """Whether a text has no line but blank ones; null for a null text."""
    return F.forall(split_lines(text), _blank)
