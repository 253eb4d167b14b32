"""Manifests of landed files, and which files an incremental run must take.

A manifest has file_name, size_bytes and modified; it is a table like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def name_below(folder: str, path: Column) -> Column:
    """The dataset a path belongs to, relative to ``folder``; of a partition folder its value."""
    root = folder.rstrip("/").split("/")[-1]
    below = F.substring_index(path, f"/{root}/", -1)
    return F.regexp_replace(F.regexp_replace(below, r"/part-[^/]*$", ""), r"(^|/)[^/=]*=", "$1")


def landed_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Files below a folder with size and time.  Contents are not read.

    The part files of one dataset count as one entry named after its folder, given
    relative to ``folder``, so that equal names in different folders stay apart.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    return files.groupBy(name_below(folder, F.col("path")).alias("file_name")).agg(
        F.sum("length").alias("size_bytes"), F.max("modificationTime").alias("modified")
    )


def manifest_diff(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Status of each file against the last manifest: new, changed, unchanged or removed."""
    old = previous.select(
        "file_name", F.col("size_bytes").alias("old_size"), F.col("modified").alias("old_modified")
    )
    joined = current.join(old, ["file_name"], "full")
    same = (F.col("size_bytes") == F.col("old_size")) & (F.col("modified") <= F.col("old_modified"))
    status = (
        F.when(F.col("old_size").isNull(), "new")
        .when(F.col("size_bytes").isNull(), "removed")
        .when(same, "unchanged")
        .otherwise("changed")
    )
    return joined.select("file_name", "size_bytes", "modified", status.alias("status"))


def _rule(rule: str, now: Column, max_age_days: int) -> Column:
    absent = F.col("local_size").isNull()
    if rule == "absent":
        return absent
    if rule == "newer":
        return absent | (F.col("local_modified") < F.col("modified"))
    if rule == "age":
        age = F.unix_timestamp(now) - F.unix_timestamp("local_modified")
        return absent | (age > max_age_days * 86400)
    if rule == "size":
        return absent | ((F.col("size_bytes") > 0) & (F.col("local_size") != F.col("size_bytes")))
    raise ValueError(f"unknown rule {rule!r}")


def ingest_decision(offered: DataFrame, landed: DataFrame, rule: str,
                    now: Column | None = None, max_age_days: int = 30) -> DataFrame:
    """For each offered file whether to take it.

    ``newer``: the offered copy is newer; ``absent``: none has landed; ``age``:
    the landed copy is older than the limit; ``size``: the sizes differ.
    """
    local = landed.select("file_name", F.col("size_bytes").alias("local_size"),
                          F.col("modified").alias("local_modified"))
    take = F.coalesce(_rule(rule, now if now is not None else F.current_timestamp(),
                            max_age_days), F.lit(False))
    joined = offered.join(local, ["file_name"], "left")
    return joined.select("file_name", F.when(take, "take").otherwise("skip").alias("decision"))
