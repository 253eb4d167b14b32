"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. Sizes (words) per source; targets: weighted shares of the total, none above
   ``most`` times its source, the excess shared out again by weight.
2. Blocks of ``block`` words are awarded to sources by highest quotients
   target / (2 n + 1): only the awards near the common divisor are ranked, at most
   about five rows per source, whatever the number of blocks.
3. A source's documents lie in shards of bounded size (hash of the id); each shard gets
   an integer quota of blocks by the source's divisor.
4. Within a shard, documents stand in seeded order on a line of words cut into blocks.
   A quota of q on n blocks is q div n passes over the shard and a seeded selection of
   q mod n blocks, spread evenly.  What a document gives follows from its position.

Nothing but ids and counts is shuffled.  Windows span one shard or the list of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed.session import kept

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BLOCK = 32
SHARD_WORDS = 1 << 16
SHARD_DOCUMENTS = 256
MOST = 3


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
                   ) -> DataFrame:
    """Add ``place`` (from 1, by code point, null last), ``weight`` and ``target`` to rows
    (source, source_size), one per source.

    Sources ordered by most * size / weight fill up in that order: the first one that
    stays below its limit gives the common level of all that follow.
    """
    everything = Window.partitionBy()
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("_per_weight", "place").rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(ordered)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    rows = (
        sources.withColumn("place", place).withColumn("weight", weight)
        .withColumn("_limit", F.col("source_size") * float(most))
        .withColumn("_per_weight", F.col("_limit") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_all", F.sum("weight").over(everything))
        .withColumn("_full", F.coalesce(F.sum("_limit").over(by_limit), F.lit(0.0)))
        .withColumn("_used", F.coalesce(F.sum("weight").over(by_limit), F.lit(0.0)))
        .withColumn("_level", (F.col("_total") - F.col("_full")) / (F.col("_all") - F.col("_used")))
    )
    level = F.min(F.when(F.col("_level") <= F.col("_per_weight"),
                         F.struct("_per_weight", "place", "_level"))).over(everything)
    rows = rows.withColumn("_common", level["_level"])
    target = F.when(F.col("_common").isNull(), F.col("_limit")).otherwise(
        F.least(F.col("_limit"), F.col("_common") * F.col("weight")))
    return rows.select("source", "source_size", "place", "weight", target.alias("target"))


def sainte_lague(rows: DataFrame, share: str, seats: Column, order: str) -> DataFrame:
    """Add ``quota``: ``seats`` (one number for all rows) awarded by highest quotients
    share / (2 n + 1), ties to the smaller ``order``.

    With G rows, the divisor lies between total / (seats + G/2) and
    total / (seats - G/2).  Awards above the upper one are certain; below the lower one
    there are none; what lies between, at most 3 G quotients, is ranked.
    """
    everything = Window.partitionBy()
    ranked = Window.orderBy(F.col("_quotient").desc(), F.col(order), F.col("_n"))
    rows = (
        rows.withColumn("_seats", seats.cast("long"))
        .withColumn("_sum", F.sum(share).over(everything))
        .withColumn("_half", F.count(F.lit(1)).over(everything) / 2)
    )
    part = F.try_divide(F.col(share), F.col("_sum"))
    sure = F.when(F.col("_seats") > F.col("_half") + 1, F.floor(
        part * (F.col("_seats") - F.col("_half")) * (1 - 1e-9) + 0.5))
    rows = rows.withColumn("_base", F.coalesce(F.greatest(sure, F.lit(0)), F.lit(0)))
    most = F.ceil(part * (F.col("_seats") + F.col("_half")) + 1)
    rows = rows.withColumn("_most", F.greatest(F.coalesce(most, F.lit(0)), F.col("_base")))
    rows = rows.withColumn("_open", F.col("_seats") - F.sum("_base").over(everything))
    awards = (
        rows.select(order, share, "_open", F.explode(F.sequence("_base", "_most")).alias("_n"))
        .withColumn("_quotient", F.col(share) / (2 * F.col("_n") + 1))
        .filter(F.col("_quotient") > 0)
        .withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= F.col("_open"))
        .groupBy(order).agg(F.count(F.lit(1)).alias("_more"))
    )
    quota = F.col("_base") + F.coalesce(F.col("_more"), F.lit(0))
    extra = ["_seats", "_sum", "_half", "_base", "_most", "_open", "_more"]
    return rows.join(awards, order, "left").withColumn("quota", quota).drop(*extra)


def _draw(seed: int, column: str, start: int) -> Column:
    """32 bits from a hash of the seed and a value, the same in any engine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("long")


def row_mark(key: Column, text: Column) -> Column:
    return F.xxhash64(key, text)


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
         weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, seed: int = 17
         ) -> DataFrame:
    """One row per input row: key, size, source_size, target, taken, and where its words
    lie: shard, first (position), shard_blocks, passes, rest (selected blocks), shift.
    ``mark`` is a hash of key and text, to find the row again.

    A null text has size 0; null is a source of its own, placed last.  Rows with the same
    key are documents of their own (the same id keeps them in one shard).  A source
    without words has target 0.  An empty table gives no rows.
    """
    rows = docs.select(
        docs[key].alias("key"), docs[source].alias("source"),
        F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_mark(docs[key], docs[text]).alias("mark"),
    )
    # Texts are read once; what follows needs ids and sizes only.
    rows = kept(rows, "sizes")
    by_source = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    shards = F.ceil(F.greatest(F.col("source_size") / SHARD_WORDS, F.col("_docs") / SHARD_DOCUMENTS))
    goals = source_targets(by_source, weights, most)
    seats = F.round(F.sum("source_size").over(Window.partitionBy()) / block)
    goals = sainte_lague(goals, "target", seats, "place")
    goals = goals.join(by_source.select(F.col("source").alias("_s"), shards.alias("shards")),
                       F.col("source").eqNullSafe(F.col("_s"))).drop("_s")

    rows = rows.join(goals.withColumnRenamed("source", "_s"),
                     rows["source"].eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("shard", _draw(seed, "key", 1) % F.col("shards"))
    by_shard = rows.groupBy("place", "shard").agg(
        F.sum("size").alias("_size"), F.first("quota").alias("_quota"),
        F.first("source_size").alias("_of"))
    n = F.ceil(F.col("_size") / block)
    share = F.floor(F.try_divide(F.col("_quota") * F.col("_size"), F.col("_of")) + 0.5)
    by_shard = by_shard.select(
        "place", "shard", n.alias("shard_blocks"),
        F.coalesce(F.least(share, most * n), F.lit(0)).cast("long").alias("shard_quota"))
    rows = rows.join(by_shard, ["place", "shard"])

    line = Window.partitionBy("place", "shard").orderBy(
        _draw(seed, "key", 9), "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    blocks = F.greatest(F.col("shard_blocks"), F.lit(1))
    spot = F.concat(F.lit(f"{seed}:"), F.col("place"), F.lit(":"), F.col("shard"))
    shift = F.conv(F.substring(F.md5(spot), 1, 8), 16, 10).cast("long") % blocks + 1
    rows = rows.select(
        "*", F.coalesce(F.sum("size").over(line), F.lit(0)).alias("first"), shift.alias("shift"),
        F.floor(F.col("shard_quota") / blocks).alias("passes"),
        (F.col("shard_quota") % blocks).alias("rest"))

    def upto(position: Column) -> Column:
        """Words of selected blocks before a position."""
        b = F.floor(position / block)
        x = b + F.col("shift")
        return (block * (_div(x - 1) - _div(F.col("shift") - 1))
                + F.when(chosen(x), position - b * block).otherwise(0))

    def _div(x: Column) -> Column:
        return F.floor(x * F.col("rest") / blocks)

    def chosen(x: Column) -> Column:
        return (x * F.col("rest")) % blocks < F.col("rest")

    taken = F.col("passes") * F.col("size") + upto(F.col("first") + F.col("size")) - upto(F.col("first"))
    return rows.select(
        F.col("key").alias(key), "size", "source_size", "target",
        taken.cast("long").alias("taken"), "place", "shard", "first", "shard_blocks", "passes",
        "rest", "shift", "mark")


def selected_words(text: Column, block: int = BLOCK) -> Column:
    """The words of a document that lie in selected blocks, from the columns of ``plan``."""
    blocks = F.greatest(F.col("shard_blocks"), F.lit(1))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def inside(_: Column, i: Column) -> Column:
        x = F.floor((F.col("first") + i) / block) + F.col("shift")
        return (x * F.col("rest")) % blocks < F.col("rest")

    return F.array_join(F.filter(words, inside), " ")


def apply(docs: DataFrame, seed: int = 17, key: str = "doc_id", text: str = "text", source: str = "source",
          length: str | None = "n_chars", **how) -> DataFrame:
    """The mix itself: rows and columns of ``docs``, each as often as the plan takes it.

    A document comes once per whole pass over its shard, and once more, cut to the words of
    selected blocks (joined by single spaces), if blocks of it are selected; ``length``, if
    the table has it, is then the new number of characters.  Equal rows share what the plan
    gives to them.  Texts are shuffled once, by the row's mark.
    """
    by_mark = Window.partitionBy("_mark")
    goals = plan(docs, key, text, source, seed=seed, **how).select(
        F.col("mark").alias("_mark"), "first", "shard_blocks", "passes", "rest", "shift", "size", "taken")
    goals = goals.withColumn("_n", F.row_number().over(by_mark.orderBy("first")))
    # Positions, since the documents may have columns named like the plan's or ours.
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = names[docs.columns.index(text)]
    rows = docs.toDF(*names)
    rows = rows.withColumn("_mark", row_mark(F.col(names[docs.columns.index(key)]), F.col(at)))
    rows = rows.withColumn("_n", F.row_number().over(by_mark.orderBy(F.lit(1)))).join(goals, ["_mark", "_n"])
    part = F.when(F.col("taken") > F.col("passes") * F.col("size"), selected_words(F.col(at), how.get("block", BLOCK)))
    rows = rows.withColumn("_part", part)
    whole = F.array_repeat(F.struct(F.col(at).alias("t"), F.lit(False).alias("cut")), F.col("passes").cast("int"))
    cut = F.when(F.col("_part").isNotNull(), F.array(F.struct(F.col("_part").alias("t"), F.lit(True).alias("cut"))))
    rows = rows.withColumn("_texts", F.concat(whole, F.coalesce(cut, F.slice(whole, 1, 0))))
    rows = rows.select(*names, F.explode("_texts").alias("_x"))

    def column(name: str, c: str) -> Column:
        if c == text:
            return F.col("_x.t")
        if c == length:
            kind = docs.schema[c].dataType
            return F.when(F.col("_x.cut"), F.char_length("_x.t").cast(kind)).otherwise(F.col(name))
        return F.col(name)

    return rows.select(*[column(n, c) for n, c in zip(names, docs.columns)]).toDF(*docs.columns)
