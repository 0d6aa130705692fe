"""Mixing sources to target weights: Efraimidis-Spirakis sampling, DataFrame operations only.

Each document draws an exponential key ``-ln(u) / weight`` from a hash of its
id, so documents of higher quality weight tend to come first. Within a source
documents are ordered by key and their sizes prefix-summed up to the source's
token budget. A budget above the source's size takes complete epochs first;
only what is left is selected by key.

A source may hold a third of all rows, so its prefix sums are built in two
levels: the key axis is cut into ranges (a monotone function of the key), the
ranges' sums are prefix-summed per source, and rows are ordered only within
their own range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import WORD, checkpointed, parts_for, text_or_empty
from martloom.operators.keys import assign_surrogate_keys

ROWS_PER_RANGE = 20_000
LEAST_RANGES = 256
HASH_BITS = 52


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def uniform(seed: Column) -> Column:
    """A number in (0, 1) fixed by ``seed`` (52 bits of its md5)."""
    bits = F.conv(F.substring(F.md5(seed.cast("string")), 1, HASH_BITS // 4), 16, 10).cast("bigint")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**HASH_BITS))


def source_targets(sizes: DataFrame, share: float = 1.5, weights: Sequence[float] = (5.0, 2.0, 1.0),
                   most: float = 2.0) -> DataFrame:
    """Word targets per source: ``(source, source_size, target)``.

    ``sizes`` has one row ``(source, source_size)`` per source. Sources in
    code point order (NULL last) weigh ``weights``, repeating; they share
    ``share`` times the sum of all sizes by weight. A target stops at ``most``
    times its source's size and the excess is reshared by weight among the
    others until none is above: ``target = min(cap, level * weight)`` with the
    level found by one aggregation a step (the level only rises, and a step
    ends the search as soon as no further source is capped).
    """
    names = sizes.select(F.col("source").isNull().cast("int").alias("is_null"),
                         F.coalesce("source", F.lit("")).alias("name"))
    ranked = assign_surrogate_keys(names, ["is_null", "name"], "place", 0).keyed
    place = F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    keyed = sizes.withColumn("is_null", F.col("source").isNull().cast("int")).withColumn(
        "name", F.coalesce("source", F.lit("")))
    table = checkpointed(
        keyed.join(ranked, ["is_null", "name"]).select(
            "source", "source_size", weight.alias("weight"),
            (F.col("source_size") * F.lit(float(most))).alias("cap")))
    total, level_weight = table.agg(F.sum("source_size"), F.sum(F.when(F.col("cap") > 0, F.col("weight")))).first()
    budget = float(share) * float(total or 0)
    level = budget / level_weight if level_weight else 0.0
    while True:
        free = F.col("cap") > F.lit(level) * F.col("weight")
        capped, open_weight = table.agg(F.sum(F.when(~free, F.col("cap"))), F.sum(F.when(free, F.col("weight")))).first()
        if not open_weight:
            break
        raised = (budget - (capped or 0.0)) / open_weight
        if raised <= level:
            break
        level = raised
    return table.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (5.0, 2.0, 1.0), most: float = 2.0,
        carry: Sequence[str] = ()) -> DataFrame:
    """How often each document enters the mix.

    ``docs`` needs ``doc_id``, ``source``, ``size`` (words) and ``weight``
    (quality, above 0). Returns those rows, and the columns named in
    ``carry``, with ``source_size``, ``target`` and ``copies``. Whole documents are taken: after the complete epochs, a
    document is selected while at least half of it lies inside what is left
    of the budget, so a source misses its target by half a document at most.

    NULL sources form one source of their own; rows with a NULL id draw their
    key from ``mark`` (a hash of their text) where ``docs`` has it; equal
    keys are ordered by id, then size; NULL sizes count 0 and NULL weights 1.
    Repeated rows are documents of their own. An empty table gives no rows.
    """
    unnamed = F.concat(F.lit("null "), F.col("mark").cast("string")) if "mark" in docs.columns else F.lit("null")
    key = -F.log(uniform(F.coalesce(F.col("doc_id").cast("string"), unnamed))) / F.coalesce("weight", F.lit(1.0))
    slim = checkpointed(docs.select(
        "doc_id", "source", F.coalesce("size", F.lit(0)).cast("bigint").alias("size"), key.alias("key"),
        *carry))
    sizes = checkpointed(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    targets = source_targets(sizes.select("source", "source_size"), share, weights, most)
    ranges = parts_for(sizes.agg(F.sum("n")).first()[0] or 0, ROWS_PER_RANGE, LEAST_RANGES)
    ranged = slim.withColumn(
        "part", F.floor(F.lit(float(ranges)) * (1 - F.exp(-F.col("key")))).cast("int"))
    by_range = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_range.withColumn("part_start", F.coalesce(F.sum("part_size").over(before), F.lit(0))).alias("s")
    plan = starts.join(targets.alias("t"), F.expr("s.source <=> t.source")).select(
        "s.source", "s.part", "s.part_start", "t.source_size", "t.target").alias("p")
    rows = ranged.alias("r").join(plan, F.expr("r.source <=> p.source AND r.part = p.part")).select(
        "r.*", "p.part_start", "p.source_size", "p.target")
    within = Window.partitionBy("source", "part").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.col("part_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.col("target") - F.col("epochs") * F.col("source_size")
    return rows.withColumn("start", start).withColumn("epochs", epochs.cast("bigint")).select(
        "doc_id", "source", "size", "source_size", "target", *carry,
        F.least(F.col("epochs") + (2 * F.col("start") + F.col("size") <= 2 * left).cast("bigint"),
                F.lit(math.ceil(most)).cast("bigint")).alias("copies"))  # an empty document fits into nothing left


def quality_weight(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``weight``: 0.5 to 1.5 by mean quality label, 1 where unlabelled."""
    quality = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.avg("quality").alias("mean_quality"))
    return docs.join(quality, "doc_id", "left").withColumn(
        "weight", F.coalesce(F.col("mean_quality") + 0.5, F.lit(1.0))).drop("mean_quality")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, mark`` (a hash of the text): texts of any length are counted whole, NULL as empty."""
    return docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"), F.xxhash64("text").alias("mark"))
