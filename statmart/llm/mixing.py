"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Every source gets a share of ``share`` times all words in proportion to its weight, but at most
``epochs`` times its own size; what a capped source can't take is shared among the others by
weight again, until none is above. With sources sorted by cap / weight that has a closed form:
``target = min(cap, level * weight)``, where ``level`` is the greatest of
``(total - caps of the sources before) / weights of the source and those after``.

A source's documents are then taken whole ``floor(target / size)`` times, and those that come first
in a seeded order (md5 of seed and doc_id) once more, until the rest of the target is reached:
the document at the limit is taken if its middle lies before it. So a source is off its target by at most
half a document. The order is summed in 4096 hash ranges first, so a source that holds most
rows is not sorted in one task.

Defined results: null or empty text has size 0; a null source is a source, after all others; a source
without words has target 0; rows with one doc_id are taken or left together; empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statmart.llm.common import word_count
from statmart.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = 17


def source_key(source: Column) -> Column:
    """A never-null key of a source."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def order_hash(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def document_sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, key, source, size, hash) of every row."""
    return docs.select("doc_id", source_key(F.col("source")).alias("key"), F.col("source").cast("string").alias("source"),
                       word_count(F.col("text")).alias("size"), order_hash(F.col("doc_id"), seed).alias("hash"))


def water_filling(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(key, source_size, target) from (key, source, source_size), one row a source."""
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)) + 1)
    caps = (totals.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * epochs)
            .withColumn("goal", F.sum("source_size").over(everything).cast("double") * share))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    levels = caps.withColumn("level", (F.col("goal") - before) / left)
    return levels.withColumn("level", F.max("level").over(everything)).select(
        "key", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def mixing_plan(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(key, source_size, target, whole, cut): each document of the source is taken ``whole`` times,
    and once more if its hash is at most ``cut`` (null: none)."""
    totals = sizes.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    plan = water_filling(totals, weights, share, epochs).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    plan = plan.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    grouped = sizes.groupBy("key", F.substring("hash", 1, 3).alias("range"), "hash").agg(F.sum("size").alias("size"))
    ranges = grouped.groupBy("key", "range").agg(F.sum("size").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranges.select("key", "range", before.alias("start"), (before + F.col("held")).alias("end"))
    # only the range in which a source's target is reached needs its documents in order
    edges = starts.join(plan, "key").where((F.col("start") < F.col("need")) & (F.col("end") > F.col("need"))).select(
        "key", "range", "start", "need")
    inner = grouped.join(edges, ["key", "range"])
    running = F.coalesce(F.sum("size").over(Window.partitionBy("key", "range").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    exact = (inner.withColumn("at", F.col("start") + running).where(F.col("at") + F.col("size") / 2 < F.col("need"))
             .groupBy("key").agg(F.max("hash").alias("inner_cut")))
    whole_ranges = (starts.join(plan, "key").where((F.col("need") > 0) & (F.col("end") <= F.col("need")))
                    .groupBy("key").agg(F.concat(F.max("range"), F.lit("z")).alias("outer_cut")))
    found = (plan.join(exact, "key", "left").join(whole_ranges, "key", "left")
             .select("key", "source_size", "target", F.col("whole").cast("int").alias("whole"),
                     F.coalesce("inner_cut", "outer_cut").alias("cut")))
    # written, so that Spark knows its bytes: under the session's limit it is broadcast and texts stay where they are
    return materialize(found, "mix-plan")


def copies_of(hash_column: Column) -> Column:
    """How often a document is taken, given its source's plan."""
    return F.col("whole") + F.when(hash_column <= F.col("cut"), 1).otherwise(0)


def mixing_report(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``."""
    sizes = materialize(document_sizes(docs, seed), "mix-sizes")
    plan = mixing_plan(sizes, weights, share, epochs)
    return sizes.join(plan, "key").select("doc_id", "size", "source_size", "target",
                                          (F.col("size") * copies_of(F.col("hash"))).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (rows not taken are absent)."""
    sizes = materialize(document_sizes(docs, seed), "mix-sizes")
    plan = mixing_plan(sizes, weights, share, epochs).withColumnRenamed("key", "__key")
    joined = docs.withColumn("__key", source_key(F.col("source"))).join(plan.select("__key", "whole", "cut"), "__key")
    taken = copies_of(order_hash(F.col("doc_id"), seed))
    return joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), taken))).select(docs.columns)
