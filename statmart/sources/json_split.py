"""One large JSON document read by many tasks.

Spark reads a document of many lines, or of one long line, in a single task. Here the text is
split at every ``}`` (a line separator for the text source, so each block of the file is a task)
and the place of each piece within the document is found by a prefix scan:

1. ``_pieces``: every piece is written once with what it does to the nesting, for both cases of
   how it may begin, outside or inside a string: the change in depth, the least depth it
   reaches, whether an object opens, the array it names. These facts need no other piece.
2. ``_blocks``: the quotes and changes of a block's pieces add up to those of the block, and
   running sums over the blocks of a file (one row for each) give the state at its start.
3. ``read_records``: with a block's start known, running sums within it tell which pieces make
   one record; a record that crosses blocks is put together from the few pieces at their edges.

No task holds more than a few blocks, which have a bounded number of pieces, and no record is parsed twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.functions.lookup import join_lookup
from statmart.functions.text import decoded_path
from statmart.session import default_parallelism, materialize, settled
from statmart.sources.csv_files import SOURCE

# Possessive throughout: strings of any length are matched without recursion.
_STRING = r'"(?:[^"\\]++|\\.)*+(?:"|$)'
_KEY = r'"(?:[^"\\]++|\\.)*+"(?:\s*+:\s*+\[)?+'
#: Up to the first ``{`` that isn't the document's own (which begins its piece).
_HEAD = rf'(?s)^(?:\s*+\{{)?+(?:[^"{{]++|{_STRING})*+'
_IN_STRING = r'(?s)^(?:[^"\\]++|\\.)*+(?:"|$)'
#: Depth within an array of the document: the document's braces, then the array's brackets.
_RECORDS = 2
#: Pieces of a file block that are handled together, as a power of two: a block with many short
#: pieces counts as several, since the facts of a piece may take more than its text.
_BLOCK_PIECES = 15


def _brackets(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, f"(?s){_STRING}", ""), r"[^\[\]{}]++", "")


def _change(brackets: Column) -> Column:
    closing = F.length(F.regexp_replace(brackets, r"[\[{]", ""))
    return F.length(brackets) - 2 * closing


def _lowest(brackets: Column) -> Column:
    """The least depth reached, from 0 at the start."""
    steps = F.transform(F.split(brackets, ""), lambda c: F.when(c.isin("[", "{"), 1).when(c == "]", -1).otherwise(0))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("low"))
    walked = F.aggregate(steps, start, lambda s, step: F.struct(
        (s["now"] + step).alias("now"), F.least(s["low"], s["now"] + step).alias("low")))
    return walked["low"]


def _facts(text: Column, ends_outside: Column, skipped: Column) -> Column:
    """What a piece does to the nesting where it begins outside of strings, after ``skipped`` characters."""
    head = F.regexp_extract(text, _HEAD, 0)
    brackets = _brackets(head)
    keys = F.filter(F.regexp_extract_all(head, F.lit(f"(?s){_KEY}"), F.lit(0)), lambda k: k.endswith("["))
    return F.struct(
        (_change(_brackets(text)) - ends_outside.cast("int")).alias("change"),
        _lowest(brackets).alias("low"),
        _change(brackets).alias("level"),
        # an object that is no value of a key
        ((F.length(text) > F.length(head)) & ~F.rtrim(F.regexp_replace(head, r"\s++$", "")).endswith(":")).alias("opens"),
        F.regexp_extract(F.try_element_at(keys, F.lit(-1)), f'(?s)^"(.*)"\\s*+:\\s*+\\[$', 1).alias("name"),
        (skipped + F.length(head)).alias("skip"))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(value, source_file, _start, _place, quotes, facts) of the texts before each ``}``, written once
    and dealt by block; ``_start`` orders the blocks of a file."""
    text = spark.read.text(path, lineSep="}").select(
        "value", decoded_path(F.col("_metadata.file_path")).alias(SOURCE),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_place"))
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.length(F.regexp_replace(plain, '[^"]++', ""))
    even = quotes % 2 == 0
    rest = F.regexp_replace("value", _IN_STRING, "")
    inside = _facts(rest, ~even, F.length("value") - F.length(rest))
    pieces = materialize(text.select(
        "value", SOURCE, F.struct("_block", F.shiftright("_place", _BLOCK_PIECES).alias("part")).alias("_start"), "_place",
        (quotes % 2).alias("quotes"), F.array(_facts(F.col("value"), even, F.lit(0)), inside).alias("facts")), "json-pieces")
    # a task sorts what it is dealt: as many tasks as there are blocks, however few the session asks for
    blocks = pieces.select(SOURCE, "_start").distinct().count()
    return pieces.repartition(max(blocks, default_parallelism(spark)), SOURCE, "_start")


def _before(*keys: str, order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _with_state(pieces: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pieces with their own ``fact`` and ``depth``, the depth at which they begin."""
    window = _before(SOURCE, "_start", order="_place")
    known = join_lookup(pieces, blocks, [SOURCE, "_start"])
    inside = (F.col("_inside") + _sum_before(F.col("quotes"), window)) % 2
    return (known.withColumn("fact", F.get("facts", inside.cast("int"))).drop("facts")
            .withColumn("depth", F.col("_depth") + _sum_before(F.col("fact.change"), window)))


def _blocks(pieces: DataFrame) -> DataFrame:
    """(source_file, _start, _inside, _depth): the state at the start of each block."""
    within = (_sum_before(F.col("quotes"), _before(SOURCE, "_start", order="_place")) % 2).cast("int")
    sums = pieces.select(SOURCE, "_start", "quotes", "facts", within.alias("_within")).groupBy(SOURCE, "_start").agg(
        F.sum("quotes").alias("quotes"),
        F.sum(F.get("facts", F.col("_within"))["change"]).alias("outside"),
        F.sum(F.get("facts", 1 - F.col("_within"))["change"]).alias("inside"))
    files = _before(SOURCE, order="_start")
    states = (sums.withColumn("_inside", _sum_before(F.col("quotes"), files) % 2)
              .withColumn("change", F.when(F.col("_inside") == 0, F.col("outside")).otherwise(F.col("inside")))
              .withColumn("_depth", _sum_before(F.col("change"), files)))
    states = settled(states.select(SOURCE, "_start", "_inside", "_depth", "quotes", "change"), "json-blocks")
    last = states.groupBy(SOURCE).agg(F.max_by(F.col("_depth") + F.col("change"), "_start").alias("depth"),
                                      (F.sum("quotes") % 2).alias("open"))
    broken = [r[0] for r in last.where("depth > 0 or open = 1").select(SOURCE).take(5)]
    if broken:
        raise ValueError(f"documents that end before they close: {broken}")
    return states.drop("quotes", "change")


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, name, text) of the objects in the arrays of the documents at ``path``.

    A document is an object with arrays of records, ``{"<name>": [{...}, ...], ...}``; several
    documents may follow each other in a file. Other values, and elements that are no objects, give
    no row. Key names are as written. A document that ends before it closes raises ``ValueError``.
    """
    pieces = _pieces(spark, path)
    states = _with_state(pieces, _blocks(pieces))
    fact = F.col("fact")
    lowest = F.col("depth") + fact["low"]
    ordered = Window.partitionBy(SOURCE, "_start").orderBy("_place")
    opens = fact["opens"] & (F.col("depth") + fact["level"] == _RECORDS)
    # a key's array counts where the piece reaches the document's own depth
    named = F.when((lowest <= 1) & (fact["name"] != ""), fact["name"])
    marked = states.select(
        SOURCE, "_start", "_place", opens.alias("opens"), named.alias("named"),
        F.concat(F.when(opens, F.substr("value", fact["skip"] + 1)).otherwise(F.col("value")), F.lit("}")).alias("text"),
        (F.col("depth") + fact["change"] <= _RECORDS).alias("ends"),
        named.isNotNull().alias("names"),
        # a unit begins where the depth is that of records or less; it has one record or none
        F.sum((lowest <= _RECORDS).cast("int")).over(ordered).alias("unit"),
        F.last(named, ignorenulls=True).over(ordered).alias("name"))
    units = marked.groupBy(SOURCE, "_start", "unit").agg(
        F.expr("listagg(text, '') WITHIN GROUP (ORDER BY _place)").alias("text"),
        F.bool_or("opens").alias("opens"), F.bool_or("ends").alias("ends"), F.bool_or("names").alias("names"),
        F.min_by("name", "_place").alias("name"), F.max_by("name", "_place").alias("last_name"))
    units = materialize(units, "json-units")
    # names and records go on from block to block: one row a block, and the pieces at its edges
    # (a block's first unit is 0 or 1, so every block is there; units without a new name are not sorted)
    names = units.where("names or unit <= 1").groupBy(SOURCE, "_start").agg(F.max_by("last_name", "unit").alias("last_name"))
    names = names.select(SOURCE, "_start", F.last("last_name", ignorenulls=True).over(
        _before(SOURCE, order="_start")).alias("known"))
    units = join_lookup(units, names, [SOURCE, "_start"]).withColumn("name", F.coalesce("name", "known"))
    whole = units.where(F.col("opens") & F.col("ends") & (F.col("unit") > 0)).select(SOURCE, "name", "text")
    edges = units.where((F.col("unit") == 0) | ~F.col("ends"))
    count = F.sum((F.col("unit") > 0).cast("int")).over(
        Window.partitionBy(SOURCE).orderBy("_start", "unit"))
    crossing = edges.withColumn("_record", count).groupBy(SOURCE, "_record").agg(
        F.expr("listagg(text, '') WITHIN GROUP (ORDER BY _start)").alias("text"),
        F.bool_or(F.col("opens") & (F.col("unit") > 0)).alias("opens"),
        F.min_by("name", F.struct("_start", "unit")).alias("name"))
    return whole.unionByName(crossing.where("opens").select(SOURCE, "name", "text"))


def read_records(spark: SparkSession, path: str, schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """The records of each array in ``schemas`` as rows; keys absent from a record are NULL."""
    texts = materialize(record_texts(spark, path).where(F.col("name").isin(*schemas)), "json-records")
    return {name: texts.where(F.col("name") == name).select(F.from_json("text", schema).alias("_r")).select("_r.*")
            for name, schema in schemas.items()}
