"""Tables kept in step with their sources by writing changed rows only (K5).

A refreshed table is a view over one base version and a few deltas (versions of ``sinks.tables``).
Each of them has a narrow table of keys beside it. For a key, the digest is the sum of the 64-bit
hashes of all its source rows, and a key table holds by how much the digest moved, so the digest that
the table stands for is the sum over the key tables. What changed is then one aggregation by key:

    digests of the sources  -  all that the key tables hold  <> 0

which combines in the tasks before its shuffle (a hot key is one row a task) and carries no other
columns. Only rows of changed keys are built and written, as a delta; a key without source rows is in
the delta's keys and has no rows. The view leaves out rows whose key a later delta holds: anti
joins with the deltas' keys, of which filters on the table reach every scan. Changing the view is the
commit, one catalog operation: a refresh that dies at any step leaves the table as it was.

When the deltas hold more than a share of the base's keys, or are many, ``fold_table`` writes
their sum as a new base.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.sinks.tables import _drop_version, _point_to, _write_version, safe_name, table_exists, versions

PROPERTY = "statmart.refresh"

#: Deltas are folded when they hold more than this share of the base's keys ...
FOLD_SHARE = 0.2
#: ... or when there are more of them.
FOLD_DELTAS = 8


def row_hash(df: DataFrame, *salt: int) -> Column:
    """64-bit hash of a row, whatever the order of its columns. NULL differs from any value, and a
    NULL in one column from a NULL in the next (``xxhash64`` alone passes over them)."""
    parts = [x for c in sorted(df.columns) for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(*[F.lit(s) for s in salt], *[F.lit(c) for c in sorted(df.columns)], *parts)


def _digests(sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """``_key``, ``_moved`` (hash), ``_rows`` (1) for each source row."""
    found = [df.select(F.col(f"`{key}`").alias("_key"), row_hash(df, i).cast("decimal(38,0)").alias("_moved"),
                       F.lit(1).cast("long").alias("_rows")) for i, (df, key) in enumerate(sources)]
    return reduce(DataFrame.unionByName, found)


def _summed(moves: DataFrame) -> DataFrame:
    """One row for each key whose digest moved."""
    return (moves.groupBy("_key").agg(F.sum("_moved").cast("decimal(38,0)").alias("_moved"), F.sum("_rows").alias("_rows"))
            .where(F.col("_moved") != 0))


def _held(spark: SparkSession, state: dict) -> DataFrame:
    """All that the key tables hold, to be subtracted or summed."""
    tables = [k for _, k in [state["base"], *state["deltas"]]]
    return reduce(DataFrame.unionByName, [spark.table(k).select("_key", "_moved") for k in tables])


def refresh_state(spark: SparkSession, name: str) -> dict | None:
    """What a refreshed table is made of (None for any other table)."""
    name = safe_name(name)
    if not table_exists(spark, name):
        return None
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return json.loads(found[PROPERTY]) if PROPERTY in found else None


def _view_sql(columns: Sequence[str], key: str, state: dict) -> str:
    """Rows of the base and each delta whose key no later delta holds."""
    names = ", ".join(f"t.`{c}`" for c in columns)
    parts = [state["base"], *state["deltas"]]
    selects = []
    for i, (rows, _) in enumerate(parts):
        later = " UNION ALL ".join(f"SELECT _key FROM {k}" for _, k in parts[i + 1:])
        selects.append(f"SELECT {names} FROM {rows} t"
                       + (f" LEFT ANTI JOIN ({later}) k ON t.`{key}` <=> k._key" if later else ""))
    return " UNION ALL ".join(selects)


def _commit(spark: SparkSession, name: str, columns: Sequence[str], state: dict) -> None:
    _point_to(spark, name, query=_view_sql(columns, state["key"], state), properties={PROPERTY: json.dumps(state)})


def refresh_table(name: str, key: str, sources: Sequence[tuple[DataFrame, str]],
                  build: Callable[..., DataFrame] = lambda df: df, path: str | None = None,
                  rebuild: bool = False, fold_share: float = FOLD_SHARE, fold_deltas: int = FOLD_DELTAS) -> dict:
    """Make table ``name`` equal to ``build(*sources)``, writing only what changed since its last refresh.

    ``sources`` are (DataFrame, name of its key column); ``build`` takes them in order and must
    give each key's rows from that key's source rows alone, with the key in column ``key`` (joins on
    the key and row-wise expressions do). A NULL key is a key like others. The sources are read twice, so they should be written
    tables. A column that ``build`` takes from elsewhere, such as a load time, keeps the value
    of the refresh that last changed the row.

    The whole table is built at the first refresh, with ``rebuild``, when ``build`` gives other
    columns or types than before, and when more than ``fold_share`` of the keys changed. As in
    ``replace_table``, sources without any row leave the table as it is. Maps can't be hashed: project them away. One writer at a time.

    Returns ``{"kind": "full" | "delta" | "none", "keys": changed keys, "gone": keys that left}``.
    """
    spark = sources[0][0].sparkSession
    name = safe_name(name)
    if all(df.isEmpty() for df, _ in sources):
        return {"kind": "none", "keys": 0, "gone": 0}
    state = None if rebuild else refresh_state(spark, name)
    wanted = [(f.name, f.dataType) for f in build(*[df for df, _ in sources]).schema]
    columns = [c for c, _ in wanted]
    if state and (state["key"] != key or [(f.name, f.dataType) for f in spark.table(name).schema] != wanted):
        state = None
    gone = 0
    if state:
        moves = _digests(sources).unionByName(
            _held(spark, state).select("_key", (-F.col("_moved")).cast("decimal(38,0)").alias("_moved"),
                                       F.lit(0).cast("long").alias("_rows")))
        keys = _write_version(_summed(moves), f"{name}__keys", path, (), None)
        changed = spark.table(keys)
        count, gone = changed.agg(F.count(F.lit(1)), F.count_if(F.col("_rows") == 0)).first()
        if count == 0:
            _drop_version(spark, keys)
            return {"kind": "none", "keys": 0, "gone": 0}
        if count <= fold_share * state["keys"]:
            only = [df.join(changed, df[k].eqNullSafe(changed["_key"]), "left_semi") for df, k in sources]
            rows = _write_version(build(*only), name, path, (), None)
            state["deltas"].append([rows, keys])
            state["changed"] += count
            _commit(spark, name, columns, state)
            if state["changed"] > fold_share * state["keys"] or len(state["deltas"]) > fold_deltas:
                fold_table(spark, name, path)
            return {"kind": "delta", "keys": count, "gone": gone}
        _drop_version(spark, keys)  # too much of it changed: a new base
    keys = _write_version(_summed(_digests(sources)), f"{name}__keys", path, (), None)
    rows = _write_version(build(*[df for df, _ in sources]), name, path, (), None)
    total = spark.table(keys).count()
    _commit(spark, name, columns, {"key": key, "base": [rows, keys], "deltas": [], "keys": total, "changed": 0})
    return {"kind": "full", "keys": total if not state else count, "gone": gone}


def fold_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Write base and deltas as one new base; the table's rows stay the same."""
    name = safe_name(name)
    state = refresh_state(spark, name)
    if not state or not state["deltas"]:
        return
    moves = _held(spark, state).select("_key", F.col("_moved").cast("decimal(38,0)").alias("_moved"),
                                       F.lit(1).cast("long").alias("_rows"))
    table = spark.table(name)
    keys = _write_version(_summed(moves), f"{name}__keys", path, (), None)
    rows = _write_version(table, name, path, (), None)
    _commit(spark, name, table.columns, {"key": state["key"], "base": [rows, keys], "deltas": [],
                                         "keys": spark.table(keys).count(), "changed": 0})


def drop_unused_versions(spark: SparkSession, name: str) -> int:
    """Remove the versions, with their files, that a refreshed table no longer shows (those that a
    failed refresh left too). A query that still reads one of them fails. Returns how many."""
    name = safe_name(name)
    state = refresh_state(spark, name)
    if not state:
        return 0
    used = {t for pair in [state["base"], *state["deltas"]] for t in pair}
    old = [v for n in (name, f"{name}__keys") for v in versions(spark, n)
           if v.split(".")[-1] not in {u.split(".")[-1] for u in used}]
    for v in old:
        _drop_version(spark, v)
    return len(old)
