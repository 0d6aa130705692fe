"""Keyed tables as a base and change sets: small runs write what they change.

A table is described by its layers, ``{"base": run, "rows": n, "changes":
[{"run": run, "rows": n}, ...]}``, each the folder of one run. Reading takes
the newest row of every key: the base without the keys that the change sets
hold, and of those the last change set's row. Only change sets are grouped by
key; the base is probed with their keys, which Spark broadcasts while they are
few. Where a run may change a key once only (``unique``), the last change set
is read as it is and the others without the keys changed after them. Once the
change sets pass a share of the base, a run writes a new base.

A row of a side table is removed by a row whose ``_ml_gone`` is true; a table
without that column only updates and inserts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

GONE = "_ml_gone"
_SET = "_ml_set"


def _same_key(a: DataFrame, b: DataFrame, key: Sequence[str], null_safe: bool):
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) if null_safe else a[c] == b[c] for c in key])


def without_keys(df: DataFrame, others: DataFrame, key: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key ``others`` does not hold."""
    if not null_safe:
        return df.join(others.select(*key), list(key), "left_anti")
    keys = others.select(*[F.col(c).alias(f"_ml_k_{c}") for c in key])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_ml_k_{c}")) for c in key])
    return df.join(keys, same, "left_anti")


def _keys(sets: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [s.select(*key) for s in sets])


def newest_changes(sets: Sequence[DataFrame], key: Sequence[str], unique: bool = False) -> DataFrame:
    """The last row of every key over change sets in order, oldest first; a key once per set.

    With ``unique`` (the sets are known to keep that) rows meet keys, not rows:
    the last set is not moved, and no row is held in a group."""
    if len(sets) == 1:
        return sets[0]
    if unique:
        return reduce(DataFrame.unionByName, [
            *[without_keys(s, _keys(sets[i + 1 :], key), key, null_safe=True) for i, s in enumerate(sets[:-1])], sets[-1]])
    columns = sets[0].columns
    tagged = [s.withColumn(_SET, F.lit(i)) for i, s in enumerate(sets)]
    rest = [c for c in columns if c not in key]
    best = reduce(DataFrame.unionByName, tagged).groupBy(*key).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(_SET)).alias("_ml_row"))
    return best.select(*key, *[F.col(f"_ml_row.{c}").alias(c) for c in rest]).select(*columns)


def run_files(spark: SparkSession, folder: str, run: str, schema: StructType | None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{folder}/run={run}")


def change_sets(spark: SparkSession, folder: str, layers: dict, schema: StructType | None) -> list[DataFrame]:
    """What was changed since the base, oldest first."""
    return [run_files(spark, folder, c["run"], schema) for c in layers["changes"]]


def read_layers(spark: SparkSession, folder: str, layers: dict, key: Sequence[str], schema: StructType | None = None,
                null_safe: bool = False, unique: bool = False) -> DataFrame:
    """The table of ``layers`` under ``folder``: the newest row of every key."""
    out = run_files(spark, folder, layers["base"], schema)
    sets = change_sets(spark, folder, layers, schema)
    if sets:
        out = without_keys(out, _keys(sets, key), key, null_safe).unionByName(newest_changes(sets, key, unique))
    return out.filter(~F.col(GONE)).drop(GONE) if GONE in out.columns else out


def with_change(layers: dict, run: str, rows: int) -> dict:
    if not rows:
        return layers
    return {**layers, "changes": [*layers["changes"], {"run": run, "rows": rows}]}


def due_for_compaction(layers: dict, ratio: float) -> bool:
    return sum(c["rows"] for c in layers["changes"]) > ratio * layers["rows"]


def runs_of(layers: dict | None) -> list[str]:
    return [] if not layers else [layers["base"], *(c["run"] for c in layers["changes"])]
