"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import stored_table

# A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once as a table beside the session's checkpoints, and read back.

    Cuts lineage, so a lost executor re-reads files instead of recomputing,
    and makes values that depend on partition boundaries stable. A table is
    smaller than ``checkpoint()`` files (columnar, compressed) and, unlike
    them, carries no constraints of its query into the plans of later rounds,
    which makes planning slower with every round.
    """
    return stored_table(df)[0]


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that is none of ``columns`` (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def parts_for(units: int, per_part: int, least: int = 1) -> int:
    """A partition count in proportion to the work, so a part stays bounded."""
    return max(least, -(-int(units) // int(per_part)))
