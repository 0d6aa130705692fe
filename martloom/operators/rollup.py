"""Exact distinct-count rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rollup(df: DataFrame, by: Sequence[str], counts: Mapping[str, str]) -> DataFrame:
    """``count(distinct col)`` for each ``{output: col}``, grouped by ``by``.

    NULLs are not counted; a group whose values are all NULL gets 0. Exact
    counts only. Catalyst rewrites several distinct counts into one Expand
    plus two hash aggregates: the first shuffles on (group, value), so a
    group holding a third of all rows is still spread over many tasks, and
    the second shuffles only partial counts.
    """
    return df.groupBy(*by).agg(*[F.count_distinct(F.col(c)).cast("bigint").alias(o) for o, c in counts.items()])
