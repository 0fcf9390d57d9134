"""Data checks in place of declared keys: uniqueness, required columns, references."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _report(name: str, broken: DataFrame) -> DataFrame:
    return broken.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def duplicate_keys(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Number of key values that occur more than once."""
    return _report(name, df.groupBy(*key).count().filter(F.col("count") > 1))


def missing_values(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Number of rows with NULL in a required column."""
    missing = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
    return _report(name, df.filter(missing))


def orphans(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str
) -> DataFrame:
    """Number of rows that refer to a parent that is not there (NULL refers to nothing).

    References are counted per value first, so a frequent one is joined once.
    """
    uses = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).count()
    lost = uses.join(parent, uses["_ref"] == parent[parent_column], "left_anti")
    return lost.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def check_report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
