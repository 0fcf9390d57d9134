"""Series tables as views over the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import numeric_value
from tideline.operators.lastprice import symbol_names
from tideline.operators.pairs import all_symbol_pairs


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def ticks_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("tick_id"),
        F.col("ts").alias("time"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        _k().cast("double").alias("volume"),
    )


def ticks(spark: SparkSession, root: str) -> DataFrame:
    return ticks_from_events(table(spark, root, "events"))


def long_ticks(spark: SparkSession, root: str) -> DataFrame:
    """Several years of ticks, many at equal times."""
    return table(spark, root, "orders").select(
        F.col("o_orderkey").alias("tick_id"),
        F.col("o_orderdate").alias("time"),
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("volume"),
    )


def rates(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("from"),
        F.lit("USD").alias("to"),
        (F.col("value") * F.lit(1.001)).alias("ask"),
        (F.col("value") * F.lit(0.999)).alias("bid"),
    )


def swaps(spark: SparkSession, root: str) -> DataFrame:
    """Two of three events buy k + 1 tokens, the third sells (k + 1) / 2 of them."""
    buys = F.col("event_id") % 3 < 2
    bought = (_k() + 1).cast("double")
    sold = bought / F.lit(2.0)
    zero = F.lit(0.0)
    return table(spark, root, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("time"),
        F.col("event_type").alias("token_address"),
        F.concat(F.lit("w"), (F.col("user_id") % 50).cast("string")).alias("wallet_address"),
        F.when(buys, bought).otherwise(zero).alias("token_in"),
        F.when(buys, zero).otherwise(sold).alias("token_out"),
        F.when(buys, F.col("value") * bought).otherwise(zero).alias("usd_in"),
        F.when(buys, zero).otherwise(F.col("value") * sold).alias("usd_out"),
    )


def samples(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select(
        F.col("ts").alias("time"), F.col("user_id").cast("string").alias("device_id"), "value"
    )


def installations(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")
    )


def signals(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("id_installation"),
    )


def typed_samples(spark: SparkSession, root: str) -> DataFrame:
    kind = F.col("event_id") % 3
    return table(spark, root, "events").select(
        (F.col("user_id") % 25).alias("id"),
        F.col("ts").alias("tstamp"),
        F.when(kind == 0, F.col("value")).alias("value_f64"),
        F.when(kind == 1, _k().cast("long")).alias("value_i64"),
        F.when(kind == 2, _k() >= 50).alias("value_bool"),
        (F.col("event_type") != "error").alias("quality"),
    )


def numeric_samples(typed: DataFrame) -> DataFrame:
    return typed.select(
        "id",
        "tstamp",
        numeric_value("value_f64", "value_i64", "value_bool").alias("value"),
        "quality",
    )


def metrics(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select(
        F.col("ts").alias("time"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(":"), "event_type").alias(
            "metric_name"
        ),
        "value",
    )


def samples_of_type(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """One table per value type: ``float``, ``boolean`` or ``text``."""
    value = {"float": F.col("value"), "boolean": _k() >= 50, "text": F.col("event_type")}[kind]
    return table(spark, root, "events").select(
        F.col("ts").alias("time"),
        F.col("user_id").cast("string").alias("id"),
        value.alias("value"),
    )


def tracked_pairs(spark: SparkSession, root: str) -> DataFrame:
    return all_symbol_pairs(symbol_names(ticks(spark, root)))
