"""Price ratios of tracked symbol pairs, derived from the ticks of both legs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import pair_leg, ratio, round_half_up
from tideline.operators.ordered import MAX_ROWS, OrderedScan, running_last

PAIR_DECIMALS = 5


def all_symbol_pairs(symbols: DataFrame) -> DataFrame:
    """Every ordered pair of two different symbols of a symbol table, as ``A/B``.

    Listing the pairs is the purpose here, so the result itself has n * (n - 1) rows.
    """
    names = symbols.select("symbol").distinct()
    a, b = names.alias("a"), names.alias("b")
    return a.join(b, F.col("a.symbol") != F.col("b.symbol")).select(
        F.concat("a.symbol", F.lit("/"), "b.symbol").alias("symbol_pair")
    )


def pair_legs(pairs: DataFrame) -> DataFrame:
    """Two rows per pair: its leg number (1 or 2) and the symbol of that leg."""
    return pairs.select(
        *pairs.columns,
        F.posexplode(F.array(pair_leg("symbol_pair", 1), pair_leg("symbol_pair", 2))).alias(
            "_pos", "leg_symbol"
        ),
    ).select(*pairs.columns, "leg_symbol", (F.col("_pos") + 1).alias("leg"))


def ticks_by_pair(ticks: DataFrame, pairs: DataFrame, tiebreak: str = "tick_id") -> DataFrame:
    """Each tick once per tracked pair that has its symbol as a leg.

    An equi-join on the symbol. It carries no hint: Spark broadcasts the legs while their
    measured size allows, and otherwise shuffles, where adaptive execution splits the
    partitions of a symbol that holds a large share of the ticks.
    """
    legs = pair_legs(pairs)
    extra = [c for c in pairs.columns if c != "symbol_pair"]
    return ticks.join(legs, ticks["symbol"] == legs["leg_symbol"]).select(
        "symbol_pair", "leg", "symbol", "time", tiebreak, "price", *extra
    )


def with_initial_prices(pairs: DataFrame, symbols: DataFrame) -> DataFrame:
    """Pairs with the already known last price of each leg."""
    known = symbols.select("symbol", "last_price")
    out = pairs
    for leg in (1, 2):
        prices = known.select(
            F.col("symbol").alias("_leg"), F.col("last_price").alias(f"initial_{leg}")
        )
        out = out.join(prices, pair_leg("symbol_pair", leg) == F.col("_leg"), "left").drop("_leg")
    return out


def pair_ticks(
    ticks: DataFrame,
    pairs: DataFrame,
    symbols: DataFrame | None = None,
    tiebreak: str = "tick_id",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """At each tick of a leg, the ratio of the latest prices of both legs, volume 1.

    Nothing is emitted until both prices are known, nor while the second price is zero.
    ``symbols`` supplies prices known before the first tick.
    """
    if symbols is not None:
        pairs = with_initial_prices(pairs, symbols)
    rows = ticks_by_pair(ticks, pairs, tiebreak)
    # Rows per pair follow from the ticks per symbol, before the fan-out over pairs.
    legs, counts = pair_legs(pairs), ticks.groupBy("symbol").count()
    sizes = (
        legs.join(counts, legs["leg_symbol"] == counts["symbol"])
        .groupBy("symbol_pair")
        .agg(F.sum("count").alias("count"))
    )
    order = ["time", tiebreak, "leg"]
    scan = OrderedScan.of(rows, ["symbol_pair"], order, max_rows, sizes).running(
        {
            f"price_{leg}": running_last(F.when(F.col("leg") == leg, F.col("price")))
            for leg in (1, 2)
        }
    )
    known = scan.frame()
    if symbols is not None:
        known = known.withColumns(
            {f"price_{leg}": F.coalesce(f"price_{leg}", f"initial_{leg}") for leg in (1, 2)}
        )
    return (
        known.withColumn(
            "_ratio", round_half_up(ratio(F.col("price_1"), F.col("price_2")), PAIR_DECIMALS)
        )
        .filter(F.col("_ratio").isNotNull())
        .select(
            "time",
            F.col(tiebreak),
            F.col("symbol_pair").alias("symbol"),
            F.col("_ratio").alias("price"),
            F.lit(1.0).alias("volume"),
        )
    )
