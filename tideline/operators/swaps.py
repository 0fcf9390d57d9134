"""Token swap accounting per wallet and token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.buckets import time_bucket
from tideline.functions.scalars import add_nullable, ratio, round_half_up
from tideline.operators.ordered import (
    MAX_ROWS,
    OrderedScan,
    Running,
    row_index,
    running_last,
    running_max,
    running_sum,
)
from tideline.session import stored

# Amounts and their sums are exact: what was bought and sold off again leaves nothing. Sums
# keep one digit less before the point than a decimal can hold, so that differences of two
# are exact as well. Doubles are read by their shortest decimal form; unit prices, values
# and profits, which come from divisions, are doubles.
AMOUNT, TOTAL = "decimal(36,18)", "decimal(37,18)"
KEYS = ("wallet_address", "token_address")
ORDER = ("time", "id")
PNL_COLUMNS = (
    "id",
    "time",
    "wallet_address",
    "token_address",
    "token_in",
    "token_out",
    "usd_in",
    "usd_out",
    "token_balance",
    "realized_pnl",
    "cumulative_pnl",
)


def amount(name: str) -> Column:
    return F.col(name).cast(AMOUNT)


def total(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(TOTAL)


def number(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def _realized(spent_before, bought_before):
    """Profit of a sale at the average cost of all purchases before it.

    NULL when tokens were sold earlier but none was ever bought.
    """
    sale = number("usd_out") - number("token_out") * ratio(spent_before, bought_before)
    return F.when(F.col("token_out") > 0, sale).otherwise(F.lit(0.0))


def swap_pnl(swaps: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Running token balance, realized and cumulative profit per wallet and token."""
    first = F.col("_row") == 0
    scan = (
        OrderedScan.of(swaps, KEYS, ORDER, max_rows)
        .running(
            {
                "_in": running_sum(amount("token_in")),
                "_out": running_sum(amount("token_out")),
                "_in_before": running_sum(amount("token_in"), exclusive=True),
                "_usd_before": running_sum(amount("usd_in"), exclusive=True),
                "_row": row_index(),
            }
        )
        .with_columns(
            {
                "token_balance": total("_in") - total("_out"),
                "realized_pnl": _realized(
                    F.when(first, F.lit(0.0)).otherwise(number("_usd_before")),
                    F.when(first, F.lit(1.0)).otherwise(number("_in_before")),
                ),
            }
        )
        .running({"cumulative_pnl": running_sum(F.col("realized_pnl"))})
    )
    return scan.frame().select(*PNL_COLUMNS)


BOOK_SCHEMA = (
    f"wallet_address string, token_address string, c_in {TOTAL}, c_out {TOTAL}, c_usd {TOTAL}, c_pnl double, c_rows bigint"
)


def close_books(
    pnl: DataFrame, previous: DataFrame | None = None, by: tuple[str, ...] = KEYS
) -> DataFrame:
    """Carry-in for later rows: totals per wallet and token over finished PnL rows."""
    totals = pnl.groupBy(*by).agg(
        total(F.sum(amount("token_in"))).alias("c_in"),
        total(F.sum(amount("token_out"))).alias("c_out"),
        total(F.sum(amount("usd_in"))).alias("c_usd"),
        F.sum("realized_pnl").alias("c_pnl"),
        F.count("*").alias("c_rows"),
    )
    return totals if previous is None else add_books(previous.unionByName(totals))


def add_books(books: DataFrame) -> DataFrame:
    """Totals per wallet and token of several sets of totals."""
    names = ("c_in", "c_out", "c_usd", "c_pnl", "c_rows")
    exact = ("c_in", "c_out", "c_usd")
    return books.groupBy(*KEYS).agg(
        *((total(F.sum(n)) if n in exact else F.sum(n)).alias(n) for n in names)
    )


def swap_pnl_from_books(
    new_swaps: DataFrame, books: DataFrame, max_rows: int = MAX_ROWS
) -> DataFrame:
    """PnL of newer rows only, continuing from stored totals; older rows are not read."""
    wanted = ("id", "time", *KEYS, "token_in", "token_out", "usd_in", "usd_out")
    rows = new_swaps.select(*wanted).join(books, list(KEYS), "left")
    before_in = number(add_nullable(total("c_in"), total("_in_before")))
    before_usd = number(add_nullable(total("c_usd"), total("_usd_before")))
    first = (F.col("_row") == 0) & F.col("c_rows").isNull()
    scan = (
        OrderedScan.of(rows, KEYS, ORDER, max_rows)
        .running(
            {
                "_in": running_sum(amount("token_in")),
                "_out": running_sum(amount("token_out")),
                "_in_before": running_sum(amount("token_in"), exclusive=True),
                "_usd_before": running_sum(amount("usd_in"), exclusive=True),
                "_row": row_index(),
            }
        )
        .with_columns(
            {
                "token_balance": total(add_nullable(total("c_in"), total("_in")))
                - total(add_nullable(total("c_out"), total("_out"))),
                "realized_pnl": _realized(
                    F.when(first, F.lit(0.0)).otherwise(before_usd),
                    F.when(first, F.lit(1.0)).otherwise(before_in),
                ),
            }
        )
        .running({"_pnl": running_sum(F.col("realized_pnl"))})
        .with_columns({"cumulative_pnl": add_nullable(F.col("c_pnl"), F.col("_pnl"))})
    )
    return scan.frame().select(*PNL_COLUMNS)


ACTIVITY = (
    "total_usd_in",
    "total_usd_out",
    "total_token_in",
    "total_token_out",
    "swap_count",
    "sell_count",
    "buy_count",
)


def swap_activity(swaps: DataFrame, width: str = "1 hour") -> DataFrame:
    return swaps.groupBy(time_bucket(width, "time").alias("bucket"), *KEYS).agg(
        total(F.sum(amount("usd_in"))).alias("total_usd_in"),
        total(F.sum(amount("usd_out"))).alias("total_usd_out"),
        total(F.sum(amount("token_in"))).alias("total_token_in"),
        total(F.sum(amount("token_out"))).alias("total_token_out"),
        F.count("*").alias("swap_count"),
        F.count_if(F.col("token_out") > 0).alias("sell_count"),
        F.count_if(F.col("token_in") > 0).alias("buy_count"),
    )


def rollup_swap_activity(activity: DataFrame, width: str) -> DataFrame:
    return (
        activity.withColumn("_parent", time_bucket(width, "bucket"))
        .groupBy(F.col("_parent").alias("bucket"), *KEYS)
        .agg(*((total(F.sum(n)) if n.startswith("total_") else F.sum(n)).alias(n) for n in ACTIVITY))
    )


def daily_volume(swaps: DataFrame) -> DataFrame:
    return swaps.groupBy(time_bucket("1 day", "time").alias("day"), "token_address").agg(
        total(F.sum(amount("usd_in"))).alias("buy_volume_usd"),
        total(F.sum(amount("usd_out"))).alias("sell_volume_usd"),
        total(F.sum(amount("usd_in") + amount("usd_out"))).alias("total_volume_usd"),
        total(F.sum(amount("token_in"))).alias("buy_volume_token"),
        total(F.sum(amount("token_out"))).alias("sell_volume_token"),
    )


def cost_basis(swaps: DataFrame) -> DataFrame:
    """Average cost and balance of every wallet and token still held."""
    balance = F.col("total_tokens_bought") - F.col("_sold")
    return (
        swaps.groupBy(*KEYS)
        .agg(
            total(F.sum(amount("usd_in"))).alias("total_cost"),
            total(F.sum(amount("token_in"))).alias("total_tokens_bought"),
            total(F.sum(amount("token_out"))).alias("_sold"),
        )
        .withColumn("current_token_balance", balance)
        .filter(F.col("current_token_balance") > 0)
        .select(
            *KEYS,
            "total_cost",
            "total_tokens_bought",
            ratio(number("total_cost"), number("total_tokens_bought")).alias("avg_cost_per_token"),
            "current_token_balance",
        )
    )


def win_rate(pnl: DataFrame) -> DataFrame:
    """Share of profitable sales and total profit, from the rows of ``swap_pnl``."""
    trades = F.col("total_trades")
    return (
        pnl.filter(F.col("token_out") > 0)
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias("total_trades"),
            F.count_if(F.col("realized_pnl") > 0).alias("winning_trades"),
            F.sum("realized_pnl").alias("total_pnl"),
        )
        .select(
            *KEYS,
            "total_trades",
            "winning_trades",
            round_half_up(ratio(F.col("winning_trades") * F.lit(100.0), trades), 2).alias("win_rate"),
            "total_pnl",
        )
    )


def last_sale_prices(swaps: DataFrame) -> DataFrame:
    """Price of the newest sale of each token."""
    price = ratio(number("usd_out"), number("token_out"))
    return (
        swaps.filter(F.col("token_out") > 0)
        .groupBy("token_address")
        .agg(F.max_by(price, "time").alias("estimated_current_price"))
    )


def mark_to_market(swaps: DataFrame) -> DataFrame:
    """Value and unrealized profit of open balances at the last sale price.

    Both sides are aggregated before the join; it carries no hint, so the token side is
    broadcast only while its size allows.
    """
    held = cost_basis(swaps).select(*KEYS, "current_token_balance", "avg_cost_per_token")
    balance, cost = number("current_token_balance"), F.col("avg_cost_per_token")
    price = F.col("estimated_current_price")
    return held.join(last_sale_prices(swaps), "token_address").select(
        *KEYS,
        "current_token_balance",
        cost,
        price,
        (balance * price).alias("estimated_current_value"),
        (balance * price - balance * cost).alias("unrealized_pnl"),
        round_half_up((ratio(price, cost) - 1) * 100, 2).alias("unrealized_pnl_percent"),
    )


def _last_where(condition: Column, name: str) -> Running:
    return running_last(F.when(condition, F.col(name)))


def fifo_lots(swaps: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Which purchase lots each sale used up, first in first out.

    Purchases fill the line of token quantities from zero; sales consume it from zero
    too. ``bought - shortage`` keeps a sale from using lots bought after it: the
    shortage is the running maximum of what was sold beyond everything bought so far.
    Both kinds of stretch lie end to end on that line, so instead of joining overlapping
    stretches, all their starting points are sorted and the lot and sale in force at each
    point carried forward. Work is linear in the number of swaps.
    """
    zero = F.lit(0).cast(TOTAL)
    bought, sold = F.coalesce(amount("token_in"), zero), F.coalesce(amount("token_out"), zero)
    flows = OrderedScan.of(swaps, KEYS, ORDER, max_rows)
    running = (
        flows.running(
            {
                "_b": running_sum(bought),
                "_b0": running_sum(bought, exclusive=True),
                "_s": running_sum(sold),
                "_s0": running_sum(sold, exclusive=True),
            }
        )
        .with_columns({"_over": total("_s") - total("_b")})
        .running(
            {
                "_u": running_max(F.col("_over")),
                "_u0": running_max(F.col("_over"), exclusive=True),
            }
        )
        .frame()
    )

    def point(kind: int, low, high, cost):
        return F.struct(
            F.lit(kind).alias("kind"),
            total(low).alias("low"),
            total(high).alias("high"),
            cost.alias("cost"),
        )

    lot = point(
        0,
        F.coalesce(total("_b0"), zero),
        F.col("_b"),
        ratio(number("usd_in"), number("token_in")),
    )
    sale = point(
        1,
        F.coalesce(total("_s0"), zero) - total(F.greatest(total("_u0"), zero)),
        total("_s") - total(F.greatest(total("_u"), zero)),
        F.lit(None).cast("double"),
    )
    # A row may buy, sell or both; empty stretches mark nothing.
    points = (
        running.select(*KEYS, "id", F.explode(F.array(lot, sale)).alias("p"))
        .select(*KEYS, "id", "p.*")
        .filter(F.col("high") > F.col("low"))
    )
    is_lot = F.col("kind") == 0
    order = ("low", "kind", "id")
    if flows.split is None:
        # No key is large, and a swap gives at most two points.
        by_quantity = OrderedScan(KEYS, order, points, None)
    else:
        by_quantity = OrderedScan.of(stored(points, "fifo-points"), KEYS, order, max_rows)
    scan = by_quantity.running(
        {
            "lot_id": _last_where(is_lot, "id"),
            "_lot_high": _last_where(is_lot, "high"),
            "unit_cost": _last_where(is_lot, "cost"),
            "sale_id": _last_where(~is_lot, "id"),
            "_sale_high": _last_where(~is_lot, "high"),
        }
    )
    quantity = F.least("_lot_high", "_sale_high") - F.col("low")
    return (
        scan.frame()
        .filter(F.col("lot_id").isNotNull() & F.col("sale_id").isNotNull())
        .withColumn("quantity", quantity)
        .filter(F.col("quantity") > 0)
        .select(*KEYS, "sale_id", "lot_id", "quantity", "unit_cost")
    )


def fifo_pnl(swaps: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Per sale: matched and unmatched quantity, lot cost, profit of the matched part."""
    used = (
        fifo_lots(swaps, max_rows)
        .groupBy("sale_id")
        .agg(
            F.sum("quantity").alias("_quantity"),
            F.sum(number("quantity") * F.col("unit_cost")).alias("fifo_cost"),
        )
    )
    sales = swaps.filter(F.col("token_out") > 0)
    matched = F.coalesce(total("_quantity"), F.lit(0).cast(TOTAL))
    return sales.join(used, sales["id"] == used["sale_id"], "left").select(
        "id",
        "time",
        *KEYS,
        "token_out",
        matched.alias("matched_quantity"),
        (total(amount("token_out")) - matched).alias("unmatched_quantity"),
        "fifo_cost",
        (number("usd_out") * number(matched) / number("token_out") - F.col("fifo_cost")).alias("fifo_pnl"),
    )
