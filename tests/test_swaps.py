import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plain
from tideline.operators import swaps as s

SCHEMA = (
    "id long, time timestamp_ntz, token_address string, token_in double, token_out double, "
    "usd_in double, usd_out double, wallet_address string"
)


@pytest.fixture
def seven_swaps(spark):
    """Two purchases sold off in three sales to the last token, then a purchase half sold."""
    data = [
        (0.1, 0, 4.2, 0),
        (0.2, 0, 9.6, 0),
        (0, 0.15, 0, 7.5),
        (0, 0.05, 0, 2.0),
        (0, 0.1, 0, 5.1),
        (3.3, 0, 165.0, 0),
        (0, 1.1, 0, 60.5),
    ]
    rows = [
        (i, datetime(2025, 5, 1) + timedelta(hours=7 * i), "ash", *map(float, amounts), "ann")
        for i, amounts in enumerate(data, 1)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def random_swaps(spark, n=500, seed=11):
    rng = random.Random(seed)
    rows, held, last = [], {}, {}
    for i in range(n):
        wallet = "hot" if rng.random() < 0.6 else rng.choice(["w1", "w2"])
        token = rng.choice(["x", "y"])
        amount, price = rng.randrange(1, 4000) / 100, rng.randrange(100, 90000) / 100
        when = datetime(2025, 1, 1) + timedelta(minutes=rng.randrange(0, 6 * 1440))
        key = (wallet, token)
        if rng.random() < 0.2 and held.get(key, 0) > 0:
            amount = held[key]  # everything is sold
            when = last[key] + timedelta(seconds=1)
        last[key] = max(when, last.get(key, when))
        if rng.random() < 0.5 and amount != held.get(key):
            held[key] = round(held.get(key, 0) + amount, 2)
            rows.append((i, when, token, amount, 0.0, amount * price, 0.0, wallet))
        else:
            held[key] = round(max(0, held.get(key, 0) - amount), 2)
            rows.append((i, when, token, 0.0, amount, 0.0, amount * price, wallet))
    return spark.createDataFrame(rows, SCHEMA)


def test_pnl_of_seven_swaps(seven_swaps):
    rows = s.swap_pnl(seven_swaps).orderBy("time").collect()
    # The first purchases cost 13.8 for 0.3, 46 each; all together 178.8 for 3.6.
    assert [round(r["realized_pnl"], 4) for r in rows] == [0, 0, 0.6, -0.3, 0.5, 0, round(60.5 - 1.1 * 178.8 / 3.6, 4)]
    assert [round(r["cumulative_pnl"], 4) for r in rows][:6] == [0, 0, 0.6, 0.3, 0.8, 0.8]
    assert [str(r["token_balance"].normalize()) for r in rows] == ["0.1", "0.3", "0.15", "0.1", "0", "3.3", "2.2"]


def test_reports_of_seven_swaps(seven_swaps):
    win = s.win_rate(s.swap_pnl(seven_swaps)).first()
    assert (win["total_trades"], win["winning_trades"], win["win_rate"]) == (4, 3, 75.0)
    basis = s.cost_basis(seven_swaps).first()
    assert round(basis["avg_cost_per_token"], 4) == 49.6667
    assert str(basis["current_token_balance"].normalize()) == "2.2"
    held = s.mark_to_market(seven_swaps).first()
    assert (round(held["estimated_current_price"], 6), round(held["estimated_current_value"], 6)) == (55, 121)
    assert round(held["unrealized_pnl"], 4) == 11.7333
    assert held["unrealized_pnl_percent"] == 10.74


def test_a_closed_position_is_neither_held_nor_a_lot(seven_swaps):
    sold = seven_swaps.filter("id <= 5")
    assert s.cost_basis(sold).isEmpty() and s.mark_to_market(sold).isEmpty()
    lots = s.fifo_lots(seven_swaps).orderBy("sale_id", "lot_id").collect()
    assert [(r["sale_id"], r["lot_id"], float(r["quantity"])) for r in lots] == [
        (3, 1, 0.1), (3, 2, 0.05), (4, 2, 0.05), (5, 2, 0.1), (7, 6, 1.1)]


def test_fifo_of_seven_swaps(seven_swaps):
    pnl = {r["id"]: round(r["fifo_pnl"], 6) for r in s.fifo_pnl(seven_swaps).collect()}
    assert pnl == {3: 0.9, 4: -0.4, 5: 0.3, 7: 5.5}


def test_sales_before_any_purchase(spark):
    rows = [
        (1, datetime(2025, 1, 1), "t", 0.0, 1.0, 0.0, 10.0, "w"),
        (2, datetime(2025, 1, 2), "t", 0.0, 1.0, 0.0, 10.0, "w"),
        (3, datetime(2025, 1, 3), "t", 4.0, 0.0, 8.0, 0.0, "w"),
        (4, datetime(2025, 1, 4), "t", 0.0, 1.0, 0.0, 10.0, "w"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = s.swap_pnl(df).orderBy("id").collect()
    # The first sale costs 0 / 1, the second has no known cost and is skipped by the sum.
    assert [r["realized_pnl"] for r in out] == [10, None, 0, 8]
    assert [r["cumulative_pnl"] for r in out] == [10, 10, 10, 18]
    fifo = {r["id"]: r for r in s.fifo_pnl(df).collect()}
    assert fifo[1]["matched_quantity"] == 0 and fifo[1]["fifo_pnl"] is None
    assert (fifo[4]["matched_quantity"], fifo[4]["fifo_pnl"]) == (1, 8)


def test_hot_wallet_route_equals_plain_route(spark):
    df = random_swaps(spark)
    assert plain(s.swap_pnl(df), digits=4) == plain(s.swap_pnl(df, max_rows=20), digits=4)
    assert plain(s.fifo_lots(df), digits=4) == plain(s.fifo_lots(df, max_rows=20), digits=4)


def fifo_by_hand(rows):
    lots, out = {}, []
    for r in sorted(rows, key=lambda r: (r["time"], r["id"])):
        queue = lots.setdefault((r["wallet_address"], r["token_address"]), [])
        if r["token_in"] > 0:
            queue.append([r["id"], Decimal(str(r["token_in"]))])
        left = Decimal(str(r["token_out"]))
        while left > 0 and queue:
            used = min(left, queue[0][1])
            out.append((r["id"], queue[0][0], used))
            queue[0][1] -= used
            left -= used
            if queue[0][1] == 0:
                queue.pop(0)
    return sorted((a, b, float(q)) for a, b, q in out)


@pytest.mark.parametrize("max_rows", [s.MAX_ROWS, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_fifo_against_a_decimal_queue(spark, seed, max_rows):
    df = random_swaps(spark, 300, seed)
    got = s.fifo_lots(df, max_rows)
    assert plain(got, "sale_id", "lot_id", "quantity") == fifo_by_hand(df.collect())


@pytest.mark.parametrize("max_rows", [10_000, 25])
def test_incremental_equals_full(spark, max_rows):
    df = random_swaps(spark)
    full = s.swap_pnl(df)
    first, second = F.lit(datetime(2025, 1, 3)), F.lit(datetime(2025, 1, 5))
    t = F.col("time")
    books = s.close_books(s.swap_pnl(df.filter(t < first)))
    middle = s.swap_pnl_from_books(df.filter((t >= first) & (t < second)), books, max_rows)
    books = s.close_books(middle, books)
    new = s.swap_pnl_from_books(df.filter(t >= second), books, max_rows)
    assert plain(middle, digits=4) == plain(
        full.filter((t >= first) & (t < second)), digits=4
    )
    assert plain(new, digits=4) == plain(full.filter(t >= second), digits=4)
