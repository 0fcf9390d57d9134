from conftest import make_ticks, minutes, plain, random_ticks
from tideline.operators import lastprice, pairs


def symbols(spark, names, price=None):
    return spark.createDataFrame(
        [(n, price, None) for n in names], "symbol string, last_price double, last_price_at timestamp_ntz"
    )


def pair_frame(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "symbol_pair string")


def test_both_legs_emit_a_ratio(spark):
    known = spark.createDataFrame(
        [("STOCK_A", 101.0, minutes(0)), ("STOCK_B", 202.0, minutes(0))],
        "symbol string, last_price double, last_price_at timestamp_ntz",
    )
    ticks = make_ticks(spark, [(1, "STOCK_A", 102, 1000), (1, "STOCK_B", 202, 500)])
    out = pairs.pair_ticks(ticks, pair_frame(spark, "STOCK_A/STOCK_B"), known)
    assert plain(out, "symbol", "price", "volume") == [("STOCK_A/STOCK_B", 0.50495, 1.0)] * 2


def test_thirty_symbols_make_870_pairs(spark):
    names = symbols(spark, [f"SYM-{i}" for i in range(1, 31)])
    out = pairs.all_symbol_pairs(names)
    assert out.count() == out.distinct().count() == 870


def test_prefix_symbols_do_not_match(spark):
    ticks = make_ticks(spark, [(0, "SYM-1", 1, 1), (1, "SYM-10", 2, 1)])
    out = pairs.ticks_by_pair(ticks, pair_frame(spark, "SYM-10/X"))
    assert plain(out, "symbol", "leg") == [("SYM-10", 1)]


def test_zero_second_price_and_unknown_leg_emit_nothing(spark):
    ticks = make_ticks(spark, [(0, "A", 4, 1), (1, "B", 0, 1), (2, "A", 5, 1), (3, "B", 2, 1)])
    out = pairs.pair_ticks(ticks, pair_frame(spark, "A/B", "A/C"))
    assert plain(out, "time", "symbol", "price") == [(minutes(3), "A/B", 2.5)]


def test_ratios_round_half_away_from_zero(spark):
    ticks = make_ticks(spark, [(0, "B", 32, 1), (1, "A", 11.3, 1)])
    assert pairs.pair_ticks(ticks, pair_frame(spark, "A/B")).first()["price"] == 0.35313


def test_split_route_equals_plain_route(spark):
    ticks = random_ticks(spark, hot="H")
    tracked = pairs.all_symbol_pairs(lastprice.symbol_names(ticks))
    whole = pairs.pair_ticks(ticks, tracked)
    assert whole.count() > 1500
    assert plain(whole) == plain(pairs.pair_ticks(ticks, tracked, max_rows=40))


def test_initial_last_price_takes_highest_of_ties(spark):
    ticks = make_ticks(spark, [(0, "A", 9, 1), (1, "A", 4, 1), (1, "A", 5, 1), (0, "B", 2, 1)])
    out = lastprice.initial_last_prices(ticks)
    assert plain(out) == [("A", 5.0, minutes(1)), ("B", 2.0, minutes(0))]


def test_merge_last_prices(spark):
    known = spark.createDataFrame(
        [("A", 1.0, minutes(5)), ("B", None, None), ("C", 7.0, minutes(1))],
        "symbol string, last_price double, last_price_at timestamp_ntz",
    )
    ticks = make_ticks(spark, [(3, "A", 9, 1), (2, "B", 4, 1), (2, "C", 6, 1), (2, "D", 3, 1)])
    seeded = plain(lastprice.merge_last_prices(known, ticks), "symbol", "last_price")
    assert seeded == [("A", 1.0), ("B", 4.0), ("C", 6.0)]
    everyone = lastprice.merge_last_prices(known, ticks, seeded_only=False)
    assert plain(everyone, "symbol", "last_price") == [*seeded, ("D", 3.0)]


def test_insert_if_absent(spark):
    old, new = symbols(spark, ["A", "B"], 1.0), symbols(spark, ["B", "C", "C"], 2.0)
    out = lastprice.insert_if_absent(old, new, ["symbol"])
    assert plain(out, "symbol", "last_price") == [("A", 1.0), ("B", 1.0), ("C", 2.0)]
