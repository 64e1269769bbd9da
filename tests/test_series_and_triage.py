import datetime as dt

import pytest
from pyspark.sql import functions as F

from peervane.operators import series as sr
from peervane.operators import triage as tr
from peervane.operators.asof import combine_terms, in_force
from peervane.operators.dedup import last_per_key
from peervane.operators.joins import RepeatedKeyError, left_join_keeping_rows
from peervane.operators.links import heaviest_edge, measured_fees, reconcile_fees
from peervane.operators.universe import (
    FunnelDeviationError,
    compare_funnel,
    raise_if_off,
    reachable,
)

DAY = dt.date(2025, 1, 1)


def panel(spark, **prices):
    rows = [
        (e, DAY + dt.timedelta(days=i), p, 100.0, 1.0, None, 10)
        for e, series in prices.items()
        for i, p in enumerate(series)
        if p is not Ellipsis
    ]
    return spark.createDataFrame(rows, "entity string, ts date, price double, assets double, inflow double, outflow double, holders bigint")


def metrics(spark, benchmark=0.0, **prices):
    rows = sr.metric_panel(panel(spark, **prices), F.lit(benchmark)).collect()
    return {r["entity"]: r for r in rows}


def test_known_drawdowns_and_returns(spark):
    got = metrics(spark, 0.1, a=[100.0, 200.0, 150.0, 180.0], b=[100.0, 400.0, 200.0], c=[5.0, 5.0, 5.0])
    assert got["a"]["max_drawdown"] == pytest.approx(-0.25)
    assert got["b"]["max_drawdown"] == pytest.approx(-0.5)
    assert got["a"]["total_return"] == pytest.approx(0.8)
    assert got["a"]["excess_return"] == pytest.approx(0.7)
    assert got["c"]["volatility"] == 0.0 and got["c"]["return_per_risk"] is None
    assert got["c"]["downside_volatility"] == 0.0 and got["c"]["negative_days"] == 0.0


def test_period_return_of_the_published_series(spark):
    got = metrics(spark, a=[42.4090370000, 43.0, 43.7544400000])
    assert got["a"]["total_return"] == pytest.approx(0.031724441185, abs=1e-12)


def test_unusable_series_are_left_out(spark):
    got = metrics(spark, a=[1.0, 0.0, 2.0], b=[1.0, None, 2.0], c=[1.0], d=[1.0, float("nan"), 2.0], e=[1.0, 2.0])
    assert set(got) == {"e"}


def test_point_in_time(spark):
    whole = panel(spark, a=[1.0, 2.0, 4.0])
    (row,) = sr.metric_panel(whole, F.lit(0.0), reference=DAY + dt.timedelta(days=1)).collect()
    assert row["observations"] == 2 and row["total_return"] == pytest.approx(1.0)


def test_timestamps_are_refused(spark):
    with pytest.raises(TypeError):
        sr.metric_panel(panel(spark, a=[1.0, 2.0]).withColumn("ts", F.col("ts").cast("timestamp")), F.lit(0.0))


def test_adjacent_returns_void_a_gap(spark):
    p = panel(spark, a=[1.0, 2.0, 4.0, 8.0], b=[1.0, ..., 4.0, 8.0])
    got = sr.with_adjacent_returns(p, sr.calendar_of(p)).orderBy("entity", "ts").collect()
    assert [r["ret"] for r in got if r["entity"] == "b"] == [None, None, 1.0]
    assert [r["ret"] for r in sr.with_returns(p).orderBy("entity", "ts").collect() if r["entity"] == "b"] == [None, 3.0, 1.0]


def test_stale_runs_must_be_contiguous(spark):
    frozen = [1.0] + [2.0] * 4 + [3.0]
    scattered = [1.0, 1.0, 2.0, 2.0, 3.0, 3.0]
    got = sr.flag_stale_prices(panel(spark, a=frozen, b=scattered), 3).orderBy("entity", "ts").collect()
    assert [r["stale_price"] for r in got if r["entity"] == "a"] == [False, False, True, True, True, False]
    assert not any(r["stale_price"] for r in got if r["entity"] == "b")


def test_implausible_moves_never_flag_the_first_row(spark):
    got = sr.flag_implausible_moves(panel(spark, a=[1.0, 1.5, 1.6], b=[9.0, 9.1])).orderBy("entity", "ts").collect()
    assert [r["implausible_move"] for r in got] == [False, True, False, False, False]


def test_compounding_no_rates_gives_zero(spark):
    rates = spark.createDataFrame([(DAY, 0.01), (DAY + dt.timedelta(days=1), 0.02)], "ts date, rate double")
    assert sr.benchmark_over(rates, DAY, DAY + dt.timedelta(days=9)).first()[0] == pytest.approx(1.01 * 1.02 - 1)
    assert sr.benchmark_over(rates, dt.date(2030, 1, 1), dt.date(2031, 1, 1)).first()[0] == 0.0


DIRTY = [
    ("00017024000153", DAY, 10.0, 5.0, 1), ("00068305000135", DAY, 10.0, 5.0, 2), ("00068305000135", DAY, 11.0, 5.0, 3),
    ("42592315000115", DAY, -1.0, 5.0, 4), ("42592315000115", DAY + dt.timedelta(1), None, 5.0, 5),
    ("00017024000153", DAY + dt.timedelta(400), 10.0, 5.0, 6), ("123", DAY, 10.0, 5.0, 7), ("00017024000154", DAY, 10.0, 5.0, 8),
    ("00017024000153", DAY + dt.timedelta(2), 10.0, -500.0, 9), ("00017024000153", None, 10.0, 5.0, 10),
]


def dirty(spark):
    frame = spark.createDataFrame(DIRTY, "key string, ts date, price double, assets double, seq bigint")
    reason = tr.rejection_reason(F.col("key"), F.col("ts"), F.col("price"), F.col("assets"))
    return frame, tr.triage(frame, ["key", "ts"], "ts", reason, DAY + dt.timedelta(300), [F.col("seq")])


def test_each_defect_has_its_reason(spark):
    _, judged = dirty(spark)
    fate = {r["seq"]: (r["disposition"], r["reason"]) for r in judged.collect()}
    assert fate == {
        1: ("clean", None), 3: ("clean", None), 4: ("quarantined", "price at or below zero"), 5: ("quarantined", "no price"),
        6: ("future", None), 7: ("quarantined", "key must have 14 digits"), 8: ("quarantined", "key fails its check digits"),
        9: ("quarantined", "assets below zero"), 10: ("quarantined", "no readable date"),
    }


def test_rows_add_up(spark):
    frame, judged = dirty(spark)
    plan = tr.accounting(judged)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    assert dict(judged.select("seq", "copies").collect())[3] == 2 and frame.count() == judged.agg(F.sum("copies")).first()[0]
    counts = {r["disposition"]: r["n_rows"] for r in tr.accounting(judged).collect()}
    assert counts == {"clean": 2, "quarantined": 6, "future": 1, "deduplicated": 1}
    with pytest.raises(tr.TooMuchQuarantinedError):
        tr.assert_quarantine_within(judged, 0.05)
    assert tr.assert_quarantine_within(judged, 0.7) == pytest.approx(0.6)


def test_contract_on_clean_rows(spark):
    _, judged = dirty(spark)
    clean = tr.clean_rows(judged).withColumn("holders", F.lit(1))
    tr.assert_contract(clean, "key", "ts", "price", "assets", "holders")
    with pytest.raises(tr.ContractError):
        tr.assert_contract(clean.withColumn("price", F.lit(0.0)), "key", "ts", "price", "assets", "holders")


def test_last_row_keeps_its_nulls(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("b", 1, "y")]
    got = last_per_key(spark.createDataFrame(rows, "k string, seq int, v string"), ["k"], [F.col("seq")]).collect()
    assert {(r["k"], r["seq"], r["v"]) for r in got} == {("a", 2, None), ("b", 1, "y")}


def test_terms_in_force_and_coalesced(spark):
    rows = [("a", DAY, 0.01, 1), ("a", DAY + dt.timedelta(5), None, 2), ("a", DAY + dt.timedelta(50), 0.03, 3), ("b", None, 0.01, 1)]
    filings = spark.createDataFrame(rows, "entity string, ts date, fee double, redemption_days int")
    (row,) = in_force(filings, "entity", "ts", DAY + dt.timedelta(10)).collect()
    assert row["fee"] is None and row["redemption_days"] == 2
    primary = spark.createDataFrame([("a", 0.01, 1), ("b", None, 1)], "entity string, fee double, redemption_days int")
    fallback = spark.createDataFrame([("a", 0.09, 9), ("b", 0.02, 2), ("c", 0.03, 3)], "entity string, fee double, redemption_days int")
    got = combine_terms(primary, fallback, "entity", ["fee", "redemption_days"], ("P", "F")).collect()
    assert {(r["entity"], r["fee"], r["source"]) for r in got} == {("a", 0.01, "P"), ("b", 0.02, "F"), ("c", 0.03, "F")}


def test_coalescing_reads_each_filing_once(spark, tmp_path):
    schema = "entity string, fee double, redemption_days int"
    written = {"primary": [("a", 0.01, 1), ("b", None, 1), (None, 0.05, 5)], "fallback": [("a", 0.09, 9), ("b", 0.02, 2), ("b", 0.02, 3), (None, 0.06, 6)]}
    for name, rows in written.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    primary, fallback = (spark.read.parquet(f"{tmp_path}/{name}") for name in written)
    got = combine_terms(primary, fallback, "entity", ["fee", "redemption_days"], ("P", "F"))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(
        map(str, [("a", 0.01, 1, "P"), (None, 0.05, 5, "P"), ("b", 0.02, 2, "F"), ("b", 0.02, 3, "F"), (None, 0.06, 6, "F")])
    )
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2


def test_dimension_join_refuses_repeated_keys(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(RepeatedKeyError):
        left_join_keeping_rows(left, right, ["k"])


def test_fee_is_the_same_over_any_window(spark):
    def fee(days):
        master = [100.0 * 1.0005**i for i in range(days)]
        own = [100.0 * (1.0005 * (1 - 0.02) ** (1 / 252)) ** i for i in range(days)]
        p = panel(spark, m=master, a=own)
        links = spark.createDataFrame([("a", "m")], "src string, dst string")
        return measured_fees(p, links, 252, 60).first()["measured_fee"]

    assert fee(100) == pytest.approx(0.02, abs=1e-9)
    assert fee(300) == pytest.approx(0.02, abs=1e-9)


def test_no_negative_and_no_short_fee(spark):
    p = panel(spark, m=[1.0 + i / 100 for i in range(80)], a=[1.0 + i / 50 for i in range(80)], b=[1.0, 1.1])
    links = spark.createDataFrame([("a", "m"), ("b", "m")], "src string, dst string")
    assert measured_fees(p, links, 252, 60).count() == 0


def test_heaviest_edge_needs_its_share(spark):
    edges = spark.createDataFrame([("a", "m", 60.0), ("a", "m", 37.0), ("a", "n", 3.0), ("b", "m", 50.0), ("b", "n", 50.0)], "src string, dst string, value double")
    (row,) = heaviest_edge(edges, 0.95).collect()
    assert (row["src"], row["dst"]) == ("a", "m") and row["share"] == pytest.approx(0.97)


def test_reconciled_fee_errs_against_the_entity(spark):
    funds = spark.createDataFrame([("a", 0.01, "N"), ("b", 0.01, " s "), ("c", 0.01, "S"), ("d", 0.03, None)], "entity string, fee double, holds_funds string")
    measured = spark.createDataFrame([("a", 0.02), ("c", 0.005)], "entity string, measured_fee double")
    got = {r["entity"]: r["fee"] for r in reconcile_fees(funds, measured, "entity").collect()}
    assert got == {"a": 0.02, "b": None, "c": 0.01, "d": 0.03}


def test_reachability(spark):
    funds = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "entity string")
    profile = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 3.0), ("c", 0.0, 0.0)], "entity string, individuals double, distributors double")
    assert {r["entity"] for r in reachable(funds, profile, "entity").collect()} == {"a", "b", "d"}


def test_funnel_tolerance(spark):
    observed = spark.createDataFrame([(0, "x", 100), (1, "y", 90), (2, "z", 1)], "ord int, step string, observed bigint")
    report = compare_funnel(observed, {"x": 98, "y": 100}, 0.03)
    got = {r["step"]: (round(r["deviation"], 4), r["ok"]) for r in report.collect()}
    assert got == {"x": (0.0204, True), "y": (-0.1, False)}
    with pytest.raises(FunnelDeviationError, match="y is -10.0%"):
        raise_if_off(report)
