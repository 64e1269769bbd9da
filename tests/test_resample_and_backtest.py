import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peervane.operators import backtest as bt
from peervane.operators import peers as pe
from peervane.operators import resample as rs
from peervane.operators import twins as tw
from peervane.params import Backtest, Profile, Resampling, weights_table
from peervane.session import materialise

DAY = dt.date(2025, 1, 1)
SETTINGS = Resampling(draws=300, block=5, seed=42)


def histories(spark, **rets):
    return spark.createDataFrame([(e, r, [0.0001] * len(r)) for e, r in rets.items()], "entity string, rets array<double>, rates array<double>")


def test_blocks_are_contiguous_and_lengths_kept(spark):
    h = histories(spark, a=[float(i) for i in range(23)], b=[0.5, 0.25, 0.125])
    for r in rs.block_bootstrap(h, SETTINGS).collect():
        got = r["rets"]
        if r["entity"] == "b":
            assert len(got) == 3
            continue
        assert len(got) == 23
        for at in range(0, 23, 5):
            block = got[at : at + 5]
            assert [x - block[0] for x in block] == list(range(len(block)))


def test_both_resamplers_draw_the_same_blocks(spark):
    rng = random.Random(1)
    h = histories(spark, **{e: [rng.gauss(0.0005, 0.01) for _ in range(n)] for e, n in (("a", 60), ("b", 31), ("c", 2))})
    arrays = {(r["entity"], r["draw"]): np.array(r["rets"]) for r in rs.block_bootstrap(h, SETTINGS).collect()}
    got = rs.resample_metrics(h, SETTINGS).collect()
    assert len(got) == 900
    for r in got:
        x = arrays[r["entity"], r["draw"]]
        path = np.concatenate([[1.0], np.cumprod(1 + x)])
        assert r["excess_return"] == pytest.approx(path[-1] - 1.0001 ** len(x), abs=1e-12)
        assert r["volatility"] == pytest.approx(np.std(x, ddof=1) * 252**0.5)
        assert r["max_drawdown"] == pytest.approx((path / np.maximum.accumulate(path) - 1).min())


def test_still_series_has_no_ratio_and_seeds_matter(spark):
    h = histories(spark, a=[0.0] * 30, b=[0.01 * (-1) ** i for i in range(31)])
    got = rs.resample_metrics(h, SETTINGS).collect()
    assert all(r["return_per_risk"] is None for r in got if r["entity"] == "a")
    parity = rs.resample_metrics(h, SETTINGS, include_base=False).agg(F.avg("max_drawdown")).first()[0]
    assert parity >= rs.resample_metrics(h, SETTINGS).agg(F.avg("max_drawdown")).first()[0]
    one, same, other = (
        sorted(map(tuple, rs.resample_metrics(h.repartition(n), Resampling(draws=20, block=5, seed=s)).select("entity", "draw", "excess_return").collect()))
        for n, s in ((1, 1), (4, 1), (1, 2))
    )
    assert one == same and one != other


def test_jittered_weights_stay_whole_and_near(spark):
    profile = Profile("p", {"a": 50, "b": 30, "c": 20}, {"a": 5, "b": 3})
    table = weights_table(spark, [profile])
    rows = rs.jitter_weights(table, SETTINGS).collect()
    by_draw = {}
    for r in rows:
        by_draw.setdefault(r["draw"], {})[r["metric"]] = r["drawn_weight"]
    assert len(by_draw) == 300 and all(sum(w.values()) == 100 for w in by_draw.values())
    assert all(40 <= w["a"] <= 60 and 24 <= w["b"] <= 36 for w in by_draw.values())
    assert len({w["a"] for w in by_draw.values()}) > 4
    still = rs.jitter_weights(table.withColumn("jitter", F.lit(0)), SETTINGS).filter("metric = 'a'")
    assert {r["drawn_weight"] for r in still.collect()} == {50}


RULES = Backtest([DAY + dt.timedelta(10), DAY + dt.timedelta(20)], DAY + dt.timedelta(60), portfolios=400, seed=3)


def test_forward_returns_are_strictly_after_the_cut(spark):
    rows = [("a", DAY + dt.timedelta(i), float(2**i) if i <= 12 else 2.0**12) for i in range(61)] + [("b", DAY + dt.timedelta(i), 1.0) for i in range(11)]
    panel = spark.createDataFrame(rows, "entity string, ts date, price double")
    got = {(r["cut_date"], r["entity"]): r["forward_return"] for r in bt.forward_returns(panel, RULES).collect()}
    assert got == {(RULES.cut_dates[0], "a"): pytest.approx(1.0), (RULES.cut_dates[1], "a"): 0.0}
    assert [r["entity"] for r in bt.discontinued(panel, RULES).collect()] == ["b"]


def test_random_subsets_are_distinct_and_fair(spark):
    members = spark.createDataFrame([(DAY, "p", f"e{i}", float(i)) for i in range(12)], "cut_date date, profile string, entity string, forward_return double")
    sizes = spark.createDataFrame([(DAY, "p", 5)], "cut_date date, profile string, size int")
    slots = spark.range(2000).select(bt.subset_slots(F.lit(5), F.lit(12).cast("bigint"), 3, F.col("id")).alias("s")).collect()
    seen = [0] * 12
    for r in slots:
        assert len(set(r["s"])) == 5
        for k in r["s"]:
            seen[k] += 1
    assert all(700 < n < 970 for n in seen)
    got = bt.random_portfolios(members, sizes, 400, 3).collect()
    assert len(got) == 400
    assert np.mean([r["portfolio_return"] for r in got]) == pytest.approx(5.5, abs=0.3)
    small = bt.random_portfolios(members.limit(3), sizes, 10, 3).collect()
    everyone = np.mean([r["forward_return"] for r in members.limit(3).collect()])
    assert [r["portfolio_return"] for r in small] == pytest.approx([everyone] * 10)


def test_members_are_numbered_without_gaps(spark):
    members = spark.createDataFrame([(DAY, "p", i) for i in range(500)] + [(DAY, "q", i) for i in range(3)], "cut_date date, profile string, entity int")
    for ranges in (16, 256):
        got = bt.numbered_members(members, ranges=ranges).collect()
        assert sorted(r["slot"] for r in got if r["profile"] == "p") == list(range(500))
        assert {(r["profile"], r["members"]) for r in got} == {("p", 500), ("q", 3)}


def test_evaluation_and_verdict(spark):
    cuts = RULES.cut_dates
    pools = spark.createDataFrame([(c, "p", f"e{i:02d}", 0.001 * i) for c in cuts for i in range(20)], "cut_date date, profile string, entity string, fee double")
    forward = spark.createDataFrame([(c, f"e{i:02d}", i / 100) for c in cuts for i in range(19)], "cut_date date, entity string, forward_return double")
    chosen = spark.createDataFrame([(cuts[0], "p", f"e{i:02d}") for i in range(15, 20)] + [(cuts[1], "p", f"e{i:02d}") for i in range(5)], "cut_date date, profile string, entity string")
    rates = spark.createDataFrame([(DAY + dt.timedelta(i), 0.001) for i in range(61)], "ts date, rate double")
    stopped = spark.createDataFrame([("e15",)], "entity string")
    found = materialise(bt.evaluate(chosen, pools, forward, bt.benchmark_returns(rates, RULES), stopped, RULES), "outcomes")
    first, second = found.orderBy("cut_date").collect()
    assert first["selected_return"] == pytest.approx((0.15 + 0.16 + 0.17 + 0.18) / 5)
    assert first["carried"] == ["e19"] and first["discontinued"] == ["e15"]
    assert first["peer_median_return"] == pytest.approx(0.09) and first["beat_median"] == 4
    assert first["benchmark_return"] == pytest.approx(1.001**50 - 1)
    assert first["random_percentile"] > 0.9 and first["cheap_percentile"] == 1.0
    assert second["random_percentile"] < 0.1 and second["beat_median"] == 0
    (row,) = bt.verdict(found, RULES).collect()
    assert (row["dates_passed"], row["dates_tested"], row["passed"], row["method_passed"]) == (1, 2, False, False)


def test_a_pool_without_a_selection_keeps_its_row(spark):
    cut = RULES.cut_dates[0]
    pools = spark.createDataFrame([(cut, p, f"e{i}", 0.01 * i) for p in "ab" for i in range(10)], "cut_date date, profile string, entity string, fee double")
    forward = spark.createDataFrame([(cut, f"e{i}", (i + 1) / 100) for i in range(10)], "cut_date date, entity string, forward_return double")
    chosen = spark.createDataFrame([(cut, "a", "e9")], "cut_date date, profile string, entity string")
    rates = spark.createDataFrame([(DAY, 0.001)], "ts date, rate double")
    stopped = spark.createDataFrame([], "entity string")
    got = {r["profile"]: r for r in bt.evaluate(chosen, pools, forward, bt.benchmark_returns(rates, RULES), stopped, RULES).collect()}
    assert got["a"]["selected"] == ["e9"] and got["a"]["beat_median"] == 1
    row = got["b"]
    assert (row["selected"], row["carried"], row["discontinued"]) == ([], [], [])
    assert (row["selected_return"], row["random_percentile"], row["beat_median"]) == (0.0, 0.0, 0)
    assert row["peer_median_return"] == pytest.approx(0.055)


def test_members_without_draws_stay_in_every_draw(spark):
    draws = spark.createDataFrame([("x", d, 0.1) for d in range(3)], "entity string, draw int, volatility double")
    pool = spark.createDataFrame([("p", e, "g", 2, 2) for e in ("x", "y")], "profile string, entity string, peer_group string, peer_size long, pool_size long")
    got = sorted((r["entity"], r["draw"], r["volatility"]) for r in rs.draws_of_pools(draws, pool, 3).collect())
    assert got == [("x", d, 0.1) for d in range(3)] + [("y", d, None) for d in range(3)]


def test_a_metric_the_pool_lacks_is_left_out_of_the_draws(spark):
    pool = spark.createDataFrame([("p", e, "g", 2, 2, pct) for e, pct in (("x", 0.0), ("y", 1.0))], "profile string, entity string, peer_group string, peer_size long, pool_size long, volatility_pct double")
    draws = spark.createDataFrame([(e, d, v) for d in range(2) for e, v in (("x", 0.1), ("y", 0.2))], "entity string, draw int, volatility double")
    weights = spark.createDataFrame([("p", "volatility", 0, 60, 0), ("p", "absent", 1, 40, 0)], "profile string, metric string, ord int, effective_weight int, jitter int")
    got = rs.scored_draws(pool, draws, weights, ["volatility", "absent"], {"volatility": "low", "absent": "high"}, Resampling(draws=2))
    assert {(r["entity"], r["draw"], r["score"], r["score_variable_only"]) for r in got.collect()} == {(e, d, s, t) for d in range(2) for e, s, t in (("x", 60.0, 100.0), ("y", 0.0, 0.0))}


def test_drawn_scores_equal_ranking_by_windows(spark):
    rng = random.Random(4)
    moving, metrics = list(rs.DRAWN_METRICS), ["size", *rs.DRAWN_METRICS]
    directions = {m: "low" if m in ("volatility", "size") else "high" for m in metrics}
    ids = range(23)
    group = {i: "(universo inteiro)" if i % 4 == 0 else f"g{i % 3}" for i in ids}
    size = {g: sum(x == g for x in group.values()) for g in group.values()}
    pool = spark.createDataFrame(
        [(p, i, group[i], len(ids) if i % 4 == 0 else size[group[i]], len(ids), rng.random(), 0.0) for p in ("p", "q") for i in ids],
        "profile string, entity int, peer_group string, peer_size long, pool_size long, size_pct double, volatility_pct double",
    )
    pool = pool.withColumns({f"{m}_pct": F.lit(0.5) for m in moving})
    drawn = [(i, d, *[None if rng.random() < 0.1 else rng.randrange(5) / 4 for _ in moving]) for i in ids if i != 7 for d in range(3)]
    draws = spark.createDataFrame(drawn, "entity int, draw int, " + ", ".join(f"{m} double" for m in moving))
    weights = weights_table(spark, [Profile("p", {"size": 40, "volatility": 60}), Profile("q", {m: 25 for m in moving})]).withColumnRenamed("weight", "effective_weight")
    settings = Resampling(draws=3)
    got = {(r["profile"], r["draw"], r["entity"]): (r["score"], r["score_variable_only"]) for r in rs.scored_draws(pool, draws, weights, metrics, directions, settings).collect()}

    rows = pe.metric_rows(rs.draws_of_pools(draws, pool, 3), moving, ["profile", "draw", "entity", "peer_group", "peer_size", "pool_size"])
    ranked = pe.percentile_rows(rows, moving, directions, ("profile", "draw")).collect()
    pct = {(r["profile"], r["draw"], r["entity"], r["metric"]): r["pct"] for r in ranked}
    pct |= {(r["profile"], d, r["entity"], "size"): r["size_pct"] for r in pool.collect() for d in range(3)}
    own = {"p": {"size": 40, "volatility": 60}, "q": {m: 25 for m in moving}}
    assert len(got) == 2 * 3 * len(ids)
    for (p, d, i), (every, only) in got.items():
        part = lambda m: 0.5 if pct[p, d, i, m] is None else pct[p, d, i, m]
        assert every == pytest.approx(sum(part(m) * w for m, w in own[p].items()), abs=1e-8)
        assert only == pytest.approx(part("volatility") * 100 if p == "p" else every, abs=1e-8)


@pytest.mark.parametrize("days, block", [(47, 6), (60, 21), (5, 21), (2, 1), (9, 3)])
@pytest.mark.parametrize("base", [True, False])
def test_chained_blocks_equal_the_days_themselves(days, block, base):
    rng = np.random.default_rng(days)
    rets, rates = rng.normal(0, 0.03, (6, days)), rng.normal(0, 0.001, (6, days))
    rets[3], rets[4, days // 2] = 0.01, -1.0
    codes, numbers = rng.integers(0, 1 << 60, 6), np.arange(40, dtype=np.int64)
    settings = Resampling(draws=40, block=block)
    excess, volatility, fall, ratio = rs._resampled(rets, rates, codes, numbers, settings, base)
    size = min(block, days)
    starts = rs._block_starts(settings.seed, numbers, codes, -(-days // size), days - size + 1)
    for e in (0, 1, 2, 3, 5):
        index = (starts[e][:, :, None] + np.arange(size)).reshape(40, -1)[:, :days]
        drawn = rets[e][index]
        path = np.cumprod(1 + drawn, axis=1)
        peak = np.maximum.accumulate(path, axis=1)
        assert excess[e] == pytest.approx(path[:, -1] - np.prod(1 + rates[e][index], axis=1), abs=1e-12)
        assert volatility[e] == pytest.approx(0 if e == 3 else np.std(drawn, axis=1, ddof=1) * 252**0.5, abs=1e-12)
        assert fall[e] == pytest.approx((path / (np.maximum(peak, 1) if base else peak) - 1).min(axis=1), abs=1e-12)
    assert np.isnan(ratio[3]).all()
    assert base is False or (fall[4][(starts[4] >= 0).any(axis=1)] >= -1).all()


def test_few_priced_members_keep_everyone(spark):
    rows = [(DAY, "p", i, None if i > 6 else float(i), 0.1) for i in range(12)] + [(DAY, "q", i, float(i), 0.1) for i in range(9)]
    members = spark.createDataFrame(rows, "cut_date date, profile string, entity int, fee double, forward_return double")
    got = bt.cheapest_quartile(members).collect()
    assert sum(r["profile"] == "p" for r in got) == 12
    assert sorted(r["entity"] for r in got if r["profile"] == "q") == [0, 1, 2]


@pytest.mark.parametrize("prefix", [3, 40])
def test_stability_equals_walking_every_scored_draw(spark, prefix):
    """Pools ranked from packed draws, in one round or several, come to the lists that all scored draws give."""
    rng = random.Random(8)
    histories, returns = [], []
    for base in range(10):
        rets = [rng.gauss(0.002 * base, 0.02) for _ in range(24 if base != 2 else 11)]
        for copy in range(3):
            entity = base * 10 + copy
            histories.append((entity, rets, [0.001] * len(rets)))
            returns += [("m" if base < 8 else f"m{copy}", entity, d, r) for d, r in enumerate(rets)]
    h = materialise(spark.createDataFrame(histories, "entity bigint, rets array<double>, rates array<double>"), "h")
    twins = tw.twin_classes(spark.createDataFrame(returns, "manager string, entity bigint, day_index int, ret double"), 0.35, 12)
    edges = {(r["a"], r["b"]) for r in twins.expanded.collect()}
    assert twins.pairs.count() and len(edges) > 30
    ids = [e for e, _, _ in histories] + [999]
    group = {e: f"g{e % 2}" for e in ids}
    pool = spark.createDataFrame(
        [(p, e, group[e], sum(g == group[e] for g in group.values()), len(ids), rng.random(), 0.0, 0.0) for p in ("p", "q") for e in ids],
        "profile string, entity bigint, peer_group string, peer_size long, pool_size long, size_pct double, volatility_pct double, return_per_risk_pct double",
    )
    pool = materialise(pool, "pool")
    metrics = ["size", "volatility", "return_per_risk"]
    directions = {"size": "high", "volatility": "low", "return_per_risk": "high"}
    profiles = [Profile("p", {"size": 10, "return_per_risk": 90}, {"size": 5}), Profile("q", {"volatility": 30, "return_per_risk": 70}, {"volatility": 9})]
    weights = weights_table(spark, profiles).withColumnRenamed("weight", "effective_weight")
    settings = Resampling(draws=23, block=5, seed=3)
    got = {(r["profile"], r["entity"]): r for r in rs.stability(pool, h, weights, metrics, directions, twins, settings, 3, prefix=prefix).collect()}
    scored = rs.scored_draws(pool, rs.resample_metrics(h, settings), weights, metrics, directions, settings).collect()
    want = {rate: dict.fromkeys(got, 0) for rate in rs.RATES}
    for rate, score in zip(rs.RATES, ("score", "score_variable_only")):
        for profile in ("p", "q"):
            for draw in range(23):
                order = sorted((-r[score], r["entity"]) for r in scored if (r["profile"], r["draw"]) == (profile, draw))
                chosen = []
                for _, e in order:
                    if len(chosen) < 3 and not any((min(e, c), max(e, c)) in edges for c in chosen):
                        chosen.append(e)
                for e in chosen:
                    want[rate][profile, e] += 1
    assert len(got) == 2 * len(ids)
    for rate in rs.RATES:
        assert {k: r[rate] for k, r in got.items()} == pytest.approx({k: n / 23 for k, n in want[rate].items()})


def test_drawn_histories_spread_over_the_tasks(spark):
    """A few small histories are many draws: they do not stay in the one or two tasks their bytes would fill."""
    h = spark.range(64).selectExpr("id AS entity", "transform(sequence(1, 30), i -> i * 0.01D + id) AS rets").coalesce(1)
    made = rs.block_bootstrap(materialise(h, "h"), Resampling(draws=500, block=6, seed=1))
    tasks = made.select(F.spark_partition_id().alias("task"), "entity", "draw").distinct().groupBy("task").count().collect()
    assert sum(r["count"] for r in tasks) == 64 * 500 and len(tasks) >= 6


def test_stability_measures_only_the_twins_it_meets(spark):
    """Twins of every pair are not formed for the few that lead a draw, in the first round or in later ones."""
    rng = random.Random(9)
    series = {e: [rng.gauss(0, 0.02) for _ in range(24)] for e in range(30)}
    h = materialise(spark.createDataFrame([(e, r, [0.0] * 24) for e, r in series.items()], "entity bigint, rets array<double>, rates array<double>"), "h")
    returns = spark.createDataFrame([("m", e, d, r) for e, rets in series.items() for d, r in enumerate(rets)], "manager string, entity bigint, day_index int, ret double")
    twins = tw.twin_classes(returns, 9.0, 12)
    pool = materialise(spark.createDataFrame([("p", e, "g", 30, 30, 0.0) for e in series], "profile string, entity bigint, peer_group string, peer_size long, pool_size long, volatility_pct double"), "pool")
    weights = weights_table(spark, [Profile("p", {"volatility": 100})]).withColumnRenamed("weight", "effective_weight")
    got = rs.stability(pool, h, weights, ["volatility"], {"volatility": "low"}, twins, Resampling(draws=12, block=5, seed=3), 3, prefix=4).collect()
    assert "pairs" not in vars(twins)
    # Everyone is everyone's twin: a draw lists its first entity alone.
    assert [sum(r[rate] for r in got) for rate in rs.RATES] == pytest.approx([1.0, 1.0])
