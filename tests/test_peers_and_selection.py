import random
import statistics

import pytest
from pyspark.sql import functions as F

from peervane.operators import peers as pe
from peervane.operators import selection as se
from peervane.operators import twins as tw
from peervane.operators.order_stats import (
    average_rank,
    quantiles,
    value_counts,
)
from peervane.params import (
    DIRECTIONS,
    PARITY_DIRECTIONS,
    Eligibility,
    Profile,
    Scoring,
    weights_table,
)
from peervane.session import materialise


def ranks_by_hand(values):
    known = sorted(v for v in values if v is not None)
    return {v: statistics.mean(i for i, x in enumerate(known, 1) if x == v) for v in known}


def test_ranks_and_quantiles_equal_sorting_by_hand(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else None if rng.random() < 0.1 else f"g{rng.randrange(5)}", i, 0.0 if rng.random() < 0.3 else (None if rng.random() < 0.1 else round(rng.gauss(0, 1), 2))) for i in range(900)]
    frame = materialise(spark.createDataFrame(rows, "g string, id int, v double"), "ranks")
    expected = {}
    for g in {r[0] for r in rows}:
        table = ranks_by_hand([r[2] for r in rows if r[0] == g])
        expected |= {r[1]: table.get(r[2]) for r in rows if r[0] == g}
    assert {r["id"]: r["rank"] for r in average_rank(frame, ["g"], "v", "rank").collect()} == pytest.approx(expected)
    exact = {r["g"]: r for r in frame.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99))).alias("q")).collect()}
    found = quantiles(value_counts(frame, ["g"], "v"), ["g"], "v", {"a": 0.01, "b": 0.5, "c": 0.99}).collect()
    assert len(found) == len(exact)
    for r in found:
        assert [r["a"], r["b"], r["c"]] == pytest.approx(exact[r["g"]]["q"])


def test_a_group_spans_many_ranges(spark):
    frame = materialise(spark.range(40_000).selectExpr("'hot' AS g", "CAST(id % 20000 AS double) AS v"), "hot")
    ranged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        counts = value_counts(frame, ["g"], "v")
        windows = counts._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", ranged)
    assert windows.count("Window [") == 3
    # Every window that orders values parts them by range as well.
    assert "[g#" in windows and all("_range" in line for line in windows.splitlines() if "Window [" in line and "sum(n#" in line)
    found = counts.agg(F.max("below"), F.min("total"), F.count(F.lit(1))).first()
    assert tuple(found) == (39_998, 40_000, 20_000)


def pool(spark, rows):
    return spark.createDataFrame(rows, "profile string, entity string, grp string, excess_return double, admin_fee double")


def percentiles(spark, rows, min_size, directions=DIRECTIONS):
    metrics = ["excess_return", "admin_fee"]
    grouped = pe.with_peer_groups(pool(spark, rows), "grp", min_size)
    long = pe.metric_rows(grouped, metrics, ["profile", "entity", "peer_group", "peer_size", "pool_size"])
    wide = pe.widened(pe.percentile_rows(long, metrics, directions), ["profile", "entity", "peer_group"], metrics, {"pct": "_pct", "pool_pct": "_pool_pct"})
    return {r["entity"]: r for r in wide.collect()}


ROWS = [("p", f"a{i}", "A", i / 10, 0.01 * i) for i in range(5)] + [("p", f"b{i}", "B", 1 + i / 10, None if i == 0 else 0.02) for i in range(4)]


def test_percentiles_within_group(spark):
    got = percentiles(spark, ROWS, 2)
    assert [got[f"a{i}"]["excess_return_pct"] for i in range(5)] == [0, 0.25, 0.5, 0.75, 1.0]
    assert [got[f"a{i}"]["admin_fee_pct"] for i in range(5)] == [1.0, 0.75, 0.5, 0.25, 0]
    assert got["b0"]["admin_fee_pct"] is None
    assert got["b1"]["admin_fee_pct"] == pytest.approx(1 / 3)  # three tied ranks of 2, over a size that counts the null
    assert got["a4"]["excess_return_pool_pct"] == pytest.approx(0.5)


def test_small_groups_are_ranked_in_the_whole_pool(spark):
    got = percentiles(spark, ROWS, 5)
    assert got["b3"]["peer_group"] == pe.WHOLE_POOL and got["b3"]["excess_return_pct"] == 1.0
    assert got["b0"]["excess_return_pct"] == pytest.approx(5 / 8)
    assert got["a4"]["excess_return_pct"] == 1.0


def test_group_of_one_is_neutral_and_direction_is_checked(spark):
    got = percentiles(spark, [("p", "x", "A", 1.0, 1.0)], 1)
    assert got["x"]["excess_return_pct"] == 0.5
    with pytest.raises(ValueError):
        percentiles(spark, ROWS, 2, {**DIRECTIONS, "admin_fee": "sideways"})
    assert PARITY_DIRECTIONS["max_drawdown"] == "low" and DIRECTIONS["max_drawdown"] == "high"


def test_effective_weights(spark):
    profile = Profile("p", {"a": 28, "b": 22, "c": 12, "d": 38})
    spread = spark.createDataFrame([("p", "a", 0.9), ("p", "b", 0.9), ("p", "c", 0.01), ("p", "d", 0.5)], "profile string, metric string, dispersion double")
    got = {r["metric"]: r for r in pe.effective_weights(weights_table(spark, [profile]), spread, 0.05).collect()}
    assert {m: r["effective_weight"] for m, r in got.items()} == {"a": 32, "b": 25, "c": 0, "d": 43}
    assert [m for m, r in got.items() if r["inert"]] == ["c"]
    nothing = pe.effective_weights(weights_table(spark, [profile]), spread.withColumn("dispersion", F.lit(0.0)), 0.05)
    assert {r["metric"]: r["effective_weight"] for r in nothing.collect()} == dict(profile.weights)
    with pytest.raises(ValueError):
        Profile("q", {"a": 99})


def test_winsorising_and_scores(spark):
    rows = [("p", f"e{i:03d}", "A", float(i), 0.01 * (i % 7)) for i in range(101)]
    stored = materialise(pool(spark, rows), "pool")
    profile = Profile("p", {"excess_return": 60, "admin_fee": 40})
    scored, weights = pe.score_profiles(stored, [profile], DIRECTIONS, Scoring(min_group=20))
    got = {r["entity"]: r for r in scored.collect()}
    assert sum(r["effective_weight"] for r in weights.collect()) == 100
    assert got["e000"]["excess_return_pct"] == got["e001"]["excess_return_pct"] == pytest.approx(0.005)
    assert all(0 <= r["score"] <= 100 and r["score"] == pytest.approx(r["pool_score"]) for r in got.values())


def test_eligibility_nulls(spark):
    funds = spark.createDataFrame([("a", "P", None, 1), ("b", "P", 10.0, None), ("c", "P", 9999.0, 1), ("d", "Q", 1.0, 1), ("e", None, 1.0, 1)], "entity string, target_investor string, minimum_investment double, redemption_days int")
    retail = Profile("r", {"x": 100}, eligibility=Eligibility(["P"], 5000.0, 1))
    anyone = Profile("z", {"x": 100})
    got = pe.profile_pools(funds, [retail, anyone]).collect()
    assert sorted(r["entity"] for r in got if r["profile"] == "r") == ["a"]
    assert len([r for r in got if r["profile"] == "z"]) == 5


def walk_by_hand(order, twins, n):
    chosen, passed = [], {}
    for c in order:
        if len(chosen) >= n:
            break
        hit = [(twins[frozenset((c, h))], i, h) for i, h in enumerate(chosen) if frozenset((c, h)) in twins]
        if hit:
            passed[c] = min(hit)[2]
        else:
            chosen.append(c)
    return chosen, passed


@pytest.mark.parametrize("seed,prefix", [(1, 64), (2, 4), (5, 4)])
def test_walks_match_the_spelled_out_rule(spark, seed, prefix):
    rng = random.Random(seed)
    ids = list(range(60))
    twins = {frozenset((a, b)): rng.random() for a in ids for b in ids if a < b and (rng.random() < 0.1 or (a < 30 and b < 30))}
    edges = spark.createDataFrame([(a, b, d) for k, d in twins.items() for a, b in (tuple(k), tuple(k)[::-1])], "entity int, twin int, distance double")
    rows = spark.createDataFrame([("g", i, i) for i in ids] + [("h", i, 60 - i) for i in ids[:7]], "grp string, entity int, place int")
    chosen = materialise(se.first_distinct(rows, ["grp"], "place", edges, 4, prefix), "chosen")
    passed = se.displaced(rows, ["grp"], "place", edges, chosen, 4).collect()
    for group, order in (("g", ids), ("h", ids[:7][::-1])):
        want, over = walk_by_hand(order, twins, 4)
        assert [r["entity"] for r in sorted(chosen.collect(), key=lambda r: r["pick"]) if r["grp"] == group] == want
        assert {r["entity"]: r["duplicate_of"] for r in passed if r["grp"] == group} == over


def test_gates_strike_and_the_list_is_a_prefix(spark):
    rows = [("p", i, i, None if i == 2 else 0.001 * i, 0.9 if i != 3 else 0.1) for i in range(20)]
    scored = spark.createDataFrame(rows, "profile string, entity int, place int, declared_fee double, excess_return_pct double").withColumn("measured_fee", F.lit(None).cast("double"))
    edges = spark.createDataFrame([(1, 0, 0.0001), (0, 1, 0.0001)], "entity int, twin int, distance double")
    gated = materialise(se.with_gates(scored, 0.0035, 0.0, 0.2), "gated")
    listed, over, struck = se.gated_selection(gated, ["profile"], "place", edges, 3, 6)
    got = sorted(listed.collect(), key=lambda r: r["pick"])
    assert [r["entity"] for r in got] == [0, 2]
    assert all(r["delivered"] for r in got)
    assert {r["entity"]: r["duplicate_of"] for r in over.collect()} == {1: 0}
    assert {r["entity"]: r["exclusion_reason"] for r in struck.collect()} == {3: "performance"}


@pytest.mark.parametrize("tile", [3, 128])
def test_twins_match_all_pairs(spark, tile):
    rng = random.Random(11)
    days, rows = 90, []
    market = [rng.gauss(0, 0.01) for _ in range(days)]
    for e in range(40):
        base = e // 2 if e < 20 else e
        own = random.Random(base)
        noise = random.Random(1000 + e)
        for d in range(days):
            r = market[d] * (0.5 + base / 20) + own.gauss(0, 0.002) + noise.gauss(0, 0.00003)
            if e % 7 != 3 or d not in (10, 11, 50):
                rows.append(("hot" if e < 30 else "cold", e, d, r))
    returns = spark.createDataFrame(rows, "manager string, entity int, day_index int, ret double")
    found = {(r["a"], r["b"]): (r["distance"], r["overlap"]) for r in tw.twin_pairs(returns, 0.002, 60, 252, tile).collect()}
    want = {(r["a"], r["b"]): (r["distance"], r["overlap"]) for r in tw.pair_distances(returns).filter("distance <= 0.002 AND overlap >= 60").collect()}
    assert set(found) == set(want) and len(want) == 10
    assert all(found[k] == pytest.approx(want[k]) for k in want)
    assert tw.both_directions(tw.twin_pairs(returns, 0.002, 60, 252, tile)).count() == 20


def test_twins_prune_tiles(spark):
    rows = [("m", e, d, 0.01 * ((-1) ** d) * (1 + e)) for e in range(300) for d in range(70)]
    returns = spark.createDataFrame(rows, "manager string, entity int, day_index int, ret double")
    vectors = tw._with_cells(tw._vectors(returns), 0.001, 252)
    cells = vectors.groupBy("manager", "stretch", "cell", "gaps").agg(F.lit(1).alias("tiles"))
    assert cells.filter("stretch = 0").count() == 300
    assert tw._tile_pairs(cells).count() <= 600


def test_twins_with_gaps_are_gridded_too(spark):
    rng = random.Random(5)
    late, rows = set(range(0, 60, 3)), []
    for e in range(60):
        own = random.Random(e // 2)
        for d in range(120):
            r = 0.01 * ((-1) ** d) * (1 + e // 2) + own.gauss(0, 0.001) + rng.gauss(0, 0.00002)
            absent = (e in late and d < 20) or (e % 10 == 4 and d % 29 == 3) or (e % 10 == 5 and d > 70)
            if not absent:
                rows.append(("m", e, d, r))
    returns = spark.createDataFrame(rows, "manager string, entity int, day_index int, ret double")
    want = {(r["a"], r["b"]) for r in tw.pair_distances(returns).filter("distance <= 0.002 AND overlap >= 30").collect()}
    found = [(r["a"], r["b"]) for r in tw.twin_pairs(returns, 0.002, 30, 252, 4).collect()]
    assert len(found) == len(set(found)) and set(found) == want and len(want) == 30
    cells = tw._with_cells(tw._vectors(returns), 0.002, 252)
    tiles = cells.groupBy("manager", "stretch", "cell", "gaps").agg(F.lit(1).alias("tiles"))
    assert tw._tile_pairs(tiles).filter("stretch > 0").count() < 400


def test_manager_share(spark):
    rows = [("p", m) for m in "aaaabbbccddefg"] + [("p", None)]
    got = se.manager_share(spark.createDataFrame(rows, "profile string, manager string")).collect()
    assert [(r["manager"], r["share"]) for r in sorted(got, key=lambda r: (-r["n"], r["manager"]))][:2] == [("a", 0.2667), ("b", 0.2)]
    assert len(got) <= 5


def test_metrics_a_profile_does_not_weigh_are_clipped_in_its_pool(spark):
    """Every percentile is of clipped values, also where the weight of the metric is another profile's."""
    profiles = [Profile("a", {"excess_return": 100}), Profile("b", {"volatility": 100})]
    rows = [(p.profile_id, f"{i:03}", "g", float(i), float(i)) for p in profiles for i in range(201)]
    pool = materialise(spark.createDataFrame(rows, "profile string, entity string, grp string, excess_return double, volatility double"), "pool")
    scored, _ = pe.score_profiles(pool, profiles, DIRECTIONS, Scoring(min_group=3))
    for profile in ("a", "b"):
        first = scored.filter((F.col("profile") == profile) & F.col("entity").isin("000", "001", "002", "003"))
        places = {r["entity"]: (r["excess_return_pct"], r["volatility_pool_pct"]) for r in first.collect()}
        assert len({places[e] for e in ("000", "001", "002")}) == 1
        assert places["003"][0] > places["002"][0] and places["003"][1] < places["002"][1]


def copied_returns(spark):
    """Twelve series, four of them alike by twos, each with five copies up to noise in the last place; one copy is too short."""
    rows = []
    for base in range(12):
        own = random.Random(base // 2 if base < 4 else base)
        rets = [own.gauss(0, 0.01) + base * 1e-5 * (d % 2) for d in range(40)]
        for copy in range(5):
            for d, r in enumerate(rets if (base, copy) != (7, 4) else rets[:10]):
                rows.append(("m", base + 12 * copy, d, r * (1 + 2e-16 * copy)))
    return materialise(spark.createDataFrame(rows, "manager string, entity int, day_index int, ret double"), "returns")


def test_copies_are_compared_once_and_lose_no_pair(spark):
    returns = copied_returns(spark)
    found = tw.twin_classes(returns, 0.001, 30)
    assert found.classes.select("class").distinct().count() == 12 and found.pairs.count() == 2
    got = {(r["a"], r["b"]): (r["distance"], r["overlap"]) for r in found.expanded.collect()}
    want = {(r["a"], r["b"]): (r["distance"], r["overlap"]) for r in tw.pair_distances(returns).filter("distance <= 0.001 AND overlap >= 30").collect()}
    assert set(got) == set(want) and len(want) == 2 * 45 + 7 * 10 + 6
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.mark.parametrize("prefix", [4, 64])
def test_a_walk_over_classes_is_the_walk_over_all_pairs(spark, prefix):
    returns = copied_returns(spark)
    found = tw.twin_classes(returns, 0.001, 30)
    edges = materialise(tw.both_directions(found.expanded), "edges")
    order = random.Random(4).sample(range(60), 60)
    rows = spark.createDataFrame([("g", e, i) for i, e in enumerate(order)] + [("h", e, -i) for i, e in enumerate(order[:9])], "grp string, entity int, place int")
    chosen = materialise(se.first_distinct(rows, ["grp"], "place", found.links, 8, prefix, found.classes), "chosen")
    plain = materialise(se.first_distinct(rows, ["grp"], "place", edges, 8), "plain")
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, plain.collect()))
    over = se.displaced(rows, ["grp"], "place", found.links, chosen, 6, found.classes)
    assert sorted(map(tuple, over.collect())) == sorted(map(tuple, se.displaced(rows, ["grp"], "place", edges, plain, 6).collect()))


def near_returns(spark, entities: int, days: int = 60):
    """One manager whose series move together, some with a gap; twins are common at 0.05 and no two are copies."""
    rows = []
    for e in range(entities):
        own = random.Random(e)
        rows += [("m" if e % 5 else "n", e, d, 0.01 * ((-1) ** d) + own.gauss(0, 0.003)) for d in range(days) if e % 11 != 3 or d % 17 != 5]
    return materialise(spark.createDataFrame(rows, "manager string, entity bigint, day_index int, ret double"), "returns")


def test_series_travel_once_for_many_others(spark, monkeypatch):
    """A crowded cell sends each of its series to few tasks, and no pair comes twice where a tile stays empty."""
    sent = []
    monkeypatch.setattr(tw, "_met", lambda rows, *rest, met=tw._met: sent.append(rows.count()) or met(rows, *rest))
    returns = near_returns(spark, 400)
    found = [(r["a"], r["b"], r["overlap"]) for r in tw.twin_pairs(returns, 0.0663, 40).collect()]
    want = {(r["a"], r["b"], r["overlap"]) for r in tw.pair_distances(returns).filter("distance <= 0.0663 AND overlap >= 40").collect()}
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 1000
    # A whole series meets its own cell and the next, and those with gaps in each of the parts.
    assert len(sent) == 1 and sent[0] <= 400 * 8
    few = returns.filter("entity < 12")
    assert tw.twin_pairs(few, 1.0, 40, tile=1).count() == tw.pair_distances(few).count() == 39


@pytest.mark.parametrize("prefix", [4, 64])
def test_a_walk_measures_only_the_twins_it_meets(spark, prefix):
    returns = near_returns(spark, 120)
    found = tw.twin_classes(returns, 0.07, 40, tile=16)
    order = random.Random(4).sample(range(120), 120)
    rows = spark.createDataFrame(
        [("g", e, i) for i, e in enumerate(order)] + [("h", e, -i) for i, e in enumerate(order)] + [("i", e, i) for i, e in enumerate(order[:9])] + [("i", 999, 4)],
        "grp string, entity bigint, place int",
    )
    chosen = materialise(se.first_distinct(rows, ["grp"], "place", found, 8, prefix), "chosen")
    over = se.displaced(rows, ["grp"], "place", found, chosen, 6).collect()
    assert "pairs" not in vars(found)
    edges = materialise(tw.both_directions(found.expanded), "edges")
    assert edges.count() > 1000
    plain = materialise(se.first_distinct(rows, ["grp"], "place", edges, 8), "plain")
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, plain.collect()))
    assert sorted(map(tuple, over)) == sorted(map(tuple, se.displaced(rows, ["grp"], "place", edges, plain, 6).collect()))


def test_gated_lists_measure_only_the_twins_they_meet(spark):
    returns = near_returns(spark, 60)
    found = tw.twin_classes(returns, 0.07, 40, tile=16)
    rng = random.Random(6)
    scored = spark.createDataFrame(
        [(p, e, i, None, rng.random()) for p in "pq" for i, e in enumerate(rng.sample(range(60), 60))],
        "profile string, entity bigint, place int, declared_fee double, excess_return_pct double",
    ).withColumn("measured_fee", F.lit(None).cast("double"))
    gated = materialise(se.with_gates(scored, 0.0035, 0.0, 0.4), "gated")
    got = [sorted(map(tuple, part.collect())) for part in se.gated_selection(gated, ["profile"], "place", found, 3, 6, 8)]
    assert "pairs" not in vars(found)
    edges = materialise(tw.both_directions(found.expanded), "edges")
    want = [sorted(map(tuple, part.collect())) for part in se.gated_selection(gated, ["profile"], "place", edges, 3, 6)]
    assert got == want and all(want)
