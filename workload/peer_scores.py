"""Peer-relative scores, twins and the walk down the order."""

from __future__ import annotations

from pyspark.sql import functions as F

from peervane.operators import peers as pe
from peervane.operators import selection as se
from peervane.operators import twins as tw
from peervane.params import DIRECTIONS, Scoring, metrics_of, weights_table
from peervane.session import materialise
from workload.base import (
    FUND_CTES,
    PANEL_SQL,
    PERIODS,
    PROFILES,
    REGISTRY_SQL,
    SERIES_SQL,
    Tables,
    columns_r6,
    pools_sql,
    query,
    r6,
    weights_sql,
    with_clause,
)

METRICS = metrics_of(PROFILES)
SCORING = Scoring(min_group=3)
THRESHOLD, OVERLAP = 2.2, 24


def stored_pools(t: Tables):
    return materialise(pe.profile_pools(t.funds, PROFILES), "pools")


def scored_pools(t: Tables):
    scored, weights = pe.score_profiles(stored_pools(t), PROFILES, DIRECTIONS, SCORING)
    rounded = {c: F.round(c, 9) for c in ("score", "pool_score")}
    return scored.withColumns(rounded), weights


LONG_SQL = "long AS (" + " UNION ALL ".join(
    f"SELECT profile, entity, grp, '{m}' AS metric, {m}::DOUBLE AS value FROM pools" for m in METRICS
) + ")"
WEIGHTS_SQL = """spread AS (SELECT profile, metric, 1 - max(n) / sum(n)::DOUBLE AS dispersion FROM (
    SELECT profile, metric, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL) GROUP BY 1, 2),
live AS (SELECT d.*, coalesce(dispersion, 0) AS dispersion, coalesce(dispersion >= 0.05, false) AS live FROM declared d LEFT JOIN spread USING (profile, metric)),
scaled AS (SELECT *, sum(CASE WHEN live THEN weight END) OVER (PARTITION BY profile) AS live_total, count(*) FILTER (WHERE NOT live) OVER (PARTITION BY profile) AS dead FROM live),
rounded AS (SELECT *, CASE WHEN dead = 0 OR live_total IS NULL THEN weight WHEN live THEN round_even(weight * 100 / live_total::DOUBLE, 0) ELSE 0 END AS r FROM scaled),
weights AS (SELECT profile, metric, ord, weight, jitter, dispersion, CAST(r + CASE WHEN dead > 0 AND live_total IS NOT NULL AND row_number() OVER (PARTITION BY profile ORDER BY r DESC, ord) = 1
    THEN 100 - sum(r) OVER (PARTITION BY profile) ELSE 0 END AS BIGINT) AS effective_weight, NOT live AND dead > 0 AND live_total IS NOT NULL AS inert FROM rounded)"""
BOUNDS_SQL = "bounds AS (SELECT profile, metric, quantile_cont(value, 0.01) AS low, quantile_cont(value, 0.99) AS high FROM long GROUP BY 1, 2)"
GROUPED_SQL = """grouped AS (SELECT profile, entity, CASE WHEN n >= 3 THEN grp ELSE '(universo inteiro)' END AS peer_group, CASE WHEN n >= 3 THEN n ELSE total END AS peer_size, total AS pool_size FROM (
    SELECT profile, entity, grp, count(*) OVER (PARTITION BY profile, grp) AS n, count(*) OVER (PARTITION BY profile) AS total FROM pools))"""
LOW_METRICS = ", ".join(f"'{m}'" for m in METRICS if DIRECTIONS[m] == "low")


def ranks_sql(name: str, source: str, by: str = "profile") -> str:
    """Percentiles of (by, entity, metric, peer_group, peer_size, pool_size, v), `v` signed so that high is good."""

    def average(keys: str) -> str:
        return f"rank() OVER (PARTITION BY {keys}, v IS NULL ORDER BY v) + (count(*) OVER (PARTITION BY {keys}, v) - 1) / 2.0::DOUBLE"

    return f"""{name} AS (SELECT * EXCLUDE (rg, rp), CASE WHEN pool_size > 1 THEN CASE WHEN v IS NOT NULL THEN (rp - 1) / (pool_size - 1) END ELSE 0.5 END AS pool_pct,
    CASE WHEN peer_group = '(universo inteiro)' THEN CASE WHEN pool_size > 1 THEN CASE WHEN v IS NOT NULL THEN (rp - 1) / (pool_size - 1) END ELSE 0.5 END
      WHEN peer_size > 1 THEN CASE WHEN v IS NOT NULL THEN (rg - 1) / (peer_size - 1) END ELSE 0.5 END AS pct
    FROM (SELECT *, {average(f'{by}, metric, peer_group')} AS rg, {average(f'{by}, metric')} AS rp FROM {source}))"""


CLIPPED_SQL = f"""clipped AS (SELECT l.profile, l.entity, l.metric, CASE WHEN l.metric IN ({LOW_METRICS}) THEN -1 ELSE 1 END * CASE WHEN value IS NOT NULL THEN greatest(low, least(high, value)) END AS v,
  peer_group, peer_size, pool_size FROM long l JOIN bounds USING (profile, metric) JOIN grouped g ON g.profile = l.profile AND g.entity = l.entity)"""
SCORES_SQL = """scores AS (SELECT r.profile, r.entity, any_value(peer_group) AS peer_group, any_value(peer_size) AS peer_size, any_value(pool_size) AS pool_size,
  round(sum(coalesce(pct, 0.5) * effective_weight), 9) AS score, round(sum(coalesce(pool_pct, 0.5) * effective_weight), 9) AS pool_score FROM ranks r JOIN weights USING (profile, metric) GROUP BY 1, 2)"""
POOL_CTES = (*FUND_CTES, pools_sql(), LONG_SQL, weights_sql(), WEIGHTS_SQL)
SCORE_CTES = (*POOL_CTES, BOUNDS_SQL, GROUPED_SQL, CLIPPED_SQL, ranks_sql("ranks", "clipped"), SCORES_SQL)


@query(
    "sco2_winsorised_metrics", "SCO-2 AGG-8",
    with_clause(*SCORE_CTES) + "SELECT profile, entity, " + ", ".join(
        r6(f"max(CASE WHEN metric = '{m}' THEN v * CASE WHEN metric IN ({LOW_METRICS}) THEN -1 ELSE 1 END END)", m) for m in METRICS
    ) + " FROM clipped GROUP BY 1, 2",
)
def _(t: Tables):
    pools = stored_pools(t)
    bounds = pe.clip_bounds(pe.metric_counts(pools, METRICS), 0.01, 0.99)
    return pe.winsorised(pools, bounds, METRICS).select("profile", "entity", *METRICS)


@query(
    "sco3_peer_percentiles", "SCO-3 SCO-6 WIN-6 WIN-7",
    with_clause(*SCORE_CTES) + "SELECT profile, entity, peer_group, " + ", ".join(
        r6(f"max(CASE WHEN metric = '{m}' THEN pct END)", f"{m}_pct") for m in METRICS
    ) + ", " + ", ".join(r6(f"max(CASE WHEN metric = '{m}' THEN pool_pct END)", f"{m}_pool_pct") for m in METRICS)
    + " FROM ranks GROUP BY 1, 2, 3",
)
def _(t: Tables):
    scored, _ = scored_pools(t)
    return scored.select("profile", "entity", "peer_group", *[f"{m}{s}" for m in METRICS for s in ("_pct", "_pool_pct")])


@query(
    "sco4_effective_weights", "SCO-4 AGG-7 SET-4",
    with_clause(*POOL_CTES) + f"SELECT profile, metric, ord::BIGINT AS ord, weight::BIGINT AS weight, jitter::BIGINT AS jitter, {r6('dispersion', 'dispersion')}, effective_weight, inert FROM weights",
)
def _(t: Tables):
    spread = pe.metric_dispersion(stored_pools(t), METRICS)
    return pe.effective_weights(weights_table(t.spark, PROFILES), spread, SCORING.min_dispersion)


@query(
    "set4_inert_metrics", "SET-4",
    with_clause(*POOL_CTES) + "SELECT profile, metric FROM weights WHERE inert",
)
def _(t: Tables):
    declared = weights_table(t.spark, PROFILES)
    spread = pe.metric_dispersion(stored_pools(t), METRICS)
    return pe.inert_metrics(declared, spread.filter(F.col("dispersion") >= SCORING.min_dispersion))


@query(
    "sco5_total_scores", "SCO-5 SCO-6",
    with_clause(*SCORE_CTES) + f"SELECT profile, entity, peer_group, peer_size, pool_size, {columns_r6('score', 'pool_score')} FROM scores",
)
def _(t: Tables):
    scored, _ = scored_pools(t)
    return scored.select("profile", "entity", "peer_group", "peer_size", "pool_size", "score", "pool_score")


@query(
    "ord4_top_five_per_profile", "ORD-4 ORD-2 SCO-5 WIN-9",
    with_clause(*SCORE_CTES) + f"""SELECT profile, entity, name, manager, peer_group, {columns_r6('score', 'pool_score')}, position FROM (
      SELECT s.*, r.name, r.manager, row_number() OVER (PARTITION BY profile ORDER BY score DESC, entity) AS position FROM scores s JOIN registry r USING (entity)) WHERE position <= 5""",
)
def _(t: Tables):
    scored, _ = scored_pools(t)
    top = se.top_per_group(scored, ["profile"], [F.desc("score"), F.col("entity")], 5)
    return top.select("profile", "entity", "name", "manager", "peer_group", "score", "pool_score", "position")


# --- twins ---------------------------------------------------------------

RETURNS_SQL = """calendar AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS day_index FROM (SELECT DISTINCT ts FROM series)),
returns AS (SELECT manager, entity, day_index, ret FROM (
  SELECT r.manager, s.entity, day_index, CASE WHEN lag(day_index) OVER w = day_index - 1 THEN price / lag(price) OVER w - 1 END AS ret
  FROM series s JOIN registry r USING (entity) JOIN calendar USING (ts) WINDOW w AS (PARTITION BY s.entity ORDER BY day_index)) WHERE ret IS NOT NULL)"""
PAIRS_SQL = f"""pairs AS (SELECT a.entity AS a, b.entity AS b, stddev_pop(a.ret - b.ret) * sqrt({PERIODS}) AS distance, count(*) AS overlap
  FROM returns a JOIN returns b ON a.manager = b.manager AND a.day_index = b.day_index AND a.entity < b.entity GROUP BY 1, 2)"""
TWINS_SQL = f"""twins AS (SELECT * FROM pairs WHERE distance <= {THRESHOLD} AND overlap >= {OVERLAP})"""
EDGES_SQL = "edges AS (SELECT a AS entity, b AS twin, distance FROM twins UNION ALL SELECT b, a, distance FROM twins)"
TWIN_CTES = (RETURNS_SQL, PAIRS_SQL, TWINS_SQL, EDGES_SQL)


def twin_returns(t: Tables):
    return tw.pool_returns(t.stored_series, t.registry.select("entity", "manager"))


def twins(t: Tables) -> tw.Twins:
    return tw.twin_classes(twin_returns(t), THRESHOLD, OVERLAP, PERIODS)


@query(
    "sco7_twin_pairs", "SCO-7 JN-12 AGG-9 WIN-2",
    with_clause(PANEL_SQL, SERIES_SQL, REGISTRY_SQL, RETURNS_SQL, PAIRS_SQL, TWINS_SQL) + f"SELECT a, b, {r6('distance', 'distance')}, overlap FROM twins",
)
def _(t: Tables):
    return tw.twin_pairs(twin_returns(t), THRESHOLD, OVERLAP, PERIODS)


# --- selection -----------------------------------------------------------

GATE = {"max_cost": 0.0101, "trusted_above": 0.0005, "floor": 0.2}
TOP_N, SIZE = 5, 10


def gated_pools(t: Tables):
    scored, _ = scored_pools(t)
    priced = scored.withColumns({"declared_fee": F.col("fee"), "measured_fee": F.lit(None).cast("double")})
    gated = se.with_gates(priced, GATE["max_cost"], GATE["trusted_above"], GATE["floor"])
    key = F.struct((-F.col("score")).alias("s"), F.col("entity").alias("e"))
    return materialise(gated.withColumn("ord_key", key), "gated")


GATED_SQL = f"""gated AS (SELECT s.*, p.fee, x.pct AS excess_pct, coalesce(fee > {GATE['max_cost']}, false) AS cost_gated, coalesce(x.pct < {GATE['floor']}, false) AS below_floor
  FROM scores s JOIN pools p USING (profile, entity) JOIN (SELECT profile, entity, pct FROM ranks WHERE metric = 'excess_return') x USING (profile, entity))"""


def walk_sql(name: str, source: str, n: int, groups: str = "profile", order: str = "score DESC, entity") -> str:
    """(groups, pick, entity): a fold over each ordered list."""
    return f"""{name} AS (SELECT {groups}, unnest(range(1, len(chosen) + 1)) AS pick, unnest(chosen) AS entity FROM (
    SELECT {groups}, list_reduce(list({{'id': entity, 'twins': tw, 'chosen': []::BIGINT[]}} ORDER BY {order}), lambda acc, x: {{'id': x.id, 'twins': x.twins,
      'chosen': CASE WHEN len(acc.chosen) < {n} AND NOT list_has_any(acc.chosen, x.twins) THEN list_append(acc.chosen, x.id) ELSE acc.chosen END}},
      {{'id': NULL::BIGINT, 'twins': []::BIGINT[], 'chosen': []::BIGINT[]}}).chosen AS chosen
    FROM (SELECT s.*, coalesce(e.tw, []::BIGINT[]) AS tw FROM {source} s LEFT JOIN (SELECT entity, list(twin) AS tw FROM edges GROUP BY 1) e USING (entity)) GROUP BY {groups}))"""


def displaced_sql(name: str, source: str, picks: str, n: int) -> str:
    return f"""{name} AS (WITH placed AS (SELECT c.*, s.score FROM {picks} c JOIN {source} s USING (profile, entity) WHERE pick <= {n}),
    ends AS (SELECT profile, count(*) AS filled, arg_max(score, pick) AS last_score, arg_max(entity, pick) AS last_entity FROM placed GROUP BY 1),
    hit AS (SELECT s.profile, s.entity, p.entity AS duplicate_of, e.distance FROM placed p JOIN edges e ON e.twin = p.entity JOIN {source} s ON s.entity = e.entity AND s.profile = p.profile
      JOIN ends d ON d.profile = s.profile WHERE (p.score > s.score OR p.score = s.score AND p.entity < s.entity)
      AND (filled < {n} OR s.score > last_score OR s.score = last_score AND s.entity < last_entity))
    SELECT profile, entity, arg_min(duplicate_of, distance) AS duplicate_of, round_even(min(distance), 6) AS tracking_difference FROM hit GROUP BY 1, 2)"""


SELECTION_CTES = (
    *SCORE_CTES, *TWIN_CTES, GATED_SQL,
    "kept AS (SELECT * FROM gated WHERE NOT cost_gated AND NOT below_floor)",
    walk_sql("listed", "kept", SIZE), walk_sql("ungated", "gated", TOP_N),
    displaced_sql("displaced", "kept", "listed", TOP_N),
)


@query(
    "sco8_distinct_selection", "SCO-8",
    with_clause(*SCORE_CTES, *TWIN_CTES, walk_sql("picked", "scores", SIZE)) + "SELECT profile, pick, entity FROM picked",
)
def _(t: Tables):
    scored, _ = scored_pools(t)
    rows = materialise(
        scored.select("profile", "entity", F.struct((-F.col("score")).alias("s"), F.col("entity").alias("e")).alias("ord_key")), "rows"
    )
    return se.first_distinct(rows, ["profile"], "ord_key", twins(t), SIZE)


@query(
    "sco8_displaced", "SCO-8 PRJ-8",
    with_clause(*SELECTION_CTES) + f"SELECT profile, entity, duplicate_of, {r6('tracking_difference', 'tracking_difference')} FROM displaced",
)
def _(t: Tables):
    gated = gated_pools(t)
    return se.gated_selection(gated, ["profile"], "ord_key", twins(t), TOP_N, SIZE)[1]


@query(
    "sco9_gated_selection", "SCO-9 SNK-5 WIN-9",
    with_clause(*SELECTION_CTES) + f"SELECT profile, pick, entity, pick <= {TOP_N} AS delivered FROM listed",
)
def _(t: Tables):
    gated = gated_pools(t)
    return se.gated_selection(gated, ["profile"], "ord_key", twins(t), TOP_N, SIZE)[0]


@query(
    "sco14_struck_entities", "SCO-14 SCO-9 FLT-14",
    with_clause(*SELECTION_CTES) + f"""SELECT profile, entity, {r6('fee', 'gate_cost')}, {r6('excess_pct', 'excess_return_pct')}, CASE WHEN cost_gated THEN 'cost' ELSE 'performance' END AS exclusion_reason
      FROM ungated JOIN gated USING (profile, entity) WHERE cost_gated OR below_floor""",
)
def _(t: Tables):
    gated = gated_pools(t)
    struck = se.gated_selection(gated, ["profile"], "ord_key", twins(t), TOP_N, SIZE)[2]
    return struck.select("profile", "entity", "gate_cost", "excess_return_pct", "exclusion_reason")
