"""Block resampling, weight jitter, rank stability."""

from __future__ import annotations

from pyspark.sql import functions as F

from peervane.operators import resample as rs
from peervane.operators.peers import effective_weights, metric_dispersion
from peervane.params import DIRECTIONS, Resampling, metrics_of, weights_table
from peervane.session import materialise
from workload.base import (
    PANEL_SQL,
    PERIODS,
    PROFILES,
    RATES_SQL,
    SERIES_SQL,
    Tables,
    code_sql,
    columns_r6,
    hashed_sql,
    query,
    r6,
    with_clause,
)
from workload.peer_scores import (
    METRICS,
    SCORE_CTES,
    SCORING,
    TWIN_CTES,
    ranks_sql,
    scored_pools,
    stored_pools,
    twins,
    walk_sql,
)

SETTINGS = Resampling(draws=1000, block=6, seed=20250101, periods=PERIODS)

HISTORY_SQL = """history AS (SELECT entity, list(ret ORDER BY ts) AS rets, list(rate ORDER BY ts) AS rates, count(*) AS len FROM (
    SELECT entity, s.ts, price / lag(price) OVER (PARTITION BY entity ORDER BY s.ts) - 1 AS ret, coalesce(r.rate, 0) AS rate FROM series s LEFT JOIN rates r ON s.ts = r.ts)
  WHERE ret IS NOT NULL GROUP BY entity HAVING count(*) >= 2)"""
PATH_SQL = f"""blocks AS (SELECT entity, draw, len, least({SETTINGS.block}, len) AS size, unnest(range(CAST(ceil(len / least({SETTINGS.block}, len)::DOUBLE) AS BIGINT))) AS b, {code_sql('entity')} AS code
  FROM (SELECT entity, len, unnest(range({SETTINGS.draws})) AS draw FROM history)),
starts AS (SELECT entity, draw, len, size, b, CAST(floor(u * (len - size + 1)) AS BIGINT) AS start FROM {hashed_sql('blocks', SETTINGS.seed, 'draw', 'code', 'b')}),
places AS (SELECT *, unnest(range(size)) AS o FROM starts),
path AS (SELECT p.entity, p.draw, b * size + o AS j, rets[start + o + 1] AS ret, rates[start + o + 1] AS rate FROM places p JOIN history USING (entity) WHERE b * size + o < p.len),
grown AS (SELECT *, product(1 + ret) OVER (PARTITION BY entity, draw ORDER BY j ROWS UNBOUNDED PRECEDING) AS g FROM path),
peaks AS (SELECT *, greatest(1, max(g) OVER (PARTITION BY entity, draw ORDER BY j ROWS UNBOUNDED PRECEDING)) AS peak FROM grown),
draws AS (SELECT *, CASE WHEN volatility > 0 THEN excess_return / volatility END AS return_per_risk FROM (
  SELECT entity, draw, product(1 + ret) - product(1 + rate) AS excess_return, stddev_samp(ret) * sqrt({PERIODS}) AS volatility, min(g / peak - 1) AS max_drawdown FROM peaks GROUP BY 1, 2))"""
DRAW_CTES = (HISTORY_SQL, PATH_SQL)


def histories(t: Tables):
    return rs.aligned_returns(t.stored_series, t.rates)


def draws(t: Tables):
    return rs.resample_metrics(histories(t), SETTINGS)


@query(
    "res2_aligned_returns", "RES-2 JN-11",
    with_clause(PANEL_SQL, SERIES_SQL, RATES_SQL, HISTORY_SQL)
    + f"SELECT entity, place - 1 AS place, {r6('rets[place]', 'ret')}, {r6('rates[place]', 'rate')} FROM (SELECT *, unnest(range(1, len + 1)) AS place FROM history)",
)
def _(t: Tables):
    zipped = F.posexplode(F.arrays_zip("rets", "rates")).alias("place", "x")
    return histories(t).select("entity", zipped).select(
        "entity", "place", F.col("x.rets").alias("ret"), F.col("x.rates").alias("rate")
    )


@query(
    "res1_block_bootstrap", "RES-1",
    with_clause(PANEL_SQL, SERIES_SQL, RATES_SQL, *DRAW_CTES)
    + f"""SELECT entity, draw, count(*) AS days, {r6('arg_min(ret, j)', 'first_ret')}, {r6('arg_max(ret, j)', 'last_ret')}, {r6('sum((j + 1) * ret)', 'placed_sum')}
      FROM path GROUP BY 1, 2""",
)
def _(t: Tables):
    """Every drawn history in one row: its days, its ends, and a sum in which each day counts by its place."""
    placed = F.aggregate(
        F.transform("rets", lambda ret, j: ret * (j + 1)), F.lit(0.0), lambda total, x: total + x
    )
    return rs.block_bootstrap(histories(t), SETTINGS).select(
        "entity", "draw", F.size("rets").alias("days"), F.element_at("rets", 1).alias("first_ret"),
        F.element_at("rets", -1).alias("last_ret"), placed.alias("placed_sum"),
    )


@query(
    "res3_resampled_metrics", "RES-3 WIN-10",
    with_clause(PANEL_SQL, SERIES_SQL, RATES_SQL, *DRAW_CTES)
    + f"SELECT entity, draw, {columns_r6('excess_return', 'volatility', 'max_drawdown', 'return_per_risk')} FROM draws",
)
def _(t: Tables):
    return draws(t)


MANY = Resampling(draws=1000, block=6, seed=20250101, periods=PERIODS)
MANY_SQL = PATH_SQL.replace(f"range({SETTINGS.draws})", f"range({MANY.draws})")


@query(
    "res3_thousand_draws", "RES-3",
    with_clause(PANEL_SQL, SERIES_SQL, RATES_SQL, HISTORY_SQL, MANY_SQL)
    + f"""SELECT entity, count(*) AS draws, {r6('avg(excess_return)', 'mean_excess')}, {r6('avg(volatility)', 'mean_volatility')},
      {r6('min(max_drawdown)', 'worst_drawdown')}, {r6('avg(return_per_risk)', 'mean_ratio')} FROM draws GROUP BY 1""",
)
def _(t: Tables):
    """The delivered number of draws, summed up per supplier."""
    drawn = rs.resample_metrics(histories(t), MANY)
    return drawn.groupBy("entity").agg(
        F.count(F.lit(1)).alias("draws"), F.avg("excess_return").alias("mean_excess"), F.avg("volatility").alias("mean_volatility"),
        F.min("max_drawdown").alias("worst_drawdown"), F.avg("return_per_risk").alias("mean_ratio"),
    )


def jittered_sql(name: str, source: str, value: str, where: str = "true") -> str:
    return f"""{name} AS (WITH spread AS (SELECT *, unnest(range({SETTINGS.draws})) AS draw, {code_sql('profile')} AS code FROM {source} WHERE {where}),
    moved AS (SELECT *, greatest(0, {value} + (u * 2 - 1) * jitter) AS m FROM {hashed_sql('spread', SETTINGS.seed, 'draw', 'code', 'ord')}),
    shares AS (SELECT *, sum(m) OVER (PARTITION BY profile, draw) AS total, sum({value}) OVER (PARTITION BY profile, draw) AS declared_total FROM moved),
    whole AS (SELECT *, round_even(CASE WHEN total > 0 THEN m * 100 / total ELSE {value} * 100 / declared_total END, 0) AS r FROM shares)
    SELECT profile, draw, metric, ord, CAST(r + CASE WHEN row_number() OVER (PARTITION BY profile, draw ORDER BY r DESC, ord) = 1
      THEN 100 - sum(r) OVER (PARTITION BY profile, draw) ELSE 0 END AS BIGINT) AS drawn_weight FROM whole)"""


@query(
    "res4_jittered_weights", "RES-4",
    with_clause(*SCORE_CTES, jittered_sql("jittered", "weights", "effective_weight", "effective_weight > 0"))
    + "SELECT profile, draw, metric, ord::BIGINT AS ord, drawn_weight FROM jittered",
)
def _(t: Tables):
    spread = metric_dispersion(stored_pools(t), METRICS)
    weights = effective_weights(weights_table(t.spark, PROFILES), spread, SCORING.min_dispersion)
    return rs.jitter_weights(weights.filter("effective_weight > 0"), SETTINGS, "effective_weight")


MOVING = rs.DRAWN_METRICS
LOW = ", ".join(f"'{m}'" for m in MOVING if DIRECTIONS[m] == "low")
MOVED_SQL = "moved_long AS (" + " UNION ALL ".join(
    f"SELECT g.profile, d.draw, d.entity, '{m}' AS metric, {'-' if DIRECTIONS[m] == 'low' else ''}d.{m} AS v, g.peer_group, g.peer_size, g.pool_size FROM draws d JOIN grouped g USING (entity)"
    for m in MOVING
) + ")"
RANKED_SQL = f"""ranked AS (SELECT profile, draw, entity, metric, pct FROM draw_ranks WHERE (profile, metric) IN (SELECT (profile, metric) FROM weights WHERE effective_weight > 0)
  UNION ALL SELECT r.profile, d.draw, r.entity, r.metric, r.pct FROM ranks r, (SELECT unnest(range({SETTINGS.draws})) AS draw) d
  WHERE r.metric NOT IN ({', '.join(f"'{m}'" for m in MOVING)}))"""


def draw_scores_sql(name: str, weights: str) -> str:
    return f"""{name} AS (SELECT r.profile, r.draw, r.entity, round(sum(coalesce(pct, 0.5) * drawn_weight), 9) AS score
      FROM ranked r JOIN {weights} w ON w.profile = r.profile AND w.draw = r.draw AND w.metric = r.metric GROUP BY 1, 2, 3)"""


def rate_sql(name: str, picks: str) -> str:
    return f"""{name} AS (SELECT g.profile, g.entity, coalesce(n, 0) / {float(SETTINGS.draws)}::DOUBLE AS rate FROM grouped g
      LEFT JOIN (SELECT profile, entity, count(*) AS n FROM {picks} GROUP BY 1, 2) USING (profile, entity))"""


STABILITY_CTES = (
    *SCORE_CTES, *DRAW_CTES, *TWIN_CTES, MOVED_SQL, ranks_sql("draw_ranks", "moved_long", "profile, draw"), RANKED_SQL,
    jittered_sql("j_all", "weights", "effective_weight", "effective_weight > 0"),
    jittered_sql("j_moving", "weights", "effective_weight", f"effective_weight > 0 AND metric IN ({', '.join(repr(m) for m in MOVING)})"),
    draw_scores_sql("s_all", "j_all"), draw_scores_sql("s_moving", "j_moving"),
    walk_sql("p_all", "s_all", 5, "profile, draw"), walk_sql("p_moving", "s_moving", 5, "profile, draw"),
    rate_sql("r_all", "p_all"), rate_sql("r_moving", "p_moving"),
)


@query(
    "jn17_draws_of_pools", "JN-17",
    with_clause(*SCORE_CTES, *DRAW_CTES) + f"SELECT g.profile, d.entity, d.draw, g.peer_group, {r6('d.volatility', 'volatility')} FROM draws d JOIN grouped g USING (entity)",
)
def _(t: Tables):
    scored, _ = scored_pools(t)
    return rs.draws_of_pools(draws(t), scored, SETTINGS.draws).select("profile", "entity", "draw", "peer_group", "volatility")


@query(
    "res5_rank_stability", "RES-5 AGG-25 JN-14 JN-17",
    with_clause(*STABILITY_CTES) + f"SELECT a.profile, a.entity, {r6('a.rate', 'appearance_rate')}, {r6('m.rate', 'appearance_rate_variable_only')} FROM r_all a JOIN r_moving m USING (profile, entity)",
)
def _(t: Tables):
    scored, weights = scored_pools(t)
    scored = materialise(scored, "scored")
    stored = materialise(histories(t), "histories")
    return rs.stability(scored, stored, weights, metrics_of(PROFILES), DIRECTIONS, twins(t), SETTINGS)
