"""Forward returns, random portfolios, the verdict, and whole rankings."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from peervane.functions.dates import window_start_date
from peervane.operators import backtest as bt
from peervane.params import Backtest, Resampling, Scoring, Selection, metrics_of
from peervane.plans.ranking import Inputs, Settings, rank
from peervane.plans.replay import replay
from peervane.session import materialise
from peervane.sources.documents import comparison_list, ranking_document
from workload.base import (
    BENCHMARK_SQL,
    FUND_CTES,
    HOLDINGS_SQL,
    METRICS_SQL,
    MONTHS,
    PANEL_SQL,
    PERIODS,
    PROFILES,
    RATES_SQL,
    REFERENCE,
    REGISTRY_SQL,
    SERIES_SQL,
    START,
    TERMS_SQL,
    Tables,
    columns_r6,
    filings_sql,
    hashed_sql,
    pools_sql,
    query,
    r6,
    with_clause,
)
from workload.joins import FILTERS, LINKS_SQL, MEASURED_SQL
from workload.peer_scores import SCORE_CTES, TWIN_CTES, walk_sql
from workload.resampling import DRAW_CTES, STABILITY_CTES

RULES = Backtest(
    cut_dates=(dt.date(1998, 12, 31), dt.date(1999, 6, 30), dt.date(1999, 12, 31)), end_date=REFERENCE, portfolios=1000
)
CUTS_SQL = "cuts (cut_date) AS (VALUES " + ", ".join(f"(DATE '{c}')" for c in RULES.cut_dates) + ")"
FORWARD_SQL = f"""forward AS (SELECT cut_date, entity, arg_max(price, ts) / arg_min(price, ts) - 1 AS forward_return FROM panel, cuts
  WHERE ts > cut_date AND ts <= DATE '{REFERENCE}' GROUP BY 1, 2 HAVING count(*) >= 2 AND min(price) > 0)"""
BENCH_SQL = f"""bench_after AS (SELECT cut_date, coalesce(product(1 + rate) FILTER (WHERE ts > cut_date), 1) - 1 AS benchmark_return FROM cuts, rates WHERE ts <= DATE '{REFERENCE}' GROUP BY 1)"""


@query(
    "bt1_forward_returns", "BT-1 FLT-10 FLT-13",
    with_clause(PANEL_SQL, CUTS_SQL, FORWARD_SQL) + f"SELECT cut_date, entity, {r6('forward_return', 'forward_return')} FROM forward",
)
def _(t: Tables):
    return bt.forward_returns(t.panel, RULES)


@query(
    "bt2_benchmark_returns", "BT-2 AGG-10",
    with_clause(RATES_SQL, CUTS_SQL, BENCH_SQL) + f"SELECT cut_date, {r6('benchmark_return', 'benchmark_return')} FROM bench_after",
)
def _(t: Tables):
    return bt.benchmark_returns(t.rates, RULES)


# A selection to be judged: the suppliers of each region that were cheapest before the cut.
POOLS_SQL = f"""bt_pools AS (SELECT cut_date, target_investor AS profile, r.entity, t.fee FROM registry r JOIN terms t USING (entity), cuts WHERE classification LIKE 'Renda Fixa%')"""
SELECTED_SQL = """selected AS (SELECT cut_date, profile, entity FROM bt_pools QUALIFY row_number() OVER (PARTITION BY cut_date, profile ORDER BY fee, entity) <= 5)"""
REALISED_SQL = "realised AS (SELECT p.*, f.forward_return FROM bt_pools p JOIN forward f USING (cut_date, entity))"


def numbered_sql(name: str, source: str) -> str:
    return f"""{name} AS (SELECT cut_date, profile, entity, forward_return, row_number() OVER (PARTITION BY cut_date, profile ORDER BY md5(entity::VARCHAR), entity) - 1 AS slot,
      count(*) OVER (PARTITION BY cut_date, profile) AS members FROM {source})"""


def portfolios_sql(name: str, numbered: str, size: str = "sizes") -> str:
    """Floyd's subset sampling, unrolled over the at most five places."""
    base = f"""(SELECT n.cut_date, n.profile, n.members, least(z.size, n.members) AS take, unnest(range({RULES.portfolios})) AS draw
      FROM (SELECT DISTINCT cut_date, profile, members FROM {numbered}) n JOIN {size} z USING (cut_date, profile))"""
    stages, previous = [], f"{name}_0"
    stages.append(f"{previous} AS (SELECT *, []::BIGINT[] AS chosen FROM {base})")
    for k in range(5):
        hashed = hashed_sql(previous, RULES.seed, "draw", "0", f"(members - take + {k})")
        here = f"{name}_{k + 1}"
        j = f"(members - take + {k})"
        pick = f"CAST(floor(u * ({j} + 1)) AS BIGINT)"
        stages.append(
            f"""{here} AS (SELECT * EXCLUDE (u, chosen), CASE WHEN {k} >= take THEN chosen WHEN list_contains(chosen, {pick}) THEN list_append(chosen, {j})
              ELSE list_append(chosen, {pick}) END AS chosen FROM {hashed})"""
        )
        previous = here
    stages.append(
        f"""{name} AS (SELECT d.cut_date, d.profile, d.draw, avg(n.forward_return) AS portfolio_return FROM (SELECT cut_date, profile, draw, unnest(chosen) AS slot FROM {previous}) d
          JOIN {numbered} n USING (cut_date, profile, slot) GROUP BY 1, 2, 3)"""
    )
    return ",\n".join(stages)


SIZES_SQL = "sizes AS (SELECT cut_date, profile, count(*) AS size FROM selected GROUP BY 1, 2)"
CHEAP_SQL = """cheap AS (SELECT r.* EXCLUDE (priced, cut) FROM (SELECT *, count(fee) OVER w AS priced, quantile_cont(fee, 0.25) OVER w AS cut FROM realised WINDOW w AS (PARTITION BY cut_date, profile)) r
  WHERE priced < 8 OR fee <= cut)"""
BT_CTES = (PANEL_SQL, RATES_SQL, REGISTRY_SQL, TERMS_SQL, CUTS_SQL, FORWARD_SQL, BENCH_SQL, POOLS_SQL, SELECTED_SQL, REALISED_SQL, SIZES_SQL)


def bt_pools(t: Tables):
    rows = t.registry.filter(F.col("classification").startswith("Renda Fixa")).join(t.terms, "entity")
    dated = bt.by_cut(rows, RULES.cut_dates, lambda c: c.isNotNull())
    return dated.select("cut_date", F.col("target_investor").alias("profile"), "entity", "fee")


def selected(t: Tables):
    from peervane.operators.selection import top_per_group

    order = [F.col("fee"), F.col("entity")]
    return top_per_group(bt_pools(t), list(bt.GROUP), order, 5).select(*bt.GROUP, "entity")


def realised(t: Tables):
    return materialise(bt_pools(t).join(bt.forward_returns(t.panel, RULES), ["cut_date", "entity"]), "realised")


@query(
    "bt3_random_portfolios", "BT-3",
    with_clause(*BT_CTES, numbered_sql("numbered", "realised"), portfolios_sql("chance", "numbered"))
    + f"SELECT cut_date, profile, draw, {r6('portfolio_return', 'portfolio_return')} FROM chance",
)
def _(t: Tables):
    sizes = selected(t).groupBy(*bt.GROUP).agg(F.count(F.lit(1)).alias("size"))
    return bt.random_portfolios(realised(t), sizes, RULES.portfolios, RULES.seed)


@query(
    "bt4_cheapest_quartile", "BT-4 AGG-8",
    with_clause(*BT_CTES, CHEAP_SQL) + f"SELECT cut_date, profile, entity, {columns_r6('fee', 'forward_return')} FROM cheap",
)
def _(t: Tables):
    return bt.cheapest_quartile(realised(t)).select("cut_date", "profile", "entity", "fee", "forward_return")


OUTCOME_SQL = f"""picked AS (SELECT s.*, f.forward_return FROM selected s LEFT JOIN forward f USING (cut_date, entity)),
middle AS (SELECT cut_date, profile, median(forward_return) AS median FROM realised GROUP BY 1, 2),
basic AS (SELECT cut_date, profile, avg(coalesce(forward_return, 0)) AS selected_return, count(*) FILTER (WHERE coalesce(forward_return, 0) > median) AS beat_median,
  count(*) FILTER (WHERE forward_return IS NULL) AS carried, any_value(median) AS median FROM picked LEFT JOIN middle USING (cut_date, profile) GROUP BY 1, 2),
outcomes AS (SELECT b.*, benchmark_return,
  coalesce((SELECT avg(CASE WHEN round(portfolio_return, 12) < round(b.selected_return, 12) THEN 1.0 ELSE 0.0 END::DOUBLE) FROM chance c WHERE c.cut_date = b.cut_date AND c.profile = b.profile), 0) AS random_percentile,
  coalesce((SELECT avg(CASE WHEN round(portfolio_return, 12) < round(b.selected_return, 12) THEN 1.0 ELSE 0.0 END::DOUBLE) FROM low c WHERE c.cut_date = b.cut_date AND c.profile = b.profile), 0) AS cheap_percentile
  FROM basic b JOIN bench_after USING (cut_date))"""
OUTCOME_CTES = (
    *BT_CTES, CHEAP_SQL, numbered_sql("numbered", "realised"), numbered_sql("numbered_low", "cheap"),
    portfolios_sql("chance", "numbered"), portfolios_sql("low", "numbered_low"), OUTCOME_SQL,
)


def outcomes(t: Tables):
    panel = t.panel
    return bt.evaluate(
        materialise(selected(t), "selected"), materialise(bt_pools(t), "bt-pools"),
        materialise(bt.forward_returns(panel, RULES), "forward"),
        bt.benchmark_returns(t.rates, RULES), bt.discontinued(panel, RULES), RULES,
    )


@query(
    "bt5_evaluated_selections", "BT-5 JN-16 AGG-23 AGG-24 SNK-7",
    with_clause(*OUTCOME_CTES) + f"""SELECT cut_date, profile, carried, beat_median, {columns_r6('selected_return', 'benchmark_return', 'random_percentile', 'cheap_percentile')},
      {r6('median', 'peer_median_return')}, {r6('(selected_return - median) * 10000', 'edge_bp')} FROM outcomes""",
)
def _(t: Tables):
    found = outcomes(t)
    carried = found.select("cut_date", "profile", F.size("carried").alias("carried"))
    return bt.outcome_report(found).join(carried, list(bt.GROUP))


@query(
    "bt7_verdict", "BT-7 AGG-26",
    with_clause(*OUTCOME_CTES) + """SELECT *, bool_and(passed) OVER () AS method_passed FROM (
      SELECT profile, count(*) FILTER (WHERE random_percentile > 0.6) AS dates_passed, count(*) AS dates_tested, count(*) FILTER (WHERE random_percentile > 0.6) >= 2 AS passed FROM outcomes GROUP BY 1)""",
)
def _(t: Tables):
    return bt.verdict(outcomes(t), RULES)


@query(
    "agg27_edge_summary", "AGG-27",
    with_clause(*OUTCOME_CTES) + f"""SELECT {r6('min(selected_return - median) * 10000', 'min_edge_bp')}, {r6('max(selected_return - median) * 10000', 'max_edge_bp')},
      count(*) FILTER (WHERE selected_return > median) AS beat_median, count(*) FILTER (WHERE selected_return > benchmark_return) AS beat_benchmark,
      {r6('min(cheap_percentile)', 'min_cheap_percentile')}, {r6('max(cheap_percentile)', 'max_cheap_percentile')}, count(*) AS tested FROM outcomes""",
)
def _(t: Tables):
    return bt.edge_summary(outcomes(t))


# --- whole rankings ------------------------------------------------------

SETTINGS = Settings(
    profiles=PROFILES, filters=replace(FILTERS, min_observations=6, min_holders=1), months=MONTHS, periods=PERIODS,
    scoring=Scoring(min_group=3), selection=Selection(2.2, 24, 0.2, 0.02, 0.0005, 5, 10),
    resampling=Resampling(draws=1000, block=6, seed=20250101, periods=PERIODS), min_fee_overlap=24,
)


def inputs(t: Tables) -> Inputs:
    return Inputs(
        panel=materialise(t.panel, "panel"), registry=t.registry, primary_terms=t.filings("F"),
        fallback_terms=t.filings("O"), rates=materialise(t.rates, "rates"), holdings=t.holdings,
    )


def in_force_sql(name: str, source: str) -> str:
    return f"""{name} AS (SELECT entity, fee, redemption_days, minimum_investment FROM {source} WHERE ts <= DATE '{REFERENCE}'
      QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC) = 1)"""


RANKED_FUNDS_SQL = f"""both_terms AS (SELECT * FROM pf WHERE fee IS NOT NULL AND redemption_days IS NOT NULL UNION ALL
    SELECT * FROM ff WHERE fee IS NOT NULL AND redemption_days IS NOT NULL AND entity NOT IN (SELECT entity FROM pf WHERE fee IS NOT NULL AND redemption_days IS NOT NULL)),
settled AS (SELECT b.entity, b.fee AS declared_fee, f.measured_fee, b.redemption_days, b.minimum_investment,
    CASE WHEN r.holds_funds = 'S' AND f.measured_fee IS NULL THEN NULL ELSE greatest(b.fee, f.measured_fee) END AS fee
  FROM both_terms b JOIN registry r USING (entity) LEFT JOIN fees f ON f.src = b.entity),
summary AS (SELECT entity, count(*) AS observations, arg_max(assets, ts) AS assets, arg_max(holders, ts) AS holders FROM series0 GROUP BY 1),
universe AS (SELECT r.*, t.* EXCLUDE (entity, fee), CASE WHEN t.fee <> 0 THEN t.fee END AS fee FROM registry r JOIN summary s USING (entity) JOIN settled t USING (entity)
  WHERE regexp_matches(classification, 'Renda Fixa') AND status = 'Em Funcionamento Normal' AND condominium = 'Aberto' AND exclusive <> 'S'
    AND NOT regexp_matches(upper(name), '#0+7$|ZERAGEM') AND observations >= 24 AND assets >= 100000 AND s.holders >= 1 AND fee IS NOT NULL),
series AS (SELECT * FROM series0 WHERE entity IN (SELECT entity FROM universe))"""
FUNDS_OF_UNIVERSE_SQL = """funds AS (SELECT u.*, CASE WHEN long_term = 'S' THEN 0.5::DOUBLE ELSE 0.0 END AS tax_efficiency, ln(1 + average_assets) AS size,
  m.* EXCLUDE (entity, b) FROM universe u JOIN metrics m USING (entity))"""
MEMBERS_SQL = """members AS (SELECT DISTINCT entity, manager FROM pools),
pool_series AS (SELECT * FROM series WHERE entity IN (SELECT entity FROM members))"""
RANK_CTES = (
    PANEL_SQL, RATES_SQL, REGISTRY_SQL, HOLDINGS_SQL, filings_sql("f", "F"), filings_sql("o", "O"), in_force_sql("pf", "f"), in_force_sql("ff", "o"),
    SERIES_SQL.replace("series AS", "series0 AS"), LINKS_SQL, MEASURED_SQL.replace("JOIN panel", "JOIN series0"), RANKED_FUNDS_SQL, BENCHMARK_SQL, METRICS_SQL,
    FUNDS_OF_UNIVERSE_SQL, pools_sql(), *SCORE_CTES[len(FUND_CTES) + 1 :], MEMBERS_SQL,
    *[c.replace("FROM series", "FROM pool_series").replace("JOIN registry r", "JOIN members r") for c in (*TWIN_CTES, *DRAW_CTES)],
    *STABILITY_CTES[len(SCORE_CTES) + len(DRAW_CTES) + len(TWIN_CTES) :],
    """ordered AS (SELECT s.*, a.rate AS appearance_rate, m.rate AS moving_rate, p.fee, coalesce(CASE WHEN p.declared_fee > 0.0005 THEN p.declared_fee ELSE coalesce(p.measured_fee, p.declared_fee) END > 0.02, false) AS cost_gated,
      coalesce(x.pct < 0.2, false) AS below_floor FROM scores s JOIN r_all a USING (profile, entity) JOIN r_moving m USING (profile, entity) JOIN pools p USING (profile, entity)
      JOIN (SELECT profile, entity, pct FROM ranks WHERE metric = 'excess_return') x USING (profile, entity))""",
    "survivors AS (SELECT * FROM ordered WHERE NOT cost_gated AND NOT below_floor)",
    walk_sql("final_list", "survivors", 10, "profile", "appearance_rate DESC, score DESC, entity"),
)


@query(
    "sco12_ranked_profiles", "SCO-12 SCO-9 ORD-2 WIN-9 SNK-5",
    with_clause(*RANK_CTES) + f"""SELECT profile, pick AS rank, entity, pick <= 5 AS delivered, {columns_r6('score', 'pool_score', 'appearance_rate')}
      FROM final_list JOIN survivors USING (profile, entity)""",
)
def _(t: Tables):
    return comparison_list(rank(inputs(t), SETTINGS, REFERENCE).listed)


@query(
    "snk4_ranking_document", "SNK-4",
    with_clause(*RANK_CTES) + f"""SELECT profile, pick AS rank, entity, {columns_r6('score', 'moving_rate', 'fee')}, (SELECT count(*) FROM pools p WHERE p.profile = l.profile) AS eligible_universe_size
      FROM final_list l JOIN survivors USING (profile, entity) WHERE pick <= 5""",
)
def _(t: Tables):
    """The published document of each profile, opened up again into rows."""
    r = rank(inputs(t), SETTINGS, REFERENCE)
    document = ranking_document(
        r.listed, r.displaced, r.struck, r.weights, r.shares, r.scored, metrics_of(PROFILES), REFERENCE, MONTHS, r.start, 5
    )
    entry = document.select("profile", "eligible_universe_size", F.explode("top").alias("e"))
    return entry.select(
        "profile", "eligible_universe_size", "e.rank", "e.entity", "e.score",
        F.col("e.appearance_rate_variable_only").alias("moving_rate"), F.col("e.metrics.fee").alias("fee"),
    )


def cut_sql(number: int, cut: dt.date) -> str:
    """The pools of a ranking as of a cut, with the place on the final list: the statement of one date, read at another."""
    dates = {f"DATE '{REFERENCE}'": f"DATE '{cut}'", f"DATE '{START}'": f"DATE '{window_start_date(cut, MONTHS)}'"}
    moved = []
    for cte in RANK_CTES:
        if cte != REGISTRY_SQL:  # the registry knows no date
            for there, here in dates.items():
                cte = cte.replace(there, here)
        moved.append(cte)
    return f"ranked_{number} AS MATERIALIZED ({with_clause(*moved)} SELECT profile, entity, p.fee, f.pick FROM pools p LEFT JOIN final_list f USING (profile, entity))"


REPLAY_CTES = (
    PANEL_SQL, RATES_SQL, CUTS_SQL, FORWARD_SQL, BENCH_SQL, *[cut_sql(n, c) for n, c in enumerate(RULES.cut_dates)],
    "replayed AS (" + " UNION ALL ".join(f"SELECT DATE '{c}' AS cut_date, * FROM ranked_{n}" for n, c in enumerate(RULES.cut_dates)) + ")",
    "bt_pools AS (SELECT cut_date, profile, entity, fee FROM replayed)", "selected AS (SELECT cut_date, profile, entity FROM replayed WHERE pick <= 5)",
    REALISED_SQL, SIZES_SQL, *OUTCOME_CTES[len(BT_CTES) :],
)


@query(
    "bt6_replayed_rankings", "BT-6 BT-5",
    with_clause(*REPLAY_CTES) + f"""SELECT cut_date, profile, beat_median, {columns_r6('selected_return', 'benchmark_return', 'random_percentile', 'cheap_percentile')},
      {r6('median', 'peer_median_return')}, {r6('(selected_return - median) * 10000', 'edge_bp')} FROM outcomes""",
)
def _(t: Tables):
    return bt.outcome_report(replay(inputs(t), SETTINGS, RULES)[0])
