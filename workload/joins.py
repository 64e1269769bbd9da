"""Joins: dimension, as-of, three-way aligned, lookup, reachability, funnel."""

from __future__ import annotations

from pyspark.sql import functions as F

from peervane.operators import universe as un
from peervane.operators.asof import in_force
from peervane.operators.joins import left_join_keeping_rows, repeated_keys, without_overlap
from peervane.operators.links import heaviest_edge, measured_fees, reconcile_fees
from peervane.operators.series import summarise_series, with_benchmark_rate, with_returns
from peervane.params import Filters
from workload.base import (
    HOLDINGS_SQL,
    METRIC_CTES,
    PANEL_SQL,
    PERIODS,
    RATES_SQL,
    REFERENCE,
    REGISTRY_SQL,
    SERIES_SQL,
    TERMS_SQL,
    Tables,
    columns_r6,
    filings_sql,
    query,
    r6,
    with_clause,
)


@query(
    "jn1_left_join_keeping_rows", "JN-1 JN-15",
    f"SELECT o_orderkey, o_custkey, c_name, c_mktsegment, {r6('o_totalprice', 'o_totalprice')} FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def _(t: Tables):
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return left_join_keeping_rows(orders, customers, ["o_custkey"])


@query(
    "jn1_repeated_keys", "JN-1",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(t: Tables):
    return repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "jn2_registry_with_summary", "JN-2 AGG-1",
    with_clause(PANEL_SQL, REGISTRY_SQL) + f"""SELECT r.entity, r.grp, count(*) AS observations, min(ts) AS first_date, max(ts) AS last_date,
      {r6('arg_max(assets, ts)', 'assets')}, arg_max(holders, ts) AS holders
      FROM registry r JOIN panel p ON r.entity = p.entity WHERE ts <= DATE '{REFERENCE}' GROUP BY 1, 2""",
)
def _(t: Tables):
    return t.registry.select("entity", "grp").join(summarise_series(t.panel, REFERENCE), "entity")


@query(
    "jn3_optional_terms", "JN-3",
    with_clause(REGISTRY_SQL, TERMS_SQL) + f"""SELECT r.entity, r.name, {r6('t.fee', 'fee')}, t.redemption_days
      FROM registry r LEFT JOIN (SELECT * FROM terms WHERE redemption_days >= 25) t USING (entity)""",
)
def _(t: Tables):
    late = t.terms.filter("redemption_days >= 25").select("entity", "fee", "redemption_days")
    return left_join_keeping_rows(t.registry.select("entity", "name"), late, ["entity"])


@query(
    "jn4_semi_join_panel", "JN-4",
    with_clause(PANEL_SQL, SERIES_SQL, REGISTRY_SQL) + f"""SELECT entity, ts, {r6('price', 'price')} FROM series
      WHERE entity IN (SELECT entity FROM registry WHERE manager = 'AFRICA')""",
)
def _(t: Tables):
    chosen = t.registry.filter("manager = 'AFRICA'").select("entity")
    return t.series.select("entity", "ts", "price").join(chosen, "entity", "left_semi")


@query(
    "jn6_reachable_by_individuals", "JN-6",
    """SELECT c_custkey AS entity, c_mktsegment AS segment FROM customer
      LEFT JOIN (SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' AND o_orderpriority = '2-HIGH') AS ok FROM orders GROUP BY 1) ON o_custkey = c_custkey
      WHERE coalesce(ok, true)""",
)
def _(t: Tables):
    profile = t.orders.select(
        F.col("o_custkey").alias("entity"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("individuals"),
        ((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "2-HIGH")).cast("int").alias("distributors"),
    )
    funds = t.customer.select(F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("segment"))
    return un.reachable(funds, profile, "entity")


LINKS_SQL = """summed AS (SELECT src, dst, sum(value) AS v FROM holdings GROUP BY 1, 2),
links AS (SELECT src, dst, share FROM (SELECT src, dst, v / sum(v) OVER (PARTITION BY src) AS share, sum(v) OVER (PARTITION BY src) AS total,
  row_number() OVER (PARTITION BY src ORDER BY v DESC, dst DESC) AS k FROM summed) WHERE k = 1 AND total > 0 AND share >= 0.95)"""


@query(
    "agg2_heaviest_edge", "AGG-2 PRJ-4",
    with_clause("holdings AS (SELECT l_orderkey AS src, l_suppkey AS dst, l_extendedprice AS value FROM lineitem)", LINKS_SQL.replace("0.95", "0.4"))
    + f"SELECT src, dst, {r6('share', 'share')} FROM links",
)
def _(t: Tables):
    edges = t.lineitem.select(
        F.col("l_orderkey").alias("src"), F.col("l_suppkey").alias("dst"), F.col("l_extendedprice").alias("value")
    )
    return heaviest_edge(edges, 0.4)


MEASURED_SQL = f"""both_sides AS (SELECT l.src, c.ts, c.price AS own, m.price AS master FROM links l JOIN panel c ON c.entity = l.src JOIN panel m ON m.entity = l.dst AND m.ts = c.ts),
ends_of AS (SELECT src, count(*) AS n, arg_min(own, ts) AS o0, arg_max(own, ts) AS o1, arg_min(master, ts) AS m0, arg_max(master, ts) AS m1 FROM both_sides GROUP BY src),
fees AS (SELECT * FROM (SELECT src, n AS measured_days, 1 - pow((o1 / o0) / (m1 / m0), 1 / ((n - 1) / {float(PERIODS)})) AS measured_fee FROM ends_of WHERE n >= 24) WHERE measured_fee >= 0)"""


@query(
    "jn7_measured_fees", "JN-7 AGG-3 SCL-10 WIN-8",
    with_clause(PANEL_SQL, HOLDINGS_SQL, LINKS_SQL, MEASURED_SQL) + f"SELECT src, measured_days, {r6('measured_fee', 'measured_fee')} FROM fees",
)
def _(t: Tables):
    return measured_fees(t.panel, heaviest_edge(t.holdings, 0.95), PERIODS, 24)


@query(
    "sco10_reconciled_fees", "SCO-10 JN-8 SCL-11 SCL-12 JN-15",
    with_clause(PANEL_SQL, HOLDINGS_SQL, LINKS_SQL, MEASURED_SQL, TERMS_SQL, REGISTRY_SQL) + f"""
    SELECT t.entity, {r6('t.fee', 'declared_fee')}, {r6('f.measured_fee', 'measured_fee')},
      {r6("CASE WHEN r.holds_funds = 'S' AND f.measured_fee IS NULL THEN NULL ELSE greatest(t.fee, f.measured_fee) END", 'fee')}
    FROM terms t JOIN registry r USING (entity) LEFT JOIN fees f ON f.src = t.entity""",
)
def _(t: Tables):
    fees = measured_fees(t.panel, heaviest_edge(t.holdings, 0.95), PERIODS, 24)
    flagged = t.terms.select("entity", "fee").join(t.registry.select("entity", "holds_funds"), "entity")
    settled = reconcile_fees(flagged, fees.withColumnRenamed("src", "entity"), "entity")
    return settled.select("entity", "declared_fee", "measured_fee", "fee")


@query(
    "jn10_filing_in_force", "JN-10",
    f"""SELECT o_custkey, CAST(o_orderdate AS DATE) AS filed, o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, {r6('o_totalprice', 'o_totalprice')}
      FROM orders WHERE o_orderdate <= TIMESTAMP '{REFERENCE}' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t: Tables):
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    filings = t.orders.select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("filed"), "o_orderkey", priority.alias("priority"), "o_totalprice"
    )
    return in_force(filings, "o_custkey", "filed", REFERENCE, [F.col("o_orderkey")])


@query(
    "jn11_benchmark_rate_lookup", "JN-11",
    with_clause(PANEL_SQL, RATES_SQL) + f"""SELECT entity, p.ts, {r6('price / lag(price) OVER (PARTITION BY entity ORDER BY p.ts) - 1', 'ret')}, {r6('coalesce(rate, 0)', 'benchmark_rate')}
      FROM panel p LEFT JOIN rates r ON p.ts = r.ts""",
)
def _(t: Tables):
    returns = with_returns(t.panel).select("entity", "ts", "ret")
    return with_benchmark_rate(returns, t.rates)


@query(
    "jn13_join_without_overlap", "JN-13",
    with_clause(*METRIC_CTES, REGISTRY_SQL) + f"""SELECT r.entity, r.grp, m.observations, {r6('m.total_return', 'total_return')}
      FROM registry r JOIN metrics m USING (entity)""",
)
def _(t: Tables):
    left = t.registry.select("entity", "grp", F.lit(0).alias("observations"))
    measured = t.metrics.select("entity", "observations", "total_return")
    return without_overlap(left, measured, ["entity"]).join(measured, "entity")


FILTERS = Filters(
    classification=["Renda Fixa"], status=["Em Funcionamento Normal"], condominium=["Aberto"],
    exclude_exclusive=True, exclude_name_markers=["#0+7$", "ZERAGEM"], min_observations=12, min_assets=100_000.0,
    min_holders=2,
)
STEPS = [
    "registered_classes", "fixed_income", "operating", "open_ended", "non_exclusive", "not_cash_sweep", "with_quota_series",
    "with_enough_observations", "above_min_assets", "above_min_shareholders", "with_fee_and_redemption", "reachable_by_individuals",
]


def universe(t: Tables):
    """The funnel over the suppliers; holders are the orders each supplier's nation shares."""
    terms = in_force(t.filings(), "entity", "ts", REFERENCE).drop("ts")
    holders = t.lineitem.select(
        F.col("l_suppkey").alias("entity"),
        (F.col("l_quantity") > 49.5).cast("int").alias("individuals"),
        (F.col("l_discount") > 0.095).cast("int").alias("distributors"),
    )
    return un.build_universe(
        t.registry, summarise_series(t.series, REFERENCE), terms, FILTERS.scaled_to(36), holders
    )


UNIVERSE_SQL = f"""summary AS (SELECT entity, count(*) AS observations, arg_max(assets, ts) AS assets, arg_max(holders, ts) AS holders FROM series GROUP BY 1),
in_force AS (SELECT * FROM f WHERE ts <= DATE '{REFERENCE}' QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC) = 1),
evidence AS (SELECT l_suppkey AS entity, bool_or(l_quantity > 49.5 OR l_discount > 0.095) AS reached FROM lineitem GROUP BY 1),
joined AS (SELECT r.*, s.observations, s.assets, s.holders, t.fee, t.redemption_days, e.reached FROM registry r
  LEFT JOIN summary s USING (entity) LEFT JOIN in_force t USING (entity) LEFT JOIN evidence e USING (entity)),
staged AS (SELECT *, regexp_matches(classification, 'Renda Fixa') AS s1, status = 'Em Funcionamento Normal' AS s2, condominium = 'Aberto' AS s3,
  exclusive <> 'S' AS s4, NOT regexp_matches(upper(name), '#0+7$|ZERAGEM') AS s5, observations IS NOT NULL AS s6, coalesce(observations >= 36, false) AS s7,
  coalesce(assets >= 100000, false) AS s8, coalesce(holders >= 2, false) AS s9, fee IS NOT NULL AND redemption_days IS NOT NULL AS s10, coalesce(reached, true) AS s11 FROM joined)"""
UNIVERSE_CTES = (PANEL_SQL, SERIES_SQL, REGISTRY_SQL, filings_sql("f"), UNIVERSE_SQL)


def passed(k: int) -> str:
    return " AND ".join(f"s{i}" for i in range(1, k + 1)) or "true"


FUNNEL_SQL = "funnel AS (" + " UNION ALL ".join(
    f"SELECT {k}::BIGINT AS ord, '{s}' AS step, count(*) FILTER (WHERE {passed(k)}) AS observed FROM staged" for k, s in enumerate(STEPS)
) + ")"


@query(
    "agg6_eligibility_funnel", "AGG-6 SCO-13 FLT-1 FLT-2 FLT-3 FLT-4 FLT-5 FLT-6 SNK-6",
    with_clause(*UNIVERSE_CTES, FUNNEL_SQL) + "SELECT * FROM funnel",
)
def _(t: Tables):
    return universe(t)[1]


@query(
    "sco13_universe", "SCO-13 JN-3 JN-6 PRJ-5",
    with_clause(*UNIVERSE_CTES) + f"""SELECT entity, grp, manager, observations, holders, redemption_days, {columns_r6('assets')}, {r6('CASE WHEN fee <> 0 THEN fee END', 'fee')}, {r6('fee', 'declared_fee')}, fee = 0 AS zero_declared
      FROM staged WHERE {passed(11)}""",
)
def _(t: Tables):
    return universe(t)[0].select(
        "entity", "grp", "manager", "observations", "holders", "redemption_days", "assets", "fee", "declared_fee", "zero_declared"
    )


EXPECTED = {"registered_classes": 100, "fixed_income": 90, "operating": 90, "with_quota_series": 60, "above_min_assets": 0}
REPORT_SQL = f"""baseline (step, expected) AS (VALUES {', '.join(f"('{k}', {v})" for k, v in EXPECTED.items())}),
report AS (SELECT ord, step, observed, expected::BIGINT AS expected, CASE WHEN expected = 0 THEN CASE WHEN observed = 0 THEN 0.0 ELSE 1.0 END ELSE (observed - expected) / expected::DOUBLE END AS deviation
  FROM funnel JOIN baseline USING (step))"""


@query(
    "agg20_funnel_against_baseline", "AGG-20 SNK-6",
    with_clause(*UNIVERSE_CTES, FUNNEL_SQL, REPORT_SQL) + f"SELECT ord, step, observed, expected, {r6('deviation', 'deviation')}, abs(deviation) <= 0.03 AS ok FROM report",
)
def _(t: Tables):
    return un.compare_funnel(universe(t)[1], EXPECTED, 0.03)


@query(
    "agg20_worst_step", "AGG-20",
    with_clause(*UNIVERSE_CTES, FUNNEL_SQL, REPORT_SQL) + f"""SELECT ord, step, observed, expected, {r6('deviation', 'deviation')}, false AS ok FROM report
      WHERE abs(deviation) > 0.03 ORDER BY abs(deviation) DESC, ord LIMIT 1""",
)
def _(t: Tables):
    return un.worst_step(un.compare_funnel(universe(t)[1], EXPECTED, 0.03))


@query(
    "snk3_changed_inputs", "SNK-3",
    """SELECT coalesce(d.doc_id, l.doc_id)::VARCHAR AS name, CASE WHEN l.doc_id IS NULL THEN 'added' WHEN d.doc_id IS NULL THEN 'removed'
      WHEN l.quality = 0 THEN 'changed' WHEN l.toxic = 1 THEN 'changed' ELSE 'same' END AS state
      FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t: Tables):
    from peervane.sources.staged import changed_inputs

    now = t.documents.select(
        F.col("doc_id").cast("string").alias("name"), F.sha2("text", 256).alias("sha256"), F.length("text").alias("size_bytes")
    )
    known = t.labels.select(F.col("doc_id").cast("string").alias("name"), "quality", "toxic").join(now, "name", "left")
    before = known.select(
        "name",
        F.when(F.col("toxic") == 1, "other").otherwise(F.coalesce("sha256", F.lit("gone"))).alias("sha256"),
        (F.coalesce("size_bytes", F.lit(0)) + F.when(F.col("quality") == 0, 1).otherwise(0)).alias("size_bytes"),
    )
    return changed_inputs(before, now)
