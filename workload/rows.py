"""Projections, filters, scalar functions, deduplication, set operations, orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from peervane.functions import keys, numbers
from peervane.functions.dates import months_touched, track_record, window_start, window_start_date
from peervane.functions.tax import tax_efficiency, tax_regime
from peervane.operators import triage as tr
from peervane.operators.asof import combine_terms
from peervane.operators.dedup import distinct_keys, except_keys, last_per_key, union_distinct
from peervane.operators.selection import in_listed_order, top_per_group
from peervane.operators.universe import any_pattern, blank_undisclosed, lacks_marker
from peervane.sources.text import cast_present, select_and_rename, union_drifting
from workload.base import (
    DAILY_SQL,
    FUND_CTES,
    PANEL_SQL,
    REFERENCE,
    REGISTRY_SQL,
    START,
    Tables,
    columns_r6,
    filings_sql,
    pools_sql,
    query,
    r6,
    with_clause,
)


def digit_sum_sql(key: str, weights) -> str:
    return "(" + " + ".join(f"substr({key}, {i}, 1)::INTEGER * {w}" for i, w in enumerate(weights, 1)) + ")"


def check_digit_sql(key: str, weights) -> str:
    s = digit_sum_sql(key, weights)
    return f"CASE WHEN {s} % 11 < 2 THEN 0 ELSE 11 - {s} % 11 END"


def with_full_key(frame, number):
    """Add `key`: twelve digits of a number and the two digits that close them."""
    closing = F.lpad(keys.closing_digits(number.cast("bigint")).cast("string"), 2, "0")
    return frame.withColumn("key", F.concat(F.lpad(number.cast("string"), 12, "0"), closing))


def full_key_sql(source: str, base: str) -> str:
    """Rows of `source` with `key`: the base and its two check digits."""
    return (
        f"(SELECT * EXCLUDE (k1), k1 || ({check_digit_sql('k1', keys.SECOND_DIGIT_WEIGHTS)})::VARCHAR AS key FROM ("
        f"SELECT *, b || ({check_digit_sql('b', keys.FIRST_DIGIT_WEIGHTS)})::VARCHAR AS k1 FROM ("
        f"SELECT *, {base} AS b FROM {source})))"
    )


# --- projections ---------------------------------------------------------

RENAMED = {"o_orderkey": "id", "o_custkey": "owner", "o_totalprice": "amount", "not_published": "extra"}


@query(
    "prj1_select_and_rename", "PRJ-1 PRJ-2",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS owner, " + r6("o_totalprice", "amount") + " FROM orders",
)
def _(t: Tables):
    kept = select_and_rename(t.orders, RENAMED)
    return cast_present(kept, {"id": F.col("id").cast("string"), "extra": F.col("extra")})


@query(
    "prj3_scoring_aliases", "PRJ-3 PRJ-7 SCL-19",
    with_clause(PANEL_SQL) + f"SELECT entity, ts, {r6('price', 'quota')}, {r6('ln(1 + assets)', 'size')} FROM panel",
)
def _(t: Tables):
    return t.panel.select(
        "entity", "ts", F.col("price").alias("quota"), numbers.log_size(F.col("assets")).alias("size")
    )


@query(
    "prj5_blank_undisclosed_fees", "PRJ-5",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {r6('l_tax', 'declared_fee')}, l_tax = 0 AS zero_declared,
      {r6('CASE WHEN l_tax <> 0 THEN l_tax END', 'fee')} FROM lineitem""",
)
def _(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_tax").alias("fee"))
    return blank_undisclosed(lines)


@query(
    "prj6_source_tag_union", "PRJ-6 SET-1 FLT-12",
    with_clause(filings_sql("f", "F"), filings_sql("o", "O")) + f"""
    SELECT *, 'EXTRATO' AS source FROM (SELECT entity, ts, {r6('fee', 'fee')}, redemption_days FROM f WHERE fee IS NOT NULL AND redemption_days IS NOT NULL)
    UNION ALL
    SELECT *, 'LAMINA' FROM (SELECT entity, ts, {r6('fee', 'fee')}, redemption_days FROM o WHERE fee IS NOT NULL AND redemption_days IS NOT NULL)""",
)
def _(t: Tables):
    def tagged(status, label):
        both = F.col("fee").isNotNull() & F.col("redemption_days").isNotNull()
        return t.filings(status).filter(both).select(
            "entity", "ts", "fee", "redemption_days", F.lit(label).alias("source")
        )

    return tagged("F", "EXTRATO").unionByName(tagged("O", "LAMINA"))


@query(
    "prj8_half_even_rounding", "PRJ-8",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round_even(l_quantity / 4, 0) AS BIGINT) AS quarter_quantity FROM lineitem",
)
def _(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.bround(F.col("l_quantity") / 4, 0).cast("bigint").alias("quarter_quantity"),
    )


# --- filters -------------------------------------------------------------


@query(
    "flt1_without_blank_ids", "FLT-1",
    "SELECT doc_id, source FROM documents WHERE source IS NULL OR trim(CASE WHEN lang = 'en' THEN '  ' ELSE source END) = ''",
)
def _(t: Tables):
    docs = t.documents.select("doc_id", "source", F.when(F.col("lang") == "en", "  ").otherwise(F.col("source")).alias("sub"))
    return docs.filter(F.col("source").isNull() | (F.trim("sub") == "")).drop("sub")


@query(
    "flt2_any_pattern", "FLT-2",
    "SELECT p_partkey, p_name, p_type FROM part WHERE regexp_matches(p_type, 'ECONOMY') OR regexp_matches(p_type, '^PROMO')",
)
def _(t: Tables):
    return t.part.filter(any_pattern(F.col("p_type"), ["ECONOMY", "^PROMO"])).select("p_partkey", "p_name", "p_type")


@query(
    "flt3_membership_and_inequality", "FLT-3 FLT-4",
    with_clause(REGISTRY_SQL) + """SELECT entity, name, status, condominium, exclusive FROM registry
      WHERE status IN ('Em Funcionamento Normal') AND condominium IN ('Aberto') AND exclusive <> 'S'""",
)
def _(t: Tables):
    return t.registry.filter(
        F.col("status").isin("Em Funcionamento Normal") & F.col("condominium").isin("Aberto") & (F.col("exclusive") != "S")
    ).select("entity", "name", "status", "condominium", "exclusive")


@query(
    "flt5_lacks_marker", "FLT-5",
    "SELECT p_partkey, p_name FROM part WHERE NOT coalesce(regexp_matches(upper(nullif(p_name, 'small ring')), 'WIDGET|GEAR'), false)",
)
def _(t: Tables):
    name = F.when(F.col("p_name") != "small ring", F.col("p_name"))
    return t.part.filter(lacks_marker(name, ["WIDGET", "GEAR"])).select("p_partkey", "p_name")


@query(
    "flt6_floors", "FLT-6 FLT-7",
    with_clause(PANEL_SQL) + """SELECT entity, count(*) AS observations, CAST(sum(holders) AS BIGINT) AS holders FROM panel
      GROUP BY entity HAVING count(*) >= 80 AND sum(holders) >= 500""",
)
def _(t: Tables):
    from peervane.params import Filters

    floors = Filters(["x"], ["x"], ["x"], min_observations=20, min_holders=500).scaled_to(48)
    summed = t.panel.groupBy("entity").agg(F.count(F.lit(1)).alias("observations"), F.sum("holders").alias("holders"))
    return summed.filter(
        (F.col("observations") >= floors.min_observations) & (F.col("holders") >= floors.min_holders)
    )


@query(
    "flt8_point_in_time_window", "FLT-8 FLT-9 FLT-10 SCL-17",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS ts FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '{START}' AND l_shipdate <= TIMESTAMP '{REFERENCE}'""",
)
def _(t: Tables):
    start = window_start_date(REFERENCE, 48)
    day = F.col("l_shipdate")
    return t.lineitem.filter(
        (day >= F.lit(str(start)).cast("timestamp_ntz")) & (day <= F.lit(str(REFERENCE)).cast("timestamp_ntz"))
    ).select("l_orderkey", "l_linenumber", "l_partkey", day.cast("date").alias("ts"))


@query(
    "flt11_profile_eligibility", "FLT-11 JN-9",
    with_clause(*FUND_CTES, pools_sql()) + "SELECT profile, entity, target_investor, redemption_days FROM pools",
)
def _(t: Tables):
    from peervane.operators.peers import profile_pools
    from workload.base import PROFILES

    return profile_pools(t.funds, PROFILES).select("profile", "entity", "target_investor", "redemption_days")


@query(
    "flt13_sound_series", "FLT-13 SCL-21",
    with_clause(DAILY_SQL) + """SELECT entity, count(*) AS observations FROM daily GROUP BY entity
      HAVING count(*) >= 2 AND count(*) FILTER (WHERE price IS NULL OR price <= 0) = 0""",
)
def _(t: Tables):
    from peervane.operators.series import sound_series

    return sound_series(t.daily)


@query(
    "flt14_cost_and_performance_vetoes", "FLT-14 SCL-13 SCO-14",
    with_clause(FUND_CTES[0], FUND_CTES[1], FUND_CTES[2], FUND_CTES[3], FUND_CTES[4], FUND_CTES[5], FUND_CTES[6], FUND_CTES[7],
    """judged AS (SELECT entity, CASE WHEN fee > 0.0105 THEN fee ELSE coalesce(m, fee) END AS gate_cost, negative_days AS pct
      FROM (SELECT *, CASE WHEN holds_funds = 'N' THEN fee * 1.1 END AS m FROM funds))""") + f"""
    SELECT entity, {r6('gate_cost', 'gate_cost')}, gate_cost > 0.0105 AS cost_gated, coalesce(pct < 0.45, false) AS below_floor,
      gate_cost > 0.0105 OR coalesce(pct < 0.45, false) AS vetoed,
      CASE WHEN gate_cost > 0.0105 THEN 'cost' WHEN pct < 0.45 THEN 'performance' END AS reason FROM judged""",
)
def _(t: Tables):
    from peervane.operators.selection import exclusion_reason, with_gates

    judged = t.funds.select(
        "entity", F.col("fee").alias("declared_fee"),
        F.when(F.col("holds_funds") == "N", F.col("fee") * 1.1).alias("measured_fee"),
        F.col("negative_days").alias("excess_return_pct"),
    )
    gated = with_gates(judged, 0.0105, 0.0105, 0.45)
    return gated.select("entity", "gate_cost", "cost_gated", "below_floor", "vetoed", exclusion_reason().alias("reason"))


# --- scalar functions ----------------------------------------------------


@query(
    "scl1_digits_only", "SCL-1",
    "SELECT page_id, regexp_replace(url, '[^0-9]', '', 'g') AS digits FROM pages",
)
def _(t: Tables):
    return t.pages.select("page_id", keys.digits_only(F.col("url")).alias("digits"))


VALID_SQL = (
    "key = '' IS FALSE AND regexp_matches(key, '^[0-9]{14}$') AND key <> repeat(substr(key, 1, 1), 14) "
    f"AND substr(key, 13, 1)::INTEGER = ({check_digit_sql('key', keys.FIRST_DIGIT_WEIGHTS)}) "
    f"AND substr(key, 14, 1)::INTEGER = ({check_digit_sql('key', keys.SECOND_DIGIT_WEIGHTS)})"
)


@query(
    "scl2_check_digits_per_key", "SCL-2 DED-4",
    f"SELECT DISTINCT key, {VALID_SQL} AS valid FROM (SELECT lpad(o_custkey::VARCHAR, 14, '0') AS key FROM orders)",
)
def _(t: Tables):
    raw = t.orders.select(F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias("key"))
    return tr.valid_keys(raw, "key")


@query(
    "scl3_normalised_keys", "SCL-3",
    "SELECT c_custkey, key AS normalised, NULL::VARCHAR AS problem FROM "
    + full_key_sql("customer", "lpad(c_custkey::VARCHAR, 12, '0')")
    + """ WHERE c_acctbal >= 0 AND key <> repeat('0', 14)
    UNION ALL SELECT c_custkey, NULL, CASE WHEN c_acctbal < 0 THEN 'key must have 14 digits' ELSE 'key fails its check digits' END FROM """
    + full_key_sql("customer", "lpad(c_custkey::VARCHAR, 12, '0')")
    + " WHERE c_acctbal < 0 OR key = repeat('0', 14)",
)
def _(t: Tables):
    keyed = with_full_key(t.customer, F.col("c_custkey"))
    key = F.col("key")
    dotted = F.concat(F.substring(key, 1, 8), F.lit("/"), F.substring(key, 9, 4), F.lit("-"), F.substring(key, 13, 2))
    raw = F.when(F.col("c_acctbal") < 0, F.substring(key, 1, 9)).otherwise(dotted)
    return keys.with_normalised_key(keyed.select("c_custkey", raw.alias("raw")), "raw", "normalised", "problem").drop("raw")


@query(
    "scl4_lenient_parsing", "SCL-4 SCL-5",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS iso,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day_first,
      {r6("CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 100 END", 'fraction')} FROM orders""",
)
def _(t: Tables):
    from peervane.functions.dates import day_first_date, iso_date

    open_row = F.col("o_orderstatus") == "P"
    text = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")
    other = F.date_format(F.col("o_orderdate"), "dd/MM/yyyy")
    raw = t.orders.select(
        "o_orderkey",
        F.when(open_row, "2025-13-45").otherwise(text).alias("a"),
        F.when(open_row, "not a date").otherwise(other).alias("b"),
        F.when(open_row, "n/d").otherwise(F.col("o_totalprice").cast("string")).alias("c"),
    )
    return raw.select(
        "o_orderkey", iso_date(F.col("a")).alias("iso"), day_first_date(F.col("b")).alias("day_first"),
        numbers.percent_to_fraction(F.col("c")).alias("fraction"),
    )


@query(
    "scl6_redemption_days", "SCL-6",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_returnflag = 'A' THEN CAST(ceil((l_linenumber + coalesce(q, 0)) * 7 / 5.0::DOUBLE) AS BIGINT) ELSE l_linenumber + coalesce(q, 0) END AS days
      FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) END AS q FROM lineitem)""",
)
def _(t: Tables):
    unit = F.when(F.col("l_returnflag") == "A", "Dias úteis").when(F.col("l_returnflag") == "N", "corridos")
    unit = F.when(F.col("l_returnflag") == "A", F.lit("dias uteis")).otherwise(unit)
    payment = F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("bigint"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        numbers.redemption_days(F.col("l_linenumber").cast("bigint"), payment, unit).alias("days"),
    )


def raw_report(t: Tables):
    """Orders as a dirty report: formatted, short and wrong keys, missing and bad values."""
    keyed = with_full_key(t.orders, F.col("o_custkey") + 1)
    key = F.col("key")
    status, priority, amount = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    raw = (
        F.when((priority == "1-URGENT") & (status == "P"), F.substring(key, 1, 10))
        .when((priority == "1-URGENT") & (status == "F"), F.concat(F.substring(key, 1, 13), F.lit("X")))
        .when(priority == "2-HIGH", F.concat(F.substring(key, 1, 12), F.lit("-"), F.substring(key, 13, 2)))
        .when((priority == "3-MEDIUM") & (status == "P"), F.concat(F.lit("9"), F.substring(key, 2, 13)))
        .otherwise(key)
    )
    return keyed.select(
        keys.digits_only(raw).alias("key"),
        F.when((priority != "4-NOT SPECIFIED") | (status != "P"), F.trunc(F.col("o_orderdate").cast("date"), "quarter")).alias("ts"),
        F.when((priority != "5-LOW") | (status != "P"), amount - 20000).alias("price"),
        (amount - 30000).alias("assets"), F.col("o_orderkey").alias("seq"),
    )


RAW_SQL = f"""raw AS (SELECT regexp_replace(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN substr(key, 1, 10)
    WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN substr(key, 1, 13) || 'X'
    WHEN o_orderpriority = '2-HIGH' THEN substr(key, 1, 12) || '-' || substr(key, 13, 2)
    WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN '9' || substr(key, 2, 13) ELSE key END, '[^0-9]', '', 'g') AS key,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' OR o_orderstatus <> 'P' THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) END AS ts,
  CASE WHEN o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P' THEN o_totalprice - 20000 END AS price, o_totalprice - 30000 AS assets, o_orderkey AS seq
  FROM {full_key_sql('orders', "lpad((o_custkey + 1)::VARCHAR, 12, '0')")}),
kept AS (SELECT *, count(*) OVER (PARTITION BY key, ts) AS copies FROM raw QUALIFY row_number() OVER (PARTITION BY key, ts ORDER BY seq DESC) = 1),
judged AS (SELECT *, CASE WHEN ts > DATE '{REFERENCE}' THEN NULL WHEN length(key) <> 14 THEN 'key must have 14 digits'
    WHEN NOT ({VALID_SQL}) THEN 'key fails its check digits' WHEN ts IS NULL THEN 'no readable date'
    WHEN price IS NULL THEN 'no price' WHEN price <= 0 THEN 'price at or below zero' WHEN assets < 0 THEN 'assets below zero' END AS reason FROM kept),
fated AS (SELECT *, CASE WHEN ts > DATE '{REFERENCE}' THEN 'future' WHEN reason IS NOT NULL THEN 'quarantined' ELSE 'clean' END AS disposition FROM judged)"""


def judged_report(t: Tables):
    reason = tr.rejection_reason(F.col("key"), F.col("ts"), F.col("price"), F.col("assets"))
    return tr.triage(raw_report(t), ["key", "ts"], "ts", reason, REFERENCE, [F.col("seq")])


@query(
    "scl8_triage", "SCL-7 SCL-8 DED-2",
    with_clause(RAW_SQL) + f"SELECT key, ts, seq, reason, disposition, {columns_r6('price', 'assets')} FROM fated",
)
def _(t: Tables):
    return judged_report(t).drop("copies")


@query(
    "agg21_row_accounting", "AGG-21",
    with_clause(RAW_SQL) + """SELECT d.disposition, coalesce(n, 0) AS n_rows FROM (VALUES ('clean'), ('quarantined'), ('future')) d(disposition)
      LEFT JOIN (SELECT disposition, count(*) AS n FROM fated GROUP BY 1) USING (disposition)
      UNION ALL SELECT 'deduplicated', CAST(sum(copies - 1) AS BIGINT) FROM fated""",
)
def _(t: Tables):
    return tr.accounting(judged_report(t))


@query(
    "agg19_quarantine_share", "AGG-19",
    with_clause(RAW_SQL) + f"""SELECT CAST(sum(copies) AS BIGINT) AS received, count(*) FILTER (WHERE disposition = 'quarantined') AS quarantined,
      {r6("count(*) FILTER (WHERE disposition = 'quarantined') / sum(copies)", 'share')} FROM fated""",
)
def _(t: Tables):
    return tr.quarantine_share(judged_report(t))


@query(
    "scl9_contract_breaches", "SCL-9",
    """SELECT count(*) FILTER (WHERE NOT regexp_matches(lpad(c_custkey::VARCHAR, 14, '0'), '^[0-9]{14}$')) AS key, 0::BIGINT AS date,
      count(*) FILTER (WHERE NOT c_acctbal > 0) AS price, count(*) FILTER (WHERE c_acctbal < 0) AS assets, 0::BIGINT AS holders FROM customer""",
)
def _(t: Tables):
    rows = t.customer.select(
        F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("key"), F.lit(REFERENCE).alias("ts"),
        F.col("c_acctbal").alias("price"), F.col("c_acctbal").alias("assets"), F.col("c_custkey").alias("holders"),
    )
    return tr.contract_breaches(rows, "key", "ts", "price", "assets", "holders")


@query(
    "scl10_horizontal_max_and_clip", "SCL-11 SCL-20",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {r6("greatest(CASE WHEN l_returnflag <> 'A' THEN l_tax END, CASE WHEN l_linestatus = 'F' THEN l_discount END)", 'fee')},
      {r6("CASE WHEN l_returnflag <> 'A' THEN greatest(0.01, least(0.06, l_tax)) END", 'clipped')} FROM lineitem""",
)
def _(t: Tables):
    tax = F.when(F.col("l_returnflag") != "A", F.col("l_tax"))
    discount = F.when(F.col("l_linestatus") == "F", F.col("l_discount"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.max_ignoring_null(tax, discount).alias("fee"),
        numbers.clip(tax, F.lit(0.01), F.lit(0.06)).alias("clipped"),
    )


EXEMPT_SQL = "(upper(coalesce(p_name, '') || ' ' || coalesce(p_type, '')) LIKE '%INCENTIVAD%' OR upper(coalesce(p_name, '') || ' ' || coalesce(p_type, '')) LIKE '%INFRA%')"


@query(
    "scl14_tax_treatment", "SCL-14 SCL-15",
    f"""SELECT p_partkey, CASE WHEN {EXEMPT_SQL} THEN 1.0::DOUBLE WHEN p_size > 25 THEN 0.5 ELSE 0.0 END AS efficiency,
      CASE WHEN {EXEMPT_SQL} THEN 'isento_pf_incentivado' WHEN p_size > 25 THEN 'tabela_regressiva_longo_prazo' ELSE 'tabela_regressiva' END AS regime
      FROM (SELECT * REPLACE (CASE WHEN p_brand < 'Brand#15' THEN p_name || ' infraestrutura' ELSE p_name END AS p_name) FROM part)""",
)
def _(t: Tables):
    name = F.when(F.col("p_brand") < "Brand#15", F.concat("p_name", F.lit(" infraestrutura"))).otherwise(F.col("p_name"))
    flag = F.when(F.col("p_size") > 25, "S").otherwise("N")
    return t.part.select(
        "p_partkey", tax_efficiency(name, F.col("p_type"), flag).alias("efficiency"),
        tax_regime(name, F.col("p_type"), flag).alias("regime"),
    )


@query(
    "scl16_track_record", "SCL-16",
    f"""SELECT c_custkey, {r6(f"date_diff('day', coalesce(CASE WHEN c_acctbal >= 0 THEN first_date - 1000 END, first_date), DATE '{REFERENCE}') / 365.25", 'years')}
      FROM customer JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_date FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def _(t: Tables):
    seen = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").cast("date").alias("first_date"))
    started = F.when(F.col("c_acctbal") >= 0, F.date_sub("first_date", 1000))
    return t.customer.join(seen, "c_custkey").select(
        "c_custkey", track_record(started, F.col("first_date"), F.lit(REFERENCE)).alias("years")
    )


@query(
    "scl17_window_starts", "SCL-17 SRC-12",
    """SELECT d AS reference, CAST(CAST(d - INTERVAL 12 MONTH AS DATE) + 1 AS DATE) AS start_12, CAST(CAST(d - INTERVAL 1 MONTH AS DATE) + 1 AS DATE) AS start_1
      FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def _(t: Tables):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("reference")).distinct()
    return days.select(
        "reference", window_start(F.col("reference"), 12).alias("start_12"), window_start(F.col("reference"), 1).alias("start_1")
    )


@query(
    "src12_months_touched", "SRC-12",
    f"""SELECT strftime(l_shipdate, '%Y%m') AS month, count(*) AS n FROM lineitem
      WHERE strftime(l_shipdate, '%Y%m') BETWEEN '{START:%Y%m}' AND '{REFERENCE:%Y%m}' GROUP BY 1""",
)
def _(t: Tables):
    month = F.date_format("l_shipdate", "yyyyMM")
    return t.lineitem.select(month.alias("month")).filter(F.col("month").isin(months_touched(START, REFERENCE))).groupBy(
        "month"
    ).agg(F.count(F.lit(1)).alias("n"))


# --- deduplication and sets ----------------------------------------------

LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(
    "ded1_last_row_per_key", "DED-1 DED-3 WIN-8",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {columns_r6('l_quantity', 'l_extendedprice')}, CAST(l_shipdate AS DATE) AS day
      FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c.strip() + ' DESC' for c in LINE_ORDER.split(','))}) = 1""",
)
def _(t: Tables):
    order = [F.col(c.strip()) for c in LINE_ORDER.split(",")]
    last = last_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], order)
    return last.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("day"),
    )


@query("ded4_distinct_keys", "DED-4", "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def _(t: Tables):
    return distinct_keys(t.lineitem, ["l_orderkey", "l_suppkey"])


@query(
    "set2_diagonal_union", "SET-2",
    f"""SELECT o_custkey AS key, {r6('o_totalprice', 'amount')}, NULL::VARCHAR AS segment FROM orders
      UNION ALL SELECT c_custkey, {r6('c_acctbal', 'amount')}, c_mktsegment FROM customer""",
)
def _(t: Tables):
    return union_drifting(
        [
            t.orders.select(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("amount")),
            t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("segment")),
        ]
    )


@query(
    "set3_union_distinct", "SET-3",
    "SELECT l_suppkey AS key FROM lineitem UNION SELECT c_custkey FROM customer",
)
def _(t: Tables):
    return union_distinct(t.lineitem.select(F.col("l_suppkey").alias("key")), t.customer.select(F.col("c_custkey").alias("key")))


@query(
    "set4_except_keys", "SET-4 JN-5",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def _(t: Tables):
    return except_keys(t.documents.select("doc_id", "lang", "source"), t.labels, ["doc_id"])


@query(
    "sco11_combined_terms", "SCO-11 JN-5 DED-3 PRJ-6",
    with_clause(filings_sql("f", "F"), filings_sql("o", "O"), """p AS (SELECT * FROM f WHERE fee IS NOT NULL AND redemption_days IS NOT NULL AND redemption_days < 25
      QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC) = 1),
      q AS (SELECT * FROM o WHERE fee IS NOT NULL AND redemption_days IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC) = 1)""")
    + f"""SELECT entity, {r6('fee', 'fee')}, redemption_days, 'EXTRATO' AS source FROM p UNION ALL
      SELECT entity, {r6('fee', 'fee')}, redemption_days, 'LAMINA' FROM q WHERE entity NOT IN (SELECT entity FROM p)""",
)
def _(t: Tables):
    primary = t.filings("F").filter("redemption_days < 25")
    both = combine_terms(
        primary, t.filings("O"), "entity", ["fee", "redemption_days"], ("EXTRATO", "LAMINA"), order=[F.col("ts")]
    )
    return both.select("entity", "fee", "redemption_days", "source")


# --- orders --------------------------------------------------------------


@query(
    "ord2_multi_key_order", "ORD-2 WIN-9",
    f"""SELECT o_custkey, o_orderkey, position FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_totalprice DESC, o_orderkey) AS position FROM orders)
      WHERE position <= 3""",
)
def _(t: Tables):
    order = [F.desc("o_orderpriority"), F.desc("o_totalprice"), F.col("o_orderkey")]
    return top_per_group(t.orders, ["o_custkey"], order, 3).select("o_custkey", "o_orderkey", "position")


@query(
    "ord5_listed_order", "ORD-5",
    """SELECT o_orderkey, o_orderpriority, CAST(list_position(['3-MEDIUM', '1-URGENT', '5-LOW'], o_orderpriority) - 1 AS BIGINT) AS list_position FROM orders
      WHERE o_orderpriority IN ('3-MEDIUM', '1-URGENT', '5-LOW')""",
)
def _(t: Tables):
    return in_listed_order(
        t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["3-MEDIUM", "1-URGENT", "5-LOW"]
    )
