"""Round trips through files: the panel as published text, staged and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from peervane.functions.keys import closing_digits
from peervane.operators.triage import quarantine
from peervane.session import scratch_path
from peervane.sources.filings import (
    read_daily_report,
    read_factsheet,
    read_holdings,
    read_investor_profile,
    read_rates,
    read_registry,
    read_registry_classes,
    read_registry_funds,
    read_statement,
)
from peervane.sources.staged import current_rows, fingerprints, read_months, stage_daily, write_quarantine
from workload.base import (
    PANEL_SQL,
    RATES_SQL,
    REFERENCE,
    REGISTRY_SQL,
    SERIES_SQL,
    START,
    Tables,
    columns_r6,
    filings_sql,
    query,
    r6,
    with_clause,
)
from workload.rows import RAW_SQL, full_key_sql, judged_report


def published_panel(t: Tables):
    """The panel under the published headers, keys dotted, every tenth of a name accented."""
    key = F.concat(
        F.lpad(F.col("entity").cast("string"), 12, "0"),
        F.lit("-"),
        F.lpad(closing_digits(F.col("entity").cast("bigint")).cast("string"), 2, "0"),
    )
    return t.panel.select(
        F.lit('Fundação "FI').alias("TP_FUNDO_CLASSE"), key.alias("CNPJ_FUNDO_CLASSE"),
        F.when(F.col("price") > 1600, "S1").alias("ID_SUBCLASSE"), F.col("ts").alias("DT_COMPTC"),
        F.col("assets").alias("VL_TOTAL"), F.col("price").alias("VL_QUOTA"), F.col("assets").alias("VL_PATRIM_LIQ"),
        F.col("inflow").alias("CAPTC_DIA"), F.col("outflow").alias("RESG_DIA"), F.col("holders").alias("NR_COTST"),
    )


@query(
    "src2_daily_report_text", "SRC-1 SRC-2 FLT-1 PRJ-1 PRJ-2 SCL-1 SCL-4",
    with_clause(PANEL_SQL) + f"""SELECT key AS entity, ts, 'Fundação "FI' AS kind, holders, {r6('price', 'price')}, {r6('assets', 'assets')},
      {r6('assets', 'portfolio_value')}, {r6('inflow', 'inflow')}, {r6('outflow', 'outflow')} FROM {full_key_sql('panel', "lpad(entity::VARCHAR, 12, '0')")} WHERE price <= 1600""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "report")
    writer = published_panel(t).write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1")
    writer.option("quote", "").option("escapeQuotes", False).csv(path)
    return read_daily_report(t.spark, path)


@query(
    "src1_drifting_releases", "SRC-1 SRC-2",
    with_clause(PANEL_SQL) + f"""SELECT key AS entity, ts, CASE WHEN ts <= DATE '{REFERENCE}' THEN holders END AS holders, {r6('price', 'price')}, {r6('assets', 'assets')}
      FROM {full_key_sql('panel', "lpad(entity::VARCHAR, 12, '0')")} WHERE price <= 1600""",
)
def _(t: Tables):
    """Two releases of the panel: the later one has its columns in another order and no holders."""
    columns = ["CNPJ_FUNDO_CLASSE", "DT_COMPTC", "ID_SUBCLASSE", "VL_QUOTA", "VL_PATRIM_LIQ", "NR_COTST"]
    panel = published_panel(t)
    late = F.col("DT_COMPTC") > F.lit(REFERENCE)
    paths = [scratch_path(t.spark, name) for name in ("early", "late")]
    for rows, names, path in ((panel.filter(~late), columns, paths[0]), (panel.filter(late), columns[4::-1], paths[1])):
        writer = rows.select(*names).write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1")
        writer.option("quote", "").option("escapeQuotes", False).csv(path)
    found = read_daily_report(t.spark, paths)
    return found.select("entity", "ts", "holders", "price", "assets")


@query(
    "src9_rates_json_array", "SRC-9 SCL-4 SCL-5",
    with_clause(RATES_SQL) + f"SELECT ts, {r6('rate', 'rate')} FROM rates",
)
def _(t: Tables):
    """Rates as a published array of day-first dates and percentages."""
    path = scratch_path(t.spark, "rates")
    entry = F.struct(F.date_format("ts", "dd/MM/yyyy").alias("data"), (F.col("rate") * 100).cast("string").alias("valor"))
    by_year = t.rates.groupBy(F.year("ts").alias("year")).agg(F.collect_list(entry).alias("entries"))
    by_year.select(F.to_json("entries").alias("value"), "year").repartition("year").write.partitionBy("year").text(path)
    return read_rates(t.spark, path).select("ts", "rate")


@query(
    "src10_staged_months", "SRC-10 SRC-12 FLT-8",
    with_clause(PANEL_SQL, SERIES_SQL) + f"SELECT entity, ts, {columns_r6('price', 'assets')} FROM series",
)
def _(t: Tables):
    path = scratch_path(t.spark, "months")
    monthly = t.panel.withColumn("month", F.date_format("ts", "yyyyMM"))
    spread = F.pmod(F.xxhash64("entity"), F.lit(8))
    monthly.repartition("month", spread).write.partitionBy("month").parquet(path)
    return read_months(t.spark, path, START, REFERENCE).select("entity", "ts", "price", "assets")


@query(
    "snk2_fingerprints", "SNK-2",
    """SELECT doc_id // 100 AS part, sha256(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id)) AS sha256, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS size_bytes
      FROM documents GROUP BY 1""",
)
def _(t: Tables):
    """A file of whole texts for every hundred documents, hashed by the task that reads it."""
    path = scratch_path(t.spark, "texts")
    lines = t.documents.select(
        F.floor(F.col("doc_id") / 100).alias("part"), "doc_id", F.coalesce("text", F.lit("")).alias("value")
    )
    ordered = lines.repartition("part").sortWithinPartitions("part", "doc_id")
    ordered.select("part", "value").write.partitionBy("part").text(path)
    part = F.regexp_extract("path", "part=([0-9]+)", 1).cast("bigint")
    return fingerprints(t.spark, f"{path}/part=*").select(part.alias("part"), "sha256", "size_bytes")


def published(t: Tables, rows, label: str, order: str | None = None) -> str:
    """The path of a published text of `rows`; lines of one key stay in one file, in the order given."""
    path = scratch_path(t.spark, label)
    if order is not None:
        rows = rows.repartition(rows.columns[0]).sortWithinPartitions(order).drop(order)
    writer = rows.write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1")
    writer.option("quote", "").option("escapeQuotes", False).csv(path)
    return path


def key_text(column: str):
    return F.lpad(F.col(column).cast("string"), 14, "0")


def published_classes(t: Tables) -> str:
    """Suppliers as classes; every fifth is listed twice, and its later line corrects the name and the start."""
    version = F.explode(F.when(F.col("entity") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))).alias("version")
    rows = t.registry.join(t.supplier.select(F.col("s_suppkey").alias("entity"), "s_nationkey", "s_acctbal"), "entity").select("*", version)
    early = F.col("version") == 1
    return published(t, rows.select(
        F.col("entity").alias("ID_Registro_Classe"), F.col("s_nationkey").alias("ID_Registro_Fundo"), key_text("entity").alias("CNPJ_Classe"),
        F.when(early, "Razão antiga").otherwise(F.col("name")).alias("Denominacao_Social"), F.col("status").alias("Situacao"),
        F.when(early, F.lit("no date")).otherwise(F.col("constituted").cast("string")).alias("Data_Inicio"),
        F.col("classification").alias("Classificacao"), F.col("target_investor").alias("Publico_Alvo"), F.col("exclusive").alias("Exclusivo"),
        F.col("s_acctbal").alias("Patrimonio_Liquido"), F.lit("x").alias("Outra_Coluna"), "version",
    ), "classes", "version")


CLASSES_SQL = "classes AS (SELECT r.*, s_nationkey, s_acctbal FROM registry r JOIN supplier ON s_suppkey = entity)"


@query(
    "src3_registry_classes", "SRC-3 DED-3",
    with_clause(REGISTRY_SQL, CLASSES_SQL) + f"""SELECT entity::VARCHAR AS class_id, s_nationkey::VARCHAR AS fund_id, lpad(entity::VARCHAR, 14, '0') AS entity, name, status, constituted AS started,
      classification, target_investor, exclusive, {r6('s_acctbal', 'registered_assets')} FROM classes""",
)
def _(t: Tables):
    return read_registry_classes(t.spark, published_classes(t))


def published_funds(t: Tables) -> str:
    """Nations as funds, listed twice each; the seventh is not listed at all."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).filter("n_name <> 'NATION_7'")
    return published(t, nations.select(
        F.col("n_nationkey").alias("ID_Registro_Fundo"), key_text("n_nationkey").alias("CNPJ_Fundo"), F.col("n_name").alias("Denominacao_Social"),
        F.date_sub(F.lit(REFERENCE), F.col("n_nationkey").cast("int") * 100).cast("string").alias("Data_Constituicao"),
        F.explode(F.array(F.lit("Gestão antiga"), F.col("r_name"))).alias("Gestor"),
    ).withColumn("version", F.when(F.col("Gestor") == "Gestão antiga", 1).otherwise(2)), "funds", "version")


FUNDS_SQL = f"""parents AS (SELECT n_nationkey::VARCHAR AS fund_id, lpad(n_nationkey::VARCHAR, 14, '0') AS fund_key, n_name AS fund_name,
  DATE '{REFERENCE}' - CAST(n_nationkey * 100 AS INTEGER) AS constituted, r_name AS manager FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name <> 'NATION_7')"""


@query("src4_registry_funds", "SRC-4 DED-3", with_clause(FUNDS_SQL) + "SELECT * FROM parents")
def _(t: Tables):
    return read_registry_funds(t.spark, published_funds(t))


@query(
    "src4_classes_with_parents", "SRC-3 SRC-4 JN-1",
    with_clause(REGISTRY_SQL, CLASSES_SQL, FUNDS_SQL) + """SELECT lpad(c.entity::VARCHAR, 14, '0') AS entity, c.name, p.fund_name, p.manager, p.constituted
      FROM classes c LEFT JOIN parents p ON p.fund_id = c.s_nationkey::VARCHAR""",
)
def _(t: Tables):
    found = read_registry(t.spark, published_classes(t), published_funds(t))
    return found.select("entity", "name", "fund_name", "manager", "constituted")


def filed_terms(t: Tables, conversion: str, minimum: str):
    """The monthly terms of every supplier as filed: percentages, and business days for every other supplier."""
    return t.filings().select(
        key_text("entity").alias("CNPJ_FUNDO_CLASSE"), F.col("ts").alias("DT_COMPTC"), (F.col("fee") * 100).cast("string").alias("TAXA_ADM"),
        F.when(F.col("entity") % 3 == 0, "n/d").otherwise("20").alias("TAXA_PERFM"), F.col("redemption_days").alias(conversion),
        F.lit(3).alias("QT_DIA_PAGTO_RESGATE"), F.when(F.col("entity") % 2 == 0, "DIAS ÚTEIS").otherwise("DIAS CORRIDOS").alias("TP_DIA_PAGTO_RESGATE"),
        F.col("minimum_investment").alias(minimum),
        F.when(F.month("ts") == 7, "S1").alias("ID_SUBCLASSE"),
    )


FILED_SQL = f"""SELECT lpad(entity::VARCHAR, 14, '0') AS entity, ts, redemption_days AS conversion_days, 3::BIGINT AS payment_days,
  CASE WHEN entity % 2 = 0 THEN 'DIAS ÚTEIS' ELSE 'DIAS CORRIDOS' END AS day_unit, {columns_r6('fee', 'minimum_investment')},
  {r6('CASE WHEN entity % 3 <> 0 THEN 0.2 END', 'performance_fee')},
  CASE WHEN entity % 2 = 0 THEN CAST(ceil((redemption_days + 3) * 7 / 5.0::DOUBLE) AS BIGINT) ELSE redemption_days + 3 END AS redemption_days FROM f"""


@query("src5_statements", "SRC-5 SCL-6", with_clause(filings_sql("f")) + FILED_SQL)
def _(t: Tables):
    return read_statement(t.spark, published(t, filed_terms(t, "QT_DIA_CONVERSAO_COTA", "APLIC_MIN"), "statements"))


@query("src6_factsheets", "SRC-6 FLT-1 SCL-6", with_clause(filings_sql("f")) + FILED_SQL + " WHERE month(ts) <> 7")
def _(t: Tables):
    """The other filing has other headers, and lines of subclasses that are left out."""
    return read_factsheet(t.spark, published(t, filed_terms(t, "QT_DIA_CONVERSAO_COTA_RESGATE", "INVEST_INICIAL_MIN"), "factsheets"))


@query(
    "src7_investor_profiles", "SRC-7",
    """SELECT lpad(l_suppkey::VARCHAR, 14, '0') AS entity, (count(*) FILTER (WHERE l_returnflag = 'A') + count(*) FILTER (WHERE l_returnflag = 'R'))::DOUBLE AS individuals,
      CASE WHEN count(*) % 2 = 0 THEN count(*) ELSE 0 END::DOUBLE AS distributors FROM lineitem GROUP BY l_suppkey""",
)
def _(t: Tables):
    """Counts of each supplier's lines; blank and unreadable ones count as zero."""
    lines = t.lineitem.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "A").alias("a"), F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count(F.lit(1)).alias("n")
    )
    rows = lines.select(
        key_text("l_suppkey").alias("CNPJ_FUNDO_CLASSE"), F.col("a").alias("NR_COTST_PF_VAREJO"), F.nullif("r", F.lit(0)).alias("NR_COTST_PF_PB"),
        F.when(F.col("n") % 2 == 0, F.col("n").cast("string")).otherwise("n/d").alias("NR_COTST_DISTRIB"),
    )
    return read_investor_profile(t.spark, published(t, rows, "profiles"))


@query(
    "src8_holdings", "SRC-8",
    f"""SELECT lpad(l_suppkey::VARCHAR, 14, '0') AS src, lpad(l_partkey::VARCHAR, 14, '0') AS dst, {r6('sum(l_extendedprice)', 'value')}
      FROM lineitem WHERE l_partkey % 7 <> 0 AND l_partkey % 11 <> 0 GROUP BY l_suppkey, l_partkey""",
)
def _(t: Tables):
    """What each supplier holds of each part; positions that name no fund or carry no value are left out."""
    held = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_extendedprice").alias("value"))
    named = F.when(F.col("l_partkey") % 7 == 0, F.col("l_partkey").cast("string")).otherwise(key_text("l_partkey"))
    rows = held.select(
        key_text("l_suppkey").alias("CNPJ_FUNDO_CLASSE"), named.alias("CNPJ_FUNDO_CLASSE_COTA"),
        F.when(F.col("l_partkey") % 11 != 0, F.col("value")).alias("VL_MERC_POS_FINAL"),
    )
    return read_holdings(t.spark, published(t, rows, "holdings"))


def one_file(t: Tables, rows, label: str) -> str:
    """The whole path of a text written as a single file: a report is one file to those who publish it."""
    folder = published(t, rows.coalesce(1), label)
    return t.spark.read.format("binaryFile").load(folder).select("path").first()[0]


RESTATED = 1998


@query(
    "snk1_restated_reports", "SNK-1 SNK-2 SNK-3",
    with_clause(PANEL_SQL) + f"""SELECT key AS entity, ts, holders, {r6(f'CASE WHEN year(ts) = {RESTATED} THEN 2 * price ELSE price END', 'price')}
      FROM {full_key_sql('panel', "lpad(entity::VARCHAR, 12, '0')")} WHERE price <= 1600""",
)
def _(t: Tables):
    """A report a year is staged, one is published again with other prices and staged beside it: the manifest names the newer."""
    panel = published_panel(t)
    years = [r[0] for r in panel.select(F.year("DT_COMPTC").alias("y")).distinct().orderBy("y").collect()]
    reports = {f"{y}01": one_file(t, panel.filter(F.year("DT_COMPTC") == y), f"report-{y}") for y in years}
    target = scratch_path(t.spark, "staged")
    stage_daily(t.spark, reports, target, read_daily_report)
    again = panel.filter(F.year("DT_COMPTC") == RESTATED).withColumn("VL_QUOTA", F.col("VL_QUOTA") * 2)
    reports[f"{RESTATED}01"] = one_file(t, again, "restated")
    stage_daily(t.spark, reports, target, read_daily_report)
    staged = t.spark.read.parquet(target)
    return current_rows(staged, fingerprints(t.spark, list(reports.values()))).select("entity", "ts", "holders", "price")


@query(
    "snk8_quarantine_by_reason", "SNK-8",
    with_clause(RAW_SQL) + f"SELECT reason, key, ts, seq, {columns_r6('price', 'assets')} FROM fated WHERE disposition = 'quarantined'",
)
def _(t: Tables):
    """Rejected rows as they are found again under their reason."""
    path = scratch_path(t.spark, "quarantine")
    write_quarantine(quarantine(judged_report(t)), path)
    return t.spark.read.parquet(path)
