"""The whole way: the tables as published files, from these files to the final lists."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from peervane.functions.keys import closing_digits
from peervane.plans.run import run
from peervane.session import scratch_path
from peervane.sources.documents import comparison_list
from peervane.streaming.staging import newest_rows, stage_stream, stream_daily_reports
from workload.backtests import RANK_CTES, SETTINGS
from workload.base import (
    HOLDINGS_SQL,
    PANEL_SQL,
    REFERENCE,
    REGISTRY_SQL,
    Tables,
    columns_r6,
    filings_sql,
    query,
    with_clause,
)
from workload.rows import full_key_sql


def keyed_sql(cte: str, name: str, columns: tuple[str, ...]) -> str:
    """A table under another name, and under its own with the published key for every number of an entity."""
    bare = re.sub(rf"\b{name} AS \(", f"bare_{name} AS (", cte, count=1)
    found = f"bare_{name}"
    for c in columns:
        found = f"(SELECT * EXCLUDE (b, key, {c}), key AS {c} FROM {full_key_sql(found, f'''lpad(({c} + 1)::VARCHAR, 12, '0')''')})"
    return f"{bare},\n{name} AS (SELECT * FROM {found})"


KEYED = {
    PANEL_SQL: keyed_sql(PANEL_SQL, "panel", ("entity",)), REGISTRY_SQL: keyed_sql(REGISTRY_SQL, "registry", ("entity",)),
    HOLDINGS_SQL: keyed_sql(HOLDINGS_SQL, "holdings", ("src", "dst")), filings_sql("f", "F"): keyed_sql(filings_sql("f", "F"), "f", ("entity",)),
    filings_sql("o", "O"): keyed_sql(filings_sql("o", "O"), "o", ("entity",)),
}
FILE_CTES = [KEYED.get(c, c).replace("NULL::BIGINT", "NULL::VARCHAR").replace("BIGINT[]", "VARCHAR[]") for c in RANK_CTES]


def key_of(column: str):
    """Twelve digits, a dash and the two digits that close the key; a key of zeros alone is not one, so numbers begin at 1."""
    number = F.col(column).cast("bigint") + 1
    return F.concat(F.lpad(number.cast("string"), 12, "0"), F.lit("-"), F.lpad(closing_digits(number).cast("string"), 2, "0"))


def publish(t: Tables) -> str:
    """A folder of the seven inputs. Some lines of the reports are corrected further down, and some keys are broken."""
    folder = scratch_path(t.spark, "published")

    def put(name: str, rows, order: tuple[str, ...] = ()) -> None:
        if order:
            rows = rows.repartition(rows.columns[0]).sortWithinPartitions(*order).drop("version")
        writer = rows.write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1")
        writer.option("quote", "").option("escapeQuotes", False).csv(f"{folder}/{name}")

    version = F.explode(F.when(F.pmod(F.xxhash64("entity", "ts"), F.lit(9)) == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2))))
    lines = t.panel.select("*", version.alias("version"))
    stale = F.col("version") == 1
    reports = lines.select(
        key_of("entity").alias("CNPJ_FUNDO_CLASSE"), F.lit(None).cast("string").alias("ID_SUBCLASSE"), F.col("ts").alias("DT_COMPTC"),
        F.when(stale, -1.0).otherwise(F.col("price")).alias("VL_QUOTA"), F.col("assets").alias("VL_PATRIM_LIQ"),
        F.col("inflow").alias("CAPTC_DIA"), F.col("outflow").alias("RESG_DIA"), F.col("holders").alias("NR_COTST"), "version",
    )
    broken = reports.filter((F.month("DT_COMPTC") == 5) & (F.year("DT_COMPTC") == 1997) & ~stale).withColumn("CNPJ_FUNDO_CLASSE", F.lit("123"))
    put("reports", reports.unionByName(broken), ("CNPJ_FUNDO_CLASSE", "DT_COMPTC", "version"))
    registry = t.registry
    put("classes", registry.select(
        F.col("entity").alias("ID_Registro_Classe"), F.col("entity").alias("ID_Registro_Fundo"), key_of("entity").alias("CNPJ_Classe"),
        F.col("name").alias("Denominacao_Social"), F.col("status").alias("Situacao"), F.col("classification").alias("Classificacao"),
        F.col("grp").alias("Classificacao_Anbima"), F.col("holds_funds").alias("Classe_Cotas"), F.col("condominium").alias("Forma_Condominio"),
        F.col("exclusive").alias("Exclusivo"), F.col("target_investor").alias("Publico_Alvo"), F.col("long_term").alias("Tributacao_Longo_Prazo"),
    ))
    put("funds", registry.select(
        F.col("entity").alias("ID_Registro_Fundo"), F.col("constituted").cast("string").alias("Data_Constituicao"), F.col("manager").alias("Gestor")
    ))
    terms = lambda status, days, minimum: t.filings(status).select(
        key_of("entity").alias("CNPJ_FUNDO_CLASSE"), F.col("ts").alias("DT_COMPTC"), (F.col("fee") * 100).alias("TAXA_ADM"), F.lit(None).cast("string").alias("TAXA_PERFM"),
        F.col("redemption_days").alias(days), F.lit(0).alias("QT_DIA_PAGTO_RESGATE"), F.col("minimum_investment").alias(minimum),
    )
    put("statements", terms("F", "QT_DIA_CONVERSAO_COTA", "APLIC_MIN"))
    put("factsheets", terms("O", "QT_DIA_CONVERSAO_COTA_RESGATE", "INVEST_INICIAL_MIN"))
    put("holdings", t.holdings.select(
        key_of("src").alias("CNPJ_FUNDO_CLASSE"), key_of("dst").alias("CNPJ_FUNDO_CLASSE_COTA"), F.col("value").alias("VL_MERC_POS_FINAL")
    ))
    entry = F.struct(F.date_format("ts", "dd/MM/yyyy").alias("data"), (F.col("rate") * 100).cast("string").alias("valor"))
    by_year = t.rates.groupBy(F.year("ts").alias("year")).agg(F.collect_list(entry).alias("entries"))
    by_year.select(F.to_json("entries").alias("value"), "year").repartition("year").write.partitionBy("year").text(f"{folder}/rates")
    return folder


@query(
    "src11_files_to_lists", "SRC-11 SRC-1 SRC-2 SRC-3 SRC-4 SRC-5 SRC-6 SRC-8 SRC-9 SCO-12 SNK-4",
    with_clause(*FILE_CTES) + f"""SELECT profile, pick AS rank, entity, pick <= 5 AS delivered, {columns_r6('score', 'pool_score', 'appearance_rate')}
      FROM final_list JOIN survivors USING (profile, entity)""",
)
def _(t: Tables):
    """The inputs of `sco12_ranked_profiles` written as text, read, triaged, checked and ranked; investor profiles are missing."""
    made = run(t.spark, publish(t), SETTINGS, REFERENCE)
    return comparison_list(made.ranking.listed)


HEADER = ("CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "VL_QUOTA", "VL_PATRIM_LIQ", "NR_COTST")
STREAMED_SQL = f"""numbered AS (SELECT *, month(ts) AS m FROM {full_key_sql("(SELECT entity + 1 AS number, * FROM panel)", "lpad(number::VARCHAR, 12, '0')")}),
last AS (SELECT key, ts, CASE WHEN m % 4 = 3 THEN -1 WHEN m % 2 = 1 THEN price * 2 ELSE price END AS price, assets, holders FROM numbered)"""


@query(
    "snk1_streamed_restatements", "SNK-1 DED-3 SCL-8",
    with_clause(PANEL_SQL, STREAMED_SQL) + f"""SELECT key AS entity, ts, holders, {columns_r6('price', 'assets')} FROM last WHERE price > 0 AND ts <= DATE '{REFERENCE}'""",
)
def _(t: Tables):
    """The panel arrives in three batches: all of it, every odd month at twice the price, and every fourth month without a usable price."""
    spark = t.spark
    incoming, target, checkpoint = (scratch_path(spark, name) for name in ("incoming", "streamed", "progress"))
    month = F.month("ts")
    parts = [t.panel, t.panel.filter(month % 2 == 1).withColumn("price", F.col("price") * 2), t.panel.filter(month % 4 == 3).withColumn("price", F.lit(-1.0))]
    for number, part in enumerate(parts):
        lines = part.select(
            key_of("entity").alias("CNPJ_FUNDO_CLASSE"), F.lit(None).cast("string").alias("ID_SUBCLASSE"), F.col("ts").alias("DT_COMPTC"),
            F.col("price").alias("VL_QUOTA"), F.col("assets").alias("VL_PATRIM_LIQ"), F.col("holders").alias("NR_COTST"),
        )
        writer = lines.write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").option("quote", "")
        writer.option("escapeQuotes", False).csv(f"{incoming}/part={number}")
        query = stage_stream(stream_daily_reports(spark, f"{incoming}/*", list(HEADER)), target, checkpoint, REFERENCE)
        query.awaitTermination()
    return newest_rows(spark, target).select("entity", "ts", "holders", "price", "assets")
