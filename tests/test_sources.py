import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peervane.sources import documents as dc
from peervane.sources import filings as fl
from peervane.sources import staged as sg
from peervane.sources.text import read_delimited, union_drifting
from peervane.streaming.staging import newest_rows, stage_stream, stream_daily_reports

HEADER = "TP_FUNDO_CLASSE;CNPJ_FUNDO_CLASSE;ID_SUBCLASSE;DT_COMPTC;VL_TOTAL;VL_QUOTA;VL_PATRIM_LIQ;CAPTC_DIA;RESG_DIA;NR_COTST"


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def put(folder, name, *lines):
    path = f"{folder}/{name}"
    with open(path, "wb") as out:
        out.write(("\n".join(lines) + "\n").encode("latin-1"))
    return path


def test_stray_quotes_accents_and_ragged_lines(spark, folder):
    path = put(folder, "t.csv", "A;B;C", 'São "Paulo;x;1', "Ação;y;2;extra", "Pé;z")
    got = sorted(tuple(r) for r in read_delimited(spark, path).collect())
    assert got == sorted([('São "Paulo', "x", "1"), ("Ação", "y", "2"), ("Pé", "z", None)])


def daily(folder, name="d.csv"):
    return put(
        folder, name, HEADER,
        "FI;00.017.024/0001-53;;2025-10-01;1;10.5;100;1;2;7", "FI;00068305000135; ;2025-10-01;;;n/d;;;1.5",
        "FI;00068305000135;S1;2025-10-01;1;1;1;1;1;1", "FI;00068305000135;;2025-13-01;1;1;1;1;1;1",
    )


def test_daily_report(spark, folder):
    got = fl.read_daily_report(spark, daily(folder)).orderBy(F.col("price").desc()).collect()
    assert len(got) == 3 and "subclass" not in got[0].asDict()
    assert got[0]["entity"] == "00017024000153" and got[0]["ts"] == dt.date(2025, 10, 1)
    assert (got[0]["price"], got[0]["holders"]) == (10.5, 7)
    assert got[1]["ts"] is None
    assert (got[2]["price"], got[2]["assets"], got[2]["holders"]) == (None, None, None)


def test_old_layout_is_refused(spark, folder):
    with pytest.raises(fl.UnsupportedLayoutError):
        fl.read_daily_report(spark, put(folder, "old.csv", "CNPJ_FUNDO;DT_COMPTC", "1;2023-01-01"))


def test_releases_of_other_column_order_are_matched_by_name(spark, folder):
    one = daily(folder)
    moved = "ID_SUBCLASSE;CNPJ_FUNDO_CLASSE;DT_COMPTC;VL_PATRIM_LIQ;VL_QUOTA;NR_COTST"
    two = put(folder, "e.csv", moved, ";00017024000153;2025-10-02;500;10.75;9")
    got = {r["ts"]: r for r in fl.read_daily_report(spark, [one, two]).filter("price IS NOT NULL AND ts IS NOT NULL").collect()}
    row = got[dt.date(2025, 10, 2)]
    assert (row["price"], row["assets"], row["holders"], row["inflow"]) == (10.75, 500.0, 9, None)
    assert got[dt.date(2025, 10, 1)]["price"] == 10.5
    with pytest.raises(fl.UnsupportedLayoutError):
        fl.read_daily_report(spark, [one, put(folder, "old.csv", "CNPJ_FUNDO;DT_COMPTC", "1;2023-01-01")])


def test_a_folder_of_unequal_headers_is_refused(spark, folder):
    put(folder, "a.csv", "A;B", "1;2")
    put(folder, "b.csv", "B;A", "2;1")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, folder).collect()


def test_registry_keeps_the_last_repeat_and_every_class(spark, folder):
    classes = put(folder, "c.csv", "ID_Registro_Fundo;ID_Registro_Classe;CNPJ_Classe;Denominacao_Social;Data_Inicio;Patrimonio_Liquido", "1;10;11.111.111/0001-11;Um;2025-01-01;5.5", "1;11;2;Dois;x;y", "9;12;3;Três;;", "1;10;4;Um corrigido;2025-01-02;6")
    funds = put(folder, "f.csv", "ID_Registro_Fundo;CNPJ_Fundo;Denominacao_Social;Data_Constituicao;Gestor", "1;5;Velho;2001-01-01;A", "1;5;Novo;2002-01-01;B")
    got = {r["class_id"]: r for r in fl.with_age(fl.read_registry(spark, classes, funds), dt.date(2025, 12, 31)).collect()}
    assert set(got) == {"10", "11", "12"}
    assert got["10"]["name"] == "Um corrigido" and got["10"]["manager"] == "B"
    assert got["10"]["age_years"] == pytest.approx((dt.date(2025, 12, 31) - dt.date(2002, 1, 1)).days / 365.25)
    assert got["12"]["manager"] is None and got["11"]["started"] is None


def test_terms_of_both_filings(spark, folder):
    statement = put(folder, "s.csv", "CNPJ_FUNDO_CLASSE;DT_COMPTC;TAXA_ADM;TAXA_PERFM;QT_DIA_CONVERSAO_COTA;QT_DIA_PAGTO_RESGATE;TP_DIA_PAGTO_RESGATE;APLIC_MIN", "1;2025-01-01;0.20;;1;4;DIAS ÚTEIS;100", "2;2025-01-01;x;;0;3;;")
    a, b = fl.read_statement(spark, statement).orderBy("entity").collect()
    assert (a["fee"], a["redemption_days"], a["minimum_investment"]) == (pytest.approx(0.002), 7, 100.0)
    assert (b["fee"], b["redemption_days"]) == (None, 3)
    factsheet = put(folder, "l.csv", "CNPJ_FUNDO_CLASSE;ID_SUBCLASSE;DT_COMPTC;TAXA_ADM;TAXA_PERFM;QT_DIA_CONVERSAO_COTA_RESGATE;QT_DIA_PAGTO_RESGATE;INVEST_INICIAL_MIN", "1;;2025-01-01;1;;1;4;1", "1;S;2025-01-01;1;;1;4;1")
    (row,) = fl.read_factsheet(spark, factsheet).collect()
    assert (row["fee"], row["redemption_days"]) == (0.01, 5)


def test_holders_holdings_and_rates(spark, folder):
    holders = put(folder, "p.csv", "CNPJ_FUNDO_CLASSE;NR_COTST_PF_VAREJO;NR_COTST_PF_PB;NR_COTST_DISTRIB;X", "1;2;3;;9", "2;;;4;9")
    assert [tuple(r) for r in fl.read_investor_profile(spark, holders).orderBy("entity").collect()] == [("1", 5.0, 0.0), ("2", 0.0, 4.0)]
    holdings = put(folder, "h.csv", "CNPJ_FUNDO_CLASSE;CNPJ_FUNDO_CLASSE_COTA;VL_MERC_POS_FINAL", "1;00.017.024/0001-53;5", "1;;5", "1;00017024000153;", "1;123;5")
    assert [tuple(r) for r in fl.read_holdings(spark, holdings).collect()] == [("1", "00017024000153", 5.0)]
    path = f"{folder}/r.json"
    with open(path, "w") as out:
        json.dump([{"data": "05/12/2025", "valor": "0.055131"}, {"data": "04/12/2025", "valor": "x"}], out)
    got = fl.read_rates(spark, path).collect()
    assert [r["ts"] for r in got] == [dt.date(2025, 12, 4), dt.date(2025, 12, 5)]
    assert got[0]["rate"] is None and got[1]["rate"] == pytest.approx(0.00055131)


def test_staging_parses_each_content_once(spark, folder):
    path, target = daily(folder), f"{folder}/staged"
    assert sg.stage_daily(spark, {"202510": path}, target, fl.read_daily_report) == ["202510"]
    assert sg.stage_daily(spark, {"202510": path}, target, fl.read_daily_report) == []
    before = spark.createDataFrame(sg.fingerprints(spark, path).drop("path").collect())
    put(folder, "d.csv", HEADER, "FI;00017024000153;;2025-10-02;1;11;100;1;2;7")
    assert sg.stage_daily(spark, {"202510": path}, target, fl.read_daily_report) == ["202510"]
    now = sg.fingerprints(spark, path)
    assert {r["state"] for r in sg.changed_inputs(before, now).collect()} == {"changed"}
    staged = sg.read_months(spark, target, dt.date(2025, 10, 1), dt.date(2025, 10, 31))
    assert staged.count() == 4
    assert [r["price"] for r in sg.current_rows(staged, now).collect()] == [11.0]
    assert sg.read_months(spark, target, dt.date(2024, 1, 1), dt.date(2024, 2, 1)).count() == 0


def test_months_of_equal_file_names_are_told_apart(spark, folder):
    other, target = tempfile.mkdtemp(prefix="spark-", dir="/tmp"), f"{folder}/staged"
    line = "FI;00017024000153;;2025-1{};1;{};100;1;2;7"
    paths = {"202510": put(folder, "inf.csv", HEADER, line.format("0-02", 11)), "202511": put(other, "inf.csv", HEADER, line.format("1-03", 12))}
    assert sg.stage_daily(spark, paths, target, fl.read_daily_report) == ["202510", "202511"]
    put(other, "inf.csv", HEADER, line.format("1-03", 13))
    assert sg.stage_daily(spark, paths, target, fl.read_daily_report) == ["202511"]
    current = sg.current_rows(spark.read.parquet(target), sg.fingerprints(spark, list(paths.values())))
    assert sorted(r["price"] for r in current.collect()) == [11.0, 13.0]


def test_optional_inputs_become_empty_tables(spark, folder):
    schema = T.StructType([T.StructField("entity", T.StringType())])
    assert sg.read_or_empty(spark, f"{folder}/absent.csv", fl.read_holdings, schema).count() == 0


def test_drifting_releases_union(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, old string"), spark.createDataFrame([(2, "y")], "k int, new string")
    assert [tuple(r) for r in union_drifting([a, b]).orderBy("k").collect()] == [(1, "x", None), (2, None, "y")]


def test_quarantine_is_written_by_reason(spark, folder):
    rows = spark.createDataFrame([("a", "r1"), ("b", "r2"), ("c", "r1")], "k string, reason string")
    sg.write_quarantine(rows, f"{folder}/q")
    assert spark.read.parquet(f"{folder}/q").filter("reason = 'r1'").count() == 2


def test_streamed_reports_are_split_and_not_read_twice(spark, folder):
    incoming = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    daily(incoming, "one.csv")
    rows = stream_daily_reports(spark, incoming, HEADER.split(";"))
    for _ in range(2):
        query = stage_stream(rows, f"{folder}/out", f"{folder}/checkpoint", dt.date(2025, 12, 31))
        query.awaitTermination(120)
        assert query.exception() is None
    clean = spark.read.parquet(f"{folder}/out/clean")
    assert [r["entity"] for r in clean.collect()] == ["00017024000153"]
    assert spark.read.parquet(f"{folder}/out/quarantine").count() == 2
    counts = {r["disposition"]: r["n_rows"] for r in spark.read.parquet(f"{folder}/out/accounting").collect()}
    assert counts["clean"] == 1 and counts["quarantined"] == 2


def test_a_later_batch_restates_and_takes_back(spark, folder):
    incoming = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    line = "FI;00017024000153;;2025-10-{:02d};1;{};100;1;2;7"
    for name, lines in (("a.csv", [(1, 10), (1, 11), (2, 20), (3, 30)]), ("b.csv", [(2, 21), (3, -1)]), ("c.csv", [(4, 40), (28, 50)])):
        put(incoming, name, HEADER, *[line.format(*x) for x in lines])
        rows = stream_daily_reports(spark, incoming, HEADER.split(";"))
        query = stage_stream(rows, f"{folder}/out", f"{folder}/checkpoint", dt.date(2025, 10, 27))
        query.awaitTermination(120)
        assert query.exception() is None
    got = {r["ts"].day: r["price"] for r in newest_rows(spark, f"{folder}/out").collect()}
    assert got == {1: 11.0, 2: 21.0, 4: 40.0}
    assert spark.read.parquet(f"{folder}/out/future").count() == 1


def test_document_fields_are_sorted_and_checked(spark, folder):
    good = spark.sql("SELECT 'p' AS profile, 2 AS top_n, array(named_struct('rank', 1, 'entity', 'a'), named_struct('rank', 2, 'entity', 'b')) AS top")
    assert dc.sorted_fields(good).schema["top"].dataType.elementType.names == ["entity", "rank"]
    dc.write_document(dc.sorted_fields(good), f"{folder}/doc")
    assert json.loads(spark.read.text(f"{folder}/doc").first()[0])["top"][1] == {"entity": "b", "rank": 2}
    with pytest.raises(dc.DocumentError):
        dc.validate_document(good.withColumn("top_n", F.lit(1)))
    for rank in ("1", "3", "CAST(NULL AS INT)"):
        with pytest.raises(dc.DocumentError):
            dc.validate_document(good.withColumn("top", F.expr(f"transform(top, (t, i) -> named_struct('rank', if(i = 0, 1, {rank}), 'entity', t.entity))")))
