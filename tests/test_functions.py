import datetime as dt

import pytest
from pyspark.sql import functions as F

from peervane.functions import dates, keys, numbers, tax
from peervane.functions.uniform import entity_code, hashed_integer, uniform


def column(spark, rows, schema, **expressions):
    frame = spark.createDataFrame(rows, schema)
    return [r.asDict() for r in frame.select(*[e.alias(n) for n, e in expressions.items()]).collect()]


def slow_check(key):
    if len(key) != 14 or not key.isdigit() or key == key[0] * 14:
        return False
    for size, weights in ((12, keys.FIRST_DIGIT_WEIGHTS), (13, keys.SECOND_DIGIT_WEIGHTS)):
        rest = sum(int(key[i]) * weights[i] for i in range(size)) % 11
        if int(key[size]) != (0 if rest < 2 else 11 - rest):
            return False
    return True


def test_check_digits_against_spelled_out_rule(spark):
    candidates = [f"{(i * 7919 * 10**6 + i * i) % 10**14:014d}" for i in range(1, 3000)]
    candidates += ["00017024000153", "00068305000135", "42592315000115", "0" * 14, "1" * 14, "123", "", "12345678901234X"]
    frame = spark.createDataFrame([(c,) for c in candidates], "k string")
    base = F.call_function("div", F.col("k").try_cast("bigint"), F.lit(100).cast("bigint"))
    rows = frame.select("k", keys.check_digits_match(F.col("k")).alias("ok"), keys.closing_digits(base).alias("close")).collect()
    for r in rows:
        assert r["ok"] == slow_check(r["k"]), r
        if len(r["k"]) == 14 and r["k"].isdigit() and r["k"] != r["k"][0] * 14:
            assert slow_check(r["k"][:12] + f"{r['close']:02d}")


def test_cleaning_keeps_digits_and_names_the_problem(spark):
    frame = spark.createDataFrame([("00.017.024/0001-53",), ("123",), ("00017024000154",), (None,)], "raw string")
    rows = keys.with_normalised_key(frame, "raw", "clean", "problem").collect()
    assert [r["clean"] for r in rows] == ["00017024000153", None, None, None]
    assert [r["problem"] for r in rows] == [None, "key must have 14 digits", "key fails its check digits", "key must have 14 digits"]


@pytest.mark.parametrize(
    "reference,months,start",
    [("2025-12-31", 12, "2025-01-01"), ("2025-03-31", 1, "2025-03-01"), ("2024-02-29", 12, "2023-03-01"), ("2025-01-15", 14, "2023-11-16")],
)
def test_window_start(spark, reference, months, start):
    day = dt.date.fromisoformat(reference)
    assert dates.window_start_date(day, months) == dt.date.fromisoformat(start)
    (row,) = column(spark, [(day,)], "d date", s=dates.window_start(F.col("d"), months))
    assert row["s"] == dt.date.fromisoformat(start)


def test_months_and_years_touched():
    assert dates.months_touched(dt.date(2024, 11, 3), dt.date(2025, 2, 1)) == ["202411", "202412", "202501", "202502"]
    assert dates.filing_years(dt.date(2024, 11, 3), dt.date(2025, 2, 1)) == [2023, 2024, 2025]


def test_lenient_parsing(spark):
    rows = column(
        spark, [("2025-12-05", "05/12/2025", "0.055131"), ("2025-02-30", "2025-12-05", "n/d"), (None, None, "")],
        "a string, b string, c string",
        a=dates.iso_date(F.col("a")), b=dates.day_first_date(F.col("b")), c=numbers.percent_to_fraction(F.col("c")),
    )
    assert rows[0] == {"a": dt.date(2025, 12, 5), "b": dt.date(2025, 12, 5), "c": pytest.approx(0.00055131)}
    assert rows[1] == rows[2] == {"a": None, "b": None, "c": None}


def test_whole_numbers_only(spark):
    rows = column(spark, [("12",), ("1.5",), ("x",), (None,)], "a string", a=numbers.to_long(F.col("a")))
    assert [r["a"] for r in rows] == [12, None, None, None]


def test_redemption_days(spark):
    rows = column(
        spark, [(0, 5, "Dias Úteis"), (1, 4, "DIAS UTEIS"), (None, 3, "corridos"), (2, None, None)], "a bigint, b bigint, u string",
        d=numbers.redemption_days(F.col("a"), F.col("b"), F.col("u")),
        n=numbers.redemption_days(F.col("a"), F.col("b"), None),
    )
    assert [r["d"] for r in rows] == [7, 7, 3, 2]
    assert [r["n"] for r in rows] == [5, 5, 3, 2]


def test_gate_cost_trusts_a_believable_declaration(spark):
    rows = column(
        spark, [(0.01, 0.02), (0.0004, 0.015), (None, 0.01), (0.0004, None), (None, None)], "d double, m double",
        c=numbers.gate_cost(F.col("d"), F.col("m"), 0.0005),
    )
    assert [r["c"] for r in rows] == [0.01, 0.015, 0.01, 0.0004, None]


def test_tax_treatment(spark):
    rows = column(
        spark, [("Fundo Infra", "x", "N"), (None, "RF Incentivado", "S"), ("a", "b", "S"), ("a", None, None)], "n string, g string, l string",
        e=tax.tax_efficiency(F.col("n"), F.col("g"), F.col("l")), r=tax.tax_regime(F.col("n"), F.col("g"), F.col("l")),
    )
    assert [r["e"] for r in rows] == [1.0, 1.0, 0.5, 0.0]
    assert [r["r"] for r in rows] == [tax.EXEMPT, tax.EXEMPT, tax.LONG_TERM, tax.ORDINARY]


def test_uniforms_are_even_and_reproducible(spark):
    frame = spark.range(20000).withColumn("c", entity_code(F.col("id") % 50))
    draw = (F.col("id") / 50).cast("int")
    u = uniform(7, draw, F.col("c"), F.lit(3))
    tenths = {r["b"]: r["count"] for r in frame.groupBy(F.floor(u * 10).alias("b")).count().collect()}
    assert sorted(tenths) == list(range(10)) and all(1800 < n < 2200 for n in tenths.values())
    a = frame.select(F.sum(hashed_integer(7, draw, F.col("c"), F.lit(3)))).first()[0]
    assert a == frame.repartition(5).select(F.sum(hashed_integer(7, draw, F.col("c"), F.lit(3)))).first()[0]


def test_streams_of_many_entities_differ(spark):
    """A million entities, each with the uniforms of two draws: a pair that agrees in both shares its stream."""
    code = entity_code(F.col("id"))
    both = spark.range(1_000_000).select(
        code.alias("c"), *[hashed_integer(7, F.lit(d), code, F.lit(0)).alias(f"u{d}") for d in range(2)]
    )
    assert both.select("c").distinct().count() == 1_000_000
    assert both.select("u0", "u1").distinct().count() == 1_000_000
