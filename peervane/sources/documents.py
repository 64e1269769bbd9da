"""Published results: the nested ranking document and its tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the version of the published document.
SCHEMA_VERSION = "1.1.0"

LISTED_VALUES = (
    "total_return", "excess_return", "volatility", "return_per_risk", "max_drawdown", "negative_days",
    "fee", "declared_fee", "measured_fee", "redemption_days", "average_assets", "holders",
    "observations", "source", "zero_declared", "track_record", "tax_efficiency", "tax_regime",
)


class DocumentError(ValueError):
    """The document does not satisfy its own contract."""


def sorted_fields(frame: DataFrame) -> DataFrame:
    """Columns, and the fields of every struct below them, in alphabetical order."""

    def arranged(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            fields = sorted(kind.fields, key=lambda f: f.name)
            return T.StructType([T.StructField(f.name, arranged(f.dataType)) for f in fields])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(arranged(kind.elementType))
        return kind

    def rebuild(column, kind: T.DataType):
        if isinstance(kind, T.StructType):
            fields = sorted(kind.fields, key=lambda f: f.name)
            built = F.struct(*[rebuild(column[f.name], f.dataType).alias(f.name) for f in fields])
            return F.when(column.isNotNull(), built)
        if isinstance(kind, T.ArrayType) and kind.elementType != arranged(kind.elementType):
            return F.transform(column, lambda x: rebuild(x, kind.elementType))
        return column

    names = sorted(frame.columns)
    return frame.select(*[rebuild(F.col(n), frame.schema[n].dataType).alias(n) for n in names])


def ranked_records(listed: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(profile, rank, delivered, record): one nested record per listed entity.

    Percentiles form a map of the weighted metrics that have one.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("key"), F.col(f"{m}_pct").alias("value")) for m in metrics])
    weighed = F.filter(pairs, lambda p: p["value"].isNotNull())
    values = [c for c in LISTED_VALUES if c in listed.columns]
    record = F.struct(
        F.col("pick").alias("rank"), "entity", "name", "manager", "peer_group", "score", "pool_score",
        "appearance_rate", "appearance_rate_variable_only",
        F.struct(*values).alias("metrics"),
        F.map_from_entries(F.array_sort(weighed)).alias("percentiles"),
    )
    return listed.select("profile", F.col("pick").alias("rank"), "delivered", record.alias("record"))


def _gathered(frame: DataFrame, name: str, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(profile, name): the few rows of a list as an ordered array of structs."""
    keyed = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*fields).alias("_r"))
    rows = F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x["_r"])
    return frame.groupBy("profile").agg(rows.alias(name))


def ranking_document(
    listed: DataFrame, displaced: DataFrame, struck: DataFrame, weights: DataFrame, shares: DataFrame,
    pools: DataFrame, metrics: Sequence[str], reference, months: int, start, top_n: int,
    benchmark_label: str = "CDI",
) -> DataFrame:
    """One row per profile: the whole published document of that profile.

    Every list is bounded before it is gathered: the top list and what it passed
    over, the weights of a profile, and five managers.
    """
    records = ranked_records(listed, metrics).filter("delivered")
    top = records.groupBy("profile").agg(
        F.array_sort(F.collect_list("record"), lambda a, b: a["rank"] - b["rank"]).alias("top")
    )
    sizes = pools.groupBy("profile").agg(F.count(F.lit(1)).alias("eligible_universe_size"))
    applied = weights.groupBy("profile").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "weight")))).alias("weights"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.when(~F.col("inert"), F.struct("metric", "effective_weight"))))
        ).alias("effective_weights"),
        F.sort_array(F.collect_list(F.when(F.col("inert"), F.col("metric")))).alias("inert_metrics"),
    )
    share = shares.groupBy("profile").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("manager", "share")))).alias("manager_share")
    )
    lists = [
        _gathered(displaced, "displaced", ["entity"], ["entity", "duplicate_of", "tracking_difference"]),
        _gathered(
            struck.filter("exclusion_reason = 'cost'"), "cost_excluded", ["entity"],
            ["entity", "declared_fee", "measured_fee", "gate_cost"],
        ),
        _gathered(
            struck.filter("exclusion_reason = 'performance'"), "performance_excluded", ["entity"],
            ["entity", "excess_return", "excess_return_pct"],
        ),
    ]
    document = applied
    for part in (sizes, top, share, *lists):
        document = document.join(part, "profile", "left")
    empty = {
        name: F.coalesce(name, F.array().cast(document.schema[name].dataType))
        for name in ("top", "displaced", "cost_excluded", "performance_excluded")
    }
    document = document.withColumns(empty).withColumns(
        {
            "eligible_universe_size": F.coalesce("eligible_universe_size", F.lit(0)),
            "schema_version": F.lit(SCHEMA_VERSION),
            "reference_date": F.lit(reference),
            "lookback_months": F.lit(months),
            "window_start": F.lit(start),
            "benchmark_label": F.lit(benchmark_label),
            "top_n": F.lit(top_n),
        }
    )
    return sorted_fields(document)


def validate_document(document: DataFrame) -> None:
    """Top lists fit, ranks run from 1 without repeats or gaps and no entity is listed twice; one job."""
    ranks = F.transform("top", lambda r: r["rank"])
    names = F.transform("top", lambda r: r["entity"])
    sound = (
        (F.size("top") <= F.col("top_n"))
        & (F.size(F.array_distinct(names)) == F.size(names))
        & (F.size(F.array_distinct(ranks)) == F.size(ranks))
        & F.forall(ranks, lambda r: (r >= 1) & (r <= F.size(ranks)))
    )
    broken = document.filter(~F.coalesce(sound, F.lit(False))).select("profile").limit(5).collect()
    if broken:
        raise DocumentError(f"invalid top lists: {[r['profile'] for r in broken]}")


def write_document(document: DataFrame, target: str) -> None:
    validate_document(document)
    document.write.mode("overwrite").json(target)


def comparison_list(listed: DataFrame) -> DataFrame:
    """The longer list; its delivered rows are its first ones."""
    return listed.select(
        "profile", F.col("pick").alias("rank"), "entity", "delivered", "score", "pool_score", "appearance_rate"
    )


def benchmark_by_group(funds: DataFrame, group: str = "grp", label: str = "CDI") -> DataFrame:
    """(group, benchmark): what each category is measured against."""
    named = funds.filter(F.coalesce(F.col(group), F.lit("")) != "")
    return named.select(group).distinct().withColumn("benchmark", F.lit(label))
