"""Walking an order: the first distinct entities, and what was passed over.

An order is a column that sorts ascending, usually a struct such as
(-score, entity). No step gathers a whole pool: a walk looks at a bounded
prefix of every group, and goes on only for groups whose prefix ran out before
the list was full. Each further round starts with an entity that no chosen one
repeats, so a list of n needs at most n rounds.

`edges` is (entity, twin, distance) in both directions, or `Twins`, which are measured
among the rows of a prefix and beside the entities that were chosen, and nowhere else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peervane.functions.numbers import gate_cost
from peervane.operators.twins import Twins
from peervane.session import materialise

PREFIX = 64


def top_per_group(frame: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group, with `position` from 1.

    Spark limits each group on the map side first, so a hot group costs n rows
    per map task.
    """
    w = W.partitionBy(*groups).orderBy(*order)
    return frame.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def _among(window: DataFrame, groups: Sequence[str], edges: DataFrame | Twins) -> DataFrame:
    """(groups, entity, _twins): the twins of each entity among those of its group."""
    if isinstance(edges, Twins):
        return edges.among(window, groups)
    near = edges.select("entity", "twin")
    inside = window.select(*groups, F.col("entity").alias("twin"))
    return (
        window.select(*groups, "entity").join(near, "entity").join(inside, [*groups, "twin"], "left_semi")
        .groupBy(*groups, "entity").agg(F.collect_list("twin").alias("_twins"))
    )


def _beside(rows: DataFrame, edges: DataFrame | Twins) -> DataFrame:
    """The rows of (entity, ..) once for each twin, with (twin, distance)."""
    if isinstance(edges, Twins):
        return edges.beside(rows)
    return rows.join(edges.select("entity", "twin", "distance"), "entity")


def _fold(window: DataFrame, groups: Sequence[str], edges: DataFrame | Twins, room: Column) -> DataFrame:
    """Walk each group's window in order; (groups, picks, seen)."""
    twins = _among(window, groups, edges)
    rows = window.join(twins, [*groups, "entity"], "left")
    id_type = window.schema["entity"].dataType
    none = F.array().cast(f"array<{id_type.simpleString()}>")
    walked = rows.groupBy(*groups).agg(
        F.array_sort(
            F.collect_list(
                F.struct("position", "entity", F.coalesce("_twins", none).alias("twins"), room.alias("room"))
            )
        ).alias("_rows")
    )

    def step(chosen: Column, row: Column) -> Column:
        takes = (F.size(chosen) < row["room"]) & ~F.arrays_overlap(chosen, row["twins"])
        return F.when(takes, F.array_append(chosen, row["entity"])).otherwise(chosen)

    return walked.select(
        *groups, F.aggregate("_rows", none, step).alias("picks"), F.size("_rows").alias("seen")
    )


def class_heads(rows: DataFrame, groups: Sequence[str], order: str, classes: DataFrame) -> DataFrame:
    """(groups, entity, order, holder): the first row of every class in each group, under the name of its class.

    Copies share their twins, so whatever becomes of the first one keeps all others off the list. Equal
    classes collapse on the map side. An entity without a class is its own.
    """
    kind = F.coalesce("class", "entity").alias("_class")
    known = rows.join(classes.select("entity", "class"), "entity", "left")
    first = known.groupBy(*groups, kind).agg(F.min(F.struct(F.col(order).alias("o"), F.col("entity").alias("e"))).alias("_first"))
    return first.select(*groups, F.col("_class").alias("entity"), F.col("_first.o").alias(order), F.col("_first.e").alias("holder"))


def walk(
    leading: Callable[[DataFrame | None, DataFrame | None], DataFrame], groups: Sequence[str], edges: DataFrame | Twins, n: int, prefix: int
) -> DataFrame:
    """(groups, pick, entity): the first n of each order that repeat nothing chosen.

    `leading(unfilled, gone)` gives the first `prefix` rows of every group as a stored table (groups, entity, position, _held);
    after the first round, of the groups in `unfilled` (groups, _held) alone and without the (groups, entity) in `gone`.
    """
    groups = list(groups)
    parts: list[DataFrame] = []
    unfilled = gone = None
    for _ in range(n):
        window = leading(unfilled, gone)
        walked = materialise(_fold(window, groups, edges, F.lit(n) - F.col("_held")), "walk")
        picks = walked.select(*groups, F.posexplode("picks").alias("_at", "entity"))
        held = reduce(DataFrame.unionByName, parts).groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")) if parts else None
        if held is not None:
            picks = picks.join(held, groups, "left")
        offset = F.coalesce(F.col("_n"), F.lit(0)) if held is not None else F.lit(0)
        parts.append(picks.select(*groups, (F.col("_at") + 1 + offset).alias("pick"), "entity"))
        chosen = reduce(DataFrame.unionByName, parts)
        count = chosen.groupBy(*groups).agg(F.count(F.lit(1)).alias("_held"))
        unfilled = walked.filter(F.col("seen") >= prefix).select(*groups).join(
            count.filter(F.col("_held") < n), groups
        )
        if unfilled.isEmpty():
            break
        begun = chosen.join(unfilled.select(*groups), groups, "left_semi").select(*groups, "entity")
        gone = begun.unionByName(_beside(begun, edges).select(*groups, F.col("twin").alias("entity")))
    return reduce(DataFrame.unionByName, parts)


def first_distinct(
    rows: DataFrame, groups: Sequence[str], order: str, edges: DataFrame | Twins, n: int, prefix: int = PREFIX,
    classes: DataFrame | None = None,
) -> DataFrame:
    """(groups, pick, entity): the first n of each order that repeat nothing chosen.

    `rows` is (groups, entity, order). With `classes`, which is (entity, class), the edges are between classes, and
    members of one class repeat each other; `Twins` go with classes of their own.
    """
    groups = list(groups)
    classes = _classes_of(edges, classes)
    prefix = max(prefix, n)
    if classes is not None:
        heads = materialise(class_heads(rows, groups, order, classes), "heads")
        picked = _first_of_heads(heads, groups, order, edges, n, prefix)
        return picked.join(heads.select(*groups, "entity", "holder"), [*groups, "entity"]).select(
            *groups, "pick", F.col("holder").alias("entity")
        )

    return _first_of_heads(rows, groups, order, edges, n, prefix)


def _classes_of(edges: DataFrame | Twins, classes: DataFrame | None) -> DataFrame | None:
    return edges.classes if classes is None and isinstance(edges, Twins) else classes


def _first_of_heads(rows: DataFrame, groups: list[str], order: str, edges: DataFrame | Twins, n: int, prefix: int) -> DataFrame:
    def leading(unfilled: DataFrame | None, gone: DataFrame | None) -> DataFrame:
        remaining = rows.select(*groups, "entity", order)
        if unfilled is None:
            remaining = remaining.withColumn("_held", F.lit(0))
        else:
            remaining = remaining.join(unfilled, groups).join(gone, [*groups, "entity"], "left_anti")
        first = top_per_group(remaining, groups, [F.col(order)], prefix)
        return materialise(first.select(*groups, "entity", "position", "_held"), "window")

    return walk(leading, groups, edges, n, prefix)


def displaced(
    rows: DataFrame, groups: Sequence[str], order: str, edges: DataFrame | Twins, chosen: DataFrame, n: int,
    classes: DataFrame | None = None,
) -> DataFrame:
    """(groups, entity, duplicate_of, distance): rows the walk reached and passed over.

    A passed-over row precedes the end of the walk and repeats an entity chosen
    before it; it names the closest such one. With `classes`, `edges` are between them.
    """
    groups = list(groups)
    classes = _classes_of(edges, classes)
    ordered = rows.select(*groups, "entity", order)
    if classes is None:
        ordered = ordered.withColumn("_class", F.col("entity"))
    else:
        known = classes.select("entity", F.col("class").alias("_class"))
        ordered = ordered.join(known, "entity", "left").withColumn("_class", F.coalesce("_class", "entity"))
    placed = chosen.filter(F.col("pick") <= n).select(*groups, "entity", "pick").join(ordered, [*groups, "entity"])
    ends = placed.groupBy(*groups).agg(
        F.max(order).alias("_last"), F.count(F.lit(1)).alias("_filled")
    )
    holders = placed.select(*groups, F.col("entity").alias("_holder"), F.col(order).alias("_held_at"), F.col("_class").alias("entity"))
    near = _beside(holders, edges).withColumnRenamed("twin", "_class")
    if classes is not None:
        own = holders.select("*", F.col("entity").alias("_class"), F.lit(0.0).alias("distance"))
        near = near.unionByName(own)
    candidates = (
        near.drop("entity").withColumnRenamed("_holder", "twin").join(ordered, [*groups, "_class"])
        .filter(F.col("_held_at") < F.col(order))
        .join(ends, groups)
        .filter((F.col("_filled") < n) | (F.col(order) < F.col("_last")))
    )
    nearest = candidates.groupBy(*groups, "entity").agg(
        F.min(F.struct("distance", "_held_at", "twin")).alias("_near")
    )
    return nearest.select(
        *groups, "entity", F.col("_near.twin").alias("duplicate_of"),
        F.bround("_near.distance", 6).alias("tracking_difference"),
    )


def with_gates(scored: DataFrame, max_cost: float, trusted_above: float, floor: float) -> DataFrame:
    """Add `gate_cost`, `cost_gated`, `below_floor` and `vetoed`; a null never vetoes."""
    cost = gate_cost(F.col("declared_fee"), F.col("measured_fee"), trusted_above)
    return (
        scored.withColumn("gate_cost", cost)
        .withColumns(
            {
                "cost_gated": F.coalesce(F.col("gate_cost") > max_cost, F.lit(False)),
                "below_floor": F.coalesce(F.col("excess_return_pct") < floor, F.lit(False)),
            }
        )
        .withColumn("vetoed", F.col("cost_gated") | F.col("below_floor"))
    )


def exclusion_reason() -> Column:
    """Each struck entity is explained once, cost before performance."""
    return F.when(F.col("cost_gated"), "cost").when(F.col("below_floor"), "performance")


def gated_selection(
    scored: DataFrame, groups: Sequence[str], order: str, edges: DataFrame | Twins, top_n: int, size: int,
    prefix: int = PREFIX, classes: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(listed, displaced, struck) under the vetoes; `classes` as in `first_distinct`.

    `listed` is the longer list; its first `top_n` are the delivered one, since
    a walk for fewer stops earlier on the same path. `struck` are the vetoed
    entities an ungated walk would have delivered.
    """
    groups = list(groups)
    kept = scored.filter(~F.col("vetoed"))
    walks = kept.select(*groups, "entity", order, F.lit(True).alias("gated")).unionByName(
        scored.select(*groups, "entity", order, F.lit(False).alias("gated"))
    )
    walked = first_distinct(walks, ["gated", *groups], order, edges, max(size, top_n), prefix, classes)
    delivered = F.col("pick") <= top_n
    listed = walked.filter("gated").drop("gated").withColumn("delivered", delivered)
    over = displaced(kept, groups, order, edges, listed, top_n, classes)
    ungated = walked.filter(~F.col("gated") & delivered)
    struck = ungated.select(*groups, "entity").join(
        scored.filter("vetoed"), [*groups, "entity"]
    ).withColumn("exclusion_reason", exclusion_reason())
    return listed, over, struck


def manager_share(pool: DataFrame, by: Sequence[str] = ("profile",), manager: str = "manager", k: int = 5) -> DataFrame:
    """The k largest managers of each pool and their share of it."""
    by = list(by)
    counts = pool.groupBy(*by, manager).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("_total"))
    top = top_per_group(counts, by, [F.desc("n"), F.col(manager)], k)
    return top.join(sizes, by).filter(F.col(manager).isNotNull()).select(
        *by, manager, "n", F.bround(F.col("n") / F.col("_total"), 4).alias("share")
    )


def in_listed_order(frame: DataFrame, key: str, listed: Sequence) -> DataFrame:
    """Rows whose key is listed, with `list_position`, in the order of the list.

    Equal positions follow the other columns, so a value with many rows is cut into ranges and not one task.
    """
    places = frame.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(v) for v in listed])).alias("list_position", key)
    )
    return frame.join(places, key).orderBy("list_position", *[c for c in frame.columns if c != key])
