"""Near-identical series under one manager.

Two entities are twins when one manager runs both and the annualised standard
deviation of the difference of their returns, over the days both have, is at
most a threshold.

All pairs of a manager are never formed. An entity present on every day of a
stretch of the calendar gets a coordinate there: its returns weighted by the
centred market return. By Cauchy-Schwarz two twins cannot lie further apart on it
than a radius known in advance, so a grid of that width puts each twin in the same
or the next cell. The stretches are the whole calendar, for entities without gaps,
and a few parts of it, for the others; a pair is judged in the first stretch both
fill, and only pairs that fill no stretch together are compared without a grid.
Cells are split into tiles of bounded size, and a task compares one pair of tiles:
products of matrices tell most pairs apart, the rest are measured day by day. Nothing
within the threshold is missed.

All pairs within a threshold can still be as many as the square of a manager. A list
needs few of them: those among the rows a walk sees, and those of entities it chose.
`Twins` finds these when asked and leaves the others unmeasured.

Copies are walked once. Entities of a manager whose returns agree on every day, to
nine digits, are one class; the smallest of them stands for all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peervane.operators.series import (
    PANEL,
    PERIODS_PER_YEAR,
    PanelColumns,
    calendar_of,
    with_adjacent_returns,
)
from peervane.session import materialise, wide_parallelism

# Series of a tile, and their returns. Series travel once for every tile theirs meets, so small tiles cost disk.
TILE = 4096
TILE_RETURNS = 1 << 20
# Numbers of one array while pairs are told apart and measured: 8 MB.
CELLS = 1_000_000
# Returns that agree to so many digits are the same return of a copy.
CLASS_DIGITS = 9
PARTS = 4
WHOLE, APART = 0, -1  # stretches: the whole calendar, and none in common
TILE_KEY = ("cell", "gaps", "tile")
TILE_PAIR = ("manager", "stretch", *[f"{k}_{side}" for side in "ab" for k in TILE_KEY])


def pool_returns(
    panel: DataFrame, members: DataFrame, cols: PanelColumns = PANEL, by: tuple[str, ...] = ()
) -> DataFrame:
    """Returns between neighbouring dates of the pool: (manager, entity, day_index, ret).

    `members` is (entity, manager), one row per entity of the pool. `by` names columns of the panel that part
    it into pools with calendars of their own.
    """
    pool = panel.select(*by, cols.entity, cols.ts, cols.price).join(
        members.select(F.col(cols.entity), "manager").filter("manager IS NOT NULL"), cols.entity
    )
    everyone = panel.select(*by, cols.entity, cols.ts).join(members.select(cols.entity), cols.entity, "left_semi")
    returns = with_adjacent_returns(pool, calendar_of(everyone, cols.ts, by), cols, by=by)
    return returns.filter(F.col("ret").isNotNull()).select(
        "manager", F.col(cols.entity).alias("entity"), "day_index", "ret"
    )


def pair_distances(returns: DataFrame, periods: int = PERIODS_PER_YEAR) -> DataFrame:
    """Distance and shared days of every pair, by plain self-join.

    For small pools and for tests: its output grows with the square of a manager.
    """
    left = returns.select("manager", "day_index", F.col("entity").alias("a"), F.col("ret").alias("ra"))
    right = returns.select("manager", "day_index", F.col("entity").alias("b"), F.col("ret").alias("rb"))
    both = left.join(right, ["manager", "day_index"]).filter("a < b")
    gap = F.stddev_pop(F.col("ra") - F.col("rb"))
    return both.groupBy("a", "b").agg(
        (gap * F.sqrt(F.lit(float(periods)))).alias("distance"), F.count(F.lit(1)).alias("overlap")
    )


def _vectors(returns: DataFrame) -> DataFrame:
    """(manager, entity, days, rets): a row per entity, as long as the calendar at most."""
    observed = F.array_sort(F.collect_list(F.struct("day_index", "ret")))
    vectors = returns.groupBy("manager", "entity").agg(observed.alias("_obs"))
    return vectors.select(
        "manager", "entity", F.col("_obs.day_index").alias("days"), F.col("_obs.ret").alias("rets")
    )


def _market(vectors: DataFrame) -> list[tuple[int, float]]:
    """(day, mean return) of each day of the calendar, in order.

    A few hundred numbers a year reach the driver; as literals they put an entity
    into the same cell in every branch of the plan and after every retry.
    """
    daily = vectors.select(F.explode(F.arrays_zip("days", "rets")).alias("_x")).groupBy("_x.days").agg(
        F.avg("_x.rets").alias("mean")
    )
    return sorted((row["days"], row["mean"]) for row in daily.collect())


def _stretches(market: list[tuple[int, float]]) -> list[tuple[int, list[tuple[int, float]]]]:
    """(number, days) of the whole calendar and of its parts, which need two days each."""
    parts = min(PARTS, len(market) // 2)
    edges = [len(market) * k // parts for k in range(parts + 1)] if parts else []
    found = [(k + 1, market[edges[k] : edges[k + 1]]) for k in range(parts)]
    return [(WHOLE, market), *found] if market else []


def _with_cells(
    vectors: DataFrame, threshold: float, periods: int, market: list[tuple[int, float]] | None = None
) -> DataFrame:
    """A row per entity and stretch it fills: (.., stretch, cell, gaps, filled).

    `filled` has a bit for each part an entity fills. One more row per entity, of
    stretch APART, has these bits as its cell, for pairs that fill no part together.
    """
    market = _market(vectors) if market is None else market
    sigma = threshold / periods**0.5
    cells, filled = [], F.lit(0)
    for number, days in _stretches(market):
        middle = sum(m for _, m in days) / len(days)
        weights = [m - middle for _, m in days]
        radius = sum(w * w for w in weights) ** 0.5 * len(market) ** 0.5 * sigma * (1 + 1e-9) + 1e-12
        first, last = days[0][0], days[-1][0]
        inside = F.filter(F.arrays_zip("days", "rets"), lambda x: x["days"].between(first, last))
        literal = F.expr(f"array({', '.join(f'{w!r}D' for w in weights)})")
        z = F.aggregate(
            F.zip_with(inside, literal, lambda x, w: x["rets"] * w), F.lit(0.0), lambda total, x: total + x
        )
        fills = F.size(inside) == len(days)
        cell = F.when(fills, F.floor(z / F.lit(radius)).cast("bigint"))
        cells.append(F.struct(F.lit(number).alias("stretch"), cell.alias("cell")))
        if number != WHOLE:
            filled = filled + F.when(fills, 1 << (number - 1)).otherwise(0)
    none = F.array().cast("array<struct<stretch:int,cell:bigint>>")
    known = F.filter(F.array(*cells), lambda c: c["cell"].isNotNull()) if cells else none
    placed = vectors.withColumns({"filled": filled, "_places": known})
    gaps = ~F.exists("_places", lambda c: c["stretch"] == WHOLE)
    apart = F.array(F.struct(F.lit(APART).alias("stretch"), F.col("filled").cast("bigint").alias("cell")))
    return placed.withColumn("gaps", gaps).select(
        "manager", "entity", "days", "rets", "filled", "gaps", F.inline(F.concat("_places", apart))
    )


def _tile_pairs(cells: DataFrame) -> DataFrame:
    """Pairs of tiles to compare, from (manager, stretch, cell, gaps, tiles).

    In the whole calendar neighbouring cells meet. In a part, cells of entities with
    gaps meet each other and the neighbouring cells of the rest. Apart, cells meet
    whose bits have nothing in common, of at most 2^PARTS cells per manager.
    """
    other = cells.select(
        "manager", "stretch", F.col("cell").alias("cell_b"), F.col("gaps").alias("gaps_b"), F.col("tiles").alias("_tiles_b")
    )
    mine = cells.select(
        "manager", "stretch", F.col("cell").alias("cell_a"), F.col("gaps").alias("gaps_a"), F.col("tiles").alias("_tiles_a")
    )
    steps = F.when(F.col("stretch") == WHOLE, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(-1), F.lit(0), F.lit(1))
    )
    looking = mine.filter((F.col("stretch") == WHOLE) | ((F.col("stretch") > WHOLE) & F.col("gaps_a")))
    near = looking.withColumn("cell_b", F.explode(F.transform(steps, lambda k: F.col("cell_a") + k))).join(
        other, ["manager", "stretch", "cell_b"]
    ).filter((F.col("stretch") == WHOLE) | ~F.col("gaps_b") | (F.col("cell_b") >= F.col("cell_a")))
    apart = mine.filter(F.col("stretch") == APART).join(
        other.filter(F.col("stretch") == APART), ["manager", "stretch"]
    ).filter((F.col("cell_a").bitwiseAND(F.col("cell_b")) == 0) & (F.col("cell_a") <= F.col("cell_b")))
    pairs = near.unionByName(apart)
    spread = pairs.withColumn("tile_a", F.explode(F.sequence(F.lit(0), F.col("_tiles_a") - 1))).withColumn(
        "tile_b", F.explode(F.sequence(F.lit(0), F.col("_tiles_b") - 1))
    )
    same = (F.col("cell_a") == F.col("cell_b")) & (F.col("gaps_a") == F.col("gaps_b"))
    return spread.filter(~same | (F.col("tile_a") <= F.col("tile_b"))).select(*TILE_PAIR)


@dataclass(frozen=True)
class Rule:
    """Who is a twin: the largest distance a year, the fewest shared days, and the periods of a year."""

    threshold: float
    min_overlap: int
    periods: int = PERIODS_PER_YEAR


def _dense(days, rets):
    """(series x day) returns less the mean of their series, NaN where there are none, from lists of days and returns."""
    import numpy as np
    import pyarrow.compute as pc

    at, values = (c.flatten().to_numpy(zero_copy_only=False) for c in (days, rets))
    lengths = pc.list_value_length(days).to_numpy(zero_copy_only=False)
    first = at.min()
    dense = np.full((len(lengths), at.max() - first + 1), np.nan)
    dense[np.repeat(np.arange(len(lengths)), lengths), at - first] = values
    # Each series is centred on its own mean: a gap is then small, and its spread keeps all its digits.
    return dense - np.nanmean(dense, axis=1, keepdims=True)


def _within(left, right, rule: Rule, allowed=None):
    """Yield (rows of left, rows of right, distances, shared days) of the pairs within the threshold, of `_dense` returns.

    Sums of squares out of products of matrices, with room for their rounding, tell most pairs apart; those left are
    measured on their differences. `allowed(first, end)` masks the pairs of a slice of the left.
    """
    import numpy as np

    def known(x):
        has = np.isfinite(x)
        filled = np.where(has, x, 0.0)
        return has.astype(np.float64), filled, filled * filled

    least, limit = max(rule.min_overlap, 1), rule.threshold**2 / rule.periods * (1 + 1e-9)
    has_b, b, bb = known(right)
    size_b = bb.sum(axis=1)
    step, measured = max(1, CELLS // max(len(right), 1)), max(1, CELLS // right.shape[1])
    for first in range(0, len(left), step):
        some = left[first : first + step]
        has_a, a, aa = known(some)
        size_a = aa.sum(axis=1)
        whole = has_a.all() and has_b.all()
        if whole:
            days = np.full((1, 1), float(right.shape[1]))
            off = a.sum(axis=1)[:, None] - b.sum(axis=1)
            squares = size_a[:, None] + size_b - 2 * (a @ b.T)
        else:
            days = has_a @ has_b.T
            off = a @ has_b.T - has_a @ b.T
            squares = aa @ has_b.T + has_a @ bb.T - 2 * (a @ b.T)
        room = 1e-12 * (np.sqrt(size_a)[:, None] + np.sqrt(size_b)) ** 2
        near = (squares - off * off / np.maximum(days, 1) <= limit * days + room) & (days >= least)
        if allowed is not None:
            near &= allowed(first, first + len(some))
        rows, columns = np.nonzero(near)
        for at in range(0, len(rows), measured):
            i, j = rows[at : at + measured], columns[at : at + measured]
            gaps = some[i] - right[j]
            if whole:
                n = np.full(len(i), right.shape[1])
                gaps -= (gaps.sum(axis=1) / n)[:, None]
            else:
                shared = np.isfinite(gaps)
                n = shared.sum(axis=1)
                gaps = np.where(shared, gaps, 0.0)
                gaps = np.where(shared, gaps - (gaps.sum(axis=1) / n)[:, None], 0.0)
            distances = np.sqrt((gaps * gaps).sum(axis=1) / n * rule.periods)
            found = np.flatnonzero(distances <= rule.threshold)
            yield i[found] + first, j[found], distances[found], n[found]


def _met(rows: DataFrame, keys: Sequence[str], rule: Rule) -> DataFrame:
    """(a, b, distance, overlap): series of side a within the threshold of those of side b under the same keys.

    `rows` has (entity, days, rets, side, filled, judged, itself) beside the keys. With `itself`, side a meets itself, each
    pair once. `judged` is the stretch that pairs have to be judged in, or null where they are judged however they
    meet. Pairs leave the task as they are found, so it never holds all of them.
    """
    entity_type = rows.schema["entity"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        group = pa.Table.from_batches(list(batches)).combine_chunks()
        column = lambda name: group.column(name).combine_chunks()
        is_a = column("side").to_numpy(zero_copy_only=False) == "a"
        judged, itself = group.column("judged")[0].as_py(), group.column("itself")[0].as_py()
        first = np.flatnonzero(is_a)
        second = first if itself else np.flatnonzero(~is_a)
        if not (len(first) and len(second)):
            return
        filled = column("filled").to_numpy(zero_copy_only=False)
        parted = judged is not None and judged != WHOLE

        def allowed(start, end):
            mask = np.ones((end - start, len(second)), dtype=bool)
            if itself:
                mask = np.arange(len(second)) > np.arange(start, end)[:, None]
            if parted:
                # A pair is judged in the first part of the calendar that both fill, or apart if there is none.
                common = filled[first[start:end]][:, None] & filled[second]
                mask &= (common & -common) == (0 if judged == APART else 1 << (judged - 1))
            return mask

        dense = _dense(column("days"), column("rets"))
        ids = column("entity")
        for i, j, distances, days in _within(dense[first], dense[second], rule, allowed if itself or parted else None):
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(first[i])), ids.take(pa.array(second[j])), pa.array(distances), pa.array(days, pa.int64())],
                names=["a", "b", "distance", "overlap"],
            )

    spread = rows.repartition(wide_parallelism(rows.sparkSession), *keys)
    return spread.groupBy(*keys).applyInArrow(compare, f"a {entity_type}, b {entity_type}, distance double, overlap bigint")


def _tiles(rows: DataFrame, where: Sequence[str], tile: int, name: str = "tiles") -> DataFrame:
    """(where, tiles): how many tiles the rows of each key fill."""
    return rows.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(tile))).cast("int").alias(name))


def _tile_of(tiles: str) -> Column:
    return F.pmod(F.xxhash64("entity"), F.col(tiles)).cast("int")


@dataclass(frozen=True)
class Twins:
    """Twins by class, measured when asked for.

    `classes` is (entity, class, copies, days): the class an entity belongs to, named by its smallest member, and
    how many share it. Entities with too few days for any twin are left out. Members of one class are twins of each
    other at no distance. `vectors` has the returns of every entity and `firsts` those that stand for a class. All three are stored.
    """

    classes: DataFrame
    vectors: DataFrame
    firsts: DataFrame
    rule: Rule
    tile: int = TILE

    @cached_property
    def pairs(self) -> DataFrame:
        """(a, b, distance, overlap) with a < b of all classes, stored: it can grow with the square of a manager."""
        return materialise(_pairs(self.firsts, self.rule, self.tile), "twin-classes")

    @property
    def links(self) -> DataFrame:
        """(entity, twin, distance): pairs of classes seen from both ends."""
        return both_directions(self.pairs)

    @property
    def expanded(self) -> DataFrame:
        """(a, b, distance, overlap) with a < b for every pair of entities, as they are found."""
        return _pairs(self.vectors, self.rule, self.tile)

    def among(self, window: DataFrame, groups: Sequence[str]) -> DataFrame:
        """(groups, entity, _twins): the twins each class has among those of its group, for groups of bounded size.

        `window` is (groups, entity). Classes without twins there may be left out.
        """
        groups, rule = list(groups), self.rule
        near = self.firsts.select("entity", *[F.col(c).alias(f"_{c}") for c in ("manager", "days", "rets")])
        rows = window.select(*groups, "entity").join(near, "entity")

        def link(group):
            import numpy as np

            manager = group.column("_manager").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            dense = _dense(group.column("_days").combine_chunks(), group.column("_rets").combine_chunks())
            places = np.arange(len(manager))

            def allowed(first, end):
                return (manager == manager[first:end][:, None]) & (places != places[first:end][:, None])

            ends = [(i, j) for i, j, _, _ in _within(dense, dense, rule, allowed)]
            here, there = (np.concatenate([e[k] for e in ends] or [places[:0]]) for k in range(2))
            ids = group.column("entity").combine_chunks()
            offsets = np.searchsorted(here, np.arange(len(manager) + 1)).astype(np.int32)
            twins = pa.ListArray.from_arrays(pa.array(offsets), ids.take(pa.array(there)))
            return pa.Table.from_arrays([*(group.column(g) for g in groups), ids, twins], names=[*groups, "entity", "_twins"])

        kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [*groups, "entity"]]
        entity_type = rows.schema["entity"].dataType.simpleString()
        spread = rows.repartition(wide_parallelism(rows.sparkSession), *groups)
        return spread.groupBy(*groups).applyInArrow(link, f"{', '.join(kinds)}, _twins array<{entity_type}>")

    def beside(self, rows: DataFrame) -> DataFrame:
        """The rows of (entity, ..) once for each twin of their class, with (twin, distance).

        Every class of a manager meets those asked for, tile by tile: the work grows with the product of both.
        """
        asked = rows.select("entity").distinct().join(self.firsts, "entity")
        sizes = _tiles(self.firsts, ["manager"], self.tile).join(_tiles(asked, ["manager"], self.tile, "blocks"), "manager")
        every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
        a = asked.join(sizes, "manager").withColumn("block", _tile_of("blocks")).withColumn("tile", every("tiles"))
        b = self.firsts.join(sizes, "manager").withColumn("tile", _tile_of("tiles")).withColumn("block", every("blocks"))
        keys = ["manager", "tile", "block"]
        sides = [
            side.select(
                *keys, "entity", "days", "rets", F.lit(name).alias("side"), F.lit(0).alias("filled"),
                F.lit(None).cast("int").alias("judged"), F.lit(False).alias("itself"),
            )
            for name, side in (("a", a), ("b", b))
        ]
        met = _met(sides[0].unionByName(sides[1]), keys, self.rule).filter("a <> b")
        return rows.join(met.select(F.col("a").alias("entity"), F.col("b").alias("twin"), "distance"), "entity")


def _classes(vectors: DataFrame) -> DataFrame:
    """(entity, class, copies, days) of vectors with a digest: equal digests collapse on the map side."""
    key = ["manager", "digest"]
    firsts = vectors.groupBy(*key).agg(F.min("entity").alias("class"), F.count(F.lit(1)).alias("copies"))
    return vectors.select(*key, "entity", F.size("days").alias("days")).join(firsts, key).select(
        "entity", "class", "copies", "days"
    )


def _long_enough(returns: DataFrame, min_overlap: int) -> DataFrame:
    return _vectors(returns).filter(F.size("days") >= max(min_overlap, 1))


def twin_pairs(
    returns: DataFrame, threshold: float, min_overlap: int, periods: int = PERIODS_PER_YEAR,
    tile: int = TILE,
) -> DataFrame:
    """(a, b, distance, overlap) with a < b for every pair within the threshold.

    The pairs are not stored: they can grow with the square of a manager, and so can what becomes of them.
    """
    vectors = materialise(_long_enough(returns, min_overlap), "vectors")
    return _pairs(vectors, Rule(threshold, min_overlap, periods), tile)


def twin_classes(
    returns: DataFrame, threshold: float, min_overlap: int, periods: int = PERIODS_PER_YEAR,
    tile: int = TILE,
) -> Twins:
    """Classes of copies, and the series to find their twins by."""
    # A sum of 0.0 makes a negative zero a plain one.
    digits = F.transform("rets", lambda r: F.round(r, CLASS_DIGITS) + F.lit(0.0))
    digest = F.unhex(F.sha2(F.to_json(F.struct("days", digits.alias("rets"))), 256))
    vectors = materialise(_long_enough(returns, min_overlap).withColumn("digest", digest), "vectors")
    classes = materialise(_classes(vectors), "classes")
    firsts = classes.filter(F.col("entity") == F.col("class")).select("entity")
    firsts = materialise(vectors.drop("digest").join(firsts, "entity", "left_semi"), "representatives")
    return Twins(classes, vectors.drop("digest"), firsts, Rule(threshold, min_overlap, periods), tile)


def _pairs(vectors: DataFrame, rule: Rule, tile: int) -> DataFrame:
    """(a, b, distance, overlap) with a < b of stored vectors.

    Places are paired first, a few numbers a row; a series joins each tile it goes to at the end.
    """
    market = _market(vectors)
    tile = min(tile, max(1, TILE_RETURNS // max(len(market), 1)))
    placed = _with_cells(vectors, rule.threshold, rule.periods, market).drop("days", "rets")
    placed = materialise(placed, "places")
    where = ["manager", "stretch", "cell", "gaps"]
    cells = _tiles(placed, where, tile)
    tiled = placed.join(cells, where).withColumn("tile", _tile_of("tiles")).drop("tiles")
    itself = F.lit(True)
    for k in TILE_KEY:
        itself = itself & (F.col(f"{k}_a") == F.col(f"{k}_b"))
    pairs = _tile_pairs(cells).withColumn("itself", itself)

    def side(name: str) -> DataFrame:
        members = tiled.withColumnsRenamed({k: f"{k}_{name}" for k in TILE_KEY})
        keyed = pairs if name == "a" else pairs.filter("NOT itself")
        return keyed.join(members, ["manager", "stretch", *[f"{k}_{name}" for k in TILE_KEY]]).select(
            *TILE_PAIR, "entity", "filled", "itself", F.lit(name).alias("side")
        )

    rows = side("a").unionByName(side("b")).join(vectors, ["manager", "entity"])
    found = _met(rows.withColumn("judged", F.col("stretch")), TILE_PAIR, rule)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance", "overlap")


def both_directions(pairs: DataFrame) -> DataFrame:
    """(entity, twin, distance): each pair seen from both ends, in one pass."""
    ends = [F.struct(F.col(x).alias("entity"), F.col(y).alias("twin")) for x, y in ("ab", "ba")]
    return pairs.select(F.inline(F.array(*ends)), "distance")
