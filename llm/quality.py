"""Quality classifier: kernel ridge regression through random Fourier features, with isotonic calibration.

1. A pass over whole texts turns each document into a few statistics (lengths, shares of letters, digits, marks and
   capitals, repetition of words, pairs of words and lines). Only those are stored.
2. Statistics are standardised over the training rows, and cosines of random projections of them approximate a Gaussian kernel.
3. Every task adds up Z'Z and Z'y of its training rows; the partial sums are added per matrix row. The size of what
   reaches the driver is the square of the number of features, however many rows there are.
4. The ridge scores of the training rows left out of the fit are cut into bins of equal width; pooling adjacent violators over
   the bins gives a rising map from score to the share of good documents.

Labels are learned only from rows that are not held out (crc32 of the id modulo 5 is 0): remainders 1 to 3 fit the ridge, 4 the
calibration. Neither labels nor id, language or source are inputs of a score.

Defined results: null, empty and blank texts have the statistics of an empty text and get its score. A null id is not held out
and never labelled. Rows that repeat an id are scored alone. A label that is null is none; if an id has several labels, their mean counts.
Without any label every score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import materialise
from llm.textkit import Words, rolling, slices

FEATURES = 192
BANDWIDTH = 4.0
RIDGE = 1e-3
BINS = 400
SEED = 20240229

NAMES = (
    "log_bytes", "log_words", "log_lines", "word_length", "long_words", "letters", "capitals", "digits", "high_bytes",
    "marks", "odd_marks", "bars", "blanks", "line_length", "short_lines", "distinct_words", "distinct_pairs",
    "commonest_word", "distinct_lines", "ended_lines", "marked_words",
)

# Byte classes.
CLASSES = np.zeros((256, 8), np.float64)
CLASSES[[*range(65, 91), *range(97, 123)], 0] = 1
CLASSES[65:91, 1] = 1
CLASSES[48:58, 2] = 1
CLASSES[128:, 3] = 1
CLASSES[[c for c in range(33, 127) if not chr(c).isalnum()], 4] = 1
CLASSES[[ord(c) for c in "#$%&*@\\^_`{}~<>"], 5] = 1
CLASSES[ord("|"), 6] = 1
CLASSES[[32, *range(9, 14)], 7] = 1
STOPS = np.isin(np.arange(256), [ord(c) for c in ".!?:;\"')"])
MARKS = CLASSES[:, 4] > 0


def statistics(words: Words) -> np.ndarray:
    """A row of `NAMES` for every document of a word table."""
    n = words.documents()
    out = np.zeros((n, len(NAMES)))
    pairs = rolling(words.hashes, 2)
    lengths = words.ends - words.starts
    closing = MARKS[words.data[words.ends - 1]] if len(words.ends) else np.zeros(0, bool)
    for d in range(n):
        data = words.data[words.offsets[d] : words.offsets[d + 1]]
        size = len(data)
        if not size:
            continue
        a, b = int(words.first[d]), int(words.first[d + 1])
        shares = np.bincount(data, minlength=256) @ CLASSES / size
        breaks = np.flatnonzero(data == 10)
        bounds = np.concatenate(([-1], breaks, [size]))
        widths = np.diff(bounds) - 1
        ends = bounds[1:][widths > 0] - 1
        row = out[d]
        row[:3] = np.log1p([size, b - a, len(widths)])
        row[5:13] = shares
        row[13] = np.log1p(widths.mean())
        row[14] = (widths < 20).mean()
        row[19] = STOPS[data[ends]].mean() if len(ends) else 0.0
        body = data.tobytes().split(b"\n")
        row[18] = len(set(body)) / len(body)
        if b > a:
            mine = lengths[a:b]
            row[3], row[4] = mine.mean(), (mine > 12).mean()
            _, counts = np.unique(words.hashes[a:b], return_counts=True)
            row[15], row[17] = len(counts) / np.sqrt(b - a), counts.max() / (b - a)
            row[16] = len(np.unique(pairs[a : b - 1])) / (b - a - 1) if b - a > 1 else 1.0
            row[20] = closing[a:b].mean()
    return out


def fold_of(ids: list[int | None]) -> list[int | None]:
    return [None if i is None else zlib.crc32(str(i).encode()) % 5 for i in ids]


def statistic_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [statistics(words) for _, words in slices(batch.column(1))]
        stats = np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))],
            names=["doc_id", "stats"],
        )


@dataclass(frozen=True)
class Projection:
    """Standardisation and the random cosines after it."""

    mean: np.ndarray
    spread: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        draws = np.random.default_rng(SEED)
        directions = draws.normal(0, 1 / BANDWIDTH, (stats.shape[1], FEATURES))
        shifts = draws.uniform(0, 2 * np.pi, FEATURES)
        scaled = np.clip((stats - self.mean) / self.spread, -8, 8)
        cosines = np.sqrt(2 / FEATURES) * np.cos(scaled @ directions + shifts)
        return np.concatenate([cosines, np.ones((len(stats), 1))], axis=1)


@dataclass(frozen=True)
class Model:
    projection: Projection
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.projection.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated: linear between the centres of the bins, so that scores keep their order."""
        return np.clip(np.interp(self.ridge(stats), self.edges, self.levels), 0.0, 1.0)


def stats_of(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("stats")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def normal_equations(batches: Iterator[pa.RecordBatch], projection: Projection) -> Iterator[pa.RecordBatch]:
    """The rows of Z'[Z y] over all rows of a partition."""
    total = np.zeros((FEATURES + 1, FEATURES + 2))
    for batch in batches:
        z = projection.features(stats_of(batch))
        total += z.T @ np.column_stack([z, batch.column("label").to_numpy()])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(FEATURES + 1)), pa.array([r.tobytes() for r in total])], names=["i", "sums"]
    )


def added(frame):
    """Sums of one matrix row over partitions."""
    import pandas as pd

    rows = np.sum([np.frombuffer(x) for x in frame["sums"]], axis=0)
    return pd.DataFrame({"i": [int(frame["i"].iloc[0])], "sums": [rows.tobytes()]})


def ridge_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(model.ridge(stats_of(batch))), batch.column("label")], names=["ridge", "label"])


def pooled(centres: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of means over bins in order, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for c, s, n in zip(centres, sums, counts):
        blocks.append([s, n, c, c])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, n2, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + n2, blocks[-1][2], high]
    # One label of each kind is added, so no level is certain.
    x = [v for b in blocks for v in (b[2], b[3])]
    y = [v for b in blocks for v in [(b[0] + 0.5) / (b[1] + 1)] * 2]
    return np.array(x), np.maximum.accumulate(np.array(y))


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """A model from (doc_id, stats) and (doc_id, quality)."""
    marked = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").cast("double").alias("label"))
        .withColumn("fold", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)))
        .filter("fold <> 0")
    )
    rows = materialise(stats.join(marked, "doc_id"), "labelled")
    train, later = rows.filter("fold <> 4"), rows.filter("fold = 4")
    moments = train.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(len(NAMES))),
        *(F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(len(NAMES))),
    ).first()
    if not moments["n"]:
        flat = Projection(np.zeros(len(NAMES)), np.ones(len(NAMES)))
        return Model(flat, np.zeros(FEATURES + 1), np.zeros(1), np.array([0.5]))
    spread = np.array([moments[f"s{i}"] for i in range(len(NAMES))])
    projection = Projection(
        np.array([moments[f"m{i}"] for i in range(len(NAMES))]), np.where(spread > 1e-9, spread, 1.0)
    )
    parts = train.select("stats", "label").mapInArrow(partial(normal_equations, projection=projection), "i long, sums binary")
    summed = sorted(parts.groupBy("i").applyInPandas(added, "i long, sums binary").collect())
    matrix = np.array([np.frombuffer(bytes(r["sums"])) for r in summed])
    gram, target = matrix[:, :-1], matrix[:, -1]
    penalty = RIDGE * moments["n"] / FEATURES * np.eye(FEATURES + 1)
    penalty[-1, -1] = 0
    weights = np.linalg.lstsq(gram + penalty, target, rcond=None)[0]
    model = Model(projection, weights, np.zeros(1), np.array([0.5]))
    left = later if later.limit(1).count() else train
    scored = left.select("stats", "label").mapInArrow(partial(ridge_rows, model=model), "ridge double, label double")
    binned = scored.groupBy(F.floor(F.least(F.greatest("ridge", F.lit(-1.0)), F.lit(2.0)) * BINS / 3).alias("bin")).agg(
        F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")
    )
    table = np.array(sorted(map(tuple, binned.collect())), float)
    edges, levels = pooled((table[:, 0] + 0.5) * 3 / BINS, table[:, 1], table[:, 2])
    return Model(projection, weights, edges, levels)


def score_rows(batches: Iterator[pa.RecordBatch], model: Model, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = model.score(stats_of(batch))
        held = [f == 0 for f in fold_of(batch.column("doc_id").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(held), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )


def text_statistics(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(texts.mapInArrow(statistic_rows, "doc_id long, stats array<double>"), "text-statistics")


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of (doc_id, text)."""
    stats = text_statistics(docs)
    model = fit(stats, labels)
    return stats.mapInArrow(
        partial(score_rows, model=model, threshold=threshold), "doc_id long, held_out boolean, score double, predicted int"
    )


def good_rows(batches: Iterator[pa.RecordBatch], model: Model, threshold: float) -> Iterator[pa.RecordBatch]:
    """The rows of each batch whose text scores high enough, all columns as they were."""
    for batch in batches:
        stats = [statistics(words) for _, words in slices(batch.column(batch.schema.names.index("text")))]
        if stats:
            yield batch.filter(pa.array(model.score(np.concatenate(stats)) >= threshold))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of documents whose score reaches the threshold, with their columns as they were."""
    model = fit(text_statistics(docs), labels)
    return docs.mapInArrow(partial(good_rows, model=model, threshold=threshold), docs.schema)
