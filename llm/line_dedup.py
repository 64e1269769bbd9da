"""Line deduplication: hash ranges sorted by document and position, streamed, answered by bitmaps of kept lines.

A line's key is the line stripped of ASCII white space with A-Z lowered. Keys of
at least `min_chars` code points that are found in at least `min_docs` documents lose all
their lines except in the largest document id that holds them.

1. Each task hashes the keys of its documents (128 bits). A key that has `min_docs` documents within
   one Arrow batch is settled there for all but the largest of them, so a line that a third of all
   documents hold sends a row per batch, not per document.
2. The rest is dealt out in ranges of the hash and sorted by hash, then document from the largest, then position. A
   stream over each range meets the keeper first, holds back what follows until `min_docs` documents
   have been seen, and passes on the rest; it never holds a key's rows beyond that.
3. The dropped positions of a document become one compressed bitmap. Only those, not lines, go back to the texts.

Defined results: a null or empty text is one empty line. Rows with a null id lose no line and do not count as
documents. Rows that repeat an id count as one document and keep or lose a line alike. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import materialise

#: doc_id and the hash of its text name a row; `common` says that the key has enough documents in its batch.
LINES = "high long, low long, doc_id long, body long, line int, common boolean, settled boolean"
DROPPED = "doc_id long, body long, line int"
KEPT = "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_lines binary"


def long_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(position, key) of the lines whose key is long enough."""
    for n, line in enumerate(text.split(b"\n")):
        key = line.strip().lower()
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
            yield n, key


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins in sorted columns."""
    change = np.ones(len(columns[0]), bool)
    change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return change


def batch_lines(batches: Iterator[pa.RecordBatch], min_chars: int, min_docs: int) -> Iterator[pa.RecordBatch]:
    """The long lines of whole documents, settled as far as one batch can tell."""
    for batch in batches:
        ids, bodies = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        texts = batch.column(1).cast(pa.large_binary())
        marks, owner, line = [], [], []
        for i, doc in enumerate(ids):
            if doc is None:
                continue
            for n, key in long_keys(texts[i].as_py() or b"", min_chars):
                marks.append(xxhash.xxh3_128_digest(key))
                owner.append(i)
                line.append(n)
        if not marks:
            continue
        hashes = np.frombuffer(b"".join(marks), "<i8").reshape(-1, 2)
        owner = np.array(owner)
        doc = np.array([i or 0 for i in ids], np.int64)[owner]
        order = np.lexsort((-doc, hashes[:, 1], hashes[:, 0]))
        high, low, doc, owner = hashes[order, 0], hashes[order, 1], doc[order], owner[order]
        starts = np.flatnonzero(run_starts(high, low))
        sizes = np.diff(starts, append=len(doc))
        docs = np.repeat(np.add.reduceat(run_starts(high, low, doc).astype(np.int64), starts), sizes)
        common = docs >= min_docs
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(high), pa.array(low), pa.array(doc), pa.array(np.array(bodies, np.int64)[owner]),
                pa.array(np.array(line, np.int32)[order]), pa.array(common),
                pa.array(common & (doc != np.repeat(doc[starts], sizes))),
            ],
            names=["high", "low", "doc_id", "body", "line", "common", "settled"],
        )


def streamed_drops(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Positions that a sorted range drops: of a key with enough documents, all but those of its first document."""
    key, keeper, last, count = None, None, None, 0
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low, doc, body, line = (batch.column(c).to_numpy() for c in ("high", "low", "doc_id", "body", "line"))
        common = batch.column("common").to_numpy(zero_copy_only=False)
        fresh = run_starts(high, low, doc)
        starts = np.flatnonzero(run_starts(high, low))
        sizes = np.diff(starts, append=len(doc))
        goes_on = key == (high[0], low[0])
        if goes_on:
            fresh[0] = doc[0] != last
        counts = np.add.reduceat(fresh + min_docs * common, starts)
        keepers = doc[starts]
        if goes_on:
            counts[0] += count
            keepers[0] = keeper
        if held and (not goes_on or counts[0] >= min_docs or len(starts) > 1):
            if goes_on and counts[0] >= min_docs:
                yield dropped_rows([np.concatenate(x) for x in zip(*held)])
            held = []
        lower = doc != np.repeat(keepers, sizes)
        gone = lower & np.repeat(counts >= min_docs, sizes)
        if gone.any():
            yield dropped_rows([doc[gone], body[gone], line[gone]])
        if counts[-1] < min_docs:
            tail = slice(starts[-1], None)
            held.append([x[tail][lower[tail]] for x in (doc, body, line)])
        key, keeper, last, count = (high[-1], low[-1]), keepers[-1], doc[-1], counts[-1]


def dropped_rows(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "body", "line"])


def bitmap(gone: list[int], total: int) -> bytes:
    """Compressed bits of `total` lines, set where the line stays."""
    bits = np.ones(total, bool)
    bits[gone] = False
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def kept_positions(packed: bytes, total: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=total))


def kept_rows(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        rows: list[list] = [[], [], [], [], []]
        for i, gone in enumerate(batch.column("gone").to_pylist()):
            text = texts[i].as_py() or b""
            total = text.count(b"\n") + 1
            packed = bitmap(gone or [], total)
            if gone:
                lines = text.split(b"\n")
                text = b"\n".join(lines[n] for n in kept_positions(packed, total))
            for column, value in zip(rows, (total, len(gone or []), hashlib.sha256(text).hexdigest(), packed, text)):
                column.append(value)
        arrays = [batch.column("doc_id"), *(pa.array(x) for x in rows[:4])]
        names = ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_lines"]
        if with_text:
            arrays, names = [*arrays, pa.array(rows[4], pa.binary()).cast(pa.string())], [*names, "kept_text"]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def line_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, with_text: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256, kept_lines[, kept_text]) for every row of (doc_id, text)."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("body", F.xxhash64("text"))
    found = texts.mapInArrow(partial(batch_lines, min_chars=min_chars, min_docs=min_docs), LINES)
    found = materialise(found, "line-hashes")
    ranges = found.filter("NOT settled").drop("settled").repartitionByRange("high", "low")
    ordered = ranges.sortWithinPartitions("high", "low", F.col("doc_id").desc(), "line")
    dropped = ordered.mapInArrow(partial(streamed_drops, min_docs=min_docs), DROPPED)
    settled = found.filter("settled").select("doc_id", "body", "line")
    # Lines repeated within a text may come both ways.
    gone = dropped.unionByName(settled).groupBy("doc_id", "body").agg(F.collect_set("line").alias("gone"))
    joined = texts.join(gone.hint("merge"), ["doc_id", "body"], "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(partial(kept_rows, with_text=with_text), KEPT + (", kept_text string" if with_text else ""))
