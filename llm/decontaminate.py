"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts are lowered, words are parted by white space and ASCII punctuation.

1. The test items are the query set, taken in blocks of at most about `block_words` words; a block is the only thing
   that goes to every task, and each document meets every block. A larger benchmark means more blocks.
2. A first pass counts in how many documents each n-gram of the block occurs, summed per task before the shuffle.
3. An n-gram is a rare seed of an item if no more than `rare` of all documents hold it, or no more than
   `factor` times as many as hold the item's rarest n-gram that occurs at all.
4. A second pass looks all n-grams up in whole texts. One at word p of a text and word o of an item puts the item at p - o; each such
   place is a window around the item's length. A window with a rare seed is aligned. One with frequent n-grams only is aligned
   unless too few words of the item stand in it for a score of `least` (`within_reach`): that bound is exact, so
   `rare` and `factor` decide what is computed, never what is found.
5. The item is aligned in the window, word by word, by Smith-Waterman (equal
   words `MATCH`, other words and gaps `MISS`). All windows of a slice of texts advance together, one item word at a time.
   The score is the best local alignment over that of an exact copy. A copy that keeps no `n` words of the item in a row has no window.

Texts are never shuffled, and a hot document or item is only more windows in its own task.

Defined results: null or empty texts and items match nothing, nor do items of fewer than `n` words. A null id is a document like others and comes back as
null. Rows that repeat an id are reported as one; items that repeat a text are reported each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import materialise
from llm.textkit import LETTER_WORDS, Words, mix64, rolling, slices

MATCH, MISS = 2, -1
#: Places of n-grams that are spread out at a time.
PLACES = 1 << 20
PAIRS = "doc_id long, item_id long, score double, end_word long"


@dataclass(frozen=True)
class Items:
    """Test items of one block: word hashes one after the other, and their n-grams in order of hash."""

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray
    grams: np.ndarray  # distinct n-grams, sorted
    spans: np.ndarray  # where each n-gram's places begin
    owner: np.ndarray  # item of each place
    offset: np.ndarray  # word of the item at each place

    def only(self, keep: np.ndarray) -> Items:
        """The same items with the places `keep` left as seeds."""
        index = np.repeat(np.arange(len(self.grams)), np.diff(self.spans))[keep]
        used, counts = np.unique(index, return_counts=True)
        return Items(
            self.ids, self.words, self.first, self.grams[used], np.concatenate(([0], np.cumsum(counts))),
            self.owner[keep], self.offset[keep],
        )


def items_of(rows: list, n: int) -> Items:
    ids = np.array([r["item_id"] for r in rows], np.int64)
    words = [w.of(d) for _, w in slices(pa.array([r["text"] for r in rows], pa.large_string()), LETTER_WORDS) for d in range(w.documents())]
    grams = [rolling(w, n) for w in words]
    every = np.concatenate(grams)
    owner = np.repeat(np.arange(len(words)), [len(g) for g in grams])
    offset = np.concatenate([np.arange(len(g)) for g in grams])
    order = np.argsort(every, kind="stable")
    distinct, counts = np.unique(every, return_counts=True)
    return Items(
        ids, np.concatenate(words), np.concatenate(([0], np.cumsum([len(w) for w in words]))),
        distinct, np.concatenate(([0], np.cumsum(counts))), owner[order], offset[order],
    )


def hits(words: Words, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word, n-gram) of every place of a slice where a sought n-gram stands."""
    every = rolling(words.hashes, n)
    at = np.searchsorted(grams, every)
    at[at == len(grams)] = 0
    place = np.flatnonzero(grams[at] == every)
    doc = np.searchsorted(words.first, place, "right") - 1
    inside = place + n <= words.first[doc + 1]
    place, doc = place[inside], doc[inside]
    return doc, place - words.first[doc], at[place]


def frequencies(batches: Iterator[pa.RecordBatch], items: Items, n: int) -> Iterator[pa.RecordBatch]:
    """Per task: number of documents, as n-gram -1, and how many of them hold each n-gram."""
    counts, total = np.zeros(len(items.grams), np.int64), 0
    for batch in batches:
        for _, words in slices(batch.column(0), LETTER_WORDS):
            total += words.documents()
            doc, _, gram = hits(words, items.grams, n)
            pair = np.unique(doc * len(items.grams) + gram)
            counts += np.bincount(pair % len(items.grams), minlength=len(items.grams))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(([-1], used))), pa.array(np.concatenate(([total], counts[used])))], names=["gram", "docs"]
    )


def seen_seeds(items: Items, docs: np.ndarray, total: int, rare: float, factor: int) -> tuple[Items, np.ndarray]:
    """Only the places of n-grams that occur, and which of them are rare for their item."""
    held = np.repeat(docs, np.diff(items.spans))
    seen = held > 0
    least = np.full(len(items.ids), np.iinfo(np.int64).max)
    np.minimum.at(least, items.owner[seen], held[seen])
    bound = np.maximum(rare * total, factor * least[items.owner].astype(float))
    return items.only(seen), (held <= bound)[seen]


def aligned(items: np.ndarray, lengths: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score and its last word, for rows of padded items and windows.

    Padding of items is skipped by length; padding of windows is 0, which no word hash of an item equals in practice.
    A gap within a row is a running maximum, so only the item's words are a loop.
    """
    rows, width = texts.shape
    fall = np.arange(width, dtype=np.int32) * -MISS
    above = np.zeros((rows, width), np.int32)
    best, end = np.zeros(rows, np.int32), np.zeros(rows, np.int64)
    for i in range(items.shape[1]):
        step = np.where(texts == items[:, i : i + 1], MATCH, MISS).astype(np.int32)
        step[:, 1:] += above[:, :-1]
        line = np.maximum(np.maximum(step, above + MISS), 0)
        line = np.maximum.accumulate(line + fall, axis=1) - fall
        live = i < lengths
        top = line.argmax(1)
        value = line[np.arange(rows), top]
        better = live & (value > best)
        best[better], end[better] = value[better], top[better]
        above = line
    return best, end


def within_reach(items: np.ndarray, lengths: np.ndarray, texts: np.ndarray, least: float) -> np.ndarray:
    """Whether a window has enough of its item's words for a score of `least`, for rows as in `aligned`.

    Every match takes a word of the item and an equal one of the window, so that share of the words has to meet.
    """
    salt = mix64(np.arange(len(items), dtype=np.uint64))[:, None]
    row, column = np.nonzero(np.arange(items.shape[1]) < lengths[:, None])
    sought, at, wanted = np.unique((items ^ salt)[row, column], return_index=True, return_counts=True)
    there = (texts ^ salt)[texts != 0]
    place = np.minimum(np.searchsorted(sought, there), len(sought) - 1)
    found = np.bincount(place[sought[place] == there], minlength=len(sought))
    return np.bincount(row[at], np.minimum(wanted, found), len(items)) >= least * lengths - 1e-9


def windows(words: Words, items: Items, rare: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(item, document, tile) of the windows of a slice that hold an n-gram, and whether it is a rare seed; some may come twice."""
    every_doc, every_place, every_gram = hits(words, items.grams, n)
    ends = np.cumsum(np.diff(items.spans)[every_gram])
    cuts = np.flatnonzero(np.diff(ends // PLACES, prepend=0))
    for at in np.split(np.arange(len(ends)), cuts):
        if not len(at):
            continue
        doc, place, gram = every_doc[at], every_place[at], every_gram[at]
        counts = items.spans[gram + 1] - items.spans[gram]
        which = np.repeat(items.spans[gram], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        doc, place = np.repeat(doc, counts), np.repeat(place, counts)
        item = items.owner[which]
        tile = (place - items.offset[which]) // np.diff(items.first)[item]
        order = np.lexsort((~rare[which], tile, doc, item))
        keys = np.column_stack([item, doc, tile])[order]
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]).any(1)
        yield keys[first], rare[which][order][first]


def window_scores(
    words: Words, items: Items, rare: np.ndarray, n: int, least: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(document, item, score, last word) of the windows of a slice that reach `least`."""
    for keys, seeded in windows(words, items, rare, n):
        for at in np.array_split(np.arange(len(keys)), -(-len(keys) // 256)):
            item, doc, tile = keys[at].T
            length = np.diff(items.first)[item]
            # A copy at the threshold can hold this many words of its own, on either side of its seed.
            slack = np.ceil(2 * (1 - least) * length).astype(np.int64) + n
            start = np.maximum(tile * length - slack, 0)
            size = words.first[doc + 1] - words.first[doc]
            stop = np.minimum((tile + 2) * length + slack, size)
            wide, deep = int((stop - start).max()), int(length.max())
            column = start[:, None] + np.arange(wide)
            index = np.minimum(words.first[doc][:, None] + column, len(words.hashes) - 1)
            texts = np.where(column < stop[:, None], words.hashes[index], np.uint64(0))
            row = np.arange(deep)
            sought = items.words[np.minimum(items.first[item][:, None] + row, len(items.words) - 1)]
            go = seeded[at].copy()
            if not go.all():
                go[~go] = within_reach(sought[~go], length[~go], texts[~go], least)
            if not go.any():
                continue
            best, end = aligned(sought[go], length[go], texts[go])
            score = best / (MATCH * length[go])
            keep = score >= least
            yield doc[go][keep], item[go][keep], score[keep], (start[go] + end)[keep]


def scored_windows(
    batches: Iterator[pa.RecordBatch], items: Items, rare: np.ndarray, n: int, least: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for at, words in slices(batch.column(1), LETTER_WORDS):
            for doc, item, score, end in window_scores(words, items, rare, n, least):
                if len(doc):
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(doc + at)), pa.array(items.ids[item]), pa.array(score), pa.array(end)],
                        names=["doc_id", "item_id", "score", "end_word"],
                    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, n: int = 4, least: float = 0.5, rare: float = 0.001, factor: int = 8,
    block_words: int = 1_000_000,
) -> DataFrame:
    """(doc_id, item_id, score, end_word): documents (doc_id, text) that hold a copy of an item (item_id, text), edited or not.

    Items without id or text are no test items and are left out.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    items = materialise(
        benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(
            F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text")
        ),
        "test-items",
    )
    # A word has a letter and a gap, so bytes / 2 is above the number of words.
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // (2 * block_words))
    found = []
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        block = items_of(rows, n) if rows else None
        if block is None or not len(block.grams):
            continue
        counted = texts.select("text").mapInArrow(partial(frequencies, items=block, n=n), "gram long, docs long")
        sums = {r["gram"]: r["docs"] for r in counted.groupBy("gram").agg(F.sum("docs").alias("docs")).collect()}
        docs_with = np.zeros(len(block.grams), np.int64)
        number = sums.pop(-1, 0)
        docs_with[list(sums)] = list(sums.values())
        seeds, are_rare = seen_seeds(block, docs_with, number, rare, factor)
        if len(seeds.grams):
            found.append(texts.mapInArrow(partial(scored_windows, items=seeds, rare=are_rare, n=n, least=least), PAIRS))
    if not found:
        return spark.createDataFrame([], PAIRS)
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("score", "end_word")).alias("best"))
        .select("doc_id", "item_id", "best.score", "best.end_word")
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows whose id is in no contaminated pair; rows without id stay."""
    hit = contaminated(docs, benchmark, **options).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(*docs.columns)
