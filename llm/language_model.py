"""Scores of whole texts under an n-gram model learned from the corpus, as a weighted backoff automaton.

States are the contexts seen in training, the empty one included; an arc reads a word and carries its log-probability, and where a state has no
arc for the word, its failure arc leads to the context without its first word at the log of the backoff weight. Probabilities are smoothed by a
Dirichlet prior centred on the shorter context: p(w | h) = (c(hw) + m p(w | h')) / (c(h) + m), down to (c(w) + 1) / (N + V + 1), which also
holds for unknown words; the backoff weight of h is m / (c(h) + m), so the probabilities of every state sum to one.

Training counts never meet in one place. Documents are tokenised once into blocks of bounded size. A block sends its distinct n-grams and its own
counts of them to buckets of the hash space (so a frequent n-gram is one entry a block, not one an occurrence); a bucket adds up and returns the
totals in the order asked. With them a block builds the part of the automaton its texts can reach, and traverses it from left to right, all pieces of
a block in step, carrying a state each. A piece starts some words early, which is enough to be in the state of the whole traversal.

Between blocks, words are compared by 64-bit hashes, and longer n-grams by as many bits as number them all and 30 more (at most 64), so a chance
collision anywhere is unlikely at every size; within a block they are compared exactly. Log-probabilities are whole multiples of 1e-12, so sums do not depend
on order or partitioning. No n-gram is pruned. A block, a bucket and the longest text are what a task holds.

Defined results: null texts are empty, and an empty text is one end token. Rows without id are learned from. Repeated rows are all learned from and
all scored. An empty table gives no rows; without any row to learn from every token has probability 1. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import textkit
from llm.tables import materialise, shuffles_released

ORDER = 3
#: Strength of the prior for contexts of one word, two words, ...
MASS = (200.0, 50.0)
PIECE = 1024
BLOCK_TOKENS = 1 << 20
BUCKET_GRAMS = 1 << 20
#: Keys of n-grams of two and more words have so many bits more than numbering all n-grams needs (64 at most; words always have 64).
SPARE_BITS = 30
SCALE = 10**12
CODEC = pa.Codec("zstd", compression_level=1)
START, END = (textkit.mix64(np.array([n], np.uint64))[0] for n in (11, 12))
START_ID, END_ID = 0, 1

BLOCKS_DDL = (
    "block long, tokens long, words binary, ids binary, row array<long>, doc_id array<long>, learn array<boolean>, "
    "size array<int>, lead array<int>"
)


def planes(values: np.ndarray, width: int) -> bytes:
    """Little-endian integers as compressed bytes, those of equal weight together; the number of integers comes first."""
    bare = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()
    return len(values).to_bytes(4, "little") + CODEC.compress(bare, asbytes=True)


def unplaned(data: bytes, width: int) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    rows = np.frombuffer(CODEC.decompress(data[4:], n * width), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(rows.T).view(f"<u{width}").ravel()


class Gathering:
    """Pieces of texts until they make a block."""

    def __init__(self, order: int):
        self.order, self.held, self.columns, self.hashes = order, 0, ([], [], [], [], []), []

    def add(self, words: np.ndarray, row: int, doc_id: int | None, learn: bool) -> None:
        """One piece: `words` begins with those that only lead into it."""
        self.hashes.append(words)
        self.held += len(words)
        for column, value in zip(self.columns[:3], (row, doc_id, learn)):
            column.append(value)

    def pieces(self, words: np.ndarray, row: int, doc_id: int | None, learn: bool) -> Iterator[None]:
        whole = np.concatenate(([START], words, [END]))
        for at in range(1, len(whole), PIECE):
            lead = min(at, self.order - 1)
            part = whole[at - lead : at + PIECE]
            self.add(part, row, doc_id, learn)
            self.columns[3].append(len(part))
            self.columns[4].append(lead)
            if self.held >= BLOCK_TOKENS:
                yield

    def block(self, number: int) -> pa.RecordBatch:
        hashes = np.concatenate(self.hashes)
        distinct, where, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        marks = np.isin(distinct, (START, END))
        # Frequent words get small numbers, whose upper bytes are zero.
        rank = np.argsort(-counts, kind="stable")
        rank = rank[~marks[rank]]
        ids = np.empty(len(distinct), np.int64)
        ids[rank] = np.arange(2, 2 + len(rank))
        ids[distinct == START], ids[distinct == END] = START_ID, END_ID
        words = np.concatenate(([START, END], distinct[rank]))
        tokens = ids[where]
        row = [
            [number], [int(sum(self.columns[3]) - sum(self.columns[4]))], [words.astype("<u8").tobytes()], [planes(tokens, 4)],
            *([c] for c in self.columns),
        ]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), *map(pa.list_, (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32()))]
        names = ["block", "tokens", "words", "ids", "row", "doc_id", "learn", "size", "lead"]
        self.__init__(self.order)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)


def tokenised(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    number, row, gathering = part << 32, part << 40, Gathering(order)
    for batch in batches:
        docs, learn = batch.column("doc_id").to_pylist(), batch.column("learn").to_pylist()
        for first, words in textkit.slices(batch.column("text")):
            for d in range(words.documents()):
                for _ in gathering.pieces(words.of(d), row, docs[first + d], learn[first + d]):
                    yield gathering.block(number)
                    number += 1
                row += 1
    if gathering.held:
        yield gathering.block(number)


@dataclass
class Level:
    """Distinct k-grams of a block: `codes` ascend, prefix * words + last word; `at` is the k-gram that ends at each token, or -1."""

    codes: np.ndarray
    at: np.ndarray
    prefix: np.ndarray
    last: np.ndarray
    suffix: np.ndarray
    keys: np.ndarray


@dataclass
class Block:
    words: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    leads: np.ndarray
    learned: np.ndarray  # per token: counts in training
    scored: np.ndarray  # per token: not only leading in


def block_of(row: dict) -> Block:
    sizes, leads = np.array(row["size"], np.int64), np.array(row["lead"], np.int64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
    scored = place >= np.repeat(leads, sizes)
    learned = scored & np.repeat(np.array(row["learn"], bool), sizes)
    return Block(np.frombuffer(row["words"], "<u8"), unplaned(row["ids"], 4).astype(np.int64), starts, sizes, leads, learned, scored)


def levels(block: Block, order: int, bits: int) -> list[Level]:
    """All k-grams of a block; keys of k > 1 keep the upper `bits` of their hash."""
    spare = np.uint64(64 - bits)
    w, n = len(block.words), len(block.ids)
    place = np.arange(n) - np.repeat(block.starts, block.sizes)
    every = np.arange(w)
    made, hashes = [Level(every, block.ids, np.zeros(w, np.int64), every, np.zeros(w, np.int64), block.words)], block.words
    for k in range(2, order + 1):
        below = made[-1]
        ends = np.flatnonzero(place >= k - 1)
        codes, found = np.unique(below.at[ends - 1] * w + block.ids[ends], return_inverse=True)
        at = np.full(n, -1, np.int64)
        at[ends] = found
        prefix, last = codes // w, codes % w
        suffix = np.searchsorted(below.codes, below.suffix[prefix] * w + last)
        hashes = textkit.mix64(hashes[prefix] * textkit.POWER + block.words[last])
        made.append(Level(codes, at, prefix, last, suffix, hashes >> spare << spare))
    return made


def own_counts(block: Block, level: Level, k: int) -> np.ndarray:
    """How often each k-gram ends at a token to learn from; the start mark counts once a text."""
    counts = np.bincount(level.at[block.learned & (level.at >= 0)], minlength=len(level.codes))
    if k == 1:
        # A text begins where its first piece does: the start mark leads, and the piece's next token is scored.
        begins = np.flatnonzero((block.ids[:-1] == START_ID) & block.learned[1:])
        counts[START_ID] = len(begins)
    return counts


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in ascending keys; buckets are equal ranges of the hash space."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def wide_enough(count: int) -> int:
    return min(64, count.bit_length() + SPARE_BITS)


GRAMS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("k", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def shift_of(k: int, bits: int) -> np.uint64:
    return np.uint64(64 - bits if k > 1 else 0)


def grams(batches: Iterator[pa.RecordBatch], order: int, buckets: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A row per (bucket, block, k): ascending keys as differences, and the block's counts."""
    for row in rows_of(batches):
        block, out = block_of(row), []
        for k, level in enumerate(levels(block, order, bits), 1):
            rank = np.argsort(level.keys, kind="stable")
            keys, counts = level.keys[rank], own_counts(block, level, k)[rank]
            cuts = bucket_cuts(keys, buckets)
            keys = keys >> shift_of(k, bits)
            for b in np.flatnonzero(np.diff(cuts)):
                a, z = cuts[b], cuts[b + 1]
                steps = np.diff(keys[a:z], prepend=np.uint64(0))
                out.append((int(b), row["block"], k, planes(steps, 8), planes(counts[a:z], 4)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), GRAMS)], schema=GRAMS)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


TOTALS_DDL = "block long, bucket int, k int, totals binary, tokens long, words long"
TOTALS = pa.schema([
    ("block", pa.int64()), ("bucket", pa.int32()), ("k", pa.int32()), ("totals", pa.binary()), ("tokens", pa.int64()), ("words", pa.int64()),
])


def added(asked: pa.Table) -> pa.Table:
    """The totals of one bucket for every block that asked, and its share of N and V in rows without block."""
    out = []
    rows = asked.to_pylist()
    for k in sorted({r["k"] for r in rows}):
        own = [r for r in rows if r["k"] == k]
        keys = [np.cumsum(unplaned(r["keys"], 8), dtype=np.uint64) for r in own]
        counts = np.concatenate([unplaned(r["counts"], 4) for r in own]).astype(np.int64)
        every, where = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(len(every), np.int64)
        np.add.at(totals, where, counts)
        if k == 1:
            words = totals[every != START]
            out.append((None, own[0]["bucket"], k, None, int(words.sum()), int((words > 0).sum())))
        answers = np.split(totals[where], np.cumsum([len(x) for x in keys])[:-1])
        out += [(r["block"], r["bucket"], k, planes(a, 8), None, None) for r, a in zip(own, answers)]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), TOTALS)], schema=TOTALS)


def fixed(p: np.ndarray) -> np.ndarray:
    return np.rint(np.log10(p) * SCALE).astype(np.int64)


@dataclass
class Automaton:
    """State 0 is the empty context. `arcs` ascend, state * words + word; the arcs of state 0 are dense over words."""

    words: int
    first_log: np.ndarray
    first_next: np.ndarray
    arcs: np.ndarray
    arc_log: np.ndarray
    arc_next: np.ndarray
    fail: np.ndarray
    fail_log: np.ndarray


def automaton(stack: list[Level], totals: list[np.ndarray], tokens: int, words: int, mass: tuple[float, ...]) -> Automaton:
    order, w = len(stack), len(stack[0].codes)
    offsets = np.cumsum([0, 1, *(len(level.codes) for level in stack)])[: order + 1]
    share = (totals[0] + 1) / (tokens + words + 1)
    known = totals[0] > 0
    first_next = np.where(known & (order > 1), offsets[1] + np.arange(w), 0)
    keys, logs, nexts, fails, fail_logs = [], [], [], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    first_log = fixed(share)
    for k in range(2, order + 1):
        level, below, m = stack[k - 1], totals[k - 2], mass[k - 2]
        share = (totals[k - 1] + m * share[level.suffix]) / (below[level.prefix] + m)
        arcs = np.flatnonzero(totals[k - 1] > 0)
        keys.append((offsets[k - 1] + level.prefix[arcs]) * w + level.last[arcs])
        logs.append(fixed(share[arcs]))
        nexts.append(offsets[k] + arcs if k < order else offsets[k - 1] + level.suffix[arcs])
        fails.append(offsets[k - 2] + stack[k - 2].suffix if k > 2 else np.zeros(w, np.int64))
        fail_logs.append(fixed(m / (below + m)))
    joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return Automaton(w, first_log, first_next, joined(keys), joined(logs), joined(nexts), joined(fails), joined(fail_logs))


def traversed(machine: Automaton, block: Block) -> np.ndarray:
    """The log-probability of every piece: all read their next word at once, each from its own state."""
    rank = np.argsort(-block.sizes, kind="stable")
    starts, sizes, leads = block.starts[rank], block.sizes[rank], block.leads[rank]
    state, total = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
    reading = np.searchsorted(-sizes, -np.arange(int(sizes.max())), "left")
    for t, n in enumerate(reading):
        word = block.ids[starts[:n] + t]
        gained, open_ = np.zeros(n, np.int64), np.flatnonzero(state[:n])
        top = np.ones(n, bool)
        while len(open_):
            at = state[open_]
            wanted = at * machine.words + word[open_]
            arc = np.searchsorted(machine.arcs, wanted)
            has = arc < len(machine.arcs)
            has[has] = machine.arcs[arc[has]] == wanted[has]
            taken, lost = open_[has], open_[~has]
            gained[taken] += machine.arc_log[arc[has]]
            state[taken] = machine.arc_next[arc[has]]
            top[taken] = False
            gained[lost] += machine.fail_log[at[~has]]
            state[lost] = machine.fail[at[~has]]
            open_ = lost[state[lost] > 0]
        rest = np.flatnonzero(top)
        gained[rest] += machine.first_log[word[rest]]
        state[rest] = machine.first_next[word[rest]]
        total[:n] += np.where(t >= leads[:n], gained, 0)
    out = np.empty_like(total)
    out[rank] = total
    return out


SCORED = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("learn", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base", pa.int64()), ("score", pa.int64()),
])
SCORED_DDL = "row long, doc_id long, learn boolean, n_tokens long, n_known long, base long, score long"


def block_scores(blocks: pa.Table, answers: pa.Table, order: int, bits: int, tokens: int, words: int, mass: tuple[float, ...]) -> pa.Table:
    """Per piece of one block: tokens, known tokens, base and model log-probability (in units of 1 / SCALE)."""
    row = blocks.to_pylist()[0]
    block = block_of(row)
    stack = levels(block, order, bits)
    by_level: dict[int, list] = {}
    for r in answers.select(["k", "bucket", "totals"]).to_pylist():
        by_level.setdefault(r["k"], []).append((r["bucket"], r["totals"]))
    totals = []
    for k, level in enumerate(stack, 1):
        told = [unplaned(t, 8) for _, t in sorted(by_level.get(k, []))]
        counts = np.empty(len(level.codes), np.int64)
        counts[np.argsort(level.keys, kind="stable")] = np.concatenate(told) if told else []
        totals.append(counts)
    machine = automaton(stack, totals, tokens, words, mass)
    scored = traversed(machine, block)
    summed = lambda per_token: np.add.reduceat(np.where(block.scored, per_token, 0), block.starts)
    known = summed(totals[0][block.ids] > 0)
    base = summed(machine.first_log[block.ids])
    return pa.Table.from_arrays([
        pa.array(row["row"], pa.int64()), pa.array(row["doc_id"], pa.int64()), pa.array(row["learn"], pa.bool_()),
        pa.array(block.sizes - block.leads), pa.array(known.astype(np.int64)), pa.array(base), pa.array(scored),
    ], schema=SCORED)


def scores(docs: DataFrame, learn: Column, order: int = ORDER, mass: tuple[float, ...] = MASS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row (doc_id, text), learned from rows where `learn` is true."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(learn, F.lit(True)).alias("learn")
    )
    blocks = materialise(rows.mapInArrow(partial(tokenised, order=order), BLOCKS_DDL), "lm-blocks")
    # Three numbers reach the driver: tokens of all texts, and N and V of those learned from.
    every = blocks.agg(F.sum("tokens")).first()[0] or 0
    buckets, bits = max(1, -(-every * order // (2 * BUCKET_GRAMS))), wide_enough(every * order)
    asked = blocks.mapInArrow(partial(grams, order=order, buckets=buckets, bits=bits), "bucket int, block long, k int, keys binary, counts binary")
    with shuffles_released(docs.sparkSession):
        totals = materialise(asked.groupBy("bucket").applyInArrow(added, TOTALS_DDL), "lm-totals")
    tokens, words = totals.filter("block IS NULL").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    answers = totals.filter("block IS NOT NULL").select("block", "k", "bucket", "totals")

    def told(own: pa.Table, given: pa.Table) -> pa.Table:
        return block_scores(own, given, order, bits, tokens, words, mass)

    pieces = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(told, SCORED_DDL)
    exact = lambda c: (F.sum(F.col(c).cast("decimal(38,0)")).cast("double") / F.lit(float(SCALE)))
    return pieces.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), (~F.first("learn")).alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), exact("base").alias("base_score"),
        exact("score").alias("score"),
    ).drop("row")
