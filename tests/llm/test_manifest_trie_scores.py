"""Merkle manifest, prefix trie and language-model scores against brute force on small tables of awkward rows."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from llm import language_model, merkle, prefix_trie, queries, radix  # noqa: E402

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest string, rank string, n string, block string, learn string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(count=70):
    made = [(i, f"s{i % 3}" if i % 5 else "hot", "en", i, f"text {i}\n\nline" if i % 4 else "no line") for i in range(count)]
    made += [(None, "hot", None, None, None), (None, "hot", "de", 3, "a\nb"), (900, None, "é", 0, ""), (901, "lone", None, None, None),
             (7, "s1", "en", 7, "other text of the same id"), (8, "s2", "en", 8, "x\ny"), (8, "s2", "en", 8, "x\ny"), (8, "s2", "en", 8, "x\ny")]
    return [(*row, *"zzzzzz") for row in made]


def leaf_of(doc_id, source, lang, n_chars, text):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def tree_of(leaves):
    """Root of a list of digests, and for each the list of (left, right) on its way."""
    ways, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            a = place - place % 3
            run = level[a : a + 3]
            ways[i].append(("".join(run[: place - a]), "".join(run[place - a + 1 :])))
        level, at = [sha("".join(level[a : a + 3])) for a in range(0, len(level), 3)], [p // 3 for p in at]
    return level[0], ways


def manifest_by_hand(rows, tampers):
    groups = defaultdict(list)
    for row in rows:
        doc = row[:5]
        shown = (*doc[:4], doc[4].replace("\n", "")) if doc[4] is not None and tampers(doc[0]) else doc
        groups[doc[1]].append((doc[0], leaf_of(*doc), leaf_of(*shown)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = tree_of([r[1] for r in groups[s]])
    root, upper = tree_of([trees[s][0] for s in order])
    out = []
    for s, crown in zip(order, upper):
        for (doc_id, leaf, shown), way in zip(groups[s], trees[s][1]):
            node = shown
            for left, right in way + crown:
                node = sha(left + node + right)
            out.append((doc_id, leaf, trees[s][0], root, sha("".join(a + b for a, b in way + crown)), node, node == root))
    return out


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0


def told(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_manifest_equals_hand_folding_at_every_block_height(spark, tmp_path, monkeypatch, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rows = documents()
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_merkle_manifest(spark, str(tmp_path))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert told(found) == sorted(manifest_by_hand(rows, tampered), key=repr)


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame(documents()[:1], DOCS)
    row = merkle.manifest(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.path == []
    assert merkle.manifest(one.limit(0)).count() == 0


def test_manifest_without_tampering_verifies_all(spark):
    found = merkle.manifest(spark.createDataFrame(documents(), DOCS))
    assert found.filter("verified").count() == len(documents())


def test_radix_tree_grows_through_all_layouts():
    keys = [bytes([a, 7, b]) for a in range(256) for b in (0, 255)] + [b"", bytes([3]), bytes([3, 7])]
    random.Random(3).shuffle(keys)
    tree = radix.Tree()
    for i, key in enumerate(keys):
        tree.insert(key, i)
    order, kinds = [], set()
    for node, _, _, end in tree.preorder():
        kinds.add(type(node.children).__name__)
        order += [keys[i] for i in node.values]
        assert all(len(keys[i]) == end for i in node.values)
    assert order == sorted(keys)
    few = radix.Tree()
    for a in range(40):
        few.insert(bytes([a]), a)
        kinds.add((type(few.root.children).__name__, getattr(few.root.children, "room", 48)))
    assert {"Direct", ("Sorted", 4), ("Sorted", 16), ("Indexed", 48)} <= kinds


def trie_by_hand(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in given.items()}
    nodes = defaultdict(list)
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(math.fmod(c, 100))
        whole = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append((c, d == len(whole)))
    low = {p: min(c for c, _ in m) for p, m in nodes.items()}
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(
        (low[p], len(p), low[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p], sha(",".join(str(c) for c, e in sorted(m) if e)))
        for p, m in nodes.items()
    )


def conversations():
    draw = random.Random(5)
    rows = []
    for c in [*range(0, 130), 1000, 1037, 2050, -7, -100, -150]:
        for t in range(draw.randrange(1, 7)):
            rows.append((c, t, draw.choice(["user", "bot"]), draw.choice(["hi", "é😀", "", "long " * 5])))
    rows += [(500, None, "user", "first"), (500, None, None, None), (500, 1, "a", "tie"), (500, 1, "a", "Tie"), (500, 1, "a", "tie"), (None, 1, "user", "x")]
    rows += [(600 + i, t, "user", "same") for i in range(9) for t in range(8)]
    rows += [(700, t, "user", f"turn {t % 7}") for t in range(600)] + [(701, t, "user", f"turn {t % 7}") for t in range(590)]
    return rows


def test_trie_equals_hand_counting(spark, tmp_path):
    rows = conversations()
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, ids string, depth int")
    frame.repartition(6).write.parquet(str(tmp_path / "conversations.parquet"))
    found = queries.op13_conversation_prefix_trie(spark, str(tmp_path))
    assert found.columns == list(prefix_trie.RESULT)
    assert sorted(tuple(r) for r in found.collect()) == trie_by_hand(rows) or told(found) == sorted(trie_by_hand(rows), key=repr)


def test_trie_of_no_conversation(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert queries.op13_conversation_prefix_trie(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_stitching_does_not_depend_on_where_blocks_end(size):
    draw = random.Random(size)
    turn = lambda t: hashlib.sha256(str(t).encode()).digest()[:16]
    convs = [(tuple(draw.choice("ab") for _ in range(draw.randrange(0, 6))), c) for c in range(60)] + [(("a", "a", "b"), c) for c in range(100, 120)]
    keyed = sorted((b"".join(map(turn, p)), c, p) for p, c in convs)
    parts, nodes, ends = [], [], []
    for n, at in enumerate(range(0, len(keyed), size)):
        some = keyed[at : at + size]
        for row in prefix_trie.block_rows([k for k, _, _ in some], [b"\x03\0\0\0" * len(p) for _, _, p in some], [c for _, c, _ in some], n):
            {"spine": parts, "node": nodes, "ends": ends}[row["kind"]].append(row)
    parts.sort(key=lambda r: (r["block"], r["side"], r["depth"]))
    fields = [f for f in prefix_trie.BLOCK_SCHEMA]
    import pyarrow as pa

    whole = [r for b in prefix_trie.stitched(iter([pa.RecordBatch.from_pylist(parts, schema=pa.schema(fields))])) for r in b.to_pylist()]
    shared = [r for r in whole if r["kind"] == "node"]
    got = sorted((r["conv_id"], r["depth"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in nodes + shared)
    members, children = defaultdict(list), Counter()
    for p, c in convs:
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    want = sorted(
        (min(m), len(p), len(m), children[p], sum(not children[q] for q in members if q[: len(p)] == p),
         sum((len(members[q]) - 1) * 3 for q in members if q and q[: len(p)] == p))
        for p, m in members.items()
    )
    assert got == want


WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts():
    draw = random.Random(9)
    made = [(i, " ".join(draw.choice("the a cat dog sat on É mat Cat".split()) for _ in range(draw.randrange(0, 30)))) for i in range(60)]
    made += [(100, None), (101, ""), (102, " \t\n\r\x0b\x0c "), (103, "word " * 3000 + "cat sat on"), (None, "the null cat sat"), (5, "the cat sat"), (5, "the cat sat"), (104, "unseen wörter only")]
    return made


def scored_by_hand(rows, held, order, mass):
    seqs = [(i, held(i), ["<s>", *WORD.findall((t or "").translate(FOLD)), "</s>"]) for i, t in rows]
    c = Counter()
    for _, out, s in seqs:
        if not out:
            c[("<s>",)] += 1
            c.update(tuple(s[p - k + 1 : p + 1]) for p in range(1, len(s)) for k in range(1, order + 1) if p - k + 1 >= 0)
    n = sum(v for g, v in c.items() if len(g) == 1 and g != ("<s>",))
    v = sum(len(g) == 1 for g in c if g != ("<s>",))

    def p(h, w):
        if not h:
            return (c[(w,)] + 1) / (n + v + 1)
        m = mass[len(h) - 1]
        return (c[h + (w,)] + m * p(h[1:], w)) / (c[h] + m)

    return [
        (i, out, len(s) - 1, sum(c[(w,)] > 0 for w in s[1:]), n, sum(math.log10(p((), w)) for w in s[1:]),
         sum(math.log10(p(tuple(s[max(0, j - order + 1) : j]), s[j])) for j in range(1, len(s))))
        for i, out, s in seqs
    ]


@pytest.mark.parametrize("order, mass", [(1, ()), (2, (3.0,)), (3, (200.0, 50.0)), (4, (4.0, 2.0, 1.0))])
def test_scores_equal_the_recursive_formula(spark, order, mass):
    rows = texts()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    docs = spark.createDataFrame([(*r, "z", "z", "z") for r in rows], "doc_id long, text string, row string, words string, block string").repartition(4)
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    got = told(language_model.scores(docs, learn, order, mass))
    want = sorted(scored_by_hand(rows, held, order, mass), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    key = lambda r: (repr(r[:5]), r[5])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[5] == pytest.approx(w[5], abs=1e-7) and g[6] == pytest.approx(w[6], abs=1e-7)


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    learn = F.lit(True)
    assert told(language_model.scores(docs.repartition(1), learn)) == told(language_model.scores(docs.repartition(7), learn))


def test_scores_without_rows_and_without_rows_to_learn_from(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    assert language_model.scores(docs.limit(0), F.lit(True)).count() == 0
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in language_model.scores(docs, F.lit(False)).collect()} == {(0, 0, 0.0, 0.0)}


def test_probabilities_of_every_state_sum_to_one(spark):
    rows = [(i, t) for i, t in texts() if i is not None]
    order, mass = 3, (7.0, 2.0)
    seqs = [["<s>", *WORD.findall((t or "").translate(FOLD)), "</s>"] for _, t in rows]
    vocabulary = sorted({w for s in seqs for w in s[1:]})
    history = ["<s>", "the"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("learn", F.lit(True))
    probes = spark.createDataFrame([(10_000 + n, f"the {w}") for n, w in enumerate([*vocabulary, "neverseen"]) if w != "</s>"], "doc_id long, text string")
    ends = spark.createDataFrame([(20_000, "the")], "doc_id long, text string")
    both = docs.unionByName(probes.unionByName(ends).withColumn("learn", F.lit(False)))
    got = {r.doc_id: r.score for r in language_model.scores(both, F.col("learn"), order, mass).filter("held_out").collect()}
    # score("the w") - score of its end; the end follows (the, w), so it is taken from the formula.
    c = Counter(g for s in seqs for p in range(1, len(s)) for k in (1, 2, 3) if p - k + 1 >= 0 for g in [tuple(s[p - k + 1 : p + 1])])
    c[("<s>",)] = len(seqs)
    n, v = sum(x for g, x in c.items() if len(g) == 1 and g != ("<s>",)), len(vocabulary)
    p = lambda h, w: (c[(w,)] + 1) / (n + v + 1) if not h else (c[h + (w,)] + mass[len(h) - 1] * p(h[1:], w)) / (c[h] + mass[len(h) - 1])
    head = math.log10(p(("<s>",), "the"))
    total = 10 ** (got[20_000] - head)
    for m, w in enumerate([*vocabulary, "neverseen"]):
        if w != "</s>":
            total += 10 ** (got[10_000 + m] - head - math.log10(p(("the", w), "</s>")))
    assert history and total == pytest.approx(1.0, abs=1e-9)
