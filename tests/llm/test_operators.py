"""Every operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

import hashlib
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from llm import chat, decontaminate, exact_dedup, licences, line_dedup, mixing, ngram_join, pii, quality, sharding  # noqa: E402
from llm.tables import components  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
BASE = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
SHAPE = "doc_id long, text string, source string, node string, size string, kept string, record string, quality_score string"
ROWS = [
    (1, BASE, "b"), (2, BASE.replace("word30", "other"), "b"), (3, BASE.upper(), "b"), (4, None, "a"), (5, "", None),
    (6, " \t\n ", "a"), (7, "one two", "c"), (8, "One  two", "c"), (9, LONG, "c"), (10, "x " + BASE, None), (11, "é ß 😀 line\nline", "d"),
    (11, "é ß 😀 line\nline", "d"), (None, BASE, "b"), (None, None, None), (12, "a line that many share, long enough\nshort\n tail", "d"),
    (13, "A LINE that many share, long enough \nb", "d"), (14, "a line that many share, long enough\n\na line that many share, long enough", "a"),
    (15, "mail me at a.b@c.org or +1 (555) 010-9999 now, 10.0.0.256 10.0.0.1, 4111 1111 1111 1111", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in ROWS], SHAPE)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


def words(text):
    return [w.lower() for w in (text or "").encode().split()]


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def linked(rows, k, num, den):
    sets, up = [(i, shingles(t, k)) for i, t in rows if i is not None], {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for n, (i, s) in enumerate(sets):
        for j, t in sets[:n]:
            if s and t and den * len(s & t) >= num * len(s | t):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {(i, len(s), root(i)) for i, s in sets}


def test_components_of_paths_stars_and_rings(spark):
    path, ring = [(i, i + 1) for i in range(40, 70)], [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    star, turned, chained = [(1, i) for i in range(2, 20)], [(99, i) for i in range(80, 99)], [(300, 301), (302, 301), (301, 303)]
    links = path + ring + star + turned + chained + [(1, 2), (7, 7)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        up[high] = low
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in up if root(x) != x or any(root(y) == x and y != x for y in up))
    assert not components(spark.createDataFrame([], "a long, b long")).count()


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 8, 10)])
@pytest.mark.parametrize("tile", [3, 2048])
def test_near_copies(spark, docs, monkeypatch, k, num, den, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    family = [(100 + i, BASE.replace(f"word{i}", f"edit{i}").replace(f"word{2 * i % 60}", f"edit{i}")) for i in range(40)]
    more = spark.createDataFrame([(i, t, *["x"] * 6) for i, t in family], SHAPE)
    got = ngram_join.jaccard_components(docs.unionByName(more), k, num, den).collect()
    assert len(got) == len(ROWS) + 40
    assert {tuple(r) for r in got if r.doc_id is not None} == linked([r[:2] for r in ROWS] + family, k, num, den)
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_blocks_meet_every_linked_pair():
    import numpy as np

    draws = np.random.default_rng(5)
    for n in (2, 5, 9, 10, 19, 40, 150, 700):
        for num, den in ((9, 10), (8, 10)):
            for _ in range(20):
                a = np.unique(draws.integers(0, 2**63, n).astype(np.uint64))
                lost = int(draws.integers(0, n * (den - num) // den + 1))
                b = np.unique(np.concatenate([a[lost:], draws.integers(0, 2**63, n // 10).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if den * both >= num * (len(a) + len(b) - both):
                    assert np.intersect1d(ngram_join.block_keys(a, num, den), ngram_join.block_keys(b, num, den)).size


def test_tree_finds_every_pair():
    import numpy as np

    draws = np.random.default_rng(6)
    points = draws.poisson(3, (300, ngram_join.AXES)).astype("<i4")
    points[150:] = points[:150] + (draws.random((150, ngram_join.AXES)) < 0.05)
    sizes, labels = points.sum(1).astype(np.int64), np.arange(300) // 2
    tree = ngram_join.bulk_load(points, sizes, labels)
    got = {tuple(sorted(p)) for i, j in ngram_join.tree_pairs(tree, tree, points, sizes, labels, 9, 10) for p in zip(i.tolist(), j.tolist())}
    need = ngram_join.least_overlap(sizes[:, None] + sizes[None, :], 9, 10)
    shared = np.minimum(points[:, None, :], points[None, :, :]).sum(2)
    want = {(i, j) for j in range(300) for i in range(j) if shared[i, j] >= need[i, j] and labels[i] != labels[j]}
    assert got == want and want


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                    "card": lambda: 12 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()
            if good:
                out.append((m.start(), n, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


TRICKY = [
    "a@b.com_x@c.de..q x@y a@b@c.d. me.you@h-1.co.uk. 1.2.3.4.5.6.7.8 256.1.1.1 000255.1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111x4111  1111",
    "+1 (266) 555-7228 +49.30.1234567- +12 é 😀 +44 20 7946 0958 a@b.c", "1 2 3 " * 4000, "a." * 5000 + "@" + "b." * 5000,
    "\x01\x0212\x0134@ a\x02b@c\x02d.e 4111\x011111", "x" * 100_000, "name (at) host.com 555-123-4567", None, "", "9" * 50_000,
]


def test_private_spans(spark, docs):
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(TRICKY, 200)), "doc_id long, text string"))
    got = pii.private_spans(frame).collect()
    assert len(got) == len(ROWS) + len(TRICKY)
    texts = dict([r[:2] for r in ROWS] + list(enumerate(TRICKY, 200)))
    for r in got:
        if r.doc_id is None:
            continue
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (r.doc_id, want)
        assert {*want.split(",")} - {""} <= {*r.spans.split(",")}
        assert [r[f"n_{k}"] for k in PATTERNS] == [want.count(f"{k}:") for k in PATTERNS]
    hidden = pii.redacted(frame.filter("doc_id = 15")).first().text
    assert hidden.startswith("mail me at <email> or <phone> now, 10.0.0.256 <ip>, <card>")


def test_private_spans_of_other_forms_are_added(spark):
    good, bad = ("4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009"), ("4111 1111 1111 1112", "5500 0000 0000 0005", "3400 0000 0000 001")
    forms = [*(f"card {c} ok" for c in good), *(f"card {c} no" for c in bad), "mail a.b@c.org now", "host 10.0.0.1 up", "host 10.0.0.256 up", "call +1 555 010 9999 now", "see +12 34 x"]
    rows = [(i, forms[i % len(forms)]) for i in range(30 * len(forms))]
    # Many of each, as on a corpus.
    planted = {"card 4111.1111.1111.1111 ok": "card:5:24", "card 4111.1111.1111.1112 ok": "", "mail joe (at) host.com now": "email:5:22"}
    rows += [(1000 + i, list(planted)[i % 3]) for i in range(600)]
    got = {r.doc_id: r.spans for r in pii.private_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(600):
        want = list(planted.values())[i % 3]
        assert (want in got[1000 + i].split(",")) if want else got[1000 + i] == "", (rows[len(rows) - 600 + i], got[1000 + i])


def test_benchmark_copies(spark, docs):
    item = "The quick, brown fox jumps over the lazy dog while seven wizards brew potent quince jelly for kings."
    edited = item.replace("lazy", "sleepy").replace("potent", "strong").upper()
    rows = [(300, "intro text here " + item + " and more words follow"), (301, "before " + edited + " after"), (302, "the quick brown fox is here"),
            (303, LONG + " " + item), (304, " ".join(reversed(item.split())))]
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "too short", "x"), (None, item, "x"), (6, item, "x")], "item_id long, text string, doc_id string")
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    for block_words in (1_000_000, 40):
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(frame, bench, block_words=block_words).collect()}
        assert set(got) == {(d, i) for d in (300, 301, 303) for i in (1, 6)}
        assert got[300, 1] == 1.0 and 0.7 < got[301, 1] < 1.0
    left = decontaminate.clean(frame, bench)
    assert left.columns == ["doc_id", "text"] and left.count() == len(ROWS) + 2


def test_frequent_truncated_copies_keep_a_window(spark):
    item = " ".join(f"leak{i}" for i in range(20))
    start = " ".join(item.split()[:12])
    rows = [(0, item)] + [(i, f"a{i} b{i} {start} c{i} d{i}") for i in range(1, 61)] + [(i, f"e{i} {item[-23:]}") for i in range(61, 64)]
    frame, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    for options in ({}, {"rare": 0.0, "factor": 1}, {"rare": 1.0}):
        got = {r.doc_id: r.score for r in decontaminate.contaminated(frame, bench, **options).collect()}
        assert got == {0: 1.0} | {i: 0.6 for i in range(1, 61)}, options


def test_reach_is_a_bound_of_the_score():
    import numpy as np

    rng = np.random.default_rng(5)
    items, texts = rng.integers(1, 9, (400, 12)).astype(np.uint64), rng.integers(1, 12, (400, 30)).astype(np.uint64)
    lengths = rng.integers(4, 13, 400)
    texts[::3, 20:] = 0
    scores = decontaminate.aligned(items, lengths, texts)[0] / (2 * lengths)
    for least in (0.5, 0.75, 0.9):
        near = decontaminate.within_reach(items, lengths, texts, least)
        assert near[scores >= least].all() and (~near).any()


def smith_waterman(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if x == y else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
    return max(map(max, table))


def test_alignment_is_smith_waterman():
    import numpy as np

    draws = np.random.default_rng(8)
    items, texts = draws.integers(1, 6, (60, 12)).astype(np.uint64), draws.integers(1, 6, (60, 30)).astype(np.uint64)
    lengths = draws.integers(1, 13, 60)
    best, _ = decontaminate.aligned(items, lengths, texts)
    assert best.tolist() == [smith_waterman(a[:n].tolist(), b.tolist()) for a, n, b in zip(items, lengths, texts)]


def test_licence_lines(spark, docs):
    rows = [(400, "Some prose.\nLicensed under the Apache License, Version 2.0.\nAll rights reserved."), (401, "RELEASED!! UNDER!! THE!! MIT!! LICENSE!!"),
            (402, "Licensed under CC BY-NC 4.0."), (403, "This work is licensed under the GNU General Public License, version 3."), (404, "a driving license")]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.doc_id, r.line): r.family for r in licences.licence_lines(frame).collect()}
    assert got == {(400, 1): "apache", (400, 2): "unknown", (401, 0): "mit", (402, 0): "cc-by-nc", (403, 0): "gpl", (404, 0): "unknown"}


def test_wrapped_and_short_licences(spark):
    gpl = licences.TEMPLATES["gpl"][1].split()
    rows = [(n, "Prose before it.\n\n" + "\n".join(" * " + " ".join(gpl[i : i + n]) for i in range(0, len(gpl), n)) + "\n\nA new part.") for n in (3, 4, 9)]
    names = {"CC-BY-SA 4.0": "cc-by-sa", "GPLv3": "gpl", "MPL-2.0": "mozilla", "BSD 3-Clause": "bsd", "GNU/GPL": "gpl", "the public\nwas free": None, "GPL": "unknown"}
    rows += list(enumerate(names, 100))
    rows += [(200, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0")]
    got = {(r.doc_id, r.line): r.family for r in licences.licence_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n in (3, 4, 9):
        assert {k[1]: f for k, f in got.items() if k[0] == n} == dict.fromkeys(range(2, 2 + -(-len(gpl) // n)), "gpl"), n
    assert {i: got.get((i, 0)) for i in range(100, 107)} == dict(enumerate(names.values(), 100))
    assert (got[200, 0], got[200, 1]) == ("mit", "apache")


def test_line_dedup(docs):
    holders = defaultdict(set)
    strip = lambda x: x.encode().strip().lower()
    for i, t, _ in ROWS:
        for x in (t or "").split("\n"):
            if i is not None and len(strip(x).decode()) >= 20:
                holders[strip(x)].add(i)
    got = line_dedup.line_bitmaps(docs, with_text=True).collect()
    want = []
    for i, t, _ in ROWS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[strip(x)]) < 3 or i == max(holders[strip(x)])]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got) == Counter(want)
    assert any(r.n_dropped for r in got)
    for r in got:
        assert r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest()
        assert len(line_dedup.kept_positions(bytes(r.kept_lines), r.n_lines)) == r.n_lines - r.n_dropped


def test_line_stream_over_batches():
    import pyarrow as pa

    rows = [(1, 1, d, 7, n, False, ) for d, n in ((9, 0), (9, 1), (5, 0), (3, 2))] + [(2, 1, 4, 7, 0, False), (2, 1, 1, 7, 0, False), (3, 3, 8, 7, 0, True), (3, 3, 2, 7, 1, False)]
    names = ["high", "low", "doc_id", "body", "line", "common"]
    for size in (1, 2, 3, 8):
        parts = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names=names) for i in range(0, len(rows), size)]
        out = [tuple(r.values()) for b in line_dedup.streamed_drops(iter(parts), 3) for r in b.to_pylist()]
        assert sorted(out) == [(2, 7, 1), (3, 7, 2), (5, 7, 0)], size


def test_line_stream_forgets_a_key_of_too_few_documents():
    import pyarrow as pa

    names = ["high", "low", "doc_id", "body", "line", "common"]
    rare = [(1, 1, d, 7, n, False) for d, n in ((9, 0), (5, 1), (5, 2), (5, 3))]
    often = [(2, 1, d, 7, 0, False) for d in (8, 7, 6)]
    # The same document from two batches, of which only the second saw enough documents.
    mixed = [(3, 1, 8, 7, 0, False), (3, 1, 8, 7, 4, True), (3, 1, 2, 7, 0, False)]
    for rows, want in ((rare + often, [(6, 7, 0), (7, 7, 0)]), (rare + often + mixed, [(2, 7, 0), (6, 7, 0), (7, 7, 0)])):
        for size in (1, 2, 3, 4):
            parts = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names=names) for i in range(0, len(rows), size)]
            out = [tuple(r.values()) for b in line_dedup.streamed_drops(iter(parts), 3) for r in b.to_pylist()]
            assert sorted(out) == want, (size, out)


def test_mixing(spark, docs):
    got = mixing.mixed(docs).collect()
    assert len(got) == len(ROWS)
    total = sum(r.size for r in got)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(words(t))) for i, t, _ in ROWS)
    assert all(0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size for r in got)
    by_target = {(r.source_size, r.target) for r in got}
    assert abs(sum(t for _, t in by_target) - 1.5 * total) < 1e-6
    big = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', int(1 + id % 97)) AS text", "concat('s', id % 3) AS source")
    rows = mixing.mixed(big, keep=["source"]).collect()
    for s in ("s0", "s1", "s2"):
        mine = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 97
    assert sorted(rows) == sorted(mixing.mixed(big.repartition(5), keep=["source"]).collect())


def test_quality(spark, docs):
    folder = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = {r.doc_id: r for r in quality.scored(folder, labels).collect()}
    assert len(got) == folder.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert sum(got[i].predicted == q for i, q in truth.items() if got[i].held_out) >= 0.85 * sum(got[i].held_out for i in truth)
    odd = quality.scored(docs, labels).collect()
    assert len(odd) == len(ROWS) and len({r.score for r in odd if r.doc_id in (4, 5)}) == 1
    assert quality.accepted(docs, labels).columns == docs.columns
    assert {r.score for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}


def test_exact_groups(docs):
    plain = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, _ in ROWS]
    want = Counter()
    for i, t in plain:
        same = [j for j, u in plain if u == t]
        keep = min((j for j in same if j is not None), default=None)
        want[(i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter(map(tuple, exact_dedup.exact_groups(docs).collect())) == want


def test_sharding(spark, docs, tmp_path):
    for frame, n, shards in ((docs, len(ROWS), 24), (docs, len(ROWS), 4), (spark.range(1003).selectExpr("id AS doc_id", "cast(id AS string) AS text"), 1003, 24)):
        got = sharding.sharded(frame, shards=shards).collect()
        assert len(got) == n
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        counts = [len(slots[s]) for s in range(shards)]
        assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert all(r.law == "rows" and r.grown_shard is None for r in got)
    text = {r[0]: r[1] or "" for r in ROWS}
    for r in sharding.sharded(docs).collect():
        if r.doc_id is not None:
            assert (r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 8, zlib.crc32(text[r.doc_id].encode()))
    sharding.write_shards(docs, str(tmp_path / "out"), shards=3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


def cheapest(roles):
    """Every repair by exhaustive search over states."""
    best = {chat.NONE: 0}
    steps = chat.ways((chat.MERGE, chat.RELABEL, chat.INSERT))
    for role in roles:
        after = {}
        for state, cost in best.items():
            for c, to, _, _ in steps[role][state]:
                after[to] = min(after.get(to, chat.FAR), cost + c)
        best = after
    return min(c + chat.closing(s, (chat.MERGE, chat.RELABEL, chat.INSERT)) for s, c in best.items())


PRICES = {"keep": 0, "merge": chat.MERGE, "relabel": chat.RELABEL, "relabel+merge": chat.RELABEL + chat.MERGE, "insert": chat.INSERT}


@pytest.mark.parametrize("piece", [2, 1024])
def test_chat(spark, monkeypatch, piece):
    monkeypatch.setattr(chat, "PIECE", piece)
    talks = {
        1: ["user", "assistant"], 2: ["assistant", "user"], 3: ["system", "system", "user", "user", "assistant"], 4: ["user"], 5: ["system"],
        6: [None, "Human", " BOT ", "odd", "user", "assistant", "assistant", "system", "user"], 7: ["assistant"] * 7, 8: ["user", "system"] * 4,
    }
    rows = [(k, n, r, f"t{n}" if n % 2 else None, "x") for k, v in talks.items() for n, r in enumerate(v)] + [(None, None, "user", "q", "x")]
    got = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, given string")).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.conv_id or 0, r.position)):
        by[r.conv_id].append(r)
    code = {"system": 1, "user": 2, "assistant": 3}
    for k, v in by.items():
        assert [r.position for r in v] == list(range(len(v)))
        given = talks.get(k, ["user"])
        assert sum(r.change != "insert" for r in v) == len(given)
        turns = [r.role for r in v if not r.change.endswith("merge")]
        assert [r.out_turn for r in v if not r.change.endswith("merge")] == list(range(len(turns)))
        body = turns[1:] if turns[0] == "system" else turns
        assert len(body) % 2 == 0 and all(x == ("user", "assistant")[i % 2] for i, x in enumerate(body))
        names = [chat.NAMES.get((r or "").strip().lower(), (r or "").strip().lower()) for r in given]
        assert sum(PRICES[r.change] for r in v) == cheapest([code.get(n, 0) for n in names])
        text = "".join(r.rendered for r in v)
        assert text.count("<|end|>") == len(turns) and text.endswith("<|end|>\n")


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for frame in (
        ngram_join.jaccard_components(none), pii.private_spans(none), decontaminate.contaminated(none, bench), licences.licence_lines(none),
        line_dedup.line_bitmaps(none), mixing.mixed(none), quality.scored(none, labels), exact_dedup.exact_groups(none), sharding.sharded(none),
        chat.formatted(talk),
    ):
        assert frame.count() == 0
