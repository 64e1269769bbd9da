"""One query per operator over the driver's tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import (
    chat, decontaminate, exact_dedup, language_model, licences, line_dedup, merkle, mixing, ngram_join, pii, prefix_trie, quality, sharding,
)
from llm.tables import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


OP1_SQL = f"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END)) AS s FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * both_n >= 90 * (x.n + y.n - both_n)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, w.b FROM reached r JOIN ways w ON w.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)"""


def op2_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.private_spans(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_lines(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_bitmaps(table(spark, sf_dir, "documents")).drop("kept_lines")


OP5_SQL = f"""WITH split AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS n
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM split),
common AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, coalesce(doc_id <> holder, false) AS gone FROM keyed k LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def op6_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("copies")


OP6_SQL = f"""WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    (('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, {mixing.DIGITS}))::BIGINT + 0.5::DOUBLE)
      / {float(16**mixing.DIGITS)}::DOUBLE AS u FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM totals),
ranked AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(source_size) OVER b, 0) AS sizes_before, coalesce(sum(weight) OVER b, 0) AS weights_before
  FROM weighed WINDOW b AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
leveled AS (
  SELECT *, ((total * 150)::DOUBLE / 100.0::DOUBLE - (2 * sizes_before)::DOUBLE) / (weights - weights_before)::DOUBLE AS level FROM ranked),
aimed AS (
  SELECT source, source_size, weight, least((2 * source_size)::DOUBLE,
    coalesce((SELECT max(level) FROM leveled WHERE level * weight <= 2 * source_size) * weight, (2 * source_size)::DOUBLE)) AS target
  FROM leveled),
aims AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
    target - (CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END * source_size)::DOUBLE AS rest FROM aimed),
placed AS (
  SELECT s.*, a.source_size, a.target, a.whole, a.rest,
    (u / (1 - u)) / ((rest / a.source_size) / (1 - rest / a.source_size)) AS odds
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source),
cut AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS reached FROM placed)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  ((whole + CASE WHEN rest > 0 AND reached < rest AND 2 * (rest - reached) > size THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM cut"""


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


OP8_SQL = f"""WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM plain"""


def op9_two_pass_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed_records(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a short ASCII string, bit by bit."""
    step = "list_reduce([xor(c, b)] || list_transform(range(8), lambda i: 0::BIGINT), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    bytes_of = f"list_transform(regexp_extract_all({text}, '.'), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {bytes_of}, lambda c, b: {step}), 4294967295)"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.manifest(docs, text)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified"
    )


def _leaf_sql(text: str) -> str:
    parts = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({p})::VARCHAR || ':' || {p}, '-')" for p in parts) + ")"


OP11_SQL = f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf_sql('text')} AS leaf,
    {_leaf_sql(f"CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS shown
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes AS (
  SELECT 0 AS level, source, rank AS place, n, leaf AS digest FROM ranked
  UNION ALL
  SELECT level + 1, source, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM nodes WHERE n > 1
  GROUP BY level, source, place // 3, n),
crowns AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS level, rank AS place, n, subroot AS digest FROM crowns
  UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM upper_nodes WHERE n > 1 GROUP BY level, place // 3, n),
ways AS (
  SELECT r.doc_id, r.leaf, r.shown, r.source, r.rank, c.subroot, c.rank AS crown, 0 AS level, false AS above, r.rank AS place, r.n
  FROM ranked r JOIN crowns c ON r.source IS NOT DISTINCT FROM c.source
  UNION ALL
  SELECT doc_id, leaf, shown, source, rank, subroot, crown, CASE WHEN n = 1 THEN 0 ELSE level + 1 END, above OR n = 1,
    CASE WHEN n = 1 THEN crown ELSE place // 3 END, CASE WHEN n = 1 THEN (SELECT count(*) FROM crowns) ELSE (n + 2) // 3 END
  FROM ways WHERE NOT (above AND n = 1)),
steps AS (
  SELECT w.doc_id, w.source, w.rank, w.above, w.level,
    coalesce(string_agg(coalesce(a.digest, b.digest), '' ORDER BY coalesce(a.place, b.place)) FILTER (WHERE coalesce(a.place, b.place) < w.place), '') AS l,
    coalesce(string_agg(coalesce(a.digest, b.digest), '' ORDER BY coalesce(a.place, b.place)) FILTER (WHERE coalesce(a.place, b.place) > w.place), '') AS r
  FROM ways w
  LEFT JOIN nodes a ON NOT w.above AND a.level = w.level AND a.source IS NOT DISTINCT FROM w.source AND a.place // 3 = w.place // 3
  LEFT JOIN upper_nodes b ON w.above AND b.level = w.level AND b.place // 3 = w.place // 3
  WHERE w.n > 1 GROUP BY w.doc_id, w.source, w.rank, w.above, w.level, w.place),
paths AS (
  SELECT source, rank, list({{'l': l, 'r': r}} ORDER BY above, level) AS path, string_agg(l || r, '' ORDER BY above, level) AS proof
  FROM steps GROUP BY source, rank),
folded AS (
  SELECT r.source, r.rank, coalesce(p.path, []) AS path, coalesce(p.proof, '') AS proof, r.shown AS node, 0 AS i
  FROM ranked r LEFT JOIN paths p ON r.source IS NOT DISTINCT FROM p.source AND r.rank = p.rank
  UNION ALL
  SELECT source, rank, path, proof, sha256(path[i + 1].l || node || path[i + 1].r), i + 1 FROM folded WHERE i < len(path))
SELECT r.doc_id, r.leaf, c.subroot, u.digest AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = u.digest AS verified
FROM ranked r JOIN crowns c ON r.source IS NOT DISTINCT FROM c.source
JOIN folded f ON r.source IS NOT DISTINCT FROM f.source AND r.rank = f.rank AND f.i = len(f.path)
JOIN upper_nodes u ON u.n = 1"""


def op12_language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    return language_model.scores(table(spark, sf_dir, "documents"), learned)


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = prefix_trie.conversations_of(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    rebuilt = prefix_trie.spliced(whole, conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6)
    return prefix_trie.trie(rebuilt)


OP13_SQL = f"""WITH given AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
lent AS (
  SELECT c.conv_id, c.turns, coalesce(b.turns, []) AS head, {crc32_sql('CAST(c.conv_id AS VARCHAR)')} % 6 AS h
  FROM given c LEFT JOIN given b ON b.conv_id = c.conv_id - c.conv_id % 100),
rebuilt AS (SELECT conv_id, head[1:h] || turns[h + 1:] AS turns FROM lent),
begun AS (SELECT conv_id, d AS depth, turns[1:d] AS path, d = len(turns) AS ended FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(length(path[depth].t), 0) AS length,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM begun GROUP BY depth, path),
fertile AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
known AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children, (n.n_convs - 1) * n.length AS saved
  FROM nodes n LEFT JOIN fertile f ON f.depth = n.depth AND f.path = n.path),
under AS (SELECT unnest(range(depth + 1)) AS up, path, n_children = 0 AS leaf, saved FROM known),
sums AS (SELECT up AS depth, path[1:up] AS path, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM under GROUP BY 1, 2)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, k.ends_sha256
FROM known k JOIN sums s ON s.depth = k.depth AND s.path = k.path
LEFT JOIN nodes p ON p.depth = k.depth - 1 AND p.path = k.path[1:k.depth - 1]"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_private_spans, op3_benchmark_decontamination, op4_licence_scan, op5_line_dedup,
        op6_pareto_mixing, op7_quality_classifier, op8_exact_dedup, op9_two_pass_sharding, op10_chat_format, op11_merkle_manifest,
        op12_language_model_scores, op13_conversation_prefix_trie,
    )
}
ORACLES = {
    "op1_ngram_jaccard_join": OP1_SQL, "op5_line_dedup": OP5_SQL, "op6_pareto_mixing": OP6_SQL, "op8_exact_dedup": OP8_SQL,
    "op11_merkle_manifest": OP11_SQL, "op13_conversation_prefix_trie": OP13_SQL,
}
