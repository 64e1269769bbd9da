"""Personal data: overlapping candidate spans, boosted trees over their format and context, a calibrated threshold.

Generators are regular expressions with high recall. Four of them, with their checks, are the *base* and always
count; other matches, and those that fail a check, are candidates. Trees are fitted on the matches of the base generators, of which
those that pass their check are positive and those that fail it negative. Their features are shared by all generators: kind,
format (digits, Luhn's check of a card, separators, leading plus) and context (neighbouring characters, a hint before it). They are boosted on the counts of all
feature combinations, four fifths of the documents for the fit and one for the threshold: the lowest score from which
on the calibrated share of base spans in that fifth is at least `precision`. Candidates above it that overlap no base span are added.

Everything on the data is SQL functions. A text is scanned only by generators whose cheap hint it has. Two characters
are rewritten before matching, one for one, so that repeated groups become plain character classes, which Java matches without
recursion: white space or hyphen between digits, and a dot between label characters. Positions are sums of the lengths between matches,
in a window over the matches of one text.

Defined results: a null or empty text has no span; null ids and repeated rows are rows of their own; extra columns are ignored.
Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm import boosting
from llm.tables import materialise

KINDS = ("email", "ip", "card", "phone")
GAP, DOT, OTHER = "\x01", "\x02", "\x03"
LOCAL = f"[A-Za-z0-9._%+{DOT}-]"

#: name: (kind, which text, pattern, is base). A match may begin where the last one ended or where a run begins.
GENERATORS = {
    "email": (0, "dotted", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9{DOT}-]+", True),
    "ip": (1, "plain", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True),
    "card": (2, "gapped", f"[0-9][0-9{GAP}]+", True),
    "phone": (3, "plain", r"\+[0-9][\x20().0-9-]+[0-9]", True),
    "spelled_email": (0, "spelled", r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9][A-Za-z0-9.-]{1,64}", False),
    "parted_card": (2, "plain", r"(?<![0-9])[0-9]{3,6}[./_][0-9]{3,6}[./_][0-9]{3,6}(?:[./_][0-9]{1,6})?(?![0-9])", False),
    "local_phone": (3, "plain", r"(?<![0-9+])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])", False),
}
HINTS = ("tel|phone|call|fon|móvil|tél", "card|visa|carte|tarjeta|karte", "mail|contact|kontakt", "host|addr|server", "token|key|secret|=")
FEATURES = ["kind", "digits", "luhn", "separators", "plus", "char_before", "char_after", "hint"]


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check: every second from the right doubled, digits summed."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, (d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10)).otherwise(d.cast("int")).cast("int"))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def parts_fit(quad: Column) -> Column:
    """Whether the parts of a dotted quad are at most 255."""
    bare = F.transform(F.split(quad, "\\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(bare, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))


def char_class(c: Column) -> Column:
    """0 none, 1 white space, 2 letter, 3 digit, 4 quote, 5 other."""
    return (
        F.when((c == "") | c.isNull(), 0).when(c.rlike("^\\s$"), 1).when(c.rlike("^\\p{L}$"), 2).when(c.rlike("^[0-9]$"), 3)
        .when(c.rlike("^[\"']$"), 4).otherwise(5)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """A row for every match of every generator, and a row with a null kind for texts without one."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spare = raw.contains(GAP) | raw.contains(DOT)
    plain = F.when(spare, F.translate(raw, GAP + DOT, OTHER + OTHER)).otherwise(raw)
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), plain.alias("plain"))
    texts = texts.withColumn("has_digits", F.col("plain").rlike("[0-9]"))
    texts = texts.select(
        "doc_id", "row",
        F.when(F.col("has_digits"), F.col("plain")).alias("plain"),
        F.when(F.col("plain").contains("@"), F.regexp_replace("plain", r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)).alias("dotted"),
        F.when(F.col("has_digits"), F.regexp_replace("plain", "(?<=[0-9])[ -](?=[0-9])", GAP)).alias("gapped"),
        F.when(F.col("plain").rlike(r"(?i)[\[(] ?at ?[\])]"), F.col("plain")).alias("spelled"),
    )
    scans = [
        F.struct(
            F.lit(kind).alias("kind"), F.lit(g).alias("generator"), F.lit(base).alias("base"),
            F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0)).alias("found"),
            F.split(column, pattern, -1).alias("between"),
        )
        for g, (kind, column, pattern, base) in enumerate(GENERATORS.values())
    ]
    scanned = texts.select("doc_id", "row", F.explode_outer(F.filter(F.array(*scans), lambda s: F.size(s["found"]) > 0)).alias("s"))
    places = scanned.select("doc_id", "row", "s.kind", "s.generator", "s.base", F.posexplode_outer(
        F.arrays_zip(F.col("s.found").alias("match"), F.col("s.between").alias("gap"), F.expr("slice(s.between, 2, size(s.found))").alias("rest"))
    ).alias("i", "m")).filter("m IS NULL OR m.match IS NOT NULL")
    return places.select(
        "doc_id", "row", "kind", "generator", "base", "i", F.translate("m.match", GAP + DOT, " .").alias("match"),
        F.length("m.gap").alias("gap"), F.substring("m.gap", -24, 24).alias("before"), F.substring("m.rest", 1, 1).alias("after"),
    )


def checked(found: DataFrame) -> DataFrame:
    """Candidates with their place, whether they are base spans, and their features."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    valid = (
        F.when(F.col("kind") == 0, F.lit(True)).when(F.col("kind") == 1, parts_fit(F.col("match")))
        .when(F.col("kind") == 2, n.between(12, 19) & luhn(digits)).otherwise(n.between(9, 15))
    )
    earlier = W.partitionBy("row", "generator").orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    hint = F.lit(0)
    for value, words in reversed(list(enumerate(HINTS, 1))):
        hint = F.when(F.lower("before").rlike(words), value).otherwise(hint)
    placed = found.repartition("row").withColumn(
        "start", F.coalesce(F.sum(F.col("gap") + F.length("match")).over(earlier), F.lit(0)) + F.col("gap")
    )
    return placed.select(
        "doc_id", "row", "kind", "generator", "start", (F.col("start") + F.length("match")).alias("end"),
        F.col("base").alias("fitted"), (F.col("base") & valid).alias("base"), F.least(n, F.lit(20)).alias("digits"),
        F.when(F.col("kind") == 2, luhn(digits).cast("int")).otherwise(0).alias("luhn"),
        F.least(F.length(F.regexp_replace("match", "[A-Za-z0-9]", "")), F.lit(4)).alias("separators"),
        F.col("match").startswith("+").cast("int").alias("plus"), char_class(F.substring("before", -1, 1)).alias("char_before"),
        char_class(F.col("after")).alias("char_after"), hint.alias("hint"),
    )


def overlapped(*by: str) -> Column:
    """Whether a base span with the same `by` overlaps the span, itself included."""
    to_here = W.partitionBy(*by).orderBy("start").rangeBetween(W.unboundedPreceding, W.currentRow)
    onward = W.partitionBy(*by).orderBy("start").rangeBetween(W.currentRow, W.unboundedFollowing)
    last_end = F.max(F.when(F.col("base"), F.col("end"))).over(to_here)
    next_start = F.min(F.when(F.col("base"), F.col("start"))).over(onward)
    return F.coalesce(last_end > F.col("start"), F.lit(False)) | F.coalesce(next_start < F.col("end"), F.lit(False))


def with_overlap(spans: DataFrame) -> DataFrame:
    """Spans with whether a base span of any kind overlaps them."""
    return spans.withColumn("overlaps", overlapped("row"))


def redactions(spans: DataFrame, precision: float = 0.9) -> tuple[Column, Column]:
    """Score of a candidate and whether it is to be redacted, fitted on the matches of the base generators (from `with_overlap`)."""
    fold = (F.pmod(F.xxhash64("row"), F.lit(5)) == 0).cast("int").alias("fold")
    counts = spans.filter("fitted").groupBy(*FEATURES, fold).agg(
        F.sum((~F.col("base")).cast("long")).alias("no"), F.sum(F.col("base").cast("long")).alias("yes")
    )
    table = np.array(sorted(map(tuple, counts.collect())), np.int64).reshape(-1, len(FEATURES) + 3)
    x, late, no, yes = table[:, : len(FEATURES)], table[:, -3] == 1, table[:, -2].astype(float), table[:, -1].astype(float)
    start, trees = boosting.boost(x[~late], no[~late], yes[~late])
    cut = boosting.precise_margin(boosting.margins(start, trees, x[late]), no[late], yes[late], precision)
    margin = F.expr(boosting.margin_sql(start, trees, FEATURES))
    return 1 / (1 + F.exp(-margin)), margin >= F.lit(cut) - 1e-9


def joined(spans: Column) -> Column:
    """kind:start:end of an array of structs (start, kind, end) in that order, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    ordered = F.array_distinct(F.sort_array(spans))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def private_spans(docs: DataFrame, precision: float = 0.9) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of (doc_id, text); counts are of base spans."""
    spans = materialise(with_overlap(checked(candidates(docs))), "private-candidates")
    score, redact = redactions(spans, precision)
    span = F.struct("start", "kind", "end")
    base = F.collect_list(F.when(F.col("base"), span))
    every = F.collect_list(F.when(F.col("base") | (redact & ~F.col("overlaps")), span))
    return spans.groupBy("row", "doc_id").agg(
        *(F.sum(F.when(F.col("base") & (F.col("kind") == k), 1).otherwise(0)).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(every).alias("spans"),
        F.max(F.when(F.col("kind").isNotNull() & ~F.col("overlaps"), score)).alias("best_open_score"),
    ).drop("row")


def redacted(docs: DataFrame, mark: str = "<{}>", precision: float = 0.9) -> DataFrame:
    """Rows of (doc_id, text) with every span replaced by its kind; needs distinct ids."""
    found = private_spans(docs, precision).filter("spans <> ''").select("doc_id", F.col("spans").alias("found_spans"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    pieces = F.transform(F.split("found_spans", ","), lambda s: F.split(s, ":"))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, p: F.when(p[1].cast("int") < a["at"], a).otherwise(
        F.struct(p[2].cast("int").alias("at"), F.concat(a["out"], F.substr(text, a["at"] + 1, p[1].cast("int") - a["at"]),
                 F.replace(F.lit(mark), F.lit("{}"), p[0])).alias("out"))
    )
    folded = F.aggregate(pieces, state, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))
    joined_docs = docs.select("doc_id", "text").join(found, "doc_id", "left")
    return joined_docs.select("doc_id", F.when(F.col("found_spans").isNull(), F.col("text")).otherwise(folded).alias("text"))
