"""Personal data by candidate gradient boosting.

High-recall generators propose spans that may overlap: addresses in their usual and spelled-out forms,
and chains of digits with separators, read as card, phone or network address wherever their length
allows it. The strict base patterns are found in the same scan; their spans always stay. A candidate that
coincides with a base span is a positive example, every other one a negative; boosted trees are
fitted on a bounded sample of them with features of format (digits, groups, separators, check sums) and
context (neighbouring characters, words before). On a held-back part the smallest score is sought, for
each kind, from which the wanted share of candidates is positive; candidates from there on are
redacted too, the best first, where they overlap no span chosen before.

Results: null text is empty and has no spans. Spans are code points, end exclusive. With no candidates,
with only positives or negatives, or with too few held-back positives of a kind, only base spans
remain. Texts of any length are scanned whole, in time linear in them. Rows with equal id and text are
one document; input columns named like the output are replaced. An empty table gives none.
"""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from .shared import doc_key, held

#: Kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FOUR_PARTS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

SPELLED = re.compile(r"(?<![\w.+-])[\w.+-]{1,64}+ ?(?:@|[(\[]at[)\]]) ?[\w-]{1,63}+(?: ?(?:\.|[(\[]dot[)\]]) ?[\w-]{1,63}+){1,6}", re.I)
CHAIN = re.compile(r"\+?\(?[0-9](?:[ ().:/-]{0,3}[0-9])+")
GROUPS = re.compile(r"[0-9]+")
SEPARATORS = re.compile(r"[^0-9]+")
ANYTHING = re.compile(r"[0-9@]|[(\[]at[)\]]", re.I)
#: Words before a span that hint at its kind, in the order of KINDS.
HINTS = tuple(map(re.compile, (r"mail|contact|write", r"\bip\b|host|server|addr", r"card|visa|account|pay", r"phone|tel|call|fax|mobile")))
NEAR = 40

#: Rows in the fitting sample and of each kind; share of held-back candidates that must be positive, positives needed.
SAMPLE_ROWS, PRECISION, LEAST_POSITIVES = 20_000, 0.98, 20
ROUNDS, DEPTH, STEPS = 15, 4, 100


def luhn(digits: str) -> bool:
    """Whether the check sum of a card number holds: every second digit from the right is doubled."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def small(part: str) -> bool:
    """At most 255, whatever the number of leading zeros."""
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses: each is found from its @, back over the local part and on over the domain."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            floor = m.end()
        else:
            floor = at + 1  # no match can reach back over this @
        at = text.find("@", max(at + 1, floor))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, by kind, then start."""
    out = [(EMAIL, a, b) for a, b in _emails(text)]
    for m in FOUR_PARTS.finditer(text):
        if all(map(small, m[0].split("."))):
            out.append((IP, *m.span()))
    for m in DIGITS.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((CARD, *m.span()))
    for m in PLUS.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append((PHONE, *m.span()))
    return out


def proposals(text: str) -> set[tuple[int, int, int]]:
    """Spans that could be personal data, one span perhaps under several kinds."""
    out = {(EMAIL, *m.span()) for m in SPELLED.finditer(text)}
    for m in CHAIN.finditer(text):
        groups = GROUPS.findall(m[0])
        n = sum(map(len, groups))
        if 12 <= n <= 19:
            out.add((CARD, *m.span()))
        if 7 <= n <= 15:
            out.add((PHONE, *m.span()))
        if len(groups) == 4 and max(map(len, groups)) <= 3:
            out.add((IP, *m.span()))
    return out


def _kind_of_char(ch: str) -> float:
    return 0.0 if not ch or ch.isspace() else 1.0 if ch.isalpha() else 2.0 if ch.isdigit() else 3.0


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a span, each a number."""
    span, before = text[start:end], text[max(0, start - NEAR) : start].lower()
    groups, seps = GROUPS.findall(span), SEPARATORS.findall(span)
    digits = "".join(groups)
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        float(len(span)),
        float(len(digits)),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float(len(set(seps))),
        float("+" in span),
        float("(" in span),
        float("." in span),
        float("-" in span),
        float(" " in span),
        float("@" in span),
        float(kind == CARD and luhn(digits)),
        float(kind == IP and all(map(small, groups))),
        _kind_of_char(text[start - 1 : start]),
        _kind_of_char(text[end : end + 1]),
        *(float(bool(h.search(before))) for h in HINTS),
    ]


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
PROPOSED = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("positive", pa.int32()), ("features", pa.list_(pa.float64()))])
_PLACE = [StructField(c, IntegerType()) for c in ("kind", "start", "end")]
_MADE = [StructField("positive", IntegerType()), StructField("features", ArrayType(DoubleType()))]
SPANS = ArrayType(StructType(_PLACE))
SCANNED = StructType([StructField("base", SPANS), StructField("proposed", ArrayType(StructType(_PLACE + _MADE)))])


@F.arrow_udf(SCANNED)
def scanned(texts: pa.Array) -> pa.Array:
    base, proposed = [], []
    for text in texts.to_pylist():
        if not text or not ANYTHING.search(text):
            base.append([])
            proposed.append([])
            continue
        strict = base_spans(text)
        sure = set(strict)
        base.append([{"kind": k, "start": a, "end": b} for k, a, b in strict])
        every = sorted(sure | proposals(text))
        proposed.append([{"kind": k, "start": a, "end": b, "positive": int((k, a, b) in sure), "features": features(text, k, a, b)} for k, a, b in every])
    return pa.StructArray.from_arrays([pa.array(base, pa.list_(SPAN)), pa.array(proposed, pa.list_(PROPOSED))], ["base", "proposed"])


def _fitted(rows: DataFrame, sample_rows: int) -> DataFrame | None:
    """rows(kind, positive, vector, point) with a score, by trees fitted on part of a bounded sample."""
    sizes = {(r.kind, r.positive): r.n for r in rows.where("point >= 0.3").groupBy("kind", "positive").agg(F.count("*").alias("n")).collect()}
    if len({p for _, p in sizes}) < 2:
        return None
    share = sample_rows / len(sizes)
    limit = reduce(lambda c, x: c.when((F.col("kind") == x[0][0]) & (F.col("positive") == x[0][1]), min(1.0, share / x[1])), sorted(sizes.items()), F.when(F.lit(False), 0.0))
    sample = held(rows.where((F.col("point") >= 0.3) & ((F.col("point") - 0.3) / 0.7 < limit)).select("vector", F.col("positive").cast("double").alias("label")).limit(2 * sample_rows))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=ROUNDS, maxDepth=DEPTH, seed=7).fit(sample)
    return trees.transform(rows).withColumn("score", vector_to_array("probability")[1]).drop("vector", "probability", "rawPrediction", "prediction")


def _thresholds(scored: DataFrame, precision: float) -> dict[int, int]:
    """For each kind the least hundredth of score from which held-back candidates reach the precision."""
    step = F.floor(F.col("score") * STEPS).cast("int").alias("step")
    counts = scored.where("point < 0.3").groupBy("kind", step).agg(F.sum("positive").alias("good"), F.count("*").alias("n")).collect()
    out = {}
    for kind in {r.kind for r in counts}:
        good = n = 0
        for r in sorted((r for r in counts if r.kind == kind), key=lambda r: -r.step):
            good, n = good + r.good, n + r.n
            if good >= precision * n and good >= LEAST_POSITIVES:
                out[kind] = r.step
    return out


@F.arrow_udf(SPANS)
def merged(base: pa.Array, more: pa.Array) -> pa.Array:
    """Base spans and, best score first, further spans that overlap none before."""
    out = []
    for strict, found in zip(base.to_pylist(), more.to_pylist(), strict=True):
        spans = [(s["kind"], s["start"], s["end"]) for s in strict]
        taken = sorted((a, b) for _, a, b in spans)
        for s in sorted(found or [], key=lambda s: (-s["score"], s["start"] - s["end"], s["start"], s["kind"])):
            if not any(a < s["end"] and s["start"] < b for a, b in taken):
                spans.append((s["kind"], s["start"], s["end"]))
                taken.append((s["start"], s["end"]))
        out.append([{"kind": k, "start": a, "end": b} for k, a, b in sorted(spans)])
    return pa.array(out, pa.list_(SPAN))


def redactions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, precision: float = PRECISION) -> DataFrame:
    """Rows (row, base, spans): the other columns of docs as a struct, strict spans, all spans."""
    key: Column = doc_key(id_col, text_col)
    others = [c for c in docs.columns if c != text_col]
    marks = held(docs.select(F.struct(*others).alias("row"), key.alias("key"), scanned(F.col(text_col)).alias("found")))
    proposed = marks.select("key", F.explode("found.proposed").alias("p")).select("key", "p.*").distinct()
    point = F.pmod(F.xxhash64("key", "kind", "start"), F.lit(1 << 20)) / (1 << 20)
    rows = held(proposed.select("key", "kind", "start", "end", "positive", "features", point.alias("point")))
    scored = _fitted(rows.withColumn("vector", array_to_vector("features")), sample_rows)
    base = F.col("found.base").alias("base")
    limits = _thresholds(scored, precision) if scored is not None else {}
    if not limits:
        return marks.select("row", base, F.array_sort("found.base").alias("spans"))
    wanted = [(F.col("kind") == k) & (F.floor(F.col("score") * STEPS) >= step) for k, step in sorted(limits.items())]
    chosen = scored.where((F.col("positive") == 0) & reduce(lambda a, b: a | b, wanted))
    more = chosen.groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end", "score")).alias("more"))
    return marks.join(more, "key", "left").select("row", base, merged(F.col("found.base"), F.col("more")).alias("spans"))


@F.arrow_udf(StringType())
def _masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        if text is not None and found:
            parts, at = [], 0
            for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= at:
                    parts += [text[at : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                at = max(at, s["end"])
            text = "".join(parts) + text[at:]
        out.append(text)
    return pa.array(out, pa.string())


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents with each span of their text replaced by its kind in brackets."""
    key, columns = doc_key(id_col, text_col), docs.columns
    ids = docs.select(key.alias("key"), F.col(id_col), F.col(text_col))
    spans = redactions(ids, id_col, text_col, **settings).select("row.key", "spans").dropDuplicates(["key"])
    joined = docs.withColumn("__key", key).join(spans.select(F.col("key").alias("__key"), F.col("spans").alias("__spans")), "__key", "left")
    return joined.withColumn(text_col, _masked(F.col(text_col), F.col("__spans"))).select(*columns)
