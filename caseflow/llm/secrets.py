"""Secret scans with a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: alternatives of trigrams
that every match must hold (in lower case, since rules may ignore case). The index has a posting (the
trigram, the document) for each trigram that some query names. A rule's candidates are the
documents in the postings of all trigrams of one of its alternatives; only these are verified with the
expression itself. Rules without a mandatory trigram scan all documents.

Results: null text is empty and has no spans. Spans are code points, end exclusive; within a rule they
are the leftmost matches that do not overlap, less those whose value is too short. Spans of different
rules may overlap. Texts of any length are scanned whole. Rows with equal id and text are one document
and get equal results; input columns named like the outputs are replaced. An empty table gives none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import doc_key


@dataclass(frozen=True)
class Rule:
    """A kind of secret: expression, group of the value, fewest characters of the value."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: The three base rules, then the formats of well-known credentials.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),  # maximal runs, so the bound can stand in the expression
    Rule("private", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
)
#: Strings in one run of alternatives before it is closed; alternatives of a whole query.
MOST_STRINGS, MOST_CLAUSES = 24, 64


def mandatory_strings(pattern: str) -> list[set[str]]:
    """Runs that every match holds, in order; of each run one of its (lower-case) strings."""
    runs: list[set[str]] = []

    def close(run: set[str]) -> set[str]:
        if run != {""}:
            runs.append(run)
        return {""}

    def exact(node) -> set[str] | None:
        """All strings that a node may match, if they are few."""
        op, arg = node
        name = str(op)
        if name == "LITERAL":
            return {chr(arg).lower()}
        if name == "IN":
            if not all(str(o) == "LITERAL" for o, _ in arg):
                return None
            return {chr(a).lower() for _, a in arg}
        if name == "SUBPATTERN":
            return joined(arg[3])
        if name == "BRANCH":
            parts = [joined(p) for p in arg[1]]
            return None if None in parts else set().union(*parts)
        if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, body = arg
            one = joined(body)
            if one is None or high not in (0, 1) and low != high or low > 8:
                return None
            return {"".join(x) for n in {low, high} for x in product(sorted(one), repeat=n)}
        return {""} if name == "AT" else None

    def joined(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            if (one := exact(node)) is None or len(out) * len(one) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in one}
        return out

    def walk(nodes) -> None:
        run = {""}
        for node in nodes:
            one = exact(node)
            if one is not None and len(run) * len(one) <= MOST_STRINGS:
                run = {a + b for a in run for b in one}
                continue
            run = close(run)
            if one is not None:
                run = one
            elif str(node[0]) == "SUBPATTERN":
                walk(node[1][3])
            elif "REPEAT" in str(node[0]) and node[1][0] > 0:
                walk(node[1][2])  # at least once
        close(run)

    walk(re._parser.parse(pattern))
    return runs


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams, all of one of which every match holds; empty: no mandatory trigram."""
    clauses = [frozenset()]
    for run in mandatory_strings(pattern):
        if min(map(len, run)) < 3:
            continue  # some string of the run has no trigram, so the run demands nothing
        options = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        if len(clauses) * len(options) <= MOST_CLAUSES:
            clauses = [a | b for a in clauses for b in options]
    clauses = [c for c in set(clauses) if not any(o < c for o in clauses)]
    return [] if frozenset() in clauses else sorted(clauses, key=sorted)


def postings(docs: DataFrame, trigrams: list[str], key: Column, text_col: str = "text") -> DataFrame:
    """Rows (trigram, key): the documents that hold each of the given trigrams."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.select(key.alias("key"), low.alias("low"))
    found = [F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in trigrams]
    return texts.select("key", F.explode(F.array_compact(F.array(*found))).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], key: Column, text_col: str = "text") -> DataFrame:
    """Rows (key, kinds): for each document the rules whose query its trigrams satisfy."""
    spark = docs.sparkSession
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    clauses = [(kind, i, g, len(c)) for kind, cs in queries.items() for i, c in enumerate(cs) for g in sorted(c)]
    terms = spark.createDataFrame(clauses, "kind string, clause int, trigram string, wanted int")
    index = postings(docs, sorted({g for *_, g, _ in clauses}), key, text_col)
    met = index.join(F.broadcast(terms), "trigram")  # as many rows as the rules have trigrams
    held = met.groupBy("key", "kind", "clause", "wanted").agg(F.count_distinct("trigram").alias("n"))
    return held.where(F.col("n") == F.col("wanted")).groupBy("key").agg(F.collect_set("kind").alias("kinds"))


SPANS = "array<struct<start:int,order:int,kind:string,end:int>>"


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of a rule's matches: the texts between matches and the matches, laid end to end."""
    pattern = F.lit(rule.pattern)
    gaps, whole = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    lengths = F.arrays_zip(F.transform(F.slice(gaps, 1, F.size(whole)), F.length).alias("gap"), F.transform(whole, F.length).alias("match"), F.transform(value, F.length).alias("value"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), (start + x["match"]).alias("end"))
        out = F.when(x["value"] >= rule.least, F.concat(a["out"], F.array(span))).otherwise(a["out"])
        return F.struct((start + x["match"]).alias("at"), out.alias("out"))

    return F.aggregate(lengths, begin, step, lambda a: a["out"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with `secrets`: start, order of the rule, kind and end of every span, sorted."""
    key = doc_key(id_col, text_col)
    whole = docs.select(F.struct(*(c for c in docs.columns if c != "secrets")).alias("row"), key.alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = whole.join(candidates(docs, rules, key, text_col), "key", "left")
    none = F.array().cast(SPANS)
    each = []
    for order, rule in enumerate(rules):
        test = F.array_contains("kinds", rule.kind) if trigram_query(rule.pattern) else F.col("text").rlike(rule.pattern)
        each.append(F.when(test, _spans(F.col("text"), rule, order)).otherwise(none))
    return found.select("row.*", F.array_sort(F.concat(*each)).alias("secrets"))
