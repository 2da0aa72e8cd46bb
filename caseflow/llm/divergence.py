"""Quality rules by distribution divergence, in DataFrame functions only.

Plain counts (words, symbols, repeated lines, repeated five-word windows) fail the obviously poor
texts. The others are compared with references of their language: the shares of character classes
(lower case, upper case, space, digit, sentence mark, symbol, other) and the shares of the language's
most common short words. Both are distributions; their Jensen-Shannon distances (base 2, from 0 to 1)
to one language must both stay below a threshold: those to the language that fits best are returned, the one
of which the larger part of a threshold is the least. References are learned from all documents of
a language, for every language that has a word: those of frequent languages are written into the query,
the others are kept in a table; texts below a minimum length are not judged by divergence, and neither is any text while
there is no reference.

Results: null text has no words and fails; empty text likewise. Lines count as repeated only if they
hold a word. Texts of any length are counted whole. Rows with a null language are judged but do not
shape a reference. Repeated rows get equal results. Input columns named like the outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import SPACE, held

NOT_SPACE = r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS, MARKS = "[#*$%&|<>]", r"[.,;:!?'\"()-]"
CLASSES = ("lower", "space", "upper", "digit", "mark", "symbol", "other")
#: Words in a repeated window; fewest words; most words in repeated windows, in hundredths.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Common words of a language: how many, and of how many characters at most.
COMMON, SHORT = 12, 4
#: Words from which divergence is judged, and the largest distances of the two histograms.
JUDGED_WORDS, MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE = 50, 0.3, 0.28
#: Smallest share of all words for which a language's reference is written into the query: at most 1000 are.
LEAST_SHARE = 0.001


@dataclass(frozen=True)
class Reference:
    """One language: shares of CLASSES, its common words, and their shares with the rest's last."""

    language: str
    classes: list[float]
    words: list[str]
    word_shares: list[float]


def measured(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """keep, words, n_words, word_chars, n_symbols, and the count of each character class."""
    text = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("trimmed", F.btrim("t", F.lit(BLANKS)))
    split = F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", SPACE))
    words = text.select(*keep, "t", split.alias("words")).withColumn("solid", F.array_join("words", ""))
    rest = words.select(*keep, "t", "words", F.length("t").alias("n_chars"), F.length("solid").alias("n1"), F.regexp_replace("solid", r"\p{Ll}+", "").alias("t2"))
    counted = rest.select(
        *keep,
        "t",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.col("n1").cast("long").alias("word_chars"),
        (F.col("n1") - F.length("t2")).alias("lower"),
        (F.col("n_chars") - F.col("n1")).alias("space"),
        F.regexp_count("t2", F.lit(r"\p{Lu}")).alias("upper"),
        F.regexp_count("t2", F.lit(r"\p{N}")).alias("digit"),
        F.regexp_count("t2", F.lit(MARKS)).alias("mark"),
        F.regexp_count("t2", F.lit(SYMBOLS)).alias("symbol"),
        F.length("t2").alias("n2"),
    )
    other = F.col("n2") - F.col("upper") - F.col("digit") - F.col("mark") - F.col("symbol")
    return counted.withColumns({"other": other, "n_symbols": F.col("symbol").cast("long")}).drop("n2")


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[Reference], DataFrame | None]:
    """References of all languages with a share of the words, whose number that share bounds, and a
    table (classes, words, word_shares) of all others' if there are any."""
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("l"), F.col(text_col).alias("text"))
    totals = measured(known, "text", ["l"]).groupBy("l").agg(F.sum("n_words").alias("n"), *(F.sum(c).alias(c) for c in CLASSES))
    totals = held(totals.where(F.col("n") > 0))  # a row for each label; read again
    frequent = F.col("n") >= LEAST_SHARE * F.col("all")
    shared = totals.join(F.broadcast(totals.agg(F.sum("n").alias("all"))))
    bounded, rare = shared.where(frequent), shared.where(~frequent)
    by_language = {r.l: r for r in bounded.collect()}
    short = F.filter(F.split(F.lower("text"), SPACE), lambda w: (w != "") & (F.length(w) <= SHORT))
    counts = known.select("l", F.explode(short).alias("word")).groupBy("l", "word").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("l").orderBy(F.desc("n"), "word")))
    common: dict[str, list] = {}
    ranked = ranked.where(F.col("rank") <= COMMON)
    for r in ranked.where(F.col("l").isin(list(by_language))).collect():
        common.setdefault(r.l, []).append(r)
    out = []
    for language, r in sorted(by_language.items()):
        chars = sum(r[c] for c in CLASSES)
        words = sorted(common.get(language, []), key=lambda x: x["rank"])
        shares = [x.n / r.n for x in words]
        out.append(Reference(language, [r[c] / chars for c in CLASSES], [x.word for x in words], [*shares, max(0.0, 1 - sum(shares))]))
    return out, None if rare.isEmpty() else held(_reference_table(rare, ranked))


def _reference_table(totals: DataFrame, ranked: DataFrame) -> DataFrame:
    """Rows (classes, words, word_shares), as in Reference, of the languages in totals."""
    own = totals.select("l", F.col("n").alias("total"))
    words = ranked.join(own, "l").groupBy("l").agg(F.array_sort(F.collect_list(F.struct("rank", "word", (F.col("n") / F.col("total")).alias("share")))).alias("common"))
    chars = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    common = F.coalesce(F.col("common"), F.array().cast("array<struct<rank:int,word:string,share:double>>"))
    shares = totals.join(words, "l", "left").select(F.array(*(F.col(c) / chars for c in CLASSES)).alias("classes"), common["word"].alias("words"), common["share"].alias("shares"))
    rest = F.greatest(F.lit(0.0), F.lit(1.0) - _sum(F.col("shares")))
    return shares.select("classes", "words", F.concat("shares", F.array(rest)).alias("word_shares"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _part(x: Column, y: Column) -> Column:
    return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)


def js_distance(p: Column, q: list[float] | Column) -> Column:
    """Jensen-Shannon distance between a column of shares and fixed shares or another column.

    Fixed shares are written out term by term, which the engine compiles.
    """
    if isinstance(q, Column):
        total = _sum(F.zip_with(p, q, lambda x, y: (_part(x, y) + _part(y, x)) / 2))
    else:
        total = F.lit(0.0)
        for i, share in enumerate(q):
            x, y = F.get(p, F.lit(i)), F.lit(float(share))
            total = total + (_part(x, y) + (_part(y, x) if share > 0 else F.lit(0.0))) / 2
    return F.sqrt(F.greatest(F.lit(0.0), total))


def _word_shares(short: Column, n_words: Column, words: list[str]) -> Column:
    """Shares of the given words and of all others; `short` has each short word between spaces."""
    counts = [(F.length(short) - F.length(F.replace(short, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2) for w in words]
    shares = [c / n_words for c in counts]
    rest = F.lit(1.0)
    for s in shares:
        rest = rest - s
    return F.array(*shares, F.greatest(F.lit(0.0), rest))


def _listed_shares(short: Column, n_words: Column, words: Column) -> Column:
    """As _word_shares, for words in an array."""
    less = lambda w: F.length(short) - F.length(F.replace(short, F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))
    shares = F.transform(words, lambda w: less(w) / (F.length(w) + 2) / n_words)
    return F.concat(shares, F.array(F.greatest(F.lit(0.0), F.lit(1.0) - _sum(shares))))


def _repeated_words(df: DataFrame, keep: list[str]) -> DataFrame:
    """keep and n_repeat_words: words in windows of five that the text of column `words` holds twice."""
    n = F.size("words")

    def paired(one: str, other: str, start: int, length: Column) -> Column:
        """Hashes of one's values, each with that of other `start - 1` places on."""
        length = F.greatest(F.lit(0), length)
        return F.zip_with(F.slice(one, 1, length), F.slice(other, start, length), lambda a, b: F.xxhash64(a, b))

    # Windows of two, four and five words are hashed from shorter ones; a text without a repeated
    # window of four has none of five.
    one = df.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    two = one.withColumn("h2", paired("h1", "h1", 2, n - 1))
    four = two.withColumn("h4", paired("h2", "h2", 3, n - 3)).drop("h2")
    few = F.array().cast("array<struct<h:bigint,i:int>>")
    indexed = F.array_sort(F.transform(paired("h4", "h1", WINDOW, n - 4), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    ordered = four.withColumn("s", F.when(F.size(F.array_distinct("h4")) < F.size("h4"), indexed).otherwise(few)).drop("h1", "h4")

    def again(e: Column, k: Column) -> Column:
        before, after = F.get("s", k - 1), F.get("s", k + 1)
        same = F.coalesce(before["h"] == e["h"], F.lit(False)) | F.coalesce(after["h"] == e["h"], F.lit(False))
        return F.when(same, e["i"])

    at = F.array_sort(F.filter(F.transform("s", again), lambda i: i.isNotNull()))
    placed = ordered.withColumn("at", at).drop("s")
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        "at",
        start,
        lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).cast("long").alias("n")),
        lambda a: a["n"],
    )
    return placed.select(*keep, covered.alias("n_repeat_words"))


def judge(docs: DataFrame, refs: list[Reference], text_col: str = "text", rest: DataFrame | None = None) -> DataFrame:
    """The documents with the counts, base_failed, class_distance, word_distance and kept.

    `rest` has the references that are not in `refs`, a row for each.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")
    inner = docs.select(F.struct(*(c for c in docs.columns if c not in made)).alias("row"), F.col(text_col).alias("text"))
    base = measured(inner, "text", ["row"])
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(NOT_SPACE))
    kept = ["row", "n_words", "word_chars", "n_symbols", *CLASSES, "n_dup_lines", "short"]
    short = F.concat(F.lit(" "), F.lower(F.array_join(F.filter("words", lambda w: F.length(w) <= SHORT), "  ")), F.lit(" "))
    lined = base.withColumns({"lines": lines, "short": short}).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    counted = _repeated_words(lined.select(*kept, "words"), kept)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    total = F.greatest(F.lit(1), sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0])))
    shares = counted.withColumns({"base_failed": failed, "classes": F.array(*(F.col(c) / total for c in CLASSES))})
    n = F.greatest(F.lit(1), F.col("n_words"))
    # The shares first, in columns of their own: each is used in several terms.
    words = {f"words{i}": _word_shares(F.col("short"), n, r.words) for i, r in enumerate(refs)}
    shares = shares.withColumns(words).drop("short") if rest is None else shares.withColumns(words)

    def fit(by_class: Column, by_word: Column) -> Column:
        worst = F.greatest(by_class / MOST_CLASS_DISTANCE, by_word / MOST_WORD_DISTANCE)
        return F.struct(worst.alias("worst"), by_class.alias("class_distance"), by_word.alias("word_distance"))

    apart = {f"apart{i}": F.struct(js_distance(F.col("classes"), r.classes).alias("c"), js_distance(F.col(f"words{i}"), r.word_shares).alias("w")) for i, r in enumerate(refs)}
    far = shares.withColumns(apart).drop(*words)
    fits = [fit(F.col(a)["c"], F.col(a)["w"]) for a in apart]
    if rest is not None:
        far = far.crossJoin(F.broadcast(rest.agg(F.collect_list(F.struct("classes", "words", "word_shares")).alias("rest"))))
        fits.append(F.array_min(F.transform("rest", lambda r: fit(js_distance(F.col("classes"), r["classes"]), js_distance(_listed_shares(F.col("short"), n, r["words"]), r["word_shares"])))))
    nearest = F.array_min(F.array(*fits)) if fits else F.lit(None).cast("struct<worst:double,class_distance:double,word_distance:double>")
    far = far.withColumn("nearest", nearest).drop(*apart)
    far = far.withColumns({"class_distance": F.col("nearest.class_distance"), "word_distance": F.col("nearest.word_distance")})
    within = (F.col("class_distance") <= MOST_CLASS_DISTANCE) & (F.col("word_distance") <= MOST_WORD_DISTANCE)
    fits = within if fits else F.lit(True)
    verdict = ~F.col("base_failed") & ((F.col("n_words") < JUDGED_WORDS) | fits)
    return far.withColumn("kept", verdict).select("row.*", *made)
