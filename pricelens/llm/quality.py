"""Quality rules with DataFrame functions only.

Base rules: too few words, or too many words inside repeated eight-word
windows. The method's verdict is a distribution divergence: the document's
histograms of character classes and of common words are compared with those
of each language by Jensen-Shannon distance (in bits, of the better language),
with minimum-length guards: a text shorter than the guard has no verdict
against it, and short texts get room for the noise of few words.

The language references are fitted on all labelled rows that pass the base
rules: class totals, and the ``COMMON_WORDS`` most frequent words. They are the
only thing that reaches the driver. The rows are staged with their measures,
which are taken once, and scored from there; word counts are shuffled, no row is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, packed, staged, text_of

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SAMPLE_DOCS = 2000  # the SQL draws above this many a language; the operator reads every row
COMMON_WORDS = 100
GUARD_WORDS = 50  # fewer: no verdict on common words
GUARD_CHARS = 200  # fewer: no verdict on character classes
MAX_WORD_DISTANCE = 0.12
WORD_NOISE = 8.0  # this much over the number of words is added to the limit
MAX_CLASS_DISTANCE = 0.08
CLASSES = ("upper", "letter", "digit", "symbol", "space", "other")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def _run_starts(s: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: (k == 0) | (F.get(s, k) != F.get(s, k - 1)))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside ``window``-word windows that the text holds twice or more."""
    def covered(s: Column) -> Column:
        same = lambda k, o: F.get(s, k)["h"] == F.get(s, o)["h"]
        again = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                         lambda k: F.coalesce((k > 0) & same(k, k - 1), F.lit(False))
                         | F.coalesce(same(k, k + 1), F.lit(False)))
        places = F.array_sort(F.transform(again, lambda k: F.get(s, k)["i"]))
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-window).alias("at"))
        return F.aggregate(places, start, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(window), p - a["at"])).alias("n"), p.alias("at")), lambda a: a["n"])

    def windows(w: Column) -> Column:
        hashes = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
            F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint"))
                   .otherwise(let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)))

    return F.when(F.size(words) <= window, F.lit(0).cast("bigint")).otherwise(let(words, windows))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def measured(docs: DataFrame, text: str = "text", *more: Column) -> DataFrame:
    """``row``, the base measures, and the text's class counts."""
    whole = packed(docs, text_of(text).alias("t"), *more)
    cols = [c for c in whole.columns if c != "t"]
    split = whole.select(*cols, "t", words_of(F.col("t")).alias("w"),
                         F.regexp_replace("t", r"[\p{L}\x20\x09-\x0D]+", "").alias("rest"))
    out = split.select(
        *cols, F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("rest", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        duplicate_lines(F.col("t")).alias("n_dup_lines"), repeated_words(F.col("w")).alias("n_repeat_words"),
        F.length("t").alias("n_chars"), F.length("rest").alias("n_rest"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).alias("n_upper"),
        F.length(F.regexp_replace("rest", "[^0-9]+", "")).alias("n_digit"))
    letters = F.col("word_chars") - F.col("n_rest") - F.col("n_upper")
    counts = F.array(*[c.cast("double") for c in (
        F.col("n_upper"), letters, F.col("n_digit"), F.col("n_symbols"), F.col("n_chars") - F.col("word_chars"),
        F.col("n_rest") - F.col("n_digit") - F.col("n_symbols"))])
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(*cols, *base, failed.alias("base_failed"), "n_chars", counts.alias("classes"))


def lower_words(text: str) -> Column:
    """Lower-cased words of the text column of ``row``."""
    return words_of(F.lower(text_of(f"row.{text}")))


def references(measures: DataFrame, common_words: int = COMMON_WORDS, text: str = "text",
               lang: str = "lang") -> list[tuple[list[float], dict[str, float]]]:
    """Per language: shares of the character classes, and of the common words.

    ``measures``: rows of ``measured``; all that have a language and pass the base rules count.
    """
    known = measures.select("*", F.col(f"row.{lang}").alias("lang")).filter("lang IS NOT NULL AND NOT base_failed")
    sums = [F.sum(F.get("classes", F.lit(i))).alias(c) for i, c in enumerate(CLASSES)]
    totals = known.groupBy("lang").agg(*sums, F.sum("n_words").alias("words")).collect()
    counts = known.select("lang", F.explode(lower_words(text)).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))  # each partition sends its best only
    top = counts.withColumn("k", place).filter(F.col("k") <= common_words).orderBy("lang", "k").collect()
    out = []
    for r in sorted(totals, key=lambda r: r["lang"]):
        chars = sum(r[c] for c in CLASSES)
        out.append(([r[c] / chars for c in CLASSES], {t["word"]: t["n"] / r["words"] for t in top if t["lang"] == r["lang"]}))
    return out


def _bits(p: Column, q: Column) -> Column:
    """p's and q's share of twice the Jensen-Shannon distance."""
    one = lambda a: F.when(a > 0, a * F.log2(2 * a / (p + q))).otherwise(0.0)
    return one(p) + one(q)


def class_distance(classes: Column, n_chars: Column, shares: list[float]) -> Column:
    return sum((_bits(F.get(classes, F.lit(i)) / n_chars, F.lit(q)) for i, q in enumerate(shares)), F.lit(0.0)) / 2


def word_distance(runs: Column, n_words: Column, shares: dict[str, float]) -> Column:
    """``runs``: distinct words of the references in the text, with their counts.

    A common word that the text lacks adds its share; all other words are one.
    """
    table = F.create_map(*[F.lit(x) for w, q in shares.items() for x in (w, q)])
    start = F.struct(F.lit(0.0).alias("bits"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

    def add(a: Column, r: Column) -> Column:
        p = r["n"] / n_words
        return let(F.struct(p.alias("p"), F.element_at(table, r["w"]).alias("q")), lambda x: F.when(
            x["q"].isNull(), a).otherwise(F.struct((a["bits"] + _bits(x["p"], x["q"])).alias("bits"),
                                                   (a["p"] + x["p"]).alias("p"), (a["q"] + x["q"]).alias("q"))))

    total = sum(shares.values())
    return F.aggregate(runs, start, add, lambda a: (
        a["bits"] + (total - a["q"]) + _bits(F.greatest(1 - a["p"], F.lit(0.0)), F.lit(max(0.0, 1 - total)))) / 2)


def quality_rules(docs: DataFrame, refs: list[tuple[list[float], dict[str, float]]] | None = None, text: str = "text",
                  lang: str = "lang") -> DataFrame:
    """``row``, the base measures, ``base_failed``, the two distances and ``kept``.

    A NULL or empty text has no words and fails the base rules. A distance is
    NULL where its guard holds or there is no reference; NULL never rejects.
    ``lang`` is read for the references only. An empty table gives no rows.
    """
    m = measured(docs, text)
    if refs is None:
        m = staged(m, "quality-measures")
        refs = references(m, text=text, lang=lang)
    base = [c for c in m.columns if c not in ("n_chars", "classes")]
    if refs:
        known = sorted(set().union(*[r[1] for r in refs]))
        common = F.array_sort(F.filter(lower_words(text), lambda w: w.isin(known)))
        runs = let(common, lambda s: let(_run_starts(s), lambda b: F.transform(b, lambda at, j: F.struct(
            F.get(s, at).alias("w"), (F.coalesce(F.get(b, j + 1), F.size(s)) - at).alias("n")))))
        empty = F.array().cast("array<struct<w:string,n:int>>")
        runs = F.when(F.size(common) > 0, runs).otherwise(empty)
        m = m.select(*base, "n_chars", "classes", F.when(F.col("n_words") >= GUARD_WORDS, runs).alias("runs"))
        by_class = [class_distance(F.col("classes"), F.col("n_chars"), r[0]) for r in refs]
        by_word = [word_distance(F.col("runs"), F.col("n_words"), r[1]) for r in refs]
        least = lambda xs: F.least(*xs) if len(xs) > 1 else xs[0]
        m = m.select(*base, F.when(F.col("n_chars") >= GUARD_CHARS, least(by_class)).alias("class_distance"),
                     F.when(F.col("n_words") >= GUARD_WORDS, least(by_word)).alias("word_distance"))
    else:
        none = F.lit(None).cast("double")
        m = m.select(*base, none.alias("class_distance"), none.alias("word_distance"))
    far = F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False)) | F.coalesce(
        F.col("word_distance") > MAX_WORD_DISTANCE + WORD_NOISE / F.col("n_words"), F.lit(False))
    return m.withColumn("kept", ~F.col("base_failed") & ~far)
