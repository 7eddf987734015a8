"""Secret scans with DataFrame functions only.

Three patterns give the base findings. Beside them, every long string of
letters, digits and ``+/_=-`` is a candidate for the entropy scan: a window of
``WINDOW`` characters slides over it, and its Shannon entropy follows from the
counts of the character that leaves and the one that enters, alone. The limit
depends on the candidate's character class. Candidates on the allow-list
(words, identifiers, plain numbers, UUIDs, placeholders) are suppressed.

Entropies are compared as integers (millionths of c * log2 c), so that
incremental and direct counts agree to the last bit. Everything happens in the
document's own row; no row is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, text_of

# The base patterns and their least lengths.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
VALUE = r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
MIN_VALUE = 6
# of a run of the class, the longest match is the run: the least length may stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

PART = 256  # items that one fold gathers
WINDOW = 20
SCALE = 1_000_000
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Character classes, narrowest first, with the least entropy (bits a character) of a secret.
CLASSES = (
    ("hex", r"[0-9a-f]+|[0-9A-F]+", 3.0),
    ("alnum", r"[A-Za-z0-9]+", 3.7),
    ("base64", r"[A-Za-z0-9+/_=-]+", 3.8),
)
ALLOWED = (
    r"[0-9]+",
    r"[A-Z]?[a-z]+|[A-Z]+",
    r"[A-Za-z]*(?:[-_/=+]+[A-Za-z]*)+",
    r"(?:[A-Za-z]+|[0-9]+)(?:[-_/=]+(?:[A-Za-z]+|[0-9]+))*[-_/=]*",
    r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}",
    r".*(?:EXAMPLE|example|SAMPLE|sample|PLACEHOLDER|placeholder|changeme|xxxx|XXXX).*",
)


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = "(?:" + "|".join(any_case(k) for k in KEYWORDS) + ")" + VALUE


def let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _scan(items: Column, state: Column, step, kind: str) -> Column:
    """``step(carry, item) -> struct(carry, out)`` along an array; returns the ``out`` that are not NULL.

    An array that grows inside a fold is copied for every item. Here it is at
    most ``PART`` long, and the parts are put together at the end: the work is
    linear up to millions of items.
    """
    def part(xs: Column, i: Column) -> Column:
        return F.slice(xs, i * PART + 1, F.lit(PART))

    def inside(a: Column, x: Column) -> Column:
        return let(step(a["carry"], x), lambda n: F.struct(
            n["carry"].alias("carry"), F.when(n["out"].isNull(), a["found"]).otherwise(
                F.concat(a["found"], F.array(n["out"]).cast(f"array<{kind}>"))).alias("found")))

    def over(xs: Column) -> Column:
        none = F.array().cast(f"array<{kind}>")
        parts = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / PART).cast("int"))
        start = F.struct(state.alias("carry"), F.array().cast(f"array<array<{kind}>>").alias("parts"))

        def outside(a: Column, i: Column) -> Column:
            one = F.aggregate(part(xs, i), F.struct(a["carry"].alias("carry"), none.alias("found")), inside)
            return let(one, lambda n: F.struct(n["carry"].alias("carry"),
                                               F.concat(a["parts"], F.array(n["found"])).alias("parts")))

        return F.when(F.size(xs) == 0, none).otherwise(
            F.flatten(F.aggregate(parts, start, outside, lambda a: a["parts"])))

    return let(items, over)


def _matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """``start, end, value`` of all matches, from the pieces between them.

    ``value`` is the group's text, the whole match's if there is none.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(F.split(text, pattern).alias("gap"), whole.alias("whole"), value.alias("value"))
    kind = "struct<start:bigint,end:bigint,value:string>"

    def step(at: Column, x: Column) -> Column:
        begin = at + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["whole"]), F.lit(0))
        one = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value")).cast(kind)
        return F.struct(end.cast("bigint").alias("carry"), F.when(x["whole"].isNotNull(), one).alias("out"))

    found = _scan(zipped, F.lit(0).cast("bigint"), step, kind)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{kind}>"))


def _entropy_limit(bits: float) -> int:
    """Largest sum of c * log2 c (scaled) in a window of at least ``bits`` a character."""
    return int(round(SCALE * WINDOW * (math.log2(WINDOW) - bits)))


def _window_span(value: Column, limit: Column) -> Column:
    """First and last end of the windows whose entropy reaches the class's limit (-1: none).

    ``sum`` is the window's sum of c * log2 c over its counts c. One character
    leaves and one enters at a time; only their two counts change it.
    """
    table = F.array(*[F.lit(0 if c < 2 else int(round(SCALE * c * math.log2(c)))).cast("bigint")
                      for c in range(WINDOW + 2)])
    f = lambda c: F.get(table, c)
    count = lambda window, c: F.length(window) - F.length(F.replace(window, c, F.lit("")))
    start = F.struct(F.lit("").alias("w"), F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("i"),
                     F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def step(a: Column, c: Column) -> Column:
        def slid(x: Column) -> Column:  # rest: the window without the one that leaves
            out = F.when(x["full"], f(count(x["rest"], x["out"])) - f(count(x["rest"], x["out"]) + 1)).otherwise(0)
            total = a["sum"] + out + f(count(x["rest"], c) + 1) - f(count(x["rest"], c))
            return let(total, lambda s: let((a["i"] + 1 >= WINDOW) & (s <= limit), lambda hit: F.struct(
                F.concat(x["rest"], c).alias("w"), s.alias("sum"), (a["i"] + 1).alias("i"),
                F.when(hit & (a["first"] < 0), a["i"] + 1).otherwise(a["first"]).alias("first"),
                F.when(hit, a["i"] + 1).otherwise(a["last"]).alias("last"))))

        full = F.length(a["w"]) >= WINDOW
        return let(F.struct(full.alias("full"), F.left(a["w"], F.lit(1)).alias("out"),
                            F.when(full, F.substr(a["w"], F.lit(2))).otherwise(a["w"]).alias("rest")), slid)

    return F.aggregate(F.filter(F.split(value, ""), lambda c: c != ""), start, step,
                       lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))


def entropy_spans(text: Column) -> Column:
    """``start, end`` of the part of each candidate that its high-entropy windows cover."""
    allowed = lambda v: v.rlike("^(?:" + "|".join(ALLOWED) + ")$")
    candidates = F.filter(_matches(text, CANDIDATE), lambda m: ~allowed(m["value"]))

    def limit(v: Column) -> Column:
        out = F.lit(-1).cast("bigint")
        for _, pattern, bits in reversed(CLASSES):
            out = F.when(v.rlike(f"^(?:{pattern})$"), F.lit(_entropy_limit(bits)).cast("bigint")).otherwise(out)
        return out

    seen = F.transform(candidates, lambda m: let(limit(m["value"]), lambda most: F.struct(
        m["start"].alias("start"), _window_span(m["value"], most).alias("w"))))
    return F.transform(F.filter(seen, lambda m: m["w"]["first"] >= 0), lambda m: F.struct(
        (m["start"] + m["w"]["first"] - WINDOW).alias("start"), (m["start"] + m["w"]["last"]).alias("end")))


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row``, ``base`` and ``spans``: arrays of ``start, kind (its number), end``, in that order.

    Positions count code points, the end is exclusive. ``spans`` are the base
    findings and the entropy findings that no base finding covers. A NULL or
    empty text has none. An empty table gives no rows.
    """
    whole = packed(docs, text_of(text).alias("t"))
    span = lambda kind: lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"))
    assign = F.filter(_matches(F.col("t"), ASSIGN, 1), lambda m: F.length(m["value"]) >= MIN_VALUE)
    base = F.array_sort(F.concat(F.transform(assign, span("assign")),
                                 F.transform(_matches(F.col("t"), ACCESS), span("access")),
                                 F.transform(_matches(F.col("t"), HEX), span("hex"))))
    found = whole.select("row", base.alias("base"),
                         F.transform(entropy_spans(F.col("t")), span("entropy")).alias("more"))
    return found.select("row", "base", _uncovered(F.array_sort(F.concat("base", "more"))).alias("spans"))


def _uncovered(spans: Column) -> Column:
    """Sorted spans without the entropy findings that lie inside a base finding.

    Base findings come first among equal starts, so the largest end of those
    before a span tells whether one of them covers it.
    """
    entropy = KINDS.index("entropy")

    def step(reach: Column, s: Column) -> Column:
        own = s["kind"] == entropy
        return F.struct(F.when(own, reach).otherwise(F.greatest(reach, s["end"])).alias("carry"),
                        F.when(~own | (s["end"] > reach), s).alias("out"))

    return _scan(spans, F.lit(-1).cast("bigint"), step, "struct<start:bigint,kind:int,end:bigint>")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
