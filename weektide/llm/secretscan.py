"""Secrets in texts: patterns of known kinds, and windows of high entropy; DataFrame functions only.

The base kinds are found leftmost and without overlaps, kind by kind:

| kind | a match | kept if |
| --- | --- | --- |
| assign | ``password``, ``passwd``, ``secret``, ``token``, ``api_key`` in any case, ``:`` or ``=``, a value | the value has six characters |
| access | ``AKIA`` and capitals or digits | twenty characters in all |
| hex | digits and a-f | 24 characters |

The method adds ``entropy`` spans.  Candidates are runs of letters, digits and ``+/_=-``.
A window of ``WINDOW`` characters slides over each; the count of every character and of
every class of characters is carried along, one leaving and one coming in at each step,
and with them the Shannon entropy of the window.  The class decides what is high:

| class of a window | signs | least bits |
| --- | --- | --- |
| hex | hexadecimal digits, at least three digits and three letters | 3.0 |
| alnum | digits and letters of one case, at least three of each | 3.6 |
| mixed | two digits, two capitals and two small letters at least, two other signs at most | 3.9 |

High windows that touch make one span.  A span is suppressed if its candidate has an
allowed shape as a whole (a UUID), or if the span holds an allowed word in any case.
Base spans stay whatever the allow-list says.

Entropies are compared as whole numbers (multiples of 2^-20), so the result does not
depend on rounding.  Counts of five bits lie twelve to a 64-bit number.  Long candidates
are worked through in blocks that overlap by a window, so no state grows with them.

Positions count code points from 0, ends are exclusive.  Defined results: a NULL or
empty text has no spans; equal rows get equal results, a row each; an empty table gives
none; ids may be NULL; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans at one place are listed.
KINDS = ("assign", "access", "hex", "entropy")
#: Characters of a window.
WINDOW = 20
#: Least entropy of a window in bits, by its class.
LEAST_BITS = {"hex": 3.0, "alnum": 3.6, "mixed": 3.9}
#: Candidates that are no secrets as a whole, and words that mark examples.
ALLOWED_SHAPES = (r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",)
ALLOWED_WORDS = ("example", "placeholder", "0123456789", "abcdefghij", "1234567890")

# The base patterns.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
LEAST_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

ALPHABET = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/_=-"
#: Entropy sums are whole multiples of this part of a bit.
UNIT = 1 << 20
_PER_WORD, _BITS = 12, 5
_BLOCK = 4096
# Classes of characters, counted eight bits each in one number.
_CLASSES = (string.ascii_uppercase, string.ascii_lowercase, string.digits, "+/_=-",
            "".join(set(ALPHABET) - set(string.hexdigits)))
_UPPER, _LOWER, _DIGIT, _SIGN, _NOT_HEX = range(len(_CLASSES))


def weight(n: int) -> int:
    """``n log2 n`` in units: a window's entropy is log2(size) less these over the size."""
    return round(n * math.log2(n) * UNIT) if n else 0


def most_weight(bits: float, window: int = WINDOW) -> int:
    """The largest sum of weights of a window with at least that many bits of entropy."""
    return math.floor((math.log2(window) - bits) * window * UNIT)


def candidates(window: int = WINDOW) -> str:
    """The pattern of strings that are long enough for a window."""
    return f"[A-Za-z0-9+/_=-]{{{window},}}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _numbers(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def _running(sizes: Column) -> Column:
    """Running totals of an array: each pass adds what stands twice as far ahead."""
    passes = F.ceil(F.log2(F.size(sizes) + F.lit(1))).cast("int")
    steps = F.transform(F.sequence(F.lit(0), passes), lambda p: F.pow(F.lit(2), p).cast("int"))
    return F.aggregate(
        steps, sizes,
        lambda sums, step: F.transform(
            sums, lambda x, i: x + F.coalesce(F.when(i >= step, F.get(sums, i - step)), F.lit(0))
        ),
    )


def _placed(text: Column, pattern: str, matches: Column) -> Column:
    """Start, end and text of all matches, from the lengths of what lies between them."""
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(
        F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m)
    )
    placed = F.zip_with(
        _running(sizes), matches,
        lambda end, m: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("secret")),
    )
    return placed


def _high(block: Column, window: int, least: Mapping[str, float]) -> Column:
    """Spans of high windows of a short string, by counts that slide along."""
    place = {c: i for i, c in enumerate(ALPHABET)}
    limits = {k: most_weight(bits, window) for k, bits in least.items()}
    # Of every ASCII character: its word of counts, its place there, what it adds to each count.
    spots = [divmod(place.get(chr(a), 0), _PER_WORD) for a in range(128)]
    words = _numbers([w for w, _ in spots])
    shifts = F.array(*[F.lit(_BITS * k) for _, k in spots])
    kinds = _numbers([sum((chr(a) in c) << (8 * k) for k, c in enumerate(_CLASSES)) for a in range(128)])
    weights = _numbers([weight(n) for n in range(window + 1)])

    def moved(now: Column, sign: Column, by: int) -> Column:
        """Counts and entropy sum after one character has come in (1) or left (-1)."""
        held = F.get(now["counts"], sign["word"].cast("int"))
        count = F.call_function("shiftright", held, sign["shift"]).bitwiseAND(F.lit((1 << _BITS) - 1))
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), sign["shift"])

        def counted(x: Column) -> Column:
            return F.struct(
                F.transform(now["counts"], lambda v, k: F.when(k == sign["word"], v + x["one"] * by).otherwise(v)).alias("counts"),
                (now["kinds"] + sign["kind"] * by).alias("kinds"),
                (now["sum"] + F.get(weights, x["count"] + by) - F.get(weights, x["count"])).alias("sum"),
            )

        return _let(F.struct(count.cast("int").alias("count"), one.alias("one")), counted)

    def high(now: Column) -> Column:
        def n(kind: int) -> Column:
            return F.shiftright(now["kinds"], 8 * kind).bitwiseAND(F.lit(255))

        letters, digits = n(_UPPER) + n(_LOWER), n(_DIGIT)
        one_case = (n(_SIGN) == 0) & ((n(_UPPER) == 0) | (n(_LOWER) == 0))
        some = (digits >= 3) & (letters >= 3)
        mixed = (n(_SIGN) <= 2) & (digits >= 2) & (n(_UPPER) >= 2) & (n(_LOWER) >= 2)
        return (
            F.when(n(_NOT_HEX) == 0, some & (now["sum"] <= limits["hex"]))
            .when(one_case, some & (now["sum"] <= limits["alnum"]))
            .otherwise(mixed & (now["sum"] <= limits["mixed"]))
        )

    def span(s: Column) -> Column:
        return F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))

    def noted(s: Column, now: Column, i: Column) -> Column:
        """The state with the window that ends at ``i``: it goes on a span or begins one."""
        first, some = i - (window - 1), s["end"] > 0
        hit = (first >= 0) & high(now)
        begins = hit & ~(some & (first <= s["end"]))
        return F.struct(
            now.alias("now"),
            F.when(begins & some, F.concat(s["done"], span(s))).otherwise(s["done"]).alias("done"),
            F.when(begins, first).otherwise(s["start"]).alias("start"),
            F.when(hit, i + 1).otherwise(s["end"]).alias("end"),
        )

    def spans(signs: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            rest = F.when(
                i >= window, moved(s["now"], F.get(signs, i - window), -1)
            ).otherwise(s["now"])
            return _let(_let(rest, lambda r: moved(r, F.get(signs, i), 1)), lambda now: noted(s, now, i))

        return F.aggregate(
            F.sequence(F.lit(0), F.size(signs) - 1), empty, step,
            lambda s: F.when(s["end"] > 0, F.concat(s["done"], span(s))).otherwise(s["done"]),
        )

    none = F.array().cast(_SPANS)
    empty = F.struct(
        F.struct(
            _numbers([0] * -(-len(ALPHABET) // _PER_WORD)).alias("counts"),
            F.lit(0).cast("bigint").alias("kinds"), F.lit(0).cast("bigint").alias("sum"),
        ).alias("now"),
        none.alias("done"), F.lit(0).alias("start"), F.lit(0).alias("end"),
    )
    signs = F.transform(F.filter(F.split(block, ""), lambda c: c != ""), lambda c: _let(
        F.ascii(c) + 1,
        lambda a: F.struct(
            F.element_at(words, a).alias("word"), F.element_at(shifts, a).alias("shift"),
            F.element_at(kinds, a).alias("kind"),
        ),
    ))
    return F.when(F.length(block) >= window, _let(signs, spans)).otherwise(none)


_SPANS = "array<struct<start:int,end:int>>"


def entropy_spans(text: Column, window: int = WINDOW, least: Mapping[str, float] = LEAST_BITS) -> Column:
    """Spans of touching high windows of one candidate string."""
    chunks = F.regexp_extract_all(text, F.lit(f"(.{{1,{_BLOCK}}})"), F.lit(1))

    def blocks(chunks: Column) -> Column:
        return F.flatten(F.transform(chunks, lambda c, i: F.transform(
            _high(F.concat(c, F.coalesce(F.left(F.get(chunks, i + 1), F.lit(window - 1)), F.lit(""))), window, least),
            lambda s: F.struct(
                (s["start"] + i * _BLOCK).alias("start"), (s["end"] + i * _BLOCK).alias("end")
            ),
        )))

    def merged(spans: Column) -> Column:
        """Spans of neighbouring blocks joined where they touch."""
        begins = F.filter(spans, lambda s, i: F.coalesce(s["start"] > F.get(spans, i - 1)["end"], F.lit(True)))
        ends = F.filter(spans, lambda s, i: F.coalesce(F.get(spans, i + 1)["start"] > s["end"], F.lit(True)))
        return F.zip_with(begins, ends, lambda b, e: F.struct(b["start"].alias("start"), e["end"].alias("end")))

    return _let(_let(chunks, blocks), merged)


def scan(
    docs: DataFrame, id_col: str, text_col: str,
    window: int = WINDOW, least: Mapping[str, float] = LEAST_BITS,
    allowed_shapes: Sequence[str] = ALLOWED_SHAPES, allowed_words: Sequence[str] = ALLOWED_WORDS,
) -> DataFrame:
    """``doc_id`` and ``spans`` of every document: kind, start, end and the secret's text,
    by start, then in the order of ``KINDS``.  ``window`` is at most 31 characters."""
    if not 2 <= window < 1 << _BITS:
        raise ValueError("a window has 2 to 31 characters")
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": candidates(window)}

    def matches(kind: str) -> Column:
        found = F.regexp_extract_all(F.col("text"), F.lit(patterns[kind]), F.lit(0))
        if kind == "access":  # most texts have none
            return F.when(F.contains("text", F.lit("AKIA")), found).otherwise(F.array().cast("array<string>"))
        return found

    def spans(kind: str) -> Column:
        placed = _placed(F.col("text"), patterns[kind], F.col(kind))
        if kind == "assign":
            placed = F.filter(placed, lambda s: F.length(F.regexp_extract(s["secret"], ASSIGN, 2)) >= LEAST_VALUE)
        if kind == "entropy":
            if allowed_shapes:
                shapes = "^(?:" + "|".join(allowed_shapes) + ")$"
                placed = F.filter(placed, lambda s: ~s["secret"].rlike(shapes))
            placed = F.flatten(F.transform(placed, lambda c: F.transform(
                entropy_spans(c["secret"], window, least),
                lambda s: F.struct(
                    (c["start"] + s["start"]).alias("start"), (c["start"] + s["end"]).alias("end"),
                    F.substring(c["secret"], s["start"] + 1, s["end"] - s["start"]).alias("secret"),
                ),
            )))
            if allowed_words:
                words = "|".join(re.escape(word.lower()) for word in allowed_words)
                placed = F.filter(placed, lambda s: ~F.lower(s["secret"]).rlike(words))
        rank = KINDS.index(kind)
        return F.when(F.size(kind) > 0, F.transform(placed, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), s["secret"].alias("secret")
        ))).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int,secret:string>>"))

    kinds = F.array(*[F.lit(k) for k in KINDS])
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    found = rows.select("*", *[matches(kind).alias(kind) for kind in KINDS])
    return found.select("doc_id", F.transform(
        F.sort_array(F.concat(*[spans(kind) for kind in KINDS])),
        lambda s: F.struct(
            F.get(kinds, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["secret"].alias("secret"),
        ),
    ).alias("spans"))
