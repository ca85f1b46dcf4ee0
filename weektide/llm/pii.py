"""Pseudonyms for personal data that keep its format, in DataFrame functions only.

Numbers, dates, addresses and secrets are found by one pattern, validated by the rules
of their kind, and permuted within their format by a keyed Feistel network.  The same
value gets the same pseudonym in every document, two values never share one, and a
pseudonym is again a valid value of its kind.  What fails validation stays as it is, but is
looked at again behind its first run of signs, so a value beside other digits is found.

| kind | valid if | permuted |
| --- | --- | --- |
| payment card, 13-19 digits, in the usual groups or in others that hold no other value | Luhn sum | all digits but the check digit, which is set anew |
| IPv4 address | four numbers 0-255 without leading zeros | the four numbers |
| phone, ``+1 (988) 555-2485`` and the like, or ``988-555-2485`` | 7-15 digits | all but the country code and the two first digits of the area |
| social security number ``123-45-6789`` | area not 000, 666, 9xx; no zero group | within valid areas, groups and numbers |
| IBAN, as long as its country has them | remainder 1 by 97 | digits and letters after the check digits, which are set anew |
| date, ``2001-02-03``, ``03.02.2001``, ``02/03/2001``, also with / or - | a day of 1900-2099 | the day among all that are written in the same way |
| e-mail address | pattern | letters (up to Latin-1) and digits before the @ |
| access key, ``password=...``, ``token = "..."`` | pattern | letters and digits of the secret |

A slashed date is month/day/year if that is a day, else day/month/year.

A network works on a list of values with a base for each: halves take turns, and to
each value of one half a keyed digest of the other half is added, modulo its base.

Defined results: a NULL text stays NULL, an empty one empty; text outside matches is
kept byte by byte; rows, ids and all other columns are left as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds of a network.
ROUNDS = 8

_EMAIL = r"[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_IBAN = r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b"
_KEY = r"\bAKIA[A-Z0-9]{16}\b"
_SECRET = (
    r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[ ]{0,2}[=:][ ]{0,2}[\"']?)"
    r"[A-Za-z0-9+/_-]{8,}"
)
_DATE = (
    r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}"
    r"|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2})(?![0-9]|[./-][0-9])"
)
_IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
# Cards as they are written; and any groups, where nothing else is found in them.
_CARD = (
    r"(?<![0-9])(?:(?:[0-9]{4}[ -]){3}[0-9]{4}(?:[ -][0-9]{3}(?![ -]?[0-9]))?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}"
    r"|[0-9]{13,19})(?![0-9])"
)
_GROUPS = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
_PHONE = (
    r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
    r"|(?<![0-9])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
)
_KINDS = [_EMAIL, _KEY, _SECRET, _IBAN, _DATE, _IP, _SSN, _CARD, _PHONE, _GROUPS]
_PATTERN = "|".join(f"(?:{p})" for p in _KINDS)
#: How often what a failed or shorter match leaves over is looked at again.
AGAIN = 1

# Characters of an account number by country.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}


def _digest(key: str, kind: str, turn: Column, other: Column) -> Column:
    """A keyed digest of one half."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn, F.concat_ws(",", other)), 256)


def feistel(values: Column, bases: Column, key: str, kind: str) -> Column:
    """``values`` permuted: each stays within 0 and its base (exclusive).

    One value alone has no half to take turns with; its shift depends on the key only.
    """
    half = F.floor(F.size(values) / 2).cast("int")
    rest = F.size(values) - half
    left_bases, right_bases = F.slice(bases, 1, half), F.slice(bases, half + 1, rest)

    def shifted(part: Column, part_bases: Column, digest: Column) -> Column:
        return F.transform(part, lambda v, i: F.pmod(
            v + F.pmod(F.xxhash64(digest, i), F.lit(1 << 40)),
            F.element_at(part_bases, i + 1),
        ))

    def turn(state: Column, number: Column) -> Column:
        left, right = state["l"], state["r"]
        even = F.pmod(number, F.lit(2)) == 0
        digest = _digest(key, kind, number.cast("string"),
                         F.transform(F.when(even, right).otherwise(left), lambda v: v.cast("string")))
        return F.struct(
            F.when(even, shifted(left, left_bases, digest)).otherwise(left).alias("l"),
            F.when(even, right).otherwise(shifted(right, right_bases, digest)).alias("r"),
        )

    start = F.struct(F.slice(values, 1, half).alias("l"), F.slice(values, half + 1, rest).alias("r"))
    turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(turns, start, turn, lambda s: F.concat(s["l"], s["r"]))


def _longs(strings: Column) -> Column:
    return F.transform(strings, lambda x: x.cast("bigint"))


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


#: Digits and letters that are permuted among their like: first code, and how many.
_LIKE = ((48, 10), (97, 26), (65, 26), (224, 23), (248, 7), (192, 23), (216, 7))


def _alnum(text: Column, key: str, kind: str, hexadecimal: bool = False) -> Column:
    """Digits, lower and upper case letters (up to Latin-1) permuted among their like;
    other signs stay."""
    chars = _chars(text)

    def chosen(code: Column, what: Callable[[int, int], Column], other: Column) -> Column:
        out = None
        for low, n in _LIKE:
            size = 6 if hexadecimal and low == 97 else n
            hit, value = code.between(low, low + n - 1), what(low, size)
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out.otherwise(other).cast("bigint")

    def low(code: Column) -> Column:
        return chosen(code, lambda low, n: F.lit(low), code)

    codes = F.transform(chars, lambda c: F.ascii(c).cast("bigint"))
    bases = F.transform(codes, lambda c: chosen(c, lambda low, n: F.lit(n), F.lit(1)))
    moved = feistel(F.transform(codes, lambda c: c - low(c)), bases, key, kind)
    return F.array_join(F.zip_with(chars, moved, lambda c, m: _let(
        F.ascii(c).cast("bigint"),
        lambda a: F.when(chosen(a, lambda low, n: F.lit(n), F.lit(1)) > 1, F.char(low(a) + m)).otherwise(c),
    )), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _refill(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced, in order, by those of the array ``digits``."""
    state = F.struct(F.lit("").alias("t"), F.lit(1).alias("i"))
    joined = F.array_join(digits, "")

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["t"], F.when(digit, F.substring(joined, s["i"], F.lit(1))).otherwise(c)).alias("t"),
            (s["i"] + F.when(digit, 1).otherwise(0)).alias("i"),
        )

    return F.aggregate(_chars(text), state, step, lambda s: s["t"])


def _digits(text: Column) -> Column:
    return _longs(_chars(F.regexp_replace(text, "[^0-9]", "")))


def _same(n: Column, value: int) -> Column:
    return F.array_repeat(F.lit(value).cast("bigint"), n)


def _luhn(digits: Column) -> Column:
    """The sum that has to end in 0, the last digit being the check digit."""
    doubled = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 0, d).otherwise(
        F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    ))
    return F.aggregate(doubled, F.lit(0).cast("bigint"), lambda a, d: a + d)


def _card(text: Column, key: str) -> Column:
    digits = _digits(text)
    body = F.slice(digits, 1, F.size(digits) - 1)
    moved = feistel(body, _same(F.size(body), 10), key, "card")
    zero = F.array(F.lit(0).cast("bigint"))
    check = F.pmod(10 - F.pmod(_luhn(F.concat(moved, zero)), F.lit(10)), F.lit(10))
    filled = _refill(text, F.concat(moved, F.array(check)))
    return F.when(_luhn(digits) % 10 == 0, filled).otherwise(text)


def _ip(text: Column, key: str) -> Column:
    octets = _longs(F.split(text, "[.]"))
    moved = feistel(octets, _same(F.lit(4), 256), key, "ip")
    # With leading zeros it is no address: two of them would be one.
    valid = F.forall(octets, lambda o: o < 256) & ~text.rlike(r"(?:^|[.])0[0-9]")
    return F.when(valid, F.array_join(moved, ".")).otherwise(text)


def _ssn(text: Column, key: str) -> Column:
    parts = _longs(F.split(text, "-"))
    area, group, serial = (F.element_at(parts, k) for k in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    values = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)
    moved = feistel(values, F.array(*[F.lit(b).cast("bigint") for b in (898, 99, 9999)]), key, "ssn")

    def out(moved: Column) -> Column:
        a = F.element_at(moved, 1)
        return F.concat_ws(
            "-", F.lpad((F.when(a >= 665, a + 2).otherwise(a + 1)).cast("string"), 3, "0"),
            F.lpad((F.element_at(moved, 2) + 1).cast("string"), 2, "0"),
            F.lpad((F.element_at(moved, 3) + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, F.element_at(F.transform(F.array(moved), out), 1)).otherwise(text)


def _phone(text: Column, key: str) -> Column:
    """Digits of the country code and the area's first two stay, so a number stays valid."""
    code = F.when(text.startswith("+"), F.regexp_extract(text, r"^\+[0-9]+", 0)).otherwise("")
    rest = F.substring(text, F.length(code) + 1, F.length(text))
    digits = _digits(rest)
    kept, body = F.slice(digits, 1, 2), F.slice(digits, 3, F.greatest(F.size(digits) - 2, F.lit(0)))
    moved = feistel(body, _same(F.size(body), 10), key, "phone")
    total = F.length(F.regexp_replace(text, "[^0-9]", ""))
    valid = total.between(7, 15) & (F.size(body) >= 2)
    return F.when(valid, F.concat(code, _refill(rest, F.concat(kept, moved)))).otherwise(text)


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a run of digits and letters, A counting as 10."""
    def step(a: Column, c: Column) -> Column:
        code = F.ascii(c).cast("bigint")
        return F.when(code < 58, F.pmod(a * 10 + code - 48, F.lit(97))).otherwise(
            F.pmod(a * 100 + code - 55, F.lit(97))
        )

    return F.aggregate(_chars(text), F.lit(0).cast("bigint"), step)


def _iban(text: Column, key: str) -> Column:
    plain = F.regexp_replace(text, " ", "")
    country, body = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = _mod97(F.concat(body, country, F.substring(plain, 3, 2))) == 1

    def out(moved: Column) -> Column:
        rest = _mod97(F.concat(moved, country, F.lit("00")))
        whole = F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), moved)
        state = F.struct(F.lit("").alias("t"), F.lit(1).alias("i"))
        return F.aggregate(
            _chars(text), state,
            lambda s, c: F.struct(
                F.concat(s["t"], F.when(c == " ", c).otherwise(F.substring(whole, s["i"], F.lit(1)))).alias("t"),
                (s["i"] + F.when(c == " ", 0).otherwise(1)).alias("i"),
            ),
            lambda s: s["t"],
        )

    moved = F.array(_alnum(body, key, "iban"))
    return F.when(valid, F.element_at(F.transform(moved, out), 1)).otherwise(text)


# Days from 1900-01-01 to 2099-12-31: 73 049 = 17 * 4297, so a day is a pair of numbers.
_DAY_BASES = (17, 4297)


#: Steps of a walk along a permutation; a set of a fifth of all days is missed by as many
#: with a chance of 1e-24.
_WALK = 256


def _date(text: Column, key: str) -> Column:
    """The day moves among all that read in the same way: a part of one digit stays one,
    and a slashed date that can only be day/month stays such.  The permutation is walked
    until it comes to one of those, which is a permutation of them."""
    parts = F.split(text, "[./-]")
    a, b, c = (F.element_at(parts, k) for k in (1, 2, 3))
    year_first = F.length(a) == 4
    slash = text.contains("/")
    start = F.lit("1900-01-01").cast("date")

    def day(y: Column, m: Column, d: Column) -> Column:
        iso = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
        return F.datediff(iso.try_cast("date"), start).cast("bigint")

    month_first = slash & ~year_first & day(c, a, b).isNotNull()
    number = F.when(year_first, day(a, b, c)).when(month_first, day(c, a, b)).otherwise(day(c, b, a))
    month_at = F.when(year_first, b).when(month_first, a).otherwise(b)
    day_at = F.when(year_first, c).when(month_first, b).otherwise(a)
    bases = F.array(*[F.lit(x).cast("bigint") for x in _DAY_BASES])
    told = F.struct(
        number.alias("n"), (slash & ~year_first & ~month_first).alias("late"),
        (F.length(month_at) == 1).alias("short_month"), (F.length(day_at) == 1).alias("short_day"),
        year_first.alias("year_first"), month_first.alias("month_first"),
    )

    def moved(n: Column) -> Column:
        values = F.array(F.floor(n / _DAY_BASES[1]), F.pmod(n, F.lit(_DAY_BASES[1])))
        return _let(feistel(values, bases, key, "date"),
                    lambda m: F.element_at(m, 1) * _DAY_BASES[1] + F.element_at(m, 2))

    def walked(t: Column) -> Column:
        def reads(n: Column) -> Column:
            at = F.date_add(start, n.cast("int"))
            d, m = F.dayofmonth(at), F.month(at)
            return (~t["late"] | (d > 12)) & (~t["short_month"] | (m < 10)) & (~t["short_day"] | (d < 10))

        def step(s: Column, _: Column) -> Column:
            return F.when(s["done"], s).otherwise(
                _let(moved(s["n"]), lambda n: F.struct(n.alias("n"), reads(n).alias("done")))
            )

        zero = F.struct(t["n"].alias("n"), F.lit(False).alias("done"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), zero, step, lambda s: s["n"])

    def out(t: Column) -> Column:
        def printed(new: Column) -> Column:
            y = F.date_format(new, "yyyy")
            m = F.when(t["short_month"], F.date_format(new, "M")).otherwise(F.date_format(new, "MM"))
            d = F.when(t["short_day"], F.date_format(new, "d")).otherwise(F.date_format(new, "dd"))
            first = F.when(t["year_first"], y).when(t["month_first"], m).otherwise(d)
            second = F.when(t["year_first"] | ~t["month_first"], m).otherwise(d)
            third = F.when(t["year_first"], d).otherwise(y)
            gap = F.regexp_extract(text, "[./-]", 0)
            gap2 = F.regexp_extract(text, "[./-][0-9]+([./-])", 1)
            return F.concat(first, gap, second, gap2, third)

        return F.when(t["n"].isNotNull(), _let(F.date_add(start, walked(t).cast("int")), printed)).otherwise(text)

    return _let(told, out)


def _email(text: Column, key: str) -> Column:
    name = F.substring_index(text, "@", 1)
    return F.concat(_alnum(name, key, "email"), F.substring(text, F.length(name) + 1, F.length(text)))


def _secret(text: Column, key: str) -> Column:
    secret = F.regexp_extract(text, r"[A-Za-z0-9+/_-]{8,}$", 0)
    lead = F.substring(text, F.lit(1), F.length(text) - F.length(secret))
    hexadecimal = secret.rlike("^[0-9a-f]+$")
    return F.concat(lead, F.when(hexadecimal, _alnum(secret, key, "hex", True)).otherwise(
        _alnum(secret, key, "secret")
    ))


def _access_key(text: Column, key: str) -> Column:
    return F.concat(F.lit("AKIA"), _alnum(F.substring(text, 5, 16), key, "access"))


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one match of the pattern, by the first kind that it is; what
    fails the rules of its kind stays."""
    others = "|".join(f"(?:{p})" for p in (_SSN, _CARD, _PHONE))
    rules: list[tuple[str, Callable[[Column, str], Column]]] = [
        (_EMAIL, _email), (_KEY, _access_key), (_SECRET, _secret), (_IBAN, _iban),
        (_DATE, _date), (_IP, _ip), (_SSN, _ssn), (_CARD, _card), (_PHONE, _phone),
    ]
    out = F.when(match.rlike(others), match).otherwise(_card(match, key))
    for pattern, rule in reversed(rules):
        out = F.when(match.rlike(f"^(?:{pattern})$"), rule(match, key)).otherwise(out)
    return out


def _head(match: Column) -> Column:
    """The part of a match that is tried: of an account number as many characters as its
    country has; of a card with three digits after it the card, if that is valid alone."""
    lengths = F.create_map(*[
        F.lit(x) for n, names in _IBAN_LENGTHS.items() for name in names.split() for x in (name, n)
    ])
    n = F.element_at(lengths, F.substring(match, 1, 2)).cast("string")
    account = F.concat(F.lit("^[A-Z0-9](?: ?[A-Z0-9]){"), (n.cast("int") - 1).cast("string"), F.lit("}(?![A-Z0-9])"))
    cut = F.call_function("regexp_extract", match, account, F.lit(0))
    card = F.substring(match, 1, 19)
    return (
        F.when(match.rlike(f"^(?:{_IBAN})$") & n.isNotNull(), F.coalesce(F.when(cut != "", cut), match))
        .when(match.rlike("^(?:[0-9]{4}[ -]){4}[0-9]{3}$") & (_luhn(_digits(card)) % 10 == 0), card)
        .otherwise(match)
    )


def _parts(text: Column, key: str) -> Column:
    """``text`` in parts with pseudonyms: what is done, and what may hold more (``open``).

    After a match that fails, its first run of letters and digits is done and the rest
    is open; after one that was longer than the value in it, what follows is.
    """
    found = F.regexp_extract_all(text, F.lit(f"({_PATTERN})"), F.lit(0))
    between = F.split(text, _PATTERN, -1)

    def tried(m: Column) -> Column:
        first = F.regexp_extract(m, "^[^A-Za-z0-9]*[A-Za-z0-9]+", 0)
        return _let(_head(m), lambda h: F.struct(m.alias("m"), h.alias("h"), first.alias("f"), pseudonym(h, key).alias("new")))

    def told(t: Column, gap: Column) -> Column:
        kept = t["new"] == t["h"]
        rest = F.substring(t["m"], F.length(F.when(kept, t["f"]).otherwise(t["h"])) + 1, F.length(t["m"]))
        # What is left may go on behind the match.
        return F.array(
            F.struct(F.when(kept, t["f"]).otherwise(t["new"]).alias("part"), F.lit(False).alias("open")),
            F.struct(F.concat(rest, gap).alias("part"), rest.rlike("[0-9]").alias("open")),
        )

    def closed(part: Column) -> Column:
        return F.array(F.struct(part.alias("part"), F.lit(False).alias("open")))

    n = F.size(found)
    parts = F.flatten(F.zip_with(F.transform(found, tried), F.slice(between, 2, n), told))
    return F.when(n > 0, F.concat(closed(F.get(between, F.lit(0))), parts)).otherwise(closed(text))


def pseudonymise(docs: DataFrame, text_col: str, key: str) -> DataFrame:
    """``docs`` with the personal data of one text column replaced.

    One pattern cuts a text into matches and what lies between; matches are replaced
    and the pieces joined again.  What failed or longer matches leave over goes through
    the same ``AGAIN`` times more.  A text that cannot hold a match (it has neither an @
    nor a digit, nor a named secret) is passed through.
    """
    # The kinds nest deeper than the analyzer's default of rounds resolves.
    conf = docs.sparkSession.conf
    conf.set("spark.sql.analyzer.maxIterations", str(max(400, int(conf.get("spark.sql.analyzer.maxIterations")))))
    held = "parts"
    while held.lower() in {c.lower() for c in docs.columns}:
        held += "_"
    text = F.col(f"`{text_col}`").cast("string")
    may = text.rlike("@|[0-9]") | text.rlike(f"(?:{_SECRET})")
    out = docs.withColumn(held, F.when(may, _parts(text, key)))
    for _ in range(AGAIN):
        more = F.flatten(F.transform(held, lambda p: F.when(p["open"], _parts(p["part"], key)).otherwise(F.array(p))))
        out = out.withColumn(held, F.when(F.exists(held, lambda p: p["open"]), more).otherwise(F.col(held)))
    joined = F.array_join(F.transform(held, lambda p: p["part"]), "")
    return out.withColumn(text_col, F.when(F.col(held).isNotNull(), joined).otherwise(text)).drop(held)
