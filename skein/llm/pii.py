"""Format-preserving pseudonyms for validated numbers and dates.

Kinds (fixed patterns below): payment card numbers that pass the Luhn check
(among groups of digits, any run of whole groups), IBANs whose check digits
hold, phone numbers in the forms of the North American plan with any area and
exchange code (between blanks alone: with codes from 200) and international ones
after ``+``, social security numbers, IPv4 and IPv6 addresses, dates (ISO and
with slashes, day.month.year, month/day/year or day/month/year, with month names
in four languages) and the letters and digits of an e-mail address's local part.
A match that doesn't validate stays as it is.

A value becomes a list of small numbers, each with its own radix and least
value.  A Feistel network permutes the list: it is cut into two halves, and in
each of ``ROUNDS`` rounds every number of one half moves, within its radix, by
a SHA-256 value of the key, the kind, the round and the other half.  So the
map is a bijection of each format onto itself: equal values get equal
pseudonyms in all documents, and different values different ones.  A card's
last digit and an IBAN's check digits are computed anew; a date is its day in a cycle of 400 years,
146,097 days = 189 * 773, written as two numbers with these radices.
Separators, letter case and field widths stay; days and months of one digit
may get two.  A date with slashes whose order is open is month/day; a month
name that two languages share counts for the first of them.  A local part's
letters move within the ranges below, letters of other scripts stay.

DataFrame operations only, row by row: no join and no shuffle.

Defined results: null stays null, empty stays empty; matches never overlap,
the first alternative at a place wins; other columns stay as they are; a
repeated row gives the same text again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Month names.
MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
    "januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember",
    "janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre",
    "enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
]
#: Ranges of digits and letters of one case, first code and size.
LETTERS = [
    (0x30, 10), (0x41, 26), (0x61, 26), (0xC0, 23), (0xD8, 7), (0xE0, 23), (0xF8, 8), (0x100, 128), (0x391, 17), (0x3A3, 7), (0x3B1, 25),
    (0x410, 32), (0x430, 32), (0x5D0, 27), (0x3041, 86), (0x30A1, 90), (0x4E00, 20992), (0xAC00, 11172),
]
LETTER = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{a + n - 1:X}}}" for a, n in LETTERS) + "]"
NAME = "(?iu:" + "|".join(sorted(set(MONTHS), key=len, reverse=True)) + ")"

#: Fixed patterns, in order of precedence.
KINDS = {
    "email": r"(?<![\p{L}\p{N}])[\p{L}\p{N}][\p{L}\p{M}\p{N}._%+-]*+@[\p{L}\p{M}\p{N}-]+(?:\.[\p{L}\p{M}\p{N}-]+)*\.\p{L}{2,}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ipv6": r"(?<![\p{L}\p{N}:.])(?=[A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:]|\.[0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "iso_date": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])",
    "dot_date": r"(?<![0-9.])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9]|\.[0-9])",
    "slash_date": r"(?<![0-9/])(?:[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{4}/[0-9]{2}/[0-9]{2})(?![0-9]|/[0-9])",
    "named_date": rf"(?<![0-9.])[0-9]{{1,2}}(?:\.|st|nd|rd|th|er)? (?:de |of )?{NAME},? (?:de )?[0-9]{{4}}(?![0-9])|(?<![\p{{L}}\p{{N}}]){NAME} [0-9]{{1,2}}(?:st|nd|rd|th)?,? [0-9]{{4}}(?![0-9])",
    "phone": r"(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}(?![0-9])"
    r"|(?:(?<![0-9-])|(?<=(?<![0-9])1-))[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9]|-[0-9])"
    r"|(?:(?<![0-9.])|(?<=(?<![0-9])1\.))[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9]|\.[0-9])"
    r"|(?<![0-9])(?:[0-9]{3} [0-9]{3}-|[2-9][0-9]{2} [2-9][0-9]{2} )[0-9]{4}(?![0-9])"
    r"|\+1[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
    "world_phone": r"(?<![\p{L}\p{N}+])\+[2-9][0-9]{1,2}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,12}){1,5}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
}
#: Groups of digits, 13 or more in all, up to the next value of another kind, or where two are too long for
#: one card; cards are looked for among them.
OTHER = "|".join(f"(?:{p})" for p in KINDS.values())
KINDS["card"] = rf"(?<![0-9])(?=(?:[ -]?[0-9]){{13}})[0-9]{{1,19}}(?![0-9])(?:[ -](?!(?<=[0-9]{{13}}[ -])[0-9]{{13}})(?!{OTHER})[0-9]{{1,19}}(?![0-9])){{0,200}}"
#: Cards as one group, 4-4-4-4 and 4-6-5.
USUAL = r"^(?:[0-9]+|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"
CANDIDATE = "|".join(f"(?:{p})" for p in KINDS.values())

DAYS, DAYS_A, DAYS_B = 146097, 189, 773
#: First day of the cycle of 400 years that holds today.
CYCLE = "1800-01-01"


def feistel(values: Column, radices: Column, key: str, kind: str) -> Column:
    """The list with each number permuted within its radix (see the module's text)."""
    n = F.size(values)
    half = F.floor(n / 2).cast("int")

    def turn(state: Column, r: Column) -> Column:
        def move(x: Column, i: Column) -> Column:
            said = F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), i.cast("string"), F.array_join(state["b"].cast("array<string>"), ","))
            shift = F.conv(F.substring(F.sha2(said, 256), 1, 12), 16, 10).cast("bigint")
            return F.pmod(x.cast("bigint") + shift, F.element_at(state["ra"], i + 1).cast("bigint")).cast("int")

        return F.struct(state["b"].alias("a"), F.transform(state["a"], move).alias("b"), state["rb"].alias("ra"), state["ra"].alias("rb"))

    zero = F.struct(
        F.slice(values, 1, half).alias("a"),
        F.slice(values, half + 1, n - half).alias("b"),
        F.slice(radices, 1, half).alias("ra"),
        F.slice(radices, half + 1, n - half).alias("rb"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), zero, turn, lambda s: F.concat(s["a"], s["b"]))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _characters(value: Column) -> Column:
    return F.split(value, "")


def _codes(characters: Column) -> Column:
    return F.transform(characters, lambda c: F.ascii(c))


def _digits(value: Column) -> Column:
    return F.transform(_characters(F.regexp_replace(value, "[^0-9]", "")), lambda c: c.cast("int"))


def _filled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by ``digits``."""
    fields = F.split(value, "[0-9]")
    return F.array_join(F.zip_with(fields, digits, lambda f, d: F.concat(f, F.coalesce(d.cast("string"), F.lit("")))), "")


def luhn(digits: Column) -> Column:
    """The sum modulo 10 that is 0 for valid numbers."""

    def add(a: Column, x: Column) -> Column:
        twice = x["d"] * 2
        return a + F.when(x["odd"], F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(x["d"])

    marked = F.transform(F.reverse(digits), lambda d, i: F.struct(d.alias("d"), (i % 2 == 1).alias("odd")))
    return F.pmod(F.aggregate(marked, F.lit(0), add), F.lit(10))


def _permuted(digits: Column, least: Column, radices: Column, key: str, kind: str) -> Column:
    moved = feistel(F.zip_with(digits, least, lambda d, m: d - m), radices, key, kind)
    return F.zip_with(moved, least, lambda d, m: d + m)


def _card(value: Column, key: str) -> Column:
    """Of the runs of whole groups with 13 to 19 digits, those that are valid: the usual forms, then others, the leftmost first and the longest of these."""

    def change(digits: Column) -> Column:
        n = F.size(digits)
        body = feistel(F.slice(digits, 1, n - 1), F.array_repeat(F.lit(10), n - 1), key, "card")
        return _let(body, lambda b: F.concat(b, F.array(F.pmod(10 - luhn(F.concat(b, F.array(F.lit(0)))), F.lit(10)).cast("int"))))

    def choose(groups: Column) -> Column:
        n = F.size(groups)

        def start(i: Column) -> Column:  # the group's place in the value, from 1
            return F.char_length(F.array_join(F.slice(groups, 1, i), " ")) + F.when(i > 0, 2).otherwise(1)

        def runs(i: Column) -> Column:
            size = F.sequence(F.least(F.lit(19), n - i), F.lit(1), F.lit(-1))
            found = F.transform(size, lambda k: F.struct(start(i).alias("at"), F.char_length(F.array_join(F.slice(groups, i + 1, k), " ")).alias("n")))
            found = F.filter(found, lambda x: F.char_length(F.regexp_replace(F.substr(value, x["at"], x["n"]), "[^0-9]", "")).between(13, 19))
            found = F.filter(found, lambda x: luhn(_digits(F.substr(value, x["at"], x["n"]))) == 0)
            return F.transform(found, lambda x: F.struct(x["at"].alias("at"), x["n"].alias("n"), F.substr(value, x["at"], x["n"]).rlike(USUAL).alias("usual")))

        def add(state: Column, x: Column) -> Column:
            part = F.substr(value, x["at"], x["n"])
            new = F.concat(state["out"], F.substr(value, state["next"], x["at"] - state["next"]), _filled(part, change(_digits(part))))
            return F.when(x["at"] < state["next"], state).otherwise(F.struct(new.alias("out"), (x["at"] + x["n"]).alias("next")))

        def replaced(valid: Column) -> Column:
            def free(x: Column) -> Column:
                return x["usual"] | ~F.exists(valid, lambda y: y["usual"] & (y["at"] < x["at"] + x["n"]) & (x["at"] < y["at"] + y["n"]))

            zero = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))
            return F.aggregate(F.filter(valid, free), zero, add, lambda s: F.concat(s["out"], F.substr(value, s["next"], F.char_length(value))))

        return _let(F.flatten(F.transform(F.sequence(F.lit(0), n - 1), runs)), replaced)

    return _let(F.split(value, "[ -]"), choose)


def _numbers(*values: int) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _phone(value: Column, key: str) -> Column:
    """Ten digits; area and exchange codes that begin with 0 or 1 go to such codes."""

    def change(d: Column) -> Column:
        def first(x: Column) -> tuple[Column, Column]:
            return F.when(x >= 2, 2).otherwise(0), F.when(x >= 2, 8).otherwise(2)

        (a, ra), (b, rb), ten, zero = first(d[0]), first(d[3]), F.lit(10), F.lit(0)
        least, radices = F.array(a, zero, zero, b, *[zero] * 6), F.array(ra, ten, ten, rb, *[ten] * 6)
        return _permuted(d, least, radices, key, "phone")

    country = F.regexp_extract(value, r"^\+1", 0)
    number = F.regexp_replace(value, r"^\+1", "")
    return F.concat(country, _let(number, lambda x: _filled(x, _let(_digits(x), change))))


def _ssn(value: Column, key: str) -> Column:
    """Area 001-665 or 667-899, group 01-99, serial 0001-9999, each as one number."""
    area, group, serial = (F.substring(value, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (group > 0) & (serial > 0)
    number = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)

    def said(x: Column) -> Column:
        new = F.when(x[0] >= 665, x[0] + 2).otherwise(x[0] + 1)
        return F.format_string("%03d-%02d-%04d", new, x[1] + 1, x[2] + 1)

    return F.when(valid, _let(feistel(number, _numbers(898, 99, 9999), key, "ssn"), said)).otherwise(value)


def _ip(value: Column, key: str) -> Column:
    """Four numbers from 0 to 255, the first from 1."""
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    valid = F.forall(octets, lambda x: x <= 255) & (octets[0] > 0) & ~value.rlike(r"(?:^|\.)0[0-9]")
    moved = _permuted(octets, _numbers(1, 0, 0, 0), _numbers(255, 256, 256, 256), key, "ip")
    return F.when(valid, F.array_join(moved.cast("array<string>"), ".")).otherwise(value)


def _day(date: Column, key: str) -> Column:
    """Another day of the same cycle of 400 years."""
    since = F.datediff(date, F.lit(CYCLE).cast("date"))
    day = F.pmod(since, F.lit(DAYS))
    moved = feistel(F.array((day / DAYS_B).cast("int"), F.pmod(day, F.lit(DAYS_B)).cast("int")), _numbers(DAYS_A, DAYS_B), key, "date")
    return F.date_add(F.lit(CYCLE).cast("date"), _let(moved, lambda x: x[0] * DAYS_B + x[1]) + since - day)


def _date(value: Column, year: Column, month: Column, day: Column, say: Callable[[Column], Column], key: str) -> Column:
    date = F.try_to_timestamp(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")
    # Years over 1399 keep four digits in every cycle; years of the older calendar stay.
    valid = date.isNotNull() & (year >= "1600") & (year < "9800")
    return F.when(valid, _let(_day(date, key), say)).otherwise(value)


def _iso(value: Column, key: str) -> Column:
    return _date(value, F.substring(value, 1, 4), F.substring(value, 6, 2), F.substring(value, 9, 2), lambda d: F.date_format(d, "yyyy-MM-dd"), key)


def _wide(value: Column, wide: str, narrow: str) -> Callable[[Column], Column]:
    return lambda d: F.when(F.char_length(value) == 10, F.date_format(d, wide)).otherwise(F.date_format(d, narrow))


def _dotted(value: Column, key: str) -> Column:
    return _let(F.split(value, r"\."), lambda p: _date(value, p[2], p[1], p[0], _wide(value, "dd.MM.yyyy", "d.M.yyyy"), key))


def _slashed(value: Column, key: str) -> Column:
    def change(p: Column) -> Column:
        first = _date(value, p[0], p[1], p[2], lambda d: F.date_format(d, "yyyy/MM/dd"), key)
        day = _date(value, p[2], p[1], p[0], _wide(value, "dd/MM/yyyy", "d/M/yyyy"), key)
        month = _date(value, p[2], p[0], p[1], _wide(value, "MM/dd/yyyy", "M/d/yyyy"), key)
        return F.when(F.char_length(p[0]) == 4, first).when(p[0].cast("int") > 12, day).otherwise(month)

    return _let(F.split(value, "/"), change)


def _named(value: Column, key: str) -> Column:
    """The day's and the year's digits and the month's name, in the name's language and case."""
    name = F.regexp_extract(value, f"({NAME})", 1)
    place = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(name)).cast("int")
    lone = r"(?<![0-9])([0-9]{1,2})(?![0-9])"
    old = F.regexp_extract(value, lone, 1)

    def say(d: Column) -> Column:
        new = F.element_at(F.array(*map(F.lit, MONTHS)), (F.floor((place - 1) / 12) * 12 + F.month(d)).cast("int"))
        new = F.when(name == F.upper(name), F.upper(new)).when(F.substring(name, 1, 1) == F.upper(F.substring(name, 1, 1)), F.initcap(new)).otherwise(new)
        day = F.when(old.startswith("0"), F.date_format(d, "dd")).otherwise(F.date_format(d, "d"))
        out = F.regexp_replace(value, F.lit(lone), day)
        out = F.regexp_replace(out, F.lit("[0-9]{4}$"), F.date_format(d, "yyyy"))
        return F.regexp_replace(out, F.lit(NAME), new)

    return _date(value, F.substring(value, -4, 4), (F.pmod(place - 1, F.lit(12)) + 1).cast("string"), old, say, key)


def _spread(value: Column, pattern: str, least: Callable, radix: Callable, code: Callable, char: Callable, key: str, kind: str) -> Column:
    """``value`` with its characters of ``pattern`` permuted, each within its radix from its least code."""

    def change(codes: Column) -> Column:
        moved = _permuted(codes, F.transform(codes, least), F.transform(codes, radix), key, kind)
        fields = F.split(value, pattern)
        new = F.transform(moved, char)
        return F.array_join(F.zip_with(fields, new, lambda f, c: F.concat(f, F.coalesce(c, F.lit("")))), "")

    kept = F.filter(_characters(value), lambda c: c.rlike(f"^{pattern}$"))
    return _let(F.transform(kept, code), change)


def _ipv6(value: Column, key: str) -> Column:
    """Hexadecimal digits: 0 stays, the others move among themselves; letters in the case of the first."""
    groups = F.size(F.filter(F.split(value, ":"), lambda g: g != ""))
    valid = (groups == 8) | value.contains("::") & (groups < 8)
    moved = _spread(
        F.lower(value), "[0-9a-f]", lambda c: F.when(c > 0, 1).otherwise(0), lambda c: F.when(c > 0, 15).otherwise(1),
        lambda c: F.conv(c, 16, 10).cast("int"), lambda c: F.lower(F.hex(c.cast("bigint"))), key, "ipv6",
    )
    return F.when(~valid, value).when(value.rlike("[A-F]"), F.upper(moved)).otherwise(moved)


def _mod97(value: Column) -> Column:
    """The remainder by 97 of a text of digits and capitals, A as 10 to Z as 35."""

    def add(a: Column, c: Column) -> Column:
        n = F.conv(c, 36, 10).cast("int")
        return F.pmod(a * F.when(n > 9, 100).otherwise(10) + n, F.lit(97))

    return F.aggregate(_characters(value), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    def change(plain: Column) -> Column:
        country = F.substring(plain, 1, 2)
        body = _spread(
            F.substring(plain, 5, 60), "[0-9A-Z]", lambda c: F.when(c >= 65, 65).otherwise(48), lambda c: F.when(c >= 65, 26).otherwise(10),
            F.ascii, _char, key, "iban",
        )

        def said(b: Column) -> Column:
            whole = F.concat(country, F.format_string("%02d", 98 - _mod97(F.concat(b, country, F.lit("00")))), b)
            spaces = F.split(value, "[0-9A-Z]")
            return F.array_join(F.zip_with(spaces, _characters(whole), lambda f, c: F.concat(f, F.coalesce(c, F.lit("")))), "")

        valid = F.char_length(plain).between(15, 34) & (_mod97(F.concat(F.substring(plain, 5, 60), F.substring(plain, 1, 4))) == 1)
        return F.when(valid, _let(body, said)).otherwise(value)

    return _let(F.replace(value, F.lit(" "), F.lit("")), change)


def _world_phone(value: Column, key: str) -> Column:
    """8 to 15 digits; the country's code stays (three digits where a separator follows them, else two), leading zeros too."""
    country = F.regexp_extract(value, r"^(\+[0-9]{3}(?=[ .(-])|\+[0-9]{2})", 1)
    rest = F.substr(value, F.char_length(country) + 1)

    def change(d: Column) -> Column:
        first = d[0]
        n = F.size(d)
        least = F.concat(F.array(F.when(first > 0, 1).otherwise(0)), F.array_repeat(F.lit(0), n - 1))
        radices = F.concat(F.array(F.when(first > 0, 9).otherwise(1)), F.array_repeat(F.lit(10), n - 1))
        return _permuted(d, least, radices, key, "phone")

    valid = F.char_length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
    return F.when(valid, F.concat(country, _let(rest, lambda x: _filled(x, _let(_digits(x), change))))).otherwise(value)


def _email(value: Column, key: str) -> Column:
    """Letters stay letters of their range, digits digits, other characters and the domain as they are."""

    def of(c: Column, at: int) -> Column:
        out = None
        for x in LETTERS:
            test = c.between(x[0], x[0] + x[1] - 1)
            out = F.when(test, x[at]) if out is None else out.when(test, x[at])
        return out

    local = F.substring_index(value, "@", 1)
    new = _spread(local, LETTER, lambda c: of(c, 0), lambda c: of(c, 1), F.ascii, _char, key, "email")
    return F.concat(new, F.lit("@"), F.substring_index(value, "@", -1))


def _char(code: Column) -> Column:
    """The character of a code below 2^16."""
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 4, "0")), "UTF-16BE")


CHANGES = {
    "email": _email, "iban": _iban, "ipv6": _ipv6, "ip": _ip, "iso_date": _iso, "dot_date": _dotted, "slash_date": _slashed, "named_date": _named,
    "phone": _phone, "world_phone": _world_phone, "ssn": _ssn, "card": _card,
}


def kind_of(value: Column) -> Column:
    """The kind of a match of ``CANDIDATE``."""
    out = None
    for kind, pattern in KINDS.items():
        test = value.rlike(f"^(?:{pattern})$")
        out = F.when(test, F.lit(kind)) if out is None else out.when(test, F.lit(kind))
    return out


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a match; a match that doesn't validate stays."""
    out = None
    for name, change in CHANGES.items():
        out = F.when(kind == name, change(value, key)) if out is None else out.when(kind == name, change(value, key))
    return out.otherwise(value)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", found: str | None = None) -> DataFrame:
    """``docs`` with the text's values replaced; ``found``: a column for the changed values' kinds and pseudonyms.

    The text is cut at its matches, and the pieces between them are joined
    with the pseudonyms.
    """
    old, gate = F.col(f"`{text}`"), r"[0-9@]"
    matches = F.when(old.rlike(gate), F.regexp_extract_all(old, F.lit(CANDIDATE), F.lit(0))).otherwise(F.array().cast("array<string>"))
    work = docs.withColumn("_m", F.coalesce(matches, F.array().cast("array<string>")))
    made = F.transform("_m", lambda m: _let(kind_of(m), lambda k: F.struct(k.alias("kind"), m.alias("value"), pseudonym(m, k, key).alias("pseudonym"))))
    work = work.withColumn("_p", made)
    new = F.array_join(F.zip_with(F.split(old, CANDIDATE), F.col("_p"), lambda a, b: F.concat(a, F.coalesce(b["pseudonym"], F.lit("")))), "")
    work = work.withColumn(text, F.when(F.size("_m") > 0, new).otherwise(old))
    if found:
        work = work.withColumn(found, F.filter("_p", lambda p: p["value"] != p["pseudonym"]))
    return work.drop("_m", "_p")
