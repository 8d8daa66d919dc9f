"""Format-preserving pseudonyms for personal data (operator 6, DataFrame functions only).

Candidates are found by one pattern, with the numbers that touch them; a part that is no valid value as a whole is looked
through again at each place where one may start, for shorter candidates of every kind. They are validated: card numbers
by Luhn's sum, IBANs by their remainder, addresses by their octets, dates by the calendar, US phone and social security
numbers by their reserved ranges. What is valid is permuted by a keyed Feistel network over its own domain, so that equal values get equal pseudonyms in every document,
different values different ones, and each pseudonym is valid in the same format with the same separators. A date that is
read day first because its day is past the 12th gets another such day (the network is walked until it meets one, in at
most WALK steps; the chance to miss is below 10^-25), so that pseudonyms are read as their originals are.

A network alternates ``left = (left + f(right)) mod a`` and ``right = (right + f(left)) mod b``, a permutation of the
a x b values whatever a and b are; f is SHA-256 under the key. Dates use the 146,097 = 189 x 773 days of one Gregorian
cycle, 1800-01-01 to 2199-12-31.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import table

ROUNDS = 10
KINDS = ("email", "iban", "date", "ip", "ssn", "card", "phone")
#: Candidates; Java's syntax. Digits next to a candidate would make it a part of another number.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
#: Lengths of the countries' IBANs; other countries' are tried at any length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL|SD|FK", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK|MN", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|TL|OM|SO", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "PT|ST|LY",
    26: "IS|TR", 27: "FR|GR|IT|MC|MR|SM|BI|DJ", 28: "AL|AZ|CY|DO|GT|HU|LB|PL|BY|SV|NI", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_IBAN_OF = "|".join(f"(?:{c})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])" for n, c in IBAN_LENGTHS.items())
_IBAN_START = "[A-Z]{2}[0-9]{2}"
ISO = r"(?<![0-9])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
DAY = r"(?<![0-9/.])[0-9]{1,2}(?<mark>[/.])[0-9]{1,2}\k<mark>[0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
PHONE = r"(?<![0-9A-Za-z])\+?[0-9]{0,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
#: A group of an international number is not the start of a value that is written in full.
_WHOLE = r"[ .-]?(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])"


def _abroad(groups: str) -> str:
    return rf"(?<![0-9A-Za-z])\+[0-9]{{1,3}}(?:(?!{_WHOLE})[ .-]?[0-9]{{2,4}}){{{groups}}}(?![0-9])"


#: Digits that belong to an email are left to it.
_NO_EMAIL = r"(?![A-Za-z0-9._%+-]{0,64}@)"
#: Numbers go on to the last that touches by separators: which of them are values is found by a look inside.
TAIL = rf"(?:[ ()./+-][0-9 ()./+-]*(?<=[0-9])(?![0-9]|[._%+-]{{0,64}}[A-Za-z@]))?"
PATTERN = (
    rf"{EMAIL}|(?:(?<![A-Za-z0-9])(?:{_IBAN_OF}|{_IBAN_START}(?:(?! {_IBAN_START} ?[A-Z0-9]{{4}}) ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9])){_NO_EMAIL}"
    rf"|(?:{'|'.join([ISO, IP, DAY, SSN, CARD, PHONE, _abroad('2,5')])}){_NO_EMAIL}){TAIL}"
)
#: What is tried in turn at each place of a rejected part, after the character before it.
_CARDS = [
    "[0-9]{13,19}(?![0-9])",
    *(rf"[0-9]{{4}}(?<mark>[ -])[0-9]{{4}}\k<mark>[0-9]{{4}}\k<mark>{last}(?![0-9])" for last in (r"[0-9]{4}\k<mark>[0-9]{1,3}", "[0-9]{1,4}")),
    r"[0-9]{4}(?<mark>[ -])[0-9]{6}\k<mark>[0-9]{4,5}(?![0-9])",
    "[0-9]{6}[ -][0-9]{7,13}(?![0-9])",
]
_IBANS = [f"(?:{_IBAN_OF})", *(f"{_IBAN_START}(?: ?[A-Z0-9]{{4}}){{{n}}}{last}(?![A-Za-z0-9])" for n in range(7, 1, -1) for last in (" ?[A-Z0-9]{1,3}", ""))]
INSIDE = [ISO, IP, DAY, SSN, *_CARDS, PHONE, *(_abroad(str(n)) for n in range(5, 1, -1)), CARD]
#: Characters of a place's window: the longest candidate is shorter.
WINDOW = 64
#: Marks around candidates; a mark that is in the text already is written with an E and restored.
MARK = "\x01"
ESCAPED, AROUND = f"{MARK}E", f"{MARK}M"
EPOCH, DAYS = "1800-01-01", 189 * 773
WALK = 64
#: The session's setting for the key of the query, and the one of demonstrations where it is unset.
KEY_SETTING, DEMONSTRATION_KEY = "spark.fieldspark.pseudonymKey", "op6"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _f(key: str, kind: str, step: Column, value: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 14), 16, 10).cast("long")


def feistel(value: Column, a: Column | int, b: Column | int, key: str, kind: str) -> Column:
    """Permutes a number below a x b (each at most 10^10); ``kind`` separates the domains."""
    a, b = (x.cast("long") if isinstance(x, Column) else F.lit(x).cast("long") for x in (a, b))
    start = F.struct(((value - value % b) / b).cast("long").alias("l"), (value % b).cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, (s["l"] + _f(key, kind, i, s["r"]) % a) % a).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise((s["r"] + _f(key, kind, i, s["l"]) % b) % b).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] * b + s["r"])


def _ten(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """Permutes the digit strings of each length from 1 to 18."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    return F.lpad(feistel(digits.try_cast("long"), _ten(half), _ten(n - half), key, kind).cast("string"), n, "0")


def permute_text(text: Column, key: str, kind: str) -> Column:
    """Permutes the strings of a-z and 0-9 of each length: halves of characters are shifted by each other's hash."""
    alphabet = F.lit("abcdefghijklmnopqrstuvwxyz0123456789")
    half = F.floor(F.length(text) / 2).cast("int")

    def shifted(part: Column, other: Column, i: Column) -> Column:
        hashed = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), F.lit(str(k)), other), 256) for k in range(2)])
        places = F.sequence(F.lit(1), F.greatest(F.length(part), F.lit(1)))
        moved = F.transform(
            places,
            lambda p: F.substr(
                alphabet, F.pmod(F.instr(alphabet, F.substr(part, p, F.lit(1))) - 1 + F.conv(F.substr(hashed, p * 3 - 2, F.lit(3)), 16, 10).cast("int"), F.lit(36)) + 1, F.lit(1)
            ),
        )
        return F.when(F.length(part) == 0, part).otherwise(F.array_join(moved, ""))

    start = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text)).alias("r"))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, shifted(s["l"], s["r"], i)).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(shifted(s["r"], s["l"], i)).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _refill(format_: Column, symbols: Column, kept: str) -> Column:
    """Writes ``symbols`` in turn over those characters of the format that the class ``kept`` holds."""
    places = F.sequence(F.lit(1), F.length(format_))

    def at(p: Column) -> Column:
        c = F.substr(format_, p, F.lit(1))
        turn = F.length(F.regexp_replace(F.substr(format_, F.lit(1), p), f"[^{kept}]", ""))
        return F.when(c.rlike(f"[{kept}]"), F.substr(symbols, turn, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(places, at), "")


def _luhn(digits: Column) -> Column:
    """Luhn's sum of a digit string."""
    n = F.length(digits)

    def add(total: Column, p: Column) -> Column:
        d = F.substr(digits, p, F.lit(1)).cast("int")
        twice = F.when((n - p) % 2 == 1, d * 2).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add)


def _mod97(iban: Column) -> Column:
    """Remainder of an IBAN without spaces: country and check digits go to the end, letters count from 10."""
    moved = F.concat(F.substr(iban, F.lit(5), F.length(iban)), F.substr(iban, F.lit(1), F.lit(4)))

    def add(r: Column, p: Column) -> Column:
        v = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substr(moved, p, F.lit(1))) - 1
        return (r * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def _day(m: Column) -> Column:
    """The date that a candidate writes: year first, day.month.year, or month/day/year (day first where that fails)."""
    parts = F.split(m, "[-/.]")
    one, two, three = (F.get(parts, F.lit(i)) for i in range(3))
    date = lambda y, mo, d: F.try_to_date(F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    found = F.when(F.length(one) == 4, date(one, two, three)).when(m.contains("."), date(three, two, one)).otherwise(F.coalesce(date(three, one, two), date(three, two, one)))
    return F.when(found.between(F.lit(EPOCH).cast("date"), F.date_add(F.lit(EPOCH).cast("date"), DAYS - 1)), found)


def _order(m: Column) -> Column:
    """How a date candidate is written: y, d (day first) or m (month first)."""
    parts = F.split(m, "[-/.]")
    month_first = F.get(parts, F.lit(0)).try_cast("int") <= 12
    return F.when(F.length(F.get(parts, F.lit(0))) == 4, F.lit("y")).when(m.contains(".") | ~month_first, F.lit("d")).otherwise(F.lit("m"))


def kind_of(m: Column) -> Column:
    """The validated kind of a candidate, or the empty text."""
    d = _digits(m)
    n = F.length(d)
    part = lambda a, k: F.substr(d, F.lit(a), F.lit(k)).try_cast("int")
    octets = F.split(m, r"\.")
    ten = F.when(n == 11, F.substr(d, F.lit(2), F.lit(10))).otherwise(d)
    american = (n.isin(10, 11)) & ((n == 10) | d.startswith("1")) & F.substr(ten, F.lit(1), F.lit(1)).between("2", "9") & F.substr(ten, F.lit(4), F.lit(1)).between("2", "9")
    return (
        F.when(m.contains("@"), F.lit("email"))
        .when(m.rlike("^[A-Z]{2}[0-9]{2}"), F.when(_mod97(F.regexp_replace(m, " ", "")) == 1, F.lit("iban")).otherwise(F.lit("")))
        .when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), F.when(F.forall(octets, lambda x: x.cast("int") <= 255), F.lit("ip")).otherwise(F.lit("")))
        .when(m.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{4})$"), F.when(_day(m).isNotNull(), F.lit("date")).otherwise(F.lit("")))
        .when(
            m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
            F.when(part(1, 3).between(1, 899) & (part(1, 3) != 666) & (part(4, 2) > 0) & (part(6, 4) > 0), F.lit("ssn")).otherwise(F.lit("")),
        )
        .when(n.between(13, 19) & ~m.startswith("+") & ~m.contains("("), F.when(_luhn(d) % 10 == 0, F.lit("card")).otherwise(F.lit("")))
        .when(american | (m.startswith("+") & n.between(8, 15)), F.lit("phone"))
        .otherwise(F.lit(""))
    )


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a candidate of a validated kind."""
    d = _digits(m)
    n = F.length(d)

    local = F.substring_index(m, "@", 1)
    plain = F.regexp_replace(F.lower(local), "[^a-z0-9]", "")
    domain = F.substr(m, F.length(local) + 1, F.length(m))
    email = F.concat(_refill(F.lower(local), permute_text(plain, key, "email"), "a-z0-9"), domain)

    tight = F.regexp_replace(m, " ", "")
    bban = F.substr(tight, F.lit(5), F.length(tight))
    numbers = _digits(bban)
    moved = _refill(bban, _long_digits(numbers, key, "iban"), "0-9")
    check = F.lpad((98 - _mod97(F.concat(F.substr(tight, F.lit(1), F.lit(2)), F.lit("00"), moved))).cast("string"), 2, "0")
    iban = _refill(m, F.concat(F.substr(tight, F.lit(1), F.lit(2)), check, moved), "A-Z0-9")

    from_epoch = lambda x: F.date_add(F.lit(EPOCH).cast("date"), x.cast("int"))
    number = F.date_diff(_day(m), F.lit(EPOCH).cast("date")).cast("long")
    moved = lambda x: feistel(x, 189, 773, key, "date")
    late = lambda x: F.dayofmonth(from_epoch(x)) > 12
    step = lambda s, _: F.when(s["done"], s).otherwise(F.get(F.transform(F.array(moved(s["x"])), lambda x: F.struct(x.alias("x"), late(x).alias("done"))), F.lit(0)))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.struct(number.alias("x"), F.lit(False).alias("done")), step, lambda s: s["x"])
    day = from_epoch(F.when(m.contains("/") & (_order(m) == "d"), walked).otherwise(moved(number)))
    written = F.split(m, "[-/.]")
    padded = lambda format_, i: F.when(F.length(F.get(written, F.lit(i))) == 2, F.date_format(day, format_ * 2)).otherwise(F.date_format(day, format_))
    mark = F.when(m.contains("/"), F.lit("/")).otherwise(F.lit("."))
    date = (
        F.when(_order(m) == "y", F.date_format(day, "yyyy-MM-dd"))
        .when(_order(m) == "d", F.concat(padded("d", 0), mark, padded("M", 1), mark, F.date_format(day, "yyyy")))
        .otherwise(F.concat(padded("M", 0), mark, padded("d", 1), mark, F.date_format(day, "yyyy")))
    )

    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
    address = feistel(number, 65536, 65536, key, "ip")
    ip = F.array_join(F.transform(F.array(F.lit(24), F.lit(16), F.lit(8), F.lit(0)), lambda s: F.pmod(F.floor(address / F.pow(F.lit(2.0), s)), F.lit(256)).cast("string")), ".")

    area, group, serial = (F.substr(d, F.lit(a), F.lit(k)).cast("long") for a, k in ((1, 3), (4, 2), (6, 4)))
    rank = F.when(area > 666, area - 2).otherwise(area - 1)  # 898 areas: 001 to 899 but 666
    social = feistel(rank * (99 * 9999) + (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn")
    new_rank = F.floor(social / (99 * 9999)).cast("long")
    rest = social % (99 * 9999)
    pad = lambda c, k: F.lpad(c.cast("long").cast("string"), k, "0")
    ssn = F.concat_ws("-", pad(F.when(new_rank >= 665, new_rank + 2).otherwise(new_rank + 1), 3), pad(F.floor(rest / 9999) + 1, 2), pad(rest % 9999 + 1, 4))

    # The issuer's first digit stays, the digits to the last are permuted, the last is the check digit.
    payload = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute_digits(F.substr(d, F.lit(2), n - 2), key, "card"))
    card = _refill(m, F.concat(payload, F.pmod(10 - _luhn(F.concat(payload, F.lit("0"))), F.lit(10)).cast("string")), "0-9")

    country = F.when(n == 11, F.substr(d, F.lit(1), F.lit(1))).otherwise(F.lit(""))
    ten = F.when(n == 11, F.substr(d, F.lit(2), F.lit(10))).otherwise(d)
    place, exchange, line = (F.substr(ten, F.lit(a), F.lit(k)).try_cast("long") for a, k in ((1, 3), (4, 3), (7, 4)))
    dialled = feistel((place - 200) * 8_000_000 + (exchange - 200) * 10_000 + line, 800, 8_000_000, key, "phone")
    american = F.concat(country, pad(F.floor(dialled / 8_000_000) + 200, 3), pad(F.floor(dialled % 8_000_000 / 10_000) + 200, 3), pad(dialled % 10_000, 4))
    is_american = n.isin(10, 11) & ((n == 10) | d.startswith("1")) & place.between(200, 999) & exchange.between(200, 999)
    # The digit that tells other numbers of ten or eleven digits from American ones stays, as do the first two.
    split = F.when(n.isin(10, 11), n - 6).otherwise(F.lit(3))
    kept, head = F.when(n.isin(10, 11), F.substr(d, split, F.lit(1))).otherwise(F.lit("")), F.substr(d, F.lit(3), split - 3)
    others = permute_digits(F.concat(head, F.substr(d, split + F.length(kept), n)), key, "phone+")
    abroad = F.concat(F.substr(d, F.lit(1), F.lit(2)), F.substr(others, F.lit(1), F.length(head)), kept, F.substr(others, F.length(head) + 1, n))
    phone = _refill(m, F.when(is_american, american).otherwise(abroad), "0-9")

    return (
        F.when(kind == "email", email)
        .when(kind == "iban", iban)
        .when(kind == "date", date)
        .when(kind == "ip", ip)
        .when(kind == "ssn", ssn)
        .when(kind == "card", card)
        .when(kind == "phone", phone)
        .otherwise(m)
    )


def _long_digits(digits: Column, key: str, kind: str) -> Column:
    """Permutes digit strings of up to 36 digits, as two strings in a row of which the second is keyed by the first."""
    first = permute_digits(F.substr(digits, F.lit(1), F.least(F.length(digits), F.lit(18))), key, kind)
    rest = F.substr(digits, F.lit(19), F.lit(18))
    return F.when(F.length(digits) == 0, digits).when(F.length(digits) <= 18, first).otherwise(F.concat(first, permute_digits(rest, key, f"{kind}2")))


def _value(kind: Column, value: Column) -> Column:
    return F.struct(kind.alias("kind"), value.alias("value"))


def _inside(x: Column, before: Column, after: Column) -> Column:
    """The values in a part that is not one value itself, and what lies between them, in order.

    A window is laid at every place where a value may start; the first candidate there that is valid counts, and the
    places that it covers do not.
    """
    whole = F.concat(F.when(before == "", F.lit(" ")).otherwise(F.right(before, F.lit(1))), x, F.left(after, F.lit(1)))
    starts = "(?:(?<=[^0-9])[0-9]|(?<=[^0-9A-Za-z])[A-Z(+])"
    windows = F.regexp_extract_all(whole, F.lit(rf"(?s)(?=(.{starts}.{{0,{WINDOW}}}))"), F.lit(1))
    # Characters up to the next start; the first piece ends where the first window's value starts.
    pieces = F.regexp_extract_all(whole, F.lit("(?:[0-9]++[A-Za-z]*+[(+]?+|[A-Za-z]++[(+]?+|[(+])[^0-9A-Za-z(+]*+|[^0-9A-Za-z(+]++"), F.lit(0))

    def best(w: Column) -> Column:
        at = lambda pattern: F.regexp_extract(w, f"(?s)^.({pattern})", 1)
        iban = w.rlike(f"(?s)^.{_IBAN_START}")
        tried = F.when(iban, F.array(*map(at, _IBANS))).when(w.rlike("(?s)^.[0-9(+]"), F.array(*map(at, INSIDE))).otherwise(F.array().cast("array<string>"))
        return F.get(F.filter(F.transform(tried, lambda c: _value(F.when(c == "", "").otherwise(kind_of(c)), c)), lambda v: v["kind"] != ""), F.lit(0))

    # A place of a value counts characters of ``x`` from 1.
    places = F.zip_with(F.transform(windows, best), F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda v, piece: F.struct(v.alias("v"), F.length(piece).alias("n")))
    chosen = "array<struct<at:int,kind:string,value:string>>"
    start = F.struct(F.length(F.get(pieces, F.lit(0))).alias("at"), F.lit(1).alias("free"), F.array().cast(chosen).alias("chosen"))

    def walk(s: Column, p: Column) -> Column:
        take = p["v"].isNotNull() & (s["at"] >= s["free"])
        found = F.struct(s["at"].alias("at"), p["v"]["kind"].alias("kind"), p["v"]["value"].alias("value"))
        return F.struct(
            (s["at"] + p["n"]).alias("at"),
            F.when(take, s["at"] + F.length(p["v"]["value"])).otherwise(s["free"]).alias("free"),
            F.when(take, F.concat(s["chosen"], F.array(found))).otherwise(s["chosen"]).alias("chosen"),
        )

    def spread(got: Column) -> Column:
        end = lambda i: F.when(i < 0, F.lit(1)).otherwise(F.get(got, i)["at"] + F.length(F.get(got, i)["value"]))
        clear = lambda i, to: _value(F.lit(""), F.substr(x, end(i), to - end(i)))
        pairs = F.flatten(F.transform(got, lambda v, i: F.array(clear(i - 1, v["at"]), _value(v["kind"], v["value"]))))
        return F.concat(pairs, F.array(clear(F.size(got) - 1, F.length(x) + 1)))

    return F.flatten(F.transform(F.array(F.aggregate(places, start, walk, lambda s: s["chosen"])), spread))


def _values(x: Column, before: Column, after: Column) -> Column:
    """A part as one value where it is one alone, or the values inside it."""
    one = F.regexp_extract(x, f"^(?:{PATTERN.removesuffix(TAIL)})", 0) == x
    mixed = x.rlike("^[0-9 -]*$") & x.contains(" ") & x.contains("-") & (F.length(_digits(x)) >= 13)
    kind = F.transform(F.array(F.when(one & ~mixed, kind_of(x)).otherwise(F.lit(""))), lambda k: F.when(k != "", F.array(_value(k, x))).otherwise(_inside(x, before, after)))
    return F.get(kind, F.lit(0))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """Adds to the columns of ``docs``: ``found`` (array of kind, value, pseudonym in the order of the text), with
    ``text`` replaced. A column of ``docs`` that is named ``found`` is replaced, all others stay.

    A text without candidates stays as it is; a null text stays null and has no findings; an empty table gives no rows.
    Repeated values and documents get equal pseudonyms. Rows are handled one by one: no shuffle, no limit of length.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    marked = F.regexp_replace(F.replace(F.col("text"), F.lit(MARK), F.lit(ESCAPED)), f"({PATTERN})", f"{AROUND}$1{AROUND}")
    parts, values, pairs = (f"__{k}_{uuid.uuid4().hex}" for k in ("parts", "values", "pairs"))
    # Every candidate has a digit or an @: other texts are not searched.
    out = docs.withColumn(parts, F.when(F.col("text").rlike("[0-9@]") & F.col("text").rlike(PATTERN), F.split(marked, AROUND)))
    near = lambda i: F.coalesce(F.get(parts, i), F.lit(""))
    part = lambda x, i: F.when(i % 2 == 1, _values(x, near(i - 1), near(i + 1))).otherwise(F.array(_value(F.lit(""), x)))
    out = out.withColumn(values, F.flatten(F.transform(parts, part)))
    changed = F.transform(values, lambda v: F.struct(v["kind"], v["value"], F.when(v["kind"] == "", v["value"]).otherwise(pseudonym(v["value"], v["kind"], key)).alias("pseudonym")))
    out = out.withColumn(pairs, changed)
    text = F.replace(F.array_join(F.transform(pairs, lambda p: p["pseudonym"]), ""), F.lit(ESCAPED), F.lit(MARK))
    found = F.coalesce(F.filter(pairs, lambda p: p["kind"] != ""), F.array().cast("array<struct<kind:string,value:string,pseudonym:string>>"))
    return out.withColumn("found", found).withColumn("text", F.when(F.col(pairs).isNull(), F.col("text")).otherwise(text)).drop(parts, values, pairs)


def _of(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(KEY_SETTING, DEMONSTRATION_KEY)
    done = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    counts = [F.size(F.filter("found", _of(k))).alias(f"n_{k}") for k in KINDS]
    return done.select("doc_id", *counts, F.transform("found", lambda x: x["pseudonym"]).alias("pseudonyms"), "text")
