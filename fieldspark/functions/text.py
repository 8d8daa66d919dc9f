"""Cleaning of provider text as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mean "missing", whatever their case.
MISSING = ("nan", "na", "n/a", "none", "null")
TRUE_TOKENS = ("1", "1.0", "true", "yes")
OPEN_LICENSES = ("cc0", "by")


def is_missing(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "") | F.lower(F.trim(c)).isin(*MISSING)


def first_present(*columns: Column) -> Column:
    """The first value that is not missing, untrimmed."""
    return F.coalesce(*[F.when(~is_missing(c), c) for c in columns])


def source_text(c: Column) -> Column:
    """Trimmed text, or null where it is missing."""
    return F.when(~is_missing(c), F.trim(c))


def present(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c.cast("string")) != "") & (F.lower(c.cast("string")) != "nan")


def record_id(source: Column, native: Column, payload: Column) -> Column:
    """``SOURCE:native``, or a digest of the canonical payload where there is no native id."""
    native = source_text(native)
    digest = F.concat(F.lit("sha256:"), F.substring(F.sha2(payload, 256), 1, 24))
    return F.concat(F.upper(source), F.lit(":"), F.coalesce(native, digest))


def indicator_tokens(indicators: dict[str, Column], separator: str = "; ") -> Column:
    """Names of the indicators that are set, in order and each once; null if none is."""
    names = F.array_compact(F.array(*[F.when(F.lower(F.trim(c.cast("string"))).isin(*TRUE_TOKENS), F.lit(n)) for n, c in indicators.items()]))
    return F.when(F.size(names) > 0, F.array_join(F.array_distinct(names), separator))


def join_present(separator: str, *columns: Column) -> Column:
    """Distinct present texts in order; null if there is none."""
    texts = F.array_distinct(F.array_compact(F.array(*[source_text(c) for c in columns])))
    return F.when(F.size(texts) > 0, F.array_join(texts, separator))


def has_clock(c: Column) -> Column:
    """Whether a text has a time of day after a T or white space."""
    return F.coalesce(c.rlike(r"[T\s]\d{1,2}:\d{2}"), F.lit(False))


def html_lines(c: Column) -> Column:
    """Lines of a fragment: breaks and paragraphs end lines, tags go, common entities are decoded, blanks are dropped."""
    broken = F.regexp_replace(c, r"(?i)<br\s*/?>|</p>", "\n")
    plain = F.regexp_replace(broken, r"<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.filter(F.transform(F.split(plain, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def labelled_notes(lines: Column, aliases: dict[str, str]) -> Column:
    """Map of canonical field to the text after its label, for lines ``label: value``; the last of a field wins."""
    names = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    pairs = F.transform(
        F.filter(lines, lambda x: x.contains(":")),
        lambda x: F.struct(names[F.lower(F.trim(F.substring_index(x, ":", 1)))].alias("key"), F.trim(F.substr(x, F.instr(x, ":") + 1)).alias("value")),
    )
    found = []
    for field in dict.fromkeys(aliases.values()):
        last = F.try_element_at(F.filter(pairs, _keyed(field)), F.lit(-1))
        found += [F.lit(field), last["value"]]
    return F.map_filter(F.create_map(*found), lambda _, v: v.isNotNull())


def _keyed(field: str) -> Callable[[Column], Column]:
    return lambda p: p["key"] == field


def date_text(c: Column) -> Column:
    """Archive date text with its usual slips repaired: ``Sept``, doubled commas and spaces."""
    fixed = F.regexp_replace(F.trim(c), r"(?i)\bSept\b\.?", "Sep")
    fixed = F.regexp_replace(fixed, r",\s*,", ",")
    return F.regexp_replace(fixed, r"\s+", " ")


def coordinate_component(c: Column, axis: str) -> Column:
    """Degrees of a text like ``48 30.5 N``, ``48.508`` or ``-123.1``; longitudes without a sign are west.

    Degrees and minutes where two numbers stand, a hemisphere letter sets the sign; out of range is null.
    """
    numbers = F.regexp_extract_all(c, F.lit(r"(\d+(?:\.\d+)?)"), 1)
    degrees, minutes = F.get(numbers, F.lit(0)).try_cast("double"), F.get(numbers, F.lit(1)).try_cast("double")
    size = degrees + F.coalesce(minutes / 60, F.lit(0.0))
    south = F.upper(c).rlike(r"[SW]") | F.trim(c).startswith("-")
    north = F.upper(c).rlike(r"[NE]")
    sign = F.when(south, -1.0).when(north, 1.0).otherwise(-1.0 if axis == "lon" else 1.0)
    value = F.when((F.coalesce(minutes, F.lit(0.0)) < 60) & (F.size(numbers).between(1, 2)), size * sign)
    return F.when(F.abs(value) <= (180 if axis == "lon" else 90), value)


def header_name(name: str, aliases: dict[str, str] | None = None) -> str:
    """Header text in canonical form: trimmed, lower-case, underscores and runs of white space as one space."""
    plain = " ".join(name.strip().lower().replace("_", " ").split())
    return (aliases or {}).get(plain, plain)


def strict_int(c: Column, minimum: int | None = None, maximum: int | None = None) -> Column:
    """Whole numbers within the bounds; null for anything else, so that the caller can report it."""
    value = F.trim(c.cast("string")).try_cast("double")
    whole = F.when(value == F.floor(value), value.cast("long"))
    if minimum is not None:
        whole = F.when(whole >= minimum, whole)
    if maximum is not None:
        whole = F.when(whole <= maximum, whole)
    return whole


def comparison_identifier(c: Column) -> Column:
    """Identifier without punctuation, and without zeros that pad its number: ``J-007a`` becomes ``J7A``."""
    plain = F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")
    return F.regexp_replace(plain, r"^([TJKL])0*([0-9]+)", "$1$2")


def use_class(licenses: Column) -> Column:
    """REDISTRIBUTABLE if there are licences and each is CC0 or BY without NC or ND, else INTERNAL_ONLY."""

    def free(x: Column) -> Column:
        words = F.split(F.lower(x), r"[^a-z0-9]+")
        return F.arrays_overlap(words, F.array(*map(F.lit, OPEN_LICENSES))) & ~F.arrays_overlap(words, F.array(F.lit("nc"), F.lit("nd")))

    return F.when((F.size(licenses) > 0) & F.forall(licenses, lambda x: F.coalesce(free(x), F.lit(False))), F.lit("REDISTRIBUTABLE")).otherwise(F.lit("INTERNAL_ONLY"))


# Fixed value: words that negate the mention after them.
NEGATION = r"\b(not|no|unlikely|isn'?t|wasn'?t)\s+(an?\s+)?"


def negated_before(c: Column, pattern: str) -> Column:
    """Text in which mentions of the pattern that follow a negation are blanked, so that the rest can be matched."""
    return F.regexp_replace(c, f"(?i){NEGATION}{pattern}", " ")


def quarantine(flags: Column, severe: list[str]) -> Column:
    """Struct ``status, reasons``: quarantined if a severe flag is set."""
    reasons = F.array_sort(F.array_intersect(flags, F.array(*map(F.lit, severe))))
    return F.struct(F.when(F.size(reasons) > 0, F.lit("QUARANTINED")).otherwise(F.lit("ACCEPTED")).alias("status"), reasons.alias("reasons"))


def paragraph_fields(html: Column, aliases: dict[str, str]) -> Column:
    """Map of canonical field to value from the paragraphs ``label: value`` of a page; the first of a field wins.

    Labels are compared without case and without anything but letters and digits, and have at most 50 characters.
    """
    plain = lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, r"(?s)<[^>]*>", " "), r"\s+", " "))
    lines = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1)), plain)
    names = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    label = lambda x: F.regexp_replace(F.lower(F.substring_index(x, ":", 1)), "[^a-z0-9]", "")
    usable = F.filter(lines, lambda x: x.rlike(r"^[^:]{1,50}:"))
    pairs = F.filter(F.transform(usable, lambda x: F.struct(names[label(x)].alias("key"), F.trim(F.substr(x, F.instr(x, ":") + 1)).alias("value"))), lambda p: p["key"].isNotNull())
    found = []
    for field in dict.fromkeys(aliases.values()):
        found += [F.lit(field), F.get(F.filter(pairs, _keyed(field)), F.lit(0))["value"]]
    return F.map_filter(F.create_map(*found), lambda _, v: v.isNotNull())


def canonical_json(**fields: Column) -> Column:
    """JSON object with its keys in order and no spaces; nulls are left out."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def tag_names(tags: Column) -> Column:
    """Names of a JSON list of tags, which are texts or objects with a name; others are left out."""
    names = F.transform(F.from_json(tags, "array<string>"), lambda t: F.when(t.startswith("{"), F.get_json_object(t, "$.name")).otherwise(t))
    return F.filter(names, lambda t: t.isNotNull() & (t != ""))


def precise_timestamp(c: Column) -> Column:
    """The text if it is one ISO instant with a time of day: intervals, dates alone and other texts are null."""
    text = source_text(c)
    clock = text.contains("T") | F.substr(text, F.lit(11), F.length(text)).rlike(r"\d")
    return F.when(~text.contains("/") & clock & text.try_cast("timestamp").isNotNull(), text)


def map_marker_date(c: Column, year: int) -> Column:
    """Struct ``date, flags`` of a marker's date text, with doubled commas mended and a missing or cut year taken from the
    map's; flags say what was done."""
    text = F.regexp_replace(F.trim(c), r"(?i)\bSept\b", "Sep")
    odd = text.contains(",,") | text.rlike(r",\d{4}$")
    text = F.regexp_replace(F.regexp_replace(text, ",,", ","), r",(\d{4})$", ", $1")
    text = F.regexp_replace(text, r"^([A-Za-z]{3})\.", "$1")
    cut = text.rlike(r",\s*\d{3}$")
    bare = ~cut & ~text.rlike(r"(,\s*(\d{2}|\d{4})|\s+\d{4})$")
    text = F.when(cut, F.regexp_replace(text, r",\s*\d{3}$", f", {year}")).when(bare, F.concat(text, F.lit(f", {year}"))).otherwise(text)
    date = F.coalesce(*[F.try_to_date(text, f) for f in ("MMM d, yyyy", "MMMM d, yyyy")])
    names = {"ATLIST_DATE_TEXT_NORMALIZED": odd, "ATLIST_DATE_YEAR_REPAIRED": cut, "ATLIST_DATE_YEAR_INFERRED": bare, "ATLIST_MAP_YEAR_DATE_MISMATCH": F.year(date) != year, "UNPARSED_ATLIST_DATE": date.isNull()}
    missing = c.isNull() | (F.trim(c) == "")
    flags = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in names.items()]))
    return F.struct(F.when(~missing, date).alias("date"), F.when(missing, F.array(F.lit("MISSING_ATLIST_DATE"))).otherwise(flags).alias("flags"))
