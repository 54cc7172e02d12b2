"""Scalar functions over titles and descriptions, as Catalyst expressions.

All take and return columns and stay JVM-side. Word boundaries are made by
splitting at anything but letters, digits and underscores: regular-expression
``\\b`` differs between engines outside ASCII.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .. import vocabulary as V

YEAR = "1[5-9][0-9]{2}|20[012][0-9]"
YEAR_NARROW = "1[5-9][0-9]{2}"
APART = r"[^\p{L}\p{N}_]+"
CYRILLIC = "а-яёА-ЯЁ"


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def any_stem(c: Column, stems: Sequence[str]) -> Column:
    """Whether the lower-cased text contains one of the stems: one scan of the text."""
    return F.lower(text(c)).rlike("|".join(re.escape(s) for s in stems)) if stems else F.lit(False)


def classify(c: Column, positive: Sequence[str] = V.POSITIVE, doubtful: Sequence[str] = V.DOUBTFUL) -> Column:
    return F.when(any_stem(c, positive), "positive").when(any_stem(c, doubtful), "doubtful").otherwise("negative")


def year_list(c: Column, pattern: str = YEAR) -> Column:
    words = F.filter(F.split(text(c), APART), lambda w: w.rlike(f"^({pattern})$"))
    return F.transform(words, lambda w: w.cast("int"))


def years(c: Column, pattern: str = YEAR) -> tuple[Column, Column]:
    """Least and greatest year named; nulls if none."""
    found = year_list(c, pattern)
    return F.array_min(found), F.array_max(found)


def years_in_order(c: Column, pattern: str = YEAR) -> tuple[Column, Column]:
    """First and last year named."""
    found = year_list(c, pattern)
    return F.try_element_at(found, F.lit(1)), F.try_element_at(found, F.lit(-1))


def years_any4(c: Column) -> tuple[Column, Column]:
    """First and last run of four digits, wherever it begins."""
    found = F.transform(F.regexp_extract_all(text(c), F.lit("[0-9]{4}"), F.lit(0)), lambda w: w.cast("int"))
    return F.try_element_at(found, F.lit(1)), F.try_element_at(found, F.lit(-1))


def year_overlap(first: Column, last: Column, low: int | None, high: int | None) -> Column:
    """Null-tolerant overlap of [first, last] with [low, high]; bounds of None or 0 are open."""
    out = F.lit(True)
    if low:
        out = out & F.coalesce(last >= low, F.lit(True))
    if high:
        out = out & F.coalesce(first <= high, F.lit(True))
    return out


def first_text(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def fix_title(c: Column) -> Column:
    """A blank between a small letter or digit and a capital; runs of blanks become one."""
    apart = F.regexp_replace(text(c), "([а-яёa-z0-9])([А-ЯЁA-Z])", "$1 $2")
    return strip(F.regexp_replace(apart, " {2,}", " "))


def slippage(c: Column) -> Column:
    """A run of 14 Cyrillic letters or more: words have probably run together."""
    return text(c).rlike(f"[{CYRILLIC}]{{14,}}")


def language(c: Column) -> Column:
    latin = F.length(F.regexp_replace(text(c), "[^a-zA-Z]++", ""))
    cyrillic = F.length(F.regexp_replace(text(c), f"[^{CYRILLIC}]++", ""))
    words = F.split(F.lower(text(c)), APART)

    def names(vocabulary: Sequence[str]) -> Column:
        return F.arrays_overlap(words, F.array(*map(F.lit, vocabulary)))

    german, french = F.when(names(V.GERMAN_WORDS), "Немецкий"), F.when(names(V.FRENCH_WORDS), "Французский")
    return F.when(latin > cyrillic, F.coalesce(german, french, F.lit("Латинский"))).otherwise("Русский")


def admin_level(c: Column) -> Column:
    return (
        F.when(any_stem(c, ("губерни", "наместничеств", "провинци")), "Губерния")
        .when(any_stem(c, ("уезда", "уезде", " уезд")), "Уезд")
        .when(any_stem(c, ("волост",)), "Волость")
    )


def modern_regions(title: Column, territory: Column, regions: Sequence[tuple[str, str]] = V.REGIONS) -> Column:
    both = F.concat_ws(" ", text(title), text(territory))
    return F.concat_ws(", ", *[F.when(any_stem(both, (stem,)), name) for stem, name in regions])


def scale(c: Column) -> Column:
    return F.regexp_replace(text(c), "[^0-9]", "").try_cast("long")


def language_name(code: Column) -> Column:
    key = F.lower(F.substring(text(code), 1, 3))
    out = F.lit(V.OTHER_LANGUAGE)
    for k, name in V.LANGUAGE_CODES.items():
        out = F.when(key == k, name).otherwise(out)
    return out


def cipher(c: Column) -> Column:
    """Fund, inventory and case of an archival cipher; empty where not given."""
    parts = {"fund": r"Ф[.\s]+([\p{L}\p{N}_.-]+)", "inventory": r"[Оо]п[.\s]+([^\s]+)", "case": r"Д[.\s]+([0-9]+[\p{L}\p{N}_]*)"}
    return F.struct(*[F.regexp_extract(text(c), p, 1).alias(k) for k, p in parts.items()])


def digit_cipher(c: Column) -> Column:
    parts = {"fund": r"Ф\.([0-9]+)", "inventory": r"Оп\.([0-9]+)", "case": r"Д\.([0-9]+)"}
    return F.struct(*[F.regexp_extract(text(c), p, 1).alias(k) for k, p in parts.items()])


def map_shelfmark(c: Column) -> Column:
    return (text(c) == "") | F.upper(text(c)).rlike("^(" + "|".join(V.SHELFMARKS) + ")")


def map_rubric(rubrics: Column, bbk: Column) -> Column:
    return any_stem(F.concat_ws(" ", text(rubrics), text(bbk)), V.RUBRICS)


def geo_map(title: Column, annotation: Column, variants: Sequence[str]) -> Column:
    both = F.concat_ws(" ", text(title), text(annotation))
    return any_stem(both, [*map(str.lower, variants), *V.GEO_WORDS]) & ~any_stem(both, V.NOT_MAPS)


def fault(c: Column) -> Column:
    """The kind of fault a message speaks of; ``other`` if none is known."""
    out = F.lit("other")
    for kind in reversed(V.FAULTS):
        out = F.when(F.lower(text(c)).contains(kind), kind).otherwise(out)
    return out


def access_class(c: Column) -> Column:
    out = F.lit("")
    for stem, kind in reversed(V.ACCESS):
        out = F.when(F.lower(text(c)).contains(stem), kind).otherwise(out)
    return out


def open_access(c: Column) -> Column:
    return F.lower(text(c)).rlike(r"открыт[омые]+\s+доступ")


def first_of(c: Column, words: Sequence[str]) -> Column:
    out = F.lit("")
    for w in reversed(words):
        out = F.when(text(c).contains(w), w).otherwise(out)
    return out


def century_year(c: Column, end: bool, default: int) -> Column:
    """Year of four digits, or the first (or last) year of a Roman century, or the default."""
    digits = F.regexp_extract(text(c), "[0-9]{4}", 0)
    out = F.lit(default)
    for roman, start in reversed(V.CENTURIES):
        year = start + 99 if end else start
        out = F.when(F.upper(text(c)).rlike(rf"[XVI]\s*В") & F.upper(text(c)).contains(roman), year).otherwise(out)
    return F.when(digits != "", F.nullif(digits, F.lit("")).cast("int")).otherwise(out)


def period(c: Column) -> tuple[Column, Column]:
    """First and last year of a period written freely."""
    found = F.transform(F.regexp_extract_all(text(c), F.lit("[0-9]{4}"), F.lit(0)), lambda w: w.cast("int"))
    one, two = F.try_element_at(found, F.lit(1)), F.try_element_at(found, F.lit(2))
    upto = any_stem(c, ("до", "по"))
    low = F.when(F.size(found) >= 2, one).when(F.size(found) == 1, F.when(upto, 1700).otherwise(one)).otherwise(century_year(c, False, 1750))
    high = F.when(F.size(found) >= 2, two).when(F.size(found) == 1, F.when(upto, one).otherwise(one + 50)).otherwise(century_year(c, True, 1917))
    return low, high


def query_words(query: Column) -> Column:
    return F.filter(F.split(F.lower(text(query)), r"\s+"), lambda w: F.length(w) > 3)


def query_overlap(query: Column, title: Column) -> Column:
    """Some word of the query longer than three letters is in the title; true if it has none."""
    words = query_words(query)
    return (F.size(words) == 0) | F.exists(words, lambda w: F.contains(F.lower(text(title)), w))


def tokens(c: Column, least: int = 4, letters: str = "а-яё") -> Column:
    return F.regexp_extract_all(F.lower(text(c)), F.lit(f"[{letters}]{{{least},}}"), F.lit(0))


def absolute_url(href: Column, base: str | Column) -> Column:
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(base if isinstance(base, Column) else F.lit(base), href))


def normal_url(url: Column) -> Column:
    """Without fragment, query and one slash at the end."""
    return F.regexp_replace(F.regexp_replace(text(url), "[#?].*$", ""), "/$", "")


def real_href(href: Column) -> Column:
    return (text(href) != "") & ~text(href).rlike("^(#|mailto:|javascript:)")


def pairs(c: Column) -> Column:
    """``key: value`` lines as a map; a later line wins."""
    lines = F.filter(F.split(text(c), "\n"), lambda x: F.contains(x, F.lit(":")))
    entries = F.transform(lines, lambda x: F.struct(strip(F.regexp_extract(x, "^([^:]*):", 1)).alias("key"), strip(F.regexp_extract(x, "^[^:]*:(.*)$", 1)).alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda o: o.key == e.key))
    return F.map_from_entries(last)


def joined(*parts: Column, sep: str = "; ") -> Column:
    """Non-empty parts, joined."""
    return F.concat_ws(sep, *[F.nullif(p, F.lit("")) for p in parts])


def year_range(first: Column, last: Column) -> Column:
    return F.concat(F.coalesce(first.cast("string"), F.lit("?")), F.lit("–"), F.coalesce(last.cast("string"), F.lit("?")))
