"""Fields, numbers and encodings of catalogue pages, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .. import vocabulary as V
from .text import any_stem, strip, text

#: The upper half of code page 1251, made from the codec: the character of each byte that has one.
_UPPER = {b: bytes([b]).decode("cp1251") for b in range(128, 256) if b != 0x98}
_CP1251, _LATIN = "".join(_UPPER.values()), "".join(map(chr, _UPPER))


def has(c: Column, part: str) -> Column:
    """Whether the text contains ``part`` in any case; an empty part is in every text."""
    return F.contains(F.lower(text(c)), F.lit(part.lower()))


def soft_territory(territory: str, geography: Column, title: Column) -> Column:
    """The territory is named in the geography or, failing that, in the title."""
    return has(geography, territory) | has(title, territory)


def record_row(row: Column, title: Column) -> Column:
    """A table row that is a record: long enough, and not a heading of the form."""
    return (F.length(text(row)) >= 30) & ~F.lower(text(title)).rlike("^(" + "|".join(V.NO_RECORDS) + ")")


def portal(title: Column) -> Column:
    return any_stem(title, V.PORTALS)


def shelfmark(c: Column, shape: str) -> Column:
    """The whole shelfmark as one of the archives writes it; empty if there is none."""
    return strip(F.regexp_extract(text(c), V.CIPHER_SHAPES[shape], 0))


def whole_cipher(c: Column) -> Column:
    """Cipher, fund, inventory and case."""
    parts = {"fund": r"Ф[.\s]+([\p{L}\p{N}_.-]+)", "inventory": r"[Оо]п[.\s]+(\S+)", "case": r"Д[.\s]+([0-9]+[\p{L}\p{N}_]*)"}
    return F.struct(shelfmark(c, "gako").alias("cipher"), *[F.regexp_extract(text(c), p, 1).alias(k) for k, p in parts.items()])


def plain_cipher(c: Column) -> Column:
    """Fund, inventory and case; the fund has no dots."""
    parts = {"fund": r"Ф[.\s]+([\p{L}\p{N}_-]+)", "inventory": r"[Оо]п[.\s]+(\S+)", "case": r"Д[.\s]+([0-9]+[\p{L}\p{N}_]*)"}
    return F.struct(*[F.regexp_extract(text(c), p, 1).alias(k) for k, p in parts.items()])


def without_numbers(c: Column) -> Column:
    """The text without the numbers of its cipher (fund, inventory and case) and of a case
    by name, ``Дело 1799`` or, at the beginning, ``Д 1799``: they look like years.
    ``Дело 1799 г.`` and ``Дело 1796-1799`` name years."""
    return F.regexp_replace(text(c), f"{V.CIPHER}|{V.CASE}", " ")


def archive_at_end(c: Column) -> Column:
    return strip(F.regexp_extract(text(c), V.ARCHIVE_AT_END, 0))


def author_line(c: Column) -> Column:
    """Family name and initials at the beginning of a line."""
    return F.regexp_extract(text(c), r"(?m)^([А-Я][а-я]+\s+[А-Я]\.[А-Я]?\.?)", 1)


def location(c: Column) -> Column:
    return F.substring(F.regexp_extract(text(c), r"(?iu)(Свердловская[^;]*;[^;]*;[^;]*Инв\.\s*номер[^<\n]*)", 1), 1, 120)


def annotation(c: Column) -> Column:
    return F.substring(strip(F.regexp_extract(text(c), r"Аннотация:\s*([^\n\r<]{10,})", 1)), 1, 300)


def after_label(c: Column, label: str, least: int = 1) -> Column:
    """The line after a line that is the label, if it has ``least`` characters or more."""
    return strip(F.regexp_extract(text(c), rf"{label}\s*\n([^\n]{{{least},}})", 1))


def in_line(c: Column, label: str) -> Column:
    """What follows the label on its line."""
    return strip(F.regexp_extract(text(c), rf"{label}:?\s*([^\n\r<]+)", 1))


def blocks(c: Column) -> Column:
    """Parts that two blank lines or more keep apart, without the empty ones."""
    return F.filter(F.transform(F.split(text(c), r"\n{3,}"), strip), lambda b: b != "")


def numbered_blocks(c: Column) -> Column:
    """What follows each line that is a number of up to four digits: (number, content)."""
    apart = F.regexp_replace(F.concat(F.lit("\n"), text(c)), r"\n[ \t]*([0-9]{1,4})[ \t]*(?=\n)", "\u0001$1\u0002")
    parts = F.slice(F.split(apart, "\u0001"), 2, F.greatest(F.size(F.split(apart, "\u0001")), F.lit(1)))
    return F.transform(parts, lambda p: F.struct(F.substring_index(p, "\u0002", 1).cast("int").alias("number"), strip(F.substring_index(p, "\u0002", -1)).alias("content")))


def hidden_fields(html: Column) -> Column:
    """Hidden inputs of a form by name; a later one wins, one without a value is empty."""
    inputs = F.regexp_extract_all(text(html), F.lit(r"""(?i)<input[^>]+type=["']?hidden["']?[^>]*>"""), F.lit(0))
    named = F.filter(inputs, lambda t: t.rlike(r"""(?i)name=["'][^"']+["']"""))
    entries = F.transform(
        named,
        lambda t: F.struct(F.regexp_extract(t, r"""(?i)name=["']([^"']+)["']""", 1).alias("key"), F.regexp_extract(t, r"""(?i)value=["']([^"']*)["']""", 1).alias("value")),
    )
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda o: o.key == e.key))
    return F.map_from_entries(last)


def without_brackets(c: Column) -> Column:
    return F.regexp_replace(text(c), r"^[\[\]]+|[\[\]]+$", "")


def without_colon(c: Column) -> Column:
    return F.regexp_replace(text(c), ":+$", "")


def total_hits(c: Column, patterns: Sequence[str] = V.TOTALS, default: int = 0) -> Column:
    """The number of hits that a page names, by the first pattern that fits."""
    found = [F.nullif(F.regexp_extract(text(c), f"(?iu){p}", 1), F.lit("")).try_cast("long") for p in patterns]
    return F.coalesce(*found, F.lit(default).cast("long"))


def page_count(total: Column, size: int = 20) -> Column:
    return F.ceil(total / F.lit(size)).cast("long")


def offsets(total: Column, size: int = 20, first: int = 1) -> Column:
    """Where each page of results begins; none without results."""
    return F.when(total >= first, F.sequence(F.lit(first).cast("long"), total, F.lit(size).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def last_offset(total: Column, size: int = 20, first: int = 1) -> Column:
    """Where the last page of results begins, without a list of the others; null without results."""
    whole = total.cast("long")
    return F.when(whole >= first, whole - (whole - first) % size)


def last_page(html: Column) -> Column:
    """The greatest page number that a link of the page names; 1 if none does."""
    numbers = F.regexp_extract_all(text(html), F.lit(r"""(?i)href=["'][^"']*?(?:pages?|[?&;](?:p|stpage|pg))=([0-9]+)"""), F.lit(1))
    return F.greatest(F.coalesce(F.array_max(F.transform(numbers, lambda n: n.try_cast("int"))), F.lit(1)), F.lit(1))


def run_label(at: Column) -> Column:
    """Name of a run's folder; names sort by time."""
    return F.date_format(at, "yyyyMMdd_HHmmss")


def map_query(year_to: Column) -> Column:
    """Query for maps printed up to a year."""
    return F.concat(F.lit("((SH карта)) AND (PY LE '"), year_to.cast("string"), F.lit("')"))


def year_of_query(query: Column, default: int = 1917) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(text(query), r"PY LE '([0-9]+)'", 1), F.lit("")).try_cast("int"), F.lit(default))


def marked(word: Column, known: Sequence[str] = V.KNOWN_TRIGGERS) -> Column:
    return F.when(word.isin(*known), " ← ТРИГГЕР").otherwise("")


def verdict(n: Column) -> Column:
    return F.when(n > 0, "OK").otherwise("FAIL")


def province_in(name: Column) -> Column:
    """First of the four provinces that a name contains."""
    out = F.lit(None).cast("string")
    for province in reversed(list(V.PROVINCES)):
        out = F.when(F.contains(text(name), F.lit(province.capitalize())), province.capitalize()).otherwise(out)
    return out


def combined_note(abbreviation: Column, notes: Column, most: int = 2000) -> Column:
    """``abbreviation: notes``, cut; empty if both are."""
    first = F.when(text(abbreviation) != "", F.concat(abbreviation, F.lit(": "))).otherwise("")
    return F.substring(F.concat(first, text(notes)), 1, most)


def advice(problem: Column) -> Column:
    """What to try against a problem, by the first kind of fault that it names."""
    out = F.lit(V.WORKAROUNDS["other"])
    for kind in reversed(V.FAULTS):
        out = F.when(F.contains(F.lower(text(problem)), F.lit(kind)), V.WORKAROUNDS[kind]).otherwise(out)
    return out


# Encodings


def percent(c: Column) -> Column:
    """A text in a URL: UTF-8, all but letters, digits, ``_.-~`` and slashes as percent codes."""
    out = F.url_encode(text(c))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _latin(c: Column) -> Column:
    """Characters of code page 1251 as the Latin-1 characters of the same bytes; ? for all others."""
    other = F.regexp_replace(text(c), f"[^\\x00-\\x7F{_CP1251}]", "?")
    return F.translate(other, _CP1251, _LATIN)


def to_cp1251(c: Column) -> Column:
    return F.encode(_latin(c), "ISO-8859-1")


def from_cp1251(c: Column) -> Column:
    return F.translate(F.decode(c, "ISO-8859-1"), _LATIN, _CP1251)


def percent_cp1251(c: Column) -> Column:
    """A form value in code page 1251: blanks as plus signs, other bytes as percent codes."""
    signs = F.filter(F.split(_latin(c), ""), lambda s: s != "")
    coded = F.transform(signs, lambda s: F.when(s.rlike("^[A-Za-z0-9_.~-]$"), s).when(s == " ", "+").otherwise(F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(s)), 2, "0"))))
    return F.array_join(coded, "")


def decoded(c: Column) -> Column:
    """Bytes as text: UTF-8 if they are that, code page 1251 otherwise; an XML declaration says UTF-8 then."""
    told = F.when(F.is_valid_utf8(c.cast("string")), F.decode(c, "UTF-8")).otherwise(from_cp1251(c))
    return F.regexp_replace(told, 'encoding="[^"]*"', 'encoding="utf-8"')
