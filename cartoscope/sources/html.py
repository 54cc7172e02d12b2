"""Captured pages: links, titles and label/value pairs.

Links and titles are regular expressions and stay in the JVM. Label/value
pairs need the element tree: one Arrow-batched UDF, whose parser tries its
strategies in order and keeps the first that finds anything.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: An anchor's address, in quotes of either kind or none.
LINK = r"""(?i)<a\s(?:[^>]*\s)?href\s*=\s*["']?((?<=")[^"]*|(?<=')[^']*|(?<=[=\s])[^\s>"']*)"""
#: An anchor and its text, which ends with it, where another begins, or with the page.
ANCHOR = rf"(?s){LINK}[^>]*>(.*?)(?=</a\s*>|<a\s|$)"
TITLE = r"(?s)<title>(.*?)</title>"


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), F.lit(1))


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(html, F.lit("")), TITLE, 1))


def links(pages: DataFrame) -> DataFrame:
    """A row per link of each page, in order."""
    return pages.select("page_id", "url", F.posexplode(hrefs(F.col("html"))).alias("pos", "href"))


class _Pairs(HTMLParser):
    """Texts of dt/dd, th/td and label/items elements, in order."""

    LABELS = {"dt": "dl", "th": "table"}
    VALUES = {"dd": "dl", "td": "table"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: dict[str, list[list[str]]] = {"field": [], "dl": [], "table": []}
        self.open: tuple[str, bool, str] | None = None
        self.text: list[str] = []
        self.lines: list[str] = []

    def handle_starttag(self, tag, attrs):
        kinds = (dict(attrs).get("class") or "").split()
        if tag in self.LABELS or "field-label" in kinds:
            self._close()
            self.open = self.LABELS.get(tag, "field"), True, tag
        elif tag in self.VALUES or "field-items" in kinds:
            self._close()
            self.open = self.VALUES.get(tag, "field"), False, tag
        elif tag in ("br", "p", "div", "li", "tr"):
            self.lines.append("\n")

    def handle_data(self, data):
        self.lines.append(data)
        if self.open:
            self.text.append(data)

    def handle_endtag(self, tag):
        if self.open and self.open[2] == tag:
            self._close()

    def _close(self):
        if self.open:
            kind, label, _ = self.open
            value = " ".join("".join(self.text).split())
            if label:
                self.found[kind].append([value.rstrip(": "), ""])
            elif self.found[kind] and not self.found[kind][-1][1]:
                self.found[kind][-1][1] = value
        self.open, self.text = None, []

    def pairs(self) -> dict[str, str]:
        self._close()
        for kind in ("field", "dl", "table"):
            got = {k: v for k, v in self.found[kind] if k and v}
            if got:
                return got
        lines = (x.partition(":") for x in "".join(self.lines).split("\n"))
        return {k.strip(): v.strip() for k, sep, v in lines if sep and k.strip() and v.strip()}


def parse_pairs(html: str | None) -> dict[str, str]:
    parser = _Pairs()
    parser.feed(html or "")
    parser.close()
    return parser.pairs()


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def label_values(html: pd.Series) -> pd.Series:
    return html.map(parse_pairs)
