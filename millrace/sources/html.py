"""Fields of web pages: titles, links, product cards."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the two elements that need no tree.
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
HREF = r"(?i)<a\s[^>]*href=\"([^\"]*)\""


def title(html: Column) -> Column:
    """Text of the title element, null without one."""
    found = F.regexp_extract(html, TITLE, 1)
    return F.when(html.rlike(TITLE), F.trim(found))


def links(df: DataFrame, key: str, html: str) -> DataFrame:
    """One row per link of a page, in page order."""
    return df.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(HREF), 1)).alias("pos", "href"))


class _Cards(HTMLParser):
    """Collects the fields of elements with the card class."""

    def __init__(self, card: str, fields: dict[str, str], code: str):
        super().__init__()
        self.card, self.fields, self.code = card, fields, code
        self.cards: list[dict] = []
        self.depth = 0
        self.into: str | None = None

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        classes = (attributes.get("class") or "").split()
        if self.depth == 0 and self.card in classes:
            self.cards.append({"sku": attributes.get(self.code)})
            self.depth = 1
            return
        if self.depth:
            if tag not in ("br", "img", "hr", "input", "meta", "link"):
                self.depth += 1
            self.into = next((f for f, cls in self.fields.items() if cls in classes), None)
            if tag == "a" and attributes.get("href"):
                self.cards[-1].setdefault("url", attributes["href"])

    def handle_endtag(self, tag):
        self.into = None
        if self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if self.depth and self.into and data.strip():
            card = self.cards[-1]
            card[self.into] = (card.get(self.into, "") + data).strip()


CARD_COLUMNS = ["sku", "name", "price", "rating", "url"]


def product_cards(df: DataFrame, key: str, html: str, card: str, classes: dict[str, str], code: str) -> DataFrame:
    """Product cards of each page; a missing element is null, a renamed class gives no rows.

    ``card`` is the class of a card, ``classes`` those of its name, price and rating,
    ``code`` the attribute of the card that holds its number.
    """
    kind = df.schema[key].dataType.simpleString()

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, text in zip(batch[key], batch[html]):
                parser = _Cards(card, classes, code)
                parser.feed(text or "")
                rows += [(k, *[c.get(f) for f in CARD_COLUMNS]) for c in parser.cards]
            yield pd.DataFrame(rows, columns=[key, *CARD_COLUMNS])

    texts = ", ".join(f"{c} string" for c in CARD_COLUMNS)
    found = df.select(key, html).mapInPandas(extract, f"{key} {kind}, {texts}")
    number = lambda c: F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double")
    return found.withColumn("price", number("price")).withColumn("rating", number("rating"))


def drifted(pages: DataFrame, cards: DataFrame, key: str) -> DataFrame:
    """Pages without any card: the sign that a selector no longer fits."""
    return pages.select(key).join(cards.select(key).distinct(), key, "left_anti")
