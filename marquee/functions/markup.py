"""Markup: readable text of HTML, entity decoding, display clean-up, escapes for feeds."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKIPPED = frozenset({"script", "style", "noscript", "svg", "nav", "footer", "header", "iframe", "template"})
BLOCKS = frozenset({"p", "div", "br", "li", "ul", "ol", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article"})


class _Reader(HTMLParser):
    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.parts, self.depth, self.link = base, [], 0, None

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.depth += 1
        elif tag in BLOCKS:
            self.parts.append("\n")
        elif tag == "a" and not self.depth:
            self.link = (len(self.parts), dict(attrs).get("href") or "")

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.depth = max(0, self.depth - 1)
        elif tag in BLOCKS:
            self.parts.append("\n")
        elif tag == "a" and self.link:
            at, href = self.link
            label, url = "".join(self.parts[at:]).strip(), urljoin(self.base, href)
            if label and url.startswith(("http://", "https://")):
                self.parts[at:] = [f"{label} ({url})"]
            self.link = None

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def readable(page: str | None, base: str | None) -> str:
    reader = _Reader(base or "")
    reader.feed(page or "")
    reader.close()
    lines = (re.sub(r"\s+", " ", x).strip() for x in "".join(reader.parts).split("\n"))
    return "\n".join(x for x in lines if x)


@F.pandas_udf(T.StringType())
def html_text(pages: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Readable text of pages, links kept as `label (url)`."""
    for page, base in pages:
        yield pd.Series([readable(p, b) for p, b in zip(page, base, strict=True)], dtype="object")


def decoder() -> Callable[[str | None], str]:
    """What decoded does to one text. It names no helper of this module, which workers might not find."""

    def decode(text: str | None) -> str:
        return html.unescape(html.unescape(html.unescape(text))) if text and "&" in text else text or ""

    return decode


def cleaner() -> Callable[[str | None], str]:
    """What clean_text does to one text."""
    decode = decoder()

    def clean(text: str | None) -> str:
        text = decode(text)
        if "<" in text:
            end = text.rfind(">") + 1  # a tag that isn't closed would be looked for up to the end from each of its signs
            text = re.sub(r"<[^>]*>", " ", text[:end]) + text[end:]
        if "\\" in text:
            text = re.sub(r"\\(['\"nrt\\])", lambda m: {"n": " ", "r": " ", "t": " "}.get(m[1], m[1]), text)
        return " ".join(text.split())

    return clean


def _each(one: Callable[[str | None], str]) -> Callable[[pa.Array], pa.Array]:
    """A text function over arrays: equal texts of a batch are looked at once."""

    def run(texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode()
        return pa.array([one(t) for t in coded.dictionary.to_pylist()], pa.string()).take(coded.indices).fill_null(one(None))

    return run


def _each_of_lists(one: Callable[[str | None], str]) -> Callable[[pa.Array], pa.Array]:
    """A text function over the elements of lists; null lists stay null."""
    each = _each(one)

    def run(lists: pa.Array) -> pa.Array:
        ends = np.cumsum(np.concatenate(([0], lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), each(lists.flatten()), mask=lists.is_null())

    return run


def clean_text(texts: Column | str) -> Column:
    """Entities decoded up to three times, tags dropped, escapes undone, white space squeezed; null is empty."""
    return F.arrow_udf(_each(cleaner()), T.StringType())(texts)


def clean_texts(lists: Column | str) -> Column:
    """clean_text of each text of a list; a null list stays null."""
    return F.arrow_udf(_each_of_lists(cleaner()), T.ArrayType(T.StringType()))(lists)


def decoded(texts: Column | str) -> Column:
    """Entities decoded up to three times; null is empty."""
    return F.arrow_udf(_each(decoder()), T.StringType())(texts)


def strip_display(text: Column) -> Column:
    """Text for display: markdown marks and URLs removed, the punctuation they leave repaired."""
    for pattern, by in (
        (r"\[([^\]]*)\]\([^)]*\)", "$1"),
        (r"https?://\S+", ""),
        (r"(\*\*|__|`)", ""),
        (r"(?m)^#+\s*", ""),
        (r"\(\s*\)", ""),
        (r"\s+([.,;:!?])", "$1"),
        (r"([.,;:!?])\1+", "$1"),
        (r"\s+", " "),
    ):
        text = F.regexp_replace(text, pattern, by)
    return F.trim(text)


def escape_xml(text: Column) -> Column:
    text = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def escape_ical(text: Column) -> Column:
    for a, b in (("\\", "\\\\"), (";", "\\;"), (",", "\\,"), ("\r\n", "\\n"), ("\n", "\\n")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


@F.pandas_udf(T.StringType())
def fold_ical(lines: pd.Series) -> pd.Series:
    """Lines of at most 75 bytes, further ones after CRLF and a space, never inside a character."""

    def one(line):
        if line is None:
            return None
        out, now, room = [], b"", 75
        for ch in line:
            b = ch.encode()
            if len(now) + len(b) > room:
                out.append(now)
                now, room = b"", 74
            now += b
        return b"\r\n ".join([*out, now]).decode()

    return lines.map(one)
