"""Data that arrives in pieces: page payloads streamed in chunks, and JSON arrays that were cut off."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: A chunk is one JSON string; escapes repeat possessively, so that long chunks need no recursion.
CHUNK = r'self\.__next_f\.push\(\[1\s*,\s*("[^"\\]*+(?:\\.[^"\\]*+)*+")\]\)'
VALUE = re.compile(r"[0-9a-f]+:[A-Z]?(?=[\[{])")
LONGEST = 2_000_000
_decoder = json.JSONDecoder()


def flight_stream(html: Column) -> Column:
    """The chunks of a page's payload, decoded and put together in order; chunks that are no JSON strings are left out. Empty without any."""
    chunks = F.transform(F.regexp_extract_all(html, F.lit(CHUNK), F.lit(1)), lambda c: F.get_json_object(F.concat(F.lit('{"c":'), c, F.lit("}")), "$.c"))
    return F.array_join(chunks, "")


def values_of(stream: str) -> list[str]:
    """Every whole JSON object or array of a stream of `id:value` lines, as text; what is not whole is passed over."""
    out = []
    for m in VALUE.finditer(stream):
        try:
            _, end = _decoder.raw_decode(stream, m.end())
        except (ValueError, RecursionError):
            continue
        if end - m.end() <= LONGEST:
            out.append(stream[m.end() : end])
    return out


@F.pandas_udf(ArrayType(StringType()))
def stream_values(stream: pd.Series) -> pd.Series:
    """values_of for each row; null has none."""
    return stream.map(lambda s: values_of(s) if s else [])


def flight_values(html: Column) -> Column:
    return stream_values(flight_stream(html))


def json_array(answer: Column) -> Column:
    """The elements, variants, of the first JSON array in a text, between fences and prose or not.

    An array that is cut off keeps its elements up to the last whole object that another one follows. No array gives no elements.
    """
    plain = F.regexp_replace(answer, "```json|```", "")
    body = F.when(F.contains(plain, F.lit("[")), F.substr(plain, F.instr(plain, F.lit("["))))
    close = F.instr(F.reverse(body), F.lit("]"))
    whole = F.when(close > 0, F.substr(body, F.lit(1), F.length(body) - close + 1)).otherwise(body)
    comma = F.instr(F.reverse(whole), F.lit(",}"))
    kept = F.when(comma > 0, F.concat(F.substr(whole, F.lit(1), F.length(whole) - comma), F.lit("]")))
    value = F.coalesce(F.try_parse_json(whole), F.try_parse_json(kept))
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))
