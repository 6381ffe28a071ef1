"""Costs, venues and text limits of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as free, one amount, a marked amount, no price, and the symbols of the currencies in use.
FREE = r"(?i)\bfree\b|^(?:[a-z]{3}\s*)?[$€£¥]?\s*0(?:[.,]00?)?$"
AMOUNT = r"^(?:([A-Za-z]{3})\s*)?[$€£¥]?\s*(\d+(?:[.,]\d{1,2})?)$"
MARKED = r"[$€£¥]\s*(\d+(?:[.,]\d{1,2})?)"
SYMBOLS = {"AUD": "$", "USD": "$", "NZD": "$", "CAD": "$", "EUR": "€", "GBP": "£", "JPY": "¥"}
NO_PRICE = r"(?i)^(?:see (?:link|website|site)|check (?:website|site|ticket price|prices?)|tba|tbc|unknown|not specified|paid|price on application|poa|varies|various|buy tickets?|tickets?|ticketed|book(?: now)?|register|n/?a|—|-|\?+)$"
FLOOR = r"(?i)^(level|lvl|floor|shop|suite|unit)\s*\d+[a-z]?$"


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(".")).cast("double")


def cost_amount(raw: Column) -> Column:
    """0 for free, the number if the text is one amount, else null."""
    value = F.trim(raw)
    return F.when(value.rlike(FREE), 0.0).when(value.rlike(AMOUNT), _number(F.regexp_extract(value, AMOUNT, 2)))


def cost_range(raw: Column) -> Column:
    """(low, high) of two or more marked amounts, else null."""
    amounts = F.transform(F.regexp_extract_all(raw, F.lit(MARKED), F.lit(1)), _number)
    return F.when(F.size(amounts) >= 2, F.struct(F.array_min(amounts).alias("low"), F.array_max(amounts).alias("high")))


def cost_label(raw: Column, currency: str = "AUD") -> Column:
    """`free`, a single amount with its currency's symbol, else the text; null if it is empty or names no price. Another currency's code is kept before the amount."""
    value = F.trim(raw)
    n = cost_amount(raw)
    digits = F.when(n == F.floor(n), F.format_number(n, 0)).otherwise(F.format_number(n, 2))
    declared = F.upper(F.regexp_extract(value, AMOUNT, 1))
    mark = F.when((declared == "") | (declared == currency), F.lit(SYMBOLS.get(currency, currency + " "))).otherwise(F.concat(declared, F.lit(" ")))
    return F.when(value == "", None).when(value.rlike(FREE), "free").when(value.rlike(NO_PRICE), None).when(value.rlike(AMOUNT), F.concat(mark, digits)).otherwise(value)


def offer(raw: Column, url: Column, currency: str = "AUD") -> Column:
    """schema.org Offer or AggregateOffer as JSON, null without a label."""
    label, amount, span = cost_label(raw, currency), cost_amount(raw), cost_range(raw)
    base = [label.alias("description"), F.lit(currency).alias("priceCurrency"), F.lit("https://schema.org/InStock").alias("availability"), url.alias("url")]
    kind = lambda k, *more: F.to_json(F.struct(F.lit(k).alias("@type"), *base, *more))
    many = kind("AggregateOffer", span["low"].alias("lowPrice"), span["high"].alias("highPrice"))
    return F.when(label.isNull(), None).when(amount.isNotNull(), kind("Offer", amount.alias("price"))).when(span.isNotNull(), many).otherwise(kind("Offer"))


def raw_venue(location: Column) -> Column:
    """The first part of a location that is not a floor or unit."""
    parts = F.filter(F.transform(F.split(F.coalesce(location, F.lit("")), "[,·]"), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.get(F.filter(parts, lambda x: ~x.rlike(FLOOR)), 0), F.get(parts, 0), F.lit(""))


def venue_key(name: Column) -> Column:
    plain = F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit(" and ")), "[^a-z0-9 ]", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(plain, r"\s+", " ")), "^the ", "")


def numbers_conflict(a: Column, b: Column) -> Column:
    """Both hold numbers, and not the same ones."""
    numbers = lambda x: F.array_join(F.regexp_extract_all(x, F.lit(r"(\d+)"), F.lit(1)), " ")
    return (numbers(a) != "") & (numbers(b) != "") & (numbers(a) != numbers(b))


def truncate(text: Column, most: int = 200) -> Column:
    """At most `most` characters, cut at a space if one is late enough, with an ellipsis."""
    cut = F.substring(text, 1, most)
    last = most - F.instr(F.reverse(cut), " ")
    late = (F.instr(F.reverse(cut), " ") > 0) & (last > int(most * 0.6))
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.trim(F.when(late, F.substr(cut, F.lit(1), last)).otherwise(cut)), F.lit("…")))


def blocked(status: Column, body: Column, readable: Column) -> Column:
    """Why a response is no page: its status, a challenge, or next to no text; null if it is one."""
    challenge = body.rlike(r"(?i)(captcha|cf-challenge|access denied|are you a robot|enable javascript and cookies)")
    return F.when(status.isin(401, 403, 429), F.concat(F.lit("status "), status.cast("string"))).when(challenge & (readable < 2000), "challenge").when(readable < 50, "empty")
