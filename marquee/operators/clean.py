"""Events as they are published: every text, link, price and picture cleaned, and tags in the one order of steps that keeps their meaning."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import model
from marquee.functions import dates as D
from marquee.functions import listing as L
from marquee.functions.markup import clean_text, clean_texts, cleaner, decoded
from marquee.operators import corpus

TEXTS = ("title", "description", "location", "cost", "datetime", "source")
LINKS = ("link", "location_url")
# What a cost that is free looks like, and the council's page of an embedded event with the page that shows it.
FREE_COST = r"(?i)^(free|free entry|no charge|\$?0(\.00)?)$"
COUNCIL = r"(?i)^https?://(?:www\.)?brisbane\.qld\.gov\.au/[^?#]*\?trumbaEmbed=view(?:%3D|=)event(?:%26|&)eventid(?:%3D|=)(\d+)"
COUNCIL_PAGE = "https://www.trumba.com/calendars/brisbane-city-council?eventid="


def currency_codes(spark: SparkSession) -> list[str]:
    """The codes of ISO 4217 that the JVM knows."""
    return sorted(c.getCurrencyCode() for c in spark._jvm.java.util.Currency.getAvailableCurrencies())


def one_currency(cost: Column, currency: str, codes: list[str]) -> Column:
    """A cost with any other currency's code before an amount as the city's own; three letters that are no code stay. Null is empty."""
    others = "|".join(c for c in codes if c != currency.upper())
    text = F.coalesce(cost, F.lit(""))
    if re.fullmatch(r"[\w|]+", others, re.ASCII):  # a word without an amount behind it is told before all codes are tried, and these by their first letter
        first = {c[0]: [x[1:] for x in others.split("|") if x[:1] == c[0]] for c in others.split("|") if c}
        others = r"(?=\w+\b\s*[\d.$])(?:" + "|".join(f"{a}(?:{'|'.join(rest)})" for a, rest in first.items()) + ")"
    return F.regexp_replace(text, rf"(?i)\b(?:{others})\b(?=\s*[\d.$])", currency) if others else text


def clean_url(url: Column) -> Column:
    """Entities decoded, ends trimmed; empty unless it is http or https."""
    plain = F.trim(decoded(url))
    return F.when(plain.rlike("(?i)^https?://"), plain).otherwise("")


def council_url(url: Column) -> Column:
    """The council's link to its search of embedded events as the page of the event; any other as it is."""
    found = F.regexp_extract(url, COUNCIL, 1)
    return F.when(found != "", F.concat(F.lit(COUNCIL_PAGE), found)).otherwise(url)


def clean_events(events: DataFrame, currency: str = "AUD", codes: list[str] | None = None) -> DataFrame:
    """The events with cleaned columns; of TEXTS, LINKS, image and tags those that they have.

    Texts lose entities, tags and escapes; null is empty. datetime is said anew from datetime_iso and datetime_end_iso and stays as written
    only where they say nothing. A foreign currency becomes the city's. Links are decoded and http or https or empty. image must be https with
    the extension of a picture, else it is empty. Tags are cleaned and in lower case, null ones empty; null tags stay null. Other columns stay."""
    rows = _clean_fields(events, currency, codes)
    if "tags" not in events.columns:
        return rows
    return rows.withColumn("tags", F.transform(clean_texts(F.col("tags")), lambda t: F.lower(t)))


def _clean_fields(events: DataFrame, currency: str, codes: list[str] | None) -> DataFrame:
    """clean_events but for tags."""
    out: dict[str, Column] = {n: clean_text(F.col(n)) for n in TEXTS if n in events.columns}
    out |= {n: clean_url(F.col(n)) for n in (*LINKS, "image") if n in events.columns}
    dated = {f"_{n}": _dated(n) for n in ("datetime_iso", "datetime_end_iso") if {"datetime_iso", "datetime_end_iso"} <= set(events.columns)}
    rows = events.withColumns(out | dated)
    then: dict[str, Column] = {}
    if dated:
        said = F.nullif(D.human_datetime(*map(F.col, dated)), F.lit(""))
        then["datetime"] = F.coalesce(said, F.col("datetime") if "datetime" in events.columns else F.lit(""), F.lit(""))
    if "cost" in events.columns:
        then["cost"] = one_currency(F.col("cost"), currency, currency_codes(events.sparkSession) if codes is None else codes)
    if "link" in events.columns:
        then["link"] = council_url(F.col("link"))
    if "image" in events.columns:
        then["image"] = F.when(L.image_url(F.col("image")), F.col("image")).otherwise("")
    return rows.withColumns(then).drop(*dated)


def _dated(name: str) -> Column:
    """A date that can be read, else null."""
    value = F.col(name)
    good = value.rlike(r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2})?)?$") & F.substring(value, 1, 10).try_cast("date").isNotNull()
    return F.when(good, value)


def tag_steps(events: DataFrame, city: str, key: str = "ord", most: int = 50_000) -> DataFrame:
    """tags through all steps, in order: variants on their commoner spelling, repeats dropped, useless ones and names of the place dropped,
    implied ones added, and `free` by the cost alone, as the last.

    Spellings are counted over all events, at once; up to `most` of them are sent to all tasks, and events aren't shuffled. Beyond that, events with
    a variant are gathered by `key`, which must then be unique and not null; their pairs are as many as their tags. A tag that could go to two others
    goes to the least. Null tags stay null; a null cost or location is empty."""
    variants = _variants(events)
    spell = _few(variants, most)
    rows = events if spell is not None else _spelled(events, variants, key)
    # the generator keeps lambdas that made the tags out of the Python function's arguments, where Spark could not tell it apart
    rows = rows.withColumn("tags", F.explode(F.array("tags")))
    return _with_free(rows.withColumn("tags", _stepped(city, spell or {})("tags", "location")))


def published(events: DataFrame, city: str, currency: str = "AUD", codes: list[str] | None = None, key: str = "ord", most: int = 50_000) -> DataFrame:
    """tag_steps of clean_events: the same rows, but all that Python does to an event is done at once, and tags are cleaned once for each spelling."""
    spell = _few(_variants(events, lambda t: F.lower(clean_text(t))), most)
    if spell is None:
        return tag_steps(clean_events(events, currency, codes), city, key, most)
    return _with_free(_clean_fields(events.withColumn("tags", _stepped(city, spell, cleaner())("tags", "location")), currency, codes))


def _variants(events: DataFrame, plain: Callable[[Column], Column] = lambda t: t) -> DataFrame:
    """tag, canonical: the spelling of each tag that has a commoner one."""
    return corpus.tag_variants(events.select("tags"), plain).filter("tag <> canonical").groupBy("tag").agg(F.min("canonical").alias("canonical"))


def _few(variants: DataFrame, most: int) -> dict[str, str] | None:
    rows = variants.limit(most + 1).collect()
    return {r["tag"]: r["canonical"] for r in rows} if len(rows) <= most else None


def _spelled(events: DataFrame, variants: DataFrame, key: str) -> DataFrame:
    """tags on their commoner spelling, where variants are too many to be sent to all tasks."""
    spelled = events.select(F.col(key).alias("_key"), F.explode("tags").alias("_tag")).join(variants.withColumnRenamed("tag", "_tag"), "_tag")
    changed = spelled.groupBy("_key").agg(F.map_from_entries(F.collect_set(F.struct("_tag", "canonical"))).alias("_spell"))
    rows = events.join(changed, F.col(key) == F.col("_key"), "left")
    return rows.withColumn("tags", F.transform("tags", lambda t: F.coalesce(F.element_at("_spell", t), t))).drop("_key", "_spell")


def _with_free(events: DataFrame) -> DataFrame:
    free = F.when(F.trim(F.coalesce("cost", F.lit(""))).rlike(FREE_COST), F.array(F.lit("free"))).otherwise(F.array().cast("array<string>"))
    return events.withColumn("tags", F.concat("tags", free))


def _stepped(city: str, spell: dict[str, str], clean: Callable[[str | None], str] | None = None) -> Callable[[str, str], Column]:
    """A function of the columns of tags and place: the steps of tags without `free`. It names no helper of this module, which workers might not find.

    Tags and places are looked at once a batch; equal lists with equal names of places among them once, while they are among the 65,536 latest."""
    implied, useless, seen = L.implier(4), frozenset(model.VACUOUS_TAGS), {}

    def run(tags: pa.Array, places: pa.Array) -> pa.Array:
        if not seen or len(seen["number"]) + len(seen["done"]) >= 1 << 16:
            seen.update(number={}, words=[], of_word={}, done={})
        number, words, of_word, done = seen["number"], seen["words"], seen["of_word"], seen["done"]
        coded, place = tags.flatten().dictionary_encode(), places.dictionary_encode()
        code = []
        for t in coded.dictionary.to_pylist():
            t = clean(t).lower() if clean else t
            t = spell.get(t, t)
            if t not in number:
                plain = t.strip(" ").lower()
                number[t] = -1 if plain == "" or plain in useless else len(words)
                if number[t] >= 0:
                    words.append(t)
                    if " " not in plain:
                        of_word.setdefault(plain, []).append(number[t])
            code.append(number[t])
        # null tags are dropped like useless ones
        codes = np.array([*code, -1], np.int32)[coded.indices.fill_null(len(code)).to_numpy(zero_copy_only=False)].tobytes()
        ends = np.cumsum(tags.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) * 4
        texts = [f"{city} {clean(p) if clean else p}".lower() for p in place.dictionary.to_pylist()] + [city.lower()]
        names = [tuple(sorted({n for w in re.findall("[a-z0-9]{4,}", p) for n in of_word.get(w, ())})) for p in texts]
        at, out, here, start = [], [], {}, 0
        for end, p in zip(ends.tolist(), place.indices.fill_null(len(texts) - 1).to_pylist(), strict=True):
            one = codes[start:end], names[p]
            start = end
            if one not in here:
                if one not in done:
                    kept = dict.fromkeys(np.frombuffer(one[0], np.int32).tolist())
                    done[one] = [t for t in implied(words[n] for n in kept if n >= 0 and n not in one[1]) if t != "free"]
                here[one] = len(out)
                out.append(done[one])
            at.append(here[one])
        made = pa.array(out, pa.list_(pa.string())).take(pa.array(at, pa.int32()))
        return pc.if_else(tags.is_valid(), made, None) if tags.null_count else made

    return F.arrow_udf(run, T.ArrayType(T.StringType()))
