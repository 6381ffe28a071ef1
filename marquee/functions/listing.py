"""Column functions over listings. "" and null both mean missing in text columns; dates are naive ISO strings."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import model


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once a row: a lambda that names a column's expression would compute it anew for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def day(iso: Column) -> Column:
    """The date part, null if missing."""
    return F.nullif(F.substring(iso, 1, 10), F.lit(""))


def last_day_of(start: Column, end: Column, shown: Column | None = None) -> Column:
    """When a listing ends: its end, else the end its display text names, else its start."""
    parts = [day(end)] + ([] if shown is None else [end_in_text(shown, start)]) + [day(start)]
    return F.coalesce(*parts)


def _month(name: Column) -> Column:
    months = F.array(*map(F.lit, "jan feb mar apr may jun jul aug sep oct nov dec".split()))
    return F.array_position(months, F.lower(name))


def end_in_text(shown: Column, start: Column) -> Column:
    """The end that a text like `3 - 9 Mar` or `3 Mar to 9 Apr` names, in the start's year."""
    short = r"\b\d{1,2}\s*[–—-]\s*(\d{1,2})\s+([A-Za-z]{3})\b"
    date = r"\b(\d{1,2})\s+([A-Za-z]{3})\b"
    written = lambda d, m: F.when(m > 0, F.concat(F.substring(start, 1, 4), F.lit("-"), F.lpad(m.cast("string"), 2, "0"), F.lit("-"), F.lpad(d, 2, "0")))
    one = written(F.regexp_extract(shown, short, 1), _month(F.regexp_extract(shown, short, 2)))
    days, months = F.regexp_extract_all(shown, F.lit(date), F.lit(1)), F.regexp_extract_all(shown, F.lit(date), F.lit(2))
    many = F.when(F.size(days) >= 2, written(F.element_at(days, -1), _month(F.element_at(months, -1))))
    return F.coalesce(one, many)


def overlaps(start: Column, end: Column, first: str, last: str, shown: Column | None = None) -> Column:
    """Whether a listing lies in [first, last] on any day; never without a date."""
    return F.coalesce((day(start) <= F.lit(last)) & (last_day_of(start, end, shown) >= F.lit(first)), F.lit(False))


def is_past(start: Column, end: Column, today: str) -> Column:
    """Ended before today; a listing without a date is never past."""
    return F.coalesce(last_day_of(start, end) < F.lit(today), F.lit(False))


def score_floor(score: Column, least: float = model.LOW_SCORE) -> Column:
    return score.isNull() | (score >= least)


def top_pick(score: Column, start: Column, end: Column, first: str, last: str) -> Column:
    """Score high enough, and start and end inside the window; an empty window asks for a date only."""
    good = F.coalesce(score, F.lit(0.0)) >= model.TOP_PICK
    if not first or not last:
        return good & day(start).isNotNull()
    return good & F.coalesce(day(start).between(first, last), F.lit(False)) & F.coalesce(day(end) <= F.lit(last), F.lit(True))


def band(start: Column) -> Column:
    """morning, afternoon or evening (past midnight too); null without a time."""
    hour = F.when((F.length(start) > 10) & F.substring(start, 12, 2).rlike("^[0-9]{2}$"), F.substring(start, 12, 2).cast("int"))
    return F.when(hour.between(5, 11), "morning").when(hour.between(12, 16), "afternoon").when((hour >= 17) & (hour < 29) | (hour < 5), "evening")


def canonical_order(score: Column, start: Column, order: Column) -> list[Column]:
    """Best first, then soonest; null scores as 0, undated last."""
    return [F.coalesce(score, F.lit(0.0)).desc(), sort_date(start), order]


def sort_date(iso: Column) -> Column:
    return F.coalesce(F.nullif(iso, F.lit("")), F.lit(model.NO_DATE))


def event_hash(city: Column, title: Column, start: Column, place: Column) -> Column:
    """The frozen identity: h = 31 h + unit over the UTF-16 units of city|title|start|place, 32 bits, base 36."""
    return F.lower(F.conv(_hash31(F.concat_ws("|", city, title, start, place)).cast("string"), 10, 36))


@F.arrow_udf(T.LongType())
def _hash31(texts: pa.Array) -> pa.Array:
    """Sums of unit * 31^(units behind it), modulo 2^32, over all texts of a batch at once.

    31 has an inverse modulo 2^32: a unit at place i of the batch counts unit * 31^-i, and a text's sum is raised by 31^(its last place)."""
    blob = texts.cast(pa.large_binary())
    bounds = np.frombuffer(blob.buffers()[1], np.int64)[blob.offset : blob.offset + len(blob) + 1]
    data = blob.buffers()[2]
    units = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and len(blob) else np.zeros(0, np.uint8)
    ends, sizes = bounds[1:] - bounds[0], np.diff(bounds)
    if len(units) and units.max() > 127:
        coded = [t.encode("utf-16-le", "surrogatepass") for t in texts.to_pylist()]
        sizes = np.fromiter((len(b) // 2 for b in coded), np.int64, len(coded))
        ends, units = np.cumsum(sizes), np.frombuffer(b"".join(coded), "<u2")
    # all that is named here travels with the function, so workers need not import this module
    up, down = (np.multiply.accumulate(np.concatenate(([1], np.full(len(units), x))).astype(np.uint32), dtype=np.uint32) for x in (31, pow(31, -1, 1 << 32)))
    out, some = np.zeros(len(sizes), np.uint32), sizes > 0
    if len(units):
        out[some] = np.add.reduceat(units * down[: len(units)], (ends - sizes)[some], dtype=np.uint32) * up[ends[some] - 1]
    return pa.array(out.astype(np.int64))


def normal_text(text: Column) -> Column:
    """Lower case, runs of other than a-z and 0-9 as one space. Latin-1 letters lose their marks."""
    plain = F.translate(F.lower(text), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def one_edit(a: Column, b: Column) -> Column:
    """At most one insertion, deletion, change or swap of neighbours apart."""
    n, at = F.length(a), lambda x, i: F.substr(x, i, F.lit(1))
    diffs = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: at(a, i) != at(b, i))
    i, j = (lambda d: F.get(d, 0)), (lambda d: F.get(d, 1))
    swap = (n == F.length(b)) & let(diffs, lambda d: (F.size(d) == 2) & (j(d) == i(d) + 1) & (at(a, i(d)) == at(b, j(d))) & (at(a, j(d)) == at(b, i(d))))
    return F.levenshtein(a, b, 1).between(0, 1) | F.coalesce(swap, F.lit(False))


def token_matches(haystack: Column, token: str) -> Column:
    """Contains the token or, from 4 letters on, has a word one edit away."""
    found = F.contains(haystack, F.lit(token))
    if len(token) < 4:
        return found
    return found | F.exists(F.split(haystack, " "), lambda w: F.length(w).between(len(token) - 1, len(token) + 1) & one_edit(F.lit(token), w))


def bigrams(text: Column) -> Column:
    n = F.length(text)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))


def numbered_bigrams(text: Column) -> Column:
    """The bigrams, repeated ones numbered, so that the multisets of two texts share as many as these sets."""
    return let(F.array_sort(bigrams(text)), lambda two: F.transform(two, lambda b, i: F.concat(b, F.lit("#"), (i - F.array_position(two, b) + 1).cast("string"))))


def coded_bigrams(text: Column) -> Column:
    """numbered_bigrams of an ASCII text as whole numbers, which are compared faster."""
    code = lambda b: F.ascii(b).cast("long") * 128 + F.ascii(F.substr(b, F.lit(2), F.lit(1)))
    return let(F.array_sort(bigrams(text)), lambda two: F.transform(two, lambda b, i: F.shiftleft(code(b), 32) + i - F.array_position(two, b)))


def set_dice(a: Column, b: Column, x: Column, y: Column) -> Column:
    """dice(a, b) by their numbered or coded bigrams."""
    n, m = F.size(x), F.size(y)
    return F.when(a == b, 1.0).when((n == 0) | (m == 0), 0.0).otherwise(2.0 * F.size(F.array_intersect(x, y)) / (n + m))


def dice(a: Column, b: Column) -> Column:
    """Dice similarity of the bigram multisets; 1 for equal texts, 0 if either is under two characters."""
    x, y = bigrams(a), bigrams(b)
    count = lambda arr, g: F.size(F.filter(arr, lambda z: z == g))
    shared = F.aggregate(F.array_distinct(x), F.lit(0), lambda t, g: t + F.least(count(x, g), count(y, g)))
    return F.when(a == b, 1.0).when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(2.0 * shared / (F.size(x) + F.size(y)))


def titles_match(a: Column, b: Column, similarity: Column | None = None) -> Column:
    """Equal, one the start of the other (6 letters at least), or alike by bigrams: their dice, if it isn't given."""
    start = (F.length(a) >= 6) & (F.length(b) >= 6) & (F.startswith(a, b) | F.startswith(b, a))
    return (a != "") & (b != "") & ((a == b) | start | ((dice(a, b) if similarity is None else similarity) > 0.85))


def host(url: Column) -> Column:
    """Bare host in lower case, null if empty."""
    bare = F.lower(F.split_part(F.regexp_replace(F.trim(url), "^(?i)https?://", ""), F.lit("/"), F.lit(1)))
    return F.nullif(F.regexp_replace(bare, "^www\\.", ""), F.lit(""))


def host_suffixes(h: Column) -> Column:
    """The host and every parent domain at a dot."""
    parts = F.split(h, "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def distance_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    s = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), F.lit(2))
    return 2 * model.EARTH_KM * F.asin(F.sqrt(s))


def slug(text: Column, most: int = 60) -> Column:
    return F.replace(F.trim(F.substring(normal_text(text), 1, most)), F.lit(" "), F.lit("-"))


def strip_useless(tags: Column, city: Column, place: Column) -> Column:
    """Tags without those that say nothing, and single words that only name the place."""
    places = F.filter(F.split(F.lower(F.concat_ws(" ", city, place)), "[^a-z0-9]+"), lambda w: F.length(w) >= 4)
    plain = lambda t: F.lower(F.trim(t))
    says = lambda t, p: (t != "") & ~t.isin(*model.VACUOUS_TAGS) & (F.contains(t, F.lit(" ")) | ~F.array_contains(p, t))
    return let(places, lambda p: F.filter(tags, lambda t: says(plain(t), p)))


def implied_once(tags: Column) -> Column:
    """Tags with those that they imply directly: those of the first tag first, each tag's in the order of the rules."""
    implied = lambda t: F.array_compact(F.array(*(F.when(t.rlike("|".join(patterns)), F.lit(name)) for name, patterns in model.IMPLIED_TAGS.items())))
    return F.array_distinct(F.concat(tags, F.flatten(F.transform(tags, implied))))


def implier(passes: int) -> Callable[[Iterable], list]:
    """What implied_once gives after so many passes: only tags that are new in a pass can add others in the next. It looks at a tag once, while it
    is among the 65,536 latest, and names no helper of this module, which workers might not find."""
    rules = [(name, re.compile("|".join(p).replace("$", r"\Z"), re.ASCII)) for name, p in model.IMPLIED_TAGS.items()]
    seen = {}

    def directly(tag: str) -> tuple[str, ...]:
        if tag not in seen:
            if len(seen) >= 1 << 16:
                seen.clear()
            seen[tag] = tuple(name for name, rule in rules if rule.search(tag))
        return seen[tag]

    def run(tags: Iterable) -> list:
        out = dict.fromkeys(tags)
        new = list(out)
        for _ in range(passes):
            new = [x for x in dict.fromkeys(n for t in new if t is not None for n in directly(t)) if x not in out]
            out |= dict.fromkeys(new)
            if not new:
                break
        return list(out)

    return run


def implied(tags: Column, passes: int) -> Column:
    """Tags with all that they imply over so many passes of implied_once."""
    every = implier(passes)
    return F.pandas_udf(lambda lists: lists.map(lambda xs: None if xs is None else every(xs)), T.ArrayType(T.StringType()))(tags)


def completeness(image: Column, location: Column, link: Column, description: Column, tags: Column, cost: Column, start: Column) -> Column:
    """0 to 11: how much of a record is filled in."""
    has = lambda c, n: F.when(F.coalesce(c, F.lit("")) != "", n).otherwise(0)
    return (
        has(image, 2) + has(location, 2) + F.when(F.coalesce(link, F.lit("")) == "", 0).when(specific_link(link), 2).otherwise(1) + has(description, 1)
        + F.when(F.length(description) > 120, 1).otherwise(0) + F.when(F.size(tags) > 0, 1).otherwise(0)
        + F.when((F.coalesce(cost, F.lit("")) != "") & (cost != "See link"), 1).otherwise(0) + F.when(F.length(start) > 10, 1).otherwise(0)
    )


def specific_link(link: Column) -> Column:
    """Has a path or query beyond the root."""
    path, query = F.try_parse_url(link, F.lit("PATH")), F.try_parse_url(link, F.lit("QUERY"))
    return F.coalesce(F.regexp_replace(path, "/+$", "") != "", F.lit(False)) | F.coalesce(query != "", F.lit(False))


def place_text(location: Column) -> Column:
    """Lower case, all but a-z, 0-9 and single spaces dropped; "" if missing."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(location, F.lit(""))), "[^a-z0-9 ]", " "), " +", " "))


def acronym_match(a: Column, b: Column) -> Column:
    """Whether the first letters of three or more leading words of one text are a word of the other; words of 3 letters at least."""
    words = lambda x: F.filter(F.split(x, " "), lambda w: F.length(w) >= 3)
    initials = lambda x: F.array_join(F.transform(words(x), lambda w: F.substring(w, 1, 1)), "")
    heads = lambda x: F.transform(F.sequence(F.lit(3), F.greatest(F.length(initials(x)), F.lit(3))), lambda n: F.substr(initials(x), F.lit(1), n))
    return F.arrays_overlap(heads(a), words(b)) | F.arrays_overlap(heads(b), words(a))


def venues_agree(a: Column, b: Column, similarity: Column | None = None) -> Column:
    """Whether two place_text()s may be one place: a missing one, one inside the other, alike (their dice, if it isn't given), the same first two words, or an acronym."""
    first = lambda x: F.array_join(F.slice(F.split(x, " "), 1, 2), " ")
    inside = F.contains(a, b) | F.contains(b, a)
    return (a == "") | (b == "") | inside | ((dice(a, b) if similarity is None else similarity) > 0.6) | (first(a) == first(b)) | acronym_match(a, b)


def distinctive_title(title: Column) -> Column:
    """Four words or more."""
    return F.size(F.filter(F.split(title, " "), lambda w: w != "")) >= 4


def image_url(url: Column) -> Column:
    """https, with an image's extension before query and fragment."""
    return F.coalesce(url.rlike("^(?i)https://") & F.get(F.split(url, "[?#]"), 0).rlike(r"(?i)\.(jpe?g|png|webp|gif|avif)$"), F.lit(False))


def pref_tier(tags: Column, wanted: Column, unwanted: Column) -> Column:
    """-1 with an unwanted tag, else 1 with a wanted one, else 0. The lists may be null."""
    meets = lambda x: F.coalesce(F.arrays_overlap(tags, x), F.lit(False))
    return F.when(meets(unwanted), -1).when(meets(wanted), 1).otherwise(0)


def human_day(date: Column) -> Column:
    return F.date_format(date, "EEEE d MMM")
