"""Secret scans over a trigram inverted index.

From each rule's regular expression a Boolean trigram query is derived: an OR of alternatives, each an AND of trigrams
that every match of the alternative must hold. The index has a row for each trigram of any query and each text that
holds it, its posting; texts are named by a hash of their content, so copies share postings and a hash collision adds a
candidate at most. An alternative looks its trigrams' postings up and intersects them: the texts that are in all of them
are the candidates, and only those are matched against the rule's regular expression. Rules whose expression has no
mandatory trigram (long hexadecimal runs) scan every text. An index may be written once by postings() and given to later
scans of the same texts whose rules need no other trigrams.

Candidates meet the documents by text key and a salt, so the copies of one text are spread over SALTS tasks.

Main path: DataFrame functions only. Trigrams and masks fold case, which keeps them necessary for either case.

Cases: a null text is empty and has no spans; null and repeated doc_ids are rows like others; overlapping spans of
different kinds are all reported; an empty table gives no rows; other columns of any name are kept by redact() and
ignored by scan(). Offsets count code points, the end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as c
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import common


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0
    group: int = 0


RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
BASE = ("assign", "access", "hex")
#: For masking, the pem rule goes on to the END line, or without one over what follows in base64: runs of 24 characters or more, whole
#: lines of 8 or more, and a last shorter line. Groups repeat possessively, so blocks of any length are matched without recursion.
_PEM = next(r.pattern for r in RULES if r.kind == "pem")
_BASE64 = r"(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{24,}+={0,2}+|[\r\n]++[A-Za-z0-9+/]{8,}+={0,2}+(?![^\r\n]))++(?:[\r\n]++[A-Za-z0-9+/]{1,76}+={0,2}+(?![^\r\n]))?"
_KEY = rf"(?:(?:\s*(?:Proc-Type|DEK-Info):[^\r\n]*){{0,4}}(?:[^-]*-----END [A-Z ]*PRIVATE KEY-----|{_BASE64}))?"
MASKED = tuple(Rule(r.kind, r.pattern + _KEY) if r.kind == "pem" else r for r in RULES)
MOST_STRINGS = 64
FEW = 64
SALTS = 32
MASK = "[SECRET]"


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The alternatives of a pattern, each a set of trigrams in lower case; [] if a match may lack every trigram."""
    clauses: list[list[frozenset[str]]] = []

    def settle(strings: set[str]) -> None:
        sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
        if all(sets):
            clauses.append([s for s in dict.fromkeys(sets) if not any(o < s for o in sets)])

    def members(items) -> set[str] | None:
        out: set[str] = set()
        for op, value in items:
            if op == c.LITERAL:
                out.add(chr(value).lower())
            elif op == c.RANGE and value[1] - value[0] < 8:
                out |= {chr(x).lower() for x in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None

    def exact(tree) -> set[str] | None:
        """All strings that a tree matches, in lower case, if they are few."""
        out = {""}
        for op, value in tree:
            if op == c.LITERAL:
                more = {chr(value).lower()}
            elif op == c.IN:
                more = members(value)
            elif op == c.SUBPATTERN:
                more = exact(value[-1])
            elif op == c.BRANCH:
                parts = [exact(x) for x in value[1]]
                more = None if None in parts else set().union(*parts)
            elif op == c.MAX_REPEAT and value[1] == 1:
                more = exact(value[2])
                more = None if more is None else more | ({""} if value[0] == 0 else set())
            else:
                more = None
            if more is None or len(out) * len(more) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in more}
        return out

    now = {""}
    for node in parser.parse(pattern):
        more = exact([node])
        if more is not None and len(now) * len(more) <= MOST_STRINGS:
            now = {a + b for a in now for b in more}
        else:
            settle(now)
            now = more or {""}
    settle(now)
    return max(clauses, key=lambda x: min(map(len, x)), default=[])


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """trigram, text_key: one row for each of the trigrams that a text holds."""
    text = F.col("text").cast("string")
    low = docs.select(F.xxhash64(text).alias("text_key"), F.lower(text).alias("low"))  # a column of its own, else it is folded anew for every trigram
    held = F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams))  # no lambda around it, which would keep it out of generated code
    return low.select(F.explode(held).alias("trigram"), "text_key").filter("trigram is not null")


def lookups(rules: tuple[Rule, ...]) -> list[tuple[int, int, str, int]]:
    """(rule, alternative, trigram, trigrams of the alternative) of every rule's query."""
    return [(i, k, t, len(needed)) for i, rule in enumerate(rules) for k, needed in enumerate(trigram_query(rule.pattern)) for t in sorted(needed)]


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """text_key, rules: the bit mask of the rules whose query the text meets. Postings of each alternative's trigrams are looked up and intersected."""
    rows = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("rule", "alternative", "trigram", "needed"), x, strict=True))) for x in lookups(rules)))
    wanted = index.sparkSession.range(1).select(F.inline(rows))
    found = index.join(F.broadcast(wanted), "trigram")  # a row for each trigram of a rule, however many texts there are
    bit = F.element_at(F.array(*(F.lit(1 << i) for i in range(len(rules)))), F.col("rule") + 1)
    inside = found.groupBy("text_key", "rule", "alternative").agg(F.count_distinct("trigram").alias("held"), F.max("needed").alias("needed")).filter("held = needed")
    return inside.groupBy("text_key").agg(F.bit_or(bit).alias("rules"))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, kind number, end) of a rule's matches in a text, those that are long enough."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    between = F.split(text, rule.pattern, -1)
    steps = F.zip_with(F.zip_with(found, measured, lambda a, b: F.struct(F.length(a).alias("n"), F.length(b).alias("m"))), F.slice(between, 1, F.size(found)), lambda x, y: F.struct(x["n"].alias("n"), x["m"].alias("m"), F.length(y).alias("gap")))

    def placed(x: Column) -> Column:
        ends = common.running(F.transform(x, lambda y: (y["n"] + y["gap"]).cast("long")), lambda a, b: a + b, F.lit(0).cast("long"))
        every = F.zip_with(x, ends, lambda y, e: F.struct((e - y["n"]).alias("start"), F.lit(order).alias("kind"), e.alias("end"), y["m"].alias("m")))
        return F.transform(F.filter(every, lambda y: y["m"] >= rule.least), lambda y: F.struct(y["start"].alias("start"), y["kind"].alias("kind"), y["end"].alias("end")))

    return common.let(steps, placed)


def find(docs: DataFrame, kept: Column, rules: tuple[Rule, ...] = RULES, index: DataFrame | None = None) -> DataFrame:
    """row (the kept column), body (the text, null as empty) and found, the sorted spans of all rules. index: postings of these texts, made here if not given."""
    queries = [trigram_query(r.pattern) for r in rules]
    trigrams = sorted({t for q in queries for alternative in q for t in alternative})
    texts = docs.select(kept.alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    if trigrams:
        hits = candidates(postings(docs, trigrams) if index is None else index, rules)
        hits = hits.withColumn("hit_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        texts = texts.withColumns({"key": F.xxhash64("body"), "salt": (F.monotonically_increasing_id() % SALTS).cast("int")})
        texts = texts.join(hits.hint("shuffle_hash"), (F.col("key") == F.col("text_key")) & (F.col("salt") == F.col("hit_salt")), "left")
    else:
        texts = texts.withColumn("rules", F.lit(0))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    every = [spans(F.col("body"), r, i) if not q else F.when(F.col("rules").bitwiseAND(F.lit(1 << i)) != 0, spans(F.col("body"), r, i)).otherwise(none) for i, (r, q) in enumerate(zip(rules, queries, strict=True))]
    return texts.select("row", "body", F.sort_array(F.concat(*every)).alias("found"))


def _text_of(found: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[str, ...] = BASE) -> DataFrame:
    """One row per document: doc_id, n_<kind> of each base kind, base_sha256, spans."""
    numbers = {r.kind: i for i, r in enumerate(rules)}
    found = F.col("found")
    ours = [numbers[k] for k in base]
    of_kind = lambda i: F.filter(found, lambda x: x["kind"] == i)
    counts = [F.size(of_kind(numbers[k])).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(_text_of(F.filter(found, lambda x: x["kind"].isin(ours)), rules), 256)
    return find(docs, F.col("doc_id").cast("long"), rules).select(F.col("row").alias("doc_id"), *counts, digest.alias("base_sha256"), _text_of(found, rules).alias("spans"))


def _masked(body: Column, found: Column, mask: str) -> Column:
    """body with each of the sorted spans as the mask, spans that overlap as one. With many spans the text is cut into characters once, since finding a place in a text takes a walk."""
    few = lambda at, n: F.substring(body, (at + 1).cast("int"), n.cast("int"))

    def pieces(cut, reached: Column) -> Column:
        before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(reached, i - 1))
        gaps = F.transform(found, lambda x, i: F.when(x["start"] >= before(i), F.concat(cut(before(i), x["start"] - before(i)), F.lit(mask))).otherwise(F.lit("")))
        end = F.element_at(reached, -1)
        return F.concat(F.array_join(gaps, ""), cut(end, F.length(body).cast("long") - end))

    def joined(reached: Column) -> Column:
        many = common.let(F.split(body, ""), lambda chars: pieces(lambda at, n: F.array_join(F.slice(chars, (at + 1).cast("int"), n.cast("int")), ""), reached))
        return F.when(F.size(found) <= FEW, pieces(few, reached)).otherwise(many)

    return common.let(common.running(F.transform(found, lambda x: x["end"]), lambda a, b: F.greatest(a, b), F.lit(0).cast("long")), joined)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = MASKED, mask: str = MASK) -> DataFrame:
    """docs with every secret in text replaced by the mask, overlapping spans by one; n_chars follows the new text."""
    rows = find(docs, F.struct("*"), rules).withColumn("clean", F.when(F.size("found") > 0, _masked(F.col("body"), F.col("found"), mask)))
    out = []
    for name, kind in docs.dtypes:
        old = F.col("row")[name]
        new = {"text": F.col("clean"), "n_chars": F.length("clean").cast(kind)}.get(name)
        out.append((old if new is None else F.when(F.col("clean").isNotNull(), new).otherwise(old)).alias(name))
    return rows.select(*out)


def _oracle() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = []
    for i, r in enumerate(RULES):
        p = quoted(r.pattern)
        kinds.append(f"""SELECT row, {i} AS kind, '{r.kind}' AS name, list_sum(list_transform(gaps[1:k], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: length(x))), 0)::BIGINT AS start, length(hits[k]) AS n
FROM (SELECT row, hits, values_, gaps, unnest(range(1, len(hits) + 1)) AS k FROM (SELECT row, regexp_extract_all(body, {p}, 0) AS hits, regexp_extract_all(body, {p}, {r.group}) AS values_, string_split_regex(body, {p}) AS gaps FROM texts))
WHERE length(values_[k]) >= {r.least}""")
    return f"""WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body FROM documents),
spans AS ({" UNION ALL ".join(kinds)}),
joined AS (SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(name || ':' || start || ':' || (start + n), ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
  string_agg(name || ':' || start || ':' || (start + n), ',' ORDER BY start, kind) AS spans FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts LEFT JOIN joined USING (row)"""


ORACLE = _oracle()
