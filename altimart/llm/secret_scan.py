"""Secrets in texts, by a trigram inverted index; DataFrame expressions only."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart.llm.common import cut, spread_join
from altimart.llm.trigrams import ALWAYS, trigram_query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """A pattern; of its matches those stay whose ``group`` has ``least`` characters."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0


def either_case(text: str) -> str:
    """A pattern's letters A-Z in either case, and no other letter that Unicode folds to them."""
    return "".join(f"[{c.lower()}{c.upper()}]" if "a" <= c.lower() <= "z" else c for c in text)


# The shapes of secrets.
RULES = (
    Rule(
        "assign",
        f"({either_case('password|passwd|secret|token|api_?key')})"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]{20,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", "[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("map", "AIza[A-Za-z0-9_-]{30,}"),
    Rule("web", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("mail", r"[a-z]{2,12}://[A-Za-z0-9._-]+:[^\x20\x09-\x0D/@:]{6,}@[A-Za-z0-9.-]+"),
)


def _key(text: Column) -> Column:
    """Equal texts share a key.  Different ones may: they only become candidates together."""
    return F.xxhash64(text)


def _lookahead(trigrams: Sequence[str]) -> str:
    """A pattern that captures each of these trigrams at its place without consuming it."""
    by_first: dict[str, list[str]] = {}
    for t in sorted(trigrams):
        by_first.setdefault(t[0], []).append(t[1:])
    parts = [re.escape(c) + "(?:" + "|".join(map(re.escape, rest)) + ")" for c, rest in by_first.items()]
    return f"(?=({'|'.join(parts)}))"


def postings(docs: DataFrame, trigrams: Sequence[str], text_column: str = "text") -> DataFrame:
    """The inverted index: (trigram, key of a text that holds it), for the trigrams asked for.

    Trigrams of rules only: other ones are never looked up.  One pass over the text with A-Z in lower
    case; each row of docs gives a trigram at most once.
    """
    text = F.translate(F.coalesce(F.col(text_column), F.lit("")), UPPER, LOWER)
    if not trigrams:
        return docs.select(F.lit("").alias("trigram"), _key(F.col(text_column)).alias("key")).limit(0)
    held = F.array_distinct(F.regexp_extract_all(text, F.lit(_lookahead(trigrams)), F.lit(1)))
    return docs.select(F.explode(held).alias("trigram"), _key(F.col(text_column)).alias("key"))


def candidates(index: DataFrame, queries: dict[str, frozenset]) -> DataFrame:
    """(key, rules): the rules whose query the text fulfils, by intersecting postings.

    A set of a query is a row of the small table of wanted trigrams, which is as large as the rules
    and is broadcast.  Its trigrams are bits; a text's postings are combined by bitwise or, in each
    task first, and the text is in the intersection when all bits of the set are there.  So a list of
    postings is never held as a whole, however frequent its trigram.
    """
    wanted = [
        (rule, i, trigram, 1 << (bit % 62), bit // 62)
        for rule, query in queries.items()
        for i, trigrams in enumerate(sorted(map(sorted, query)))
        for bit, trigram in enumerate(trigrams)
    ]
    full: dict[tuple[str, int, int], int] = {}
    for rule, i, _, mask, word in wanted:
        full[rule, i, word] = full.get((rule, i, word), 0) | mask
    words = {(rule, i): 1 + max(w for r, j, w in full if (r, j) == (rule, i)) for rule, i, _ in full}
    spark = index.sparkSession
    terms = spark.createDataFrame(
        [(*w, full[w[0], w[1], w[4]], words[w[0], w[1]]) for w in wanted],
        "rule string, part int, trigram string, mask long, word int, whole long, words int",
    )
    met = (
        index.join(F.broadcast(terms), "trigram")
        .groupBy("key", "rule", "part", "word", "whole", "words")
        .agg(F.bit_or("mask").alias("met"))
        .where("met = whole")
        .groupBy("key", "rule", "part", "words")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n = words")
    )
    return met.groupBy("key").agg(F.collect_set("rule").alias("rules"))  # as many as there are rules


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """array<(start, place, kind, end)> of a rule's matches in one text, leftmost, not overlapping.

    The text split at the matches gives the gaps between them; sums of the lengths of gaps and
    matches are the places, in code points.
    """
    kind = "array<struct<start:int,place:int,kind:string,end:int>>"

    def placed(matches: Column) -> Column:
        gaps = F.split(text, rule.pattern, -1)
        groups = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1 + rule.group)) if rule.least else matches
        parts = F.arrays_zip(F.transform(matches, F.length).alias("m"), F.transform(F.slice(gaps, 1, F.size(matches)), F.length).alias("g"), F.transform(groups, F.length).alias("w"))
        walked = F.aggregate(
            parts,
            F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
            lambda state, p: F.struct(
                (state["at"] + p["g"] + p["m"]).alias("at"),
                F.when(
                    p["w"] >= rule.least,
                    F.concat(
                        state["out"],
                        F.array(
                            F.struct(
                                (state["at"] + p["g"]).alias("start"), F.lit(place).alias("place"),
                                F.lit(rule.name).alias("kind"), (state["at"] + p["g"] + p["m"]).alias("end"),
                            )
                        ),
                    ),
                ).otherwise(state["out"]).alias("out"),
            ),
            lambda state: state["out"],
        )
        return F.when(F.size(matches) > 0, walked).otherwise(F.array().cast(kind))

    # bound once, so that the search does not run again for each use of its result
    found = F.array(F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1)))
    return F.element_at(F.transform(found, placed), 1)


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    part = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, part), ",")


def secret_spans(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text_column: str = "text", spans_column: str = "spans"
) -> DataFrame:
    """All columns and the spans, array<(start, place, kind, end)>, by start, then by rule.

    Places are code points, the end exclusive; ``place`` is the number of the rule.  Matches of one
    rule are leftmost and do not overlap; those of different rules may.

    1. Each rule's pattern becomes a Boolean query of trigrams (``trigrams.trigram_query``).  The
       inverted index of these trigrams goes to the checkpoint folder.
    2. Postings are intersected to the candidates of each rule.  Rules without mandatory trigrams,
       such as runs of hex digits, have every text as a candidate.
    3. Candidates are joined back to the texts on a hash and verified: the pattern itself runs over
       the whole text of each candidate.  Copies share a hash; hot ones are spread.

    NULL counts as the empty text and has no spans.  Repeated rows each get their spans.  An empty
    table gives no rows.  A column of the result's name is an error; all other names are free.
    """
    if spans_column in docs.columns:
        raise ValueError(f"column {spans_column!r} exists; give the result another name")
    queries = {r.name: trigram_query(r.pattern) for r in rules}
    scans = {name for name, query in queries.items() if query & ALWAYS}
    lookups = {name: query for name, query in queries.items() if name not in scans}
    trigrams = sorted(set().union(*(s for q in lookups.values() for s in q)))
    found = candidates(cut(postings(docs, trigrams, text_column)), lookups)

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), _key(F.col(f"`{text_column}`")).alias("key"))
    text = F.coalesce(F.col("__row").getField(text_column), F.lit(""))
    asked = spread_join(packed, found, ["key"], F.monotonically_increasing_id(), "left")
    parts = []
    for place, rule in enumerate(rules):
        spans = _spans(text, rule, place)
        if rule.name not in scans:
            none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
            spans = F.when(F.array_contains("rules", rule.name), spans).otherwise(none)
        parts.append(spans)
    spans = F.array_sort(F.concat(*parts)) if parts else F.array()
    return asked.select("__row.*", spans.alias(spans_column))

