"""Secret scans through a trigram inverted index.

1. From each rule's regular expression a Boolean query over lower-cased trigrams
   is derived: an OR of alternatives, each an AND of the trigrams that any match
   must contain.
2. One pass over the texts writes the postings (trigram, document) of the
   trigrams that occur in some query - at most a few dozen rows per document.
3. Each alternative intersects the postings of its trigrams; documents in the
   intersection are candidates of the rule.
4. Candidates are verified with the regular expression, which gives the spans. A
   rule that has an alternative without trigrams cannot use the index and scans
   every text.

Only DataFrame and SQL functions run on the data; the queries over trigrams are
derived on the driver from the rules alone.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import text_of, written


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping; those whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base rules, then further well-known token formats.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
)


# ---------------------------------------------------------------- trigram queries

#: Character classes of up to so many characters are written out as alternatives.
SMALL_CLASS = 8


def _expansions(nodes) -> list[str]:
    """Strings that stand for a sequence of regex nodes; a NUL stands for anything."""
    out = [""]
    for op, value in nodes:
        if op is sre.LITERAL:
            found = [chr(value).lower()]
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in value) and len(value) <= SMALL_CLASS:
            found = list(dict.fromkeys(chr(v).lower() for _, v in value))
        elif op is sre.SUBPATTERN:
            found = _expansions(value[-1])
        elif op is sre.BRANCH:
            found = [x for branch in value[1] for x in _expansions(branch)]
        elif op is sre.MAX_REPEAT and value[:2] == (0, 1):
            found = ["", *_expansions(value[2])]
        elif op is sre.MAX_REPEAT and value[0] > 0:
            once = _expansions(value[2])
            found = [x * value[0] + ("" if value[0] == value[1] else "\0") for x in once] if len(once) == 1 else ["\0"]
        elif op is sre.AT:
            found = [""]
        else:
            found = ["\0"]
        out = list(dict.fromkeys(a + b for a in out for b in found))
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The alternatives, each a set of trigrams that a match contains; None if some match need contain none."""
    found = set()
    for text in _expansions(sre_parser.parse(pattern)):
        grams = frozenset(run[i : i + 3] for run in text.split("\0") for i in range(len(run) - 2))
        if not grams:
            return None
        found.add(grams)
    # an alternative that asks for more than another one adds nothing
    return sorted((x for x in found if not any(y < x for y in found)), key=sorted)


# ---------------------------------------------------------------- index


def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """(trigram, key) of every document of ``docs`` (key, text) that contains one of ``trigrams``, case ignored."""
    lowered = docs.select("key", F.lower("text").alias("low"))
    present = F.filter(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]), lambda t: t.isNotNull())
    return lowered.select("key", F.explode(present).alias("trigram")).select("trigram", "key")


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(key, kinds): the kinds of rules of which a document has all trigrams of some alternative."""
    rows, number = [], 0
    for kind, alternatives in queries.items():
        for grams in alternatives:
            number += 1
            rows += [(kind, number, g, 1 << i, (1 << len(grams)) - 1) for i, g in enumerate(sorted(grams))]
    clauses = index.sparkSession.createDataFrame(rows, "kind string, alternative int, trigram string, bit long, whole long")
    met = (
        index.join(F.broadcast(clauses), "trigram")  # as many rows as the rules have trigrams
        .groupBy("key", "kind", "alternative", "whole").agg(F.bit_or("bit").alias("bits"))
        .where("bits = whole")
    )
    return met.groupBy("key").agg(F.collect_set("kind").alias("__kinds"))


# ---------------------------------------------------------------- verification

#: Matches whose positions are summed up together.
BLOCK = 256


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """array<struct<start, place, end>> of the rule's matches in code points.

    The gaps between the matches and the matches themselves alternate; their
    lengths summed up give the positions. The sum runs within blocks of ``BLOCK``
    matches and then over the blocks, as appending to an array copies it: the
    work is linear in the matches, not quadratic.
    """
    pattern = F.lit(rule.pattern)
    matches = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
        F.split(text, rule.pattern, -1).alias("gap"),
    )
    span = "struct<start:int,place:int,end:int,size:int>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("found"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.coalesce(F.length(part["whole"]), F.lit(0))
        found = F.struct(begin.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.coalesce(F.length(part["value"]), F.lit(-1)).alias("size"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(found)).alias("found"))

    def blocks(parts: Column) -> Column:  # each with the positions of its own beginning
        return F.transform(F.sequence(F.lit(1), F.size(parts), F.lit(BLOCK)), lambda first: F.aggregate(F.slice(parts, first, BLOCK), start, step))

    def begins(done: Column) -> Column:  # where each block begins: the lengths of those before it
        sums = F.aggregate(done, F.array(F.lit(0)), lambda ends, block: F.concat(ends, F.array(F.element_at(ends, -1) + block["at"])))
        return F.slice(sums, 1, F.size(done))

    def moved(done: Column) -> Column:
        def shift(block: Column, by: Column) -> Column:
            # the last gap has no match behind it: size -1
            kept = F.filter(block["found"], lambda s: s["size"] >= rule.least)
            return F.transform(kept, lambda s: F.struct((s["start"] + by).alias("start"), s["place"], (s["end"] + by).alias("end")))

        return F.flatten(F.zip_with(done, begins(done), shift))

    # an expression is evaluated anew wherever a lambda uses it, a lambda's variable is not
    placed = F.transform(F.array(matches), blocks)
    return F.transform(placed, moved)[0]


def _shortest(rule: Rule) -> Rule:
    """The rule with its least length in the pattern, where that finds the same matches.

    True for a pattern that ends in a repeated class and is dropped by its whole
    length: a shorter match is a whole run, inside which no longer one can begin.
    """
    if rule.group or not rule.least or not rule.pattern.endswith("]+"):
        return rule
    fixed = rule.pattern.index("[")
    return Rule(rule.kind, f"{rule.pattern[:-1]}{{{rule.least - fixed},}}", 0, rule.least)


def _joined(spans: Column, kinds: Sequence[str]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["place"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, base: Sequence[Rule] = BASE, more: Sequence[Rule] = MORE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` plus ``secret_counts`` (matches of each base rule, in order),
    ``secret_base`` and ``secret_spans`` (``kind:start:end`` of the base rules' and of all matches,
    by start, then kind in the order of the rules, joined by commas).

    Positions are code points, the end exclusive. A null text counts as empty
    and has no match. Null ids and repeated rows are treated as any other row. An
    empty table gives an empty result.
    """
    rules = [*base, *more]
    kinds = [r.kind for r in rules]
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not None}
    keyed = docs.withColumns({"__text": text_of(text)}).withColumn("__key", F.xxhash64(F.col(doc_id), "__text"))
    grams = sorted({g for q in indexed.values() for a in q for g in a})
    index = written(postings(keyed.select(F.col("__key").alias("key"), F.col("__text").alias("text")), grams), "secret-postings")
    found = candidates(index, indexed).select(F.col("key").alias("__key"), "__kinds")
    joined = keyed.join(found, "__key", "left")

    def spans(place: int) -> Column:
        rule = _shortest(rules[place])
        hit = F.array_contains("__kinds", rule.kind) if rule.kind in indexed else F.size(F.regexp_extract_all("__text", F.lit(rule.pattern), F.lit(0))) > 0
        return F.when(hit, _spans(F.col("__text"), rule, place)).otherwise(F.array().cast("array<struct<start:int,place:int,end:int>>"))

    of_rule = {f"__spans{i}": spans(i) for i in range(len(rules))}
    names = list(of_rule)
    scanned = joined.withColumns(of_rule)
    return scanned.withColumns({
        "secret_counts": F.array(*[F.size(c).cast("long") for c in names[: len(base)]]),
        "secret_base": _joined(F.array_sort(F.concat(*names[: len(base)])), kinds),
        "secret_spans": _joined(F.array_sort(F.concat(*names)), kinds),
    }).drop("__key", "__text", "__kinds", *names)
