"""Quality rules as a short-circuit cascade.

Every rule is a cheap test on a document's text. Their costs (seconds) and
rejection rates are estimated on a bounded sample of documents; the rules are
then run in the order of rejections per cost, and a document stops at the first
rule that rejects it. A document is kept when no rule rejects it, so the verdict
does not depend on the order, which only decides how much work is done.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import WORD, Words, row_chunks, text_of, window_hashes

SYMBOLS = b"#*$%&|<>"
SAMPLE_ROWS = 2000
_BLANK = " \t\n\v\f\r"
_BULLETS = ("•", "-", "*", "●")
_WORDS = re.compile(WORD)
_LETTER = regex.compile(r"\p{L}")


class Doc:
    """One document: its text and the counts that every rule may use."""

    __slots__ = ("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def __init__(self, text: str, n_words: int, word_chars: int, n_symbols: int, n_dup_lines: int, n_repeat_words: int):
        self.text, self.n_words, self.word_chars = text, n_words, word_chars
        self.n_symbols, self.n_dup_lines, self.n_repeat_words = n_symbols, n_dup_lines, n_repeat_words


def _lines(text: str) -> list[str]:
    return [x for x in text.split("\n") if x.strip(_BLANK)]


def too_many_symbols(d: Doc) -> bool:
    return 10 * d.n_symbols > 3 * d.n_words


def odd_word_length(d: Doc) -> bool:
    return not 2 * d.n_words <= d.word_chars <= 20 * d.n_words


def repeated_lines(d: Doc) -> bool:
    return 2 * d.n_dup_lines > len(_lines(d.text))


def few_letters(d: Doc) -> bool:
    """Fewer than half of the words have a letter."""
    return 2 * sum(1 for w in _WORDS.findall(d.text) if _LETTER.search(w)) < d.n_words


def bullet_list(d: Doc) -> bool:
    lines = _lines(d.text)
    return len(lines) > 1 and 10 * sum(1 for x in lines if x.lstrip(_BLANK).startswith(_BULLETS)) > 9 * len(lines)


def cut_lines(d: Doc) -> bool:
    lines = _lines(d.text)
    return 2 * sum(1 for x in lines if x.rstrip(_BLANK).endswith(("...", "…"))) > len(lines)


def one_word_rules_all(d: Doc) -> bool:
    """One word makes up more than 40 % of the text."""
    words = _WORDS.findall(d.text)
    return bool(words) and 10 * Counter(words).most_common(1)[0][1] > 4 * len(words)


#: Rules in no particular order; the cascade orders them.
RULES: dict[str, Callable[[Doc], bool]] = {
    f.__name__: f for f in (too_many_symbols, odd_word_length, repeated_lines, few_letters, bullet_list, cut_lines, one_word_rules_all)
}


def base_failed(d: Doc) -> bool:
    return d.n_words < 50 or 100 * d.n_repeat_words > 50 * d.n_words


def measured(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[Doc]]]:
    """Slices of a batch with (doc_id, text) and the counts of their documents."""
    for part, buf, offs in row_chunks(batch, "text"):
        words = Words(buf, offs)
        hashes = words.hashes()
        length = words.end - words.start
        # bytes that begin a code point, and symbols, summed up to each byte
        begins = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        symbols = np.concatenate(([0], np.cumsum(symbol[words.data])))
        chars = np.concatenate(([0], np.cumsum(begins[words.end] - begins[words.start]))) if len(length) else np.zeros(1, np.int64)
        lo_byte, docs = 0, []
        for text, lo, hi, end in zip(part.column(1).to_pylist(), words.first, words.first[1:], words.doc_end):
            text = text or ""
            lines = _lines(text)
            docs.append(Doc(text, int(hi - lo), int(chars[hi] - chars[lo]), int(symbols[end] - symbols[lo_byte]), len(lines) - len(set(lines)), _repeated(hashes[lo:hi])))
            lo_byte = end
        yield part, docs


def _repeated(words: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    windows = window_hashes(words, 3)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(windows)] |= twice
    return int(inside.sum())


def estimate_order(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per second, measured on a sample of about ``sample_rows`` documents.

    The sample is uniform (a share of the rows from their count), so its size
    does not grow with the table.
    """
    total = docs.count()
    if not total:
        return sorted(RULES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected, seen = dict.fromkeys(RULES, 0.0), dict.fromkeys(RULES, 0), 0
        for batch in batches:
            for _, found in measured(batch):
                passed = [d for d in found if not base_failed(d)]
                seen += len(passed)
                for name, rule in RULES.items():
                    began = time.perf_counter()
                    rejected[name] += sum(map(rule, passed))
                    spent[name] += time.perf_counter() - began
        names = sorted(RULES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([seen] * len(names), pa.int64()), pa.array([rejected[n] for n in names], pa.int64()), pa.array([spent[n] for n in names])],
            ["rule", "seen", "rejected", "spent"],
        )

    share = min(1.0, sample_rows / total)
    rows = docs.sample(share, seed=4).mapInArrow(run, "rule string, seen long, rejected long, spent double").groupBy("rule").agg(
        F.sum("seen").alias("seen"), F.sum("rejected").alias("rejected"), F.sum("spent").alias("spent")
    ).collect()  # one row per rule
    # half a rejection and a nanosecond are added so that no rule has none
    return [r.rule for r in sorted(rows, key=lambda r: (-(r.rejected + 0.5) / (r.spent + 1e-9), r.rule))]


_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string, rules_run int"


def quality(docs: DataFrame, order: list[str] | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: the counts, the base verdict, the verdict of the cascade.

    ``rejected_by`` is the first rule in the estimated order that rejected the
    document (null if none did or the base verdict is negative); ``rules_run``
    is the number of rules tried. A null text counts as empty, and an empty text
    fails the base verdict. Null and repeated ids pass through. An empty table
    gives an empty result.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    order = estimate_order(plain) if order is None else order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = [(name, RULES[name]) for name in order]
        for batch in batches:
            for part, found in measured(batch):
                out: list[list] = [[] for _ in range(9)]
                for d in found:
                    failed, by, tried = base_failed(d), None, 0
                    if not failed:
                        for name, rule in cascade:
                            tried += 1
                            if rule(d):
                                by = name
                                break
                    for column, value in zip(out, (d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words, failed, not failed and by is None, by, tried)):
                        column.append(value)
                kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string(), pa.int32()]
                names = [x.split()[0] for x in _SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names)

    return plain.mapInArrow(run, _SCHEMA)
