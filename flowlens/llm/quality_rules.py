"""Quality rules as a short-circuit cascade.

Each rule's cost and rejection rate are estimated on a bounded sample; the cascade then runs the rules with
the most rejections per cost first and stops at the first that rejects. The order changes the time, never the
verdict. Counts that are reported are taken from every whole text.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import sampled, text_of

#: Documents on which costs and rejections are estimated.
SAMPLE_DOCS = 1_000

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
NOT_LEADING = bytes(range(0x80, 0xC0))

MIN_WORDS = 50


class Text:
    """A text as UTF-8 bytes; what several rules need is computed when first asked for."""

    def __init__(self, data: bytes):
        self.data, self.words = data, data.split()
        self.n = len(self.words)

    def word_chars(self) -> int:
        return len(self.data.translate(None, SPACE + NOT_LEADING))

    def symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    def dup_lines(self) -> int:
        """Lines with a word that equal an earlier line."""
        lines = [x for x in self.data.split(b"\n") if x.strip()]
        return len(lines) - len(set(lines))

    def repeat_words(self) -> int:
        """Words inside a three-word window that occurs twice or more, its first time included."""
        if self.n < 4:
            return 0
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in self.words], "i8")
        _, pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
        _, window, times = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        again = times[window] > 1
        covered = np.zeros(self.n, bool)
        for k in range(3):
            covered[k:k + len(again)] |= again
        return int(covered.sum())


# A rule rejects a text when it returns True. Fixed thresholds.
RULES: dict[str, Callable[[Text], bool]] = {
    "symbols": lambda t: t.symbols() > 0.1 * t.n,
    "duplicate_lines": lambda t: t.dup_lines() > 0.5 * (t.data.count(b"\n") + 1),
    "word_length": lambda t: not 2 * t.n <= t.word_chars() <= 20 * t.n,
    "shouting": lambda t: sum(w.isupper() and len(w) > 1 for w in t.words) > 0.4 * t.n,
    "no_letters": lambda t: sum(w.isascii() and w.upper() == w.lower() for w in t.words) > 0.6 * t.n,
    "few_kinds": lambda t: len(set(t.words)) < 0.5 * t.n**0.5,
}


def estimate(docs: DataFrame, rules: dict[str, Callable[[Text], bool]], sample_docs: int = SAMPLE_DOCS) -> list[tuple]:
    """(rule, seconds a text, rejection rate) from a bounded sample of documents."""
    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, hit, n = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0
        for b in batches:
            for data in b.column(0).to_pylist():
                text, n = Text(data), n + 1
                for name, rule in rules.items():
                    begin = time.perf_counter()
                    hit[name] += bool(rule(text))
                    spent[name] += time.perf_counter() - begin
        yield pa.RecordBatch.from_pydict({
            "rule": list(rules), "seconds": [spent[r] for r in rules], "hits": pa.array([hit[r] for r in rules], pa.int64()),
            "n": pa.array([n] * len(rules), pa.int64())})

    sample = sampled(docs.select(text_of().cast("binary").alias("data")), sample_docs)
    rows = (sample.mapInArrow(trial, "rule string, seconds double, hits long, n long").groupBy("rule")
            .agg(F.sum("seconds").alias("s"), F.sum("hits").alias("h"), F.sum("n").alias("n")).collect())
    return sorted((r["rule"], r["s"] / max(1, r["n"]), r["h"] / max(1, r["n"])) for r in rows)


def ordered(estimates: list[tuple]) -> list[str]:
    """Rules by falling rejection per cost."""
    return [rule for rule, _, _ in sorted(estimates, key=lambda e: (-e[2] / max(e[1], 1e-9), e[0]))]


COLUMNS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, rejected_by string")


def quality(docs: DataFrame, rules: dict[str, Callable[[Text], bool]] | None = None,
            sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Counts of every text, and whether the base rules and the cascade keep it.

    ``rejected_by`` names the first rule that rejected; with measured costs it can differ between runs where
    several would. A NULL or empty text has no words and fails the base rules. Repeated rows each give a row;
    other columns are left out.
    """
    rules = RULES if rules is None else rules
    order = ordered(estimate(docs, rules, sample_docs))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for data in b.column(1).to_pylist():
                t = Text(data)
                repeats = t.repeat_words()
                why = "few_words" if t.n < MIN_WORDS else "repeated_windows" if 100 * repeats > 50 * t.n else None
                base = why is not None
                why = why or next((r for r in order if rules[r](t)), None)
                for col, v in zip(out, (t.n, t.word_chars(), t.symbols(), t.dup_lines(), repeats, base, why is None, why),
                                  strict=True):
                    col.append(v)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(out, kinds, strict=True)]],
                                             names=[c.split()[0] for c in COLUMNS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), text_of().cast("binary").alias("data")).mapInArrow(judge, COLUMNS)
