"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insults and their stems are learned from labelled rows with a weight each, threats,
targets, negations and speech verbs are fixed lists. Three small transducers follow negation, reported speech
and targets inside a clause; their composition is one table that sorts every insult or threat into a reading
(plain, aimed at someone, negated, reported). Clauses are scored by the weights in each reading, and a
logistic model over a document's matched clauses gives its score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.common import crc_fold, materialize, sampled, text_of

#: Labelled rows that the lexicon and the weights are fitted on, and entries the lexicon may hold.
TRAIN_ROWS = 20_000
LEXICON = 4_096
PREFIXES = range(3, 10)
MIN_LOG_ODDS = 2.0
THRESHOLD = 0.7

# Fixed word lists.
THREATS = {"kill", "hurt", "destroy", "burn", "beat", "shoot", "stab", "die", "tuer", "frapper", "töten",
           "schlagen", "matar", "golpear"}
TARGETS = {"you", "your", "yours", "u", "he", "she", "they", "them", "tu", "toi", "vous", "du", "dich", "ihr",
           "euch", "tú", "usted", "ustedes"}
NEGATIONS = {"not", "no", "never", "without", "isn't", "aren't", "don't", "ne", "pas", "jamais", "nicht",
             "kein", "keine", "nie", "nunca", "jamás"}
SPEECH = {"said", "says", "told", "wrote", "claimed", "called", "quoted", "reported", "according", "dit",
          "sagte", "schrieb", "dijo", "llamó"}

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK = range(7)
READINGS = ("plain", "aimed", "negated", "reported", "threat")
#: Words a negation or a target reaches ahead.
REACH = 3

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")
BREAKS = ".!?;:\n"


def negation_machine(state: int, symbol: int) -> tuple[int, bool]:
    """Words still inside the reach of a negation; tells whether this word is."""
    if symbol == BREAK:
        return 0, False
    return (REACH if symbol == NEGATION else max(0, state - 1)), state > 0


def speech_machine(state: int, symbol: int) -> tuple[int, bool]:
    """Whether a speech verb has opened reported speech in this clause."""
    if symbol == BREAK:
        return 0, False
    return int(state or symbol == REPORT), bool(state)


def target_machine(state: int, symbol: int) -> tuple[int, bool]:
    """Words still inside the reach of a target."""
    if symbol == BREAK:
        return 0, False
    return (REACH if symbol == TARGET else max(0, state - 1)), state > 0


def compose() -> list[list[tuple[int, int]]]:
    """Table of the composed machine: by state and symbol, the next state and the reading or -1."""
    start, number, table = (0, 0, 0), {(0, 0, 0): 0}, []
    todo = [start]
    while todo:
        negated, told, aimed = todo.pop(0)
        row = []
        for symbol in range(7):
            (a, is_negated), (b, is_told), (c, is_aimed) = (
                negation_machine(negated, symbol), speech_machine(told, symbol), target_machine(aimed, symbol))
            if (nxt := (a, b, c)) not in number:
                number[nxt] = len(number)
                todo.append(nxt)
            reading = -1
            if symbol in (INSULT, THREAT):
                reading = 2 if is_negated else 3 if is_told else 4 if symbol == THREAT else 1 if is_aimed else 0
            row.append((number[nxt], reading))
        table.append(row)
    return table


FIXED = ({w: (NEGATION, 0.0) for w in NEGATIONS} | {w: (REPORT, 0.0) for w in SPEECH}
         | {w: (TARGET, 0.0) for w in TARGETS} | {w: (THREAT, 3.0) for w in THREATS} | {b: (BREAK, 0.0) for b in BREAKS})

#: What most words are, and the words a worker keeps.
NEUTRAL, KNOWN_WORDS = (OTHER, 0.0), 100_000


@dataclass
class Grammar:
    """Lexicon weights ("=" marks whole words, others are prefixes), machine, and model weights."""

    lexicon: dict[str, float]
    table: list[list[tuple[int, int]]] = field(default_factory=compose)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    _known: dict[str, tuple[int, float]] = field(default_factory=dict)

    def symbol(self, word: str) -> tuple[int, float]:
        """Symbol and weight of a token; a bounded cache of tokens met so far."""
        got = self._known.get(word)
        if got is None:
            low = word.lower()
            got = FIXED.get(low)
            if got is None or got[0] not in (BREAK,):
                w = max([self.lexicon.get("=" + low, 0.0), *(self.lexicon.get(low[:k], 0.0) for k in PREFIXES if k <= len(low))])
                got = (INSULT, w) if w > 0 and got is None else got or NEUTRAL
            if len(self._known) > KNOWN_WORDS:
                self._known.clear()
            self._known[word] = got
        return got

    def clauses(self, text: str) -> tuple[list[list[float]], int, int]:
        """Weights by reading of every matched clause, the number of clauses and of words."""
        state, matched, clauses, words, clause = 0, [], 0, 0, None
        known, table = self._known.get, self.table
        for token in TOKEN.findall(text):
            symbol, weight = known(token) or self.symbol(token)
            state, reading = table[state][symbol]
            if symbol == BREAK:
                clauses += 1
                if clause:
                    matched.append(clause)
                    clause = None
                continue
            words += 1
            if reading >= 0:
                clause = clause or [0.0] * len(READINGS)
                clause[reading] += weight
        if clause:
            matched.append(clause)
        return matched, clauses + 1, words

    def features(self, text: str) -> list[float]:
        matched, clauses, words = self.clauses(text)
        if not matched:
            return [0.0] * (len(READINGS) + 4)
        sums = np.sum(matched, axis=0)
        tops = max(sum(c) for c in matched)
        return [*np.log1p(sums).tolist(), float(np.log1p(sums.sum())), tops, float(sums.sum() / max(1, words) * 10),
                len(matched) / clauses]

    def score(self, rows: list[list[float]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        x = (np.array(rows) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))


def word_features(text: str) -> set[str]:
    """Whole words and prefixes of a text, in lower case."""
    out = set()
    for w in {t.lower() for t in TOKEN.findall(text) if t not in BREAKS}:
        out.add("=" + w)
        out.update(w[:k] for k in PREFIXES if k < len(w))
    return out


def learn_lexicon(train: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Log-odds of words and prefixes that toxic rows use more; ``train`` has text and toxic.

    Words of toxic rows are counted first, then only those that several such rows share in the other rows.
    """
    def counts(df: DataFrame, wanted) -> DataFrame:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            keep = None if wanted is None else wanted.value
            for b in batches:
                for t in b.column(0).to_pylist():
                    f = word_features(t)
                    seen.update(f if keep is None else f & keep)
            yield pa.RecordBatch.from_pydict({"f": pa.array(list(seen), pa.string()), "n": pa.array(seen.values(), pa.int64())})

        return df.select("text").mapInArrow(count, "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))

    totals = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    least = max(3, toxic // 200)
    found = {r["f"]: r["n"] for r in counts(train.where("toxic = 1"), None).where(F.col("n") >= least).collect()}
    wanted = train.sparkSession.sparkContext.broadcast(frozenset(found))
    other = {r["f"]: r["n"] for r in counts(train.where("toxic = 0"), wanted).collect()}
    odds = {f: np.log((n + 0.5) / (toxic + 1)) - np.log((other.get(f, 0) + 0.5) / (clean + 1)) for f, n in found.items()}
    best = sorted((f for f in odds if odds[f] >= MIN_LOG_ODDS), key=lambda f: (-odds[f] * found[f], f))[:size]
    return {f: float(odds[f]) for f in best}


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights of a ridge logistic model, by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, penalty = np.zeros(z.shape[1]), np.r_[1e-6, np.full(x.shape[1], ridge)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Grammar:
    """Learn lexicon and weights from a bounded sample of labelled rows outside the held-out third.

    Weights meet each half of the rows with the lexicon of the other half, as unseen rows are met; the lexicon
    that is kept comes from both.
    Labels that are NULL are left out; a row with two labels counts as toxic. Without labelled rows of both
    kinds the lexicon is empty and every score is the share of toxic rows.
    """
    known = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .where(crc_fold() != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = F.broadcast(sampled(known, rows))  # at most about ``rows`` pairs of numbers
    train = materialize(docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).join(chosen, "doc_id")
                        .withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2))), "toxicity-train")
    grammar = Grammar(learn_lexicon(train))
    crossed = [Grammar(learn_lexicon(train.where(f"half = {1 - half}"))) for half in (0, 1)]

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)
            yield pa.RecordBatch.from_pydict({
                "x": pa.array([crossed[half].features(t) for t, half in rows], pa.list_(pa.float64())),
                "y": b.column(1).cast(pa.int32())})

    got = train.select("text", "toxic", "half").mapInArrow(described, "x array<double>, y int").toPandas()
    if got["y"].nunique() < 2:
        share = float(got["y"].mean()) if len(got) else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        k = len(READINGS) + 4
        grammar.mean, grammar.scale, grammar.weights = np.zeros(k), np.ones(k), np.r_[np.log(share / (1 - share)), np.zeros(k)]
    else:
        order = np.lexsort((*np.stack(got["x"]).T, got["y"]))  # rows come in any order; sums should not
        grammar.mean, grammar.scale, grammar.weights = fit_weights(np.stack(got["x"])[order], got["y"].to_numpy(float)[order])
    grammar._known = {}
    return grammar


def scorer(spark: SparkSession, grammar: Grammar):
    """The score of a text column; the bounded grammar is broadcast, and each worker keeps one copy of it."""
    shared = spark.sparkContext.broadcast(grammar)

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score([shared.value.features(t) for t in text]), dtype="float64")

    return lambda column="text": scored(text_of(column))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold."""
    return docs.where(scorer(docs.sparkSession, fit(docs, labels))() < threshold)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    NULL and empty texts get the score of a text without matches; repeated rows each give a row; other
    columns, lang and source among them, are never read.
    """
    value = scorer(docs.sparkSession, fit(docs, labels))()
    return (docs.select(F.col("doc_id").cast("long"), value.alias("score"))
            .select("doc_id", (crc_fold() == 1).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
