"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: compatibility forms and accents go, look-alike letters
become Latin, digits and signs that stand for letters become letters, everything
else becomes a blank.  Lexicon entries are folded words (`` idiot ``) or word
beginnings (`` idio``), learned with their weights from labelled documents;
exceptions are phrases of two words around an entry that clean documents have,
and an entry inside one of them doesn't count.  The sum of weights is set
against the text's length, and a logistic curve makes it a score.

Learning uses at most ``SAMPLE`` labelled rows of each class, chosen by a hash of
doc_id; everything else runs over all documents.  Labels of one document that
contradict each other count as toxic; null labels are left out.

Null and empty texts have no match and get the score of a text without any.
Rows are scored one by one, so repeated rows and ties play no part; a text longer
than a slice is a slice of its own.  Without
labelled rows of both classes the lexicon is empty and all scores are equal.
An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.arrays import slices
from tapeworks.llm.staging import identified, staged

SAMPLE = 20_000
MAX_ENTRIES, MAX_PHRASES = 4_000, 4_000
PREFIX_CHARS = (3, 4, 5, 6)
MIN_DOCS, MIN_ODDS, MIN_PHRASES = 4, 2.0, 3
THRESHOLD = 0.3
SLICE_BYTES = 8 << 20
# Letters that look like Latin ones, and signs used in their place.
LOOKALIKES = dict(zip("аеорсухіјѕѵԁһкмтвнгзпиαβεηικμνορτυχωɡıɩʟ",
                      "aeopcyxijsvdhkmtbhrznuabehikmvoptuxwgiil", strict=True))
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
             "@": "a", "$": "s", "€": "e", "£": "l"}


class Fold(dict):
    """Translation table that fills itself: one letter for each character, or a blank."""

    def __missing__(self, code: int) -> str:
        letter = chr(code)
        out = LOOKALIKES.get(letter) or STAND_INS.get(letter)
        if out is None:
            plain = "".join(c for c in unicodedata.normalize("NFKD", letter.lower())
                            if not unicodedata.combining(c))
            plain = "".join(LOOKALIKES.get(c, c) for c in plain)
            marks = unicodedata.category(letter) in ("Mn", "Me", "Cf")
            out = plain if plain.isalpha() else "" if marks else " "
        self[code] = out
        return out


def folded(text: str | None, table: Fold) -> str:
    """The folded text with one blank around each word."""
    return f" {' '.join((text or '').lower().translate(table).split())} "


def entries_of(words: set[str]) -> set[str]:
    """Lexicon entries that a text's words could stand for."""
    out = {f" {w} " for w in words}
    for n in PREFIX_CHARS:
        out |= {f" {w[:n]}" for w in words if len(w) > n}
    return out


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: frozenset[str]
    curve: tuple[float, ...] = (-3.0, 1.0, 1.0, 1.0)

    def automaton(self):
        """All entries and phrases; None if there are none."""
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        if not len(found):
            return None
        found.make_automaton()
        return found


def hits(text: str, automaton) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the best entry in each word that no exception covers."""
    if automaton is None:
        return []
    best, shields = {}, []
    for end, (length, weight) in automaton.iter(text):
        start = end + 1 - length
        if weight is None:
            shields.append((start, end + 1))
        elif weight > best.get(start, (0, 0.0))[1]:
            best[start] = (end + 1, weight)
    return [(a, b, w) for a, (b, w) in best.items()
            if not any(s <= a and b <= e for s, e in shields)]


def measures(text: str, automaton) -> tuple[float, float, float]:
    """Weight for a hundred words, the largest weight, and the number of hits, all damped."""
    found = hits(text, automaton)
    total = sum(w for _, _, w in found)
    n_words = text.count(" ") - 1
    return (float(np.log1p(100.0 * total / max(n_words, 20))),
            max((w for _, _, w in found), default=0.0), float(np.log1p(len(found))))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.1] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge @ w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge
        w = w + np.linalg.solve(bend, slope)
    return tuple(float(v) for v in w)


def sample_of(labels: DataFrame, train: Column, size: int) -> DataFrame:
    """At most ``size`` training rows of each class, picked by a hash of doc_id."""
    one = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(train)
           .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    pick = [F.xxhash64("doc_id"), F.col("doc_id")]
    return (one.where("toxic = 1").orderBy(*pick).limit(size)
            .unionByName(one.where("toxic = 0").orderBy(*pick).limit(size)))


def learned(docs: DataFrame, labels: DataFrame, train: Column, size: int = SAMPLE) -> Lexicon:
    """Entries with weights, exceptions and the score's curve."""
    # At most 2 * size rows of two numbers.
    sample = F.broadcast(sample_of(labels, train, size))
    texts = staged(identified(docs).join(sample, "doc_id").select("text", "toxic"), "labelled")
    totals = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, frozenset())

    def spread(make):
        """Counts of ``make``'s keys by class, combined over each batch."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fold, state = Fold(), {}
            for batch in batches:
                counts: dict[str, list[int]] = {}
                for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(),
                                       strict=True):
                    for key in make(folded(text, fold), state):
                        counts.setdefault(key, [0, 0])[toxic] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()),
                     pa.array([c[1] for c in counts.values()], pa.int64()),
                     pa.array([c[0] for c in counts.values()], pa.int64())], ["key", "bad", "good"])
        return (texts.mapInArrow(run, "key string, bad long, good long").groupBy("key")
                .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))

    odds = (F.log((F.col("bad") + 0.1) / (n_toxic + 0.2))
            - F.log((F.col("good") + 0.1) / (n_clean + 0.2)))
    kept = (spread(lambda text, _: entries_of(set(text.split()))).withColumn("odds", odds)
            .where((F.col("bad") >= MIN_DOCS) & (F.col("odds") >= MIN_ODDS))
            .orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "key").limit(MAX_ENTRIES).collect())
    weights = {r.key: r.odds for r in kept}
    lexicon = Lexicon(weights, frozenset())

    def phrases(text: str, state: dict) -> set[str]:
        if "found" not in state:
            state["found"] = lexicon.automaton()
        out = set()
        for start, end, _ in hits(text, state["found"]):
            stop = text.index(" ", start + 1) + 1
            before = text.rfind(" ", 0, start) if start else -1
            after = text.find(" ", stop)
            if before >= 0:
                out.add(text[before:stop])
            if after > 0:
                out.add(text[start:after + 1])
        return out

    mild = (spread(phrases).where((F.col("good") >= MIN_PHRASES) & (odds < 0))
            .orderBy(F.desc("good"), "key").limit(MAX_PHRASES).collect())
    lexicon = Lexicon(weights, frozenset(r.key for r in mild))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, automaton = Fold(), lexicon.automaton()
        for batch in batches:
            rows = [measures(folded(t, fold), automaton) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r[k] for r in rows], pa.float64()) for k in range(3)), batch["toxic"]],
                ["rate", "most", "hits", "toxic"])

    # As many rows as the sample has, four numbers each.
    rows = texts.mapInArrow(measure, "rate double, most double, hits double, toxic int").toPandas()
    curve = fit(rows[["rate", "most", "hits"]].to_numpy(), rows["toxic"].to_numpy())
    return Lexicon(weights, lexicon.exceptions, curve)


def scored(docs: DataFrame, labels: DataFrame, train: Column, threshold: float = THRESHOLD) -> DataFrame:
    """Score and prediction of every document."""
    model = docs.sparkSession.sparkContext.broadcast(learned(docs, labels, train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, automaton, curve = Fold(), model.value.automaton(), np.array(model.value.curve)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                x = np.array([measures(folded(t, fold), automaton)
                              for t in part["text"].to_pylist()]).reshape(-1, 3)
                score = 1 / (1 + np.exp(-np.clip(curve[0] + x @ curve[1:], -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(score),
                     pa.array((score >= threshold).astype(np.int32))],
                    ["doc_id", "score", "predicted"])

    return identified(docs).mapInArrow(run, "doc_id long, score double, predicted int").select(
        "doc_id", (~train).alias("held_out"), "score", "predicted")
