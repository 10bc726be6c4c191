"""Quality rules on repetition: characters inside repeated n-grams and lines.

Rolling hashes of several n-gram lengths are built over the word hashes of a
whole slice at once.  A window of n words can only be repeated if both windows
of n - 1 words inside it are, so each length looks at the survivors of the one
before.

Null and empty texts have no words and fail the base rule; a document is judged
by its own text alone, so ties, repeated rows and other columns play no part.
A text longer than a slice is a slice of its own.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapeworks.llm.arrays import (STEP, covered, flags, flat, grams, mix, repeats, slices,
                                  text_hashes, totals, words)
from tapeworks.llm.staging import identified

SLICE_BYTES = 2 << 20
# The symbols of the base figures.
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Largest shares of a document's word characters.

    ``top`` bounds the most frequent n-gram of a length, ``repeated`` the
    characters inside n-grams seen before, ``line_chars`` those of lines seen
    before.  Figures as published for web-text filters.  All rules count
    characters: one short line said twice doesn't make a bad document.
    """

    top: dict[int, float] = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    repeated: dict[int, float] = field(default_factory=lambda: {
        5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    line_chars: float = 0.20
    min_words: int = 10
    repeat_percent: int = 20


COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, base_failed boolean, dup_line_chars long, "
           "worst_ngram_share double, kept boolean")


def _lines(data, offsets, inside):
    """Starts, ends and text numbers of the lines that hold a word."""
    if not len(data):
        return data.astype(np.int64), data.astype(np.int64), data.astype(np.int64)
    breaks = np.flatnonzero(data == 10)
    some = offsets[:-1][offsets[1:] > offsets[:-1]]
    starts = np.union1d(breaks + 1, some)
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = np.where(data[ends - 1] == 10, ends - 1, ends)
    sums = np.concatenate(([0], np.cumsum(inside)))
    with_word = sums[ends] > sums[starts]
    starts, ends = starts[with_word], ends[with_word]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def measure(column, limits: Limits) -> dict[str, np.ndarray]:
    """The figures of every text of a column."""
    data, offsets = flat(column)
    n = len(offsets) - 1
    lead = (data & 0xC0) != 0x80
    starts, ends, doc = words(data, offsets)
    inside = ~flags((9, 10, 11, 12, 13, 32))[data]
    lead_sums = np.concatenate(([0], np.cumsum(lead & inside)))
    chars = lead_sums[ends] - lead_sums[starts]
    n_words = np.bincount(doc, minlength=n)
    out = {"n_words": n_words, "word_chars": totals(lead & inside, offsets),
           "n_symbols": totals(flags(SYMBOLS)[data], offsets)}

    salt = mix((doc.astype(np.uint64) + np.uint64(1)) * np.uint64(STEP))
    line_starts, line_ends, line_doc = _lines(data, offsets, inside)
    keys = mix(text_hashes(data, line_starts, line_ends)
               ^ ((line_doc.astype(np.uint64) + np.uint64(1)) * np.uint64(STEP)))
    _, later = repeats(keys)
    line_chars = lead_sums[line_ends] - lead_sums[line_starts]
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=n)
    out["dup_line_chars"] = np.bincount(
        line_doc[later], line_chars[later], minlength=n).astype(np.int64)

    total = np.maximum(out["word_chars"], 1)
    worst = np.zeros(n)
    values = text_hashes(data, starts, ends)
    at = np.arange(len(values))
    out["n_repeat_words"] = np.zeros(n, np.int64)
    for length in range(2, 11):
        at = at[at + length <= len(values)]
        at = at[doc[at] == doc[at + length - 1]]
        keys = mix(grams(values, length)[at] ^ salt[at]) if len(at) else np.zeros(0, np.uint64)
        twice, later = repeats(keys)
        if length in limits.top and twice.any():
            kinds, first, counts = np.unique(keys[twice], return_index=True, return_counts=True)
            one = at[twice][first]
            sums = np.concatenate(([0], np.cumsum(chars)))
            size = (sums[one + length] - sums[one]) * counts
            top = np.zeros(n, np.int64)
            np.maximum.at(top, doc[one], size)
            worst = np.maximum(worst, top / total / limits.top[length])
        if length in limits.repeated:
            hidden = covered(at[later], length, len(values))
            share = np.bincount(doc[hidden], chars[hidden], minlength=n) / total
            worst = np.maximum(worst, share / limits.repeated[length])
        if length == 5:
            hidden = covered(at[twice], length, len(values))
            out["n_repeat_words"] = np.bincount(doc[hidden], minlength=n)
        alive = np.zeros(len(values) + 1, bool)
        alive[at[twice]] = True
        at = np.flatnonzero(alive[:-1] & alive[1:])

    out["base_failed"] = (n_words < limits.min_words) | (
        100 * out["n_repeat_words"] > limits.repeat_percent * n_words)
    out["worst_ngram_share"] = worst
    bad_lines = out["dup_line_chars"] > limits.line_chars * total
    out["kept"] = ~(out["base_failed"] | bad_lines | (worst > 1.0))
    return out


def score(docs: DataFrame, limits: Limits = Limits(), *, with_text: bool = False) -> DataFrame:
    """Figures and verdict of each document; ``worst_ngram_share`` is relative to its limit."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    keep = ["doc_id", "text"] if with_text else ["doc_id"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                found = measure(part["text"], limits)
                yield pa.RecordBatch.from_arrays(
                    [part[k] for k in keep] + [pa.array(found[k]) for k in names], keep + names)

    schema = "doc_id long, " + ("text string, " if with_text else "") + COLUMNS
    return identified(docs).mapInArrow(judge, schema)


def kept_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    text = docs.columns.index("text")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                yield part.filter(pa.array(measure(part.column(text), limits)["kept"]))

    return docs.mapInArrow(sift, docs.schema)
