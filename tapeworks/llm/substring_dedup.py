"""Substring deduplication behind a count-min prefilter.

A window of ``width`` words is repeated if its word sequence starts anywhere
else.  Each window is represented by its seed: the leftmost smallest hash of the
``seed_words``-word runs inside it.  Equal windows have equal seeds at different
places, so the number of places of a seed bounds the count of each of its
windows from above.

1. Every chunk of documents makes a partial sketch of its seeds.  The partial
   sketches of one shard of the key space are merged, and the merged estimate
   (the smaller of two cells, never below the truth) goes back to the chunk.
2. Windows whose seed is estimated to be repeated, and only those, are grouped
   exactly by 128-bit hashes; a chunk sends each distinct window once.
3. Words covered by repeated windows are removed.

Sketches and shards are sized by the input; a hot window takes one entry for
each chunk.  Null and empty texts, and texts shorter than a window, keep all
their words; a text longer than a chunk is a chunk of its own.  Repeated rows are copies like any other: all of them lose the
shared windows.  doc_id may be null or repeated; it is only passed through.  An
empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.arrays import (covered, flat, grams, leftmost_minimum, mix, text_hashes, words)
from tapeworks.llm.staging import (ask, blob, chunked, ordered, shards_for, staged, tell)

WIDTH, SEED_WORDS = 35, 12
# Cells of each of a shard's two rows, and seeds for which that is enough.
CELLS, SEEDS_PER_SHARD = 1 << 20, 1 << 17
# Text bytes for each seed, on the low side: shards are sized by it.
BYTES_PER_SEED = 48
ASK = "shard int, chunk long, keys binary, counts binary"
ANSWER = "chunk long, shard int, bits binary"


class Windows:
    """Words, seeds and windows of one chunk."""

    def __init__(self, table: pa.Table, width: int, seed_words: int):
        self.data, self.offsets = flat(table["text"])
        self.starts, self.ends, self.doc = words(self.data, self.offsets)
        self.width = width
        self.values = text_hashes(self.data, self.starts, self.ends)
        at = np.arange(max(0, len(self.values) - width + 1))
        self.at = at[self.doc[at] == self.doc[at + width - 1]]
        runs = grams(self.values, seed_words)
        place = leftmost_minimum(runs, width - seed_words + 1)[self.at]
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1]
        # Seed number of each window, and each distinct seed with its places.
        self.seeds, which, counts = np.unique(runs[place[first]], return_inverse=True,
                                              return_counts=True)
        self.seed_of = which[np.cumsum(first) - 1] if len(place) else np.zeros(0, np.int64)
        self.seed_counts = np.minimum(counts, 2).astype(np.uint8)

    def candidates(self, repeated: np.ndarray):
        """Windows whose seed may be repeated: places, number of each distinct one, hashes, counts."""
        at = self.at[repeated[self.seed_of]]
        if not len(at):
            none = np.zeros(0, np.uint64)
            return at, np.zeros(0, np.int64), np.stack((none, none)), np.zeros(0, np.uint8)
        one = grams(self.values, self.width)[at]
        two = grams(text_hashes(self.data, self.starts, self.ends, 1), self.width, 1)[at]
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        head = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
        number = np.empty(len(at), np.int64)
        number[order] = np.cumsum(head) - 1
        counts = np.minimum(np.diff(np.append(np.flatnonzero(head), len(at))), 2)
        return at, number, np.stack((one[head], two[head])), counts.astype(np.uint8)


def by_shard(shard: np.ndarray):
    """Order of the keys by shard, and (shard, from, to) of each shard in it."""
    order = np.argsort(shard, kind="stable")
    ranked = shard[order]
    edges = np.flatnonzero(ranked[1:] != ranked[:-1]) + 1
    heads, stops = np.append(0, edges)[:len(ranked)], np.append(edges, len(ranked))[:len(ranked)]
    return order, [(int(ranked[a]), int(a), int(b)) for a, b in zip(heads, stops, strict=True)]


def questions(chunk: int, keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.Table:
    """One row for each shard, its keys (a column each) in the order of ``by_shard``."""
    order, spans = by_shard(shard)
    keys, counts = keys[:, order], counts[order]
    return pa.table({
        "shard": pa.array([s for s, _, _ in spans], pa.int32()),
        "chunk": pa.array([chunk] * len(spans), pa.int64()),
        "keys": pa.array([blob(keys[:, a:b]) for _, a, b in spans], pa.binary()),
        "counts": pa.array([blob(counts[a:b]) for _, a, b in spans], pa.binary())})


def answered(answers: pa.Table, shard: np.ndarray) -> np.ndarray:
    """The bit of each key, from the answers of its shards."""
    order, spans = by_shard(shard)
    out = np.zeros(len(shard), bool)
    bits = dict(zip(answers["shard"].to_pylist(), answers["bits"].to_pylist(), strict=True))
    for s, a, b in spans:
        out[order[a:b]] = np.unpackbits(np.frombuffer(bits[s], np.uint8), count=b - a)
    return out


def read_questions(table: pa.Table, kind):
    """Keys (two rows), counts and the number of keys in each question."""
    counts = [np.frombuffer(c, np.uint8) for c in table["counts"].to_pylist()]
    keys = [np.frombuffer(k, kind).reshape(2, -1) for k in table["keys"].to_pylist()]
    return (np.concatenate(keys, axis=1), np.concatenate(counts).astype(np.int64),
            [len(c) for c in counts])


def answers_for(table: pa.Table, hit: np.ndarray, sizes: list[int]) -> pa.Table:
    cuts = np.cumsum(sizes)[:-1]
    return pa.table({"chunk": table["chunk"], "shard": table["shard"],
                     "bits": pa.array([blob(np.packbits(h)) for h in np.split(hit, cuts)],
                                      pa.binary())})


def _cells(seeds: np.ndarray) -> np.ndarray:
    mixed = mix(seeds)
    return np.stack((mixed & np.uint64(CELLS - 1),
                     (mixed >> np.uint64(32)) & np.uint64(CELLS - 1))).astype(np.uint32)


def repeated_words(docs: DataFrame, width: int = WIDTH, seed_words: int = SEED_WORDS, *,
                   with_text: bool = False) -> DataFrame:
    """n_words, n_removed and digest of the kept words of each document."""
    spark = docs.sparkSession
    chunks = chunked(docs)
    total = chunks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = shards_for(total // BYTES_PER_SEED, SEEDS_PER_SHARD, spark)

    def seed_shards(found: Windows) -> np.ndarray:
        return (found.seeds % np.uint64(n_shards)).astype(np.int32)

    def sketch(table: pa.Table) -> pa.Table:
        found = Windows(ordered(table), width, seed_words)
        return questions(table["chunk"][0].as_py(), _cells(found.seeds), found.seed_counts,
                         seed_shards(found))

    def merge(table: pa.Table) -> pa.Table:
        cells, counts, sizes = read_questions(table, np.uint32)
        rows = [np.bincount(c, counts, minlength=CELLS) for c in cells]
        estimate = np.minimum(rows[0][cells[0]], rows[1][cells[1]])
        return answers_for(table, estimate >= 2, sizes)

    estimates = staged(ask(chunks, sketch, ASK).groupBy("shard").applyInArrow(merge, ANSWER),
                       "estimates").withColumn("step", F.lit(1))

    def window_shards(keys: np.ndarray) -> np.ndarray:
        return (keys[0] % np.uint64(n_shards)).astype(np.int32)

    def count(table: pa.Table, answers: pa.Table) -> pa.Table:
        found = Windows(ordered(table), width, seed_words)
        _, _, keys, counts = found.candidates(answered(answers, seed_shards(found)))
        return questions(table["chunk"][0].as_py(), keys, counts, window_shards(keys))

    def exact(table: pa.Table) -> pa.Table:
        keys, counts, sizes = read_questions(table, np.uint64)
        order = np.lexsort((keys[1], keys[0]))
        one, two = keys[0][order], keys[1][order]
        head = np.flatnonzero(np.concatenate(
            ([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]))))
        sums = np.add.reduceat(counts[order], head)
        hit = np.empty(len(order), bool)
        hit[order] = np.repeat(sums >= 2, np.diff(np.append(head, len(order))))
        return answers_for(table, hit, sizes)

    asked = tell(chunks, estimates.drop("step"), count, ASK)
    groups = asked.groupBy("shard").applyInArrow(exact, ANSWER).withColumn("step", F.lit(2))

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = ordered(table)
        found = Windows(table, width, seed_words)
        step = np.asarray(answers["step"])
        hot = answered(answers.filter(pa.array(step == 1)), seed_shards(found))
        at, number, keys, _ = found.candidates(hot)
        repeated = answered(answers.filter(pa.array(step == 2)), window_shards(keys))
        gone = covered(at[repeated[number]], width, len(found.values))
        n = table.num_rows
        removed = np.bincount(found.doc[gone], minlength=n)
        first = np.searchsorted(found.doc, np.arange(n + 1))
        raw, offsets = found.data.tobytes(), found.offsets.tolist()
        kept = []
        for i in range(n):
            parts = raw[offsets[i]:offsets[i + 1]].split()
            if removed[i]:
                parts = compress(parts, (~gone[first[i]:first[i + 1]]).tolist())
            kept.append(b" ".join(parts))
        out = {"doc_id": table["doc_id"], "n_words": pa.array(np.diff(first)),
               "n_removed": pa.array(removed),
               "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
        if with_text:
            out["kept_text"] = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.table(out)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return tell(chunks, estimates.unionByName(groups), cut,
                schema + (", kept_text string" if with_text else ""))
