"""Lexical retrieval packing: each window is filled with its seed's BM25 neighbours.

1. Texts become token ids and one end id.  Whole windows of a long document are
   sequences of their own; what is left of it, less than a window, goes on with
   the counts of its distinct tokens, but without the ids: the checksum of every
   ``STEP``-token mark is enough to cut it later.
2. Remainders are ordered by the smallest hashes of their tokens, so that texts
   with like words lie close, and cut into shards of bounded size.  Equal keys
   are told apart by doc_id and row, so no key is too hot for a shard.
3. Each shard has its own inverted index with BM25 weights.  The first unused
   remainder is the seed; its unused neighbours fill the window, best first, and
   where they run out the next unused remainders do.  A remainder that doesn't
   fit is cut at a mark and its rest stays in the shard.

A null text is empty and consists of its end id.  doc_id may be null or repeated;
each row is packed once.  Neighbours of equal weight come in the shard's order.  A
text longer than a slice is a slice of its own.  An empty table gives an empty result; other columns
play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.arrays import STEP as GOLDEN
from tapeworks.llm.arrays import mix, slices
from tapeworks.llm.bpe import Encoder, Vocabulary
from tapeworks.llm.staging import blob, identified, partitions, staged

WINDOW, STEP = 2048, 32
END_ID = 1
SLICE_BYTES = 4 << 20
SHARD_TOKENS = 2 << 20
# Terms of a seed that are looked up, rarest first, and BM25's two constants.
QUERY_TERMS, K1, B = 12, 1.2, 0.75
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
PREPARED = ("doc_id long, row long, start long, length long, crc long, doc_tokens long, "
            "key1 long, key2 long, marks binary, terms binary, counts binary")


# Checksums of parts from checksums of prefixes ---------------------------------

# Fixed value: the CRC-32 polynomial, bits reversed.
POLYNOMIAL = 0xEDB88320


def times(a: int, b: int) -> int:
    """Product of two polynomials modulo the checksum's."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


class Shift:
    """Moves a checksum past a number of bytes."""

    def __init__(self):
        self.squares = [1 << 23]           # x ** 8
        self.known: dict[int, int] = {}

    def factor(self, n: int) -> int:
        if n not in self.known:
            out, k = 1 << 31, 0
            rest = n
            while rest:
                if k == len(self.squares):
                    self.squares.append(times(self.squares[-1], self.squares[-1]))
                if rest & 1:
                    out = times(out, self.squares[k])
                rest, k = rest >> 1, k + 1
            self.known[n] = out
        return self.known[n]

    def part(self, before: int, whole: int, n_bytes: int) -> int:
        """Checksum of the last ``n_bytes`` of a text, from those of the start and of all."""
        return whole ^ times(self.factor(n_bytes), before)


# Tokens ------------------------------------------------------------------------

def marks_of(ids: np.ndarray) -> list[int]:
    """Checksums of the first 0, STEP, 2 * STEP ... ids and of all."""
    raw, out, crc = ids.astype("<u4").tobytes(), [0], 0
    for a in range(0, len(raw), 4 * STEP):
        crc = zlib.crc32(raw[a:a + 4 * STEP], crc)
        out.append(crc)
    return out


def prepare(batches: Iterator[pa.RecordBatch], vocab: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Whole windows (marks null) and remainders of each document."""
    encoder, number = Encoder(vocab), TaskContext.get().partitionId() << 40
    names = [c.split()[0] for c in PREPARED.split(", ")]
    for batch in batches:
        for part in slices(batch, SLICE_BYTES):
            ids, ends = encoder.encode(part["text"])
            out: dict[str, list] = {k: [] for k in names}
            for i, doc_id in enumerate(part["doc_id"].to_pylist()):
                own = np.append(ids[ends[i]:ends[i + 1]], END_ID)
                n, cut = len(own), len(own) // WINDOW * WINDOW
                for a in range(0, cut, WINDOW):
                    crc = zlib.crc32(own[a:a + WINDOW].astype("<u4").tobytes())
                    for k, v in zip(names, (doc_id, number, a, WINDOW, crc, n, 0, 0, None, None, None),
                                    strict=True):
                        out[k].append(v)
                if cut < n:
                    rest = own[cut:]
                    terms, counts = np.unique(rest, return_counts=True)
                    # The end id is in every text and says nothing about it.
                    telling = terms[terms != END_ID] if len(terms) > 1 else terms
                    hashes = mix(telling.astype(np.uint64) * np.uint64(GOLDEN))
                    keys = [int(h.min() >> np.uint64(1)) for h in (hashes, mix(hashes))]
                    for k, v in zip(names, (
                            doc_id, number, cut, n - cut, 0, n, *keys,
                            blob(np.array(marks_of(rest), np.uint32)), blob(terms.astype(np.uint32)),
                            blob(np.minimum(counts, 65535).astype(np.uint16))), strict=True):
                        out[k].append(v)
                number += 1
            kinds = {"long": pa.int64(), "binary": pa.binary()}
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [(c.split()[0], kinds[c.split()[1]]) for c in PREPARED.split(", ")]))


# A shard -----------------------------------------------------------------------

@dataclass
class Shard:
    """Remainders of one shard, in order."""

    rows: list[dict] = field(default_factory=list)
    tokens: int = 0

    def add(self, row: dict) -> None:
        self.rows.append(row)
        self.tokens += row["length"]


class Index:
    """Inverted index of a shard: postings with their BM25 weights."""

    def __init__(self, rows: list[dict]):
        self.terms = [np.frombuffer(r["terms"], np.uint32) for r in rows]
        counts = np.concatenate([np.frombuffer(r["counts"], np.uint16) for r in rows]).astype(np.float64)
        owner = np.repeat(np.arange(len(rows)), [len(t) for t in self.terms])
        flat = np.concatenate(self.terms)
        lengths = np.array([r["length"] for r in rows], np.float64)
        order = np.argsort(flat, kind="stable")
        self.names, starts, found = np.unique(flat[order], return_index=True, return_counts=True)
        self.bounds = np.append(starts, len(flat))
        idf = np.log(1 + (len(rows) - found + 0.5) / (found + 0.5))
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        weight = counts * (K1 + 1) / (counts + norm[owner])
        self.docs = owner[order]
        self.weights = weight[order] * np.repeat(idf, found)
        self.frequency = found
        self.n = len(rows)

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused remainders that share the seed's rarest terms, best first."""
        at = np.searchsorted(self.names, self.terms[seed])
        at = at[self.frequency[at] > 1]
        at = at[np.argsort(self.frequency[at], kind="stable")][:QUERY_TERMS]
        if not len(at):
            return at
        spans = [slice(self.bounds[k], self.bounds[k + 1]) for k in at.tolist()]
        scores = np.bincount(np.concatenate([self.docs[s] for s in spans]),
                             np.concatenate([self.weights[s] for s in spans]), minlength=self.n)
        scores[used] = 0
        scores[seed] = 0
        hits = np.flatnonzero(scores)
        return hits[np.argsort(-scores[hits], kind="stable")]


def pack(rows: list[dict], first_id: int, shift: Shift) -> tuple[list[tuple], int]:
    """Pieces of a shard's remainders and the next sequence number."""
    index = Index(rows)
    taken = np.zeros(len(rows), np.int64)          # tokens of each remainder already placed
    lengths = np.array([r["length"] for r in rows])
    used = np.zeros(len(rows), bool)
    marks = [np.frombuffer(r["marks"], np.uint32).tolist() for r in rows]
    pieces, sequence, front = [], first_id, 0

    def place(i: int, offset: int) -> int:
        """Put as much of a remainder into the window as fits; its length, 0 if nothing does."""
        room, start = WINDOW - offset, int(taken[i])
        length = int(lengths[i]) - start
        if length > room:
            length = room // STEP * STEP
            if not length:
                return 0
        row, end = rows[i], start + length
        last = len(marks[i]) - 1 if end == lengths[i] else end // STEP
        crc = shift.part(marks[i][start // STEP], marks[i][last], 4 * length)
        pieces.append((row["doc_id"], row["start"] + start, length, crc, row["doc_tokens"],
                       sequence, offset))
        taken[i] = end
        used[i] = end == lengths[i]
        return length

    while True:
        while front < len(rows) and used[front]:
            front += 1
        if front == len(rows):
            return pieces, sequence
        offset = place(front, 0)
        for i in index.neighbours(front, used).tolist():
            if WINDOW - offset < STEP:
                break
            offset += place(i, offset)
        following = front
        while WINDOW - offset >= STEP and following < len(rows):
            if not used[following]:
                offset += place(following, offset)
            following += 1
        sequence += 1


def pack_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shift, shard = Shift(), Shard()
    sequence = TaskContext.get().partitionId() << 40
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

    def flush():
        nonlocal sequence, shard
        pieces, sequence = pack(shard.rows, sequence, shift)
        shard = Shard()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*pieces, strict=True)], schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            shard.add(row)
            if shard.tokens >= SHARD_TOKENS:
                yield flush()
    if shard.rows:
        yield flush()


def packed(docs: DataFrame, path: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(Vocabulary.read(path))
    prepared = staged(identified(docs).mapInArrow(lambda b: prepare(b, vocab.value), PREPARED), "pieces")
    # Even sequence numbers belong to whole windows, odd ones to packed remainders.
    whole = prepared.where("marks is null").select(
        "doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens",
        (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    order = ["key1", "key2", "doc_id", "row"]
    rests = (prepared.where("marks is not null").repartitionByRange(partitions(spark), *order)
             .sortWithinPartitions(*order).mapInArrow(pack_shards, PIECES)
             .withColumn("sequence_id", F.col("sequence_id") * 2 + 1))
    return whole.unionByName(rests)
