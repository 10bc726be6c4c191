"""Substring deduplication by a collection suffix array, built column by column.

A byte goes if it is covered by a ``width``-byte string that also starts
earlier (smaller doc_id, or earlier in the same document).

1. Each window of ``width`` bytes is represented by its seed, the leftmost
   smallest hash of the ``seed_bytes``-byte runs inside it.  Equal windows have
   equal seeds, so only seeds found at two places or more go on; seeds are
   counted by shard, each once per chunk.
2. The windows of one seed lie next to each other: they make a segment of at
   most ``2 * width - seed_bytes`` bytes.  Segments are dealt out by seed, so
   equal windows meet in one bucket.  Equal segments of a chunk, and then of a
   bucket, are combined first: all but the earliest go wholly.  (Windows of one
   segment differ, so a segment that is alone with its seed is done with.)
3. In a bucket the Burrows-Wheeler transform and the common prefixes of the
   collection of segments grow by one symbol of every segment in each round;
   both live in files that a round reads from start to end and writes anew.
   Neighbouring suffixes with ``width`` bytes in common are equal windows, and
   all but the earliest of them go.
4. The spans return to their chunks, where the bytes are cut out.

Null and empty texts have no bytes; a text longer than a chunk is a chunk of its own.  Rows with the same doc_id count as
documents of their own, one after the other; null doc_ids come last.  Matches
never cross documents.  An empty table gives an empty result; other columns play
no part.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.arrays import byte_values, flat, grams, leftmost_minimum, text_hashes
from tapeworks.llm.staging import ask, chunked, ordered, shards_for, staged, tell
from tapeworks.llm.substring_dedup import (ANSWER, ASK, answered, answers_for, questions,
                                           read_questions)

WIDTH, SEED_BYTES = 100, 20
SEEDS_PER_SHARD = 1 << 18
# Text bytes for each bucket; a few hundredths of them are in repeated segments.
BYTES_PER_BUCKET = 4 << 20
SPANS = "chunk long, row int, start int, stop int"
SEGMENTS = ("kind int, chunk long, row int, start int, stop int, doc_id long, seed long, "
            "behind int, bucket int, body binary")
LAST_ID = np.iinfo(np.int64).max


class Seeds:
    """Windows of one chunk by seed: ``runs`` are (seed, first window, last window)."""

    def __init__(self, table: pa.Table, width: int, seed_bytes: int):
        self.data, self.offsets = flat(table["text"])
        runs = grams(byte_values(0)[self.data], seed_bytes)
        place = leftmost_minimum(runs, width - seed_bytes + 1)
        inside = np.zeros(len(place) + 1, np.int32)
        long = np.diff(self.offsets) >= width
        np.add.at(inside, self.offsets[:-1][long], 1)
        np.subtract.at(inside, self.offsets[1:][long] - width + 1, 1)
        at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        place = place[at]
        head = np.ones(len(at), bool)
        head[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        heads = np.flatnonzero(head)
        self.first = at[heads]
        self.last = at[np.append(heads[1:], len(at)) - 1] if len(at) else at
        self.place = place[heads]
        self.seed = runs[self.place]
        self.doc = np.searchsorted(self.offsets, self.first, "right") - 1
        self.distinct, self.number, counts = np.unique(
            self.seed, return_inverse=True, return_counts=True)
        self.counts = np.minimum(counts, 2).astype(np.uint8)


def earliest_first(doc_id, chunk, row, start) -> np.ndarray:
    return np.lexsort((start, row, chunk, doc_id))


def common_windows(bodies: np.ndarray, offsets: np.ndarray, width: int,
                   behind: np.ndarray | None = None):
    """(string, offset) of windows, in suffix order, and where the order's runs of
    equal windows begin; every window found twice is among them.

    ``bodies`` holds the strings, none shorter than ``width``, one after the
    other.  Round j inserts the suffix of length j + 1 of each string that has
    one, at the place the transform gives for it.

    With ``behind``, the bytes from each string's seed to its end, equal windows are
    known to lie at equal distances from their seeds.  Strings then join in such
    rounds that seeds are met together, and so are equal windows.  A common prefix
    grows by one symbol a round at most: a string leaves once its longest can't
    reach ``width`` any more.
    """
    lengths = np.diff(offsets)
    m, longest = len(lengths), int(lengths.max())
    codes = np.unique(bodies)
    recode = np.zeros(256, np.uint8)
    # Symbol 0 is "nothing before".  All 256 bytes at once can't occur in UTF-8.
    recode[codes] = np.arange(1, len(codes) + 1)
    symbols = recode[bodies]
    with tempfile.TemporaryFile() as bwt_file, tempfile.TemporaryFile() as lcp_file:
        files, size = (bwt_file, lcp_file), m

        def load() -> list[np.ndarray]:
            for file in files:
                file.seek(0)
            return [np.frombuffer(bytearray(file.read(size)), np.uint8) for file in files]

        def store(*arrays: np.ndarray) -> None:
            for file, array in zip(files, arrays, strict=True):
                file.seek(0)
                file.write(array.data)

        store(np.zeros(m, np.uint8), np.zeros(m, np.uint8))
        joins = np.zeros(m, np.int64) if behind is None else behind.max() - behind
        place = live = np.zeros(0, np.int64)
        reached = np.zeros(m, np.int64)
        for turn in range(int((joins + lengths).max())):
            # The empty suffixes of all strings stay first, in the strings' order.
            fresh = np.flatnonzero(joins == turn)
            place, live = np.concatenate((place, fresh)), np.concatenate((live, fresh))
            order = np.argsort(place)
            place, live = place[order], live[order]
            if not len(live):
                continue
            done = turn - joins[live]
            bwt, lcp = load()
            bwt[place] = symbols[offsets[live + 1] - 1 - done]
            # A stable sort by the symbol before is the order of the suffixes one longer.
            ranked = np.argsort(bwt, kind="stable")
            nothing = m - len(live)
            rank = np.empty(len(bwt), np.int32)
            rank[ranked] = np.arange(len(bwt), dtype=np.int32)
            at = rank[place]
            new = at - nothing + m
            here = bwt[place]
            before = ranked[at - 1]
            has_before = (at > 0) & (bwt[before] == here)
            after = ranked[np.minimum(at + 1, len(bwt) - 1)]
            has_after = (at + 1 < len(bwt)) & (bwt[after] == here)
            bounded = np.append(lcp, 0)

            def least(start, stop):
                pairs = np.stack((start, stop), axis=1).reshape(-1)
                return np.minimum.reduceat(bounded, pairs)[::2]

            with_left = np.zeros(len(at), np.uint8)
            if has_before.any():
                with_left[has_before] = 1 + least(before[has_before] + 1, place[has_before] + 1)
            size = len(bwt) + len(new)
            old = np.ones(size, bool)
            old[new] = False
            next_lcp, next_bwt = np.empty(size, np.uint8), np.zeros(size, np.uint8)
            next_lcp[old], next_bwt[old] = lcp, bwt
            if has_after.any():
                next_lcp[new[has_after] + 1] = 1 + least(
                    place[has_after] + 1, after[has_after] + 1)
            # Below the longest string a new suffix may start its symbol's block.
            ends = new[~has_after] + 1
            next_lcp[ends[ends < size]] = 0
            next_lcp[new] = with_left
            store(next_bwt, next_lcp)
            reached[live] = done + 1
            going = lengths[live] > done + 1
            if behind is not None:
                common = np.maximum(with_left, np.append(next_lcp, 0)[new + 1]).astype(np.int64)
                going &= common + lengths[live] - (done + 1) >= width
            place, live = new[going].astype(np.int64), live[going]
        bwt, lcp = load()
    # Walk every string through the finished transform: from its empty suffix on,
    # the place of each suffix one symbol longer.
    ranked = np.argsort(bwt, kind="stable")
    step = np.empty(len(bwt), np.int64)
    step[ranked] = np.arange(len(bwt)) - np.count_nonzero(bwt == 0) + m
    string = np.full(len(bwt), -1, np.int32)
    offset = np.zeros(len(bwt), np.int32)
    place, live = np.arange(m), np.arange(m)
    for done in range(1, longest + 1):
        going = reached[live] >= done
        place, live = step[place[going]], live[going]
        if done >= width:
            string[place] = live
            offset[place] = lengths[live] - done
    windows = np.flatnonzero(string >= 0)
    # Shorter suffixes may stand between windows: a run is cut where the common
    # prefix falls below the width anywhere between two windows.
    short = np.cumsum(lcp < width)
    head = np.ones(len(windows), bool)
    head[1:] = short[windows[1:]] != short[windows[:-1]]
    return string[windows], offset[windows], head


def later_windows(bodies, offsets, keys, width, behind):
    """Spans of each string that an earlier equal window makes superfluous.

    ``keys`` are the strings' (doc_id, chunk, row, start); ``behind`` as above.
    """
    if len(offsets) < 2:
        none = np.zeros(0, np.int64)
        return none, none, none
    string, offset, head = common_windows(bodies, offsets, width, behind)
    run = np.cumsum(head) - 1
    doc_id, chunk, row, start = (k[string] for k in keys)
    order = np.lexsort((start + offset, row, chunk, doc_id, run))
    first = np.ones(len(order), bool)
    first[1:] = run[order][1:] != run[order][:-1]
    later = order[~first]
    string, offset = string[later], offset[later]
    order = np.lexsort((offset, string))
    string, offset = string[order], offset[order]
    head = np.ones(len(string), bool)
    head[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
    heads = np.flatnonzero(head)
    return string[heads], offset[heads], offset[np.append(heads[1:], len(string)) - 1] + width \
        if len(heads) else offset


def _spans(chunk, row, start, stop) -> pa.Table:
    return pa.table({"chunk": pa.array(chunk, pa.int64()), "row": pa.array(row, pa.int32()),
                     "start": pa.array(start, pa.int32()), "stop": pa.array(stop, pa.int32())})


def later_bytes(docs: DataFrame, width: int = WIDTH, seed_bytes: int = SEED_BYTES, *,
                with_text: bool = False) -> DataFrame:
    """n_bytes, n_removed, n_spans and digest of the remaining bytes of each document.

    With ``with_text`` also ``kept_text``: the remaining bytes as text, without
    characters that a cut went through, and ``rest``, a struct of the other columns.
    """
    spark = docs.sparkSession
    chunks = chunked(docs, carry=with_text)
    total = chunks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = shards_for(total // (width // 3), SEEDS_PER_SHARD, spark)
    n_buckets = shards_for(total, BYTES_PER_BUCKET, spark)

    def seed_shards(found: Seeds) -> np.ndarray:
        return (found.distinct % np.uint64(n_shards)).astype(np.int32)

    def seeds(table: pa.Table) -> pa.Table:
        found = Seeds(ordered(table), width, seed_bytes)
        halves = np.stack((found.distinct >> np.uint64(32),
                           found.distinct & np.uint64(0xFFFFFFFF))).astype(np.uint32)
        return questions(table["chunk"][0].as_py(), halves, found.counts, seed_shards(found))

    def count(table: pa.Table) -> pa.Table:
        halves, counts, sizes = read_questions(table, np.uint32)
        keys = halves[0].astype(np.uint64) << np.uint64(32) | halves[1]
        _, number = np.unique(keys, return_inverse=True)
        return answers_for(table, np.bincount(number, counts)[number] >= 2, sizes)

    known = ask(chunks, seeds, ASK).groupBy("shard").applyInArrow(count, ANSWER)

    def segments(table: pa.Table, answers: pa.Table) -> pa.Table:
        """Segments that may have partners (kind 1) and copies inside the chunk (kind 0)."""
        table = ordered(table)
        found = Seeds(table, width, seed_bytes)
        hot = np.flatnonzero(answered(answers, seed_shards(found))[found.number])
        first, last, doc = found.first[hot], found.last[hot], found.doc[hot]
        stop = last + width
        start = first - found.offsets[doc]
        ids = np.asarray(table["doc_id"].fill_null(LAST_ID))[doc]
        order = earliest_first(ids, np.zeros(len(ids)), doc, start)
        one = text_hashes(found.data, first, stop)[order] if len(hot) else first
        two = text_hashes(found.data, first, stop, 1)[order] if len(hot) else first
        same = np.lexsort((np.arange(len(order)), two, one))
        head = np.ones(len(same), bool)
        head[1:] = (one[same][1:] != one[same][:-1]) | (two[same][1:] != two[same][:-1])
        kind = np.empty(len(same), np.int32)
        kind[order[same]] = head
        raw = found.data.tobytes()
        bodies = [raw[a:b] if k else None for a, b, k in
                  zip(first.tolist(), stop.tolist(), kind.tolist(), strict=True)]
        bucket = ((found.seed[hot] >> np.uint64(20)) % np.uint64(n_buckets)).astype(np.int32)
        return pa.table({
            "kind": pa.array(kind), "chunk": pa.array(np.full(len(hot), table["chunk"][0].as_py())),
            "row": pa.array(doc.astype(np.int32)), "start": pa.array(start.astype(np.int32)),
            "stop": pa.array((stop - found.offsets[doc]).astype(np.int32)),
            "doc_id": pa.array(ids), "seed": pa.array(found.seed[hot].view(np.int64)),
            "behind": pa.array((stop - found.place[hot]).astype(np.int32)),
            "bucket": pa.array(bucket),
            "body": pa.array(bodies, pa.binary())})

    parts = staged(tell(chunks, known, segments, SEGMENTS), "segments")
    copies = parts.where("kind = 0").select("chunk", "row", "start", "stop")

    def bucket(table: pa.Table) -> pa.Table:
        keys = [np.asarray(table[c]).astype(np.int64) for c in ("doc_id", "chunk", "row", "start")]
        order = earliest_first(*keys)
        coded = table["body"].combine_chunks().take(pa.array(order)).dictionary_encode()
        keys = [k[order] for k in keys]
        stop = np.asarray(table["stop"])[order]
        number = np.asarray(coded.indices)
        # Codes are given in order of appearance: the first of each body is the earliest.
        first = np.ones(len(number), bool)
        first[1:] = number[1:] > np.maximum.accumulate(number)[:-1]
        gone = ~first
        # A seed with one segment left has nothing more to compare.
        seed = np.asarray(table["seed"])[order][first]
        _, which, counts = np.unique(seed, return_inverse=True, return_counts=True)
        several = np.flatnonzero(counts[which] > 1)
        bodies, offsets = flat_binary(coded.dictionary.take(pa.array(several)))
        at = np.flatnonzero(first)[several]
        behind = np.asarray(table["behind"])[order][at].astype(np.int64)
        string, begin, end = later_windows(bodies, offsets, [k[at] for k in keys], width, behind)
        _, chunk, row, start = keys
        at = at[string]
        return _spans(np.concatenate((chunk[gone], chunk[at])),
                      np.concatenate((row[gone], row[at])).astype(np.int32),
                      np.concatenate((start[gone], start[at] + begin)).astype(np.int32),
                      np.concatenate((stop[gone], start[at] + end)).astype(np.int32))

    spans = parts.where("kind = 1").select(
        "chunk", "row", "start", "stop", "doc_id", "seed", "behind", "bucket",
        "body").groupBy("bucket").applyInArrow(
        bucket, SPANS)

    def cut(table: pa.Table, spans: pa.Table) -> pa.Table:
        table = ordered(table)
        data, offsets = flat(table["text"])
        base = offsets[np.asarray(spans["row"]).astype(np.int64)] if spans.num_rows else 0
        edges = np.zeros(len(data) + 1, np.int32)
        np.add.at(edges, np.asarray(spans["start"]).astype(np.int64) + base, 1)
        np.subtract.at(edges, np.asarray(spans["stop"]).astype(np.int64) + base, 1)
        gone = np.cumsum(edges[:-1]) > 0
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        starts = offsets[:-1][np.diff(offsets) > 0]
        head[starts] = gone[starts]
        sums = np.concatenate(([0], np.cumsum(gone)))
        runs = np.concatenate(([0], np.cumsum(head)))
        kept, cuts = data[~gone].tobytes(), offsets - sums[offsets]
        texts = [kept[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        out = {"doc_id": table["doc_id"], "n_bytes": pa.array(np.diff(offsets)),
               "n_removed": pa.array(np.diff(sums[offsets])),
               "n_spans": pa.array(np.diff(runs[offsets])),
               "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())}
        if with_text:
            out["kept_text"] = pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string())
            if "rest" in table.column_names:
                out["rest"] = table["rest"]
        return pa.table(out)

    schema = T.StructType.fromDDL(
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        + (", kept_text string" if with_text else ""))
    if "rest" in chunks.columns:
        schema = schema.add(chunks.schema["rest"])
    return tell(chunks, copies.unionByName(spans), cut, schema)


def flat_binary(column) -> tuple[np.ndarray, np.ndarray]:
    return flat(column.cast(pa.large_binary()).view(pa.large_string()))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with their repeated bytes cut out; all rows and columns stay."""
    cut = later_bytes(docs, width, with_text=True)
    other = {c: F.col(f"rest.`{c}`") for c in docs.columns if c not in ("doc_id", "text")}
    if "n_chars" in other:
        other["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    every = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), **other}
    return cut.select(*(every[c].alias(c) for c in docs.columns))
