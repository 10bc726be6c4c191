"""Language-model scores by online logistic context mixing.

The model codes a text as its lower-cased words and one end, so that its
probability can be compared with a smoothed unigram base.

* Exact counts of all training words, whatever their number, come from shards
  that own the words; a chunk asks for each of its distinct words once.
* A word that the counts don't settle is coded byte by byte, each byte along a
  Huffman tree.  Every bit is predicted from several hashed contexts (the last
  1, 2, 3, 4 and 6 bytes, and the word so far), whose counts over all distinct
  training words lie in one table of fixed size.
* The predictions are mixed in the logistic domain with weights chosen by a gate
  (how many contexts are known, and how far the word has come).  Weights are
  learned online, batch after batch, from words whose own counts are taken out;
  an adaptive table then refines the mixed probability.
* Word and byte models share the probability by the mass that unseen words have
  (words seen once among all words).
* Along a text, the words that followed the last word so far make one more
  prediction, whose weight is gated by how long such predictions have held.
* Along all training texts, the tokens that followed a word (an end stands before
  each first word) make another.  Counts of pairs come from the shards too, under
  32 check bits.  Whether a token comes from there or from the price above is a bit
  of its own, mixed logistically from four hashed contexts with gated weights and
  refined; a chunk learns it online from its training tokens, whose own counts are
  taken out, and then scores all its texts.  So the scores depend a little on which
  texts share a chunk.  Bytes are never predicted across a word's start.

Training texts are those for which ``train`` is true.  Tasks learn the weights of the
byte model on their own words and the results are averaged by the bits seen.

A null text is empty: it scores its end alone.  doc_id may be null or repeated;
rows are scored one by one, so ties play no part.  A text longer than a chunk is a
chunk of its own.  With no training row N = V = 0 and the base is
log10(1) for each token.  An empty table gives an empty result; other columns
play no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.arrays import STEP, flat, mix, text_hashes, word_array, words
from tapeworks.llm.staging import ask, blob, chunked, ordered, shards_for, staged, tell
from tapeworks.llm.substring_dedup import by_shard

SLOT_BITS = 22
ORDERS = (1, 2, 3, 4, 6)
INPUTS = len(ORDERS) + 2                      # contexts, the word so far, and a bias
GATES = (len(ORDERS) + 2) * 8                 # known contexts x place in the word
REFINE = 33                                   # buckets of the refining table
BATCH, RATE = 1 << 13, 0.02
WORDS_PER_SHARD, BYTES_PER_NEW_WORD = 1 << 17, 32
WORD_END = 32                                 # never part of a word
ASK = "shard int, chunk long, words binary, lengths binary, counts binary, pairs binary, followed binary"
OWNED = ("kind int, shard int, chunk long, words binary, lengths binary, counts binary, "
         "followed binary, tokens long, types long, once long")
END_NAME = np.uint64(0xD6E8FEB86659FD93)      # stands for a text's end among hashes of words


def upper_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


# Bits -----------------------------------------------------------------------

@dataclass(frozen=True)
class Tree:
    """A Huffman tree over bytes: the inner nodes and branches on the way to each."""

    starts: np.ndarray
    lengths: np.ndarray
    nodes: np.ndarray
    branches: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> Tree:
        heap = [(int(c) + 1, b, None) for b, c in enumerate(counts)]
        heapq.heapify(heap)
        number = 256
        while len(heap) > 1:
            one, two = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (one[0] + two[0], number, (one, two)))
            number += 1
        ways: dict[int, list[tuple[int, int]]] = {}
        stack = [(heap[0], [])]
        while stack:
            (_, name, inner), way = stack.pop()
            if inner is None:
                ways[name] = way
            else:
                stack += [(child, [*way, (name - 256, bit)]) for bit, child in enumerate(inner)]
        lengths = np.array([len(ways[b]) for b in range(256)])
        steps = [s for b in range(256) for s in ways[b]]
        return Tree(np.cumsum(lengths) - lengths, lengths, np.array([s[0] for s in steps]),
                    np.array([s[1] for s in steps], np.uint8))


def bits_of(tree: Tree, data: np.ndarray, offsets: np.ndarray):
    """For every bit of the words (each with its end): word, gate place, branch, slots."""
    n = len(offsets) - 1
    lengths = np.diff(offsets) + 1
    ends = np.cumsum(lengths)
    symbols = np.full(ends[-1], WORD_END, np.uint8)
    inner = np.ones(len(symbols), bool)
    inner[ends - 1] = False
    symbols[inner] = data
    word = np.repeat(np.arange(n, dtype=np.int32), lengths)
    place = np.arange(len(symbols)) - (ends - lengths)[word]
    contexts = np.empty((len(ORDERS) + 1, len(symbols)), np.uint64)
    window = np.zeros(len(symbols), np.uint64)
    back = symbols.astype(np.uint64) + np.uint64(1)
    for reach in range(1, max(ORDERS) + 1):
        # Beyond the word's start there is nothing to see.
        shifted = np.zeros(len(symbols), np.uint64)
        shifted[reach:] = back[:-reach]
        shifted[place < reach] = 0
        window = (window + shifted) * np.uint64(STEP)
        if reach in ORDERS:
            contexts[ORDERS.index(reach)] = mix(window + np.uint64(reach))
    starts = (ends - lengths)[word]
    at = np.arange(len(symbols))
    contexts[-1] = text_hashes(symbols, starts, at) if len(at) else window
    steps = tree.lengths[symbols]
    which = np.repeat(np.arange(len(symbols), dtype=np.int32), steps)
    way = np.repeat(tree.starts[symbols] - (np.cumsum(steps) - steps), steps) + np.arange(len(which))
    # Contexts and nodes are mixed, so their sum needs no more of it.
    node = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(STEP))[tree.nodes[way]]
    slots = np.empty((len(contexts), len(which)), np.int32)
    for k, context in enumerate(contexts):
        slots[k] = (context[which] + node) >> np.uint64(64 - SLOT_BITS)
    return word[which], np.minimum(place[which], 7), tree.branches[way], slots


def stretched(counts: np.ndarray) -> np.ndarray:
    """Input of each slot; 0 where it has no counts, and only there."""
    zero, one = counts
    table = np.log((one + np.float32(0.4)) / (zero + np.float32(0.4)))
    table[(table == 0) & (zero > 0)] = 1e-7
    return table


def predicted(table: np.ndarray, slots):
    """Inputs of the mixer, from ``stretched`` counts, and how many contexts are known."""
    inputs = np.empty((INPUTS, slots.shape[1]), np.float32)
    known = np.zeros(slots.shape[1], np.int64)
    for k, slot in enumerate(slots):
        inputs[k] = table[slot]
        known += inputs[k] != 0
    inputs[-1] = 0.3
    return inputs, known


def predicted_by_others(counts: np.ndarray, slots, branch):
    """The same from (slot, branch) counts, with one count of ``branch`` taken out."""
    inputs = np.empty((INPUTS, slots.shape[1]), np.float32)
    known = np.zeros(slots.shape[1], np.int64)
    sign = np.where(branch == 1, np.float32(1), np.float32(-1))
    for k, slot in enumerate(slots):
        at = slot * 2 + branch
        same, other = np.maximum(counts[at] - np.float32(1), 0), counts[at ^ 1]
        known += (same + other) > 0
        inputs[k] = sign * np.log((same + np.float32(0.4)) / (other + np.float32(0.4)))
    inputs[-1] = 0.3
    return inputs, known


def squash(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Mixer:
    """Gated weights and the refining table."""

    weights: np.ndarray
    hits: np.ndarray

    @staticmethod
    def fresh() -> Mixer:
        weights = np.full((GATES, INPUTS), 0.3, np.float32)
        centre = squash((np.arange(REFINE) - REFINE // 2) / 2.0)
        # Each cell starts as if it had seen its own probability come true.
        hits = np.stack((20 * (1 - centre), 20 * centre))
        return Mixer(weights, np.repeat(hits[:, None, :], GATES, axis=1))

    def mixed(self, inputs, gate):
        return np.einsum("kn,nk->n", inputs, self.weights[gate])

    def refined(self, total, gate):
        """Half the mixed probability, half what the table has seen come of it."""
        cell = np.clip(np.rint(total * 2).astype(np.int64) + REFINE // 2, 0, REFINE - 1)
        zero, one = self.hits[0][gate, cell], self.hits[1][gate, cell]
        return 0.5 * squash(total) + 0.5 * one / (zero + one), cell

    def learn(self, inputs, gate, branch, weight) -> None:
        for a in range(0, len(gate), BATCH):
            part = slice(a, a + BATCH)
            x, g, w = inputs[:, part], gate[part], weight[part]
            total = self.mixed(x, g)
            error = (branch[part] - squash(total)) * w
            share = np.bincount(g, w, minlength=GATES)
            for k in range(INPUTS):
                step = np.bincount(g, error * x[k], minlength=GATES)
                # A gate's step is the mean of its bits' steps, longer if it has many.
                self.weights[:, k] += (RATE * step / np.sqrt(np.maximum(share, 1))).astype(np.float32)
            _, cell = self.refined(total, g)
            np.add.at(self.hits, (branch[part].astype(np.int64), g, cell), w)


def gates(known, place):
    return known * 8 + place


def word_bits(tree, counts, mixer, data, offsets, table=None) -> np.ndarray:
    """log10 probability of each word's bytes and its end (``table``: the stretched counts)."""
    out = np.empty(len(offsets) - 1)
    table = stretched(counts) if table is None else table
    for a, b in word_batches(offsets):
        word, place, branch, slots = bits_of(tree, data[offsets[a]:offsets[b]],
                                             offsets[a:b + 1] - offsets[a])
        inputs, known = predicted(table, slots)
        gate = gates(known, place)
        one, _ = mixer.refined(mixer.mixed(inputs, gate), gate)
        out[a:b] = np.bincount(word, np.log10(np.where(branch == 1, one, 1 - one)), minlength=b - a)
    return out


def word_batches(offsets, limit: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Ranges of words that hold about ``limit`` bytes; a longer word is alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


# Spark ----------------------------------------------------------------------

# Weight of the text's own word pairs after 0, 1, 2, 3 and 8 correct ones in a row.
MATCH_FROM, MATCH_WEIGHT = (0, 1, 2, 3, 8), (0.01, 0.2, 0.5, 0.9, 0.97)
# Contexts of a choice, slots of each (as bits), and gates, one for each length of a run above.
CHOICE_BITS, CHOICE_CONTEXTS, CHOICE_GATES = 12, 4, len(MATCH_FROM)
CHOICE_SLOTS = 1 << CHOICE_BITS


def earlier(keys: np.ndarray) -> np.ndarray:
    """How often each key has come before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    at = np.arange(len(keys))
    head = np.ones(len(keys), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    out = np.empty(len(keys), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(head, at, 0))
    return out


def runs(held: np.ndarray, head: np.ndarray) -> np.ndarray:
    """How many tokens in a row, just before each one, were held; ``head`` starts a text."""
    at = np.arange(len(held))
    broken = np.maximum.accumulate(np.where(~held | head, at, 0))
    run = np.zeros(len(held), np.int64)
    run[1:] = (at - broken)[:-1] + (held & head)[:-1]
    run[head] = 0
    return run


def with_matches(cost: np.ndarray, word: np.ndarray, doc: np.ndarray, n_words: int) -> np.ndarray:
    """log10 probability of each word, mixed with what its text has shown so far."""
    if not len(word):
        return cost
    before = np.concatenate(([n_words], word[:-1]))
    head = np.ones(len(word), bool)
    head[1:] = doc[1:] != doc[:-1]
    before[head] = n_words
    context = doc * (n_words + 1) + before
    asked = earlier(context)
    right = earlier(mix(context.astype(np.uint64) * np.uint64(STEP) + word.astype(np.uint64)))
    run = runs(right > 0, head)
    weight = np.array(MATCH_WEIGHT)[np.searchsorted(MATCH_FROM, run, "right") - 1]
    weight = np.where((asked > 0) & ~head, weight, 0.0)
    return together(cost, right / np.maximum(asked, 1), weight)


def together(cost: np.ndarray, share: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """log10 of (1 - weight) * 10 ** cost + weight * share."""
    plain = np.log10(1 - weight) + cost
    both = np.log10((1 - weight) * 10.0 ** np.maximum(cost, -290) + weight * share)
    return np.where(weight * share > 0, both, plain)


@dataclass
class Choice:
    """The bit "the word comes from its context", mixed from several hashed contexts.

    The bit is never seen: its part in a token's probability teaches instead.
    """

    counts: np.ndarray
    weights: np.ndarray
    hits: np.ndarray

    @staticmethod
    def fresh() -> Choice:
        counts = np.empty((2, CHOICE_CONTEXTS, CHOICE_SLOTS))
        # Until something is learned, the context has one part in ten.
        counts[0], counts[1] = 1.8, 0.2
        centre = squash((np.arange(REFINE) - REFINE // 2) / 2.0)
        hits = np.stack((20 * (1 - centre), 20 * centre))
        return Choice(counts, np.full((CHOICE_GATES, CHOICE_CONTEXTS), 1 / CHOICE_CONTEXTS),
                      np.repeat(hits[:, None, :], CHOICE_GATES, axis=1))

    def chance(self, slots, gate):
        inputs = np.empty(slots.shape)
        for k, slot in enumerate(slots):
            inputs[k] = np.log(self.counts[1, k][slot] / self.counts[0, k][slot])
        total = (inputs * self.weights[gate].T).sum(axis=0)
        cell = np.clip(np.rint(total * 2).astype(np.int64) + REFINE // 2, 0, REFINE - 1)
        zero, one = self.hits[0][gate, cell], self.hits[1][gate, cell]
        mixed = squash(total)
        return np.clip(0.5 * mixed + 0.5 * one / (zero + one), 1e-6, 1 - 1e-6), inputs, mixed, cell

    def learn(self, slots, gate, cost, share) -> None:
        """Online, batch after batch: each predicts its bits before it learns from them."""
        for a in range(0, len(gate), BATCH):
            part = slice(a, a + BATCH)
            g, at = gate[part], slots[:, part]
            chance, inputs, mixed, cell = self.chance(at, g)
            ours = chance * share[part]
            bit = ours / (ours + (1 - chance) * 10.0 ** np.maximum(cost[part], -290))
            many = np.sqrt(np.maximum(np.bincount(g, minlength=CHOICE_GATES), 1))
            for k in range(CHOICE_CONTEXTS):
                step = np.bincount(g, (bit - mixed) * inputs[k], minlength=CHOICE_GATES)
                self.weights[:, k] += RATE * step / many
                for side, amount in enumerate((1 - bit, bit)):
                    self.counts[side, k] += np.bincount(at[k], amount, minlength=CHOICE_SLOTS)
            place = g * REFINE + cell
            for side, amount in enumerate((1 - bit, bit)):
                self.hits[side] += np.bincount(place, amount, minlength=CHOICE_GATES * REFINE).reshape(
                    CHOICE_GATES, REFINE)


def choice_slots(pair: np.ndarray, context: np.ndarray, names: np.ndarray, head: np.ndarray):
    """Slots of a token's contexts and its gate: all from what stands before the token.

    ``pair`` and ``context`` say how often the token after its context, and the context,
    occur in training texts; ``names`` are hashes of the words before.
    """
    run = runs(pair > 0, head)
    run = np.searchsorted(MATCH_FROM, run, "right") - 1
    often = np.minimum(np.log2(context + 1.0) * 2, 63).astype(np.int64)
    # How often the last token had followed its own context.
    last = np.zeros(len(pair), np.int64)
    last[1:] = np.minimum(np.log2(pair[:-1] + 1.0) * 2, 31).astype(np.int64)
    last[head] = 32
    further = np.zeros(len(pair), np.uint64)
    further[1:] = names[:-1]
    further[head] = 0
    shift = np.uint64(64 - CHOICE_BITS)
    return np.stack((often * CHOICE_GATES + run, last * 64 + often, (names >> shift).astype(np.int64),
                     (mix(further + np.uint64(1) + run.astype(np.uint64)) >> shift).astype(np.int64))), run


def in_text(cost, pair, context, names, doc, own, alone):
    """log10 probability of each token: its ``cost`` alone, mixed with the word before it.

    ``own`` tokens (of training texts) teach, each from the others: its own part of the counts
    is taken out.  ``alone`` is the cost without that part.
    """
    head = np.ones(len(doc), bool)
    head[1:] = doc[1:] != doc[:-1]
    choice = Choice.fresh()
    mine = np.flatnonzero(own)
    if len(mine):
        rest, all_others = np.maximum(pair[mine] - 1, 0), np.maximum(context[mine] - 1, 0)
        slots, gate = choice_slots(rest, all_others, names[mine], head[mine])
        use = np.flatnonzero(all_others > 0)
        choice.learn(slots[:, use], gate[use], alone[mine][use], (rest / np.maximum(all_others, 1))[use])
    out = np.empty(len(cost))
    slots, gate = choice_slots(pair, context, names, head)
    for a in range(0, len(cost), 1 << 16):
        part = slice(a, a + (1 << 16))
        weight = np.where(context[part] > 0, choice.chance(slots[:, part], gate[part])[0], 0.0)
        out[part] = together(cost[part], pair[part] / np.maximum(context[part], 1), weight)
    return out


def planes(values: np.ndarray) -> bytes:
    """Whole numbers, their lowest bytes first: high bytes are mostly zero and pack well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def unpacked(row_words: bytes, row_lengths: bytes) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.frombuffer(row_lengths, np.uint32)
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return np.frombuffer(row_words, np.uint8), offsets


class Words:
    """Distinct lower-cased words of one chunk, and its pairs of neighbours, dealt to shards."""

    def __init__(self, table: pa.Table, n_shards: int):
        data, self.offsets = flat(table["text"])
        data = upper_table()[data]
        starts, ends, self.doc = words(data, self.offsets)
        coded = word_array(data, starts, ends).dictionary_encode()
        self.which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.data, self.ends = flat(coded.dictionary)
        hashes = text_hashes(self.data, self.ends[:-1], self.ends[1:])
        self.order, self.spans = by_shard((hashes % np.uint64(n_shards)).astype(np.int32))
        # Running text: words with the end of each text; an end stands before the first word too.
        n = table.num_rows
        self.at = np.arange(len(self.which)) + self.doc
        self.end_at = np.cumsum(np.bincount(self.doc, minlength=n) + 1) - 1
        self.token_doc = np.empty(len(self.which) + n, np.int64)
        self.token_doc[self.at], self.token_doc[self.end_at] = self.doc, np.arange(n)
        names = np.full(len(self.token_doc), END_NAME, np.uint64)
        names[self.at] = hashes[self.which]
        self.before = np.concatenate((np.array([END_NAME], np.uint64), names[:-1]))
        keys = mix(self.before * np.uint64(STEP) + names)
        # The upper half names the shard, the lower half checks the key inside it.
        keys = (keys >> np.uint64(32)) % np.uint64(n_shards) << np.uint64(32) | keys & np.uint64(0xFFFFFFFF)
        self.pairs, self.pair = np.unique(keys, return_inverse=True)
        shard = (self.pairs >> np.uint64(32)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(shard)) + 1
        edges = [0, *cuts.tolist(), len(shard)]
        self.pair_spans = {int(shard[i]): (i, j) for i, j in zip(edges, edges[1:], strict=False) if i < j}


def scored(docs: DataFrame, train: Column) -> DataFrame:
    """Scores of all documents by a model of those with ``train`` (a condition on doc_id)."""
    spark = docs.sparkSession
    chunks = chunked(docs).withColumn("train", F.coalesce(train, F.lit(False)))
    total, train_docs = chunks.agg(F.sum(F.octet_length("text")),
                                   F.count_if("train")).first()
    n_shards = shards_for((total or 0) // BYTES_PER_NEW_WORD, WORDS_PER_SHARD, spark)

    def collect(table: pa.Table) -> pa.Table:
        table = ordered(table)
        found = Words(table, n_shards)
        learned = np.asarray(table["train"])[found.doc]
        counts = np.bincount(found.which[learned], minlength=len(found.ends) - 1)[found.order]
        raw, lengths = found.data.tobytes(), np.diff(found.ends).astype(np.uint32)[found.order]
        a, b = found.ends[:-1][found.order].tolist(), found.ends[1:][found.order].tolist()
        pieces = [raw[i:j] for i, j in zip(a, b, strict=True)]
        followed = np.bincount(found.pair[np.asarray(table["train"])[found.token_doc]],
                               minlength=len(found.pairs)).astype(np.uint32)
        checks, spans = found.pairs.astype(np.uint32), {s: (i, j) for s, i, j in found.spans}
        rows = [(s, *spans.get(s, (0, 0)), *found.pair_spans.get(s, (0, 0)))
                for s in sorted(spans.keys() | found.pair_spans.keys())]
        return pa.table({
            "shard": pa.array([r[0] for r in rows], pa.int32()),
            "chunk": pa.array([table["chunk"][0].as_py()] * len(rows), pa.int64()),
            "words": pa.array([b"".join(pieces[i:j]) for _, i, j, _, _ in rows], pa.binary()),
            "lengths": pa.array([blob(lengths[i:j]) for _, i, j, _, _ in rows], pa.binary()),
            "counts": pa.array([blob(counts[i:j].astype(np.uint32)) for _, i, j, _, _ in rows],
                               pa.binary()),
            "pairs": pa.array([blob(checks[i:j]) for _, _, _, i, j in rows], pa.binary()),
            "followed": pa.array([planes(followed[i:j]) for _, _, _, i, j in rows], pa.binary())})

    def own(table: pa.Table) -> pa.Table:
        """Kind 0: the shard's distinct words and counts.  Kind 1: their numbers, for each chunk,
        and how often its pairs occur in all training texts."""
        lengths = [np.frombuffer(x, np.uint32) for x in table["lengths"].to_pylist()]
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths), dtype=np.int64)))
        every = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1,
            [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(table["words"].to_pylist()))])
        coded = every.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        counts = np.bincount(which, np.concatenate(
            [np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()])).astype(np.int64)
        data, ends = flat(coded.dictionary.view(pa.large_string()))
        shard = table["shard"][0].as_py()
        parts = np.split(which.astype(np.uint32), np.cumsum([len(x) for x in lengths])[:-1])
        n = table.num_rows
        none = [None] * n
        checks = [np.frombuffer(x, np.uint32) for x in table["pairs"].to_pylist()]
        distinct, same = np.unique(np.concatenate(checks), return_inverse=True)
        followed = np.bincount(same, np.concatenate(
            [from_planes(x, np.uint32) for x in table["followed"].to_pylist()]),
            minlength=len(distinct)).astype(np.uint64)[same]
        followed = np.split(followed, np.cumsum([len(x) for x in checks])[:-1])
        return pa.table({
            "kind": pa.array([0] + [1] * n, pa.int32()),
            "shard": pa.array([shard] * (n + 1), pa.int32()),
            "chunk": pa.array([None, *table["chunk"].to_pylist()], pa.int64()),
            "words": pa.array([data.tobytes(), *none], pa.binary()),
            "lengths": pa.array([blob(np.diff(ends).astype(np.uint32)), *none], pa.binary()),
            "counts": pa.array([blob(counts), *map(blob, parts)], pa.binary()),
            "followed": pa.array([None, *map(planes, followed)], pa.binary()),
            "tokens": pa.array([int(counts.sum())] + none, pa.int64()),
            "types": pa.array([int(np.count_nonzero(counts))] + none, pa.int64()),
            "once": pa.array([int(np.count_nonzero(counts == 1))] + none, pa.int64())})

    owned = staged(ask(chunks, collect, ASK).groupBy("shard").applyInArrow(own, OWNED), "words")
    lists = owned.where("kind = 0").select("shard", "words", "lengths", "counts")
    sums = owned.where("kind = 0").agg(F.sum("tokens"), F.sum("types"), F.sum("once")).first()
    word_tokens, types, once = (x or 0 for x in sums)
    all_tokens, vocabulary = word_tokens + train_docs, types + (train_docs > 0)
    tree, counts = context_counts(lists)
    shared = spark.sparkContext.broadcast((tree, counts))
    model = spark.sparkContext.broadcast(learned_mixer(lists, shared))
    unseen = (once + 1) / (word_tokens + 2)

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """log10 probability of each of a shard's words."""
        (tree, counts), mixer = shared.value, model.value
        table = stretched(counts)
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets = unpacked(row["words"], row["lengths"])
                seen = np.frombuffer(row["counts"], np.int64)
                spelled = word_bits(tree, counts, mixer, data, offsets, table)
                known = (1 - unseen) * seen / max(word_tokens, 1)
                prices = np.log10(known + unseen * 10.0 ** np.maximum(spelled, -300))
                # Far below what a double can hold only the logarithm is left.
                prices = np.where(seen > 0, prices, np.log10(unseen) + spelled)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]], pa.int32()), pa.array([blob(prices)], pa.binary()),
                     pa.array([row["counts"]], pa.binary())], ["shard", "prices", "seen"])

    prices = lists.mapInArrow(price, "shard int, prices binary, seen binary")

    def answer(asked: pa.Table, prices: pa.Table) -> pa.Table:
        cost = np.frombuffer(prices["prices"][0].as_py(), np.float64)
        seen = np.frombuffer(prices["seen"][0].as_py(), np.int64)
        which = [np.frombuffer(x, np.uint32) for x in asked["counts"].to_pylist()]
        return pa.table({"chunk": asked["chunk"], "shard": asked["shard"],
                         "prices": pa.array([blob(cost[w].astype(np.float32)) for w in which], pa.binary()),
                         "seen": pa.array([blob(seen[w].astype(np.uint32)
                                                if not len(seen) or seen.max() < 1 << 32
                                                else seen[w]) for w in which], pa.binary()),
                         "wide": pa.array([bool(len(seen)) and int(seen.max()) >= 1 << 32]
                                          * asked.num_rows),
                         "followed": asked["followed"]})

    answers = (owned.where("kind = 1").select("shard", "chunk", "counts", "followed").groupBy("shard")
               .cogroup(prices.groupBy("shard")).applyInArrow(
                   answer, "chunk long, shard int, prices binary, seen binary, wide boolean, followed binary"))
    p_end = (train_docs + 0.5) / (all_tokens + 1)
    c_end = train_docs

    def sum_up(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = ordered(table)
        found = Words(table, n_shards)
        cost = np.empty(len(found.order))
        seen = np.empty(len(found.order), np.int64)
        replies = {r["shard"]: r for r in answers.to_pylist()}
        pairs = np.empty(len(found.pairs), np.int64)
        for s, (a, b) in found.pair_spans.items():
            pairs[a:b] = from_planes(replies[s]["followed"], np.uint64)
        for s, a, b in found.spans:
            r = replies[s]
            cost[found.order[a:b]] = np.frombuffer(r["prices"], np.float32)
            seen[found.order[a:b]] = np.frombuffer(r["seen"], np.int64 if r["wide"] else np.uint32)
        n = table.num_rows
        tokens = np.bincount(found.doc, minlength=n) + 1
        room = np.log10(all_tokens + vocabulary + 1)
        base = np.bincount(found.doc, np.log10(seen + 1.0)[found.which], minlength=n)
        base = base + np.log10(c_end + 1.0) - tokens * room
        matched = with_matches(cost[found.which], found.which, found.doc, len(found.order))
        plain = np.empty(len(found.token_doc))
        plain[found.at], plain[found.end_at] = matched + np.log10(1 - p_end), np.log10(p_end)
        often = np.full(len(plain), c_end, np.int64)
        often[found.at] = seen[found.which]
        # An end stands before each first word; all others follow the token before them.
        context = np.concatenate(([c_end], often[:-1]))
        alone = plain + np.log10(np.maximum(often - 1, 0.5) / np.maximum(often, 0.5))
        mixed = in_text(plain, pairs[found.pair], context, found.before, found.token_doc,
                        np.asarray(table["train"])[found.token_doc], alone)
        score = np.bincount(found.token_doc, mixed, minlength=n)
        size = np.maximum(np.diff(found.offsets), 1)
        return pa.table({
            "doc_id": table["doc_id"], "held_out": pa.array(~np.asarray(table["train"])),
            "n_tokens": pa.array(tokens),
            "n_known": pa.array(np.bincount(found.doc, (seen > 0)[found.which], minlength=n)
                                .astype(np.int64) + int(c_end > 0)),
            "train_tokens": pa.array(np.full(n, all_tokens)), "base_score": pa.array(base),
            "score": pa.array(score), "bits_per_byte": pa.array(-score / np.log10(2) / size)})

    return tell(chunks, answers, sum_up,
                "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double, bits_per_byte double")


def context_counts(lists: DataFrame) -> tuple[Tree, np.ndarray]:
    """The Huffman tree of the training words, and (zeros, ones) of every context slot."""
    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256)
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets = unpacked(row["words"], row["lengths"])
                seen = np.frombuffer(row["counts"], np.int64) > 0
                total += np.bincount(data, np.repeat(seen, np.diff(offsets)), minlength=256)
                total[WORD_END] += seen.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["byte", "n"])

    found = lists.mapInArrow(letters, "byte long, n double").groupBy("byte").agg(
        F.sum("n").alias("n")).collect()
    frequency = np.zeros(256)
    for row in found:
        frequency[row.byte] = row.n
    tree = Tree.of(frequency)
    block = 1 << 14

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(2 << SLOT_BITS, np.float32)
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets = unpacked(row["words"], row["lengths"])
                seen = (np.frombuffer(row["counts"], np.int64) > 0).astype(np.float32)
                for a, b in word_batches(offsets):
                    word, _, branch, slots = bits_of(tree, data[offsets[a]:offsets[b]],
                                                     offsets[a:b + 1] - offsets[a])
                    weight = seen[a:b][word]
                    for slot in slots:
                        np.add.at(table, slot.astype(np.int64) * 2 + branch, weight)
        table = table.reshape(-1, 2).T
        some = table.any(axis=0)
        for k in range(0, 1 << SLOT_BITS, block):
            at = np.flatnonzero(some[k:k + block])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([blob(at.astype(np.uint16))], pa.binary()),
                     pa.array([blob(table[:, k + at])], pa.binary())], ["block", "at", "counts"])

    def merge(parts: pa.Table) -> pa.Table:
        total = np.zeros((2, block), np.float32)
        for at, counts in zip(parts["at"].to_pylist(), parts["counts"].to_pylist(), strict=True):
            at = np.frombuffer(at, np.uint16)
            total[:, at] += np.frombuffer(counts, np.float32).reshape(2, -1)
        return pa.table({"block": parts["block"].slice(0, 1), "counts": pa.array([blob(total)])})

    counts = np.zeros((2, 1 << SLOT_BITS), np.float32)
    # The table has a fixed size, 32 MB, however large the corpus is.
    for row in (lists.mapInArrow(partial, "block int, at binary, counts binary").groupBy("block")
                .applyInArrow(merge, "block int, counts binary").toLocalIterator()):
        counts[:, row.block:row.block + block] = np.frombuffer(
            row["counts"], np.float32).reshape(2, -1)
    return tree, counts


def learned_mixer(lists: DataFrame, shared) -> Mixer:
    """Weights learned online in each task, averaged by the bits they have seen."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, counts = shared.value
        counts = np.ascontiguousarray(counts.T).reshape(-1)
        mixer, fresh, bits = Mixer.fresh(), Mixer.fresh(), 0
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets = unpacked(row["words"], row["lengths"])
                seen = np.frombuffer(row["counts"], np.int64)
                for a, b in word_batches(offsets):
                    word, place, branch, slots = bits_of(tree, data[offsets[a]:offsets[b]],
                                                         offsets[a:b + 1] - offsets[a])
                    use = seen[a:b][word] > 0
                    word, place, branch, slots = word[use], place[use], branch[use], slots[:, use]
                    # Each word learns from the others: its own part is taken out.
                    inputs, known = predicted_by_others(counts, slots, branch)
                    mixer.learn(inputs, gates(known, place), branch, np.ones(len(word), np.float32))
                    bits += len(word)
        if bits:
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(bits)]), pa.array([blob(mixer.weights * np.float32(bits))], pa.binary()),
                 pa.array([blob(mixer.hits - fresh.hits)], pa.binary())], ["bits", "weights", "hits"])

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, weights, hits = 0.0, 0.0, 0.0
        for part in parts:
            for row in part.to_pylist():
                bits += row["bits"]
                weights = weights + np.frombuffer(row["weights"], np.float32).astype(np.float64)
                hits = hits + np.frombuffer(row["hits"], np.float64)
        if bits:
            yield pa.RecordBatch.from_arrays(
                [pa.array([bits]), pa.array([blob(weights.astype(np.float32))], pa.binary()),
                 pa.array([blob(hits)], pa.binary())], ["bits", "weights", "hits"])

    schema = "bits double, weights binary, hits binary"
    # One row of a fixed size from each task.
    parts = lists.mapInArrow(learn, schema).repartition(1).mapInArrow(add, schema).collect()
    mixer = Mixer.fresh()
    for row in parts:
        mixer.weights = (np.frombuffer(row.weights, np.float32) / row.bits).reshape(
            GATES, INPUTS).astype(np.float32)
        mixer.hits = mixer.hits + np.frombuffer(row.hits, np.float64).reshape(mixer.hits.shape)
    return mixer
