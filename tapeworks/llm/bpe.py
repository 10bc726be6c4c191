"""BPE encoding and decoding in batched numpy merge rounds.

A batch is cut into words; only distinct words are encoded.  Their symbols lie
in one flat array.  In each round every word merges its lowest-ranked pair, at
all places from left to right; ranks come from a binary search over sorted pair
keys, and only pairs that a merge has touched are searched again.  Words without
a known pair leave the array.

Null and empty texts have no tokens.  Texts are encoded one by one, so repeated
rows, ties and other columns play no part; an empty table gives an empty result.
A single word may be as long as its document.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tapeworks.llm.arrays import flags, flat, slices
from tapeworks.llm.staging import identified

SLICE_BYTES = 4 << 20
# Distinct words a task remembers before it forgets them all.
REMEMBERED = 250_000
NO_RANK = np.int32(1 << 30)
# How the two public vocabularies split texts.  White space is
# spelled as the Unicode property, which is what their own library goes by.
BYTE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
WORD_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = CAPITALS + CAPITALS.lower()


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """Merge tables as sorted arrays."""

    inner: np.ndarray      # symbol of each byte inside a word
    last: np.ndarray       # symbol of each byte at a word's end
    keys: np.ndarray       # sorted (left symbol << 32 | right symbol)
    ranks: np.ndarray
    merged: np.ndarray
    token_bytes: bytes     # bytes of all tokens, one after the other
    token_ends: np.ndarray
    specials: tuple[tuple[str, int], ...]
    lower: bool            # lower-case words without white space, or bytes with it

    @staticmethod
    def read(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        specials = tuple((t["content"], t["id"]) for t in spec["added_tokens"])
        number = {letter: b for b, letter in enumerate(letters)}
        size = max(*ids.values(), *(i for _, i in specials)) + 1
        pieces = [b""] * size
        for token, i in ids.items():
            body = token[:len(token) - len(suffix)] if suffix and token.endswith(suffix) else token
            pieces[i] = bytes(number[c] for c in body)
        for token, i in specials:
            pieces[i] = token.encode()
        return Vocabulary(
            np.array([ids[c] for c in letters], np.int32),
            np.array([ids[c + suffix] for c in letters], np.int32),
            keys[order], order.astype(np.int32), merged[order].astype(np.int32), b"".join(pieces),
            np.cumsum([len(p) for p in pieces]), specials, bool(suffix))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of many runs, one after the other (below 2**31: a slice's)."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int32)
    out = np.repeat((starts - (ends - lengths)).astype(np.int32), lengths)
    out += np.arange(len(out), dtype=np.int32)
    return out


def merge_words(vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray):
    """Token ids of each word (non-empty byte spans) and their offsets."""
    n = len(offsets) - 1
    symbols = vocab.inner[data]
    symbols[offsets[1:] - 1] = vocab.last[data[offsets[1:] - 1]]
    word = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))

    def rank_at(left, right):
        keys = left.astype(np.int64) << 32 | right
        place = np.minimum(np.searchsorted(vocab.keys, keys), len(vocab.keys) - 1)
        known = vocab.keys[place] == keys
        return np.where(known, vocab.ranks[place], NO_RANK), vocab.merged[place]

    def ranked(symbols, word):
        rank, into = np.full(len(symbols), NO_RANK), np.zeros(len(symbols), np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], into[inner] = rank_at(symbols[inner], symbols[inner + 1])
        return rank, into

    rank, into = ranked(symbols, word)
    done_symbols, done_words = [], []
    while len(symbols):
        heads = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        lowest = np.minimum.reduceat(rank, heads)
        alive = np.repeat(lowest < NO_RANK, np.diff(np.append(heads, len(word))))
        if not alive.all():
            done_symbols.append(symbols[~alive])
            done_words.append(word[~alive])
            symbols, word, rank, into = symbols[alive], word[alive], rank[alive], into[alive]
            if not len(symbols):
                break
            heads = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = lowest[lowest < NO_RANK]
        at = np.flatnonzero(rank == np.repeat(lowest, np.diff(np.append(heads, len(word)))))
        # Of pairs that overlap (one symbol twice in a row) every other one merges.
        if len(at) > 1:
            new_run = np.concatenate(([True], np.diff(at) != 1))
            number = np.arange(len(at))
            at = at[(number - np.maximum.accumulate(np.where(new_run, number, 0))) % 2 == 0]
        symbols[at] = into[at]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        symbols, word, rank, into = symbols[keep], word[keep], rank[keep], into[keep]
        near = np.zeros(len(symbols) + 1, bool)
        near[place[at]] = True
        near[:-1] |= near[1:]
        touched = np.flatnonzero(near[:-1])
        rank[touched] = NO_RANK
        inner = touched[touched + 1 < len(symbols)]
        inner = inner[word[inner] == word[inner + 1]]
        rank[inner], into[inner] = rank_at(symbols[inner], symbols[inner + 1])
    symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int32)
    word = np.concatenate(done_words) if done_words else np.zeros(0, np.int32)
    order = np.argsort(word, kind="stable")
    ends = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(word, minlength=n), out=ends[1:])
    return symbols[order], ends


def _odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold white space beyond ASCII or ``<|``, where words can't be cut apart."""
    at = np.flatnonzero(flags((0x3C, 0xC2, 0xE1, 0xE2, 0xE3))[data])
    padded = np.append(data, (0, 0)).astype(np.int32)
    first, second, third = padded[at], padded[at + 1], padded[at + 2]
    two, three = first << 8 | second, first << 16 | second << 8 | third
    odd = (two == 0x3C7C) | (two == 0xC285) | (two == 0xC2A0) | (three == 0xE19A80) | (
        (three >= 0xE28080) & (three <= 0xE2808A)) | np.isin(
        three, (0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080))
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, at[odd], "right") - 1] = True
    return out


def _lowered(word: str) -> str:
    if word.isascii():
        return word.lower()
    word = unicodedata.normalize("NFC", word)
    return "".join(c.lower() for c in word) if "Σ" in word else word.lower()


class Encoder:
    """Encodes slices of texts; one for each task."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        pattern = WORD_PATTERN if vocab.lower else BYTE_PATTERN
        self.find: Callable[[str], list[str]] = regex.compile(pattern).findall
        self.special = {text.encode(): i for text, i in vocab.specials}
        self.forget()
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t, _ in vocab.specials) + ")") \
            if vocab.specials else None

    def _pieces(self, unit: str) -> list:
        """Pieces of a unit to merge, as text, and special tokens, as ids."""
        find = self.find
        if "<|" in unit and self.cut:
            out = []
            for part in self.cut.split(unit):
                if (i := self.special.get(part.encode())) is not None:
                    out.append(i)
                    self.added = True
                elif part:
                    out += find(_lowered(part) if self.vocab.lower else part)
            return out
        if self.vocab.lower:
            unit = _lowered(unit)
            return [unit] if unit.isalpha() else find(unit)
        return [unit] if unit[:1] == " " and unit[1:].isalpha() else find(unit)

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column and the offsets of each text."""
        data, offsets = flat(column)
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        space = flags((9, 10, 11, 12, 13, 32))[data]
        plain = ~np.repeat(_odd_texts(data, offsets), np.diff(offsets))
        before = np.concatenate(([0], data[:-1]))
        if self.vocab.lower:
            # Units: words without white space; a mark after a letter is one of its own.
            head = ~space & flags((0, 9, 10, 11, 12, 13, 32))[before]
            head |= flags(b".,;:!?")[data] & flags(LETTERS)[before]
            data = np.where(plain & flags(CAPITALS)[data], data + 32, data).astype(np.uint8)
            kept = ~(space & plain)
        else:
            # Units: a word with the white space before it.
            head = space & ~flags((9, 10, 11, 12, 13, 32))[before]
            kept = np.ones(len(data), bool)
        head &= plain
        some = offsets[:-1][offsets[1:] > offsets[:-1]]
        head[some] = kept[some]
        sums = np.concatenate(([0], np.cumsum(kept)))
        starts, data = sums[np.flatnonzero(head)], data[kept]
        offsets = sums[offsets]
        bounds = np.append(starts, len(data))
        units = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = units.dictionary_encode()
        place = self._places(coded.dictionary.to_pylist())
        which = place[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.lengths[which]
        ids = self.ids[ragged(self.starts[which], lengths)]
        sums = np.concatenate(([0], np.cumsum(lengths)))
        return ids, sums[np.searchsorted(starts, offsets)]

    def forget(self) -> None:
        """Drop the remembered words."""
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _places(self, units: list[bytes]) -> np.ndarray:
        """Where the tokens of each distinct unit are remembered; new units are encoded."""
        if len(self.known) > REMEMBERED:
            self.forget()
        known = self.known
        fresh = [u for u in units if u not in known]
        if fresh:
            pieces, counts, self.added = [], [], False
            for unit in fresh:
                known[unit] = len(known)
                found = self._pieces(unit.decode("utf-8", "replace"))
                pieces += found
                counts.append(len(found))
            tokens, ends = self._tokens(pieces)
            ends = ends[np.concatenate(([0], np.cumsum(counts))).astype(np.int64)]
            self.starts = np.concatenate((self.starts, len(self.ids) + ends[:-1]))
            self.lengths = np.concatenate((self.lengths, np.diff(ends)))
            self.ids = np.concatenate((self.ids, tokens))
        return np.array([known[u] for u in units], np.int64)

    def _tokens(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece and their offsets; distinct pieces are merged once."""
        if self.added:
            texts = pa.array([" " if type(p) is int else p for p in pieces], pa.large_string())
        else:
            texts = pa.array(pieces, pa.large_string())
        coded = texts.dictionary_encode()
        data, offsets = flat(coded.dictionary)
        ids, ends = merge_words(self.vocab, data, offsets)
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = np.diff(ends)[which] if len(which) else np.zeros(0, np.int64)
        starts = ends[:-1][which] if len(which) else np.zeros(0, np.int64)
        special = np.array([type(p) is int for p in pieces], bool) if self.added else None
        if special is not None and special.any():
            added = np.array([p for p in pieces if not isinstance(p, str)], np.int32)
            starts[special] = len(ids) + np.arange(len(added))
            lengths[special] = 1
            ids = np.concatenate((ids, added))
        return ids[ragged(starts, lengths)], np.concatenate(([0], np.cumsum(lengths)))

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """UTF-8 of each run of ids; bytes that are no UTF-8 become U+FFFD."""
        bytes_of = np.frombuffer(self.vocab.token_bytes, np.uint8)
        stops = self.vocab.token_ends
        starts = np.concatenate(([0], stops[:-1]))
        lengths = (stops - starts)[ids]
        data = bytes_of[ragged(starts[ids], lengths)].tobytes()
        cuts = np.concatenate(([0], np.cumsum(lengths)))[ends]
        texts = [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return [t.decode("utf-8", "replace").encode() for t in texts]


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digest of each document's ids and of the text decoded from them."""
    vocab = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocab.value)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                ids, ends = encoder.encode(part["text"])
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], pa.array(np.diff(ends)),
                    pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest()
                              for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)],
                             pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in encoder.decode(ids, ends)],
                             pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return identified(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
