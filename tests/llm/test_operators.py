"""The corpus operators against plain versions, and on nulls, repeats and empty tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import (arrays, bpe, exact_dedup, forest_dedup, lm_mixing, packing, quality,
                           substring_dedup, suffix_dedup, toxicity, url_filters)
from tapeworks.llm.queries import checksum, vocabulary
from tests.llm import brute
from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# Kernels ------------------------------------------------------------------------

def test_leftmost_minimum_and_grams():
    pick = np.random.default_rng(1)
    values = pick.integers(0, 5, 90_000).astype(np.uint64) << np.uint64(40)
    for width in (1, 3, 24, 81):
        want = np.lib.stride_tricks.sliding_window_view(values, width).argmin(axis=1)
        assert (arrays.leftmost_minimum(values, width) == want + np.arange(len(want))).all()
    runs = arrays.grams(values, 4)
    seen = {}
    for k in range(0, len(runs), 7):
        assert seen.setdefault(tuple(values[k:k + 4].tolist()), runs[k]) == runs[k]
    assert len(set(seen.values())) == len(seen)


def test_checksums_of_parts():
    data, shift = random.Random(3).randbytes(9000), packing.Shift()
    for cut in (0, 4, 128, 4096, 8996):
        assert shift.part(zlib.crc32(data[:cut]), zlib.crc32(data), len(data) - cut) \
            == zlib.crc32(data[cut:])


@pytest.mark.parametrize("seed", range(4))
def test_column_wise_construction(seed):
    pick = random.Random(seed)
    width = 5
    strings = [bytes(pick.choice(b"abc"[:2 + seed % 2]) for _ in range(pick.randint(width, 14)))
               for _ in range(30 + 20 * seed)]
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
    string, offset, head = suffix_dedup.common_windows(
        np.frombuffer(b"".join(strings), np.uint8), offsets, width)
    windows = [strings[i][k:k + width] for i, k in zip(string, offset)]
    assert len(windows) == sum(len(s) - width + 1 for s in strings)
    assert windows == sorted(windows)
    assert head.tolist() == [True] + [a != b for a, b in zip(windows, windows[1:])]


@pytest.mark.parametrize("seed", range(6))
def test_construction_by_seeds(seed):
    """Strings around one seed: all windows found twice are found, the others may be left out."""
    pick, width = random.Random(seed), 8
    sides = [bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 6))) for _ in range(12)]
    strings = sorted({pick.choice(sides) + b"xyz" + pick.choice(sides) for _ in range(60)})
    strings = [s for s in strings if len(s) >= width]
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
    behind = np.array([len(s) - s.index(b"xyz") for s in strings])
    string, offset, head = suffix_dedup.common_windows(
        np.frombuffer(b"".join(strings), np.uint8), offsets, width, behind)
    windows = [strings[i][k:k + width] for i, k in zip(string, offset)]
    # Windows hold the seed wherever the operator cuts segments.
    every = Counter(w for s in strings for k in range(len(s) - width + 1)
                    if b"xyz" in (w := s[k:k + width]))
    found = Counter(w for w in windows if b"xyz" in w)
    assert all(found[w] == n for w, n in every.items() if n > 1) and found <= every
    assert windows == sorted(windows)
    assert head.tolist() == [True] * (len(head) > 0) + [a != b for a, b in zip(windows, windows[1:])]


# Operators ----------------------------------------------------------------------

def plain_scores(rows):
    counts, split = Counter(), []
    for i, text in rows:
        words = brute.split((text or "").translate(LOWER))
        train = zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
        split.append((i, words + [None], train))
        if train:
            counts.update(words + [None])
    n, v = sum(counts.values()), len(counts)
    return {i: (not train, len(w), sum(counts[x] > 0 for x in w), n,
                sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for i, w, train in split}


def test_lm_scores(docs, rows):
    want = plain_scores(rows)
    for r in lm_mixing.scored(docs, checksum() % 7 != 2).collect():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4])
        assert r.score < 0


def test_lm_probabilities_add_up():
    """All words of one byte, and all continuations, share at most the whole probability."""
    tree = lm_mixing.Tree.of(np.bincount(np.frombuffer(b"some letters", np.uint8), minlength=256))
    assert sum(2.0 ** -tree.lengths) == pytest.approx(1)
    counts = np.random.default_rng(2).integers(0, 9, (2, 1 << lm_mixing.SLOT_BITS)).astype(np.float32)
    one = [bytes([b]) for b in range(256) if b != lm_mixing.WORD_END]
    data = np.frombuffer(b"".join(one), np.uint8)
    bits = lm_mixing.word_bits(tree, counts, lm_mixing.Mixer.fresh(), data, np.arange(len(one) + 1))
    assert 0 < (10.0 ** bits).sum() < 1


def test_lm_matches_are_a_distribution():
    """Over all next words, the mixed probabilities add up as the plain ones do."""
    history, words = [0, 1, 2, 0, 1, 2, 0, 1], 5
    total = 0.0
    for nxt in range(words):
        word = np.array([*history, nxt])
        cost = np.full(len(word), math.log10(1 / words))
        total += 10.0 ** lm_mixing.with_matches(cost, word, np.zeros(len(word), np.int64), words)[-1]
    assert total == pytest.approx(1)


def test_lm_beats_the_base_where_texts_repeat(spark):
    texts = [(i, prose(i, 150) + "\n" + prose(i, 150)) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    scores = lm_mixing.scored(docs, checksum() % 7 != 2).where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert scores[0] > scores[1]


def test_lm_reads_running_text(spark):
    """A held-out text scores higher than its words in another order: the order of the
    training texts is part of the model."""
    names = [f"w{i}" for i in range(200)]
    phrase = [[names[(7 * i + k * (i % 5 + 1)) % 200] for k in range(12)] for i in range(40)]
    texts = [(i, " ".join(w for j in range(8) for w in phrase[(i * 3 + j * j) % 40])) for i in range(70)]
    held = next(i for i, _ in texts if zlib.crc32(str(i).encode()) % 7 == 2)
    # The next held-out number carries the same words in an order of its own.
    other = next(i for i in range(70, 200) if zlib.crc32(str(i).encode()) % 7 == 2)
    texts.append((other, " ".join(sorted(texts[held][1].split(), key=lambda w: zlib.crc32(w.encode()) % 97))))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r for r in lm_mixing.scored(docs, checksum() % 7 != 2).collect()}
    assert found[held].base_score == pytest.approx(found[other].base_score)
    # Known words: without contexts across words both have the price of their words.
    assert found[held].n_known == found[held].n_tokens
    assert found[held].score > 0.7 * found[other].score


def test_lm_running_text_is_a_distribution():
    """Whatever the choice has learned, the mixed probabilities of all next tokens add up to one."""
    n, follow, total = 6, np.array([4, 0, 3, 1, 0, 2]), 0.0
    for nxt in range(n):
        pair = np.concatenate((np.tile([2, 3, 0], 20), [follow[nxt]]))
        context = np.concatenate((np.full(60, 7), [follow.sum()]))
        names = (np.arange(61, dtype=np.uint64) + np.uint64(5)) << np.uint64(50)
        cost = np.full(61, math.log10(1 / n))
        score = lm_mixing.in_text(cost, pair, context, names, np.zeros(61, np.int64),
                                  np.concatenate((np.ones(60, bool), [False])), cost)
        total += 10.0 ** score[-1]
    assert total == pytest.approx(1)


def plain_pairs(texts):
    """Training counts of (word before, word), an end standing before and behind each text."""
    found = Counter()
    for words in texts:
        found.update(zip([None, *words], [*words, None], strict=True))
    return found


def test_lm_counts_pairs_over_all_chunks(spark, monkeypatch):
    """The counts that a chunk hears of are those of all training texts, in whatever chunks."""
    texts = [(i, " ".join(f"w{(i * i + k) % 11}" for k in range(i % 9))) for i in range(60)] + [(60, None)]
    train = [brute.split(t or "") for i, t in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    want = plain_pairs(train)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)

    # No choice is made, so a token scores what its context says alone.
    def context_only(cost, pair, context, names, doc, own, alone):
        return pair * 1000.0 + context

    monkeypatch.setattr(lm_mixing, "in_text", context_only)
    before = Counter()
    for (a, _), n in want.items():
        before[a] += n
    for r in lm_mixing.scored(docs, checksum() % 7 != 2).collect():
        words = brute.split(dict(texts)[r.doc_id] or "")
        steps = list(zip([None, *words], [*words, None], strict=True))
        assert r.score == sum(1000.0 * want[s] + before[s[0]] for s in steps)


def plain_quality(text):
    words, lines = brute.split(text), (text or "").split("\n")
    seen, dup = set(), 0
    for line in lines:
        if brute.split(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    inside = set()
    for k in range(len(words) - 4):
        if count[tuple(words[k:k + 5])] > 1:
            inside.update(range(k, k + 5))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside))


def test_quality(docs, rows):
    found = {r.doc_id: r for r in quality.score(docs).collect()}
    for i, text in rows:
        r, want = found[i], plain_quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == brute.quality_kept(text)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}
    assert found[10].kept and not found[23].kept and not found[26].kept


def test_substring_dedup(docs, rows):
    got = collected(substring_dedup.repeated_words(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.repeated_words(rows), key=repr)
    assert sum(r[2] for r in got) > 500


def test_suffix_dedup(docs, rows):
    got = collected(suffix_dedup.later_bytes(docs),
                    "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.repeated_bytes(rows), key=repr)
    cut = suffix_dedup.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert cut.where("doc_id = 10").first().text == rows[0][1]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_are_the_librarys(rows, name):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary(name))
    encoder = bpe.Encoder(bpe.Vocabulary.read(vocabulary(name)))
    texts = [t for _, t in rows] + ["ΑΣ ΑΣ. don't WE'LL", "<|startoftext|>A<|endoftext|> a<|x", "ǅ ﬁ é"]
    ids, ends = encoder.encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[ends[k]:ends[k + 1]].tolist() == \
            library.encode(text or "", add_special_tokens=False).ids


def test_bpe_round_trip(docs, rows):
    from tokenizers import Tokenizer
    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()),
                     brute.sha(library.decode(ids, skip_special_tokens=False))))
    assert collected(bpe.round_trip(docs, path),
                     "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_toxicity(spark):
    pick = random.Random(5)
    texts, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        words = prose(i, 60).split(" ")
        if toxic:
            words[pick.randrange(60)] = pick.choice(("vilest", "v1lest", "vіlest", "ViLeSt,"))
        elif i % 11 == 0:
            words[30:32] = ["not", "vilest"]
        texts.append((i, " ".join(words)))
        labels.append((i, int(toxic), None))
    docs = spark.createDataFrame([*texts, (None, None)], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1, None), (7, None, None)],
                                  "doc_id long, toxic int, quality int")
    found = toxicity.scored(docs, marks, checksum() % 4 != 2).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 401 and len(held) > 50
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_toxicity_without_labels(docs, none, spark):
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    assert len({r.score for r in toxicity.scored(docs, marks, checksum() % 4 != 2).collect()}) == 1


def plain_rule(host, path, rules):
    fitting = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (max(fitting)[3:] if fitting and host else (None, "allow"))


def test_url_filters(spark):
    urls = ["http://Example.ORG/es/1", "http://a.b.example.org/en/1?x=/es/", "https://example.org/en/2",
            "http://example.org", "http://badexample.org/es/", "x://com/fr/", "http://a.com/de/#t",
            "http://com.net/de/", "no scheme", "", None, "http://", "http:///fr/", "http://org/a\nb",
            "http://a..org/es/", "HTTP://u:p@EXAMPLE.org:80/es/", "http://é.org/ü", "http://x.com/fr/de/"]
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls * 2)],
                                  "page_id long, url string, rule string")
    table = spark.createDataFrame(rules, url_filters.RULES)
    for r in url_filters.judge(pages, table).collect():
        url = urls[r.page_id % len(urls)] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = rest[:min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))]
        path = rest[len(host):]
        path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
        host = host.translate(LOWER)
        assert (r.host, r.path, (r.rule, r.verdict)) == (host, path, plain_rule(host, path, rules))
    assert {r.verdict for r in url_filters.judge(pages, table.limit(0)).collect()} == {"allow"}
    assert url_filters.judge(pages.limit(0), table).count() == 0


def test_packing(docs, rows):
    from tokenizers import Tokenizer
    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    pieces = packing.packed(docs, path).collect()
    places, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        part = ids[p.doc_id][p.start:p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and len(part) == p.length
        assert p.doc_tokens == len(ids[p.doc_id])
        places[p.doc_id].append((p.start, p.length))
        windows[p.sequence_id].append((p.offset, p.length))
    for found, sizes in ((places, {i: len(x) for i, x in ids.items()}), (windows, None)):
        for name, parts in found.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == sizes[name] if sizes else at <= packing.WINDOW


def test_near_duplicates(docs, rows):
    got = collected(forest_dedup.clusters(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near_duplicates(rows), key=repr)
    kept = forest_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, c in got if i == c}


def test_large_clusters_come_apart_by_region(spark, monkeypatch):
    monkeypatch.setattr(forest_dedup, "CLUSTER", 12)
    rows = []
    for i in range(60):
        words = prose(50 + i % 3, 120).split(" ")
        for k in range(i // 20):
            words[(7 * i + 31 * k) % 120] = f"w{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(forest_dedup.clusters(docs), "doc_id", "n_shingles", "component_id") == sorted(
        brute.near_duplicates(rows), key=repr)


@pytest.mark.parametrize("percent", [80, 85])
def test_all_pairs_of_large_clusters_meet(spark, monkeypatch, percent):
    """One template whose signatures tell nothing apart, in far more classes than a group takes."""
    monkeypatch.setattr(forest_dedup, "CLUSTER", 4)
    monkeypatch.setattr(forest_dedup, "signatures", lambda hashes, offsets: np.zeros(
        (np.count_nonzero(np.diff(offsets)), forest_dedup.HASHES), np.uint32))
    base, rows = prose(700, 300).split(), []
    for i in range(40):
        words = list(base)
        for k in range(8):
            words[10 + 35 * k + i % 20] = f"own{i % 20}-{k}"
        if i >= 20:
            for k in range(3):
                words[20 + 90 * k] = f"second{i}-{k}"
        rows.append((i, " ".join(words)))
    want = sorted(brute.near_duplicates(rows, percent), key=repr)
    assert 10 < len({c for _, _, c in want}) < 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(forest_dedup.clusters(docs, percent), "doc_id", "n_shingles", "component_id") == want


def test_candidates_in_crowded_regions(spark):
    """600 implausible classes of one region stand between two that share 49 of 64 hashes."""
    values = np.random.default_rng(1).integers(0, 1 << 32, (602, forest_dedup.HASHES), np.uint32)
    values[:, :forest_dedup.DEPTH] = values[0, :forest_dedup.DEPTH]
    values[601] = values[0]
    values[601, forest_dedup.DEPTH::forest_dedup.DEPTH] ^= 0xFFFFFFFF
    classes = spark.createDataFrame([(i, 100, bytearray(v.tobytes())) for i, v in enumerate(values)],
                                    "node long, n long, signature binary")
    assert {frozenset(r) for r in forest_dedup.candidates(classes, 85).collect()} == {frozenset((0, 601))}


def test_meetings_cover_every_pair_of_different_kin(spark):
    rows = [(k, n, n % 3 if n < 60 else n) for k in (1, 2) for n in range(80)] + [(3, n, 0) for n in range(30)]
    met = forest_dedup.meetings(spark.createDataFrame(rows, "key long, node long, kin long"), ["key"], 8)
    groups = {}
    for r in met.collect():
        groups.setdefault((r.key, r.meeting), []).append((r.node, r.kin))
    assert {k for k, _ in groups} == {1, 2}
    for key in (1, 2):
        seen = {(a, b) for (k, _), g in groups.items() if k == key for a, _ in g for b, _ in g}
        assert all((a, b) in seen for k, a, x in rows if k == key
                   for j, b, y in rows if j == key and x != y)


def test_exact_dedup(docs, rows):
    found = {r.doc_id: r for r in exact_dedup.group(docs).collect()}
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(LOWER)].append(i)
    for body, ids in groups.items():
        for i in ids:
            r = found[i]
            assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), i == max(ids))
            assert r.text_sha256 == hashlib.sha256(body.encode()).hexdigest()
    assert {r.doc_id for r in exact_dedup.kept_documents(docs).collect()} == {
        max(ids) for ids in groups.values()}


# Odd tables ---------------------------------------------------------------------

OPERATORS = {
    "lm": lambda d: lm_mixing.scored(d, checksum() % 7 != 2),
    "quality": quality.score,
    "substrings": substring_dedup.repeated_words,
    "bpe": lambda d: bpe.round_trip(d, vocabulary("byte_bpe_50k.json")),
    "toxicity": lambda d: toxicity.scored(d, d.select("doc_id", F.lit(1).alias("toxic")),
                                          checksum() % 4 != 2),
    "packing": lambda d: packing.packed(d, vocabulary("word_bpe_49k.json")),
    "suffixes": suffix_dedup.later_bytes,
    "forest": forest_dedup.clusters,
    "exact": exact_dedup.group,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(none, name):
    assert OPERATORS[name](none).collect() == []


@pytest.mark.parametrize("name", list(OPERATORS))
def test_repeated_and_missing_ids(odd_ids, name):
    found = OPERATORS[name](odd_ids).collect()
    assert Counter(r.doc_id for r in found) == Counter({1: 2, None: 2, 2: 1, 3: 1})
    if name == "suffixes":
        # The first of the equal rows stays whole, the others keep nothing.
        assert sorted(r.n_bytes - r.n_removed > 0 for r in found if r.n_bytes) == [False] * 3 + [True]
    if name == "forest":
        assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 3), (None, None)}
    if name == "exact":
        assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == {
            (1, 2, 4), (2, 2, 4), (None, 2, 4), (None, 3, 2), (3, 3, 2)}


def test_a_text_longer_than_a_chunk(spark):
    """Over four megabytes in one text, with a passage that a short one shares."""
    passage = prose(77, 60)
    words = [f"w{i}" for i in range(650_000)]
    long = " ".join([*words[:400_000], passage, *words[400_000:]])
    assert len(long) > 4 << 20
    docs = spark.createDataFrame([(1, long), (2, passage + " tail end"), (3, "short")], "doc_id long, text string")
    n = len(brute.split(long))
    assert collected(substring_dedup.repeated_words(docs), "doc_id", "n_words", "n_removed") == [
        (1, n, 60), (2, 62, 60), (3, 1, 0)]
    assert collected(suffix_dedup.later_bytes(docs), "doc_id", "n_bytes", "n_removed", "n_spans") == [
        (1, len(long.encode()), 0, 0), (2, len(passage.encode()) + 9, len(passage.encode()) + 1, 1), (3, 5, 0, 0)]
    assert collected(forest_dedup.clusters(docs), "doc_id", "n_shingles", "component_id") == [
        (1, n - 4, 1), (2, 58, 2), (3, 1, 3)]
    assert collected(exact_dedup.group(docs), "doc_id", "keep_id", "group_size") == [
        (1, 1, 1), (2, 2, 1), (3, 3, 1)]
    assert [r[1] for r in collected(quality.score(docs), "doc_id", "n_words")] == [n, 62, 1]
