"""Merkle manifest, spelling variants and nearest neighbours against plain versions."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import hash_forest, merkle, spelling
from tapeworks.llm.queries import QUERIES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
# Columns whose names the operators use themselves.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, node int, rank int, path int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# Merkle manifest ------------------------------------------------------------------

def leaf(row, text):
    fields = (row[0], row[3], row[2], row[4], text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def grown(nodes):
    """The top of a list of nodes, and the siblings of each on its way up, as (left, right)."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = nodes[at - at % 16:at - at % 16 + 16]
            paths[i].append((run[:at % 16], run[at % 16 + 1:]))
            where[i] = at // 16
        nodes = [sha(*nodes[k:k + 16]) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of each row."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[3]].append((row[0], leaf(row, row[1]), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    found, subroots = [], []
    for name in names:
        here = sorted(sources[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        top, paths = grown([x[1] for x in here])
        subroots.append(top)
        found.append((here, paths))
    root, upper = grown(subroots) if subroots else (None, [])
    out = []
    for (here, paths), top, above in zip(found, subroots, upper, strict=True):
        for (doc_id, node, row), path in zip(here, paths, strict=True):
            changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
            fold = leaf(row, row[1].translate(LOWER) if changed and row[1] is not None else row[1])
            proof = ""
            for left, right in path + above:
                fold, proof = sha(*left, fold, *right), proof + "".join(left + right)
            out.append((doc_id, node, top, root, sha(proof), fold))
    return sorted(out, key=repr)


def op11(docs):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(chosen, merkle.leaf(text=F.translate(F.col("text"), UPPER, UPPER.lower())))
    store = merkle.build(merkle.leaves(docs, tampered=tampered))
    found = merkle.proofs(store, store.leaves)
    rows = found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256),
                        merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))).collect()
    return sorted(map(tuple, rows), key=repr)


def doc(doc_id, text, source, lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text), "t", 1, 2, 3)


def test_manifest_of_odd_rows(spark):
    rows = [doc(i, f"Text {i}" if i % 7 else None, ("b", "a", None, "é", "")[i % 5]) for i in range(60)]
    rows += [doc(100 + i, "Hot ROW", "hot", None if i % 3 else "de") for i in range(300)]
    rows += [doc(None, "no id", "hot"), doc(None, "no id", "hot"), doc(None, None, None), doc(5, "LONG " * 50_000, "z"),
             doc(7, "", "lone"), doc(101, "Hot ROW", "hot"), doc(101, "other", "hot")]
    got = op11(spark.createDataFrame(rows, DOCS).repartition(7))
    assert got == manifest(rows)
    assert len({r[3] for r in got}) == 1
    assert any(r[5] != r[3] for r in got) and any(r[5] == r[3] for r in got)


@pytest.mark.parametrize("n", [0, 1, 16, 17, 257])
def test_manifest_sizes(spark, n):
    rows = [doc(i, f"t{i}", "one") for i in range(n)]
    assert op11(spark.createDataFrame(rows, DOCS)) == manifest(rows)


def test_many_sources_make_a_tree_of_their_own(spark):
    rows = [doc(i, f"t{i}", f"s{i}") for i in range(300)]
    assert op11(spark.createDataFrame(rows, DOCS)) == manifest(rows)


def test_some_requests_open_their_paths_only(spark):
    rows = [doc(i, f"t{i}", "ab"[i % 2]) for i in range(700)]
    store = merkle.build(merkle.leaves(spark.createDataFrame(rows, DOCS)))
    asked = store.leaves.where(F.col("doc_id").isin(3, 400, 401))
    got = merkle.proofs(store, asked)
    want = {r[0]: r for r in manifest(rows)}
    for r in got.select("doc_id", "leaf", "subroot", "root", "path",
                        merkle.folded(F.col("leaf"), F.col("path")).alias("folded")).collect():
        assert (r.leaf, r.subroot, r.root) == want[r.doc_id][1:4] and r.folded == r.root
        assert sha("".join(s.left + s.right for s in r.path)) == want[r.doc_id][4]
    assert got.count() == 3


# Spelling variants ------------------------------------------------------------------

def variants(words):
    """word -> (form, root, n, n_near, form_n), by comparing all words of fitting lengths."""
    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    others = {w: [v for v in words if v != w and near(w, v)] for w in words}
    form = {}
    for w, vs in others.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return {w: (form[w], root(w), words[w], len(others[w]), words.get(form[w])) for w in words}


def test_variants_against_all_pairs(spark, monkeypatch):
    pick = random.Random(4)
    # Few letters, so that grams are frequent and words crowded.
    words = Counter()
    for _ in range(900):
        word = "".join(pick.choice("abcé") for _ in range(pick.choice((4, 5, 5, 6, 7, 9))))
        words[word] += pick.choice((1, 2, 3, 5, 9, 20, 90))
    for base in ("spelling" * 40, "aaaaaaa"):
        words.update({base: 50, base[1:]: 3, base + "x": 9, "y" + base[1:]: 50})
    rows = [(w, n, 1, "c") for w, n in words.items()] + [("spelling" * 40, 7, 1, "c"), (None, 3, 1, "c"), ("", 2, 1, "c")]
    words["spelling" * 40] += 7
    want = variants({w: n for w, n in words.items() if len(w) >= 5})
    for share in (spelling.SHARE, 40):
        monkeypatch.setattr(spelling, "SHARE", share)
        got = spelling.variants(spark.createDataFrame(rows, "word string, n long, length int, gram string"))
        assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()} == want
    assert sum(v[0] is not None for v in want.values()) > 100 and max(v[3] for v in want.values()) >= 10


def test_grams_hold_their_bound():
    """Two words one edit apart share what the bound says, for any dictionary."""
    pick = random.Random(8)
    for trial in range(3000):
        letters = "ab" if trial % 2 else "abcd"
        word = "".join(pick.choice(letters) for _ in range(pick.randint(5, 11)))
        at = pick.randrange(len(word) + 1)
        other = pick.choice((word[:at] + pick.choice(letters) + word[at:],
                             word[:at] + pick.choice(letters) + word[at + 1:],
                             word[:at] + word[at + 1:] if len(word) > 5 else word + "a"))
        texts = ["".join(pick.choice(letters) for _ in range(8)) for _ in range(12)] + [word, other]
        counts = Counter(t[p:p + q] for t in (f"\x01\x01{t}\x02\x02\x02" for t in texts)
                         for q in range(spelling.QMIN, spelling.QMAX + 1) for p in range(len(t) - q + 1))
        grams = spelling.Grams({g: n for g, n in counts.items() if n > pick.randint(1, 5)}, 5)
        if any(g[:k] not in grams.frequent for g in list(grams.frequent) for k in range(2, len(g))):
            continue  # no dictionary: a longer gram is never more frequent than its beginning
        a, b = grams.rarest(word), grams.rarest(other)
        if word != other:
            assert {g for g, _ in a} & {g for g, _ in b}
        for text, kept in ((word, a), (other, b)):
            padded, first = grams.padded(text)
            places = grams.places(padded)
            hit = grams.affected(padded, places, first, first + 1 + len(text))
            assert hit < len(places) and len(kept) == hit + 1


def test_variants_of_an_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_words_of_documents(spark, docs, rows, tmp_path):
    """The query on the cases: whole texts, nulls, and deleted code points."""
    words = Counter()
    many = [(i + 1000 * k, t) for k in range(3) for i, t in rows] + [(None, "NULLid Élan élan élan nullid nullid")]
    for i, text in many:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            words[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    want = variants({w: n for w, n in words.items() if len(w) >= 5 and n >= 3})
    spark.createDataFrame([(i, t, "word", 1) for i, t in many], "doc_id long, text string, word string, run int"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_gram_variants"](spark, str(tmp_path)).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(want) > 30


# Nearest neighbours -------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, tree int, codes string"


def exact(rows, k=20):
    """query -> list of (score, id), nearest first, over the vectors that take part."""
    good = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in good:
        if q % 20 == 0:
            near = sorted((-float(good[q] @ v), i) for i, v in good.items() if i != q)
            out[q] = [(-s, i) for s, i in near[:k]]
    return out


def vectors(n, seed, spread=0.15):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(12, 8))
    found = centres[pick.integers(0, 12, n)] + spread * pick.normal(size=(n, 8))
    return (found * pick.uniform(0.5, 2, (n, 1))).astype(np.float32).tolist()


def recall(got, want):
    mine = defaultdict(set)
    for r in got:
        mine[r.query_id].add(r.vec_id)
    return sum(len(mine[q] & {i for _, i in near}) for q, near in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize("limits", [{}, {"rows_per_task": 100, "queries_per_task": 7}])
def test_neighbours_and_their_recall(spark, limits):
    rows = [(i, v, 1, 2, "c") for i, v in enumerate(vectors(1500, 5))]
    # A vector that a third of the rows have, longer than others, and rows that take no part.
    rows[7] = (7, [5 * x for x in rows[7][1]], 1, 2, "c")
    rows += [(2000 + i, rows[7][1], 1, 2, "c") for i in range(700)]
    nan, inf = float("nan"), float("inf")
    rows += [(4000, None, 1, 2, "c"), (4020, [0.0] * 8, 1, 2, "c"), (4040, [nan] * 8, 1, 2, "c"),
             (4060, [inf] + [1.0] * 7, 1, 2, "c"), (4080, [None] + [1.0] * 7, 1, 2, "c"),
             (4100, [1.0] * 3, 1, 2, "c"), (None, [1.0] * 8, 1, 2, "c"), (40, rows[40][1], 1, 2, "c")]
    want = exact(rows)
    got = hash_forest.neighbours(spark.createDataFrame(rows, VECTORS).repartition(5),
                                 F.col("vec_id") % 20 == 0, **limits).collect()
    assert recall(got, want) >= 0.9
    by_query = defaultdict(list)
    for r in got:
        by_query[r.query_id].append((r.rank, -r.score, r.vec_id))
    assert set(by_query) == set(want)
    vector = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows if i is not None and v and i < 4000}
    for q, near in by_query.items():
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, 21))
        assert [x[1:] for x in near] == sorted(x[1:] for x in near)
        assert q not in {i for _, _, i in near} and len({i for _, _, i in near}) == 20
        assert all(abs(-s - vector[q] @ vector[i]) < 1e-12 for _, s, i in near)
    # Equal vectors: the smallest ids, the query's own left out.
    hot = [i for _, i in want[2020]]
    assert [i for _, _, i in sorted(by_query[2020])] == hot == [7, *(2000 + i for i in range(19))]


def test_few_vectors_are_all_found(spark):
    rows = [(i, v, 1, 2, "c") for i, v in enumerate(vectors(9, 6))] + [(20, [1.0] * 8, 1, 2, "c")]
    got = hash_forest.neighbours(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).collect()
    want = exact(rows)
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == {
        (q, k + 1, i) for q, near in want.items() for k, (_, i) in enumerate(near)}


@pytest.mark.parametrize("rows", [[], [(1, [1.0] * 8, 1, 2, "c")], [(20, None, 1, 2, "c")], [(20, [1.0] * 8, 1, 2, "c")]])
def test_no_queries_or_no_candidates(spark, rows):
    df = hash_forest.neighbours(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0)
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and df.collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_recall_on_the_test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    vectors = {i: np.array(v) for i, v in rows}
    want = {q: sorted((-float(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:20]
            for q in vectors if q % 20 == 0}
    got = QUERIES["op13_hash_prefix_forest"](spark, "/root/testdata/sf0.01").collect()
    assert recall(got, want) >= 0.9
