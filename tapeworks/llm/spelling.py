"""Spelling variants: words one edit apart, found by an index of variable-length grams.

1. **Gram dictionary.**  Grams of ``QMIN`` to ``QMAX`` code points are counted in
   all padded words.  Frequent ones, with more than a ``SHARE``-th of all places,
   are kept: at most ``SHARE`` of each length, so the dictionary is small however
   many words there are.  A gram is extended as long as it is frequent; that cuts
   long lists of short grams into many short lists.
2. **Decomposition.**  A word has the longest gram from each place, without those
   inside an earlier one.
3. **Affected grams.**  For each place of an edit the grams that the edit may
   destroy are: those over the place, and those behind it that a frequent gram,
   reaching over the place, could swallow.  (None before it: what would swallow
   them in the changed word does so already.)  With the most of these, ``hit``,
   two words one edit apart share at least ``grams - hit`` grams of either, at
   places that agree up to the change of length.  Then the ``hit + 1`` rarest grams
   of one and of the other already have one in common, so only these lists are
   merged.  Padding makes sure that ``hit < grams`` for every word.
4. **Verification.**  Pairs of the merged lists that differ by at most two letters
   are compared exactly.

No list is cut.  A word is a row once; repeated words are added up, null and too
short ones left out.  Equal counts are settled by code-point order.  Very long
words are decomposed like others (the cost is linear, up to a factor of
``QMAX``).  An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.staging import partitions, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed value: what a run of letters is, after A-Z are lower-cased.
LETTERS = "[a-zÀ-ÿ]+"
QMIN, QMAX = 2, 5
# A gram is frequent with more than 1 / SHARE of all places.
SHARE = 50_000
MIN_LENGTH = 5
FRONT, BACK = "\x01", "\x02"


def letter_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and each maximal run of letters, one row a place."""
    text = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    return docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))


def without_point(word: Column, at: Column) -> Column:
    """The word without its code point at ``at``, from 0."""
    return F.concat(F.left(word, at), F.substr(word, at + 2))


class Grams:
    """Decomposition of words by a dictionary of frequent grams."""

    def __init__(self, frequent: dict[str, int], min_length: int):
        self.frequent = frequent
        self.tails = {g[k:] for g in frequent if len(g) < QMAX for k in range(1, len(g))}
        self.min_length = min_length

    def padded(self, word: str) -> tuple[str, int]:
        """The word between paddings, and the place of the last one before it."""
        # From 2 * QMAX places on, some gram lies out of each edit's reach.
        more = max(2, 2 * QMAX - self.min_length)
        front = more // 2
        return FRONT * front + word + BACK * (more - front), front - 1

    def places(self, text: str) -> list[tuple[int, int]]:
        """First and last place of each kept gram."""
        kept, last, n = [], -1, len(text)
        for p in range(n - QMIN + 1):
            end = p + QMIN
            while end - p < QMAX and end < n and text[p:end] in self.frequent:
                end += 1
            if end - 1 > last:
                last = end - 1
                kept.append((p, last))
        return kept

    @staticmethod
    def letters(word: str) -> int:
        """Which code points occur, modulo 63: one edit changes at most two bits."""
        bits = 0
        for c in set(word):
            bits |= 1 << ord(c) % 63
        return bits

    def affected(self, text: str, kept: list[tuple[int, int]], first: int, stop: int) -> int:
        """The most grams that one edit between ``first`` and ``stop`` can destroy."""
        most = 0
        for site in range(first, stop):
            hit = 0
            for p, end in kept:
                if p > site:
                    if end - site >= QMAX:
                        break
                    hit += text[site + 1:end] in self.tails
                else:
                    hit += end >= site
            most = max(most, hit)
        return most

    def rarest(self, word: str) -> list[tuple[str, int]]:
        """The grams, with their places, that a word has to be looked up by."""
        text, first = self.padded(word)
        kept = self.places(text)
        hit = self.affected(text, kept, first, first + 1 + len(word))
        grams = sorted((self.frequent.get(text[p:end + 1], 0), text[p:end + 1], p) for p, end in kept)
        return [(gram, p) for _, gram, p in grams[:hit + 1]]


def frequent_grams(words: DataFrame, min_length: int) -> dict[str, int]:
    """Grams with more than a ``SHARE``-th of all places, and their counts."""
    plain = Grams({}, min_length)
    pad = len(plain.padded("")[0])
    total = words.agg(F.sum(F.length("word") + pad)).first()[0] or 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for word in batch.column("word").to_pylist():
                text = plain.padded(word)[0]
                for q in range(QMIN, QMAX + 1):
                    found.update(text[p:p + q] for p in range(len(text) - q + 1))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()),
                                              pa.array(list(found.values()), pa.int64())], ["gram", "n"])

    grams = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(
        F.sum("n").alias("n")).where(F.col("n") * SHARE > total)
    return {row.gram: row.n for row in grams.collect()}


def near_pairs(words: DataFrame, min_length: int) -> DataFrame:
    """``(a, a_n, b, b_n)``: each pair of words one edit apart, once."""
    grams = Grams(frequent_grams(words, min_length), min_length)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(word, n, len(word), grams.letters(word), gram, place)
                    for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(),
                                       strict=True) for gram, place in grams.rarest(word)]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["word", "n", "length", "letters", "gram", "place"])

    lists = staged(words.select("word", "n").mapInArrow(
        look_up, "word string, n long, length int, letters long, gram string, place int"), "grams")
    # A word meets words of its length at the same place, and longer ones there or one further.
    meets = F.array(*[F.struct((F.col("place") + p).alias("place"), (F.col("length") + l).alias("length"))
                      for p, l in ((0, 0), (0, 1), (1, 1))])
    probes = lists.select(F.col("word").alias("a"), F.col("n").alias("a_n"), "gram",
                          F.col("length").alias("own"), F.col("letters").alias("a_letters"),
                          F.explode(meets).alias("meet")).select(
        "a", "a_n", "gram", "own", "a_letters", "meet.place", "meet.length")
    listed = lists.select(F.col("word").alias("b"), F.col("n").alias("b_n"), "gram", "place", "length",
                          F.col("letters").alias("b_letters"))
    return (probes.join(listed, ["gram", "place", "length"])
            .where((F.col("own") < F.col("length")) | (F.col("a") < F.col("b")))
            .where(F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2)
            .where(F.levenshtein("a", "b", 1) == 1)
            .select("a", "a_n", "b", "b_n").distinct())


def roots(forms: DataFrame) -> DataFrame:
    """The end of each word's chain of ``forms (word, form)``, in log(length) rounds."""
    ends = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        ends = staged(ends.join(ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")),
            "roots")
        moved = ends.where("moved").isEmpty()
        ends = ends.drop("moved")
        if moved:
            return ends


def variants(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = 2) -> DataFrame:
    """form, root, n, n_near and form_n of each word of ``words (word, n)``.

    A word's form is its most frequent neighbour if that is at least ``ratio``
    times as frequent; the root is where the forms lead.  ``ratio`` must be 2 or
    more, so that forms can't lead in a circle.
    """
    words = staged(words.select(F.col("word").cast("string"), F.col("n").cast("long"))
                   .where(F.length("word") >= min_length)
                   .groupBy("word").agg(F.sum("n").alias("n"))
                   # Little data, much work: dealt to all tasks whatever its bytes.
                   .repartition(partitions(words.sparkSession)), "words")
    pairs = staged(near_pairs(words, min_length), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"),
                                          F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("form")))
    near = both.groupBy(F.col("a").alias("word"), F.col("a_n").alias("n")).agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.n") >= F.col("n") * ratio
    near = staged(near.select("word", "n_near", F.when(enough, F.col("best.form")).alias("form"),
                              F.when(enough, -F.col("best.n")).alias("form_n")), "near")
    ends = roots(near.where(F.col("form").isNotNull()))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
