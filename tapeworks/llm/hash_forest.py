"""Nearest neighbours by inner product: a forest of sorted arrays of long hash strings.

* **Strings.**  Each tree hashes a vector to ``BITS`` bits: on which sides of
  random planes it lies, the planes orthogonal in groups.  Vectors are first
  lifted to one length (a further component makes up for the norm), so that the
  angle to a query falls as the inner product grows.
* **Sorted arrays.**  Rows with a common prefix are neighbours in their tree's
  order.  An array is cut into regions by the first ``r`` bits, ``r`` growing with
  the number of rows; a region with too many rows is dealt to several slices, and
  a slice asked by too many queries to several tasks.  So a task holds at most
  about ``ROWS`` rows and ``QUERIES`` queries, hot regions included.
* **Descent.**  In its region a query finds by binary search how many rows share
  each prefix length; shorter prefixes are counted in a table with a line for each
  region.
* **Synchronous ascent.**  From the longest prefixes on, all trees go up one bit
  after the other until the rows passed reach the target.  Every row that shares
  the prefix a tree has then come to is scored exactly, none is cut off.
* **Target.**  The number of rows to pass is fitted on at most ``SAMPLE`` queries,
  compared with all rows: the smallest for which ``RECALL`` of their neighbours
  are passed.  Vectors without structure need a large share of all rows, clustered
  ones few.  All rows are indexed.

Equal vectors are one entry with its smallest ids, so a vector that a third of the
rows have is one row.  Null vectors, null, NaN or infinite components, zero
vectors, null ids and vectors of another than the usual dimension take no part.
Ids of equal rows count once; two vectors with one id are both candidates, but
never for that id's query.  Ties go to the smaller id.  An empty table, or one
without queries, gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.llm.staging import partitions, staged

TREES, BITS = 4, 60
ROWS, QUERIES = 1 << 14, 1 << 13
SAMPLE, RECALL = 200, 0.95
# Products computed at a time.
BLOCK = 1 << 22
HIT = "query_id long, vec_id long, score double"


def matrix(column) -> np.ndarray:
    """Arrow lists of one length to rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


@dataclass
class Forest:
    """The planes of all trees, and the norm all vectors are lifted to."""

    planes: np.ndarray  # tree, dimension + 1, bit
    norm: float

    @classmethod
    def planted(cls, dim: int, norm: float, trees: int, seed: int = 13) -> Forest:
        random = np.random.default_rng(seed)
        size = dim + 1
        groups = [np.concatenate([np.linalg.qr(random.normal(size=(size, size)))[0]
                                  for _ in range(-(-BITS // size))], axis=1)[:, :BITS]
                  for _ in range(trees)]
        return cls(np.stack(groups), norm)

    def codes(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """A tree a row: the strings as numbers, first bit highest."""
        if query:
            scaled = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            lift = np.zeros(len(vectors))
        else:
            scaled = vectors / self.norm
            lift = np.sqrt(np.maximum(0, 1 - (scaled ** 2).sum(axis=1)))
        lifted = np.column_stack((scaled, lift))
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        return np.stack([(lifted @ p > 0) @ weights for p in self.planes])


def usable(rows: DataFrame, vector: str, id_column: str) -> DataFrame:
    """``vec_id, vector``, each once; every vector of the usual dimension, finite and not zero."""
    kind = dict(rows.dtypes)[vector]
    kind = kind if kind == "array<float>" else "array<double>"
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.select(F.col(id_column).cast("long").alias("vec_id"),
                       F.col(vector).cast(kind).alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        finite & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return rows.where(F.size("vector") == (sizes.dim if sizes else 0))


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """``ids, vector``: each vector once, with its ``keep`` smallest ids."""
    marked = rows.withColumn("one", F.xxhash64("vector")).withColumn("two", F.xxhash64(F.lit(1), "vector"))
    least = F.slice(F.sort_array(F.collect_set("vec_id")), 1, keep)
    several = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    # A task sends each vector it has several rows of once, so no group is large.
    groups = (marked.select("one", "two", "vec_id", F.spark_partition_id().alias("part"))
              .groupBy("one", "two", "part").agg(least.alias("ids"), F.count(F.lit(1)).alias("n"))
              .groupBy("one", "two").agg(several.alias("ids"), F.sum("n").alias("n"))
              .where("n > 1").select("one", "two", "ids"))
    groups = staged(groups, "equal_vectors")
    first = F.col("ids").isNull() | (F.col("vec_id") == F.col("ids")[0])
    copies = marked.join(groups, ["one", "two"], "left").where(first).select(
        F.coalesce("ids", F.array("vec_id")).alias("ids"), "vector")
    # Equal rows with the least id are left over.
    return copies.where(F.size("ids") == 1).where(F.col("ids")[0].isNotNull()).unionByName(
        copies.where(F.size("ids") > 1).dropDuplicates(["ids"]))


def coded(df: DataFrame, forest: Forest, query: bool) -> DataFrame:
    """The rows with ``codes``, one for each tree."""
    kept = df.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = forest.codes(matrix(batch.column("vector")), query).T if batch.num_rows else \
                np.zeros((0, len(forest.planes)), np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(codes) + 1) * codes.shape[1], pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*kept, "codes"])

    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", codes array<long>"
    return df.mapInArrow(add, schema)


def shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of codes."""
    return BITS - np.frexp((a ^ b).astype(float))[1]


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best, all ties of the last included."""
    if len(scores) <= k:
        return np.arange(len(scores))
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])


def target(index: DataFrame, queries: DataFrame, forest: Forest, k: int) -> int:
    """How many rows a query has to pass, by a bounded sample of queries."""
    rows = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(SAMPLE).collect()
    if not rows:
        return k
    own = np.array([r.query_id for r in rows])
    vectors = np.array([r.vector for r in rows], float)
    asked = forest.codes(vectors, True)
    trees = len(asked)

    def steps(codes: np.ndarray, q: int) -> np.ndarray:
        """For each tree (a row) the step of the ascent that reaches each code."""
        return (BITS - shared_bits(codes, asked[:, q, None])) * trees + np.arange(trees)[:, None]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = np.zeros((len(own), (BITS + 1) * trees), np.int64)
        best = [np.zeros((2, 0))] * len(own)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = matrix(batch.column("codes")).astype(np.int64).T
            found = matrix(batch.column("vector"))
            first = np.array([i[0] for i in batch.column("ids").to_pylist()])
            scores = vectors @ found.T
            for q in range(len(own)):
                at = steps(codes, q)
                passed[q] += np.bincount(at.ravel(), minlength=passed.shape[1])
                near = np.stack((np.where(first == own[q], -np.inf, scores[q]), at.min(axis=0)))
                near = np.concatenate((best[q], near), axis=1)
                best[q] = near[:, top(near[0], near[1], k)][:, :4 * k]
        q, step = np.nonzero(passed)
        rows = [(int(a), int(b), float("nan"), int(passed[a, b])) for a, b in zip(q, step, strict=True)]
        rows += [(a, int(s), float(v), 0) for a in range(len(own)) for v, s in best[a].T if np.isfinite(v)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, (
                pa.int32(), pa.int32(), pa.float64(), pa.int64()), strict=True)], ["q", "step", "score", "n"])

    told = staged(index.select("ids", "vector", "codes").mapInArrow(
        compare, "q int, step int, score double, n long"), "sample")
    passed = np.zeros((len(own), (BITS + 1) * trees), np.int64)
    for r in told.where("n > 0").groupBy("q", "step").agg(F.sum("n").alias("n")).collect():
        passed[r.q, r.step] = r.n
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "step"))
    wanted = told.where("n = 0").withColumn("place", place).where(F.col("place") <= k).collect()
    if not wanted:
        return k
    sums = np.cumsum(passed, axis=1)
    # Rows that lie before a neighbour's step: the target must be larger to reach it.
    before = np.sort([sums[r.q, r.step - 1] if r.step else 0 for r in wanted])
    return max(k, int(before[min(len(before) - 1, int(np.ceil(RECALL * len(before))))]) + 1)


def sorted_slice(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    codes = np.asarray(table["code"])
    order = np.argsort(codes, kind="stable")
    return order, codes[order]


def bounds(codes: np.ndarray, asked: np.ndarray, bits) -> tuple[np.ndarray, np.ndarray]:
    """Where the rows that share ``bits`` bits with each asked code begin and end."""
    rest = BITS - np.asarray(bits, np.int64)
    low = asked >> rest << rest
    return (np.searchsorted(codes, low, "left"),
            np.searchsorted(codes, low + (np.int64(1) << rest) - 1, "right"))


def neighbours(rows: DataFrame, is_query: Column, k: int = 20, *, vector: str = "embedding",
               id_column: str = "vec_id", trees: int = TREES, rows_per_task: int = ROWS,
               queries_per_task: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query.

    ``is_query`` says of ``vec_id`` whether a row is a query.
    """
    spark = rows.sparkSession
    good = staged(usable(rows, vector, id_column), "vectors")
    facts = good.agg(F.first(F.size("vector")).alias("dim"), F.max(F.sqrt(F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).alias("norm")).first()
    forest = Forest.planted(facts.dim or 1, facts.norm or 1.0, trees)
    # Much work for few bytes: dealt to all tasks.
    index = staged(coded(entries(good, k + 1).repartition(partitions(spark)), forest, False), "index")
    queries = staged(coded(good.where(is_query).dropDuplicates(["vec_id", "vector"]).select(
        F.col("vec_id").alias("query_id"), "vector").repartition(partitions(spark)), forest, True), "queries")
    n_rows = index.count()
    enough = target(index, queries, forest, k)
    r = max(0, int(np.ceil(np.log2(max(1, n_rows / rows_per_task)))))
    region = F.shiftright("code", BITS - r).alias("region")
    tree_code = F.posexplode("codes").alias("tree", "code")

    # Regions with their sizes, and the same for all shorter prefixes.
    directory = staged(index.select(tree_code).groupBy("tree", region).agg(F.count(F.lit(1)).alias("n"))
                       .withColumn("slices", F.ceil(F.col("n") / rows_per_task)), "regions")
    lengths = F.explode(F.sequence(F.lit(0), F.lit(r))).alias("bits")
    prefixes = (directory.select("tree", "region", "n", lengths)
                .groupBy("tree", "bits", F.expr(f"shiftright(region, {r} - bits)").alias("prefix"))
                .agg(F.sum("n").alias("n")))
    asked = queries.select("query_id", F.monotonically_increasing_id().alias("ask"), "vector", "codes")
    asked = staged(asked, "asked")
    by_tree = asked.select("ask", tree_code).withColumn("region", F.shiftright("code", BITS - r))
    short = (by_tree.select("ask", "tree", "region", lengths)
             .withColumn("prefix", F.expr(f"shiftright(region, {r} - bits)"))
             .join(prefixes, ["tree", "bits", "prefix"])
             .select("ask", "tree", "bits", "n"))

    # Descent: rows that share longer prefixes, slice by slice.
    slices = F.col("slices")
    in_slices = index.select(F.col("ids")[0].alias("id"), tree_code).withColumn(
        "region", F.shiftright("code", BITS - r)).join(directory, ["tree", "region"]).select(
        "tree", "region", F.pmod(F.xxhash64("id"), slices).cast("int").alias("slice"), "code")
    to_slices = by_tree.join(directory, ["tree", "region"]).select(
        "ask", "tree", "region", F.explode(F.sequence(F.lit(0), (slices - 1).cast("int"))).alias("slice"),
        "code")

    def descend(found: pa.Table, asking: pa.Table) -> pa.Table:
        codes, own = np.sort(np.asarray(found["code"])), np.asarray(asking["code"])
        out = []
        for bits in range(r + 1, BITS + 1):
            low, high = bounds(codes, own, bits)
            some = np.flatnonzero(high > low)
            if not len(some):
                break
            out.append((np.asarray(asking["ask"])[some], np.full(len(some), bits), (high - low)[some]))
        ask, bits, n = (np.concatenate(c) for c in zip(*out, strict=True)) if out else [np.zeros(0, int)] * 3
        tree = asking["tree"][0].as_py() if len(own) else 0
        return pa.table({"ask": pa.array(ask, pa.int64()), "tree": pa.array(np.full(len(ask), tree), pa.int32()),
                         "bits": pa.array(bits, pa.int32()), "n": pa.array(n, pa.int64())})

    cell = ["tree", "region", "slice"]
    long = to_slices.groupBy(*cell).cogroup(in_slices.groupBy(*cell)).applyInArrow(
        lambda asking, found: descend(found, asking), "ask long, tree int, bits int, n long")

    # Ascent: bit by bit in all trees until enough rows are passed.
    steps = short.unionByName(long).groupBy("ask", "tree", "bits").agg(F.sum("n").alias("n"))
    step = ((BITS - F.col("bits")) * trees + F.col("tree")).alias("step")
    # A prefix holds the longer ones: what a tree has passed is its latest count.
    fresh = F.col("n") - F.coalesce(F.lead("n").over(
        Window.partitionBy("ask", "tree").orderBy("bits")), F.lit(0))
    upto = F.sum("fresh").over(Window.partitionBy("ask").orderBy("step"))
    stops = (steps.select("ask", step, fresh.alias("fresh")).withColumn("passed", upto)
             .groupBy("ask").agg(F.coalesce(F.min(F.when(F.col("passed") >= enough, F.col("step"))),
                                            F.lit(BITS * trees + trees - 1)).alias("stop")))
    levels = staged(stops.select("ask", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), (
        F.lit(BITS) - F.floor((F.col("stop") - F.col("tree")) / trees)).cast("int").alias("bits")), "levels")

    # Scoring: each query goes to all slices that its prefix reaches.
    visits = levels.join(by_tree, ["ask", "tree"]).where(F.col("bits") <= BITS)
    over = F.greatest(F.lit(r) - F.col("bits"), F.lit(0))
    base = F.expr(f"shiftright(region, greatest({r} - bits, 0))")
    visits = visits.select("ask", "tree", "code", "bits", base.alias("base"), over.alias("over")).select(
        "ask", "tree", "code", "bits", F.explode(F.expr(
            "sequence(shiftleft(base, over), shiftleft(base + 1, over) - 1)")).alias("region"))
    visits = staged(visits.join(directory, ["tree", "region"]), "visits")
    plan = staged(visits.groupBy("tree", "region", "slices").agg(
        F.ceil(F.count(F.lit(1)) / queries_per_task).alias("blocks")), "plan")
    cell = [*cell, "block"]
    asking = (visits.drop("slices", "n").join(plan, ["tree", "region"])
              .withColumn("slice", F.explode(F.sequence(F.lit(0), (slices - 1).cast("int"))))
              .withColumn("block", F.pmod(F.xxhash64("ask"), F.col("blocks")).cast("int"))
              .join(asked.select("ask", "query_id", "vector"), "ask")
              .select("query_id", "vector", *cell, "code", "bits"))
    held = (index.select("ids", "vector", tree_code)
            .withColumn("region", F.shiftright("code", BITS - r)).join(plan, ["tree", "region"])
            .withColumn("slice", F.pmod(F.xxhash64(F.col("ids")[0]), slices).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
            .select("ids", "vector", *cell, "code"))

    def score(asking: pa.Table, found: pa.Table) -> pa.Table:
        hits: list[tuple[int, int, float]] = []
        if asking.num_rows and found.num_rows:
            order, codes = sorted_slice(found)
            vectors, ids = matrix(found["vector"])[order], [found["ids"][int(i)].as_py() for i in order]
            wanted, own = matrix(asking["vector"]), np.asarray(asking["query_id"])
            low, high = bounds(codes, np.asarray(asking["code"]), np.asarray(asking["bits"]))
            # Queries with the same rows are multiplied together.
            for a, b in sorted(set(zip(low.tolist(), high.tolist(), strict=True))):
                if a == b:
                    continue
                same = np.flatnonzero((low == a) & (high == b))
                for part in np.array_split(same, -(-len(same) * (b - a) // BLOCK)):
                    for q, line in zip(part, wanted[part] @ vectors[a:b].T, strict=True):
                        # One more than k: the query's own entry may be among them.
                        at = a + top(line, line, k + 1)
                        exact = (vectors[at] * wanted[q]).sum(axis=1)
                        near = sorted((-s, i) for s, p in zip(exact.tolist(), at, strict=True)
                                      for i in ids[p] if i != own[q])
                        hits += [(int(own[q]), i, -s) for s, i in near[:k]]
        columns = list(zip(*hits, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(
            ("query_id", "vec_id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)})

    hits = asking.groupBy(*cell).cogroup(held.groupBy(*cell)).applyInArrow(score, HIT)
    # A pair found in several trees has one score, so it takes one rank.
    order = F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (hits.withColumn("rank", order).where(F.col("rank") <= k)
            .groupBy("query_id", "rank", "vec_id", "score").agg(F.lit(1)).select(
                "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
