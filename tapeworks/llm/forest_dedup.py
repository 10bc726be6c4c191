"""Near-duplicates by an LSH forest over MinHash signatures.

A document's set holds the distinct runs of five of its words, lower-cased.

1. Documents with equal sets are one class from the start.
2. Each of ``TREES`` trees sorts all classes by its own part of the signature.
   Classes that share at least the first two of a tree's hashes form a region.
   All classes of a region are compared by estimated similarity, unless they are
   joined already.  In a region of more than ``REACH`` + 1 classes, neighbours in
   the sorted order come first; any two that are still apart then meet in blocks.
3. Classes joined by such candidates form clusters.  Each class goes, with its
   text, to its cluster once, where similarities are exact: a prefix index over
   the rarest shingles finds every pair that can reach the threshold, and pairs
   already in one component aren't compared.
4. A cluster of more than ``CLUSTER`` classes is first taken apart by region of
   ``LARGE_TREES`` trees, with as many hashes as a region needs to come below the
   limit.  Then any two of its classes that those links haven't joined meet in
   blocks of bounded size, so that each pair of a large cluster is settled exactly.

Links are confirmed on full sets with whole numbers.  The threshold is an argument,
85 percent unless another is asked for, and not below ``LEAST_PERCENT``.  All trees
separate a pair at the threshold at depth two with a probability of about 8e-8 at
0.80 and 1e-9 at 0.85; the sketch that every tree asks finds it implausible with at
most ``MISS``.

Texts without words, null texts among them, have empty sets and link with
nothing; a text longer than a chunk is a chunk of its own.  component_id is the smallest doc_id reachable.  Rows that repeat a
doc_id are nodes with the same name.  Rows with a null doc_id stay out of the
graph: their component_id is null and they are kept.  An empty table gives an
empty result; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.arrays import (BASES, STEP, flat, grams, mix, prefix_sums, span_hashes,
                                  text_hashes, words)
from tapeworks.llm.lm_mixing import upper_table
from tapeworks.llm.staging import (ask, blob, chunked, components, join_by_hot_key, ordered,
                                   partitions, staged, tell, unused)

SHINGLE, PERCENT, LEAST_PERCENT = 5, 85, 80
TREES, DEPTH, LEAST_DEPTH = 16, 4, 2
HASHES = TREES * DEPTH
# Probability that the sketches of a pair at the threshold look implausible.
MISS = 1e-6
CLUSTER = 4096
# Trees that take large clusters apart before the rest of their classes meet.
LARGE_TREES = 4
# How far a class looks along the order inside its region; larger regions go on in blocks.
REACH, BLOCK_ROWS = 256, 2048
SIGNED = ("chunk long, row int, doc_id long, n_shingles long, set_hash binary, signature binary")
TREE_ROWS = "tree int, label binary, node long, n long, sketch binary"


def shingle_sets(column) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and offsets."""
    data, offsets = flat(column)
    n = len(offsets) - 1
    data = upper_table()[data]
    starts, ends, doc = words(data, offsets)
    values = text_hashes(data, starts, ends)
    at = np.arange(max(0, len(values) - SHINGLE + 1))
    at = at[doc[at] == doc[at + SHINGLE - 1]]
    hashes, owner = grams(values, SHINGLE)[at], doc[at]
    # Shorter texts are one shingle, their whole sequence.
    first = np.searchsorted(doc, np.arange(n))
    stop = np.searchsorted(doc, np.arange(n), "right")
    short = np.flatnonzero((stop > first) & (stop - first < SHINGLE))
    if len(short):
        sums = prefix_sums(values, BASES[0])
        hashes = np.concatenate((hashes, span_hashes(sums, first[short], stop[short], BASES[0])))
        owner = np.concatenate((owner, short))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(n + 1))


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values (upper halves) of each non-empty set."""
    heads = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(heads), HASHES), np.uint32)
    keys = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(STEP)) | np.uint64(1)
    if len(heads):
        for k in range(HASHES):
            permuted = (hashes ^ keys[2 * k]) * keys[2 * k + 1]
            out[:, k] = np.minimum.reduceat(permuted, heads) >> np.uint64(32)
    return out


def sign(table: pa.Table) -> pa.Table:
    """Set size, set hash and signature of each document of a chunk."""
    table = ordered(table)
    hashes, offsets = shingle_sets(table["text"])
    some = np.diff(offsets) > 0
    found = signatures(hashes, offsets)
    heads = offsets[:-1][some]
    sums = [np.add.reduceat(mix(hashes * np.uint64(m)), heads) if len(heads) else heads
            for m in (STEP, BASES[1])]
    digests = np.stack(sums, axis=1).astype(np.uint64) if len(heads) else np.zeros((0, 2), np.uint64)
    names, signs = [None] * table.num_rows, [None] * table.num_rows
    for i, k in enumerate(np.flatnonzero(some).tolist()):
        names[k], signs[k] = blob(digests[i]), blob(found[i])
    return pa.table({"chunk": table["chunk"], "row": table["row"], "doc_id": table["doc_id"],
                     "n_shingles": pa.array(np.diff(offsets)),
                     "set_hash": pa.array(names, pa.binary()),
                     "signature": pa.array(signs, pa.binary())})


def planted(classes: DataFrame) -> DataFrame:
    """A row for each tree: the label (two bytes of each hash) and a byte of every hash."""
    # Hashes lie as four bytes each, the highest last.
    def byte(place: int):
        return F.substring("signature", place + 1, 1)

    trees = F.array(*[F.struct(
        F.lit(tree).alias("tree"), F.concat(*[
            byte(4 * h + b) for h in range(tree * DEPTH, (tree + 1) * DEPTH) for b in (3, 2)]).alias("label"))
        for tree in range(TREES)])
    sketched = classes.select("node", "n", "signature", F.concat(*[
        byte(4 * h) for h in range(HASHES)]).alias("sketch"))
    return sketched.select(F.explode(trees).alias("place"), "node", "n", "sketch").select(
        "place.tree", "place.label", "node", "n", "sketch")


def rows_of(batch):
    """Arrays of sorted tree rows; regions are numbered by tree and first hashes."""
    labels = np.frombuffer(b"".join(batch["label"].to_pylist()), ">u2").reshape(-1, DEPTH)
    region = np.asarray(batch["tree"]).astype(np.uint64)
    for k in range(LEAST_DEPTH):
        region = region << np.uint64(16) | labels[:, k]
    sketch = np.frombuffer(b"".join(batch["sketch"].to_pylist()), np.uint8).reshape(-1, HASHES)
    return region, np.asarray(batch["node"]), np.asarray(batch["n"]), sketch


def least_alike(percent: int) -> int:
    """Equal hashes that a pair at the threshold falls short of with at most ``MISS``."""
    p, k, below = percent / 100, 0, 0.0
    while (below := below + math.comb(HASHES, k) * p ** k * (1 - p) ** (HASHES - k)) <= MISS:
        k += 1
    return k


def plausible(one, two, n_one, n_two, percent: int) -> np.ndarray:
    close = 100 * np.minimum(n_one, n_two) >= percent * np.maximum(n_one, n_two)
    at = np.flatnonzero(close)
    one = one[at] if len(one) > 1 else one
    close[at] = np.count_nonzero(one == two[at], axis=1) >= least_alike(percent)
    return close


def neighbours(region, node, n, sketch, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each row to the plausible ones of the next ``REACH`` of its region."""
    open_rows, label, pairs = np.arange(len(node)), np.arange(len(node)), []
    for step in range(1, REACH + 1):
        open_rows = open_rows[open_rows + step < len(node)]
        open_rows = open_rows[region[open_rows] == region[open_rows + step]]
        if not len(open_rows):
            break
        apart = open_rows[label[open_rows] != label[open_rows + step]]
        hit = plausible(sketch[apart], sketch[apart + step], n[apart], n[apart + step], percent)
        one = apart[hit]
        pairs.append((node[one], node[one + step]))
        label = merged(label, one, one + step)
    if not pairs:
        return node[:0], node[:0]
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the least row of each set) after the sets of rows ``a`` and ``b`` are joined."""
    while len(a):
        one, two = label[a], label[b]
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(one, two), np.minimum(one, two))
        while ((up := to[to]) != to).any():
            to = up
        label = to[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def compare(rows: pa.Table, percent: int) -> pa.Table:
    """Links between all plausible rows of a meeting that aren't of one kin."""
    node, n = np.asarray(rows["node"]), np.asarray(rows["n"])
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(-1, HASHES)
    _, label = np.unique(np.asarray(rows["kin"]), return_inverse=True)
    one, two = [], []
    for i in range(len(node)):
        other = np.flatnonzero(label[i + 1:] != label[i]) + i + 1
        if not len(other):
            continue
        other = other[plausible(sketch[i:i + 1], sketch[other], n[i], n[other], percent)]
        kins, first = np.unique(label[other], return_index=True)
        if len(kins):
            one += [node[i]] * len(kins)
            two += node[other[first]].tolist()
            label[np.isin(label, kins)] = label[i]
    return pa.table({"a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64())})


def search(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidates along one partition's order (border null), and its edge rows.

    The first and last ``REACH`` rows go on under the number of the border they
    lie at, so that neighbours on either side of it are met as well.
    """
    def edge(rows: pa.Table, border: int):
        n = rows.num_rows
        return pa.table({"a": pa.nulls(n, pa.int64()), "b": pa.nulls(n, pa.int64()),
                         "border": pa.array(np.full(n, border, np.int32)),
                         **{c: rows[c] for c in ("tree", "label", "node", "n", "sketch")}})

    number, kept = TaskContext.get().partitionId(), None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if kept is None:
            yield from edge(table.slice(0, REACH), number - 1).to_batches()
        table = table if kept is None else pa.concat_tables((kept, table))
        a, b = neighbours(*rows_of(table.combine_chunks().to_batches()[0]), percent)
        n = len(a)
        yield from pa.table({
            "a": pa.array(a), "b": pa.array(b), "border": pa.nulls(n, pa.int32()),
            "tree": pa.nulls(n, pa.int32()), "label": pa.nulls(n, pa.binary()),
            "node": pa.nulls(n, pa.int64()), "n": pa.nulls(n, pa.int64()),
            "sketch": pa.nulls(n, pa.binary())}).to_batches()
        kept = table.slice(max(0, table.num_rows - REACH))
    if kept is not None:
        yield from edge(kept, number).to_batches()


def search_borders(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables((kept, table))
        a, b = neighbours(*rows_of(table.combine_chunks().to_batches()[0]), percent)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        kept = table.slice(max(0, table.num_rows - REACH))


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that join all classes which share a region of some tree and look similar."""
    spark, region = classes.sparkSession, ["tree", "prefix"]
    prefix = F.substring("label", 1, 2 * LEAST_DEPTH).alias("prefix")
    forest = planted(classes).select("*", prefix)
    crowded = staged(forest.groupBy(region).agg(F.count(F.lit(1)).alias("crowd"))
                     .where(F.col("crowd") > REACH + 1).select(region), "crowded")
    hot = crowded.limit(1).count() > 0
    # Each is more than REACH rows, so the table of crowded regions is small.
    calm = forest.join(F.broadcast(crowded), region, "left_anti") if hot else forest
    pairs = staged(
        calm.repartition(partitions(spark), *region).sortWithinPartitions(*region).drop("prefix")
        .mapInArrow(lambda b: search_borders(b, percent), "a long, b long"), "candidates")
    if not hot:
        return pairs
    order = ["tree", "label", "node"]
    busy = staged(forest.join(F.broadcast(crowded), region, "left_semi"), "crowds")
    found = staged(
        busy.drop("prefix").repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
        .mapInArrow(lambda b: search(b, percent), f"a long, b long, border int, {TREE_ROWS}"), "candidates")
    # At most 2 * REACH rows of each border.
    edges = found.where("border is not null").select("border", "tree", "label", "node", "n", "sketch")
    borders = (edges.repartition("border").sortWithinPartitions("border", *order)
               .mapInArrow(lambda b: search_borders(b, percent), "a long, b long").where("a <> b"))
    pairs = staged(pairs.unionByName(found.where("border is null").select("a", "b"))
                   .unionByName(borders), "candidates")
    known = components(pairs, "kin").withColumnRenamed("component", "kin")
    rows = busy.join(known, "node", "left").select(
        *region, "node", "n", "sketch", F.coalesce("kin", "node").alias("kin"))
    met = meetings(staged(rows, "crowds"), region, BLOCK_ROWS)
    return pairs.unionByName(staged(met.groupBy(*region, "meeting").applyInArrow(
        lambda rows: compare(rows, percent), "a long, b long"), "candidates"))


class Links:
    """Union of sets by exact similarity inside one cluster."""

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray, nodes: np.ndarray, percent: int,
                 kin: np.ndarray | None = None):
        self.nodes, self.percent = nodes, percent
        _, number, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        # Rare shingles first: each set is sorted by how many sets have a shingle.
        rank = np.empty(len(counts), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
        ranked = rank[number]
        self.sets = [np.sort(ranked[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.shared_from = int(np.count_nonzero(counts == 1))
        self.parent = list(range(len(nodes)))
        if kin is not None:
            # What is known to be one component starts as one, under its smallest node.
            order = np.lexsort((nodes, kin))
            _, first, which = np.unique(kin[order], return_index=True, return_inverse=True)
            for i, head in zip(order.tolist(), order[first[which]].tolist(), strict=True):
                self.parent[i] = head

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def linked(self, a: int, b: int) -> bool:
        one, two = self.sets[a], self.sets[b]
        common = len(np.intersect1d(one, two, assume_unique=True))
        return 100 * common >= self.percent * (len(one) + len(two) - common)

    def roots(self) -> np.ndarray:
        """The smallest node of each set's component."""
        index: dict[int, list[int]] = {}
        order = sorted(range(len(self.sets)), key=lambda i: (len(self.sets[i]), self.nodes[i]))
        for a in order:
            size = len(self.sets[a])
            prefix = self.sets[a][:size - -(-self.percent * size // 100) + 1]
            prefix = prefix[prefix >= self.shared_from].tolist()
            seen: set[int] = set()
            for shingle in prefix:
                for b in index.get(shingle, ()):
                    if b in seen:
                        continue
                    seen.add(b)
                    if (100 * len(self.sets[b]) >= self.percent * size
                            and (x := self.root(a)) != (y := self.root(b)) and self.linked(a, b)):
                        if self.nodes[x] < self.nodes[y]:
                            x, y = y, x
                        self.parent[x] = y
            for shingle in prefix:
                index.setdefault(shingle, []).append(a)
        return np.array([self.nodes[self.root(i)] for i in range(len(self.nodes))])


def meetings(rows: DataFrame, key: list[str], size: int) -> DataFrame:
    """Rows with a ``meeting``: any two of one key that are not of one ``kin`` share one.

    A kin of more than ``size`` rows has blocks of its own, which needn't meet each
    other; the smaller ones of a key share blocks.  A meeting is two blocks, and keys
    of a single kin have none.
    """
    kins = staged(rows.groupBy(*key, "kin").agg(F.count(F.lit(1)).alias("members")), "kins")
    large = F.col("members") > size
    keys = kins.groupBy(*key).agg(
        F.count(F.lit(1)).alias("kins"),
        F.sum(F.when(large, 0).otherwise(F.col("members"))).alias("rest")).where("kins > 1").drop("kins")
    kins = staged(kins.join(keys, key), "kins")

    def name(owner, part):
        return F.concat(F.coalesce(owner.cast("string"), F.lit("")), F.lit(":"), part.cast("string"))

    def parts(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(n) / size) - 1)).alias("part")

    blocks = kins.where(large).select(*key, F.col("kin").alias("owner"), parts("members")).unionByName(
        kins.where(~large).select(*key, "rest").distinct()
        .select(*key, F.lit(None).cast("long").alias("owner"), parts("rest")))
    blocks = blocks.groupBy(*key).agg(F.collect_list(
        F.struct("owner", name(F.col("owner"), F.col("part")).alias("name"))).alias("blocks"))
    part = F.when(large, F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / size))).otherwise(
        F.pmod(F.xxhash64("kin"), F.ceil(F.col("rest") / size)))
    dealt = rows.join(kins, [*key, "kin"]).withColumn("owner", F.when(large, F.col("kin"))).withColumn(
        "name", name(F.col("owner"), part))
    others = F.when(F.size("blocks") == 1, F.col("blocks")).otherwise(F.filter("blocks", lambda b: (
        b["name"] != F.col("name")) & ~F.coalesce(b["owner"] == F.col("owner"), F.lit(False))))
    met = staged(dealt, "dealt").join(blocks, key).withColumn("other", F.explode(others))
    return met.withColumn("meeting", F.concat(
        F.least("name", "other.name"), F.lit("|"), F.greatest("name", "other.name"))).select(
        *rows.columns, "meeting")


def clusters(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """n_shingles, component_id and kept of every row."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"the forest is tuned for {LEAST_PERCENT} to 100 percent")
    chunks = chunked(docs)
    signed = staged(ask(chunks, sign, SIGNED), "signed")
    some = signed.where("set_hash is not null and doc_id is not null")
    classes = staged(
        some.groupBy("set_hash").agg(
            F.min(F.struct("doc_id", "chunk", "row", "n_shingles", "signature")).alias("one"),
            F.count(F.lit(1)).alias("size"))
        .select("set_hash", "size", F.col("one.doc_id").alias("node"), "one.chunk", "one.row",
                F.col("one.n_shingles").alias("n"), "one.signature"), "classes")
    found = components(candidates(classes, percent), "clusters")
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    grouped = staged(
        classes.join(found, "node").join(sizes, "component")
        .select("node", "chunk", "row", "signature", "component", "members"), "grouped")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Where a class is compared: in its cluster, or in a region of each tree."""
        for batch in batches:
            out = {k: [] for k in ("chunk", "row", "node", "component", "tree", "label")}
            for r in batch.to_pylist():
                whole = r["members"] <= CLUSTER
                hashes = np.frombuffer(r["signature"], np.uint32)
                for tree in range(1 if whole else LARGE_TREES):
                    label = b"" if whole else blob(hashes[tree * DEPTH:(tree + 1) * DEPTH].astype(">u4"))
                    for k, v in zip(out, (r["chunk"], r["row"], r["node"], r["component"], tree, label),
                                    strict=True):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("chunk", pa.int64()), ("row", pa.int32()), ("node", pa.int64()),
                 ("component", pa.int64()), ("tree", pa.int32()), ("label", pa.binary())]))

    placed = grouped.mapInArrow(
        keys, "chunk long, row int, node long, component long, tree int, label binary")
    # The shortest prefix with few enough classes.  Where too many share even a
    # whole label they are dealt to a ring of halves, each half in two groups.
    deep = placed.withColumn("group", F.lit(None).cast("binary"))
    large = grouped.where(F.col("members") > CLUSTER).limit(1).count() > 0
    if large:
        for depth in range(LEAST_DEPTH, DEPTH + 1):
            prefix = F.substring("label", 1, 4 * depth)
            counts = placed.where("label <> X''").groupBy("component", "tree", prefix.alias("prefix")).agg(
                F.count(F.lit(1)).alias("crowd"))
            small = F.col("crowd") <= CLUSTER
            deep = deep.withColumn("prefix", prefix).join(counts, ["component", "tree", "prefix"], "left")
            deep = deep.withColumn("group", F.coalesce("group", F.when(small, F.col("prefix"))))
            if depth < DEPTH:
                deep = deep.drop("prefix", "crowd")
        halves = F.ceil(F.col("crowd") * 2 / CLUSTER)
        half = F.pmod(F.xxhash64("node"), halves)
        ring = F.transform(F.array(half, F.pmod(half + 1, halves)), lambda h: F.concat(
            F.col("prefix"), F.encode(h.cast("string"), "UTF-8")))
        split = F.col("group").isNull() & (F.col("label") != F.lit(b""))
        deep = deep.withColumn("group", F.explode(
            F.when(split, ring).otherwise(F.array("group")))).drop("prefix", "crowd")
    wanted = deep.select("chunk", "row", "node", "component", "tree",
                         F.coalesce("group", F.lit(b"")).alias("group"))

    def fetch(table: pa.Table, wanted: pa.Table) -> pa.Table:
        texts = ordered(table)["text"]
        return wanted.drop_columns(["chunk"]).append_column(
            "text", texts.take(wanted["row"].combine_chunks()))

    texts = tell(chunks, wanted, fetch,
                 "row int, node long, component long, tree int, group binary, text string")

    def confirm(table: pa.Table) -> pa.Table:
        hashes, offsets = shingle_sets(table["text"])
        nodes = np.asarray(table["node"])
        kin = np.asarray(table["kin"]) if "kin" in table.column_names else None
        roots = Links(hashes, offsets, nodes, percent, kin).roots()
        other = roots != nodes
        return pa.table({"a": pa.array(nodes[other]), "b": pa.array(roots[other])})

    joined = staged(texts.groupBy("component", "tree", "group").applyInArrow(confirm, "a long, b long"),
                    "links")
    if large:
        # What the regions haven't joined: all of it meets, whatever its number.
        known = components(joined, "regions").withColumnRenamed("component", "kin")
        rest = (grouped.where(F.col("members") > CLUSTER).join(known, "node", "left")
                .select("chunk", "row", "node", "component", F.coalesce("kin", "node").alias("kin")))
        met = tell(chunks, meetings(staged(rest, "rest"), ["component"], CLUSTER // 2), fetch,
                   "row int, node long, component long, kin long, meeting string, text string")
        joined = joined.unionByName(staged(
            met.groupBy("component", "meeting").applyInArrow(confirm, "a long, b long"), "met"))
    # Whole clusters give stars already; only regions of large ones overlap.
    final = components(joined, "components") if large else joined.select(
        F.col("a").alias("node"), F.col("b").alias("component"))
    named = classes.select("set_hash", "size", "node").join(final, "node", "left").select(
        "set_hash", "size", F.coalesce("component", "node").alias("component_id"))
    total = named.agg(F.sum("size")).first()[0] or 0
    rows = join_by_hot_key(some.select("doc_id", "n_shingles", "set_hash"), named,
                           "set_hash", "size", total)
    alone = signed.where("set_hash is null or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return rows.select("doc_id", "n_shingles", "component_id").unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns.

    Rows that repeat a doc_id stay or go together.
    """
    found, gone = staged(clusters(docs, percent), "kept"), unused(docs, "_gone")
    stays = found.where("kept").select("doc_id")
    goes = found.where("not kept").select(F.col("doc_id").alias(gone)).distinct()
    goes = goes.join(stays, F.col(gone) == F.col("doc_id"), "left_anti")
    return docs.join(goes, F.col("doc_id").cast("long") == F.col(gone), "left_anti")
