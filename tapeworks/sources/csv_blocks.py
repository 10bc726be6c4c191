"""Records of CSV files of any size, read block by block.

Whether a line begins a record depends on every quote before it, back to the start
of the file.  A block is read without that knowledge, in two passes:

1. Each block says where its last line ends, inside quotes or outside, for both
   places it may begin in.  Composed along the file, these tell where each block
   really begins: what the last block says that ends in one place either way,
   turned once for each later block that ends in the other place than it begins.
2. With that, each block gives the records that begin and end in it.  A record that
   goes on in later blocks leaves one piece in each; pieces are put together by
   file and record.

Text isn't moved: only pieces, at most two a block, are.  A record must fit in a
task; one of more than ``max_record_bytes`` ends the read with an error, which also
bounds what an unclosed quote can gather.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tapeworks.session import workspace

# Executors need numpy and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Complete fields from a record's start on, then a quoted one that stays open.
_OPENS = re.compile(rb'(?:[,\r\n]|"(?:[^"]++|"")*+"[^,\r\n]*+|[^",\r\n][^,\r\n]*+)*+"(?:[^"]++|"")*+\Z')
# From inside quotes, the end of that field.
_CLOSES = re.compile(rb'(?:[^"]++|"")*+"[^,\r\n]*+')

# What a piece is: a record, the going on of an earlier block's, the beginning of a later one's.
WHOLE, ON, OPEN = 0, 1, 2
PIECES = "file string, block long, kind int, head boolean, text binary"


def line_ends(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line ends inside quotes: if it begins outside, and if inside."""
    out, inside = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    for i in np.flatnonzero(np.asarray(pc.match_substring(lines, '"'))):
        line = lines[int(i)].as_py()
        out[i] = _OPENS.match(line) is not None
        closed = _CLOSES.match(line)
        if closed:
            inside[i] = _OPENS.match(line, closed.end()) is not None
    return out, inside


def after_lines(out: np.ndarray, inside: np.ndarray, start: bool) -> np.ndarray:
    """Whether each line ends inside quotes, the first beginning as ``start`` says."""
    turns = np.cumsum(out & ~inside)
    settled = np.maximum.accumulate(np.where(out == inside, np.arange(len(out)), -1))
    known = settled >= 0
    value = np.where(known, out[settled], start)
    return value ^ ((turns - np.where(known, turns[settled], 0)) % 2 == 1)


def spans(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The batch cut where the file or block changes."""
    if not batch.num_rows:
        return
    file, block = batch.column("file"), batch.column("block")
    change = np.asarray(pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])))
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        yield file[a].as_py(), block[a].as_py(), batch.slice(a, b - a)


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class _Limit:
    def __init__(self, most: int):
        self.most = most

    def check(self, file: str, lines: list[bytes]) -> None:
        if sum(map(len, lines)) > self.most:
            raise ValueError(f"a record of {file} has more than {self.most} bytes")


def block_ends(lines: DataFrame, separator: bytes, most: int, with_header: bool = True) -> DataFrame:
    """``file, block, from_out, from_in, header``: one line for each block.

    The header, a file's first record, comes with its first block if it ends there.  A line
    without a quote ends where it begins, so only the others are looked at, and, if the
    header is wanted, the lines of first blocks.
    """
    telling = told_lines(lines, with_header)
    # A block without any of them ends as it begins.
    blocks = lines.select("file", "block").distinct()
    found = _scanned_ends(telling, separator, most, with_header)
    return blocks.join(found, ["file", "block"], "left").select(
        "file", "block", F.coalesce("from_out", F.lit(False)).alias("from_out"),
        F.coalesce("from_in", F.lit(True)).alias("from_in"), "header")


def told_lines(lines: DataFrame, with_header: bool) -> DataFrame:
    quoted = F.contains(F.col("value"), F.lit(b'"'))
    return lines.where(quoted | (F.col("block") == 0) if with_header else quoted)


def _scanned_ends(lines: DataFrame, separator: bytes, most: int, with_header: bool) -> DataFrame:
    limit = _Limit(most)
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("from_out", pa.bool_()),
                        ("from_in", pa.bool_()), ("header", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ends, header, done = None, (False, True), [], False

        def told() -> list[tuple]:
            return [] if at is None else [(*at, *ends, separator.join(header) if header else None)]

        for batch in batches:
            rows = []
            for file, block, part in spans(batch):
                if (file, block) != at:
                    rows += told()
                    at, ends, header = (file, block), (False, True), []
                    done = block != 0 or not with_header
                out, inside = line_ends(part.column("value"))
                first = after_lines(out, inside, ends[0])
                if not done:
                    stop = np.flatnonzero(~first)
                    header += part.column("value")[:int(stop[0]) + 1 if len(stop) else len(first)].to_pylist()
                    limit.check(file, header)
                    done = len(stop) > 0
                ends = (bool(first[-1]), bool(after_lines(out, inside, ends[1])[-1]))
            yield table_of(rows, schema)
        yield table_of(told(), schema)

    return lines.select("value", "file", "block").mapInArrow(
        scan, "file string, block long, from_out boolean, from_in boolean, header binary")


def beginnings(ends: DataFrame) -> DataFrame:
    """``file, block, inside``: whether each block begins inside quotes.

    The window holds one line for each block of a file.
    """
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    settled, turned = F.col("from_out") == F.col("from_in"), F.col("from_out") & ~F.col("from_in")
    turns = ends.withColumn("turns", F.sum(turned.cast("int")).over(upto))
    last = F.last(F.when(settled, F.struct("from_out", "turns")), ignorenulls=True).over(before)
    here = turns.withColumn("last", last).withColumn(
        "earlier", F.coalesce(F.max("turns").over(before), F.lit(0)))
    odd = (F.col("earlier") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    return here.select("file", "block", (
        F.coalesce("last.from_out", F.lit(False)) != odd).alias("inside"))


def block_pieces(lines: DataFrame, separator: bytes, most: int) -> DataFrame:
    """``PIECES`` of lines ``(value, file, block, inside)``, in the order of each block.

    ``head`` marks the first record of a file.
    """
    limit = _Limit(most)
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()),
                        ("head", pa.bool_()), ("text", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Lines of the record being read, what it is if it ends here, whether the last of them
        # ends inside quotes, and whether the file's first record is still to come.
        at, held, kind, inside, first = None, [], WHOLE, False, False

        def piece(kind: int) -> tuple:
            nonlocal held, first
            limit.check(at[0], held)
            row = (*at, kind, first and kind != ON, separator.join(held))
            held, first = [], first and kind == ON
            return row

        def rest() -> list[tuple]:
            if not held:
                return []
            return [piece(ON if kind == ON else OPEN)]

        for batch in batches:
            done: list[pa.RecordBatch] = []
            for file, block, part in spans(batch):
                values = part.column("value")
                if (file, block) != at:
                    done.append(table_of(rest(), schema))
                    at, inside = (file, block), bool(part.column("inside")[0].as_py())
                    kind, first = ON if inside else WHOLE, block == 0
                after = after_lines(*line_ends(values), inside)
                ends = np.flatnonzero(~after)
                inside = bool(after[-1])
                if not len(ends):
                    held += values.to_pylist()
                    limit.check(file, held)
                    continue
                rows, start = [], 0
                if held or kind == ON or first:
                    start = int(ends[0]) + 1
                    held += values[:start].to_pylist()
                    rows, kind = [piece(kind)], WHOLE
                done.append(table_of(rows, schema))
                # Records of one line are taken as they are.
                ends = ends[ends >= start]
                begins = np.append(start, ends[:-1] + 1)[:len(ends)]
                texts = values.take(pa.array(begins))
                several = np.flatnonzero(begins < ends)
                if len(several):
                    texts = texts.to_pylist()
                    for i in several:
                        texts[i] = separator.join(values[int(begins[i]):int(ends[i]) + 1].to_pylist())
                        limit.check(file, [texts[i]])
                    texts = pa.array(texts, pa.binary())
                n = len(ends)
                done.append(pa.RecordBatch.from_arrays(
                    [pa.array([file] * n, pa.string()), pa.array(np.full(n, block)),
                     pa.array(np.full(n, WHOLE, np.int32)), pa.array(np.zeros(n, bool)),
                     texts.cast(pa.binary())], schema=schema))
                held = values[int(ends[-1]) + 1 if n else start:].to_pylist()
            yield from (d for d in done if d.num_rows)
        yield table_of(rest(), schema)

    return lines.select("value", "file", "block", "inside").mapInArrow(cut, PIECES)


def text_lines(spark: SparkSession, paths: str | list[str], separator: str) -> DataFrame:
    """Lines as bytes, with their file and the start of their block in it."""
    return spark.read.text(paths, lineSep=separator).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def kept(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined_pieces(pieces: DataFrame, separator: Column, most: int) -> DataFrame:
    """Records over several blocks: ``file, block`` they begin in, ``head`` and ``text``."""
    number = F.sum((F.col("kind") == OPEN).cast("int")).over(W.partitionBy("file").orderBy("block", "kind"))
    size = F.sum(F.octet_length("text")).over(W.partitionBy("file", "number").orderBy("block"))
    # Checked before a record's pieces are gathered.
    text = F.when(F.col("size") > most, F.raise_error(F.concat(
        F.lit("a record of "), F.col("file"), F.lit(f" has more than {most} bytes"))).cast("binary")
    ).otherwise(F.col("text"))
    whole = F.aggregate(F.slice("parts", 2, F.size("parts")), F.col("parts")[0]["text"],
                        lambda text, p: F.concat(text, separator.cast("binary"), p["text"]))
    return (pieces.withColumn("number", number).withColumn("size", size).withColumn("text", text)
            .groupBy("file", "number")
            .agg(F.min("block").alias("block"), F.bool_or("head").alias("head"),
                 F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
            .select("file", "block", "head", whole.alias("text")))
