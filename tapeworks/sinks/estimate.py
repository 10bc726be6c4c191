"""How many bytes a write would produce, without writing."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from tapeworks.functions.layout import partition_dir
from tapeworks.schema import SCHEMAS
from tapeworks.sinks.parquet import ROW_GROUP_ROWS, silver_layout

# Executors need pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZES = "partition_path string, files long, rows long, sampled long, bytes long"
# Rows encoded of each file: the first row group, in file order.
SAMPLE_ROWS = ROW_GROUP_ROWS
# Bytes of a column chunk's entry in a footer that other writers leave out.
COLUMN_ENTRY = 40


def encoded_bytes(rows: pa.Table, compression: str) -> tuple[int, int]:
    """Bytes of the column data of one file with these rows, and of everything else."""
    sink = pa.BufferOutputStream()
    pq.write_table(rows, sink, compression=compression, data_page_version="2.0", store_schema=False,
                   coerce_timestamps="us", allow_truncated_timestamps=True)
    data = sink.getvalue()
    found = pq.read_metadata(pa.BufferReader(data))
    group = found.row_group(0)
    inside = sum(group.column(i).total_compressed_size for i in range(group.num_columns))
    return inside, data.size - inside


def estimate(df: DataFrame, table: str, *, compression: str = "snappy", row_group_rows: int = ROW_GROUP_ROWS,
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``SIZES``: a line for each directory with the bytes that ``write_silver`` would give it.

    Rows are laid out as for a write.  Of each run of rows that would be a file, the
    first ``sample_rows`` are encoded in memory, and the size of their column data is
    carried on to all rows of the run; every row group and file adds its footer.
    """
    stored = T.StructType(SCHEMAS[table].fields)
    where = partition_dir(table, F.col("exchange"), F.col("event_ts"), F.col("instrument_type"))
    laid = silver_layout(df.select(*stored.names), "").select(where.alias("partition_path"), *stored.names)
    schema_text = len(json.dumps(json.loads(stored.json())))
    names = stored.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, held, kept = None, 0, 0, []

        def told() -> tuple:
            inside, footer = encoded_bytes(pa.Table.from_batches(kept), compression)
            groups = -(-rows // row_group_rows)
            size = inside * rows / held + groups * (footer + COLUMN_ENTRY * len(names)) + schema_text
            return at, 1, rows, held, round(size)

        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column("partition_path")
            cuts = pc.indices_nonzero(pc.not_equal(place[1:], place[:-1])).to_pylist()
            edges, out = [0, *(c + 1 for c in cuts), batch.num_rows], []
            for a, b in zip(edges, edges[1:], strict=False):
                if place[a].as_py() != at:
                    if at is not None:
                        out.append(told())
                    at, rows, held, kept = place[a].as_py(), 0, 0, []
                rows += b - a
                take = min(b - a, sample_rows - held)
                if take:
                    kept.append(batch.select(names).slice(a, take))
                    held += take
            yield from lines(out)
        if at is not None:
            yield from lines([told()])

    def lines(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (
                    pa.string(), *[pa.int64()] * 4), strict=True)],
                ["partition_path", "files", "rows", "sampled", "bytes"])

    return laid.mapInArrow(run, SIZES).groupBy("partition_path").agg(
        *[F.sum(c).alias(c) for c in ("files", "rows", "sampled", "bytes")])
