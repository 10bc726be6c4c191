"""Queries on file readers, file encodings and the smaller predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tapeworks import fixtures as X
from tapeworks.catalog.manifest import BRONZE
from tapeworks.catalog.registry import query
from tapeworks.functions.hashing import provenance_hash
from tapeworks.operators import metrics as MT, validate as V
from tapeworks.session import workspace
from tapeworks.sinks import parquet as P
from tapeworks.sources.payloads import attach_content, is_virtual, scan_payload_files
from tapeworks.sources.reference_data import legacy_bronze_rows, read_label_list, read_master_csv
from tapeworks.sources.silver import read_nanosecond_parquet, read_silver


@query("q_payload_files", """
select cast(sum(strlen(text) + 1) as bigint) as bytes, true as found, true as same from documents""")
def payload_files(spark, sf_dir):
    """Documents as files of lines: their bytes by scan, and by asking for each file."""
    folder = workspace(spark, "payload-files")
    X.table(spark, sf_dir, "documents").select("text").write.text(folder)
    files = scan_payload_files(spark, folder, "part-*")
    listed = files.select("source_uri").withColumn("sha256", F.xxhash64("source_uri").cast("string"))
    asked = attach_content(listed, files).agg(
        F.sum(F.octet_length("content")).alias("bytes"), F.every(F.col("content").isNotNull()).alias("found"))
    total = files.agg(F.sum(F.octet_length("content")).alias("scanned"))
    # Two one-row results side by side.
    return asked.join(total, F.col("bytes") == F.col("scanned"), "left").select(
        "bytes", "found", F.col("scanned").isNotNull().alias("same"))


@query("q_master_file", f"""
with raw as ({X.master_sql('part')})
select {", ".join(f"nullif(trim({c}), '') as {c}" for c in
                  ("isin", "ticker", "figi", "asset_class", "country", "currency"))} from raw""")
def master_file(spark, sf_dir):
    """The instrument master written as CSV, with its columns in another order, and read back."""
    raw = spark.sql(X.master_sql("{part}"), part=X.table(spark, sf_dir, "part"))
    folder = workspace(spark, "master")
    raw.select("currency", "figi", "ticker", "row_no", "asset_class", "isin", "country").write.option(
        "header", "true").option("ignoreLeadingWhiteSpace", "false").csv(folder)
    return read_master_csv(spark, folder).drop("row_no")


@query("q_nanosecond_import", f"""
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as at, true as same from events""")
def nanosecond_import(spark, sf_dir):
    """Events stored by another writer with nanosecond times, read back: cut to microseconds."""
    events = X.table(spark, sf_dir, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    folder = workspace(spark, "nanoseconds")

    def write(batches):
        """One file for each task; each time gets some nanoseconds more."""
        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet as pq
        from pyspark import TaskContext
        fs, path = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        fs.create_dir(path)
        for n, batch in enumerate(batches):
            ids = batch.column("event_id").to_numpy()
            ns = batch.column("us").to_numpy() * 1000 + ids % 1000
            rows = pa.table({"event_id": ids, "ts": pa.array(ns, pa.timestamp("ns", "UTC"))})
            pq.write_table(rows, f"{path}/part-{TaskContext.get().partitionId()}-{n}.parquet",
                           filesystem=fs, version="2.6")
            yield pa.RecordBatch.from_arrays([pa.array([len(ids)])], ["n"])

    events.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    read = read_nanosecond_parquet(spark, folder, "ts")
    return read.join(events, "event_id").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"),
        (F.unix_micros("ts") == F.col("us")).alias("same"))


@query("q_schema_drift", """
select variant, drift, rows from (values ('pinned', ''), ('without flags', 'missing trade_flags_raw string'),
  ('moved', 'column order'), ('retyped', 'missing seq bigint; unexpected seq int'),
  ('longer', 'unexpected note string')) variants(variant, drift), (select count(*) as rows from lineitem) counts""")
def schema_drift(spark, sf_dir):
    """Trades written in five forms; the schema of the files is held against the pinned one."""
    rows = X.trade_rows(spark, sf_dir)
    forms = {"pinned": rows, "without flags": rows.drop("trade_flags_raw"),
             "moved": rows.select(*reversed(rows.columns)),
             "retyped": rows.withColumn("seq", F.col("seq").cast("int")),
             "longer": rows.withColumn("note", F.lit("x"))}
    found = []
    for variant, form in forms.items():
        folder = workspace(spark, "drift")
        # Digests are most of a row; they shrink by half under a codec that codes single bytes.
        form.write.option("compression", "zstd").parquet(folder)
        written = spark.read.parquet(folder)
        found.append(written.agg(F.count("*").alias("rows")).select(
            F.lit(variant).alias("variant"), F.lit("; ".join(V.schema_drift(written.schema, "trades"))).alias(
                "drift"), "rows"))
    return reduce(DataFrame.unionByName, found)


@query("q_label_files", """
select concat(lang, '-', doc_id, '.csv') as label, concat('legacy:', lang, '-', doc_id, '.csv') as sha256,
  'ingested' as status from documents""")
def label_files(spark, sf_dir):
    """Label lists as files, one JSON array each, read and turned into manifest rows."""
    label = F.concat("lang", F.lit("-"), "doc_id", F.lit(".csv"))
    folder = workspace(spark, "labels")
    (X.table(spark, sf_dir, "documents").groupBy(F.expr("doc_id div 200").alias("list"))
     .agg(F.to_json(F.collect_list(label)).alias("value")).write.partitionBy("list").text(folder))
    return legacy_bronze_rows(read_label_list(spark, folder), scraped_at=F.lit(0.0)).select(
        "label", "sha256", "status")


@query("q_file_codecs", """
select codec, count(*) as rows, cast(sum(l_quantity) as bigint) as size
from lineitem, (values ('gz'), ('snappy'), ('zstd')) codecs(codec) group by 1""")
def file_codecs(spark, sf_dir):
    """Every trade written with each compression; the codec is read off the file names.

    The first write lays the rows out; the others take them as they lie in its files.
    """
    rows, parts = X.trade_rows(spark, sf_dir), []
    for codec in ("gzip", "snappy", "zstd"):
        folder = workspace(spark, f"codec-{codec}")
        P.write_silver(rows, folder, "trades", compression=codec, row_group_rows=5_000, dealt=bool(parts),
                       file_bytes=P.PASS_BYTES)
        if not parts:
            rows = read_silver(spark, folder, "trades")
        name = F.regexp_extract(F.col("_metadata.file_name"), r"([a-z]+)\.parquet$", 1)
        parts.append(spark.read.parquet(f"{folder}/trades").select(name.alias("codec"), "trade_size"))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("codec").agg(F.count("*").alias("rows"),
                                      F.sum("trade_size").cast("long").alias("size"))


@query("q_virtual_files", """
select doc_id % 4 as kind, doc_id % 4 in (0, 1) as virtual, count(*) as files,
  count(*) filter (where doc_id % 4 < 3) as with_content,
  cast(sum(case when doc_id % 4 = 2 then strlen(text) else 0 end) as bigint) as bytes
from documents group by all""")
def virtual_files(spark, sf_dir):
    """Rows that never had a payload, rows with one, and rows whose payload is missing."""
    docs = X.table(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 4
    scheme = F.element_at(F.array(*map(F.lit, ("label-only://x/", "legacy://", "/in/", "/gone/"))),
                          (kind + 1).cast("int"))
    files = docs.select(kind.alias("kind"), F.concat(scheme, "doc_id").alias("source_uri"))
    payloads = docs.select(F.concat(F.lit("file:///in/"), "doc_id").alias("source_uri"),
                           F.encode("text", "UTF-8").alias("content"))
    got = attach_content(files, payloads)
    return got.groupBy("kind", is_virtual(F.col("source_uri")).alias("virtual")).agg(
        F.count("*").alias("files"), F.count("content").alias("with_content"),
        F.coalesce(F.sum(F.octet_length("content")), F.lit(0)).alias("bytes"))


@query("q_provenance", """
select doc_id, case when doc_id % 3 = 0 then sha256(text) else concat('own', doc_id) end as digest
from documents""")
def provenance(spark, sf_dir):
    """A record's own digest, or its payload's where it has none or an empty one."""
    own = F.when(F.col("doc_id") % 6 == 0, F.lit("")).when(
        F.col("doc_id") % 3 != 0, F.concat(F.lit("own"), "doc_id"))
    return X.table(spark, sf_dir, "documents").select(
        "doc_id", provenance_hash(own, F.sha2("text", 256)).alias("digest"))


@query("q_landing_metrics", f"""
with {BRONZE}, roots as (select split_part(exchange, '/', 1) as exchange, status, bytes_size from bronze_v)
select 'scraper_files_total' as name, exchange, 'http' as method, cast(count(*) as double) as value,
  'Files downloaded' as description from roots where status <> 'failed' group by 2
union all select 'scraper_bytes_total', exchange, 'http', cast(sum(bytes_size) as double),
  'Bytes downloaded' from roots where status <> 'failed' group by 2
union all select 'scraper_download_failures_total', exchange, 'http', cast(count(*) as double),
  'Download failures' from roots where status = 'failed' group by 2""")
def landing_metrics(spark, sf_dir):
    files = X.bronze_v(spark, sf_dir)
    failed = F.col("status") == "failed"
    series = MT.counters(MT.landing_increments(
        files.where(~failed), files.where(failed), "http", F.lit(1.0)))
    labels = F.map_from_entries("labels")
    return series.select("name", labels["exchange"].alias("exchange"), labels["method"].alias("method"),
                         "value", "description")
