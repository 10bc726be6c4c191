import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from tapeworks.catalog import QUERIES
from tapeworks.fixtures import ingest_files
from tapeworks.plans.ingest import parquet_sink
from tapeworks.session import configure
from tapeworks.sources.silver import read_silver
from tapeworks.operators import dq
from tapeworks.streaming import passes as S
from tapeworks.streaming.dedupe import read_parts, split_batch
from tapeworks.streaming.hours import feed_hours

HEAD = "TradingDateTime,ISIN,Price,Quantity\n"


def test_files_are_ingested_once_as_they_arrive(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    outcomes = {}

    def drain():
        files = S.stream_payload_files(spark, str(inbox), exchange="athex", max_files=1)
        S.stream_ingest(files, parquet_sink(str(tmp_path / "silver")),
                        lambda df, n: outcomes.update({n: df.collect()}),
                        checkpoint=str(tmp_path / "cp"),
                        ingest_ts=F.timestamp_seconds(F.lit(1))).awaitTermination()

    (inbox / "a.csv").write_text(HEAD + "2025-08-01,A,1,2\n")
    (inbox / "b.csv").write_text(HEAD + "2025-08-01,B,1,2\nbad,B,1,2\n")
    drain()
    (inbox / "c.csv").write_text(HEAD + "2025-08-02,C,1,2\n2025-08-02,D,1,2\n")
    drain()
    done = sorted((r.label, r.outcome, r.rows) for rows in outcomes.values() for r in rows)
    assert done == [("a.csv", "ok", 1), ("b.csv", "ok", 1), ("c.csv", "ok", 2)]
    rows = read_silver(spark, str(tmp_path / "silver"), "trades").collect()
    assert sorted((r.isin, r.source_file, r.seq) for r in rows) == [
        ("A", "a.csv", 1), ("B", "b.csv", 1), ("C", "c.csv", 1), ("D", "c.csv", 2)]


def test_payloads_are_moved_without_their_digests(spark):
    plan = ingest_files(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "sha2(" in plan[:plan.index("Exchange ")] and "sha2(" not in plan[plan.index("Exchange "):]


def test_what_a_stream_stages_codes_single_bytes(spark):
    """Digests of files are most of what is staged: under snappy they kept their hexadecimal size."""
    base = Path(spark.conf.get("spark.checkpoint.dir")) / "tapeworks"
    before = set(base.glob("*"))
    QUERIES["q_stream_ingest"](spark, "/root/testdata/sf0.001")
    new = sorted(set(base.glob("*")) - before)
    for pattern in ("ingest-*/staged", "stream-ingest-*/incoming", "stream-ingest-*/outcomes"):
        files = [f.name for folder in new for f in folder.parent.glob(f"{folder.name}/**/*.parquet")
                 if f.parent.match(pattern) or f.parent.parent.match(pattern)]
        assert files and all(name.endswith(".zstd.parquet") for name in files), pattern


def test_dedupe_across_batches(spark, tmp_path):
    rows = [("h1", dt.datetime(2025, 8, 1, 9)), ("h1", dt.datetime(2025, 8, 1, 9)),
            ("h2", dt.datetime(2025, 8, 1, 9, 1))]
    df = spark.createDataFrame(rows, "source_msg_hash string, event_ts timestamp").coalesce(1)
    for _ in range(2):
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = S.stream_folder(spark, str(tmp_path / "in"), df.schema, max_files=1)
        kept = S.stream_dedupe(stream, ["source_msg_hash"], delay="1 hour")
        S.append_stream(kept, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp")
                        ).awaitTermination()
    got = [r.source_msg_hash for r in spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == ["h1", "h2"]


def test_rows_without_a_key_pass_through(spark, tmp_path):
    at = dt.datetime(2025, 8, 1, 9)
    df = spark.createDataFrame([("h", at), ("h", at), (None, at), (None, at)],
                               "trade_id string, event_ts timestamp").coalesce(1)
    df.write.parquet(str(tmp_path / "in"))
    kept = S.stream_dedupe(S.stream_folder(spark, str(tmp_path / "in"), df.schema), ["trade_id"])
    S.append_stream(kept, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect()
    assert sorted(r.trade_id or "" for r in got) == ["", "", "h"]


def test_a_batch_keeps_its_pass_id():
    assert S.batch_pass("/a", 3) == S.batch_pass("/a", 3) != S.batch_pass("/b", 3)


def test_silent_feeds_have_hours_and_fail_the_gate(spark, tmp_path):
    base, folder = 1754006400, str(tmp_path / "in")
    schema = "sha256 string, exchange string, status string, second long"

    def send(*rows):
        spark.createDataFrame(rows, schema).withColumn("scraped_ts", F.timestamp_seconds("second")).drop(
            "second").write.mode("append").parquet(folder)

    def drain():
        stream = S.stream_folder(spark, folder, spark.read.parquet(folder).schema)
        lines = feed_hours(stream, spark.createDataFrame([("quiet",)], "exchange string"), since=base + 60, shards=2)
        S.append_stream(lines, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp")).awaitTermination()
        return spark.read.schema(lines.schema).parquet(str(tmp_path / "out"))

    send(*[(f"s{i}", "busy", "failed" if i == 0 else "ok", base + i * 1800) for i in range(4)])
    drain()
    send(("m", "clock", "ok", base + 5 * 3600))
    hours = drain()
    got = {(r.exchange, r.hour): (r.files, r.failed) for r in hours.groupBy(
        "exchange", ((F.unix_seconds("window_start") - base) / 3600).cast("int").alias("hour")).agg(
        F.sum("files").alias("files"), F.sum("failed").alias("failed")).collect()}
    assert {h: v for (e, h), v in got.items() if e == "quiet"} == {h: (0, 0) for h in range(4)}
    assert {h: v for (e, h), v in got.items() if e == "busy"} == {0: (2, 1), 1: (2, 0), 2: (0, 0), 3: (0, 0)}
    rules = (dq.Rule("quiet", 1), dq.Rule("busy", 1, 0.5), dq.Rule("never", 0), dq.Rule("busy", 1, 0.1))
    failed = dq.check_hours(spark, hours, rules, end=F.timestamp_seconds(F.lit(base + 4 * 3600))).collect()
    assert [(r.rule_no, r.message) for r in sorted(failed, key=lambda r: r.rule_no)] == [
        (0, "DQ: exchange=quiet got 0 files in last 24h (expected >= 1)"),
        (3, "DQ: exchange=busy failure rate 1/4=25% exceeds max=10%")]


def test_a_session_with_the_default_state_store_gives_hours(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    # What a session has that wasn't built by this package.
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        configure(spark)
        spark.createDataFrame([("s", "a", "ok", dt.datetime(2025, 8, 1, 9))],
                              "sha256 string, exchange string, status string, scraped_ts timestamp"
                              ).write.parquet(str(tmp_path / "in"))
        stream = S.stream_folder(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
        lines = feed_hours(stream, spark.createDataFrame([("quiet",)], "exchange string"),
                           since=1754006400, shards=1)
        S.append_stream(lines, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp")).awaitTermination()
        got = spark.read.schema(lines.schema).parquet(str(tmp_path / "out")).where("exchange = 'quiet'")
        # The watermark is an hour behind the file of nine o'clock.
        assert [r.files for r in got.collect()] == [0] * 8
    finally:
        spark.conf.set(key, before)


def test_every_row_is_kept_late_or_a_repeat(spark, tmp_path):
    def at(hour):
        return dt.datetime(2025, 8, 1) + dt.timedelta(hours=hour)

    schema, folder = "k string, event_ts timestamp, n int", str(tmp_path)
    batches = [[("a", at(5), 1), ("a", at(6), 2), (None, at(5), 3), (None, at(5), 4)],
               [("a", at(7), 5), ("b", at(1), 6), ("b", at(30), 7), ("c", at(5), 8)],
               [("a", at(40), 9), ("b", at(31), 10), ("c", at(19), 11), (None, at(2), 12), (None, None, 13)]]
    for number in (0, 1, 1, 2, 2):  # batches that run again replace their own rows
        split_batch(spark.createDataFrame(batches[number], schema), number, ["k"], folder, delay="10 hours")
    rows = read_parts(spark, folder, spark.createDataFrame([], schema)).collect()
    assert {r.n: (r.batch, r.part) for r in rows} == {
        1: (0, "kept"), 2: (0, "repeats"), 3: (0, "kept"), 4: (0, "kept"),
        5: (1, "repeats"), 6: (1, "kept"), 7: (1, "repeats"), 8: (1, "kept"),
        # The mark is hour 20 by now: what was kept at hour 5 is forgotten.
        9: (2, "kept"), 10: (2, "kept"), 11: (2, "late"), 12: (2, "late"), 13: (2, "kept")}
    assert len(rows) == 13
