import datetime as dt
import os
import random
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapeworks.operators.manifest import ManifestTables
from tapeworks.plans import ingest as I, landing as L
from tapeworks.sinks import maintenance, parquet as P
from tapeworks.sources.rows import typed_select
from tapeworks.sources.silver import read_live, read_nanosecond_parquet, read_silver
from tests.test_operators import bronze, trades

CSV = ("TradingDateTime,ISIN,Price,Quantity,Currency,Flags\n"
       "2025-08-01T09:00:00Z,DE1,42.78,125,EUR,LRGS\n2025-08-01T08:00:00Z,DE1,42.80,10,EUR,\n")


def land(spark, store, *files):
    """Files as (feed, label, content); returns their payload table."""
    rows = [(e, lab, f"/in/{lab}", bytearray(c.encode())) for e, lab, c in files]
    payloads = spark.createDataFrame(rows, "feed string, label string, source_uri string, content binary")
    candidates = L.bronze_candidates(payloads, exchange=F.col("feed"), scraped_at=F.lit(1.0))
    store.land(L.select_new(spark, candidates, store.bronze()))
    return payloads.select("source_uri", "content")


def test_ingest_end_to_end(spark, tmp_path):
    store, root = ManifestTables(spark, str(tmp_path / "m")), str(tmp_path / "data")
    payloads = land(spark, store, ("athex", "a.csv", CSV), ("nowhere", "n.csv", CSV + "x"),
                    ("bme", "bad.json", "5"), ("bme", "odd.json", "{"), ("berlin", "e.csv", " "))
    result = I.run_ingest(spark, store, payloads, root, now=50.0)
    assert {r.label: (r.outcome, r.rows, r.malformed) for r in result.outcomes.collect()} == {
        "a.csv": ("ok", 2, False), "n.csv": ("no_adapter", 0, False),
        "bad.json": ("failed", 0, False), "odd.json": ("empty", 0, True),
        "e.csv": ("empty", 0, True)}
    stats = I.pass_stats(result.outcomes).first()
    assert (stats.seen, stats.parsed_rows, stats.files_ok, stats.files_failed,
            stats.files_skipped_no_adapter) == (5, 2, 3, 1, 1)
    assert {r.label: r.status for r in store.bronze().collect()} == {
        "a.csv": "ingested", "n.csv": "downloaded", "bad.json": "failed", "odd.json": "ingested",
        "e.csv": "ingested"}
    rows = read_silver(spark, root, "trades").collect()
    assert [r.event_ts.hour for r in rows] == [8, 9] and rows[0].p_exchange == "ATHEX"
    files = store.silver().collect()
    assert [(f.rows, f.status, f.partition_path) for f in files] == [
        (2, "written", "trades/exchange=ATHEX/year=2025/month=08/day=01/instrument_type=equity")]
    assert files[0].bronze_sha256 is not None
    # A second pass sees the unmapped file only, and only if it may use up the limit.
    assert I.pass_stats(I.run_ingest(spark, store, payloads, root).outcomes).first().seen == 1
    again = I.run_ingest(spark, store, payloads, root, skip_unmapped=True)
    assert I.pass_stats(again.outcomes).first().seen == 0


def test_writer_failure_fails_the_batch(spark, tmp_path):
    store = ManifestTables(spark, str(tmp_path / "m"))
    payloads = land(spark, store, ("athex", "a.csv", CSV), ("berlin", "e.csv", ""))

    def broken(tables, pass_id):
        raise I.SinkRefused("boom")

    I.run_ingest(spark, store, payloads, str(tmp_path / "data"), sink=broken, now=5.0)
    state = {r.label: (r.status, r.error) for r in store.bronze().collect()}
    assert state == {"a.csv": ("failed", "writer: SinkRefused('boom')"),
                     "e.csv": ("ingested", None)}


def one_by_one(candidates, known_labels, known_shas):
    landed, labels, shas = [], set(known_labels), set(known_shas)
    for sha, label, at in sorted(candidates, key=lambda c: (c[2], c[0], c[1])):
        if label not in labels and sha not in shas:
            landed.append((sha, label))
            labels.add(label)
            shas.add(sha)
    return sorted(landed)


@pytest.mark.parametrize("batch", [
    [("S", "a", 1), ("T", "a", 2), ("T", "b", 3)],
    [("S", "a", 1), ("S", "b", 2), ("T", "b", 3)],
    [(f"S{i // 2}", f"l{(i + 1) // 2}", i) for i in range(12)],
    [(f"S{i * 7 % 5}", f"l{i * 3 % 4}", i) for i in range(20)],
    [("K", "z", 1), ("Q", "known", 2), ("Q", "c", 3)],
])
def test_landing_equals_one_by_one(spark, batch):
    candidates = bronze(spark, *[(s, "x", lab, at, "downloaded") for s, lab, at in batch])
    known = bronze(spark, ("K", "x", "known", 0, "ingested"))
    got = sorted((r.sha256, r.label) for r in L.select_new(spark, candidates, known).collect())
    assert got == one_by_one(batch, {"known"}, {"K"})


def test_a_long_chain_settles_in_few_rounds(spark, monkeypatch):
    """10,000 payloads in one chain, each sharing its digest or label with the one before."""
    batch = [(f"S{i // 2}", f"l{(i + 1) // 2}", i) for i in range(10_000)]
    rounds = []
    settled = L._settled
    monkeypatch.setattr(L, "_settled", lambda *a: rounds.append(1) or settled(*a))
    candidates = bronze(spark, *[(s, "x", lab, at, "downloaded") for s, lab, at in batch])
    got = sorted((r.sha256, r.label) for r in L.select_new(spark, candidates, bronze(spark)).collect())
    assert got == one_by_one(batch, set(), set()) and len(got) == 5_000
    assert len(rounds) == 2


def test_tangled_landings_and_null_labels(spark):
    pick = random.Random(2)
    batch = [(f"S{pick.randrange(120)}", f"l{pick.randrange(120)}", i) for i in range(300)]
    batch += [("hot", f"h{i % 50}", 400 + i) for i in range(200)]
    schema = bronze(spark, ("S", "x", "l", 1, "downloaded")).schema
    rows = bronze(spark, *[(s, "x", lab, at, "downloaded") for s, lab, at in batch])
    null = bronze(spark, ("N1", "x", "?", 900, "downloaded"), ("N2", "x", "?", 901, "downloaded")).withColumn(
        "label", F.lit(None).cast("string")).select(*schema.names)
    got = L.select_new(spark, rows.unionByName(null), bronze(spark)).collect()
    assert sorted((r.sha256, r.label) for r in got if r.label) == one_by_one(batch, set(), set())
    assert sorted(r.sha256 for r in got if r.label is None) == ["N1", "N2"]


def test_files_are_sorted_in_limited_row_groups(spark, tmp_path):
    place = F.col("id") * 37 % 1000
    df = typed_select(spark.range(1000), "trades", {
        "seq": place, "event_ts": F.timestamp_seconds(F.lit(1754006400) + place),
        "ingest_ts": F.timestamp_seconds(F.lit(1)), "exchange": F.lit("X Y/Z"),
        "isin": F.lit("A"), "data_type": F.lit("post_trade"), "schema_version": F.lit("2.0.0")})
    P.write_silver(df, str(tmp_path), "trades", compression="zstd", row_group_rows=300)
    files = list(tmp_path.glob("trades/*/*/*/*/*/*/*.parquet"))
    seqs = []
    for path in files:
        assert "p_exchange=X_Y_Z" in str(path) and "p_instrument_type=unknown" in str(path)
        meta = pq.ParquetFile(path).metadata
        assert all(meta.row_group(i).num_rows <= 300 for i in range(meta.num_row_groups))
        assert meta.row_group(0).column(0).compression == "ZSTD"
        mine = pq.read_table(path, partitioning=None)["seq"].to_pylist()
        assert mine == sorted(mine)
        seqs += mine
    assert sorted(seqs) == list(range(1000))
    back = read_silver(spark, str(tmp_path), "trades").first()
    assert back.exchange == "X Y/Z" and back.instrument_type is None
    plan = P.lay_out(P.with_partition_columns(df, "p"), P.PARTITION_COLUMNS)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1


def test_digests_and_directories_travel_light(spark, tmp_path):
    texts = ["", "ab", "AB", "abc", "zz", None, "0a" * 32, "\u00e9", "\x01ab"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", P.packed(F.col("t")).alias("p"))
    got = df.select("t", P.unpacked(F.col("p")).alias("back"), F.octet_length("p").alias("n")).collect()
    assert [r.back for r in got] == texts
    assert {r.t: r.n for r in got}["0a" * 32] == 33
    rows = trades(spark, *[{"seq": i, "source_msg_hash": t} for i, t in enumerate(texts)])
    P.write_silver(rows, str(tmp_path), "trades")
    back = read_silver(spark, str(tmp_path), "trades").orderBy("seq").collect()
    assert [r.source_msg_hash for r in back] == texts
    plan = P.silver_layout(rows, "p")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange ") == 1
    moved = plan[plan.index("Exchange "):]
    # The path columns are made behind the shuffle, where rows arrive.
    assert "p_exchange" not in moved and "p_pass" not in moved
    assert P.FILE_BYTES == "192m"  # what one task reads and sorts



def test_laid_out_rows_are_written_again_without_being_moved(spark, tmp_path):
    rows = trades(spark, *[{"seq": i, "exchange": "AB"[i % 2], "isin": None if i % 3 else "X"} for i in range(40)])
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    P.write_silver(rows, first, "trades", compression="gzip")
    stored = read_silver(spark, first, "trades")
    P.write_silver(stored, second, "trades", compression="zstd", dealt=True)
    names = [*rows.columns, *P.DIRECTORY_COLUMNS]
    again = read_silver(spark, second, "trades").select(*names)
    assert again.count() == 40 and again.exceptAll(stored.select(*names)).count() == 0
    plan = P.silver_layout(stored.select(*rows.columns), "p", dealt=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" in plan


def test_rows_written_again_are_sorted_in_small_pieces(spark, tmp_path, monkeypatch):
    """A task sorts as many rows as fit its memory, whatever a session reads at once."""
    start = dt.datetime(2025, 8, 1)
    rows = trades(spark, *[{"seq": i, "exchange": "AB"[i % 2], "event_ts": start + dt.timedelta(
        seconds=i * 37 % 3000), "source_msg_hash": f"{i * 7919 % 65521:064x}"} for i in range(3000)])
    first, second = str(tmp_path / "first"), tmp_path / "second"
    P.write_silver(rows, first, "trades", compression="gzip", row_group_rows=100)
    monkeypatch.setattr(P, "DEALT_BYTES", "4k")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    P.write_silver(read_silver(spark, first, "trades"), str(second), "trades", compression="zstd", dealt=True)
    assert spark.conf.get(key) == before
    files = list(second.glob("trades/*/*/*/*/*/*/*.parquet"))
    assert len(files) > 4
    seqs = []
    for path in files:
        stored = pq.read_table(path, partitioning=None)
        times = stored["event_ts"].to_pylist()
        assert times == sorted(times)
        seqs += stored["seq"].to_pylist()
    assert sorted(seqs) == list(range(3000))


def test_a_write_leaves_no_shuffled_rows(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    P.write_silver(trades(spark, *[{"seq": i, "exchange": "AB"[i % 2]} for i in range(100)]), str(tmp_path), "trades")
    for _ in range(100):
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert read_silver(spark, str(tmp_path), "trades").count() == 100


def test_what_repeats_travels_first(spark):
    rows = trades(spark, {"seq": 1}).withColumn("bronze_sha256", F.lit("0a"))
    order = P.moved_order(rows)
    assert sorted(order) == sorted(rows.columns) and order[0] == "publication_ts"
    place = {c: i for i, c in enumerate(order)}
    assert place["schema_version"] < place["source_msg_hash"] < place["isin"] < place["trade_flags_raw"]
    assert place["trade_flags_raw"] < place["event_ts"] < place["trade_price"]
    laid = P.silver_layout(rows, "one-pass").select("seq", "p_pass")  # few columns, or the plan's text is cut
    plan = laid._jdf.queryExecution().executedPlan().toString()
    # The pass is made behind the sort, and in its keys; no sorted row holds it.
    assert plan.count("AS p_pass") == 1 and plan.index("AS p_pass") < plan.index("Sort [")


def test_a_pass_sorts_less_at_once(spark, tmp_path, monkeypatch):
    """Rows of a pass are wide; what one task reads has to fit its memory once it is sorted."""
    asked = []
    monkeypatch.setattr(I, "write_silver", lambda *a, **options: asked.append(options["file_bytes"]))
    I.parquet_sink(str(tmp_path))({"trades": trades(spark, {"seq": 1})}, "p")
    I.parquet_sink(str(tmp_path), file_bytes="7m")({"trades": trades(spark, {"seq": 1})}, "p")
    assert asked == [P.PASS_BYTES, "7m"] and int(P.PASS_BYTES[:-1]) * 2 <= int(P.FILE_BYTES[:-1])


def test_the_size_behind_a_file_is_asked_for(spark, tmp_path):
    rows = trades(spark, *[{"seq": i, "source_msg_hash": f"{i * 7919 % 65521:064x}"} for i in range(2000)])
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    P.write_silver(rows.repartition(8), str(tmp_path), "trades", file_bytes="5k")
    assert spark.conf.get(key) == before
    files = list(tmp_path.glob("trades/*/*/*/*/*/*/*.parquet"))
    assert len(files) >= 3 and read_silver(spark, str(tmp_path), "trades").count() == 2000


def test_pruning_reaches_the_scan(spark, tmp_path):
    P.write_silver(trades(spark, {"seq": 1}, {"seq": 2, "exchange": "B"}), str(tmp_path), "trades")
    df = read_silver(spark, str(tmp_path), "trades").where(
        "p_exchange = 'B' and isin = 'A'").select("seq")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_exchange" in plan
    assert "EqualTo(isin,A)" in plan and "ReadSchema: struct<seq:bigint,isin:string>" in plan


def test_compaction_and_retention(spark, tmp_path):
    store, root = ManifestTables(spark, str(tmp_path / "m")), str(tmp_path / "d")
    for i in range(3):
        df = trades(spark, {"seq": i}, {"seq": i + 10, "event_ts": dt.datetime(2025, 7, 30)})
        P.write_silver(df.withColumn("bronze_sha256", F.lit(f"s{i}")), root, "trades", lineage=True)
        store.record_silver(P.silver_rows(P.written_files(spark, root, "trades", store.silver()),
                                          F.lit(float(i))))
    assert store.silver().count() == 6
    maintenance.compact(spark, store, root, "trades", min_files=3, now=9.0)
    maintenance.compact(spark, store, root, "trades", min_files=2, now=9.5, event_no=2)
    by_status = {r.status: (r.n, r.rows) for r in store.silver().groupBy("status").agg(
        F.count("*").alias("n"), F.sum("rows").alias("rows")).collect()}
    assert by_status == {"written": (2, 6), "compacted": (6, 6)}
    live = read_live(spark, root, "trades", store.silver())
    assert sorted(r.seq for r in live.collect()) == [0, 1, 2, 10, 11, 12]
    plan = live._jdf.queryExecution().optimizedPlan().toString()
    assert "p_day" in plan.split("LeftSemi")[1].split("\n")[0]
    # Written but not registered: not visible.
    P.write_silver(trades(spark, {"seq": 99}), root, "trades")
    assert read_live(spark, root, "trades", store.silver()).count() == 6
    store.record_silver(maintenance.expired(store.silver(), "2025-08-01", 10.0), 2)
    assert sorted(r.seq for r in read_live(spark, root, "trades", store.silver()).collect()) == [0, 1, 2]


def test_other_failures_end_the_pass(spark, tmp_path):
    store = ManifestTables(spark, str(tmp_path / "m"))
    payloads = land(spark, store, ("athex", "a.csv", CSV))

    def lost(tables, pass_id):
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError, match="executor lost"):
        I.run_ingest(spark, store, payloads, str(tmp_path / "data"), sink=lost, now=5.0)
    assert store.bronze().first().status == "downloaded"


def test_a_repeated_pass_replaces_its_rows(spark, tmp_path):
    store, root = ManifestTables(spark, str(tmp_path / "m")), str(tmp_path / "data")
    payloads = land(spark, store, ("athex", "a.csv", CSV))
    files = I.attach_content(I.pending(store.bronze()), payloads.unionByName(payloads))
    for at in (1.0, 2.0):
        result = I.ingest_batch(spark, files, I.parquet_sink(root), ingest_ts=F.timestamp_seconds(
            F.lit(1)), pass_id="p")
        I.register(spark, store, root, result, "p", at)
    assert read_silver(spark, root, "trades").count() == 2
    assert read_live(spark, root, "trades", store.silver()).count() == 2
    assert {r.status: r["count"] for r in store.silver().groupBy("status").count().collect()} == {
        "written": 1, "expired": 1}


def test_range_keys_cost_little(spark):
    """The keys of ranges are computed twice for each row: no time is formatted for them."""
    rows = trades(spark, {"trade_id": "1"})
    plan = P.silver_layout(rows, "p", ranges=8)._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "rangepartitioning" in line]
    below = plan[plan.index(keys[0]):]
    assert len(keys) == 1 and "date_format" not in below


def test_a_hot_directory_is_cut_by_time(spark, tmp_path):
    """Files of one directory don't overlap, so a filter on time leaves most of them unread."""
    at = dt.datetime(2025, 8, 1)
    rows = trades(spark, *[{"seq": i, "event_ts": at + dt.timedelta(minutes=i * 7 % 1000)} for i in range(1000)])
    P.write_silver(rows, str(tmp_path), "trades", ranges=8)
    table = read_silver(spark, str(tmp_path), "trades")
    spans = sorted(table.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("event_ts").alias("a"), F.max("event_ts").alias("b")).select("a", "b").collect())
    assert len(spans) >= 6 and all(x.b <= y.a for x, y in zip(spans, spans[1:]))
    some = table.where((F.col("event_ts") >= at + dt.timedelta(minutes=100)) & (
        F.col("event_ts") < at + dt.timedelta(minutes=110))).select("seq")
    assert some.count() == 10
    execution = some._jdf.queryExecution().executedPlan()
    some._jdf.collectToPython()
    leaves = execution.collectLeaves()
    read = [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())]
    assert 10 <= sum(read) <= 300


def test_purge_deletes_what_nobody_needs(spark, tmp_path):
    store, root = ManifestTables(spark, str(tmp_path / "m")), str(tmp_path / "data")
    rows = trades(spark, *[{"seq": i, "event_ts": dt.datetime(2025, 8, 1 + i % 2)} for i in range(8)])
    rows = rows.withColumn("bronze_sha256", F.lit("s"))
    for at in (1.0, 2.0):
        pass_id = P.write_silver(rows, root, "trades", lineage=True)
        store.record_silver(P.silver_rows(P.written_files(spark, root, "trades", store.silver(), pass_id=pass_id), F.lit(at)))
    maintenance.compact(spark, store, root, "trades", now=10.0)
    store.record_silver(maintenance.expired(store.silver(), "2025-08-02", 50.0), 2)

    def files():
        return {str(p) for p in (tmp_path / "data").rglob("*.parquet")}

    def paths(df):
        return {"/" + r.target_uri.removeprefix("file:").lstrip("/") for r in df.collect()}

    every, state = files(), store.silver()
    compacted, expired_ = paths(state.where("status = 'compacted'")), paths(state.where("status = 'expired'"))
    live = paths(state.where("status = 'written'"))
    assert (len(compacted), len(expired_), len(live)) == (4, 1, 1) and every == compacted | expired_ | live
    readers = spark.createDataFrame([(9.0,)], "as_of double")
    assert maintenance.purgeable(state, now=100.0, grace=20.0, readers=readers).count() == 0
    assert paths(maintenance.purgeable(state, now=60.0, grace=20.0)) == compacted
    before = sorted(map(tuple, read_live(spark, root, "trades", store.silver()).collect()))
    maintenance.purge(spark, store, now=60.0, grace=20.0)
    assert files() == expired_ | live
    # A file that was marked but is gone already is no trouble.
    os.unlink(next(iter(expired_)))
    maintenance.purge(spark, store, now=200.0, grace=20.0, event_no=7)
    assert files() == live
    assert sorted(map(tuple, read_live(spark, root, "trades", store.silver()).collect())) == before
    assert {r.status: r["count"] for r in store.silver().groupBy("status").count().collect()} == {
        "written": 1, "purged": 5}


def test_nanosecond_import(spark, tmp_path):
    when = dt.datetime(2025, 8, 1, 9, 0, 0, 123456)
    table = pa.table({"t": pa.array([when], pa.timestamp("ns", tz="UTC")), "v": [1]})
    pq.write_table(table, tmp_path / "x.parquet")
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        assert read_nanosecond_parquet(spark, str(tmp_path), "t").first().t == when
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
