import datetime as dt

import pytest
from pyspark.sql import Row, functions as F, types as T

from tapeworks.plans.discover import discover, discover_after_mark
from tapeworks.sources.payloads import attach_content
from tapeworks.operators import discovery as D, dq, enrich as E, manifest as M, messages as MS
from tapeworks.operators import metrics as MT, registry as R, validate as V
from tapeworks.schema import SCHEMAS
from tapeworks.sources.rows import typed_select

NOW = dt.datetime(2025, 8, 1, 9, 30)


def trades(spark, *rows, **common):
    """Rows of ``trades`` from dicts, with sound defaults."""
    base = {"event_ts": NOW, "ingest_ts": NOW, "exchange": "BERA", "data_type": "post_trade",
            "schema_version": "2.0.0", **common}
    names = [f.name for f in SCHEMAS["trades"].fields]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in SCHEMAS["trades"].fields])
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], schema)


# --- enrichment -----------------------------------------------------------------

MASTER = [("A", "TA", "FA", "equity", "DE", "EUR", 1), ("B", None, "FB", "bond", None, None, 2),
          (None, "TB", None, "etf", None, "USD", 3), ("A", "TX", None, "late", None, "CHF", 4)]


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_first_key_supplies_the_whole_row(spark, limit):
    """The same rows whether Spark broadcasts the master or joins it by shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    master = spark.createDataFrame(MASTER, "isin string, ticker string, figi string, "
                                   "asset_class string, country string, currency string, row_no int")
    df = trades(spark, {"isin": "A", "seq": 1}, {"isin": "ZZ", "ticker": "TB", "seq": 2},
                {"figi": "FA", "seq": 3}, {"seq": 4}, {"isin": "B", "currency": "GBP", "seq": 5},
                {"isin": "", "ticker": "TA", "seq": 6},
                {"isin": "A", "ticker": "t", "figi": "f", "instrument_type": "i", "currency": "c",
                 "seq": 7})
    out = E.enrich(df, master).orderBy("seq")
    got = [(r.isin, r.ticker, r.figi, r.instrument_type, r.currency, r.touched)
           for r in out.collect()]
    assert got == [("A", "TX", None, "late", "CHF", True), ("ZZ", "TB", None, "etf", "USD", True),
                   ("A", "TA", "FA", "equity", "EUR", True), (None, None, None, None, None, False),
                   ("B", None, "FB", "bond", "GBP", True), ("", "TA", "FA", "equity", "EUR", True),
                   ("A", "t", "f", "i", "c", False)]
    assert E.enrich_count(out).first() == Row(touched=5, records=7)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_adapter_by_path_then_root(spark):
    df = spark.createDataFrame([("berlin/pretrade",), ("berlin/x",), ("cboe/bxe/hourly",),
                                ("bank-of-greece/Pre-Trade",), ("unknown/bme",)], "exchange string")
    got = [r.route and (r.route.adapter, r.route.exchange, r.route.mic, r.route.data_type)
           for r in R.resolve_adapter(df).collect()]
    assert got == [("rts13", "BERA", "BERA", "pre_trade"), ("rts13", "BERA", "BERA", "post_trade"),
                   ("rts13", "CBOE", None, "post_trade"), ("hdat", "BOG-HDAT", "HDAT", "pre_trade"),
                   None]


# --- validation -----------------------------------------------------------------

def test_reject_reasons(spark):
    df = trades(spark, {"seq": 1}, {"seq": 2, "event_ts": None}, {"seq": 3, "data_type": "bogus"},
                {"seq": 4, "trade_flag_canonical": "not_a_real_flag"},
                {"seq": 5, "trade_flag_canonical": "dark"}, {"seq": 6, "exchange": None,
                                                            "data_type": "bogus"})
    valid, rejects = V.split_valid(df, "trades")
    assert sorted(r.seq for r in valid.collect()) == [1, 5]
    assert {r.seq: r.reject_reason for r in rejects.collect()} == {
        2: "missing:event_ts", 3: "data_type:bogus", 4: "flag:not_a_real_flag",
        6: "missing:exchange"}
    assert V.require_valid(valid, "trades").count() == 2
    with pytest.raises(Exception, match="data_type:bogus"):
        V.require_valid(df.where("seq = 3"), "trades").collect()


def test_schema_drift(spark):
    df = trades(spark, {"seq": 1})
    assert V.schema_drift(df.schema, "trades") == []
    assert V.schema_drift(df.drop("side").schema, "trades") == ["missing side string"]
    assert V.schema_drift(df.select(*reversed(df.columns)).schema, "trades") == ["column order"]


def test_isin_checksum(spark):
    df = spark.createDataFrame([("DE0007164600",), ("DE0007164601",), ("US0378331005",),
                                ("XX",), ("us0378331005",)], "isin string")
    assert [r[0] for r in df.select(V.isin_checksum_ok(F.col("isin"))).collect()] == [
        True, False, True, False, False]


def test_sequence_checks(spark):
    rows = [("a", 1), ("a", 2), ("b", 1), ("b", 1), ("c", 1), ("c", 3), ("d", 0)]
    df = spark.createDataFrame(rows, "source_file string, seq long")
    assert {r.source_file: r.ok for r in V.sequence_checks(df).collect()} == {
        "a": True, "b": False, "c": False, "d": False}


def test_union_view(spark):
    df = trades(spark, {"seq": 1})
    quotes = typed_select(df, "quotes", {c: F.col(c) for c in ("event_ts", "exchange")})
    view = V.all_events({"trades": df, "quotes": quotes})
    assert len(view.columns) == 20 and view.count() == 2


# --- manifest -------------------------------------------------------------------

def bronze(spark, *rows):
    fields = "sha256 exchange label source_uri bytes_size scraped_at status".split()
    return spark.createDataFrame(
        [(s, e, lab, f"/in/{lab}", 1, float(at), st) for s, e, lab, at, st in rows],
        ", ".join(f"{f} {'long' if f == 'bytes_size' else 'double' if f == 'scraped_at' else 'string'}"
                  for f in fields))


def test_lifecycle_in_tables(spark, tmp_path):
    store = M.ManifestTables(spark, str(tmp_path))
    assert store.bronze().count() == 0 and store.silver().count() == 0
    store.land(bronze(spark, ("s1", "bme", "a", 1, "downloaded"), ("s2", "bme", "b", 2, "downloaded")))
    # A re-release under a new label adds nothing.
    store.land(bronze(spark, ("s1", "bme", "other", 3, "downloaded")))
    assert [r.label for r in M.pending(store.bronze()).collect()] == ["a", "b"]
    events = spark.createDataFrame([("s1", "failed", "x" * 2000), ("nobody", "failed", "e")],
                                   "sha256 string, status string, error string")
    store.mark(events, F.lit(5.0))
    state = {r.sha256: r for r in store.bronze().collect()}
    assert set(state) == {"s1", "s2"} and state["s1"].status == "failed"
    assert len(state["s1"].error) == 1024 and state["s1"].label == "a"
    store.mark(events.where("sha256 = 's1'").withColumn("status", F.lit("ingested")), F.lit(6.0))
    done = store.bronze().where("sha256 = 's1'").first()
    assert (done.status, done.ingested_at, done.error) == ("ingested", 6.0, None)
    store.mark(events.where("sha256 = 's1'"), F.lit(7.0))
    again = store.bronze().where("sha256 = 's1'").first()
    assert (again.status, again.ingested_at) == ("failed", 6.0)
    counts = {(r.layer, r.status): r.files for r in M.stats(store.bronze(), store.silver()).collect()}
    assert counts == {("bronze", "failed"): 1, ("bronze", "downloaded"): 1}


def test_a_base_stands_for_all_events(spark, tmp_path):
    store = M.ManifestTables(spark, str(tmp_path))
    silver = "target_uri string, table string, written_at double, status string, rows long"

    def state():
        return (sorted(map(tuple, store.bronze().collect())), sorted(map(tuple, store.silver().collect())))

    store.rebase()  # nothing yet
    for step in range(4):
        store.land(bronze(spark, ("s", "x", f"l{step}", 10 - step, "downloaded"), (f"t{step}", "x", f"m{step}", 5, "downloaded")))
        store.mark(spark.createDataFrame([("s", "ingested" if step % 2 else "failed", "e"), ("u", "failed", None)],
                                         "sha256 string, status string, error string"), F.lit(20.0 - step))
        store.record_silver(spark.createDataFrame([("f", "trades", float(step), f"s{step}", step)], silver))
        before = state()
        if step < 3:
            store.rebase()
        assert state() == before
    # A rebase that died before its last line leaves the state as it is.
    M.bronze_base(spark.createDataFrame([], M.BRONZE_EVENT_SCHEMA)).write.parquet(f"{tmp_path}/bronze_events_base/epoch=5")
    assert state() == before and state()[0][0][0] == "s"
    assert store.silver(as_of=1.0).first().status == "s1"
    # Four rebases in: only the last epoch and its base are opened.
    opened = {f.split("/bronze_")[1] for f in store._events("bronze_events", M.BRONZE_EVENT_SCHEMA).inputFiles()}
    assert {f.rsplit("/", 1)[0] for f in opened if "epoch=4" in f} == {"events/epoch=4", "events_base/epoch=4"}
    plan = store.bronze()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(epoch") == 2


def test_status_before_landing_is_void(spark):
    landed = M.landing_events(bronze(spark, ("s", "x", "l", 10, "downloaded")))
    early = M.status_events(spark.createDataFrame([("s", "ingested", None)],
                            "sha256 string, status string, error string"), F.lit(9.0))
    row = M.fold_bronze(landed.unionByName(early)).first()
    assert (row.status, row.ingested_at) == ("downloaded", None)


def test_pending_is_equality_on_the_feed(spark):
    df = bronze(spark, ("1", "bme", "a", 3, "downloaded"), ("2", "bme/x", "b", 1, "downloaded"),
                ("3", "bme", "c", 2, "failed"), ("4", "bme", "d", 1, "downloaded"))
    assert [r.label for r in M.pending(df, "bme", 5).collect()] == ["d", "a"]
    assert [r.label for r in M.pending(df, None, 2).collect()] == ["b", "d"]


# --- gates and metrics --------------------------------------------------------------

def files(spark, n, failed=0, exchange="Berlin/x", at=100.0):
    return bronze(spark, *[(f"{exchange}{i}", exchange, str(i), at,
                            "failed" if i < failed else "ingested") for i in range(n)])


def messages(spark, df, *rules, now=100.0):
    return [r.message for r in dq.check(spark, df, rules, now=now).orderBy("rule_no").collect()]


def test_gates(spark):
    rule = dq.Rule("berlin", 5, 0.10)
    assert messages(spark, files(spark, 6), rule) == []
    assert messages(spark, files(spark, 6).limit(0), rule) == [
        "DQ: exchange=berlin got 0 files in last 24h (expected >= 5)"]
    assert messages(spark, files(spark, 10, 4), rule) == [
        "DQ: exchange=berlin failure rate 4/10=40% exceeds max=10%"]
    # Few files hide the failure rate; the window's start counts, one second before does not.
    assert "got 4" in messages(spark, files(spark, 4, 4), rule)[0]
    assert messages(spark, files(spark, 6), rule, now=100.0 + 86400) == []
    assert len(messages(spark, files(spark, 6), rule, now=101.0 + 86400)) == 1
    # Wildcards work, a backslash is itself, 12.5 % rounds to even.
    assert messages(spark, files(spark, 8, 1), dq.Rule("b_r%n", 1, 0.1)) == [
        "DQ: exchange=b_r%n failure rate 1/8=12% exceeds max=10%"]
    assert len(messages(spark, files(spark, 8), dq.Rule("ber\\", 1, 0.1))) == 1


def test_metrics_text(spark, tmp_path):
    rows = [("b_total", "", {}, 1.0, 1), ("foo_total", "Foo.", {"x": "1"}, 1.0, 2),
            ("foo_total", "other", {"x": "1"}, 1.0, 3), ("foo_total", "", {"b": "2", "a": "1"}, 0.5, 4)]
    df = spark.createDataFrame(rows, "name string, description string, labels map<string,string>, "
                               "value double, at long")
    series = MT.counters(df)
    lines = MT.exposition(series)
    MT.write_exposition(lines, str(tmp_path / "m"))
    text = [r.value for r in spark.read.text(str(tmp_path / "m")).collect()]
    want = ["# TYPE b_total counter", "b_total 1.0", "# HELP foo_total Foo.",
            "# TYPE foo_total counter", 'foo_total{a="1",b="2"} 0.5', 'foo_total{x="1"} 2.0']
    assert sorted(text) == sorted(want)
    assert [r.line for r in lines.orderBy("name_at", "name", "part", "labels").collect()] == want
    assert {r.name: (r.total, r.series) for r in MT.summary(series).collect()} == {
        "b_total": (1.0, 1), "foo_total": (2.5, 2)}
    assert [r.value for r in MT.gauges(df.where("labels['x'] = '1'")).collect()] == [1.0]


# --- discovery and messages -----------------------------------------------------------

def test_last_link_first_place(spark):
    df = spark.createDataFrame([("s", 1, "/a/f.csv"), ("s", 2, "/a/g.csv"), ("s", 3, "/b/f.csv")],
                               "section string, pos int, link string")
    got = D.last_link_per_file(df, ["section"], ["pos"]).orderBy("pos").collect()
    assert [(r.file, r.link, r.pos) for r in got] == [("f.csv", "/b/f.csv", 1),
                                                      ("g.csv", "/a/g.csv", 2)]


def links(spark, *rows):
    return spark.createDataFrame(rows, "text string, link string, href string, type_attr string")


def test_one_link_can_serve_several_feeds(spark):
    df = links(spark, ("2025_BMEA_posttrade.json", "http://x/a.csv", "a.csv", ""),
               ("Pretrade.x", "u", "u", ""), ("post", "u", "u", "text/comma-separated-values"),
               ("z", "h/d.json.gz?", "d.json.gz?", ""), ("z", "h/d.json.gz", "d.json.gz", ""),
               ("n", "h/rts13_public_trade_data_CXE_2025-08-01_08.csv", "x", ""),
               ("", "u", "u", "text/comma-separated-values"))
    got = sorted((r.feed, r.label) for r in D.match_rules(df).collect())
    name = "rts13_public_trade_data_CXE_2025-08-01_08.csv"
    assert got == [("athex", "a.csv"), ("athex", name), ("berlin/posttrade", "post"),
                   ("bme", "2025_BMEA_posttrade.json"), ("cboe/cxe/hourly", name),
                   ("deutsche-boerse", "d.json.gz"), ("munich/pretrade", "Pretrade.x")]


def test_a_label_seen_anywhere_is_seen(spark):
    page = "".join(f'<a href="/dl?x={i}">{i}_BMEA_posttrade.json</a>' for i in range(3))
    pages = spark.createDataFrame([(1, "http://h/p", page)], "page_id long, url string, html string")
    seen = spark.createDataFrame([("lsx", "1_BMEA_posttrade.json")], "exchange string, label string")
    assert sorted(r.label[0] for r in discover(pages, seen).collect()) == ["0", "2"]


def _capped_runs(spark, rules, n_runs, fails=()):
    """Runs over one page of 150 files; what is fetched is seen by the next run."""
    page = "".join(f'<a href="/f{i}.json.gz">x</a>' for i in range(150))
    pages = spark.createDataFrame([(1, "http://h/p", page)], "page_id long, url string, html string")
    known, tried, runs = [], [], []
    for _ in range(n_runs):
        bronze = spark.createDataFrame([("x", k) for k in known], "exchange string, label string")
        failed = spark.createDataFrame([(t,) for t in tried], "label string")
        new = [r.label for r in discover(pages, bronze, rules=rules, tried=failed).collect()]
        known += [n for n in new if n not in fails]
        tried += [n for n in new if n in fails]
        runs.append(len(new))
    return runs, known


def test_rules_have_no_cap_unless_asked(spark):
    assert _capped_runs(spark, D.LINK_RULES, 2)[0] == [150, 0]
    assert _capped_runs(spark, D.with_caps(D.LINK_RULES), 3)[0] == [100, 50, 0]
    first = D.with_caps(D.LINK_RULES, cap_first=("deutsche-boerse",))
    assert _capped_runs(spark, first, 2)[0] == [100, 0]
    assert {r.feed: r.cap for r in first if r.cap} == D.RUN_CAPS


def test_failures_do_not_use_up_a_cap(spark):
    fails = [f"/f{i}.json.gz" for i in range(100)]
    runs, known = _capped_runs(spark, D.with_caps(D.LINK_RULES), 2, fails)
    # The files behind the failing ones come first in the second run.
    assert runs == [100, 100] and sorted(known) == sorted(f"/f{i}.json.gz" for i in range(100, 150))


def test_marks(spark):
    df = spark.createDataFrame([("x", "a-2025-04-16T14_21.json.gz"), ("x", "a-2025-04-16T14_20.json.gz"),
                                ("x", "a.json.gz"), ("new", "b-2020-01-01T00_00.json.gz")],
                               "feed string, link string")
    marks = spark.createDataFrame([("x", dt.datetime(2025, 4, 16, 14, 20)), ("y", NOW)],
                                  "feed string, mark timestamp")
    found = discover_after_mark(df, marks)
    assert {r.link for r in found.fresh.collect()} == {
        "a-2025-04-16T14_21.json.gz", "b-2020-01-01T00_00.json.gz"}
    assert {r.feed: r.mark for r in found.marks.collect()} == {
        "x": dt.datetime(2025, 4, 16, 14, 21), "y": NOW, "new": dt.datetime(2020, 1, 1)}
    assert [r.link for r in found.rejects.collect()] == ["a.json.gz"]


def test_a_cap_loses_no_link(spark):
    stamps = ["2025-04-16T14_20", "2025-04-16T14_21", "2025-04-16T14_21", "2025-04-16T14_22"]
    df = spark.createDataFrame([("x", f"{9 - i}-{s}.json.gz") for i, s in enumerate(stamps)],
                               "feed string, link string")
    marks, runs = spark.createDataFrame([], "feed string, mark timestamp"), []
    while len(runs) < 9:
        found = discover_after_mark(df, marks, cap=1)
        runs.append(sorted(r.link for r in found.fresh.collect()))
        if not runs[-1]:
            break
        marks = spark.createDataFrame(found.marks.collect(), marks.schema)
    assert [len(r) for r in runs] == [1, 2, 1, 0]


def test_rows_without_a_key_are_nobodys_copies(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 3), (None, 4)],
                               "trade_id string, n int")
    kept = M.first_per_key(df, ["trade_id"], ["n"])
    assert sorted((r.trade_id or "", r.n) for r in kept.collect()) == [
        ("", 3), ("", 3), ("", 4), ("a", 1)]


def test_a_payload_delivered_twice_is_one(spark):
    files = spark.createDataFrame([("s1", "/in/a"), ("s2", "label-only://b"), ("s3", "/in/c")],
                                  "sha256 string, source_uri string")
    payloads = spark.createDataFrame([("file:///in/a", b"x"), ("/in/a", b"x")],
                                     "source_uri string, content binary")
    got = {r.sha256: r.content for r in attach_content(files, payloads).collect()}
    assert got == {"s1": b"x", "s2": b"", "s3": None}


def test_download_counters(spark):
    landed = spark.createDataFrame([("cboe/bxe", 5), ("cboe", 7)], "exchange string, bytes_size long")
    failed = spark.createDataFrame([("lsx",)], "exchange string")
    rows = MT.landing_increments(landed, failed, "http", F.lit(1.0)).collect()
    assert {(r.name, r.labels["exchange"], r.labels["method"], r.value) for r in rows} == {
        ("scraper_files_total", "cboe", "http", 2.0), ("scraper_bytes_total", "cboe", "http", 12.0),
        ("scraper_download_failures_total", "lsx", "http", 1.0)}


def test_newest_message_that_matches(spark):
    df = spark.createDataFrame(
        [("r", 1, "https://dl.luxse.com/dl?v=1"), ("r", 2, "https://dl.luxse.com/dl?v=2 x"),
         ("r", 3, "nothing"), ("q", 9, "none")], "recipient string, n int, text string")
    assert [tuple(r) for r in MS.latest_link(df, order=["n"]).collect()] == [
        ("r", "https://dl.luxse.com/dl?v=2", 2)]
