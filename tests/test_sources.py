import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tapeworks.schema import SCHEMAS
from tapeworks.operators.validate import schema_drift
from tapeworks.sources import csv_blocks, json_documents as jd, rts13
from tapeworks.sources.reference_data import read_label_list, read_master_csv
from tapeworks.sources.payloads import attach_content, scan_payload_files

NOW = dt.datetime(2025, 8, 2)


def payloads(spark, *contents):
    rows = [(i, c if isinstance(c, bytearray) else bytearray(c.encode()))
            for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "id int, content binary")


def csv_trades(spark, *contents):
    parsed = rts13.parse_rts13(payloads(spark, *contents))
    return rts13.rts13_trades(parsed, exchange=F.lit("BERA"), mic=F.lit("BERA"),
                              data_type=F.lit("post_trade"), source_file=F.col("id").cast("string"),
                              ingest_ts=F.lit(NOW).cast("timestamp")).orderBy("source_file", "seq")


def test_rts13_golden(spark):
    df = csv_trades(spark, (
        "TradingDateTime,ISIN,Price,Quantity,Currency,TradeID,Flags\n"
        "2025-08-01T09:00:00Z,DE0007164600,42.78,125,EUR,T1,LRGS\n"
        "2025-08-01T09:00:01Z,DE0007164600,42.80,10,EUR,T2,\n"
        "NOT_A_TIMESTAMP,DE0007164600,1,1,EUR,T3,\n"))
    assert schema_drift(df.schema, "trades") == []
    rows = df.collect()
    assert [r.seq for r in rows] == [1, 2]
    assert [r.trade_flag_canonical for r in rows] == ["large_in_scale", "normal"]
    first = rows[0]
    assert (first.trade_price, first.trade_size, first.notional) == (42.78, 125.0, 42.78 * 125.0)
    assert first.trade_id == "T1" and first.instrument_type == "equity"
    assert rows[1].trade_flags_raw is None and len(first.source_msg_hash) == 64


def test_rts13_headers_quotes_and_odd_rows(spark):
    df = csv_trades(
        spark,
        # alternatives, case, repeated column (the last counts), quoted line break
        'isin,NOTE,tradetime,price,quantity,transactionid,ISIN\r\n'
        'A,"x, ""y""\r\nz",2025-08-01 09:00:00,1.5,0,Q1,B\r\n'
        '\r\n'
        'C,,2025-08-01,abc,7\r\n'
        'D,pl"ain,2025-08-03T01:00:00+01:00,2,3,Q"4,E',
        "TradingDateTime,Price\n", "", "no header that fits\n1\n2\n",
        bytearray(b"TradingDateTime,ISIN,Price\n2025-08-01,DE\xff1,\xfe2\n"))
    rows = df.collect()
    got = [(r.source_file, r.seq, r.isin, r.trade_price, r.trade_size, r.trade_id) for r in rows]
    assert got == [("0", 1, "B", 1.5, 0.0, "Q1"), ("0", 2, None, None, 7.0, None),
                   ("0", 3, "E", 2.0, 3.0, 'Q"4'), ("4", 1, "DE1", 2.0, None, None)]
    assert rows[0].notional is None
    assert rows[2].event_ts == dt.datetime(2025, 8, 3)


def test_first_alternative_with_a_value_wins(spark):
    df = csv_trades(spark, "Timestamp,TradingDateTime,TradeID,TransactionID\n"
                           "2025-08-01,,,X\n2025-08-01,2025-08-09,Y,Z\n")
    assert [(r.event_ts.day, r.trade_id) for r in df.collect()] == [(1, "X"), (9, "Y")]


def test_large_files_are_numbered_across_blocks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for name, n in (("a", 900), ("b", 3)):
            lines = ["Price,TradingDateTime"]
            for i in range(n):
                stamp = "bad" if i % 7 == 3 else f"2025-08-01T00:00:00.{i:06d}Z"
                lines.append(f"{i + 1},{stamp}")
            (tmp_path / f"{name}.csv").write_text("\r\n".join(lines) + "\r\n")
        for header in (None, ["Price", "TradingDateTime"]):
            df = rts13.read_rts13_files(spark, str(tmp_path), exchange="X", header=header)
            got = df.select("source_file", "seq", "trade_price").collect()
            for name, n in (("a", 900), ("b", 3)):
                mine = sorted((r.seq, r.trade_price) for r in got
                              if r.source_file.endswith(f"{name}.csv"))
                kept = [float(i + 1) for i in range(n) if i % 7 != 3]
                assert mine == [(k + 1, v) for k, v in enumerate(kept)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")


FILES = {
    "bad-bytes": b"TradingDateTime,ISIN,Price\n2025-08-01,A\xffB,1\n",
    "quotes": b'TradingDateTime,ISIN,Price,Note\n2025-08-01,"A,""x""",2,5" pipe\n2025-08-01,B,3,"x"y\n',
    "blank-first": b"\nTradingDateTime,ISIN,Price\n2025-08-01,A,1\n",
    "no-time": b"When,ISIN,Price\n2025-08-01,A,1\n",
}


def as_payloads(spark, folder):
    parsed = rts13.parse_rts13(scan_payload_files(spark, str(folder)))
    return rts13.rts13_trades(parsed, exchange=F.lit("X"), mic=F.lit(None), data_type=F.lit("post_trade"),
                              source_file=F.col("source_uri"), ingest_ts=F.lit(NOW).cast("timestamp"))


def plain(df):
    name = F.regexp_extract("source_file", "[^/]+$", 0)
    return sorted(map(tuple, df.select(name, "seq", "isin", "trade_price", "trade_flags_raw", "trade_id",
                                       "event_ts").collect()), key=str)


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few lines."""
    sizes = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    yield
    for key in sizes:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", list(FILES))
def test_large_files_and_payloads_agree(spark, tmp_path, name):
    (tmp_path / "f.csv").write_bytes(FILES[name])
    got = plain(rts13.read_rts13_files(spark, str(tmp_path), exchange="X"))
    assert got == plain(as_payloads(spark, tmp_path))
    assert len(got) == {"bad-bytes": 1, "quotes": 2}.get(name, 0)
    parsed = rts13.parse_rts13(spark.createDataFrame([(bytearray(FILES[name]),)], "content binary"))
    assert parsed.first().malformed == (name in ("blank-first", "no-time"))


def test_quoted_line_breaks_across_blocks(spark, tmp_path, small_blocks):
    """Random fields, open quotes, a record over many blocks, several line ends."""
    pick = random.Random(3)

    def field():
        if pick.random() < .3:
            inner = (pick.choice(["a", '""', ",", "\n", "\r\n", "\r", "b c", "é"]) for _ in range(pick.randint(0, 9)))
            return '"' + "".join(inner) + '"' + pick.choice(["", "", 'z"q'])
        return pick.choice(["", "abc", 'pl"ain', "12.5"])

    for f in range(5):
        lines = ["TradingDateTime,Note,ISIN,Price,Flags,TradeID"]
        for i in range((0, 2, 40, 90, 60)[f]):
            time = "bad" if i % 6 == 4 else f"2025-08-01T00:00:{i % 60:02d}Z"
            lines += [""] * (i % 17 == 3) + [",".join([time, field(), field(), str(i), field(), f"T{i}"])]
        if f == 3:
            lines[30:30] = ['2025-08-02,"' + "long, \n" * 300 + '",X,7,,L', '2025-08-02,"x""\n",Y,8,,M']
        if f == 4:
            lines.append('2025-08-01,"never closed,\n\nX')
        text = ("\n", "\r\n")[f % 2].join(lines) + "\n" * (f % 3)
        (tmp_path / f"{f}.csv").write_bytes(text.encode())
    got = plain(rts13.read_rts13_files(spark, str(tmp_path), exchange="X"))
    assert got == plain(as_payloads(spark, tmp_path))
    assert max(r[1] for r in got) > 70 and any("\r\n" in (r[4] or "") for r in got)


def test_lines_without_quotes_tell_nothing_of_block_ends(spark, tmp_path, small_blocks):
    header = ["TradingDateTime", "ISIN", "Price"]
    lines = [",".join(header), '2025-08-01T00:00:00Z,"' + "long\n" * 600 + '",1',
             *[f"2025-08-01T00:00:{i % 60:02d}Z,I{i},{i}" for i in range(80)]]
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    got = plain(rts13.read_rts13_files(spark, str(tmp_path), exchange="X", header=header))
    assert got == plain(as_payloads(spark, tmp_path)) and len(got) == 81
    text = csv_blocks.text_lines(spark, str(tmp_path), "\n")
    ends = csv_blocks.block_ends(text, b"\n", 1 << 20)
    plan = ends._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" in plan or "contains(" in plan.lower()
    assert csv_blocks.told_lines(text, False).count() == 2
    # Blocks without a quote have their line, and end as they begin.
    told = {r.block: (r.from_out, r.from_in) for r in ends.collect()}
    assert len(told) == text.select("block").distinct().count()
    assert sum(t == (False, True) for t in told.values()) == len(told) - 2


def test_a_record_must_fit_its_bound(spark, tmp_path, small_blocks):
    (tmp_path / "f.csv").write_text('TradingDateTime,ISIN\n2025-08-01,"' + "open\n" * 400)
    with pytest.raises(Exception, match="has more than 1000 bytes"):
        rts13.read_rts13_files(spark, str(tmp_path), exchange="X", max_record_bytes=1000).collect()


def test_numbering_moves_no_rows(spark, tmp_path, small_blocks):
    lines = [f'2025-08-01T00:00:00Z,"{i}\n",A' for i in range(200)]
    (tmp_path / "f.csv").write_text("\n".join(["TradingDateTime,TradeID,ISIN", *lines]))
    df = rts13.read_rts13_files(spark, str(tmp_path), exchange="X")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan
    assert not any(word in plan for word in ("Exchange hashpartitioning", "Exchange rangepartitioning",
                                             "Window", "SortMergeJoin"))
    # Once for rows in one block, once for the few over several.
    assert plan.count("csv-rows") == 1 and plan.count("csv-joined") == 1
    assert sorted((r.seq, r.trade_id) for r in df.collect()) == [(i + 1, f"{i}\n") for i in range(200)]


def test_a_known_header_may_be_there_or_not(spark, tmp_path):
    (tmp_path / "a.csv").write_text("TradingDateTime,ISIN\n2025-08-01,A\n")
    (tmp_path / "b.csv").write_text("2025-08-02,B\n2025-08-03,C\n")
    df = rts13.read_rts13_files(spark, str(tmp_path), exchange="X", header=["TradingDateTime", "ISIN"])
    assert [r[1:3] for r in plain(df)] == [(1, "A"), (1, "B"), (2, "C")]


def test_lines_that_end_in_carriage_returns(spark, tmp_path, small_blocks):
    text = "TradingDateTime,ISIN,Note\r" + "".join(f'2025-08-01,I{i},"a\rb"\r' for i in range(60))
    (tmp_path / "f.csv").write_text(text)
    got = plain(rts13.read_rts13_files(spark, str(tmp_path), exchange="X", separator="\r"))
    assert got == plain(as_payloads(spark, tmp_path)) and len(got) == 60


def bme(spark, *contents):
    parsed = jd.parse_bme(payloads(spark, *contents))
    return parsed, jd.bme_trades(parsed, source_file=F.col("id").cast("string"),
                                 ingest_ts=F.lit(NOW).cast("timestamp")).orderBy("source_file", "seq")


def test_bme_golden(spark):
    _, df = bme(spark, json.dumps([
        {"trading_datetime": "2025-08-01T09:00:00Z", "isin": "ES0", "price": "11.23",
         "volume": "500", "currency": "EUR", "flags": "BENC"},
        {"trading_datetime": "2025-08-01T09:00:01Z", "isin": "ES0", "price": "11.23",
         "volume": "500", "currency": "EUR"}]))
    assert schema_drift(df.schema, "trades") == []
    rows = df.collect()
    assert [r.trade_flag_canonical for r in rows] == ["benchmark", "normal"]
    assert rows[0].notional == 11.23 * 500 and rows[0].mic == "BMEX" and rows[0].seq == 1


def test_json_roots(spark):
    row = '{"timestamp":"2025-08-01","price":1}'
    cases = [
        (f"[{row}]", 1, False, False), (f'{{"trades":[{row},{row}]}}', 2, False, False),
        (f'{{"trades":[],"data":[{row}]}}', 1, False, False),
        (f'{{"trades":null}}', 0, False, False), ("{}", 0, False, False), ("[]", 0, False, False),
        ("{not json", 0, True, False), ("  ", 0, True, False), (f"[{row}] x", 0, True, False),
        (f"[{row}]}} x", 0, True, False), ("5", 0, False, True), ('"a"', 0, False, True),
        ("null", 0, False, True), ("true", 0, False, True), ("[1]", 0, False, True),
        (f"[{row},null]", 0, False, True), ('{"trades":"abc"}', 0, False, True),
        ('{"trades":{"a":1}}', 0, False, True), ('{"data":7}', 0, False, True),
        ('{"trades":0,"data":0}', 0, False, False), (f"[{row},{row[:-1]},\"x\":NaN}}]", 2, False, False),
        ('[{"timestamp":"2025-08-01","timestamp":"2025-08-02"}]', 1, False, False),
    ]
    parsed, _ = bme(spark, *[c[0] for c in cases])
    got = [(r["n"], r["malformed"], r["e"]) for r in parsed.orderBy("id").select(
        F.size("rows").alias("n"), "malformed", F.col("error").isNotNull().alias("e")).collect()]
    for case, g in zip(cases, got):
        assert g == case[1:], case[0]


def test_values_that_do_not_count_fall_through(spark):
    _, df = bme(spark, json.dumps([
        {"timestamp": "2025-08-01", "price": 0, "Price": 5, "volume": "", "quantity": 2},
        {"timestamp": "2025-08-01", "price": "0", "Price": 5, "isin": None, "ISIN": "X"},
        {"trading_datetime": "", "tradingDateTime": "2025-08-01", "price": 0, "flags": False,
         "Flags": "CANC"},
        {"trading_datetime": 20250803, "price": True, "volume": 1e3}]))
    rows = df.collect()
    assert [r.trade_price for r in rows] == [5.0, 0.0, None, 1.0]
    assert [r.trade_size for r in rows] == [2.0, None, None, 1000.0]
    assert [r.notional for r in rows] == [10.0, None, None, 1000.0]
    assert rows[1].isin == "X" and rows[2].trade_flag_canonical == "cancellation"
    assert rows[3].event_ts == dt.datetime(2025, 8, 3)


def test_hdat(spark):
    bar = {"date": "2025-08-01", "isin": "GR0114030555", "open": 99.85, "high": 100.05,
           "low": 99.80, "close": 99.95, "volume": 2500000, "vwap": 99.94, "trades": 37}
    docs = [json.dumps([bar]), json.dumps({"data": [dict(bar, trades="12"), dict(bar, trades=0),
                                                   dict(bar, trades=3.9)]}),
            json.dumps([bar, dict(bar, trades="1.5")]),
            json.dumps([dict(bar, date="bad", trades="1.5")])]
    parsed = jd.parse_hdat(payloads(spark, *docs))
    errors = [r.error for r in parsed.orderBy("id").collect()]
    assert [e is None for e in errors] == [True, True, False, True]
    df = jd.hdat_bars(parsed, data_type=F.lit("post_trade"), source_file=F.col("id").cast("string"),
                      ingest_ts=F.lit(NOW).cast("timestamp"))
    assert schema_drift(df.schema, "bars") == []
    rows = df.orderBy("source_file", F.col("trades_count").desc()).collect()
    assert [r.trades_count for r in rows] == [37, 12, 3, None]
    first = rows[0]
    assert (first.open, first.high, first.low, first.close) == (99.85, 100.05, 99.8, 99.95)
    assert (first.volume, first.vwap, first.exchange, first.mic) == (
        2500000.0, 99.94, "BOG-HDAT", "HDAT")
    assert first.seq is None and first.bar_interval == "1d" and first.currency == "EUR"


def test_printed_json_values(spark):
    tokens = ["99.95", "100", "1.50", "100.0", "1e3", "1E-7", '"x"', "true", "null",
              "12345678901234567890"]
    df = payloads(spark, *[f'{{"c":{t}}}' for t in tokens])
    value = F.parse_json(F.col("content").cast("string"))
    got = [r[0] for r in df.orderBy("id").select(jd.json_printed(
        jd.json_text(value, "c"), jd.json_kind(value, "c"))).collect()]
    assert got == ["99.95", "100", "1.5", "100.0", "1000.0", "1e-07", "x", "True", None,
                   "12345678901234567890"]


def test_master_and_label_files(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('ticker,isin,currency,other\n SAP , DE1 ,EUR,x\n,, ,\n"A,B",DE2,"",y\n')
    rows = read_master_csv(spark, str(path)).orderBy("row_no").collect()
    assert [(r.isin, r.ticker, r.currency, r.figi) for r in rows] == [
        ("DE1", "SAP", "EUR", None), (None, None, None, None), ("DE2", "A,B", None, None)]
    assert read_master_csv(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "l.json").write_text('["a.csv",\n "b.csv"]')
    assert [r.label for r in read_label_list(spark, str(tmp_path / "l.json")).collect()] == [
        "a.csv", "b.csv"]
    assert read_label_list(spark, str(tmp_path / "none.json")).count() == 0


def test_payloads_by_uri(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b"abc")
    files = spark.createDataFrame(
        [(1, str(tmp_path / "x.csv")), (2, f"file://{tmp_path}/x.csv"), (3, "label-only://a/b"),
         (4, "legacy://c"), (5, "/missing")], "n int, source_uri string")
    got = attach_content(files, scan_payload_files(spark, str(tmp_path))).orderBy("n").collect()
    assert [None if r.content is None else bytes(r.content) for r in got] == [
        b"abc", b"abc", b"", b"", None]


def test_required_columns_are_pinned():
    assert [len(SCHEMAS[t].fields) for t in ("trades", "quotes", "bars")] == [26, 25, 27]


def test_drift_files_code_single_bytes(spark):
    """Digests are most of a row: under snappy they kept their hexadecimal size."""
    from pathlib import Path

    from tapeworks.catalog import QUERIES
    QUERIES["q_schema_drift"](spark, "/root/testdata/sf0.001")
    base = Path(spark.conf.get("spark.checkpoint.dir")) / "tapeworks"
    files = [p.name for p in base.glob("drift-*/*.parquet")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)
