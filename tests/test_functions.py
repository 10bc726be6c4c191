import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tapeworks.functions import flags, hashing, layout, links, parsing

UTC = dt.timezone.utc


def evaluate(spark, build, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").repartition(2)
    out = df.select("i", build(F.col("v")).alias("o")).collect()
    return [r["o"] for r in sorted(out, key=lambda r: r["i"])]


def test_flags(spark):
    cases = {
        "LRGS": "large_in_scale", "LIS": "large_in_scale", "BENC": "benchmark",
        "NPFT": "negotiated", "CANC": "cancellation", "BENC,LRGS": "large_in_scale",
        "LRGS;BENC": "large_in_scale", None: "normal", "": "normal", "  ": "normal",
        ";, ;": "normal", "ZZZZ": "unknown", " npft ; DLAY": "negotiated",
        "ZZZZ,AMND": "amendment", "SI": "systematic_internaliser", "SIX": "unknown",
        "LRGS BENC": "unknown", ",DARK,": "dark", "MOFF": "agency_cross", "NOFF": "offbook",
        "DLAY": "late_publication", "DARK;SDIV": "dark",
    }
    assert evaluate(spark, flags.canonical_trade_flag, list(cases)) == list(cases.values())


def test_doubles(spark):
    cases = {"42.78": 42.78, " 7 ": 7.0, "": None, None: None, "abc": None, "12d": None,
             "1_000": 1000.0, "1__0": None, "-.5": -0.5, "1e3": 1000.0, "5.": 5.0,
             "inf": float("inf"), "-Infinity": float("-inf"), "0x10": None, "1 2": None}
    assert evaluate(spark, parsing.parse_double, list(cases)) == list(cases.values())
    assert str(evaluate(spark, parsing.parse_double, ["-NaN"])[0]) == "nan"


def test_integers(spark):
    cases = {"37": 37, " -4 ": -4, "1_0": 10, "37.5": None, "x": None,
             "99999999999999999999": None}
    assert evaluate(spark, parsing.parse_integer, list(cases)) == list(cases.values())


TIMES = [
    "2025-08-01T09:00:00Z", "2025-08-01 09:00:00", "2025-08-01", "2025-08-01T09:00:00.123456Z",
    "2025-08-01T09:00:00+02:00", "2025-08-01T09:00:00-0330", "2025-08-01T09:00+02",
    "2025-08-01T09", "2025-08-01T09Z", "20250801T090000", "20250801", "2025-08-01T09:00:00,5",
    "2025-08-01x09:00", "2025-08-01T0900", "2025-08-01T09:00:00.1234567Z", "2025-02-30",
    "NOT_A_TIMESTAMP", "", "2025", "09:00:00", " 2025-08-01", "2025-08-01T25:00:00",
    "2025-8-1", "2025-08-01T09:00:00ZZ", "2025-08-01T09:00:60", "0000-01-01", "2025-0801",
]


def expected_time(raw):
    try:
        ts = dt.datetime.fromisoformat(raw.replace("Z", "+00:00"))
    except ValueError:
        return None
    return ts.astimezone(UTC) if ts.tzinfo else ts.replace(tzinfo=UTC)


def test_times_against_the_standard_library(spark):
    micros = evaluate(spark, lambda c: F.unix_micros(parsing.parse_event_ts(c)), TIMES)
    epoch = dt.datetime(1970, 1, 1, tzinfo=UTC)
    want = [None if t is None else (t - epoch) // dt.timedelta(microseconds=1)
            for t in map(expected_time, TIMES)]
    assert dict(zip(TIMES, micros)) == dict(zip(TIMES, want))


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = evaluate(spark, lambda c: F.unix_micros(parsing.parse_event_ts(c)),
                       ["2025-08-01", "2025-08-01T00:00:00", "20250801"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1754006400000000] * 3


def test_bytes_that_are_no_utf8_are_dropped(spark):
    got = evaluate(spark, parsing.decode_utf8,
                   [b"ab\xffc", "grün".encode(), b"", b"\xe2\x82x"], "binary")
    assert got == ["abc", "grün", "", "x"]


def test_double_text_is_the_shortest_round_trip(spark):
    values = [0.0, -0.0, 1.0, 42.78, 100.0, 1e7, 12345678.9, 0.001, 0.0001, 0.00012345, 1e-5,
              1.5e-7, 1e15, 9999999999999998.0, 1e16, 1.5e20, -3.5e-9, 1 / 3, 2 / 3 * 1e9,
              float("inf"), float("-inf"), float("nan"), 1e100]
    assert evaluate(spark, parsing.double_text, values, "double") == [repr(v) for v in values]


def test_hash_matches_its_recipe(spark):
    when = dt.datetime(2025, 8, 1, 9, tzinfo=UTC)
    row = spark.createDataFrame([("BERA", None, when, 42.78, 12345678.9, "LRGS")],
                                "e string, i string, t timestamp, p double, s double, f string")
    got = row.select(hashing.trade_hash(*[F.col(c) for c in "eitpsf"])).first()[0]
    text = f"BERA||{when}|42.78|12345678.9|LRGS"
    assert got == hashlib.sha256(text.encode()).hexdigest()


def test_layout(spark):
    assert evaluate(spark, layout.partition_value, [None, "", "a/b c=d\\e", "bond"]) == [
        "unknown", "unknown", "a_b_c_d_e", "bond"]
    row = spark.createDataFrame([("CBOE BXE", dt.datetime(2025, 8, 1), None)],
                                "e string, t timestamp, k string")
    got = row.select(layout.partition_dir("trades", F.col("e"), F.col("t"), F.col("k"))).first()[0]
    assert got == "trades/exchange=CBOE_BXE/year=2025/month=08/day=01/instrument_type=unknown"


@pytest.mark.parametrize("href, want", [
    ("https://x.org/a.csv", "https://x.org/a.csv"), ("//cdn.org/a", "http://cdn.org/a"),
    ("/a/für b", "http://site.de:80/a/für b"), ("b.csv?x=1", "http://site.de:80/dir/b.csv?x=1"),
])
def test_absolute_url(spark, href, want):
    base = F.lit("HTTP://site.de:80/dir/page.html?q=/x/y#f")
    assert evaluate(spark, lambda c: links.absolute_url(c, base), [href]) == [want]


def test_link_pieces(spark):
    assert evaluate(spark, links.filename_from_url, [
        "https://x.org/a/b.csv?x=/c", "https://x.org/", "https://x.org/a/b/", "/%%/ü.gz#x"]) == [
        "b.csv", "download.bin", "b", "ü.gz"]
    url = F.lit("https://x.org/u.bin")
    assert evaluate(spark, lambda c: links.disposition_filename(c, url), [
        'attachment; filename="a b.csv" ', "inline", None]) == ["a b.csv", "u.bin", "u.bin"]
    assert evaluate(spark, lambda c: F.date_format(links.link_minute(c), "yyyyMMddHHmm"), [
        "/api/DEUR-post-2025-04-16T14_21.json.gz", "/api/x.json.gz"]) == ["202504161421", None]
    assert evaluate(spark, links.strip_amp, ["a?x=1&amp;y=2"]) == ["a?x=1&y=2"]
    assert evaluate(spark, links.delivery_link, [
        'see <a href="HTTPS://dl.luxse.com/dl?v=Ab1">', "none"]) == [
        "HTTPS://dl.luxse.com/dl?v=Ab1", None]


def test_anchors(spark):
    html = ("<article><a\n class=x HREF='a.csv'> one &amp; <b>two</b>\n</a><a href=>no</a>"
            '<a type="text/csv" href="/b?x=1&amp;y=2">B</a><abbr>x</abbr></article>')
    df = spark.createDataFrame([(html,)], "html string").select(
        F.posexplode(links.anchors(F.col("html"))).alias("pos", "a"))
    got = [tuple(r) for r in df.select(
        links.anchor_attribute(F.col("a"), "href"), links.anchor_text(F.col("a")),
        links.anchor_attribute(F.col("a"), "type")).collect()]
    assert got == [("a.csv", "one & two", ""), ("", "no", ""), ("/b?x=1&y=2", "B", "text/csv")]


def test_what_is_no_anchor(spark):
    html = ("<!-- <a href='c1'>no</a> --><script>x = \"<a href='s'>no</a>\"</script><STYLE>a</STYLE>"
            "<a title='x > y href=t' data-href=d href=\"q?a='1'\">one <!-- </b> > --><i class='>'>two</i></a >"
            "<textarea><a href=t>no</a></textarea><a name=it's href=u>three</a><a href = 'v' href='w'>four</a>"
            "<a = href=x>five</a><!-- never closed <a href=z>no</a>")
    df = spark.createDataFrame([(html,)], "html string").select(
        F.posexplode(links.anchors(F.col("html"))).alias("pos", "a"))
    got = [tuple(r) for r in df.select("pos", links.anchor_attribute(F.col("a"), "href"),
                                       links.anchor_text(F.col("a"))).collect()]
    assert got == [(0, "q?a='1'", "one two"), (1, "u", "three"), (2, "v", "four"), (3, "x", "five")]


def test_anchors_of_a_long_page(spark):
    """Many tags, attributes and unclosed anchors: no deep recursion."""
    html = "<a href=u>" + "<b x='1' y=2>t</b>" * 20_000 + "</a>" + "<a " + "k='v' " * 3_000 + "href=z>last</a>"
    df = spark.createDataFrame([(html + "<a href=open>" * 3_000,)], "html string").select(
        F.explode(links.anchors(F.col("html"))).alias("a"))
    got = [(r[0], len(r[1])) for r in df.select(links.anchor_attribute(F.col("a"), "href"),
                                               links.anchor_text(F.col("a"))).collect()]
    assert got == [("u", 20_000), ("z", 4)]


def test_date_parts_are_formats_of_their_own(spark):
    days = spark.sql("""select make_timestamp(y, m, d, 23, 59, 59.5) as t
      from values (1, 1, 9), (999, 12, 31), (1999, 2, 28), (2025, 8, 1), (9999, 10, 10), (12345, 6, 7), (null, 1, 1) as v(y, m, d)""")
    for r in days.select(F.array(*layout.date_parts(F.col("t"))).alias("got"), F.array(
            *[F.date_format("t", f) for f in ("yyyy", "MM", "dd")]).alias("want")).collect():
        assert r.got == r.want
