"""Queries on listing pages, links and messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks import fixtures as X
from tapeworks.catalog.registry import query
from tapeworks.functions import links as L
from tapeworks.operators import discovery as D, manifest as M, messages as MS
from tapeworks.plans import discover as P
from tapeworks.session import workspace

_BASE = r"regexp_extract(url, '^(https?://[^/?#]*)', 1)"
_PAGE_PATH = r"regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)"
_PLAIN = "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')"

# The inside of a tag, for SQL text.
_TAG = "(?:[^>\"'']|\"[^\"]*\"|''[^'']*'')*"
_HREF = _PLAIN.format("concat(regexp_extract(a, '(?i)\\shref=\"([^\"]*)\"', 1), "
                      "regexp_extract(a, '(?i)\\shref=''([^'']*)''', 1))")
_TEXT = _PLAIN.format(f"regexp_replace(a, '(?s)<!--.*?-->|<{_TAG}>', '', 'g')")

LINKS = f"""
pages_v as ({X.listing_pages_sql('pages')}),
anchors as (
  select page_id, url, unnest(list) as a, generate_subscripts(list, 1) - 1 as pos
  from (select page_id, url, list_filter(regexp_extract_all(
          html, '(?is)<!--.*?-->|<script.*?</script\\s*>|<a\\s{_TAG}>.*?</a\\s*>'), lambda t: t ilike '<a%') as list
        from pages_v)),
hrefs as (
  select page_id, url, pos, {_HREF} as href, regexp_extract(a, '(?i)\\stype="([^"]*)"', 1) as type_attr,
    trim({_TEXT}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) as "text"
  from anchors),
found as (
  select page_id, cast(pos as int) as pos, href, type_attr, "text", case when href like 'http%://%' then href
    when href like '//%' then concat(split_part(url, ':', 1), ':', href)
    when href like '/%' then concat({_BASE}, href)
    else concat({_BASE}, case when {_PAGE_PATH} = '' then '/'
      else regexp_replace({_PAGE_PATH}, '[^/]*$', '') end, href) end as link
  from hrefs where href <> '')"""


def _found(spark, sf_dir):
    return D.page_links(X.listing_pages(spark, sf_dir)).select(
        "page_id", "pos", "href", "type_attr", "text", "link")


@query("q_links", f"with {LINKS} select * from found")
def page_links(spark, sf_dir):
    """Anchors of all pages with absolute links."""
    return _found(spark, sf_dir)


@query("q_filenames", f"""
with {LINKS}, named as (select page_id, pos,
  regexp_extract(regexp_extract(link, '^https?://[^/?#]*([^?#]*)', 1), '([^/]+)/*$', 1) as n,
  regexp_extract(link, '([^/]*)$', 1) as last_segment from found)
select page_id, pos, case when n = '' then 'download.bin' else n end as file, last_segment,
  case when page_id % 2 = 0 then concat('f', page_id, '.csv')
       when n = '' then 'download.bin' else n end as served_as
from named""")
def filenames(spark, sf_dir):
    header = F.when(F.col("page_id") % 2 == 0, F.concat(
        F.lit('attachment; filename="f'), "page_id", F.lit('.csv" ')))
    return _found(spark, sf_dir).select(
        "page_id", "pos", L.filename_from_url(F.col("link")).alias("file"),
        L.last_segment(F.col("link")).alias("last_segment"),
        L.disposition_filename(header, F.col("link")).alias("served_as"))


_WANTED = f"""
{LINKS}, wanted as (
  select 'bme' as feed, "text" as label, * from found
    where regexp_matches("text", '(?i)_BMEA_posttrade\\.json$')
  union all select 'berlin/pretrade', "text", * from found
    where regexp_matches("text", '(?i)^Download der Pretrade Daten für ')
  union all select 'berlin/posttrade', "text", * from found
    where type_attr = 'text/comma-separated-values'
  union all select 'athex', regexp_extract(link, '([^/]*)$', 1), * from found where link like '%.csv'
  union all select 'cboe/' || m || '/hourly', regexp_extract(link, '([^/]*)$', 1), found.*
    from found, (values ('bxe'), ('cxe'), ('dxe'), ('apa')) markets(m)
    where regexp_matches(link,
      '(?i)rts13_public_trade_data_' || m || '_[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}_[0-9]{{2}}\\.csv$')
  union all select 'deutsche-boerse', href, * from found where link like '%.json.gz')"""


@query("q_rule_matches", f"with {_WANTED} select feed, count(*) as links from wanted group by 1")
def rule_matches(spark, sf_dir):
    return D.listing_counts(D.match_rules(_found(spark, sf_dir)), "feed").withColumnRenamed(
        "files", "links")


@query("q_market_counts", f"""
with {LINKS} select lower(regexp_extract(link, '(?i)rts13_public_trade_data_([a-z]+)_', 1)) as market,
  count(*) as files from found
where regexp_matches(link, '(?i)rts13_public_trade_data_(bxe|cxe|dxe|apa)_\\d{{4}}-\\d{{2}}-\\d{{2}}_\\d{{2}}\\.csv$')
group by 1""")
def market_counts(spark, sf_dir):
    return D.listing_counts(D.market_files(_found(spark, sf_dir)), "market")


_FILES = f"""
with {_WANTED}, files as (
  select feed, label, link, page_id, pos from wanted where feed <> 'athex'
  union all select feed, label, arg_max(link, pos), page_id, min(pos) from wanted
  where feed = 'athex' group by feed, label, page_id),
seen as (
  select concat('f', c_custkey % 25, '.csv') as label from customer
  union select concat('post ', c_custkey % 7) from customer),
unseen as (select * from files f where not exists (select 1 from seen s where s.label = f.label))"""


def _seen(spark, sf_dir):
    """Labels under exchanges that none of the pages' feeds belong to."""
    customer = X.table(spark, sf_dir, "customer")
    return customer.select(
        F.concat(F.lit("f"), F.col("c_custkey") % 25, F.lit(".csv")).alias("label"),
        F.lit("lsx").alias("exchange")).unionByName(customer.select(
            F.concat(F.lit("post "), F.col("c_custkey") % 7).alias("label"),
            F.lit("elsewhere").alias("exchange")))


@query("q_link_discovery", _FILES + """
select feed, label, link, page_id, pos, regexp_extract(link, '([^/]*)$', 1) as file from unseen""")
def link_discovery(spark, sf_dir):
    """All new links."""
    return P.discover(X.listing_pages(spark, sf_dir), _seen(spark, sf_dir)).select(
        "feed", "label", "link", "page_id", "pos", "file")


_TWO = D.LinkRule("all", "link", ".", label="href", cap=2)


@query("q_link_discovery_capped", f"""
with {LINKS}, seen as (select concat('/p/t', c_custkey % 20) as label from customer),
firsts as (select * from found qualify row_number() over (partition by page_id order by pos) <= 2)
select page_id, pos, href as label from firsts where href not in (select label from seen)""")
def link_discovery_capped(spark, sf_dir):
    """The cap comes before the manifest is asked."""
    seen = X.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("/p/t"), F.col("c_custkey") % 20).alias("label"), F.lit("x").alias("exchange"))
    new = P.discover(X.listing_pages(spark, sf_dir), seen, rules=(_TWO._replace(cap_first=True),))
    return new.select("page_id", "pos", "label")


_FEW = D.LinkRule("all", "link", ".", label="href", cap=6)


@query("q_discovery_drained", f"""
with recursive {LINKS}, rest as (
  select page_id, pos, href, 1 as run, row_number() over (partition by page_id order by pos) as n from found
  union all
  select page_id, pos, href, run + 1, row_number() over (partition by page_id order by pos)
  from (select * from rest r where href not in (select href from rest where n <= 6)))
select page_id, pos, href as label, cast(run as int) as run from rest where n <= 6""")
def discovery_drained(spark, sf_dir):
    """Runs under a cap of six new links a page, until one finds nothing: what a run
    leaves, a later one finds, unless its label has been taken meanwhile."""
    pages, folder, run = X.listing_pages(spark, sf_dir), workspace(spark, "drained"), 0
    known = "label string, exchange string, page_id long, pos int, run int"
    while True:
        run += 1
        bronze = spark.createDataFrame([], known) if run == 1 else spark.read.schema(known).parquet(folder)
        new = P.discover(pages, bronze, rules=(_FEW,)).select(
            "label", F.lit("x").alias("exchange"), "page_id", "pos", F.lit(run).alias("run"))
        new.write.mode("append").parquet(folder)
        found = spark.read.schema(known).parquet(folder)
        if found.where(F.col("run") == run).isEmpty():
            return found.select("page_id", "pos", "label", "run")


# --- pointer ------------------------------------------------------------------------------

def _stamped(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("feed"), L.strip_amp(F.concat(
            F.lit("https://x.example.org/api/download/DEUR?a=1&amp;b="), "event_id", F.lit("-"),
            F.date_format("ts", "yyyy-MM-dd'T'HH_mm"), F.lit(".json.gz"))).alias("link"))


def _marks(spark, sf_dir):
    """Marks of all feeds but one."""
    feeds = X.table(spark, sf_dir, "events").select(F.col("event_type").alias("feed")).distinct()
    return feeds.where("feed <> 'signup'").withColumn("mark", F.concat(
        F.lit("2024-01-"), F.length("feed") + 10, F.lit(" 12:30:00")).cast("timestamp"))


_STAMPED = """
with links as (
  select event_type as feed, date_trunc('minute', ts) as stamped_at,
    concat('https://x.example.org/api/download/DEUR?a=1&b=', event_id, '-',
      strftime(ts, '%Y-%m-%dT%H_%M'), '.json.gz') as link from events),
marks as (select distinct event_type as feed,
  cast(concat('2024-01-', length(event_type) + 10, ' 12:30:00') as timestamp) as mark from events
  where event_type <> 'signup'),
fresh as (select l.*, m.mark from links l left join marks m using (feed)
  where m.mark is null or stamped_at > mark)"""


@query("q_highwater", _STAMPED + """
select feed, count(*) as links, strftime(min(stamped_at), '%Y-%m-%d %H:%M') as oldest,
  strftime(max(stamped_at), '%Y-%m-%d %H:%M') as mark from fresh group by 1""")
def highwater(spark, sf_dir):
    """Links newer than each feed's mark, and the mark after fetching all."""
    links, marks = _stamped(spark, sf_dir), _marks(spark, sf_dir)
    fresh = D.newer_than_mark(links, marks)
    counts = fresh.groupBy("feed").agg(
        F.count("*").alias("links"),
        F.date_format(F.min("stamped_at"), "yyyy-MM-dd HH:mm").alias("oldest"))
    after = D.advance_marks(marks, fresh).select(
        "feed", F.date_format("mark", "yyyy-MM-dd HH:mm").alias("mark"))
    return counts.join(after, "feed")


@query("q_highwater_batch", _STAMPED + """, batch as (
  select *, rank() over (partition by feed order by stamped_at) as place from fresh
  qualify place <= 100)
select feed, link, strftime(max(stamped_at) over (partition by feed), '%Y-%m-%d %H:%M') as mark
from batch""")
def highwater_batch(spark, sf_dir):
    """The oldest hundred links of each feed in whole minutes, and the marks after them."""
    found = P.discover_after_mark(_stamped(spark, sf_dir), _marks(spark, sf_dir), cap=100)
    after = found.marks.select("feed", F.date_format("mark", "yyyy-MM-dd HH:mm").alias("mark"))
    return found.fresh.select("feed", "link").join(after, "feed")


@query("q_highwater_drained", _STAMPED + """
select feed, count(*) as links, count(distinct link) as kinds from fresh group by 1""")
def highwater_drained(spark, sf_dir):
    """One capped batch and one without a cap: together they are all fresh links, once each."""
    links, marks = _stamped(spark, sf_dir), _marks(spark, sf_dir)
    first = P.discover_after_mark(links, marks, cap=100)
    rest = P.discover_after_mark(links, first.marks)
    return first.fresh.unionByName(rest.fresh).groupBy("feed").agg(
        F.count("*").alias("links"), F.count_distinct("link").alias("kinds"))


# --- messages -----------------------------------------------------------------------------

_MESSAGES = f"""
with messages as (select *, concat('desk', conv_id % 20) as recipient,
  {X.FIRST_DAY} + conv_id * 3600 + turn as received from conversations)"""


@query("q_latest_message_link", _MESSAGES + f"""
select recipient, concat('HTTPS://dl.luxse.com/dl?v=', conv_id, '-', turn) as link, conv_id, turn
from (select * from messages where turn % 3 = 0 and received >= {X.FIRST_DAY} + 86400
        and role in ('user', 'system'))
qualify row_number() over (partition by recipient order by received desc, turn desc) = 1""")
def latest_message_link(spark, sf_dir):
    """Per recipient the newest message with a link, of two senders, since a day."""
    since = F.timestamp_seconds(F.lit(X.FIRST_DAY + 86400 + 50000))
    messages = X.messages_v(spark, sf_dir)
    mine = (MS.matching_messages(messages, sender="USER@", since=since)
            .unionByName(MS.matching_messages(messages, sender="system@", since=since)))
    return MS.latest_link(mine, order=["received_at", "turn", "conv_id"]).select(
        "recipient", "link", "conv_id", "turn")


@query("q_attachments", """
select conv_id, turn, concat(role, '.xlsx') as filename, strlen(text) as bytes
from conversations where turn % 3 > 0 and strlen(text) > 0""")
def attachments(spark, sf_dir):
    return MS.attachments(X.messages_v(spark, sf_dir)).select(
        "conv_id", "turn", "filename", F.octet_length("content").cast("long").alias("bytes"))


@query("q_latest_attachments", _MESSAGES + """
select recipient, conv_id, turn, concat(role, '.xlsx') as filename, sha256(text) as sha256
from (select * from messages where turn % 3 > 0 and strlen(text) > 0)
qualify row_number() over (partition by recipient order by received desc, turn desc) = 1""")
def latest_attachments(spark, sf_dir):
    newest = MS.latest_attachments(X.messages_v(spark, sf_dir),
                                   order=["received_at", "turn", "conv_id"])
    return newest.select("recipient", "conv_id", "turn", "filename",
                         F.sha2("content", 256).alias("sha256"))
