"""Queries on the manifest, data-quality gates and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks import fixtures as X
from tapeworks.catalog.registry import query
from tapeworks.operators import dq as D, manifest as M, metrics as MT
from tapeworks.plans import landing as P
from tapeworks.session import workspace
from tapeworks.sources.reference_data import explode_labels, label_only_rows, legacy_bronze_rows

BRONZE = f"bronze_v as ({X.bronze_sql(X.DUCK, 'events')})"


@query("q_pending", f"""
with {BRONZE} select sha256, exchange, label, scraped_at from bronze_v
where status = 'downloaded' order by scraped_at, sha256 limit 1000""")
def pending(spark, sf_dir):
    return M.pending(X.bronze_v(spark, sf_dir), limit=1000).select(
        "sha256", "exchange", "label", "scraped_at")


@query("q_pending_feed", f"""
with {BRONZE} select sha256, scraped_at from bronze_v
where status = 'downloaded' and exchange = 'bme' order by scraped_at, sha256 limit 1000""")
def pending_feed(spark, sf_dir):
    return M.pending(X.bronze_v(spark, sf_dir), "bme", 1000).select("sha256", "scraped_at")


_EVENTS = f"""
with {BRONZE}, landed as (
  select 'landed' as kind, scraped_at as event_at, 0 as no, cast(event_id // 3 as varchar) as sha,
    b.exchange, b.label, 'downloaded' as status, null as error
  from bronze_v b join (select event_id from events) e on b.sha256 = cast(e.event_id as varchar)),
changes as (
  select 'status' as kind, floor(epoch(ts)) + value - 40 as event_at, 1 as no,
    cast(event_id // 2 as varchar) as sha, null as label,
    case event_type when 'error' then 'failed' else 'ingested' end as status,
    case event_type when 'error' then repeat('e', 2000) end as error
  from events where event_type <> 'view'),
first as (select * from landed
  qualify row_number() over (partition by sha order by event_at, no, exchange, label) = 1),
valid as (select c.* from changes c join first f on c.sha = f.sha
  where (c.event_at, c.no) > (f.event_at, f.no)),
last as (select * from valid
  qualify row_number() over (partition by sha order by event_at desc, no desc, status desc) = 1),
done as (select sha, max(event_at) as at from valid where status = 'ingested' group by 1)"""


def _history(spark, sf_dir):
    """Landings of every file (three events share a digest) and status changes,
    some before the landing and some for digests that never landed."""
    events = X.table(spark, sf_dir, "events")
    files = X.bronze_v(spark, sf_dir).withColumn("status", F.lit("downloaded"))
    third = (F.col("sha256").cast("long") / 3).cast("long").cast("string")
    landed = M.landing_events(files.withColumn("sha256", third))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    changes = events.where(F.col("event_type") != "view").select(
        (F.col("event_id") / 2).cast("long").cast("string").alias("sha256"),
        (seconds + F.col("value") - 40).alias("event_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ingested").alias("status"),
        F.when(F.col("event_type") == "error", F.repeat(F.lit("e"), F.lit(2000))).alias("error"))
    marked = M.status_events(changes, F.col("event_at"), F.lit(1))
    return landed.unionByName(marked)


_FOLD = _EVENTS + """
select f.sha as sha256, f.label, coalesce(l.status, f.status) as status, d.at as ingested_at,
  coalesce(length(l.error), 0) as error_length
from first f left join last l on f.sha = l.sha left join done d on f.sha = d.sha"""


@query("q_status_fold", _FOLD)
def status_fold(spark, sf_dir):
    state = M.fold_bronze(_history(spark, sf_dir))
    return state.select("sha256", "label", "status", "ingested_at",
                        F.coalesce(F.length("error"), F.lit(0)).cast("long").alias("error_length"))


@query("q_state_rebase", _FOLD)
def state_rebase(spark, sf_dir):
    """The same history appended in three parts, the state so far made the base after
    each of the first two: read from the last base and the events since."""
    store = M.ManifestTables(spark, workspace(spark, "rebased"))
    history = _history(spark, sf_dir)
    part = F.pmod(F.xxhash64("sha256", "event_at", "status"), F.lit(3))
    for n in range(3):
        store.append_events(history.where(part == n))
        if n < 2:
            store.rebase()
    return store.bronze().select("sha256", "label", "status", "ingested_at",
                                 F.coalesce(F.length("error"), F.lit(0)).cast("long").alias("error_length"))


@query("q_manifest_stats", f"""
with {BRONZE}
select 'bronze' as layer, status, count(*) as files from bronze_v group by all
union all
select 'silver', case when o_orderstatus = 'F' then 'compacted' else 'written' end, count(*)
from (select * from orders qualify row_number() over (
  partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1) group by all""")
def manifest_stats(spark, sf_dir):
    return M.stats(X.bronze_v(spark, sf_dir), M.fold_silver(_silver_events(spark, sf_dir)))


def _silver_events(spark, sf_dir):
    """One silver event per order; a customer's orders rewrite one file."""
    return X.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("/silver/"), "o_custkey").alias("target_uri"),
        F.lit("trades").alias("table"), F.lit("p").alias("partition_path"),
        F.col("o_orderkey").alias("rows"), F.lit(1).cast("long").alias("bytes_size"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double").alias("written_at"),
        F.lit(None).cast("string").alias("bronze_sha256"),
        F.when(F.col("o_orderstatus") == "F", "compacted").otherwise("written").alias("status"),
        F.col("o_orderkey").alias("event_no"))


@query("q_silver_upsert", """
select concat('/silver/', o_custkey) as target_uri, o_orderkey as rows,
  case when o_orderstatus = 'F' then 'compacted' else 'written' end as status
from orders qualify row_number() over (
  partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""")
def silver_upsert(spark, sf_dir):
    return M.fold_silver(_silver_events(spark, sf_dir)).select("target_uri", "rows", "status")


@query("q_files_per_day", f"""
with {BRONZE}
select exchange, strftime(make_timestamp(cast(scraped_at as bigint) * 1000000), '%Y-%m-%d') as day,
  status, count(*) as files, cast(sum(bytes_size) as bigint) as bytes
from bronze_v group by all""")
def files_per_day(spark, sf_dir):
    return M.files_per_day(X.bronze_v(spark, sf_dir))


# --- dedupe and landing -------------------------------------------------------------

_SEEN = """
seen as (select sha256(text) as sha256, source as exchange, concat(lang, doc_id) as label
         from documents where lang = 'de')"""


def _documents(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("feed"), F.concat("lang", "doc_id").alias("label"),
        "text", "lang", F.concat(F.lit("/in/"), "doc_id").alias("source_uri"))
    candidates = P.bronze_candidates(docs, content="text", scraped_at=F.col("doc_id"))
    known = P.bronze_candidates(docs.where(F.col("lang") == "de"), content="text",
                                scraped_at=F.lit(0))
    return candidates, known


@query("q_bronze_landing", f"""
with {_SEEN}
select sha256(text) as sha256, source as exchange, concat(lang, doc_id) as label,
  strlen(text) as bytes_size, cast(doc_id as double) as scraped_at, 'downloaded' as status
from documents d
where not exists (select 1 from seen s where s.sha256 = sha256(d.text))
  and not exists (select 1 from seen s where s.label = concat(d.lang, d.doc_id)
                  and s.exchange = d.source)
qualify row_number() over (partition by sha256(text) order by doc_id) = 1""")
def bronze_landing(spark, sf_dir):
    candidates, known = _documents(spark, sf_dir)
    landed = P.select_new(spark, candidates, known)
    return landed.select("sha256", "exchange", "label", "bytes_size", "scraped_at", "status")


@query("q_not_seen", f"""
with {_SEEN}, shifted as (
  select *, source as exchange, concat(lang, doc_id - 1) as label from documents)
select 'exchange+label' as keys, count(*) as payloads from shifted d
  where not exists (select 1 from seen s where s.exchange = d.exchange and s.label = d.label)
union all select 'label', count(*) from shifted d
  where not exists (select 1 from seen s where s.label = d.label)
union all select 'sha256', count(*) from shifted d
  where not exists (select 1 from seen s where s.sha256 = sha256(d.text))""")
def not_seen(spark, sf_dir):
    """The three dedupe keys; labels are shifted so that they meet other documents."""
    candidates, known = _documents(spark, sf_dir)
    docs = X.table(spark, sf_dir, "documents").select(
        F.sha2("text", 256).alias("sha256"), F.col("source").alias("exchange"),
        F.concat("lang", F.col("doc_id") - 1).alias("label"))
    parts = [M.not_seen(docs, known, keys).agg(F.count("*").alias("payloads"))
             .select(F.lit("+".join(keys)).alias("keys"), "payloads")
             for keys in (["exchange", "label"], ["label"], ["sha256"])]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("q_legacy_import", """
select concat('legacy:', label) as sha256, 'legacy' as exchange, label,
  concat('legacy://', label) as source_uri, 0::bigint as bytes_size, 'ingested' as status
from (select distinct unnest([concat(lang, '-', source, '.csv'), concat(doc_id, '.csv')]) as label
      from documents)
union all
select concat('label-only:', source, ':', lang), source, lang,
  concat('label-only://', source, '/', lang), 0, 'ingested'
from (select distinct source, lang from documents)""")
def legacy_import(spark, sf_dir):
    """Label lists in JSON text, imported twice, and labels marked as seen."""
    docs = X.table(spark, sf_dir, "documents")
    lists = docs.select(F.to_json(F.array(
        F.concat("lang", F.lit("-"), "source", F.lit(".csv")),
        F.concat("doc_id", F.lit(".csv")))).alias("value"))
    rows = legacy_bronze_rows(explode_labels(lists, "value"), scraped_at=F.lit(1.0))
    seen = label_only_rows(docs.select("source", F.col("lang").alias("label")),
                           exchange=F.col("source"), scraped_at=F.lit(1.0))
    store = M.ManifestTables(spark, workspace(spark, "legacy"))
    for _ in range(2):
        store.import_labels(rows)
        store.import_labels(seen)
    return store.bronze().select("sha256", "exchange", "label", "source_uri", "bytes_size",
                                 "status")


# --- gates ----------------------------------------------------------------------------

_RULES = (D.Rule("berlin", 3, 0.10), D.Rule("BME", 1, 0.15), D.Rule("bank_of", 0, 0.99),
          D.Rule("cboe", 1_000_000_000, 0.10), D.Rule("nowhere", 2, 0.10), D.Rule("none", 0, 0.1))

_RULE_SUMS = f"""
with {BRONZE}, rules(rule_no, exchange, min_files, max_failure_rate) as (values
  {', '.join(f"({i}, '{r.exchange}', {r.min_files}, {r.max_failure_rate}::double)"
             for i, r in enumerate(_RULES))}),
recent as (select * from bronze_v
           where scraped_at >= (select max(scraped_at) - 604800 from bronze_v)),
sums as (
  select r.rule_no, r.exchange, r.min_files, r.max_failure_rate, count(b.sha256) as files,
    count(b.sha256) filter (where b.status = 'failed') as failed
  from rules r left join recent b on b.exchange ilike '%' || r.exchange || '%' group by all)"""


@query("q_dq_counts", _RULE_SUMS + """
select rule_no, exchange, files, failed from sums""")
def dq_counts(spark, sf_dir):
    end = X.last_scrape(spark, sf_dir)
    return D.rule_counts(spark, X.bronze_v(spark, sf_dir), _RULES,
                         cutoff=F.lit(end - 604800)).select("rule_no", "exchange", "files", "failed")


@query("q_dq_gate", _RULE_SUMS + """
select rule_no, case when files < min_files then concat('DQ: exchange=', exchange, ' got ', files,
    ' files in last 168h (expected >= ', min_files, ')')
  else concat('DQ: exchange=', exchange, ' failure rate ', failed, '/', files, '=',
    cast(round_even(100.0::double * (failed / files), 0) as bigint), '% exceeds max=',
    cast(round_even(max_failure_rate * 100, 0) as bigint), '%') end as message
from sums where files < min_files
  or (files > 0 and failed / files > max_failure_rate)""")
def dq_gate(spark, sf_dir):
    end = X.last_scrape(spark, sf_dir)
    return D.check(spark, X.bronze_v(spark, sf_dir), _RULES, now=end,
                   window_hours=168).select("rule_no", "message")


# --- metrics --------------------------------------------------------------------------

def _increments(spark, sf_dir):
    """One counter increment per event; view events set a gauge as well."""
    return X.table(spark, sf_dir, "events").select(
        F.concat(F.col("event_type"), F.lit("_total")).alias("name"),
        F.when(F.col("event_type") != "view", F.concat(F.lit("Events of type "), "event_type"))
        .alias("description"),
        F.when(F.col("event_type") == "click", F.create_map().cast("map<string,string>"))
        .otherwise(F.create_map(
            F.lit("user"), (F.col("user_id") % 3).cast("string"),
            F.lit("day"), F.date_format("ts", "dd"))).alias("labels"),
        F.lit(1.0).alias("value"), "ts", F.col("event_id").alias("at"))


_SERIES = """
with series as (
  select concat(event_type, '_total') as name, case when event_type <> 'click'
      then concat('{day="', strftime(ts, '%d'), '",user="', user_id % 3, '"}') else '' end as tags,
    cast(count(*) as double) as value, min(event_id) as first_at
  from events group by all)"""


@query("q_metrics_render", _SERIES + """
, names as (select name, min(first_at) as name_at from series group by 1)
select name_at, name, 0 as part, concat('# HELP ', name, ' Events of type ',
  replace(name, '_total', '')) as line from names where name <> 'view_total'
union all select name_at, name, 1, concat('# TYPE ', name, ' counter') from names
union all select name_at, name, 2, concat(name, tags, ' ', cast(value as varchar))
from series join names using (name)""")
def metrics_render(spark, sf_dir):
    lines = MT.exposition(MT.counters(_increments(spark, sf_dir)))
    return lines.select("name_at", "name", "part", "line")


@query("q_metrics_summary", _SERIES + """
select name, sum(value) as total, count(*) as series from series group by 1""")
def metrics_summary(spark, sf_dir):
    return MT.summary(MT.counters(_increments(spark, sf_dir)))


@query("q_metrics_gauges", """
select 'value' as name, concat('user=', user_id) as labels, arg_max(value, event_id) as value
from events group by all""")
def metrics_gauges(spark, sf_dir):
    settings = X.table(spark, sf_dir, "events").select(
        F.lit("value").alias("name"), F.lit("").alias("description"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("labels"),
        "value", F.col("event_id").alias("at"))
    label = F.concat(F.col("labels")[0]["key"], F.lit("="), F.col("labels")[0]["value"])
    return MT.gauges(settings).select("name", label.alias("labels"), "value")
