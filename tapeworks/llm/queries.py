"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm import (bpe, exact_dedup, forest_dedup, hash_forest, lm_mixing, merkle, packing,
                           quality, spelling, substring_dedup, suffix_dedup, toxicity, url_filters)
from tapeworks.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_repetition_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"))


@query("op4_bpe_round_trip")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


# The rules of the contract.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _fits(host: str, path: str) -> str:
    return (f"((host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}'))")


def _choice(pick: Callable[[tuple[str, str, str]], str], other: str) -> str:
    longest_first = sorted(URL_RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
    arms = " ".join(f"when {_fits(h, p)} then '{pick((h, p, v))}'" for h, p, v in longest_first)
    return f"case {arms} else {other} end"


@query("op6_url_rules", f"""
    with split as (
        select page_id,
               translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                         '{url_filters.UPPER}', '{url_filters.LOWER}') as host,
               regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path
        from pages)
    select page_id, host, path, {_choice(lambda r: r[0] + r[1], 'null')} as rule,
           {_choice(lambda r: r[2], "'allow'")} as verdict
    from split""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filters.RULES)
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


@query("op10_salted_exact_dedup", f"""
    with rows as (
        select doc_id, translate(coalesce(text, ''), '{exact_dedup.UPPER}', '{exact_dedup.LOWER}') as body
        from documents),
    groups as (select body, max(doc_id) as keep_id, count(*) as group_size from rows group by body)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
    from rows join groups using (body)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group(table(spark, sf_dir, "documents"))


@query("op3_sketched_substrings")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(table(spark, sf_dir, "documents"))


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.later_bytes(table(spark, sf_dir, "documents"))


def checksum(doc_id: str = "doc_id") -> Column:
    """crc32 of doc_id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


@query("op1_context_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_mixing.scored(table(spark, sf_dir, "documents"), checksum() % 7 != 2)


@query("op5_lexicon_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                           checksum() % 4 != 2)


@query("op9_lsh_forest")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_dedup.clusters(table(spark, sf_dir, "documents"))


@query("op7_retrieval_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


# Unsigned crc32 of a text's UTF-8 bytes, bit by bit.
def _crc32_sql(text: str) -> str:
    byte = f"('0x' || substr(hex(encode({text})), (2 * i - 1)::bigint, 2))::bigint"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform("
            f"range(1, strlen({text}) + 1), lambda i: {byte})), "
            f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), "
            f"lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))))")


def _leaf_sql(text: str) -> str:
    fields = ", ".join(f"coalesce(strlen({f})::varchar || ':' || {f}, '-')" for f in (
        "doc_id::varchar", "source", "lang", "n_chars::varchar", text))
    return f"sha256(concat({fields}))"


def _tree_sql(name: str, heights: int) -> str:
    """Tables name_0 .. name_heights (tree, rank, node), and name_top (tree, node)."""
    steps = [f"""
        {name}_{h + 1} as (
            select tree, rank // 16 as rank,
                   case when max(n) = 1 then any_value(node)
                        else sha256(string_agg(node, '' order by rank)) end as node,
                   (max(n) + 15) // 16 as n
            from {name}_{h} group by tree, rank // 16)""" for h in range(heights)]
    return ",".join([*steps, f"{name}_top as (select tree, node from {name}_{heights})"])


def _merkle_sql(leaf_heights: int = 5, source_heights: int = 3) -> str:
    """Height by height; enough heights for 16 ** 5 rows of a source and 16 ** 3 sources."""
    tables, previous = [], "start"
    for name, heights, own, at in (("leaf", leaf_heights, "p.tree", "p.rank"),
                                   ("source", source_heights, "''", "p.ordinal")):
        for h in range(heights):
            tables.append(f"""
                {name}_path_{h} as (
                    select p.* exclude (proof, node), p.proof || s.lefts || s.rights as proof,
                           case when s.n = 1 then p.node
                                else sha256(s.lefts || p.node || s.rights) end as node
                    from {previous} p join (
                        select tree, rank, n,
                               coalesce(string_agg(node, '') over (w rows between unbounded preceding
                                        and 1 preceding), '') as lefts,
                               coalesce(string_agg(node, '') over (w rows between 1 following
                                        and unbounded following), '') as rights
                        from {name}_{h} window w as (partition by tree, rank // 16 order by rank)) s
                    on s.tree = {own} and s.rank = {at} // {16 ** h})""")
            previous = f"{name}_path_{h}"
    return f"""
        with rows as (
            select doc_id, coalesce('s' || source, '') as tree, {_leaf_sql("text")} as leaf,
                   case when {_crc32_sql("doc_id::varchar")} % 5 = 0
                        then {_leaf_sql(f"translate(text, '{exact_dedup.UPPER}', '{exact_dedup.LOWER}')")}
                   end as tampered
            from documents),
        numbered as (
            select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as rank,
                   count(*) over (partition by tree) as n
            from rows),
        leaf_0 as (select tree, rank, leaf as node, n from numbered),
        {_tree_sql("leaf", leaf_heights)},
        source_0 as (
            select '' as tree, row_number() over (order by tree) - 1 as rank, node,
                   count(*) over () as n, tree as source
            from leaf_top),
        {_tree_sql("source", source_heights)},
        start as (
            select d.*, s.rank as ordinal, s.node as subroot, r.node as root, '' as proof,
                   coalesce(d.tampered, d.leaf) as node
            from numbered d join source_0 s on s.source = d.tree, source_top r),
        {",".join(tables)}
        select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, node as folded_root,
               node = root as verified
        from {previous}"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Null ids have no decimal form: such rows aren't tampered with.
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(chosen, merkle.leaf(text=F.translate(F.col("text"), exact_dedup.UPPER, exact_dedup.LOWER)))
    store = merkle.build(merkle.leaves(docs, tampered=tampered))
    found = merkle.proofs(store, store.leaves)
    root = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root",
                        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                        root.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


@query("op12_gram_variants", f"""
    with recursive runs as (
        select coalesce(doc_id::varchar, '') || ':' || run as named, run, count(*) as times from (
            select doc_id, unnest(regexp_extract_all(translate(
                       text, '{spelling.UPPER}', '{spelling.LOWER}'), '{spelling.LETTERS}')) as run
            from documents) group by all),
    hashed as (select run, times, {_crc32_sql("named")} as h from runs),
    words as (
        select word, sum(times)::bigint as n from (
            select times, case when h % 97 <> 0 then run
                else substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) end as word
            from hashed)
        where length(word) >= 5 group by word having sum(times) >= 3),
    cuts as (
        select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
        from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
    pairs as (
        select a.word, b.word as near, b.n from cuts a join cuts b using (i, rest) where a.word <> b.word
        union select c.word, c.rest, w.n from cuts c join words w on w.word = c.rest
        union select w.word, c.word, c.n from cuts c join words w on w.word = c.rest),
    best as (
        select word, count(*) as n_near, min({{'n': -n, 'near': near}}) as top from pairs group by word),
    formed as (
        select word, w.n, coalesce(n_near, 0) as n_near,
               case when -top.n >= 2 * w.n then top.near end as form,
               case when -top.n >= 2 * w.n then -top.n end as form_n
        from words w left join best using (word)),
    chains as (
        select word, coalesce(form, word) as reached, 1 as step from formed
        union all
        select c.word, f.form, c.step + 1 from chains c join formed f on f.word = c.reached
        where f.form is not null)
    select word, form, root, n, n_near, form_n
    from formed join (select word, arg_max(reached, step) as root from chains group by word) using (word)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    h = F.crc32(named.cast("binary"))
    word = F.when(h % 97 == 0, spelling.without_point(
        F.col("run"), (h % F.length("run")).cast("int"))).otherwise(F.col("run"))
    words = spelling.letter_runs(docs).select(word.alias("word")).where(
        F.length("word") >= spelling.MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return spelling.variants(words.where("n >= 3"))


@query("op13_hash_prefix_forest")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_forest.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
