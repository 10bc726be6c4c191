"""The pipeline, stage by stage and as a whole, against the plain version."""

import zlib
from collections import defaultdict

import numpy as np

import corpus_pipeline
from tapeworks.llm.queries import vocabulary
from tests.llm import brute
from tests.llm.conftest import SCHEMA, prose


def corpus():
    """Clean texts with copies, near copies and shared passages among bad ones."""
    passage, rows = prose(900, 60), []
    for i in range(40):
        text = prose(i % 32, 150)
        if i % 4 == 1:
            text += "\n" + passage + " " + prose(600 + i, 40)
        if i >= 32:
            words = text.split(" ")
            words[40] = "altered"
            text = " ".join(words) if i % 2 else text.upper()
        rows.append((i, text))
    return [*rows, (50, None), (51, "short"), (52, "again and again " * 30), (53, prose(3, 150))]


def test_stages_and_run(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, None, "c", 1) for i, t in rows], SCHEMA)
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, found, str(tmp_path))
        assert found.columns == docs.columns
        found = spark.createDataFrame(found.collect(), docs.schema)
    want = brute.pipeline_texts(rows)
    assert {r.doc_id: r.text for r in found.collect()} == want
    assert 20 < len(want) < 40 and want[5] != dict(rows)[5]

    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    ids = {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in want.items()}
    ends = defaultdict(int)
    for p in sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda p: p.start):
        part = ids[p.doc_id][p.start:p.start + p.length]
        assert p.start == ends[p.doc_id] and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        ends[p.doc_id] += p.length
    assert ends == {i: len(x) for i, x in ids.items()}


def test_empty_table(spark, none, tmp_path):
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_copies_from_80_percent(spark, tmp_path):
    """Pairs at 0.75 to 0.95 against brute force; some lie between 0.80 and 0.85."""
    rows = []
    for i in range(40):
        base = prose(2000 + i, 200).split()
        other = list(base)
        for k in range(1 + i % 8):
            other[10 + 20 * k] = f"altered{k}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    want = {80: set(), 85: set()}
    for percent, kept in want.items():
        kept.update(i for i, _, c in brute.near_duplicates(rows, percent) if i == c)
    assert len(want[80]) < len(want[85]) < len(rows)
    docs = spark.createDataFrame([(i, t, None, "c", 1) for i, t in rows], SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["near_copies"]
    assert {r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()} == want[80]


def test_stages_take_any_columns_null_ids_and_repeated_rows(spark, tmp_path):
    """Columns named like the operators' own, rows without an id, and rows given twice."""
    names = ("_keep", "_digest", "_gone", "_row", "chunk", "row", "rest", "node", "seq")
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    texts = [(1, prose(5, 120)), (2, prose(6, 120)), (2, prose(6, 120)), (3, prose(5, 120)),
             (None, prose(7, 120)), (None, prose(7, 120)), (4, None), (5, prose(8, 120)), (None, None)]
    docs = spark.createDataFrame([(i, t, *names) for i, t in texts], schema)
    found = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, found, str(tmp_path))
        assert found.columns == docs.columns
        found = spark.createDataFrame(found.collect(), docs.schema)
    kept = found.collect()
    assert {r.doc_id for r in kept} == {2, 3, 5, None}
    assert all(tuple(r)[2:] == names for r in kept)
    pieces = corpus_pipeline.STAGES[-1][1](spark, found, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == {2, 3, 5, None}
