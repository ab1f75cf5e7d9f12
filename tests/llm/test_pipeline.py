"""The pipeline against its parts by hand, and the registered queries that SQL can express."""

from pathlib import Path

import duckdb
import pyarrow as pa
import pytest
from test_pairs import jaccard_by_hand
from test_repeats import bytes_by_hand

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check_oracle import compare
from regraft.llm.common import bounded_sample, id_bits, marked_ids, without_ids
from regraft.llm.quality import accepted

NAMES = [
    "op1_url_filter", "op2_phrases", "op3_licenses", "op4_jaccard", "op5_suffixes", "op6_contamination",
    "op7_quality", "op8_vectors", "op9_main_text", "op10_bpe", "pipeline",
]


def test_all_are_registered():
    assert set(NAMES) <= queries().keys()


@pytest.mark.parametrize("name", [n for n in NAMES if n in oracle_sql()])
def test_against_sql(spark, folder, name):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    good, note = compare(spark, con, name, queries()[name], oracle_sql()[name], folder)
    assert good, note


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality classifier", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "BPE encoding and decoding",
    ]

    def rows(frame):
        return sorted((r.doc_id, r.text) for r in frame.collect())

    before, step = rows(docs), iter(stages.values())
    docs = next(step)(spark, docs, folder).cache()
    kept = rows(docs)
    assert docs.columns == columns and 0.5 * len(before) < len(kept) < len(before) and set(kept) <= set(before)

    docs = next(step)(spark, docs, folder).cache()
    single = {i for i, _, _, c in jaccard_by_hand(kept, 5, 80) if i == c}
    kept, given = rows(docs), kept
    assert docs.columns == columns and kept == [r for r in given if r[0] in single]

    docs = next(step)(spark, docs, folder).cache()
    gone = {i: n for i, _, n, _, _ in bytes_by_hand(kept, corpus_pipeline.REPEAT_BYTES)}
    shorter, given = rows(docs), dict(kept)
    assert docs.columns == columns
    for i, text in shorter:
        cut = len(given[i].encode()) - len(text.encode())
        assert gone[i] - 8 <= cut <= gone[i] if gone[i] else text == given[i]

    docs = next(step)(spark, docs, folder).cache()
    clean = rows(docs)
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert docs.columns == columns
    assert set(clean) >= {r for r in shorter if not any(w in r[1] for x in items for w in [" ".join(x.split()[:5])])}
    assert not [i for i, t in clean for x in items if x in t]

    last = next(step)(spark, docs, folder)
    assert sorted(r.doc_id for r in last.collect()) == [i for i, _ in clean]


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)


def test_ids_are_marked_and_removed(spark, documents):
    ids = [0, 1, -1, 7, 1 << 62, -(1 << 62), 32767, 32768, (1 << 23) - 1, 1 << 23]
    bits = id_bits(spark.createDataFrame([(i,) for i in ids], "v long"), "v")
    assert marked_ids(bits, pa.array(ids)).all() and not marked_ids(bits, pa.array([5, 99])).any()
    table = documents((5, "a"), (8, "b"), (1 << 23, "c"))
    left = without_ids(table, spark.createDataFrame([(5,), (0,)], "doc_id long"))
    assert left.columns == table.columns and sorted(r.doc_id for r in left.collect()) == [8, 1 << 23]


def test_null_ids_in_the_stages(spark, documents, folder):
    text = " ".join(f"w{k}" for k in range(60))
    table = documents((4, text), (None, text), (None, f"{text} more"), (None, "quite another text of some words"), (2, f"{text} end"), (4, "once more"))
    left = corpus_pipeline.near_duplicate_stage(spark, table, folder)
    want = [(2, f"{text} end"), (4, "once more"), (None, "quite another text of some words")]
    assert left.columns == table.columns and sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)
    bits = id_bits(spark.createDataFrame([(None,), (5,)], "v long"), "v")
    assert marked_ids(bits, pa.array([5])).all() and not marked_ids(bits, pa.array([6])).any()


def test_sample(spark):
    assert bounded_sample(spark.range(10_000), "id", 50).count() == 50
    assert bounded_sample(spark.range(30), "id", 50).count() == 30


def test_accepted_documents_keep_their_columns(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    assert accepted(docs.withColumn("slots", docs.lang), labels).columns == [*docs.columns, "slots"]
