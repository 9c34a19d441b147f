"""The pipeline's stages against their rules, and the registered queries."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import corpus_pipeline  # noqa: E402
from check_sql import connect, differences  # noqa: E402

from cabstream.llm import queries  # noqa: E402
from cabstream.llm.common import stored  # noqa: E402

from .conftest import prose  # noqa: E402
from .test_lines_and_shards import direct as direct_lines  # noqa: E402
from .test_simhash import direct_components, direct_fingerprint  # noqa: E402


def test_all_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    _count, notes = differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.SQL[name])
    assert not notes


def test_native_operators_run_no_python(spark, sf_dir):
    for name in ("op5_line_dedup", "op9_sharding"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_stages_on_the_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = []
    for _name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        steps.append(docs)
    first, lines, single, clean, packed = steps
    before = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    kept = {r.doc_id: r for r in first.collect()}
    assert len(kept) >= 0.97 * len(before) and all(before[i] == r for i, r in kept.items())
    ids = sorted(kept)
    want = dict(zip(ids, direct_lines([kept[i].text for i in ids], 10), strict=True))
    after = {r.doc_id: r for r in lines.collect()}
    assert {i: r.text for i, r in after.items()} == {i: w[2] for i, w in want.items()}
    assert all(r.n_chars == len(r.text) for r in after.values() if want[r.doc_id][1])
    roots = direct_components({i: direct_fingerprint(r.text, 4) for i, r in after.items()}, 4)
    assert {r.doc_id for r in single.collect()} == set(roots.values())
    gone = {r.doc_id for r in single.collect()} - {r.doc_id for r in clean.collect()}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for i, r in after.items():
        if i in set(roots.values()) and any(item in " ".join(r.text.lower().split()) for item in items):
            assert i in gone
    assert len(gone) < 0.1 * len(roots)
    rows = packed.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in clean.collect()}
    assert all(s.columns == docs_columns for s, docs_columns in ((s, list(before[ids[0]].asDict())) for s in steps[:4]))


def test_stages_take_awkward_rows(spark, sf_dir, make_docs, awkward):
    texts = [*awkward, *[prose(100 + i, 40) for i in range(10)]]
    docs = make_docs(texts, lang=["en", "de"] * (len(texts) // 2)).withColumns(
        {"source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"), "n_dropped": F.lit(-3),
         "tags": F.create_map(F.lit("k"), F.col("doc_id")), "odd name": F.lit(2), "_text": F.lit("x")})
    nameless = docs.withColumn("doc_id", F.when(F.col("doc_id") > 5, F.col("doc_id")))
    for table in (docs.unionAll(docs.limit(9)), nameless, docs.limit(0)):
        for _name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf_dir)
            assert out.columns == docs.columns and out.count() <= table.count()
            assert all(r["score"] == 1 and r["n_lines"] == 1 and r["n_dropped"] == -3 and r["_text"] == "x"
                       and r["kept_text"] == 1 and r["tags"] == {"k": r["doc_id"]} or table is nameless
                       for r in out.collect())
        corpus_pipeline.STAGES[-1][1](spark, table, sf_dir).count()


def test_decontamination_judges_each_row_by_its_own_text(spark, sf_dir, make_docs):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    held = f"{prose(1, 30)} {item} {prose(2, 30)}"
    docs = make_docs([held, prose(3, 40), prose(4, 40), held, prose(5, 40), None], clashes=False)
    shared = docs.withColumn("doc_id", F.when(F.col("doc_id") > 2, F.lit(7)))
    out = corpus_pipeline.decontamination(spark, shared, sf_dir)
    assert out.columns == docs.columns
    kept = {(None, prose(3, 40)), (None, prose(4, 40)), (7, prose(5, 40)), (7, None)}
    assert {(r.doc_id, r.text) for r in out.collect()} == kept and out.count() == 4


def test_near_duplicates_judge_each_text_under_an_id(spark, sf_dir, make_docs):
    texts = [prose(1, 60), prose(2, 60), prose(2, 60), prose(3, 60), prose(1, 60), prose(4, 60), None]
    docs = make_docs(texts, clashes=False, lang=["en", "fr", "de", "en", "en", "en", "en"]).withColumn(
        "doc_id", F.when(F.col("doc_id") < 4, F.lit(7)).when(F.col("doc_id") == 4, F.lit(9)))
    out = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert out.columns == docs.columns
    kept = [(7, prose(1, 60), "en"), (7, prose(2, 60), "de"), (7, prose(3, 60), "en"), (None, prose(4, 60), "en"),
            (None, None, "en")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(i, t, k) for i, t, k in kept], key=str)


def test_languages_are_rejected_relative_to_their_number(spark, sf_dir, make_docs):
    texts = [prose(i, 30) for i in range(40)] + ["", None, "12 34"]
    for labels, kept in ((["aa"] * 43, 40), ([None] * 43, 40)):
        assert corpus_pipeline.language_id(spark, make_docs(texts, lang=labels), sf_dir).count() == kept


@pytest.mark.parametrize("kind", ["smallint", "string", "decimal(9,0)", "date"])
def test_benchmark_ids_of_any_type(spark, make_docs, kind):
    from cabstream.llm import decontaminate

    item = prose(1, 30)
    ids = F.col("item_id").cast(kind) if kind != "date" else F.date_add(F.lit("2024-01-01").cast("date"), F.col("item_id").cast("int"))
    bench = spark.createDataFrame([(5, item)], "item_id long, text string").withColumn("item_id", ids)
    found = decontaminate.benchmark_matches(make_docs([prose(2, 50), f"{prose(3, 9)} {item}"]), bench).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, bench.first().item_id)]
    assert decontaminate.benchmark_matches(make_docs([prose(2, 9)]), bench.limit(0)).count() == 0
