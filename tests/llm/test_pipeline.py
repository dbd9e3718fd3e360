"""The pipeline's stages one by one against brute force, and the queries' shape."""

import os
from collections import Counter

import brute
import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from refinery.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return SF


def test_stage_names_and_functions():
    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "decontaminate", "mix_sources", "token_files"]
    assert P.ORACLE_SQL is None and all(callable(f) for _, f in P.STAGES)


def test_language_stage_rejects_only_texts_without_letters(spark, awkward, tables):
    rows, df = awkward
    out = P.language_id(spark, df, tables)
    assert out.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(
        (d, t) for d, t, *_ in rows if any(c.isalpha() for c in t or ""))


def test_language_stage_without_a_model_rejects_only_texts_without_letters(spark, awkward, nothing, tables):
    rows, df = awkward
    out = P.language_id(spark, df.withColumn("lang", F.lit(None).cast("string")), tables)
    assert out.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(
        (d, t) for d, t, *_ in rows if any(c.isalpha() for c in t or ""))
    assert P.language_id(spark, nothing, tables).count() == 0


def test_near_duplicate_stage_keeps_one_of_each_group(spark, awkward, tables):
    rows, df = awkward
    out = P.near_duplicates(spark, df, tables)
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    component, sizes = brute.similar_components([(r[0], r[1]) for r in rows])
    alone = Counter((r[0], r[1]) for r, n in zip(rows, sizes) if n == 0)
    assert Counter(k for k in kept if not brute.shingles(k[1])) == alone
    rest = [k for k in kept if brute.shingles(k[1])]
    # whole rows decide groups: number them by text
    group = {}
    for (d, t, *_), c in zip(rows, brute.similar_components([(i, r[1]) for i, r in enumerate(rows)])[0]):
        group[d, t] = c
    assert sorted(group[k] for k in rest) == sorted(set(g for k, g in group.items() if brute.shingles(k[1])))
    assert {k[0] for k in rest} <= set(component)


def test_decontamination_stage_drops_hit_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    rows = docs.collect()
    hit = brute.contamination([r["text"] for r in rows], items)
    out = P.decontaminate(spark, docs, tables)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r, (_, n, _) in zip(rows, hit) if n == 0)


def test_mixing_stage_repeats_rows(spark, awkward, tables):
    rows, df = awkward
    out = P.mix_sources(spark, df, tables)
    assert out.columns == df.columns
    times = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    held = Counter((d, t, s) for d, t, _, s in rows)
    assert set(times) <= set(held) and all(n <= 3 * held[k] for k, n in times.items())


def test_run_from_documents_to_tokens(spark, tables):
    out = P.run(spark, tables).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    assert out and {r["doc_id"] for r in out} <= set(docs)
    starts = sorted((r["start"], r["n_tokens"]) for r in out)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


CONTRACT = {
    "op1": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op2": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4": ["doc_id", "size", "source_size", "target", "taken"],
    "op5": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op6": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op7": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op8": ["page_id", "url", "text", "n_chars"],
    "op9": ["doc_id", "n_shingles", "component_id"],
    "op10": ["doc_id", "held_out", "lang_pred", "score"],
}


@pytest.mark.parametrize("op", CONTRACT)
def test_query_columns_and_rows(spark, tables, op):
    (name,) = [q for q in queries.QUERIES if q.split("_")[0] == op]
    out = queries.QUERIES[name](spark, tables)
    assert out.columns == CONTRACT[op]
    table = "pages" if "page_id" in out.columns else "documents"
    assert out.count() == spark.read.parquet(f"{tables}/{table}.parquet").count()
    longs = {"size", "start", "n_tokens", "n_words", "n_hit", "n_items", "payload_bytes", "text_crc32", "slot", "taken", "source_size",
             "ids_crc32", "group_size", "n_bytes", "n_removed", "n_spans", "n_chars"}
    assert all(t == "bigint" for c, t in out.dtypes if c in longs)


def test_native_query_runs_no_python(spark, tables):
    plan = queries.QUERIES["op6_progressive_refinement"](spark, tables)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "MapIn"))
