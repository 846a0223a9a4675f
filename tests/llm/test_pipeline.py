"""Each stage of the pipeline against brute force on what the stage before it kept."""

import os

import duckdb
import pytest
from conftest import SMALL
from test_llm import slow_components, slow_shingles

import corpus_pipeline
from spritelake.llm import queries, toxicity
from spritelake.llm.tokens import encoder, vocabulary_path

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SMALL).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
        assert name == "packing" or kept[-1].columns == columns
    ids = [sorted(r.doc_id for r in k.select("doc_id").collect()) for k in kept]
    model = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = docs.select("doc_id", "text").collect()
    assert ids[1] == sorted(r.doc_id for r in rows if model.score((r.text or "").encode()) < toxicity.THRESHOLD) and len(ids[1]) < len(ids[0])
    left = sorted((r.doc_id, r.text) for r in rows if r.doc_id in set(ids[1]))
    firsts = sorted({left[k][0] for k in slow_components([slow_shingles(t) for _, t in left])})
    assert ids[2] == firsts and len(ids[2]) < len(ids[1])
    assert ids[3] == ids[2] and sorted(map(tuple, kept[3].collect())) == sorted(map(tuple, kept[2].collect()))
    encode = encoder(vocabulary_path()).encode
    want = {r.doc_id: len(encode((r.text or "").encode())) // 4 + 1 for r in kept[3].collect()}
    assert {r.doc_id: r["sum(length)"] for r in kept[4].groupBy("doc_id").sum("length").collect()} == want


def test_registered_names():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 11)} == {n.split("_")[0] + "_" for n in names if n.startswith("op")} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


COLUMNS = {
    "op1_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op2_url_rules": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op3_licenses": {"doc_id": "bigint", "path": "string", "license": "string", "how": "string"},
    "op4_ogg": {
        "doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint",
        "media_sha256": "string", "feature": "string",
    },
    "op5_impact_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op8_token_file": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op9_mixing": {"doc_id": "bigint", "source": "string", "slot": "bigint", "mix_position": "bigint"},
    "op10_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
}


def test_registered_queries_return_their_columns_for_whole_tables(spark):
    sizes = {t: spark.read.parquet(f"{SMALL}/{t}.parquet").count() for t in ("documents", "pages")}
    for name, columns in COLUMNS.items():
        found = queries.QUERIES[name](spark, SMALL)
        assert columns.items() <= dict(found.dtypes).items(), name
        n = found.count()
        if name == "op1_packing":
            assert found.select("doc_id").distinct().count() == sizes["documents"] <= n
        elif name != "op5_impact_search":
            assert n == sizes["pages" if "page_id" in columns else "documents"], name


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_registered_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    answer = duck.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in answer.description]
    found = queries.QUERIES[name](spark, SMALL)
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(str, answer.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in found.collect())


def test_mixing_equals_sql_for_sources_that_run_out_at_different_slots(spark, tmp_path):
    data = [(k, s) for k, s in enumerate(s for s, n in {"a": 700, "b": 130, "c": 90, "d": 17, None: 260}.items() for _ in range(n))]
    spark.createDataFrame(data, "doc_id long, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    answer = duck.execute(queries.ORACLE_SQL["op9_mixing"])
    names = [c[0] for c in answer.description]
    rows = answer.fetchall()
    found = queries.QUERIES["op9_mixing"](spark, str(tmp_path)).collect()
    assert len({r["phase"] for r in found}) >= 3 and sorted(map(str, rows)) == sorted(str(tuple(r[c] for c in names)) for r in found)
