import duckdb
import pytest

import corpus_pipeline
from forecourt.llm.common import ORACLE, QUERIES, ready
from forecourt.llm.pieces import decoded, default_model
from forecourt.llm.queries import QUERIES as REGISTERED

FOLDER = "/root/testdata/sf0.001"


def test_queries_are_the_thirteen_and_the_pipeline():
    from __spark_entry__ import oracle_sql, queries

    mine = {k for k in queries() if k.startswith("op") and k[2].isdigit() or k == "pipeline"}
    assert sorted(int(k[2:].split("_")[0]) for k in mine - {"pipeline"}) == list(range(1, 14))
    assert set(REGISTERED) == mine - {"pipeline"} and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        db.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cursor = db.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(cursor.fetchall())


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = ready(spark).read.parquet(f"{FOLDER}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        rows = docs.collect()
        assert len({r["doc_id"] for r in rows}) == len(rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            now = {r["doc_id"]: r["text"] for r in rows}
            assert now.keys() <= before.keys()
            assert all(len(t) <= len(before[i]) for i, t in now.items())
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
            seen.append((len(before) - len(now), sum(before[i] != t for i, t in now.items())))
            before = now
            docs = spark.createDataFrame(rows, docs.schema)
        else:
            assert {r["doc_id"] for r in rows} == before.keys() and all(r["round_trip"] for r in rows)
            assert {r["doc_id"]: r["text"] for r in decoded(docs, default_model()).collect()} == before
            assert all(len(r["ids"]) == r["n_tokens"] for r in rows)
    (quality, a), (near, b), (_, cut), (_, clean) = seen
    assert quality > 0 and near > 0 and a == b == 0 and cut > 0 and clean > 0
    assert corpus_pipeline.run(spark, FOLDER).count() == len(before)


def test_stages_take_an_empty_table_and_nulls(spark):
    docs = ready(spark).read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, None, "en", "s", 0), (-2, "", None, None, None)], docs.schema)
    for given, most in ((docs, 0), (odd, 3)):
        for _, stage in corpus_pipeline.STAGES:
            given = stage(spark, given, FOLDER)
            assert given.count() <= most


def test_small_blocks_buckets_and_chunks_change_nothing(spark, monkeypatch):
    """The same rows where blocks, buckets, chunks and sub-batches split as they do on large tables."""
    from functools import partial

    from forecourt.llm import pieces, quality, simhash

    rows = lambda: sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select("doc_id", "n_tokens", "ids_sha256").collect()))
    whole = rows()
    monkeypatch.setattr(corpus_pipeline, "deduplicate", partial(corpus_pipeline.deduplicate, block_bytes=20_000, bucket_bytes=15_000))
    monkeypatch.setattr(simhash, "links", partial(simhash.links, chunk=5))
    for module in (pieces, quality, simhash):
        monkeypatch.setattr(module, "TOGETHER", 5_000)
    assert rows() == whole and len(whole) > 100
