"""The pipeline against its stages done by hand, and the registered SQL."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from check import canonical  # noqa: E402
from snapflow.llm import bpe, quality  # noqa: E402
from snapflow.llm.queries import ORACLES, QUERIES  # noqa: E402
from snapflow.session import cut  # noqa: E402

from test_decontam_licenses import plain_shingles  # noqa: E402
from test_jaccard import plain_groups  # noqa: E402
from test_suffix_lines import plain_lines  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = canonical(QUERIES[name](spark, SF).toPandas())
    assert got == canonical(duck.execute(ORACLES[name]).df())


def test_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    given = docs
    for (name, stage), n in zip(corpus_pipeline.STAGES, range(5)):
        out = cut(stage(spark, docs, SF))
        rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        ids = sorted(rows)
        if n == 0:
            scores = {r.doc_id: r.score for r in quality.quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
            want = {d: rows[d] for d in ids if scores[d] >= 0.5}
        elif n == 1:
            left = plain_lines([rows[d] for d in ids], 50)
            want = {d: t for d, t in zip(ids, left) if t == rows[d] or t.strip()}
            assert all(r.n_chars == len(r.text) for r in out.collect())
        elif n == 2:
            groups = plain_groups([rows[d] for d in ids])  # the place of the first of each group
            want = {ids[i]: rows[ids[i]] for i in set(groups)}
            assert len(want) < len(rows)
        elif n == 3:
            asked = [plain_shingles(t) for t in items]
            want = {d: t for d, t in rows.items() if not any(len(a & plain_shingles(t)) >= 0.8 * len(a) for a in asked)}
        if n < 4:
            assert out.columns == given.columns, name
            assert {r.doc_id: r.text for r in out.collect()} == want, name
            assert 0 < len(want) <= len(rows)
            docs = out
    ranks, pattern = bpe_arguments()
    got = {r.doc_id: r.token_ids for r in out.collect()}
    assert got == {d: bpe.encode_text(t, ranks, pattern).tolist() for d, t in rows.items()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == set(got)


def bpe_arguments():
    import public_tokenizers

    return public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN


def test_stages_on_odd_rows(spark):
    odd = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (None, "text without an id", "en", None, None), (None, "another text without an id, quite unlike", "en", None, 3), (2, "w " * 30_000, None, "s", 5)]
    docs = odd.unionByName(spark.createDataFrame(rows + rows[:2], odd.schema)).withColumn("_key", F.lit(1)).withColumn("row", F.lit("x"))
    for data in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            data = cut(stage(spark, data, SF))
            assert data.columns == docs.columns, name
        corpus_pipeline.STAGES[-1][1](spark, data, SF).collect()


CONTRACTS = {
    "op2_warc_bundles": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op3_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_simhash_near_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_chat_formatting": {
        "conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string",
        "formatted_chars": "bigint", "n_tokens": "bigint",
    },
    "op8_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op11_centroid_clustering": {
        "vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string",
    },
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract(spark, name):
    got = QUERIES[name](spark, SF)
    assert dict(got.dtypes) == CONTRACTS[name]
    source = {"op2_warc_bundles": "pages", "op7_chat_formatting": "conversations", "op11_centroid_clustering": "embeddings"}.get(name, "documents")
    rows = spark.read.parquet(f"{SF}/{source}.parquet")
    want = rows.select("conv_id").distinct().count() + 1 if source == "conversations" else rows.count()
    assert got.count() == want


def test_every_operator_has_a_query():
    assert sorted(q.split("_")[0] for q in QUERIES) == sorted(f"op{n}" for n in range(1, 14))
