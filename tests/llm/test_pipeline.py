"""The pipeline's stages on awkward rows, and its whole run against plain versions of the stages."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import (
    SMALL, TEXTS, check_packing, components_plain, frame, print_plain, rows_of,
)
from weighbridge.llm import quality, queries, secret_scan
from weighbridge.llm.common import staged


@pytest.mark.parametrize("rows", [TEXTS, []])
def test_stages_keep_the_columns_of_their_input(spark, rows):
    docs = frame(spark, rows).withColumn("n_chars", F.lit(-1).cast("long"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.schema.names == docs.schema.names, name
        assert out.count() <= docs.count()
        docs = staged(out)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()


def test_secrets_are_masked(spark):
    docs = frame(spark, TEXTS).withColumn("n_chars", F.lit(-1).cast("long"))
    out = {r["doc_id"]: r for r in corpus_pipeline.without_secrets(spark, docs, SMALL).collect()}
    assert out[12]["text"] == "[secret] [secret] [secret]" and out[12]["n_chars"] == 26
    assert out[7]["text"] == "lone" and out[3]["text"] is None


def test_run_against_plain_stages(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    table, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    score = quality.fit(table, labels).scorer()
    docs = [(i, t) for i, t in docs if score(t) >= 0.3]
    first = {}
    for i, t in sorted(docs):
        first.setdefault(normal(t), (i, t))
    docs = sorted(first.values())
    roots = components_plain([print_plain(t) for _, t in docs])
    docs = [d for n, d in enumerate(docs) if roots[n] == n]
    texts = [secret_scan.masked(t, secret_scan.secrets_in(t)[1]) for _, t in docs]
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in docs}
    check_packing(got, texts, 1024)


def normal(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text)


def test_each_query_covers_its_table(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name, query in queries.QUERIES.items():
        if name in ("op3_tree_search", "op6_packing"):
            continue
        if name == "op13_vector_codes":
            assert query(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
            continue
        ids = rows_of(query(spark, SMALL), "doc_id")
        assert sum(ids.values()) == n and set(Counter(ids).values()) == {1}, name
