"""A third of all rows equal: every operator that deals rows out spreads them."""

import random

import pytest
from pyspark.sql import functions as F

from hopscan.llm import bpe_chunks, mixing, token_files, topk
from tests.llm.conftest import DOCUMENTS, sentence

N = 1800


@pytest.fixture(scope="module")
def third(spark):
    rng = random.Random(8)
    same = sentence(rng, 12)
    rows = [(7, same, "en", "s", 0) if i % 3 == 0 else (i, sentence(rng, 12), "en", "s", 0) for i in range(N)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(6)


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_blocks_of_a_source(third):
    p = mixing.plan(third)
    blocks = sorted(r["count"] for r in p.rows.groupBy("s", "block").count().collect())
    assert len(blocks) == -(-N // mixing.BLOCK_ROWS) and blocks[-1] < 1.5 * N / len(blocks)
    assert {r.copy for r in p.rows.filter("doc_id = 7").collect()} >= set(range(N // 3))


def test_ranges_of_texts(third):
    assert sizes(bpe_chunks.route(third.select("doc_id", "text"), 8))[-1] < 2 * N / 8


def test_token_files_of_equal_rows(third, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_TEXT_BYTES", 1 << 13)
    files = token_files.write_token_files(third)
    per = third.sparkSession.read.parquet(files.index).count()
    assert len(files.paths) > 8 and per >= 1
    got = token_files.token_file_rows(third).collect()
    assert len(got) == N and sum(r.doc_id == 7 for r in got) >= N // 3
    ends = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))


def test_query_blocks_of_one_id(spark):
    rows = spark.range(N).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("vec_id"), F.array("id", "id").alias("v"))
    blocks = topk._query_blocks(rows.repartition(4), 4).collect()
    assert sorted(len(b["ids"]) // 8 for b in blocks)[-1] < 1.3 * N / 4 and sum(len(b["ids"]) // 8 for b in blocks) == N
