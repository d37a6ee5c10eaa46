"""Groups of near copies far above a block: all links found, each row moved about once."""

import random

import pytest
from pyspark.sql import functions as F

from hopscan.llm import near_dedup
from tests.llm import brute
from tests.llm.conftest import DOCUMENTS


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCUMENTS).repartition(6)


def test_rounds_of_a_large_group_copy_little(spark):
    n = 30_000
    members = spark.range(n).select(F.lit(5).alias("bucket"), F.xxhash64("id").alias("node"), F.lit(n).cast("long").alias("n"))
    first = near_dedup.first_round(members, "bucket", near_dedup.BUCKET_ROWS).persist()
    assert first.count() < 1.1 * n and first.select("node").distinct().count() == n
    blocks = [r["count"] for r in first.groupBy("x").count().collect()]
    assert len(blocks) == 30 and max(blocks) < 1.2 * near_dedup.BLOCK
    assert max(r["count"] for r in first.groupBy("part").count().collect()) < 3 * near_dedup.BUCKET_ROWS
    joined = members.withColumn("label", F.lit(1).cast("long")).drop("n")
    assert near_dedup.second_round(joined, "bucket", 10_000) is None
    few = members.withColumn("label", F.when(F.pmod("node", F.lit(1000)) == 0, F.col("node")).otherwise(1)).drop("n")
    rest = near_dedup.second_round(few, "bucket", near_dedup.CLUSTER_ROWS)
    assert n <= rest.count() < 1.1 * n
    assert max(r["count"] for r in rest.groupBy("x", "y").count().collect()) < 1.3 * near_dedup.BLOCK


def test_twelve_thousand_near_copies_are_one_group(spark):
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(12_000):
        w = list(base)
        w[i % 60] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(50_000 + i, " ".join(f"y{i}a{k}" for k in range(30))) for i in range(50)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows), 80).collect()}
    near = [d for d, _ in rows if d < 12_000]
    assert len({got[d] for d in near}) == 1 and got[0] == 0 and all(got[d] == d for d, _ in rows if d >= 50_000)


@pytest.mark.parametrize("block", [4, 16])
def test_chains_through_blocks_lose_no_link(spark, monkeypatch, block):
    """Groups cut into tiny blocks with few representatives: components as by brute force."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "REPRESENTATIVES", 1)
    rng = random.Random(block)
    rows, text = [], [f"a{k}" for k in range(70)]
    for i in range(120):  # a slow walk: neighbours are near, far ones are not
        text[rng.randrange(70)] = f"b{i}"
        rows.append((1000 - i, " ".join(text)))
    rows += [(5000 + i, " ".join(f"c{k}" if k % 9 else f"d{i % 3}" for k in range(60))) for i in range(40)]
    want, sizes = brute.components(rows, 80)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows), 80).collect()}
    assert [got[d] for d, _ in rows] == want
