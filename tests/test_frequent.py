"""Frequent values by summaries, and quality profiles by dense counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hopscan.operators import fastq as fq
from hopscan.operators.frequent import frequent_values


def wanted(rows, share):
    total = Counter(g for g, _ in rows)
    return {(g, v): n for (g, v), n in Counter(rows).items() if n >= share * total[g]}


@pytest.mark.parametrize("share,parts", [(0.01, 7), (0.2, 3), (1.0, 2)])
def test_frequent_values_are_exact(spark, share, parts):
    rng = random.Random(parts)
    rows = [(rng.choice("ab"), f"v{min(int(rng.paretovariate(0.7)), 10**6)}") for _ in range(30_000)]
    rows += [(None, None)] * 50 + [(None, "x")] * 3 + [("c", "only")] + [("a", None)] * 900
    df = spark.createDataFrame(rows, "g string, v string").repartition(parts)
    got = {(r.g, r.v): r.n for r in frequent_values(df, "v", share, ["g"]).collect()}
    assert got == wanted(rows, share)
    flat = [(0, v) for _, v in rows]
    got = {(0, r.v): (r.n, round(r.share, 9)) for r in frequent_values(df, "v", share).collect()}
    assert got == {k: (n, round(n / len(rows), 9)) for k, n in wanted(flat, share).items()}


def test_many_values_of_one_task_survive_pruning(spark):
    """A value that is frequent overall but spread among far more distinct ones than a task may hold."""
    rows = [(f"u{i}",) for i in range(60_000)] + [("hit",)] * 700
    df = spark.createDataFrame(rows, "v string").orderBy(F.xxhash64("v")).coalesce(2)
    assert [(r.v, r.n) for r in frequent_values(df, "v", 0.01).collect()] == [("hit", 700)]


def test_summaries_do_not_grow_with_distinct_values(spark):
    def rows_between(n):
        df = spark.range(n).select(F.concat(F.lit("s"), "id").alias("v")).unionByName(spark.range(n // 5).select(F.lit("hit").alias("v")))
        from hopscan.operators.frequent import ROOM, _summaries
        found = df.coalesce(2).mapInArrow(_summaries([], "v", ROOM * 10), "v string, held long, total long, lost long").collect()
        assert sum(r.total or 0 for r in found) == n + n // 5
        return len(found)

    assert rows_between(100_000) <= 2 * (40 + 1) and rows_between(1000) <= 2 * (40 + 1)


def test_no_rows_and_clashing_names(spark):
    assert frequent_values(spark.createDataFrame([], "g string, v string"), "v", 0.1, ["g"]).count() == 0
    with pytest.raises(ValueError):
        frequent_values(spark.range(1).withColumnRenamed("id", "n"), "n", 0.1)


def test_profile_counts_every_base(spark):
    rng = random.Random(1)
    rows = []
    for i in range(500):
        n = rng.randint(0, 30)
        rows.append((rng.choice([None, "x", "y"]), "".join(rng.choice("ACGTNacR") for _ in range(n)), "".join(chr(33 + rng.randint(0, 41)) for _ in range(n))))
    df = spark.createDataFrame([*rows, ("x", None, None)], "g string, seq1 string, qual1 string").repartition(3)
    got = {(r.g, r.cycle): r for r in fq.base_quality_profile(df, ["g"]).collect()}
    cells = {}
    for g, s, q in rows:
        for i, (b, c) in enumerate(zip(s, q), 1):
            cells.setdefault((g, i), []).append((b, ord(c) - 33))
    assert set(got) == set(cells)
    for key, seen in cells.items():
        r = got[key]
        assert r.bases == len(seen) and r.n_a == sum(b == "A" for b, _ in seen) and r.n_n == sum(b == "N" for b, _ in seen)
        assert r.mean_quality == pytest.approx(sum(q for _, q in seen) / len(seen))
    plan = fq.base_quality_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_profile_refuses_other_offsets(spark):
    df = spark.createDataFrame([("ACGT", "\x20\x20\x20\x20")], "seq1 string, qual1 string")
    with pytest.raises(Exception, match="offset"):
        fq.base_quality_profile(df).collect()


def test_profile_leaves_out_reads_without_bases_in_one_pass(spark):
    rows = [("a", "AC", "I5"), ("a", None, "I"), ("a", "A", None), ("a", "", "I"), ("a", "A", ""), ("b", None, None)]
    df = fq.base_quality_profile(spark.createDataFrame(rows, "g string, seq1 string, qual1 string"), ["g"])
    assert sorted((r.g, r.cycle, r.bases, r.n_a, r.n_c) for r in df.collect()) == [("a", 1, 1, 1, 0), ("a", 2, 1, 0, 1)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan
