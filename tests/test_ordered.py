"""Ranks, quantiles and running values against numpy, with skew and ties."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as stt
from pyspark.sql import functions as F

from conftest import rows
from hopscan.operators import ordered as od


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(400, 1.0), rng.normal(0, 5, 600), [0.0, -0.0, 1e-300, -1e9, 1e9]])
    groups = np.where(np.arange(len(values)) % 3 == 0, "hot", "g" + pd.Series(np.arange(len(values)) % 7).astype(str))
    pdf = pd.DataFrame({"g": groups, "v": values})
    return pdf, spark.createDataFrame(pdf).repartition(5)


def test_exact_quantile(skewed):
    pdf, df = skewed
    got = {r["g"]: (r["m"], r["q"]) for r in od.exact_quantile(df, ["g"], "v", {"m": 0.5, "q": 0.9}).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g][0] == pytest.approx(np.median(part["v"]))
        assert got[g][1] == pytest.approx(np.quantile(part["v"], 0.9))


def test_gini_matches_definition(skewed):
    pdf, df = skewed
    pdf, df = pdf.assign(v=pdf["v"].abs()), df.withColumn("v", F.abs("v"))
    for r in od.gini(df, ["g"], "v").collect():
        x = np.sort(pdf.loc[pdf["g"] == r["g"], "v"].to_numpy())
        n = len(x)
        want = 2 * (np.arange(1, n + 1) * x).sum() / (n * x.sum()) - (n + 1) / n
        assert r["gini"] == pytest.approx(min(1, max(0, want)))


def test_gini_of_zeros_is_zero(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0)], "g string, v long")
    assert od.gini(df, ["g"], "v").first()["gini"] == 0.0


def bh(p):
    p = np.asarray(p, float)
    order = np.argsort(-p)
    n = len(p)
    q = np.minimum.accumulate((p * n / (np.argsort(np.argsort(p, kind="stable"), kind="stable") + 1))[order])
    out = np.empty(n)
    out[order] = np.minimum(q, 1)
    return out


def test_bh_adjust(spark):
    rng = np.random.default_rng(1)
    p = np.unique(np.concatenate([rng.uniform(0, 1, 300), rng.uniform(0, 1e-6, 50), [1.0]]))
    pdf = pd.DataFrame({"id": np.arange(len(p)), "p": rng.permutation(p)})
    df = spark.createDataFrame(pdf).withColumn("p", F.when(F.col("id") < 5, None).otherwise(F.col("p")))
    kept = pdf[pdf["id"] >= 5]
    want = dict(zip(kept["id"], bh(kept["p"])))
    for r in od.bh_adjust(df, "p").collect():
        if r["id"] < 5:
            assert r["padj"] is None
        else:
            assert r["padj"] == pytest.approx(want[r["id"]], rel=1e-12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(stt.lists(stt.integers(-500, 500), min_size=1, max_size=40))
def test_previous_value_any_width(spark, values):
    df = spark.createDataFrame([("a", v) for v in values], "g string, v long")
    got = dict(rows(od.previous_value(df, ["g"], "v", width=37).select("v", "previous")))
    ordered = sorted(set(values))
    assert got == dict(zip(ordered, [None, *ordered]))


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_carry_forward_and_running_max(spark, width):
    data = [(i, v) for i, v in enumerate([None, 4, None, None, 2, None, 9, None])]
    df = spark.createDataFrame(data, "i long, v long")
    got = [v for _, v in rows(od.carry_forward(df, "v", "i", width=width).select("i", "v"))]
    assert got == [None, 4, 4, 4, 2, 2, 9, 9]
    rm = od.running_max(
        df.withColumn("g", F.lit(1)), ["g"], "i", "v", "m", width=width)
    assert [m for _, m in rows(rm.select("i", "m"))] == [None, None, 4, 4, 4, 4, 4, 9]


def test_keep_first_with_a_hot_key(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("k"), (1000 - F.col("id")).alias("o"))
    first = dict(rows(od.keep_first(df, ["k"], ["o"])))
    assert first[1] == 101 and len(first) == 101


def test_results_do_not_depend_on_partitions(skewed):
    _, df = skewed
    one, many = (rows(od.cumulative_counts(df.repartition(n), ["g"], "v").drop("_bucket")) for n in (1, 9))
    assert one == many


def test_null_groups_survive(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    assert rows(od.exact_quantile(df, ["g"], "v", {"m": 0.5})) == [("a", 2.0), (None, 2.0)]


def test_order_and_top(spark):
    df = spark.createDataFrame([("III", 5), ("mating_type_region", 1), ("I", 9), ("zz", 0), ("I", 2)], "Chr string, x long")
    from hopscan.config import CHROMOSOME_ORDER
    got = [tuple(r) for r in od.ordered_output(df, CHROMOSOME_ORDER, ["x"]).collect()]
    assert got == [("I", 2), ("I", 9), ("III", 5), ("mating_type_region", 1), ("zz", 0)]
    assert [r["x"] for r in od.top_depleted(df, "x", 2, ["Chr"]).collect()] == [9, 5]
