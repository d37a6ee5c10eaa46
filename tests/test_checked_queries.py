"""Registered queries: coverage of the SQL and a few end-to-end comparisons on the small tables."""

import glob
import os
import re

import pytest

import checks
from checks import load_all
from checks.framework import CHECKS
from checks.run import compare, connect

load_all()
SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"fit_curves", "replicate_scores", "score_no_replicates", "score_replicates"}
FEW = ("filter_read_pairs", "merge_fragments", "hard_filter", "boundary_dedup", "impute_opposite_strand", "bh_adjust", "fit_grid")


def test_only_models_lack_sql():
    assert {n for n, c in CHECKS.items() if c.sql is None} == ROWS_ONLY


def test_no_query_has_a_fixed_number_of_parts():
    """A fixed number of partitions makes the tasks grow with the input."""
    for path in glob.glob(os.path.join(os.path.dirname(checks.__file__), "*.py")):
        with open(path) as f:
            assert not re.search(r"repartition\(\d", f.read()), path


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", FEW)
def test_agrees_with_sql(spark, name):
    ok, text = compare(spark, connect(SF), SF, name)
    assert ok, text


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_scoring_inputs_read_the_pairs_once(spark, monkeypatch):
    """Counts and annotation both come from the insertions; worked out from the pairs twice, that was most of the time."""
    from checks import framework
    from hopscan.session import checkpointed

    read = []
    monkeypatch.setattr(framework, "checkpointed", lambda df: read.extend(df.inputFiles()) or checkpointed(df))
    inputs = framework.Inputs(spark, SF)
    assert inputs.stored_hard.count() and inputs.stored_ann.count()
    assert sum("lineitem" in f for f in read) == 1


def test_alignment_files_are_packed_and_read_back(spark, tmp_path):
    """As plain text the derived lines took many times the space of the tables."""
    from datetime import datetime

    from checks.framework import Inputs

    data = [(i // 4, i * 7 % 2000, i % 30, 1 + i % 7, float(i % 50), 900.0 + i, i % 11 / 100, i % 9 / 100, "N", "FO"[i % 2], datetime(1995 + i % 7, 3, 1)) for i in range(4000)]
    spark.createDataFrame(data, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp") \
        .coalesce(2).write.parquet(f"{tmp_path}/lineitem.parquet")
    inputs = Inputs(spark, str(tmp_path))
    inputs.__dict__["scratch"] = f"{tmp_path}/scratch"
    got = CHECKS["read_alignments"].query(inputs)
    lines = [r["line"] for r in inputs["v_sam"].collect()]
    assert sorted(r["qname"] for r in got.collect()) == sorted(x.split("\t")[0] for x in lines)
    stored = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/scratch/**/part-*", recursive=True))
    assert 0 < stored * 2 < sum(len(x) + 1 for x in lines)
