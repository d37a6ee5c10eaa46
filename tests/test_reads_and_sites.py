"""Read pairs, filters, sites and the count table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from hopscan.config import SITE, MateThresholds, PairFilter, RunConfig
from hopscan.functions import alignment as al
from hopscan.operators import quality as ql, reads as rd, sites as st, summaries as sm
from hopscan.session import checkpointed
from hopscan.sources.alignments import parse_alignments

PAIR = "R1_MAPQ bigint, R1_NCIGAR bigint, R1_NM string, R1_SA string, R1_XA string, R2_MAPQ bigint, " \
       "R2_NCIGAR bigint, R2_NM string, R2_SA string, R2_XA string, Is_Proper_Pair string"


def pair(**kw):
    base = dict(R1_MAPQ=60, R1_NCIGAR=1, R1_NM="0", R1_SA="N/A", R1_XA=None, R2_MAPQ=60, R2_NCIGAR=1,
                R2_NM="0", R2_SA="", R2_XA="NA", Is_Proper_Pair="YES")
    return tuple((base | kw).values())


@pytest.mark.parametrize("change,kept", [
    ({}, True), ({"R1_MAPQ": 19}, False), ({"R1_NCIGAR": 2}, False), ({"R1_NM": "4"}, False),
    ({"R1_NM": "N/A"}, False), ({"R1_NM": None}, False), ({"R1_SA": "I,1,+"}, False),
    ({"R2_XA": "I,+7"}, False), ({"R2_MAPQ": 39}, False), ({"Is_Proper_Pair": "No"}, False),
    ({"Is_Proper_Pair": "Single_End_Or_Flag_Issue"}, False),
])
def test_pair_filter_each_rule(spark, change, kept):
    df = spark.createDataFrame([pair(**change)], PAIR)
    assert (rd.filter_read_pairs(df).count() == 1) is kept


def test_null_threshold_skips_its_test(spark):
    loose = PairFilter(MateThresholds(None, None, None, False, False), MateThresholds(None, None, None, False, False), False)
    df = spark.createDataFrame([pair(R1_MAPQ=0, R1_NM=None, R1_SA="x", Is_Proper_Pair="No")], PAIR)
    assert rd.filter_read_pairs(df, loose).count() == 1


def test_pair_filter_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "pairs")
    spark.createDataFrame([pair()], PAIR).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = rd.filter_read_pairs(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(R1_MAPQ,20)" in plan.replace(" ", "")


def test_sentinels_become_null_without_ansi_errors(spark):
    df = spark.createDataFrame([("N/A", "12", "oops", "NA"), ("", "N/A", "3", "x")],
                               "R1_NM string, R1_Pos string, R1_MAPQ string, R1_SA string")
    assert rows(rd.coerce_sentinels(df)) == [(None, 12.0, None, None), (None, None, 3, "x")]


LINES = [
    "@HD\tVN:1.6",
    "q1\t83\tI\t101\t60\t5S20M1D10M\t=\t50\t-99\t*\t*\tNM:i:2\tSA:Z:I,5,+;x:y",
    "q1\t99\tII\t201\t60\t30M\t=\t50\t99\t*\t*",
    "q1\t163\tI\t11\t40\t10M\t=\t50\t99\t*\t*\tNM:i:1",
    "q2\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*",
    "q3\t0\tI\t5\t9\t4M\t*\t0\t0\t*\t*",
    "q4\t2113\tI\t5\t9\t4M\t*\t0\t0\t*\t*",
    "q4\t133\tI\t5\t9\t4M\t*\t0\t0\t*\t*",
    "q5\t129\tI\t5\t9\t4M\t*\t0\t0\t*\t*",
]


def test_assemble_pairs(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LINES)], "ord long, line string")
    got = {r["QueryName"]: r for r in rd.assemble_pairs(parse_alignments(df)).collect()}
    assert set(got) == {"q1", "q3", "q5"}
    q1 = got["q1"]
    assert (q1["R1_Ref_Start"], q1["R1_Ref_End"], q1["R1_LEN"], q1["R1_NCIGAR"], q1["R1_Strand"]) == (100, 131, 30, 4, "-")
    assert (q1["R1_NM"], q1["R1_SA"], q1["R2_Ref_End"], q1["Is_Proper_Pair"]) == ("2", "I,5,+;x:y", 20, "Yes")
    q3, q5 = got["q3"], got["q5"]
    assert (q3["R1_MAPQ"], q3["R1_Flag"], q3["R1_Chrom"], q3["Is_Proper_Pair"]) == (0, 0, None, "N/A")
    assert (q5["R1_MAPQ"], q5["R2_Chrom"], q5["Is_Proper_Pair"]) == (0, "I", "No")


def test_a_name_with_most_lines_is_not_gathered(spark):
    flags = (99, 147, 0, 4)  # read 1, read 2, neither, unmapped
    lines = [(i, f"{'*' if i % 10 else f'q{i}'}\t{flags[i // 10 % 4]}\tI\t{i + 1}\t60\t4M\t=\t50\t0\t*\t*") for i in range(3, 4000)]
    df = spark.createDataFrame(lines, "ord long, line string").repartition(6)
    pairs = rd.assemble_pairs(parse_alignments(df))
    got = {r["QueryName"]: r for r in pairs.collect()}
    assert (got["*"]["R1_Pos"], got["*"]["R2_Pos"]) == (3, 11)
    assert len(got) == 1 + sum(i % 10 == 0 and flags[i // 10 % 4] != 4 for i, _ in lines)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "partial_min" in plan.split("Exchange", 1)[1]


def test_coordinate_and_crossed_strands(spark):
    reads = spark.createDataFrame(
        [("S", "t", "PBL", "I", "+", 96, 160), ("S", "t", "PBL", "I", "+", 96, 150),
         ("S", "t", "PBR", "I", "-", 40, 100), ("S", "t", "PBR", "I", None, 40, 100)],
        "Sample string, Timepoint string, Fragment string, R1_Chrom string, R1_Strand string, R1_Ref_Start long, R1_Ref_End long",
    )
    expected = [("S", "t", "I", 100, "+", 0, 0, 0), ("S", "t", "I", 100, "-", 2, 1, 3)]
    assert rows(st.merge_fragments(st.site_count(reads))) == expected
    assert rows(st.count_insertions(reads)) == expected
    total = st.count_insertions(reads).agg(F.sum("Reads")).first()[0]
    assert total == rd.valid_insertion_rows(reads).count()


COUNTS = "Chr string, Coordinate long, Strand string, Sample string, Timepoint string, Reads long"


def counts(spark, data):
    return spark.createDataFrame(data, COUNTS)


def test_absent_timepoint_is_zero_absent_sample_is_missing(spark):
    df = counts(spark, [("I", 1, "+", "A", "t0", 5), ("I", 1, "+", "A", "t1", 2), ("I", 2, "+", "B", "t1", 7)])
    assert rows(st.concat_timepoints(df, ["t0", "t1"])) == [
        ("A", "I", 1, "+", "t0", 5), ("A", "I", 1, "+", "t1", 2), ("B", "I", 2, "+", "t0", 0), ("B", "I", 2, "+", "t1", 7)]


def test_hard_filter_is_per_sample(spark):
    df = counts(spark, [("I", 1, "+", "A", "t0", 8), ("I", 1, "+", "A", "t1", 0), ("I", 1, "+", "B", "t0", 7), ("I", 1, "+", "B", "t1", 99)])
    assert {r["Sample"] for r in st.hard_filter(df, "t0", 8, SITE).collect()} == {"A"}
    with pytest.raises(ValueError):
        st.hard_filter(df, "nope", 8, SITE, timepoints=["t0", "t1"])


def test_complete_cases(spark):
    df = counts(spark, [("I", 1, "+", "A", "t0", 1), ("I", 1, "+", "B", "t0", 1), ("I", 2, "+", "A", "t0", 1)])
    assert {r["Coordinate"] for r in st.complete_cases(df, key=SITE).collect()} == {1}


@pytest.mark.parametrize("drop,expected", [
    (("0h",), {"YES0": 7, "t1": 1}), ((), {"YES0": 7, "0h": 3, "t1": 1}), (("0h", "t1"), {"YES0": 7})])
def test_merge_similar_timepoints(spark, drop, expected):
    df = counts(spark, [("I", 1, "+", "A", "0h", 3), ("I", 1, "+", "A", "YES0", 4), ("I", 1, "+", "A", "t1", 1)])
    out = st.merge_similar_timepoints(df, ["0h", "YES0"], "YES0", drop, SITE)
    assert {r["Timepoint"]: r["Reads"] for r in out.collect()} == expected


def test_round_trip_wide(spark):
    df = counts(spark, [("I", 1, "+", "A", "t0", 5), ("I", 2, "-", "A", "t1", 2)])
    keys = [*SITE, "Sample"]
    wide = st.to_wide(df, keys, "Timepoint", ["t0", "t1"], "Reads")
    assert rows(st.to_long(wide, keys)) == rows(df)


def test_retention_and_site_stats(spark):
    df = spark.createDataFrame(
        [("S", "t", "PBL", *pair()), ("S", "t", "PBL", *pair(R1_MAPQ=None)), ("S", "t", "PBR", *pair(R1_MAPQ=1))],
        "Sample string, Timepoint string, Fragment string, " + PAIR)
    r = sm.filter_retention(df).first()
    assert (r["original_read_pairs_pbl"], r["filtered_read_pairs_pbl"], r["retention_rate_pbr"], r["overall_retention_rate"]) == (2, 1, 0.0, 0.3333)


def test_cigar_helpers(spark):
    df = spark.createDataFrame([("10M",), ("5S10M2I3M1D4N2=1X3H",), ("*",), (None,)], "c string")
    got = rows(df.select(*[c.alias(n) for n, c in al.cigar_functions(F.col("c")).items()]))
    assert (1, 10, 10) in got and (9, 21, 18) in got and got.count((0, 0, 0)) == 2


def test_config_checks():
    with pytest.raises(ValueError):
        RunConfig(timepoints=("a",), initial="b")
    with pytest.raises(ValueError):
        RunConfig(timepoints=("a", "b"), initial="a", generations={"a": 0, "b": 1})


def test_quality_figures_do_not_read_the_pairs_again(spark, tmp_path):
    schema = "Sample string, Timepoint string, Fragment string, R1_Chrom string, R1_Strand string, R1_Ref_Start long, R1_Ref_End long, ok boolean"
    data = [("S", "t", "PBL" if i % 2 else "PBR", None if i % 9 == 0 else "I", "+-"[i % 2], (i % 5) * 10, (i % 5) * 10 + 60, i % 4 > 0) for i in range(200)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "pairs"))
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    table = checkpointed(st.site_table(pairs, F.col("ok")))
    kept = pairs.filter("ok")
    assert rows(st.insertions_of(table)) == rows(st.count_insertions(kept))
    assert rows(sm.site_stats_of(table, ["Sample"])) == rows(sm.site_stats(kept, ["Sample"]))
    for figure in (st.insertions_of(table), sm.site_stats_of(table), sm.retention_of(table)):
        assert not any("/pairs/" in f for f in figure.inputFiles())
    assert sm.retention_of(table).first()["total_filtered_pairs"] == kept.count()


def test_insert_sizes_come_from_one_scan(spark):
    sizes = {("A", "t"): [100, 100, 100, 107, 250, 251], ("B", "t"): [90], (None, "t"): [5, 9]}
    data = [(s, t, 129, v if i % 2 else -v) for (s, t), vs in sizes.items() for i, v in enumerate(vs)] + [("A", "t", 129, 0), ("A", "t", 65, 7)]
    aln = spark.createDataFrame(data, "Sample string, Timepoint string, flag int, tlen long").withColumn("tlen", F.col("tlen") + F.length(F.lit("planted")) - 7)
    df = ql.insert_size_metrics(aln)
    assert "planted" not in df._jdf.queryExecution().logical().toString() and "LocalRelation" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["Sample"], r["Timepoint"]): r for r in df.collect()}
    assert set(got) == set(sizes)
    for k, vs in sizes.items():
        r, v = got[k], np.array(vs, dtype=float)
        middle = np.median(v)
        assert (r["pairs"], r["min"], r["max"]) == (len(v), v.min(), v.max())
        assert [r["mean"], r["median"], r["mad"]] == pytest.approx([v.mean(), middle, np.median(np.abs(v - middle))])
        assert r["sd"] is None if len(v) == 1 else r["sd"] == pytest.approx(v.std(ddof=1))


def test_cigar_lengths(spark):
    known = {"60M": (1, 60, 60), "60S": (1, 0, 0), "7D": (1, 7, 0), "9I": (1, 0, 9), "M": (1, 0, 0), "M60": (1, 0, 0), "60": (0, 0, 0),
             "5H30M2D25M": (4, 57, 55), "10S50M": (2, 50, 50), "*": (0, 0, 0), "": (0, 0, 0), None: (0, 0, 0)}
    df = spark.createDataFrame([(c,) for c in known], "c string")
    assert {r[0]: tuple(r)[1:] for r in df.select("c", *al.cigar_functions(F.col("c")).values()).collect()} == known
