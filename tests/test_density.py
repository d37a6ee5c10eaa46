"""The gene report from segment summaries against its parts, which rank whole groups."""

import math
import random

import pytest

from hopscan.config import SITE
from hopscan.operators import density as dn


@pytest.fixture(scope="module")
def tables(spark):
    """Counts and annotations of genes of many lengths; one holds a third of all insertions, some have one site or none at all."""
    rng = random.Random(4)
    counts, ann, sites = [], [], set()
    genes = [(f"g{i}", 10_000 * i + 500, 10_000 * i + 500 + rng.choice([30, 400, 2048, 7000])) for i in range(1, 12)] + [("long", 200_000, 260_000)]
    for name, start, end in genes:
        for _ in range(1 if name == "g1" else 350 if name == "long" else rng.choice([3, 40, 90])):
            at, strand = rng.randint(start, end), rng.choice("+-")
            if (at, strand) in sites:
                continue
            sites.add((at, strand))
            for sample in "AB":
                for t in ("t0", "t1"):
                    counts.append(("I", at, strand, sample, t, rng.choice([0, 0, 1, 1, 2, 7, 300])))
            ann.append(("I", at, strand, name, name.upper() if name != "g2" else None, "I", start, end, end - start, "+", "viable", "CDS",
                        float(at - start), float(end - at), 0.5, rng.choice(["Forward", "Reverse", None])))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return (spark.createDataFrame(counts, "Chr string, Coordinate long, Strand string, Sample string, Timepoint string, Reads long"),
            spark.createDataFrame(ann, "Chr string, Coordinate long, Strand string, Systematic_ID string, Name string, Chr_Interval string, ParentalRegion_start long, "
                                  "ParentalRegion_end long, ParentalRegion_length long, Strand_Interval string, FYPOviability string, Type string, "
                                  "Distance_to_start_codon double, Distance_to_stop_codon double, Fraction_to_stop_codon double, Insertion_direction string"))


def close(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, (int, float)) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12))


@pytest.mark.parametrize("segment", [64, 2048])
def test_report_equals_its_parts(tables, monkeypatch, segment):
    monkeypatch.setattr(dn, "SEGMENT", segment)
    counts, ann = tables
    report = dn.gene_density_report(counts, ann, "t0", "t1", key=SITE, rounded=False)
    got = {r["Systematic_ID"]: r.asDict() for r in report.collect()}
    rows = dn.in_gene_insertions(counts, ann, "t0", "t1", key=SITE)
    assert len(got) == rows.select("Systematic_ID").distinct().count() > 8
    for part in (dn.gene_density(rows, False), dn.gene_gaps(rows, False), dn.gene_reads(rows, False), dn.gene_strand(rows, False)):
        for r in part.collect():
            mine = got[r["Systematic_ID"]]
            assert all(close(mine[c], v) for c, v in r.asDict().items()), (r, mine)


def test_report_rounds_and_lists(tables):
    counts, ann = tables
    report = dn.gene_density_report(counts, ann, "t0", "t1", key=SITE, lists=True)
    rows = dn.in_gene_insertions(counts, ann, "t0", "t1", key=SITE)
    want = {r["Systematic_ID"]: r.asDict() for r in dn.gene_gaps(rows, lists=True).collect()}
    for r in report.collect():
        assert all(r[c] == v for c, v in want[r["Systematic_ID"]].items())


def test_few_exchanges_after_one_scan(tables):
    counts, ann = tables
    plan = dn.gene_density_report(counts, ann, "t0", "t1", key=SITE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4 and plan.count("FileScan") == 2  # both of the stored segments
    rows = dn.gene_segments(dn.in_gene_insertions(counts, ann, "t0", "t1", key=SITE))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 6
