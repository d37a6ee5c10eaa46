"""Intervals, annotation, regions and identifiers."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hopscan.config import INTERGENIC, SITE
from hopscan.functions import labels as fl
from hopscan.operators import annotation as an, identifiers as idn, intervals as iv, regions as rg

POINT = "Chr string, Coordinate long, Strand string"
REGION = ("Chr string, Start long, End long, Strand string, Type string, Feature string, Systematic_ID string, "
          "Accumulated_CDS_bases long, ParentalRegion_start long, ParentalRegion_end long, ParentalRegion_length long")


@pytest.fixture(scope="module")
def regions(spark):
    return spark.createDataFrame([
        ("I", 0, 100, "+|-", INTERGENIC, "x", "gap", None, 0, 100, 100),
        ("I", 100, 160, "+", "Coding gene", "CDS", "G1", 0, 100, 200, 100),
        ("I", 160, 200, "+", "Coding gene", "CDS", "G1", 60, 100, 200, 100),
        ("I", 200, 300, "-", "Non-coding gene", "tRNA", "G2", None, 200, 300, 100),
    ], REGION)


@pytest.mark.parametrize("width", [7, 10_000])
def test_points_match_both_ends(spark, regions, width):
    pts = spark.createDataFrame([("I", 100, "+"), ("I", 160, "-"), ("I", 205, "+"), ("II", 5, "+"), ("I", 999, "+")], POINT)
    got = rows(an.annotate_points(pts, regions, width).select("Coordinate", "Systematic_ID", "Start_Interval"))
    assert got == [(100, "G1", 100), (100, "gap", 0), (160, "G1", 100), (160, "G1", 160), (205, "G2", 200)]


def test_positions_inside_a_gene(spark, regions):
    pts = spark.createDataFrame([("I", 110, "+"), ("I", 170, "-"), ("I", 50, "+"), ("I", 205, "+")], POINT)
    got = {r["Coordinate"]: r for r in an.annotate_points(pts, regions).collect()}
    a = got[110]
    assert (a["Distance_to_start_codon"], a["Distance_to_stop_codon"], a["Fraction_to_start_codon"]) == (10.0, 90.0, 0.1)
    assert (a["Residue_affected"], a["Residue_frame"], a["Insertion_direction"]) == (4.0, 1.0, "Forward")
    b = got[170]
    assert (b["Residue_affected"], b["Residue_frame"], b["Insertion_direction"]) == (24.0, 1.0, "Reverse")
    gap, rna = got[50], got[205]
    assert gap["Distance_to_start_codon"] is None and gap["Insertion_direction"] is None and gap["Residue_affected"] is None
    assert (rna["Distance_to_start_codon"], rna["Residue_affected"], rna["Insertion_direction"]) == (95.0, None, "Reverse")


def test_boundary_dedup(spark, regions):
    pts = spark.createDataFrame([("I", 100, "+"), ("I", 160, "+"), ("I", 50, "+"), ("I", 200, "+")], POINT)
    got = rows(an.boundary_dedup(an.annotate_points(pts, regions)).select("Coordinate", "Systematic_ID"))
    # 100: the gene row is on its start codon, the gap row stays; 160: both CDS rows stay;
    # 200: on the stop codon of both genes, so nothing is left.
    assert got == [(50, "gap"), (100, "gap"), (160, "G1"), (160, "G1")]


def test_in_gene_limits_and_modes(spark):
    df = spark.createDataFrame(
        [("I", 1, "+", "Coding gene", 4.0), ("I", 1, "+", "Coding gene", 9.0), ("I", 2, "+", "Coding gene", 4.0), ("I", 3, "+", INTERGENIC, None)],
        POINT + ", Type string, Distance_to_stop_codon double")
    assert an.in_gene_filter(df, 4).count() == 1 and an.in_gene_filter(df, 3).count() == 3
    assert an.in_gene_filter(df, 4, "key", SITE).count() == 2
    with pytest.raises(ValueError):
        an.in_gene_filter(df, 4, "other")


def test_target_sequence_edges(spark):
    tiles = spark.createDataFrame([("I", 0, "acgtACGTTT"), ("I", 10, "AACCGGTTAA"), ("I", 20, "TT")], "Chr string, tile_start long, seq string")
    seq = "acgtACGTTTAACCGGTTAATT".upper()
    pts = spark.createDataFrame([("I", c, "+") for c in range(0, 26)] + [("X", 8, "+")], POINT)
    got = {(r["Chr"], r["Coordinate"]): r["Target"] for r in an.target_sequence(pts, tiles, 10).collect()}
    for c in range(0, 26):
        assert got[("I", c)] == (seq[c - 4:c] if 4 <= c <= len(seq) else "NNNN"), c
    assert got[("X", 8)] == "NNNN"


def random_intervals(n, top, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        s = rng.randrange(0, top)
        out.add((s, min(top, s + rng.randrange(1, 60))))
    return sorted(out)


@pytest.mark.parametrize("width", [25, 1000])
def test_complement_and_features_cover_the_contig(spark, width):
    spans = random_intervals(25, 900, 5)
    f = spark.createDataFrame([("I", s, e) for s, e in spans], "Chr string, Start long, End long")
    sizes = spark.createDataFrame([("I", 1000), ("II", 7)], "Chr string, length long")
    gaps = rows(iv.interval_complement(f, sizes))
    covered = {p for s, e in spans for p in range(s, e)}
    free = [p for c, s, e in gaps if c == "I" for p in range(s, e)]
    assert len(free) == len(set(free)) and set(free) == set(range(1000)) - covered
    assert ("II", 0, 7) in gaps


@pytest.mark.parametrize("width", [13, 5000])
def test_subtract_leaves_nothing_near_coding(spark, width):
    a, b = random_intervals(15, 800, 1), random_intervals(6, 800, 2)
    left = spark.createDataFrame([("I", s, e, f"a{i}") for i, (s, e) in enumerate(a)], "Chr string, Start long, End long, Systematic_ID string")
    right = spark.createDataFrame([("I", s, e) for s, e in b], "Chr string, Start long, End long")
    got = rows(iv.interval_subtract(left, right, 10, width=width))
    barred = {p for s, e in b for p in range(max(0, s - 10), e + 10)}
    for i, (s, e) in enumerate(a):
        pieces = [(x, y) for _, x, y, g in got if g == f"a{i}"]
        assert sorted(p for x, y in pieces for p in range(x, y)) == [p for p in range(s, e) if p not in barred]
        assert len(pieces) == len({x for x, _ in pieces})


@pytest.mark.parametrize("width", [9, 5000])
def test_self_overlap_finds_contained_genes(spark, width):
    spans = [("I", 0, 100, "t1", "g1", "+"), ("I", 20, 40, "t2", "g2", "-"), ("I", 100, 150, "t3", "g3", "+"), ("II", 0, 100, "t4", "g4", "+")]
    df = spark.createDataFrame(spans, "Chr string, Start long, End long, Transcript string, Systematic_ID string, Strand string")
    assert rows(iv.interval_self_overlap(df, width).select("Chr", "Start", "End", "Transcript", "Strand")) == [("I", 20, 40, "t1,t2", "+,-")]


def test_gff_patterns(spark):
    attrs = ["ID=SPAC1.01c.1;Parent=SPAC1.01c", "ID=SPAC1.01c.1:CDS:2;Parent=SPAC1.01c.1", "ID=SPAC1.01c;Name=x", "ID=SPAC9"]
    df = spark.createDataFrame([("mRNA" if i == 0 else "CDS", a) for i, a in enumerate(attrs)], "f string, a string")
    got = [tuple(r) for r in df.select(fl.gff_systematic_id(F.col("a")), fl.gff_transcript(F.col("f"), F.col("a"), ("mRNA",))).collect()]
    assert got == [("SPAC1.01c", "SPAC1.01c.1"), ("SPAC1.01c", "SPAC1.01c.1"), ("SPAC1.01c", None), ("SPAC9", None)]


def test_primary_transcript_rules(spark):
    rows_ = [("g1", t, "CDS", 0, 30, 30, "+") for t in ("g1.2", "g1.1", "g1.3")] + [("g2", "g2.2", "CDS", 0, 31, 31, "+"), ("g3", "g3.1", "CDS", 0, 60, 60, "+")]
    f = spark.createDataFrame(rows_, "Systematic_ID string, Transcript string, Feature string, Start long, End long, Length long, Strand string")
    pep = spark.createDataFrame([("g1", 9), ("g2", 9), ("g3", 9)], "Systematic_ID string, Residues long")
    assert rows(rg.primary_transcript(f, pep).select("Systematic_ID", "Transcript")) == [("g1", "g1.1"), ("g2", "g2.2")]


def test_parental_span_keeps_contigs_apart(spark):
    df = spark.createDataFrame([("I", 0, 5, "Boundary|Boundary"), ("II", 3, 9, "Boundary|Boundary")], "Chr string, Start long, End long, Systematic_ID string")
    assert {(r["Chr"], r["ParentalRegion_start"], r["ParentalRegion_length"]) for r in rg.parental_span(df).collect()} == {("I", 0, 5), ("II", 3, 6)}


def test_resolve_ids_rules(spark):
    ids = spark.createDataFrame([
        ("A.1", "one", "s1, dup", "protein coding gene"), ("A.2", "two", "s2,dup", "protein coding gene"),
        ("A.3", "two", None, "protein coding gene"), ("A.4", None, "one", "protein coding gene"), ("N.1", "nc", "s9", "ncRNA gene"),
    ], "gene_systematic_id string, gene_name string, synonyms string, gene_type string")
    tokens = ["A.1", "one", "two", "dup", "s2", "nc", "zzz", None, "A.4"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t string")
    got = [r[1] for r in rows(idn.resolve_ids(df, "t", ids).select("i", "resolved_id"))]
    assert got == ["A.1", "A.1", None, None, "A.2", "nc", "zzz", None, "A.4"]
    odd = spark.createDataFrame([(" a.4 ",), ("AbC.D",)], "t string")
    assert {r[0] for r in idn.resolve_ids(odd, "t", ids, normalize_case=True).select("resolved_id").collect()} == {"A.4", "ABC.d"}


def test_strip_suffix_is_not_a_character_set(spark):
    df = spark.createDataFrame([("Diploid_fitted",), ("Diploid",)], "c string")
    assert [r[0] for r in df.select(fl.strip_suffix(F.col("c"), "_fitted")).collect()] == ["Diploid", "Diploid"]
