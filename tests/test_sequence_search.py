"""Anchors in reads: the search in bands against a plain alignment, and how often reads go through Python."""

import random

import pytest

from hopscan.functions.sequence import anchor_matches
from hopscan.operators import fastq as fq


def plain(read, anchor, min_overlap, rate):
    """(score, end) by a whole alignment: cells are (score, -edits, cut-off anchor bases)."""
    m = len(anchor)
    column = [(0, 0, j) for j in range(m + 1)]
    best, end = None, 0
    for i, base in enumerate(read, 1):
        new = [(0, 0, 0)]
        for j, letter in enumerate(anchor, 1):
            (s, e, c), hit = column[j - 1], base == letter
            ways = [(s + 1, e, c) if hit else (s - 1, e - 1, c)]
            ways += [(s - 2, e - 1, c) for s, e, c in (column[j], new[j - 1])]
            new.append(max(ways))
        column = new
        s, e, c = column[m]
        if m - c >= min_overlap and -e <= int(rate * (m - c)) and (s, e) >= (0, 0) and (best is None or (s, e) > best):
            best, end = (s, e), i
    return (best[0], end) if best else (0, 0)


@pytest.mark.parametrize("size, least, rate", [(35, 15, 0.1), (49, 15, 0.1), (19, 4, 0.1), (33, 4, 0.1), (20, 3, 0.2), (70, 15, 0.1)])
def test_search_equals_a_whole_alignment(size, least, rate):
    rng = random.Random(size)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))

    def edited(s, k):
        s = list(s)
        for _ in range(k):
            p = rng.randrange(len(s))
            s[p: p + 1] = rng.choice([[], [rng.choice("ACGT")], [s[p], rng.choice("ACGT")]])
        return "".join(s)

    anchor = dna(size)
    reads = ["", anchor, anchor[size - least:], anchor[size - least + 1:]]
    for _ in range(60):
        cut = rng.choice([0, 0, rng.randrange(size - 6)])
        read = dna(rng.choice([0, 0, 2, 9])) + edited(anchor[cut:], rng.randrange(6)) + dna(rng.randrange(8))
        reads += [read, read + edited(anchor, rng.randrange(4)), read[: rng.randrange(len(read))]]
    got = list(zip(*(v.tolist() for v in anchor_matches(reads, anchor, least, rate)), strict=True))
    assert got == [plain(r, anchor, least, rate) for r in reads]


def passes(df):
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_reads_go_through_python_once_a_mate(spark):
    pairs = spark.createDataFrame([("ACGT", "IIII", "ACGT", "IIII")], "seq1 string, qual1 string, seq2 string, qual2 string")
    assert passes(fq.adapter_trim(pairs)) == 1
    labelled = fq.junction_classify(pairs)
    assert passes(labelled) == 2
    # Labels alone need the first mate only.
    assert passes(fq.junction_counts(labelled)) == 1


def test_junctions_of_missing_reads(spark):
    rows = [(1, None, None, None, None), (2, "ACGT", None, "ACGT", None), (3, None, "IIII", None, "IIII"), (4, "ACGTAC", "III#", "ACGT", "IIIIII")]
    pairs = spark.createDataFrame(rows, "i int, seq1 string, qual1 string, seq2 string, qual2 string")
    got = [tuple(r) for r in fq.junction_classify(pairs).orderBy("i").collect()]
    assert got == [(1, None, None, None, None, "unknown"), (2, "", None, "", None, "unknown"), (3, None, "IIII", None, "", "unknown"),
                   (4, "ACG", "III", "ACGT", "IIII", "unknown")]
