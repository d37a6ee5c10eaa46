"""Files, logs, release, raw reads and the stream."""

import gzip

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hopscan.config import SITE, Junctions
from hopscan.functions.sequence import trimmed_lengths
from hopscan.operators import fastq as fq, reads as rd
from hopscan.operators.sites import site_count
from hopscan.sources import alignments as al, genome as gn, raw_reads as rr, sinks as sk, tables as tb
from hopscan.streaming.site_counts import incremental_site_count, running_site_counts


def write(path, text):
    path.write_text(text)
    return str(path)


def test_sample_sheet_checks(spark, tmp_path):
    head = "Sample\tTimepoint\tCondition\tread1\tread2\n"
    good = write(tmp_path / "a.tsv", head + "S\tt0\twt\ta_1.fq.gz\ta_2.fastq.gz\n")
    assert tb.read_sample_sheet(spark, good).count() == 1
    bad = write(tmp_path / "b.tsv", head + "S\tt0\twt\ta_1.fq\ta_2.fastq.gz\n")
    for columns in (("Sample", "read1"), ("read1",), ("Timepoint",)):
        with pytest.raises(Exception, match="bad sample sheet row"):
            tb.read_sample_sheet(spark, bad).select(*columns).collect()


def test_alignments_of_two_libraries_stay_apart(spark, tmp_path):
    def line(name, flag, pos):
        return f"{name}\t{flag}\tI\t{pos}\t60\t50M\t=\t{pos + 100}\t150\t*\t*\tNM:i:0\n"

    folder = tmp_path / "sam"
    folder.mkdir()
    for sample, pos in (("A", 10), ("B", 900)):
        text = line("r1", 99, pos) + line("r1", 99, pos + 5) + line("r1", 147, pos + 100)
        write(folder / f"{sample}.x_YES0_.sam", text)
    aln = al.read_alignments(spark, str(folder), timepoints=("YES0",))
    pairs = rd.assemble_pairs(aln, by=("Sample", "Timepoint"))
    got = {(r["Sample"], r["Timepoint"], r["R1_Ref_Start"]) for r in pairs.collect()}
    assert {(s, t, str(p)) for s, t, p in got} == {("A", "YES0", "9"), ("B", "YES0", "899")}


def test_derived_lines_are_computed_once(spark):
    fields = ["concat('planted', id)", "67", "'I'", "id", "60", "'50M'", "'='", "0", "150", "'*'", "'*'", "'NM:i:0'"]
    line = f"case when id = 0 then '@HD' else concat_ws(chr(9), {', '.join(fields)}) end as line"
    parsed = al.parse_alignments(spark.range(4).selectExpr(line, "id as ord", "'A' as Sample"))
    kept = parsed.filter((F.col("flag") == 67) & (F.col("tlen") != 0))
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("planted") == 1
    assert rows(kept.select("qname", "ord")) == [(f"planted{i}", i) for i in (1, 2, 3)]


def test_broken_fastq_records_are_reported(spark, tmp_path):
    import gzip

    good = "@a\nACGT\n+\nIIII\n"
    for name, text in (("plus", "@a\nACGT\nACGT\nIIII\n"), ("short", "@a\nACGT\n+\nIII\n"), ("shift", "ACGT\n+\nIIII\n@b\n")):
        path = str(tmp_path / f"{name}.fq.gz")
        with gzip.open(path, "wt") as f:
            f.write(good + text)
        with pytest.raises(Exception, match="broken read record"):
            rr.read_fastq(spark, path, 1).collect()


def _marked(*files):
    """Lines of files as a task gets them: the path before every first of four lines and after every fourth."""
    lines = [(file, line) for file, text in files for line in text.split("\n")[:-1]]
    return [f"{f}\n{t}" if i % 4 == 0 else f"{t}\n{f}" if i % 4 == 3 else t for i, (f, t) in enumerate(lines)]


@pytest.mark.parametrize("size", [1, 3, 4, 7, 100])
def test_records_of_several_files_in_a_task(size):
    import pyarrow as pa

    def run(*files):
        lines = _marked(*files)
        batches = [pa.RecordBatch.from_arrays([pa.array(lines[i: i + size])], names=["value"]) for i in range(0, len(lines), size)]
        return [tuple(r.values()) for b in rr._records(iter(batches)) for r in b.to_pylist()]

    one, two = "@a/1 x/2\nACGT\n+\n@III\n", "@b/1/2\nÄC\n+b\n++\n@ c\n\n+\n\n@d\x0b/1\nA\n+\nI\n"
    want = [("a", "ACGT", "@III"), ("b/1", "ÄC", "++"), ("", "", ""), ("d", "A", "I")]
    assert run(("f", one), ("f2", two)) == want and run(("f2", two), ("f", one)) == want[1:] + want[:1]
    # Three lines and a fourth of another file look like a record.
    with pytest.raises(ValueError, match="incomplete read record at the end of f$"):
        run(("f", one + "@c\nACGT\n+\n"), ("f2", "@abc\n"))
    with pytest.raises(ValueError, match="incomplete read record at the end of f2$"):
        run(("f", one), ("f2", "@c\nACGT\n"))
    with pytest.raises(ValueError, match="broken read record '@c' in f2$"):
        run(("f", one), ("f2", "@c\nACGT\n+\nI\n"))


def test_fastq_lines_carry_no_path(spark, tmp_path):
    """A path with every line is most of what a reader would send to Python."""
    for i in range(40):
        with gzip.open(tmp_path / f"{i}_R1.fq.gz", "wt") as f:
            f.writelines(f"@r{i}.{j}/1\nACGT\n+\n@III\n" for j in range(i + 1))
    df = rr.read_fastq(spark, str(tmp_path), 1)
    assert sorted(tuple(r) for r in df.collect()) == sorted((f"r{i}.{j}", "ACGT", "@III") for i in range(40) for j in range(i + 1))
    node = df._jdf.queryExecution().optimizedPlan()
    while not node.nodeName().startswith("MapIn"):
        node = node.children().head()
    assert node.children().head().output().size() == 1


def test_uneven_fasta_lines(spark, tmp_path):
    path = write(tmp_path / "u.fa", ">c one\nACGTAC\nGG\nTTTTTT\n>d\nA\n\nCC\n")
    got = {(r["Chr"], r["tile_start"], r["seq"]) for r in gn.read_fasta_tiles(spark, path, width=4).collect()}
    assert got == {("c", 0, "ACGT"), ("c", 4, "ACGG"), ("c", 8, "TTTT"), ("c", 12, "TT"), ("d", 0, "ACC")}


@pytest.mark.parametrize("text", [
    "Sample\t\t\tA\tA\nTimepoint\t\t\tt0\tt1\nChr\tCoordinate\tStrand\t\t\nI\t5\t+\t3\t\nI\t6\t-\t\t4.0\n",
    "Chr\tCoordinate\tStrand\tA#t0\tA#t1\nI\t5\t+\t3\t\nI\t6\t-\t\t4\n",
])
def test_count_matrix_headers(spark, tmp_path, text):
    path = write(tmp_path / "m.tsv", text)
    assert rows(tb.read_count_matrix(spark, path, SITE)) == [("I", 5, "+", "A", "t0", 3), ("I", 6, "-", "A", "t1", 4)]


def test_unknown_extension(spark):
    with pytest.raises(ValueError):
        tb.read_delimited(spark, "/x/y.xlsx")


def test_fasta_tiles_and_recut(spark, tmp_path):
    seq = "ACGTTGCAAC" * 7 + "GGG"
    wrapped = "\n".join(seq[i:i + 10] for i in range(0, len(seq), 10))
    path = write(tmp_path / "g.fa", f">I first\n{wrapped}\n>II\nTTTT\n")
    tiles = gn.read_fasta_tiles(spark, path, width=30)
    assert rows(tiles.select("Chr", "tile_start", "seq")) == [("I", 0, seq[:30]), ("I", 30, seq[30:60]), ("I", 60, seq[60:]), ("II", 0, "TTTT")]
    again = rows(gn.fixed_tiles(tiles, 25))
    assert "".join(s for c, _, s in again if c == "I") == seq and all(len(s) <= 25 for *_, s in again)


def test_fastq_pairs(spark, tmp_path):
    for mate in (1, 2):
        with gzip.open(tmp_path / f"x_R{mate}.fq.gz", "wt") as f:
            f.writelines(f"@r{i}/{mate} extra\nACGT{mate}\n+\n@III{mate}\n" for i in range(25_000))
    df = rr.read_fastq_pairs(spark, str(tmp_path / "x_R1.fq.gz"), str(tmp_path / "x_R2.fq.gz"))
    assert df.count() == 25_000
    assert tuple(df.filter("name = 'r24999'").first()) == ("r24999", "ACGT1", "@III1", "ACGT2", "@III2")
    with pytest.raises(ValueError):
        rr.read_fastq_pairs(spark, "a.fq", "b.fq.gz")


def test_filter_logs(spark, tmp_path):
    def block(f, n):
        return (f"x | ====\nx | FILTERING SUMMARY\nx | ====\nx | Total chunks processed: 2\nx | Original read pairs: {n:,}\n"
                f"x | Filtered read pairs: 1,000\nx | Removed read pairs: {n - 1000:,}\nx | Overall retention rate: 50.25%\n"
                f"x | Output written to: out/S.{f}.filtered.parquet\n")
    write(tmp_path / "S1.log", "noise\n" + block("PBL", 2000) + "more\n" + block("PBR", 1_234_567))
    write(tmp_path / "S2.log", "nothing here\n")
    parsed = rr.scan_filter_logs(spark, str(tmp_path))
    assert rows(parsed.select("Sample", "Fragment", "original_read_pairs", "retention_rate")) == [("S1", "PBL", 2000, 0.5025), ("S1", "PBR", 1234567, 0.5025)]
    assert rr.log_totals(parsed).first()["total_original_pairs"] == 1236567


def test_release_manifest_and_missing_tables(spark, tmp_path):
    assert len(sk.release_manifest(True, True)) == 17 and len(sk.release_manifest(False, False)) == 5
    with pytest.raises(ValueError, match="raw_reads"):
        sk.write_release({}, str(tmp_path), False, False)


def walk(qual, cutoff=15):
    best, cut, total = 0, len(qual), 0
    for i in range(len(qual) - 1, -1, -1):
        total += cutoff - (ord(qual[i]) - 33)
        if total < 0:
            break
        if total > best:
            best, cut = total, i
    return cut


def test_quality_trimming_against_a_plain_walk():
    import random
    rng = random.Random(1)
    quals = ["".join(rng.choice("#+05:?I") for _ in range(rng.randrange(0, 40))) for _ in range(500)] + ["", "####", "IIII"]
    assert list(trimmed_lengths(quals, 15, 33)) == [walk(q) for q in quals]


def test_junction_labels(spark):
    j = Junctions()
    body = "ACGTACGTACGTACGTACGT"
    one_off = j.pbl[10:20] + "A" + j.pbl[21:]
    reads = [("whole", j.pbl + body), ("tail", j.pbl[-15:] + body), ("short", j.pbl[-14:] + body), ("pbr", j.pbr + body), ("edit", one_off + body), ("none", body * 3)]
    df = spark.createDataFrame([(n, s, "I" * len(s)) for n, s in reads], "name string, seq1 string, qual1 string")
    got = {r["name"]: (r["junction"], r["seq1"]) for r in fq.junction_classify(df).collect()}
    assert got["whole"] == ("PBL", body) and got["pbr"] == ("PBR", body) and got["tail"][0] == "PBL"
    assert got["edit"] == ("PBL", body) and got["short"][0] == got["none"][0] == "unknown"


def test_junctions_with_edits_on_both_mates(spark):
    import random
    rng, j = random.Random(4), Junctions()
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))

    def edited(s, kind):
        p = rng.randrange(6, len(s) - 6)
        return {0: s, 1: s[:p] + rng.choice([c for c in "ACGT" if c != s[p]]) + s[p + 1:], 2: s[:p] + rng.choice("ACGT") + s[p:], 3: s[:p] + s[p + 1:]}[kind]

    data, want = [], {}
    for i in range(240):
        name, front, back = (("PBL", j.pbl, j.pbl_reverse), ("PBR", j.pbr, j.pbr_reverse))[i % 2]
        lead, body, mate = dna(rng.randrange(12)), dna(50), dna(40)
        s1, s2 = lead + edited(front, i % 4) + body, mate + edited(back, i // 4 % 4) + dna(rng.randrange(8))
        data.append((i, s1, "I" * len(s1), s2, "I" * len(s2)))
        want[i] = (name, body, mate)
    df = spark.createDataFrame(data, "i int, seq1 string, qual1 string, seq2 string, qual2 string")
    got = {r["i"]: (r["junction"], r["seq1"], r["seq2"]) for r in fq.junction_classify(df).collect()}
    assert got == want


def test_adapters_with_edits(spark):
    j = Junctions()
    body, a = "ACGTTGCAACGTTGCAGGCA", j.adapter_r1
    reads = {"whole": body + a + "TT", "cut": body + a[:6], "edit": body + a[:8] + "A" + a[9:], "tail": body + a[:7] + "G" + a[8:14], "none": body}
    df = spark.createDataFrame([(n, s, "I" * len(s)) for n, s in reads.items()], "name string, seq1 string, qual1 string")
    got = {r["name"]: (r["seq1"], len(r["qual1"])) for r in fq.adapter_trim(df).collect()}
    assert set(got.values()) == {(body, len(body))}


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    schema = "Sample string, Timepoint string, Fragment string, R1_Chrom string, R1_Strand string, R1_Ref_Start long, R1_Ref_End long"
    data = [("S", "t", "PBL" if i % 2 else "PBR", "I", "+-"[i % 2], (i % 5) * 10, (i % 5) * 10 + 60) for i in range(100)]
    src, folder = spark.createDataFrame(data, schema), str(tmp_path / "in")
    src.limit(60).write.mode("append").parquet(folder)
    out = str(tmp_path / "out")
    args = (spark, folder, src.schema, str(tmp_path / "cp"), out)
    incremental_site_count(*args).awaitTermination()
    src.limit(40).write.mode("append").parquet(folder)
    incremental_site_count(*args, files_per_trigger=1).awaitTermination()
    assert rows(running_site_counts(spark, out)) == rows(site_count(spark.read.parquet(folder)))
