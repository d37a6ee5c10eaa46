"""Sources and sinks. Files are derived from the tables, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.framework import CONFIG, R, Inputs, check
from checks.views import TIMEPOINTS
from hopscan.config import SITE
from hopscan.operators import reads as rd, sites as st
from hopscan.plans.release import release
from hopscan.plans.scoring import score_no_replicates, score_replicates
from hopscan.session import checkpointed
from hopscan.sources import alignments as al, genome as gn, raw_reads as rr, sinks as sk, tables as tb

SAMPLES = ("S0", "S1", "S2")
LABELS = [(s, t) for s in SAMPLES for t in TIMEPOINTS]

_SHEET = """select Sample, Timepoint, 'wt' as Condition, concat(Sample,'_',Timepoint,'_R1.fastq.gz') as read1,
 concat(Sample,'_',Timepoint,'_R2.fq.gz') as read2 from v_reads group by Sample, Timepoint"""


@check("read_sample_sheet", _SHEET)
def _(s: Inputs) -> DataFrame:
    path = f"{s.scratch}/sheet.tsv"
    sk.write_table(s.sql(_SHEET), path)
    return tb.read_sample_sheet(s.spark, path)


@check("read_alignments", """
select split_part(line,chr(9),1) as qname, cast(split_part(line,chr(9),2) as int) as flag, split_part(line,chr(9),3) as rname,
 cast(split_part(line,chr(9),4) as bigint) as pos, cast(split_part(line,chr(9),5) as int) as mapq, split_part(line,chr(9),6) as cigar,
 split_part(line,chr(9),7) as rnext, cast(split_part(line,chr(9),9) as bigint) as tlen,
 substr(split_part(line,chr(9),12),6) as nm, substr(split_part(line,chr(9),13),6) as md from v_sam""")
def _(s: Inputs) -> DataFrame:
    path = f"{s.scratch}/lines.sam"
    head = s.spark.createDataFrame([("@HD\tVN:1.6",)], "line string")
    # Packed, as the lines are many times larger than the tables they come from.
    s["v_sam"].select("line").unionByName(head).write.option("compression", "lz4").text(path)
    a = al.read_alignments(s.spark, path)
    return a.select("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "tlen",
                    F.col("tags")["NM"].alias("nm"), F.col("tags")["MD"].alias("md"))


@check("read_pairs_parquet", """
select QueryName, Sample, Timepoint, cast(R1_MAPQ as bigint) as R1_MAPQ, R1_Chrom from v_reads
 where R1_MAPQ<>18 or R2_NCIGAR<>1 or R2_MAPQ<>36""")
def _(s: Inputs) -> DataFrame:
    path = f"{s.scratch}/pairs"
    pairs = rd.assemble_pairs(s.alignments, by=("Sample", "Timepoint"))
    tb.write_pairs_parquet(pairs, path)
    back = tb.read_pairs_parquet(s.spark, path)
    return back.select(
        "QueryName", "Sample", "Timepoint",
        F.when(F.col("R1_Chrom").isNull(), F.lit(18)).otherwise(F.col("R1_MAPQ")).alias("R1_MAPQ"),
        F.coalesce("R1_Chrom", "R2_Chrom").alias("R1_Chrom"),
    )


@check("read_count_matrix", "select Chr, Coordinate, Strand, Sample, Timepoint, Reads from v_hard")
def _(s: Inputs) -> DataFrame:
    path = f"{s.scratch}/matrix.tsv"
    sk.write_wide_matrix(s.hard, path, LABELS, key=SITE)
    return tb.read_count_matrix(s.spark, path, SITE)


_CELLS = ", ".join(
    f"max(case when Sample='{a}' and Timepoint='{b}' then Reads end) as {a}_{b}" for a, b in LABELS
)


@check("write_wide_matrix", f"select Chr, Coordinate, Strand, {_CELLS} from v_hard group by 1,2,3")
def _(s: Inputs) -> DataFrame:
    """The matrix as it comes back from its files."""
    path = f"{s.scratch}/wide.tsv"
    sk.write_wide_matrix(s.hard, path, LABELS, key=SITE)
    wide = s.spark.read.option("sep", "\t").option("header", True).csv(path)
    kinds = {c: "string" if c in ("Chr", "Strand") else "bigint" for c in wide.columns}
    return wide.select(*[F.col(f"`{c}`").cast(k).alias(c.replace("#", "_")) for c, k in kinds.items()])


@check("read_delimited", "select cast(p_partkey as string) as p_partkey, p_name, p_type from part")
def _(s: Inputs) -> DataFrame:
    path = f"{s.scratch}/part.csv"
    s.table("part").select("p_partkey", "p_name", "p_type").write.option("header", True).csv(path)
    return tb.read_delimited(s.spark, path)


_ATTRS = "split_part(line,chr(9),9)"
_AFTER = f"substr({_ATTRS}, strpos({_ATTRS},'ID=')+3)"
_OWN = f"split_part({_AFTER},';',1)"
# A transcript number ends the gene id: a dot and a digit before the end or before a colon.
_NUMBERED = f"""list_min([n for n in range(2, length({_OWN})) if substr({_OWN},n,1)='.' and substr({_OWN},n+1,1) between '0' and '9'
 and (n+1=length({_OWN}) or (substr({_OWN},n+2,1)=':' and length({_OWN})>n+2))])"""
_ID = f"""case when strpos({_ATTRS},'ID=')=0 then '' when strpos({_AFTER},';')=0 or {_NUMBERED} is null then {_OWN} else substr({_OWN},1,cast({_NUMBERED} as bigint)-1) end"""
_GFF = f"""
select split_part(line,chr(9),1) as Chr, split_part(line,chr(9),3) as Feature, cast(split_part(line,chr(9),4) as bigint) as Start,
 cast(split_part(line,chr(9),5) as bigint) as End_, split_part(line,chr(9),7) as Strand, {_ID} as Systematic_ID,
 case when split_part(line,chr(9),3) in ('CDS','intron') then regexp_extract(split_part(line,chr(9),9), 'Parent=([^;]+)', 1)
  else regexp_extract(split_part(line,chr(9),9), 'ID=([^:;]+)', 1) end as Transcript from v_gff"""


@check("read_gff3", _GFF)
def _(s: Inputs) -> DataFrame:
    path = f"{s.scratch}/genome.gff3"
    head = s.spark.createDataFrame([("##gff-version 3",)], "line string")
    s["v_gff"].unionByName(head).write.text(path)
    return gn.read_gff3(s.spark, path).select(
        "Chr", "Feature", "Start", F.col("End").alias("End_"), "Strand", "Systematic_ID", "Transcript"
    )


@check("read_fasta_tiles", """
with contigs as (select Chr, string_agg(seq, '' order by tile_start) as seq from v_genome group by 1)
select Chr, x.p as tile_start, cast(500 as bigint) as tile_width, substr(seq, x.p+1, 500) as seq
from contigs, unnest(range(0, length(seq), 500)) x(p)""")
def _(s: Inputs) -> DataFrame:
    path = f"{s.scratch}/genome.fa"
    items = F.array_sort(F.collect_list(F.struct("tile_start", "seq")))
    contigs = s["v_genome"].groupBy("Chr").agg(
        F.array_join(F.transform(items, lambda t: t["seq"]), "").alias("seq")
    )
    # Lines of uneven length: 50 bases, then 7, and so on.
    lines = F.rtrim(F.regexp_replace("seq", "(.{50})(.{0,7})", "$1\n$2\n"), F.lit("\n"))
    contigs.select(F.concat(F.lit(">"), "Chr", F.lit(" contig\n"), lines).alias("value")).write.text(path)
    return gn.read_fasta_tiles(s.spark, path, width=500)


@check("read_chrom_sizes", "select Chr, length from v_sizes")
def _(s: Inputs) -> DataFrame:
    path = f"{s.scratch}/genome.fai"
    s["v_sizes"].selectExpr("Chr", "length", "0 as o", "60 as b", "61 as w").write.option("sep", "\t").csv(path)
    return tb.read_chrom_sizes(s.spark, path)


@check("read_regions", """
select Chr, Start, End_, Systematic_ID, Strand, Type, Feature, Accumulated_CDS_bases, Name, FYPOviability,
 DeletionLibrary_essentiality, ParentalRegion_start, ParentalRegion_end, ParentalRegion_length from v_regions""")
def _(s: Inputs) -> DataFrame:
    path = f"{s.scratch}/regions.bed"
    r = s.regions.withColumnRenamed("Chr", "#Chr").withColumnRenamed("Systematic_ID", "Systematic ID")
    r.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(".")).alias(c) for c in r.columns]).write \
        .option("sep", "\t").option("header", True).csv(path)
    return tb.read_regions(s.spark, path).withColumnRenamed("End", "End_")


@check("read_gene_tables", """
select i.gene_systematic_id, coalesce(i.gene_name, i.gene_systematic_id) as gene_name, v.viability, p.Residues
from v_gene_ids i left join v_viability v on v.systematic_id=i.gene_systematic_id left join v_peptide p on p.Systematic_ID=i.gene_systematic_id""")
def _(s: Inputs) -> DataFrame:
    root = s.scratch
    s["v_viability"].write.option("sep", "\t").csv(f"{root}/viability.tsv")
    sk.write_table(s["v_peptide"], f"{root}/peptide.tsv")
    sk.write_table(s["v_gene_ids"], f"{root}/ids.tsv")
    calls, lengths, ids = tb.read_gene_tables(
        s.spark, f"{root}/viability.tsv", f"{root}/peptide.tsv", f"{root}/ids.tsv"
    )
    return (
        ids.join(calls, ids.gene_systematic_id == calls.systematic_id, "left")
        .join(lengths, ids.gene_systematic_id == lengths.Systematic_ID, "left")
        .select("gene_systematic_id", "gene_name", "viability", "Residues")
    )


@check("read_fastq_pairs", "select name, seq1, qual1, seq2, qual2 from v_fastq")
def _(s: Inputs) -> DataFrame:
    root, fq = s.scratch, s["v_fastq"]
    for mate in (1, 2):
        record = F.concat(
            F.lit("@"), "name", F.lit(f" {mate}:N:0\n"), f"seq{mate}", F.lit("\n+\n"), f"qual{mate}"
        )
        # Read once and thrown away: packing them tightly would cost more than reading them.
        fq.select(record.alias("value")).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED") \
            .text(f"{root}/lib_R{mate}.fastq.gz")
    return rr.read_fastq_pairs(s.spark, f"{root}/lib_R1.fastq.gz", f"{root}/lib_R2.fastq.gz")


def named_files(spark, root: str, column: str) -> list[str]:
    """Gives each file that stands alone in a ``column=name`` folder the name ``name.column``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for found in fs.globStatus(hadoop.Path(f"{root}/{column}=*/part-*")):
        name = found.getPath().getParent().getName().split("=", 1)[1]
        target = hadoop.Path(f"{root}/{name}.{column}")
        fs.rename(found.getPath(), target)
        out.append(target.toString())
    return out


@check("scan_filter_logs", """
with t as (select Sample, Timepoint, Fragment, count(*) as o from v_reads group by all),
 k as (select Sample, Timepoint, Fragment, count(*) as f from v_filt group by all)
select concat(t.Sample,'_',t.Timepoint) as Sample, t.Fragment as Fragment, cast(3 as bigint) as chunks_processed, t.o as original_read_pairs,
 coalesce(k.f,0) as filtered_read_pairs, t.o-coalesce(k.f,0) as removed_read_pairs,
 """ + R("floor(coalesce(k.f,0)*10000/t.o)/10000") + """ as retention_rate,
 concat(t.Sample,'_',t.Timepoint,'.',t.Fragment,'.filtered.parquet') as output_file
from t left join k on t.Sample=k.Sample and t.Timepoint=k.Timepoint and t.Fragment=k.Fragment""")
def _(s: Inputs) -> DataFrame:
    kept = F.coalesce(rd.pair_condition(CONFIG.pair_filter), F.lit(False))
    n = s.reads.groupBy("Sample", "Timepoint", "Fragment").agg(
        F.count(F.lit(1)).alias("o"), st.count_where(kept).alias("f")
    )
    name = F.concat_ws("_", "Sample", "Timepoint")
    rate = F.format_string("%.2f", F.floor(F.col("f") * 10000 / F.col("o")) / 100)
    block = F.concat(
        F.lit("t | ====\nt | FILTERING SUMMARY\nt | ====\nt | Total chunks processed: 3\n"),
        F.lit("t | Original read pairs: "), F.format_number("o", 0),
        F.lit("\nt | Filtered read pairs: "), F.format_number("f", 0),
        F.lit("\nt | Removed read pairs: "), F.format_number(F.col("o") - F.col("f"), 0),
        F.lit("\nt | Overall retention rate: "), rate,
        F.lit("%\nt | Output written to: "), name, F.lit("."), "Fragment", F.lit(".filtered.parquet\n"),
    )
    logs = n.select(name.alias("lib"), block.alias("b")).groupBy("lib").agg(
        F.array_join(F.collect_list("b"), "\n").alias("text")
    )
    root = f"{s.scratch}/logs"
    logs.withColumnRenamed("lib", "log").write.partitionBy("log").option("lineSep", "\n").text(root)
    return rr.scan_filter_logs(s.spark, named_files(s.spark, root, "log"))


_TARGETS = {
    "insertion_level/raw_reads.tsv": "select count(*) from (select distinct Chr, Coordinate, Strand from v_hard) k",
    "insertion_level/LFC.tsv": "select count(*) from v_hard", "insertion_level/baseMean.tsv": "select count(*) from v_hard",
    "insertion_level/normed_counts.tsv": "select count(*) from (select distinct Chr, Coordinate, Strand from v_hard) k",
    "insertion_level/annotations.tsv.gz": "select count(*) from v_ann",
    "insertion_level/insertion_level_fitting_statistics.tsv": "select count(*) from (select distinct Chr, Coordinate, Strand, Sample from v_hard) k",
    "insertion_level/fitting_LFCs.tsv": "select count(*)*5 from (select distinct Chr, Coordinate, Strand, Sample from v_hard) k",
    "insertion_level/fitting_results.tsv": "select 1", "gene_level/fitting_results.tsv": "select 1",
}
_COUNTED = " union all ".join(f"select '{t}' as target, cast(({q}) as bigint) as row_count, true as intact" for t, q in _TARGETS.items())


@check("write_release", _COUNTED)
def _(s: Inputs) -> DataFrame:
    """The branch without replicates, mapped from its plan, written, read again and compared by content."""
    results = score_no_replicates(s.stored_hard, s.stored_ann, CONFIG)
    path = f"{s.scratch}/release"
    written = release(results, s.stored_hard, s.stored_ann, CONFIG, LABELS, path)
    found = checkpointed(sk.verify_release(s.spark, path))
    others = found.filter(~F.col("target").isin(*_TARGETS) & ~F.col("intact")).count()
    if len(written) != 13 or others:
        raise ValueError("a target is missing or was changed")
    return found.filter(F.col("target").isin(*_TARGETS))


_ALL_TARGETS = " union all ".join(f"select '{t}' as target, true as intact" for t in sk.release_manifest(True, True))


@check("write_release_replicates", _ALL_TARGETS)
def _(s: Inputs) -> DataFrame:
    """All seventeen targets of the branch with replicates, by content."""
    results = score_replicates(s.stored_hard, s.stored_ann, CONFIG)
    path = f"{s.scratch}/release"
    release(results, s.stored_hard, s.stored_ann, CONFIG, LABELS, path)
    return sk.verify_release(s.spark, path).select("target", "intact")
