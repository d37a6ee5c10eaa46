"""Read pairs, filters, sites, count tables and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.framework import CONFIG, R, Inputs, check
from checks.views import CUTOFF, TIMEPOINTS
from hopscan.config import SITE
from hopscan.functions import alignment as fa, labels as fl, sequence as fs
from hopscan.operators import (
    name_groups as ng, ordered as od, quality as ql, reads as rd, sites as st, summaries as sm,
)
from hopscan.plans.counts import reads_to_counts
from hopscan.sources.alignments import read_alignments

_SAM = """sam as (select *, split_part(line,chr(9),1) as qname, cast(split_part(line,chr(9),2) as int) as flag, split_part(line,chr(9),3) as rname,
 cast(split_part(line,chr(9),4) as bigint) as pos, cast(split_part(line,chr(9),5) as bigint) as mapq, split_part(line,chr(9),6) as cigar,
 split_part(line,chr(9),7) as rnext, cast(split_part(line,chr(9),9) as bigint) as tlen, substr(split_part(line,chr(9),12),6) as nm from v_sam)"""
_SUM = "list_sum([cast(x as bigint) for x in regexp_extract_all({c}, '(\\d+)[{ops}]', 1)])"


def _len(c: str, ops: str) -> str:
    return "cast(coalesce(" + _SUM.format(c=c, ops=ops) + ",0) as bigint)"


@check("primary_alignments", f"with {_SAM} select qname, flag, pos, cigar from sam where (flag & 2308)=0")
def _(s: Inputs) -> DataFrame:
    return rd.primary_alignments(s.alignments).select("qname", "flag", "pos", "cigar")


@check("cigar_functions", f"""with {_SAM} select cigar, cast(length(regexp_replace(cigar,'[^MIDNSHP=X]','','g')) as bigint) as n_ops,
 {_len('cigar', 'MDN=X')} as reference_length, {_len('cigar', 'MI=X')} as aligned_length, count(*) as n from sam group by cigar""")
def _(s: Inputs) -> DataFrame:
    return s.alignments.groupBy("cigar").agg(F.count(F.lit(1)).alias("n")).select(
        "cigar", *[c.alias(n) for n, c in fa.cigar_functions(F.col("cigar")).items()], "n"
    )


_BITS = {"is_paired": 1, "is_proper": 2, "is_unmapped": 4, "is_reverse": 16, "is_read1": 64,
         "is_read2": 128, "is_secondary": 256, "is_supplementary": 2048}


@check("flag_functions", f"with {_SAM} select flag, "
       + ", ".join(f"(flag & {b})={b} as {n}" for n, b in _BITS.items())
       + ", count(*) as n from sam group by flag")
def _(s: Inputs) -> DataFrame:
    return s.alignments.groupBy("flag").agg(F.count(F.lit(1)).alias("n")).select(
        "flag", *[c.alias(n) for n, c in fa.flag_functions(F.col("flag")).items()], "n"
    )


_PAIR = """
 f as (select *, row_number() over (partition by qname, case when (flag & 64)=64 then 1 else 2 end order by ord) as rn from sam where (flag & 2308)=0),
 a as (select * from f where rn=1 and (flag & 64)=64), b as (select * from f where rn=1 and (flag & 64)=0),
 q as (select distinct qname from f)"""


def _mate(t: str, p: str, flag: str) -> str:
    ops = f"cast(length(regexp_replace({t}.cigar,'[^MIDNSHP=X]','','g')) as bigint)"
    return f"""coalesce({t}.mapq,0) as {p}_MAPQ, case when {t}.cigar is not null then {_len(t + '.cigar', 'MI=X')} end as {p}_LEN,
 coalesce({ops},0) as {p}_NCIGAR, {t}.pos-1 as {p}_Ref_Start, {t}.pos-1+{_len(t + '.cigar', 'MDN=X')} as {p}_Ref_End, {t}.cigar as {p}_CIGAR,
 case when {t}.flag is null then null when ({t}.flag & 16)=16 then '-' else '+' end as {p}_Strand, {t}.rname as {p}_Chrom,
 cast(coalesce({t}.flag,0) as bigint) as {flag}, {t}.nm as {p}_NM"""


_PAIRS = f"""with {_SAM}, {_PAIR}
select q.qname as QueryName, {_mate('a', 'R1', 'R1_Flag')}, {_mate('b', 'R2', 'R2_FLAG')},
 case when (coalesce(a.flag,b.flag) & 2)=2 then 'Yes' else 'No' end as Is_Proper_Pair
from q left join a on a.qname=q.qname left join b on b.qname=q.qname"""


def _pair_columns(p: DataFrame) -> DataFrame:
    cols = ["MAPQ", "LEN", "NCIGAR", "Ref_Start", "Ref_End", "CIGAR", "Strand", "Chrom", "NM"]
    return p.select("QueryName", *[f"R1_{c}" for c in cols], "R1_Flag",
                    *[f"R2_{c}" for c in cols], "R2_FLAG", "Is_Proper_Pair")


@check("assemble_pairs", _PAIRS)
def _(s: Inputs) -> DataFrame:
    return _pair_columns(rd.assemble_pairs(s.alignments))


@check("assemble_grouped_pairs", _PAIRS)
def _(s: Inputs) -> DataFrame:
    """From lines written grouped by name, as an aligner does, in several files and splits."""
    lines = s["v_sam"].repartition(F.split("line", "\t")[0]).sortWithinPartitions("ord")
    lines.select("line").write.text(f"{s.scratch}/grouped.sam")
    return _pair_columns(ng.assemble_grouped_pairs(read_alignments(s.spark, f"{s.scratch}/grouped.sam")))


@check("assemble_scattered_pairs", _PAIRS)
def _(s: Inputs) -> DataFrame:
    """From lines in any order."""
    return _pair_columns(ng.assemble_grouped_pairs(s.alignments.repartition("pos")))


def _null(c: str) -> str:
    return f"case when {c} in ('N/A','NA','') then null else {c} end as {c}"


@check("coerce_sentinels", f"""select QueryName, cast(R1_Ref_Start as double) as R1_Ref_Start, cast(R1_Ref_End as double) as R1_Ref_End,
 R1_MAPQ, R2_MAPQ, R1_NCIGAR, R2_NCIGAR, try_cast(R1_NM as double) as R1_NM, try_cast(R2_NM as double) as R2_NM,
 {_null('R1_SA')}, {_null('R1_XA')}, {_null('R2_SA')}, {_null('R2_XA')}, R1_Chrom, R1_Strand, Is_Proper_Pair from v_reads""")
def _(s: Inputs) -> DataFrame:
    return rd.coerce_sentinels(s.reads).drop("Sample", "Timepoint", "Fragment")


@check("filter_read_pairs", "select * from v_filt")
def _(s: Inputs) -> DataFrame:
    return s.filtered


# Every seventh row lacks something: contig, strand, start or end.
_SPOILED = """select QueryName, Sample, Timepoint, Fragment, case when R1_MAPQ % 7=1 then null else R1_Chrom end as R1_Chrom, case when R1_MAPQ % 7=2 then '*' else R1_Strand end as R1_Strand,
 case when R1_MAPQ % 7=3 then null else R1_Ref_Start end as R1_Ref_Start, case when R1_MAPQ % 7=4 then null else R1_Ref_End end as R1_Ref_End from v_reads"""


@check("valid_insertion_rows", f"""select QueryName, R1_Chrom, R1_Strand from ({_SPOILED}) p
 where R1_Chrom is not null and R1_Ref_Start is not null and R1_Ref_End is not null and R1_Strand in ('+','-')""")
def _(s: Inputs) -> DataFrame:
    return rd.valid_insertion_rows(s.sql(_SPOILED)).select("QueryName", "R1_Chrom", "R1_Strand")


@check("insertion_coordinate", """select QueryName, R1_Chrom as Chr, case when R1_Strand='+' then R1_Ref_Start+4 else R1_Ref_End end as Coordinate,
 R1_Strand as Strand from v_reads""")
def _(s: Inputs) -> DataFrame:
    return rd.with_coordinate(s.reads).select("QueryName", "Chr", "Coordinate", "Strand")


@check("site_count", "select * from v_sites")
def _(s: Inputs) -> DataFrame:
    return s.sites


@check("merge_fragments", "select * from v_merged")
def _(s: Inputs) -> DataFrame:
    return st.merge_fragments(s.sites)


@check("count_insertions", "select * from v_merged")
def _(s: Inputs) -> DataFrame:
    return s.merged


@check("concat_timepoints", "select * from v_counts")
def _(s: Inputs) -> DataFrame:
    return s.counts


@check("concat_samples", "select * from v_hard")
def _(s: Inputs) -> DataFrame:
    return st.concat_samples([s.hard.filter(F.col("Sample") == x) for x in ("S0", "S1", "S2")])


@check("merge_similar_timepoints", """
select Chr, Coordinate, Strand, Sample, case when Timepoint in ('YES0','YES1') then 'YES0' else Timepoint end as Timepoint,
 cast(sum(Reads) as bigint) as Reads from v_counts group by 1,2,3,4,5""")
def _(s: Inputs) -> DataFrame:
    return st.merge_similar_timepoints(s.counts, ("YES0", "YES1"), "YES0", ("YES1",), SITE)


@check("hard_filter", "select * from v_hard")
def _(s: Inputs) -> DataFrame:
    return s.hard


@check("complete_cases", "select * from v_complete")
def _(s: Inputs) -> DataFrame:
    return st.complete_cases(s.hard, key=SITE)


@check("positive_pairs", "select Sample, Timepoint, Chr, Coordinate, Strand, PBL, PBR from v_merged where least(PBL,PBR)>0")
def _(s: Inputs) -> DataFrame:
    return st.positive_pairs(s.merged, "PBL", "PBR").drop("Reads")


@check("semi_keys", """select h.* from v_hard h where exists (select 1 from v_controls c
 where c.Chr=h.Chr and c.Coordinate=h.Coordinate and c.Strand=h.Strand)""")
def _(s: Inputs) -> DataFrame:
    return st.semi_keys(s.hard, s.controls, key=SITE)


_INSIDE = "select distinct Chr, Coordinate, Strand from v_ann where Type<>'Intergenic region' and Distance_to_stop_codon>3"
_FLIP = "case Strand when '-' then '+' else '-' end"


@check("key_intersection", f"""select Chr, Coordinate, {_FLIP} as Strand from v_hard where Sample='S0'
 intersect select Chr, Coordinate, Strand from v_hard where Sample='S1' intersect select Chr, Coordinate, Strand from v_hard where Sample='S2'""")
def _(s: Inputs) -> DataFrame:
    one = s.hard.filter(F.col("Sample") == "S0").withColumn("Strand", fa.flip_strand(F.col("Strand")))
    two = st.key_intersection(one, s.hard.filter(F.col("Sample") == "S1"), SITE)
    return st.key_intersection(two, s.hard.filter(F.col("Sample") == "S2"), SITE)


@check("key_difference", f"select distinct Chr, Coordinate, Strand from v_hard except ({_INSIDE})")
def _(s: Inputs) -> DataFrame:
    from hopscan.operators.scoring import in_gene_keys

    return st.key_difference(s.hard, in_gene_keys(s.ann, 3, SITE), SITE)


@check("union_strands", "select Sample, Timepoint, Chr, Coordinate, Strand, Reads from v_merged")
def _(s: Inputs) -> DataFrame:
    m = s.merged.select("Sample", "Timepoint", *SITE, "Reads")
    return st.union_strands(m.filter(F.col("Strand") == "+"), m.filter(F.col("Strand") == "-"))


_WIDE = ", ".join(f"max(case when Timepoint='{t}' then Reads end) as {t}" for t in TIMEPOINTS)


@check("to_wide", f"select Chr, Coordinate, Strand, Sample, {_WIDE} from v_hard group by 1,2,3,4")
def _(s: Inputs) -> DataFrame:
    return st.to_wide(s.hard, [*SITE, "Sample"], "Timepoint", TIMEPOINTS, "Reads")


@check("to_long", "select Chr, Coordinate, Strand, Sample, Timepoint, Reads from v_hard")
def _(s: Inputs) -> DataFrame:
    wide = st.to_wide(s.hard, [*SITE, "Sample"], "Timepoint", TIMEPOINTS, "Reads")
    return st.to_long(wide, [*SITE, "Sample"])


@check("replicate_sum", """select Chr, Coordinate, Strand, cast(coalesce(sum(case when Timepoint='YES0' then Reads end),0) as bigint) as reads_initial,
 cast(coalesce(sum(case when Timepoint='YES4' then Reads end),0) as bigint) as reads_final from v_hard group by 1,2,3""")
def _(s: Inputs) -> DataFrame:
    return st.replicate_sum(s.hard, "YES0", "YES4", SITE)


@check("reads_to_counts", "select * from v_hard")
def _(s: Inputs) -> DataFrame:
    return reads_to_counts(s.reads, CONFIG)


# --- summaries -------------------------------------------------------------------------------

def _ret(f: str) -> str:
    low = f.lower()
    return f"""sum(case when Fragment='{f}' then 1 else 0 end) as original_read_pairs_{low},
 sum(case when Fragment='{f}' and ok=1 then 1 else 0 end) as filtered_read_pairs_{low}"""


@check("filter_retention", f"""
with k as (select r.Sample, r.Timepoint, r.Fragment, case when f.QueryName is null then 0 else 1 end as ok
  from v_reads r left join v_filt f on f.QueryName=r.QueryName),
 g as (select Sample, Timepoint, {_ret('PBL')}, {_ret('PBR')} from k group by 1,2)
select Sample, Timepoint, """ + ", ".join(
    f"""cast(original_read_pairs_{x} as bigint) as original_read_pairs_{x}, cast(filtered_read_pairs_{x} as bigint) as filtered_read_pairs_{x},
 cast(original_read_pairs_{x}-filtered_read_pairs_{x} as bigint) as removed_read_pairs_{x},
 {R(f'filtered_read_pairs_{x}/original_read_pairs_{x}')} as retention_rate_{x}""" for x in ("pbl", "pbr"))
    + """, cast(original_read_pairs_pbl+original_read_pairs_pbr as bigint) as total_original_pairs,
 cast(filtered_read_pairs_pbl+filtered_read_pairs_pbr as bigint) as total_filtered_pairs,
 """ + R("(filtered_read_pairs_pbl+filtered_read_pairs_pbr)/(original_read_pairs_pbl+original_read_pairs_pbr)", 4)
    + " as overall_retention_rate from g")
def _(s: Inputs) -> DataFrame:
    return sm.filter_retention(s.reads)


@check("site_stats", f"""
with p as (select *, R1_Chrom is not null and R1_Ref_Start is not null and R1_Ref_End is not null and coalesce(R1_Strand in ('+','-'), false) as ok from ({_SPOILED}) z),
 g as (select Sample, count(*) as total_rows, sum(case when ok then 1 else 0 end) as valid_rows, count(distinct case when ok then concat(R1_Chrom,':',cast(case when R1_Strand='+' then R1_Ref_Start+4 else R1_Ref_End end as string)) end) as unique_sites,
  sum(case when ok and R1_Strand='+' then 1 else 0 end) as plus_reads, sum(case when ok and R1_Strand='-' then 1 else 0 end) as minus_reads from p group by 1)
select Sample, total_rows, cast(valid_rows as bigint) as valid_rows, cast(unique_sites as bigint) as unique_sites, cast(plus_reads as bigint) as plus_reads, cast(minus_reads as bigint) as minus_reads,
 cast(total_rows-valid_rows as bigint) as invalid_rows, {R('100.0*valid_rows/total_rows')} as validity_rate from g""")
def _(s: Inputs) -> DataFrame:
    return sm.site_stats(s.sql(_SPOILED), ["Sample"])


@check("merge_summary", f"""
select Sample, Timepoint, cast(count(distinct concat(Chr,':',cast(Coordinate as string))) as bigint) as sites, count(*) as rows, cast(sum(PBL) as bigint) as pbl_reads, cast(sum(PBR) as bigint) as pbr_reads,
 cast(sum(case when PBL>0 and PBR>0 then 1 else 0 end) as bigint) as paired_rows, cast(sum(Reads) as bigint) as total_reads,
 {R('100.0*sum(PBL)/sum(Reads)')} as pbl_share, {R('100.0*sum(PBR)/sum(Reads)')} as pbr_share from v_merged group by 1,2""")
def _(s: Inputs) -> DataFrame:
    return sm.merge_summary(s.merged, ("Sample", "Timepoint"))


@check("hard_filter_summary", f"""
with k as (select Sample, Chr, Coordinate, Strand, max(case when Timepoint='YES0' then Reads end) as r from v_counts group by 1,2,3,4)
select coalesce(Sample,'ALL') as Sample, count(*) as total_insertions, cast(sum(case when r>={CUTOFF} then 1 else 0 end) as bigint) as retained_insertions,
 cast(sum(case when r>={CUTOFF} then 0 else 1 end) as bigint) as removed_insertions, {R(f'100.0*sum(case when r>={CUTOFF} then 1 else 0 end)/count(*)')} as retention_rate
from k group by rollup(Sample)""")
def _(s: Inputs) -> DataFrame:
    return sm.hard_filter_summary(s.counts, "YES0", CUTOFF, SITE)


@check("cutoff_retention", f"""
select Sample, count(*) as original_rows, cast(sum(Reads) as bigint) as original_counts, cast(sum(case when Reads>={CUTOFF} then 1 else 0 end) as bigint) as rows_kept,
 cast(sum(case when Reads>={CUTOFF} then Reads else 0 end) as bigint) as count_kept, {R(f'100.0*sum(case when Reads>={CUTOFF} then 1 else 0 end)/count(*)')} as percentage_rows_kept,
 {R(f'100.0*sum(case when Reads>={CUTOFF} then Reads else 0 end)/sum(Reads)')} as percentage_count_kept from v_counts where Timepoint='YES0' group by 1""")
def _(s: Inputs) -> DataFrame:
    return sm.cutoff_retention(s.counts, "YES0", CUTOFF, SITE)


# --- scalar functions on read columns --------------------------------------------------------

@check("flip_strand", f"select Chr, Coordinate, {_FLIP} as Strand, count(*) as n from v_merged group by 1,2,3")
def _(s: Inputs) -> DataFrame:
    return s.merged.groupBy("Chr", "Coordinate", fa.flip_strand(F.col("Strand")).alias("Strand")).agg(
        F.count(F.lit(1)).alias("n")
    )


@check("reverse_complement", "select name, reverse(translate(seq1,'ACGTacgtNn','TGCAtgcaNn')) as rc from v_fastq")
def _(s: Inputs) -> DataFrame:
    return s["v_fastq"].select("name", fs.reverse_complement(F.col("seq1")).alias("rc"))


@check("case_normalize_id", """select p_partkey, concat(upper(split_part(p_brand,'#',1)),'.',lower(p_type)) as id from part""")
def _(s: Inputs) -> DataFrame:
    raw = F.concat(F.lit("  "), F.regexp_extract("p_brand", "^([^#]*)", 1), F.lit("."), F.col("p_type"), F.lit(" "))
    return s.table("part").select("p_partkey", fl.case_normalize_id(raw).alias("id"))


@check("strip_suffix", "select Timepoint, count(*) as n from v_reads group by 1")
def _(s: Inputs) -> DataFrame:
    named = F.concat("Timepoint", F.lit("_fitted"))
    return s.reads.groupBy(fl.strip_suffix(named, "_fitted").alias("Timepoint")).agg(F.count(F.lit(1)).alias("n"))


@check("split_sample_name", "select Sample, Timepoint, count(*) as n from v_reads group by 1,2")
def _(s: Inputs) -> DataFrame:
    path = F.concat(F.lit("/data/run.1/"), "Sample", F.lit(".x_"), "Timepoint", F.lit("_wt.tsv"))
    parts = fl.split_sample_name(path, TIMEPOINTS)
    return s.reads.groupBy(*[c.alias(n) for n, c in parts.items()]).agg(F.count(F.lit(1)).alias("n"))


# --- order and windows over big groups -------------------------------------------------------

@check("keep_first", """select l_partkey, l_orderkey, l_linenumber, l_quantity from (select *, row_number() over (partition by l_partkey
 order by l_orderkey, l_linenumber, l_quantity, l_extendedprice) as rn from lineitem) t where rn=1""")
def _(s: Inputs) -> DataFrame:
    cols = ["l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return od.keep_first(s.table("lineitem").select(*cols), ["l_partkey"], cols[1:]).drop("l_extendedprice")


@check("rank_sum", f"""select l_returnflag, l_extendedprice, count(*) as n, min(rn) as first_rank, max(rn) as last_rank, {R('sum(rn)')} as ranks
 from (select *, row_number() over (partition by l_returnflag order by l_extendedprice) as rn from lineitem) t group by 1,2""")
def _(s: Inputs) -> DataFrame:
    return od.rank_sum(s.table("lineitem"), ["l_returnflag"], "l_extendedprice")


@check("gini", f"""select l_returnflag, {R('2*sum(rn*q)/(count(*)*sum(q)) - (count(*)+1)/count(*)')} as gini
 from (select l_returnflag, l_quantity as q, row_number() over (partition by l_returnflag order by l_quantity) as rn from lineitem) t group by 1""")
def _(s: Inputs) -> DataFrame:
    return od.gini(s.table("lineitem"), ["l_returnflag"], "l_quantity")


@check("gap_lag", """select l_returnflag, l_orderkey, l_orderkey - lag(l_orderkey) over (partition by l_returnflag order by l_orderkey) as gap
 from (select distinct l_returnflag, l_orderkey from lineitem) t""")
def _(s: Inputs) -> DataFrame:
    return od.gap_lag(s.table("lineitem"), ["l_returnflag"], "l_orderkey", width=1000)


@check("carry_forward", """select event_id, last_value(case when event_type='error' then user_id end ignore nulls)
 over (order by event_id rows between unbounded preceding and current row) as carried from events""")
def _(s: Inputs) -> DataFrame:
    e = s.table("events").select("event_id", F.when(F.col("event_type") == "error", F.col("user_id")).alias("carried"))
    return od.carry_forward(e, "carried", "event_id", width=500)


@check("bh_adjust", f"""
with p as (select l_returnflag, l_orderkey, l_linenumber, l_partkey, l_extendedprice, case when l_linenumber=7 then 1.0 when l_linenumber=6 then null else l_extendedprice/210007.0 end as pvalue from lineitem),
 r as (select *, rank() over (partition by l_returnflag order by pvalue) + count(*) over (partition by l_returnflag, pvalue) - 1 as rk, count(*) over (partition by l_returnflag) as m from p where pvalue is not null),
 a as (select *, least(1.0, min(pvalue*m/rk) over (partition by l_returnflag order by pvalue desc range between unbounded preceding and current row)) as padj from r)
select l_returnflag, l_orderkey, l_linenumber, l_partkey, {R('l_extendedprice')} as l_extendedprice, {R('pvalue')} as pvalue, {R('padj')} as padj from a
union all select l_returnflag, l_orderkey, l_linenumber, l_partkey, {R('l_extendedprice')}, null, null from p where pvalue is null""")
def _(s: Inputs) -> DataFrame:
    n = F.col("l_linenumber")
    p = F.when(n == 7, 1.0).when(n == 6, None).otherwise(F.col("l_extendedprice") / 210007.0)
    rows = s.table("lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", p.cast("double").alias("pvalue")
    )
    return od.bh_adjust(rows, "pvalue", ["l_returnflag"])


@check("ordered_output", """select Chr, Coordinate, Strand, cast(case Chr when 'I' then 2 when 'II' then 3 when 'III' then 4 else 7 end as bigint) as chrom_rank
 from (select distinct Chr, Coordinate, Strand from v_merged) t order by chrom_rank, Coordinate, Strand""")
def _(s: Inputs) -> DataFrame:
    from hopscan.config import CHROMOSOME_ORDER as order

    rows = s.points.withColumn("chrom_rank", od.chromosome_rank(F.col("Chr"), order))
    return od.ordered_output(rows, order, ["Coordinate", "Strand"])


@check("sample_head", """select QueryName, Sample, Timepoint, Fragment, R1_Chrom, R1_Ref_Start from v_reads
order by QueryName desc, Sample, Timepoint, Fragment, R1_Chrom, R1_Ref_Start limit 10""")
def _(s: Inputs) -> DataFrame:
    columns = ["QueryName", "Sample", "Timepoint", "Fragment", "R1_Chrom", "R1_Ref_Start"]
    return od.sample_head(s.reads, 10, [F.desc("QueryName"), *columns[1:]]).select(*columns)


@check("log_histogram", f"""
with v as (select Sample, 'PBL' as "column", log10(PBL) as x from v_merged where PBL>0 union all select Sample, 'PBR', log10(PBR) from v_merged where PBR>0),
 m as (select Sample, "column", min(x) as lo, max(x) as hi from v group by 1,2),
 b as (select v.Sample, v."column", cast(least(floor((x-lo)/(hi-lo)*50), 49) as bigint) as bin, lo, hi from v join m on v.Sample=m.Sample and v."column"=m."column")
select Sample, "column", bin, {R('lo+(hi-lo)/50*bin')} as lower, {R('lo+(hi-lo)/50*(bin+1)')} as upper, count(*) as frequency from b group by all""")
def _(s: Inputs) -> DataFrame:
    return ql.log_histogram(s.merged, ["PBL", "PBR"], 50, ["Sample"])


_CORR = """count(*) as points, {p} as pearson, {r} as r_squared, {s} as slope, {i} as intercept, {e} as rmse""".format(
    p=R("corr(y,x)"), r=R("corr(y,x)*corr(y,x)"), s=R("regr_slope(y,x)"), i=R("regr_intercept(y,x)"),
    e=R("sqrt(greatest(regr_syy(y,x)-regr_slope(y,x)*regr_sxy(y,x),0)/count(*))"))


@check("pair_correlation", f"""select Sample, Timepoint, {_CORR} from (select Sample, Timepoint, log10(PBL) as x, log10(PBR) as y from v_merged where PBL>0 and PBR>0) t group by 1,2""")
def _(s: Inputs) -> DataFrame:
    return ql.pair_correlation(s.merged, "PBL", "PBR", ["Sample", "Timepoint"])


@check("orientation_correlation", f"""select Sample, Timepoint, {_CORR} from (
 select a.Sample, a.Timepoint, log10(a.Reads) as x, log10(b.Reads) as y from v_hard a join v_hard b on a.Sample=b.Sample and a.Timepoint=b.Timepoint and a.Chr=b.Chr and a.Coordinate=b.Coordinate
 and a.Strand='+' and b.Strand='-' where a.Reads>0 and b.Reads>0) t group by 1,2""")
def _(s: Inputs) -> DataFrame:
    return ql.orientation_correlation(s.hard, SITE)


_PROFILE_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LONG = " union all ".join(f"select '{c}' as \"column\", cast({c} as double) as v from lineitem" for c in _PROFILE_COLS)


@check("column_profile", f"""select "column", count(v) as n, {R('avg(v)')} as mean, {R('stddev_samp(v)', 5)} as sd, {R('min(v)')} as min, {R('max(v)')} as max,
 cast(sum(case when v is null then 1 else 0 end) as bigint) as missing, {R('median(v)')} as median from ({_LONG}) t group by 1""")
def _(s: Inputs) -> DataFrame:
    p = ql.column_profile(s.table("lineitem"))
    return p.withColumn("sd", F.round("sd", 5))


@check("column_profile_histogram", f"""with v as ({_LONG}), m as (select "column", min(v) as lo, max(v) as hi from v group by 1)
select v."column", cast(least(floor((v-lo)/(hi-lo)*30), 29) as bigint) as bin, {R('lo+(hi-lo)/30*cast(least(floor((v-lo)/(hi-lo)*30), 29) as bigint)')} as lower,
 {R('lo+(hi-lo)/30*(cast(least(floor((v-lo)/(hi-lo)*30), 29) as bigint)+1)')} as upper, count(*) as frequency
from v join m on v."column"=m."column" group by all""")
def _(s: Inputs) -> DataFrame:
    return ql.column_histogram(s.table("lineitem"))


# --- alignment statistics --------------------------------------------------------------------

_P = "(flag & 2304)=0"
_FLAGS = {
    "total": "true", "primary": _P, "secondary": "(flag & 256)=256", "supplementary": "(flag & 2048)=2048 and (flag & 256)=0",
    "duplicates": "(flag & 1024)=1024", "mapped": "(flag & 4)=0", "primary_mapped": f"{_P} and (flag & 4)=0",
    "paired": f"{_P} and (flag & 1)=1", "read1": f"{_P} and (flag & 65)=65", "read2": f"{_P} and (flag & 129)=129",
    "properly_paired": f"{_P} and (flag & 3)=3 and (flag & 4)=0", "both_mapped": f"{_P} and (flag & 1)=1 and (flag & 12)=0",
    "singletons": f"{_P} and (flag & 9)=9 and (flag & 4)=0",
    "mate_other_contig": f"{_P} and (flag & 1)=1 and (flag & 12)=0 and rnext not in ('=','*') and rnext<>rname",
}


@check("flagstat", f"with {_SAM} select Sample, " + ", ".join(
    f"cast(sum(case when {c} then 1 else 0 end) as bigint) as \"{n}\"" for n, c in _FLAGS.items()) + " from sam group by Sample")
def _(s: Inputs) -> DataFrame:
    return ql.flagstat(s.alignments, ["Sample"])


@check("idxstats", f"""with {_SAM} select rname as Chr, cast(sum(case when (flag & 4)=0 then 1 else 0 end) as bigint) as mapped,
 cast(sum(case when (flag & 4)=4 then 1 else 0 end) as bigint) as unmapped from sam group by 1""")
def _(s: Inputs) -> DataFrame:
    return ql.idxstats(s.alignments)


_SIZES = f"""{_SAM}, z as (select Sample, Timepoint, abs(tlen) as size from sam where (flag & 129)=129 and (flag & 3340)=0 and tlen<>0),
 md as (select Sample, Timepoint, median(size) as med from z group by 1,2)"""


@check("insert_size_metrics", f"""with {_SIZES}
select z.Sample, z.Timepoint, count(*) as pairs, {R('avg(size)')} as mean, {R('stddev_samp(size)')} as sd, min(size) as min, max(size) as max,
 {R('max(med)')} as median, {R('median(abs(size-med))')} as mad from z join md on z.Sample=md.Sample and z.Timepoint=md.Timepoint group by 1,2""")
def _(s: Inputs) -> DataFrame:
    return ql.insert_size_metrics(s.alignments)


@check("insert_size_histogram", f"with {_SIZES} select Sample, Timepoint, size, count(*) as pairs from z group by 1,2,3")
def _(s: Inputs) -> DataFrame:
    return ql.insert_size_histogram(s.alignments)


@check("expand_sample_files", """select s.Sample, s.Timepoint, 'wt' as Condition, f.Fragment from (select distinct Sample, Timepoint from v_reads) s
 cross join (select 'PBL' as Fragment union all select 'PBR') f
 where not exists (select 1 from v_reads r where r.Sample=s.Sample and r.Timepoint=s.Timepoint and r.Fragment=f.Fragment and r.R1_MAPQ>=68 and (r.Sample<>'S1' or r.Timepoint<'YES2' or r.Fragment='PBL'))""")
def _(s: Inputs) -> DataFrame:
    sheet = s.reads.select("Sample", "Timepoint", F.lit("wt").alias("Condition")).distinct()
    lost = (F.col("Sample") == "S1") & (F.col("Timepoint") >= "YES2") & (F.col("Fragment") == "PBR")
    present = s.reads.filter((F.col("R1_MAPQ") >= 68) & ~lost).select("Sample", "Timepoint", "Fragment").distinct()
    return ql.expand_sample_files(sheet, present=present)


@check("qc_rollup", f"""
with a as (select Sample, Timepoint, Fragment, count(*) as pairs from v_reads group by all),
 b as (select Sample, Timepoint, Fragment, count(*) as sites, cast(sum(plus+minus) as bigint) as reads from v_sites group by all)
select coalesce(a.Sample,b.Sample) as Sample, coalesce(a.Timepoint,b.Timepoint) as Timepoint, coalesce(a.Fragment,b.Fragment) as Fragment, pairs, sites, reads
from a full outer join b on a.Sample=b.Sample and a.Timepoint=b.Timepoint and a.Fragment=b.Fragment""")
def _(s: Inputs) -> DataFrame:
    by = ("Sample", "Timepoint", "Fragment")
    a = s.reads.groupBy(*by).agg(F.count(F.lit(1)).alias("pairs")).withColumn("Sample", F.concat("Sample", F.lit("_R1")))
    b = s.sites.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sites"), F.sum(F.col("plus") + F.col("minus")).cast("bigint").alias("reads")
    )
    return ql.qc_rollup([a, b], by, name_suffix="_R[12]$")
