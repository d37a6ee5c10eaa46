"""Domain tables derived from the driver tables, in SQL that both engines run unchanged.

A block of consecutive parts plays a gene with its surroundings; a line item plays a read pair
whose site is set by its part. Every view covers its whole source tables, so it grows with them.
Reads lost to depletion get a mapping quality that the pair filter rejects.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

TIMEPOINTS = ("YES0", "YES1", "YES2", "YES3", "YES4")
GENERATIONS = dict(zip(TIMEPOINTS, (0.0, 2.352, 5.588, 9.104, 12.48)))
CUTOFF = 8
BOUNDARY = 80

_FILTER = """R1_MAPQ>=20 and R1_NCIGAR<=1 and try_cast(R1_NM as double)<=3
 and (R1_SA is null or R1_SA in ('N/A','NA','')) and (R1_XA is null or R1_XA in ('N/A','NA',''))
 and R2_MAPQ>=40 and R2_NCIGAR<=10 and try_cast(R2_NM as double)<=15
 and (R2_SA is null or R2_SA in ('N/A','NA','')) and (R2_XA is null or R2_XA in ('N/A','NA',''))
 and lower(Is_Proper_Pair)='yes'"""

# Feature, offsets of its ends in the block, coding bases before it on either strand.
REGION_FEATURES = (("CDS", 150, 330, 0, 270), ("intron", 330, 420, 180, 270), ("CDS", 420, 690, 180, 0))
# Feature, start offset, end, id stem, transcript, id suffix, transcript of the parent.
GFF_FEATURES = (
    ("mRNA", 100, "e2+50", "GENE", ".1", "", ""),
    ("CDS", 150, "w+330", "GENE", ".1", ":CDS:1", ".1"),
    ("intron", 330, "w+420", "GENE", ".1", ":intron:1", ".1"),
    ("CDS", 420, "e2", "GENE", ".1", ":CDS:2", ".1"),
    ("intron", 5, "w+20", "GENE", ".1", ":intron:2", ".1"),
    ("mRNA", 100, "w+740", "GENE", ".2", "", ""),
    ("CDS", 150, "w+330", "GENE", ".2", ":CDS:1", ".2"),
    ("CDS", 420, "case when b % 5 = 0 then e2 else w+450 end", "GENE", ".2", ":CDS:2", ".2"),
    ("lncRNA", 600, "w+1200", "NC", ".1", "", ""),
    ("tRNA", 900, "w+930", "TR", ".1", "", ""),
)

VIEWS: dict[str, str] = {
    "v_reads": """
select concat(cast(l_orderkey as string),':',cast(l_linenumber as string),':',cast(l_partkey as string),':',cast(cast(round(l_extendedprice*100) as bigint) as string)) as QueryName,
 concat('S',cast(l_suppkey % 3 as string)) as Sample, concat('YES',cast(t as string)) as Timepoint,
 case when l_linenumber % 2 = 0 then 'PBL' else 'PBR' end as Fragment,
 case b % 3 when 0 then 'I' when 1 then 'II' else 'III' end as R1_Chrom,
 case when l_linestatus='F' then '+' else '-' end as R1_Strand,
 case when l_linestatus='F' then site-4 else site-60 end as R1_Ref_Start,
 case when l_linestatus='F' then site+56 else site end as R1_Ref_End,
 cast(case when k between 1 and 7 and l_quantity <= (b % 4)*3*t then 5 else 18+5*cast(round(l_discount*100) as int) end as bigint) as R1_MAPQ,
 cast(36+5*cast(round(l_tax*100) as int) as bigint) as R2_MAPQ,
 cast(case when l_linenumber=7 and l_orderkey % 3 = 0 then 2 else 1 end as bigint) as R1_NCIGAR,
 cast(1+(l_linenumber % 4) as bigint) as R2_NCIGAR,
 case when l_orderkey % 40 = 0 then 'N/A' else cast(cast(l_quantity as int) % 5 as string) end as R1_NM,
 cast(cast(l_quantity as int) % 17 as string) as R2_NM,
 case when l_orderkey % 20 = 0 then 'II,100,+,50M,60,0;' else 'N/A' end as R1_SA,
 case when l_orderkey % 21 = 0 then 'I,+7,50M,0;' when l_orderkey % 2 = 0 then '' else 'N/A' end as R1_XA,
 'N/A' as R2_SA, 'N/A' as R2_XA,
 case when l_orderkey % 25 = 0 then 'No' else 'Yes' end as Is_Proper_Pair
from (select *, 1000*cast(floor(b/3) as bigint)+60+90*k as site from
  (select *, cast(floor(l_partkey/120) as bigint) as b, l_partkey % 10 as k, (year(l_shipdate)-1995) % 5 as t from lineitem) x) y""",
    "v_filt": "select * from v_reads where " + _FILTER,
    "v_sites": """
select Sample, Timepoint, Fragment, R1_Chrom as Chr, case when R1_Strand='+' then R1_Ref_Start+4 else R1_Ref_End end as Coordinate,
 cast(sum(case when R1_Strand='+' then 1 else 0 end) as bigint) as plus, cast(sum(case when R1_Strand='-' then 1 else 0 end) as bigint) as minus
from v_filt group by 1,2,3,4,5""",
    "v_merged": """
select Sample, Timepoint, Chr, Coordinate, Strand, cast(sum(PBL) as bigint) as PBL, cast(sum(PBR) as bigint) as PBR, cast(sum(PBL+PBR) as bigint) as Reads from (
 select Sample,Timepoint,Chr,Coordinate,'+' as Strand, case when Fragment='PBL' then minus else 0 end as PBL, case when Fragment='PBR' then plus else 0 end as PBR from v_sites
 union all
 select Sample,Timepoint,Chr,Coordinate,'-', case when Fragment='PBL' then plus else 0 end, case when Fragment='PBR' then minus else 0 end from v_sites) u group by 1,2,3,4,5""",
    "v_counts": """
select k.Sample, k.Chr, k.Coordinate, k.Strand, t.Timepoint, coalesce(m.Reads,0) as Reads
from (select distinct Sample,Chr,Coordinate,Strand from v_merged) k cross join (select distinct Timepoint from v_merged) t
left join v_merged m on m.Sample=k.Sample and m.Chr=k.Chr and m.Coordinate=k.Coordinate and m.Strand=k.Strand and m.Timepoint=t.Timepoint""",
    "v_hard": f"""
select c.* from v_counts c join (select Sample,Chr,Coordinate,Strand from v_counts where Timepoint='YES0' and Reads>={CUTOFF}) s
 on c.Sample=s.Sample and c.Chr=s.Chr and c.Coordinate=s.Coordinate and c.Strand=s.Strand""",
    "v_complete": """
select h.* from v_hard h join (select Chr,Coordinate,Strand from v_hard group by 1,2,3
 having count(*) = (select count(*) from (select distinct Sample,Timepoint from v_hard) q)) s
 on h.Chr=s.Chr and h.Coordinate=s.Coordinate and h.Strand=s.Strand""",
    "v_series": """
select Chr, Coordinate, Strand, Sample, Timepoint, log2((cast(i as double)+1)/(Reads+1)) as LFC from (
 select *, max(case when Timepoint='YES0' then Reads end) over (partition by Chr, Coordinate, Strand, Sample) as i from v_hard) t""",
    "v_blocks": """
select b, case b % 3 when 0 then 'I' when 1 then 'II' else 'III' end as chrom, cast(floor(b/3) as bigint) as g, 1000*cast(floor(b/3) as bigint) as w,
 case when b % 2 = 0 then '+' else '-' end as strand, nm, sz, 1000*cast(floor(b/3) as bigint) + case when b % 7 = 3 then 1170 else 690 end as e2
from (select cast(floor(p_partkey/120) as bigint) as b, min(p_name) as nm, cast(sum(p_size) as bigint) as sz from part group by 1) a""",
    "v_sizes": """
select chrom as Chr, 1000*(max(g)+1)+500 as length from v_blocks group by 1 union all select 'MT', cast(5000 as bigint)""",
    "v_regions": " union all ".join(f"""
select chrom as Chr, w+{lo} as Start, w+{hi} as End_, concat('GENE',cast(b as string)) as Systematic_ID, strand as Strand,
 'Coding gene' as Type, '{kind}' as Feature, cast(case when strand='+' then {plus} else {minus} end as bigint) as Accumulated_CDS_bases,
 case when b % 11 = 5 then null else nm end as Name,
 case sz % 4 when 0 then 'inviable' when 1 then 'condition-dependent' else 'viable' end as FYPOviability,
 case sz % 3 when 0 then 'E' when 1 then 'V' else null end as DeletionLibrary_essentiality,
 w+150 as ParentalRegion_start, w+690 as ParentalRegion_end, cast(540 as bigint) as ParentalRegion_length
from v_blocks""" for kind, lo, hi, plus, minus in REGION_FEATURES) + """
union all
select chrom, s, e, concat('GAP',cast(g as string),'|',chrom), '+|-', 'Intergenic region', 'Convergent_Region', cast(null as bigint),
 concat('gap',cast(g as string)), 'viable', 'Not_determined', s, e, e-s
from (select chrom, g, case when g=0 then cast(0 as bigint) else w-310 end as s, w+150 as e from v_blocks
  union all select b.chrom, b.g+1, b.w+690, z.length from v_blocks b join v_sizes z on z.Chr=b.chrom and b.w+1500=z.length) x""",
    "v_ann_all": """
select m.Chr, m.Coordinate, m.Strand, r.Type, r.Feature, r.Systematic_ID, r.Name, r.FYPOviability, r.DeletionLibrary_essentiality, r.Chr as Chr_Interval, r.Strand as Strand_Interval,
 r.Start as Start_Interval, r.End_ as End_Interval, r.Accumulated_CDS_bases, r.ParentalRegion_start, r.ParentalRegion_end, r.ParentalRegion_length,
 m.Coordinate-r.ParentalRegion_start as Distance_to_region_start, r.ParentalRegion_end-m.Coordinate as Distance_to_region_end,
 cast(case when r.Type='Intergenic region' then null when r.Strand='+' then m.Coordinate-r.ParentalRegion_start else r.ParentalRegion_end-m.Coordinate end as double) as Distance_to_start_codon,
 cast(case when r.Type='Intergenic region' then null when r.Strand='+' then r.ParentalRegion_end-m.Coordinate else m.Coordinate-r.ParentalRegion_start end as double) as Distance_to_stop_codon,
 case when r.Type='Intergenic region' then null when m.Strand=r.Strand then 'Forward' else 'Reverse' end as Insertion_direction
from (select distinct Chr,Coordinate,Strand from v_merged) m
join v_regions r on m.Chr=r.Chr and m.Coordinate>=r.Start and m.Coordinate<=r.End_""",
    "v_ann": """
select Chr,Coordinate,Strand,Type,Feature,Systematic_ID,Name,FYPOviability,DeletionLibrary_essentiality,Chr_Interval,Strand_Interval,Start_Interval,End_Interval,
 Accumulated_CDS_bases,ParentalRegion_start,ParentalRegion_end,ParentalRegion_length,Distance_to_region_start,Distance_to_region_end,Distance_to_start_codon,Distance_to_stop_codon,Insertion_direction
from (select *, max(case when Type<>'Intergenic region' then 1 else 0 end) over (partition by Chr,Coordinate,Strand) as anyc
 from v_ann_all where coalesce(Distance_to_start_codon,1)<>0 and coalesce(Distance_to_stop_codon,1)<>0) z
where anyc=0 or Type<>'Intergenic region'""",
    "v_controls": f"""
select min(Strand) as Strand, Chr, Coordinate from v_ann a
where Type='Intergenic region' and Distance_to_region_start>{BOUNDARY} and Distance_to_region_end>{BOUNDARY}
 and exists (select 1 from v_complete c where c.Chr=a.Chr and c.Coordinate=a.Coordinate and c.Strand=a.Strand)
group by Chr, Coordinate""",
    "v_viability": """
select concat('GENE',cast(b as string)) as systematic_id, case sz % 4 when 0 then 'inviable' when 1 then 'condition-dependent' else 'viable' end as viability from v_blocks
union all select concat('SUP',cast(s_suppkey as string)), case s_nationkey % 5 when 0 then 'inviable' when 1 then 'condition-dependent' when 2 then 'viable' when 3 then 'unknown' else 'slow' end from supplier""",
    "v_essentiality": """
select concat('GENE',cast(b as string)) as Systematic_ID, case sz % 3 when 0 then ' E' when 1 then 'V ' else 'Not_determined' end as DeletionLibrary_essentiality from v_blocks""",
    "v_peptide": """
select concat('GENE',cast(b as string)) as Systematic_ID, case when b % 7 = 3 then cast(309 as bigint) else cast(149 as bigint) end as Residues from v_blocks""",
    "v_genome": """
select case when chrom='III' then 'IIIx' else chrom end as Chr, w as tile_start,
 repeat(case b % 4 when 0 then 'ACGTTAAC' when 1 then 'GGTTAACC' when 2 then 'ttaaCGCA' else 'CATGNNAT' end, 125) as seq from v_blocks""",
    "v_gene_ids": """
select concat('GENE',cast(p_partkey as string)) as gene_systematic_id,
 case when p_partkey % 4 = 0 then null else concat('nm',cast(p_partkey - case when p_partkey % 7 = 3 then 1 else 0 end as string)) end as gene_name,
 concat('syn',cast(p_partkey as string),', alt',cast(cast(floor(p_partkey/3) as bigint) as string)) as synonyms,
 case when p_partkey % 9 = 0 then 'ncRNA gene' else 'protein coding gene' end as gene_type
from part""",
    "v_sam": """
select Sample, Timepoint, ord, concat(qn,chr(9),cast(flag as string),chr(9),rname,chr(9),cast(pos as string),chr(9),cast(mapq as string),chr(9),cigar,chr(9),rnext,chr(9),cast(pos+100 as string),chr(9),cast(tlen as string),chr(9),'*',chr(9),'*',chr(9),'NM:i:',cast(nm as string),chr(9),'MD:Z:60') as line
from (
 select QueryName as qn, Sample, Timepoint, concat(QueryName,':1') as ord,
  67 + case when R1_Strand='-' then 16 else 0 end + case when R1_MAPQ=18 then 4 else 0 end as flag,
  R1_Chrom as rname, R1_Ref_Start+1 as pos, R1_MAPQ as mapq, '60M' as cigar, 150+R1_MAPQ as tlen, R1_NCIGAR as nm, '=' as rnext from v_reads
 union all
 select QueryName, Sample, Timepoint, concat(QueryName,':2'),
  131 + case when R1_Strand='+' then 16 else 0 end + case when R2_MAPQ=36 then 256 else 0 end,
  R1_Chrom, R1_Ref_Start+101, R2_MAPQ, case when R2_NCIGAR=1 then '60M' when R2_NCIGAR=2 then '10S50M' else '20M2I30M1D8M' end, -(150+R1_MAPQ), R2_NCIGAR, case when R2_NCIGAR=4 then 'II' else '=' end from v_reads
 union all
 select QueryName, Sample, Timepoint, concat(QueryName,':3'),
  67 + case when R2_NCIGAR=1 then 2048 else 0 end, R1_Chrom, R1_Ref_Start+31, R1_MAPQ, '5H30M2D25M', 99, 7, '=' from v_reads
) u""",
    "v_gff": """
select concat(chrom,chr(9),'src',chr(9),feature,chr(9),cast(s+1 as string),chr(9),cast(e as string),chr(9),'.',chr(9),strand,chr(9),'.',chr(9),attr) as line
from (""" + " union all ".join(
        f"""select chrom, strand, '{kind}' as feature, w+{start} as s, {end} as e,
 concat('ID={stem}',cast(b as string),'{tx}{suffix};Parent={stem}',cast(b as string),'{parent}') as attr from v_blocks"""
        for kind, start, end, stem, tx, suffix, parent in GFF_FEATURES
    ) + ") u",
    "v_fastq": """
select name, Sample, Fragment, seq1, concat(repeat('I',cast(length(seq1)-k as int)),repeat('#',k)) as qual1,
 seq2, concat(repeat('5',cast(length(seq2)-k as int)),repeat('$',k)) as qual2 from (
 select QueryName as name, cast(R1_MAPQ % 7 as int) as k, Sample, Fragment,
  concat(case when R1_NCIGAR=2 then 'GATTACA'
    when Fragment='PBL' then case R2_NCIGAR when 3 then 'TTTTACGCAGACTATCTTTCTAGGG' when 4 then 'TTTTACGCAGTCTATCTTTCTAGGG' else 'CATGCGTCAATTTTACGCAGACTATCTTTCTAGGG' end
    else case R2_NCIGAR when 2 then 'GGACGCATGATTATCTTTAACGTACGTCACAATATGATTATCTTTCTAGGG' else 'ACGCATGATTATCTTTAACGTACGTCACAATATGATTATCTTTCTAGGG' end end,
   bases) as seq1,
  concat(reverse(bases), case when Fragment='PBL' then 'CCCTAGAAAGATAGTCTGCG' else 'CCCTAGAAAGATAATCATATTGTGACGTACGTTAAAGATAATCATGCGTACGT' end) as seq2
 from (select *, translate(lpad(cast(R1_Ref_Start*7919+R1_MAPQ as string),20,'0'),'0123456789','ACGTACGTAC') as bases from v_reads) z) u""",
}


def needed(sql: str) -> list[str]:
    """Views a text uses, in definition order, following their own uses."""
    want: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in VIEWS:
            if name not in want and re.search(rf"\b{name}\b", text):
                want.add(name)
                todo.append(VIEWS[name])
    return [n for n in _ordered() if n in want]


def _ordered() -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for other in VIEWS:
            if other != name and re.search(rf"\b{other}\b", VIEWS[name]):
                visit(other)
        done.append(name)

    for name in VIEWS:
        visit(name)
    return done


def with_views(sql: str) -> str:
    """Prefix a query with the views it needs."""
    heads = [f"{n} AS ({VIEWS[n].strip()})" for n in needed(sql)]
    if not heads:
        return sql
    body = sql.strip()
    if body.lower().startswith("with "):
        return "WITH " + ",\n".join(heads) + ",\n" + body[5:]
    return "WITH " + ",\n".join(heads) + "\n" + body


class Source:
    """Driver tables and derived views of one scale, as Spark DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def sql(self, text: str) -> DataFrame:
        full = with_views(text)
        for t in TABLES:
            full = re.sub(rf"\b(from|join)\s+{t}\b", rf"\1 parquet.`{self.sf_dir}/{t}.parquet`", full)
        return self.spark.sql(full)

    def __getitem__(self, name: str) -> DataFrame:
        return self.sql(f"select * from {name}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
