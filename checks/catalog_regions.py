"""Annotation, genome regions, intervals and identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.catalog_sources import _GFF
from checks.framework import R, Inputs, check
from checks.views import BOUNDARY
from hopscan.config import CODING, SITE
from hopscan.functions import labels as fl
from hopscan.operators import (
    annotation as an, genes as gn, identifiers as idn, intervals as iv, regions as rg,
    scoring as sc, summaries as sm,
)
from hopscan.plans.regions import attribute_tables, build_regions

ANN = ["Chr", "Coordinate", "Strand", "Type", "Feature", "Systematic_ID", "Name", "FYPOviability",
       "DeletionLibrary_essentiality", "Chr_Interval", "Strand_Interval", "Start_Interval",
       "End_Interval", "Accumulated_CDS_bases", "ParentalRegion_start", "ParentalRegion_end",
       "ParentalRegion_length", "Distance_to_region_start", "Distance_to_region_end",
       "Distance_to_start_codon", "Distance_to_stop_codon", "Insertion_direction"]


@check("annotate_points", "select * from v_ann_all")
def _(s: Inputs) -> DataFrame:
    return s.annotated.select(*ANN)


@check("boundary_dedup", "select * from v_ann")
def _(s: Inputs) -> DataFrame:
    return s.ann.select(*ANN)


def _frac(plus: str, minus: str) -> str:
    return R(f"case when Type='Intergenic region' then null when Strand_Interval='+' then {plus} else {minus} end / cast(ParentalRegion_length as double)")


@check("codon_distances", f"""select Chr, Coordinate, Strand, Systematic_ID, Feature, Distance_to_start_codon, Distance_to_stop_codon,
 {_frac('Distance_to_region_start','Distance_to_region_end')} as Fraction_to_start_codon, {_frac('Distance_to_region_end','Distance_to_region_start')} as Fraction_to_stop_codon from v_ann_all""")
def _(s: Inputs) -> DataFrame:
    return s.annotated.select(*SITE, "Systematic_ID", "Feature", "Distance_to_start_codon",
                              "Distance_to_stop_codon", "Fraction_to_start_codon", "Fraction_to_stop_codon")


@check("affected_residue", """
select Chr, Coordinate, Strand, Systematic_ID, Feature, cast(case when Type='Coding gene' then floor(b/3)+1 end as double) as Residue_affected,
 cast(case when Type='Coding gene' then b % 3 end as double) as Residue_frame
from (select *, coalesce(Accumulated_CDS_bases,0) + case when Feature='CDS' then case when Strand_Interval='+' then Coordinate-Start_Interval else End_Interval-Coordinate end else 0 end as b from v_ann_all) t""")
def _(s: Inputs) -> DataFrame:
    return s.annotated.select(*SITE, "Systematic_ID", "Feature", "Residue_affected", "Residue_frame")


@check("insertion_direction", "select Chr, Coordinate, Strand, Systematic_ID, Insertion_direction from v_ann_all")
def _(s: Inputs) -> DataFrame:
    return s.annotated.select("Chr", "Coordinate", "Strand", "Systematic_ID", "Insertion_direction")


@check("in_gene_filter", "select * from v_ann where Type<>'Intergenic region' and Distance_to_stop_codon>4")
def _(s: Inputs) -> DataFrame:
    return an.in_gene_filter(s.ann, 4).select(*ANN)


@check("in_gene_filter_key", """select a.* from v_ann_all a where exists (select 1 from v_ann_all b where b.Chr=a.Chr and b.Coordinate=a.Coordinate
 and b.Strand=a.Strand and b.Type<>'Intergenic region' and b.Distance_to_stop_codon>4)""")
def _(s: Inputs) -> DataFrame:
    return an.in_gene_filter(s.annotated, 4, "key", SITE).select(*ANN)


@check("intergenic_core_filter", f"select * from v_ann where Type='Intergenic region' and Distance_to_region_start>{BOUNDARY} and Distance_to_region_end>{BOUNDARY}")
def _(s: Inputs) -> DataFrame:
    return an.intergenic_core_filter(s.ann, BOUNDARY).select(*ANN)


@check("union_annotations", "select * from v_ann")
def _(s: Inputs) -> DataFrame:
    a = s.ann.select(*ANN)
    return an.union_annotations([a, a.filter(F.col("Strand") == "+")])


@check("annotation_summary", f"""
select count(*) as annotated_insertions, cast(sum(case when Type<>'Intergenic region' then 1 else 0 end) as bigint) as coding_insertions,
 cast(sum(case when Type='Intergenic region' then 1 else 0 end) as bigint) as intergenic_insertions, count(distinct case when Type<>'Intergenic region' then Systematic_ID end) as unique_genes,
 cast(sum(case when Insertion_direction='Forward' then 1 else 0 end) as bigint) as forward_insertions, cast(sum(case when Insertion_direction='Reverse' then 1 else 0 end) as bigint) as reverse_insertions,
 {R("100.0*sum(case when Type<>'Intergenic region' then 1 else 0 end)/count(*)")} as coding_percentage from v_ann""")
def _(s: Inputs) -> DataFrame:
    return sm.annotation_summary(s.ann)


_TARGET = """contigs as (select Chr, string_agg(seq, '' order by tile_start) as seq from v_genome group by 1),
 tg as (select m.Chr, m.Coordinate, m.Strand, case when c.seq is null or m.Coordinate<4 or m.Coordinate>length(c.seq) then 'NNNN' else upper(substr(c.seq, m.Coordinate-3, 4)) end as Target
  from (select distinct Chr, Coordinate, Strand from v_merged) m left join contigs c on c.Chr=m.Chr)"""


@check("target_sequence", f"with {_TARGET} select * from tg")
def _(s: Inputs) -> DataFrame:
    return an.target_sequence(s.points, s["v_genome"], 1000)


def _with_target(s: Inputs) -> DataFrame:
    return s.merged.join(an.target_sequence(s.points, s["v_genome"], 1000), list(SITE))


@check("concat_summary", f"""with {_TARGET} select cast(count(distinct concat(m.Chr,':',cast(m.Coordinate as string),m.Strand)) as bigint) as insertions, count(distinct m.Chr) as chromosomes, count(distinct Target) as targets,
 cast(sum(PBL) as bigint) as pbl_reads, cast(sum(PBR) as bigint) as pbr_reads, cast(sum(Reads) as bigint) as total_reads,
 count(distinct case when Target='TTAA' then concat(m.Chr,':',cast(m.Coordinate as string),m.Strand) end) as ttaa_insertions,
 {R("100.0*count(distinct case when Target='TTAA' then concat(m.Chr,':',cast(m.Coordinate as string),m.Strand) end)/count(distinct concat(m.Chr,':',cast(m.Coordinate as string),m.Strand))")} as ttaa_share
from v_merged m join tg on tg.Chr=m.Chr and tg.Coordinate=m.Coordinate and tg.Strand=m.Strand""")
def _(s: Inputs) -> DataFrame:
    return sm.concat_summary(_with_target(s))


@check("target_distribution", f"with {_TARGET} select Target, count(*) as insertions from tg group by 1")
def _(s: Inputs) -> DataFrame:
    return sm.target_distribution(_with_target(s))


# --- genome annotation -----------------------------------------------------------------------

_FEAT = f"""gffp as ({_GFF}),
 feat as (select Chr, Start-1 as Start, End_, Transcript, End_-Start+1 as Length, Strand, Feature, Systematic_ID from gffp
  where Feature in ('CDS','intron') and Systematic_ID in (select Systematic_ID from gffp where Feature='mRNA')),
 acc as (select *, cast(coalesce(sum(case when Feature='CDS' then Length else 0 end) over (partition by Systematic_ID, Transcript order by case when Strand='+' then Start else -Start end
  rows between unbounded preceding and 1 preceding),0) as bigint) as Accumulated_CDS_bases from feat),
 inner_ as (select * from (select a.*, min(case when Feature='CDS' then Start end) over w as lo, max(case when Feature='CDS' then End_ end) over w as hi from acc a
  window w as (partition by Systematic_ID, Transcript)) z where Start>=lo and End_<=hi),
 cand as (select Systematic_ID, Transcript, cast(sum(case when Feature='CDS' then Length else 0 end) as bigint) as CDS_length from feat group by 1,2),
 chosen as (select Systematic_ID, Transcript, CDS_length from (select c.*, row_number() over (partition by c.Systematic_ID order by case when c.Transcript like '%.1' then 0 else 1 end, c.Transcript) as rn
  from cand c join v_peptide p on p.Systematic_ID=c.Systematic_ID where cast(floor(CDS_length/3) as bigint)-1=p.Residues and CDS_length>0) z where rn=1),
 prim as (select Chr, Start, End_, Transcript, Length, Strand, Feature, Systematic_ID, Accumulated_CDS_bases from inner_ where Transcript in (select Transcript from chosen))"""
_GAPS = """gaps as (select Chr, prev as Start, Start as End_ from (select Chr, Start, coalesce(max(End_) over (partition by Chr order by Start, End_ rows between unbounded preceding and 1 preceding),0) as prev
   from (select distinct Chr, Start, End_ from prim) d) e where Start>prev
  union all select z.Chr, coalesce(m.mx,0), z.length from v_sizes z left join (select Chr, max(End_) as mx from prim group by 1) m on m.Chr=z.Chr where coalesce(m.mx,0) < z.length)"""
_FLANK = """lf as (select * from (select *, row_number() over (partition by Chr, End_ order by Start, Transcript) as rn from prim) z where rn=1),
 rt as (select * from (select *, row_number() over (partition by Chr, Start order by End_, Transcript) as rn from prim) z where rn=1),
 flank as (select g.Chr, g.Start, g.End_, concat(coalesce(l.Transcript,'Boundary'),'|',coalesce(r.Transcript,'Boundary')) as Transcript,
  concat(coalesce(l.Systematic_ID,'Boundary'),'|',coalesce(r.Systematic_ID,'Boundary')) as Systematic_ID, concat(coalesce(l.Strand,'Boundary'),'|',coalesce(r.Strand,'Boundary')) as Strand,
  case when l.Strand='+' and r.Strand='-' then 'Convergent_Region' when l.Strand='-' and r.Strand='+' then 'Divergent_Region' when l.Strand='+' and r.Strand='+' then 'Tandem_Plus_Region'
   when l.Strand='-' and r.Strand='-' then 'Tandem_Minus_Region' else 'Boundary_Adjacent_Region' end as Feature
  from gaps g left join lf l on l.Chr=g.Chr and l.End_=g.Start left join rt r on r.Chr=g.Chr and r.Start=g.End_)"""
_SPANS = """sp as (select Chr, min(Start) as s, max(End_) as e, Transcript, Systematic_ID, Strand from prim group by Chr, Transcript, Systematic_ID, Strand)"""


def _features(s: Inputs) -> DataFrame:
    return rg.accumulated_cds(rg.coding_features(s.gff))


def _primary(s: Inputs) -> DataFrame:
    features = _features(s)
    chosen = rg.primary_transcript(features, s["v_peptide"]).select("Transcript")
    return rg.transcript_boundary_filter(features).join(chosen, "Transcript", "left_semi")


def _sql_end(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("End", "End_")


@check("gff_attributes", f"with gffp as ({_GFF}) select Systematic_ID, Transcript, Feature, count(*) as n from gffp group by 1,2,3")
def _(s: Inputs) -> DataFrame:
    return s.gff.groupBy("Systematic_ID", "Transcript", "Feature").agg(F.count(F.lit(1)).alias("n"))


@check("bed_coordinates", f"with gffp as ({_GFF}) select Transcript, Feature, Start-1 as Start, End_, End_-Start+1 as Length from gffp")
def _(s: Inputs) -> DataFrame:
    bed = fl.bed_coordinates(F.col("Start"), F.col("End"))
    return s.gff.select("Transcript", "Feature", bed["Start"].alias("Start"), bed["End"].alias("End_"), bed["Length"].alias("Length"))


@check("accumulated_cds", f"with {_FEAT} select * from acc")
def _(s: Inputs) -> DataFrame:
    return _sql_end(_features(s)).drop("Type")


@check("transcript_boundary_filter", f"with {_FEAT} select Chr, Start, End_, Transcript, Feature, Systematic_ID from inner_")
def _(s: Inputs) -> DataFrame:
    return _sql_end(rg.transcript_boundary_filter(_features(s))).select("Chr", "Start", "End_", "Transcript", "Feature", "Systematic_ID")


@check("primary_transcript", f"with {_FEAT} select * from chosen")
def _(s: Inputs) -> DataFrame:
    return rg.primary_transcript(_features(s), s["v_peptide"])


@check("interval_complement", f"with {_FEAT}, {_GAPS} select * from gaps")
def _(s: Inputs) -> DataFrame:
    return _sql_end(iv.interval_complement(_primary(s), s["v_sizes"]))


@check("flank_lookup", f"with {_FEAT}, {_GAPS}, {_FLANK} select * from flank")
def _(s: Inputs) -> DataFrame:
    p = _primary(s)
    return _sql_end(iv.flank_lookup(iv.interval_complement(p, s["v_sizes"]), p))


@check("orientation_label", """select l, r, case when l='+' and r='-' then 'Convergent' when l='-' and r='+' then 'Divergent' when l='+' and r='+' then 'Tandem_Plus' when l='-' and r='-' then 'Tandem_Minus' else 'Boundary_Adjacent' end as label, count(*) as n
 from (select R1_Strand as l, case when R2_NCIGAR=1 then 'Boundary' when R2_NCIGAR=2 then '+' else '-' end as r from v_reads) t group by 1,2""")
def _(s: Inputs) -> DataFrame:
    n = F.col("R2_NCIGAR")
    rows = s.reads.select(
        F.col("R1_Strand").alias("l"), F.when(n == 1, "Boundary").when(n == 2, "+").otherwise("-").alias("r")
    )
    return rows.groupBy("l", "r").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "label", fl.orientation_label(F.col("l"), F.col("r"))
    )


def _spans(s: Inputs) -> DataFrame:
    return rg.spans(rg.parental_span(_primary(s)))


@check("interval_self_overlap", f"""with {_FEAT}, {_SPANS}, o as (
 select a.Chr, greatest(a.s,b.s) as Start, least(a.e,b.e) as End_, concat(a.Transcript,',',b.Transcript) as Transcript, concat(a.Strand,',',b.Strand) as Strand, 'Overlapping genes' as Feature,
  concat(a.Systematic_ID,',',b.Systematic_ID) as Systematic_ID, row_number() over (partition by a.Chr, greatest(a.s,b.s), least(a.e,b.e) order by a.s,a.e,a.Transcript,b.s,b.e,b.Transcript) as rn
 from sp a join sp b on a.Chr=b.Chr and a.s<b.e and b.s<a.e and a.Transcript<>b.Transcript and row(a.s,a.e,a.Transcript)<row(b.s,b.e,b.Transcript))
select Chr, Start, End_, Transcript, Strand, Feature, Systematic_ID, End_-Start as Length from o where rn=1""")
def _(s: Inputs) -> DataFrame:
    return _sql_end(iv.interval_self_overlap(_spans(s), width=500))


_NC = """nc as (select Chr, Start-1 as Start, End_, Transcript, Systematic_ID, Feature from gffp where Feature in ('tRNA','rRNA','snoRNA','snRNA','lncRNA')),
 free as (select n.*, t.p from nc n, unnest(range(Start, End_)) t(p) where not exists (select 1 from sp where sp.Chr=n.Chr and t.p>=greatest(sp.s-200,0) and t.p<sp.e+200)),
 isl as (select *, p - row_number() over (partition by Chr, Start, End_, Transcript order by p) as grp from free)"""


@check("interval_subtract", f"""with {_FEAT}, {_SPANS}, {_NC}
select Chr, min(p) as Start, max(p)+1 as End_, Transcript, Systematic_ID, Feature from isl group by Chr, Transcript, Systematic_ID, Feature, grp""")
def _(s: Inputs) -> DataFrame:
    nc = rg.non_coding_features(s.gff).select("Chr", "Start", "End", "Transcript", "Systematic_ID", "Feature")
    return _sql_end(iv.interval_subtract(nc, _spans(s), 200, ("Transcript",), width=700))


@check("parental_span", f"""with {_FEAT} select Chr, Start, End_, Systematic_ID, Transcript, min(Start) over w as ParentalRegion_start, max(End_) over w as ParentalRegion_end,
 max(End_) over w - min(Start) over w as ParentalRegion_length from feat window w as (partition by Chr, Systematic_ID)""")
def _(s: Inputs) -> DataFrame:
    return _sql_end(rg.parental_span(rg.coding_features(s.gff))).select(
        "Chr", "Start", "End_", "Systematic_ID", "Transcript", "ParentalRegion_start", "ParentalRegion_end", "ParentalRegion_length")


@check("region_type_counts", "select Type, count(*) as regions from v_regions group by 1")
def _(s: Inputs) -> DataFrame:
    return rg.region_type_counts(s.regions)


@check("union_regions", f"""with {_FEAT}, {_GAPS} select Chr, Start, End_, Transcript from prim union all select Chr, Start, End_, null from gaps""")
def _(s: Inputs) -> DataFrame:
    p = _primary(s)
    return _sql_end(rg.union_regions(p.select("Chr", "Start", "End", "Transcript"), iv.interval_complement(p, s["v_sizes"])))


_ATTR = """nm as (select gene_systematic_id as id, max(coalesce(gene_name, gene_systematic_id)) as v from v_gene_ids group by 1),
 vi as (select systematic_id as id, max(viability) as v from v_viability group by 1),
 es as (select Systematic_ID as id, max(trim(DeletionLibrary_essentiality)) as v from v_essentiality group by 1)"""


def _lookup(col: str, table: str, default: str, sep: str) -> str:
    part = f"split_part(i.id,'{sep}',{{k}})"

    def one(k: int) -> str:
        p = part.format(k=k)
        return f"coalesce((select v from {table} where {table}.id={p}), {default or p})"

    single = f"(select v from {table} where {table}.id=i.id)"
    return f"case when i.id like '%{sep}%' then concat({one(1)},'{sep}',{one(2)}) else {single} end as {col}"


def _attributes(sep: str) -> str:
    return ", ".join([
        _lookup("Name", "nm", "", sep), _lookup("FYPOviability", "vi", "", sep),
        _lookup("DeletionLibrary_essentiality", "es", "'Not_determined'", sep),
    ])


_IDS = """select distinct concat('GENE',cast(p_partkey as string)) as id from part union all select concat('GENE',cast(p_partkey as string),'|GENE',cast(p_partkey+3 as string)) from part
 union all select concat('SUP',cast(s_suppkey as string)) from supplier union all select concat('Boundary|SUP',cast(s_suppkey as string)) from supplier"""


@check("gene_attributes", f"with {_ATTR}, i as ({_IDS}) select i.id as Systematic_ID, {_attributes('|')} from i")
def _(s: Inputs) -> DataFrame:
    rows = s.sql(_IDS).withColumnRenamed("id", "Systematic_ID")
    return rg.gene_attributes(rows, *attribute_tables(s["v_gene_ids"], s["v_viability"], s["v_essentiality"]))


_TOKENS = """select case l_linenumber when 1 then concat('GENE',cast(l_partkey as string)) when 2 then concat('nm',cast(l_partkey as string)) when 3 then concat('syn',cast(l_partkey as string))
 when 4 then concat('alt',cast(cast(floor(l_partkey/3) as bigint) as string)) when 5 then concat('zz',cast(l_partkey as string)) when 6 then concat('nm',cast(l_partkey+1 as string)) end as token from lineitem"""


@check("resolve_ids", f"""
with coding as (select gene_systematic_id as id, coalesce(gene_name, gene_systematic_id) as name, synonyms from v_gene_ids where gene_type='protein coding gene'),
 nm as (select name as alias, case when count(*)=1 then min(id) end as id from (select distinct name, id from coding) d group by 1),
 sy as (select alias, case when count(*)=1 then min(id) end as id from (select trim(unnest(string_split(synonyms, ','))) as alias, id from coding) d group by 1),
 t as ({_TOKENS})
select token, case when token in (select id from coding) then token when token in (select alias from nm) then (select id from nm where nm.alias=token)
 when token in (select alias from sy) then (select id from sy where sy.alias=token) else token end as resolved_id, count(*) as n from t group by 1,2""")
def _(s: Inputs) -> DataFrame:
    out = idn.resolve_ids(s.sql(_TOKENS), "token", s["v_gene_ids"])
    return out.groupBy("token", "resolved_id").agg(F.count(F.lit(1)).alias("n"))


_LEVELS_A = """select concat('P',cast(p_partkey as string)) as Name, concat('spo',lpad(cast(p_size as string),5,'0')) as Level_1,
 case when p_partkey % 3=0 then null else p_brand end as Level_2, case when p_partkey % 2=0 then null else p_type end as Level_3 from part"""
_LEVELS_B = """select case when s_suppkey % 10=0 then null else s_name end as Name, case when s_suppkey % 7=0 then null else concat('spo',lpad(cast(s_nationkey as string),5,'0')) end as Level_1 from supplier"""
_CODES = "select n_nationkey as Code, n_name as Category, r_name as Description from nation join region on r_regionkey=n_regionkey"


@check("hierarchy_union", f"""
with a as ({_LEVELS_A}), b as (select Name, Level_1, cast(null as varchar) as Level_2, cast(null as varchar) as Level_3 from ({_LEVELS_B}) x), u as (select * from a union all select * from b),
 f as (select Name, coalesce(Level_1,Name) as Level_1, coalesce(Level_2,Level_1,Name) as Level_2, coalesce(Level_3,Level_2,Level_1,Name) as Level_3 from u where Name is not null), c as ({_CODES})
select Name, Category, Description, Level_1, Level_2, Level_3 from f left join c on f.Level_1=concat('spo',lpad(cast(Code as varchar),5,'0'))""")
def _(s: Inputs) -> DataFrame:
    return idn.hierarchy_union([s.sql(_LEVELS_A), s.sql(_LEVELS_B)], s.sql(_CODES))


_COVERED = """select distinct a.Systematic_ID from v_ann a join (select distinct Chr, Coordinate, Strand from v_hard) h
 on a.Chr=h.Chr and a.Coordinate=h.Coordinate and a.Strand=h.Strand where a.Systematic_ID is not null"""


@check("covered_genes", _COVERED)
def _(s: Inputs) -> DataFrame:
    return gn.covered_genes(s.hard, s.ann, SITE)


@check("coverage_by_viability", f"""with c as ({_COVERED})
select viability, count(*) as total, count(c.Systematic_ID) as covered, count(*)-count(c.Systematic_ID) as not_covered, {R('100.0*count(c.Systematic_ID)/count(*)')} as coverage_pct,
 cast(case viability when 'viable' then 1 when 'inviable' then 2 when 'condition-dependent' then 3 when 'unknown' then 4 else 5 end as bigint) as display_order
from v_viability v left join c on c.Systematic_ID=v.systematic_id group by 1""")
def _(s: Inputs) -> DataFrame:
    return gn.coverage_by_viability(gn.covered_genes(s.hard, s.ann, SITE), s["v_viability"])


@check("build_regions", f"""with {_FEAT}, {_GAPS}, {_FLANK}, {_ATTR},
 i0 as (select Chr, Start, End_, Transcript, Length, Strand, Feature, Systematic_ID as id, 'Coding gene' as Type, Accumulated_CDS_bases from prim
  union all select Chr, Start, End_, Transcript, End_-Start, Strand, Feature, Systematic_ID, 'Intergenic region', null from flank),
 i as (select *, min(Start) over w as ParentalRegion_start, max(End_) over w as ParentalRegion_end from i0 window w as (partition by Chr, id, Type))
select Chr, Start, End_, Transcript, Length, Strand, Feature, i.id as Systematic_ID, Type, Accumulated_CDS_bases, {_attributes('|')}, ParentalRegion_start, ParentalRegion_end,
 ParentalRegion_end-ParentalRegion_start as ParentalRegion_length from i""")
def _(s: Inputs) -> DataFrame:
    out = build_regions(s.gff, s["v_sizes"], s["v_peptide"], s["v_gene_ids"], s["v_viability"], s["v_essentiality"])
    return _sql_end(out["genome"])


@check("build_regions_overlapped", f"""with {_FEAT}, {_SPANS}, {_ATTR}, i as (
 select a.Chr, greatest(a.s,b.s) as Start, least(a.e,b.e) as End_, concat(a.Systematic_ID,',',b.Systematic_ID) as id
 from sp a join sp b on a.Chr=b.Chr and a.s<b.e and b.s<a.e and row(a.s,a.e,a.Transcript)<row(b.s,b.e,b.Transcript))
select Chr, Start, End_, i.id as Systematic_ID, '{CODING}' as Type, {_attributes(',')} from i""")
def _(s: Inputs) -> DataFrame:
    out = build_regions(s.gff, s["v_sizes"], s["v_peptide"], s["v_gene_ids"], s["v_viability"], s["v_essentiality"])
    return _sql_end(out["overlapped"]).drop("Transcript", "Strand", "Feature", "Length")


_INSIDE = "select distinct Chr, Coordinate, Strand from v_ann where Type<>'Intergenic region' and Distance_to_stop_codon>3"
_IMPUTED = f"""inside as ({_INSIDE}), g as (select h.* from v_hard h join inside i on i.Chr=h.Chr and i.Coordinate=h.Coordinate and i.Strand=h.Strand),
 grid as (select k.*, s.Sample, t.Timepoint from (select distinct Chr, Coordinate, Strand from g) k cross join (select distinct Sample from v_hard) s cross join (select distinct Timepoint from v_hard) t),
 filled as (select grid.*, coalesce(a.Reads, b.Reads) as Reads, a.Reads is null as imputed from grid
  left join g a on a.Chr=grid.Chr and a.Coordinate=grid.Coordinate and a.Strand=grid.Strand and a.Sample=grid.Sample and a.Timepoint=grid.Timepoint
  left join g b on b.Chr=grid.Chr and b.Coordinate=grid.Coordinate and b.Strand<>grid.Strand and b.Sample=grid.Sample and b.Timepoint=grid.Timepoint),
 cells as (select count(*) as n from (select distinct Sample, Timepoint from v_hard) q),
 imp as (select f.* from filled f join (select Chr, Coordinate, Strand from filled group by 1,2,3 having count(Reads)=(select n from cells)) c on c.Chr=f.Chr and c.Coordinate=f.Coordinate and c.Strand=f.Strand
  union all select h.Chr, h.Coordinate, h.Strand, h.Sample, h.Timepoint, h.Reads, false from v_complete h left join inside i on i.Chr=h.Chr and i.Coordinate=h.Coordinate and i.Strand=h.Strand where i.Chr is null)"""


@check("impute_opposite_strand", f"with {_IMPUTED} select * from imp")
def _(s: Inputs) -> DataFrame:
    return sc.impute_opposite_strand(s.hard, s.ann, key=SITE)


@check("imputation_stats", f"with {_IMPUTED} select Chr, Coordinate, Strand, cast(sum(case when imputed and Timepoint='YES0' then 1 else 0 end) as bigint) as num_of_imputed_insertions from imp group by 1,2,3")
def _(s: Inputs) -> DataFrame:
    return sc.imputation_stats(sc.impute_opposite_strand(s.hard, s.ann, key=SITE), "YES0", SITE)


@check("imputation_summary", f"""with {_IMPUTED}, k as (select distinct Chr, Coordinate, Strand from v_hard),
 x as (select k.*, i.Chr is not null as g, c.Chr is not null as f from k left join inside i on i.Chr=k.Chr and i.Coordinate=k.Coordinate and i.Strand=k.Strand
  left join (select distinct Chr, Coordinate, Strand from v_complete) c on c.Chr=k.Chr and c.Coordinate=k.Coordinate and c.Strand=k.Strand),
 a as (select count(*) as n from (select Chr, Coordinate, Strand from filled group by 1,2,3 having count(Reads)=(select n from cells)) q),
 b as (select count(*) as n from (select distinct Chr, Coordinate, Strand, Sample from filled where imputed and Reads is not null) q)
select count(*) as total_insertions, cast(sum(case when g then 1 else 0 end) as bigint) as in_gene_insertions, cast(sum(case when g then 0 else 1 end) as bigint) as intergenic_insertions,
 cast(sum(case when f then 1 else 0 end) as bigint) as complete_insertions_before, cast(sum(case when f and g then 1 else 0 end) as bigint) as complete_in_gene_before,
 cast(sum(case when f and not g then 1 else 0 end) as bigint) as complete_intergenic, cast((select n from a) as bigint) as complete_in_gene_after,
 cast((select n from b) as bigint) as complementarity_used, cast((select n from a) - sum(case when f and g then 1 else 0 end) as bigint) as imputed_insertions from x""")
def _(s: Inputs) -> DataFrame:
    return sc.imputation_summary(s.hard, s.ann, key=SITE)
