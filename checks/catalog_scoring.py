"""Controls, scores, weights, genes, density, curves and the replicate model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from checks.catalog_regions import _IMPUTED
from checks.framework import CHECKS, CONFIG, Check, R, Inputs, check, rounded
from checks.views import GENERATIONS, TIMEPOINTS
from hopscan.config import GENE_STOP_DISTANCE, SITE
from hopscan.functions import curve as fc, statistics as fs
from hopscan.operators import (
    curves as cv, density as dn, genes as gn, ordered as od, reads as rd, replicates as rp, scoring as sc,
    sites as st, summaries as sm,
)
from hopscan.operators.scoring import in_gene_keys
from hopscan.operators.sites import semi_keys
from hopscan.plans.qc import qc_report
from hopscan.plans.scoring import score_no_replicates, score_replicates
from hopscan.session import checkpointed
from hopscan.streaming.site_counts import compact_site_counts, incremental_site_count, running_site_counts

_ON = "{a}.Chr={b}.Chr and {a}.Coordinate={b}.Coordinate and {a}.Strand={b}.Strand"


def _on(a: str, b: str) -> str:
    return _ON.format(a=a, b=b)


_CTRL = f"ctrl as (select h.* from v_hard h join v_controls c on {_on('h', 'c')})"
_MED = f"{_CTRL}, med as (select Sample, Timepoint, median(Reads) as median from ctrl group by 1,2)"


@check("select_controls", "select Chr, Coordinate, Strand from v_controls")
def _(s: Inputs) -> DataFrame:
    return s.controls.select(*SITE)


@check("control_summary", f"""select count(*) as complete_insertions, (select count(*) from v_controls) as control_insertions,
 {R('100.0*(select count(*) from v_controls)/count(*)')} as control_rate from (select distinct Chr, Coordinate, Strand from v_complete) k""")
def _(s: Inputs) -> DataFrame:
    complete = st.complete_cases(s.stored_hard, key=SITE).select(*SITE).distinct()
    return sm.control_summary(complete, s.controls, SITE)


@check("control_medians", f"with {_MED} select Sample, Timepoint, {R('median')} as median, {R('(select min(median) from med)')} as min_median from med")
def _(s: Inputs) -> DataFrame:
    return sc.control_medians(s.stored_hard, s.controls, SITE)


@check("baseline_join", """select *, max(case when Timepoint='YES0' then Reads end) over (partition by Chr, Coordinate, Strand, Sample) as initial from v_hard""")
def _(s: Inputs) -> DataFrame:
    return sc.baseline_join(s.stored_hard, "YES0", SITE)


_MA = f"""{_MED}, n as (select h.*, h.Reads*(select min(median) from med)/m.median as n from v_hard h join med m on m.Sample=h.Sample and m.Timepoint=h.Timepoint),
 ma as (select *, max(case when Timepoint='YES0' then n end) over (partition by Chr, Coordinate, Strand, Sample) as i from n)"""


@check("ma_scores", f"""with {_MA} select Chr, Coordinate, Strand, Sample, Timepoint, {R('i')} as "baseMean", {R('-log2((n+1)/(i+1))')} as "LFC", {R('0.5*log2((n+1)*(i+1))')} as "A", {R('n')} as normed from ma""")
def _(s: Inputs) -> DataFrame:
    return sc.ma_scores(s.stored_hard, s.controls, "YES0", SITE, digits=None)


@check("ma_values", f"""select l_orderkey, l_linenumber, l_partkey, {R('-log2((l_quantity+1)/(l_extendedprice+1))')} as "LFC", {R('0.5*log2((l_quantity+1)*(l_extendedprice+1))')} as "A" from lineitem""")
def _(s: Inputs) -> DataFrame:
    m = fs.ma_values(F.col("l_quantity"), F.col("l_extendedprice"))
    return s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", m["LFC"].alias("LFC"), m["A"].alias("A"))


_CLIP = "least(greatest({x}, 0.000001), 0.999999)"


@check("clip_neg_log10", f"""select l_orderkey, l_linenumber, l_partkey, {R('-log10(' + _CLIP.format(x='coalesce(case when l_linenumber=3 then null else l_discount*11-0.02 end, 1)') + ')')} as weight from lineitem""")
def _(s: Inputs) -> DataFrame:
    p = F.when(F.col("l_linenumber") != 3, F.col("l_discount") * 11 - 0.02)
    return s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fs.clip_neg_log10(p).alias("weight"))


@check("r2_weight", f"""select l_orderkey, l_linenumber, l_partkey, {R('case when l_linenumber=3 then null else 1-' + _CLIP.format(x='l_discount*11-0.02') + ' end')} as weight from lineitem""")
def _(s: Inputs) -> DataFrame:
    p = F.when(F.col("l_linenumber") != 3, F.col("l_discount") * 11 - 0.02)
    return s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fs.r2_weight(p).alias("weight"))


_RATIO = f"""{_CTRL}, lg as (select *, min(Reads) over (partition by Chr, Coordinate, Strand) as mn, ln(case when Reads>0 then Reads end) as lr from ctrl),
 ra as (select *, lr - avg(lr) over (partition by Chr, Coordinate, Strand) as d from lg where mn>0),
 sf as (select Sample, Timepoint, exp(median(d)) as size_factor from ra group by 1,2)"""


@check("size_factors", f"with {_RATIO} select Sample, Timepoint, {R('size_factor')} as size_factor from sf")
def _(s: Inputs) -> DataFrame:
    return sc.size_factors(s.stored_hard, s.controls, SITE)


@check("dispersion_moments", f"""with {_RATIO}, n as (select h.*, Reads/size_factor as n, 1/size_factor as inv from v_hard h join sf on sf.Sample=h.Sample and sf.Timepoint=h.Timepoint),
 g as (select Chr, Coordinate, Strand, avg(n) as m, var_samp(n) as v, avg(inv) as i from n group by 1,2,3)
select Chr, Coordinate, Strand, {R('m')} as base_mean, {R('v')} as base_var, {R('case when m>0 then (v-i*m)/(m*m) else 0 end')} as dispersion from g""")
def _(s: Inputs) -> DataFrame:
    return sc.dispersion_moments(s.stored_hard, sc.size_factors(s.stored_hard, s.controls, SITE), SITE)


@check("normalized_counts", f"with {_RATIO} select h.*, {R('Reads/size_factor')} as normed from v_hard h join sf on sf.Sample=h.Sample and sf.Timepoint=h.Timepoint")
def _(s: Inputs) -> DataFrame:
    return rp.normalized_counts(s.stored_hard, sc.size_factors(s.stored_hard, s.controls, SITE), digits=6)


# --- weights and genes -----------------------------------------------------------------------

_LFC = """select Chr, Coordinate, Strand, Timepoint, max(LFC) as LFC from v_series group by 1,2,3,4"""
_WEIGHT = """select Chr, Coordinate, Strand, Timepoint, case when Reads % 5=0 then null else cast(1 as double)/(1+Reads) end as weight from (
 select Chr, Coordinate, Strand, Timepoint, cast(sum(Reads) as bigint) as Reads from v_hard group by 1,2,3,4) q"""
_JOINED = f"""lfc as ({_LFC}), w as ({_WEIGHT}), lw as (select lfc.*, -log10({_CLIP.format(x='coalesce(weight,1)')}) as "Weights" from lfc join w on {_on('lfc', 'w')} and lfc.Timepoint=w.Timepoint)"""
_JA = f"""{_JOINED}, ja as (select lw.*, a.Systematic_ID, a.Name, a.FYPOviability, a.DeletionLibrary_essentiality, a.Feature from lw left join v_ann a on {_on('lw', 'a')})"""


def _weighted(s: Inputs) -> DataFrame:
    keys = [*SITE, "Timepoint"]
    lfc = s.series.groupBy(*keys).agg(F.max("LFC").alias("LFC"))
    reads = s.stored_hard.groupBy(*keys).agg(F.sum("Reads").alias("n"))
    weight = F.when(F.col("n") % 5 != 0, F.lit(1.0) / (1 + F.col("n")))
    return gn.join_lfc_weights(lfc, reads.select(*keys, weight.alias("weight")), SITE)


def _gene_rows(s: Inputs) -> DataFrame:
    cols = ["Systematic_ID", "Name", "FYPOviability", "DeletionLibrary_essentiality", "Feature"]
    return gn.join_annotations(_weighted(s), s.stored_ann.select(*SITE, *cols), SITE)


@check("join_lfc_weights", f"""with {_JOINED} select Chr, Coordinate, Strand, Timepoint, {R('"LFC"')} as "LFC", {R('"Weights"')} as "Weights" from lw""")
def _(s: Inputs) -> DataFrame:
    return _weighted(s)


@check("join_annotations", f"""with {_JA} select Chr, Coordinate, Strand, Timepoint, Systematic_ID, Name, FYPOviability, DeletionLibrary_essentiality, Feature, {R('"LFC"')} as "LFC", {R('"Weights"')} as "Weights" from ja""")
def _(s: Inputs) -> DataFrame:
    return _gene_rows(s)


@check("normalize_weights", f"""with {_JA} select Chr, Coordinate, Strand, Timepoint, Systematic_ID, Feature, {R('"Weights"/sum("Weights") over (partition by Systematic_ID, Timepoint)')} as "Normalized_weights" from ja""")
def _(s: Inputs) -> DataFrame:
    return gn.normalize_weights(_gene_rows(s)).select(*SITE, "Timepoint", "Systematic_ID", "Feature", "Normalized_weights")


_GENE = f"""{_JA}, gene as (select Systematic_ID, Name, FYPOviability, coalesce(DeletionLibrary_essentiality,'Not_determined') as DeletionLibrary_essentiality, Timepoint, sum("LFC"*"Weights")/sum("Weights") as "LFC"
 from ja where Systematic_ID is not null and Name is not null and FYPOviability is not null group by 1,2,3,4,5)"""


@check("gene_lfc", f"""with {_GENE} select Systematic_ID, Name, FYPOviability, DeletionLibrary_essentiality, Timepoint, {R('"LFC"')} as "LFC" from gene""")
def _(s: Inputs) -> DataFrame:
    return gn.gene_lfc(_gene_rows(s), digits=None)


@check("gene_summary", f"""with {_GENE}, k as (select distinct Systematic_ID, Name, FYPOviability, DeletionLibrary_essentiality from gene)
select count(*) as genes, cast(sum(case when FYPOviability='inviable' then 1 else 0 end) as bigint) as inviable, cast(sum(case when FYPOviability='viable' then 1 else 0 end) as bigint) as viable,
 cast(sum(case when DeletionLibrary_essentiality='E' then 1 else 0 end) as bigint) as library_essential, cast(sum(case when DeletionLibrary_essentiality='V' then 1 else 0 end) as bigint) as library_dispensable from k""")
def _(s: Inputs) -> DataFrame:
    return sm.gene_summary(gn.gene_lfc(_gene_rows(s)))


@check("top_depleted", f"""with {_GENE} select Systematic_ID, Timepoint, {R('"LFC"')} as "LFC" from gene where Timepoint='YES4' order by round("LFC",6) desc, Systematic_ID limit 10""")
def _(s: Inputs) -> DataFrame:
    g = gn.gene_lfc(_gene_rows(s), digits=6).filter(F.col("Timepoint") == "YES4")
    return od.top_depleted(g, "LFC", 10, ["Systematic_ID"]).select("Systematic_ID", "Timepoint", "LFC")


# --- density ---------------------------------------------------------------------------------

_ROWS = f"""rs as (select Chr, Coordinate, Strand, cast(coalesce(sum(case when Timepoint='YES0' then Reads end),0) as bigint) as reads_initial, cast(coalesce(sum(case when Timepoint='YES4' then Reads end),0) as bigint) as reads_final from v_hard group by 1,2,3),
 rw as (select a.*, rs.reads_initial, rs.reads_final from v_ann a join rs on {_on('a', 'rs')} where a.Type<>'Intergenic region' and a.Distance_to_stop_codon>4)"""
_DENS = f"""dens as (select Systematic_ID, count(*) as total_insertions, count(distinct case when reads_initial>0 then Coordinate end) as i, count(distinct case when reads_final>0 then Coordinate end) as f, max(ParentalRegion_length) as len from rw group by 1)"""
_DENS_COLS = f"""total_insertions, i as unique_sites_initial, f as unique_sites_final, len as gene_length, {R('1000.0*i/len')} as insertion_density_per_kb_initial, {R('1000.0*f/len')} as insertion_density_per_kb_final,
 {R('1000.0*(f-i)/len')} as insertion_density_change, {R('log2((f+1.0)/(i+1.0))')} as insertion_density_log2fc"""


def _gene_insertions(s: Inputs) -> DataFrame:
    return dn.in_gene_insertions(s.stored_hard, s.stored_ann, "YES0", "YES4", key=SITE)


@check("gene_density", f"with {_ROWS}, {_DENS} select Systematic_ID, {_DENS_COLS} from dens")
def _(s: Inputs) -> DataFrame:
    return dn.gene_density(_gene_insertions(s), rounded=False)


_GAPS = """mk as (select Systematic_ID, Coordinate as p, max(ParentalRegion_length) over (partition by Systematic_ID) as len from rw union select Systematic_ID, ParentalRegion_start, ParentalRegion_length from rw union select Systematic_ID, ParentalRegion_end, ParentalRegion_length from rw),
 gp as (select Systematic_ID, p, gap, round(cast(gap as double)/len, 3) as fr from (select Systematic_ID, p, len, p - lag(p) over (partition by Systematic_ID order by p) - 1 as gap from mk) z where gap>0),
 gi as (select Systematic_ID, fr, row_number() over (partition by Systematic_ID order by fr) as rn from gp),
 gini as (select Systematic_ID, least(1,greatest(0,2*sum(rn*fr)/(count(*)*sum(fr)) - (count(*)+1)/count(*))) as g from gi group by 1),
 gaps as (select Systematic_ID, count(*) as num_gaps, max(gap) as largest_gap, max(fr) as largest_gap_fraction, min(gap) as smallest_gap, min(fr) as smallest_gap_fraction, avg(gap) as mean_gap_length, avg(fr) as mean_gap_length_fraction,
  median(gap) as median_gap_length, median(fr) as median_gap_length_fraction, stddev_pop(gap) as gap_length_sd, stddev_pop(fr) as gap_length_sd_fraction from gp group by 1)"""
_GAP_COLS = ", ".join(
    ["num_gaps", "largest_gap", "smallest_gap"]
    + [f"{R(c)} as {c}" for c in ("largest_gap_fraction", "smallest_gap_fraction", "mean_gap_length", "mean_gap_length_fraction", "median_gap_length",
                                  "median_gap_length_fraction", "gap_length_sd", "gap_length_sd_fraction")]
    + [f"{R('g')} as gini_coefficient_of_location"]
)


@check("gene_gaps", f"with {_ROWS}, {_GAPS} select gaps.Systematic_ID, {_GAP_COLS} from gaps join gini on gini.Systematic_ID=gaps.Systematic_ID")
def _(s: Inputs) -> DataFrame:
    return dn.gene_gaps(_gene_insertions(s), rounded=False)


@check("gap_rows", f"with {_ROWS}, {_GAPS} select Systematic_ID, p as Coordinate, gap, {R('fr')} as gap_fraction from gp")
def _(s: Inputs) -> DataFrame:
    return dn.gap_rows(_gene_insertions(s))


def _gini(name: str, value: str) -> str:
    return f"""{name} as (select Systematic_ID, case when sum(v)=0 then 0 else least(1,greatest(0,2*sum(rn*v)/(count(*)*sum(v)) - (count(*)+1)/count(*))) end as g
 from (select Systematic_ID, {value} as v, row_number() over (partition by Systematic_ID order by {value}) as rn from rw) z group by 1)"""


_READS = f"""{_gini('g0', 'reads_initial')}, {_gini('g1', 'reads_final')},
 rd as (select Systematic_ID, cast(sum(reads_initial) as bigint) as i, cast(sum(reads_final) as bigint) as f, avg(reads_initial) as mi, avg(reads_final) as mf from rw group by 1)"""
_READ_COLS = f"""i as total_reads_initial, f as total_reads_final, {R('mi')} as mean_reads_per_insertion_initial, {R('mf')} as mean_reads_per_insertion_final, {R('log2((f+1.0)/(i+1.0))')} as total_reads_log2fc,
 {R('g0.g')} as gini_coefficient_of_depth_initial, {R('g1.g')} as gini_coefficient_of_depth_final"""


@check("gene_reads", f"with {_ROWS}, {_READS} select rd.Systematic_ID, {_READ_COLS} from rd join g0 on g0.Systematic_ID=rd.Systematic_ID join g1 on g1.Systematic_ID=rd.Systematic_ID")
def _(s: Inputs) -> DataFrame:
    return dn.gene_reads(_gene_insertions(s), rounded=False)


_STRAND = """sa as (select Systematic_ID, Coordinate, sum(case when Insertion_direction='Forward' then 1 else 0 end) as fw, sum(case when Insertion_direction='Reverse' then 1 else 0 end) as rv, count(*) as n from rw group by 1,2),
 sd as (select Systematic_ID, cast(sum(fw) as bigint) as forward_insertions, cast(sum(rv) as bigint) as reverse_insertions, sum(n) as n, cast(sum(case when fw>0 and n>fw then 1 else 0 end) as bigint) as paired_sites, count(*) as sites from sa group by 1)"""
_STRAND_COLS = f"""forward_insertions, reverse_insertions, {R('1.0*forward_insertions/n')} as forward_preference, {R('1.0*reverse_insertions/n')} as reverse_preference, {R('abs(1.0*forward_insertions/n-0.5)')} as strand_bias,
 paired_sites, {R('1.0*paired_sites/sites')} as paired_sites_fraction"""


@check("gene_strand", f"with {_ROWS}, {_STRAND} select Systematic_ID, {_STRAND_COLS} from sd")
def _(s: Inputs) -> DataFrame:
    return dn.gene_strand(_gene_insertions(s), rounded=False)


_REPORT = f"""{_ROWS}, {_DENS}, {_GAPS}, {_READS}, {_STRAND},
 att as (select Systematic_ID, min(Name) as Name, min(Chr_Interval) as Chr, min(ParentalRegion_start) as Start, min(ParentalRegion_end) as End_, min(ParentalRegion_length) as Length, min(Strand_Interval) as Strand, min(FYPOviability) as FYPOviability from rw group by 1),
 dc as (select Systematic_ID, {_DENS_COLS} from dens),
 gc as (select gaps.Systematic_ID, {_GAP_COLS} from gaps join gini on gini.Systematic_ID=gaps.Systematic_ID),
 rc as (select rd.Systematic_ID, {_READ_COLS} from rd join g0 on g0.Systematic_ID=rd.Systematic_ID join g1 on g1.Systematic_ID=rd.Systematic_ID),
 tc as (select Systematic_ID, {_STRAND_COLS} from sd),
 report as (select * from att join dc using (Systematic_ID) join gc using (Systematic_ID) join rc using (Systematic_ID) join tc using (Systematic_ID))"""


def _report(s: Inputs) -> DataFrame:
    return dn.gene_density_report(s.stored_hard, s.stored_ann, "YES0", "YES4", key=SITE, rounded=False)


@check("gene_density_report", f"with {_REPORT} select * from report")
def _(s: Inputs) -> DataFrame:
    return _report(s).withColumnRenamed("End", "End_")


def _avg(c: str) -> str:
    return f"{R(f'avg({c})', 5)} as mean_{c}"


def _n(cond: str, name: str) -> str:
    return f"cast(sum(case when {cond} then 1 else 0 end) as bigint) as {name}"


@check("density_summary", f"""with {_REPORT} select count(*) as total_genes_analyzed, cast(sum(total_insertions) as bigint) as total_insertions_analyzed, cast(sum(unique_sites_initial) as bigint) as total_unique_sites_initial,
 cast(sum(unique_sites_final) as bigint) as total_unique_sites_final, {R('avg(total_insertions)', 5)} as mean_insertions_per_gene, {R('median(total_insertions)', 5)} as median_insertions_per_gene,
 {_avg('insertion_density_per_kb_initial')}, {_avg('insertion_density_per_kb_final')}, {R('median(insertion_density_per_kb_initial)', 5)} as median_insertion_density_per_kb_initial,
 {R('median(insertion_density_per_kb_final)', 5)} as median_insertion_density_per_kb_final, {_avg('insertion_density_log2fc')}, {_n('insertion_density_log2fc < -0.5', 'genes_with_density_drop')}, {_avg('gini_coefficient_of_location')},
 {_n('gini_coefficient_of_location > 0.5', 'genes_with_high_inequality_of_location')}, {_avg('gini_coefficient_of_depth_initial')}, {_n('gini_coefficient_of_depth_initial > 0.5', 'genes_with_high_inequality_of_depth')},
 {_avg('strand_bias')}, {_n('strand_bias > 0.2', 'genes_with_strong_strand_bias')}, {_avg('paired_sites_fraction')}, {_n('paired_sites_fraction > 0.5', 'genes_with_high_paired_sites_fraction')} from report""")
def _(s: Inputs) -> DataFrame:
    from checks.framework import rounded

    return rounded(dn.density_summary(checkpointed(_report(s))), 5)


# --- curves ----------------------------------------------------------------------------------

_X = [GENERATIONS[t] for t in TIMEPOINTS]
_IDS = "Chr, Coordinate, Strand, Sample"
_CELLS = ", ".join(f"max(case when Timepoint='{t}' then LFC end) as y_{i}, cast(1 as double) as w_{i}" for i, t in enumerate(TIMEPOINTS))
_CURVES = f"cur as (select {_IDS}, {_CELLS} from v_series group by 1,2,3,4)"
_E = "2.718281828459045"


def _gomp(x: str, a: str = '"A"', r: str = '"DR"', d: str = '"DL"') -> str:
    u = f"least(greatest({r}*{_E}/{a}*({d}-({x}))+1, -700), 700)"
    return f"case when {a}=0 then 0 else {a}*exp(-exp({u})) end"


def _loss(x: str, y: str) -> str:
    z = f"power({y}-({_gomp(x)}), 2)"
    return f"case when {z}<=1 then {z} else 2*sqrt({z})-1 end"


_OBJ = "0.006*abs(\"DL\") + " + " + ".join(f"({_loss(str(x), f'y_{i}')})" for i, x in enumerate(_X))


def _curves(s: Inputs) -> DataFrame:
    return cv.curve_table(s.series, [*SITE, "Sample"], GENERATIONS)


_PARAMS = """select l_orderkey, l_linenumber, l_partkey, l_linenumber*1.5e0 as x, case when l_quantity=7 then 0 else l_quantity/10 end as "A", 0.05e0+l_discount*5 as "DR", l_tax*50 as "DL" from lineitem"""


@check("gompertz_eval", f"with p as ({_PARAMS}) select l_orderkey, l_linenumber, l_partkey, {R(_gomp('x'))} as value from p")
def _(s: Inputs) -> DataFrame:
    p = s.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_linenumber") * 1.5).alias("x"),
        F.when(F.col("l_quantity") == 7, 0.0).otherwise(F.col("l_quantity") / 10).alias("A"),
        (F.lit(0.05) + F.col("l_discount") * 5).alias("DR"), (F.col("l_tax") * 50).alias("DL"),
    )
    value = fc.gompertz_eval(F.col("x"), F.col("A"), F.col("DR"), F.col("DL"))
    return p.select("l_orderkey", "l_linenumber", "l_partkey", value.alias("value"))


_GIVEN = f"""{_CURVES}, giv as (select *, 0.5e0+(Coordinate % 7) as "A", 0.05e0+(Coordinate % 11)/10.0e0 as "DR", (Coordinate % 5)*0.5e0 as "DL" from cur)"""


def _given(s: Inputs) -> DataFrame:
    c = F.col("Coordinate")
    return _curves(s).withColumns({
        "A": F.lit(0.5) + c % 7, "DR": F.lit(0.05) + (c % 11) / 10.0, "DL": (c % 5) * 0.5,
    })


_ALPHA = f'("DR"*{_E}/"A")'


@check("fit_objective", f"""with {_GIVEN} select {_IDS}, {R(_OBJ)} as objective, {R('12.48+3-abs("A")/abs("DR")-"DL"')} as span_slack,
 {R(f'abs("DR")*{_E}*(exp({_ALPHA}-exp({_ALPHA}))+exp(-{_ALPHA}-exp(-{_ALPHA}))) - 1.8*abs("DR")')} as smooth_slack from giv""")
def _(s: Inputs) -> DataFrame:
    a, r, d = F.col("A"), F.col("DR"), F.col("DL")
    points = [(F.lit(x), F.col(f"y_{i}"), F.col(f"w_{i}")) for i, x in enumerate(_X)]
    return _given(s).select(
        *SITE, "Sample", fc.fit_objective(points, a, r, d).alias("objective"),
        fc.span_slack(a, r, d, _X[-1]).alias("span_slack"), fc.smooth_slack(a, r, d).alias("smooth_slack"),
    )


def _values(vals) -> str:
    return "(values " + ",".join(f"(cast({v} as double))" for v in vals) + ")"


_GRID = f"""grid as (select a as "A", a/s as "DR", d as "DL" from {_values((-0.5, 0.25, 0.5, 1, 2, 3, 4, 6, 8))} ga(a), {_values((6.5, 8, 10, 12, 14))} gs(s), {_values((0, 1, 2, 3, 4, 6, 8))} gd(d) where s<=15.48-d)"""


@check("fit_grid", f"""with {_CURVES}, {_GRID}, e as (select {_IDS}, round({_OBJ}, 6) as objective, "A", "DR", "DL" from cur, grid),
 o as (select *, row_number() over (partition by {_IDS} order by objective, "A", "DR", "DL") as rn from e)
select {_IDS}, {R('objective')} as objective, {R('"A"')} as "A", {R('"DR"')} as "DR", {R('"DL"')} as "DL" from o where rn=1""")
def _(s: Inputs) -> DataFrame:
    return cv.fit_grid(_curves(s), GENERATIONS)


_RES = " + ".join(f"power(y_{i}-({_gomp(str(x))}), 2)" for i, x in enumerate(_X))
_MEAN = "(" + "+".join(f"y_{i}" for i in range(5)) + ")/5"
_TOT = " + ".join(f"power(y_{i}-{_MEAN}, 2)" for i in range(5))
_YS = ",".join(f"y_{i}" for i in range(5))


def _tp(p: float) -> str:
    return f'("DL" - abs("A")/(abs("DR")*{_E})*(ln(-ln({p}))-1))'


def _metrics(r) -> str:
    """The metrics of the given curves; ``r`` wraps each value."""
    values = {
        "t10": _tp(0.1), "t50": _tp(0.5), "t90": _tp(0.9), "t_window": _tp(0.9) + "-" + _tp(0.1),
        "t_inflection": f'"DL"+abs("A")/(abs("DR")*{_E})', "y_inflection": f'"A"/{_E}', "auc": "auc",
        "AIC": "5*ln(ss/5)+6", "BIC": "5*ln(ss/5)+3*ln(5)", "R2": "case when st>0 then 1-ss/st else 0 end",
        "RMSE": "sqrt(ss/5)", "normalized_RMSE": "case when sp>0 then sqrt(ss/5)/sp end",
    }
    return f"""{_GIVEN}, m as (select *, {_RES} as ss, {_TOT} as st, greatest({_YS})-least({_YS}) as sp from giv),
 ar as (select {_IDS}, (12.48e0/999)*(sum({_gomp('k*12.48e0/999')}) - 0.5*({_gomp('0')}+{_gomp('12.48e0')})) as auc from giv, range(1000) t(k) group by {_IDS}, "A", "DR", "DL"),
 mt as (select m.Chr, m.Coordinate, m.Strand, m.Sample, m."A", m."DR", {", ".join(f'{r(v)} as "{n}"' for n, v in values.items())}
 from m join ar on ar.Chr=m.Chr and ar.Coordinate=m.Coordinate and ar.Strand=m.Strand and ar.Sample=m.Sample)"""


@check("fit_metrics", f"""with {_metrics(R)} select * exclude ("A", "DR") from mt""")
def _(s: Inputs) -> DataFrame:
    return cv.fit_metrics(_given(s), GENERATIONS, rounded=False).select(*SITE, "Sample", *cv.METRICS)


_POINTS = " union all ".join(
    f"""select {_IDS}, '{t}' as timepoint, round(y_{i},3) as o, round({_gomp(str(x))},3) as f from giv""" for i, (t, x) in enumerate(zip(TIMEPOINTS, _X)))


@check("fit_residuals", f"with {_GIVEN}, pt as ({_POINTS}) select {_IDS}, timepoint, {R('o')} as observed, {R('f')} as fitted, {R('o-f', 3)} as residual from pt")
def _(s: Inputs) -> DataFrame:
    return cv.fit_residuals(_given(s), GENERATIONS).select(*SITE, "Sample", F.inline("points"))


@check("fit_curves", f"""with {_CURVES}, {_GRID}, e as (select {_IDS}, {_OBJ} as objective from cur, grid)
select {_IDS}, {R('min(objective)')} as grid_objective, 'Success' as "Status", true as no_worse, true as feasible from e group by {_IDS}""")
def _(s: Inputs) -> DataFrame:
    """Every fit: settled, within its constraints and at least as good as the best point of a grid."""
    curves = checkpointed(_curves(s))
    fits = cv.fit_curves(curves, GENERATIONS)
    grid = cv.fit_grid(curves, GENERATIONS).select(*[F.col(c).alias(f"g_{c}") for c in (*SITE, "Sample", "objective")])
    same = [F.col(c) == F.col(f"g_{c}") for c in (*SITE, "Sample")]
    a, r, d = F.col("A"), F.col("DR"), F.col("DL")
    flat = (F.abs(a) < 1e-9) | (F.abs(r) < 1e-9)
    feasible = (d >= cv.DL_LOW - 1e-9) & (a >= cv.A_LOW - 1e-9) & (flat | (fc.span_slack(a, r, d, _X[-1]) >= -1e-5))
    return fits.join(grid, same).select(
        *SITE, "Sample", F.col("g_objective").alias("grid_objective"), "Status",
        (F.col("objective") <= F.col("g_objective") + 1e-6).alias("no_worse"), feasible.alias("feasible"))


_PLAIN = f"""{_CURVES}, pl as (select *, 0.5e0+(Coordinate % 7) as "A", (0.5e0+(Coordinate % 7))/(7.0e0+(Coordinate % 11)/2.0e0) as "DR", 0.0e0 as "DL" from cur)"""


@check("fit_curves_recovered", f"""with {_PLAIN} select {_IDS}, {R('"A"', 3)} as "A", {R('"DR"', 3)} as "DR", {R('"DL"', 3)} as "DL", 'Success' as "Status" from pl""")
def _(s: Inputs) -> DataFrame:
    """Curves without noise come back with their parameters."""
    c = F.col("Coordinate")
    given = _curves(s).withColumns({"ga": F.lit(0.5) + c % 7, "gr": (F.lit(0.5) + c % 7) / (F.lit(7.0) + (c % 11) / 2.0)})
    exact = given.withColumns({f"y_{i}": fc.gompertz_eval(F.lit(x), F.col("ga"), F.col("gr"), F.lit(0.0)) for i, x in enumerate(_X)})
    return rounded(cv.fit_curves(exact, GENERATIONS).select(*SITE, "Sample", "A", "DR", "DL", "Status"), 3)


@check("fit_curves_parameters")
def _(s: Inputs) -> DataFrame:
    return cv.fit_report(_curves(s), GENERATIONS).drop("points")


_MEANS = ("R2", "RMSE", "A", "DR", "t10", "t50", "t90", "t_window", "t_inflection", "y_inflection", "auc", "AIC", "BIC")


@check("fit_summary", f"""with {_metrics(lambda v: v)}, ok as (select *, Coordinate % 7 <> 3 as good from mt)
select count(*) as total_datasets, cast(sum(case when good then 1 else 0 end) as bigint) as successful_fits, {R('100.0*sum(case when good then 1 else 0 end)/count(*)')} as success_rate,
 {", ".join(R(f'avg(case when good then "{c}" end)') + f' as "mean_{c}"' for c in _MEANS)} from ok""")
def _(s: Inputs) -> DataFrame:
    status = F.when(F.col("Coordinate") % 7 == 3, cv.FAILED).otherwise(cv.OK)
    return cv.fit_summary(cv.fit_metrics(_given(s), GENERATIONS, rounded=False).withColumn("Status", status))


_TESTS = f"""select Chr, Coordinate, Strand, Timepoint, cast(Reads as double) as baseMean,
 case when Coordinate % 13 = 5 then null else cast(((Coordinate*7919+Reads*31) % 997) * ((Coordinate*7919+Reads*31) % 997) as double)/3000000 end as pvalue from v_hard where Sample='S0'"""


@check("filter_rejections", f"""with s as ({_TESTS}), c as (select * from (values (0, 0.0e0), (1, 8.0e0), (2, 25.0e0), (3, 60.0e0)) v(cutoff, least)),
 t as (select Timepoint, cutoff, pvalue, count(*) over (partition by Timepoint, cutoff) as m,
  count(*) over (partition by Timepoint, cutoff order by pvalue range between unbounded preceding and current row) as k from s join c on baseMean>=least where pvalue is not null)
select Timepoint, cast(cutoff as int) as cutoff, cast(max(m) as bigint) as tests, cast(max(case when pvalue*m/k < 0.05e0 then k else 0 end) as bigint) as rejected from t group by 1, 2""")
def _(s: Inputs) -> DataFrame:
    return rp.rejections(s.sql(_TESTS), [0.0, 8.0, 25.0, 60.0], 0.05, ["Timepoint"])


# --- models and plans ------------------------------------------------------------------------

def _solved(cells: Column, alpha: Column) -> Column:
    """Mean q of one condition at a dispersion: the root of sum (k - s q) / (1 + alpha s q), by fixed-point steps."""

    def step(q: Column, _) -> Column:
        weight = lambda x: x["s"] / (1 + alpha * x["s"] * q)
        top = F.aggregate(cells, F.lit(0.0), lambda t, x: t + weight(x) * x["k"] / x["s"])
        return top / F.aggregate(cells, F.lit(0.0), lambda t, x: t + weight(x))

    start = F.aggregate(cells, F.lit(0.0), lambda t, x: t + x["k"] / x["s"]) / F.size(cells)
    return F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, step)


@check("replicate_scores", f"""with {_RATIO}, n as (select c.*, Reads/size_factor as n from v_complete c join sf on sf.Sample=c.Sample and sf.Timepoint=c.Timepoint),
 m as (select Chr, Coordinate, Strand, avg(n) as mean from n group by 1,2,3)
select k.Chr, k.Coordinate, k.Strand, k.Timepoint, {R('mean', 3)} as "baseMean", true as lfc_holds, true as se_holds, true as stat_holds, true as padj_holds
from (select distinct Chr, Coordinate, Strand, Timepoint from v_complete) k join m on {_on('k', 'm')}""")
def _(s: Inputs) -> DataFrame:
    """Every score against the score equations of its model, solved here from the counts and the reported dispersion."""
    controls = checkpointed(s.controls)
    scores = checkpointed(rp.replicate_scores(s.stored_hard, controls, "YES0", key=SITE, rounded=False, details=True))
    complete = st.complete_cases(s.stored_hard, key=SITE)
    cell = F.struct(F.col("Reads").cast("double").alias("k"), F.col("size_factor").alias("s"))
    cells = complete.join(sc.size_factors(complete, controls, SITE), ["Sample", "Timepoint"]).groupBy(*SITE, "Timepoint").agg(F.collect_list(cell).alias("cells"))
    alpha = F.col("dispersion")
    solved = scores.join(cells, [*SITE, "Timepoint"]).withColumn("q", _solved(F.col("cells"), alpha))
    solved = solved.withColumn("info", F.aggregate("cells", F.lit(0.0), lambda t, x: t + x["s"] * F.col("q") / (1 + alpha * x["s"] * F.col("q"))))
    solved = solved.withColumn("least", F.col("q") * F.array_min(F.transform("cells", lambda x: x["s"])))
    start = solved.filter(F.col("Timepoint") == "YES0").select(*[F.col(c).alias(f"o_{c}") for c in (*SITE, "q", "info", "least")])
    both = solved.join(start, [F.col(c) == F.col(f"o_{c}") for c in SITE])
    later = F.col("Timepoint") != "YES0"
    seen = later & (F.col("least") > 0.5) & (F.col("o_least") > 0.5)  # the model holds means up to half a read
    near = lambda a, b, tol: F.abs(a - b) <= tol * (1 + F.abs(b))
    ratio = F.try_divide
    lfc = F.log2(ratio(F.col("o_q"), F.col("q")))
    se = F.sqrt(ratio(F.lit(1.0), F.col("info")) + ratio(F.lit(1.0), F.col("o_info"))) / F.ln(F.lit(2.0))
    padj = F.col("padj").isNull() | ((F.col("padj") >= F.col("pvalue") - 1e-12) & (F.col("padj") <= 1))
    return both.select(
        *SITE, "Timepoint", F.round("baseMean", 3).alias("baseMean"), (~seen | near(F.col("LFC"), lfc, 1e-5)).alias("lfc_holds"),
        (~seen | near(F.col("lfcSE"), se, 1e-5)).alias("se_holds"),
        (~later | near(F.col("stat"), ratio(F.col("LFC"), F.col("lfcSE")), 1e-9)).alias("stat_holds"), F.coalesce(padj, F.lit(True)).alias("padj_holds"))


@check("replicate_scores_values")
def _(s: Inputs) -> DataFrame:
    return rp.replicate_scores(s.stored_hard, checkpointed(s.controls), "YES0", key=SITE)


@check("split_statistics", f"""with {_MA} select Chr, Coordinate, Strand, Sample, Timepoint, '"LFC"' as statistic, {R('-log2((n+1)/(i+1))', 3)} as value from ma
 union all select Chr, Coordinate, Strand, Sample, Timepoint, '"baseMean"', {R('i', 3)} from ma""".replace("""'"LFC"'""", "'LFC'").replace("""'"baseMean"'""", "'baseMean'"))
def _(s: Inputs) -> DataFrame:
    parts = rp.split_statistics(sc.ma_scores(s.stored_hard, s.controls, "YES0", SITE, digits=None), SITE)
    one, two = (parts[c].withColumn("statistic", F.lit(c)) for c in ("LFC", "baseMean"))
    return one.unionByName(two)


_OF_GENE = """Systematic_ID is not null and Name is not null and FYPOviability is not null"""


@check("score_no_replicates", f"""with {_MA}, ig as (select distinct Chr, Coordinate, Strand from v_ann where Type<>'Intergenic region' and Distance_to_stop_codon>4),
 gr as (select a.Systematic_ID, ma.Sample, ma.Timepoint, round(-log2((n+1)/(i+1)), 3) as lfc from ma join ig on {_on('ma', 'ig')} join v_ann a on {_on('ma', 'a')} where {_OF_GENE.replace('Systematic_ID', 'a.Systematic_ID')})
select Systematic_ID, Sample, Timepoint, {R('min(lfc)', 3)} as lowest, {R('max(lfc)', 3)} as highest, true as between_them from gr group by 1,2,3""")
def _(s: Inputs) -> DataFrame:
    """A gene's score, whatever the fits weigh its insertions, lies between those of its insertions."""
    out = score_no_replicates(s.stored_hard, s.stored_ann, CONFIG)
    inside = in_gene_keys(s.stored_ann, GENE_STOP_DISTANCE, SITE)
    rows = semi_keys(out["scores"], inside, key=SITE).join(s.stored_ann.select(*SITE, "Systematic_ID", "Name", "FYPOviability"), list(SITE)).filter(_OF_GENE)
    ends = rows.groupBy("Systematic_ID", "Sample", "Timepoint").agg(F.min("LFC").alias("lowest"), F.max("LFC").alias("highest"))
    near = 0.0006  # scores are rounded to three digits
    held = out["genes"].join(ends, ["Systematic_ID", "Sample", "Timepoint"])
    return rounded(held.select("Systematic_ID", "Sample", "Timepoint", "lowest", "highest",
                               ((F.col("LFC") >= F.col("lowest") - near) & (F.col("LFC") <= F.col("highest") + near)).alias("between_them")), 3)


@check("score_no_replicates_genes")
def _(s: Inputs) -> DataFrame:
    return score_no_replicates(s.stored_hard, s.stored_ann, CONFIG)["genes"]


@check("score_no_replicates_insertions", f"""with {_MA} select Chr, Coordinate, Strand, Sample, Timepoint, {R('-log2((n+1)/(i+1))', 3)} as "LFC" from ma""")
def _(s: Inputs) -> DataFrame:
    return score_no_replicates(s.stored_hard, s.stored_ann, CONFIG)["scores"].select(*SITE, "Sample", "Timepoint", "LFC")


@check("score_replicates", f"""with {_IMPUTED}, live as (select Chr, Coordinate, Strand from imp group by 1,2,3 having sum(Reads)>0),
 ig as (select distinct Chr, Coordinate, Strand from v_ann where Type<>'Intergenic region' and Distance_to_stop_codon>4),
 gr as (select a.Systematic_ID from live join ig on {_on('live', 'ig')} join v_ann a on {_on('live', 'a')} where {_OF_GENE.replace('Systematic_ID', 'a.Systematic_ID')})
select Systematic_ID, t.Timepoint, count(*) as insertions, true as between_them, true as fitted from gr cross join (select distinct Timepoint from v_hard) t group by 1,2""")
def _(s: Inputs) -> DataFrame:
    """Genes of the replicate branch: the insertions behind each, its score between theirs, its curve settled."""
    out = score_replicates(s.stored_hard, s.stored_ann, CONFIG)
    inside = in_gene_keys(s.stored_ann, GENE_STOP_DISTANCE, SITE)
    scored = out["scores"].filter(F.col("LFC").isNotNull()).select(*SITE, "Timepoint", "LFC")
    rows = semi_keys(scored, inside, key=SITE).join(s.stored_ann.select(*SITE, "Systematic_ID", "Name", "FYPOviability"), list(SITE)).filter(_OF_GENE)
    ends = rows.groupBy("Systematic_ID", "Timepoint").agg(F.count(F.lit(1)).alias("insertions"), F.min("LFC").alias("lowest"), F.max("LFC").alias("highest"))
    fits = out["gene_fits"].select("Systematic_ID", (F.col("Status") == cv.OK).alias("fitted"))
    held = out["genes"].join(ends, ["Systematic_ID", "Timepoint"]).join(fits, "Systematic_ID")
    near = 0.0006  # scores are rounded to three digits
    return held.select("Systematic_ID", "Timepoint", "insertions",
                       ((F.col("LFC") >= F.col("lowest") - near) & (F.col("LFC") <= F.col("highest") + near)).alias("between_them"), "fitted")


@check("score_replicates_fits")
def _(s: Inputs) -> DataFrame:
    return score_replicates(s.stored_hard, s.stored_ann, CONFIG)["gene_fits"].drop("points")


@check("qc_report", """
with o as (select Sample, Timepoint, count(*) as total_original_pairs from v_reads group by 1,2), k as (select Sample, Timepoint, count(*) as total_filtered_pairs from v_filt group by 1,2),
 u as (select Sample, Timepoint, count(*) as unique_sites from (select distinct Sample, Timepoint, Chr, Coordinate from v_sites) q group by 1,2),
 m as (select Sample, Timepoint, cast(sum(Reads) as bigint) as total_reads, cast(sum(case when PBL>0 and PBR>0 then 1 else 0 end) as bigint) as ends_points from v_merged group by 1,2),
 p as (select a.Sample, a.Timepoint, count(*) as orientation_points from v_counts a join v_counts b on a.Sample=b.Sample and a.Timepoint=b.Timepoint and a.Chr=b.Chr and a.Coordinate=b.Coordinate and a.Strand='+' and b.Strand='-' where a.Reads>0 and b.Reads>0 group by 1,2)
select * from o join k using (Sample, Timepoint) join u using (Sample, Timepoint) join m using (Sample, Timepoint) join p using (Sample, Timepoint)""")
def _(s: Inputs) -> DataFrame:
    out = qc_report(s.reads, s.counts, CONFIG)["rollup"]
    return out.select("Sample", "Timepoint", "total_original_pairs", "total_filtered_pairs", "unique_sites",
                      "total_reads", "ends_points", "orientation_points")


def _same_as(name: str, other: str, query) -> None:
    """A query that must give the rows of another one's SQL."""
    CHECKS[name] = Check(query, CHECKS[other].sql)


_same_as("qc_report_retention", "filter_retention", lambda s: qc_report(s.reads, s.counts, CONFIG)["retention"])
_same_as("qc_report_merge", "count_insertions", lambda s: st.insertions_of(
    st.site_table(s.reads, rd.pair_condition(CONFIG.pair_filter))))


def _write_parts(reads: DataFrame, path: str, parts: int) -> int:
    """Reads as ``parts`` equal parts of as many files each as the input's size asks for; returns that number."""
    share = -(-4 * reads.rdd.getNumPartitions() // parts)
    reads.repartition(parts * share).write.parquet(path)
    return share


@check("incremental_site_count", "select * from v_sites")
def _(s: Inputs) -> DataFrame:
    root = s.scratch
    share = _write_parts(s.reads, f"{root}/pairs", 4)
    query = incremental_site_count(
        s.spark, f"{root}/pairs", s.reads.schema, f"{root}/checkpoint", f"{root}/sites",
        spec=CONFIG.pair_filter, files_per_trigger=2 * share,
    )
    query.awaitTermination()
    return running_site_counts(s.spark, f"{root}/sites")


@check("compact_site_counts", "select * from v_sites")
def _(s: Inputs) -> DataFrame:
    """The same counts from many small batches, merged in levels while they arrive."""
    root, output = f"{s.scratch}/pairs", f"{s.scratch}/sites"
    share = _write_parts(s.reads, root, 9)
    incremental_site_count(s.spark, root, s.reads.schema, f"{root}_checkpoint", output, spec=CONFIG.pair_filter, files_per_trigger=share).awaitTermination()
    live = compact_site_counts(s.spark, output, fan=3)
    if len(live) >= 9 or max(f.level for f in live) < 1:
        raise ValueError("nothing was merged")
    return running_site_counts(s.spark, output)
