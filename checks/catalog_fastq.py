"""Raw reads: adapters, junctions, quality and duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.framework import R, Inputs, check
from hopscan.config import Junctions
from hopscan.operators import fastq as fq

J = Junctions()

_ADAPTED = f"""select name, concat(seq1, substr('{J.adapter_r1}', 1, a1), case when a1=19 then 'ACGT' else '' end) as seq1, concat(qual1, repeat('I', a1), case when a1=19 then 'IIII' else '' end) as qual1,
 concat(seq2, substr('{J.adapter_r2}', 1, a2)) as seq2, concat(qual2, repeat('I', a2)) as qual2
 from (select *, cast(length(qual1)*7 % 20 as int) as a1, cast((length(qual2)*5+length(qual1)) % 34 as int) as a2 from v_fastq) x"""


def _suffix(seq: str, adapter: str, least: int) -> str:
    """Bases kept before a whole adapter, or before its longest prefix that ends the read."""
    sizes = f"[n for n in range({least}, {len(adapter)}) if {seq} like concat('%', substr('{adapter}',1,n))]"
    return f"""case when strpos({seq},'{adapter}')>0 then strpos({seq},'{adapter}')-1 else length({seq})-coalesce(list_max({sizes}),0) end"""


@check("adapter_trim", f"""with f as ({_ADAPTED}), k as (select *, {_suffix('seq1', J.adapter_r1, 4)} as k1, {_suffix('seq2', J.adapter_r2, 4)} as k2 from f)
select name, substr(seq1,1,k1) as seq1, substr(qual1,1,k1) as qual1, substr(seq2,1,k2) as seq2, substr(qual2,1,k2) as qual2 from k""")
def _(s: Inputs) -> DataFrame:
    return fq.adapter_trim(s.sql(_ADAPTED))


def _edited(seq: str, at: int, kind: str) -> str:
    """A sequence with no edit, another base, a base more or a base less at a place, by ``kind``."""
    other = f"translate(substr({seq},{at},1),'ACGT','CGTA')"
    return f"""case {kind} when 1 then concat(substr({seq},1,{at - 1}),{other},substr({seq},{at + 1})) when 2 then concat(substr({seq},1,{at}),{other},substr({seq},{at + 1}))
 when 3 then concat(substr({seq},1,{at - 1}),substr({seq},{at + 1})) else {seq} end"""


# Planted pairs: junction at some offset with one edit on either mate, and the expected label and rests.
_PLANTED = f"""select name, Sample, Fragment, concat(lead, e1, body, tail1) as seq1, concat(repeat('I', cast(length(concat(lead, e1, body)) as int)), repeat('#', cast(length(tail1) as int))) as qual1,
 concat(reverse(body), e2, 'ACGTAC') as seq2, repeat('5', cast(length(concat(reverse(body), e2, 'ACGTAC')) as int)) as qual2,
 case when k1=4 then 'unknown' else Fragment end as want, case when k1=4 then concat(lead, e1, body) else body end as want1, case when k1=4 then concat(reverse(body), e2, 'ACGTAC') else reverse(body) end as want2
 from (select *, case when k1=4 then concat(body, reverse(body)) else {_edited('j', 12, 'k1')} end as e1, {_edited('jr', 20, 'k2')} as e2 from (
 select QueryName as name, Sample, Fragment, substr('GATTACAGATTACA', 1, cast(R1_MAPQ % 8 as int)) as lead, cast((R1_Ref_Start + R1_MAPQ) % 5 as int) as k1, cast((R1_Ref_Start*3 + R1_MAPQ) % 4 as int) as k2,
  substr('CCCC', 1, cast(R1_MAPQ % 4 as int)) as tail1, case when Fragment='PBL' then '{J.pbl}' else '{J.pbr}' end as j, case when Fragment='PBL' then '{J.pbl_reverse}' else '{J.pbr_reverse}' end as jr,
  translate(lpad(cast(R1_Ref_Start*7919+R1_MAPQ as string),20,'0'),'0123456789','ACGTACGTAC') as body from v_reads) z) u"""


@check("junction_classify", f"""with p as ({_PLANTED}) select name, Sample, Fragment, want as junction, want1 as seq1, repeat('I', cast(length(want1) as int)) as qual1, want2 as seq2, repeat('5', cast(length(want2) as int)) as qual2 from p""")
def _(s: Inputs) -> DataFrame:
    return fq.junction_classify(s.sql(_PLANTED).drop("want", "want1", "want2"))


@check("junction_counts", f"""with p as ({_PLANTED}) select Sample, cast(sum(case when want='PBL' then 1 else 0 end) as bigint) as pbl, cast(sum(case when want='PBR' then 1 else 0 end) as bigint) as pbr,
 cast(sum(case when want='unknown' then 1 else 0 end) as bigint) as unknown from p group by 1""")
def _(s: Inputs) -> DataFrame:
    return fq.junction_counts(fq.junction_classify(s.sql(_PLANTED)), ["Sample"])


# Both mates of every pair, stacked.
_MATES = "mt as (select Sample, 1 as mate, seq1 as seq, qual1 as qual from v_fastq union all select Sample, 2, seq2, qual2 from v_fastq)"


def _both(s: Inputs, operator) -> DataFrame:
    """An operator on each mate, stacked."""
    one, two = (operator(s["v_fastq"], mate).withColumn("mate", F.lit(mate)) for mate in (1, 2))
    return one.unionByName(two)


def _base(b: str) -> str:
    return f"cast(sum(case when base='{b}' then 1 else 0 end) as bigint) as n_{b.lower()}"


@check("base_quality_profile", f"""
with {_MATES}, b as (select Sample, mate, p as cycle, substr(seq,cast(p as int),1) as base, ascii(substr(qual,cast(p as int),1))-33 as q from mt, unnest(range(1, length(seq)+1)) t(p))
select Sample, mate, cycle, count(*) as bases, {R('avg(q)')} as mean_quality, {", ".join(_base(x) for x in "ACGTN")}, {R('quantile_cont(q,0.25)')} as quality_q1, {R('quantile_cont(q,0.5)')} as quality_median,
 {R('quantile_cont(q,0.75)')} as quality_q3, {R("sum(case when base='N' then 1 else 0 end)/count(*)")} as n_share from b group by 1,2,3""")
def _(s: Inputs) -> DataFrame:
    return _both(s, lambda df, mate: fq.base_quality_profile(df, ["Sample"], mate))


@check("overrepresented_sequences", f"""
with {_MATES}, c as (select Sample, mate, seq as sequence, count(*) as reads from mt group by 1,2,3), t as (select Sample, count(*) as n from v_fastq group by 1)
select c.Sample, mate, sequence, reads, {R('cast(reads as double)/n')} as share from c join t on t.Sample=c.Sample where cast(reads as double)/n>=0.0005""")
def _(s: Inputs) -> DataFrame:
    return _both(s, lambda df, mate: fq.overrepresented_sequences(df, 0.0005, ["Sample"], mate))


@check("duplication_levels", f"""with {_MATES} select Sample, mate, level, count(*) as sequences, cast(sum(level) as bigint) as reads from (select Sample, mate, seq, count(*) as level from mt group by 1,2,3) c group by 1,2,3""")
def _(s: Inputs) -> DataFrame:
    return _both(s, lambda df, mate: fq.duplication_levels(df, ["Sample"], mate))
