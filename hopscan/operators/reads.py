"""From alignment lines to filtered read pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hopscan.config import MISSING_TOKENS, MateThresholds, PairFilter
from hopscan.functions import alignment as al
from hopscan.functions.labels import null_if_missing
from hopscan.schemas import TAGS

# Types the pair columns take after sentinel removal.
NUMERIC_TAGS = ("AS", "MQ", "NM", "XS")
DOUBLE_COLUMNS = ("LEN", "Pos", "Ref_Start", "Ref_End")
LONG_COLUMNS = ("MAPQ", "NCIGAR")
FLAG_COLUMNS = ("R1_Flag", "R2_FLAG")
# End of fixed values.


def primary_alignments(aln: DataFrame) -> DataFrame:
    """Mapped, primary, not supplementary."""
    return aln.filter(al.lacks_bits(F.col("flag"), al.NOT_PRIMARY))


def raw_fields(tags: Sequence[str]) -> list[Column]:
    """What of an alignment line ``line_fields`` needs, before anything is worked out."""
    return [*[F.col(c) for c in ("mapq", "cigar", "pos", "rname", "flag")], *[F.try_element_at("tags", F.lit(t)).alias(t) for t in tags]]


def line_fields(tags: Sequence[str], raw: Column | None = None) -> list[Column]:
    """What a pair keeps of an alignment line: of the row, or of a struct of ``raw_fields``."""

    def of(name: str) -> Column:
        return F.col(name) if raw is None else raw[name]

    cigar, flag, pos, rname = of("cigar"), of("flag"), of("pos"), of("rname")
    start = F.when(pos > 0, pos - 1)
    has_cigar = ~cigar.isin("*", "")
    strand = F.when(al.has_bits(flag, al.REVERSE), "-").otherwise("+")
    return [
        F.coalesce(of("mapq"), F.lit(0)).cast("bigint").alias("MAPQ"),
        al.cigar_aligned_length(cigar).alias("LEN"),
        al.cigar_ops(cigar).alias("NCIGAR"),
        start.alias("Pos"),
        start.alias("Ref_Start"),
        F.when(has_cigar, start + al.cigar_reference_length(cigar)).alias("Ref_End"),
        F.when(has_cigar, cigar).alias("CIGAR"),
        strand.alias("Strand"),
        F.when(rname != "*", rname).alias("Chrom"),
        flag.alias("flag"),
        *([raw[t].alias(t) for t in tags] if raw is not None else raw_fields(tags)[5:]),
    ]


def mate_columns(prefix: str, flag_name: str, tags: Sequence[str]) -> list[Column]:
    """Columns of one mate; a missing mate has zeros for quality, CIGAR count and flag."""
    m = F.col(prefix)
    zero = F.lit(0).cast("bigint")
    counted = [F.coalesce(m[c], zero).alias(f"{prefix}_{c}") for c in ("MAPQ", "NCIGAR")]
    plain = [
        m[c].alias(f"{prefix}_{c}")
        for c in ("LEN", "Pos", "Ref_Start", "Ref_End", "CIGAR", "Strand", "Chrom", *tags)
    ]
    return [*counted, *plain, F.coalesce(m["flag"], zero).cast("bigint").alias(flag_name)]


def pair_status(r1: Column, r2: Column) -> Column:
    """Proper-pair label: the first paired mate decides."""

    def verdict(flag: Column) -> Column:
        return F.when(al.has_bits(flag, al.PROPER), "Yes").otherwise("No")

    return (
        F.when(al.has_bits(r1["flag"], al.PAIRED), verdict(r1["flag"]))
        .when(al.has_bits(r2["flag"], al.PAIRED), verdict(r2["flag"]))
        .when(r1.isNotNull() | r2.isNotNull(), "Single_End_Or_Flag_Issue")
        .otherwise("N/A")
    )


def assemble_pairs(
    aln: DataFrame, tags: Sequence[str] = TAGS, by: Sequence[str] = ()
) -> DataFrame:
    """One row per query name from its first primary read 1 and first primary read 2.

    Each task keeps a name's earliest line per mate before the one shuffle, so a name that holds a
    large share of the lines is never gathered. Lines of neither mate only keep their name.
    """
    keys = [*by, "qname"]
    flag = F.col("flag")
    first = al.has_bits(flag, al.READ1)
    second = al.has_bits(flag, al.READ2) & al.lacks_bits(flag, al.READ1)
    lines = primary_alignments(aln).select(
        *keys, F.when(first, 1).when(second, 2).alias("_mate"), F.struct("ord", F.struct(*line_fields(tags)).alias("_line")).alias("_led"))
    mates = (
        lines.groupBy(*keys)
        .agg(*[F.min(F.when(F.col("_mate") == m, F.col("_led"))).alias(f"_{m}") for m in (1, 2)])
        .select(*keys, *[F.col(f"_{m}")["_line"].alias(f"R{m}") for m in (1, 2)])
    )
    return mates.select(
        *by, F.col("qname").alias("QueryName"),
        *mate_columns("R1", "R1_Flag", tags),
        *mate_columns("R2", "R2_FLAG", tags),
        pair_status(F.col("R1"), F.col("R2")).alias("Is_Proper_Pair"),
    )


def coerce_sentinels(pairs: DataFrame) -> DataFrame:
    """Sentinel strings become NULL and the numeric columns numbers; malformed values are NULL."""
    kinds: dict[str, str | None] = {}
    for mate in ("R1", "R2"):
        kinds |= {f"{mate}_{c}": "double" for c in DOUBLE_COLUMNS}
        kinds |= {f"{mate}_{c}": "bigint" for c in LONG_COLUMNS}
        kinds |= {f"{mate}_{t}": "double" if t in NUMERIC_TAGS else None for t in TAGS}
        kinds |= {f"{mate}_{c}": None for c in ("CIGAR", "Strand", "Chrom")}
    kinds |= {c: "bigint" for c in FLAG_COLUMNS}
    types = dict(pairs.dtypes)

    def clean(name: str) -> Column:
        c = F.col(name)
        if name not in kinds:
            return c
        if types[name] == "string":
            c = null_if_missing(c, MISSING_TOKENS)
        if kinds[name]:
            c = c.try_cast(kinds[name])
        return c.alias(name)

    return pairs.select(*[clean(c) for c in pairs.columns])


def _absent(name: str) -> Column:
    return F.col(name).isNull() | F.col(name).isin(*MISSING_TOKENS)


def mate_condition(prefix: str, limits: MateThresholds) -> list[Column]:
    tests: list[Column] = []
    if limits.min_mapq is not None:
        tests.append(F.col(f"{prefix}_MAPQ") >= limits.min_mapq)
    if limits.max_ncigar is not None:
        tests.append(F.col(f"{prefix}_NCIGAR") <= limits.max_ncigar)
    if limits.max_nm is not None:
        # Sentinels go first: a failing cast costs far more than a comparison.
        nm = null_if_missing(F.col(f"{prefix}_NM"), MISSING_TOKENS)
        tests.append(nm.try_cast("double") <= limits.max_nm)
    if limits.forbid_sa:
        tests.append(_absent(f"{prefix}_SA"))
    if limits.forbid_xa:
        tests.append(_absent(f"{prefix}_XA"))
    return tests


def pair_condition(spec: PairFilter) -> Column:
    """All acceptance tests as one predicate; an unknown value fails its test."""
    tests = mate_condition("R1", spec.r1) + mate_condition("R2", spec.r2)
    if spec.proper_pair:
        tests.append(F.lower("Is_Proper_Pair") == "yes")
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def filter_read_pairs(pairs: DataFrame, spec: PairFilter = PairFilter()) -> DataFrame:
    return pairs.filter(pair_condition(spec))


def valid_condition() -> Column:
    """Rows usable for site extraction."""
    located = F.lit(True)
    for c in ("R1_Chrom", "R1_Ref_Start", "R1_Ref_End"):
        located = located & F.col(c).isNotNull()
    return located & F.col("R1_Strand").isin("+", "-")


def valid_insertion_rows(pairs: DataFrame) -> DataFrame:
    return pairs.filter(valid_condition())


def with_coordinate(pairs: DataFrame) -> DataFrame:
    """Adds ``Chr``, ``Coordinate`` and ``Strand`` of the insertion read off mate 1."""
    return pairs.withColumns(
        {
            "Chr": F.col("R1_Chrom"),
            "Coordinate": al.insertion_coordinate(
                F.col("R1_Strand"), F.col("R1_Ref_Start"), F.col("R1_Ref_End")
            ),
            "Strand": F.col("R1_Strand"),
        }
    )
