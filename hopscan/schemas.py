"""Explicit table schemas. Missing values are NULL, never NaN or a sentinel string."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()

# Optional alignment tags carried per mate.
TAGS = ("AS", "MC", "MD", "MQ", "NM", "SA", "XA", "XS")
# End of fixed values.


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SAMPLE_SHEET = struct(*[(c, S) for c in ("Sample", "Timepoint", "Condition", "read1", "read2")])

ALIGNMENT = struct(
    ("qname", S), ("flag", I), ("rname", S), ("pos", L), ("mapq", I), ("cigar", S),
    ("tlen", L), ("seq", S), ("qual", S), ("tags", T.MapType(S, S)), ("ord", L),
)


def _mate(prefix: str, flag: str) -> list[tuple[str, T.DataType]]:
    longs = ("MAPQ", "LEN", "NCIGAR", "Pos", "Ref_Start", "Ref_End")
    texts = ("CIGAR", "Strand", "Chrom")
    return (
        [(f"{prefix}_{c}", L) for c in longs]
        + [(f"{prefix}_{c}", S) for c in texts]
        + [(flag, L)]
        + [(f"{prefix}_{t}", S) for t in TAGS]
    )


READ_PAIR = struct(
    ("QueryName", S), *_mate("R1", "R1_Flag"), *_mate("R2", "R2_FLAG"), ("Is_Proper_Pair", S)
)

REGION = struct(
    ("Chr", S), ("Start", L), ("End", L), ("Transcript", S), ("Length", L), ("Strand", S),
    ("Feature", S), ("Systematic_ID", S), ("Type", S), ("Accumulated_CDS_bases", L),
    ("Name", S), ("FYPOviability", S), ("DeletionLibrary_essentiality", S),
    ("ParentalRegion_start", L), ("ParentalRegion_end", L), ("ParentalRegion_length", L),
)

GFF = struct(
    ("Chr", S), ("Source", S), ("Feature", S), ("Start", L), ("End", L),
    ("Score", S), ("Strand", S), ("Frame", S), ("Attribute", S),
)

FIT_POINT = struct(("timepoint", S), ("observed", D), ("fitted", D), ("residual", D))
