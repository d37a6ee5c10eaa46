"""Identifiers, sample names and small label rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Attribute patterns of the genome annotation.
SYSTEMATIC_ID_PATTERN = r"ID=(\S+?)(?:$|(?:|\.\d(?::\S+|));)"
TRANSCRIPT_PATTERN = r"ID=([^:;]+)"
PARENT_PATTERN = r"Parent=([^;]+)"
FASTQ_NAME_PATTERN = r"\.(fq|fastq)\.gz$"
# End of fixed values.


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def null_if_missing(c: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(~c.isin(*tokens), c)


def gff_systematic_id(attribute: Column) -> Column:
    return null_if_empty(F.regexp_extract(attribute, SYSTEMATIC_ID_PATTERN, 1))


def gff_transcript(feature: Column, attribute: Column, transcript_features) -> Column:
    own = null_if_empty(F.regexp_extract(attribute, TRANSCRIPT_PATTERN, 1))
    parent = null_if_empty(F.regexp_extract(attribute, PARENT_PATTERN, 1))
    return F.when(feature.isin(*transcript_features), own).otherwise(parent)


def gff_attributes(feature: Column, attribute: Column, transcript_features) -> dict[str, Column]:
    return {
        "Systematic_ID": gff_systematic_id(attribute),
        "Transcript": gff_transcript(feature, attribute, transcript_features),
    }


def bed_coordinates(start: Column, end: Column) -> dict[str, Column]:
    """1-based closed to 0-based half-open."""
    return {"Start": start - 1, "End": end, "Length": end - start + 1}


def orientation_label(left: Column, right: Column) -> Column:
    return (
        F.when((left == "+") & (right == "-"), "Convergent")
        .when((left == "-") & (right == "+"), "Divergent")
        .when((left == "+") & (right == "+"), "Tandem_Plus")
        .when((left == "-") & (right == "-"), "Tandem_Minus")
        .otherwise("Boundary_Adjacent")
    )


def case_normalize_id(c: Column) -> Column:
    """Trim; ids with a dot become UPPER.lower of their first two parts."""
    t = F.trim(c)
    parts = F.split(t, r"\.")
    dotted = F.concat_ws(".", F.upper(parts[0]), F.lower(F.get(parts, F.lit(1))))
    return F.when(F.instr(t, ".") > 0, dotted).otherwise(t)


def strip_suffix(c: Column, suffix: str) -> Column:
    shorter = F.substr(c, F.lit(1), F.length(c) - len(suffix))
    return F.when(F.endswith(c, F.lit(suffix)), shorter).otherwise(c)


def sample_of_path(path: Column) -> Column:
    """File name up to its first dot."""
    return F.split(F.regexp_extract(path, r"([^/]+)$", 1), r"\.")[0]


def timepoint_of_path(path: Column, timepoints) -> Column:
    """The timepoint label found as ``_<label>_`` in the file name; NULL if none is."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    out = F.lit(None).cast("string")
    for tp in timepoints:
        out = F.when(F.instr(name, f"_{tp}_") > 0, F.lit(tp)).otherwise(out)
    return out


def split_sample_name(path: Column, timepoints) -> dict[str, Column]:
    return {"Sample": sample_of_path(path), "Timepoint": timepoint_of_path(path, timepoints)}
