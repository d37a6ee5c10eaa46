"""Flags, CIGAR strings and read orientation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Bits of the alignment flag.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED = 0x1, 0x2, 0x4, 0x8
REVERSE, READ1, READ2 = 0x10, 0x40, 0x80
SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 0x100, 0x200, 0x400, 0x800
# End of fixed values.

NOT_PRIMARY = UNMAPPED | SECONDARY | SUPPLEMENTARY


def has_bits(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) == bits


def lacks_bits(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) == 0


def flag_functions(flag: Column) -> dict[str, Column]:
    """The single-bit tests the engine needs, by name."""
    bits = {
        "is_paired": PAIRED, "is_proper": PROPER, "is_unmapped": UNMAPPED, "is_reverse": REVERSE,
        "is_read1": READ1, "is_read2": READ2, "is_secondary": SECONDARY,
        "is_supplementary": SUPPLEMENTARY,
    }
    return {name: has_bits(flag, bit) for name, bit in bits.items()}


def _usable(cigar: Column) -> Column:
    return F.when(cigar.isin("*", "N/A", ""), F.lit(None)).otherwise(cigar)


def cigar_ops(cigar: Column) -> Column:
    """Number of CIGAR operations; 0 without a CIGAR."""
    return F.coalesce(F.regexp_count(_usable(cigar), F.lit("[MIDNSHP=X]")), F.lit(0)).cast("bigint")


def _length_of(cigar: Column, ops: str) -> Column:
    sizes = F.regexp_extract_all(_usable(cigar), F.lit(rf"(\d+)[{ops}]"), F.lit(1))
    total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda acc, n: acc + n.cast("bigint"))
    return F.coalesce(total, F.lit(0))


def cigar_reference_length(cigar: Column) -> Column:
    """Reference bases consumed: M, D, N, = and X."""
    return _length_of(cigar, "MDN=X")


def cigar_aligned_length(cigar: Column) -> Column:
    """Query bases inside the alignment: M, I, = and X (clips excluded)."""
    return _length_of(cigar, "MI=X")


def cigar_functions(cigar: Column) -> dict[str, Column]:
    return {
        "n_ops": cigar_ops(cigar),
        "reference_length": cigar_reference_length(cigar),
        "aligned_length": cigar_aligned_length(cigar),
    }


def insertion_coordinate(strand: Column, start: Column, end: Column) -> Column:
    """Insertion site of a read: 4 bases into a forward read, the end of a reverse one."""
    return F.when(strand == "+", start + 4).otherwise(end).cast("bigint")


def flip_strand(strand: Column) -> Column:
    return F.when(strand == "-", F.lit("+")).otherwise(F.lit("-"))
