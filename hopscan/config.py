"""Run parameters. Small frozen dataclasses handed to operators and plans."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column layout and thresholds that results must agree on.
SITE = ("Chr", "Coordinate", "Strand")
KEY = ("Chr", "Coordinate", "Strand", "Target")
INTERGENIC = "Intergenic region"
CODING = "Coding gene"
NON_CODING = "Non-coding gene"
MISSING_TOKENS = ("N/A", "NA", "")
NOT_DETERMINED = "Not_determined"
UNKNOWN_TARGET = "NNNN"
GENE_STOP_DISTANCE = 4
IMPUTE_STOP_DISTANCE = 3
BOUNDARY_DISTANCE = 500
CODING_EXPAND = 200
CHROMOSOME_ORDER = (
    "chr_II_telomeric_gap",
    "I",
    "II",
    "III",
    "mating_type_region",
    "mitochondrial",
)
TRANSCRIPT_FEATURES = ("mRNA", "tRNA", "rRNA", "snoRNA", "snRNA", "lncRNA")
NON_CODING_FEATURES = ("tRNA", "rRNA", "snoRNA", "snRNA", "lncRNA")
VIABILITY_ORDER = ("viable", "inviable", "condition-dependent", "unknown")
# End of fixed values.


@dataclass(frozen=True)
class MateThresholds:
    """Acceptance limits of one mate; ``None`` skips that test."""

    min_mapq: int | None = None
    max_ncigar: int | None = None
    max_nm: int | None = None
    forbid_sa: bool = True
    forbid_xa: bool = True


@dataclass(frozen=True)
class PairFilter:
    r1: MateThresholds = MateThresholds(20, 1, 3)
    r2: MateThresholds = MateThresholds(40, 10, 15)
    proper_pair: bool = True


@dataclass(frozen=True)
class Junctions:
    """Transposon ends searched at the 5' side of read 1 (reverse complement on read 2)."""

    # Junction and sequencing adapter sequences.
    pbl: str = "CATGCGTCAATTTTACGCAGACTATCTTTCTAGGG"
    pbr: str = "ACGCATGATTATCTTTAACGTACGTCACAATATGATTATCTTTCTAGGG"
    pbl_reverse: str = "CCCTAGAAAGATAGTCTGCGTAAAATTGACGCATG"
    pbr_reverse: str = "CCCTAGAAAGATAATCATATTGTGACGTACGTTAAAGATAATCATGCGT"
    adapter_r1: str = "CTGTCTCTTATACACATCT"
    adapter_r2: str = "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT"


@dataclass(frozen=True)
class RunConfig:
    """What differs between projects."""

    timepoints: tuple[str, ...]
    initial: str
    final: str | None = None
    cutoff: int = 8
    generations: dict[str, float] = field(default_factory=dict)
    pair_filter: PairFilter = PairFilter()
    similar: tuple[str, ...] = ()
    merged_name: str | None = None
    dropped: tuple[str, ...] = ()
    has_replicates: bool = False
    boundary_distance: int = BOUNDARY_DISTANCE
    key: tuple[str, ...] = KEY

    def __post_init__(self) -> None:
        if self.initial not in self.timepoints:
            raise ValueError(f"initial timepoint {self.initial!r} is not one of {self.timepoints}")
        if self.cutoff <= 0:
            raise ValueError("cutoff must be positive")
        if self.similar and not self.merged_name:
            raise ValueError("merging timepoints needs the name of the merged one")
        if self.generations and len(self.generations) < 3:
            raise ValueError("curve fitting needs at least three time points")

    @property
    def last(self) -> str:
        return self.final or self.timepoints[-1]
