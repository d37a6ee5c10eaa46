"""Raw reads: adapters, junctions and sequence quality."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from hopscan.config import Junctions
from hopscan.functions.sequence import adapter_cut, back_cut, front_cut
from hopscan.operators.frequent import frequent_values
from hopscan.operators.sites import count_where


def adapter_trim(
    fastq: DataFrame, adapter_r1: str = Junctions.adapter_r1,
    adapter_r2: str = Junctions.adapter_r2, min_overlap: int = 4, error_rate: float = 0.1,
) -> DataFrame:
    """Remove the sequencing adapter and what follows it from the 3' end of both mates."""
    adapters = {m: a for m, a in ((1, adapter_r1), (2, adapter_r2)) if f"seq{m}" in fastq.columns}
    # Both lengths are found in one pass, each once before both of its cuts.
    kept = {f"_keep{m}": adapter_cut(F.col(f"seq{m}"), a, min_overlap, error_rate) for m, a in adapters.items()}
    cuts = {c: F.substr(F.col(c), F.lit(1), F.col(f"_keep{m}")) for m in adapters for c in (f"seq{m}", f"qual{m}")}
    return fastq.withColumns(kept).withColumns(cuts).drop(*kept)


def junction_classify(
    fastq: DataFrame, junctions: Junctions = Junctions(), min_overlap: int = 15,
    error_rate: float = 0.1, quality: int = 15,
) -> DataFrame:
    """Label each pair by the transposon end found in read 1 and cut off all up to its end.

    Both mates lose their low-quality tail first; read 2 loses the reverse complement of the
    junction and what follows it. Edits are allowed on both mates. ``junction`` is PBL, PBR or
    unknown; the better score wins, PBL if equal.
    """
    fronts = {"PBL": junctions.pbl, "PBR": junctions.pbr}
    backs = {"PBL": junctions.pbl_reverse, "PBR": junctions.pbr_reverse}
    found = front_cut(F.col("seq1"), F.col("qual1"), fronts, min_overlap, error_rate, quality)
    out = fastq.withColumn("_found", found).withColumn("junction", F.col("_found.junction"))
    rest = F.col("_found.size") - F.col("_found.cut")
    cuts = {c: F.substr(F.col(c), F.col("_found.cut") + 1, rest) for c in ("seq1", "qual1")}
    if "seq2" in fastq.columns:
        keep = back_cut(F.col("seq2"), F.col("qual2"), F.col("junction"), backs, min_overlap, error_rate, quality)
        out = out.withColumn("_keep", keep)
        cuts |= {c: F.substr(F.col(c), F.lit(1), F.col("_keep")) for c in ("seq2", "qual2")}
    return out.withColumns(cuts).drop("_found", "_keep")


#: Letters that a profile tells apart; any other base counts as a base only.
BASES = "ACGTN"
#: Cycles, letters and qualities that one array of counts holds before it is sent on.
_LETTERS, _QUALITIES = len(BASES) + 1, 94
#: Reads of a group whose bases are written out at once, so that they stay in a core's cache.
_READS = 1000


def _cycle_counts(n_by: int, offset: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts by (group, cycle, base, quality) of a task's reads, added up in dense arrays, one a group."""
    letter = np.full(256, len(BASES), np.int64)
    letter[np.frombuffer(BASES.encode(), np.uint8)] = np.arange(len(BASES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple, np.ndarray] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            groups = list(zip(*(batch.column(i).to_pylist() for i in range(n_by)), strict=True)) if n_by else [()] * batch.num_rows
            place = {g: i for i, g in enumerate(dict.fromkeys(groups))}
            owner = np.array([place[g] for g in groups], np.int64)
            seq, qual = (batch.column(n_by + i).cast(pa.large_binary()) for i in (0, 1))
            bases, size = (pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (seq, qual))
            size[bases == 0] = 0  # a read without bases or qualities adds nothing
            if (bases < size).any():
                raise ValueError("a read has more qualities than bases")
            ends = np.searchsorted(owner, np.arange(len(place) + 1), sorter=(order := np.argsort(owner, kind="stable")))
            for group, i in place.items():
                for lo in range(ends[i], ends[i + 1], _READS):
                    rows = order[lo: min(lo + _READS, ends[i + 1])]
                    n = size[rows]
                    cycle = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    base = letter[_bytes(seq)[np.repeat(_offsets(seq)[rows], n) + cycle]]
                    quality = _bytes(qual)[np.repeat(_offsets(qual)[rows], n) + cycle].astype(np.int64) - offset
                    if len(quality) and not (0 <= quality.min() and quality.max() < _QUALITIES):
                        raise ValueError(f"qualities are not in the range of offset {offset}")
                    counts = np.bincount((cycle * _LETTERS + base) * _QUALITIES + quality)
                    held = tables.get(group, counts[:0])
                    longer, shorter = (counts, held) if len(counts) > len(held) else (held, counts)
                    longer[: len(shorter)] += shorter
                    tables[group] = longer
        for group, counts in tables.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * len(at), schema.field(i).type) for i, g in enumerate(group)]
                + [pa.array(at // _QUALITIES // _LETTERS + 1), pa.array((at // _QUALITIES % _LETTERS).astype(np.int32)),
                   pa.array((at % _QUALITIES).astype(np.int32)), pa.array(counts[at])],
                names=[*(schema.field(i).name for i in range(n_by)), "cycle", "base", "quality", "n"])

    return run


def _offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]


def _bytes(column: pa.Array) -> np.ndarray:
    data = column.buffers()[2]
    return np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)


def base_quality_profile(
    fastq: DataFrame, by: Sequence[str] = (), mate: int = 1, offset: int = 33
) -> DataFrame:
    """Quality and base composition per cycle.

    Tasks add their reads up in dense arrays of (cycle, base, quality) and send the filled cells, so no
    row per base exists; quartiles come from that small table.
    """
    by = list(by)
    reads = fastq.select(*by, F.col(f"seq{mate}").alias("_s"), F.col(f"qual{mate}").alias("_q"))
    # No filter on the reads here: it would work out derived reads once more for every test.
    schema = T.StructType([*reads.select(*by).schema, T.StructField("cycle", T.LongType()), T.StructField("base", T.IntegerType()),
                           T.StructField("quality", T.IntegerType()), T.StructField("n", T.LongType())])
    counted = (reads.mapInArrow(_cycle_counts(len(by), offset), schema)
               .groupBy(*by, "cycle", "base", "quality").agg(F.sum("n").alias("n")))
    n, q = F.col("n"), F.col("quality")

    def of(base: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("base") == BASES.index(base), n)), F.lit(0)).cast("bigint")

    quart = F.percentile(q, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n)
    out = counted.groupBy(*by, "cycle").agg(
        F.sum("n").cast("bigint").alias("bases"),
        (F.sum(q * n) / F.sum("n")).alias("mean_quality"),
        quart.alias("_quart"),
        *[of(b).alias(f"n_{b.lower()}") for b in BASES],
    )
    return out.withColumns(
        {
            "quality_q1": F.col("_quart")[0], "quality_median": F.col("_quart")[1],
            "quality_q3": F.col("_quart")[2],
            "n_share": F.col("n_n") / F.col("bases"),
        }
    ).drop("_quart")


def overrepresented_sequences(
    fastq: DataFrame, min_share: float = 0.001, by: Sequence[str] = (), mate: int = 1
) -> DataFrame:
    """Sequences that make up at least ``min_share`` of the reads of a library. Eager: see ``frequent_values``."""
    found = frequent_values(fastq.select(*by, F.col(f"seq{mate}").alias("sequence")), "sequence", min_share, by)
    return found.withColumnRenamed("n", "reads")


def duplication_levels(fastq: DataFrame, by: Sequence[str] = (), mate: int = 1) -> DataFrame:
    """How many distinct sequences occur how often."""
    counts = fastq.groupBy(*by, f"seq{mate}").agg(F.count(F.lit(1)).alias("level"))
    return counts.groupBy(*by, "level").agg(
        F.count(F.lit(1)).alias("sequences"), F.sum("level").cast("bigint").alias("reads")
    )


def junction_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pairs per junction label."""
    return classified.groupBy(*by).agg(
        *[count_where(F.col("junction") == j).alias(j.lower()) for j in ("PBL", "PBR", "unknown")]
    )
