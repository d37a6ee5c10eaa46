"""FASTQ read pairs and text logs of the filtering step."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from hopscan.functions.labels import FASTQ_NAME_PATTERN
from hopscan.operators.summaries import add_totals

# The labels of the figures a filtering run prints, in their order.
SUMMARY_LABELS = (
    "Total chunks processed", "Original read pairs", "Filtered read pairs", "Removed read pairs",
    "Overall retention rate", "Output written to",
)
# End of fixed values.
FRAGMENTS = ("PBL", "PBR")


def read_fastq(spark: SparkSession, path: str, mate: int) -> DataFrame:
    """(name, seq, qual) of one mate's gzipped files.

    A gzipped file is read by one task from start to end, so its lines arrive in order and four
    of them make a record; nothing is shuffled. Files that Spark would split are refused, and
    every record must have its marks and as many qualities as bases, else an error names the file.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    other = lines.filter(~F.endswith("file", F.lit(".gz"))).select("file").first()
    if other is not None:
        raise ValueError(f"expected gzipped FASTQ files, found {other['file']}")
    # The path stands before a record's first line and after its last: sent with every line as a column of its own it
    # would be most of what Python gets. No line holds a line feed.
    numbered = lines.withColumn("_n", F.pmod(F.monotonically_increasing_id(), F.lit(4)))
    mark = F.lit("\n")
    marked = numbered.select(
        F.when(F.col("_n") == 0, F.concat("file", mark, "value")).when(F.col("_n") == 3, F.concat("value", mark, "file"))
        .otherwise(F.col("value")).alias("value"))
    raw = marked.mapInArrow(_records, "name string, seq string, qual string")
    return raw.select("name", F.col("seq").alias(f"seq{mate}"), F.col("qual").alias(f"qual{mate}"))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of a task's lines, four each, which must all be of one file."""
    rest = None
    for batch in batches:
        lines = batch.column(0) if rest is None else pa.concat_arrays([rest, batch.column(0)])
        whole = len(lines) // 4 * 4
        # Copied, as a slice would hold the whole batch.
        rest = lines.take(pa.array(range(whole, len(lines)), pa.int64())) if whole < len(lines) else None
        at = 0
        while at < whole:
            file = _file(lines[at])
            rows = np.arange(at, whole, 4)
            of_file = np.asarray(pc.starts_with(lines.take(pa.array(rows)), f"{file}\n"))
            if not of_file.all():
                rows = rows[: of_file.argmin()]  # up to the next file
            at += 4 * len(rows)
            head, seq, plus, qual = (lines.take(pa.array(rows + i)) for i in range(4))
            cut = ~np.asarray(pc.ends_with(qual, f"\n{file}"))
            if cut.any():
                raise ValueError(f"incomplete read record at the end of {file}")
            head = pc.utf8_slice_codeunits(head, len(file) + 1)
            qual = pc.utf8_slice_codeunits(qual, 0, -len(file) - 1)
            broken = np.asarray(pc.or_(pc.or_(
                pc.invert(pc.starts_with(head, "@")), pc.invert(pc.starts_with(plus, "+"))),
                pc.not_equal(pc.utf8_length(seq), pc.utf8_length(qual))))
            if broken.any():
                raise ValueError(f"broken read record {head[int(broken.argmax())].as_py()!r} in {file}")
            name = pc.replace_substring_regex(pc.utf8_slice_codeunits(head, 1), r"(?:/[12])?(?:[\s\x0b].*)?$", "")
            yield pa.RecordBatch.from_arrays([name, seq, qual], names=["name", "seq", "qual"])
    if rest is not None:
        raise ValueError(f"incomplete read record at the end of {_file(rest[0])}")


def _file(line: pa.Scalar) -> str:
    return line.as_py().split("\n", 1)[0]


def read_fastq_pairs(spark: SparkSession, r1: str, r2: str) -> DataFrame:
    """Both mates of every read, joined on the read name."""
    for path in (r1, r2):
        if not re.search(FASTQ_NAME_PATTERN, path):
            raise ValueError(f"expected gzipped FASTQ files, got {path}")
    return read_fastq(spark, r1, 1).join(read_fastq(spark, r2, 2), "name")


def parse_filter_logs(logs: DataFrame, text: str = "text", path: str = "path") -> DataFrame:
    """Figures of every complete summary: one row per log and fragment.

    Every ``label: value`` line with a known label is a pair; the first label begins a new summary.
    A log is named by its path.
    """
    log = F.col(path).alias("log")
    name = F.element_at(F.split(F.col(path), "/"), -1)
    stem = F.regexp_replace(name, "[.][^.]*$", "")
    lines = logs.select(log, stem.alias("Sample"), F.posexplode(F.split(text, "\n")).alias("line", "said"))
    value = F.lit(None).cast("string")
    label = F.lit(None).cast("string")
    for known in SUMMARY_LABELS:
        here = F.instr("said", f"{known}:")
        label = F.when(here > 0, known).otherwise(label)
        value = F.when(here > 0, F.trim(F.substr("said", here + len(known) + 1))).otherwise(value)
    pairs = lines.select("log", "Sample", "line", label.alias("label"), value.alias("value")).filter("label IS NOT NULL")
    before = W.partitionBy("log").orderBy("line")  # the lines of one log, a bounded file
    blocks = pairs.withColumn("block", F.count_if(F.col("label") == SUMMARY_LABELS[0]).over(before))
    cells = [F.first(F.when(F.col("label") == known, F.col("value")), ignorenulls=True).alias(f"v{i}")
             for i, known in enumerate(SUMMARY_LABELS)]
    found = blocks.groupBy("log", "Sample", "block").agg(*cells).dropna(subset=[f"v{i}" for i in range(len(cells))])
    fragment = F.lit(None).cast("string")
    for f in FRAGMENTS:
        fragment = F.when(F.endswith("v5", F.lit(f".{f}.filtered.parquet")), f).otherwise(fragment)

    def number(i: int) -> Column:
        return F.replace(F.col(f"v{i}"), F.lit(","), F.lit("")).try_cast("bigint")

    rate = F.replace("v4", F.lit("%"), F.lit("")).try_cast("double") / 100
    return found.select(
        "Sample", fragment.alias("Fragment"), number(0).alias("chunks_processed"),
        number(1).alias("original_read_pairs"), number(2).alias("filtered_read_pairs"),
        number(3).alias("removed_read_pairs"), rate.alias("retention_rate"), F.col("v5").alias("output_file"),
    ).filter("Fragment IS NOT NULL")


def log_totals(parsed: DataFrame) -> DataFrame:
    """One row per log with both fragments side by side and the overall retention."""
    stems = ("chunks_processed", "original_read_pairs", "filtered_read_pairs",
             "removed_read_pairs", "retention_rate")
    cells = [
        F.max(F.when(F.col("Fragment") == f, F.col(s))).alias(f"{s}_{f.lower()}")
        for f in FRAGMENTS for s in stems
    ]
    return add_totals(parsed.groupBy("Sample").agg(*cells))


def scan_filter_logs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Log files (small, one row each) to figures per sample and fragment."""
    logs = spark.read.text(paths, wholetext=True).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("path")
    )
    return parse_filter_logs(logs)
