"""Headline timings. Prints one JSON line.

Inputs (read pairs, alignment lines, count and annotation tables) are first stored as Parquet or
text in a scratch folder, as a run would find them; only the operators on them are timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.framework import CONFIG, Inputs
from checks.views import GENERATIONS
from hopscan.config import SITE
from hopscan.operators import curves as cv, density as dn, fastq as fq, quality as ql, reads as rd
from hopscan.operators import annotation as an, replicates as rp, scoring as sc, sites as st, summaries as sm
from hopscan.plans.counts import reads_to_counts
from hopscan.plans.scoring import score_no_replicates
from hopscan.sources.alignments import read_alignments

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def session(scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored(df: DataFrame, path: str, parts: int) -> DataFrame:
    df.repartition(parts).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    scratch = tempfile.mkdtemp(prefix="spark-bench-", dir="/tmp")
    spark = session(scratch)
    s = Inputs(spark, SF_DIR)
    reads = stored(s.reads, f"{scratch}/reads", 2 * CPUS)
    s["v_sam"].select("line").repartition(2 * CPUS).write.text(f"{scratch}/lines.sam")
    fastq = stored(s["v_fastq"], f"{scratch}/fastq", 2 * CPUS)
    s.reads = reads
    counts = stored(s.counts, f"{scratch}/counts", CPUS)
    s.counts = counts
    hard = stored(s.hard, f"{scratch}/hard", CPUS)
    s.hard = hard
    ann = stored(s.ann, f"{scratch}/ann", CPUS)
    s.ann = ann
    controls = stored(s.controls, f"{scratch}/controls", 1)
    series = stored(
        sc.ma_scores(hard, controls, "YES0", SITE), f"{scratch}/series", CPUS
    )
    regions, points = s.regions, stored(counts.select(*SITE).distinct(), f"{scratch}/points", CPUS)
    curves = stored(
        cv.curve_table(series, [*SITE, "Sample"], GENERATIONS), f"{scratch}/curves", 2 * CPUS
    )
    n = {"pairs": reads.count(), "lines": spark.read.text(f"{scratch}/lines.sam").count(),
         "curves": curves.count(), "insertions": points.count()}

    queries: dict[str, tuple[Callable[[], None], str]] = {
        "assemble_pairs": (lambda: run(rd.assemble_pairs(read_alignments(spark, f"{scratch}/lines.sam"))), "lines"),
        "filter_read_pairs": (lambda: run(rd.filter_read_pairs(reads)), "pairs"),
        "site_count": (lambda: run(st.site_count(rd.filter_read_pairs(reads))), "pairs"),
        "reads_to_counts": (lambda: run(reads_to_counts(reads, CONFIG)), "pairs"),
        "filter_retention": (lambda: run(sm.filter_retention(reads)), "pairs"),
        "annotate_points": (lambda: run(an.boundary_dedup(an.annotate_points(points, regions))), "insertions"),
        "impute_opposite_strand": (lambda: run(sc.impute_opposite_strand(hard, ann, key=SITE)), "insertions"),
        "ma_scores": (lambda: run(sc.ma_scores(hard, controls, "YES0", SITE)), "insertions"),
        "fit_curves": (lambda: run(cv.fit_report(curves, GENERATIONS)), "curves"),
        "replicate_scores": (lambda: run(rp.replicate_scores(hard, controls, "YES0", key=SITE)), "insertions"),
        "score_no_replicates": (lambda: run(score_no_replicates(hard, ann, CONFIG)["gene_fits"]), "curves"),
        "gene_density_report": (lambda: run(dn.gene_density_report(hard, ann, "YES0", "YES4", key=SITE)), "insertions"),
        "orientation_correlation": (lambda: run(ql.orientation_correlation(counts, SITE)), "insertions"),
        "junction_classify": (lambda: run(fq.junction_classify(fastq)), "pairs"),
        "base_quality_profile": (lambda: run(fq.base_quality_profile(fastq, ["Sample"])), "pairs"),
    }
    seconds: dict[str, float] = {}
    rates: dict[str, float] = {}
    for name, (job, unit) in queries.items():
        best = float("inf")
        for _ in range(2):  # the first run also compiles
            t0 = time.perf_counter()
            job()
            best = min(best, time.perf_counter() - t0)
        seconds[name] = round(best, 3)
        rates[f"{name}_{unit}_per_sec_per_core"] = round(n[unit] / best / CPUS, 1)
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("/", 1)[-1].removeprefix("sf"),
        "cpus": CPUS, "rows": n, "rates": rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
