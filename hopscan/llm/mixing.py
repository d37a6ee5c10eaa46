"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating, and share 150 % of all
words; a target stops at twice its source, the excess is shared again by weight.

Drawing: the documents of a source fall into blocks by hash, the blocks into a random order. Whole
passes take every block; the rest of the target takes blocks in that order, and of the block where
it ends the documents in random order, the last of them in part, so a source's taken words are its
rounded target. A splitting tree deals each source's block quota to output shards: at a node the
blocks of the left half are one multivariate-hypergeometric draw from the node's quotas, seeded by
the node, so any task can walk to its own shards and reruns agree. Shards take disjoint runs of the
permuted blocks and order their documents by hash. ``taken_words`` tells the first shard of each row.

The mix itself has whole documents: the last one of a source is taken or left, whichever is nearer to its target.
The driver sees one row per source. Null or wordless texts have size 0 and are never taken. Rows equal
in doc_id and text are numbered and drawn one by one, so a text of a third of all rows falls into
many blocks; as texts they stand for each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from hopscan.llm.store import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
BLOCK_ROWS, SUPER_BLOCKS, SHARD_WORDS = 256, 512, 1_000_000
SEED = 20240611


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words wanted of each source, in the sources' order."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    left, out, open_ = share * sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        level = left / sum(weight[i] for i in open_)
        above = [i for i in open_ if level * weight[i] > most * sizes[i]]
        if not above:
            for i in open_:
                out[i] = level * weight[i]
            break
        for i in above:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(above)]
    return out


def _capacity(blocks: int, shards: int, a: int, b: int) -> int:
    """Blocks of shards a to b (end excluded)."""
    each, more = divmod(blocks, shards)
    return each * (b - a) + min(b, more) - min(a, more)


def leaf_quotas(quotas: np.ndarray, shards: int, first: int, end: int, seed: int = SEED) -> Iterator[tuple[int, np.ndarray]]:
    """Block quotas of shards first to end: the tree is walked from its root to these leaves."""
    total = int(quotas.sum())
    stack = [(0, shards, quotas)]
    while stack:
        a, b, here = stack.pop()
        if b <= first or a >= end:
            continue
        if b - a == 1:
            yield a, here
            continue
        mid = (a + b) // 2
        rng = np.random.default_rng([seed, a, b])
        left = rng.multivariate_hypergeometric(here, _capacity(total, shards, a, mid), method="marginals")
        stack += [(mid, b, here - left), (a, mid, left)]


@dataclass
class Plan:
    """rows: row, doc_id, check, size, source columns, blocks. draws: s, block, pass, shard, whole."""

    rows: DataFrame
    draws: DataFrame
    partial: DataFrame


def sizes_of(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("check"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def numbered(sized: DataFrame) -> DataFrame:
    """Adds ``copy``, which numbers the rows that are equal in doc_id and text, whatever their partitions.

    Copies are numbered within each partition of the stored rows, then the partitions one after the other.
    """
    same = lambda a, b: a["doc_id"].eqNullSafe(b["_id"]) & (a["check"] == b["_check"])
    several = checkpointed(sized.groupBy("doc_id", "check").agg(F.count("*").alias("k")).filter("k > 1")
                           .select(F.col("doc_id").alias("_id"), F.col("check").alias("_check")))
    part = F.shiftright("row", 33)  # the partition, as monotonically_increasing_id counts
    again = sized.join(several, same(sized, several), "left_semi").select("doc_id", "check", "row", part.alias("part"))
    per = again.groupBy("doc_id", "check", "part").agg(F.count("*").alias("k"))
    before = W.partitionBy("doc_id", "check").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    per = per.select(F.col("doc_id").alias("_id"), F.col("check").alias("_check"), F.col("part").alias("_part"),
                     F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(W.partitionBy("doc_id", "check", "part").orderBy("row")) - 1
    copies = again.withColumn("own", own).join(per, same(again, per) & (F.col("part") == F.col("_part"))).select(
        F.col("row").alias("_row"), (F.col("offset") + F.col("own")).alias("_copy"))
    return sized.join(copies, F.col("row") == F.col("_row"), "left").withColumn("copy", F.coalesce("_copy", F.lit(0))).drop("_row", "_copy")


def plan(docs: DataFrame) -> Plan:
    """Draw the mix of all rows."""
    spark = docs.sparkSession
    sized = checkpointed(numbered(checkpointed(sizes_of(docs).withColumn("row", F.monotonically_increasing_id()))))
    found = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()
    found.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    wanted = targets([r.words for r in found])
    table = []
    for i, (r, t) in enumerate(zip(found, wanted, strict=True)):
        goal = round(t)
        passes, rest = divmod(goal, r.words) if r.words else (0, 0)
        table.append((i, r.source, r.words, float(t), passes, rest, -(-r.n // BLOCK_ROWS)))
    sources = spark.createDataFrame(
        table, "s int, source string, source_size long, target double, passes long, rest long, n_blocks long")
    lot = lambda name, *cols: F.xxhash64(F.lit(SEED), F.lit(name), *cols)
    rows = sized.join(sources.withColumnRenamed("source", "own"), F.col("source").eqNullSafe(F.col("own"))).drop("own")
    rows = rows.withColumn("block", F.pmod(lot("block", "doc_id", "check", "copy"), "n_blocks"))
    # Order of a source's blocks: by super block, then by lot; two short windows instead of one long one.
    blocks = (rows.groupBy("s", "block").agg(F.sum("size").alias("words"), *(F.first(c).alias(c) for c in ("passes", "rest", "n_blocks")))
              .withColumn("super", F.pmod(lot("super", "s", "block"), F.ceil(F.col("n_blocks") / SUPER_BLOCKS))))
    supers = blocks.groupBy("s", "super").agg(F.sum("words").alias("w"), F.count("*").alias("k"))
    ahead = W.partitionBy("s").orderBy("super").rowsBetween(W.unboundedPreceding, -1)
    supers = supers.select("s", "super", F.coalesce(F.sum("w").over(ahead), F.lit(0)).alias("w0"),
                           F.coalesce(F.sum("k").over(ahead), F.lit(0)).alias("k0"))
    inside = W.partitionBy("s", "super").orderBy(lot("order", "block"), "block").rowsBetween(W.unboundedPreceding, -1)
    blocks = checkpointed(
        blocks.join(supers, ["s", "super"])
        .withColumn("before", F.col("w0") + F.coalesce(F.sum("words").over(inside), F.lit(0)))
        .withColumn("ordinal", F.col("k0") + F.count(F.lit(1)).over(inside)).drop("w0", "k0"))
    whole = F.col("before") + F.col("words") <= F.col("rest")
    cut = (F.col("before") < F.col("rest")) & ~whole
    # Passes run over ranks of the existing blocks, so the draws of a source are 0 .. quota - 1.
    number = blocks.groupBy("s").agg(F.count("*").alias("n_full"))
    drawn = (blocks.join(number, "s")
             .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
             .withColumn("whole", (F.col("pass") < F.col("passes")) | whole)
             .filter((F.col("pass") < F.col("passes")) | whole | cut)
             .select("s", "block", "pass", "whole", (F.col("pass") * F.col("n_full") + F.col("ordinal")).alias("draw"), "words", "before", "rest"))
    drawn = checkpointed(drawn)
    quotas = {r.s: r["count"] for r in drawn.groupBy("s").count().collect()}
    counts = np.array([quotas.get(i, 0) for i in range(len(found))], dtype=np.int64)
    shards = max(1, -(-sum(round(t) for t in wanted) // SHARD_WORDS))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in batch["id"]:
                for shard, q in leaf_quotas(counts, shards, first, min(first + 64, shards)):
                    yield pd.DataFrame({"s": np.arange(len(q)), "shard": shard, "quota": q})

    dealt = spark.range(0, shards, 64).mapInPandas(deal, "s int, shard long, quota long").filter("quota > 0")
    upto = W.partitionBy("s").orderBy("shard")
    dealt = (dealt.withColumn("end", F.sum("quota").over(upto))
             .select("s", "shard", F.explode(F.sequence(F.col("end") - F.col("quota"), F.col("end") - 1)).alias("draw")))
    draws = checkpointed(drawn.join(dealt, ["s", "draw"]).select("s", "block", "pass", "shard", "whole", "before", "rest"))
    ends = draws.filter(~F.col("whole")).select("s", "block", "before", F.col("rest").alias("goal"))
    inner = W.partitionBy("s", "block").orderBy(lot("row", "doc_id", "check", "copy"), "row").rowsBetween(W.unboundedPreceding, -1)
    partial = (rows.select("row", "doc_id", "check", "copy", "size", "s", "block").join(ends, ["s", "block"])
               .withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
               .select("row", F.greatest(F.lit(0), F.least("size", F.col("goal") - F.col("ahead"))).alias("part"))
               .filter("part > 0"))
    return Plan(rows, draws, partial)


def taken_words(docs: DataFrame) -> DataFrame:
    """Size, source, taken words and first output shard (null if nothing is taken) of every row."""
    p = plan(docs)
    times = p.draws.groupBy("s", "block").agg(
        F.count_if("whole").alias("times"), F.min(F.when(F.col("whole"), F.col("shard"))).alias("whole_shard"),
        F.min(F.when(~F.col("whole"), F.col("shard"))).alias("cut_shard"))
    shard = F.least("whole_shard", F.when(F.col("part") > 0, F.col("cut_shard")))
    return (p.rows.join(times, ["s", "block"], "left").join(p.partial, "row", "left")
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.coalesce("times", F.lit(0)) + F.coalesce("part", F.lit(0))).alias("taken"),
                    F.when(F.col("size") > 0, shard).alias("first_shard")))


def mixture(docs: DataFrame) -> DataFrame:
    """The mix itself: a row of ``docs`` for each draw, by shard and in each shard in random order.

    A document that would be drawn in part is drawn whole if that part is half of it or more.
    """
    p = plan(docs)
    id_of = lambda c: (F.coalesce(c, F.lit(0)), c.isNull())
    columns = ["doc_id", "check", "row", "copy"]
    whole = (p.draws.filter("whole").join(p.rows.filter("size > 0").select("s", "block", *columns), ["s", "block"])
             .select(*columns, "pass", "shard"))
    cut = p.draws.filter(~F.col("whole")).join(p.rows.select("s", "block", "size", *columns), ["s", "block"])
    cut = cut.join(p.partial.filter("part > 0"), "row").filter(2 * F.col("part") >= F.col("size")).select(*columns, "pass", "shard")
    lots = whole.unionByName(cut).select(
        *(x.alias(n) for x, n in zip(id_of(F.col("doc_id")), ("__id", "__no_id"), strict=True)), F.col("check").alias("__check"),
        F.col("shard").alias("__shard"), F.xxhash64(F.lit(SEED), "doc_id", "check", "copy", "pass").alias("__place"))
    keyed = docs.withColumns(dict(zip(("__id", "__no_id"), id_of(F.col("doc_id").cast("long")), strict=True)))
    keyed = keyed.withColumn("__check", F.xxhash64("text"))
    keys = ["__id", "__no_id", "__check"]
    # One row stands for all its copies; folded before the shuffle.
    mixed = keyed.dropDuplicates(keys).join(lots, keys)
    return mixed.repartition("__shard").sortWithinPartitions("__shard", "__place").select(*docs.columns)
