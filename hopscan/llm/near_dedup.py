"""Near-duplicate classes by MinHash bands, sequential Bayesian verification and exact confirmation.

1. Texts with equal shingle sets form one class; only one row per class goes on.
2. Each class gets a signature; bands of it put similar classes into common buckets.
3. Comparing: batches of signature positions one after the other; a pair is pruned as soon as the
   posterior probability of the wished similarity falls below ``miss``. A bucket gives a spanning
   forest of its surviving pairs, their components are clusters: all links lie within clusters.
4. Pairs of a cluster that survive the pruning are confirmed on their full shingle sets, again as a
   spanning forest, so a group of thousands gives a few rows per class and only pairs not yet
   joined are compared. Large buckets and clusters are cut into blocks that meet in pairs.
5. Components of confirmed links name each class by its smallest doc_id.

The least similarity is a parameter in percent; pruning limits and confirmation follow it. Chance of losing a
link at it: (1 - 0.85**5)**24 = 8e-7 by the bands at 85, (1 - 0.8**5)**24 = 7e-5 at 80, and ``miss`` by pruning.
Null or empty texts have no shingles and no link. Rows with a null doc_id have no component and are
kept. Rows repeating a doc_id are judged by their texts. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hopscan.llm.components import components
from hopscan.llm.store import bound_batches, checkpointed, release, tidy
from hopscan.llm.textbytes import mix, slices, word_hashes

SHINGLE, LEAST_PERCENT = 5, 85
BANDS, ROWS, BATCH = 24, 5, 20
HASHES = BANDS * ROWS
MISS = 1e-4
#: Members of a group that meet in one task, and rows with and without texts that a task takes at a time.
BLOCK, CLUSTER_ROWS, BUCKET_ROWS = 1024, 500, 10_000
#: Rows of a group of several blocks that all its blocks see in the first round, on average.
REPRESENTATIVES = 32
_RNG = np.random.default_rng(617)
_FACTORS = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    words, rows = word_hashes(data, at)
    runs = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        runs += words[k : k + len(runs)] * _PLACES[k]
    runs = mix(runs)
    out = []
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(mix((words[a:b] * _PLACES[8 : 8 + b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over a set."""
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(shingles), 4096):
        part = shingles[i : i + 4096]
        values = ((part[None, :] * _FACTORS[:, None]) >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, values.min(axis=1), out=least)
    return least


def band_keys(sig: np.ndarray) -> np.ndarray:
    bands = sig.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(ROWS):
        key = mix(key ^ bands[:, i])
    return key.view(np.int64)


def least_matches(least: float = LEAST_PERCENT / 100, miss: float = MISS) -> dict[int, int]:
    """Fewest matching signature bytes after each batch at which a pair stays in play.

    With a flat prior of the similarity, from the posterior of the chance that two bytes agree.
    """
    grid = (np.arange(4000) + 0.5) / 4000
    agree = np.log(grid + (1 - grid) / 256), np.log1p(-(grid + (1 - grid) / 256))
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            logs = m * agree[0] + (n - m) * agree[1]
            weight = np.exp(logs - logs.max())
            if weight[grid >= least].sum() >= miss * weight.sum():
                out[n] = m
                break
    return out


def surviving(sigs: np.ndarray, a: np.ndarray, b: np.ndarray, limits: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs not pruned, with their matches over the whole signature."""
    left, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, limit in limits.items():
        part = slice(n - BATCH, n)
        matches[left] += (sigs[a[left], part] == sigs[b[left], part]).sum(axis=1)
        left = left[matches[left] >= limit]
    return left, matches[left]


def _signed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in slices(batch.column(2)):
                sets = shingle_sets(data, at)
                sigs = [signature(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(first, end - first),
                    "check": batch.column(1).slice(first, end - first),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "print": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    "sig": pa.array([None if s is None else s.astype(np.uint8).tobytes() for s in sigs], pa.binary()),
                    "bands": pa.array([None if s is None else band_keys(s) for s in sigs], pa.list_(pa.int64())),
                })

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("check"), "text")
    return keyed.mapInArrow(tidy(run), "doc_id long, check long, n_shingles long, print binary, sig binary, bands array<long>")


def lot() -> Column:
    """A number below 2 ** 31 for each node."""
    return F.pmod(F.xxhash64("node", F.lit("stands")), F.lit(1 << 31).cast("long"))


def first_round(members: DataFrame, group: str, rows_per_task: int) -> DataFrame:
    """Rows of groups of n members dealt to blocks of BLOCK rows, each row to one; a group of several blocks has
    about REPRESENTATIVES of its rows in every block, so that copies of each other end up joined.

    A row's lot is the same in all groups, so groups that share rows choose the same ones and give the same links.
    Adds lot, side (0: representative), x (block), y = -1, label (the node) and part (the task).
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    members = members.withColumn("lot", lot())
    stands = (blocks > 1) & (F.col("lot") * F.col("n") < F.lit(REPRESENTATIVES) * F.lit(1 << 31).cast("long"))
    own = F.array(F.pmod(F.xxhash64("node"), blocks))
    dealt = members.withColumns({
        "side": F.when(stands, 0).otherwise(1), "x": F.when(stands, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(own),
        "y": F.lit(-1).cast("long"), "label": F.col("node")})
    copies = members.select((1 + F.when(blocks > 1, REPRESENTATIVES * blocks / F.col("n")).otherwise(0)).alias("c")).agg(F.sum("c")).head()[0]
    return _tasks(dealt.withColumn("x", F.explode("x")).drop("n"), group, copies or 0, rows_per_task)


def second_round(members: DataFrame, group: str, rows_per_task: int) -> DataFrame | None:
    """What the first round left: in groups of several blocks, the rows outside of the largest joined part against all.

    ``members`` has each row's label, the component so far. Rows of the largest part never meet again; where all rows are
    joined nothing is left. Adds side (0: a row outside), x, y (blocks of both sides) and part.
    """
    counted = members.groupBy(group, "label").agg(F.count("*").alias("m"))
    parts = counted.groupBy(group).agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.max("m").alias("most"), F.sum("m").alias("all"))
    open_ = checkpointed(parts.filter("most < all").select(
        group, "main", F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("long").alias("xs"), F.ceil(F.col("all") / BLOCK).cast("long").alias("ys"),
        (F.col("all") - F.col("most")).alias("out"), "all"))
    copies = open_.agg(F.sum(F.col("out") * F.col("ys") + F.col("all") * F.col("xs"))).head()[0]
    if not copies:
        return None
    rows = members.withColumn("lot", lot()).join(open_, group)
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    at = lambda n: F.pmod(F.xxhash64("node", F.lit("again")), F.col(n))
    keep = [group, "node", "label", "lot"]
    outside = rows.filter("label <> main").select(*keep, F.lit(0).alias("side"), at("xs").alias("x"), F.explode(upto("ys")).alias("y"))
    everyone = rows.select(*keep, F.lit(1).alias("side"), F.explode(upto("xs")).alias("x"), at("ys").alias("y"))
    return _tasks(outside.unionByName(everyone), group, copies, rows_per_task)


def _tasks(rows: DataFrame, group: str, copies: float, rows_per_task: int) -> DataFrame:
    """Tasks from the rows after copying."""
    return rows.withColumn("part", F.pmod(F.xxhash64(group, "x", "y"), F.lit(max(1, int(copies) // rows_per_task))))


def _joined(members: DataFrame, group: str, payload: DataFrame, join: Callable[[pa.Table], pa.Table], rows_per_task: int) -> DataFrame:
    """(node, component) of what ``join`` links within the groups of (group, node, n); ``payload`` has what it needs by node."""
    dealt = first_round(members, group, rows_per_task).join(payload, "node")
    labels = components(dealt.groupBy("part").applyInArrow(join, "a long, b long"))
    large = members.filter(F.col("n") > BLOCK)
    if large.isEmpty():
        return labels
    large = checkpointed(large.join(labels, "node", "left").select(group, "node", F.coalesce("component", "node").alias("label")))
    rest = second_round(large, group, rows_per_task)
    if rest is None:
        return labels
    more = rest.join(payload, "node").groupBy("part").applyInArrow(join, "a long, b long")
    # What is joined already goes on as one link a row.
    return components(more.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def _forest(table: pa.Table, group: str, least_percent: int, confirm) -> pa.Table:  # noqa: ANN001
    """Links that join what ``confirm`` accepts within each block or pair of blocks: a spanning forest, never all pairs.

    A row is compared with those that it is not yet joined with, representatives first; the pruned ones never reach
    ``confirm``, which gets a row and the places of others and answers for each.
    """
    limits = least_matches(least_percent / 100)
    cols = {c: table.column(c).to_numpy() for c in (group, "x", "y", "side", "lot", "node", "label")}
    order = np.lexsort((cols["node"], cols["lot"], cols["side"], cols["y"], cols["x"], cols[group]))
    cols = {c: v[order] for c, v in cols.items()}
    sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)[order]
    change = np.ones(len(order), bool)
    change[1:] = np.any([cols[c][1:] != cols[c][:-1] for c in (group, "x", "y")], axis=0)
    first = np.flatnonzero(change)
    links: list[tuple[int, int]] = []
    for lo, hi in zip(first, np.append(first[1:], len(order)), strict=True):
        inner = cols["y"][lo] < 0
        split = lo + int(np.searchsorted(cols["side"][lo:hi], 0, side="right"))
        label = np.unique(cols["label"][lo:hi], return_inverse=True)[1]
        for i in range(lo, hi if inner else split):
            others = np.arange(i + 1 if inner else split, hi)
            others = others[label[others - lo] != label[i - lo]]
            others = others[surviving(sigs, np.full(len(others), i), others, limits)[0]]
            if len(others):
                others = others[confirm(order, i, others)]
            for j in others:
                if label[j - lo] != label[i - lo]:
                    label[label == label[j - lo]] = label[i - lo]
                    links.append((i, j))
    a, b = np.array(links, np.int64).reshape(-1, 2).T
    out = pa.table({"a": cols["node"][a], "b": cols["node"][b]})
    del sigs, cols
    release()
    return out


def _likely(table: pa.Table, least_percent: int) -> pa.Table:
    """Links of the buckets' rows that survive the pruning."""
    return _forest(table, "bucket", least_percent, lambda order, i, others: np.ones(len(others), bool))


def _confirmed(table: pa.Table, least_percent: int) -> pa.Table:
    """Links of the clusters' rows that hold on the full shingle sets."""
    sets = [s for _, _, data, at in slices(table.column("text").combine_chunks()) for s in shingle_sets(data, at)]
    size = np.array([len(s) for s in sets])
    # Shingles as small numbers, so that common ones are counted by marks instead of merging.
    number = np.unique(np.concatenate(sets), return_inverse=True)[1] if sets else np.zeros(0, np.int64)
    ends = np.cumsum(size)
    marks = np.zeros(int(number.max(initial=-1)) + 1, np.int64)

    def confirm(order: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
        me, them = order[i], order[others]
        mine = number[ends[me] - size[me] : ends[me]]
        marks[mine] = 1
        at = np.concatenate([np.arange(ends[t] - size[t], ends[t]) for t in them])
        begin = np.cumsum(size[them]) - size[them]
        common = np.add.reduceat(marks[number[at]], begin)
        marks[mine] = 0
        return 100 * common >= least_percent * (size[me] + size[them] - common)

    return _forest(table, "cluster", least_percent, confirm)


def near_duplicates(docs: DataFrame, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, check) of every row; check is the text's hash.

    Rows whose shingle sets have a Jaccard similarity of ``least_percent`` in a hundred or more are linked.
    """
    bound_batches(docs.sparkSession)
    signed = checkpointed(_signed(docs))
    with_id = signed.filter("print IS NOT NULL AND doc_id IS NOT NULL")
    classes = checkpointed(
        with_id.groupBy("print").agg(F.min(F.struct("doc_id", "check")).alias("first"), F.first("sig").alias("sig"),
                                     F.first("bands").alias("bands"))
        .select(F.xxhash64("print").alias("node"), F.col("first.doc_id").alias("rep"), F.col("first.check").alias("check"),
                "sig", "bands"))
    banded = classes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = checkpointed(banded.join(shared, "bucket"))
    sigs = classes.select("node", "sig")
    likely = _joined(members.select("bucket", "node", "n"), "bucket", sigs, lambda table: _likely(table, least_percent), BUCKET_ROWS)
    clusters = likely.withColumnRenamed("component", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("n"))
    clusters = checkpointed(clusters.join(sizes, "cluster").join(classes.select("node", "rep", "check", "sig"), "node"))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.xxhash64("text").alias("check"), "text")
    found = clusters.join(texts, ["rep", "check"]).dropDuplicates(["node"]).select("node", "sig", "text")
    named = _joined(clusters.select("cluster", "node", "n"), "cluster", found, lambda table: _confirmed(table, least_percent), CLUSTER_ROWS)
    nodes = classes.select("node", "rep").join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_node = nodes.join(smallest, "component").select("node", "component_id")
    has = F.col("print").isNotNull() & F.col("doc_id").isNotNull()
    own = signed.filter(~has).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "check")
    rest = (signed.filter(has).withColumn("node", F.xxhash64("print")).join(of_node, "node")
            .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "check"))
    return rest.unionByName(own)


def keep_one(docs: DataFrame, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group. Rows that repeat its doc_id stay with it."""
    kept = near_duplicates(docs, least_percent).filter("kept").select(F.col("doc_id").alias("__id"), F.col("check").alias("__check")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__check"))
    return docs.join(kept, same, "left_semi")
