"""Frequent values by mergeable summaries: a bounded number of candidates, then exact counts."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from hopscan.operators.ordered import join_keys
from hopscan.session import checkpointed

#: Counters of a summary for each value that the least share leaves room for.
ROOM = 4


def _summaries(by: Sequence[str], value: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.DataFrame]]:
    """A task's frequent-items summary of each group.

    At most ``size`` values with counts that fall short by at most ``lost``, itself at most rows / size.
    A row with ``held`` null has the group's rows and what its counts may fall short by.
    """
    keys = [*by, value]

    def pruned(held: pd.DataFrame, lost: dict) -> pd.DataFrame:
        """Where a group holds too many values, the count after the last kept one goes from all."""
        held = held.groupby(keys, dropna=False, sort=False, as_index=False)["held"].sum()
        if len(held) <= size:
            return held
        parts = []
        groups = [((), held)] if not by else held.groupby(list(by), dropna=False, sort=False)
        for group, part in groups:
            if len(part) > size:
                cut = int(np.partition(part["held"].to_numpy(), len(part) - size - 1)[len(part) - size - 1])
                part = part[part["held"] > cut].assign(held=lambda p, c=cut: p["held"] - c)
                lost[_plain(group)] = lost.get(_plain(group), 0) + cut
            parts.append(part)
        return pd.concat(parts, ignore_index=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pd.DataFrame] = []
        rows, lost, totals, n = pd.DataFrame(columns=[*keys, "held"]), {}, {}, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            counted = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")]).to_pandas()
            counted = counted.rename(columns={"count_all": "held"})
            for group, part in [((), counted)] if not by else counted.groupby(list(by), dropna=False, sort=False):
                totals[_plain(group)] = totals.get(_plain(group), 0) + int(part["held"].sum())
            waiting.append(counted)
            n += len(counted)
            if n > 4 * size:
                rows, waiting, n = pruned(pd.concat([rows, *waiting] if len(rows) else waiting, ignore_index=True), lost), [], 0
        if waiting:
            rows = pruned(pd.concat([rows, *waiting] if len(rows) else waiting, ignore_index=True), lost)
        heads = [(*group, None, None, total, lost.get(group, 0)) for group, total in totals.items()]
        if totals:
            rows = rows.assign(total=None, lost=None)
            out = {k: [*rows[k].where(rows[k].notna(), None), *(h[i] for h in heads)] for i, k in enumerate(keys)}
            out |= {c: [*(int(x) if c == "held" else None for x in rows["held"]), *(h[len(keys) + i] for h in heads)] for i, c in enumerate(("held", "total", "lost"))}
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [(k, batch.schema.field(k).type) for k in keys] + [(c, pa.int64()) for c in ("held", "total", "lost")]))

    return run


def _plain(group) -> tuple:  # noqa: ANN001
    """A group's key with one form of missing."""
    group = group if isinstance(group, tuple) else (group,)
    return tuple(None if pd.isna(x) else x for x in group)


def frequent_values(df: DataFrame, value: str, min_share: float, by: Sequence[str] = ()) -> DataFrame:
    """(by, value, n, share) of the values that make up ``min_share`` or more of their group's rows; exact.

    Each task folds its rows into at most ROOM / min_share counters a group. The summaries add up: a
    value's counters fall short of its rows by at most what the tasks lost together, a ROOM-th of the
    share. Values that can reach the share, at most 4/3 of 1 / min_share a group, are counted exactly in a second
    pass. What is shuffled depends on the number of tasks and groups, not on how many distinct values there are. Eager.
    """
    if not 0 < min_share <= 1:
        raise ValueError("the least share is above 0 and at most 1")
    by = list(by)
    clashing = {"held", "total", "lost", "n", "share"} & {value, *by}
    if clashing:
        raise ValueError(f"rename {sorted(clashing)} first")
    rows = df.select(*by, value)
    schema = T.StructType([*rows.schema, *(T.StructField(c, T.LongType()) for c in ("held", "total", "lost"))])
    found = checkpointed(rows.mapInArrow(_summaries(by, value, math.ceil(ROOM / min_share)), schema))
    totals = found.filter("held IS NULL").groupBy(*by).agg(F.sum("total").alias("total"), F.sum("lost").alias("lost"))
    held = found.filter("held IS NOT NULL").groupBy(*by, value).agg(F.sum("held").alias("held"))
    both = join_keys(held, totals, by) if by else held.withColumns({c: totals.select(c).scalar() for c in ("total", "lost")})
    candidates = checkpointed(both.filter(F.col("held") + F.col("lost") >= min_share * F.col("total")).select(*by, value, "total"))
    counted = join_keys(rows, candidates.drop("total"), [*by, value], "left_semi").groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    joined = join_keys(counted, candidates, [*by, value])
    share = F.col("n") / F.col("total")
    return joined.filter(share >= min_share).select(*by, value, "n", share.alias("share"))
