"""Periodic runs of words, found in tiles of every period octave.

A run is a stretch of consecutive words with smallest period q and at least max(LEAST, TIMES * q)
words that no neighbouring word extends with that period.

1. Explode: words become numbers, and a document falls, for each octave of periods [s, 2s), into
   tiles of CORE or 16 * s words that overlap by 4 * s on both sides. A run of period q holds a whole
   cell of s words at a multiple of s whose copy q words on is equal, so a tile without such a cell
   holds no run; only the others become rows, which are dealt out evenly.
2. Solve: at each cell boundary with an equal cell q words on, the Z-function of the words to its
   right says how far they agree with those q on, and whether q is primitive; for the primitive ones
   the words to its left are compared backwards. What comes out is a fragment of the places where
   the document agrees with itself moved by q.
3. Stitch: fragments meet by document and period and touching ones join.

Then runs meet by document. Words are compared as such, so results are exact. Texts without a
tile row are finished in the first pass; only the others' texts move. A long document is many
tiles, a short period in it many fragments, and both are spread over tasks; a document's own text
and runs are held by one task.

Null or wordless texts have no runs. Rows repeating a doc_id are documents of their own. A null
doc_id is kept. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from hopscan.llm.store import bound_batches, checkpointed, tidy
from hopscan.llm.textbytes import slices

LEAST, TIMES = 24, 3
#: Words of a tile without its margins, at least.
CORE = 8192
#: Cell of the first octave, which has all periods below twice that many words.
CELL = 8
#: Changes a document's words before runs are sought: gets doc_id and the number of words, returns which original word stands where.
Change = Callable[[int | None, int], "np.ndarray | None"]
TILES = "row long, doc_id long, n_words long, sha string, words binary, octave int, first long, begin long, codes binary"
RUNS = "array<struct<start: long, length: long, period: long>>"


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Where h, the CRC of the id, ends in 0, words from a on repeat the p words there; null ids stay as they are."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + np.arange(n - a) % p
    return at


def _cell(octave: int) -> int:
    return CELL << octave


def _periods(octave: int) -> tuple[int, int]:
    """First period of an octave and the end."""
    s = _cell(octave)
    return (1 if octave == 0 else s), 2 * s


def _cell_hashes(codes: np.ndarray, cell: int) -> np.ndarray:
    """Hashes of all runs of ``cell`` words by doubling: equal runs have equal hashes."""
    out, width = codes.astype(np.uint64), 1
    while width < cell:
        out = (out[:-width] * np.uint64(0x9E3779B97F4A7C15)) ^ (out[width:] + np.uint64(0xD1B54A32D192ED03) * np.uint64(width))
        out ^= out >> np.uint64(29)
        width *= 2
    return out


def equal_cells(codes: np.ndarray, octave: int, boundaries: np.ndarray, end: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """(boundary, period) of cells whose copy a period on has the same hash and ends before ``end``."""
    s, (low, high) = _cell(octave), _periods(octave)
    hashes = _cell_hashes(codes, s)
    found = []
    end = np.broadcast_to(end, boundaries.shape)
    step = max(1, (1 << 20) // (high - low))
    for i in range(0, len(boundaries), step):
        c, e = boundaries[i : i + step], end[i : i + step]
        there = c[:, None] + np.arange(low, high)
        fits = there + s <= e[:, None]
        same = fits & (hashes[np.where(fits, there, 0)] == hashes[np.minimum(c, len(hashes) - 1)][:, None])
        at, q = np.nonzero(same)
        found.append((c[at], q + low))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def z_values(words: list[int], n: int) -> list[int]:
    """The first n values of the Z-function: how far the words agree with themselves from each place on."""
    z, left, right, end = [0] * n, 0, 0, len(words)
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < end and words[k] == words[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*out, n] if n > 1 else out


def agree_before(codes: np.ndarray, at: int, q: int, most: int) -> int:
    """How many words left of ``at`` agree with those q on, read backwards, ``most`` at most."""
    differ = np.flatnonzero(codes[at - most : at][::-1] != codes[at - most + q : at + q][::-1])
    return int(differ[0]) if len(differ) else most


def solve(codes: np.ndarray, octave: int, first: int, begin: int, n: int, core: int, least: int, times: int) -> list[tuple[int, int, int]]:
    """Fragments (period, low, high) of a tile: the words from low to high agree with those a period on.

    codes: words ``begin`` onwards; ``first``: where the core begins; n: words of the document. Each boundary sees 4 cells
    to both sides. A fragment that is too short for a run is left out unless it ends where the boundary sees no further.
    """
    s = _cell(octave)
    stop = min(first + core, begin + len(codes))
    at, periods = equal_cells(codes, octave, np.arange(-(-first // s) * s, stop, s) - begin, len(codes))
    order = np.argsort(at, kind="stable")
    at, periods = at[order].tolist(), periods[order].tolist()
    #: Of each period, how far its last fragment goes and whether it goes on there.
    reached: dict[int, tuple[int, bool]] = {}
    found: list[tuple[int, int, int]] = []
    k = 0
    while k < len(at):
        c, mine = at[k], []
        while k < len(at) and at[k] == c:
            high, on = reached.get(periods[k], (-1, False))
            # A fragment is carried on from the last boundary with a cell within it; the others add nothing.
            if c > high or (on and (c + 2 * s > high or c + s + begin >= stop)):
                mine.append(periods[k])
            k += 1
        if not mine:
            continue
        z = z_values(codes[c : c + 4 * s].tolist(), min(2 * s, len(codes) - c))
        for q in mine:
            if z[q] < s or any(z[q // p] >= q - q // p for p in _primes(q)):
                continue
            most = min(c, 4 * s)
            back, ahead = agree_before(codes, c, q, most), z[q]
            on = c + q + ahead == c + 4 * s and c + begin + 4 * s < n
            reached[q] = (c + ahead, on)
            if on or (back == most and c + begin > most) or back + ahead >= max(least - q, (times - 1) * q):
                found.append((q, c - back + begin, c + ahead + begin))
    return found


def explode(docs: DataFrame, change: Change | None = None, least: int = LEAST, times: int = TIMES, core: int = CORE,
            with_words: bool = False) -> DataFrame:
    """Document rows (octave null) and tile rows, stored.

    A document row has the words joined by one space if a tile of the document is there (or ``with_words``),
    else their digest.
    """
    if times < 3 or least < 3 * CELL:
        raise ValueError(f"a run has at least three periods and {3 * CELL} words")
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end, data, at in slices(batch.column(2)):
                yield from _exploded(number[start:end], ids[start:end], data, at, change, least, times, core, with_words)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return checkpointed(rows.mapInArrow(tidy(run), TILES))


def _width(n: int) -> type:
    return np.uint16 if n <= 1 << 16 else np.uint32


def _exploded(number: list, ids: list, data: np.ndarray, at: np.ndarray, change: Change | None,  # noqa: PLR0913
              least: int, times: int, core: int, with_words: bool) -> Iterator[pa.RecordBatch]:
    words = [data[a:b].tobytes().split() for a, b in zip(at[:-1], at[1:], strict=True)]
    code: dict[bytes, int] = {}
    # Numbers are of this run of texts, so most fit in two bytes.
    codes = np.fromiter((code.setdefault(w, len(code)) for ws in words for w in ws), np.int64, sum(map(len, words)))
    rows = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    if change is not None:
        for i, (doc, ws) in enumerate(zip(ids, words, strict=True)):
            order = change(doc, len(ws))
            if order is not None:
                codes[rows[i] : rows[i + 1]] = codes[rows[i] + order]
                words[i] = [ws[k] for k in order.tolist()]
    tiles: dict[int, list[tuple[int, int, int, bytes]]] = {}
    n, octave = np.diff(rows), 0
    while (n >= max(least, times * _periods(octave)[0])).any():
        s = _cell(octave)
        each = np.where(n >= max(least, times * _periods(octave)[0]), n // s, 0)
        row = np.repeat(np.arange(len(each)), each)
        local = (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)) * s
        c, _ = equal_cells(codes, octave, local + rows[row], rows[row + 1])
        size = max(core, 16 * s)
        row = np.searchsorted(rows, c, side="right") - 1
        for i, first in sorted(set(zip(row.tolist(), ((c - rows[row]) // size * size).tolist(), strict=True))):
            begin, stop = max(0, first - 4 * s), min(int(rows[i + 1] - rows[i]), first + size + 4 * s)
            part = codes[rows[i] + begin : rows[i] + stop]
            tiles.setdefault(i, []).append((octave, first, begin, part.astype(_width(len(code))).tobytes()))
        octave += 1
    out: dict[str, list] = {c.split()[0]: [] for c in TILES.split(", ")}
    for i, ws in enumerate(words):
        mine = tiles.get(i, [])
        shown = bool(mine) or with_words
        joined = b" ".join(ws)
        sha = None if shown else hashlib.sha256(joined).hexdigest()
        for values in [(number[i], ids[i], len(ws), sha, joined if shown else None, None, None, None, None),
                       *((number[i], None, len(ws), None, None, *t) for t in mine)]:
            for column, v in zip(out.values(), values, strict=True):
                column.append(v)
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    yield pa.RecordBatch.from_pydict({name: pa.array(out[name], kinds[kind]) for name, kind in (c.split() for c in TILES.split(", "))})


def fragments(tiles: DataFrame, least: int = LEAST, times: int = TIMES, core: int = CORE) -> DataFrame:
    """(row, period, low, high) of the tile rows, each tile by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row, n, octave, first, begin, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stop = min(n, first + max(core, 16 * _cell(octave)) + 4 * _cell(octave))
                words = np.frombuffer(codes, np.uint16 if len(codes) == 2 * (stop - begin) else np.uint32).astype(np.int64)
                found += [(row, *f) for f in solve(words, octave, first, begin, n, max(core, 16 * _cell(octave)), least, times)]
            table = np.array(found, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, i], pa.int64()) for i in range(4)], ["row", "period", "low", "high"])

    rows = tiles.filter("octave IS NOT NULL").select("row", "n_words", "octave", "first", "begin", "codes")
    parts = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, F.xxhash64("row", "octave", "first"))
    return dealt.mapInArrow(tidy(run), "row long, period long, low long, high long")


def stitch(pieces: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(row, start, length, period): touching fragments of a document and period joined, runs long enough kept."""
    order = W.partitionBy("row", "period").orderBy("low", "high")
    pieces = pieces.dropDuplicates(["row", "period", "low", "high"])
    begins = F.col("low") > F.coalesce(F.max("high").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    joined = (pieces.withColumn("begins", begins.cast("int"))
              .withColumn("stretch", F.sum("begins").over(order.rowsBetween(W.unboundedPreceding, 0)))
              .groupBy("row", "period", "stretch").agg(F.min("low").alias("start"), F.max("high").alias("high")))
    length = F.col("high") - F.col("start") + F.col("period")
    return (joined.withColumn("length", length)
            .filter(F.col("length") >= F.greatest(F.lit(least), F.lit(times) * F.col("period")))
            .select("row", "start", "length", "period"))


def documents_with_runs(docs: DataFrame, change: Change | None = None, least: int = LEAST, times: int = TIMES, core: int = CORE,
                        with_words: bool = False) -> DataFrame:
    """(row, doc_id, n_words, sha, words, runs) of every row; runs by start, then period; null without any."""
    tiles = explode(docs, change, least, times, core, with_words)
    runs = checkpointed(stitch(fragments(tiles, least, times, core), least, times))
    of_row = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    runs = of_row.select("row", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])).cast(RUNS).alias("runs"))
    rows = tiles.filter("octave IS NULL").select("row", "doc_id", "n_words", "sha", "words")
    open_ = rows.filter("sha IS NULL").join(runs, "row", "left")
    return open_.unionByName(rows.filter("sha IS NOT NULL").withColumn("runs", F.lit(None).cast(RUNS)))


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, core: int = CORE) -> DataFrame:
    """(doc_id, start, length, period) of every run of every row, in words."""
    found = documents_with_runs(docs, None, least, times, core)
    return found.select("doc_id", F.inline("runs"))


def kept_words(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        change[r["start"] + r["period"]] += 1
        change[r["start"] + r["length"]] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def collapse(docs: DataFrame, change: Change | None = None, least: int = LEAST, times: int = TIMES, core: int = CORE,
             with_text: bool = False) -> DataFrame:
    """Runs, and digests of them and of the words left when each run keeps its first period; on request those words (``collapsed``)."""
    columns = "row long, doc_id long, collapsed_sha256 string, runs_sha256 string" + (", collapsed string" if with_text else "")
    found = documents_with_runs(docs, change, least, times, core, with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out: dict[str, list] = {c.split()[0]: [] for c in columns.split(", ")}
            for r in rows:
                left, runs = r["sha"], r["runs"] or []
                kept = None
                if left is None:
                    kept = b" ".join(kept_words(r["words"].split(), runs))
                    left = hashlib.sha256(kept).hexdigest()
                text = "".join(f"{x['start']},{x['length']},{x['period']}\n" for x in runs)
                values = (r["row"], r["doc_id"], left, hashlib.sha256(text.encode()).hexdigest(), kept)
                for name, v in zip(out, values, strict=False):
                    out[name].append(v)
            kinds = {"long": pa.int64(), "string": pa.string()}
            made = {n: out[n] if n != "collapsed" else [None if v is None else v.decode() for v in out[n]] for n in out}
            yield pa.RecordBatch.from_pydict({n: pa.array(made[n], kinds[k]) for n, k in (c.split() for c in columns.split(", "))} | {
                "runs": pa.array([r["runs"] for r in rows], batch.schema.field("runs").type)})

    out = found.select("row", "doc_id", "sha", "words", "runs").mapInArrow(tidy(run), f"{columns}, runs {RUNS}")
    # Greatest length/period: compared as whole numbers, a/b > c/d where a*d > c*b; ties go to the first in order.
    best = F.aggregate(
        F.col("runs"), F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    out = out.withColumn("best", best).select(
        "row", "doc_id", F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
        *(["collapsed"] if with_text else []))
    return out.drop("row")
