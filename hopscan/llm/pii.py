"""Personal data by rules and by bootstrapped contexts.

Rules find e-mail addresses, IPv4 addresses, card and phone numbers. These seed entities induce
lexical patterns: the two words before them, and the words around them. Other fragments of the same
kinds in spellings that the rules miss (``name (at) host``, ``10-0-0-7``, ``4111.1111...``, numbers
without a plus) are candidates. Fragments of a kind's shape that fail its check (Luhn, octets,
number of digits, no host after the at) are refuted. Patterns and instances form a graph that Spark
scores in rounds: a pattern's confidence is the share of known instances among the distinct known and
refuted ones it stands around, if enough are known; candidates not yet decided don't count. An
instance's score is 1 - prod(1 - confidence) of its confident patterns. Candidates that reach the least
score become known, until a round adds none, and become spans. Known ones only grow and refuted ones
stay, so no confidence falls. All texts are read whole; only graph edges are shuffled.

Rule matching is linear in the text: an address is searched from its ``@``, digit runs are entered
at their first digit, which gives the leftmost matches of the stated patterns. Candidates among digits
are read off the digit groups: a group begins a few readings at most, and of all valid ones those that
cover most digits stay.

Null texts are empty. Repeated rows and null ids give a row each. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hopscan.llm.store import bound_batches, checkpointed, tidy

KINDS = ("email", "ip", "card", "phone")
LEAST_CONFIDENCE, LEAST_SUPPORT = 0.8, 3

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_AT = re.compile(r"@|\x20?[\[(](?:at|AT)[\])]\x20?")
_LOOSE_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]+)+")
_GROUP = re.compile("[0-9]+")
#: What stands between digit groups of one address, card number and phone number.
_GAPS = {1: re.compile(r"[-_:,]|\[\.\]"), 2: re.compile("[._/:]"), 3: re.compile(r"\)?[\x20./-]{1,2}\(?")}
_LIST_GAP = re.compile(r"[^\w]{1,8}")
_NO_HOST = re.compile(r"[A-Za-z0-9-]+")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _local_start(text: str, floor: int, at: int) -> int:
    """Start of the run of local-part characters that ends at ``at``, not before ``floor``."""
    width = 64
    while True:
        low = max(floor, at - width)
        last = None
        for m in _NOT_LOCAL.finditer(text, low, at):
            last = m
        if last is not None:
            return last.end()
        if low == floor:
            return floor
        width *= 4


def emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = _local_start(text, floor, at)
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            floor = host.end()
        at = text.find("@", max(at + 1, floor))


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all rule matches, by kind and start."""
    out = [(0, *s) for s in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


@lru_cache(4096)
def _gap_kinds(gap: str) -> frozenset[int]:
    return frozenset(k for k, shape in _GAPS.items() if shape.fullmatch(gap))


def _readings(groups: list[str], gaps: list[str], i: int) -> Iterator[tuple[int, int]]:
    """(kind, end) of every fragment of a kind's shape that begins with group i; the longest of a kind comes last."""
    n, size = len(groups), len(groups[i])
    if i + 4 <= n and all(1 in _gap_kinds(g) for g in gaps[i : i + 3]) and all(len(g) <= 3 for g in groups[i : i + 4]):
        yield 1, i + 4
    j = i + 1
    while size <= 19:
        if size >= 13:
            yield 2, j
        if j == n or 2 not in _gap_kinds(gaps[j - 1]):
            break
        size += len(groups[j])
        j += 1
    if 2 <= len(groups[i]) <= 4:
        j = i + 1
        while j < min(n, i + 6) and 3 in _gap_kinds(gaps[j - 1]) and 2 <= len(groups[j]) <= 5:
            j += 1
            if j - i >= 3:
                yield 3, j


def _holds(kind: int, groups: list[str]) -> bool:
    if kind == 1:
        return max(map(int, groups)) <= 255
    digits = "".join(groups)
    return luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def _fours(sizes: list[int], gaps: list[str]) -> bytearray:
    """Marks the groups of four times four digits with one separator, of which no part is a phone number."""
    out, begin = bytearray(len(sizes)), 0
    for k in range(1, len(sizes) + 1):
        if k == len(sizes) or gaps[k - 1] != gaps[begin]:
            if sizes[begin:k] == [4] * 4:
                out[begin:k] = b"\1" * 4
            begin = k
    return out


def _best(hits: list[tuple[int, int, int]], sizes: list[int]) -> list[tuple[int, int, int]]:
    """Of (kind, first group, end) hits those, apart from each other, that cover most digits; then most of them as addresses and cards; then most hits."""
    ending: dict[int, list[tuple[int, int, int]]] = {}
    for h in hits:
        ending.setdefault(h[2], []).append(h)
    score, last = [(0, 0, 0)], [None]
    for end in range(1, len(sizes) + 1):
        top, by = score[end - 1], None
        for kind, i, _ in ending.get(end, ()):
            d, n, k = score[i]
            digits = sum(sizes[i:end])
            if (new := (d + digits, n + digits * (kind < 3), k + 1)) > top:
                top, by = new, (kind, i, end)
        score.append(top)
        last.append(by)
    out, at = [], len(sizes)
    while at:
        if last[at]:
            out.append(last[at])
        at = last[at][1] if last[at] else at - 1
    return out[::-1]


def _numbers(text: str, known: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Addresses, card and phone numbers in other spellings, and fragments of their shapes that are none.

    Every reading of the digit groups is tried, so numbers in lists are found one by one and a failing one
    hides no other. Addresses and cards with one separator throughout go before those with several.
    """
    good, bad = [], []
    taken, t = sorted((s, e) for _, s, e in known), 0
    run: list[tuple[int, int]] = []

    def read() -> None:
        groups = [text[s:e] for s, e in run]
        gaps = [text[a[1] : b[0]] for a, b in zip(run, run[1:])]
        sizes = list(map(len, groups))
        tried = [(k, i, j) for i in range(len(run)) for k, j in _readings(groups, gaps, i)
                 if text[max(0, run[i][0] - 1) : run[i][0]] != "+" and not text[run[j - 1][1] : run[j - 1][1] + 1].isdigit()]
        if not tried:
            return
        whole = _fours(sizes, gaps)
        valid = [h for h in tried if _holds(h[0], groups[h[1] : h[2]]) and not (h[0] == 3 and any(whole[h[1] : h[2]]))]
        even = [h for h in valid if h[0] == 3 or len(set(gaps[h[1] : h[2] - 1])) < 2]
        chosen = _best(even, sizes)
        used = bytearray(len(run))
        for _, i, j in chosen:
            used[i:j] = b"\1" * (j - i)
        if len(even) < len(valid):
            more = _best([h for h in valid if not any(used[h[1] : h[2]])], sizes)
            for _, i, j in more:
                used[i:j] = b"\1" * (j - i)
            chosen += more
        longest = {(k, i): j for k, i, j in tried}
        end = [0] * 4
        for (k, i), j in longest.items():
            if i >= end[k] and not any(used[i:j]):
                bad.append((k, *_bracketed(text, run[i][0], run[j - 1][1])))
                end[k] = j
        good.extend((k, *_bracketed(text, run[i][0], run[j - 1][1])) for k, i, j in chosen)

    for m in _GROUP.finditer(text):
        s, e = m.span()
        while t < len(taken) and taken[t][1] <= s:
            t += 1
        free = t == len(taken) or taken[t][0] >= e
        if run and not (free and s - run[-1][1] <= 4 and _gap_kinds(text[run[-1][1] : s])):
            read()
            run = []
        if free:
            run.append((s, e))
    if run:
        read()
    return good, bad


def _bracketed(text: str, s: int, e: int) -> tuple[int, int]:
    """The span with the brackets that belong to it."""
    depth = text.count("(", s, e) - text.count(")", s, e)
    before, after = text[s - 1 : s] == "(", text[e : e + 1] == ")"
    if before and (depth < 0 or depth == 0 and after):
        s, depth = s - 1, depth + 1
    return s, e + (after and depth > 0)


def _failed_rules(text: str) -> Iterator[tuple[int, int, int]]:
    """Fragments in the rules' own spellings that fail the rules' checks."""
    for m in _IP.finditer(text):
        if any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m.group().split(".")):
            yield 1, *m.span()
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 13 <= len(d) <= 19 and not luhn(d):
            yield 2, *m.span()
    for m in _PHONE.finditer(text):
        if not 9 <= len(_digits(m.group())) <= 15:
            yield 3, *m.span()


def fragments(text: str, known: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Fragments of the kinds in other spellings, apart from the rules' matches: candidates, and refuted ones."""
    out, failed = [], []
    for m in _AT.finditer(text):
        start = _local_start(text, 0, m.start())
        host = _LOOSE_HOST.match(text, m.end()) if start < m.start() else None
        if host:
            out.append((0, start, host.end()))
        elif start < m.start() and (word := _NO_HOST.match(text, m.end())):
            failed.append((0, start, word.end()))
    numbers, wrong = _numbers(text, known)
    out += numbers
    failed += [*wrong, *_failed_rules(text)]
    candidates = _apart(out, known)
    return candidates, _apart(failed, known + candidates)


def _apart(spans: list[tuple[int, int, int]], others: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans, by start, that overlap none of the others."""
    taken = sorted((s, e) for _, s, e in others)
    free, i = [], 0
    for c in sorted(spans, key=lambda x: x[1]):
        while i < len(taken) and taken[i][1] <= c[1]:
            i += 1
        if i == len(taken) or taken[i][0] >= c[2]:
            free.append(c)
    return free


def candidate_spans(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments of the kinds in other spellings, apart from the rules' matches."""
    return fragments(text, known)[0]


def instance(kind: int, fragment: str) -> str:
    """What spellings of one instance have in common; the outcome of a kind's check depends on it alone."""
    if kind == 0:
        return fragment.lower()
    if kind == 1:
        return ".".join(p.lstrip("0") or "0" for p in re.findall("[0-9]+", fragment))
    return _digits(fragment)


def places(text: str, spans: list[tuple[int, int, int]]) -> dict[tuple[int, int, int], tuple[int, int]]:
    """Start and end of the list each span stands in, by span: entries of a list have the words around it as context."""
    out: dict[tuple[int, int, int], tuple[int, int]] = {}
    ordered = sorted(set(spans), key=lambda x: (x[1], x[2]))
    begin = 0
    for k in range(1, len(ordered) + 1):
        if k == len(ordered) or not (ordered[k][1] - ordered[k - 1][2] <= 8 and _LIST_GAP.fullmatch(text, ordered[k - 1][2], ordered[k][1])):
            part = ordered[begin:k]
            out |= dict.fromkeys(part, (part[0][1], part[-1][2]))
            begin = k
    return out


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical contexts of a span: the two words before it, and the word on each side."""
    before = _WORD.findall(text[max(0, start - 80) : start].lower())[-2:]
    after = _WORD.findall(text[end : end + 60].lower())[:1]
    out = []
    if len(before) == 2:
        out.append("before " + " ".join(before))
    if before and after:
        out.append(f"around {before[-1]} {after[0]}")
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


OCCURRENCE = "struct<kind:int,start:int,end:int,value:string,seed:boolean,refuted:boolean,patterns:array<string>>"
FOUND = (f"doc_id long, check long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         f"base string, occurrences array<{OCCURRENCE}>")


def _read(docs: DataFrame) -> DataFrame:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()),
                               ("seed", pa.bool_()), ("refuted", pa.bool_()), ("patterns", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base, seen = [], [], []
            for text in batch.column(2):
                text = text.as_py() or ""
                spans = rule_spans(text)
                counts.append([sum(s[0] == k for s in spans) for k in range(4)])
                base.append(_joined(spans))
                rows = []
                candidates, failed = fragments(text, spans)
                place = places(text, spans + candidates + failed)
                for seed, refuted, found in ((True, False, spans), (False, False, candidates), (False, True, failed)):
                    for k, s, e in found:
                        rows.append({"kind": k, "start": s, "end": e, "value": instance(k, text[s:e]), "seed": seed, "refuted": refuted,
                                     "patterns": patterns(text, *place[k, s, e])})
                seen.append(rows)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "check": batch.column(1),
                **{f"n_{name}": pa.array([c[i] for c in counts], pa.int64()) for i, name in enumerate(KINDS)},
                "base_sha256": pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                "base": pa.array(base, pa.string()), "occurrences": pa.array(seen, kind)})

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("check"), "text")
    return keyed.mapInArrow(tidy(run), FOUND)


def accepted_instances(edges: DataFrame) -> DataFrame:
    """(kind, value) of candidates that confident patterns vouch for. edges: kind, pattern, value, seed, refuted."""
    edges = checkpointed(edges.groupBy("kind", "pattern", "value").agg(F.max("seed").alias("seed"), F.max("refuted").alias("refuted")))
    of_value = edges.groupBy("kind", "value").agg(F.max("seed").alias("seed"), F.max("refuted").alias("refuted"))
    edges = checkpointed(edges.select("kind", "pattern", "value").join(of_value, ["kind", "value"])
                         .select("kind", "pattern", "value", "seed", (F.col("refuted") & ~F.col("seed")).alias("refuted"), F.col("seed").alias("known")))
    while True:
        known = F.count_if("known")
        confident = edges.groupBy("kind", "pattern").agg(
            (known / F.nullif(known + F.count_if("refuted"), F.lit(0))).alias("confidence"), known.alias("support")
        ).filter((F.col("confidence") >= LEAST_CONFIDENCE) & (F.col("support") >= LEAST_SUPPORT))
        # Kept below 1, so that the product stays a number.
        miss = F.log1p(-F.least("confidence", F.lit(1 - 1e-9)))
        vouched = checkpointed(
            edges.filter("NOT known AND NOT refuted").join(confident, ["kind", "pattern"]).groupBy("kind", "value")
            .agg((1 - F.exp(F.sum(miss))).alias("score")).filter(F.col("score") >= LEAST_CONFIDENCE).select("kind", "value", F.lit(True).alias("new")))
        if vouched.isEmpty():
            return edges.filter("known AND NOT seed").select("kind", "value").distinct()
        edges = checkpointed(edges.join(vouched, ["kind", "value"], "left").select(
            "kind", "pattern", "value", "seed", "refuted", (F.col("known") | F.col("new").isNotNull()).alias("known")))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Counts and digest of the rules' spans, and all spans, of every row; check is the text's hash."""
    bound_batches(docs.sparkSession)
    rows = checkpointed(_read(docs).withColumn("row", F.monotonically_increasing_id()))
    seen = rows.select("row", F.explode("occurrences").alias("o")).select("row", "o.*")
    edges = seen.select("kind", F.explode("patterns").alias("pattern"), "value", "seed", "refuted")
    names = F.array(*map(F.lit, KINDS))
    new = (seen.filter("NOT seed AND NOT refuted").join(accepted_instances(edges), ["kind", "value"])
           .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("new")))
    of_base = F.when(F.col("base") == "", F.array().cast("array<struct<kind:int,start:int,end:int>>")).otherwise(
        F.transform(F.filter("occurrences", lambda o: o["seed"]), lambda o: F.struct(o["kind"], o["start"], o["end"])))
    text = F.array_join(F.transform(
        F.array_sort(F.concat("old", F.col("new"))),
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    spans = F.when(F.col("new").isNull(), F.col("base")).otherwise(text)
    return (rows.withColumn("old", of_base).join(new, "row", "left")
            .select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"),
                    F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_found"), "check"))


def masked(text: str, spans: str) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    found = sorted((int(s), int(e), kind) for kind, s, e in (x.split(":") for x in spans.split(",") if x))
    out, at = [], 0
    for s, e, kind in found:
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, personal data in ``text`` replaced by its kind, n_chars renewed."""
    found = (find_personal_data(docs).filter("spans <> ''").groupBy("doc_id", "check")
             .agg(F.first("spans").alias("__spans")))
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__check": F.xxhash64("text")})
    joined = keyed.join(found, keyed["__id"].eqNullSafe(found["doc_id"]) & (keyed["__check"] == found["check"]), "left")

    @F.pandas_udf("string")
    def mask(text, spans):  # noqa: ANN001, ANN202
        return pd.Series([None if t is None else masked(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)

    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(
        mask(F.when(F.col("__spans").isNotNull(), keyed["text"]), "__spans"))
    columns = [text.alias("text") if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else keyed[c] for c in docs.columns]
    return joined.select(*columns)
