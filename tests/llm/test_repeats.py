"""Periodic runs, spelling variants and repeated word windows against plain versions."""

import random

import numpy as np
import pytest

from hopscan.llm import block_dedup, periodic_runs, spelling
from hopscan.llm.store import Shards
from tests.llm import brute
from tests.llm.conftest import DOCUMENTS


def by_text(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCUMENTS).repartition(parts)


def repeated(seed=1):
    """Texts with runs of many periods, next to each other, nested, cut and nearly periodic."""
    rng = random.Random(seed)
    pick = lambda n, of=50: [f"w{rng.randrange(of)}" for _ in range(n)]
    texts = [[], ["a"], ["a"] * 23, ["a"] * 24, ["a"] * 700, ["a", "b"] * 300, ["a"] * 40 + ["b"] * 40]
    for q in (1, 2, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 100, 128, 200):
        unit = pick(q, 1000)
        for times in (2.9, 3, 3.1, 5.5):
            texts.append(pick(rng.randrange(40)) + (unit * 7)[: int(q * times)] + pick(rng.randrange(40)))
        texts.append(unit * 4 + pick(1) + unit * 4)
    inner = pick(6) * 5
    texts += [(inner + pick(9)) * 5, (["a"] * 30 + ["b"]) * 9, pick(700, 2), pick(400, 1) + pick(300, 3), (pick(40) * 3 + pick(1)) * 4]
    a, b = ["0"], ["1"]
    for _ in range(9):
        a, b = a + b, b + a
    texts.append(a)  # Thue and Morse: no cube
    x, y = ["a"], ["a", "b"]
    for _ in range(12):
        x, y = y, y + x
    texts.append(y)  # Fibonacci: many cubes
    return [(i, "\t ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("core", [24, 8192])
def test_runs_equal_brute_force(spark, core):
    rows = [*repeated(), (None, " ".join(["p q"] * 30)), (3, "x y z " * 20), (3, None)]
    df = frame(spark, rows)
    got = by_text(periodic_runs.collapse(df, periodic_runs.planted, core=core).collect())
    want = [(d, *brute.collapsed(d, t)[0]) for d, t in rows]
    assert got == by_text(want)
    plain = by_text((r.doc_id, r.collapsed) for r in periodic_runs.collapse(df, core=core, with_text=True).collect())
    assert plain == by_text((d, brute.collapsed(d, t, plant=False)[1]) for d, t in rows)
    listed = by_text(periodic_runs.find_runs(df, core=core).collect())
    assert listed == by_text((d, *r) for d, t in rows for r in brute.runs(brute.words(t, fold=False)))


def test_runs_of_odd_tables(varied, odd, none):
    for df, rows in (varied, odd):
        rows = [r for r in rows if len(r[1] or "") < 50_000]
        got = [tuple(r) for r in periodic_runs.collapse(df.filter("text IS NULL OR length(text) < 50000"), periodic_runs.planted).collect()]
        assert by_text(got) == by_text((d, *brute.collapsed(d, t)[0]) for d, t, *_ in rows)
    assert periodic_runs.collapse(none, periodic_runs.planted).count() == 0


def test_a_long_document_is_many_tiles(spark):
    rng = random.Random(2)
    unit = [f"u{i}" for i in range(3000)]
    words = [f"x{rng.randrange(9)}" for _ in range(500)] + unit * 9 + ["end"] + ["k", "l"] * 5000
    tiles = periodic_runs.explode(frame(spark, [(1, " ".join(words))]))
    assert tiles.filter("octave IS NOT NULL").count() > 5
    got = [tuple(r)[1:] for r in periodic_runs.find_runs(frame(spark, [(1, " ".join(words))])).collect()]
    assert sorted(got) == [(500, 27_000, 3000), (27_501, 10_000, 2)]


def test_z_values():
    rng = random.Random(4)
    for _ in range(300):
        w = [rng.randrange(2) for _ in range(rng.randrange(1, 40))]
        n = rng.randrange(1, len(w) + 1)
        want = [0] + [next((k for k in range(len(w) - i) if w[k] != w[i + k]), len(w) - i) for i in range(1, n)]
        assert periodic_runs.z_values(w, n) == want


def spelled(seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(7, 11))) for _ in range(60)]
    rows = []
    for i in range(400):
        words = []
        for w in rng.choices(base, weights=range(1, 61), k=40):
            if rng.random() < 0.1:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abé") + w[at:], w[:at] + rng.choice("abß") + w[at + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 and "ß" not in w else w)
        rows.append((i, "-".join(words[:20]) + " " + "1".join(words[20:])))
    return rows


def test_variants_equal_brute_force(spark):
    rows = [*spelled(), (None, "abcdefgh ABCDEFGH abcdefgx abcdefgx"), (7, None), (8, ""), (9, "x" * 5000 + " " + "x" * 5000 + " short")]
    df = frame(spark, rows).selectExpr("*", "'c' AS word", "1 AS n", "'k' AS key")
    for change, plant in ((spelling.planted, True), (None, False)):
        count = brute.vocabulary(rows, plant)
        words = spelling.vocabulary(df, change)
        assert {r.word: r.n for r in words.collect()} == count
        for crowd in (64, 2):
            assert by_text(spelling.variants(words, crowd=crowd).collect()) == by_text(brute.variants(count))


def test_forms_are_followed_to_the_last(spark):
    words = [("aaaaaaaa", 10**k) if not k else ("a" * (8 - k) + "b" * k, 10**k) for k in range(8)]
    got = {r.word: (r.form, r.root) for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    last = words[-1][0]
    assert all(got[w][1] == last for w, _ in words) and got[last][0] is None and got[words[0][0]][0] == words[1][0]


def test_letters_of_one_symbol_lose_no_link(spark):
    """All words share their reduced word in the first alphabet, a third is one edit from one word."""
    codes = [c for c in map(chr, range(97, 123)) if spelling.symbols(np.array([ord(c)]), 8)[0] == spelling.symbols(np.array([97]), 8)[0]]
    assert len(codes) > 1
    rng = random.Random(5)
    words = sorted({"".join(rng.choice(codes) for _ in range(9)) for _ in range(400)})
    got = by_text(spelling.variants(spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long"), crowd=16).collect())
    assert got == by_text(brute.variants({w: i + 2 for i, w in enumerate(words)}))


def test_variants_without_words(spark, none):
    assert spelling.variants(spelling.vocabulary(none)).count() == 0


def test_windows_equal_brute_force(varied, odd, none):
    for df, rows in (varied, odd):
        rows = [(d, t) for d, t, *_ in rows]
        got = by_text(block_dedup.deduplicate(df).collect())
        want = [(d, n, gone, brute.sha(kept.encode())) for (d, _), (n, gone, kept) in zip(rows, brute.cut_windows(rows))]
        assert got == by_text(want)
    assert block_dedup.deduplicate(none).count() == 0


@pytest.mark.parametrize("size", [3, 6, 13])
def test_windows_of_any_length(spark, size):
    rng = random.Random(size)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(60):
        w = [f"w{rng.randrange(6)}" for _ in range(rng.randrange(60))]
        at, k = rng.randrange(len(w) + 1), rng.randrange(40)
        rows.append((rng.randrange(50), "\n".join(w[:at] + passage[k : k + rng.randrange(20)] + w[at:])))
    got = block_dedup.deduplicate(frame(spark, rows), size, with_repeats=True).collect()
    want = by_text((d, n, gone, kept) for (d, _), (n, gone, kept) in zip(rows, brute.cut_windows(rows, size)))
    assert by_text((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == want
    assert all(sum(s.n_words for s in r.repeats) == r.n_removed for r in got)


def test_a_third_of_all_rows_is_one_text(spark, monkeypatch):
    """Copies fold to one entry per task and flush, and only the first keeps its words."""
    monkeypatch.setattr(block_dedup, "FLUSH", 100)
    text = " ".join(f"c{i}" for i in range(50))
    rows = [(i, text if i % 3 == 0 else " ".join(f"r{i}x{k}" for k in range(30))) for i in range(900)]
    got = {r.doc_id: r.n_removed for r in block_dedup.deduplicate(frame(spark, rows)).collect()}
    assert got == {i: 50 if i % 3 == 0 and i else 0 for i in range(900)}


def test_a_missing_shard_is_an_error(tmp_path):
    with pytest.raises(FileNotFoundError):
        Shards(str(tmp_path), 0).raw(0)
    (tmp_path / "shard=0").mkdir()
    with pytest.raises(FileNotFoundError):
        Shards(str(tmp_path), 0).raw(0)
    (tmp_path / "shard=0" / "part-0.txt").write_bytes(b"abc\n")
    assert bytes(Shards(str(tmp_path), 0).raw(0)) == b"abc"
