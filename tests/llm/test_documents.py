"""Document operators against plain versions on small tables with every odd case."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hopscan.llm import (
    bpe_chunks, encoder, kneser_ney, mixing, near_dedup, pii, ppm_language, quality_rules, substring_dedup, token_files,
)
from tests.llm import brute


def collected(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(encoder.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_scores_equal_a_plain_model(varied, odd):
    for df, rows in (varied, odd):
        got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score, r.held_out)
                      for r in kneser_ney.language_model_scores(df).collect()), key=str)
        want = sorted(((*r, brute.part(r[0], 10) == 0) for r in brute.kneser_ney([(d, t) for d, t, *_ in rows])), key=str)
        assert [g[:4] for g in sorted(got, key=str)] == [w[:4] for w in want]
        for g, w in zip(got, want, strict=True):
            assert g[4] == pytest.approx(w[4], rel=1e-9) and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == w[6]


def test_scores_without_rows(none):
    assert kneser_ney.language_model_scores(none).count() == 0


def test_encodings_equal_the_library(varied, odd, none, library):
    for df, rows in (varied, odd):
        got = collected(bpe_chunks.encode_documents(df))
        want = []
        for d, t, *_ in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            want.append((d, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(text.encode())))
        assert got == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
    assert bpe_chunks.encode_documents(none).count() == 0


def test_chunks_are_reused_and_joins_exact(library):
    rng = random.Random(5)
    enc = encoder.Encoder(encoder.vocabulary_path())
    chunks = bpe_chunks.ChunkEncoder(enc, bound=1 << 16)
    letters = ["a", "B", " ", "  ", "\n", "\t", "é", "1", "'s", "!", " ", "\x1f", "<|endoftext|>", "the ", "tion"]
    shared = "".join(rng.choice(letters) for _ in range(4000))
    for _ in range(20):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 3000))) + shared
        ids = chunks.encode(np.frombuffer(text.encode(), np.uint8))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert enc.decode_bytes(ids).decode() == text
    assert chunks.reused > 0


def test_token_files_hold_every_document(varied, odd, none, library):
    for df, rows in (varied, odd):
        got = collected(token_files.token_file_rows(df))
        encoded = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for d, t, *_ in rows]
        assert sum(g[2] for g in got) == sum(len(i) for _, i in encoded)
        assert sorted((str(g[0]), g[2], g[3]) for g in got) == sorted(
            (str(d), len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in encoded)
        at = 0
        for g in sorted(got, key=lambda r: r[1]):
            assert g[1] == at
            at += g[2]
        ids = [g[0] for g in sorted(got, key=lambda r: r[1])]
        known = [i for i in ids if i is not None]
        assert known == sorted(known)
    assert token_files.token_file_rows(none).count() == 0


def test_absent_keys_are_refused(spark, varied):
    files = token_files.write_token_files(varied[0])
    places = files.lookup(spark.createDataFrame([(0, 0), (1, 0), (0, 1), (10**9, 0)], "doc_id long, copy long")).collect()
    assert {(r.doc_id, r.copy): r.shard is not None for r in places} == {(0, 0): True, (1, 0): False, (0, 1): False, (10**9, 0): False}


def test_ranks_are_minimal_and_perfect():
    keys = np.arange(5000)
    hashes = token_files.key_hash(keys, np.zeros(5000, bool), np.zeros(5000))
    levels, rank = token_files.build_levels(hashes)
    assert sorted(rank) == list(range(5000))
    assert (token_files.ranks(hashes, levels) == rank).all()


def test_personal_data_rules(varied, odd, none):
    for df, rows in (varied, odd):
        for r in pii.find_personal_data(df).collect():
            assert r.base_sha256 and r.n_found == 0
        assert pii.find_personal_data(df).count() == len(rows)
    assert pii.find_personal_data(none).count() == 0 and pii.redact(none).count() == 0
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@-+ ()%25é") for _ in range(rng.randrange(40)))
        assert pii.rule_spans(text) == brute.rule_spans(text)


def test_patterns_find_other_spellings(spark):
    hosts = [f"user{i}@mail{i}.example.org" for i in range(6)]
    texts = [f"please write me at {h} today" for h in hosts] + ["please write me at jane.roe (at) corp [dot] example today", "word wx jim (at) home [dot] example yz"]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    start = texts[6].index("jane")
    assert got[6].spans == f"email:{start}:{texts[6].index(' today')}" and got[6].n_email == 0 and got[6].n_found == 1
    assert got[7].spans == "" and all(got[i].n_email == 1 for i in range(6))
    masked = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert masked[6] == "please write me at <EMAIL> today" and masked[0] == masked[6] and masked[7] == texts[7]


def _found(spark, texts):
    """Texts of the spans beyond the rules' ones, by place of the text."""
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {}
    for r in pii.find_personal_data(df).collect():
        rules = {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.rule_spans(texts[r.doc_id])}
        new = [x.split(":") for x in r.spans.split(",") if x and x not in rules]
        assert len(new) == r.n_found
        got[r.doc_id] = [texts[r.doc_id][int(a) : int(b)] for _, a, b in new]
    return got


def test_patterns_keep_contexts_rich_in_unseen_instances(spark):
    seeds = [f"please write me at user{i}@mail{i}.example.org today" for i in range(6)]
    unseen = [f"please write me at person{i} (at) corp{i} [dot] example today" for i in range(12)]
    got = _found(spark, seeds + unseen)
    assert [got[6 + i] for i in range(12)] == [[f"person{i} (at) corp{i} [dot] example"] for i in range(12)]


def test_found_instances_vouch_until_nothing_is_added(spark):
    texts = [f"ask for box user{i}@mail{i}.example.org here" for i in range(3)]
    chain = ["ask for box", "now see slot", "then use line", "later try door", "at last room"]
    for step, (old, new) in enumerate(zip(chain, chain[1:])):
        for i in range(3):
            name = f"p{step}x{i} (at) corp [dot] example"
            texts += [f"{old} {name} end{'abc'[i]}", f"{new} {name} fin{'abc'[i]}"]
    got = _found(spark, texts)
    assert all(len(got[i]) == 1 for i in range(3, len(texts)))


@pytest.mark.parametrize("text,want", [
    ("hosts 10-0-0-7, 10-0-0-8, 10-0-0-9", ["10-0-0-7", "10-0-0-8", "10-0-0-9"]),
    ("host 10-0-0-7 is up", ["10-0-0-7"]),
    ("10-0-0-7,10-0-0-8,10-0-0-9", ["10-0-0-7", "10-0-0-8", "10-0-0-9"]),
    ("hosts 999-0-0-7, 10-0-0-8, 10[.]0[.]0[.]9", ["10-0-0-8", "10[.]0[.]0[.]9"]),
    ("999-10-1-17,10-0-0-8", ["10-0-0-8"]),
    ("call 017 555 7713, 017 555 7714", ["017 555 7713", "017 555 7714"]),
    ("call 017 555 7713 017 555 7714", ["017 555 7713", "017 555 7714"]),
    ("call 017 555 7713 017 555 7714 017 555 7715 017 555 7716", ["017 555 7713", "017 555 7714", "017 555 7715", "017 555 7716"]),
    ("call 12 34 56, 017 555 7714/017 555 7715", ["017 555 7714", "017 555 7715"]),
    ("call (017) 555 7713, (017 555 7714) or 0044 20 7946 0958", ["(017) 555 7713", "(017 555 7714)", "0044 20 7946 0958"]),
    ("+49 30 1234567, 017 555 7714", ["017 555 7714"]),
    ("cards 4111.1111.1111.1112/4012.8888.8888.1881, 4111_1111_1111_1111", ["4012.8888.8888.1881", "4111_1111_1111_1111"]),
    ("10-0-0-7, 017 555 7713, 4111.1111.1111.1111", ["10-0-0-7", "017 555 7713", "4111.1111.1111.1111"]),
])
def test_every_number_of_a_list_is_a_candidate(text, want):
    got = pii.candidate_spans(text, pii.rule_spans(text))
    assert [text[s:e] for _, s, e in got] == want


def test_candidates_stay_apart_and_hold():
    rng = random.Random(6)
    for _ in range(5000):
        text = "".join(rng.choice(["1", "22", "017", "4111", " ", ".", "-", ", ", "(", ")", "/", "a"]) for _ in range(rng.randrange(40)))
        rules = pii.rule_spans(text)
        good, bad = pii.fragments(text, rules)
        for a in good:
            assert all(b[2] <= a[1] or a[2] <= b[1] for b in [*rules, *bad])
            assert all(b is a or b[2] <= a[1] or a[2] <= b[1] for b in good)


def test_late_entries_of_a_list_are_found(spark):
    seeds = [f"these lines ring +49 30 12345{i:02d} at night" for i in range(4)]
    numbers = [f"017 555 77{i:02d}" for i in range(30)]
    got = _found(spark, [*seeds, "these lines ring " + ", ".join(numbers) + " at night"])
    assert got[4] == numbers


def test_refuted_instances_speak_against_a_pattern(spark):
    cards = [("4111111111111111", True), ("4012888888881881", True), ("5555555555554444", True), ("378282246310005", True)]
    texts = [f"my own number {c} again" for c, _ in cards]
    dotted = ".".join(("6011000990139424"[i : i + 4] for i in range(0, 16, 4)))
    good = [*texts, f"my own number {dotted} again"]
    assert _found(spark, good)[4] == [dotted]
    wrong = [f"my own number 1234.5678.1234.56{n} again" for n in (71, 72, 73)]
    assert not any(pii.luhn(w.replace(".", "").split()[3]) for w in wrong)
    for bad in (wrong, [w.replace(".", " ") for w in wrong]):
        got = _found(spark, [*good, *bad])
        assert got[4] == [] and all(got[i] == [] for i in (5, 6, 7))


def test_figures_and_cutoffs(spark, varied, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df, rows in (varied, odd):
        got = collected(quality_rules.judged(df, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept"))
        want = []
        for d, t, *_ in rows:
            f = brute.figures(t)
            want.append((d, *f, not (f[0] < 10 or 100 * f[4] > 20 * f[0])))
        assert got == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
    assert quality_rules.judged(none, labels).count() == 0


def test_certified_cutoffs_follow_the_binomial_bound(spark):
    rng = random.Random(2)
    rows = []
    for i in range(2600):
        good = i % 13 > 0
        symbols = 0 if good and rng.random() > 0.004 else 12
        rows.append((i, " ".join(f"w{i}x{j}" for j in range(20)) + " " + "$" * symbols, "en", int(good)))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3], 0) for r in rows], "doc_id long, quality int, toxic int")
    found = {r.rule: r.cutoff for r in quality_rules.certified(quality_rules.figures(docs), labels).collect()}
    n = sum(r[3] for r in rows)
    k = sum(r[3] and "$" in r[1] for r in rows)
    rate, level = quality_rules.RISK / 4, quality_rules.ERROR / 4
    assert (brute.binomial_tail(k, n, rate) <= level) == ("symbols_per_word" in found)
    assert set(found) <= {"symbols_per_word"}
    got = spark.range(1).select(*(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), 0.0125).alias(f"c{k}")
                                  for k, n in ((0, 50), (1, 50), (5, 2000), (0, 0)))).head()
    for value, (k, n) in zip(got, ((0, 50), (1, 50), (5, 2000), (0, 0)), strict=True):
        assert value == pytest.approx(1.0 if k >= n * 0.0125 else brute.binomial_tail(k, n, 0.0125), rel=1e-9)


def test_groups_of_near_copies(varied, odd, none):
    df, rows = varied
    want, sizes = brute.components([(d, t) for d, t, *_ in rows])
    got = {r.doc_id: r for r in near_dedup.near_duplicates(df).collect()}
    assert {r[0]: (got[r[0]].component_id, got[r[0]].n_shingles) for r in rows} == {
        r[0]: (c if s else r[0], s) for r, c, s in zip(rows, want, sizes, strict=True)}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    twice = near_dedup.near_duplicates(odd[0]).collect()
    assert len(twice) == len(odd[1]) and {(r.doc_id, r.component_id, r.kept) for r in twice} == {(1, 1, True), (2, 1, False), (None, None, True)}
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.keep_one(none).count() == 0


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(150)] = f"v{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    want, _ = brute.components(rows)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == {d: c for (d, _), c in zip(rows, want, strict=True)}


def test_cut_strings(varied, odd, none):
    for df, rows in (varied, odd):
        want = sorted(((d, n, r, s, brute.sha(k)) for (d, *_), (n, r, s, k) in zip(rows, brute.cut_strings([x[:2] for x in rows]), strict=True)), key=str)
        assert sorted((tuple(r) for r in substring_dedup.deduplicate(df).collect()), key=str) == want
    assert substring_dedup.deduplicate(none).count() == 0


def test_suffixes_sort_as_bytes_do():
    from hopscan.llm.suffix_sort import Suffixes

    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    starts, group = np.arange(500), np.repeat([0, 1, 2], [100, 150, 250])
    s = Suffixes(data, 20)
    order, run = s.runs(starts, group)
    key = lambda i: bytes(data[i : i + 20])
    want = sorted(range(500), key=lambda i: (group[i], key(i), i))
    assert [(group[i], key(i)) for i in order] == [(group[i], key(i)) for i in want]
    assert len(set(run)) == len({(group[i], key(i)) for i in range(500)})


def test_hot_anchors_are_dealt_string_by_string(spark):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(200))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(60)) + passage[i % 50 :]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = sorted((d, n, r, s, brute.sha(k)) for (d, _), (n, r, s, k) in zip(rows, brute.cut_strings(rows), strict=True))
    for hot in (substring_dedup.HOT, 3):
        assert sorted(tuple(r) for r in substring_dedup.deduplicate(df, hot=hot).collect()) == want


def test_mix_meets_its_targets(varied, odd, none):
    for df, rows in (varied, odd):
        got = mixing.taken_words(df).collect()
        sizes = {}
        for _, t, _, s in rows:
            sizes[s] = sizes.get(s, 0) + len(brute.words(t))
        order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
        want = dict(zip([sizes[s] for s in order], mixing.targets([sizes[s] for s in order]), strict=True))
        assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r["size"] for r in got)
        taken = {}
        for r in got:
            assert r.target == pytest.approx(want[r.source_size])
            taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
        assert collected(mixing.taken_words(df.repartition(3))) == collected(mixing.taken_words(df))
        drawn = mixing.mixture(df).collect()
        whole = [r["size"] * (r.taken // r["size"] + (2 * (r.taken % r["size"]) >= r["size"])) for r in got if r["size"]]
        assert sum(len(brute.words(r.text)) for r in drawn) == sum(whole)
    assert mixing.taken_words(none).count() == 0 and mixing.mixture(none).count() == 0


def test_targets_share_the_excess():
    assert mixing.targets([10, 1000, 1000]) == pytest.approx([20.0, 1996.6666666666667, 998.3333333333334])
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]


def test_the_tree_deals_exact_quotas():
    quotas = np.array([100, 37, 0, 5])
    leaves = dict(mixing.leaf_quotas(quotas, 7, 0, 7))
    assert (sum(leaves.values()) == quotas).all() and {int(v.sum()) for v in leaves.values()} <= {20, 21}
    assert (leaves[4] == dict(mixing.leaf_quotas(quotas, 7, 4, 5))[4]).all()


def _plain_ppm(counts, context, byte):
    """Probability by escapes with exclusion; counts: context tuple -> {byte: n}."""
    out, p = set(), 1.0
    for k in range(len(context), -1, -1):
        seen = counts.get(context[len(context) - k :], {})
        left = {b: n for b, n in seen.items() if b not in out}
        whole = sum(left.values()) + len(left)
        if byte in left:
            return p * left[byte] / whole
        if left:
            p *= len(left) / whole
        out |= set(seen)
    return p / (256 - len(out))


def test_code_lengths_equal_plain_ppm(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("abracadabra", "x"), ("abrakadabra baba", "x"), ("xyzzy yxzzy", "y"), ("zzyx", "y")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = ppm_language.fit(df)
    tables = ppm_language.tables(trees)
    for i, lang in enumerate(trees.languages):
        counts = {}
        for _, t, own in rows:
            if own == lang:
                s = [256, 256, 256, *t.encode()]
                for j in range(3, len(s)):
                    for k in range(4):
                        counts.setdefault(tuple(s[j - k : j]), {}).setdefault(s[j], 0)
                        counts[tuple(s[j - k : j])][s[j]] += 1
        for text in ("abra", "zzz yx q", "é", "cadabra xyz"):
            data = np.frombuffer(text.encode(), np.uint8)
            s = [256, 256, 256, *data.tolist()]
            want = -sum(np.log2(_plain_ppm(counts, tuple(s[j - 3 : j]), s[j])) for j in range(3, len(s)))
            assert tables.lengths(data, np.array([0, len(data)]))[0, i] == pytest.approx(want, rel=1e-5)


def test_languages(spark, varied, odd, none):
    for df, rows in (varied, odd):
        got = ppm_language.identify(df).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in ppm_language.identify(varied[0]).collect()}
    assert all(by_id[d].lang_pred == "und" for d, t, *_ in varied[1] if not any(c.isalpha() for c in t or ""))
    assert ppm_language.identify(none).count() == 0
    kept = ppm_language.known_language(varied[0])
    assert kept.columns == varied[0].columns
    assert {500, 501, 502}.isdisjoint({r.doc_id for r in kept.collect()})
