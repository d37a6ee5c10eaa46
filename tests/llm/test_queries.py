"""Registered queries: names, SQL on the small tables, and the pipeline against plain stages."""

import os
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from checks.run import connect, rows_of
from hopscan.llm import encoder, mixing, near_dedup
from hopscan.llm.queries import QUERIES, SQL
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_every_number_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_agrees(spark, name):
    got = QUERIES[name](spark, SF)
    cur = connect(SF).execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, cur.fetchall())


def test_pipeline_equals_plain_stages(spark, varied, tmp_path):
    from tokenizers import Tokenizer

    df, rows = varied
    docs = df.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    results, read = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, read, str(tmp_path)).write.parquet(str(tmp_path / f"{i}_{name}"))
        read = spark.read.parquet(str(tmp_path / f"{i}_{name}"))
        results.append(read.collect())
        if i < 4:
            assert read.columns == docs.columns
    language, near, pii, mix, last = results
    known = {r.doc_id for r in language}
    assert known <= {d for d, t, *_ in rows if any(c.isalpha() for c in t or "")}
    assert {d for d, t, lang, _ in rows if lang and t and len(t) > 200 and t[0] in "abcdefghijklmnopqrstuvwxyz" and "x" * 30 not in t} <= known
    left = [(r.doc_id, r.text) for r in language]
    component, _ = brute.components(left)
    assert sorted(r.doc_id for r in near) == sorted(d for (d, _), c in zip(left, component) if d == c)
    text_of = {r.doc_id: r.text for r in near}
    assert {r.doc_id: r.text for r in pii} == text_of  # no personal data in these texts
    taken = {r.doc_id: r["size"] * (r.taken // r["size"] + (2 * (r.taken % r["size"]) >= r["size"]))
             for r in mixing.taken_words(spark.createDataFrame(pii)).collect() if r["size"]}
    words = Counter()
    for r in mix:
        words[r.doc_id] += len(brute.words(r.text))
        assert text_of[r.doc_id] == r.text and r.n_chars == len(r.text)
    assert words == Counter({d: n for d, n in taken.items() if n})
    library = Tokenizer.from_file(encoder.vocabulary_path())
    want = Counter()
    for r in mix:
        ids = library.encode(r.text, add_special_tokens=False).ids
        want[r.doc_id, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(r.text.encode())] += 1
    assert Counter(tuple(r) for r in last) == want
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want


def test_pipeline_drops_near_copies_from_80_percent(spark):
    words = [f"w{i}" for i in range(62)]
    rows = []
    for i, changed in enumerate((0, 1, 2)):  # each shares 53 / 63 = 0.84 with the one before
        text = [f"{w}x" if k in (20, 40)[:changed] else w for k, w in enumerate(words)]
        rows.append((10 + i, " ".join(text)))
    rows += [(20 + i, " ".join(f"v{k}" if k < 54 - i else f"u{i}a{k}" for k in range(54))) for i in (0, 6)]  # 44 / 56 = 0.79
    rows += [(30 + i, " ".join(f"t{k}" if k < 49 - i else f"s{i}b{k}" for k in range(49))) for i in (0, 5)]  # 40 / 50 = 0.8
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect())
    want, _ = brute.components(rows, 80)
    assert got == sorted(d for (d, _), c in zip(rows, want) if d == c) == [10, 20, 26, 30]
    want, _ = brute.components(rows)
    assert sorted(r.doc_id for r in near_dedup.keep_one(df, 85).collect()) == sorted(d for (d, _), c in zip(rows, want) if d == c)


def test_top_k_cases(spark):
    from hopscan.llm.topk import top_k

    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in rng.normal(size=12).round(1)]) for i in range(130)]
    vectors += [(200, None), (220, [1.0, None] * 6), (240, [float("nan")] * 12), (260, [float("inf")] * 12), (280, [0.5] * 5), (281, [0.25] * 5), (None, [1.0] * 12)]
    vectors += [(5, vectors[5][1]), (7, vectors[9][1])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in vectors], "vec_id long, embedding array<float>, label int, score string").repartition(4)
    good = [(i, np.floor(np.array(np.float32(v), float) * 64).astype(int)) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all()]
    want = set()
    for i, q in good:
        if i % 20 == 0:
            scores = sorted((-int(q @ v), j) for j, v in good if j != i and len(v) == len(q))[:20]
            want |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)}
    assert {tuple(r) for r in top_k(df).collect()} == want
    assert top_k(df.limit(0)).count() == 0
