"""Numbers that no small table shows, and files that go missing."""

import random
import shutil
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pytest

from hopscan.llm import kneser_ney, ppm_language, substring_dedup
from hopscan.llm.store import BATCH_BYTES, bound_batches
from hopscan.llm.textbytes import pack, pack_counts
from tests.llm.conftest import DOCUMENTS, sentence


def test_counts_beyond_32_bits():
    keys, counts = np.array([5, 9], np.uint64), np.array([1 << 31, 7], np.uint64)
    rows = pd.DataFrame({"shard": [0] * 3, "keys": [pack(keys)] * 3, "counts": [pack_counts(counts)] * 3})
    once, many, n = kneser_ney._pair_arrays(np.frombuffer(kneser_ney._pair_file(rows), np.uint8))
    assert not len(once) and many.tolist() == [5, 9] and n.tolist() == [3 << 31, 21]


def test_languages_of_any_size_are_drawn(spark):
    shares = {"a": 1.0, "b": 0.25, "c": 1e-9, "d": 500 / 1e10}
    row = spark.range(1).select(*(ppm_language.limits(shares)[k].alias(k) for k in shares)).head()
    assert row.a == (1 << 63) - 1 and row.b == (1 << 62) - (1 << 63)
    for k in "cd":  # the chance that a random 64-bit hash is drawn
        assert (row[k] + (1 << 63)) / (1 << 64) == pytest.approx(shares[k], rel=1e-6)


def test_a_language_without_a_drawn_row_is_an_error(spark, monkeypatch):
    df = spark.createDataFrame([(i, "some words here", "en", "s", 0) for i in range(20)], DOCUMENTS)
    monkeypatch.setattr(ppm_language, "limits", lambda shares: ppm_language.F.create_map(
        ppm_language.F.lit("en"), ppm_language.F.lit(-(1 << 63)).cast("long")))
    with pytest.raises(ValueError, match="en"):
        ppm_language.fit(df)


def test_languages_are_told_apart(spark):
    rng = random.Random(6)
    syllables = {"en": ("the", "ing", "er", "tion", "sh", "wh"), "de": ("sch", "ung", "ein", "ä", "ver", "keit"), "fr": ("eau", "oi", "é", "que", "les", "ment")}
    rows = [(i, sentence(rng, rng.randint(5, 40), syllables[lang]), lang, "s", 0) for i in range(600) for lang in [rng.choice(list(syllables))]]
    got = ppm_language.identify(spark.createDataFrame(rows, DOCUMENTS)).collect()
    lang = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out]
    assert len(held) > 80 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def _lose_one(shards):
    shutil.rmtree(urlparse(f"{shards.folder}/shard=0").path)


@pytest.mark.parametrize("operator", ["substrings", "scores"])
def test_a_lost_file_is_an_error(spark, operator):
    docs = spark.createDataFrame([(i, sentence(random.Random(i % 5), 60), "en", "s", 0) for i in range(20)], DOCUMENTS)
    if operator == "substrings":
        index = substring_dedup.build(docs)
        _lose_one(index.contexts.shards)
        with pytest.raises(FileNotFoundError):
            index.contexts(np.array([1], np.uint64), 0)
    else:
        model = kneser_ney.fit(docs)
        _lose_one(model.pairs)
        with pytest.raises(FileNotFoundError):
            kneser_ney.Scorer(model).pair_counts(np.array([1], np.uint64))


def test_a_bound_set_by_the_user_stays(spark):
    before = spark.conf.getAll.get(BATCH_BYTES)
    try:
        spark.conf.set(BATCH_BYTES, str(256 << 20))
        bound_batches(spark)
        assert spark.conf.get(BATCH_BYTES) == str(256 << 20)
        spark.conf.unset(BATCH_BYTES)
        bound_batches(spark)
        assert spark.conf.get(BATCH_BYTES) == str(4 << 20)
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)
