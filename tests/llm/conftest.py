import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that an input may bring along under names that operators use themselves.
CLASHING = "score double, kept boolean, check string, row string, node string, size string, shard string, block string, spans string, part string"


def sentence(rng, n, syllables=("an", "the", "lo", "mi", "er", "tion", "sta", "ke", "ou", "re")):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def varied_texts(seed=7):
    """Copies, near copies, shared passages, repeats, odd bytes and long words."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(20, 160)) for _ in range(12)]
    passage = sentence(rng, 40)
    texts = list(base)
    texts += [base[0], base[0], base[1], base[1].upper()]
    for b in base[:6]:
        w = b.split()
        w[len(w) // 2] = "changed"
        texts += [" ".join(w), b + " tail", "head " + b]
    texts += [base[2] + "\n" + passage, passage + " " + base[3], passage, sentence(rng, 8) + " " + passage + " " + sentence(rng, 8)]
    line = sentence(rng, 7)
    texts += ["\n".join([line] * 5), " ".join(["same words again and"] * 30), "x" * 3000, "ab " * 1500, "é" * 700 + " ü " + "漢字" * 60]
    texts += ["one", "one two three four", "ONE two three four", "a\x0bb\x0cc\x1fd e", "<|endoftext|> it's 12 o'clock  \n\n  ok", "$$$ ### ***"]
    return texts


@pytest.fixture(scope="session")
def varied(spark):
    """(DataFrame, rows): varied texts with nulls, empty texts, extra clashing columns and a long text."""
    rng = random.Random(3)
    rows = []
    for i, t in enumerate(varied_texts()):
        rows.append((i * 3, t, ("en", "de", None)[i % 3], ("a", "b", None, "")[i % 4]))
    long = sentence(rng, 30_000)
    rows += [(500, None, "en", "a"), (501, "", "en", "b"), (502, " \n\t ", None, None), (503, long, "en", "a"), (504, long + " end", "en", "c")]
    frame = spark.createDataFrame(
        [(d, t, lang, s, len(t or ""), 0.5, True, "c", "r", "n", "s", "sh", "b", "sp", "p") for d, t, lang, s in rows], f"{DOCUMENTS}, {CLASHING}")
    return frame.repartition(5), rows


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that repeat, and rows with a null id."""
    text = sentence(random.Random(11), 60)
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (1, "other words", "en", None), (None, text, None, "a"), (None, None, None, None), (2, text, "en", "b")]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCUMENTS), rows


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)
