"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects documents whose figure lies above a cutoff. Labelled good documents that the fixed
rules let pass are the holdout. For each stratum (``lang``, null for itself) and rule the cutoffs of
a fixed grid are tested from the most lenient on: if the chance of at most k rejections among n good
documents, were the true rate as high as ``risk`` / rules, is at most ``error`` / (strata x rules),
the cutoff is certified (exact binomial tail; fixed-sequence testing along the nested cutoffs,
Bonferroni over the sequences). Of the certified cutoffs the one holds whose share of rejected bad
documents exceeds that of good ones most, by LEAST_GAIN at least (equal gains: the most lenient); a
rule without one rejects nothing. So with probability 1 - ``error``, in every stratum at most ``risk`` of good documents go.

Null texts have no words and fail. Rows repeating a doc_id are judged alone; a doc_id labelled more
than once is good if every label says so; null ids have no label. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hopscan.llm.store import checkpointed

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
RISK, ERROR, LEAST_GAIN = 0.05, 0.05, 0.05
#: Cutoffs of each rule from lenient to strict.
GRID = {
    "symbols_per_word": [2.0, 1.5, 1.2, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1],
    "repeated_share": [0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.04],
    "copied_lines_per_word": [0.5, 0.3, 0.2, 0.1, 0.08, 0.06, 0.04, 0.03, 0.02, 0.01],
    "chars_per_word": [60.0, 40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0],
}


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words standing twice or more in the array."""
    n = F.size(words) - WINDOW + 1

    def counted(hashes: Column) -> Column:
        def of(sorted_: Column) -> Column:
            again = F.filter(sorted_, lambda x, k: F.coalesce(F.get(sorted_, k - 1)["h"] == x["h"], F.lit(False))
                             | F.coalesce(F.get(sorted_, k + 1)["h"] == x["h"], F.lit(False)))
            return _bound(F.sort_array(F.transform(again, lambda x: x["i"])), lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
                F.lit(0), lambda a, x: a + x))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            _bound(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of))

    windows = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(n < 2, 0).otherwise(_bound(windows, counted))


def _bound(value: Column, use) -> Column:  # noqa: ANN001
    """``use`` applied to a value that is computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def figures(docs: DataFrame) -> DataFrame:
    """doc_id, stratum and the figures of every row."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def of(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), repeated_words(words).cast("long").alias("n_repeat_words"))

    def without(chars: str) -> Column:
        return F.length(F.translate(text, chars, ""))

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("stratum"),
        _bound(F.filter(F.split(text, SPACES), lambda w: w != ""), of).alias("w"),
        without(" \t\n\x0b\f\r").cast("long").alias("word_chars"),
        (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "stratum", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words").withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def rules() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words, "repeated_share": F.col("n_repeat_words") / words,
        "copied_lines_per_word": F.col("n_dup_lines") / words, "chars_per_word": F.col("word_chars") / words,
    }


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """Chance of at most k of n at ``rate``, by the sum of all terms in logarithms; 1 from the mean on."""
    first = n * F.log(F.lit(1 - rate))
    odds = F.log(F.lit(rate / (1 - rate)))
    start = F.struct(first.alias("term"), first.alias("sum"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        top, low = F.greatest(term, s["sum"]), F.least(term, s["sum"])
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(low - top))).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * rate, 1.0).otherwise(F.exp(F.aggregate(terms, start, step)["sum"]))


def certified(rows: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, rule, cutoff) of the certified cutoffs that separate best. One row per stratum and rule at most."""
    quality, toxic = F.coalesce(F.col("quality"), F.lit(0)), F.coalesce(F.col("toxic"), F.lit(0))
    known = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min((quality == 1) & (toxic == 0)).alias("good"), F.max(quality == 0).alias("bad")))
    holdout = rows.filter(~F.col("base_failed")).join(known, "doc_id")
    of = rules()
    above = [F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"),
                      F.count_if(F.col("good") & (of[r] > c)).alias("k"), F.count_if(F.col("bad") & (of[r] > c)).alias("hits"))
             for r, cutoffs in GRID.items() for i, c in enumerate(cutoffs)]
    table = checkpointed(holdout.groupBy("stratum").agg(
        F.count_if("good").alias("n"), F.count_if("bad").alias("n_bad"), F.array(*above).alias("tests")))
    level = error / max(1, table.count() * len(GRID))
    gain = F.col("hits") / F.greatest("n_bad", F.lit(1)) - F.col("k") / F.greatest("n", F.lit(1))
    tested = (table.select("stratum", "n", "n_bad", F.inline("tests"))
              .withColumn("ok", binomial_tail(F.col("k"), F.col("n"), risk / len(GRID)) <= level)
              .withColumn("gain", gain))
    steps = tested.groupBy("stratum", "rule").agg(
        F.min(F.when(~F.col("ok"), F.col("step"))).alias("stop"), F.collect_list(F.struct("gain", -F.col("step"), "step", "cutoff")).alias("all"))
    held = F.filter("all", lambda x: (F.col("stop").isNull() | (x["step"] < F.col("stop"))) & (x["gain"] >= LEAST_GAIN))
    return steps.select("stratum", "rule", F.array_max(held)["cutoff"].alias("cutoff")).filter("cutoff IS NOT NULL")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Figures of every row and whether it is kept."""
    rows = checkpointed(figures(docs))
    of = rules()
    reject = F.lit(False)
    for r in certified(rows, labels).collect():  # one short row per stratum and rule
        reject = reject | (F.col("stratum").eqNullSafe(F.lit(r.stratum)) & (of[r.rule] > r.cutoff))
    return rows.withColumn("kept", ~F.col("base_failed") & ~reject)
