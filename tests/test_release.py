"""The release folder: contents that are checked, and errors that say what is wrong."""

import os
import shutil

import pytest

from hopscan.operators import ordered as od, quality as ql
from hopscan.sources import sinks as sk
from hopscan.sources.raw_reads import read_fastq


def tables(spark):
    odd = [("a\tb", " lead", None, 1.5), ('say "x"', "", "null", -0.0), ("é,ü", "trail ", "-", 1e-7), ("a\tb", " lead", None, 1.5)]
    df = spark.createDataFrame(odd, "k string, t string, n string, v double").selectExpr("*", "array(1, 2) AS list")
    return {name: df for name in sk.release_manifest(True, True).values()}


def test_a_release_says_what_it_holds(spark, tmp_path):
    path = str(tmp_path / "r")
    targets = sk.write_release(tables(spark), path, True, True)
    found = {r.target: (r.row_count, r.intact) for r in sk.verify_release(spark, path).collect()}
    assert sorted(found) == targets and len(targets) == 17 and set(found.values()) == {(4, True)}


def test_changes_are_seen(spark, tmp_path):
    path = str(tmp_path / "r")
    sk.write_release(tables(spark), path, False, True)
    one, two, gone = (f"{path}/{t}" for t in ("insertion_level/LFC.tsv", "gene_level/LFC.tsv", "insertion_level/baseMean.tsv"))
    for folder, old, new in ((one, "1.0E-7", "2.0E-7"), (two, "trail ", "trail")):
        for name in os.listdir(folder):
            if name.startswith("part-"):
                file = f"{folder}/{name}"
                text = open(file, encoding="utf-8").read()
                open(file, "w", encoding="utf-8").write(text.replace(old, new))
                crc = f"{folder}/.{name}.crc"
                if os.path.exists(crc):
                    os.remove(crc)
    shutil.rmtree(gone)
    broken = {r.target for r in sk.verify_release(spark, path).collect() if not r.intact}
    assert broken == {"insertion_level/LFC.tsv", "gene_level/LFC.tsv", "insertion_level/baseMean.tsv"}
    shutil.rmtree(f"{path}/{sk.MANIFEST}")
    with pytest.raises(Exception, match="(?i)manifest"):
        sk.verify_release(spark, path)


def test_fingerprints_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(i % 5, str(i % 3)) for i in range(60)], "a long, b string")
    same = sk.fingerprint(df.orderBy("b").repartition(7)).collect()
    assert same == sk.fingerprint(df).collect()
    assert sk.fingerprint(df.limit(59)).collect() != same
    assert sk.fingerprint(spark.createDataFrame([("x", "")], "a string, b string")).collect() != sk.fingerprint(spark.createDataFrame([("", "x")], "a string, b string")).collect()
    assert sk.fingerprint(df.limit(0)).first()["row_count"] == 0


def test_tables_without_keys_are_named(spark):
    a = spark.createDataFrame([("S", "T", 1)], "Sample string, Timepoint string, n long")
    with pytest.raises(ValueError, match="none of the keys"):
        ql.qc_rollup([a, spark.range(2)])
    with pytest.raises(ValueError, match="none of the columns"):
        ql.expand_sample_files(a.selectExpr("*", "'c' AS Condition"), present=spark.range(2))


def test_a_broken_record_is_named(spark, tmp_path):
    import gzip

    good, bad = "@a\nACGT\n+\nIIII\n", "@b\nACGT\n+\nIII\n"
    with gzip.open(tmp_path / "x_R1.fastq.gz", "wt") as f:
        f.write(good * 3)
    assert read_fastq(spark, str(tmp_path / "x_R1.fastq.gz"), 1).count() == 3
    with gzip.open(tmp_path / "y_R1.fastq.gz", "wt") as f:
        f.write(good + bad + good)
    with pytest.raises(Exception, match="broken read record '@b'"):
        read_fastq(spark, str(tmp_path / "y_R1.fastq.gz"), 1).count()


@pytest.mark.parametrize("width,fan", [(1, 2), (3, 4), (1000, 1024)])
def test_values_are_carried_in_levels(spark, monkeypatch, width, fan):
    monkeypatch.setattr(od, "FAN", fan)
    values = [None, None, 4, None, None, None, None, 7, None, 9, None, None, None, None, None]
    df = spark.createDataFrame([(i, 0, v) for i, v in enumerate(values)] + [(2, 1, 5), (2, 2, None)], "i long, t long, v long").repartition(3)
    got = od.carry_forward(df, "v", "i", width=width, ties=["t"])
    want = [None, None, 4, 5, 5, 5, 5, 5, 5, 7, 7, 9, 9, 9, 9, 9, 9]
    assert [r.v for r in sorted(got.collect())] == want
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
