"""Batch folders of the stream, merged in levels."""

import shutil

import pytest

from conftest import rows
from hopscan.streaming import site_counts as sc


def write(spark, output, n, first=0):
    for i in range(first, n):
        data = [("S", "t", "PBL", "I", i % 4, 1, i), ("S", "t", "PBR", "II", i, 2, 3)]
        spark.createDataFrame(data, "Sample string, Timepoint string, Fragment string, Chr string, Coordinate long, plus long, minus long").coalesce(1).write.parquet(f"{output}/batch={i}")


def wanted(n):
    out = {}
    for i in range(n):
        for key, plus, minus in ((("S", "t", "PBL", "I", i % 4), 1, i), (("S", "t", "PBR", "II", i), 2, 3)):
            p, m = out.get(key, (0, 0))
            out[key] = (p + plus, m + minus)
    return sorted((*k, *v) for k, v in out.items())


def test_folders_grow_with_the_logarithm(spark, tmp_path):
    output = str(tmp_path / "sites")
    done = 0
    for n in (2, 5, 10, 19):
        write(spark, output, n, done)
        done = n
        live = sc.compact_site_counts(spark, output, fan=3)
        assert rows(sc.running_site_counts(spark, output)) == wanted(n)
        spans = sorted((f.first, f.last) for f in live)
        assert spans[0][0] == 0 and spans[-1][1] == n - 1 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    assert len(live) <= 2 * 3 + 1 and max(f.level for f in live) == 2
    assert sc.compact_site_counts(spark, output, fan=3) == live  # nothing left to do


def test_a_failed_merge_leaves_nothing_to_read(spark, tmp_path, monkeypatch):
    output = str(tmp_path / "sites")
    write(spark, output, 7)
    added, calls = sc._added, []

    def failing(partial, by):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return added(partial, by)

    monkeypatch.setattr(sc, "_added", failing)
    with pytest.raises(RuntimeError):
        sc.compact_site_counts(spark, output, fan=3)
    monkeypatch.setattr(sc, "_added", added)
    assert {f.level for f in sc.live_folders(spark, output)} == {0}
    assert rows(sc.running_site_counts(spark, output)) == wanted(7)
    assert len(sc.compact_site_counts(spark, output, fan=3)) == 3
    # A manifest that was not finished does not count either.
    shutil.copytree(f"{output}_manifest/version=0", f"{output}_manifest/version=1")
    (tmp_path / "sites_manifest" / "version=1" / "_SUCCESS").unlink()
    assert rows(sc.running_site_counts(spark, output)) == wanted(7)


def test_no_batches(spark, tmp_path):
    with pytest.raises(ValueError, match="no batch"):
        sc.running_site_counts(spark, str(tmp_path / "none"))
