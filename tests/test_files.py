"""Exactly the wanted files: others are neither opened nor listed."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chunkmill.sources import files


@pytest.mark.parametrize("own", [True, False])
def test_only_wanted_files_are_opened(spark, tmp_path, monkeypatch, own):
    if not own:
        monkeypatch.setattr(files, "_OPENED", ())
        monkeypatch.setattr(files, "_NAMES", 7)
    monkeypatch.setattr(files, "PART", 9)
    at = tmp_path / "data"
    at.mkdir()
    for i in range(1500):  # whoever opens one of these fails
        (at / f"other{i}.xml").symlink_to(tmp_path / "nowhere")
    for i in range(30):
        (at / f"want [{i}].xml").write_bytes(b"x" * i)
    names = [f"{'file:' if not own else ''}{at}/want [{i}].xml" for i in range(30)]
    paths = spark.createDataFrame([(p,) for p in [*names, names[3], f"{at}/other5.xml", f"{at}/none.xml", None]], "path string")
    found, missing = files.read_wanted(spark, paths, str(tmp_path / "list"))
    assert sorted(r[0] for r in found.select(F.length("content")).collect()) == list(range(30))
    assert sorted(r[0].rsplit("/", 1)[1] for r in missing.collect()) == ["none.xml", "other5.xml"]
    if own:
        assert found.rdd.getNumPartitions() == 4 and {r["path"] for r in found.select("path").collect()} == set(names)


def test_no_wanted_files(spark, tmp_path):
    found, missing = files.read_wanted(spark, spark.createDataFrame([], "path string"), str(tmp_path / "list"))
    assert found.count() == missing.count() == 0
