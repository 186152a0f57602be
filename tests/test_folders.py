"""Folder source and archive sink."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from larkspur.sources import folders


def tree(root):
    for p in ("p1", "p2", "p3"):
        for a in ("a1", "a2"):
            os.makedirs(root / p / a)
            for i in range(3):
                (root / p / a / f"{p}_{a}_{i}.NII.gz").write_bytes(b"x" * i)
            (root / p / a / "notes.txt").write_text("no scan")
    (root / "stray.txt").write_text("not a folder")


def test_all_folders(spark, tmp_path):
    tree(tmp_path)
    rows = folders.scan_folders(spark, str(tmp_path), ".nii.gz", content=True, folders=4)
    assert rows.rdd.getNumPartitions() == 2
    got = {(r.patient, r.accession, r.file): (r.length, bytes(r.content), r.path) for r in rows.collect()}
    assert len(got) == 18 and got["p2", "a1", "p2_a1_2.NII.gz"] == (2, b"xx", f"{tmp_path}/p2/a1/p2_a1_2.NII.gz")
    assert folders.scan_folders(spark, str(tmp_path)).where("file = 'notes.txt' AND length > 0").count() == 6


def test_pruned_folders_are_never_opened(spark, tmp_path):
    """Folders that would fail to be listed: links that turn in circles."""
    tree(tmp_path)
    os.symlink(tmp_path / "p9", tmp_path / "p9")
    for a in ("a1", "a2"):
        for f in os.listdir(tmp_path / "p3" / a):
            os.remove(tmp_path / "p3" / a / f)
        os.rmdir(tmp_path / "p3" / a)
    rows = folders.scan_folders(spark, str(tmp_path), ".nii.gz", folders=1)
    assert rows.where("patient = 'p1' AND accession IN ('a2', 'zz')").rdd.getNumPartitions() == 1
    assert sorted(r.file for r in rows.where("patient = 'p1' AND accession IN ('a2', 'zz')").collect()) == [f"p1_a2_{i}.NII.gz" for i in range(3)]
    reader = folders.FolderReader({"path": str(tmp_path), "folders": "1"})
    left = list(reader.pushFilters([folders.EqualTo(("patient",), "p2"), folders.EqualTo(("file",), "x"), folders.In(("patient",), ("p2", "p3"))]))
    assert [f.attribute for f in left] == [("file",)]
    opened = []
    real = folders._names
    folders._names = lambda system, folder, kind: opened.append(folder) or real(system, folder, kind)
    try:
        assert [p.folders for p in reader.partitions()] == [[("p2", "a1")], [("p2", "a2")]]
    finally:
        folders._names = real
    assert opened == [str(tmp_path), f"{tmp_path}/p2"]
    assert rows.where("patient = 'none'").count() == 0


def archives(path):
    return {f: open(os.path.join(path, f), "rb").read() for f in os.listdir(path)}


def test_archives_all_or_none(spark, tmp_path):
    rows = spark.createDataFrame([(f"set{k}", f"{i}.txt", bytearray(b"%d" % (i * k))) for k in range(5) for i in (3, 1, 2)], "archive string, name string, content binary").repartition(4)
    out = str(tmp_path)
    folders.write_archives(rows, out)
    first = archives(out)
    assert sorted(first) == [f"set{k}.zip" for k in range(5)]
    with zipfile.ZipFile(os.path.join(out, "set4.zip")) as z:
        assert z.namelist() == ["1.txt", "2.txt", "3.txt"] and z.read("3.txt") == b"12"
    folders.write_archives(rows.coalesce(1), out)
    assert archives(out) == first  # a rerun changes nothing
    broken = rows.withColumn("content", F.when(F.col("name") == "2.txt", F.expr("cast(raise_error('broken') as binary)")).otherwise(F.lit(b"new").cast("binary")))
    with pytest.raises(Exception, match="broken"):
        folders.write_archives(broken, out)
    assert archives(out) == first  # nor does a job that fails, and nothing is left behind
    folders.write_archives(rows.limit(0), out)
    assert archives(out) == first
