"""Files written by the test and read back."""

import datetime

import pytest

from carelens.sources import readers as R
from carelens.sources import staging, writers


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_latest_snapshot(spark, rows, tmp_path):
    for name, value in [("CDI_20230101_SUD", 1), ("CDI_20230401_SUD", 2), ("CDI_20230901_PC", 3), ("IMAT_20231201_SUD", 4)]:
        write(tmp_path / "raw" / f"{name}.csv", f"id,v\na,{value}\n")
    folder = str(tmp_path / "raw")
    assert R.latest_snapshot_name(spark, folder, ["CDI", "SUD"]) == "CDI_20230401_SUD.csv"
    assert rows(R.latest_snapshot(spark, folder, ["CDI", "SUD"], "id string, v int")) == [("a", 2)]
    with pytest.raises(FileNotFoundError):
        R.latest_snapshot(spark, folder, ["REAIM"], "id string")


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_snapshot_folder_whose_name_occurs_earlier_in_the_path(spark, tmp_path, scheme):
    write(tmp_path / "data" / "site (a)" / "data" / "CDI_20230101.csv", "id\nx\n")
    folder = f"{scheme}{tmp_path}/data/site (a)/data"
    assert R.latest_snapshot_name(spark, folder, ["CDI"]) == "CDI_20230101.csv"
    assert R.latest_snapshot_name(spark, folder + "/", ["CDI"]) == "CDI_20230101.csv"


def test_null_tokens_and_bad_numbers(spark, rows, tmp_path):
    write(tmp_path / "x.csv", "id,v,w\na,1,NA\nb,.,2.5\nc,na,\nd,abc,7\n")
    got = rows(R.read_csv_nulls(spark, str(tmp_path / "x.csv"), "id string, v int, w double"))
    assert got == [("a", 1, None), ("b", None, 2.5), ("c", None, None), ("d", None, 7.0)]


def test_extract(spark, rows):
    raw = spark.createDataFrame(
        [(1, "2022-03-04", "dr", "S"), (1, "2022-03-04", "dr", "S"), (2, "x", None, "S")],
        "`patient no` int, `cln enc date` string, prvdr string, `svc dprtmnt` string",
    )
    assert rows(R.load_visits(raw, "patient no")) == [(1, datetime.date(2022, 3, 4), "dr", "S"), (2, None, None, "S")]
    with pytest.raises(ValueError):
        R.load_visits(raw.drop("prvdr"), "patient no")


def test_csv_forms(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 2)], "id string, v int").coalesce(1)
    path = writers.write_csv(df, str(tmp_path / "out.csv"), sep="\t", null="", dated=True, today=datetime.date(2023, 4, 1))
    assert path.endswith("out_20230401.csv")
    assert [r[0] for r in spark.read.text(path).collect()] == ["id\tv", "a\t", "b\t2"]


def test_discard_deletes_what_was_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_root", lambda _: str(tmp_path))
    path = staging.save_stage(spark.range(3).toDF("x"), "t")
    assert staging.read_stage(spark, path).count() == 3
    staging.discard(spark)
    assert list(tmp_path.iterdir()) == []


def test_stage_goes_to_the_shared_folder(spark, rows):
    root = staging.shared_root(spark)
    path = staging.save_stage(spark.range(3).toDF("x"), "t")
    assert path.startswith(root)
    assert rows(staging.read_stage(spark, path)) == [(0,), (1,), (2,)]
    kept = staging.cut_lineage(spark.range(3).toDF("x"))
    assert kept.count() == 3


def test_published_tables(spark, rows, tmp_path):
    """Readers keep the version they began with; the disk does not grow; unfinished work does not count."""
    import os
    import time

    from carelens.sources import published as P

    root, home = str(tmp_path), tmp_path / "t"
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, root, "t")
    first = P.publish(spark.createDataFrame([(1, "a"), (2, None)], "id int, s string"), root, "t")
    assert (first["rows"], first["number"]) == (2, 1)
    before = P.read_published(spark, root, "t")
    P.publish(spark.createDataFrame([(3, "b", 1.5)], "id int, s string, x double"), root, "t")
    assert rows(before) == [(1, "a"), (2, None)] and rows(P.read_published(spark, root, "t")) == [(3, "b", 1.5)]
    (home / "_manifests" / "000000000009.json").write_text('{"folder": "version-half')  # a job that is just writing
    (home / "version-running").mkdir()
    (home / "version-failed").mkdir()
    os.utime(home / "version-failed", (time.time() - 2 * P.ABANDONED,) * 2)
    assert rows(P.read_published(spark, root, "t")) == [(3, "b", 1.5)]
    third = P.publish(spark.createDataFrame([], "id int"), root, "t")
    assert third["number"] == 3 and P.read_published(spark, root, "t").columns == ["id"]
    for i in range(4):
        P.publish(spark.range(i), root, "t")
    versions = {p.name for p in home.iterdir() if p.name.startswith("version-")}
    assert len(versions) == P.KEPT + 1 and "version-running" in versions and first["folder"] not in versions
    assert P.read_published(spark, root, "t").count() == 3


def test_two_jobs_that_publish_at_once(spark, tmp_path, monkeypatch):
    from carelens.sources import published as P

    real, calls = P._manifests, []
    monkeypatch.setattr(P, "_manifests", lambda *a: calls.append(1) or ({} if len(calls) in (1, 3) else real(*a)))
    numbers = [P.publish(spark.range(n), str(tmp_path), "t", kept=5)["number"] for n in (2, 7)]
    assert numbers == [1, 2]  # the second saw no manifest either
    monkeypatch.undo()
    assert P.read_published(spark, str(tmp_path), "t").count() == 7


def test_rejected_cells(spark, rows, tmp_path):
    for name, text in (("a", "id,n,d,s\n1,5,2023-01-02,x\nnot,6.5,2023-13-01,y\n3,NA,,z\n"), ("b", 'id,n,d,s\n4,1e3,soon,"a\nb"\n5, 7 ,2023-02-03,\n')):
        write(tmp_path / "in" / f"{name}.csv", text)
    good, bad = R.read_csv_rejects(spark, str(tmp_path / "in"), "id int, n int, d date, s string", multiLine=True)
    day = datetime.date
    assert rows(good) == [(1, 5, day(2023, 1, 2), "x"), (3, None, None, "z"), (4, None, None, "a\nb"), (5, 7, day(2023, 2, 3), None), (None, None, None, "y")]
    cells = sorted((r["file"].rsplit("/", 1)[1], r["row"], r["column"], r["text"]) for r in bad.collect())
    assert cells == [("a.csv", 2, "d", "2023-13-01"), ("a.csv", 2, "id", "not"), ("a.csv", 2, "n", "6.5"), ("b.csv", 1, "d", "soon"), ("b.csv", 1, "n", "1e3")]
    assert rows(R.rejected_counts(bad)) == [("d", 2), ("id", 1), ("n", 2)]
    none = R.read_csv_rejects(spark, str(tmp_path / "in"), "id string, n string, d string, s string")[1]
    assert none.collect() == []


def test_rejected_cells_of_files_read_in_blocks(spark, tmp_path):
    lines = [f"{i},{'x' * 50}" if i % 97 else f"bad{i},{'x' * 50}" for i in range(1, 4001)]
    write(tmp_path / "in" / "long.csv", "n,s\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        good, bad = R.read_csv_rejects(spark, str(tmp_path / "in"), "n int, s string")
        assert good.count() == 4000 and good.filter("n is null").count() == 41
        assert {(r["row"], r["text"]) for r in bad.collect()} == {(i, f"bad{i}") for i in range(97, 4001, 97)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
