"""Deleting by position, file skipping, packing of small files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import file_stats, layout, positions, tables
from tidemark.sources.lake import read_table



@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


def numbers(spark, n=1000):
    return spark.range(n).selectExpr("id AS k", "IF(id % 11 = 0, NULL, id * 7 % 100) AS v", "IF(id % 3 = 0, NULL, CONCAT('a b:', id % 3)) AS p")


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


# positions

def test_a_delete_rewrites_no_data_file(spark, path, rows):
    start = numbers(spark)
    tables.append(start, path, ["p"])
    before = files(path)
    positions.delete_by_position(spark, path, F.col("k") == 500)
    positions.delete_by_position(spark, path, (F.col("v") > 95) | (F.col("k") == 500))
    assert files(path) == before
    kept = start.where("NOT (k = 500 OR coalesce(v > 95, false))")
    assert rows(positions.read_live(spark, path).select("k", "v", "p")) == rows(kept)
    assert rows(positions.read_live(spark, path, where=F.col("k") < 20).select("k", "v", "p")) == rows(kept.where("k < 20"))
    assert positions.deleted(spark, path).count() == positions.deleted(spark, path).distinct().count() == start.count() - kept.count()


def test_folding_deletes(spark, path, rows):
    start = numbers(spark)
    tables.append(start, path, ["p"])
    assert not positions.fold_deletes(spark, path, ["p"])
    untouched = {f: t for f, t in files(path).items() if "a b%3A2" in f}
    positions.delete_by_position(spark, path, (F.col("p") == "a b:1") | F.col("p").isNull() & (F.col("k") < 500))
    want = rows(positions.read_live(spark, path).select("k", "v", "p"))
    assert positions.fold_deletes(spark, path, ["p"], schema=start.schema)
    assert rows(read_table(spark, path).select("k", "v", "p")) == want == rows(positions.read_live(spark, path).select("k", "v", "p"))
    assert {f: t for f, t in files(path).items() if f in untouched} == untouched and not glob.glob(f"{path}/p=a b%3A1*/*.parquet")
    positions.delete_by_position(spark, path, F.col("k") == 999)
    assert positions.read_live(spark, path).where("k = 999").isEmpty()


def test_positions_of_files_that_are_gone_match_nothing(spark, path, rows):
    start = numbers(spark, 60)
    tables.append(start, path, ["p"])
    positions.delete_by_position(spark, path, F.col("k") < 30)
    tables.overwrite_slice(start, path, ["p"])
    assert rows(positions.read_live(spark, path).select("k", "v", "p")) == rows(start)


# statistics

def test_only_matching_files_are_opened(spark, path, rows):
    start = numbers(spark).repartitionByRange(10, "k")
    tables.append(start.where("k < 0"), path)
    start.write.mode("append").parquet(path)
    assert file_stats.refresh_stats(spark, path, ["k", "v"]) == len(files(path))
    assert file_stats.refresh_stats(spark, path, ["k", "v"]) == 0
    wanted = {"k": (120, 180)}
    chosen = {r[0].split("/")[-1] for r in file_stats.files_within(spark, path, wanted).collect()}
    holding = {r[0].split("/")[-1] for r in spark.read.parquet(path).where("k BETWEEN 120 AND 180").select("_metadata.file_path").distinct().collect()}
    others = {os.path.basename(f) for f in files(path)} - chosen
    assert holding <= chosen and len(others) >= 7
    for f in files(path):
        if os.path.basename(f) in others:
            os.remove(f"{os.path.dirname(f)}/.{os.path.basename(f)}.crc")
            open(f, "r+b").write(b"gone")
    assert rows(file_stats.scan_within(spark, path, wanted, schema=start.schema)) == rows(start.where("k BETWEEN 120 AND 180"))


def test_ranges_nulls_and_new_files(spark, path, rows):
    start = numbers(spark).repartition(6, "k")
    tables.append(start, path, ["p"])
    scan = lambda **r: rows(file_stats.scan_within(spark, path, r).select("k", "v", "p"))
    assert scan(v=(90, None)) == rows(start.where("v >= 90"))  # no statistics yet
    file_stats.refresh_stats(spark, path, ["k", "v"])
    more = spark.createDataFrame([(2000, None, "x"), (2001, 5000, None)], "k long, v long, p string")
    tables.append(more, path, ["p"])
    assert scan(k=(1990, None)) == rows(more) and scan(v=(200, 10_000)) == rows(more.where("v = 5000"))
    assert file_stats.refresh_stats(spark, path, ["k", "v"]) == 2 and file_stats.refresh_stats(spark, path, ["k", "v"]) == 0
    assert scan(k=(2000, 2000), v=(None, None)) == [] and scan(k=(2001, None), v=(None, 6000)) == rows(more.where("v = 5000"))
    assert file_stats.files_within(spark, path, {"v": (4999, None)}).count() == 1 and scan(k=(5000, None)) == []
    with pytest.raises(ValueError):
        file_stats.refresh_stats(spark, path, ["p"])


# packing

def large_and_small(spark, path):
    start = numbers(spark, 30_000)
    start.where("k < 27000").coalesce(1).write.partitionBy("p").parquet(path)
    start.where("k >= 27000").repartition(12, "k").write.mode("append").partitionBy("p").parquet(path)
    sizes = sorted(os.path.getsize(f) for f in files(path))
    return start, 2 * sizes[-3] - 2


def test_large_files_are_neither_read_nor_moved(spark, path, rows):
    start, target = large_and_small(spark, path)
    large = {f: t for f, t in files(path).items() if os.path.getsize(f) >= target / 2}
    small = set(files(path)) - set(large)
    assert len(large) == 3 and len(small) == 36
    contents = {f: open(f, "rb").read() for f in large}
    for f in large:  # unreadable while packing
        upto = len(contents[f]) - 8 - int.from_bytes(contents[f][-8:-4], "little")
        open(f, "wb").write(contents[f][:4] + b"x" * (upto - 4) + contents[f][upto:])
    assert layout.pack_small_files(spark, path, ["p"], target, schema=start.schema) == 3
    for f in large:
        os.remove(f"{os.path.dirname(f)}/.{os.path.basename(f)}.crc")
        open(f, "wb").write(contents[f])
    now = set(files(path))
    assert set(large) <= now and not small & now and len(now) == 6
    assert rows(read_table(spark, path, schema=start.schema).select("k", "v", "p")) == rows(start)
    assert layout.pack_small_files(spark, path, ["p"], target) == 0


def test_bins_by_hand(spark):
    sizes = {"a": [10, 20, 30, 40, 49, 60, 5], "b": [99], "c": [1, 2]}
    listing = spark.createDataFrame([(f"{p}{n}", s, p) for p, each in sizes.items() for n, s in enumerate(each)], "file_path string, file_bytes long, partition string")
    got = {(r["partition"], r["bin"]): set() for r in layout.bins(listing, 100).collect()}
    for r in layout.bins(listing, 100).collect():
        got[r["partition"], r["bin"]].add(r["file_bytes"])
    assert got == {("a", 0): {49, 40, 30}, ("a", 1): {20, 10, 5}, ("c", 0): {1, 2}}


@pytest.mark.parametrize("step", ["written", "listed", "half placed"])
def test_a_packing_that_dies(spark, path, rows, monkeypatch, step):
    start, target = large_and_small(spark, path)
    put = layout._put_in_place

    def dies(spark, path, folder):
        if step == "written":
            tables._delete(spark, f"{folder}/old")
        elif step == "half placed":
            old = [r[0] for r in spark.read.parquet(f"{folder}/old").collect()]
            fs, _ = tables._filesystem(spark, path)
            for uri in old[:20]:
                fs.delete(layout._path(spark, uri), False)
        raise OSError("lost")

    monkeypatch.setattr(layout, "_put_in_place", dies)
    with pytest.raises(OSError):
        layout.pack_small_files(spark, path, ["p"], target)
    monkeypatch.setattr(layout, "_put_in_place", put)
    layout.finish_packing(spark, path)
    assert rows(read_table(spark, path, schema=start.schema).select("k", "v", "p")) == rows(start)
    assert not layout._pending(spark, path) and len(files(path)) == (39 if step == "written" else 6)


def test_statistics_of_texts_sort_a_row_for_each_batch_only(spark, tmp_path):
    """Texts beyond ASCII, NULLs, bytes and a file whose texts are all NULL; the rows themselves are never sorted."""
    path = str(tmp_path / "t")
    made = spark.range(6000).selectExpr(
        "id AS k", "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN '\U0001d7d8' WHEN id % 3 = 0 THEN '￮' ELSE 'x' || id END AS t",
        "CAST(CAST(id AS STRING) AS BINARY) AS b")
    made.repartition(3, "k").write.parquet(path)
    spark.range(4).selectExpr("id AS k", "CAST(NULL AS STRING) AS t", "CAST(NULL AS BINARY) AS b").coalesce(1).write.mode("append").parquet(path)
    got = layout.column_stats(spark, path, ["t", "k", "b"])
    assert got.columns == ["file_path", *[f"{c}_{m}" for c in "tkb" for m in ("min", "max", "nulls", "values")]]
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert all("MapInArrow" in part for part in plan.split("SortAggregate")[2::2])  # what a partial one is given
    wanted = spark.read.parquet(path).selectExpr("_metadata.file_path AS file_path", "*").toPandas()
    for row in got.collect():
        mine = wanted[wanted["file_path"] == row["file_path"]]
        for c in "tkb":
            values = [v.encode() if c == "t" else bytes(v) if c == "b" else v for v in mine[c] if v is not None]
            ends = [v.encode() if c == "t" and v is not None else bytes(v) if c == "b" and v is not None else v for v in (row[f"{c}_min"], row[f"{c}_max"])]
            assert ends == [min(values, default=None), max(values, default=None)]
            assert (row[f"{c}_nulls"], row[f"{c}_values"]) == (len(mine) - len(values), len(values))
