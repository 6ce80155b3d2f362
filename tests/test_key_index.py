"""The key index: which partitions an upsert of moving keys reads, and results as without it."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import key_index, tables
from tidemark.sources.lake import read_table

SCHEMA = "k long, v string, p string, q int"


@pytest.fixture
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def read(spark, path, like):
    return read_table(spark, path, schema=like.schema).select(*like.columns)


def damage(path, *parts):
    """Overwrites the values in the files of partitions; footers, names and sizes stay."""
    for part in parts:
        for file in glob.glob(f"{path}/{part}/*.parquet"):
            with open(file, "rb") as f:
                data = f.read()
            upto = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
            with open(file, "wb") as f:
                f.write(data[:4] + b"x" * (upto - 4) + data[upto:])
            crc = f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc"
            if os.path.exists(crc):
                os.remove(crc)


def test_only_named_partitions_are_read(spark, tmp_path, frame, rows):
    path = str(tmp_path / "t")
    start = frame(*[(k, "a", f"p{k % 10}", k) for k in range(200)])
    key_index.upsert_indexed(start, path, ["k"], ["p"])
    damage(path, *[f"p=p{n}" for n in range(10) if n not in (3, 4, 7)])
    key_index.upsert_indexed(frame((13, "moved", "p7", 0), (24, "stays", "p4", 1), (1000, "new", "p7", 2)), path, ["k"], ["p"])
    got = rows(read(spark, path, start).where(F.col("p").isin("p3", "p4", "p7")))
    want = [(k, "a", f"p{k % 10}", k) for k in range(200) if k % 10 in (3, 4, 7) and k not in (13, 24)]
    assert got == sorted([*want, (13, "moved", "p7", 0), (24, "stays", "p4", 1), (1000, "new", "p7", 2)], key=str)


def test_candidates_hold_every_partition_with_a_key(spark, tmp_path, frame, monkeypatch):
    path = str(tmp_path / "t")
    start = frame(*[(k, "a", None if k % 7 == 0 else f"p {k % 7}/%:", k) for k in range(3000)])
    key_index.upsert_indexed(start, path, ["k"], ["p"])
    for keys in ([0], [1, 2], [7, 14, 700], [3001], [5, None]):
        found = key_index.candidates(frame(*[(k, "", "", 0) for k in keys]), path, ["k"], ["p"], start.schema)
        held = {None if k % 7 == 0 else f"p {k % 7}/%:" for k in keys if k is not None and k < 3000}
        got = [r[0] for r in found.collect()]
        assert held <= set(got) and len(got) == len(set(got)) <= len(held) + 1


def test_same_results_as_without_an_index(spark, tmp_path, frame, rows):
    plain, indexed = str(tmp_path / "plain"), str(tmp_path / "indexed")
    start = frame(*[(k, "a", [None, "01", "1", "a b"][k % 4], k % 3) for k in range(60)], (None, "n", "1", 1))
    steps = [
        frame(*[(k, "b", "1", 0) for k in range(0, 60, 5)], (None, "m", "01", 2), (70, "new", None, 0)),
        frame(*[(k, "c", "only", 0) for k in range(60) if k % 4 == 1], (70, "d", "", 0)),
        frame((1, "back", "01", 1)),
    ]
    tables.append(start, plain, ["p", "q"])
    key_index.upsert_indexed(start, indexed, ["k"], ["p", "q"])
    for step in steps:
        tables.upsert_table(step, plain, ["k"], ["p", "q"], moves=True)
        key_index.upsert_indexed(step, indexed, ["k"], ["p", "q"])
        assert rows(read(spark, plain, start)) == rows(read(spark, indexed, start))
    held = key_index._read(spark, indexed, [start.schema["p"], start.schema["q"]])
    parts = read_table(spark, indexed, schema=start.schema).select("p", "q").distinct()
    assert rows(held.select("p", "q").distinct()) == rows(parts)


def test_other_writers_make_a_partition_unknown(spark, tmp_path, frame, rows):
    path = str(tmp_path / "t")
    start = frame(*[(k, "a", f"p{k % 5}", k) for k in range(50)])
    key_index.upsert_indexed(start, path, ["k"], ["p"])
    tables.append(frame((500, "other", "p2", 0), (501, "other", "p9", 0)), path, ["p"])
    key_index.upsert_indexed(frame((500, "mine", "p3", 0), (501, "mine", "p3", 0)), path, ["k"], ["p"])
    table = read(spark, path, start)
    assert rows(table.where("k >= 500")) == [(500, "mine", "p3", 0), (501, "mine", "p3", 0)] and table.count() == 52


def test_newest_wins_with_an_order(spark, tmp_path, frame, rows):
    path = str(tmp_path / "t")
    key_index.upsert_indexed(frame((1, "a", "x", 5), (2, "a", "y", 5)), path, ["k"], ["p"])
    key_index.upsert_indexed(frame((1, "late", "y", 4), (2, "new", "x", 6)), path, ["k"], ["p"], order=[F.desc("q")])
    assert rows(read(spark, path, frame())) == [(1, "a", "x", 5), (2, "new", "x", 6)]


# partitions far apart

@pytest.mark.parametrize("named", [2000, 1])
def test_partitions_between_touched_ones_are_not_read(spark, tmp_path, rows, monkeypatch, named):
    monkeypatch.setattr(tables, "PARTS_NAMED", named)
    path = str(tmp_path / "t")
    start = spark.range(100).selectExpr("id AS k", "id AS v", "id % 20 AS day")
    tables.append(start, path, ["day"])
    table = read_table(spark, path, schema=start.schema)
    parts = spark.createDataFrame([(0,), (19,), (None,)], "day long")
    if named > 1:
        damage(path, *[f"day={n}" for n in range(1, 19)])
    assert rows(tables._in_partitions(table, parts, ["day"])) == rows(start.where("day IN (0, 19)"))


def test_two_partition_columns_with_nulls(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    start = spark.range(60).selectExpr("id AS k", "IF(id % 3 = 0, NULL, id % 3) AS a", "IF(id % 4 = 0, NULL, id % 4) AS b")
    tables.append(start, path, ["a", "b"])
    table = read(spark, path, start)
    for values in ([(1, 2), (None, 3)], [(None, None)], [(2, None), (1, 1), (2, 2)], []):
        parts = spark.createDataFrame(values, "a long, b long")
        want = [r for r in rows(start) if (r[1], r[2]) in values]
        for named in (2000, 1):
            monkeypatch.setattr(tables, "PARTS_NAMED", named)
            assert rows(tables._in_partitions(table, parts, ["a", "b"]).select("k", "a", "b")) == want
