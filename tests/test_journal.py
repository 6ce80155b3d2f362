"""Loads that take place once, wherever their first attempt died."""

import datetime as dt
import glob

import pytest

from tidemark import jobs
from tidemark.sinks import journal
from tidemark.sources.lake import read_table


@pytest.fixture
def load(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "_loads")

    def run(rows, day="2024-01-01", name="a"):
        df = spark.createDataFrame(rows, "k long, p string")
        return journal.load_run(df, path, ["p"], log, "t", day, name)

    run.path, run.log = path, log
    return run


ROWS = [(1, "x"), (2, "y z"), (3, None)]


def stored(spark, load, rows):
    return rows(read_table(spark, load.path).select("k", "p"))


def test_a_run_loads_once(spark, load, rows):
    assert load(ROWS) == 3 and load(ROWS) == 3
    assert stored(spark, load, rows) == ROWS
    assert load(ROWS, name="b") == 3 and load([(9, "x")], day="2024-01-02") == 1
    assert len(stored(spark, load, rows)) == 7
    assert rows(journal.entries(spark, load.log)) == [("t", "2024-01-01", "a", 3), ("t", "2024-01-01", "b", 3), ("t", "2024-01-02", "a", 1)]
    assert load([], day="2024-01-03") == 0 and journal.entries(spark, load.log).count() == 4
    assert not glob.glob(f"{load.path}.load-*")


@pytest.mark.parametrize("step", ["before the files move", "between two files", "before the entry"])
def test_a_run_that_dies_leaves_one_copy_once_repeated(spark, load, rows, monkeypatch, step):
    load([(0, "x")], name="before")
    move = journal.move_files

    def dies(spark, source, path):
        if step == "between two files":
            file = journal.list_files(spark, source).first()["file_path"]
            fs, _ = journal._filesystem(spark, path)
            name = journal._path(spark, file)
            to = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name.getParent().getName()}")
            fs.mkdirs(to)
            fs.rename(name, to)
        elif step == "before the entry":
            move(spark, source, path)
        raise OSError("lost")

    monkeypatch.setattr(journal, "move_files", dies)
    with pytest.raises(OSError):
        load(ROWS)
    monkeypatch.setattr(journal, "move_files", move)
    if step == "before the files move":
        assert stored(spark, load, rows) == [(0, "x")]
    assert load(ROWS) == 3 and load(ROWS) == 3
    assert stored(spark, load, rows) == sorted([(0, "x"), *ROWS], key=str)


def test_landing_under_one_run_id(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "u", None, None, None, "10.0.0.1", "agent", "password")],
                                 "session_id string, user_id string, created_at timestamp, expires_at timestamp, revoked_at timestamp, ip_address string, user_agent string, auth_method string")
    count = lambda: jobs.Run(spark, str(tmp_path), day, day).read("auth", "bronze", "sessions_raw").count()
    day = dt.date(2024, 1, 1)
    for run_id, total in (("r1", 1), ("r1", 1), ("r2", 2), (jobs.NO_RUN_ID, 3), (jobs.NO_RUN_ID, 4)):
        run = jobs.Run(spark, str(tmp_path), day, dt.datetime(2024, 1, 2), run_id)
        assert jobs.land_rows(run, "sessions_raw", "auth", rows) == 1
        assert count() == total
