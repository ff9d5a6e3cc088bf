"""CSV files with other headers, and lines that do not fit."""

import gzip

import pytest

from assayer.plans import inputs
from assayer.plans.refinery import Refinery, Warehouse
from assayer.sources import csv_files
from assayer.sources.audit import Run

COLUMNS = ["id", "t", "x"]


@pytest.fixture
def arrive(spark, tmp_path):
    """arrive(name=content, ..): what is read of these files."""

    def read(files, **how):
        for name, content in files.items():
            data = content.encode()
            (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
        return csv_files.read_arrived(spark, str(tmp_path), COLUMNS, **how)

    return read


def good(arrived):
    return sorted(tuple(r) for r in arrived.rows.select(*COLUMNS).collect())


def bad(arrived):
    return sorted((r._source_file, r._record, r._reason) for r in arrived.quarantine.collect())


def test_columns_are_found_by_name(arrive):
    arrived = arrive(
        {
            "a.csv": "id,t,x\n1,one,5\n",
            "b.csv": "x, t ,id\n7,seven,2\n",
            "c.csv": '﻿"t",extra,id,extra,x\n"ten, \n""so""",e,3,f,11\n',
            "d.csv.gz": "t,x,id\nzip,1,4\n",
            "e.csv": "\n\n\"id\",\"t\",\"x\",\"long\nname\"\n5,e,6,7\n",
        }
    )
    assert good(arrived) == [("1", "one", "5"), ("2", "seven", "7"), ("3", 'ten, \n"so"', "11"), ("4", "zip", "1"), ("5", "e", "6")]
    assert bad(arrived) == []


def test_lines_that_do_not_fit_are_kept_and_counted(arrive):
    arrived = arrive({"a.csv": 'id,t,x\n1,one,5\n3,short\n4,long,7,8\n\n5,,\n6,"",9\n7,"a, ""b""\nc"\n8,last,1\n'})
    assert good(arrived) == [("1", "one", "5"), ("5", None, None), ("6", None, "9"), ("8", "last", "1")]
    assert bad(arrived) == [
        ("a.csv", '3,short', "too few fields: 2 of 3"),
        ("a.csv", "4,long,7,8", "too many fields: 4 of 3"),
        ("a.csv", '7,"a, ""b""\nc"', "too few fields: 2 of 3"),
    ]
    counts = {(r.source_file, r.reason): r.n for r in arrived.counts().collect()}
    assert counts == {("a.csv", None): 4, ("a.csv", "too few fields: 2 of 3"): 2, ("a.csv", "too many fields: 4 of 3"): 1}


def test_quotes_that_are_never_closed_lose_no_text(arrive):
    arrived = arrive({"a.csv": 'id,t,x\n1,a"b,2\n2,"open,3\n3,after,4\n4,"q",5\n', "b.csv": 'id,t,x\n5,k,1\n6,"never,2\n7,a,3\n', "c.csv": 'id,t,x\n8,"""said""",1\n'})
    assert good(arrived) == [("1", 'a"b', "2"), ("2", '"open,3\n3,after,4\n4,"q"', "5"), ("5", "k", "1"), ("8", '"said"', "1")]
    assert bad(arrived) == [("b.csv", '6,"never,2\n7,a,3', "open quote")]


def test_files_whose_header_does_not_fit(arrive):
    files = {"a.csv": "id,t\n1,2\n", "b.csv": "id,t,x,id\n1,2,3,4\n", "c.csv": "", "d.csv": "id,t,x\n", "e.csv": "9,no header,3\n"}
    arrived = arrive(files, optional=())
    assert good(arrived) == []
    assert bad(arrived) == [
        ("a.csv", "1,2", "no column x"), ("a.csv", "id,t", "no column x"), ("b.csv", "1,2,3,4", "more than one column id"),
        ("b.csv", "id,t,x,id", "more than one column id"), ("e.csv", "9,no header,3", "no column id, t, x"),
    ]
    assert good(arrive({}, optional=("x",))) == [("1", "2", None)]


def test_nothing_and_positions(spark, arrive, tmp_path):
    (tmp_path / "none").mkdir()
    assert csv_files.read_arrived(spark, str(tmp_path / "none"), COLUMNS).rows.count() == 0
    arrived = arrive({f"{i}.csv": "id,t,x\n" + "".join(f"{j},t,{i}\n" for j in range(20)) for i in range(3)}, position="_key", pattern="*.csv")
    assert arrived.rows.select("_key").distinct().count() == 60
    keys = [(r.x, r._key, int(r.id)) for r in arrived.rows.collect()]
    assert all([i for _, _, i in sorted(k for k in keys if k[0] == x)] == list(range(20)) for x in "012")


def test_too_many_headers(arrive, monkeypatch):
    monkeypatch.setattr(csv_files, "MOST_HEADERS", 1)
    with pytest.raises(ValueError, match="2 different headers"):
        arrive({"a.csv": "id,t,x\n", "b.csv": "t,id,x\n"})


def test_a_run_keeps_what_does_not_fit(spark, tmp_path):
    (tmp_path / "in").mkdir()
    names = ["text_content", "content_type", *inputs.SPEC.numeric, "label"]
    for name, header in (("a.csv", names), ("b.csv", names[::-1])):
        lines = [",".join(header), ",".join("5" if c != "label" else "1" for c in header), "broken"]
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
    refinery = Refinery(spark, Warehouse(str(tmp_path / "w")), Run("007", "2024-01-31 00:00:00"), inputs.SPEC)
    for _ in range(2):  # a rerun replaces
        landed = refinery.ingest_csv(str(tmp_path / "in"), names)
        assert {r.label for r in landed.collect()} == {"1"} and landed.count() == 2
        kept = spark.read.parquet(refinery.warehouse.path("csv_quarantine"))
        assert sorted((r._source_file, r._record) for r in kept.collect()) == [("a.csv", "broken"), ("b.csv", "broken")]
        assert spark.read.parquet(refinery.warehouse.path("csv_counts")).count() == 4
