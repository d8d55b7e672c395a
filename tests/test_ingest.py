"""CSV ingest."""

from __future__ import annotations

import os
import tempfile

import pytest

from ledgerline.sources import ingest


def test_csv_edge_cases(spark):
    d = tempfile.mkdtemp(prefix="ll-csv-")
    with open(os.path.join(d, "b_items.csv"), "w", encoding="utf-8") as f:
        f.write('﻿id,text,n\n1,"line one\nline two",NA\n2,"say ""hi""",null\n3,,None\n4,"",nan\n5, x ,7\n')
    with open(os.path.join(d, "a_other.csv"), "w", encoding="utf-8") as f:
        f.write("k\nv\n")
    tables = ingest.load_csv_directory(spark, d)
    assert list(tables) == ["a_other", "b_items"]
    rows = tables["b_items"].orderBy("_ordinal").collect()
    assert tables["b_items"].columns == ["id", "text", "n", "_ordinal"]
    assert rows[0].text == "line one\nline two" and rows[0].n is None
    assert rows[1].text == 'say "hi"' and rows[1].n is None
    assert rows[2].text is None and rows[3].text is None and rows[3].n is None
    assert rows[4].text == " x " and rows[4].n == "7"
    prof = {r.table_name: r for r in ingest.table_profile(tables).collect()}
    assert (prof["b_items"].row_count, prof["b_items"].column_count, prof["b_items"].columns) == (5, 3, "id, text, n")


def test_empty_directory_fails(spark):
    with pytest.raises(FileNotFoundError):
        ingest.list_csv_tables(spark, tempfile.mkdtemp(prefix="ll-empty-"))


def test_bronze_is_all_text_with_blank_as_null(spark):
    df = spark.createDataFrame([(1, "", 2.5), (2, "x", None)], "a int, b string, c double")
    root = tempfile.mkdtemp(prefix="ll-bronze-")
    paths = ingest.write_bronze({"t": df}, root)
    back = spark.read.parquet(paths["t"])
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["string"] * 3
    assert sorted(tuple(r) for r in back.collect()) == [("1", None, "2.5"), ("2", "x", None)]


def test_bronze_load_is_all_or_nothing(spark, monkeypatch):
    from ledgerline.session import scratch_path
    root = scratch_path(spark, "bronze-load")
    first = {"raw_a": spark.createDataFrame([("1",)], "x string"), "raw_b": spark.createDataFrame([("2",)], "y string")}
    t1 = ingest.land_bronze(spark, first, root)
    second = {"raw_a": spark.createDataFrame([("10",), ("11",)], "x string"),
              "raw_b": spark.createDataFrame([("20",)], "y string")}
    real = ingest.write_bronze

    def crash_after_tables(tables, root_, suffix=""):
        real(tables, root_, suffix)
        raise RuntimeError("lost before the load manifest")

    monkeypatch.setattr(ingest, "write_bronze", crash_after_tables)
    with pytest.raises(RuntimeError):
        ingest.land_bronze(spark, second, root)
    monkeypatch.setattr(ingest, "write_bronze", real)
    current = ingest.read_bronze(spark, root)
    assert current["raw_a"].count() == 1 and current["raw_b"].count() == 1
    t3 = ingest.land_bronze(spark, second, root)
    assert t3 > t1 and ingest.read_bronze(spark, root)["raw_a"].count() == 2
