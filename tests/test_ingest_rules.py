"""CSV intake rules: short and long rows, one level, repeated names, splittable reads, row order."""

from __future__ import annotations

import pytest

from ledgerline.sources import ingest


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.mark.parametrize("multi_line", [True, False])
def test_short_rows_are_padded(spark, tmp_path, multi_line):
    put(tmp_path, "t.csv", 'a,b,c\n1,2,3\n4\n5,6\n"x,y",,\n')
    df = ingest.load_csv_directory(spark, str(tmp_path), multi_line)["t"]
    assert [(r.a, r.b, r.c) for r in df.orderBy("_ordinal").collect()] == [
        ("1", "2", "3"), ("4", None, None), ("5", "6", None), ("x,y", None, None)]
    assert df.select("b").where("b IS NULL").count() == 2


@pytest.mark.parametrize("row", ["1,2,3,4", "1,2,3,", "1,2,3,,5"])
def test_long_rows_fail(spark, tmp_path, row):
    put(tmp_path, "t.csv", f"a,b,c\n1,2,3\n{row}\n")
    df = ingest.load_csv_directory(spark, str(tmp_path))["t"]
    with pytest.raises(Exception, match="row with more than 3 cells"):
        df.select("a").collect()


def test_one_level_and_repeated_names(spark, tmp_path):
    put(tmp_path, "in/x.csv", "a\n1\n")
    put(tmp_path, "in/sub/y.csv", "a\n1\n")
    put(tmp_path, "in/z.csv/part-1.csv", "a\n1\n")
    put(tmp_path, "in/z.csv/part-2.csv", "a\n2\n")
    tables = ingest.load_csv_directory(spark, str(tmp_path / "in"))
    assert list(tables) == ["x", "z"] and tables["z"].count() == 2
    with pytest.raises(FileNotFoundError):
        ingest.list_csv_tables(spark, str(tmp_path / "nowhere"))


def test_last_row_follows_file_name_order(spark, tmp_path):
    """The larger second part must not come first because of its size."""
    put(tmp_path, "t.csv/part-0.csv", "k,v\nq,first\n")
    put(tmp_path, "t.csv/part-1.csv", "k,v\n" + "".join(f"r{i},x\n" for i in range(5000)) + "q,last\n")
    rows = ingest.load_csv_directory(spark, str(tmp_path))["t"].where("k = 'q'").orderBy("_ordinal").collect()
    assert [r.v for r in rows] == ["first", "last"]


def test_hot_and_null_keys_spread_over_bronze_files(spark, tmp_path):
    from pyspark.sql import functions as F
    n = 20_000
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), "id")).alias("order_id"),
        F.col("id").cast("string").alias("order_item_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = ingest.write_bronze({"raw_order_items": items}, str(tmp_path))["raw_order_items"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_file = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 4 and max(per_file) < 0.45 * n
