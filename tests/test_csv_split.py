"""CSV intake: directories under any name, and one file with quoted line breaks read by many tasks."""

from __future__ import annotations

import random

import pytest

from ledgerline.operators.keys import ORDINAL
from ledgerline.sources import ingest


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def quoted(cell, always):
    return '"' + cell.replace('"', '""') + '"' if always or any(c in cell for c in ',"\r\n') else cell


def table(seed, rows, end="\n"):
    r = random.Random(seed)
    pieces = ["x", "long words ", "é漢", ",", '"', '""', "\n", "\r\n", "\n\n", " ", "NA", "1.5", ""]
    cells = [["".join(r.choices(pieces, k=r.randint(0, 6))) for _ in range(3)] for _ in range(rows)]
    body = end.join(",".join(quoted(c, r.random() < 0.3) for c in row) for row in [["a", "b", "c d"], *cells])
    return body + (end if seed % 2 else "")


def rows_of(df):
    names = [c for c in df.columns if c != ORDINAL]
    return [tuple(r[c] for c in names) for r in df.orderBy(ORDINAL).collect()]


@pytest.mark.parametrize("seed, size, end", [(1, 200, "\n"), (2, 64, "\r\n"), (3, 1000, "\n"), (4, 17, "\n")])
def test_one_file_by_many_tasks_equals_one_task(spark, tmp_path, small_splits, seed, size, end):
    path = tmp_path / "t.csv"
    path.write_bytes((b"\xef\xbb\xbf" if seed == 3 else b"") + table(seed, 120, end).encode())
    one = rows_of(ingest.read_csv_table(spark, str(path)))
    small_splits(size)
    many = ingest.read_csv_table(spark, str(path))
    assert ingest.split_records(spark, str(path)).select("block").distinct().count() > 3
    assert rows_of(many) == one and len(one) > 100


def test_a_folder_of_parts_and_rows_that_do_not_fit(spark, tmp_path, small_splits):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    for i in range(3):
        (folder / f"part-{i}.csv").write_text(table(i, 20))
    one = rows_of(ingest.read_csv_table(spark, str(folder)))
    small_splits(50)
    assert sorted(map(str, rows_of(ingest.read_csv_table(spark, str(folder))))) == sorted(map(str, one))
    (tmp_path / "short.csv").write_text('a,b\n1\n"2\n2",3\n' + "4,5\n" * 30)
    assert rows_of(ingest.read_csv_table(spark, str(tmp_path / "short.csv")))[:2] == [("1", None), ("2\n2", "3")]
    (tmp_path / "long.csv").write_text("a,b\n" + "4,5\n" * 30 + '1,2,"3\n"\n')
    with pytest.raises(Exception, match="more than 2 cells"):
        ingest.read_csv_table(spark, str(tmp_path / "long.csv")).collect()


def test_stray_quotes_go_the_one_task_way(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + 'x 5" screw,1\ny,2\n' * 20)
    one = rows_of(ingest.read_csv_table(spark, str(path)))
    small_splits(40)
    assert rows_of(ingest.read_csv_table(spark, str(path))) == one and len(one) == 40


def test_directories_by_any_name(spark, tmp_path, monkeypatch):
    inner = tmp_path / "in" / "sub" / "in"
    inner.mkdir(parents=True)
    (tmp_path / "in" / "x.csv").write_text("a\n1\n")
    (inner / "y.csv").write_text("a\n1\n")
    (tmp_path / "in" / "z.csv").mkdir()
    (tmp_path / "in" / "z.csv" / "part-0.csv").write_text("a\n1\n")
    for name in (str(tmp_path / "in"), f"{tmp_path}/in/", f"{tmp_path}/in/.", f"{tmp_path}/other/../in", f"file:{tmp_path}/in"):
        (tmp_path / "other").mkdir(exist_ok=True)
        assert list(ingest.list_csv_tables(spark, name)) == ["x", "z"], name
    (tmp_path / "odd[1]").mkdir()
    (tmp_path / "odd[1]" / "w.csv").write_text("a\n1\n")
    assert list(ingest.list_csv_tables(spark, f"{tmp_path}/odd[1]/.")) == ["w"]
    with pytest.raises(FileNotFoundError, match="no such directory"):
        ingest.list_csv_tables(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError, match="no CSV table"):
        ingest.list_csv_tables(spark, str(tmp_path / "other"))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_files_without_line_breaks_in_cells_are_split_without_moving_a_row(spark, tmp_path, small_splits, monkeypatch, end):
    rows = [["a", "b", "c d"], *([f"x{i}", 'q "and", a comma' if i % 3 else "", "NA" if i % 5 else f" {i}"] for i in range(100))]
    path = tmp_path / "t.csv"
    path.write_bytes(end.join(",".join(quoted(c, i % 2) for c in row) for i, row in enumerate(rows)).encode())
    one = rows_of(ingest.read_csv_table(spark, str(path)))
    small_splits(100)
    monkeypatch.setattr(ingest, "split_records", lambda *a: pytest.fail("lines were moved"))
    many = ingest.read_csv_table(spark, str(path))
    assert many.rdd.getNumPartitions() > 3 and "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
    assert rows_of(many) == one and len(one) == 100


@pytest.mark.parametrize("body, plain", [("a,b\n1,2\n", True), ('a,b\n"1","2"\r\n', True), ('a,b\n"1\n",2\n', False), ("a,b\n1\r2,3\n", False),
                                         ('a,b\n"1\r2",3\n', False), ('a,b\n1"2"3,4\n', False), ("", True)])
def test_lines_are_records_only_where_no_cell_breaks_a_line(spark, tmp_path, body, plain):
    path = tmp_path / "t.csv"
    path.write_bytes(body.encode())
    assert ingest._lines_are_records(spark, str(path)) is plain
