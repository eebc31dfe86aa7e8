"""CSV files of Python's writer, with line breaks in quotes, cut into blocks of any size."""

from __future__ import annotations

import csv
import random

import pytest

from rowcast.sources import foreign

SCHEMA = "id bigint, text string, n double"


@pytest.fixture
def blocks(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


def written(folder, rows, names=("id", "text", "n"), name="a.csv", ends="\r\n", **options):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=ends, **options)
        writer.writerow(names)
        writer.writerows(rows)


def texts(draw, count):
    signs = ['"', "\n", "\r\n", ",", "é", "word ", " ", "x", '""', "\n\n", "\t"]
    return ["".join(draw.choice(signs) for _ in range(draw.randrange(30))) for _ in range(count)]


@pytest.mark.parametrize("size", [40, 1 << 20])
@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_rows_are_those_written(spark, blocks, tmp_path, size, ends):
    draw = random.Random(size)
    rows = [(i, text, draw.random()) for i, text in enumerate(texts(draw, 25))]
    written(tmp_path / "t", rows, ends=ends, quoting=csv.QUOTE_NONNUMERIC)
    blocks(size)
    got = foreign.read_foreign_csv(spark, str(tmp_path / "t"), SCHEMA)
    assert sorted(map(tuple, got.collect())) == rows


def test_null_and_empty_and_what_does_not_parse(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "a.csv").write_text('id,text,n\n1,"",2.5\n2,,\nx,"a ""b""",y\n\n4,"c\n\n",1\n5\n6,d', newline="")
    got = sorted(map(tuple, foreign.read_foreign_csv(spark, str(folder), SCHEMA).collect()), key=str)
    assert got == sorted([(1, "", 2.5), (2, None, None), (None, 'a "b"', None), (4, "c\n\n", 1.0), (5, None, None), (6, "d", None)], key=str)


def test_files_of_other_column_orders(spark, blocks, tmp_path):
    folder = tmp_path / "t"
    written(folder, [(1, "a\nb", 2.0)])
    written(folder, [("c\n,d", 5)], ("text", "id"), "b.csv")
    written(folder, [("z", 7, 1.5, "e")], ("more, or\nless", "id", "n", "text"), "c.csv")
    blocks(24)
    got = sorted(map(tuple, foreign.read_foreign_csv(spark, str(folder), SCHEMA).collect()))
    assert got == [(1, "a\nb", 2.0), (5, "c\n,d", None), (7, "e", 1.5)]


def test_without_header_and_other_separators(spark, tmp_path):
    folder = tmp_path / "t"
    written(folder, [(2, "it\'s;\n'", 1.0)], (1, "x", 2.0), ends="\n", delimiter=";", quotechar="'")
    got = foreign.read_foreign_csv(spark, str(folder), SCHEMA, header=False, separator=";", quote="'")
    assert sorted(map(tuple, got.collect())) == [(1, "x", 2.0), (2, "it's;\n'", 1.0)]


def test_a_text_of_many_blocks(spark, blocks, tmp_path):
    long = "line one, of many\n" * 1200
    rows = [(1, "a", 1.0), (2, long, 2.0), (3, "b\n", 3.0)]
    written(tmp_path / "t", rows)
    blocks(4096)
    frame = foreign.read_foreign_csv(spark, str(tmp_path / "t"), SCHEMA)
    assert sorted(map(tuple, frame.collect())) == rows
    parity = foreign.block_parity(foreign._lines(spark, str(tmp_path / "t")))
    assert parity.filter("opened").count() >= 4 and parity.filter("leading").count() == 1


def test_empty_files(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "a.csv").write_text("id,text,n\n")
    (folder / "b.csv").write_text("")
    got = foreign.read_foreign_csv(spark, str(folder), SCHEMA)
    assert got.collect() == [] and got.columns == ["id", "text", "n"]
