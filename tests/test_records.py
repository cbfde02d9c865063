"""Quoted CSV and JSON arrays read from byte ranges: equal to whole-file readers, by many tasks."""

from __future__ import annotations

import csv
import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import types as T

from threadwright.sources import records as R

CSV_SCHEMA = T.StructType().add("id", "string").add("a", "string").add("c", "string")
JSON_SCHEMA = T.StructType().add("id", "long").add("s", "string").add("n", "double")
VALUES = ["", "plain", "a,b", "x\ny", 'say "hi"', '"', '""', "\n\n", "tail\n", " sp ", "é€", "cr\r\nlf", '\n,"\n"",']


@contextmanager
def small_ranges(spark, size: int):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, size)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def write_csv(path, rng: random.Random, rows: int, end: str, header=("id", 'a"\nb', "c"), long: int = 1500) -> None:
    def value():
        return rng.choice([*VALUES, "long " * long + '\n"q"']) if rng.random() < 0.9 else "plain"

    with open(path, "w", newline="") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(header)
        for i in range(rows):
            out.writerow([str(i), value(), value()])
            if i % 97 == 0:
                f.write(end)


def expected_csv(paths) -> list[tuple]:
    rows: list[tuple] = []
    for path in paths:
        with open(path, newline="") as f:
            rows += [tuple(v or None for v in r) for r in list(csv.reader(f))[1:] if r]
    return sorted(rows, key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size,long", [(700, 1), (4096, 1500), (1 << 26, 3)])
def test_csv_equals_python(spark, tmp_path, end, size, long):
    rng = random.Random(size)
    paths = [tmp_path / f"{i}.csv" for i in range(3)]
    for path, rows in zip(paths, (400, 0, 150), strict=True):
        write_csv(path, rng, rows, end, long=long)
    with small_ranges(spark, size):
        got = R.read_quoted_csv(spark, str(tmp_path), CSV_SCHEMA, nullValue="", emptyValue="")
        assert sorted(map(tuple, got.collect()), key=str) == expected_csv(paths)


def test_pieces_are_bounded(spark, tmp_path, monkeypatch):
    """Records longer than a piece, inside and outside of quotes, are put together again."""
    monkeypatch.setattr(R, "PIECE_BYTES", 50)
    lines = ["id,a,c", *(f"{i},no marks at all here,x" for i in range(200)), '7,"' + "many\n" * 300 + '",z', "8,u,v"]
    (tmp_path / "f.csv").write_text("\n".join(lines))
    found = list(R._gather(((str(tmp_path), 0, line, line.count('"') % 2 == 1) for line in "\n".join(lines).split("\n")), "\n"))
    assert max(len(p["text"] or "") for p in found) < 100 and len(found) > 100
    table = spark.createDataFrame([tuple(p.values()) for p in found], R._PIECES).repartition(3)
    got = sorted(r.record for r in R.records(table, "\n", header=True).collect())
    assert got == sorted([*lines[1:201], lines[201], lines[202]])


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    write_csv(tmp_path / "f.csv", random.Random(2), 3000, "\n")
    with small_ranges(spark, 1 << 16):
        found = R.pieces(spark, str(tmp_path), "\n", R.csv_marks)
        assert found.select("block").distinct().count() > 20
        assert R.resolved(found).filter("inside").select("block").distinct().count() > 20
        whole = spark.read.schema(CSV_SCHEMA).options(header=True, multiLine=True, quote='"', escape='"', nullValue="", emptyValue="").csv(str(tmp_path))
        got = R.read_quoted_csv(spark, str(tmp_path), CSV_SCHEMA, nullValue="", emptyValue="")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_quoted_record_over_several_ranges(spark, tmp_path):
    text = "\n".join(f"line {i}, with a comma" for i in range(2000))
    (tmp_path / "f.csv").write_text(f'id,a,c\n1,"{text}",x\n2,y,z\n3,"{text}","{text}"\n')
    with small_ranges(spark, 2000):
        got = R.read_quoted_csv(spark, str(tmp_path), CSV_SCHEMA).collect()
    assert sorted(map(tuple, got)) == [("1", text, "x"), ("2", "y", "z"), ("3", text, text)]


@pytest.mark.parametrize("body", ["", "id,a,c", "id,a,c\n", '\n\nid,"a\n\nx",c\n\n\n1,2,3', "id,a,c\r\n1,2,3\r\n\r\n"])
def test_small_files(spark, tmp_path, body):
    (tmp_path / "f.csv").write_bytes(body.encode())
    got = [tuple(r) for r in R.read_quoted_csv(spark, str(tmp_path), CSV_SCHEMA).collect()]
    assert got == ([("1", "2", "3")] if "1,2,3" in body else [])


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [500, 1 << 26])
def test_json_arrays(spark, tmp_path, indent, size):
    rng = random.Random(size)
    texts = ["}", "{", '"', "\\", '\\"', "a\nb", '},{"id":9', "é", None, "x" * 2000, "]", "[{"]
    objects = [{"id": i, "s": rng.choice(texts), "n": rng.random()} for i in range(500)]
    for k in range(2):
        with open(tmp_path / f"{k}.json", "w") as f:
            json.dump(objects[k::2], f, indent=indent, ensure_ascii=bool(indent))
    (tmp_path / "empty.json").write_text(" [ ]\n")
    with small_ranges(spark, size):
        got = R.read_flat_json(spark, str(tmp_path), JSON_SCHEMA).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(o["id"], o["s"], o["n"]) for o in objects], key=str)


def test_nested_objects_are_refused_and_read_whole(spark, tmp_path):
    from threadwright.sources.labels import read_json_records

    (tmp_path / "f.json").write_text(json.dumps([{"id": 1, "s": "{}", "n": None}, {"id": 2, "s": {"x": 1}, "n": 3.0}]))
    with pytest.raises(Exception, match="an object holds another one"):
        read_json_records(spark, str(tmp_path), JSON_SCHEMA).collect()
    got = read_json_records(spark, str(tmp_path), JSON_SCHEMA, whole_files=True).collect()
    assert [r.id for r in got] == [1, 2]
