"""Records over borders of splits, against readers that see a whole file."""

import csv
import io
import json
import random

import pytest

from millrace.sources.streams import read_csv_splits, read_json_objects


@pytest.fixture
def tiny_splits(spark):
    """Splits of some bytes, so that records of a small file cross many borders."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


def cells(pick):
    alphabet = ['"', ",", "\n", "\r\n", "a", "é", " ", "{", "}", "x" * 30, ""]
    return "".join(pick.choice(alphabet) for _ in range(pick.randrange(8)))


@pytest.mark.parametrize("size,line_end", [(100, "\n"), (250, "\r\n"), (1 << 20, "\n")])
def test_csv(spark, tmp_path, tiny_splits, size, line_end):
    pick = random.Random(size)
    expected = []
    for name in ("a", "b", "c"):
        rows = [(n, cells(pick), cells(pick) + "|") for n in range(20)]
        expected += rows
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=line_end)
        writer.writerow(["n", "s\n1", "t"])
        writer.writerows(rows)
        text = out.getvalue()
        # The last file has no line break at its end, and blank lines in between.
        (tmp_path / f"{name}.csv").write_bytes((text.rstrip("\r\n") if name == "c" else text + line_end).encode())
    tiny_splits(size)
    got = read_csv_splits(spark, str(tmp_path), "n long, s string, t string")
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_csv_without_end(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text('n,s\n1,"open\n2,x\n')
    tiny_splits(5)
    with pytest.raises(Exception, match="unfinished record"):
        read_csv_splits(spark, str(tmp_path), "n long, s string").collect()


def test_csv_cell_of_another_type(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,s\nx,1\n")
    with pytest.raises(Exception, match="MALFORMED|CAST|malformed"):
        read_csv_splits(spark, str(tmp_path), "n long, s string").collect()


def test_header_only_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,s\n")
    (tmp_path / "b.csv").write_text("")
    assert read_csv_splits(spark, str(tmp_path), "n long, s string").count() == 0
    assert read_csv_splits(spark, str(tmp_path), "n string, s string", header=False).collect() == [("n", "s")]


def value(pick, depth=0):
    texts = ["", "a", '"', "\\", "}{", '\\"', "é\n", "{[", "\\\\"]
    kinds = [lambda: pick.choice(texts), lambda: pick.randrange(100), lambda: None]
    if depth < 3:
        kinds.append(lambda: {pick.choice("pq}"): value(pick, depth + 1) for _ in range(pick.randrange(3))})
        kinds.append(lambda: [value(pick, depth + 1) for _ in range(pick.randrange(3))])
    return pick.choice(kinds)()


@pytest.mark.parametrize("size", [60, 250, 1 << 20])
def test_json(spark, tmp_path, tiny_splits, size):
    pick = random.Random(size)
    expected = []
    for name, gap, indent in (("a", "", None), ("b", "\n", None), ("c", " \n", 2), ("d", "", None)):
        objects = [{"a": n, "s": pick.choice(["}", "{", '\\"}', "x"]), "o": value(pick)} for n in range(12)]
        expected += [(o["a"], o["s"]) for o in objects]
        (tmp_path / f"{name}.json").write_text(gap.join(json.dumps(o, ensure_ascii=False, indent=indent) for o in objects) + gap)
    tiny_splits(size)
    got = read_json_objects(spark, str(tmp_path), "a long, s string")
    assert sorted(map(tuple, got.collect())) == sorted(expected)


@pytest.mark.parametrize("text", ['{"a":1}{"a":2', '{"a":1}{"a":"}', '{"a":1}}{"a":2}', '{"a":1}{"a":2}x', '{"a":{"b":1}'])
def test_broken_json(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="unfinished record|MALFORMED|malformed"):
        read_json_objects(spark, str(tmp_path), "a long").collect()
