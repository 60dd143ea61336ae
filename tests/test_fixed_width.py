import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import quality
from millrace.plans.bureau_request import consumer_lines, publish_request
from millrace.functions.address import ADDRESS_FIELDS
from millrace.sinks.requests import frame_lines, write_lines
from millrace.sources import fixedwidth
from millrace.sources.layout import (
    PERSONAL_END_OFFSETS,
    REQUEST_LAYOUT,
    RESPONSE_DATE_COLUMNS,
    RESPONSE_HEAD,
    Layout,
)

STAMP = dt.datetime(2020, 11, 3, 19, 16, 9)
HEADER = "BHDR-EQUIFAX20201103191609ADVITFINSCOREDA2"


def test_layout():
    assert REQUEST_LAYOUT.length == 220
    assert RESPONSE_HEAD.ending_at(PERSONAL_END_OFFSETS) == [
        "last_name", "first_name", "middle_name", "sin", "dob_text", "address", "city", "province", "postal_code",
    ]
    schema = RESPONSE_HEAD.schema(RESPONSE_DATE_COLUMNS)
    # The listed name is upper case, so the masked lower-case column stays text.
    assert isinstance(schema["dob_text"].dataType, T.VarcharType)
    layout = Layout.of([("a", 2), ("d", 6)])
    assert layout.ddl(["d"]) == "`a` varchar(2), `d` date"
    assert isinstance(layout.schema(["d"])["d"].dataType, T.DateType)


def test_layout_from_json(tmp_path):
    path = tmp_path / "layout.json"
    path.write_text('{"a": 2, "b": 3}')
    assert Layout.from_json(path).fields == (("a", 2), ("b", 3))


def _lines(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "pos int, value string")


def test_parse_short_blank_and_long_lines(spark):
    layout = Layout.of([("a", 2), ("b", 3), ("c", 2)])
    df = _lines(spark, ["12 x cc and rest", "1", "", "BHDR-EQUIFAX", "12, ,"])
    got = fixedwidth.parse(fixedwidth.drop_markers(df), layout, mask=["b"], escape=True)
    assert sorted(map(tuple, got.collect())) == [("", "", ""), ("1", "", ""), ("12", "", ""), ("12", "", "cc and rest")]


def test_wide_parse_equals_narrow_parse(spark, rows):
    layout = Layout.of([(f"f{i}", 1 + i % 5) for i in range(30)])
    df = _lines(spark, ["".join(chr(97 + (i * j) % 26) for j in range(n)) + " é," for i, n in enumerate(range(0, 100, 7))])
    df = df.union(df.limit(1).selectExpr(*[f"cast(null as {t}) as {c}" if c == "value" else c for c, t in df.dtypes]))
    for columns in (None, ["f7", "f3", "f29"]):
        narrow = rows(fixedwidth.parse(df, layout, mask=["f3"], columns=columns, escape=True))
        assert rows(fixedwidth.parse(df, layout, mask=["f3"], columns=columns, escape=True, in_batches=True)) == narrow


def test_wide_layout_of_a_thousand_fields(spark):
    layout = Layout.of([(f"f{i}", 1 + i % 9) for i in range(1425)])
    line = "".join(str(i % 10) * w for i, (_, w) in enumerate(layout.fields))
    row = fixedwidth.parse(_lines(spark, [line]), layout, in_batches=True).first()
    assert all(row[n] == str(i % 10) * w for i, (n, w) in enumerate(layout.fields))
    assert fixedwidth.parse(_lines(spark, [line]), layout, columns=["f1424"], in_batches=True).columns == ["f1424"]


def test_render_rejects_unknown_fields():
    with pytest.raises(ValueError):
        fixedwidth.render(REQUEST_LAYOUT, {"nope": F.lit("")})


@pytest.mark.parametrize(
    ("rule", "valid", "invalid"),
    [
        (quality.bad_birth_date, ["122256"], ["000056", "123256", "132256", "12225x"]),
        (quality.bad_sin, ["999999999", " " * 9], ["123456asd"]),
        (quality.bad_postal_code, ["h3h1h1", " " * 6], ["h3h11h", " "]),
        (quality.is_blank, ["mtl"], ["", "   "]),
        (quality.bad_province, ["qc", "Qé"], [" ", "q3"]),
    ],
)
def test_field_rules(one, rule, valid, invalid):
    assert [one(rule, v) for v in valid] == [False] * len(valid)
    assert [one(rule, v) for v in invalid] == [True] * len(invalid)


def test_header(one):
    assert one(quality.header_error, HEADER + "\n") is None
    assert one(quality.header_error, HEADER) == "length error: 42"
    wrong = HEADER.replace("BHDR", "BTRL") + "\n"
    assert one(quality.header_error, wrong) == f"prefix error: {wrong}"
    wrong = HEADER[:-1] + "3\n"
    assert one(quality.header_error, wrong) == f"suffix error: {wrong}"


def test_trailer(one):
    good = HEADER.replace("BHDR", "BTRL") + "00000010"
    check = lambda c: quality.trailer_error(c, F.lit(10).cast("long"))
    assert one(check, good) is None
    assert one(check, good + "0") == "length error: 51"
    assert one(check, good.replace("BTRL", "BHDR")).startswith("prefix error")
    assert one(check, good.replace("DA2", "DA3")).startswith("suffix error")
    assert one(check, good[:-2] + "11") == "count error: 11"
    assert one(check, good[:-1] + "x") == "count error: 0000001x"


def _applicants(spark, n):
    base = dict.fromkeys(ADDRESS_FIELDS, None) | {
        "premise_number": "1", "thoroughfare": "rue A", "city": "Montréal", "state_province": "QC", "postal_code": "H3H1H1",
    }
    people = {
        "last_name": "Côté", "first_name": "Zoë", "middle_name": None, "suffix": None, "sin": None,
        "date_of_birth": "1956-12-22", "file_number": "42",
    }
    names = ["id", "applicant_guid", *people, *base]
    data = [(i, f"app_{i}", *people.values(), *base.values()) for i in range(1, n + 1)]
    schema = "id long, applicant_guid string, " + ", ".join(f"{c} string" for c in names[2:])
    return spark.createDataFrame(data, schema).repartition(3)


def test_request_file_round_trip(spark, tmp_path):
    n = 50
    path = str(tmp_path / "request")
    write_lines(frame_lines(consumer_lines(_applicants(spark, n)), STAMP), path)
    parts = sorted((tmp_path / "request").glob("part-*"))
    assert len(parts) > 1
    lines = b"".join(p.read_bytes() for p in parts).decode("windows-1252").split("\n")
    assert lines[0] == HEADER and lines[-2] == HEADER.replace("BHDR", "BTRL") + f"{n:08d}" and lines[-1] == ""
    assert all(len(line) == 220 for line in lines[1:-2])
    assert [int(line[:12]) for line in lines[1:-2]] == list(range(1, n + 1))
    assert lines[1].startswith("000000000001Cote".ljust(37) + "Zoe")
    read = fixedwidth.read_lines(spark, path, "windows-1252")
    assert quality.is_valid(quality.validate_lines(read))
    back = fixedwidth.parse(fixedwidth.drop_markers(read), REQUEST_LAYOUT)
    assert back.where("sin = '000000000' and city = 'Montreal' and file_number = '42'").count() == n


def test_only_a_valid_file_is_handed_on(spark, tmp_path):
    rows = _applicants(spark, 20)
    draft, validated = tmp_path / "draft", tmp_path / "validated"
    assert publish_request(rows, STAMP, str(draft), str(validated)).isEmpty()
    whole = lambda folder: b"".join(p.read_bytes() for p in sorted(folder.glob("part-*")))
    assert whole(validated) == whole(draft)
    bad = rows.withColumn("city", F.lit(" "))
    errors = publish_request(bad, STAMP, str(tmp_path / "draft2"), str(tmp_path / "validated2"))
    assert errors.groupBy("category").count().collect() == [("city", 20)]
    assert not (tmp_path / "validated2").exists()


def test_faults_of_a_file(spark, rows):
    good = "0" * 12 + "x" * 67 + " " * 9 + "122256" + "1 rue A".ljust(30) + "mtl".ljust(20) + "QC" + "h3h1h1" + " " * 18
    good += "app_1".ljust(50)
    bad = good[:88] + "133256" + " " * 30 + good[124:]
    short = good[:100]
    trailer = HEADER.replace("BHDR", "BTRL") + "00000003"
    df = _lines(spark, [HEADER, good, bad, short, trailer])
    # A short line is only too short; the part of it that is there is checked.
    assert rows(quality.validate_lines(df)) == sorted(
        [("dob", "app_1", "133256"), ("address", "app_1", " " * 30), ("length", None, "101")], key=repr
    )
    df = _lines(spark, [HEADER + "x", good, trailer])
    assert rows(quality.validate_lines(df)) == sorted(
        [("header", None, "length error: 44"), ("footer", None, "count error: 3")], key=repr
    )


def test_field_cut_by_the_line_end_is_reported(spark, rows):
    # The line ends inside the nine digits, so the field holds the newline.
    line = "0" * 12 + "x" * 67 + "1234"
    df = _lines(spark, [HEADER, line, HEADER.replace("BHDR", "BTRL") + "00000001"])
    assert ("sin", "", "1234\n") in rows(quality.validate_lines(df))


def test_empty_request(spark, tmp_path):
    path = str(tmp_path / "empty")
    write_lines(frame_lines(consumer_lines(_applicants(spark, 1).where("id < 0")), STAMP), path)
    read = fixedwidth.read_lines(spark, path, "windows-1252")
    assert read.count() == 2
    assert quality.is_valid(quality.validate_lines(read))
