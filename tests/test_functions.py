import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import dates, semi, text
from millrace.functions.address import ADDRESS_FIELDS, address_lines, clean_address, full_address
from millrace.functions.stats import t_quantile


@pytest.mark.parametrize(
    "value", ["  a b ", "\t\n a\x1c", "\xa0é　", "", "   ", "a", "​x​", "  z\x85", None]
)
def test_strip_is_like_python(one, value):
    assert one(text.strip, value) == (value.strip() if value is not None else None)


def test_strip_covers_every_space_of_python(one):
    spaces = "".join(chr(i) for i in range(0x3100) if chr(i).isspace())
    assert one(text.strip, spaces + "x" + spaces) == "x"


def test_to_string(one):
    assert one(text.to_string, None) == ""
    assert one(text.to_string, " x ") == "x"
    assert one(text.to_string, "0") == "0"
    assert one(lambda c: text.to_string(c, numeric=True), 0, "int") == ""
    assert one(lambda c: text.to_string(c, numeric=True), 7, "int") == "7"
    assert one(text.to_string, "é ".encode(), "binary") == "é"


def test_transliterate(one):
    assert one(text.transliterate_fr, "ŒuvreœÀàÇçÿñ") == "OeuvreoeAaCcÿñ"
    assert one(text.clean_name, None) == ""


def test_padding(one):
    assert one(lambda c: text.fixed(c, 4), "abcdef") == "abcd"
    assert one(lambda c: text.fixed(c, 4), "a") == "a   "
    assert one(lambda c: text.fixed(c, 4), None) == "    "
    assert one(lambda c: text.zero_fill(c, 4), 12, "int") == "0012"
    assert one(lambda c: text.zero_fill(c, 4), 123456, "int") == "123456"
    assert one(text.escape_commas, "a,b") == "a\\,b"


def test_record_id(one):
    assert one(text.record_id_18, "001A0000006Vm9r") == "001A0000006Vm9rIAC"
    assert one(text.record_id_18, "001A0000006Vm9rIAC") == "001A0000006Vm9rIAC"
    assert one(text.record_id_18, "ABCDEabcdeABCDE") == "ABCDEabcdeABCDE" + "5A5"
    assert one(text.record_id_18, "short") is None
    assert one(text.record_id_18, None) is None
    with pytest.raises(PySparkException):
        one(lambda c: text.record_id_18(c, strict=True), "short")


def test_ruby_hash(one):
    assert one(text.ruby_hash_to_json, '{"a"=>nil}') == '{"a": null}'
    assert one(text.ruby_hash_to_json, '{"a"=>"vanilla"}') == '{"a": "vanullla"}'
    safe = lambda c: text.ruby_hash_to_json(c, safe=True)
    assert one(safe, '{"a"=>"vanilla=>\\"nil", "b"=>nil}') == '{"a": "vanilla=>\\"nil", "b": null}'
    assert one(safe, None) is None


@pytest.mark.parametrize("charset", ["windows-1252", "ISO-8859-1"])
def test_single_byte_text_keeps_its_bytes(spark, tmp_path, charset):
    value = "Élan  " if charset == "ISO-8859-1" else "Élan €œŸ  "
    df = spark.range(0, 1, 1, 1).select(F.lit(value).alias("v"))
    df.select(text.encode_bytes(F.col("v"), charset).alias("value")).write.text(str(tmp_path / "t"))
    (part,) = (tmp_path / "t").glob("part-*")
    assert part.read_bytes() == value.encode(charset) + b"\n"
    back = spark.read.text(str(tmp_path / "t")).select(text.decode_bytes(F.col("value"), charset).alias("v"))
    assert back.first()["v"] == value


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("053020", dt.date(2020, 5, 30)),
        ("090121", dt.date(2021, 9, 1)),
        ("100121", dt.date(1921, 10, 1)),
        ("123199", dt.date(1999, 12, 31)),
        ("022900", dt.date(2000, 2, 29)),
        ("023020", None),
        ("05-30-20", None),
        ("      ", None),
        ("", None),
        ("05302020", None),
        ("5302", None),
        ("ab3020", None),
        (None, None),
    ],
)
def test_pivot_date(one, value, expected):
    assert one(lambda c: dates.pivot_date(c, "2021-09-15"), value) == expected


def test_months_and_days(one):
    assert dates.month_before(dt.date(2021, 9, 2)) == "202108"
    assert dates.month_before(dt.date(2021, 1, 1)) == "202012"
    assert one(dates.previous_month_label, dt.date(2021, 1, 31), "date") == "202012"
    assert one(lambda c: dates.days_since(c, "2021-01-10"), dt.date(2021, 1, 1), "date") == 9


def test_birth_date_tag(one):
    assert one(dates.birth_date_tag, "1956-12-22") == "122256"
    assert one(dates.birth_date_tag, "1956-2-3") == "020356"
    assert one(dates.birth_date_tag, "22/12/1956") == ""
    assert one(dates.birth_date_tag, None) == ""


def test_utc(one):
    moment = dt.datetime(2021, 1, 2, 3, 4, 5, 678900)
    assert one(dates.utc_text, moment, "timestamp_ntz") == "2021-01-02 03:04:05.678"
    assert one(lambda _: dates.load_time("2021-01-02 03:04:05.000"), "") == "2021-01-02 03:04:05.000"
    assert len(one(lambda _: dates.load_time(), "")) == 23
    assert one(lambda c: F.date_format(dates.local_to_utc(c), "yyyy-MM-dd HH"), moment, "timestamp_ntz") == "2021-01-02 08"


def test_address_lines(spark):
    empty = dict.fromkeys(ADDRESS_FIELDS)
    street = {"premise_number": "12", "thoroughfare": " rue Élan "}
    cases = [
        (empty, ""),
        (street, "12 rue Elan"),
        (street | {"sub_premise_number": "4"}, "4-12 rue Elan"),
        (street | {"sub_premise_number": "4", "sub_premise_type": "Apt"}, "12 rue Elan Apt 4"),
        ({"thoroughfare": "rue X"}, " rue X"),
        ({"post_box_number": "7"}, " 7"),
        ({"rural_additional_content": "Site 1"}, ""),
        (street | {"rural_routes": "RR 2", "post_box_type": "CP", "post_box_number": "9"}, "12 rue Elan CP 9 RR 2"),
        ({"rural_routes": "RR 2", "rural_additional_content": "Site 1"}, "Site 1 RR 2"),
    ]
    schema = ", ".join(f"{c} string" for c in ADDRESS_FIELDS)
    data = [tuple({**empty, **fields}[c] for c in ADDRESS_FIELDS) for fields, _ in cases]
    df = clean_address(spark.createDataFrame(data, schema).coalesce(1))
    got = [r["l"] for r in df.select(address_lines().alias("l")).collect()]
    assert got == [expected for _, expected in cases]
    one_row = spark.createDataFrame([tuple({**empty, **street, "city": "Québec"}[c] for c in ADDRESS_FIELDS)], schema)
    assert clean_address(one_row).select(full_address().alias("s")).first()["s"] == "12 rue Elan Quebec   "


def test_semi_structured(spark, one):
    df = semi.as_variant(spark.createDataFrame([(1, "x", "2024-01-02")], "id int, `MY COL #` string, d string"))
    row = semi.typed_paths(df, {"id": "long", "MY COL #": "string", "d": "date", "none": "int"}).first()
    assert tuple(row) == (1, "x", dt.date(2024, 1, 2), None)
    assert df.select(semi.path("fields", "MY COL #", "int").alias("r")).first()["r"] is None
    assert one(semi.base64_text, "eA==") == "x"
    assert one(lambda c: semi.base64_bytes(c, url_safe=True), "_-8=", "string") == b"\xff\xef"
    many = lambda c: F.size(semi.one_or_many(c, "struct<a: int>"))
    assert one(many, '{"a": 1}') == 1
    assert one(many, '[{"a": 1}, {"a": 2}]') == 2


def test_row_hash_sees_nulls_and_names(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "x", None)], "a int, b string, c string")
    assert df.select(semi.row_hash(["a", "b", "c"])).distinct().count() == 2


# Two-sided 95 % points from printed tables.
@pytest.mark.parametrize(
    ("dof", "expected"), [(1, 12.7062), (2, 4.3027), (3, 3.1824), (10, 2.2281), (30, 2.0423), (120, 1.9799), (10**6, 1.96)]
)
def test_t_quantile(dof, expected):
    assert t_quantile(dof) == pytest.approx(expected, abs=5e-5)


def test_t_quantile_edges():
    assert math.isnan(t_quantile(0))
    assert t_quantile(2000) == pytest.approx(t_quantile(2001), abs=1e-6)
    assert t_quantile(5, 0.8) == pytest.approx(1.4759, abs=5e-5)
