"""Kept and rejected rows together are the raw rows."""

import os

import pytest
from conftest import day, rows

from daytally.schemas import _struct
from daytally.sources import parse_csv, parse_json, read_csv, read_json

SCHEMA = _struct("place string, date date, cases bigint")


def test_csv_values_and_lines(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('Date,extra,CASES,place\n2024-01-01,,5,"a, b"\n2024-13-01,e,many,c\n2024-01-02,,1.5,d\n,,,\n2024-01-03,,7.0\n'
                    "2024-01-04,,8,f,9,9\n2024-01-05,x,9,g\n")
    got = parse_csv(spark, str(path), SCHEMA)
    assert rows(got.kept) == [(None, None, None), ("a, b", day(1), 5), ("g", day(5), 9)]
    assert got.kept.schema == read_csv(spark, str(path), SCHEMA).schema
    found = rows(got.rejects, "column", "value", "reason", "text")
    assert [f[:3] for f in found] == [
        (None, None, "no such line"), (None, None, "no such line"), ("cases", "1.5", "no whole number"),
        ("cases", "many", "no whole number"), ("date", "2024-13-01", "no date")]
    assert found[0][3] == "2024-01-03,,7.0" and found[1][3] == "2024-01-04,,8,f,9,9"
    assert found[3][3] == '{"Date":"2024-13-01","extra":"e","CASES":"many","place":"c"}' == found[4][3]
    assert {os.path.basename(r["file"]) for r in got.rejects.collect()} == {"x.csv"}
    texts = {r["text"] for r in got.rejects.collect()}
    assert got.kept.count() + len(texts) == read_csv(spark, str(path), SCHEMA).count()


def test_json_values_and_lines(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"Place": "a", "date": "2024-01-01", "cases": 5}\n\n{"place": "b", "DATE": "soon", "cases": 12.0}\nnonsense\n'
                    '[{"place": "c", "cases": null}, {"place": "d", "cases": 1.5, "more": {"x": [1]}}]\n"text"\n')
    got = parse_json(spark, str(path), SCHEMA)
    assert rows(got.kept) == [("a", day(1), 5), ("c", None, None)]
    assert [r[:3] for r in rows(got.rejects, "column", "value", "reason")] == [
        (None, None, "no such line"), (None, None, "no such line"), ("cases", "1.5", "no whole number"), ("date", "soon", "no date")]
    same = read_json(spark, str(path), SCHEMA)
    assert rows(same) == [(None, None, None)] * 2 + [("a", day(1), 5), ("b", None, 12), ("c", None, None), ("d", None, None)]


def test_missing_fields(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"place": "a"}\n' * 1500 + '{"date": "2024-01-01"}\n')
    with pytest.raises(ValueError, match=r"lacks the columns \['cases'\]"):
        read_json(spark, str(path), SCHEMA)
    path.write_text('{"place": "a"}\n' * 1500 + '{"date": "2024-01-01", "cases": 1}\n')
    assert read_json(spark, str(path), SCHEMA).where("cases = 1").count() == 1
    path.write_text("")
    assert read_json(spark, str(path), SCHEMA).count() == 0 and parse_json(spark, str(path), SCHEMA).rejects.count() == 0
