"""Sources, payload normalizers and stream drains on small landed fixtures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from finspark.sources.documents import find
from finspark.sources.files import read_csv, read_json, read_landed, read_sheet_range, read_xml
from finspark.sources.payloads import (explode_daily_series, explode_object_or_array, first_list_rows,
                                       parse_quote, stack_by_name)
from finspark.streaming.drain import decode, drain, message_files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_na_tokens_and_types(spark, tmp_dir):
    p = _write(f"{tmp_dir}/a.csv", "sym;px;n\nA;1.5;3\nNA;N/A;\nnull;2;x\n")
    rows = read_csv(spark, p, schema="sym STRING, px DOUBLE, n INT", sep=";").collect()
    assert [tuple(r) for r in rows] == [("A", 1.5, 3), (None, None, None), (None, 2.0, None)]


def test_json_array_file_and_lines(spark, tmp_dir):
    p = _write(f"{tmp_dir}/arr.json", json.dumps([{"a": 1, "b": "x"}, {"a": 2, "b": None}], indent=2))
    assert sorted(r.a for r in read_json(spark, p).collect()) == [1, 2]
    q = _write(f"{tmp_dir}/l.jsonl", '{"a": 1}\n{"a": 2}\n')
    assert sorted(r.a for r in read_json(spark, q, lines=True).collect()) == [1, 2]
    with pytest.raises(ValueError):
        read_landed(spark, q, "excel")


def test_xml_attribute_wins(spark, tmp_dir):
    p = _write(f"{tmp_dir}/x.xml", '<rows><row id="7" status="A"><status>B</status><px>1.5</px></row>'
                                    '<row id="8"><status>C</status><px>2</px></row></rows>')
    rows = sorted(tuple(r) for r in read_xml(spark, p, xpath="//rows/row").select("id", "status", "px").collect())
    assert rows == [(7, "A", 1.5), (8, "C", 2.0)]


def test_sheet_range_json_and_empty(spark, tmp_dir):
    p = _write(f"{tmp_dir}/s.json", json.dumps([["sym", "px"], ["A", "1.5"], ["B", "2"]]))
    rows = read_sheet_range(spark, p, schema="sym STRING, px DOUBLE", fmt="json").collect()
    assert [tuple(r) for r in rows] == [("A", 1.5), ("B", 2.0)]
    e = _write(f"{tmp_dir}/e.json", "[]")
    empty = read_sheet_range(spark, e, schema="sym STRING, px DOUBLE", fmt="json")
    assert empty.count() == 0 and empty.columns == ["sym", "px"]


def test_payload_normalizers(spark):
    series = {"Time Series (Daily)": {"2024-01-02": {"1. open": "1", "2. high": "2", "3. low": "0.5",
                                                     "4. close": "1.5", "5. volume": "100"}}}
    land = spark.createDataFrame([("AAA", json.dumps(series)), ("BBB", '{"Note": "limit"}')],
                                 "request_symbol STRING, payload STRING")
    rows = explode_daily_series(land).collect()
    assert len(rows) == 1 and rows[0].close == 1.5 and rows[0].volume == 100
    obj = spark.createDataFrame([("A", '{"p": 1}'), ("B", '[{"p": 2}, {"p": 3}]')],
                                "request_symbol STRING, payload STRING")
    assert sorted((r.symbol, r.p) for r in explode_object_or_array(obj, "p INT").collect()) == \
        [("A", 1), ("B", 2), ("B", 3)]
    q = parse_quote(obj.limit(1), "p INT").collect()[0]
    assert q.symbol == "A" and q.p == 1 and q.timestamp is not None
    g = spark.createDataFrame([('{"n": 2, "items": [{"a": {"b": 1}, "t": [1]}]}',)], "payload STRING")
    out = first_list_rows(g, "n INT, items ARRAY<STRUCT<a: STRUCT<b: INT>, t: ARRAY<INT>>>")
    assert out.columns == ["a.b", "t"] and out.collect()[0]["a.b"] == 1
    nolist = first_list_rows(g, "n INT")
    assert nolist.columns == ["n"]


def test_find_and_stack(spark):
    docs = spark.createDataFrame([({"$oid": "x1"}, "F", 1), ({"$oid": "x2"}, "O", 2)],
                                 "_id STRUCT<`$oid`: STRING>, st STRING, v INT")
    out = find(docs, {"st": "F"}, {"v": 1}).collect()
    assert [tuple(r) for r in out] == [(1, "x1")] or [tuple(r) for r in out] == [("x1", 1)]
    a = spark.createDataFrame([(1, "a")], "x INT, y STRING")
    b = spark.createDataFrame([(2,)], "x INT")
    assert sorted((r.x, r.y) for r in stack_by_name([a, b]).collect()) == [(1, "a"), (2, None)]


def test_stream_drain_resume_no_loss_no_repeat(spark, tmp_dir):
    inbox, sink, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _write(f"{inbox}/a.txt", '{"id": 1}\n{"id": 2}\nnot json\n')
    stream = decode(message_files(spark, inbox), "id INT")
    assert drain(stream, sink, ckpt) == 3
    assert drain(decode(message_files(spark, inbox), "id INT"), sink, ckpt) == 0
    _write(f"{inbox}/b.txt", '{"id": 3}\n')
    assert drain(decode(message_files(spark, inbox), "id INT"), sink, ckpt) == 1
    out = spark.read.parquet(sink)
    assert sorted(r.id for r in out.where(F.col("id").isNotNull()).collect()) == [1, 2, 3]
    assert [r.raw_message for r in out.where(F.col("id").isNull()).collect()] == ["not json"]


def test_parquet_filter_and_projection_reach_the_scan(spark, tmp_dir):
    spark.range(100).selectExpr("id", "CAST(id * 2.5 AS DOUBLE) AS px", "'x' AS pad").write.parquet(tmp_dir + "/p")
    df = read_landed(spark, tmp_dir + "/p", "parquet", columns=["id", "px"]).where(F.col("px") > 100)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(px), GreaterThan(px,100.0)]" in plan
    assert "ReadSchema: struct<id:bigint,px:double>" in plan


def test_drain_cut_by_timeout_resumes_exactly_once(spark, tmp_dir):
    """A drain stopped by its timeout (one file per batch, tiny timeout) keeps
    its position: the next run adds exactly the rest, whatever the first got."""
    inbox, sink, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    for i in range(6):
        _write(f"{inbox}/m{i}.txt", "".join(f'{{"id": {i * 10 + j}}}\n' for j in range(10)))
    first = drain(decode(message_files(spark, inbox, max_files_per_trigger=1), "id INT"), sink, ckpt,
                  timeout_s=0.01)
    rest = drain(decode(message_files(spark, inbox, max_files_per_trigger=1), "id INT"), sink, ckpt)
    rows, finished = first
    assert rows + rest == 60 and finished == (rest == 0)
    assert drain(decode(message_files(spark, inbox), "id INT"), sink, ckpt, timeout_s=60) == (0, True)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(60))
