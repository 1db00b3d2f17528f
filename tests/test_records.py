"""JSON arrays and CSV files cut into records over many byte ranges."""

from __future__ import annotations

import csv
import json

import pytest
from pyspark.sql import functions as F

from stratalake.plans import runner
from stratalake.schemas import RAW_ENTITIES
from stratalake.session import settings
from stratalake.sources import records
from stratalake.sources.raw import checked_csv, read_entity, read_json

ODD = ['}', '{', '"', '\\', '\\"', '"}, {"', "]", "[{", "\\\\", "a\nb", "é😀", "", " ", '\\"}\\']


def objects(n: int) -> list[dict]:
    found = []
    for i in range(n):
        found.append({"event_id": f"E{i}", "page": ODD[i % len(ODD)] + str(i), "device": ODD[
            -i % len(ODD)], "extra": {"deep": [{"x": ODD[i * 7 % len(ODD)]}, i]}})
    return found


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("split_bytes", [None, 64, 700, 20_000])
def test_arrays_equal_their_lines(spark, tmp_path, indent, split_bytes):
    rows = objects(300)
    (tmp_path / "array").mkdir()
    for part in range(2):
        text = json.dumps(rows[part::2], ensure_ascii=False, indent=indent)
        (tmp_path / "array" / f"{part}.json").write_text(text + "\n" * part, encoding="utf-8")
    lines = records.array_as_lines(spark, str(tmp_path / "array"), split_bytes)
    found = [json.loads(row.value) for row in spark.read.text(lines).collect()]
    assert sorted(found, key=lambda r: r["event_id"]) == sorted(rows, key=lambda r: r["event_id"])


def test_an_array_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text(json.dumps(objects(4000)), encoding="utf-8")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(path.stat().st_size // 10),
                          "spark.sql.files.openCostInBytes": "0"}):
        pieces = records._pieces(spark, str(path), records.ARRAY)
        assert pieces.groupBy(F.spark_partition_id()).count().count() >= 8
    found = read_json(spark, str(path), RAW_ENTITIES["web_events"], True, 40_000)
    plain = spark.read.option("multiLine", True).option("primitivesAsString", True).json(str(path))
    assert sorted(found.columns) == sorted(plain.columns)
    assert sorted(map(str, found.select(plain.columns).collect())) == sorted(
        map(str, plain.collect()))


def test_empty_arrays_and_other_files(spark, tmp_path):
    for name, text in (("a", "[]"), ("b", " [ \n ]\n"), ("c", '﻿[{"event_id": "x"}]')):
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    lines = records.array_as_lines(spark, str(tmp_path))
    assert [r.value for r in spark.read.text(lines).collect()] == ['{"event_id": "x"}']
    (tmp_path / "d.json").write_text('{"event_id": "lines"}\n')
    with pytest.raises(Exception, match="does not begin with"):
        records.array_as_lines(spark, str(tmp_path))


def test_a_record_over_several_ranges(spark, tmp_path):
    rows = [{"event_id": "a", "page": "}" * 500}, {"event_id": "b", "page": "{" * 5}]
    path = tmp_path / "events.json"
    path.write_text(json.dumps(rows))
    lines = records.array_as_lines(spark, str(path), 50)
    assert [json.loads(r.value) for r in spark.read.text(lines).collect()] in (rows, rows[::-1])


@pytest.mark.parametrize("split_bytes", [None, 40, 5000])
def test_kept_and_rejected_rows_are_all_lines(spark, tmp_path, split_bytes):
    header = list(RAW_ENTITIES["order_items"].columns)
    good = [[f"i{k}", f"o{k}", 'p"q"\nnext, line' if k % 9 == 0 else f"p{k}", str(k), "1.5", ""]
            for k in range(200)]
    bad = [["x1", "o", "p", "many", "1.5", "0"], ["x2", "o", "p", "1", "cheap", "free"]]
    for part in range(2):
        with open(tmp_path / f"{part}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator="\r\n" if part else "\n")
            writer.writerows([header, *good[part::2], bad[part], [], ["only", "two"]])
    kept, rejected = checked_csv(spark, str(tmp_path), RAW_ENTITIES["order_items"], split_bytes)
    rows = sorted(tuple(r) for r in kept.collect())
    assert rows == sorted(
        (i, o, p.replace("\n", "\n"), int(q), float(u), None) for i, o, p, q, u, _ in good)
    found = sorted((r.reason, r.raw_text, r.file.rsplit("/", 1)[1]) for r in rejected.collect())
    assert found == sorted([
        ("quantity is no int", "x1,o,p,many,1.5,0", "0.csv"),
        ("unit_price is no double, discount_amount is no double", "x2,o,p,1,cheap,free", "1.csv"),
        ("number of fields", "only,two", "0.csv"), ("number of fields", "only,two", "1.csv")])


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("customer_id,city\n1,x\n")
    (tmp_path / "b.csv").write_text("city,customer_id\nx,1\n")
    with pytest.raises(ValueError, match="different headers"):
        checked_csv(spark, str(tmp_path), RAW_ENTITIES["customers"])


def test_the_entity_reader_takes_arrays(spark, tmp_path):
    path = tmp_path / "web_events.json"
    path.write_text(json.dumps([{"event_id": "e1", "event_timestamp": "2024-01-01 00:00:00"}]))
    assert read_entity(spark, str(path), "web_events", multi_line=True).count() == 1


def test_the_loader_keeps_rejected_rows(spark, tmp_path):
    header = ",".join(RAW_ENTITIES["products"].columns)
    (tmp_path / "products.csv").write_text(
        f"{header}\np1,\"a\nb\",c,2.5,\np2,b,c,free,\np3,short\n")
    roots = [str(tmp_path / name) for name in ("bronze", "rejects")]
    metric, = runner.raw_to_bronze(
        spark, str(tmp_path), roots[0], entities=["products"], rejects_root=roots[1])
    assert (metric.records_in, metric.records_out, metric.invalid_records) == (3, 1, 2)
    kept = spark.read.parquet(f"{roots[0]}/products").first()
    assert (kept.product_id, kept.product_name, kept.unit_price) == ("p1", "a\nb", 2.5)
    reasons = [r.reason for r in spark.read.parquet(f"{roots[1]}/products").collect()]
    assert sorted(reasons) == ["number of fields", "unit_price is no double"]
