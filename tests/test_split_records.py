"""CSV scans cut at true record ends, checks in the same pass, digests in chunks, manifests as they are."""

import csv
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from fluxsieve.operators import validation
from fluxsieve.sinks import exports
from fluxsieve.sources import market, records, tables
from fluxsieve.sources.digests import folder_digests


@pytest.fixture
def small_blocks(spark):
    """Splits of 2 kB, so that records lie across many of them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name, value in zip(names, ("2048", "0")):
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def _rows(count):
    rng = random.Random(count)
    cells = ["plain", 'a "q" b', "two\nlines, x", '"\n\n"', "", " lead ", "x\r\ny", "long\n" * 900, "é—", ",", '"']
    return [(str(i), rng.choice(cells) + str(i % 3), str(2 * i)) for i in range(count)]


def test_records_across_many_splits_and_two_layouts(spark, tmp_path, small_blocks):
    rows = _rows(900)
    with open(tmp_path / "a.csv", "w", newline="") as f:
        csv.writer(f).writerows([["﻿k", " v", "n"], *rows])
    with open(tmp_path / "b.csv", "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([["n", "k", "extra", "v"], *[(n, "b" + k, "e", v) for k, v, n in rows]])
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    got = records.read_split(spark, paths, ("k", "v", "n"), "t")
    assert records.text_lines(spark, paths[0]).rdd.getNumPartitions() > 20
    assert sorted((r["k"], r["v"], r["n"]) for r in got.collect()) == sorted(rows + [("b" + k, v, n) for k, v, n in rows])
    ordered = [r["k"] for r in got.where(F.col("_file").endswith("a.csv")).orderBy("_at").collect()]
    assert ordered == [k for k, _, _ in rows]
    both = records.read_split(spark, paths, ("k", "v", "n"), "t", others=True)
    assert {r["extra"] for r in both.select("extra").distinct().collect()} == {None, "e"}


def test_refused_headers_and_torn_rows(spark, tmp_path):
    def read(text, **how):
        (tmp_path / "t.csv").write_text(text)
        return [tuple(r) for r in records.read_split(
            spark, str(tmp_path / "t.csv"), ("a", "b"), "t", **how).orderBy("_at").select("a", "b").collect()]

    assert read("b,a\n1,2\n\n3,\n") == [("2", "1"), ("", "3")]
    assert read("a,b,c\n1,2,3\n") == [("1", "2")] and read("a,b\n") == []
    for text, how in (("a,c\n1,2\n", {}), ("a,b,a\n1,2,3\n", {}), ("", {}), ("a,b,c\n1,2,3\n", {"exactly": True})):
        with pytest.raises(validation.Refused):
            read(text, **how)
    assert read("a,b\n1,\n", exactly=True) == [("1", "")]
    for torn in ("a,b\n1\n", "a,b\n1,2,3\n"):
        with pytest.raises(Exception, match="has not 2 cells"):
            read(torn, exactly=True)


def test_rules_are_counted_while_rows_are_written(spark):
    rows = spark.range(100).withColumn("v", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")))
    assert validation.settled(rows, {"odd": F.col("v") < 0}, "rows").count() == 100
    with pytest.raises(validation.Refused, match="of 100 rows 9 break small"):
        validation.settled(rows, {"small": F.col("v") < 10, "never": F.lit(False)}, "rows")
    assert validation.settled(rows.limit(0), {"odd": F.col("v") < 0}, "rows").count() == 0


def test_bad_panel_rows_leave_nothing_at_the_target(spark, tmp_path):
    stamp = {"source": "a", "source_version": "v", "retrieved_at": "2026-01-02T00:00:00Z"}
    twice = spark.createDataFrame([("DA", "2025-02", "28", "28", "r")] * 2, "market string, period string, days_expected string, days_covered string, raw_refs string")
    with pytest.raises(validation.Refused, match="repeated keys"):
        exports.write_panel_table(twice, str(tmp_path), "constraint_coverage", stamp, ["r"])
    assert not (tmp_path / "normalized").exists()


def test_digests_of_files_of_any_size(spark, tmp_path):
    bodies = {"a.bin": b"", "sub/deep/b.bin": b"x" * (20 << 20), "sub/c d.txt": "é".encode(), "_SUCCESS": b"", ".a.crc": b"1"}
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(body)
    got = {r["relative"]: (r["bytes"], r["sha256"]) for r in folder_digests(spark, str(tmp_path)).collect()}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items() if n[0] not in "._"}
    assert folder_digests(spark, f"file://{tmp_path}").count() == 3
    (tmp_path / "none").mkdir()
    assert folder_digests(spark, str(tmp_path / "none")).count() == 0 and folder_digests(spark, str(tmp_path / "gone")).count() == 0


def test_unknown_manifest_fields_are_listed(spark):
    stamp = {"source": "s", "source_version": "v", "retrieved_at": "t"}
    text = json.dumps({"tables": {"x": {**stamp, "path": "p", "extra": {"a": [1]}, "contributors": [{**stamp, "k": 1}, stamp],
                                        "column_sources": {"c": {**stamp, "unit": None}}}, "y": {}}})
    frame = spark.createDataFrame([("m", text), ("bad", "{"), ("empty", "{}"), (None, None)], "manifest string, value string")
    got = sorted((r["table"], r["role"], r["column"] or "", r["field"], r["value"]) for r in tables.manifest_fields(frame).collect())
    assert got == [("x", "column", "c", "unit", "null"), ("x", "contributor", "", "k", "1"), ("x", "table", "", "extra", '{"a":[1]}')]


def test_features_cut_by_their_separator(spark, tmp_path, small_blocks):
    features = [{"type": "Feature", "properties": {"ID": f"F{i}", "VOLTAGE": 345, "OWNER": 'a "b" ]}'},
                 "geometry": {"type": "LineString", "coordinates": [[-90, 40], [-90, 40.5]] if i % 5 else [["x"]]}} for i in range(300)]
    text = json.dumps({"type": "FeatureCollection", "features": features}, separators=(",", ":"))
    (tmp_path / "f.json").write_text(text)
    rows = market.line_features(spark, str(tmp_path / "f.json"), '{"type":"Feature",')
    got = [(r["hid"], r["kv"], r["owner"], r["parts"] is not None) for r in rows.orderBy("ord").collect()]
    assert got == [(f"F{i}", 345.0, 'a "b" ]}', i % 5 > 0) for i in range(300)]
