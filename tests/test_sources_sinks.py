import hashlib
import json

import pytest
from pyspark.sql import functions as F

from fluxsieve import fixed
from fluxsieve.operators import filings, rollups, validation
from fluxsieve.sinks import exports
from fluxsieve.sources import market, tables


def test_text_table_keeps_blanks_and_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('﻿id, name ,note\n1,"a\nb",\n2," x ","say ""hi"""\n')
    df = tables.trimmed_headers(tables.read_text_table(spark, str(tmp_path / "t.csv")))
    assert df.columns == ["id", "name", "note"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", "a\nb", None), ("2", " x ", 'say "hi"')]


def test_quoted_line_breaks_stay_one_cell_in_grouped_files(spark, tmp_path):
    head = "Balancing Authority,Data Date,UTC Time at End of Hour,Demand (MW),Note"
    day, hour = "01/02/2024", "01/02/2024 {:02d}:00:00 AM"
    (tmp_path / "a.csv").write_text(f'{head}\nXX,{day},{hour.format(1)},5,"one\ntwo"\nXX,{day},{hour.format(2)},6,"say ""hi"""\n')
    (tmp_path / "b.csv").write_text(f"Extra,{head}\n0,XX,{day},{hour.format(3)},7,plain\n")
    rows = market.authority_rows(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "XX", 2024)
    assert sorted((r["Demand (MW)"], r["Note"]) for r in rows.collect()) == [
        ("5", "one\ntwo"), ("6", 'say "hi"'), ("7", "plain")]


def test_settled_rows_keep_quoted_line_breaks(spark, tmp_path):
    columns = [c for c in fixed.SETTLED_COLUMNS if c not in ("Month", "DA Collected")]
    body = ",".join(["Note", "Month", "DA Collected", *columns]) + "\n" + ",".join(['"a\nb"', "02/2024", "5", *columns]) + "\n"
    (tmp_path / "t.csv").write_text(body)
    assert [(str(r["month"]), r["collected"]) for r in market.settled_rows(spark, [str(tmp_path / "t.csv")]).collect()] == [
        ("2024-02-01", 5.0)]


def test_exact_contract_refuses_other_columns(spark, tmp_path):
    (tmp_path / "c.csv").write_text("market,period,days_expected,days_covered\nDA,2025-01,31,31\n")
    with pytest.raises(validation.Refused):
        tables.read_exact_table(spark, str(tmp_path / "c.csv"), fixed.COVERAGE_COLUMNS, "coverage")


def snapshot(root, body="id,v\n1,2\n", digest=None, version=1):
    (root / "normalized").mkdir(parents=True)
    (root / "normalized" / "buses.csv").write_text(body)
    stamp = {"source": "a", "source_version": "v1", "retrieved_at": "2026-01-02T00:00:00+00:00"}
    (root / "snapshot_manifest.json").write_text(json.dumps({
        "schema_version": version,
        "tables": {"buses": {**stamp, "path": "normalized/buses.csv", "rows": 1, "coverage": "partial", "note": "n",
                             "sha256": digest or hashlib.sha256(body.encode()).hexdigest(),
                             "contributors": [{**stamp, "source": "b"}], "column_sources": {"v": {**stamp, "source": "c"}}}},
        "raw": {"raw:x": {"url": "", "path": "../x", "sha256": "zz", "retrieved_at": "2026-01-02", "bytes": 1}}}))
    return str(root)


def test_verified_scan_and_manifest(spark, tmp_path):
    root = snapshot(tmp_path / "good")
    assert tables.read_verified(spark, root, ["buses"])["buses"].first()["v"] == "2"
    manifest = tables.read_manifest(spark, f"{root}/snapshot_manifest.json")
    stamps = {(r["role"], r["column"], r["source"]) for r in tables.manifest_stamps(manifest).collect()}
    assert stamps == {("table", None, "a"), ("contributor", None, "b"), ("column", "v", "c")}
    assert validation.stamp_violations(tables.manifest_stamps(manifest)).count() == 0
    broken = {r["rule"] for r in validation.raw_entry_violations(tables.manifest_raw(manifest)).collect()}
    assert broken == {"url", "sha256", "path", "retrieved_at"}
    assert tables.missing_tables(tables.manifest_tables(manifest)).count() == len(fixed.SNAPSHOT_TABLES) - 1
    with pytest.raises(validation.Refused):
        tables.read_verified(spark, root, ["queue"])
    with pytest.raises(validation.Refused):
        tables.read_verified(spark, snapshot(tmp_path / "bad", digest="0" * 64), ["buses"])
    with pytest.raises(validation.Refused):
        tables.read_manifest(spark, snapshot(tmp_path / "old", version=2) + "/snapshot_manifest.json")


HEADER = ("Interval,GMTIntervalEnd,Constraint Name,Constraint Type,State,Shadow Price,Monitored Facility,"
          "Contingent Facility, Contingency Name\n")


def test_hourly_rows_roll_up(spark, tmp_path):
    (tmp_path / "B-202501.csv").write_text(
        HEADER + "01/01/2025 01:00:00,01/01/2025 07:00:00,C1,N,BINDING,-10.5,LN B - A,AB:X Y:115,OUT1\n"
        "01/01/2025 01:00:00,01/01/2025 07:00:00,C1,N,BREACHED,-99,LN B - A,AB:X Y:115,OUT1\n"
        "02/01/2025 00:00:00,02/01/2025 06:00:00,C1,N,BREACHED,20,LN A - B,AB:X Y:115,OUT1\n")
    (tmp_path / "B-202502.csv").write_text(
        HEADER + "02/01/2025 01:00:00,02/01/2025 07:00:00,C1,N,BINDING,1.25,LN B - A,AB:X Y:115,OUT1\n")
    paths = [str(tmp_path / f"B-2025{m}.csv") for m in ("01", "02")]
    hours = market.binding_hours(market.binding_rows(spark, paths))
    row = rollups.flowgates(hours).first()
    assert (row["hours_binding"], row["breached_hours"], row["months_binding"]) == (3, 1, 2)
    assert row["shadow_price_sum"] == 31.75 and row["max_abs_shadow_price"] == 20.0
    assert row["monitored"] == "LN B - A" and row["monitored_facility"] == "LN A - B"
    assert (row["contingency_to"], row["contingency_kv"]) == ("AB", "115")
    assert tuple(rollups.duplicate_hours(hours).first()) == (1, 1)
    (tmp_path / "B-202503.csv").write_text(HEADER + "02/01/2025 01:00:00,02/01/2025 07:00:00,C1,N,BINDING,1,LN,BASE,BASE\n")
    with pytest.raises(validation.Refused):
        market.binding_hours(market.binding_rows(spark, [str(tmp_path / "B-202503.csv")]))


def test_dollars_and_settled(spark, tmp_path):
    (tmp_path / "cbc_202501.csv").write_text(
        "Date, Constraint Name, Monitored Facility, Contingent Facility, Contingency Name, Sum\n"
        "202501,C1,LN A - B,x,OUT1,-100.5\n202501,C1,LN A - B,x,OUT1,-100.5\n202501,C2,LN A - B,x,OUT1,7\n")
    dollars = market.dollar_rows(spark, [str(tmp_path / "cbc_202501.csv")])
    assert [r["conflict"] for r in rollups.dollar_duplicates(dollars).collect()] == [False]
    got = {r["constraint_id"]: (r["rent_usd"], r["negative_months"]) for r in
           rollups.flowgate_dollars(rollups.unique_dollars(dollars)).collect()}
    assert got == {"C1|OUT1": (100.5, 0), "C2|OUT1": (None, 1)}
    (tmp_path / "tcr.csv").write_text("Constraint Name,DA Collected,TCR Payout,Funding,Month\nC1,90,1,1,01/2025\n")
    settled = market.settled_rows(spark, [str(tmp_path / "tcr.csv")])
    assert rollups.reconcile_months(rollups.unique_dollars(dollars), settled, 1.0).count() == 0
    low = rollups.reconcile_months(rollups.unique_dollars(dollars), settled, 0.5)
    assert [r["check"] for r in low.collect()] == ["joined_share_below_floor"]


def test_queue_file_with_preamble(spark, tmp_path):
    names = list(fixed.QUEUE_COLUMNS)
    row = ["G1", "KS", "TO", "1,250.5", "Wind", "", "Big\n Sub 345kV", "", "DISIS STAGE"]
    gone = ["G2", "KS", "TO", "10", "", "Solar", "X", "", "IA FULLY EXECUTED/COMMERCIAL OPERATION"]
    text = '"Last Updated On",3/4/2026,\r\n' + ",".join(names) + "\r\n"
    text += "\r\n".join(",".join(f'"{c}"' for c in r) for r in (row, gone)) + "\r\n"
    (tmp_path / "q.csv").write_bytes(text.encode())
    version, active = market.queue_file(spark, str(tmp_path / "q.csv"))
    assert version == "spp_giq_2026-03-04"
    got = active.collect()
    assert len(got) == 1 and got[0]["mw"] == 1250.5 and got[0]["fuel"] == "Wind" and got[0]["poi"] == "Big Sub 345kV"
    buses = spark.createDataFrame([("B1", "BIG"), ("B2", "OTHER STATION")], "bus_id string, name string")
    assert filings.place_requests(active, buses).first()["near_bus"] == "B1"


def test_authority_halves_with_different_columns(spark, tmp_path):
    head = "Balancing Authority,Data Date,UTC Time at End of Hour,Demand (MW),Demand (MW) (Adjusted),Net Generation (MW),"
    (tmp_path / "a.csv").write_text(head + "Net Generation (MW) from Wind\nXX,01/02/2024,01/02/2024 07:00:00 AM,\"1,000\",,500,50\n"
                                    "YY,01/02/2024,01/02/2024 07:00:00 AM,1,,1,1\n")
    (tmp_path / "b.csv").write_text(head + ",".join(fixed.WIND_COLUMN_GROUPS[2])
                                    + "\nXX,07/02/2024,07/02/2024 07:00:00 PM,900,950,400,100,20\n")
    rows = market.authority_rows(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "XX", 2024)
    got = rollups.authority_hours(rows).orderBy("utc").collect()
    assert [(r["demand"], r["demand_column"], r["wind_share"]) for r in got] == [
        (1000.0, "Demand (MW)", 0.1), (950.0, "Demand (MW) (Adjusted)", 0.3)]
    assert str(got[1]["utc"]) == "2024-07-02 19:00:00"


def test_plants_and_features(spark, tmp_path):
    gens = spark.sql("SELECT 1 plant_id_eia, date'2024-01-01' report_date, 'OP' operational_status_code, 10.5D capacity_mw "
                     "UNION ALL SELECT 1, date'2024-01-01', 'RE', 99D UNION ALL SELECT 2, date'2023-01-01', 'OP', 5D")
    plants = spark.sql("SELECT 1 plant_id_eia, 'P' plant_name_eia, 40D latitude, -90D longitude, ' XX ' "
                       "balancing_authority_code_eia, date'2024-01-01' report_date")
    row = market.operating_plants(gens, plants, 2024).collect()
    assert len(row) == 1 and (row[0]["capacity_mw"], row[0]["ba"], row[0]["n_generators"]) == (10.5, "XX", 1)
    def feature(i, geometry, **p):
        return {"properties": {"ID": i, "TYPE": "AC", "STATUS": "IN SERVICE", "VOLTAGE": 345.0, **p}, "geometry": geometry}
    doc = {"features": [
        feature("1", {"type": "LineString", "coordinates": [[-90, 40], [-90, 40.1]]}),
        feature("1", {"type": "LineString", "coordinates": [[-90, 40], [-90, 40.1]]}),
        feature("2", {"type": "MultiLineString", "coordinates": [[[-90, 41], [-90, 41.1]], [[-90, 41.3], [-90, 41.2]]]}),
        feature("3", {"type": "LineString", "coordinates": [[-90, 95], [-90, 40.1]]}),
        feature("4", None), feature(None, None), feature("5", None, TYPE="DC LINE")]}
    (tmp_path / "f.json").write_text(json.dumps(doc))
    done = filings.classify_features(market.line_features(spark, str(tmp_path / "f.json")), 69.0)
    reasons = {r["ord"]: r["reason"] for r in done.collect()}
    assert reasons == {0: None, 1: "duplicate_id", 2: None, 3: "bad_geometry", 4: "bad_geometry", 5: "bad_id", 6: "dc"}
    chain = {r["ord"]: r for r in filings.chain_parts(done.where("reason is null")).collect()}
    assert chain[2]["head"]["lat"] == 41.0 and chain[2]["tail"]["lat"] == 41.3
    assert chain[2]["gap_m"] == pytest.approx(11119.5, rel=1e-3)


def test_run_export_catalogue_and_tamper(spark, tmp_path):
    folder = str(tmp_path / "runs" / "r1")
    rows = spark.createDataFrame([(1, "=C1", 0.5, None), (2, "C2", 0.25, 1.5)],
                                 "rank int, constraint_id string, p_top_k double, ev_mean_musd double")
    corridors = spark.createDataFrame([(1, "K")], "corridor_rank int, physical_corridor string")
    members = spark.createDataFrame([("K", 1, "=C1")], "physical_corridor string, position int, constraint_id string")
    exports.export_scores(rows, corridors, members, folder)
    registry = spark.createDataFrame([("a", "v1", True)], "source string, source_version string, publishable boolean")
    exports.write_run_manifest(registry, folder, ["scores.json", "scores.csv", "scores.parquet", "shortlist.json"],
                               run_label="t", region="x", mode="internal", generated_at="2026-01-01", scoring={"seed": 1})
    assert tables.run_catalogue(spark, str(tmp_path / "runs")).first()["directory"] == "r1"
    run = tables.read_run(spark, folder)
    assert run["scores"].orderBy("rank").first()["constraint_id"] == "=C1"
    text = spark.read.option("header", True).csv(f"{folder}/scores.csv").orderBy("rank").first()
    assert text["constraint_id"] == "'=C1" and text["ev_mean_musd"] is None
    exports.json_rows_to_parquet(spark, f"{folder}/scores.json", rows.schema, f"{folder}/again.parquet")
    assert spark.read.parquet(f"{folder}/again.parquet").schema == rows.schema
    part = next((tmp_path / "runs" / "r1" / "shortlist.json").glob("part-*"))
    part.write_text('{"corridor_rank":1,"physical_corridor":"OTHER"}\n')
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(validation.Refused):
        tables.read_run(spark, folder)


def test_table_sinks_check_before_they_write(spark, tmp_path):
    root = str(tmp_path)
    stamp = {"source": "a", "source_version": "v1", "retrieved_at": "2026-01-02T00:00:00Z"}
    coverage = spark.createDataFrame([("DA", "2025-02", "28", "28", "raw:a")], ", ".join(f"{c} string" for c in fixed.COVERAGE_COLUMNS))
    exports.write_panel_table(coverage, root, "constraint_coverage", stamp, ["raw:a"])
    assert spark.read.json(f"{root}/manifest").first()["rows"] == 1
    with pytest.raises(validation.Refused):
        exports.write_panel_table(coverage.withColumn("days_covered", F.lit("29")), root, "constraint_coverage", stamp, ["raw:a"])
    exports.write_table(coverage.limit(0), root, "planning", ["period"], stamp, files=1)
    kinds = {r["table"]: r["coverage"] for r in spark.read.json(f"{root}/manifest").collect()}
    assert kinds == {"constraint_coverage": "observed", "planning": "unobserved"}


def test_written_cells_read_back_as_they_were(spark, tmp_path):
    rows = [("1", 'say "hi", ok'), ("2", "two\nlines, \"quoted\""), ("3", "back\\slash"), ("4", ""), ("5", None)]
    stamp = {"source": "a", "source_version": "v1", "retrieved_at": "2026-01-02T00:00:00Z"}
    exports.write_table(spark.createDataFrame(rows, "k string, v string"), str(tmp_path), "cells", ["k"], stamp)
    got = {r["k"]: r["v"] for r in tables.read_text_table(spark, f"{tmp_path}/normalized/cells").collect()}
    assert got == {k: v or None for k, v in rows}
    assert spark.read.json(f"{tmp_path}/manifest").first()["rows"] == len(rows)


def test_digests_meet_files_by_their_whole_path(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    bodies = {"x.csv": "one", "sub/x.csv": "two"}
    for name, body in bodies.items():
        (tmp_path / name).write_text(body)
    digest = {n: hashlib.sha256(b.encode()).hexdigest() for n, b in bodies.items()}

    def failures(rows):
        return {r["t"]: r["found"] for r in tables.digest_failures(
            spark, str(tmp_path), spark.createDataFrame(rows, "t string, path string, sha256 string"), "t").collect()}

    assert failures([("a", n, d) for n, d in digest.items()][:2]) == {}
    assert failures([("a", "x.csv", digest["sub/x.csv"]), ("b", "sub/x.csv", digest["sub/x.csv"]), ("c", "gone.csv", "0")]) == {
        "a": digest["x.csv"], "c": None}
    assert failures([("c", "gone.csv", "0")]) == {"c": None}
