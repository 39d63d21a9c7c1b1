import json

import pytest
from pyspark.sql import functions as F

from checks.scoring import FORWARD, PRIORS
from fluxsieve import fixed
from fluxsieve.operators.validation import Refused
from fluxsieve.plans import corridors, decision, ranking, report

TABLES = {
    "buses": ("bus_id,name,ba,lat,lon,role,weight", ["A,N,X,40,-100,gen,1", "B,M,X,41,-100,load,2", "C,O,X,42,-99,load,1", "D,P,X,43,-99,load,1"]),
    "hifld_lines": ("line_id,from_bus,to_bus,voltage_kv,length_mi", ["L1,A,B,345,50", "L2,B,C,345,60", "L3,A,C,230,80", "L4,C,D,138,20"]),
    "eia_lines": ("line_id,voltage_kv", ["L1,345", "L3,345", ",500"]),
    "ferc1_lines": ("line_id,voltage_kv,conductor,thermal_limit_mw,cost_usd", ["L1,345,ACSR,900,1", "L3,230,4/0,,2"]),
    "constraints": ("constraint_id,monitored_line,contingency_line,ctype", ["F1,L1,L3,thermal", "F2,L1,,thermal", "F3,L4,L2,thermal", "F4,,,interface"]),
    "congestion": ("constraint_id,monthly_cost_musd,hours_binding", ["F1,2.5,400", "F2,1.5,100", "F4,0.5,50"]),
    "planning": ("constraint_id,plan,proposed_fix,assigned_cost_musd", ["F1,ITP,x,100", "F1,FCA,y,20"]),
    "queue": ("request_id,near_bus,mw,fuel", ["Q1,A,300,wind", "Q2,D,200,sun"]),
    "load_930": ("snapshot,ba,load_mw", ["peak,X,900", "low,X,300"]),
    "sensitivity": ("line_id,bus_id,ptdf", ["L1,A,0.5", "L1,C,-0.2", "L2,B,-0.6", "L3,A,0.5", "L4,D,-1"]),
}


def tables(spark, parts):
    out = {}
    for name, (head, rows) in TABLES.items():
        cols = head.split(",")
        data = [(*r.split(","), i) for i, r in enumerate(rows)]
        out[name] = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols) + ", ord int").repartition(parts)
    return out


@pytest.fixture(scope="module")
def runs(spark):
    settings = ranking.Settings(draws=200, by_value=True, priors=PRIORS, forward=FORWARD)
    stamps = spark.createDataFrame([(t, "table", None, f"src_{t}", "v1", "2026-01-01") for t in TABLES]
                                   + [("congestion", "column", "hours_binding", "src_hours", "v1", "2026-01-01")],
                                   "table string, role string, column string, source string, source_version string, retrieved_at string")
    return [ranking.rank_region(tables(spark, n), settings, stamps=stamps) for n in (1, 3)]


def test_every_score_names_the_sources_it_rests_on(runs):
    rows = {r["constraint_id"]: r["provenance"] for r in runs[0]["flowgates"].collect()}
    # dollars, hours, lines, plan and a request at bus A; F4 has no line, so what lines carry was asked in vain
    assert rows["F1"].endswith("data=src_congestion,src_eia_lines,src_ferc1_lines,src_hifld_lines,src_hours,src_planning,src_queue")
    assert rows["F4"].endswith("data=src_congestion,src_hours,src_planning; absent=src_eia_lines,src_ferc1_lines,src_hifld_lines,src_queue")
    assert "src_hours" not in rows["F3"] and "src_congestion" in rows["F3"]  # the table was asked, its hours cell is not there
    ids = {r["lineage_id"] for r in runs[0]["facts"].collect()}
    assert "obs:congestion:F1:monthly_cost_musd" in ids and "obs:ferc1_lines:L3:thermal_limit_mw" not in ids


def test_every_flowgate_is_ranked_and_layout_does_not_matter(runs):
    first, second = runs
    rows = {r["constraint_id"]: r for r in first["rows"].collect()}
    assert sorted(r["rank"] for r in rows.values()) == [1, 2, 3, 4]
    assert rows["F4"]["screen_status"] == "unmapped_monitored" and rows["F4"]["cov_loading"] == "unobserved"
    assert rows["F3"]["ev_mean_musd"] is None and rows["F3"]["rank"] == 4
    assert rows["F1"]["rent_musd"] == 30.0 and rows["F1"]["get_evidence"] == "line_n1"
    digests = [report.table_digest(report.fingerprint(r["flowgates"])).first()["digest"] for r in (first, second)]
    assert digests[0] == digests[1]
    changed = report.fingerprint(first["flowgates"]).withColumn("rank", F.col("rank") + 1)
    assert report.table_digest(changed).first()["digest"] != digests[0]


def test_corridors_detail_and_page(runs):
    out = runs[0]
    members = {(r["physical_corridor"], r["position"]): r["constraint_id"] for r in out["members"].collect()}
    assert {members["L1", 1], members["L1", 2]} == {"F1", "F2"}
    top = {r["physical_corridor"]: r for r in out["corridors"].collect()}
    assert top["L1"]["n_flowgates"] == 2 and top["L1"]["representative_flowgate"] == members["L1", 1]
    detail = corridors.corridor_detail(out["corridors"], out["rows"]).where("physical_corridor = 'L1'").collect()
    assert {r["name"] for r in detail if r["kind"] == "signal"} == set(fixed.SIGNALS)
    assert sum(r["value"] for r in detail if r["kind"] == "p_best") == pytest.approx(1, abs=1e-3)
    page = [json.loads(r["row_json"]) for r in corridors.page_rows(out["rows"], 2).collect()]
    assert sorted(p["rank"] for p in page) == [1, 2]
    gaps = [r["gap"] for r in report.gap_list(
        out["rows"].sparkSession.createDataFrame([("planning", "partial", "n")], "table string, coverage string, note string"),
        report.signal_coverage(out["flowgates"])).collect()]
    assert any(g.startswith("planning: partial") for g in gaps) and any(g.startswith("composite:") for g in gaps)


def test_sweep_keeps_the_baseline(runs):
    flow = runs[0]["flowgates"].select("constraint_id", "evidence", "rent", "months_binding")
    got = {r["scenario"]: r for r in decision.sensitivity_sweep(flow, PRIORS, FORWARD).collect()}
    moved = [m for m in decision.knobs(PRIORS) for end in ("low", "high") if m[end] != m["was"]]
    assert len(got) == 2 + len(moved) and "forward rent off" in got and "haircut at lo" in got
    assert got["baseline"]["kept_top10"] == 3 and got["baseline"]["kept_top_k"] == 1


def test_settings_of_another_input_are_refused_and_a_run_is_reproduced(spark, runs):
    settings = ranking.Settings(draws=200, by_value=True, priors=PRIORS, forward=FORWARD, derived_from={"congestion": "abc"})
    for digests in (None, {"congestion": "xyz"}):
        with pytest.raises(Refused):
            ranking.rank_region(tables(spark, 1), settings, digests=digests)
    recorded = report.fingerprint(runs[0]["flowgates"])
    assert ranking.recompute(recorded, tables(spark, 2), settings, digests={"congestion": "abc"}).count() == 0
    other = recorded.withColumn("rank", F.when(F.col("constraint_id") == "F1", 9).otherwise(F.col("rank"))).where("constraint_id <> 'F2'")
    changed = {r["constraint_id"]: r["recorded"] for r in ranking.fingerprint_changes(other, recorded).collect()}
    assert set(changed) == {"F1", "F2"} and changed["F2"] is None and changed["F1"]["rank"] == 9
