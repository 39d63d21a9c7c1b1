import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.scoring import FORWARD, PRIORS
from fluxsieve import fixed
from fluxsieve.functions import numeric, sampling
from fluxsieve.operators import remedies, validation
from fluxsieve.plans import decision, panel, scoring, signals

HISTORY = [
    ("P1", "DA", "2025-01", "10", "90", "30", "1000", "SUB A", "SUB B", 1),
    ("P1", "DA", "2025-02", "30", "120", "50", "", "SUB A", "SUB C", 2),
    ("P1", "RT", "2025-01", "5", "70", "20", "", "SUB A", "", 3),
]
COVERAGE = [("DA", "2025-01", "31", "31", "raw:da"), ("DA", "2025-02", "28", "20", "raw:da"), ("DA", "2025-03", "31", "0", ""),
            ("DA", "2025-04", "30", "30", "raw:da"), ("RT", "2025-01", "31", "31", "raw:rt")]
FOOTPRINT = [("S1", "site", "P1", "K1", "verified", "e", "", "me", "2025-05-01"), ("S2", "site", "P9", "", "verified", "e", "", "me", "2025-05-01"),
             ("S3", "site", "P7", "", "uncertain", "e", "", "", "")]


def test_panel_reads_nothing_as_zero(spark):
    history = spark.createDataFrame(HISTORY, ", ".join(f"{c} string" for c in fixed.HISTORY_COLUMNS) + ", ord int")
    coverage = spark.createDataFrame(COVERAGE, ", ".join(f"{c} string" for c in fixed.COVERAGE_COLUMNS))
    footprint = spark.createDataFrame(FOOTPRINT, ", ".join(f"{c} string" for c in fixed.FOOTPRINT_COLUMNS))
    assert validation.history_violations(history).count() == 0
    assert validation.coverage_violations(coverage).count() == 0
    assert validation.footprint_violations(footprint).count() == 0
    h, c = panel.typed_history(history), panel.typed_coverage(coverage)
    cells = panel.panel_cells(footprint, h, c)
    rows = {(r["constraint_id"], r["market"], r["period"]): r for r in panel.monthly_rows(cells).collect()}
    assert len(rows) == 2 * 2 * 4
    assert rows["P1", "DA", "2025-04"]["binding"] == "no" and rows["P1", "DA", "2025-04"]["hours_binding"] == 0.0
    assert rows["P1", "DA", "2025-03"]["binding"] == "unknown" and rows["P1", "DA", "2025-03"]["hours_binding"] is None
    assert rows["P1", "RT", "2025-02"]["coverage"] == "none"
    assert rows["P1", "DA", "2025-02"]["missing"] == "congestion_cost_usd not published"
    s = {(r["constraint_id"], r["market"]): r for r in panel.panel_summary(cells, footprint, h).collect()}
    one = s["P1", "DA"]
    assert one["hours_binding"] == 40.0 and one["shadow_price_max"] == 120.0 and one["shadow_price_mean"] == 45.0
    assert one["congestion_cost_usd"] is None and "1 of 2 binding months" in one["missing"]
    assert one["flags"] == "partial_coverage;months_not_covered" and one["confidence"] == "medium"
    assert one["reported_facilities"] == "SUB A / SUB B | SUB A / SUB C | SUB A"
    assert s["P9", "DA"]["confidence"] == "low" and s["P9", "DA"]["seen_in_source"] == "no"
    assert validation.consistency_violations(h, c).count() == 0
    moved = h.withColumn("hours_binding", F.when(F.col("market") == "RT", 746.0).otherwise(F.col("hours_binding")))
    assert [r["rule"] for r in validation.consistency_violations(moved, c).collect()] == ["too_many_hours"]


def flowgates(spark, rows):
    df = spark.createDataFrame(rows, "constraint_id string, element string, evidence string, x double, months_binding int")
    return df.withColumn("rent", numeric.band(F.col("x"), 0.6, 1.5)).drop("x")


def test_exact_decision_is_the_mean_of_simulated_decisions(spark):
    rng = random.Random(2)
    rows = [(f"F{i}", f"E{i}", rng.choice(fixed.EVIDENCE_CLASSES), rng.uniform(0.1, 8), rng.randint(1, 12)) for i in range(12)]
    got = {r["constraint_id"]: r for r in decision.decide(flowgates(spark, rows), PRIORS, FORWARD).collect()}
    for r in got.values():
        values = [r[f"mu{i}"] for i in (1, 2, 3, 4)]
        q = [r[f"q{i}"] for i in range(3)]
        mean, none = 0.0, 0.0
        for a in itertools.product((0, 1), repeat=3):
            w = 1.0
            for i in range(3):
                w *= q[i] if a[i] else 1 - q[i]
            best = max([0.0] + [values[i] for i in range(3) if a[i]] + ([values[3]] if a[0] and a[1] else []))
            mean += w * best
            none += w * (best == 0.0)
        assert r["ev_mean"] == pytest.approx(mean, abs=1e-12) and r["p_best_none"] == pytest.approx(none)
        split = sum(r[f"ev_from_{s}"] for s in ("dlr", "apfc", "to", "c"))
        assert split == pytest.approx(r["ev_mean"])
        assert (r["ev_get"] == fixed.NO_REMEDY) == (r["ev_mean"] == 0)


def test_one_element_shares_its_draws(spark):
    rows = [("A", "E", "line_n1", 5.0, 12), ("B", "E", "line_n1", 5.0, 12)]
    valued = decision.decide(flowgates(spark, rows), PRIORS)
    d = decision.realized_draws(valued, PRIORS, draws=300, seed=3)
    joint = d.groupBy("draw").agg(F.count_if(F.col("realized") == 0).alias("idle"))
    assert joint.where("idle = 1").count() == 0  # both deploy or neither does
    assert joint.where("idle = 2").count() > 0


def test_scenarios_change_one_thing_each(spark):
    moves = spark.range(1).select(decision.prior_settings(PRIORS).alias("p"), F.explode(decision.scenario_array(PRIORS)).alias("s"))
    made = moves.select("s.*", "p", decision.moved_prior(F.col("p"), F.col("s")).alias("q")).collect()
    assert {r["scenario"] for r in made} >= {"baseline", "forward rent off"} and len({r["scenario"] for r in made}) == len(made)
    for r in made:
        flat = [{(k, c): x for k, v in r[side].asDict(True).items() for c, x in (v if isinstance(v, dict) else {None: v}).items()}
                for side in ("p", "q")]
        changed = {k for k in flat[0] if flat[0][k] != flat[1][k]} - {("forward", None)}
        assert changed <= {(r["target"], r["class"])} and r["forward"] == (r["scenario"] != "forward rent off")
        assert changed or r["target"] is None or r["class"] is None
    with pytest.raises(ValueError):
        decision.check_priors({**PRIORS, "haircut": {"lo": 0.5, "mode": 0.4, "hi": 0.9}})


def test_uniforms_and_triangles_have_the_right_shape(spark):
    d = spark.range(20000).select(sampling.triangular(
        sampling.uniform(F.lit(1), F.col("id")), F.lit(0.0), F.lit(1.0), F.lit(3.0)).alias("t"),
        sampling.triangular(F.lit(0.4), F.lit(2.0), F.lit(2.0), F.lit(2.0)).alias("point"))
    r = d.agg(F.avg("t"), F.variance("t"), F.min("t"), F.max("t"), F.max("point")).first()
    assert r[0] == pytest.approx(4 / 3, abs=0.02) and r[1] == pytest.approx((0 + 1 + 9 - 0 - 0 - 3) / 18, abs=0.02)
    assert 0 <= r[2] and r[3] <= 3 and r[4] == 2.0


def test_rank_keeps_input_order_on_ties(spark):
    df = spark.createDataFrame([("a", 0.5, 1.0, 3), ("b", 0.5, 1.0, 1), ("c", 0.9, 0.1, 2)],
                               "constraint_id string, p_top_k double, composite_expected double, ord int")
    got = {r["constraint_id"]: r["rank"] for r in scoring.with_rank(df.repartition(3)).collect()}
    assert got == {"c": 1, "b": 2, "a": 3}
    assert scoring.top_k(2054, 0.05) == 103 and scoring.top_k(3, 0.05) == 1


def test_blank_rent_is_unobserved_only_where_the_column_exists(spark):
    rows = spark.createDataFrame([("a", 10.0, 500.0, None)], "constraint_id string, hours_binding double, shadow_price_sum double, rent_musd double")
    assert signals.congestion_ranges(rows).first()["rent"] is None
    assumed = signals.congestion_ranges(rows.drop("rent_musd")).first()["rent"]
    assert assumed["expected"] == pytest.approx(500 * 250 / 1e6) and assumed["hi"] == pytest.approx(1.5 * 500 * 1200 / 1e6)
    monthly = rows.withColumn("monthly_cost_musd", F.lit(2.0))
    assert signals.congestion_ranges(monthly).first()["rent"]["expected"] == 24.0


def test_unobserved_is_not_zero_evidence(spark):
    c = spark.createDataFrame([("a", "thermal", None)], "constraint_id string, ctype string, monitored_line string")
    empty = signals.congestion_ranges(spark.createDataFrame([], "constraint_id string, hours_binding double, rent_musd double"))
    loading = spark.sql("SELECT 'a' constraint_id, 'unmapped_monitored' status, named_struct('lo',0D,'expected',0D,'hi',0D) loading")
    near = spark.createDataFrame([], "line_id string, mw double")
    plans = signals.planning_items(spark.createDataFrame([], "constraint_id string, plan string, proposed_fix string, assigned_cost_musd double, ord int"))
    seen = signals.build_signals(c, empty, loading, near, plans).first()
    gone = signals.build_signals(c, empty, loading, near, plans, table_coverage={"congestion": "unobserved"}).first()
    assert seen["cov_rent"] == "observed" and seen["sig_rent"]["hi"] == 0.05
    assert gone["cov_rent"] == "unobserved" and gone["sig_rent"]["hi"] == 0.0


def test_contingency_tri_states(spark):
    rows = [("BASE", None, None), (None, None, None), (None, None, "L1"), ("K", "AB:X Y:115", None), ("K", "AB:X:115", None), ("K", "XF 1", None)]
    df = spark.createDataFrame(rows, "name string, facility string, line string")
    base = remedies.base_case(F.col("name"), F.col("facility"), F.col("line"))
    got = [tuple(r) for r in df.select(base.alias("b"), remedies.branch_outage(base, F.col("facility"), F.col("line")).alias("o")).collect()]
    assert got == [(True, None), (None, None), (False, True), (False, True), (False, False), (False, True)]


def test_shares_and_bands_equal_a_full_sort_of_all_draws(spark):
    rng = random.Random(8)
    rows = [(f"F{i}", rng.uniform(0, 1) ** 3, rng.uniform(0, 0.4)) for i in range(400)]
    df = spark.createDataFrame(rows, "constraint_id string, x double, y double")
    df = df.select("constraint_id", *[numeric.spread(F.col("x") * F.lit(1 + i), 0.05 + 0.01 * i).alias(f"sig_{n}")
                                      for i, n in enumerate(fixed.SIGNALS)])
    draws = 60
    got = {r["constraint_id"]: r for r in scoring.rank_stability(df, draws=draws, top_fraction=0.05, seed=4).collect()}
    d = scoring.composite_draws(df, draws=draws, seed=4).toPandas()
    best = d.sort_values(["draw", "composite", "constraint_id"], ascending=[True, False, True]).groupby("draw").head(20)
    share = (best.groupby("constraint_id").size() / draws).to_dict()
    for cid, values in d.groupby("constraint_id")["composite"]:
        mine = got[cid]
        assert mine["p_top_k"] == pytest.approx(share.get(cid, 0.0))
        for k, p in (("lo", 5), ("expected", 50), ("hi", 95)):
            assert mine[f"composite_{k}"] == pytest.approx(np.percentile(values, p), abs=1e-12)


def test_shares_settle_ties_and_few_rows(spark):
    rows = [(f"F{i:02}", d, float(i // 4)) for i in range(12) for d in range(1, 6)] + []
    df = spark.createDataFrame(rows, "constraint_id string, draw int, v double")
    got = {r["constraint_id"]: r["p_top_k"] for r in scoring.band_and_share(df, "v", 6, 5).collect()}
    assert got == {f"F{i:02}": float(i >= 8 or i in (4, 5)) for i in range(12)}
    none = {r["constraint_id"]: r["p_top_k"] for r in scoring.band_and_share(df, "v", 12, 5, positive_only=True).collect()}
    assert none == {f"F{i:02}": float(i >= 4) for i in range(12)}
    one = scoring.band_and_share(df.where("constraint_id = 'F00'"), "v", 1, 5).first()
    assert one["p_top_k"] == 1.0 and one["lo"] == one["hi"] == 0.0
