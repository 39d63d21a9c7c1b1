"""The sweep of the priors: the same as one decision per scenario, worked out once for scenarios that agree on a class."""

import copy
import itertools
import random

from pyspark.sql import functions as F

from checks.scoring import FORWARD, PRIORS
from fluxsieve import fixed
from fluxsieve.functions import numeric
from fluxsieve.plans import decision
from fluxsieve.plans.scoring import top_k
from fluxsieve.session import shelve

RATIO = numeric.interpolated_mean(decision.quantile_points(FORWARD))


def _flow(spark, rows):
    rng = F.struct(*[(F.col("x") * f).alias(n) for n, f in (("lo", 0.6), ("expected", 1.0), ("hi", 1.5))])
    return spark.createDataFrame(rows, "constraint_id string, evidence string, x double, months_binding int").select(
        "constraint_id", "evidence", F.when(F.col("x").isNotNull(), rng).alias("rent"), "months_binding")


def _priors():
    """Every scenario's name, priors as plain numbers and whether rent is carried forward."""
    start = decision._prior_values(PRIORS, True)
    yield "baseline", start, True
    yield "forward rent off", start, False
    for knob in decision.knobs(PRIORS):
        for end, side in (("lo", "low"), ("hi", "high")):
            if knob[side] == knob["was"]:
                continue
            moved = copy.deepcopy(start)
            if knob["class"] is None:
                moved[knob["target"]] = knob[side]
                yield f"{knob['title']} at {end}", moved, True
            else:
                moved[knob["target"]][knob["class"]] = knob[side]
                yield f"{knob['title']} {knob['was']:.2f}->{knob[side]:.2f}", moved, True


def _value(p, forward, cls, x, months):
    if cls not in fixed.EVIDENCE_CLASSES:
        return None
    rent = x * (min(max(months, 0), 12) / 12.0) * RATIO if forward else (x * 0.6 + x + x * 1.5) / 3.0
    relief = [p[f"u{i}"] * p[f"scale{i}"][cls] for i in range(3)]
    gain = p["h"] * rent
    mu = [relief[i] * gain - p[f"c{i}"] for i in range(3)]
    mu.append((1.0 - (1.0 - relief[0]) * (1.0 - relief[1])) * gain - p["c0"] - p["c1"])
    total = 0.0
    for a in itertools.product((False, True), repeat=3):
        w = 1.0
        for i in range(3):
            w *= p[f"app{i}"][cls] if a[i] else 1.0 - p[f"app{i}"][cls]
        total += w * max([0.0] + [mu[i] for i in range(3) if a[i]] + ([mu[3]] if a[0] and a[1] else []))
    return total


def test_sweep_equals_a_decision_per_scenario(spark):
    rng = random.Random(3)
    rows = [(f"F{i:03}", rng.choice([*fixed.EVIDENCE_CLASSES, "other", None]), rng.choice([None, rng.lognormvariate(1, 2), 0.01]), rng.randrange(14))
            for i in range(500)]
    known = [r for r in rows if r[2] is not None]
    k, tops, wanted = top_k(len(known), 0.05), {}, {}
    for name, p, forward in _priors():
        found = {r[0]: _value(p, forward, *r[1:]) for r in known}
        order = sorted((i for i, v in found.items() if v is not None), key=lambda i: (-found[i], i))
        tops[name] = [set(order[:n]) for n in (10, 20, k)]
        wanted[name] = (*[len(a & b) for a, b in zip(tops[name], tops["baseline"])], sum(v is not None and v > 0 for v in found.values()))
    got = {r["scenario"]: tuple(r)[1:] for r in decision.sensitivity_sweep(_flow(spark, rows), PRIORS, FORWARD).collect()}
    assert got == wanted and len({w[2] for w in wanted.values()}) > 2


def test_scenarios_that_agree_on_a_class_share_its_rows(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(decision, "shelve", lambda df: kept.append(shelve(df)) or kept[-1])
    rows = [(f"F{i}", "line_n1", 1.0 + i, 3) for i in range(30)]
    swept = decision.sensitivity_sweep(_flow(spark, rows), PRIORS, FORWARD)
    scenarios = swept.count()
    shared = next(k for k in kept if k.columns == ["constraint_id", "scenario", "ev_mean"])
    # the baseline, rent not carried forward, 14 ends of triangles and six shares of the class
    assert shared.count() == 22 * len(rows) and scenarios > 2 * 22
    assert shared.select(F.explode("scenario")).count() == scenarios * len(rows)


def test_decisions_are_plain_arithmetic(spark):
    made = decision.decide(_flow(spark, [("a", "line_n1", 2.0, 3)]), PRIORS, FORWARD)
    assert "lambda" not in made.select("ev_mean", "p_best_dlr", "ev_from_c")._jdf.queryExecution().optimizedPlan().toString()
