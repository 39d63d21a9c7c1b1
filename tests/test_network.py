import pytest
from pyspark.sql import functions as F

from fluxsieve.operators import network

TRIANGLE = [("L1", "A", "B"), ("L2", "B", "C"), ("L3", "A", "C")]


def lines_of(spark, rows):
    return network.with_reactance(spark.createDataFrame(
        [(i, f, t, 10.0, 100.0, 50.0) for i, f, t in rows],
        "line_id string, from_bus string, to_bus string, length_mi double, kv double, thermal_limit_mw double"))


# flows of a triangle of equal lines plus a stub: what goes in at a bus and out at C
PTDF = [("L1", "A", 1 / 3), ("L1", "B", -1 / 3), ("L2", "A", 1 / 3), ("L2", "B", 2 / 3), ("L3", "A", 2 / 3), ("L3", "B", 1 / 3),
        ("STUB", "D", -1.0)]


def screened(spark, rows, ptdf=PTDF):
    lines = lines_of(spark, TRIANGLE + [("STUB", "C", "D")])
    inject = spark.createDataFrame([("s", "A", 90.0), ("s", "C", -60.0), ("s", "D", -30.0)],
                                   "snapshot string, bus_id string, mw double")
    c = spark.createDataFrame(rows, "constraint_id string, monitored_line string, contingency_line string")
    table = spark.createDataFrame(ptdf, "line_id string, bus_id string, ptdf double")
    return {r["constraint_id"]: (r["status"], tuple(r["loading"])) for r in network.screen(c, lines, inject, table).collect()}


def test_screen_reroutes_islands_and_keeps_every_flowgate(spark):
    rows = [("base", "L3", None), ("outage", "L3", "L1"), ("own", "L3", "L3"), ("island", "L3", "STUB"),
            ("lost", None, "L1"), ("unknown", "L3", "NOPE")]
    got = screened(spark, rows)
    assert len(got) == len(rows)
    assert got["base"][0] == "ok" and got["base"][1][1] == pytest.approx(60 / 50)
    assert got["outage"][1][2] == pytest.approx(90 / 50)
    assert got["own"][1] == (0.0, 0.0, 0.0)
    assert got["island"][0] == "n1_disconnect" and got["island"][1] == pytest.approx((1.2 * 0.8, 1.2, 1.2 * 1.5))
    assert got["lost"] == ("unmapped_monitored", (0.0, 0.0, 0.0))
    assert got["unknown"][0] == "contingency_unmapped"


def test_lines_without_sensitivities_say_so(spark):
    got = screened(spark, [("f", "L3", None), ("g", "L1", "L3")], [p for p in PTDF if p[0] != "L3"])
    assert got["f"] == ("no_base_flows", (0.0, 1.0, 2.0)) and got["g"][0] == "contingency_unmapped"


def test_only_named_pairs_are_computed_and_ids_stay_whole(spark):
    lines = lines_of(spark, [("R:1", "R:A", "R:B"), ("R:2", "R:B", "R:C")])
    ptdf = spark.createDataFrame([("R:1", "R:A", 0.75), ("R:1", "R:B", -0.25)], "line_id string, bus_id string, ptdf double")
    pairs = spark.createDataFrame([("R:1", "R:2"), ("R:1", "R:1"), ("R:1", "R:2")], "m string, k string")
    got = {(r["m"], r["k"]): r["h"] for r in network.transfers(ptdf, lines, pairs).collect()}
    assert got == {("R:1", "R:2"): -0.25, ("R:1", "R:1"): 1.0}


def test_typical_rating_goes_to_the_nearest_voltage(spark):
    near = spark.range(1).select(network.typical_rating(F.lit(253.0)).alias("a"), network.typical_rating(F.lit(92.0)).alias("b")).first()
    assert (near["a"], near["b"]) == (500.0, 70.0)
