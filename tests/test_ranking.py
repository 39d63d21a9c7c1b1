import numpy as np
from pyspark.sql import functions as F

from fluxsieve.operators import selection
from fluxsieve.operators.ranking import exact_percentiles, most_frequent, ordered_position


def test_positions_with_one_group_holding_most_rows(spark):
    rows = [("hot", float((i * 7919) % 1000), i) for i in range(3000)] + [(f"g{i % 5}", float(i), i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, v double, id int").repartition(7)
    got = {(r["g"], r["id"]): r["position"] for r in ordered_position(
        df, [F.col("v").desc(), F.col("id")], ["g"]).collect()}
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [got[(g, r[2])] for r in order] == list(range(1, len(order) + 1))


def test_positions_do_not_depend_on_layout(spark):
    df = spark.range(500).select("id", (F.col("id") % 13).alias("v"))
    a = ordered_position(df.repartition(3), [F.col("v"), F.col("id")]).collect()
    b = ordered_position(df.repartition(11).orderBy(F.rand(1)), [F.col("v"), F.col("id")]).collect()
    assert {r["id"]: r["position"] for r in a} == {r["id"]: r["position"] for r in b}


def test_percentiles_equal_linear_interpolation(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(400, 5.0), rng.lognormal(size=700)])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0), ("b", 2.0)] + [("b", None)],
                               "g string, v double")
    points = [0.0, 0.05, 0.5, 0.99, 1.0]
    got = {(r["g"], r["p"]): (r["v"], r["n"]) for r in exact_percentiles(df, "v", points, ["g"]).collect()}
    for p in points:
        assert abs(got[("a", p)][0] - np.percentile(values, 100 * p)) < 1e-12
        assert got[("b", p)] == (1.0 + p, 2)
    whole = exact_percentiles(df.where("g = 'a'"), "v", [0.5]).first()
    assert abs(whole["v"] - np.median(values)) < 1e-12


def test_most_frequent_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", "a"), ("k", "c")], "k string, v string")
    assert most_frequent(df, ["k"], "v").first()["v"] == "a"


def test_kth_rows_equal_sorting(spark, monkeypatch):
    monkeypatch.setattr(selection, "CLASSES", 4)
    monkeypatch.setattr(selection, "FEW", 5)
    rng = np.random.default_rng(5)
    rows = [("hot", float(v), f"i{i:04}") for i, v in enumerate(rng.lognormal(sigma=4, size=400))]
    rows += [("hot", 0.0, f"z{i:04}") for i in range(300)] + [("wide", v, f"w{i}") for i, v in enumerate((-1.7e308, 1.7e308, 0.0, 1.0, 1.0))]
    rows += [("one", 7.0, "a"), ("one", None, "b")]
    df = spark.createDataFrame(rows, "g string, v double, id string")
    places = (1, 2, 20, 390, 401, 650, 5000)
    wanted = spark.createDataFrame([(g, k) for g in ("hot", "wide", "one", "none") for k in places], "g string, k int")
    got = {(r["g"], r["k"]): (r["v"], r["id"]) for r in selection.kth_rows(df, "v", "id", wanted, ["g"]).collect()}
    assert len(got) == 3 * len(places)
    for (g, k), found in got.items():
        order = sorted((r[1:] for r in rows if r[0] == g and r[1] is not None), key=lambda r: (-r[0], r[1]))
        assert found == order[min(k, len(order)) - 1]
