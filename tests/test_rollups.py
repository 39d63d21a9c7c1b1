"""Roll-ups by flowgate: rows shuffled once, crowded flowgates, repeated and null keys."""

import collections
import datetime as dt
import os
import random

import pytest

from checks import hours as queries
from fluxsieve.operators import rollups
from fluxsieve.session import shelved

HOURS = ("name string, contingency string, monitored string, contingent string, kind string, state string, price double, "
         "utc timestamp, month date, ord long")


def _hours(spark, n=400):
    """Hours with repeats, a flowgate that owns half of all rows, several spellings and null keys."""
    rng = random.Random(5)
    start, rows = dt.datetime(2024, 1, 31, 22), []
    for i in range(n):
        name = rng.choice(["HOT"] * 8 + ["A", "B", "C", None])
        utc = start + dt.timedelta(hours=rng.randrange(8))
        rows.append((name, rng.choice(["BASE", "BASE", "K1", None]), rng.choice(["LN X - Y", "LN Y - X", "", None]), rng.choice(["BASE", "AB:T:115", None]),
                     rng.choice(["MANUAL", "FLOWGATE"]), rng.choice(["BREACHED", "BINDING", None]), rng.choice([-1.25, 2.5, 40.0]), utc,
                     (utc - dt.timedelta(hours=1)).date().replace(day=1), i))
    return spark.createDataFrame(rows, HOURS)


def _brute(hours):
    first, out = {}, {}
    for r in sorted(hours.collect(), key=lambda r: r["ord"]):
        first.setdefault((r["utc"], r["name"], r["monitored"], r["contingency"]), r)
    flowgates = collections.defaultdict(list)
    for r in first.values():
        if r["name"] is not None and r["contingency"] is not None:
            flowgates[r["name"], r["contingency"]].append(r)

    def mode(values):
        return min(collections.Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[0]

    for key, rows in flowgates.items():
        out[key] = (len({r["utc"] for r in rows}), len({r["utc"] for r in rows if r["state"] == "BREACHED"}), len({r["month"] for r in rows}),
                    sum(abs(r["price"]) for r in rows), max(abs(r["price"]) for r in rows), mode(r["monitored"] for r in rows),
                    len({r["monitored"] for r in rows}), mode(r["contingent"] for r in rows), mode(r["kind"] for r in rows))
    return out


@pytest.mark.parametrize("few", [0, 100_000])
def test_flowgates_of_crowded_and_other_rows(spark, monkeypatch, few):
    monkeypatch.setattr(rollups, "FEW", few)
    hours = _hours(spark)
    assert len(rollups.by_flowgate(hours)) == (2 if few == 0 else 1)
    fields = ["name", "contingency", "hours_binding", "breached_hours", "months_binding", "shadow_price_sum", "max_abs_shadow_price", "monitored",
              "n_monitored", "contingent", "kind"]
    got = rollups.flowgates(hours).select(fields).collect()
    wanted = _brute(hours)
    assert len(got) == len(wanted) == 8
    assert {(r[0], r[1]): tuple(x if i != 1 else (x or 0) for i, x in enumerate(tuple(r)[2:])) for r in got} == wanted


def test_parts_share_no_flowgate_and_lose_no_row(spark, monkeypatch):
    monkeypatch.setattr(rollups, "FEW", 0)
    hours = _hours(spark)
    laid, crowded = rollups.by_flowgate(hours)
    assert laid.unionByName(crowded).exceptAll(hours).isEmpty() and laid.count() + crowded.count() == hours.count()
    keys = [{tuple(r) for r in p.select("name", "contingency").distinct().collect()} for p in (laid, crowded)]
    assert not keys[0] & keys[1] and ("HOT", "BASE") in keys[1]


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {line.split("hashpartitioning(")[1].split(")")[0] for line in plan.split("\n") if "Exchange hashpartitioning" in line}


def test_rows_are_shuffled_by_flowgate_alone(spark):
    """However many groupings follow, hours cross the network in one layout."""
    made = _shuffles(rollups.flowgates(_hours(spark)))
    assert len({tuple(x.split("#")[0].strip() for x in s.split(", ")[:2]) for s in made}) == 1
    assert all(s.startswith("name#") and s.split(", ")[1].startswith("contingency#") and len(s.split(", ")) == 3 for s in made)


def test_dollars_share_the_layout_of_flowgates(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), "A", "BASE", "LN X - Y", -5.0, 2), (dt.date(2024, 1, 1), "A", "BASE", None, -7.0, 1)],
                                 "month date, name string, contingency string, monitored string, amount double, ord long")
    unique = rollups.united([rollups.unique_dollars(p) for p in rollups.by_flowgate(rows)])
    assert [(r["monitored"], r["amount"], float(r["usd"])) for r in unique.collect()] == [(None, -7.0, 7.0)]
    for made in (rollups.flowgate_dollars(unique), rollups.spellings(unique)):
        assert [s.split("#")[0] for s in _shuffles(made)] == ["name"]


def test_shelved_rows_go_with_their_block(spark):
    with shelved(spark.range(10)) as rows:
        folder = os.path.dirname(rows.inputFiles()[0].removeprefix("file://"))
        assert rows.count() == 10 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_spellings_join_dollars_like_the_hours(spark):
    kept = rollups.keep_first_hours(_hours(spark))
    unique = rollups.unique_dollars(spark.createDataFrame(
        [(dt.date(2024, m, 1), n, "BASE", e, -5.0 * m, m) for m in (1, 2) for n, e in (("A", "LN Y - X"), ("B", "XFMR"), ("HOT", "LN X - Y"))],
        "month date, name string, contingency string, monitored string, amount double, ord long"))
    rolled = rollups.flowgates_of(kept).select("name", "contingency", "constraint_id")
    whole, short = (rollups.join_dollars(rolled, k, unique) for k in (kept, rollups.spellings(kept)))
    assert whole.exceptAll(short).isEmpty() and short.exceptAll(whole).isEmpty()
    assert {r["constraint_id"]: (r["rent_musd"], r["flags"]) for r in short.collect()}["B|BASE"] == (None, "cbc_monitored_mismatch")


def test_hours_leave_the_shelf_before_dollars(spark, tmp_path):
    """What stays of them is a row for each flowgate and spelling."""
    from test_growth import _tables

    _tables(spark, tmp_path)
    plan = queries.join_dollars(spark, tmp_path)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_partkey" not in plan and "price" not in plan and "state" not in plan
