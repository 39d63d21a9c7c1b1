"""Work that must not be repeated per draw, per input or per pass."""

import datetime as dt
import time

from pyspark.sql import functions as F

from checks import scoring, views
from fluxsieve.functions import sampling
from fluxsieve.operators.selection import within
from fluxsieve.plans import corridors, decision
from fluxsieve.plans.scoring import spread_for_draws
from fluxsieve.session import cut, shelve
from fluxsieve.sources import records


def test_uniforms_of_chunks_equal_those_of_digests(spark):
    draws, blocks = sampling.CHUNK + 3, 2
    ids = spark.createDataFrame([("C1|K1", "é" * 70), (None, "x"), ("", None)], "id string, other string")
    chunks = ids.withColumn("first", F.explode(sampling.chunk_starts(draws)))
    made = chunks.withColumn("u", sampling.portable_uniforms(7, draws, blocks, F.col("first"), F.col("id"), F.lit("e"), F.col("other")))
    each = made.withColumn("draw", F.explode(sampling.chunk_draws(F.col("first"), draws)))
    digest = lambda b: sampling.portable_digest(F.lit(7), F.col("draw"), F.col("id"), F.lit("e"), F.col("other"), F.lit(b))
    rows = each.select("id", "draw", *[(sampling.uniform_at(F.col("u"), blocks, F.col("draw"), F.col("first"), i) == sampling.portable_uniform(
        digest(i // 3), i % 3)).alias(f"same{i}") for i in range(6)]).collect()
    assert len(rows) == 3 * draws
    assert len({(r["id"], r["draw"]) for r in rows}) == 3 * draws
    assert all(r[f"same{i}"] for r in rows for i in range(6))


def test_rows_joined_by_id_are_spread_again(spark):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("constraint_id"))
    grouped = ids.groupBy("constraint_id").agg(F.count(F.lit(1)).alias("n"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spread_for_draws(grouped).rdd.getNumPartitions() > least


def _tables(spark, folder):
    """Parts that repeat, lines without part, supplier or date, and lines that repeat an hour."""
    day = dt.datetime(2024, 1, 31)
    parts = [(1, "Brand#1", "STEEL", 1), (1, "Brand#2", "TIN", 8), (2, "Brand#3", "STEEL", 6), (37, "Brand#4", "TIN", 20)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    lines = [(o, p, s, n, float(q), 1000.0 + o, 0.06 if o % 2 else 0.01, "RAN"[o % 3], "FO"[o % 2], d)
             for o, (p, s, n, q, d) in enumerate([
                 (1, 1, 1, 10, day), (1, 1, 1, 50, day), (1, 6, 2, 10, day + dt.timedelta(1)), (2, 5, 7, 46, day), (2, None, 3, 1, day),
                 (None, 1, 1, 1, day), (37, 2, 4, 3, None), (37, 2, 4, 9, day), (37, 2, 4, 9, day), (2, 5, 6, 2, day), (1, 3, 5, 5, None)] * 3)]
    spark.createDataFrame(lines, (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp")).write.parquet(f"{folder}/lineitem.parquet")


def _as_written(spark, folder, name):
    text = views.with_views([name], views.SPARK) + f" SELECT * FROM {name}"
    return spark.sql(text, **{t: views.table(spark, folder, t) for t in views.TABLES if "{" + t + "}" in text})


def test_views_by_part_have_the_same_rows(spark, tmp_path):
    _tables(spark, tmp_path)
    for name in ("v_flowgates", "v_dollars_once", "v_dollars", "v_monthly"):
        found, wanted = views.view(spark, tmp_path, name), _as_written(spark, tmp_path, name)
        assert found.dtypes == wanted.dtypes
        assert found.count() == wanted.count() > 3
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_hours_are_not_expanded_for_distinct_counts(spark, tmp_path):
    _tables(spark, tmp_path)
    plan = views.view(spark, tmp_path, "v_flowgates")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_signals_read_the_hours_once(spark):
    plan = scoring._signals(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_partkey" not in plan


def test_headers_do_not_read_all_records(spark, tmp_path, monkeypatch):
    """Without a record across an edge, the body is the only pass over all records."""
    passes = []
    made = records.records_of
    monkeypatch.setattr(records, "records_of", lambda lines, start, torn, first=None: passes.append((torn, first)) or made(lines, start, torn, first))
    (tmp_path / "a.csv").write_text('\n"pre\namble"\n\r\nx,y\n1,"2\n3"\n4,5\n')
    (tmp_path / "b.csv").write_text('pre\ny,x\n7,6\n')
    (tmp_path / "c.csv").write_text('pre\nx,y\n8,"open\n')
    whole = records.read_split(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")], ("x", "y"), "t", skip=1)
    assert sorted(tuple(r)[:2] for r in whole.collect()) == [("1", "2\n3"), ("4", "5"), ("6", "7")]
    assert passes == [(False, None), (False, 2)]
    assert whole._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    torn = records.read_split(spark, str(tmp_path / "c.csv"), ("x", "y"), "t", skip=1)
    assert [r["x"] for r in torn.collect()] == ["8"]


def test_header_that_its_split_cuts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('pre\nx,y,"z' + "\n" * 300 + '"\n1,2,3\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100)
    try:
        got = records.read_split(spark, str(tmp_path / "a.csv"), ("x", "y"), "t", skip=1).select("x", "y").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r) for r in got] == [("1", "2")]


def test_ranks_are_given_to_rows_of_the_columns_in_use(spark, tmp_path):
    _tables(spark, tmp_path)
    rank = scoring.rank_flowgates(spark, tmp_path)
    plan = rank._jdf.queryExecution().optimizedPlan().toString()
    assert "get_basis" not in plan and "sig_loading" not in plan and "monitored_facility" not in plan
    whole = scoring._ranked(spark, tmp_path)
    assert "get_basis" in whole.columns
    assert sorted(map(tuple, rank.collect())) == sorted(map(tuple, whole.select(rank.columns).collect()))
    for made, names in ((scoring._export(spark, tmp_path), scoring.LISTED), (scoring._ranked(spark, tmp_path, *scoring.ROLLED), scoring.ROLLED)):
        assert made.count() == whole.count() > 3 and set(names) <= set(whole.columns)
    lines = ["rank", "constraint_id", "physical_corridor", "p_top_k", "composite_expected", "rent_musd", "get_shown", "get_set", "ev_mean_musd"]
    export = corridors.export_rows(whole).select(lines)
    assert export.exceptAll(scoring._export(spark, tmp_path).select(lines)).isEmpty()


def test_shelved_rows_are_columns_on_disk(spark):
    rows = spark.range(1000).select("id", F.struct(F.lit(None).cast("double").alias("x")).alias("s"), F.lit("t" * 100).alias("t"))
    shelved = shelve(rows)
    assert shelved.dtypes == rows.dtypes and shelved.exceptAll(rows).isEmpty() and shelved.count() == 1000
    # the pruned scan says so: t is not read
    assert "t#" not in shelved.select("id")._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert shelve(rows.where("id < 0")).dtypes == rows.dtypes


def _broadcasts_off(spark, made):
    """Operators of the plan of ``made()`` when Spark broadcasts nothing by itself."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return made()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


def test_rows_stay_where_ranges_of_few_groups_are_looked_up(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("_v"))
    ranges = spark.createDataFrame([(0, 1.0, 9.0)], "g long, _lo double, _hi double")
    plan = _broadcasts_off(spark, lambda: within(rows, ranges, ["g"]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert sorted(r["_v"] for r in within(rows, ranges, ["g"]).collect()) == [3.0, 6.0, 9.0]


def test_lines_are_joined_before_rows_are_wide(spark, tmp_path):
    """The six tables are shuffled by the flowgate once, and only flowgates by their line."""
    _tables(spark, tmp_path)
    plan = _broadcasts_off(spark, lambda: scoring._signals(spark, tmp_path))
    assert plan.count("hashpartitioning(constraint_id") == 4 and plan.count("hashpartitioning(monitored_line") + plan.count("hashpartitioning(line_id") <= 2


def test_sweep_keeps_its_rows_as_columns(spark, monkeypatch):
    """Rows of all scenarios are shelved and never cut."""
    kept = []
    monkeypatch.setattr(decision, "shelve", lambda df: kept.append(df.columns) or shelve(df))
    monkeypatch.setattr(decision, "cut", lambda df: kept.append("cut " + " ".join(df.columns)) or df)
    rng = F.struct(F.col("id").cast("double").alias("lo"), F.col("id").cast("double").alias("expected"), F.col("id").cast("double").alias("hi"))
    flow = spark.range(60).select(F.col("id").cast("string").alias("constraint_id"), F.lit("line_n1").alias("evidence"), rng.alias("rent"), F.lit(3).alias("months_binding"))
    swept = decision.sensitivity_sweep(flow, scoring.PRIORS, scoring.FORWARD)
    assert swept.where("scenario = 'baseline' AND kept_top10 = 10 AND kept_top20 = 20").count() == 1
    assert ["constraint_id", "scenario", "ev_mean"] in kept and not any("ev_mean" in k for k in kept if isinstance(k, str))


def test_shuffle_files_go_with_their_execution(spark):
    """What a finished execution has shuffled does not wait for the driver's garbage collection."""
    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return {f for f in files.split() if f.endswith(".data") and "shuffle_" in f}

    def wait(done):
        until = time.time() + 20
        while not done() and time.time() < until:
            time.sleep(0.1)
        return done()

    before = held()
    grouped = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    kept = cut(grouped)
    assert wait(lambda: held() <= before)
    assert kept.count() == 7 and len(grouped.collect()) == len(grouped.collect()) == 7
