"""Where values come from: fact rows, source closure and the publishing gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.functions import numeric, text
from fluxsieve.session import cut

UNKNOWN = "__unknown_node__:"

FACT_TYPE = (
    "struct<value_num:double,value_txt:string,as_reported:string,unit:string,confidence:string,"
    "flags:array<string>,retrieved_at:timestamp,source:string,source_version:string,"
    "provider:string,lineage_id:string,inputs:array<string>>")


def cell_facts(rows: DataFrame, table: str, key: str, fields: list[str], stamps: DataFrame) -> DataFrame:
    """One fact row per non-blank cell: value, text as reported, id and source stamp.

    ``stamps``: table, role ('table' | 'column'), column, source, source_version,
    retrieved_at. A column stamp wins over the table's; the stamp table is tiny.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), text.blank_to_null(F.col(f).cast("string")).alias("as_reported"))
        for f in fields]))
    long = rows.select(F.col(key).alias("key"), cells.alias("c")).select("key", "c.*").where(
        "as_reported is not null")
    mine = stamps.where(F.col("table") == table)
    whole = mine.where("role = 'table'").select(
        F.struct("source", "source_version", "retrieved_at").alias("s")).scalar()
    per_column = mine.where("role = 'column'").select(
        F.col("column").alias("field"), F.struct("source", "source_version", "retrieved_at").alias("cs"))
    return long.join(per_column, "field", "left").withColumn("s", F.coalesce("cs", whole)).select(
        F.concat(F.lit(f"obs:{table}:"), F.col("key").cast("string"), F.lit(":"), "field").alias("lineage_id"),
        F.lit(table).alias("table"), "key", "field", F.col("as_reported").try_cast("double").alias("value_num"),
        "as_reported", "s.source", "s.source_version", "s.retrieved_at",
        F.array().cast("array<string>").alias("inputs"))


def derived_values(values: DataFrame, label: Column, inputs: str, stage: str, version: str = "derived") -> DataFrame:
    """Give derived values an id, a stage and distinct inputs; rows without inputs stay visible
    through ``values_without_inputs``."""
    parents = F.array_distinct(F.filter(F.col(inputs), lambda i: i.isNotNull() & (i != "")))
    return values.withColumn("inputs", parents).withColumn(
        "lineage_id", numeric.derived_id(label, F.col("inputs"))).withColumn(
        "source", F.lit(stage)).withColumn("source_version", F.lit(version))


def values_without_inputs(values: DataFrame) -> DataFrame:
    return values.where(F.coalesce(F.size("inputs"), F.lit(0)) <= 0)


def freshness(times: Column) -> Column:
    """A derived value is as fresh as its freshest input."""
    return F.array_max(times)


def leaves(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that cite nothing."""
    return nodes.join(edges.select(F.col("child").alias("id")), "id", "left_anti")


def dangling_inputs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Cited ids no node carries."""
    cited = edges.groupBy(F.col("parent").alias("id")).agg(F.lit(1).alias("_one")).drop("_one")
    return cited.join(nodes.select("id"), "id", "left_anti")


def source_closure(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every (node, root source) pair: sources of the leaves a node reaches.

    ``nodes``: id, source. ``edges``: child, parent. A cited id without a node becomes the
    root of an unknown source, so it can never pass for publishable. The frontier of new
    pairs moves one step per round; a node many values cite is one side of a join whose other
    side holds that node's few sources.
    """
    roots = leaves(nodes, edges).select(F.col("id").alias("node"), "source")
    unknown = dangling_inputs(nodes, edges).select(
        F.col("id").alias("node"), F.concat(F.lit(UNKNOWN), "id").alias("source"))
    frontier = cut(roots.unionByName(unknown).distinct())
    rounds = [frontier]
    links = cut(edges.select("child", "parent").distinct())
    while True:
        moved = links.join(frontier, F.col("parent") == F.col("node")).select(
            F.col("child").alias("node"), "source").distinct()
        for known in rounds:
            moved = moved.join(known, ["node", "source"], "left_anti")
        frontier = cut(moved)
        if frontier.isEmpty():
            break
        rounds.append(frontier)
        if len(rounds) > 8:
            rounds = [cut(_union(rounds))]
    return _union(rounds).join(nodes.select(F.col("id").alias("node")), "node", "left_semi")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def blocked_values(closure: DataFrame, registry: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """Values whose sources include one that is unregistered or not publishable: rows (node, source).

    ``registry``: source, publishable. ``values``: node (default: every node). An id without a node keeps
    its name, so each unresolved input can be found.
    """
    asked = closure if values is None else closure.join(values, "node", "left_semi")
    return asked.join(registry.select("source", "publishable"), "source", "left").where(
        ~F.coalesce("publishable", F.lit(False))).select("node", "source").distinct()


def blocked_sources(closure: DataFrame, registry: DataFrame) -> DataFrame:
    """Sources behind any value that may not be shared."""
    return closure.select("source").distinct().join(
        registry.select("source", "publishable"), "source", "left").where(
        ~F.coalesce("publishable", F.lit(False))).select("source")


def hidden_stamps(nodes: DataFrame, edges: DataFrame, registry: DataFrame) -> DataFrame:
    """Derived nodes stamped with a registered source that may not be shared."""
    derived = nodes.join(edges.select(F.col("child").alias("id")), "id", "left_semi")
    return derived.join(registry.where("not publishable").select("source"), "source").select("source").distinct()


def unregistered_stamps(stamps: DataFrame, registry: DataFrame) -> DataFrame:
    """Table stamps whose source is missing from the registry or pinned to another version."""
    pinned = registry.select("source", F.col("source_version").alias("pinned"))
    return stamps.join(pinned, "source", "left").where(
        F.col("pinned").isNull() | (F.col("pinned") != F.col("source_version"))).select(
        "table", "source", "source_version", "pinned")


def undeclared_column_sources(stamps: DataFrame) -> DataFrame:
    """Column stamps that are not a stamp of their table, or name a column that has none."""
    declared = stamps.where("role in ('table', 'contributor')").select(
        "table", "source", "source_version").distinct()
    columns = stamps.where("role = 'column'")
    foreign = columns.join(declared, ["table", "source", "source_version"], "left_anti").select(
        "table", "column", F.lit("source is not a stamp of the table").alias("why"))
    unsupported = columns.where(
        (F.col("table") != "congestion") | ~F.col("column").isin(*fixed.PER_COLUMN_STAMPED)
    ).select("table", "column", F.lit("column takes no stamp of its own").alias("why"))
    return foreign.unionByName(unsupported)


def provenance_line(observed: Column, consulted: Column, rent: Column, status: Column,
                    plan: Column) -> Column:
    """One line per score: what each part rests on, sources used, sources that gave nothing."""
    absent = F.array_sort(F.array_except(consulted, observed))
    return F.concat_ws(
        "; ", F.concat(F.lit("rent="), rent), F.concat(F.lit("loading="), status),
        F.when(plan.isNotNull(), F.concat(F.lit("planning="), plan)),
        F.concat(F.lit("data="), F.array_join(F.array_sort(F.array_distinct(observed)), ",")),
        F.when(F.size(absent) > 0, F.concat(F.lit("absent="), F.array_join(absent, ","))))


def attribution(stamps: DataFrame, coverage: DataFrame) -> DataFrame:
    """Sources with the tables they feed; those behind unobserved tables only stand apart.

    ``coverage``: table, coverage. Result: status, source, source_version, tables.
    """
    joined = stamps.select("table", "source", "source_version").distinct().join(coverage, "table")
    lists = joined.groupBy("source", "source_version").agg(
        F.array_sort(F.collect_set(F.when(F.col("coverage") != "unobserved", F.col("table")))).alias("used"),
        F.array_sort(F.collect_set(F.when(F.col("coverage") == "unobserved", F.col("table")))).alias("asked"))
    got = F.size("used") > 0
    return lists.select(
        F.when(got, "used").otherwise("nothing_obtained").alias("status"), "source", "source_version",
        F.array_join(F.when(got, F.col("used")).otherwise(F.col("asked")), ";").alias("tables"))
