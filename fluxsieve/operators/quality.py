"""Cross-provider readings: joins, majority value, invariants and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.functions import text


def keep_last(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The last row per key by an explicit input ordinal."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ordinal)).alias("_r")).select(
        *keys, "_r.*")


def line_readings(primary: DataFrame, second: DataFrame, third: DataFrame) -> DataFrame:
    """Voltage readings in long form, for lines the first provider knows.

    Each input has line_id, voltage_kv (text) and ord; blank ids and blank values count as
    missing, the last row per id wins. At most three rows per line come out.
    """
    skeleton = keep_last(primary.select("line_id", "voltage_kv", "ord"), ["line_id"], "ord")

    def readings(df, provider, position):
        kept = keep_last(
            df.select("line_id", "voltage_kv", "ord").where(text.blank_to_null(F.col("line_id")).isNotNull()),
            ["line_id"], "ord")
        return kept.where(text.blank_to_null(F.col("voltage_kv")).isNotNull()).select(
            "line_id", F.lit(provider).alias("provider"), F.lit(position).alias("position"),
            F.col("voltage_kv").alias("as_reported"),
            F.col("voltage_kv").try_cast("double").alias("kv"))

    others = [
        readings(df, fixed.PROVIDER_ORDER[i], i).join(skeleton.select("line_id"), "line_id", "left_semi")
        for i, df in ((1, second), (2, third))
    ]
    first = readings(primary, fixed.PROVIDER_ORDER[0], 0)
    return first.unionByName(others[0]).unionByName(others[1])


def provider_join(primary: DataFrame, second: DataFrame, third: DataFrame) -> DataFrame:
    """One row per line of the first provider, the other two attached where they have it."""
    a = keep_last(primary, ["line_id"], "ord").drop("ord").withColumnRenamed("voltage_kv", "kv_first")
    b = keep_last(second, ["line_id"], "ord").select("line_id", F.col("voltage_kv").alias("kv_second"))
    c = keep_last(third, ["line_id"], "ord").drop("ord").withColumnRenamed("voltage_kv", "kv_third")
    return a.join(b, "line_id", "left").join(c, "line_id", "left")


def triangulate(readings: DataFrame) -> DataFrame:
    """Majority value per line (ties to the first provider), divergence flag and confidence."""
    votes = readings.groupBy("line_id", "kv").agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("first"))
    best = votes.groupBy("line_id").agg(
        F.max_by("kv", F.struct(F.col("n"), -F.col("first"))).alias("kv"),
        F.count(F.lit(1)).alias("distinct_values"), F.sum("n").alias("n_readings"))
    verbatim = readings.groupBy("line_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("position", "provider", "as_reported"))),
        lambda r: F.concat(r["provider"], F.lit("="), r["as_reported"])), "; ").alias("as_reported"))
    confidence = (F.when(F.col("distinct_values") > 1, "low")
                  .when(F.col("n_readings") >= 3, "high").otherwise("medium"))
    flags = F.when(F.col("distinct_values") > 1, F.array(F.lit("source_divergence"))).otherwise(
        F.array().cast("array<string>"))
    return best.join(verbatim, "line_id").select(
        "line_id", "kv", F.col("n_readings").cast("bigint").alias("n_readings"),
        confidence.alias("confidence"), flags.alias("flags"), "as_reported")


def nominal(kv: Column) -> Column:
    return kv.isin(*fixed.NOMINAL_VOLTAGES)


def add_flag(flags: Column, when: Column, flag: str) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.array_union(flags, F.array(F.lit(flag)))).otherwise(flags)


def conductor_mismatch(kv: Column, conductor: Column) -> Column:
    """A 500 kV line on a 4/0 distribution conductor."""
    return (kv >= 500) & (F.trim(conductor) == "4/0")


def lowered(level: Column, flags: Column) -> Column:
    """One rung down the confidence ladder per distinct downgrade flag, floor at the bottom."""
    ladder = F.array(*[F.lit(x) for x in fixed.CONFIDENCE_LADDER])
    hits = F.size(F.array_intersect(flags, F.array(*[F.lit(x) for x in fixed.DOWNGRADE_FLAGS])))
    index = F.array_position(ladder, level).cast("int")
    return F.element_at(ladder, F.greatest(F.lit(1), index - hits))


def line_facts(readings: DataFrame, attributes: DataFrame) -> DataFrame:
    """Field facts per line in long form: (line_id, field, value, confidence, flags).

    ``attributes``: line_id, conductor, thermal_limit_mw, cost_usd (null = missing).
    """
    voltage = triangulate(readings).join(attributes, "line_id", "left")
    clash = conductor_mismatch(F.col("kv"), F.col("conductor"))
    vflags = add_flag(add_flag(F.col("flags"), ~nominal(F.col("kv")), "voltage_implausible"),
                      clash, "conductor_voltage_mismatch")
    none = F.array().cast("array<string>")
    cflags = F.when(F.coalesce(clash, F.lit(False)),
                    F.array(F.lit("conductor_voltage_mismatch"))).otherwise(none)

    def fact(field, value, level, flags):
        return F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"),
                        lowered(level, flags).alias("confidence"), flags.alias("flags"))

    prior = {k: F.lit(v) for k, v in fixed.FIELD_CONFIDENCE.items()}
    facts = F.array(
        fact("voltage_kv", F.col("kv"), F.col("confidence"), vflags),
        fact("conductor", F.col("conductor"), prior["conductor"], cflags),
        fact("thermal_limit_mw", F.col("thermal_limit_mw"), prior["thermal_limit_mw"], none),
        fact("cost_usd", F.col("cost_usd"), prior["cost_usd"], none))
    return voltage.select("line_id", F.explode(facts).alias("f")).select("line_id", "f.*").where(
        "value is not null")


def reading_facts(readings: DataFrame) -> DataFrame:
    """The raw readings as facts, flagged where the value is not a nominal voltage."""
    none = F.array().cast("array<string>")
    return readings.select(
        "line_id", F.lit("voltage_kv_raw").alias("field"), F.col("as_reported").alias("value"),
        F.lit("medium").alias("confidence"),
        add_flag(none, ~nominal(F.col("kv")), "voltage_implausible").alias("flags"))


def invariant_violations(readings: DataFrame, attributes: DataFrame) -> DataFrame:
    """Rows for every broken invariant: (invariant, line_id, field, detail)."""
    odd = readings.where(~nominal(F.col("kv"))).select(
        F.lit("voltage_in_set").alias("invariant"), "line_id", F.lit("voltage_kv").alias("field"),
        F.concat("provider", F.lit(" reports "), F.col("kv").cast("string"),
                 F.lit(" kV (not nominal)")).alias("detail"))
    clash = triangulate(readings).join(attributes, "line_id").where(
        conductor_mismatch(F.col("kv"), F.col("conductor"))).select(
        F.lit("conductor_matches_voltage").alias("invariant"), "line_id",
        F.lit("conductor").alias("field"),
        F.concat(F.col("kv").cast("string"), F.lit(" kV with conductor '"), "conductor",
                 F.lit("'")).alias("detail"))
    return odd.unionByName(clash)


def flag_report(facts: DataFrame) -> DataFrame:
    """Counts by (field, kind, name), where kind is 'flag' or 'confidence'."""
    marks = F.concat(
        F.transform("flags", lambda x: F.struct(F.lit("flag").alias("kind"), x.alias("name"))),
        F.array(F.struct(F.lit("confidence").alias("kind"), F.col("confidence").alias("name"))))
    return facts.select("field", F.explode(marks).alias("m")).groupBy(
        "field", "m.kind", "m.name").agg(F.count(F.lit(1)).alias("n"))
