"""Does this year's rent predict held-out months? Capture, overlap and ratio quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.functions import numeric
from fluxsieve.operators.ranking import exact_percentiles, ordered_position
from fluxsieve.session import cut

GROUP = ["predictor", "split"]


def split_predictions(monthly: DataFrame) -> DataFrame:
    """Training prediction and held-out dollars per (predictor, split, flowgate).

    ``monthly``: constraint_id, month (1..12), usd (>= 0). All splits come from one
    aggregation; the eight (predictor, split) rows are exploded from it.
    """
    usd = F.col("usd").cast("decimal(20,4)")
    sums = []
    for i, (train, held) in enumerate(fixed.MONTH_SPLITS.values()):
        in_train, in_held = F.col("month").isin(*train), F.col("month").isin(*held)
        sums += [
            F.coalesce(F.sum(F.when(in_train, usd)).cast("double"), F.lit(0.0)).alias(f"t{i}"),
            F.count_if(in_train & (F.col("usd") > 0)).alias(f"a{i}"),
            F.coalesce(F.sum(F.when(in_held, usd)).cast("double"), F.lit(0.0)).alias(f"h{i}")]
    rows = []
    for i, (name, (train, _)) in enumerate(fixed.MONTH_SPLITS.items()):
        shaped = F.col(f"t{i}") * F.col(f"a{i}") / F.lit(float(len(train)))
        for predictor, value in zip(fixed.PREDICTORS, (F.col(f"t{i}"), shaped)):
            rows.append(F.struct(
                F.lit(predictor).alias("predictor"), F.lit(name).alias("split"),
                value.alias("predicted"), F.col(f"h{i}").alias("held"), F.col(f"t{i}").alias("trained")))
    return monthly.groupBy("constraint_id").agg(*sums).select(
        "constraint_id", F.explode(F.array(*rows)).alias("r")).select("constraint_id", "r.*")


def backtest_places(predictions: DataFrame, top_fraction: float = 0.05) -> DataFrame:
    """Predictions with their predicted and best-possible place, k and the system ratio."""
    sized = predictions.groupBy(*GROUP).agg(
        numeric.top_count(F.count_if(F.col("predicted") > 0), top_fraction).alias("k"),
        (F.sum(F.col("held").cast("decimal(28,4)")).cast("double")
         / F.sum(F.col("trained").cast("decimal(28,4)")).cast("double")).alias("system"))
    guessed = ordered_position(
        predictions, [F.col("predicted").desc(), F.col("constraint_id")], GROUP, "place")
    both = ordered_position(guessed, [F.col("held").desc(), F.col("constraint_id")], GROUP, "best_place")
    return both.join(sized, GROUP)


def backtest_metrics(places: DataFrame) -> DataFrame:
    """Held-out dollars captured, overlap with the best possible, leaders that earned nothing."""
    top, oracle = F.col("place") <= F.col("k"), F.col("best_place") <= F.col("k")
    held = F.col("held").cast("decimal(28,4)")
    return places.groupBy(*GROUP).agg(
        F.first("k").cast("bigint").alias("k"),
        (F.sum(F.when(top, held)).cast("double") / F.sum(F.when(oracle, held)).cast("double")).alias("capture"),
        (F.count_if(top & oracle) / F.first("k")).alias("overlap"),
        F.count_if(top & (F.col("held") == 0)).alias("leaders_realizing_zero"))


def leader_ratios(places: DataFrame) -> DataFrame:
    """Realized over predicted of the leaders, normalized by the whole system's ratio."""
    return places.where(F.col("place") <= F.col("k")).select(
        "predictor", "split", "constraint_id",
        (F.col("held") / F.col("predicted") / F.col("system")).alias("ratio"))


def ratio_quantiles(ratios: DataFrame) -> DataFrame:
    """Quantiles of the leaders' ratios, three significant figures; p = 1 repeats p = 0.99."""
    got = exact_percentiles(ratios, "ratio", list(fixed.QUANTILE_POINTS), ["predictor"])
    points = F.when(F.col("p") == 0.99, F.array(F.lit(0.99), F.lit(1.0))).otherwise(F.array("p"))
    return got.select("predictor", F.explode(points).alias("p"),
                      numeric.significant(F.col("ratio"), 3).alias("value"))


def quantile_mean(quantiles: DataFrame) -> DataFrame:
    """Mean of the interpolated quantile function per predictor (ten points each)."""
    points = F.array_sort(F.collect_list(F.struct("p", "value")))
    packed = quantiles.groupBy("predictor").agg(points.alias("q"))
    area = F.aggregate(
        F.sequence(F.lit(1), F.size("q") - 1), F.lit(0.0),
        lambda acc, i: acc + (F.get("q", i)["p"] - F.get("q", i - 1)["p"])
        * (F.get("q", i)["value"] + F.get("q", i - 1)["value"]) / 2)
    return packed.select("predictor", area.alias("mean"))


def best_predictor(metrics: DataFrame) -> str:
    """The predictor with the highest mean held-out capture."""
    return metrics.groupBy("predictor").agg(F.avg("capture").alias("c")).orderBy(
        F.col("c").desc(), "predictor").first()["predictor"]


def forward_rent_settings(monthly: DataFrame, top_fraction: float = 0.05) -> dict:
    """Forward-rent settings for ``plans.decision`` derived from monthly dollars."""
    places = cut(backtest_places(split_predictions(monthly), top_fraction))
    predictor = best_predictor(backtest_metrics(places))
    rows = ratio_quantiles(leader_ratios(places)).where(F.col("predictor") == predictor).collect()
    return {"predictor": predictor, "ratio_quantiles": {str(r["p"]): r["value"] for r in rows}}
