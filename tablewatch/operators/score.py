"""Scorecards over check results and A/B deltas over eval results.

Scores use integer half-up rounding so every engine gives the same number:
credits are counted in half-weights (pass = 2, partial = 1, fail = 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severity weights, outcome credits (in halves) and score bands.
SEVERITY_WEIGHT = {"high": 5, "medium": 3, "low": 1}
OUTCOME_HALVES = {"pass": 2, "partial": 1, "fail": 0}
OUTCOME_RANK = {"pass": 0, "partial": 1, "fail": 2}
BANDS = [(90, "Excellent"), (75, "Healthy"), (60, "Needs attention"), (40, "At risk"), (0, "Critical")]


def _map(col: Column, mapping: dict) -> Column:
    out = F.lit(None)
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)).otherwise(out)
    return out


def collapse_findings(results: DataFrame, keys: list[str]) -> DataFrame:
    """One outcome per check: the worst outcome of its findings (a check fails once)."""
    rank = _map(F.col("outcome"), OUTCOME_RANK)
    assessed = F.col("outcome").isin(*OUTCOME_RANK.keys())
    g = results.groupBy(*keys, "check_id", "area", "severity").agg(
        F.max(F.when(assessed, rank)).alias("worst"), F.count_if(assessed & (rank > 0)).alias("offenders"),
        F.max(F.when(F.col("outcome") == "manual", 1).otherwise(0)).alias("manual"))
    inv = {v: k for k, v in OUTCOME_RANK.items()}
    outcome = F.when(F.col("manual") == 1, "manual").when(F.col("worst").isNull(), "unassessed") \
        .otherwise(_map(F.col("worst"), inv))
    return g.select(*keys, "check_id", "area", "severity", outcome.alias("outcome"), "offenders")


def _score(weight: Column, halves: Column) -> Column:
    """round(100 * credit / weight) half up, in integers; credit = halves / 2."""
    return F.when(weight > 0, F.floor((F.lit(100) * halves + weight) / (F.lit(2) * weight)).cast("long"))


def _weights(collapsed: DataFrame) -> DataFrame:
    w = _map(F.col("severity"), SEVERITY_WEIGHT)
    h = _map(F.col("outcome"), OUTCOME_HALVES)
    assessed = F.col("outcome").isin(*OUTCOME_HALVES.keys())
    return collapsed.withColumn("w", F.when(assessed, w).otherwise(0)).withColumn(
        "h", F.when(assessed, w * h).otherwise(0)).withColumn("assessed", assessed)


def health_score(collapsed: DataFrame, keys: list[str]) -> DataFrame:
    x = _weights(collapsed)
    g = x.groupBy(*keys).agg(F.sum("w").alias("weight"), F.sum("h").alias("halves"),
                             F.count_if("assessed").alias("assessed_checks"))
    return g.select(*keys, "assessed_checks", _score(F.col("weight"), F.col("halves")).alias("score"))


def area_scores(collapsed: DataFrame, keys: list[str]) -> DataFrame:
    """Same formula per area; areas with nothing assessable are dropped."""
    x = _weights(collapsed)
    g = x.groupBy(*keys, "area").agg(F.sum("w").alias("weight"), F.sum("h").alias("halves"))
    return g.where(F.col("weight") > 0).select(*keys, "area", _score(F.col("weight"), F.col("halves")).alias("score"))


def coverage(collapsed: DataFrame, keys: list[str], provisional_below: int = 60) -> DataFrame:
    """Assessed / assessable checks (manual checks are never assessable), provisional flag."""
    assessable = F.col("outcome") != "manual"
    assessed = F.col("outcome").isin(*OUTCOME_HALVES.keys())
    g = collapsed.groupBy(*keys).agg(F.count_if(assessable).alias("assessable"),
                                     F.count_if(assessed).alias("assessed"))
    pct = F.when(F.col("assessable") > 0, F.floor((F.col("assessed") * 200 + F.col("assessable"))
                                                   / (F.col("assessable") * 2)).cast("long"))
    return g.select(*keys, "assessable", "assessed", pct.alias("coverage_pct"),
                    F.coalesce(pct < provisional_below, F.lit(True)).alias("provisional"))


def score_bands(scores: DataFrame, score_col: str = "score") -> DataFrame:
    band = F.lit(None).cast("string")
    for lo, name in reversed(BANDS):
        band = F.when(F.col(score_col) >= lo, F.lit(name)).otherwise(band)
    return scores.withColumn("band", band)


def pass_rate(assertions: DataFrame, keys: list[str]) -> DataFrame:
    """passed / coded per case; manual assertions excluded; null when nothing is coded."""
    coded = F.col("kind") == "coded"
    g = assertions.groupBy(*keys).agg(F.count_if(coded).alias("coded"),
                                      F.count_if(coded & F.col("passed")).alias("passed"))
    rate = (F.col("passed").cast("decimal(18,6)") / F.when(F.col("coded") > 0, F.col("coded")))
    return g.select(*keys, "coded", "passed", rate.cast("decimal(18,4)").cast("double").alias("pass_rate"))


def config_stats(per_case: DataFrame, config_col: str, metrics: list[str]) -> DataFrame:
    """Mean and sample stddev per config (stddev only when more than one case)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_sd")]
    g = per_case.groupBy(config_col).agg(*aggs)
    out = [config_col, "n"]
    for m in metrics:
        out += [F.col(f"{m}_mean").cast("decimal(18,4)").cast("double").alias(f"{m}_mean"),
                F.when(F.col("n") > 1, F.col(f"{m}_sd")).cast("decimal(18,4)").cast("double").alias(f"{m}_sd")]
    return g.select(*out)


def config_delta(stats: DataFrame, config_col: str, metrics: list[str], with_value: str, without_value: str) -> DataFrame:
    """with minus without, per metric mean (one conditional aggregate)."""
    aggs = []
    for m in metrics:
        c = f"{m}_mean"
        aggs.append((F.max(F.when(F.col(config_col) == with_value, F.col(c)))
                     - F.max(F.when(F.col(config_col) == without_value, F.col(c))))
                    .cast("decimal(18,4)").cast("double").alias(f"{m}_delta"))
    return stats.agg(*aggs)
