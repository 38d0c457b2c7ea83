"""Aggregates over enriched columns, run counters and evaluation scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

PERCENTILES = {"min": 0.0, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99, "max": 1.0}


def percentiles(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Nearest-rank percentiles (a rank halfway goes to the even one) and the mean, for each group.

    Ranks come from one sort within the groups, so that no group has to fit
    into an array. Without groups, the values are sorted by range and ranked
    by the sizes of the ranges before, so that no single task sorts them all.
    """
    valued = df.where(F.col(value).isNotNull()).select(*(by or []), F.col(value).cast("double").alias("v"))
    if by:
        w = Window.partitionBy(*by)
        ranked = valued.withColumn("i", F.row_number().over(w.orderBy("v")) - 1).withColumn("n", F.count("*").over(w))
    else:
        counts = valued.groupBy("v").agg(F.count("*").alias("c"))
        part = counts.repartitionByRange("v").withColumn("p", F.spark_partition_id())
        sizes = part.groupBy("p").agg(F.sum("c").alias("c")).select("p", F.coalesce(F.sum("c").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("c").over(Window.partitionBy(F.lit(0))).alias("n"))
        spread = part.join(F.broadcast(sizes), "p")  # a row for each partition
        up = F.col("before") + F.sum("c").over(Window.partitionBy("p").orderBy("v"))
        ranked = spread.withColumn("up", up).select("v", "n", "c", "up")
    picks = []
    for name, q in PERCENTILES.items():
        rank = F.bround((F.col("n") - 1) * F.lit(q)).cast("long")
        hit = F.col("i") == rank if by else (rank < F.col("up")) & (rank >= F.col("up") - F.col("c"))
        picks.append(F.max(F.when(hit, F.col("v"))).alias(name))
    mean = F.avg("v") if by else F.sum(F.col("v") * F.col("c")) / F.sum("c")
    return (ranked.groupBy(*by) if by else ranked.groupBy()).agg(*picks, mean.alias("mean"))


def counts(df: DataFrame, value: str) -> DataFrame:
    """How often each value occurs."""
    return df.groupBy(value).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """(left_edge, n) of equal bins from the least to the greatest value; the last is closed. Equal values get one unit of room around them. One scan for the range, one for the counts."""
    low, high = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "left_edge double, n long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    b = F.least(F.floor((F.col(value) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    found = df.where(F.col(value).isNotNull()).groupBy(b.alias("b")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").alias("b"))
    return every.join(found, "b", "left").select((F.lit(low) + F.col("b") * F.lit(width)).alias("left_edge"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def top_key(values: Column, threshold: float, default: str) -> Column:
    """The key of the largest value that reaches the threshold, else the default; of equal ones the first."""
    entries = F.filter(F.transform(F.map_entries(values), lambda e, i: F.struct(e["value"].alias("v"), (-i).alias("i"), e["key"].alias("k"))), lambda e: e["v"] >= threshold)
    return F.coalesce(F.array_max(entries)["k"], F.lit(default))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df, and an observation of how many rows passed, filled when an action runs."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def centred(accuracy: Column, baseline_percent: Column) -> Column:
    """A score with guessing at 0: baselines are in percent."""
    base = baseline_percent * 0.01
    return (accuracy - base) / (1.0 - base)


def roll_up(evaluations: DataFrame, tasks: DataFrame, by: str = "category") -> DataFrame:
    """Mean centred score for each model and category. evaluations: (model, scores map), tasks: (task, category, baseline)."""
    rows = evaluations.select("model", F.explode("scores").alias("task", "score")).join(tasks, "task")
    return rows.groupBy("model", by).agg(F.avg(centred(F.col("score"), F.col("baseline"))).alias("mean_score"), F.count("*").alias("tasks"))


def missing_tasks(evaluations: DataFrame, tasks: DataFrame) -> DataFrame:
    """(model, task) for tasks that an evaluation lacks."""
    return evaluations.select("model").crossJoin(tasks.select("task")).join(evaluations.select("model", F.explode(F.map_keys("scores")).alias("task")), ["model", "task"], "left_anti")


def by_task_prefix(scores: DataFrame, tasks: list[str]) -> DataFrame:
    """Mean over sub-tasks: a score counts for each task whose name is part of its own."""
    names = F.explode(F.filter(F.array(*[F.lit(t) for t in tasks]), lambda t: F.contains("key", t)))
    return scores.withColumn("task", names).groupBy("task").agg(F.avg("score").alias("score"))


def compare_runs(first: DataFrame, second: DataFrame, overlap: DataFrame) -> DataFrame:
    """Per task the difference of two runs' scores beside the share of contaminated items. All are (task, ...)."""
    return first.join(second.withColumnRenamed("score", "other"), "task").select("task", (F.col("score") - F.col("other")).alias("difference")).join(overlap, "task", "left")


def precision_recall(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Precision and recall of the best guess, and their basis, over labels of 0 and 1."""
    hit = (F.col(label) == 1) & (F.col(predicted) == 1)
    return df.agg(
        F.count("*").alias("n"),
        F.try_divide(F.count_if(hit), F.count_if(F.col(predicted) == 1)).alias("precision"),
        F.try_divide(F.count_if(hit), F.count_if(F.col(label) == 1)).alias("recall"),
    )


def token_total(manifest: DataFrame, length: int) -> DataFrame:
    return manifest.agg((F.sum("num_sequences") * length).alias("tokens"))
