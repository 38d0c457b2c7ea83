"""Pipelines from YAML: steps folded into one lazy plan, with a funnel of what each step kept.

A file is a list of {source, steps}; a step is {func, arguments, _aggregate}, or
the word commit. Steps become one DataFrame expression. Counters are observed
while the one job runs; a commit, and only that, writes and reads again. A run
that finds a finished commit goes on from there.
"""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import dataclass, field

import yaml
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import jsonl
from . import registry


@dataclass(frozen=True)
class Step:
    func: str
    arguments: dict = field(default_factory=dict)
    aggregate: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Spec:
    source: str
    steps: tuple[Step, ...]

    @classmethod
    def parse(cls, text: str, providers: dict | None = None) -> list[Spec]:
        """Specs of a file. providers: values for the argument `provider` of enrichers, by operator name. Unknown names fail here, before any data is read."""
        specs = []
        for part in yaml.safe_load(text):
            steps = []
            for raw in part["steps"]:
                if isinstance(raw, str):
                    if raw != "commit":
                        raise ValueError(f"unknown verb: {raw}")
                    steps.append(Step("commit"))
                    continue
                arguments = {k: v for k, v in raw.items() if k != "func" and not k.startswith("_")}
                if providers and raw["func"] in providers:
                    arguments["provider"] = providers[raw["func"]]
                registry.make(raw["func"], **arguments)
                steps.append(Step(raw["func"], arguments, raw.get("_aggregate", {})))
            specs.append(cls(part.get("source", ""), tuple(steps)))
        return specs


@dataclass
class Run:
    """The result of a pipeline: a lazy table, and after an action its statistics."""

    df: DataFrame
    observed: list[tuple[int, str, Observation]]
    aggregates: list[tuple[str, DataFrame]]

    def funnel(self) -> list[dict]:
        """(step, name, rows, removed, added) of each step, once an action has run; rows are those after it."""
        rows = [(i, n, o.get["rows"]) for i, n, o in self.observed]
        before = [r for _, _, r in rows[:1]] + [r for _, _, r in rows[:-1]]
        return [{"step": i, "name": n, "rows": r, "removed": max(0, b - r), "added": max(0, r - b)} for (i, n, r), b in zip(rows, before)]


def compile(df: DataFrame, spec: Spec, observe: bool = True, commit_to: str | None = None) -> Run:
    """Folds the steps over df. Neighbouring predicates stay neighbours, so Catalyst joins them into one filter; what is observed sits between, so leave that off for the leanest plan."""
    observed, aggregates = [], []

    def watch(i: int, name: str) -> None:
        nonlocal df
        if observe:
            seen = Observation()
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            observed.append((i, name, seen))

    watch(0, "input")
    for i, step in enumerate(spec.steps, 1):
        if step.func == "commit":
            if commit_to:
                # named by what was done so far, so that a changed file doesn't find another's rows
                before = json.dumps([spec.source, *[[s.func, s.arguments] for s in spec.steps[:i]]], sort_keys=True, default=lambda x: type(x).__name__)
                path = f"{commit_to.rstrip('/')}/{i:03d}-{hashlib.md5(before.encode()).hexdigest()[:12]}"
                spark = df.sparkSession
                if not jsonl.exists(spark, f"{path}/_SUCCESS"):
                    df.write.mode("overwrite").parquet(path)
                df = spark.read.parquet(path)
            continue
        df = registry.make(step.func, **step.arguments).apply(df)
        for key, how in step.aggregate.items():
            value = key
            source = df
            if "transform" in how:
                extra = {k: v for k, v in how.items() if k not in ("type", "transform")}
                source = df.select(registry.TRANSFORMS[how["transform"]](F.col(key), **extra).alias("value"))
                value = "value"
            aggregates.append((key, registry.AGGREGATORS[how["type"]](source, value)))
        watch(i, step.func)
    return Run(df, observed, aggregates)


def process(spark: SparkSession, spec: Spec, source: str, output: str, schema: str | None = None, **how) -> list[dict]:
    """JSON lines in, JSON lines and a statistics table out; returns the funnel."""
    began = time.time()
    df = jsonl.read(spark, source, schema)
    if "doc_id" not in df.columns:
        df = df.withColumn("doc_id", F.xxhash64(F.input_file_name(), *df.columns))
    run = compile(df, spec, **how)
    paths = jsonl.output_paths(output)
    jsonl.write(run.df, paths["data"], mode="overwrite")
    rows = run.funnel()
    stats = [(r["step"], r["name"], rows[max(0, i - 1)]["rows"], r["rows"], r["removed"], r["added"], time.time() - began) for i, r in enumerate(rows)]
    first, last = rows[0]["rows"], rows[-1]["rows"]
    stats.append((len(rows), "global", first, last, max(0, first - last), max(0, last - first), time.time() - began))
    spark.createDataFrame(stats, "step int, name string, pages_in long, pages_out long, removed long, added long, total_secs double").coalesce(1).write.mode("overwrite").json(paths["stats"])
    return rows


def drop_reasons(df: DataFrame, rules: dict) -> DataFrame:
    """df with `drop_reason`: the first rule (name to predicate) that a row fails, or kept. One pass over all rules."""
    reason = None
    for name, keep in rules.items():
        fails = ~F.coalesce(keep, F.lit(False))
        reason = F.when(fails, name) if reason is None else reason.when(fails, name)
    return df.withColumn("drop_reason", reason.otherwise("kept"))
