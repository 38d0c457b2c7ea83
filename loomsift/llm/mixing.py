"""Mixing sources to target weights by capped water-filling.

Sizes are bytes of text. A source may be repeated `max_epochs` times at most.
Where its share of the budget asks for more, it is clamped there, and what it
can't take is spread over the others in proportion to their weights, until no
source is over its cap. In order of cap / weight the clamped sources are a
prefix, so one ordered pass finds the fixed point of that loop exactly, in
integer arithmetic. A source's epochs are then a whole number of copies of
each document and a fraction, for which a seeded hash of doc_id draws.

Without given weights a source weighs size ** 0.75, which lifts small sources;
without a given budget, it is the least at which no source is cut below one
epoch, so that mixing repeats documents and loses none.

Defined results:
* A null source is a source of its own; a source that given weights don't name
  (or with weight 0 or less) takes no part, and its rows go.
* A null or empty text has no bytes, and is repeated as its source is; a source
  of no bytes at all stays as it is.
* Texts of any length count with all their bytes. Sources of equal size get equal
  repetitions.
* Rows with the same doc_id draw alike (a null doc_id too). Empty in, empty out.
* Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linededup import _fresh
from .state import cut

MAX_EPOCHS, SEED = 4, 29
BROADCAST_SOURCES = 100_000

#: From (source, size, weight) to (source, reps). Runs on Spark and DuckDB but for the name of a wide integer.
PLAN = """
WITH s AS (
  SELECT source, size, weight, size * {epochs} AS cap FROM {sizes} WHERE size > 0 AND weight > 0
), need AS (
  SELECT max(CAST(size AS DOUBLE) / CAST(weight AS DOUBLE)) AS lambda0 FROM s
), budget AS (
  SELECT {budget} AS total FROM s CROSS JOIN need
), o AS (
  SELECT source, size, weight, cap, total,
    sum(CAST(weight AS {big})) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, cap, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
    coalesce(sum(CAST(cap AS {big})) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, cap, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before
  FROM s CROSS JOIN budget
), c AS (
  SELECT *, CAST(cap AS {big}) * CAST(weight_left AS {big2}) <= (CAST(total AS {big}) - CAST(cap_before AS {big})) * CAST(weight AS {big2}) AS clamped FROM o
), f AS (
  SELECT coalesce(sum(CASE WHEN clamped THEN cap ELSE 0 END), 0) AS taken, sum(CASE WHEN clamped THEN 0 ELSE weight END) AS free FROM c
)
SELECT source, CASE WHEN clamped THEN CAST({epochs} AS DOUBLE)
  ELSE greatest(0, CAST(total AS DOUBLE) - CAST(taken AS DOUBLE)) * CAST(weight AS DOUBLE) / (CAST(free AS DOUBLE) * CAST(size AS DOUBLE)) END AS reps
FROM c CROSS JOIN f
"""
LEAST = "sum(CAST(floor(least(CAST(cap AS DOUBLE), lambda0 * CAST(weight AS DOUBLE))) AS BIGINT))"
WEIGHT = "CAST(floor(sqrt(CAST(size AS DOUBLE)) * sqrt(sqrt(CAST(size AS DOUBLE))) * 1000) AS BIGINT)"


def epochs(docs: DataFrame, weights: DataFrame | None = None, max_epochs: int = MAX_EPOCHS, budget: int | None = None) -> DataFrame:
    """(source, reps) for each source; weights: (source, weight) with whole weights, budget in bytes."""
    spark = docs.sparkSession
    sizes = docs.groupBy("source").agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.expr(WEIGHT))
    else:
        w = weights.select(F.col("source").alias("named"), F.col("weight").cast("long").alias("weight"))
        sizes = sizes.join(w, sizes["source"].eqNullSafe(w["named"]), "inner").drop("named")
    sizes = cut(sizes)
    total = LEAST if budget is None else f"max(CAST({int(budget)} AS BIGINT))"
    plan = spark.sql(PLAN.format(sizes="{sizes}", epochs=int(max_epochs), budget=total, big="DECIMAL(20,0)", big2="DECIMAL(18,0)"), sizes=sizes)
    return cut(plan.unionByName(sizes.where("size = 0").select("source", F.lit(1.0).alias("reps"))))


def mix(docs: DataFrame, weights: DataFrame | None = None, max_epochs: int = MAX_EPOCHS, budget: int | None = None, seed: int = SEED, copy: str | None = None) -> DataFrame:
    """docs with each row as often as its source's epochs say; the column `copy`, if named, counts the copies of a row from 1."""
    plan = epochs(docs, weights, max_epochs, budget)
    source, reps, number = _fresh(docs, "mix_source", "mix_reps", "mix_copy")
    plan = plan.select(F.col("source").alias(source), F.col("reps").alias(reps))
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs["doc_id"].cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    times = (F.floor(reps) + (draw < F.col(reps) - F.floor(reps)).cast("long")).cast("int")
    joined = docs.join(plan, docs["source"].eqNullSafe(plan[source])).where(times > 0)
    out = joined.withColumn(number, F.explode(F.sequence(F.lit(1), times)))
    return out.select(*[docs[f"`{c}`"] for c in docs.columns], *([F.col(number).alias(copy)] if copy else []))


SQL = f"""
WITH sizes AS (
  SELECT source, size, {WEIGHT} AS weight FROM (SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS size FROM documents GROUP BY source)
), plan AS ({PLAN.format(sizes="sizes", epochs=MAX_EPOCHS, budget=LEAST, big="HUGEINT", big2="HUGEINT")}),
times AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
    CAST(floor(reps) + CASE WHEN ('0x' || substr(md5('{SEED}:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0::DOUBLE < reps - floor(reps) THEN 1 ELSE 0 END AS INTEGER) AS n
  FROM documents d JOIN plan USING (source)
)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(generate_series(1, n)) AS INTEGER) AS copy FROM times WHERE n > 0
"""
