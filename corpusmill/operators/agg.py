"""Aggregations for reports: subtotals, votes, quantiles by index, gaps in numberings, nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_total(df: DataFrame, by: str, aggregates: list[Column], total: str = "TOTAL") -> DataFrame:
    """Aggregates by one column and over all, the total under its own label."""
    r = df.rollup(by).agg(F.grouping(by).alias("_g"), *aggregates)
    return r.withColumn(by, F.when(F.col("_g") == 1, F.lit(total)).otherwise(F.col(by))).drop("_g")


def cross_totals(df: DataFrame, first: str, second: str) -> DataFrame:
    """Counts by both keys, by each, and over all; null marks a key that is summed over."""
    return df.cube(first, second).agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"))


def majority(votes: DataFrame, key: list[str], choice: str, weight: str, least: float = 0.8) -> DataFrame:
    """The choice that has ``least`` of the weight of its key; keys without one are dropped."""
    sums = votes.groupBy(*key, choice).agg(F.sum(weight).alias("w"))
    w = Window.partitionBy(*key)
    return sums.withColumn("share", F.col("w") / F.sum("w").over(w)).where(F.col("share") >= least)


def most_frequent(df: DataFrame, key: list[str], value: str, weight: Column | None = None) -> DataFrame:
    """The value of largest count (or weight) by key; ties to the least value."""
    n = df.groupBy(*key, value).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"))
    return n.groupBy(*key).agg(F.max_by(value, F.struct("n", (-F.col(value)).alias("v"))).alias(value), F.max("n").alias("n"))


def at_index(values: Column, share: float) -> Column:
    """The element of a sorted list at floor(n * share): a quantile by index, without interpolation."""
    return F.try_element_at(F.array_sort(values), F.floor(F.size(values) * share).cast("int") + 1)


def missing_numbers(df: DataFrame, key: str, number: str) -> DataFrame:
    """Numbers between the least and the largest of each key that don't occur."""
    g = df.groupBy(key).agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.collect_set(number).alias("s"))
    return g.select(key, "lo", "hi", F.array_sort(F.array_except(F.sequence("lo", "hi"), "s")).alias("missing"))


def accuracy(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Share of rows on which two columns agree, null-safe, for each named pair."""
    return df.agg(*(F.avg(F.col(a).eqNullSafe(F.col(b)).cast("int")).alias(n) for n, (a, b) in pairs.items()), F.count(F.lit(1)).alias("n"))


def top_templates(df: DataFrame, text: Column, length: int, k: int) -> DataFrame:
    """The k most frequent texts with digits folded, cut to ``length``; ties by text."""
    t = F.substring(F.regexp_replace(text, "[0-9]+", "N"), 1, length)
    return df.groupBy(t.alias("template")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "template").limit(k)


def nested(df: DataFrame, by: list[str], items: str, fields: list[str], order: list[str]) -> DataFrame:
    """One JSON array for each group, its objects in an order."""
    objects = F.transform(F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order]))), lambda x: F.struct(*(x[f].alias(f) for f in fields)))
    return df.groupBy(*by).agg(F.to_json(objects).alias(items))


def estimate_remaining(done: Column, total: Column, spent_hours: Column, tokens: Column, price: Column) -> dict[str, Column]:
    """Pace, hours left and cost of a running batch; null where nothing is done yet."""
    pace = done / F.nullif(spent_hours, F.lit(0.0))
    return {"pace": pace, "hours_left": (total - done) / F.nullif(pace, F.lit(0.0)), "tokens_each": tokens / F.nullif(done, F.lit(0)), "cost": tokens * price}
