"""Ordered operators: islands, blocks, chains, intervals, runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import cut


def numbered(df: DataFrame, order: list, prefix: str, width: int, into: str) -> DataFrame:
    """Formatted ids by rank in a total order.

    Ranks over a whole table without one task sorting it all: rows are range-partitioned and sorted, counted by partition, and
    numbered from their partition's offset.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()))
    counts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))  # a row a partition
    out = dealt.join(F.broadcast(offsets), "__part")
    rank = (F.col("__offset") + F.col("__row") - F.col("__first") + 1).cast("string")
    return out.withColumn(into, F.concat(F.lit(prefix), F.lpad(rank, width, "0"))).drop("__part", "__row", "__first", "__offset")


def islands(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """Runs of consecutive numbers: key, lo, hi, n."""
    w = Window.partitionBy(*key).orderBy(value)
    g = df.select(*key, value).distinct().withColumn("_g", F.col(value) - F.row_number().over(w))
    return g.groupBy(*key, "_g").agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("n")).drop("_g")


def blocks(df: DataFrame, key: list[str], order: list, header: Column, into: str = "block") -> DataFrame:
    """Numbers each row by the headers at or before it: a header opens a block that lasts until the next; 0 before the first."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(into, F.sum(header.cast("int")).over(w))


def clear_best(df: DataFrame, key: list[str], score: str, tie: str, ratio: float) -> DataFrame:
    """The best row of each key where it beats the second by ``ratio``; keys with one row pass."""
    w = Window.partitionBy(*key).orderBy(F.desc(score), tie)
    r = df.withColumn("_r", F.row_number().over(w)).withColumn("second", F.lead(score).over(w))
    return r.where((F.col("_r") == 1) & (F.col("second").isNull() | (F.col(score) >= ratio * F.col("second")))).drop("_r")


def impute_between(df: DataFrame, key: list[str], order: list, value: str, into: str) -> DataFrame:
    """Fills a missing number whose neighbours leave exactly one place for it; two passes."""
    w = Window.partitionBy(*key).orderBy(*order)
    out = df.withColumn(into, F.col(value))
    for _ in range(2):
        before, after = F.lag(into).over(w), F.lead(into).over(w)
        filled = F.when(after == before + 2, before + 1).when(after.isNull() & before.isNotNull(), before + 1).when(before.isNull() & after.isNotNull(), after - 1)
        out = out.withColumn("_f", filled).withColumn(into, F.coalesce(into, "_f")).drop("_f")
    return out


def once_only(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key occurs once."""
    return df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key))).where("_n = 1").drop("_n")


def increasing(numbers: Column) -> Column:
    """Of numbers in reading order, those that continue the chain of accepted ones by 1 or 2, from the first."""
    return F.aggregate(
        F.slice(numbers, F.lit(2), F.greatest(F.size(numbers), F.lit(0))),
        F.slice(numbers, F.lit(1), F.lit(1)),
        lambda acc, x: F.when((x == F.element_at(acc, -1) + 1) | (x == F.element_at(acc, -1) + 2), F.concat(acc, F.array(x))).otherwise(acc),
    )


def coalesce_intervals(df: DataFrame, key: list[str], lo: str, hi: str, slack: float = 0.0, *also: Column) -> DataFrame:
    """Intervals that overlap or lie within ``slack`` become one: key, lo, hi, n, and the aggregates ``also``."""
    w = Window.partitionBy(*key).orderBy(lo, hi)
    reach = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    m = df.withColumn("_new", (F.coalesce(F.col(lo) > reach + slack, F.lit(True))).cast("int"))
    m = m.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return m.groupBy(*key, "_g").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"), F.count(F.lit(1)).alias("n"), *also).drop("_g")


def gaps(df: DataFrame, key: list[str], lo: str, hi: str) -> DataFrame:
    """What lies between intervals and in none of them: key, gap_lo, gap_hi."""
    w = Window.partitionBy(*key).orderBy(lo, hi)
    reach = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.select(*key, reach.alias("gap_lo"), F.col(lo).alias("gap_hi")).where("gap_lo < gap_hi")


def runs(df: DataFrame, key: list[str], order: list, style: list[str], text: str) -> DataFrame:
    """Neighbours of equal style joined: key, run, style, text, n."""
    w = Window.partitionBy(*key).orderBy(*order)
    changed = F.lit(False)
    for s in style:
        changed = changed | ~F.lag(s).over(w).eqNullSafe(F.col(s))
    first = F.row_number().over(w) == 1
    g = df.withColumn("_k", F.row_number().over(w)).withColumn("_c", (changed | first).cast("int")).withColumn("run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", F.col(text).alias("t")))), lambda x: x["t"]), " ")
    return g.groupBy(*key, "run", *style).agg(texts.alias("text"), F.count(F.lit(1)).alias("n"))


def paragraphs(lines: DataFrame, key: list[str], order: str, text: str, width: int) -> DataFrame:
    """Lines joined to paragraphs: a new one starts after a blank line or a short line that ends a sentence; a hyphen at a line's
    end joins without a space."""
    w = Window.partitionBy(*key).orderBy(order)
    before = F.lag(text).over(w)
    start = before.isNull() | (F.trim(before) == "") | ((F.length(before) < 0.6 * width) & before.rlike(r"[.!?:]\s*$"))
    p = lines.withColumn("_s", start.cast("int")).withColumn("paragraph", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where(F.trim(text) != "")
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.trim(text).alias("t"))))
    joined = F.aggregate(ordered, F.lit(""), lambda acc, x: F.when(acc == "", x["t"]).when(acc.rlike("-$"), F.concat(F.regexp_replace(acc, "-$", ""), x["t"])).otherwise(F.concat(acc, F.lit(" "), x["t"])))
    return p.groupBy(*key, "paragraph").agg(joined.alias("text"), F.count(F.lit(1)).alias("n_lines"))


def longest_chain(df: DataFrame, key: str, style: str, number: str, page: str, least: int = 3) -> DataFrame:
    """For each key the style with the longest chain of consecutive numbers on pages that don't go back: key, style, length,
    start. A number that is missing may be stepped over once the pages are neighbours. Ties go to the lesser style.

    Sequential by nature: numbers of one key and style are at most those of a document, and each task sees one at a time.
    """

    def chains(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(set(zip(pdf["number"], pdf["page"], strict=True)))
        best: dict[int, list[tuple[int, int, int]]] = {}
        top = (0, 0)
        for n, p in rows:
            length, start = 1, n
            for m, near in ((n - 1, None), (n - 2, 1)):
                for q, l, s in best.get(m, []):
                    if q <= p and (near is None or p - q <= near) and l + 1 > length:
                        length, start = l + 1, s
                if length > 1:
                    break
            best.setdefault(n, []).append((p, length, start))
            if length > top[0]:
                top = (length, start)
        return pd.DataFrame([(k[0], k[1], top[0], top[1])], columns=["k", "s", "length", "start"])

    kinds = dict(df.dtypes)
    per = df.select(F.col(key).alias("k"), F.col(style).alias("s"), F.col(number).cast("long").alias("number"), F.col(page).cast("long").alias("page"))
    found = per.groupBy("k", "s").applyInPandas(chains, f"k {kinds[key]}, s {kinds[style]}, length long, start long")
    w = Window.partitionBy("k").orderBy(F.desc("length"), "s")
    return found.where(f"length >= {least}").withColumn("r", F.row_number().over(w)).where("r = 1").select(F.col("k").alias(key), F.col("s").alias(style), "length", "start")


def expected_next(df: DataFrame, key: str, order: str, number: str) -> DataFrame:
    """Headers accepted in turn: the expected number, or the one after it; number 1 restarts. Adds ``accepted``.

    A state machine over what was accepted before, so it runs as one streamed group a key.
    """

    def gate(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, expected = None, 1
        for pdf in it:
            flags = []
            for k, n in zip(pdf[key], pdf[number], strict=True):
                if k != now:
                    now, expected = k, 1
                ok = n in (expected, expected + 1) or n == 1
                if ok:
                    expected = n + 1
                flags.append(ok)
            yield pdf.assign(accepted=flags)

    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + ", accepted boolean"
    return df.repartition(key).sortWithinPartitions(key, order).mapInPandas(gate, schema)


def lines_by_tolerance(df: DataFrame, key: list[str], at: str, tolerance: float, into: str = "line") -> DataFrame:
    """Values that follow one another within a tolerance share a number."""
    w = Window.partitionBy(*key).orderBy(at)
    new = F.coalesce(F.col(at) - F.lag(at).over(w) > tolerance, F.lit(True)).cast("int")
    return df.withColumn("_n", new).withColumn(into, F.sum("_n").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))).drop("_n")


def middle_of_lowest(df: DataFrame, key: list[str], position: str, value: str) -> DataFrame:
    """Among the positions at the least value of each key, the middle of the longest run; ties to the first run."""
    low = df.withColumn("_m", F.min(value).over(Window.partitionBy(*key))).where(F.col(value) == F.col("_m"))
    i = islands(low, key, position)
    return i.groupBy(*key).agg(F.max_by(F.floor((F.col("lo") + F.col("hi")) / 2), F.struct("n", (-F.col("lo")).alias("l"))).alias("middle"), F.max("n").alias("run"))
