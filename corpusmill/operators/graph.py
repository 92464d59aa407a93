"""Connected components of an edge table, without collecting edges, labels or members anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import cut, release

#: Edges a partition, at least, in what a round writes: small graphs don't scatter over many tiny files.
ROWS = 20_000


def _both(e: DataFrame) -> DataFrame:
    return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(e: DataFrame, parts: int) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    n = _both(e)
    least = n.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = cut(least.coalesce(parts))  # so that the join meets plain shuffles, and a hot node's rows can be split
    tied = n.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    out = cut(tied.distinct().coalesce(parts))
    release(least)
    return out


def _small_star(e: DataFrame, parts: int) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    n = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = cut(n.groupBy("a").agg(F.min("b").alias("m")).coalesce(parts))
    tied = n.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = cut(tied.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct().coalesce(parts))
    release(least)
    return out


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of every node of ``edges`` (a, b).

    Alternating large and small stars: every round is two grouped minima and joins on narrow rows, and the number of rounds
    grows with the logarithm of the longest path. Each round is written to the checkpoint folder, and deleted once the next one
    is. Loops and repeated edges are allowed; nodes without edges do not appear; null ends are dropped.
    """
    e = cut(edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct())
    parts = e.count() // ROWS + 1
    seen = None
    while True:
        large = _large_star(e.coalesce(parts), parts)
        done, e = e, _small_star(large, parts)
        release(done, large)
        state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if state == seen:
            break
        seen = state
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def labelled_components(edges: DataFrame) -> DataFrame:
    """node, component, labels: the components of edges (a, b, label) and the sorted set of the labels that hold each together."""
    found = cut(components(edges))
    labels = edges.where("a <> b").join(found, F.col("a") == F.col("node")).select("component", "label").distinct()
    return found.join(labels.groupBy("component").agg(F.sort_array(F.collect_list("label")).alias("labels")), "component").select("node", "component", "labels")


def suppress_ordered(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Greedy suppression in an order: a row that stays suppresses its later neighbours; a suppressed row suppresses none.

    ``nodes`` (id, rank: unique, lower goes first), ``edges`` (a, b). The result, id and keeper (null for rows that stay), is that
    of the sequential loop; each round decides every row that has no undecided earlier neighbour, and the rows that it suppresses.
    """
    r = nodes.select("id", "rank")
    e = edges.select("a", "b").where("a <> b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct()
    e = e.join(r.select(F.col("id").alias("a"), F.col("rank").alias("ra")), "a").join(r.select(F.col("id").alias("b"), F.col("rank").alias("rb")), "b")
    e = cut(e.where("ra < rb").select("a", "b", "ra"))  # a goes before b
    stays, gone = None, None
    open_ = e
    touched = e.select(F.col("a").alias("id")).union(e.select(F.col("b").alias("id"))).distinct()
    undecided = cut(touched)
    while not undecided.isEmpty():
        waits = open_.select(F.col("b").alias("id")).distinct()
        keep = cut(undecided.join(waits, "id", "left_anti"))
        drop = cut(open_.join(keep.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("b").alias("id")).distinct().join(keep, "id", "left_anti"))
        stays = keep if stays is None else stays.union(keep)
        gone = drop if gone is None else gone.union(drop)
        undecided = cut(undecided.join(keep.union(drop), "id", "left_anti"))
        open_ = cut(open_.join(undecided.select(F.col("id").alias("b")), "b", "left_semi").join(undecided.select(F.col("id").alias("a")), "a", "left_semi"))
    if stays is None:
        return r.select("id", F.lit(None).cast(dict(r.dtypes)["id"]).alias("keeper"))
    kept_by = e.join(stays.select(F.col("id").alias("a")), "a", "left_semi").join(gone.select(F.col("id").alias("b")), "b", "left_semi")
    first = kept_by.groupBy("b").agg(F.min_by("a", "ra").alias("keeper")).withColumnRenamed("b", "id")
    return r.select("id").join(first, "id", "left")
