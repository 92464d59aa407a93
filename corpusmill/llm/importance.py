"""Importance resampling towards a target: hashed n-gram features, a gain for each bucket, and Gumbel top-k draws.

DuckDB works inside each task, on slices of the task's own rows: SQL unnests the words and windows them to n-grams, and a
registered zlib checksum hashes them to buckets. What a task has counted, a row a bucket at most, is spilled to Parquet in the
shared folder; Spark merges the counts, derives the gains (a row a bucket), and a second pass of the same SQL scores each
document by them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, release, ship

#: Words, the number of buckets, and the seed of the draws.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 2024
MOST_N = 1
#: Documents of fewer words are never drawn; the share of the others that is drawn.
LEAST_WORDS, PERCENT = 20, 10
#: Bytes of text that one slice of a task hands to DuckDB, unless a single text is longer.
SLICE = 8 << 20

#: Documents (no, text) to their features, hashed once for each distinct one. ``{joined}``: the words of an n-gram.
_FEATURES = """
CREATE OR REPLACE TEMP TABLE f AS
WITH w AS (
  SELECT no, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (
    SELECT no, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}') AS w FROM docs)
), g AS ({grams})
SELECT no, feature, count(*) AS n FROM g GROUP BY no, feature;
CREATE OR REPLACE TEMP TABLE b AS SELECT feature, crc32(feature) % {buckets} AS bucket FROM (SELECT DISTINCT feature FROM f)
"""


def _grams(most_n: int) -> str:
    """All runs of 1 to ``most_n`` words as a union of windows."""
    one = "SELECT no, word AS feature FROM w"
    more = [
        f"SELECT no, feature FROM (SELECT no, {' || chr(32) || '.join(['word', *(f'lead(word, {k}) OVER d' for k in range(1, n))])} AS feature FROM w WINDOW d AS (PARTITION BY no ORDER BY pos)) WHERE feature IS NOT NULL"
        for n in range(2, most_n + 1)
    ]
    return " UNION ALL ".join([one, *more])


def _engine():
    import duckdb

    def crc(words: pa.ChunkedArray) -> pa.Array:
        return pa.array([zlib.crc32(w.encode()) for w in words.to_pylist()], pa.int64())

    con = duckdb.connect(config={"threads": 1, "memory_limit": "700MB", "temp_directory": "", "preserve_insertion_order": False})
    con.create_function("crc32", crc, ["VARCHAR"], "BIGINT", type="arrow")
    return con


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in tables of about SLICE bytes of text; the column ``text`` is the last."""
    for batch in batches:
        start, weight = 0, 0
        sizes = pc.binary_length(batch.column(batch.num_columns - 1)).to_pylist()
        for i, n in enumerate(sizes):
            if weight and weight + n > SLICE:
                yield pa.Table.from_batches([batch.slice(start, i - start)])
                start, weight = i, 0
            weight += n
        if start < batch.num_rows:
            yield pa.Table.from_batches([batch.slice(start)])


def _features(con, table: pa.Table, most_n: int, buckets: int) -> None:
    con.register("docs", table)
    con.execute(_FEATURES.format(word=WORD, grams=_grams(most_n), buckets=buckets))
    con.unregister("docs")


def bucket_counts(docs: DataFrame, text: str = "text", most_n: int = MOST_N, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): what each task has counted, one row a bucket and task."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _engine()
        con.execute("CREATE TEMP TABLE c (bucket BIGINT, n BIGINT)")
        for table in _slices(batches):
            table = table.append_column("no", pa.array(range(table.num_rows), pa.int64()))
            _features(con, table, most_n, buckets)
            con.execute("INSERT INTO c SELECT bucket, sum(n) FROM f JOIN b USING (feature) GROUP BY bucket")
        yield from con.sql("SELECT bucket, sum(n)::BIGINT AS n FROM c GROUP BY bucket").to_arrow_table().to_batches()
        con.close()

    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(run, "bucket long, n long")


def gains(docs: DataFrame, target: DataFrame, text: str = "text", most_n: int = MOST_N, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain): one row for each of the buckets, from the counts of both tables, spilled and merged.

    The gain is floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))), of s and t features in the bucket and S and T in all.
    """
    sides = []
    for df, name in ((docs, "s"), (target, "t")):
        spilled = cut(bucket_counts(df, text, most_n, buckets))
        sides.append(spilled.groupBy("bucket").agg(F.sum("n").alias(name)))
    both = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(sides[0], "bucket", "left").join(sides[1], "bucket", "left").na.fill(0, ["s", "t"])
    totals = both.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t"))
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * (F.col("all_s") + buckets) / ((s + 1) * (F.col("all_t") + buckets))
    return both.join(F.broadcast(totals)).select("bucket", F.floor(F.log(ratio) * 1000).cast("long").alias("gain"))


def gumbel(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln(u))) of the uniform number that the checksum of seed and key gives."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000).cast("long")


def weights(docs: DataFrame, gain: DataFrame, doc_id: str = "doc_id", text: str = "text", most_n: int = MOST_N, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, n_words, gain_sum) of every row; ``gain`` has a row a bucket, so each task gets it whole."""
    by_bucket = [0] * buckets
    for r in gain.collect():  # a row a bucket, whatever the data
        by_bucket[r.bucket] = r.gain
    shared = docs.sparkSession.sparkContext.broadcast(by_bucket)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _engine()
        con.register("arrived", pa.table({"bucket": pa.array(range(buckets), pa.int64()), "gain": pa.array(shared.value, pa.int64())}))
        con.execute("CREATE TEMP TABLE gains AS SELECT * FROM arrived")
        for table in _slices(batches):
            ids = table.column(0).combine_chunks()
            table = table.select(["text"]).append_column("no", pa.array(range(table.num_rows), pa.int64()))
            _features(con, table, most_n, buckets)
            got = con.execute("SELECT no, sum(n)::BIGINT, sum(n) FILTER (strpos(feature, ' ') = 0)::BIGINT, sum(n * gain)::BIGINT FROM f JOIN b USING (feature) JOIN gains USING (bucket) GROUP BY no").fetchall()
            found = {r[0]: r[1:] for r in got}
            rows = [found.get(i, (0, 0, 0)) for i in range(table.num_rows)]
            yield pa.RecordBatch.from_arrays([ids if isinstance(ids, pa.Array) else ids.chunk(0), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))], names=["doc_id", "n_features", "n_words", "gain_sum"])
        con.close()

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(run, f"doc_id {kind}, n_features long, n_words long, gain_sum long")


def _ranked(df: DataFrame, order: list) -> DataFrame:
    """``df`` with ``rank``, from 1: ranges of the order are counted and numbered from their offsets, so no task sorts all."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part_", F.spark_partition_id()).withColumn("row_", F.monotonically_increasing_id()))
    counts = {r.part_: (r.n, r.first) for r in dealt.groupBy("part_").agg(F.count(F.lit(1)).alias("n"), F.min("row_").alias("first")).collect()}  # a row a partition
    before, offsets = 0, []
    for part in sorted(counts):
        n, first = counts[part]
        offsets.append((part, before - first + 1))
        before += n
    shift = df.sparkSession.createDataFrame(offsets or [(-1, 0)], "part_ int, shift_ long")
    return dealt.join(F.broadcast(shift), "part_").withColumn("rank", F.col("row_") + F.col("shift_")).drop("part_", "row_", "shift_")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", most_n: int = MOST_N, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row: rank is null where a row is not drawn.

    weight is the floored mean of the gains of a row's features, 0 without any; score is weight and a Gumbel number of the id, so
    that the highest scores are a draw without replacement by exp(weight / 1000). Of the N rows with ``least_words`` words,
    floor(percent * N / 100) are drawn; ties go to the smaller id.

    Defined results: null and empty texts have no features and weight 0; null ids come last in ties and hash as an empty one;
    rows that repeat are scored and drawn each; an empty target has counts of zero; extra columns are ignored, whatever their
    names; an empty table gives an empty table. Texts longer than a slice are a slice of their own.
    """
    gain = gains(docs, target, text, most_n, buckets)
    scored = weights(docs, gain, doc_id, text, most_n, buckets)
    weight = F.when(F.col("n_features") == 0, 0).otherwise(F.expr("(gain_sum - pmod(gain_sum, n_features)) div n_features")).cast("long")
    scored = scored.withColumn("weight", weight).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = cut(scored.withColumn("fit", F.col("n_words") >= least_words))
    drawn = scored.where("fit").count() * percent // 100
    ranked = _ranked(scored, [F.desc("fit"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")])
    release(scored)
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
