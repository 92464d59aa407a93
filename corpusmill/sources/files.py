"""Readers and writers of the file layouts that corpora come in. All paths go through Spark's readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def inventory(spark: SparkSession, root: str, pattern: str = "*", exclude: str | None = None) -> DataFrame:
    """path, length, modified, md5 of all files under a root whose names match, without paths that match ``exclude``."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    out = f.select("path", "length", F.col("modificationTime").alias("modified"), F.md5("content").alias("md5"))
    return out if exclude is None else out.where(~F.col("path").rlike(exclude))


def path_partitions(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns from the last folders of the files a frame is read from: ``…/<names[0]>/<names[1]>/file``."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    return df.select("*", *(F.element_at(parts, -(len(names) + 1 - k)).alias(n) for k, n in enumerate(names)))


def json_arrays(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """One row for each object of files that hold one JSON array each."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def json_lines(spark: SparkSession, path: str, schema: StructType | str, strict: bool = False) -> DataFrame:
    """A log of JSON lines; malformed ones are skipped, or end the job if ``strict``."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def paged_text(spark: SparkSession, path: str) -> DataFrame:
    """path, page (from 1), text of whole text files, gzip or not, whose pages form feeds part; a blank last page is none."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    pages = F.split("value", "\f", -1)
    pages = F.when(F.element_at(pages, -1).rlike(r"^\s*$"), F.slice(pages, F.lit(1), F.size(pages) - 1)).otherwise(pages)
    return t.select("path", F.posexplode(pages).alias("p", "text")).select("path", (F.col("p") + 1).alias("page"), "text")


def listed_ids(spark: SparkSession, path: str, pattern: str = r"^(P[0-9]{4})") -> DataFrame:
    """The distinct ids that begin the lines of list files; comments and other lines count for nothing."""
    return spark.read.text(path).select(F.regexp_extract("value", pattern, 1).alias("id")).where("id <> ''").distinct()


def table(spark: SparkSession, url: str, name: str, properties: dict[str, str]) -> DataFrame:
    """A table of a database by JDBC, its driver given by ``properties``."""
    return spark.read.jdbc(url, name, properties=properties)


def write_csv(df: DataFrame, path: str, columns: list[str], sep: str = ";") -> None:
    """Fixed columns in order, others left out, missing ones empty."""
    df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns)).write.mode("overwrite").option("sep", sep).option("header", "true").csv(path)


def write_parts(df: DataFrame, path: str, part: str) -> None:
    """One folder a part, replacing only the parts that the frame holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).json(path)


def layout(df: DataFrame, **defaults: str) -> DataFrame:
    """Folder columns with a name for what is missing, as ``partitionBy`` takes them."""
    return df.withColumns({c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(v)) for c, v in defaults.items()})


def markdown(df: DataFrame, order: list, cells: list[Column]) -> DataFrame:
    """One row, ``report``: a list line for each row. For reports, whose rows are few by their nature."""
    line = F.concat(F.lit("* "), F.concat_ws(" — ", *cells))
    return df.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("_line")))), lambda x: x["_line"]), "\n").alias("report"))
