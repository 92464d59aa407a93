"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..lineage import checkpoint_dir, cut, release, remove, ship  # noqa: F401

#: The characters that separate words and vanish in normalised texts: space, and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"


def whole_text(text: str = "text") -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def row_key(doc_id: str, text: str) -> Column:
    """128 bits that tell rows apart by id and text, of whatever type the id is; the same for rows that repeat both."""
    i = F.col(doc_id).cast("string")
    return F.unhex(F.md5(F.concat(F.when(i.isNull(), "-").otherwise(F.concat(F.length(i).cast("string"), F.lit(":"), i)), F.lit("|"), F.coalesce(F.concat(F.lit("+"), F.col(text)), F.lit(""))))).alias("row_key")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names of new columns that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def map_rows(df: DataFrame, columns: list, schema: StructType | str, rows: Callable[[Iterator[tuple]], Iterable[tuple]]) -> DataFrame:
    """Streams ``columns`` through ``rows`` (an iterator of tuples to an iterable of tuples) in Arrow batches.

    ``rows`` sees one partition as a single stream, so state that it keeps (memos, tables) is made once a task.
    Output batches are cut at 4 MB or 4096 rows, so long texts never pile up.
    """
    ship(df.sparkSession)
    picked = df.select(*columns)
    out_type = picked.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch], out_type=out_type) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_type)

        def tuples():
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    yield from zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True)

        held: list[tuple] = []
        weight = 0
        for row in rows(tuples()):
            held.append(row)
            weight += sum(len(v) for v in row if isinstance(v, (bytes, str, list))) + 64
            if weight >= 4 << 20 or len(held) >= 4096:
                yield _batch(held, arrow)
                held, weight = [], 0
        if held:
            yield _batch(held, arrow)

    return picked.mapInArrow(run, out_type)


def filter_rows(df: DataFrame, columns: list[str], verdicts: Callable[[Iterator[tuple]], Iterator[bool]]) -> DataFrame:
    """The rows of ``df`` that ``verdicts`` keeps, all columns unchanged, with no join and no shuffle.

    ``verdicts`` maps the stream of ``columns`` (strings and binaries as they are, null as None) to one boolean a row.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: list[pa.RecordBatch] = []

        def tuples():
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    slices.append(batch.slice(start, 256))
                    yield from zip(*(slices[-1].column(c).to_pylist() for c in columns), strict=True)

        verdict, kept = verdicts(tuples()), []
        for keep in verdict:
            kept.append(keep)
            if len(kept) == slices[0].num_rows:
                yield slices.pop(0).filter(pa.array(kept, type=pa.bool_()))
                kept = []

    return df.mapInArrow(run, df.schema)


def add_column(df: DataFrame, columns: list[str], name: str, values: Callable[[Iterator[tuple]], Iterator[str]]) -> DataFrame:
    """``df`` with one more string column, from the stream of ``columns``; all others unchanged, with no join and no shuffle."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: list[pa.RecordBatch] = []

        def tuples():
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    slices.append(batch.slice(start, 256))
                    yield from zip(*(slices[-1].column(c).to_pylist() for c in columns), strict=True)

        made: list[str] = []
        for v in values(tuples()):
            made.append(v)
            if len(made) == slices[0].num_rows:
                b = slices.pop(0)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], names=[*b.schema.names, name])
                made = []

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, StringType())]))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
