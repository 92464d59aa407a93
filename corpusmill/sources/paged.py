"""A Python data source for documents that only a library can open: one partition a slice of files, a decoder yields the pages.

The decoder is given by name (``module:function``): bytes to an iterable of page texts. Files come through Spark's own binary
reader where the table is built with :func:`decoded`; the data source is for catalogues of addresses that a decoder fetches.
"""

from __future__ import annotations

from collections.abc import Iterator
from importlib import import_module

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def text_pages(content: bytes) -> list[str]:
    """The decoder for plain text: form feeds part pages."""
    return content.decode("utf-8", "replace").split("\f")


def decoded(files: DataFrame, decoder: str = "corpusmill.sources.paged:text_pages") -> DataFrame:
    """path, page, text, error of (path, content) rows; a file that the decoder refuses gives one row with its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        module, name = decoder.split(":")
        open_ = getattr(import_module(module), name)
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    rows = [(path, k, t, None) for k, t in enumerate(open_(content), 1)]
                except Exception as e:  # noqa: BLE001  whatever the decoder raises becomes the row's error
                    rows = [(path, None, None, f"{type(e).__name__}: {e}")]
                yield pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(("path", "page", "text", "error"))}, schema=pa.schema([("path", pa.string()), ("page", pa.int32()), ("text", pa.string()), ("error", pa.string())]))

    return files.select("path", "content").mapInArrow(run, "path string, page int, text string, error string")


class _Slice(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


class CatalogueSource(DataSource):
    """``spark.read.format("catalogue").options(fetch="module:function", count=N, slices=K)``: rows that ``fetch(i)`` gives."""

    @classmethod
    def name(cls) -> str:
        return "catalogue"

    def schema(self) -> str:
        return "id long, text string"

    def reader(self, schema) -> DataSourceReader:
        return _CatalogueReader(self.options)


class _CatalogueReader(DataSourceReader):
    def __init__(self, options):
        self.fetch, self.count, self.slices = options["fetch"], int(options["count"]), int(options.get("slices", 8))

    def partitions(self):
        step = max(1, -(-self.count // self.slices))
        return [_Slice(lo, min(lo + step, self.count)) for lo in range(0, self.count, step)]

    def read(self, part: _Slice):
        module, name = self.fetch.split(":")
        fetch = getattr(import_module(module), name)
        for i in range(part.lo, part.hi):
            yield i, fetch(i)
