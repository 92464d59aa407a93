"""Keyed state in streams: permanent numbers of items, and headers accepted in turn with the language and area they carry.

Both operators keep their state by key in the state store (``transformWithState``), so a stream that is stopped goes on from its
checkpoint as if it had not been, and both have a form for tables that gives what one run over all rows would give. The state
machine of headers is written once, and both forms run it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..lineage import ship

_STORE = "spark.sql.streaming.stateStore.providerClass"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state needs the store that keeps it beside the heap, and its changes in the checkpoint."""
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    ship(spark)


class _Numbers(StatefulProcessor):
    def __init__(self, first: int):
        self.first = first

    def init(self, handle) -> None:
        self.next = handle.getValueState("next", "n long")
        self.known = handle.getMapState("known", "item string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        items = sorted({i for pdf in rows for i in pdf["item"] if i is not None})
        n = self.next.get()[0] if self.next.exists() else self.first
        out = []
        for i in items:
            new = not self.known.containsKey((i,))
            if new:
                self.known.updateValue((i,), (n,))
            out.append((key[0], i, n if new else self.known.getValue((i,))[0], new))
            n += new
        self.next.update((n,))
        yield pd.DataFrame(out, columns=["key", "item", "number", "is_new"])

    def close(self) -> None:
        pass


def numbered_stream(stream: DataFrame, key: str, item: str, first: int = 1) -> DataFrame:
    """(key, item, number, is_new): items of a key are numbered from ``first`` as they appear, and keep their numbers for good.

    Of the items that are new in a micro-batch the smaller string comes first. An item comes out once for each micro-batch that
    has it. Null items have no number; a null key is a key as any other. There is no event time: a late item is a new one.
    """
    use_state_store(stream.sparkSession)
    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(item).cast("string").alias("item"))
    return rows.groupBy("key").transformWithStateInPandas(_Numbers(first), "key string, item string, number long, is_new boolean", "Append", "None")


def numbered_table(df: DataFrame, key: str, item: str, batch: str, first: int = 1) -> DataFrame:
    """(key, item, number) that the stream gives once all batches, in their order, have gone through it."""
    seen = df.where(F.col(item).isNotNull()).groupBy(F.col(key).cast("string").alias("key"), F.col(item).cast("string").alias("item")).agg(F.min(batch).alias("_b"))
    return seen.select("key", "item", (F.row_number().over(Window.partitionBy("key").orderBy("_b", "item")) + (first - 1)).cast("long").alias("number"))


@dataclass
class Gate:
    """What is carried from line to line of a document."""

    last: int = -1
    expected: int = 0  # 0: no header yet
    lo: int = 0  # the numbers that are asked once a language; 0: none
    hi: int = 0
    first_language: str = ""
    passes: int = 0
    area: str = ""

    def line(self, pos: int, kind: str, number: int | None, value: str | None, to: int | None, first: int, languages: tuple[str, str]) -> tuple | None:
        """Takes a line in; for a header: (accepted, language, area, late)."""
        if pos <= self.last:
            return (False, None, None, True) if kind == "header" else None
        self.last = pos
        if kind == "area":
            self.area = value or ""
        elif kind == "language":
            self.first_language = self.first_language or value or ""
            if number is not None and to is not None:
                self.lo, self.hi = number, to
        elif kind == "header" and number is not None:
            again = self.lo > 0 and number == self.lo and self.expected == self.hi + 1
            self.passes += again
            if not (again or (number in (self.expected, self.expected + 1) if self.expected else number == first)):
                return False, None, None, False
            self.expected = number + 1
            of = None
            if self.first_language and self.lo <= number <= self.hi:
                of = self.first_language if self.passes == 0 else next((x for x in languages if x != self.first_language), self.first_language)
            return True, of, self.area or None, False
        return (False, None, None, False) if kind == "header" else None


_LINE = ["pos", "kind", "number", "value", "to_number"]
_HEADERS = "doc string, pos long, number long, accepted boolean, language string, area string, late boolean"


def _through(gate: Gate, doc, lines: Iterable[tuple], first: int, languages: tuple[str, str]) -> list[tuple]:
    whole = lambda v: None if pd.isna(v) else int(v)
    out = []
    for pos, kind, number, value, to in lines:
        got = gate.line(int(pos), kind, whole(number), None if pd.isna(value) else value, whole(to), first, languages)
        if got is not None:
            out.append((doc, int(pos), whole(number), *got))
    return out


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc", "pos", "number", "accepted", "language", "area", "late"])
    out["number"] = out["number"].astype("Int64")
    return out


#: Documents share so many keys of the state store, by a hash: a call costs far more than a document in it. A stream must keep
#: the number for as long as its checkpoint lives.
BUCKETS = 1024


class _Headers(StatefulProcessor):
    def __init__(self, first: int, languages: tuple[str, str]):
        self.first, self.languages = first, languages

    def init(self, handle) -> None:
        self.gates = handle.getMapState("gates", "doc string", "last long, expected long, lo long, hi long, first_language string, passes long, area string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out = []
        pdf = pd.concat(list(rows)).sort_values(["doc", "pos", "kind"])
        docs = [None if pd.isna(d) else d for d in pdf["doc"]]
        for doc, group in groupby(zip(docs, pdf[_LINE].itertuples(index=False, name=None), strict=True), key=lambda x: x[0]):
            at = ("" if doc is None else f"={doc}",)
            gate = Gate(*self.gates.getValue(at)) if self.gates.containsKey(at) else Gate()
            out += _through(gate, doc, (line for _, line in group), self.first, self.languages)
            self.gates.updateValue(at, tuple(asdict(gate).values()))
        yield _frame(out)

    def close(self) -> None:
        pass


def _lines(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc").cast("string").alias("doc"), F.col("pos").cast("long").alias("pos"), "kind", F.col("number").cast("long").alias("number"), F.col("value").cast("string").alias("value"), F.col("to_number").cast("long").alias("to_number"))


def headers_stream(stream: DataFrame, first: int = 1, languages: tuple[str, str] = ("inglês", "espanhol")) -> DataFrame:
    """Headers of numbered items in turn, from a stream of lines (doc, pos, kind, number, value, to_number).

    kind ``header``: a line that reads as the heading of item ``number``. It is accepted as the first one if it is ``first``, later
    if it is the expected number or the one after. kind ``language``: ``value`` names a language, ``number`` to ``to_number`` the
    items that are asked in each; after the last of them the first may come again, and belongs to the other language. kind
    ``area``: ``value`` is carried to the headers that follow.

    Returns doc, pos, number, accepted, language, area, late. Lines at or before a place that an earlier micro-batch has reached
    are late: late headers come out so marked, and no late line changes the state. Of two lines at one place in a micro-batch the
    second, by kind, is late as well. State is kept by document, in BUCKETS keys; a micro-batch reads and writes that of its own
    documents only, and one bucket's lines of it are in memory at a time.
    """
    use_state_store(stream.sparkSession)
    lines = _lines(stream).withColumn("bucket", F.pmod(F.xxhash64("doc"), F.lit(BUCKETS)))
    return lines.groupBy("bucket").transformWithStateInPandas(_Headers(first, languages), _HEADERS, "Append", "None")


def headers_table(df: DataFrame, first: int = 1, languages: tuple[str, str] = ("inglês", "espanhol")) -> DataFrame:
    """What :func:`headers_stream` gives for lines that arrive in order. Documents are streamed one after another, line by line."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, gate = object(), Gate()
        for pdf in it:
            out = []
            for doc, part in pdf.groupby("doc", sort=False, dropna=False):
                doc = None if pd.isna(doc) else doc
                if doc != now:
                    now, gate = doc, Gate()
                out += _through(gate, doc, part[_LINE].itertuples(index=False, name=None), first, languages)
            yield _frame(out)

    ship(df.sparkSession)
    return _lines(df).repartition("doc").sortWithinPartitions("doc", "pos", "kind").mapInPandas(run, _HEADERS)
