import gzip
import json

from pyspark.sql import functions as F

from corpusmill.sources import files, paged
from corpusmill.streaming import incremental


def test_file_sources(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a/x.txt").write_text("one")
    (tmp_path / "a/b/y.txt").write_text("two")
    (tmp_path / "a/b/z.bin").write_text("no")
    inv = files.inventory(spark, str(tmp_path / "a"), "*.txt", exclude="/b/").collect()
    assert [(r.length, r.md5) for r in inv] == [(3, "f97c5d29941bfb1b2fdab0874906ab82")]
    (tmp_path / "log.jsonl").write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    assert sorted(r.a for r in files.json_lines(spark, str(tmp_path / "log.jsonl"), "a long").collect()) == [1, 2]
    q = tmp_path / "v/2015/P1"
    q.mkdir(parents=True)
    (q / "q.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    got = files.path_partitions(files.json_arrays(spark, str(q / "q.json"), "id long"), ["exam", "year", "pid"]).collect()
    assert sorted(tuple(r) for r in got) == [(1, "v", "2015", "P1"), (2, "v", "2015", "P1")]
    with gzip.open(tmp_path / "t.txt.gz", "wt") as f:
        f.write("p1\fp2\n\f \n")
    assert [(r.page, r.text) for r in files.paged_text(spark, str(tmp_path / "t.txt.gz")).orderBy("page").collect()] == [(1, "p1"), (2, "p2\n")]
    (tmp_path / "ids.txt").write_text("P0001 # x\n# P0002\nP0003\n")
    assert sorted(r.id for r in files.listed_ids(spark, str(tmp_path / "ids.txt")).collect()) == ["P0001", "P0003"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x"), (2, "b", "y")], "id long, name string, part string")
    files.write_csv(df, str(tmp_path / "csv"), ["name", "id", "missing"])
    assert sorted(tuple(r) for r in spark.read.option("sep", ";").option("header", "true").csv(str(tmp_path / "csv")).fillna("").collect()) == [("", "1", ""), ("b", "2", "")]
    files.write_parts(df, str(tmp_path / "parts"), "part")
    files.write_parts(df.where("id = 2").withColumn("name", F.lit("new")), str(tmp_path / "parts"), "part")
    assert sorted((r.part, r.id, r.name) for r in spark.read.schema("id long, name string, part string").json(str(tmp_path / "parts")).collect()) == [("x", 1, None), ("y", 2, "new")]
    assert {r.name for r in files.layout(df, name="outros").collect()} == {"outros", "b"}
    assert files.markdown(df, ["id"], [F.col("id"), F.col("name")]).first().report == "* 1\n* 2 — b"


def test_decoders(spark):
    df = spark.createDataFrame([("a", bytearray(b"p1\fp2"))], "path string, content binary")
    assert sorted((r.path, r.page, r.text) for r in paged.decoded(df).collect()) == [("a", 1, "p1"), ("a", 2, "p2")]
    spark.dataSource.register(paged.CatalogueSource)
    got = spark.read.format("catalogue").options(fetch="builtins:str", count="5", slices="2").load().collect()
    assert sorted((r.id, r.text) for r in got) == [(i, str(i)) for i in range(5)]


def test_decoder_errors_become_rows(spark):
    df = spark.createDataFrame([("a", bytearray(b"ok")), ("b", bytearray(b"\xff"))], "path string, content binary")
    got = {r.path: r.error for r in paged.decoded(df, "json:loads").collect()}
    assert got["a"] and got["b"]


def test_incremental_runs_read_new_files_only(spark, tmp_path):
    src, sink, cp = (str(tmp_path / x) for x in ("src", "sink", "cp"))
    schema = spark.createDataFrame([], "id long, v string").schema
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(src)
    work = lambda d: d.withColumn("v", F.upper("v"))
    incremental.append_new(spark, src, schema, work, sink, cp)
    incremental.append_new(spark, src, schema, work, sink, cp)
    assert sorted(tuple(r) for r in spark.read.parquet(sink).collect()) == [(1, "A"), (2, "B")]
    spark.createDataFrame([(3, "c")], schema).write.mode("append").parquet(src)
    incremental.append_new(spark, src, schema, work, sink, cp)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [1, 2, 3]
    seen = []
    incremental.in_batches(spark, src, schema, lambda d, k: seen.append(d.count()), str(tmp_path / "cp2"), files_at_once=1)
    assert sum(seen) == 3 and len(seen) > 1


def test_event_windows_on_a_stream(spark, tmp_path):
    src = str(tmp_path / "events")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.write.parquet(src)
    out = incremental.event_windows(spark.readStream.schema(e.schema).parquet(src), late="60 days")
    q = out.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda r: (str(r.start), r.event_type, r.n)
    assert sorted(map(key, spark.table("windows").collect())) == sorted(map(key, incremental.event_windows(e).collect()))


def test_queue_and_pending(spark):
    items, done = spark.range(5).withColumnRenamed("id", "k"), spark.createDataFrame([(1,), (1,), (3,)], "k long")
    assert sorted(r.k for r in incremental.pending(items, done, "k").collect()) == [0, 2, 4]
    queue = spark.createDataFrame([(1, 2), (2, 1)], "k long, tries int")
    got = {r.k: r.tries for r in incremental.retry_queue(queue, spark.createDataFrame([(2,), (4,)], "k long"), done, "k").collect()}
    assert got == {2: 2, 4: 1}
