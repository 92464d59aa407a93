"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where it is unset, one of our own in local mode (tests); on a cluster
    a machine's own folder is of no use to the others, so there it must be set."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    named = named or "/tmp/corpusmill-checkpoints"
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` as Parquet to the shared checkpoint folder and reads it from there: what follows survives lost executors, reads
    only the columns it needs, and is planned by the size of the files. Columns may have any names, repeated ones too."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/cut-{uuid4().hex}"
    bare = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    bare = bare.withColumns({f.name: bare[f.name].cast("string") for f in bare.schema if f.dataType.typeName() == "void"})
    bare.write.parquet(path)
    out = spark.read.schema(bare.schema).parquet(path).toDF(*df.columns)
    out._cut_path = path
    return out


def release(*cuts: DataFrame) -> None:
    """Deletes the files of tables that :func:`cut` wrote and that nothing reads any more."""
    for df in cuts:
        if getattr(df, "_cut_path", None):
            remove(df.sparkSession, df._cut_path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python, once a context, by an archive in the shared checkpoint folder."""
    sc = spark.sparkContext
    if getattr(sc, "_corpusmill_archive", None) is not None:
        return
    root, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path(root.name) / f.relative_to(root))
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/corpusmill-{uuid4().hex}.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
    sc._corpusmill_archive = path.toString()
