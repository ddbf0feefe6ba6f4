"""Small things that several operators use."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one that all executors share.

    On a cluster spark.checkpoint.dir has to be set; only in local mode a folder of its own takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="llm-run-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def kept(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a written table in the shared folder: it survives lost executors and cuts the lineage."""
    path = run_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the folders of kept frames that no later step reads."""
    for frame in frames:
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(frame.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def n_words(text) -> F.Column:
    """Number of words of a text; none in a null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    empty = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when(
        (F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1
    ).otherwise(0)
    return (F.size(parts) - empty).cast("long")


def bound(value, use):
    """use(value), with value worked out once for a row however often use names it."""
    return F.transform(F.array(value), use)[0]


def _width(name: str, kind: T.DataType) -> F.Column:
    """About the bytes of a value in a broadcast: a word, and what texts and nested values have besides."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        more = F.octet_length(name)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        more = F.octet_length(F.to_json(F.struct(name)))
    else:
        more = F.lit(0)
    return F.coalesce(more, F.lit(0)).cast("long") + 16


def fits(frame: DataFrame, rows: int, size: int | None = None) -> bool:
    """Whether the frame has at most so many rows and bytes; stops one row later."""
    first = frame.limit(rows + 1)
    if size is None:
        return first.count() <= rows
    width = sum((_width(f.name, f.dataType) for f in frame.schema), F.lit(0))
    found = first.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")).first()
    return found["n"] <= rows and (found["size"] or 0) <= size


def fitting(frame: DataFrame, rows: int, size: int | None = None) -> DataFrame:
    """The frame marked for broadcast if it has at most so many rows and bytes, else as it is."""
    return F.broadcast(frame) if fits(frame, rows, size) else frame


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished parts go: nothing refers to them any more, but Spark only deletes
    them once the driver's JVM has collected its garbage."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
