"""Session helpers: shared folder, materialised stages, table access, size-checked broadcast."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted rows are at most this many,
BROADCAST_ROWS = 200_000
#: ... and their texts have at most so many bytes.
BROADCAST_BYTES = 64_000_000

#: Keys of a skewed join that are broadcast at most, each with more than this part of all rows.
HOT_KEYS = 10_000

#: Setting by which a job's shuffle files are deleted when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: dict[str, SparkSession] = {}
_local: dict[str, str] = {}
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the one the context was given; in local mode without either, a temporary one.

    A cluster without such a folder is an error: a folder of one machine would lose stages with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    given = context._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="lumenweave-")
    return _local[context.applicationId]


def materialise(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives the loss of executors.

    Shuffle files of the job that writes go with its end, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(_CLEANUP, None)
    try:
        spark.conf.set(_CLEANUP, "true")
        writer.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _written[path] = spark
    out._stage = path
    return out


def forget(*stages: DataFrame) -> None:
    """Deletes written stages that nothing reads any more."""
    for stage in stages:
        path = getattr(stage, "_stage", None)
        if path in _written:
            _delete(_written.pop(path), path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, for clusters on whose path it isn't."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="lumenweave-")) / "lumenweave.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def small(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``limit`` rows and its texts that many bytes; looks at no more than ``limit + 1`` rows."""
    texts = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    size = sum((F.coalesce(F.sum(t), F.lit(0)) for t in texts), F.lit(0))
    n, total = df.limit(limit + 1).agg(F.count("*").alias("n"), size.alias("size")).first()
    return n <= limit and total <= most_bytes


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a count of rows and bytes; a larger side keeps the planner's own choice (a shuffle join)."""
    return F.broadcast(df) if small(df, limit) else df


def look_up(left: DataFrame, right: DataFrame, on: list[str], weight: str, how: str = "inner", most_rows: int = BROADCAST_ROWS, hot: int = HOT_KEYS) -> DataFrame:
    """Inner, semi or anti join of a skewed ``left`` with ``right``, a written table of one row for each key.

    ``weight`` is how often ``left`` has the key; it is not in the result. A small ``right`` is broadcast. Of a larger one the
    keys with more than one ``hot``-th of all weight are, of which there are at most ``hot``; the other keys, none of them
    hot, are shuffled.
    """
    if small(right, most_rows):
        return left.join(F.broadcast(right.drop(weight)), on, how)
    total = right.agg(F.sum(weight)).first()[0] or 0
    often = F.coalesce(F.col(weight) * hot > total, F.lit(False))
    top, rest = right.where(often).drop(weight), right.where(~often).drop(weight)
    others = left.join(F.broadcast(top.select(*on)), on, "left_anti").join(rest, on, how)
    return others if how == "left_anti" else left.join(F.broadcast(top), on, how).unionByName(others)


@atexit.register
def _clean() -> None:
    for path, spark in _written.items():
        try:
            _delete(spark, path)
        except Exception:  # the context is gone
            return
