"""Session set-up and shared storage for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

CHECKPOINT_CONF = "spark.checkpoint.dir"
_staged: dict[str, list[str]] = {}
_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def spark_session(app: str = "scorespark", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC times; ``conf`` wins over both."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder of its own. On
    a cluster a missing setting is an error, because a folder of one machine
    would be lost with that machine.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.TemporaryDirectory(prefix="scorespark-")
    return _local_dirs[context.applicationId].name


def values_table(
    spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType
) -> DataFrame:
    """A small table of fitted values that the optimiser sees as a local relation of known size."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) or [()] * len(fields)
    arrow = pa.table(
        [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, fields)], names=fields.names
    )
    return spark.createDataFrame(arrow, fields)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under :func:`shared_dir`; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet on shared storage and return a scan of it.

    Used where an operator reads the same rows several times. Later passes scan
    only the columns they need, and losing executors cannot bring back the
    lineage behind the table.
    """
    return stage_at(df, label)[0]


def stage_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As :func:`stage`, with the path, for :func:`drop_table`."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    _staged.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path as :func:`scratch_path`, deleted with the staged tables or by :func:`drop_table`."""
    path = scratch_path(spark, label)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete one staged table that nothing reads any more."""
    _staged[spark.sparkContext.applicationId].remove(path)
    _delete(spark, [path])


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables staged by this application; how many there were.

    Call it when everything built on them has been written or shown. Results that
    are still to be computed from staged tables fail afterwards.
    """
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    _delete(spark, paths)
    return len(paths)


def _delete(spark: SparkSession, paths: Sequence[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def finish(spark: SparkSession) -> None:
    """End a job: drop staged tables and stop the session."""
    drop_staged(spark)
    spark.stop()


#: Rows a part of a fit holds at most, and the parts that smaller tables are dealt into.
FIT_ROWS = 1_000_000
FIT_PARTS = 32


def spread(df: DataFrame, key: str = "dummy_id") -> DataFrame:
    """Rows dealt by a hash of the key, in key order, into parts that follow from the number of rows.

    Row samples of a fit then depend on the rows only, not on cores or file sizes, and
    no part grows with the table.
    """
    parts = max(FIT_PARTS, -(-df.count() // FIT_ROWS))
    return df.repartition(parts, key).sortWithinPartitions(key)
