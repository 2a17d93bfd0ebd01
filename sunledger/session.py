"""Session settings and the shared folder for checkpoints and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Runtime settings the operators rely on; they can be set on a session that already runs.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_local_roots: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on. Time columns are wall clock (NTZ), so UTC is exact."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sunledger") -> SparkSession:
    """A single-machine session for tests and the bench; on a cluster use the session it provides."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors would not
    see it, so a missing setting is an error there.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        root = _local_roots.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="sunledger-")
        _local_roots[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/sunledger/{purpose}-{uuid.uuid4().hex[:12]}"


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A short register as a relation whose size the optimizer knows, so that it can choose to broadcast it."""
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [[] for _ in fields]
    table = pa.table([pa.array(c, type=to_arrow_type(f.dataType)) for c, f in zip(columns, fields)], names=fields.names)
    return spark.createDataFrame(table, fields)


def materialize(df: DataFrame, purpose: str, release_with: Scratch | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; later branches do not recompute it.

    A table that only an operator's own steps read can be handed to ``release_with``, which deletes it when they are done.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    if release_with is not None:
        release_with.hold(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of the shared folder that are deleted together once nothing reads them any more: ``with Scratch(spark) as scratch``.

    What leaves the block must be written by then, as a lost executor may have it computed again.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def hold(self, path: str) -> None:
        self.paths.append(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        context = self.spark.sparkContext
        for path in self.paths:
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
