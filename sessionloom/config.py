"""Option defaults and the Spark session / shared-storage helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Defaults that decide results.
BATCH_SIZE = 10
QUANTIZER_TRAIN_SIZE = 100
QUANTIZER_LEVELS = 256
EMBEDDING_SIZE = 1536
CONFIDENCE_INTERVAL_RATIO = 0.15
TOPK_QUANT = 5
MINIMUM_TOPK = 5
MAX_TRAIN_PROBES = 500
USER_EMBEDDINGS_LAST_N = 50
HISTORY_FIELD = "id"

# Scores are compared on this many decimals, so that the summation order of a
# dot product never decides a ranking; ties then fall to the lower id.
SCORE_DECIMALS = 9

# Cells of float data one search task holds per side (64 wide: 65,536 rows).
BLOCK_FLOATS = 1 << 22

# Row bound up to which a configuration table is broadcast.
BROADCAST_ROWS = 50_000


# Keeps the keyed state of streams on disk.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_session(app_name: str = "sessionloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the plans are designed for."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir``. A folder of our own is used only where
    that is unset and the master is local.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sessionloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def new_table_path(spark: SparkSession, name: str) -> str:
    """An unused path for one intermediate table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in shared storage and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Give back the disk of shuffles and staged tables that nothing refers to any more.

    The driver otherwise waits for its own garbage collection, which work that goes
    slice by slice may not see before its end.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def local_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A table of literal rows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(schema.fields)
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A configuration table as a local, broadcast table, if it is small.

    At most ``max_rows`` rows are brought in, once, instead of being computed
    again in every join; a larger table is returned as it is and joined by shuffle.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    # One partition: aggregates over a configuration table then need no shuffle.
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema).coalesce(1))


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
