"""Session settings and the shared scratch folder used for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. All are Spark's own runtime switches: AQE re-plans joins from
# real shuffle sizes, splits skewed join partitions and coalesces small ones. Where every
# partition of one side is small it also hashes that side instead of sorting both.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}

# Used where the session has no setting of its own. Tasks are kept small: Spark's usual 64 MB of shuffled and 128 MB
# of scanned bytes are 300 to 500 MB once the rows lie in a sort or a hash table, which spills where a core has little
# memory. Staged and stored tables are written with the denser of Parquet's usual codecs.
PREFERRED_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.parquet.compression.codec": "zstd",
}

# One shuffle partition per this much input, so that a partition and its sort fit in a task's
# memory; AQE merges the ones that turn out small.
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    for name, value in PREFERRED_SETTINGS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


def folder_bytes(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to suit the input; a larger setting is kept."""
    wanted = -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests, the bench) gets a temporary folder:
    on a cluster a machine-local folder is not visible to the executors, so it is refused.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared:
        return f"{shared}/martloom/{context.applicationId}"
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="martloom-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the optimizer real file sizes, so a
    later join is broadcast only when the table is known to be small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
