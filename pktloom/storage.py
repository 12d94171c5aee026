"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Files of a written table at most, for each core; and of one that aggregates leave small. Small files cost a store more than they are worth.
FILES_PER_CORE, FEW_PER_CORE = 8, 2
#: Shuffle partitions to a file at least, and bytes read for it at most: where there is much data, files and the tasks that compute them are many, too.
PARTITIONS_PER_FILE, BYTES_PER_FILE = 8, 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where it is unset a temporary folder is used, which only a local master may do.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="shared-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def bytes_read(df: DataFrame) -> int:
    """Bytes of the files that df is computed from; other sources count nothing."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = (int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return sum(n for n in sizes if n < 1 << 60)  # larger ones are Spark's word for unknown


def few_files(df: DataFrame, per_core: int = FILES_PER_CORE) -> DataFrame:
    """df in fewer partitions, without a shuffle: no more than so many for each core, an eighth of the shuffle partitions, or one for
    each BYTES_PER_FILE read, whichever is most. So small tables have few files, and tasks do not grow with large ones.
    """
    spark = df.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(per_core * spark.sparkContext.defaultParallelism, shuffled // PARTITIONS_PER_FILE, bytes_read(df) // BYTES_PER_FILE))


def written(df: DataFrame, name: str, per_core: int = FILES_PER_CORE) -> DataFrame:
    """The frame as a Parquet table in the shared folder: lineage is cut and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    few_files(df, per_core).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table made by written() that nothing reads any more."""
    spark, path = df.sparkSession, getattr(df, "stored_at", None)
    if path:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
