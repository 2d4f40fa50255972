"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Counted sides up to this size are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000
BROADCAST_CHARACTERS = 50_000_000

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Beyond this size the JVM does not compile a method; Spark then generates
    # smaller ones, which keeps wide contracts fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming state on local disk instead of the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A JSON key written twice keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are written for."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below the folder that ``spark.checkpoint.dir`` names.

    Executors on every host must see it, so a temporary folder of this machine
    is used only where Spark runs in this one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all hosts share")
        root = tempfile.mkdtemp(prefix="pactline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/pactline/{label}-{uuid.uuid4().hex}"


class Written(NamedTuple):
    """A table in the shared folder, with what it was found to hold."""

    df: DataFrame
    rows: int
    characters: int

    def small(self, copies: int = 1) -> bool:
        """Whether a side with so many copies of these rows may be broadcast."""
        return (
            self.rows * copies <= BROADCAST_ROWS
            and self.characters * copies <= BROADCAST_CHARACTERS
        )


def materialize(df: DataFrame, label: str, measure: bool = True) -> Written:
    """Write a result to the shared folder and count it on the way.

    The written table cuts the lineage, outlives lost executors and tells
    Catalyst its true size, so later joins can be planned on a fact. Without
    ``measure`` the width of the rows is not looked at.
    """
    path = shared_folder(df.sparkSession, label)
    width = F.length(F.to_json(F.struct(*df.columns))) if measure else F.lit(0)
    seen = Observation()
    counted = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum(width.cast("bigint")).alias("characters")
    )
    counted.write.parquet(path)
    found = seen.get
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return Written(table, found.get("rows") or 0, found.get("characters") or 0)


def spread(df: DataFrame) -> DataFrame:
    """Share out a source that has far fewer splits than there are cores.

    A single small or unsplittable file would otherwise be parsed by one task.
    A source with enough splits is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 4 <= cores else df


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    """Mark a side for broadcast where its size allows it."""
    return F.broadcast(df) if small else df
