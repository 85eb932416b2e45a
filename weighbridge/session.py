"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The row checks generate large methods. The JVM does not compile methods over 8000 bytes,
# so such a stage is better off with split projections than with one fused loop.
# The de-duplication state has one hash per file ever seen and belongs on disk. Mail messages
# go to Python with their attachments, so batches are bounded by bytes.
# Folders hold very many small files: a split takes some hundreds of them, and so does a task that
# lists their folders. Spark's own values are four files of a 16 MB split and one folder.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.openCostInBytes": str(32 << 10),
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "48",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
