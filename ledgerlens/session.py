"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only, so they can also be applied to a session someone else built.
RUNTIME_CONF = {
    # Calendar arithmetic must not depend on the host's zone.
    "spark.sql.session.timeZone": "UTC",
    # Shuffle sizes are only known at run time: coalesce small partitions, split hot ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole texts go through Arrow: bound a batch by its bytes, not only by its rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "ledgerlens", master: str | None = None, **conf: str
) -> SparkSession:
    """Create (or fetch) a session; ``conf`` keys use ``__`` in place of dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        # Recording the caller of every column expression makes building plans slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
