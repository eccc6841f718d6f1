"""Session settings this library works best with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Exports have dozens of answer columns, and code generated for one such row
# grows past the size HotSpot compiles (8000 bytes of bytecode); it would then
# be interpreted.  With this limit Spark splits such code instead.
RUNTIME = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings, unless the session already has other values than Spark's defaults."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key) == "65535":
            spark.conf.set(key, value)
    return spark
