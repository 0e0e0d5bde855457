"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffle partitions, splits skewed join partitions and
# picks broadcast joins from measured sizes. The JVM does not compile methods above
# 8000 bytes: a generated method beyond that runs interpreted, so wide projections
# (40 parsed columns) are better off with many small generated functions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.orc.impl": "native",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_SPARKS_OWN_LIMIT = "65535"


def limit_methods(spark: SparkSession) -> None:
    """The limit above for a session that was not built here, unless it has one of its own."""
    if spark.conf.get(_METHOD_LIMIT, _SPARKS_OWN_LIMIT) == _SPARKS_OWN_LIMIT:
        spark.conf.set(_METHOD_LIMIT, DEFAULTS[_METHOD_LIMIT])


def build_session(app_name: str, **overrides: str) -> SparkSession:
    """A session with the defaults; master, memory and shuffle width come from
    ``spark-submit`` or from ``overrides``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
