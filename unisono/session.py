"""Session settings the engine expects; everything else is left to the cluster."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName("unisono")
    if master:
        builder = builder.master(master)
    for k, v in (SETTINGS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
