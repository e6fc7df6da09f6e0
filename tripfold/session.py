"""Session settings this library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


CODE_CONF, CODE_DEFAULT, CODE_BYTES = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"


def compile_in_parts(spark: SparkSession) -> None:
    """Has Spark split the code of very long projections into methods that the JVM compiles.

    HotSpot never compiles a method of more than 8,000 bytes: as one method, such a projection is interpreted for
    every row. A session that has set the limit keeps its own.
    """
    if spark.conf.get(CODE_CONF) == CODE_DEFAULT:
        spark.conf.set(CODE_CONF, CODE_BYTES)


def local_session(cores: int | str = "*", name: str = "tripfold", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
