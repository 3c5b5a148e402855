"""A local session for tests and benchmarks; clusters bring their own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from altimart.operators.skew import SETTINGS


def local_session(cores: int | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("altimart")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config(map=SETTINGS)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # single-file test tables arrive as one task; a shuffle join spreads the work over cores
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        # sizes measured at run time decide: broadcast small sides, hash instead of sort where
        # every partition fits a hash table
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        # the JVM never compiles methods above 8000 bytes; let Spark split such projections
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
