"""A local session for tests and benchmarks.

On a cluster use the session given: the jobs set no options of their own and rely on
adaptive execution, which is on by default.
"""

from pyspark.sql import SparkSession


def local_session(cpus="8", memory="8g"):
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("namelink")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
