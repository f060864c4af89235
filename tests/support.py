"""Session used by the tests and the local tools."""

from pyspark.sql import SparkSession

from millrace.session import build_session


def local_session(cores: str = "8") -> SparkSession:
    spark = build_session(
        "millrace-local",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": cores,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
