"""What the operators of this subpackage share: session set-up, scratch tables, bounded driver reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcelens.session import ensure_checkpoint_dir, ship_package, write_and_read

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Python workers get batches bounded in rows and in bytes, so long texts stay within memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.execution.pyspark.binaryAsBytes": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings, shared scratch folder and shipped code that every operator here relies on."""
    for key, value in CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    return write_and_read(df, name)


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a table whose size has a proven bound; more rows than that are an error, never a cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows


def text_of(column: str = "text"):
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
