"""Tables that lie on disk by identity, so that weekly joins of them shuffle nothing.

Both sides of the feedback join are large, and both are keyed by the five identity columns. Written
once in the same number of buckets of these columns, sorted within, they meet bucket by bucket: the
newest label of a transaction and its join with the transaction need no exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.config import IDENTITY
from tallymark.sources import manifests

BUCKETS = 200

# Rows of all tables that meet in one bucket: what a task sorts and joins.
ROWS_A_BUCKET = 1_000_000


def buckets_for(*tables: DataFrame, least: int = 8) -> int:
    """Buckets for tables that are joined: `least`, or more to keep each at ROWS_A_BUCKET rows on average."""
    return max(least, -(-sum(df.count() for df in tables) // ROWS_A_BUCKET))


def write_by_identity(df: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Write `df` in buckets of the identity and register it as the table `name` of this session.

    One shuffle deals the rows out, so each bucket is one file. A manifest beside the folder holds
    schema and number of buckets for other sessions.
    """
    keys = list(IDENTITY)
    dealt = df.repartition(buckets, *keys)
    (
        dealt.write.mode("errorifexists").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
        .option("path", path).saveAsTable(name)
    )
    content = {"columns": [[f.name, f.dataType.simpleString()] for f in df.schema], "buckets": buckets}
    manifests.write(df.sparkSession, f"{path}.layout", content)
    return df.sparkSession.table(name)


def open_by_identity(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The table at `path`, registered as `name`, as any session may do."""
    content = manifests.read(spark, f"{path}.layout")
    columns = ", ".join(f"`{c}` {kind}" for c, kind in content["columns"])
    keys = ", ".join(IDENTITY)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {content['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
