"""Queries on tables of other proportions than those of the test folders."""

import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import differences  # noqa: E402

from tallymark import staging  # noqa: E402
from tallymark.catalog import shapes as fx  # noqa: E402
from tallymark.catalog.registry import ORACLES, QUERIES  # noqa: E402
from tallymark.operators import feedback  # noqa: E402
from tallymark.sources import layout  # noqa: E402

import __spark_entry__  # noqa: E402, F401


@pytest.fixture
def limited(spark):
    """Sets session options until the test ends."""
    before = {}

    def set_(**options):
        for name, value in options.items():
            key = f"spark.sql.{name.replace('__', '.')}"
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _connect(folder: str):
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return connection


def _tables(spark, at: Path, n_orders: int, n_vectors: int) -> str:
    number = F.col("id")
    tables = {
        "orders": spark.range(n_orders).select(
            number.alias("o_orderkey"), (number % 10).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            (number * 1.5).alias("o_totalprice"),
            F.lit("1999-01-05").cast("timestamp_ntz").alias("o_orderdate"),
        ),
        "part": spark.range(7).select(
            number.alias("p_partkey"), F.concat(F.lit("red bolt "), "id").alias("p_name")
        ),
        "supplier": spark.range(3).select(
            number.alias("s_suppkey"), F.concat(F.lit("Supplier "), "id").alias("s_name")
        ),
        "embeddings": spark.range(n_vectors).select(
            number.alias("vec_id"),
            F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.rand(3).cast("float") * i).alias("embedding"),
        ),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["agg_golden_failures", "agg_quality_gate"])
def test_few_rows_meet_many_vectors(spark, tmp_path, limited, name):
    """The few golden rows are broadcast at run time; their key counts the vectors' rows."""
    folder = _tables(spark, tmp_path, 2000, 6000)
    limited(autoBroadcastJoinThreshold="300k")
    problem, n = differences(QUERIES[name](spark, folder), _connect(folder), ORACLES[name])
    assert problem is None and n > 0


def test_sources_share_one_join_of_events_and_transactions(spark, folder):
    """Joins below a union of sources would all run, with their sorts, in one task."""
    sources = fx.feedback_sources(spark, folder)
    plan = feedback.union_feedback(sources)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    every = fx.feedback(spark, folder)
    assert sum(df.count() for df in sources) == every.count() + every.where("src = 0").count()


def test_identity_layout_has_buckets_by_rows(spark, tmp_path, monkeypatch):
    """A fixed number of buckets would make each task grow with the tables."""
    folder, number = _tables(spark, tmp_path, 300, 1), F.col("id")
    spark.range(960).select(
        number.alias("event_id"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts"),
        F.when(number % 5 == 0, "view").otherwise("click").alias("event_type"),
    ).coalesce(1).write.parquet(f"{folder}/events.parquet")
    written, write = [], layout.write_by_identity
    monkeypatch.setattr(layout, "write_by_identity", lambda *a: written.append(a[3]) or write(*a))
    name = "join_identity_layout"
    for rows in (layout.ROWS_A_BUCKET, 100):
        monkeypatch.setattr(layout, "ROWS_A_BUCKET", rows)
        problem, n = differences(QUERIES[name](spark, folder), _connect(folder), ORACLES[name])
        assert problem is None and n > 0
    # 300 transactions, 900 events of theirs, those of source 0 twice
    assert written == [8, 8, 15, 15]


def test_classifier_stages_only_what_it_reads(spark, tmp_path, monkeypatch):
    """Hashed buckets are input of the embedding model; making and writing them took most of the staging."""
    class Staged(Exception):
        pass

    def stop(df, name):
        raise Staged(df.columns)

    monkeypatch.setattr(staging, "stage", stop)
    _tables(spark, tmp_path, 20, 1)
    spark.range(2).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text")).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    with pytest.raises(Staged) as found:
        QUERIES["fit_text_classifier"](spark, str(tmp_path))
    assert set(found.value.args[0]) == {
        "date", "target_category", "target_category_int", "cleaned_description", "preprocessed_numeric_features"
    }
