"""Counts on the write, publication, identity layout, and rows set aside."""

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tallymark import schemas
from tallymark.config import IDENTITY, RETAIL
from tallymark.operators import feedback, joins
from tallymark.sources import layout, manifests, publication, sinks, tables

BOTH = RETAIL.with_values(domains=("app", "business"))


def rows(spark, n=60, run=1):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 > 0, "app").otherwise("business").alias("domain"),
        F.element_at(F.array(*map(F.lit, ("GB", "FR", "NL"))), (F.col("id") % 3 + 1).cast("int")).alias("country_code"),
        F.lit(run).alias("run"),
    )


def sizes(df):
    return {(r.domain, r.country_code): r["count"] for r in df.groupBy("domain", "country_code").count().collect()}


# --- counts observed on the write ----------------------------------------------------------


def test_counts_equal_a_second_read(spark, tmp_path):
    df = rows(spark)
    got = sinks.write_counted(df, f"{tmp_path}/t", BOTH)
    assert got == sizes(spark.read.parquet(f"{tmp_path}/t")) == sizes(df)
    assert sinks.write_counted(df.limit(0), f"{tmp_path}/none", BOTH) == {}
    assert sinks.write_counted(df, f"{tmp_path}/other", RETAIL) is None  # rows of another domain
    assert spark.read.parquet(f"{tmp_path}/other").count() == 60
    nulls = df.union(spark.createDataFrame([(1, "app", None, 1)], "id long, domain string, country_code string, run int"))
    assert sinks.write_counted(nulls, f"{tmp_path}/nulls", BOTH) is None


def test_metadata_do_not_read_a_counted_table(spark, tmp_path):
    df = rows(spark)
    counts = sinks.write_counted(df, f"{tmp_path}/t", BOTH)
    table = spark.read.parquet(f"{tmp_path}/t")
    read, known = (sinks.run_metadata({"training": table}, BOTH, None, c) for c in (None, {"training": counts}))
    assert sorted(read.collect()) == sorted(known.collect())

    def scans(d):
        return d._jdf.queryExecution().optimizedPlan().toString().count("parquet")

    assert scans(read) == 1 and scans(known) == 0
    assert sorted(sinks.run_metadata({"training": table}, BOTH, None, {"training": None}).collect()) == sorted(read.collect())


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = (SparkSession.builder.master("local[2,3]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from tallymark.config import RETAIL
from tallymark.sources import sinks
def flaky(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")
df = spark.range(100, numPartitions=4).mapInArrow(flaky, "id long").select(
    "id", F.lit("app").alias("domain"), F.when(F.col("id") < 30, "GB").otherwise("FR").alias("country_code"))
print("counts", sorted(sinks.write_counted(df, sys.argv[1], RETAIL).items()))
"""


def test_repeated_tasks_count_once(tmp_path):
    done = subprocess.run([sys.executable, "-c", RETRIED, f"{tmp_path}/t"], capture_output=True, text=True, timeout=200)
    assert "counts [(('app', 'FR'), 70), (('app', 'GB'), 30)]" in done.stdout, done.stderr[-1500:]


# --- publication ---------------------------------------------------------------------------


def published(spark, root, config, **made):
    run = publication.Publication(spark, root)
    for name, df in made.items():
        run.write(name, df, config)
    return run.publish()


def test_broken_off_run_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        publication.read(spark, root, "training")
    assert published(spark, root, BOTH, training=rows(spark), production=rows(spark, 9)) == 1
    run = publication.Publication(spark, root)
    run.write("training", rows(spark, 30, run=2), BOTH)  # and never the rest
    for name, n in (("training", 60), ("production", 9)):
        found = publication.read(spark, root, name)
        assert found.count() == n and {r.run for r in found.collect()} == {1}
    (tmp_path / "manifests" / "2").mkdir()  # a manifest that was broken off
    assert publication.versions(spark, root) == [1]
    assert published(spark, root, BOTH, training=rows(spark, 12, run=3)) == 3
    assert publication.read(spark, root, "training").count() == 12
    assert publication.read(spark, root, "production").count() == 9
    assert publication.read(spark, root, "training", 1).count() == 60


def test_a_domain_is_replaced_alone(spark, tmp_path):
    root = str(tmp_path)
    published(spark, root, BOTH, training=rows(spark))
    published(spark, root, RETAIL, training=rows(spark, 60, run=2).where("domain = 'app' and id < 30"))
    found = publication.read(spark, root, "training")
    assert found.columns == ["id", "domain", "country_code", "run"]
    assert {(r.domain, r.run) for r in found.collect()} == {("app", 2), ("business", 1)}
    assert found.where("domain = 'app'").count() == 20 and found.where("domain = 'business'").count() == 20
    published(spark, root, RETAIL, training=rows(spark).limit(0))
    assert {r.domain for r in publication.read(spark, root, "training").collect()} == {"business"}
    published(spark, root, BOTH, training=rows(spark).limit(0))
    assert publication.read(spark, root, "training").count() == 0


def test_runs_at_the_same_time_and_old_folders(spark, tmp_path):
    root = str(tmp_path)
    published(spark, root, BOTH, training=rows(spark))
    one, other = publication.Publication(spark, root), publication.Publication(spark, root)
    one.write("training", rows(spark, 6, run=2), BOTH)
    other.write("training", rows(spark, 9, run=3), BOTH)
    assert one.publish() == 2
    with pytest.raises(RuntimeError, match="another run"):
        other.publish()
    assert publication.read(spark, root, "training").count() == 6
    published(spark, root, RETAIL, training=rows(spark, 60, run=4).where("domain = 'app'"))
    assert publication.versions(spark, root) == [1, 2, 3]
    assert len(publication.retire(spark, root, keep=1)) == 2  # the first run, and the refused one
    assert publication.versions(spark, root) == [3]
    assert {r.run for r in publication.read(spark, root, "training").collect()} == {2, 4}


def test_damaged_manifest(spark, tmp_path):
    manifests.write(spark, f"{tmp_path}/m", {"a": [1, 2]})
    assert manifests.read(spark, f"{tmp_path}/m") == {"a": [1, 2]}
    file = next((tmp_path / "m").glob("part-*.txt"))
    (tmp_path / "m" / f".{file.name}.crc").unlink()
    file.write_text(file.read_text().replace("[1, 2]", "[1, 3]"))
    with pytest.raises(manifests.Damaged):
        manifests.read(spark, f"{tmp_path}/m")


# --- identity layout -----------------------------------------------------------------------


def identity_tables(spark):
    key = F.col("id")
    base = spark.range(200).select(
        (key % 9).cast("string").alias("user_id"), (key % 5).cast("string").alias("account_id"),
        key.cast("string").alias("transaction_id"), F.date_add(F.lit("2020-01-01").cast("date"), (key % 30).cast("int")).alias("date"),
        (key % 2 + 1).cast("int").alias("pending"),
    )
    facts = base.where("transaction_id % 3 = 0").withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        *IDENTITY, F.concat(F.lit("2020-05-0"), "k", F.lit(" 10:00:00")).alias("feedback_time"),
        F.concat(F.lit("c"), "k").alias("category"),
    )
    return base.withColumn("amount", F.col("transaction_id").cast("double")), facts


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line and "BroadcastExchange" not in line for line in plan.splitlines())


def test_join_by_identity_shuffles_nothing(spark, tmp_path):
    transactions, facts = identity_tables(spark)
    lies = layout.write_by_identity(transactions, "tx_lies", f"{tmp_path}/tx", 6)
    labels = layout.write_by_identity(facts, "fb_lies", f"{tmp_path}/fb", 6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.with_transactions(feedback.latest_feedback([labels]), lies)
        assert exchanges(joined) == 0
        plain = joins.with_transactions(feedback.latest_feedback([facts]), transactions)
        assert exchanges(plain) > 0
        assert sorted(joined.collect()) == sorted(plain.collect()) and joined.count() == 67
        # another session registers what lies there
        spark.sql("DROP TABLE tx_lies")
        again = layout.open_by_identity(spark, "tx_again", f"{tmp_path}/tx")
        joined = joins.with_transactions(feedback.latest_feedback([labels]), again)
        assert exchanges(joined) == 0 and joined.count() == 67
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- rows that do not fit ------------------------------------------------------------------


def test_csv_rows_that_do_not_fit(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "user_id,account_id,transaction_id,pending,date,feedback_time,category\n"
        "u1,a1,t1,1,2020-01-02,2020-01-03 10:00:00,Bills\n"
        "u2,a2,t2,one,2020-01-02,2020-01-03 10:00:00,Bills\n"
        "u3,a3\n"
        'u4,a4,t4,2,2020-01-02,"2020-01-03, noon",Rent\n'
        "u5,a5,t5,1,2020-13-45,x,Bills\n"
        "u6,a6,t6,1,2020-01-02,x,Bills,more\n"
        "\n"
        "u7,a7,t7,,,,\n"
    )
    good, bad = tables.read_checked(spark, f"{tmp_path}/t.csv", schemas.FEEDBACK)
    assert sorted(r.user_id for r in good.collect()) == ["u1", "u4", "u7"]
    assert good.select("category").count() == good.count() == 3  # whatever is read of the rows
    found = {r.record[:2]: r.reason for r in bad.collect()}
    assert found == {"u2": "value", "u3": "fields", "u5": "value", "u6": "fields"}
    assert bad.count() == 4 and all(r.file.endswith("t.csv") for r in bad.collect())


def test_json_rows_that_do_not_fit(spark, tmp_path):
    lines = [
        {"id": "1", "user_id": "u1"}, {"id": "2", "user_id": None, "more": 1}, "{\"id\": \"3\", ", "", "[1]", "text",
        {"id": "4", "deleted": {"x": 1}}, {},
    ]
    (tmp_path / "t.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    good, bad = tables.read_checked(spark, f"{tmp_path}/t.json", schemas.ACCOUNTS)
    assert sorted(str(r.id) for r in good.collect()) == ["1", "2", "4", "None"]
    assert sorted(r.reason for r in bad.collect()) == ["syntax"] * 3
    events = [{"id__userId": "u", "id__pendingType": 1}, {"id__userId": "v", "id__pendingType": "x"}, {"id__userId": "w", "id__localDate": "nope"}]
    (tmp_path / "e.json").write_text("\n".join(map(json.dumps, events)))
    good, bad = tables.read_checked(spark, f"{tmp_path}/e.json", schemas.FEEDBACK_EVENTS)
    assert [r.id__userId for r in good.collect()] == ["u"] and good.select("id__userId").count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["value", "value"]


def test_parquet_has_no_bad_rows(spark, tmp_path):
    spark.createDataFrame([("u", "GB", "c")], "id string, country_code string, client_id string").write.parquet(f"{tmp_path}/u")
    good, bad = tables.read_checked(spark, f"{tmp_path}/u", schemas.USERS)
    assert good.count() == 1 and bad.count() == 0 and bad.columns == ["file", "record", "reason", "read"]


def test_job_sets_rows_aside_and_publishes(spark, tmp_path):
    from test_job import RETAIL as CONFIG
    from test_job import SETTINGS, common, write

    from tallymark.plans import preprocess

    root = str(tmp_path)
    paths = common(spark, root)
    (tmp_path / "users.csv" / "broken.csv").write_text("id,country_code,client_id\nu99\n")
    made = [
        (f"u{i % 8}", f"a{i % 8}", f"t{i}", "2020-01-15", 1, f"text {i}", "", "debit", float(i), None) for i in range(40)
    ]
    paths["transactions"] = write(
        spark, f"{root}/tx.csv", "user_id string, account_id string, transaction_id string, date string, pending int, "
        "description string, internal_transaction string, transaction_type string, amount double, bank_specific string", made,
    )
    events = [(r[0], r[1], r[2], r[3], 1, "2020-02-01 10:00:00", "Bills") for r in made]
    events_path = write(
        spark, f"{root}/events.json", "id__userId string, id__accountId string, id__transactionId string, "
        "id__localDate string, id__pendingType int, kafka__timestamp string, fact__category string", events, "json",
    )
    paths["user_single_feedback_created"] = events_path
    (tmp_path / "events.json" / "broken.json").write_text('{"id__userId": "u1",\n{"id__pendingType": "two"}\n')
    metadata = preprocess.run(
        spark, CONFIG, paths, f"{root}/out", SETTINGS, "2020-04-01 10:00", set_aside=True, publish=True
    )
    facts = {r.metric: r.value for r in metadata.collect()}
    assert facts["rejected.users"] == "1" and facts["rejected.user_single_feedback_created"] == "2"
    assert facts["rejected.transactions"] == "0" and facts["version"] == "1"
    training = publication.read(spark, f"{root}/out", "training")
    assert training.count() > 0
    for (domain, country), n in sizes(training).items():
        assert facts[f"training_size.{domain}.{country}"] == str(n)
    rejected = spark.read.json(f"{root}/out/rejected/user_single_feedback_created").collect()
    assert sorted(r.reason for r in rejected) == ["syntax", "value"]
