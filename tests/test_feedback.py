from tallymark.operators import feedback, joins

SCHEMA = (
    "user_id int, account_id int, transaction_id int, date string, pending int, "
    "feedback_time string, category string"
)


def source(spark, *items):
    return spark.createDataFrame([(1, 1, t, "d", p, time, c) for t, p, time, c in items], SCHEMA)


def test_latest(spark):
    first = source(
        spark,
        (1, 1, "2020-01-01 10:00:00", "Old"),
        (2, 1, "2020-01-01 10:00:00", "B"),
        (2, 1, "2020-01-01 10:00:00", "A"),
        (2, 1, "2020-01-01 10:00:00", None),
        (3, 1, "not a time", "X"),
        (4, 1, "2020-01-01 10:00:00", None),
    )
    second = source(
        spark,
        (1, 1, "2020-01-02", "New"), (1, 2, "2019-01-01 00:00", "Pending"),
        (3, 1, "2018-01-01 00:00:00", "Y"),
    )
    rows = feedback.latest_feedback([first, second, second]).collect()
    found = {(r.transaction_id, r.pending): r.target_category for r in rows}
    assert found == {(1, 1): "New", (1, 2): "Pending", (2, 1): "A", (3, 1): "Y", (4, 1): None}
    assert len(rows) == 5


def test_latest_combines_before_the_shuffle(spark):
    rows = source(spark, (1, 1, "2020-01-01 10:00:00", "A"))
    plan = feedback.latest_feedback([rows, rows])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_columns_are_matched_by_name(spark):
    one = source(spark, (1, 1, "2020-01-01", "A"))
    other = one.select(*reversed(one.columns))
    assert feedback.union_feedback([one, other]).distinct().count() == 1


def test_no_test_user_table(spark):
    users = spark.createDataFrame([(1, "GB", "c")], "user_id int, country_code string, client_id string")
    assert joins.flag_test_users(users, None).first().test_user == 0
    assert joins.without_test_users(users, None).count() == 1
