"""Queries on training, buckets of trained models, and large rule packs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.catalog import shapes as fx
from tallymark.catalog.q_plans import NOUNS
from tallymark.catalog.q_rules import _SHAPES, _base, base_sql
from tallymark.catalog.q_text import _CLEANED, _GRAMS, _cleaned
from tallymark.catalog.registry import query
from tallymark.catalog.sql import text_list, with_shapes
from tallymark.config import RETAIL
from tallymark.functions import fingerprint, text
from tallymark.operators import embedding, features, metric_learning, rules
from tallymark.staging import stage

VALIDATION, TEST = "2000-01-01", "2000-07-01"
LEAST_RECALL = 0.9


@query("fit_metric_learning", with_shapes("fx_transactions", f"""
WITH named AS (SELECT date, list_position({text_list(NOUNS)}, string_split(description, ' ')[2]) - 1 AS label
  FROM fx_transactions)
SELECT label::INT AS label, count(*) AS n_held_out, {len(RETAIL.trainable)} AS n_scores,
  true AS recall_reached, true AS beats_centroids, true AS best_round_chosen
FROM named WHERE label >= 0 AND date >= DATE '{TEST}' GROUP BY ALL"""))
def fit_metric_learning(spark, folder):
    """Vectors learned from older rows, chosen on later ones, judged on the newest.

    LEAST_RECALL of the newest rows must find their label, and more of them than by centroids of the
    vectors that training began with.
    """
    rows = fx.with_account_type(fx.transactions(spark, folder)).drop("category")
    noun = F.array_position(
        F.array(*[F.lit(n) for n in NOUNS]), F.get(F.split("description", " "), F.lit(1))
    )
    index = F.when(noun > 0, noun - 1).cast("int")
    names = F.array(*[F.lit(c) for c in RETAIL.categories])
    rows = rows.withColumn("target_category_int", index)
    rows = rows.withColumn("target_category", F.get(names, F.col("target_category_int")))
    made = features.features(rows, RETAIL, features.limits_of(rows)).select(
        "transaction_id", "date", "target_category", "target_category_int", "preprocessed_description",
        "preprocessed_numeric_features",
    )
    made = stage(made.where("target_category_int is not null"), "features")
    older, newest = made.where(f"date < '{VALIDATION}'"), made.where(f"date >= '{TEST}'")
    later = made.where(f"date >= '{VALIDATION}' and date < '{TEST}'")
    schedule = metric_learning.Schedule(rate=RETAIL.learning_rate, patience=4, stop_after=8)
    fitted = metric_learning.fit(older, later, RETAIL, schedule, batch_size=32)
    tried = [(r.validation_error, r.validation_loss, r.number) for r in fitted.rounds]

    def right(model):
        found = model.score(newest, ["transaction_id"], RETAIL)
        best = F.array_position("scores", F.array_max("scores")) - 1
        return found.withColumn("right", (best == F.col("target_category_int")).cast("double"))

    start = metric_learning.Parameters.initial(
        fitted.parameters.buckets, RETAIL.embedding_size, len(RETAIL.trainable), RETAIL.seed
    )
    first = metric_learning.Fit(start).model(spark)
    means = embedding.masked_mean(
        older, ["transaction_id"], "preprocessed_description", first.token_vectors, RETAIL.embedding_size,
        RETAIL.hash_buckets,
    )
    labelled = older.select("transaction_id", F.col("target_category_int").alias("index")).join(means, "transaction_id")
    centroids = embedding.label_centroids(labelled, "index", "description_embedding", RETAIL.embedding_size)
    plain = right(embedding.EmbeddingModel(first.token_vectors, centroids)).agg(F.avg("right")).first()[0]
    scored = right(fitted.model(spark))
    learned = scored.agg(F.avg("right")).first()[0]
    return scored.groupBy(F.col("target_category_int").alias("label")).agg(
        F.count(F.lit(1)).alias("n_held_out"), F.max(F.size("scores")).alias("n_scores"),
        F.lit(learned >= LEAST_RECALL).alias("recall_reached"),
        F.lit(learned > plain).alias("beats_centroids"),
        F.lit(fitted.best == min(tried)[2]).alias("best_round_chosen"),
    )


@query("txt_fingerprint_buckets", with_shapes("fx_transactions_short", f"""
WITH {_CLEANED}, {_GRAMS}, cut AS (SELECT unnest(g[1:60]) AS gram FROM grams)
SELECT gram, count(*) AS n, 1 AS n_buckets, true AS in_range FROM cut GROUP BY gram"""))
def txt_fingerprint_buckets(spark, folder):
    """Every n-gram with the number of its places and of its buckets, which must be one."""
    tokens = text.tokenize(F.col("cleaned"), RETAIL.max_tokens)
    grams = text.ngrams(F.col("tokens"))
    rows = _cleaned(spark, folder).withColumn("tokens", tokens).withColumn(
        "grams", F.slice(grams, 1, RETAIL.sequence_length)
    )
    buckets = fingerprint.fingerprint_buckets(F.col("grams"), RETAIL.hash_buckets, RETAIL.sequence_length)
    pairs = F.arrays_zip(F.col("grams"), F.slice("buckets", F.lit(1), F.size("grams")).alias("buckets"))
    placed = rows.withColumn("buckets", buckets).select(F.explode(pairs).alias("p"))
    return placed.groupBy(F.col("p.grams").alias("gram")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("p.buckets").cast("int").alias("n_buckets"),
        F.bool_and(F.col("p.buckets").between(0, RETAIL.hash_buckets - 1)).alias("in_range"),
    )


def _part_pack(spark, folder) -> dict:
    """Part names as a pack: a category per brand and direction, hundreds of patterns."""
    pack: dict = {}
    rows = fx.patterns(spark, folder, "parts").drop("pack").distinct().orderBy("category", "pattern")
    for r in rows.collect():
        name = f"{r.category} {r.transaction_type}"
        rule = pack.setdefault(name, {
            "transaction_type": r.transaction_type, "description": {"+": [], "-": []}, "counterparty": {"+": [], "-": []},
        })
        rule["description"][r.sign].append(r.pattern)
    return pack


@query("rule_match_indexed", with_shapes(_SHAPES, f"""
WITH {base_sql()},
patterns AS (SELECT DISTINCT p_brand AS brand, CASE WHEN p_size % 2 = 0 THEN 'debit' ELSE 'credit' END AS way,
  p_size % 3 = 0 AS barred, p_partkey % 3 AS kind, p_name AS name FROM part),
found AS MATERIALIZED (SELECT transaction_id, transaction_type, name, description = name AS whole,
    contains(' ' || description || ' ', ' ' || name || ' ') AS word
  FROM base JOIN (SELECT DISTINCT name FROM patterns) n ON contains(description, name))
SELECT transaction_id, brand || ' ' || way AS category FROM found JOIN patterns USING (name)
WHERE way = transaction_type AND CASE kind WHEN 0 THEN word WHEN 1 THEN whole ELSE true END
GROUP BY transaction_id, brand, way HAVING NOT bool_or(barred)"""))
def rule_match_indexed(spark, folder):
    """A pack of more patterns than an alternation is good for: the literal index finds the hits."""
    found = rules.hits(_base(spark, folder), _part_pack(spark, folder))
    return found.select("transaction_id", "category")
