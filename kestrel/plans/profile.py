"""Profile queries over the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.fixed import TEST_SPLIT_RATIO
from kestrel.operators import profile as P
from kestrel.plans.common import rounded
from kestrel.plans.oracle import FEATURES, PERIODS, with_
from kestrel.plans.registry import query
from kestrel.sources.derived import features, split_periods, with_period
from kestrel.sources.tables import scan_columns

NUM = ["age", "income"]


@query("scan_feature_columns", with_(FEATURES) + "SELECT age, income, category FROM features")
def q_scan_feature_columns(spark, sf):
    return scan_columns(features(spark, sf), NUM, "category")


@query("basic_stats", with_(FEATURES) + """
SELECT count(*) AS total_records,
       round(avg(age), 6) AS avg_age, round(stddev_samp(age), 6) AS std_age,
       min(age) AS min_age, max(age) AS max_age,
       round(avg(income), 6) AS avg_income, round(stddev_samp(income), 6) AS std_income,
       round(min(income), 6) AS min_income, round(max(income), 6) AS max_income
FROM features""")
def q_basic_stats(spark, sf):
    return rounded(P.basic_stats(features(spark, sf), NUM))


@query("existing_stats", with_(PERIODS) + """
SELECT period, count(*) AS total_records,
       round(avg(age), 6) AS avg_age, round(stddev_samp(age), 6) AS std_age,
       round(avg(income), 6) AS avg_income, round(stddev_samp(income), 6) AS std_income
FROM (SELECT 'before' AS period, * FROM periods WHERE period = 'baseline'
      UNION ALL SELECT 'after', * FROM periods)
GROUP BY period""")
def q_existing_stats(spark, sf):
    base, cur = split_periods(features(spark, sf))
    before = P.existing_stats(base, NUM).select(F.lit("before").alias("period"), "*")
    after = P.existing_stats(P.union_batches(base, cur), NUM)
    return rounded(before.unionByName(after.select(F.lit("after").alias("period"), "*")))


@query("category_distribution_pct", with_(FEATURES) + """
SELECT category, count(*) AS count,
       floor(count(*) * 100.0e0 / sum(count(*)) OVER () * 100.0e0 + 0.5e0) / 100.0e0 AS percentage
FROM features GROUP BY category ORDER BY count DESC""")
def q_category_distribution_pct(spark, sf):
    return P.category_distribution_pct(features(spark, sf), "category")


@query("category_counts", with_(FEATURES) + """
SELECT category, count(*) AS count FROM features GROUP BY category ORDER BY category""")
def q_category_counts(spark, sf):
    return P.category_counts(features(spark, sf), "category")


@query("value_counts", with_(FEATURES) + """
SELECT age, count(*) AS count FROM features WHERE age IS NOT NULL GROUP BY age ORDER BY count DESC, age""")
def q_value_counts(spark, sf):
    return P.value_counts(features(spark, sf), "age")


@query("daily_stats_last10", with_(FEATURES) + """
SELECT CAST(CAST(feature_timestamp AS DATE) AS TIMESTAMP) AS date, count(*) AS record_count,
       round(avg(age), 6) AS avg_age, round(avg(income), 6) AS avg_income
FROM features GROUP BY 1 ORDER BY date DESC LIMIT 10""")
def q_daily_stats_last10(spark, sf):
    return rounded(P.daily_stats(features(spark, sf), "feature_timestamp", NUM, 10))


# nulls injected by rule: age null when income < 10, income null when age % 17 = 0
_NULLED = FEATURES + """,
nulled AS (
  SELECT entity_id, CASE WHEN income < 10 THEN NULL ELSE age END AS age,
         CASE WHEN age % 17 = 0 THEN NULL ELSE income END AS income, category
  FROM features)"""


def nulled(spark, sf):
    f = features(spark, sf)
    return f.select("entity_id",
                    F.when(F.col("income") < 10, F.lit(None)).otherwise(F.col("age")).alias("age"),
                    F.when(F.col("age") % 17 == 0, F.lit(None)).otherwise(F.col("income")).alias("income"),
                    "category")


@query("missing_count", with_(_NULLED) + """
SELECT CAST(sum(CASE WHEN entity_id IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN age IS NULL THEN 1 ELSE 0 END)
     + sum(CASE WHEN income IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN category IS NULL THEN 1 ELSE 0 END)
     AS BIGINT) AS missing
FROM nulled""")
def q_missing_count(spark, sf):
    return P.missing_count(nulled(spark, sf))


@query("column_medians", with_(_NULLED) + """
SELECT 'age' AS "column", round(median(age), 6) AS median FROM nulled
UNION ALL SELECT 'income', round(median(income), 6) FROM nulled""")
def q_column_medians(spark, sf):
    return rounded(P.column_medians(nulled(spark, sf), NUM))


@query("column_mean_std", with_(_NULLED) + """
SELECT 'age' AS "column", round(avg(age), 6) AS mean, round(stddev_pop(age), 6) AS std FROM nulled
UNION ALL SELECT 'income', round(avg(income), 6), round(stddev_pop(income), 6) FROM nulled""")
def q_column_mean_std(spark, sf):
    return rounded(P.column_mean_std(nulled(spark, sf), NUM))


@query("task_type", with_(FEATURES) + """
SELECT 'age' AS target, count(DISTINCT age) AS n_distinct,
       CASE WHEN count(DISTINCT age) < 20 THEN 'classification' ELSE 'regression' END AS task_type FROM features
UNION ALL
SELECT 'category', count(DISTINCT category), 'classification' FROM features
UNION ALL
SELECT 'age_bucket', count(DISTINCT age // 10),
       CASE WHEN count(DISTINCT age // 10) < 20 THEN 'classification' ELSE 'regression' END FROM features""")
def q_task_type(spark, sf):
    f = features(spark, sf).withColumn("age_bucket", F.floor(F.col("age") / 10))
    out = None
    for t in ["age", "category", "age_bucket"]:
        r = P.task_type(f, t).select(F.lit(t).alias("target"), "n_distinct", "task_type")
        out = r if out is None else out.unionByName(r)
    return out


@query("dataset_shape", with_(FEATURES) + """
SELECT count(*) AS n_rows, CAST((SELECT count(*) - 2 FROM (DESCRIBE features)) AS BIGINT) AS n_features,
       count(DISTINCT category) AS n_classes,
       CAST((SELECT sum(ceil(0.2e0 * n)) FROM (SELECT count(*) AS n FROM features GROUP BY category)) AS BIGINT) AS n_test,
       count(*) - CAST((SELECT sum(ceil(0.2e0 * n)) FROM (SELECT count(*) AS n FROM features GROUP BY category)) AS BIGINT) AS n_train
FROM features""")
def q_dataset_shape(spark, sf):
    f = scan_columns(features(spark, sf), NUM + ["entity_id"], "category")
    return P.dataset_shape(f, "category", TEST_SPLIT_RATIO)


@query("union_batches", with_(PERIODS) + """
SELECT period, count(*) AS n, round(sum(income), 6) AS income_sum FROM (
  SELECT * FROM periods WHERE period = 'baseline' UNION ALL SELECT * FROM periods WHERE period = 'current')
GROUP BY period""")
def q_union_batches(spark, sf):
    base, cur = split_periods(with_period(features(spark, sf)))
    u = P.union_batches(base, cur)
    return rounded(u.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum("income").alias("income_sum")))


@query("except_categories", with_(PERIODS) + """
SELECT CAST(floor(income) AS BIGINT) AS income_band FROM periods WHERE period = 'current'
EXCEPT SELECT CAST(floor(income) AS BIGINT) FROM periods WHERE period = 'baseline'""")
def q_except_categories(spark, sf):
    base, cur = split_periods(features(spark, sf).withColumn("income_band", F.floor("income").cast("bigint")))
    return P.except_values(cur, base, "income_band")


@query("pct_of_total", """
SELECT user_id, count(*) AS count,
       floor(count(*) * 100.0e0 / sum(count(*)) OVER () * 100.0e0 + 0.5e0) / 100.0e0 AS percentage
FROM events GROUP BY user_id""")
def q_pct_of_total(spark, sf):
    from kestrel.sources.tables import table
    ev = table(spark, sf, "events", "user_id")
    return P.pct_of_total(ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("count")))


@query("order_desc_limit", """
SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 10""")
def q_order_desc_limit(spark, sf):
    from kestrel.sources.tables import table
    ev = table(spark, sf, "events", "event_id", "ts", "event_type", "value")
    return ev.orderBy(F.desc("ts"), F.desc("event_id")).limit(10)
