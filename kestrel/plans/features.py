"""Feature-store queries: groups, latest values, views over two groups, as-of
lookup (error events against the latest earlier purchase of the same user)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import features as FS
from kestrel.plans.oracle import FEATURES, with_
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.derived import features
from kestrel.sources.tables import table

_LATEST = FEATURES + """,
latest AS (SELECT entity_id, age, income, category, feature_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY feature_timestamp DESC) AS rk FROM features)
  WHERE rk = 1)"""

_EV_LATEST = """ev AS (SELECT user_id, value, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk FROM events) WHERE rk = 1)"""


def _registry(spark, sf):
    reg = FS.Registry(spark)
    reg.create_group("user_features", features(spark, sf), ["entity_id"], "feature_timestamp", {"domain": "usage"})
    for f, d, labels in [("age", "age of the user in years", {}), ("income", "income of the user", {"unit": "usd"}),
                         ("category", "segment category", {"kind": "nominal"})]:
        reg.create_feature("user_features", f, d, labels)
    reg.create_group("customers", table(spark, sf, "customer"), ["c_custkey"], labels={"domain": "sales"})
    for f, d, labels in [("c_acctbal", "account balance", {"unit": "usd"}), ("c_mktsegment", "market segment", {"kind": "nominal"})]:
        reg.create_feature("customers", f, d, labels)
    return reg


@query("feature_group", with_(FEATURES) + "SELECT entity_id, feature_timestamp, age, income, category FROM features")
def q_feature_group(spark, sf):
    reg = _registry(spark, sf)
    again = reg.create_group("user_features", None, ["ignored"])      # existing -> reused
    return again.frame()


def _non_null_counts(reg, group):
    g = reg.groups[group]
    fr = g.frame()
    feats = list(g.features)
    row = fr.agg(*[F.count(c).alias(c) for c in feats])
    long = row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("non_null"))
                                         for c in feats])))
    return reg.list_features(group).drop("labels").join(long, "feature")


@query("feature_list", with_(FEATURES) + """
SELECT 'user_features' AS "group", 'age' AS feature, 'bigint' AS type, 'age of the user in years' AS description,
       count(age) AS non_null FROM features
UNION ALL SELECT 'user_features', 'income', 'double', 'income of the user', count(income) FROM features
UNION ALL SELECT 'user_features', 'category', 'string', 'segment category', count(category) FROM features""")
def q_feature_list(spark, sf):
    return _non_null_counts(_registry(spark, sf), "user_features")


@query("metadata_search", """
SELECT 'user_features' AS "group", 'income' AS feature, 'double' AS type, 'income of the user' AS description,
       count(value) AS non_null FROM events
UNION ALL SELECT 'customers', 'c_acctbal', 'double', 'account balance', count(c_acctbal) FROM customer""")
def q_metadata_search(spark, sf):
    reg = _registry(spark, sf)
    # by labels of the group and of the feature, by text and label, by text
    hits = (reg.search(labels={"domain": "sales", "unit": None}).unionByName(reg.search("income", {"unit": "usd"}))
            .unionByName(reg.search("balance")).select("group", "feature").distinct())
    counts = _non_null_counts(reg, "user_features").unionByName(_non_null_counts(reg, "customers"))
    return counts.join(hits.select("group", "feature"), ["group", "feature"], "left_semi")


@query("feature_group_delete", """
SELECT 'customers' AS "group", true AS present, count(*) AS n_rows FROM customer
UNION ALL SELECT 'user_features', false, 0""")
def q_feature_group_delete(spark, sf):
    reg = _registry(spark, sf)
    reg.delete_group("user_features")
    reg.delete_group("user_features")              # missing: success
    def row(name: str):
        if name not in reg.groups:
            return spark.range(1).select(F.lit(name).alias("group"), F.lit(False).alias("present"),
                                         F.lit(0).cast("bigint").alias("n_rows"))
        return reg.groups[name].frame().agg(F.lit(name).alias("group"), F.lit(True).alias("present"),
                                            F.count(F.lit(1)).alias("n_rows"))
    return row("customers").unionByName(row("user_features"))


@query("latest_per_entity", with_(_LATEST) + "SELECT * FROM latest")
def q_latest_per_entity(spark, sf):
    f = features(spark, sf)
    return FS.latest_per_entity(f, ["entity_id"], "feature_timestamp")


@query("online_sync", with_(_LATEST) + "SELECT * FROM latest")
def q_online_sync(spark, sf):
    path = FS.online_sync(features(spark, sf), ["entity_id"], "feature_timestamp", scratch_path(spark, "online"))
    return spark.read.parquet(path)


@query("offline_export", with_(FEATURES) + "SELECT entity_id, income, category FROM features")
def q_offline_export(spark, sf):
    path = FS.offline_export(features(spark, sf), scratch_path(spark, "offline"), ["income", "category"],
                             ["entity_id"])
    return spark.read.parquet(path)


def _ev_latest(spark, sf):
    ev = table(spark, sf, "events", "event_id", "user_id", "value", "event_type", "ts")
    return FS.latest_per_entity(ev, ["user_id"], "ts", ["event_id"]).drop("event_id")


def _customers(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    return c.select(F.col("c_custkey").alias("user_id"), "c_acctbal", "c_mktsegment")


@query("join_feature_view", "WITH " + _EV_LATEST + """
SELECT ev.user_id, ev.value AS ev_value, ev.event_type AS ev_event_type, ev.ts AS ev_ts,
       c.c_acctbal AS cu_c_acctbal, c.c_mktsegment AS cu_c_mktsegment
FROM ev LEFT JOIN customer c ON c.c_custkey = ev.user_id""")
def q_join_feature_view(spark, sf):
    return FS.feature_view([(_ev_latest(spark, sf), "ev_"), (_customers(spark, sf), "cu_")], "user_id")


@query("join_feature_view_full", "WITH " + _EV_LATEST + """
SELECT coalesce(ev.user_id, c.c_custkey) AS user_id, ev.value AS ev_value, ev.event_type AS ev_event_type,
       ev.ts AS ev_ts, c.c_acctbal AS cu_c_acctbal, c.c_mktsegment AS cu_c_mktsegment
FROM ev FULL OUTER JOIN customer c ON c.c_custkey = ev.user_id""")
def q_join_feature_view_full(spark, sf):
    return FS.feature_view([(_ev_latest(spark, sf), "ev_"), (_customers(spark, sf), "cu_")], "user_id", how="full")


@query("fetch_feature_values", "WITH " + _EV_LATEST + """
SELECT user_id, value, event_type FROM ev WHERE user_id IN (SELECT c_custkey FROM customer)""")
def q_fetch_feature_values(spark, sf):
    # the request batch is every customer key (most have no events: they return nothing)
    req = table(spark, sf, "customer", "c_custkey").select(F.col("c_custkey").alias("user_id"))
    return FS.fetch_feature_values(_ev_latest(spark, sf), req, "user_id", ["value", "event_type"])


@query("join_point_in_time", """
WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
     f AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT l.event_id, l.user_id, l.ts, f.value AS value
FROM l ASOF LEFT JOIN f ON l.user_id = f.user_id AND l.ts >= f.ts""")
def q_join_point_in_time(spark, sf):
    ev = table(spark, sf, "events", "event_id", "user_id", "ts", "event_type", "value")
    labels = ev.where(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    feats = ev.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("fts"), "value", "event_id")
    return FS.point_in_time(labels, feats, "user_id", "ts", "fts", ["value"], tie="event_id")
