"""Feature store as DataFrame plans.

* latest value per entity is a hash aggregation (``max_by`` of the row by
  (timestamp, tie-break)) — partial aggregation per partition, so a hot entity
  never lands in one task;
* the point-in-time (as-of) join never sorts a whole entity in one task: the stream of
  labels and features is cut at sampled bounds of (entity, time), and the last feature of a
  range is carried to the later ranges of its entity.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.cumulative import last_value


# ---------------------------------------------------------------- R1-R3, P11 registry
@dataclass
class FeatureGroup:
    name: str
    source: DataFrame
    entity_columns: list[str]
    timestamp_column: str | None = None
    features: dict[str, str] = field(default_factory=dict)     # name -> description
    labels: dict[str, str] = field(default_factory=dict)
    feature_labels: dict[str, dict[str, str]] = field(default_factory=dict)

    def frame(self) -> DataFrame:
        """The validated group frame: keys, timestamp, registered features (all columns when none)."""
        cols = list(self.features) or [c for c in self.source.columns
                                       if c not in self.entity_columns and c != self.timestamp_column]
        missing = [c for c in self.entity_columns + cols + ([self.timestamp_column] if self.timestamp_column else [])
                   if c not in self.source.columns]
        if missing:
            raise ValueError(f"feature group {self.name}: unknown columns {missing}")
        keys = self.entity_columns + ([self.timestamp_column] if self.timestamp_column else [])
        return self.source.select(*keys, *cols)


class Registry:
    """Feature groups by name; creating an existing group reuses it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.groups: dict[str, FeatureGroup] = {}
        self.monitors: dict[str, list[str]] = {}

    def create_group(self, name: str, source: DataFrame, entity_columns: list[str],
                     timestamp_column: str | None = None, labels: dict[str, str] | None = None) -> FeatureGroup:
        if name in self.groups:
            return self.groups[name]
        g = FeatureGroup(name, source, list(entity_columns), timestamp_column, labels=dict(labels or {}))
        self.groups[name] = g
        return g

    def create_feature(self, group: str, feature: str, description: str = "", labels: dict[str, str] | None = None) -> None:
        g = self.groups[group]
        if feature not in g.source.columns:
            raise ValueError(f"{feature} is not a column of {group}")
        g.features.setdefault(feature, description)
        g.feature_labels.setdefault(feature, dict(labels or {}))

    def list_features(self, group: str) -> DataFrame:
        """(group, feature, type, description, labels) from the source schema; a feature has its group's labels,
        and its own over them."""
        g = self.groups[group]
        types = {f.name: f.dataType.simpleString() for f in g.source.schema.fields}
        rows = [(group, f, types[f], d, g.labels | g.feature_labels.get(f, {})) for f, d in g.features.items()]
        return self.spark.createDataFrame(rows, "group string, feature string, type string, description string, labels map<string,string>")

    def search(self, term: str = "", labels: dict[str, str | None] | None = None) -> DataFrame:
        """Registered features whose name or description contains ``term`` and which have all ``labels`` (a
        value of None: the key with any value)."""
        frames = [self.list_features(g) for g in self.groups]
        if not frames:
            return self.spark.createDataFrame(
                [], "group string, feature string, type string, description string, labels map<string,string>")
        t = term.lower()
        found = reduce(DataFrame.unionByName, frames).where(F.lower("feature").contains(t) | F.lower("description").contains(t))
        for key, value in (labels or {}).items():
            found = found.where(F.map_contains_key("labels", key) if value is None else F.col("labels")[key] == value)
        return found

    def delete_group(self, name: str) -> bool:
        """Delete monitors, then features, then the group; missing is success."""
        self.monitors.pop(name, None)
        g = self.groups.pop(name, None)
        if g is not None:
            g.features.clear()
        return True


# ---------------------------------------------------------------- W2, R4, R5
def latest_per_entity(df: DataFrame, keys: list[str], ts: str, tie: list[str] | None = None) -> DataFrame:
    """The newest row per entity by (ts, tie...) as a hash aggregation."""
    tie = tie or []
    values = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(ts), *[F.col(c) for c in tie])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in values]), order).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in values])


def offline_export(df: DataFrame, path: str, features: list[str] | None = None, keys: list[str] | None = None) -> str:
    """Export all history (or the selected features) of a group as Parquet."""
    cols = (keys or []) + (features or [c for c in df.columns if c not in (keys or [])])
    df.select(*cols).write.mode("overwrite").parquet(path)
    return path


def online_sync(df: DataFrame, keys: list[str], ts: str, path: str, tie: list[str] | None = None) -> str:
    """Copy only the latest value per entity into the serving table (overwrite)."""
    latest_per_entity(df, keys, ts, tie).write.mode("overwrite").parquet(path)
    return path


# ---------------------------------------------------------------- J3, J8
def feature_view(frames: list[tuple[DataFrame, str]], key: str, how: str = "left") -> DataFrame:
    """Features from several groups side by side on the entity id.  ``frames`` is a
    list of (latest-value frame, prefix); the first frame drives a left join, or a full
    outer join when ``how='full'``."""
    out = None
    for df, prefix in frames:
        d = df.select(F.col(key), *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != key])
        if out is None:
            out = d
        elif how == "full":
            out = out.join(d, key, "full_outer")
        else:
            out = out.join(d, key, "left")
    return out


def fetch_feature_values(latest: DataFrame, requested: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Batch lookup of requested entity ids (left semi join) and chosen features."""
    return latest.join(requested.select(key).distinct(), key, "left_semi").select(key, *features)


# ---------------------------------------------------------------- J4 point in time
def point_in_time(labels: DataFrame, feats: DataFrame, key: str, label_ts: str, feat_ts: str,
                  values: list[str], tie: str | None = None, partitions: int | None = None) -> DataFrame:
    """For every label row, the latest feature row of the same entity with
    feature time <= label time (a feature at the same instant counts); no such row
    -> nulls.  Ties among feature rows at one instant break on ``tie``.

    Labels and features are one ordered stream in which the last feature is carried on
    (``last_value``): an entity with a third of all rows, even within one instant's neighbourhood, is
    cut into ranges like any other stretch of the stream."""
    lcols = labels.columns
    tcol = F.col(tie) if tie else F.lit(0)
    lab = labels.select(F.struct(*[F.col(c) for c in lcols]).alias("_l"), F.col(key).alias("_k"),
                        F.col(label_ts).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_tie"))
    # a null entity or time matches nothing
    fea = feats.where(F.col(key).isNotNull() & F.col(feat_ts).isNotNull()).select(
        F.col(key).alias("_k"), F.col(feat_ts).alias("_t"), F.lit(0).alias("_side"), tcol.cast("long").alias("_tie"),
        F.struct(*[F.col(v) for v in values]).alias("_f"))
    lab = lab.withColumn("_f", F.lit(None).cast(fea.schema["_f"].dataType))
    fea = fea.withColumn("_l", F.lit(None).cast(lab.schema["_l"].dataType))
    got = last_value(lab.unionByName(fea), ["_k"], ["_t", "_side", "_tie"], "_f", "_got", partitions, "as-of")
    return got.where(F.col("_side") == 1).select(*[F.col(f"_l.{c}").alias(c) for c in lcols],
                                                 *[F.col(f"_got.{v}").alias(v) for v in values])
