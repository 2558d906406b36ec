"""Tabular ML steps.

Split, scaling, imputation and metrics are exact DataFrame computations (SQL
checkable); model fitting uses ``pyspark.ml`` estimators, which train on the
executors.
"""

from __future__ import annotations

import json
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from kestrel.fixed import (IMPUTE_FILL, LOGREG_MAX_ITER, MAX_CLASSES, MAX_DEPTH, N_ESTIMATORS, RUN_NAME,
                           SEED, TOP_IMPORTANCES)
from kestrel.operators.boosting import SoftmaxBoosting, fit_softmax_boosting
from kestrel.operators.quantiles import exact_quantiles

_BUCKET_HEX = 4          # 16**4 = 65536 ordered hash buckets per stratum
FIT_PARALLELISM = 1      # models fitted at once; measured locally: concurrent fits contend for the same cores


# ---------------------------------------------------------------- P7, P8
def drop_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(X, y) — all columns but the target, and the target."""
    return df.drop(target), df.select(target)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns by schema type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]


# ---------------------------------------------------------------- M1 / W5 split
def is_stratified(df: DataFrame, target: str) -> bool:
    """A16 as a decision: stratify when the target is a string or has < 20 distinct values.
    The distinct values are counted exactly, and no further than the limit."""
    if isinstance(df.schema[target].dataType, StringType):
        return True
    return df.where(F.col(target).isNotNull()).select(target).distinct().limit(MAX_CLASSES).count() < MAX_CLASSES


def stratified_split(df: DataFrame, target: str | None, ratio: float, key: Column,
                     seed: int = SEED, stratify: bool | None = None,
                     materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """Exact split.  Rows of each stratum are ordered by md5('<seed>:<key>');
    the first ceil(ratio * n) go to test, the rest to train.

    No window over a whole stratum: rows are counted per (stratum, hash bucket)
    — 65536 ordered buckets — a running sum over those counts places whole
    buckets in test or train, and only the single boundary bucket of each
    stratum is ranked row by row.  A stratum holding a third of the data is
    therefore spread over 65536 groups.

    With ``materialize`` the labelled rows are checkpointed once into the shared
    checkpoint folder (the split is a step output, like the train/test datasets of
    the original pipeline): later steps scan it instead of recomputing the split,
    and a lost executor does not send the job back to the source."""
    if stratify is None:
        stratify = target is not None and is_stratified(df, target)
    # without strata all rows are one; a value made from the row keeps the join below an equi-join
    stratum = (F.coalesce(F.col(target).cast("string"), F.lit("\u0000null")) if stratify and target
               else F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 0))
    # a null key is a key like any other: its rows are split, not lost
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("\u0000null"))))
    t = (df.withColumn("_h", h).withColumn("_s", stratum)
           .withColumn("_b", F.conv(F.substring("_h", 1, _BUCKET_HEX), 16, 10).cast("int")))
    counts = t.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (counts.withColumn("_end", F.sum("_c").over(w))
                    .withColumn("_n", F.sum("_c").over(Window.partitionBy("_s")))
                    .withColumn("_k", F.ceil(F.lit(float(ratio)) * F.col("_n")))
                    .withColumn("_start", F.col("_end") - F.col("_c")))
    # a bucket lies in test, in train, or holds the k-th row of its stratum.  Rows meet their own bucket's row:
    # joined by stratum alone, all rows of one would be in one task
    where = placed.select("_s", "_b", F.col("_start").alias("_before"), "_k", (F.col("_end") <= F.col("_k")).alias("_in"),
                          ((F.col("_start") < F.col("_k")) & (F.col("_k") < F.col("_end"))).alias("_edge"))
    j = t.join(where, ["_s", "_b"])
    whole = j.where(~F.col("_edge")).withColumn("_test", F.col("_in"))
    edge = j.where("_edge")
    rn = F.row_number().over(Window.partitionBy("_s").orderBy("_h"))
    edge = edge.withColumn("_test", F.col("_before") + rn <= F.col("_k"))
    labeled = whole.unionByName(edge).drop("_h", "_s", "_b", "_before", "_k", "_in", "_edge")
    if materialize:
        from kestrel.session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        labeled = labeled.checkpoint(eager=True)
    drop = ["_test"]
    return (labeled.where(~F.col("_test")).drop(*drop), labeled.where(F.col("_test")).drop(*drop))


# ---------------------------------------------------------------- M2, M3, M4
def _one_row_struct(df: DataFrame, fields: dict[str, Column]) -> Column:
    """A scalar subquery returning one struct (computed once, reused by every field access)."""
    return df.select(F.struct(*[v.alias(k) for k, v in fields.items()])).scalar()


def standard_scale(df: DataFrame, cols: list[str], fit: DataFrame | None = None) -> DataFrame:
    """M2: (x - mean) / std_pop, nulls ignored in the fit and kept; zero variance -> divide by 1.
    ``fit`` is the frame the statistics come from (default: ``df`` itself)."""
    if not cols:
        return df
    fit = df if fit is None else fit
    aggs = {}
    for c in cols:
        aggs[f"m_{c}"] = F.avg(F.col(c).cast("double"))
        aggs[f"s_{c}"] = F.stddev_pop(F.col(c).cast("double"))
    st = _one_row_struct(fit.agg(*[v.alias(k) for k, v in aggs.items()]),
                         {k: F.col(k) for k in aggs})
    out = df
    for c in cols:
        sd = st[f"s_{c}"]
        scale = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        out = out.withColumn(c, (F.col(c).cast("double") - st[f"m_{c}"]) / scale)
    return out


def impute(df: DataFrame, numeric: list[str], other: list[str], fill: str = IMPUTE_FILL) -> DataFrame:
    """M3: numeric nulls -> exact median of the column; remaining nulls (strings) -> 'unknown'."""
    out = df
    if numeric:
        med = exact_quantiles(df, numeric)
        st = _one_row_struct(med.agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c)
                                       for c in numeric]), {c: F.col(c) for c in numeric})
        for c in numeric:
            out = out.withColumn(c, F.coalesce(F.col(c), st[c]))
    for c in other:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(fill)))
    return out


def preprocess(df: DataFrame, target: str, fit: DataFrame | None = None) -> DataFrame:
    """M4: scale numeric features, then impute (median of the scaled column,
    'unknown' elsewhere), target re-attached untouched."""
    num = numeric_columns(df, (target,))
    other = [c for c in df.columns if c not in num and c != target]
    scaled = standard_scale(df, num, None if fit is None else fit)
    return impute(scaled, num, other).select(*[c for c in df.columns])


# ---------------------------------------------------------------- A18-A20, A28
def confusion_matrix(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(label, prediction, n)."""
    return pred.groupBy(F.col(y).alias("label"), F.col(p).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 (zero division -> 0).
    Works on the confusion matrix (classes^2 rows), never on rows twice."""
    cm = confusion_matrix(pred, y, p)
    per_label = cm.groupBy("label").agg(F.sum("n").alias("support"),
                                        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))
                                              .otherwise(0)).alias("tp"))
    per_pred = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    cls = per_label.join(per_pred, "label", "full_outer").select(
        "label", F.coalesce("support", F.lit(0)).alias("support"), F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    cls = cls.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    cls = cls.withColumn("f1", f1)
    total = F.sum("support")
    return cls.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"))


def regression_metrics(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Mse, mae, r2 = 1 - SSE/SST (constant target -> r2 null)."""
    e = F.col(y).cast("double") - F.col(p).cast("double")
    a = pred.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                 F.sum(e * e).alias("sse"), (F.var_pop(F.col(y).cast("double")) * F.count(y)).alias("sst"))
    return a.select("mse", "mae", F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst")).alias("r2"))


def running_totals(df: DataFrame, order: str, cols: list[str], descending: bool = False,
                   partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order`` across the whole frame (see
    ``kestrel.operators.cumulative``)."""
    from kestrel.operators.cumulative import running
    return running(df, [], order, cols, "sum", descending, partitions)


def roc_points(pred: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """One ROC point per distinct score (descending): (score, tpr, fpr, tp, fp, pos, neg).
    Totals come with the running sums (no second pass over the predictions)."""
    per = pred.groupBy(score).agg(F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("tp"),
                                  F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).alias("fp"))
    cum = running_totals(per, score, ["tp", "fp"], descending=True)
    return cum.select(score, "tp", "fp", (F.col("cum_tp") / F.col("tot_tp")).alias("tpr"),
                      (F.col("cum_fp") / F.col("tot_fp")).alias("fpr"), "cum_tp", "cum_fp",
                      F.col("tot_tp").alias("pos"), F.col("tot_fp").alias("neg"))


def roc_auc(pred: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Area under the ROC curve by trapezoids over the distinct-score points;
    each point's trapezoid uses only its own counts and running totals."""
    pts = roc_points(pred, y, score)
    area = F.col("fp") * (2 * F.col("cum_tp") - F.col("tp"))
    return pts.agg((F.sum(area) / (2.0 * F.first("pos") * F.first("neg"))).alias("auc"),
                   F.count(F.lit(1)).alias("n_points"))


# ---------------------------------------------------------------- M5-M17 models
def _assembler(features: list[str]):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def estimator(model_type: str, task: str, n_estimators: int = N_ESTIMATORS, max_depth: int = MAX_DEPTH,
              seed: int = SEED, label: str = "label"):
    """Model factory by type and task; unknown type is an error."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    depth = min(max_depth, 30)
    if model_type == "random_forest":
        cls = RandomForestClassifier if task == "classification" else RandomForestRegressor
        return cls(numTrees=n_estimators, maxDepth=depth, seed=seed, labelCol=label, featuresCol="features")
    if model_type == "gradient_boosting":
        if task == "classification":     # M7: one softmax model for all classes, fitted on the plain columns
            return partial(fit_softmax_boosting, rounds=n_estimators, depth=depth)
        return GBTRegressor(maxIter=n_estimators, maxDepth=depth, seed=seed, labelCol=label, featuresCol="features")
    if model_type == "logistic_regression":
        if task != "classification":
            raise ValueError("logistic_regression is for classification")
        return LogisticRegression(maxIter=LOGREG_MAX_ITER, labelCol=label, featuresCol="features")
    raise ValueError(f"unsupported model type: {model_type}")


def fit_model(train: DataFrame, target: str, features: list[str], model_type: str = "random_forest",
              task: str = "classification", n_estimators: int = N_ESTIMATORS, max_depth: int = MAX_DEPTH,
              seed: int = SEED):
    """M5–M9: a PipelineModel (label indexing for classification, assembler, estimator), or the
    boosting of several classes (``SoftmaxBoosting``)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    if (model_type, task) == ("gradient_boosting", "classification"):
        return estimator(model_type, task, n_estimators, max_depth, seed)(train, target, features)
    stages = []
    label = target
    if task == "classification":
        stages.append(StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc"))
        label = "label"
    stages += [_assembler(features), estimator(model_type, task, n_estimators, max_depth, seed, label)]
    # estimators pass over the input many times and are CPU-bound per row: the split is a
    # written table, spread here over all cores and kept while fitting
    owned = not train.is_cached
    if owned:
        train = _spread(train).persist()
    try:
        return Pipeline(stages=stages).fit(train)
    finally:
        if owned:
            train.unpersist()


def _spread(df: DataFrame) -> DataFrame:
    """Rows over all cores: a written split has few partitions when it is small."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def score_model(model, df: DataFrame, target: str, task: str) -> DataFrame:
    """Batch prediction as (y, p) in the target's own values."""
    pred = model.transform(df)
    if isinstance(model, SoftmaxBoosting):
        return pred.select(F.col(target).alias("y"), F.col("prediction").alias("p"))
    if task == "classification":
        labels = model.stages[0].labels
        from pyspark.ml.feature import IndexToString
        pred = IndexToString(inputCol="prediction", outputCol="p_label", labels=labels).transform(pred)
        return pred.select(F.col(target).alias("y"), F.col("p_label").alias("p"))
    return pred.select(F.col(target).cast("double").alias("y"), F.col("prediction").alias("p"))


def evaluate(model, df: DataFrame, target: str, task: str) -> DataFrame:
    """Classification metrics (primary = accuracy) or regression metrics (primary = r2)."""
    pred = score_model(model, df, target, task)
    if task == "classification":
        return classification_metrics(pred).withColumn("primary", F.col("accuracy"))
    return regression_metrics(pred).withColumn("primary", F.col("r2"))


def feature_importance(spark, model, features: list[str], top: int = TOP_IMPORTANCES) -> DataFrame:
    """Importances by feature, largest first, at most ``top`` rows.
    The vector has one entry per feature column (model metadata, not data)."""
    est = model if isinstance(model, SoftmaxBoosting) else model.stages[-1]
    if isinstance(est, SoftmaxBoosting):
        imp = est.importances()
    elif hasattr(est, "featureImportances"):
        imp = est.featureImportances.toArray().tolist()
    else:
        # coefficients of classes cancel in a mean: their sizes are averaged
        imp = abs(est.coefficientMatrix.toArray()).mean(axis=0).tolist()
    df = spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


def save_model(model, path: str, meta: dict) -> None:
    """Persist the model and a metadata row next to it."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if isinstance(model, SoftmaxBoosting):
        model.save(spark, path)
        meta = meta | {"kind": "softmax_boosting"}
    else:
        model.write().overwrite().save(path)
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string").coalesce(1) \
        .write.mode("overwrite").json(path.rstrip("/") + "_meta")


def load_model(spark, path: str):
    """Reload the model and its metadata."""
    from pyspark.ml import PipelineModel
    meta = json.loads(spark.read.json(path.rstrip("/") + "_meta").first()["meta"])
    if meta.get("kind") == "softmax_boosting":
        return SoftmaxBoosting.load(spark, path), meta
    return PipelineModel.load(path), meta


def _fit_all(train: DataFrame, test: DataFrame, specs: list, fit_one) -> list:
    """Fit several models from a small thread pool (each fit is its own stream of Spark jobs; the
    executors interleave them).  Inputs stay cached meanwhile, spread over all cores."""
    from concurrent.futures import ThreadPoolExecutor
    # spread before it is kept: every fit works on these partitions
    train, test = _spread(train).persist(), _spread(test).persist()
    try:
        with ThreadPoolExecutor(max_workers=min(FIT_PARALLELISM, max(1, len(specs)))) as pool:
            return list(pool.map(lambda sp: fit_one(train, test, sp), specs))
    finally:
        train.unpersist()
        test.unpersist()


def grid_search(spark, train: DataFrame, test: DataFrame, target: str, features: list[str],
                grid: list[dict], model_type: str = "random_forest", task: str = "classification") -> DataFrame:
    """Fit every parameter set, score on held-out data; one row per run (run, params, score)."""
    def one(tr, te, item):
        i, params = item
        m = fit_model(tr, target, features, model_type, task, **params)
        s = evaluate(m, te, target, task).select("primary").first()[0]
        return (RUN_NAME.format(i + 1), json.dumps(params, sort_keys=True),
                int(params.get("n_estimators", 0)), int(params.get("max_depth", 0)), float(s))
    rows = _fit_all(train, test, list(enumerate(grid)), one)
    return spark.createDataFrame(rows, "run string, params string, n_estimators int, max_depth int, score double")


def compare_models(spark, train: DataFrame, test: DataFrame, target: str, features: list[str],
                   model_types: list[str], task: str = "classification", **kw) -> DataFrame:
    """Several algorithms on the same split; accuracy (or r2) of each."""
    def one(tr, te, t):
        m = fit_model(tr, target, features, t, task, **kw)
        return (t, float(evaluate(m, te, target, task).select("primary").first()[0]))
    return spark.createDataFrame(_fit_all(train, test, model_types, one), "model_type string, score double")


def custom_step(df: DataFrame, fn, schema: str) -> DataFrame:
    """A user-defined step whose body is pandas: runs per Arrow batch on the executors."""
    return df.mapInPandas(lambda it: (fn(pdf) for pdf in it), schema)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
