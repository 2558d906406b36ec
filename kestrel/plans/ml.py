"""ML queries: exact split / preprocessing / metrics with SQL oracles (M1–M4,
P7, P8, A18–A20, A28) and model steps checked by row counts (M5–M17, O6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.fixed import GRID, RUN_NAME
from kestrel.operators import ml as M
from kestrel.plans.common import rounded
from kestrel.plans.oracle import FEATURES, PREDICTIONS, with_
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.derived import features, predictions
from kestrel.sources.tables import table

from kestrel.fixed import TEST_SPLIT_RATIO as RATIO


def _key():
    return F.concat_ws(":", F.col("entity_id"),
                       F.unix_micros(F.col("feature_timestamp").cast("timestamp")).cast("string"))


_KEY_SQL = "md5('42:' || entity_id || ':' || CAST(epoch_us(feature_timestamp) AS VARCHAR))"


def _split_sql(strat: str) -> str:
    part = f"PARTITION BY {strat}" if strat else ""
    return with_(FEATURES) + f""",
ranked AS (SELECT *, row_number() OVER ({part} ORDER BY {_KEY_SQL}) AS rk,
                  count(*) OVER ({part}) AS n FROM features)
SELECT entity_id, feature_timestamp, category, income,
       CASE WHEN rk <= ceil({RATIO}e0 * n) THEN 'test' ELSE 'train' END AS split
FROM ranked"""


def _labeled_split(spark, sf, target, stratify=None):
    f = features(spark, sf)
    train, test = M.stratified_split(f, target, RATIO, _key(), stratify=stratify)
    cols = ["entity_id", "feature_timestamp", "category", "income"]
    return train.select(*cols, F.lit("train").alias("split")).unionByName(
        test.select(*cols, F.lit("test").alias("split")))


@query("train_test_split", _split_sql("category"))
def q_train_test_split(spark, sf):
    return _labeled_split(spark, sf, "category")          # string target -> stratified


@query("train_test_split_regression", _split_sql(""))
def q_train_test_split_regression(spark, sf):
    return _labeled_split(spark, sf, "income")             # >= 20 distinct -> plain split


# nulls injected by rule for the preprocessing steps
_NULLED = FEATURES + """,
nulled AS (
  SELECT entity_id, feature_timestamp,
         CASE WHEN income < 10 THEN NULL ELSE age END AS age,
         CASE WHEN age % 17 = 0 THEN NULL ELSE income END AS income,
         CASE WHEN age % 23 = 0 THEN NULL ELSE category END AS category,
         CAST(7 AS BIGINT) AS constant
  FROM features)"""


def nulled(spark, sf):
    f = features(spark, sf)
    return f.select(
        "entity_id", "feature_timestamp",
        F.when(F.col("income") < 10, F.lit(None)).otherwise(F.col("age")).alias("age"),
        F.when(F.col("age") % 17 == 0, F.lit(None)).otherwise(F.col("income")).alias("income"),
        F.when(F.col("age") % 23 == 0, F.lit(None)).otherwise(F.col("category")).alias("category"),
        F.lit(7).cast("bigint").alias("constant"))


_SCALED = _NULLED + """,
st AS (SELECT avg(age) AS ma, stddev_pop(age) AS sa, avg(income) AS mi, stddev_pop(income) AS si,
              avg(constant) AS mc, stddev_pop(constant) AS sc FROM nulled),
scaled AS (
  SELECT entity_id, feature_timestamp, category,
         (age - ma) / CASE WHEN sa IS NULL OR sa = 0 THEN 1.0e0 ELSE sa END AS age,
         (income - mi) / CASE WHEN si IS NULL OR si = 0 THEN 1.0e0 ELSE si END AS income,
         (constant - mc) / CASE WHEN sc IS NULL OR sc = 0 THEN 1.0e0 ELSE sc END AS constant
  FROM nulled, st)"""


@query("standard_scale", with_(_SCALED) + """
SELECT entity_id, feature_timestamp, category, round(age, 6) AS age, round(income, 6) AS income,
       round(constant, 6) AS constant FROM scaled""")
def q_standard_scale(spark, sf):
    d = nulled(spark, sf)
    return rounded(M.standard_scale(d, ["age", "income", "constant"]))


@query("impute", with_(_NULLED) + """,
med AS (SELECT median(age) AS a, median(income) AS i FROM nulled)
SELECT entity_id, feature_timestamp, coalesce(category, 'unknown') AS category,
       round(coalesce(age, a), 6) AS age, round(coalesce(income, i), 6) AS income
FROM nulled, med""")
def q_impute(spark, sf):
    d = nulled(spark, sf).drop("constant").withColumn("age", F.col("age").cast("double"))
    return rounded(M.impute(d, ["age", "income"], ["category"]).select(
        "entity_id", "feature_timestamp", "category", "age", "income"))


@query("preprocess", with_(_SCALED) + """,
med AS (SELECT median(age) AS a, median(income) AS i, median(constant) AS c FROM scaled)
SELECT strftime(feature_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS entity_ts, coalesce(entity_id, 'unknown') AS entity_id,
       round(coalesce(age, a), 6) AS age, round(coalesce(income, i), 6) AS income,
       round(coalesce(constant, c), 6) AS constant, category
FROM scaled, med""")
def q_preprocess(spark, sf):
    d = nulled(spark, sf)
    d = d.withColumn("entity_ts", F.date_format("feature_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")) \
         .drop("feature_timestamp")
    return rounded(M.preprocess(d, target="category"))


@query("drop_target_column", with_(FEATURES) + "SELECT entity_id, age, income, feature_timestamp FROM features")
def q_drop_target_column(spark, sf):
    x, _y = M.drop_target(features(spark, sf), "category")
    return x


@query("select_numeric_columns", with_(FEATURES) + "SELECT age, income FROM features")
def q_select_numeric_columns(spark, sf):
    f = features(spark, sf)
    return f.select(*M.numeric_columns(f))


# ------------------------------------------------------------------ metrics
@query("confusion_matrix", with_(PREDICTIONS) + """
SELECT y AS label, p AS prediction, count(*) AS n FROM predictions GROUP BY 1, 2""")
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(predictions(spark, sf))


@query("classification_metrics", with_(PREDICTIONS) + """,
cm AS (SELECT y AS label, p AS prediction, count(*) AS n FROM predictions GROUP BY 1, 2),
pl AS (SELECT label, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cm GROUP BY label),
pp AS (SELECT prediction AS label, sum(n) AS predicted FROM cm GROUP BY prediction),
cls AS (SELECT coalesce(pl.label, pp.label) AS label, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
               coalesce(predicted, 0) AS predicted FROM pl FULL OUTER JOIN pp ON pl.label = pp.label),
m AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0e0 END AS pr,
                CASE WHEN support > 0 THEN tp / support ELSE 0.0e0 END AS rc FROM cls),
m2 AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0e0 END AS f1 FROM m)
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(pr * support) / sum(support), 6) AS precision,
       round(sum(rc * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1
FROM m2""")
def q_classification_metrics(spark, sf):
    return rounded(M.classification_metrics(predictions(spark, sf)))


@query("regression_metrics", """
SELECT round(avg((l_extendedprice - l_quantity * 1500.0e0) ^ 2), 6) AS mse,
       round(avg(abs(l_extendedprice - l_quantity * 1500.0e0)), 6) AS mae,
       round(CASE WHEN var_pop(l_extendedprice) > 0 THEN 1 - sum((l_extendedprice - l_quantity * 1500.0e0) ^ 2)
             / (var_pop(l_extendedprice) * count(l_extendedprice)) END, 6) AS r2
FROM lineitem""")
def q_regression_metrics(spark, sf):
    li = table(spark, sf, "lineitem", "l_extendedprice", "l_quantity")
    pred = li.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500.0).alias("p"))
    return rounded(M.regression_metrics(pred))


_ROC_SQL = with_(PREDICTIONS) + """,
per AS (SELECT score, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS fp
        FROM predictions GROUP BY score),
tot AS (SELECT sum(tp) AS P, sum(fp) AS N FROM per),
cum AS (SELECT score, tp, fp, sum(tp) OVER (ORDER BY score DESC) AS cum_tp, sum(fp) OVER (ORDER BY score DESC) AS cum_fp
        FROM per)"""


@query("roc_points", _ROC_SQL + """
SELECT score, round(cum_tp / P, 6) AS tpr, round(cum_fp / N, 6) AS fpr FROM cum, tot""")
def q_roc_points(spark, sf):
    return rounded(M.roc_points(predictions(spark, sf)).select("score", "tpr", "fpr"))


@query("roc_auc", _ROC_SQL + """
SELECT round(sum(fp * (2 * cum_tp - tp)) / (2.0e0 * max(P) * max(N)), 6) AS auc, count(*) AS n_points FROM cum, tot""")
def q_roc_auc(spark, sf):
    return rounded(M.roc_auc(predictions(spark, sf)))


# ------------------------------------------------------------------ models
#: Counts of a text that tell its language, and two columns that tell nothing.
FEATS = ["th", "accents", "umlauts", "tildes", "vowels", "noise", "noise2"]
TARGET = "lang"


def _texts(spark, sf):
    """Features of the documents with a known language."""
    d = table(spark, sf, "documents", "doc_id", "text", "lang").where(F.col("lang").isNotNull())
    size = F.greatest(F.char_length("text"), F.lit(1))

    def share(pattern: str):
        return (F.regexp_count("text", F.lit(pattern)) / size).cast("double")

    def noise(salt: str):
        return F.pmod(F.crc32(F.concat(F.lit(salt), F.col("doc_id").cast("string")).cast("binary")), F.lit(1000)).cast("double")
    return d.select("doc_id", "lang", size.cast("double").alias("chars"), F.size(F.split("text", " ")).cast("double").alias("words"),
                    share("th").alias("th"), share("[éèêç]").alias("accents"), share("[äöüß]").alias("umlauts"),
                    share("[ñóáíú]").alias("tildes"), share("[aeiou]").alias("vowels"), noise("a").alias("noise"), noise("b").alias("noise2"))


def _text_split(spark, sf, target=TARGET, features=FEATS, stratify=True):
    """Train and test set of the flow: split, then each preprocessed by itself."""
    d = _texts(spark, sf).select("doc_id", *features, target)
    train, test = M.stratified_split(d, target, RATIO, F.col("doc_id").cast("string"), stratify=stratify)
    return M.preprocess(train.drop("doc_id"), target), M.preprocess(test.drop("doc_id"), target)


def _part_split(spark, sf):
    p = table(spark, sf, "part", "p_partkey", "p_size", "p_retailprice")
    train, test = M.stratified_split(p, None, RATIO, F.col("p_partkey").cast("string"), stratify=False)
    return train, test


# Scores of fitted models differ between engines in their last digits.  SQL states the rows scored, the
# share of the largest class, and the step of STEPS that each score reaches; a model that predicts one class, or
# at random, stays on a lower one.  The scores themselves are in ``model_figures`` and ``grid_scores``.
STEPS = (0.5, 0.7, 0.9)

_TEST_SIZE = """
WITH c AS (SELECT ceil(0.2e0 * count(*)) AS t, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang),
s AS (SELECT CAST(sum(t) AS BIGINT) AS n_test, CAST(sum(n) AS BIGINT) AS n_all, count(*) AS n_classes,
             round(max(t) / sum(t), 6) AS majority_share FROM c)"""
_PART_TEST = "CAST(ceil(0.2e0 * count(*)) AS BIGINT)"
_SCORES = ("accuracy", "precision", "recall", "f1")
_REACHED = ", ".join(f"0.9e0 AS {c}_from" for c in _SCORES)


def _step(score):
    """The greatest step that a score reaches, 0 below all."""
    out = F.lit(0.0)
    for s in STEPS:
        out = F.when(score >= s, F.lit(s)).otherwise(out)
    return out


def _classes_sql(name: str, more: str = "") -> str:
    return _TEST_SIZE + f"SELECT '{name}' AS model, n_test, n_classes, majority_share, {_REACHED}{more} FROM s"


def _parts_sql(name: str) -> str:
    return f"SELECT '{name}' AS model, {_PART_TEST} AS n_test, true AS better_than_mean FROM part"


def _class_row(model, test, name):
    """Rows scored, classes among them, share of the largest class, and the steps that the scores reach."""
    pred = M.score_model(model, test, TARGET, "classification")
    reached = M.classification_metrics(pred).select(F.struct(*[_step(F.col(c)).alias(f"{c}_from") for c in _SCORES]).alias("v")).scalar()
    rows = (pred.groupBy("y").agg(F.count(F.lit(1)).alias("n"))
            .agg(F.lit(name).alias("model"), F.sum("n").alias("n_test"), F.count("y").alias("n_classes"),
                 (F.max("n") / F.sum("n")).alias("majority_share")).withColumn("v", reached))
    return rounded(rows.select("model", "n_test", "n_classes", "majority_share", *[f"v.{c}_from" for c in _SCORES]))


def _part_row(model, test, name):
    pred = M.score_model(model, test, "p_retailprice", "regression")
    r2 = M.regression_metrics(pred).select("r2").scalar()
    return pred.agg(F.lit(name).alias("model"), F.count("p").alias("n_test")).withColumn("better_than_mean", r2 > 0)


def _forest(spark, sf):
    """The random forest of the training flow (100 trees, depth 10), with its train and test set."""
    train, test = _text_split(spark, sf)
    return M.fit_model(train, TARGET, FEATS, "random_forest", "classification"), train, test


@query("rf_classifier", _classes_sql("random_forest"))
def q_rf_classifier(spark, sf):
    m, _, test = _forest(spark, sf)
    return _class_row(m, test, "random_forest")


@query("rf_regressor", _parts_sql("random_forest"))
def q_rf_regressor(spark, sf):
    train, test = _part_split(spark, sf)
    m = M.fit_model(train, "p_retailprice", ["p_partkey", "p_size"], "random_forest", "regression")
    return _part_row(m, test, "random_forest")


@query("gbt_classifier", _classes_sql("gradient_boosting"))
def q_gbt_classifier(spark, sf):
    """M7: 100 rounds of depth 10, all classes in one softmax model."""
    train, test = _text_split(spark, sf)
    m = M.fit_model(train, TARGET, FEATS, "gradient_boosting", "classification")
    return _class_row(m, test, "gradient_boosting")


@query("gbt_regressor", _parts_sql("gradient_boosting"))
def q_gbt_regressor(spark, sf):
    train, test = _part_split(spark, sf)
    m = M.fit_model(train, "p_retailprice", ["p_partkey", "p_size"], "gradient_boosting", "regression")
    return _part_row(m, test, "gradient_boosting")


@query("logistic_regression", _classes_sql("logistic_regression"))
def q_logistic_regression(spark, sf):
    train, test = _text_split(spark, sf)
    m = M.fit_model(train, TARGET, FEATS, "logistic_regression", "classification")
    return _class_row(m, test, "logistic_regression")


@query("model_dispatch", """
SELECT 'lang' AS target, 'classification' AS task, 'RandomForestClassificationModel' AS model, 0.9e0 AS score_from
UNION ALL SELECT 'chars', 'regression', 'RandomForestRegressionModel', 0.7e0""")
def q_model_dispatch(spark, sf):
    """The task from the target's values (A16), the estimator from (model_type, task), both fitted and
    scored; an unknown type is an error."""
    rows = []
    for target, features in (("lang", FEATS), ("chars", ["words"])):
        d = _texts(spark, sf)
        task = "classification" if M.is_stratified(d, target) else "regression"
        train, test = _text_split(spark, sf, target, features, task == "classification")
        m = M.fit_model(train, target, features, "random_forest", task)
        score = M.evaluate(m, test, target, task).select(_step(F.col("primary"))).scalar()
        rows.append(spark.range(1).select(F.lit(target).alias("target"), F.lit(task).alias("task"),
                                          F.lit(type(m.stages[-1]).__name__).alias("model"),
                                          (F.least(score, F.lit(0.7)) if task == "regression" else score).alias("score_from")))
    try:
        M.estimator("unheard_of", "classification")
        raise RuntimeError("an unknown model type was accepted")
    except ValueError:
        pass
    return rows[0].unionByName(rows[1])


@query("score_model", """
SELECT lang AS y, CAST(ceil(0.2e0 * count(*)) AS BIGINT) AS n, true AS mostly_right FROM documents
WHERE lang IS NOT NULL GROUP BY lang""")
def q_score_model(spark, sf):
    """Rows scored of each class, and whether most of them get their own class."""
    m, _, test = _forest(spark, sf)
    return M.score_model(m, test, TARGET, "classification").groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.col("p").eqNullSafe(F.col("y")).cast("int")) > 0.5).alias("mostly_right"))


@query("evaluate_model", _TEST_SIZE + f"SELECT n_test, n_all - n_test AS n_train, {_REACHED}, true AS train_not_worse FROM s")
def q_evaluate_model(spark, sf):
    """The steps that the test scores reach, and the training score not below the test score by more than chance."""
    m, train, test = _forest(spark, sf)
    train_score = M.evaluate(m, train, TARGET, "classification").select("primary").scalar()
    sizes = [d.agg(F.count(F.lit(1))).scalar() for d in (test, train)]
    return M.evaluate(m, test, TARGET, "classification").select(
        sizes[0].alias("n_test"), sizes[1].alias("n_train"), *[_step(F.col(c)).alias(f"{c}_from") for c in _SCORES],
        (train_score >= F.col("primary") - 0.05).alias("train_not_worse"))


@query("feature_importance", "SELECT unnest(['th', 'accents', 'umlauts', 'tildes', 'vowels']) AS feature, true AS sums_to_one, true AS above_noise")
def q_feature_importance(spark, sf):
    """The five features that matter most, above the ones that tell nothing."""
    m, _, _ = _forest(spark, sf)
    every = M.feature_importance(spark, m, FEATS, len(FEATS))
    total = every.agg(F.sum("importance")).scalar()
    noise = every.where(F.col("feature").startswith("noise")).agg(F.max("importance")).scalar()
    return M.feature_importance(spark, m, FEATS).select("feature", (F.abs(total - 1.0) < 1e-6).alias("sums_to_one"),
                                                        (F.col("importance") > 2 * noise).alias("above_noise"))


@query("model_figures")
def q_model_figures(spark, sf):
    """M11-M13 in figures: scores and importances of the forest, beside the share of the largest class."""
    m, _, test = _forest(spark, sf)
    pred = M.score_model(m, test, TARGET, "classification")
    scores = M.classification_metrics(pred)
    share = pred.groupBy("y").agg(F.count(F.lit(1)).alias("n")).agg((F.max("n") / F.sum("n")).alias("majority_share"))
    rows = [scores.select(F.lit(c).alias("figure"), F.col(c).alias("value")) for c in _SCORES]
    rows.append(share.select(F.lit("majority_share").alias("figure"), F.col("majority_share").alias("value")))
    rows.append(M.feature_importance(spark, m, FEATS, len(FEATS)).select(
        F.concat(F.lit("importance of "), F.col("feature")).alias("figure"), F.col("importance").alias("value")))
    return rounded(M.union_all(rows))


@query("save_load_model", """
SELECT lang AS y, CAST(ceil(0.2e0 * count(*)) AS BIGINT) AS n, true AS same, 'random_forest' AS model_type
FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def q_save_load_model(spark, sf):
    """The loaded model predicts what the saved one does."""
    m, _, test = _forest(spark, sf)
    path = scratch_path(spark, "model")
    M.save_model(m, path, {"model_type": "random_forest", "task": "classification"})
    m2, meta = M.load_model(spark, path)
    before = M.score_model(m, test, TARGET, "classification").groupBy("y", "p").agg(F.count(F.lit(1)).alias("n"))
    after = M.score_model(m2, test, TARGET, "classification").groupBy("y", "p").agg(F.count(F.lit(1)).alias("n2"))
    return (before.join(after, ["y", "p"], "full_outer").groupBy("y")
            .agg(F.sum("n").alias("n"), F.min(F.col("n").eqNullSafe(F.col("n2"))).alias("same"))
            .withColumn("model_type", F.lit(meta["model_type"])))


def _grid(spark, sf):
    train, test = _text_split(spark, sf)
    return M.grid_search(spark, train, test, TARGET, FEATS, GRID)


@query("grid_search", "SELECT * FROM (VALUES " + ", ".join(
    f"('{RUN_NAME.format(i + 1)}', {g['n_estimators']}, {g['max_depth']}, 0.9e0)" for i, g in enumerate(GRID))
    + ") AS t(run, n_estimators, max_depth, score_from)")
def q_grid_search(spark, sf):
    """The step that the held-out score of each parameter set reaches."""
    return _grid(spark, sf).select("run", "n_estimators", "max_depth", _step(F.col("score")).alias("score_from"))


@query("compare_models", "SELECT unnest(['random_forest', 'gradient_boosting', 'logistic_regression']) AS model_type, 0.9e0 AS score_from")
def q_compare_models(spark, sf):
    """Three algorithms at the flow's settings (100 estimators of depth 10) on one split."""
    train, test = _text_split(spark, sf)
    out = M.compare_models(spark, train, test, TARGET, FEATS, ["random_forest", "gradient_boosting", "logistic_regression"])
    return out.select("model_type", _step(F.col("score")).alias("score_from"))


@query("train_evaluate_flow", _classes_sql("random_forest", ", 'classification' AS task"))
def q_train_evaluate_flow(spark, sf):
    """Scan -> split -> preprocess train and test separately -> dispatch -> evaluate."""
    from kestrel.sources.tables import scan_columns
    f = scan_columns(_texts(spark, sf), ["doc_id"] + FEATS, TARGET)
    train, test = M.stratified_split(f, TARGET, RATIO, F.col("doc_id").cast("string"))
    train = M.preprocess(train.drop("doc_id"), TARGET)
    test = M.preprocess(test.drop("doc_id"), TARGET)
    task = "classification" if M.is_stratified(train, TARGET) else "regression"
    m = M.fit_model(train, TARGET, FEATS, "random_forest", task)
    return _class_row(m, test, "random_forest").withColumn("task", F.lit(task))


@query("custom_step", with_(FEATURES) + "SELECT entity_id, greatest(least(income, 200.0e0), 20.0e0) AS income FROM features")
def q_custom_step(spark, sf):
    """A pandas-bodied step (here: per-batch clipping of income into [20, 200])."""
    f = features(spark, sf).select("entity_id", "income")

    def clip(pdf):
        pdf = pdf.copy()
        pdf["income"] = pdf["income"].clip(20.0, 200.0)
        return pdf
    return M.custom_step(f, clip, "entity_id string, income double")


@query("stratified_split", """
WITH d AS (SELECT l.doc_id, l.quality, d.n_chars FROM labels l JOIN documents d USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || CAST(doc_id AS VARCHAR))) AS rk,
             count(*) OVER (PARTITION BY quality) AS n FROM d)
SELECT doc_id, quality, n_chars, CASE WHEN rk <= ceil(0.2e0 * n) THEN 'test' ELSE 'train' END AS split FROM r""")
def q_stratified_split(spark, sf):
    """W5 on an integer target with two classes (stratified because < 20 distinct values)."""
    d = table(spark, sf, "labels", "doc_id", "quality").join(table(spark, sf, "documents", "doc_id", "n_chars"),
                                                              "doc_id")
    train, test = M.stratified_split(d, "quality", RATIO, F.col("doc_id").cast("string"))
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
