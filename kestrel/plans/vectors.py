"""Vector-search queries over ``embeddings``: the queries are the rows whose vec_id is divisible by 50,
searched in all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.scalars import round_half_away

from kestrel.operators import vectors as V
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.tables import table

K = 10

_Q = "q AS (SELECT vec_id AS qid, embedding AS qvec FROM embeddings WHERE vec_id % 50 = 0)"


def _rank_sql(scored: str, k: int = K) -> str:
    return f"""
SELECT qid, vec_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC NULLS LAST, vec_id) AS rank FROM ({scored}))
WHERE rank <= {k}"""


def _emb(spark, sf):
    return table(spark, sf, "embeddings", "vec_id", "embedding", "label")


def _queries(emb):
    return emb.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))


def _out(df):
    return df.select("qid", "vec_id", round_half_away("score", 6).alias("score"), "rank")


@query("knn_by_entity", "WITH " + _Q + _rank_sql("""
  SELECT q.qid, e.vec_id, list_cosine_similarity(q.qvec::DOUBLE[], e.embedding::DOUBLE[]) AS score
  FROM q CROSS JOIN embeddings e WHERE q.qid <> e.vec_id"""))
def q_knn_by_entity(spark, sf):
    e = _emb(spark, sf)
    return _out(V.knn(e, _queries(e), K))


@query("knn_topk", "WITH " + _Q + _rank_sql("""
  SELECT q.qid, e.vec_id, list_cosine_similarity(q.qvec::DOUBLE[], e.embedding::DOUBLE[]) AS score
  FROM q CROSS JOIN embeddings e WHERE q.qid <> e.vec_id""", 3))
def q_knn_topk(spark, sf):
    e = _emb(spark, sf)
    return _out(V.top_k(V.score_all(e, _queries(e), "vec_id", "embedding", best=3), 3, "vec_id"))


@query("knn_by_vector", """
WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
c AS (SELECT -1 - label::BIGINT AS qid, list(m ORDER BY pos) AS qvec FROM (
        SELECT label, pos, avg(v) AS m FROM x GROUP BY label, pos) GROUP BY label)
""" + _rank_sql("""
  SELECT c.qid, e.vec_id, list_cosine_similarity(c.qvec, e.embedding::DOUBLE[]) AS score
  FROM c CROSS JOIN embeddings e"""))
def q_knn_by_vector(spark, sf):
    """V2: given vectors that are no rows of the table, here the mean of each label (qid -1 - label)."""
    e = _emb(spark, sf)
    cen = (e.select("label", F.posexplode(F.col("embedding").cast("array<double>")))
            .groupBy("label", "pos").agg(F.avg("col").alias("m"))
            .groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("qvec"))
            .select((F.lit(-1) - F.col("label").cast("bigint")).alias("qid"), "qvec"))
    return _out(V.knn(e, cen, K, exclude_self=False))


@query("knn_filtered", "WITH " + _Q + _rank_sql("""
  SELECT q.qid, e.vec_id, list_cosine_similarity(q.qvec::DOUBLE[], e.embedding::DOUBLE[]) AS score
  FROM q CROSS JOIN embeddings e WHERE q.qid <> e.vec_id AND e.label IN (1, 2, 3)"""))
def q_knn_filtered(spark, sf):
    e = _emb(spark, sf)
    return _out(V.knn(e, _queries(e), K, where=F.col("label").isin(1, 2, 3)))


@query("knn_crowding", "WITH " + _Q + """,
s AS (SELECT q.qid, e.vec_id, e.label, list_cosine_similarity(q.qvec::DOUBLE[], e.embedding::DOUBLE[]) AS score
      FROM q CROSS JOIN embeddings e WHERE q.qid <> e.vec_id),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY score DESC NULLS LAST, vec_id) AS cr
                     FROM s) WHERE cr <= 2)""" + _rank_sql("SELECT qid, vec_id, score FROM c"))
def q_knn_crowding(spark, sf):
    e = _emb(spark, sf)
    return _out(V.knn_crowding(e, _queries(e), K, 2, "label"))


def _ann(spark, sf):
    """(neighbours, candidates, figures) of the approximate search; figures: one row with the queries, the recall
    against exact search and the candidates as a share of all pairs of a query and a row."""
    e = _emb(spark, sf)
    q = _queries(e)
    index = V.fit_inverted_file(e, K)

    def once(df, name):                               # written once: the search, the result and the figures use them
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    cand = once(V.ann_candidates(index, e, q, K), "ann-candidates")
    found = once(V.ann_search(cand, e, q, K), "ann-found")
    exact = once(V.knn(e, q, K).select("qid", "vec_id", F.lit(1).alias("hit")), "ann-exact")
    hits = found.join(exact, ["qid", "vec_id"], "left").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits"))
    figures = (hits.select("n", (F.col("hits") / exact.agg(F.count("hit")).scalar()).alias("recall"))
               .withColumn("n_queries", q.agg(F.count("qid")).scalar())
               .withColumn("candidate_share", cand.agg(F.count("qid")).scalar()
                           / (F.col("n_queries") * e.agg(F.count("vec_id")).scalar())))
    return found, figures


@query("ann_lsh", f"""
SELECT count(*) AS n_queries, {K} * count(*) AS n_neighbours, true AS recall_reached, true AS few_candidates
FROM embeddings WHERE vec_id % 50 = 0""")
def q_ann_lsh(spark, sf):
    """V5: approximate neighbours of all queries; whether nine of ten are exact ones, and whether fewer than a
    tenth of all pairs were scored for that."""
    _, figures = _ann(spark, sf)
    return figures.select("n_queries", F.col("n").alias("n_neighbours"), (F.col("recall") >= 0.9).alias("recall_reached"),
                          (F.col("candidate_share") < 0.1).alias("few_candidates"))


@query("ann_neighbours")
def q_ann_neighbours(spark, sf):
    """V5: the approximate neighbours themselves, with the measured recall and share of candidates of the search."""
    found, figures = _ann(spark, sf)
    one = figures.select(F.struct(F.round("recall", 4).alias("recall"), F.round("candidate_share", 4).alias("candidate_share")).alias("f")).scalar()
    return _out(found).withColumn("f", one).select("qid", "vec_id", "score", "rank", "f.recall", "f.candidate_share")


@query("crowding_topk", "WITH " + _Q + """,
s AS (SELECT q.qid, e.vec_id, e.label, list_cosine_similarity(q.qvec::DOUBLE[], e.embedding::DOUBLE[]) AS score
      FROM q CROSS JOIN embeddings e WHERE q.qid <> e.vec_id),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY score DESC NULLS LAST, vec_id) AS cr
                     FROM s) WHERE cr <= 1)""" + _rank_sql("SELECT qid, vec_id, score FROM c", 5))
def q_crowding_topk(spark, sf):
    """One neighbour per label at most, five overall."""
    e = _emb(spark, sf)
    return _out(V.knn_crowding(e, _queries(e), 5, 1, "label"))
