"""Vector scores (V)."""

from pyspark.sql import functions as F

from bulwark.functions import vectors
from bulwark.operators.selection import score_pool
from bulwark.queries import views
from bulwark.queries.common import rounded
from bulwark.queries.registry import query


@query("softmax", """
    SELECT vec_id, i::INTEGER AS class, round(p, 6) AS p
    FROM (SELECT vec_id, unnest(probs) AS p, generate_subscripts(probs, 1) - 1 AS i FROM v_probs)""")
def softmax(spark, sf):
    return rounded(views.probs(spark, sf).select("vec_id", F.posexplode("probs").alias("class", "p")))


@query("predict_confidence", """
    SELECT vec_id, (list_position(probs, list_max(probs)) - 1)::INTEGER AS prediction,
           round(list_max(probs), 6) AS confidence FROM v_probs""")
def predict_confidence(spark, sf):
    p = F.col("probs")
    return rounded(views.probs(spark, sf).select(
        "vec_id", vectors.prediction(p).alias("prediction"), vectors.confidence(p).alias("confidence")))


@query("prediction_entropy", "SELECT vec_id, round(entropy, 6) AS entropy FROM v_scored")
def prediction_entropy(spark, sf):
    return rounded(views.probs(spark, sf).select("vec_id", vectors.entropy(F.col("probs")).alias("entropy")))


@query("prediction_margin", "SELECT vec_id, round(margin, 6) AS margin FROM v_scored")
def prediction_margin(spark, sf):
    return rounded(views.probs(spark, sf).select("vec_id", vectors.margin(F.col("probs")).alias("margin")))


@query("true_label_loss", """
    SELECT vec_id, y, round(CASE WHEN y < len(probs) THEN -ln(greatest(1e-10, least(1.0, probs[y + 1]))) ELSE 5.0 END, 6)
             AS loss,
           round(CASE WHEN y < len(probs) THEN 1 - greatest(1e-10, least(1.0, probs[y + 1])) ELSE 1.0 END, 6)
             AS confidence_flip
    FROM (SELECT vec_id, probs, CASE WHEN vec_id % 7 = 0 THEN label + 10 ELSE label END AS y FROM v_probs)""")
def true_label_loss(spark, sf):
    """Every seventh label lies outside the classes."""
    p = views.probs(spark, sf).withColumn(
        "y", F.when(F.pmod("vec_id", F.lit(7)) == 0, F.col("label") + 10).otherwise(F.col("label")))
    return rounded(p.select("vec_id", "y", vectors.true_loss(F.col("probs"), F.col("y")).alias("loss"),
                            vectors.confidence_flip(F.col("probs"), F.col("y")).alias("confidence_flip")))


@query("sample_utility", "SELECT vec_id, round(utility, 6) AS utility FROM v_scored")
def sample_utility(spark, sf):
    return rounded(views.scored(spark, sf).select("vec_id", "utility"))


@query("score_pool", """
    SELECT vec_id, label, round(entropy, 6) AS entropy, round(margin, 6) AS margin, round(loss, 6) AS loss,
           round(confidence_flip, 6) AS confidence_flip, round(utility, 6) AS utility FROM v_scored""")
def score(spark, sf):
    return rounded(score_pool(views.probs(spark, sf)).drop("probs"))


@query("pairwise_distance", """
    WITH c AS (SELECT list(p) AS centres FROM (SELECT arg_min(probs, vec_id) AS p FROM v_probs GROUP BY label))
    SELECT vec_id, round(list_min([sqrt(list_sum([(probs[i] - c[i]) * (probs[i] - c[i]) FOR i IN range(1, 11)]))
                                   FOR c IN centres]), 6) AS distance
    FROM v_probs, c""")
def pairwise_distance(spark, sf):
    """Distance of every row to the nearest centre; the centres are the first row of each class."""
    p = views.probs(spark, sf)
    centres = p.groupBy("label").agg(F.min_by("probs", "vec_id").alias("p")).agg(F.collect_list("p").alias("c"))
    with_centres = p.withColumn("centres", centres.scalar())  # one vector per class
    return rounded(with_centres.select(
        "vec_id", vectors.nearest_distance(F.col("probs"), F.col("centres")).alias("distance")))
