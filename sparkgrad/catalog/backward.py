"""Deltas, gradients and single updates of the digit net."""

from pyspark.sql import functions as F

from sparkgrad.catalog import sqltext
from sparkgrad.catalog.forward import DIGITS, digits
from sparkgrad.catalog.registry import query, r6
from sparkgrad.functions import columns as C
from sparkgrad.operators import gradients as G
from sparkgrad.operators import losses, reshape, update
from sparkgrad.plans import forward as plans
from sparkgrad.plans.network import activations
from sparkgrad.plans.training import Options, deltas, gradients
from sparkgrad.session import materialize

LR = 0.5


def _deltas(spark, sf_dir, **options):
    images, state = digits(spark, sf_dir)
    return deltas(images, state, Options(lr=LR, **options))


@query("output_delta", sqltext.DIGITS_BACK + """
SELECT rid AS id, k AS "output", round(p, 6) AS p, round((p - CASE WHEN k = label THEN 1e0 ELSE 0e0 END) ** 2, 6) AS squared_error,
       round(d, 6) + 0e0 AS delta FROM p_0 JOIN d_0 USING (rid, k)""")
def output_delta(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    return losses.output_delta(plans.score(images, state, "array")).selectExpr(
        "id", "output", *r6("p", "squared_error", "delta"))


_HALF = sqltext.DIGITS + """,
half AS (SELECT p.rid AS id, k AS output_k, a, p - CASE WHEN k = p.label THEN 1e0 ELSE 0e0 END AS error
         FROM p_0 AS p JOIN h_0 AS h ON p.rid = h.rid AND p.k = h.j)"""


@query("half_sq_gradient", _HALF + """
SELECT id, output_k AS "output", round(0.5e0 * error * error, 6) AS squared_error, round(error, 6) + 0e0 AS error,
       CASE WHEN a = 0 THEN 0 ELSE 1 END AS relu_grad, round(error * CASE WHEN a = 0 THEN 0 ELSE 1 END * a, 6) + 0e0 AS gradient
FROM half""")
def half_sq_gradient(spark, sf_dir):
    rows = losses.half_squared_gradient(activations(*digits(spark, sf_dir)))
    return rows.selectExpr("id", "output", *r6("squared_error", "error"), "relu_grad", *r6("gradient"))


@query("clip_gradient", _HALF + """
SELECT id, output_k AS "output", round(greatest(least(error * CASE WHEN a = 0 THEN 0 ELSE 1 END * a, 0.05e0), -0.05e0), 6) + 0e0
       AS clipped FROM half""")
def clip_gradient(spark, sf_dir):
    rows = losses.half_squared_gradient(activations(*digits(spark, sf_dir)))
    return rows.selectExpr("id", "output", f"round({C.clip('gradient', 0.05)}, 6) AS clipped")


@query("output_weight_gradient", sqltext.DIGITS_BACK + """
SELECT k AS "output", j AS hidden, round(g, 6) + 0e0 AS gradient FROM g2_0""")
def output_weight_gradient(spark, sf_dir):
    return G.output_weight_gradient(_deltas(spark, sf_dir), DIGITS).selectExpr("output", "hidden", *r6("gradient"))


@query("hidden_error", sqltext.DIGITS_BACK + " SELECT rid AS id, j AS hidden, round(e, 6) + 0e0 AS error FROM er_0")
def hidden_error(spark, sf_dir):
    return G.hidden_error(_deltas(spark, sf_dir)).selectExpr("id", "hidden", *r6("error"))


@query("hidden_weight_gradient", sqltext.DIGITS_BACK + """
SELECT j AS hidden, i AS input, round(g, 6) + 0e0 AS gradient FROM g1_0""")
def hidden_weight_gradient(spark, sf_dir):
    return G.hidden_weight_gradient(_deltas(spark, sf_dir), DIGITS).selectExpr("hidden", "input", *r6("gradient"))


_ALL = sqltext.DIGITS_BACK + """
SELECT layer, unit, input, round(g, 6) + 0e0 AS gradient FROM (
  SELECT 1 AS layer, j AS unit, i AS input, g FROM g1_0 UNION ALL SELECT 1, j, -1, g FROM gb1_0
  UNION ALL SELECT 2, k, j, g FROM g2_0 UNION ALL SELECT 2, k, -1, g FROM gb2_0)"""
_KEYS = ["layer", "out AS unit", "`in` AS input"]


@query("all_gradients", _ALL)
def all_gradients(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    return gradients(images, state, Options(lr=LR), "array").selectExpr(*_KEYS, "round(g, 6) AS gradient")


@query("block_gradients", _ALL)
def block_gradients(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    return gradients(images, state, Options(lr=LR), "block").selectExpr(*_KEYS, "round(g, 6) AS gradient")


@query("sgd_step", sqltext.DIGITS_BACK + "," + sqltext.update(0, LR) + f"""
SELECT layer, unit, input, round(w, 6) + 0e0 AS weight FROM ({sqltext.all_params(1)})""")
def sgd_step(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    moved = update.sgd_update(state.params, gradients(images, state, Options(lr=LR)), LR)
    return moved.selectExpr(*_KEYS, "round(w, 6) AS weight")


@query("array_update", sqltext.DIGITS + "," + sqltext.backward(delta="half") + """
SELECT k AS "output", j AS hidden, round(w - 0.01e0 * g, 6) + 0e0 AS weight FROM w2_0 JOIN g2_0 USING (k, j)""")
def array_update(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    d = deltas(images, state, Options(delta="half"))
    g = G.output_weight_gradient(d, DIGITS).selectExpr("output AS out", "hidden AS `in`", "gradient AS w")
    packed_g = reshape.pack_weights(g).withColumnRenamed("weights", "gradient")
    moved = update.array_update(reshape.pack_weights(state.weights(2)), packed_g, "out", 0.01)
    return moved.selectExpr("out AS output", "posexplode(weights) AS (hidden, weight)").selectExpr(
        "output", "hidden", *r6("weight"))


@query("staged_activations", sqltext.DIGITS + """
SELECT j AS neuron, round(avg(a), 6) + 0e0 AS mean_activation, round(max(a), 6) AS max_activation FROM h_0 GROUP BY j""")
def staged_activations(spark, sf_dir):
    """A staging table between two queries: written once, read by the second."""
    staged = materialize(activations(*digits(spark, sf_dir)).select("id", "a"), "stage")
    units = staged.selectExpr("posexplode(a) AS (neuron, a)").groupBy("neuron")
    return units.agg(F.round(F.avg("a"), 6).alias("mean_activation"), F.round(F.max("a"), 6).alias("max_activation"))
