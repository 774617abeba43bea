"""The two-input sigmoid net, seeded from the worked example, over all lineitem rows."""

from sparkgrad.catalog import sqltext
from sparkgrad.catalog.forward import digits
from sparkgrad.catalog.registry import query, r6
from sparkgrad.operators import gradients as G
from sparkgrad.operators import init, reports
from sparkgrad.plans.forward import unit_values
from sparkgrad.plans.network import Network, State
from sparkgrad.plans.training import Options, deltas, sweep
from sparkgrad.sources import readers

PAIR = Network(2, 2, 2, hidden="sigmoid", output="sigmoid")

# The worked example's start weights by [to][from] node, and its biases.
SEED_W1 = [[0.15, 0.20], [0.25, 0.30]]
SEED_B1 = [0.35, 0.35]
SEED_W2 = [[0.40, 0.50], [0.45, 0.55]]
SEED_B2 = [0.6, 0.6]

# Learning rate, clip bound and output targets of the three variants.
VARIANTS = [
    ("lr_050", 0.5, None, [0.01, 0.99]),
    ("lr_025", 0.25, 1.0, [0.6, 0.4]),
    ("lr_010", 0.1, 1.0, [0.25, 0.75]),
]
VARIANT_SCHEMA = "variant string, lr double, clip double, target array<double>"
TARGET = (0.01, 0.99)


def seed_state(spark) -> State:
    return State(PAIR, init.literal_params(spark, SEED_W1, SEED_B1, SEED_W2, SEED_B2))


def pairs(spark, sf_dir):
    return readers.lineitem_pairs(spark, sf_dir), seed_state(spark)


def sql_steps(steps: int, lr: float, clip: float | None, target, squash=("sigmoid", "sigmoid")) -> list[str]:
    parts = []
    for n in range(steps):
        parts += [sqltext.forward(n, *squash), sqltext.backward(n, *squash, targets=target),
                  sqltext.update(n, lr, clip, update_bias=False)]
    return parts


_FORWARD = sqltext.chain(sqltext.PAIRS_X, sqltext.SEED_PARAMS, sqltext.forward(0, "sigmoid", "sigmoid"))
_BACK = _FORWARD + "," + sqltext.backward(0, "sigmoid", "sigmoid", targets=TARGET)


@query("sigmoid_layer", _FORWARD + """
SELECT l_orderkey AS id, j + 1 AS hidden, round(a, 6) AS hidden_value FROM h_0 JOIN lines USING (rid)""")
def sigmoid_layer(spark, sf_dir):
    rows = unit_values(*pairs(spark, sf_dir)).selectExpr("id", "posexplode(a) AS (j, hidden_value)")
    return rows.selectExpr("id", "j + 1 AS hidden", *r6("hidden_value"))


@query("seed_weights", _FORWARD + """
SELECT l_orderkey AS id, k + 1 AS output_node, round(p, 6) AS predicted_value FROM p_0 JOIN lines USING (rid)""")
def seed_weights(spark, sf_dir):
    rows = unit_values(*pairs(spark, sf_dir)).selectExpr("id", "posexplode(p) AS (k, predicted_value)")
    return rows.selectExpr("id", "k + 1 AS output_node", *r6("predicted_value"))


@query("distinct_activations", _FORWARD + " SELECT DISTINCT j + 1 AS hidden, round(a, 6) AS hidden_value FROM h_0")
def distinct_activations(spark, sf_dir):
    return reports.distinct_activations(sigmoid_layer(spark, sf_dir), ["hidden", "hidden_value"])


def _deltas(spark, sf_dir):
    examples, state = pairs(spark, sf_dir)
    return deltas(examples, state, Options(lr=0.5, target=TARGET))


@query("sigmoid_output_gradient", _BACK + """
SELECT k + 1 AS output_node, j + 1 AS hidden, round(g, 6) + 0e0 AS gradient FROM g2_0""")
def sigmoid_output_gradient(spark, sf_dir):
    g = G.output_weight_gradient(_deltas(spark, sf_dir), PAIR)
    return g.selectExpr("output + 1 AS output_node", "hidden + 1 AS hidden", *r6("gradient"))


@query("sigmoid_hidden_gradient", _BACK + """
SELECT j + 1 AS hidden, i + 1 AS input_node, round(g, 6) + 0e0 AS gradient FROM g1_0""")
def sigmoid_hidden_gradient(spark, sf_dir):
    g = G.hidden_weight_gradient(_deltas(spark, sf_dir), PAIR)
    return g.selectExpr("hidden + 1 AS hidden", "input + 1 AS input_node", *r6("gradient"))


def _sweep_sql(steps: int) -> str:
    # Each variant's chain is its own subquery, so the CTE names do not meet.
    parts = []
    for name, lr, clip, target in VARIANTS:
        body = sqltext.chain(sqltext.PAIRS_X, sqltext.SEED_PARAMS, *sql_steps(steps, lr, clip, tuple(target)))
        parts.append(f"SELECT '{name}' AS variant, * FROM ({body} SELECT * FROM ({sqltext.all_params(steps)}))")
    return ("SELECT variant, layer, unit, input, round(w, 6) + 0e0 AS weight FROM ("
            + " UNION ALL ".join(parts) + ")")


@query("variant_sweep", _sweep_sql(2))
def variant_sweep(spark, sf_dir):
    examples, state = pairs(spark, sf_dir)
    variants = spark.createDataFrame(VARIANTS, VARIANT_SCHEMA)
    trained = sweep(examples, state, variants, 2)
    return trained.selectExpr("variant", "layer", "out AS unit", "`in` AS input", "round(w, 6) AS weight")


# The digit net's two learning rates. A name is data and may hold any character.
DIGIT_VARIANTS = [("lr .01 (it's fast)", 0.01, None, None), ("lr .0001", 0.0001, None, None)]


def _digit_sweep_sql(steps: int) -> str:
    parts = []
    for name, lr, _, _ in DIGIT_VARIANTS:
        chain = [sqltext.EMBEDDINGS_X, sqltext.pattern_params(64, 10, 10)]
        for n in range(steps):
            chain += [sqltext.forward(n), sqltext.backward(n), sqltext.update(n, lr, None, update_bias=False)]
        quoted = name.replace("'", "''")
        parts.append(f"SELECT '{quoted}' AS variant, * FROM ({sqltext.chain(*chain)} SELECT * FROM ({sqltext.all_params(steps)}))")
    return ("SELECT variant, layer, unit, input, round(w, 6) + 0e0 AS weight FROM (" + " UNION ALL ".join(parts) + ")")


@query("variant_sweep_digits", _digit_sweep_sql(2))
def variant_sweep_digits(spark, sf_dir):
    """The softmax net, with labels and without targets."""
    images, state = digits(spark, sf_dir)
    trained = sweep(images, state, spark.createDataFrame(DIGIT_VARIANTS, VARIANT_SCHEMA), 2)
    return trained.selectExpr("variant", "layer", "out AS unit", "`in` AS input", "round(w, 6) AS weight")
