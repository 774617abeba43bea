"""Layers, forward passes, predictions and scores."""

from sparkgrad.catalog import sqltext
from sparkgrad.catalog.registry import query, r6
from sparkgrad.functions import columns as C
from sparkgrad.operators import layers, losses, reports, reshape
from sparkgrad.plans import forward as plans
from sparkgrad.plans.network import Network, State
from sparkgrad.sources import readers

DIGITS = Network(64, 10, 10)
LINES = Network(4, 10, 8)

_P = "round(p, 6) AS p"
_ROWS = sqltext.DIGITS + f' SELECT rid AS id, k AS "output", {_P} FROM p_0'


def digits(spark, sf_dir):
    return readers.embedding_images(spark, sf_dir), State.pattern(spark, DIGITS)


def _hidden_z(spark, sf_dir, **options):
    images, state = digits(spark, sf_dir)
    x = reshape.to_long(images, "id")
    return layers.dense_rows(x, state.weights(1), state.biases(1), keys=["id"], n_weights=640, **options)


def _output_z(spark, sf_dir, join_key="in"):
    _, state = digits(spark, sf_dir)
    a = layers.relu_rows(_hidden_z(spark, sf_dir), ["id"]).selectExpr("id", "out AS `in`", "a AS v")
    return layers.dense_rows(a, state.weights(2), state.biases(2), keys=["id"], n_weights=100, join_key=join_key)


_Z1 = sqltext.DIGITS + " SELECT rid AS id, j AS neuron, round(z, 6) + 0e0 AS z FROM z1_0"


@query("dense_hidden", _Z1)
def dense_hidden(spark, sf_dir):
    return _hidden_z(spark, sf_dir).selectExpr("id", "out AS neuron", *r6("z"))


@query("dense_hidden_shuffled", _Z1)
def dense_hidden_shuffled(spark, sf_dir):
    """The layer as it runs when the weights are too large to broadcast."""
    return _hidden_z(spark, sf_dir, broadcast_limit=0).selectExpr("id", "out AS neuron", *r6("z"))


@query("dense_packed", _Z1)
def dense_packed(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    x = reshape.to_long(images, "id")
    z = layers.dense_packed(x, state.weights(1), state.biases(1), keys=["id"], n_in=64, n_out=10)
    return reshape.array_to_rows(z, ["id"], "z", "neuron", "z").selectExpr("id", "neuron", *r6("z"))


@query("relu_layer", sqltext.DIGITS + " SELECT rid AS id, j AS neuron, round(a, 6) + 0e0 AS activated_value FROM h_0")
def relu_layer(spark, sf_dir):
    a = layers.relu_rows(_hidden_z(spark, sf_dir), ["id"])
    return a.selectExpr("id", "out AS neuron", "round(a, 6) AS activated_value")


@query("dense_output", sqltext.DIGITS + ' SELECT rid AS id, k AS "output", round(z, 6) + 0e0 AS z FROM z2_0')
def dense_output(spark, sf_dir):
    return _output_z(spark, sf_dir).selectExpr("id", "out AS output", *r6("z"))


@query("dense_output_as_written", sqltext.DIGITS + """
SELECT rid AS id, k AS "output", round(sum(w * a) + max(b), 6) + 0e0 AS z
FROM h_0 JOIN (SELECT k, w, b FROM w2_0 JOIN b2_0 USING (k)) AS t ON h_0.j = t.k GROUP BY rid, k""")
def dense_output_as_written(spark, sf_dir):
    return _output_z(spark, sf_dir, join_key="out").selectExpr("id", "out AS output", *r6("z"))


@query("softmax", sqltext.DIGITS + """
SELECT rid AS id, k AS "output", round(e, 6) AS soft_max_vals, round(total, 6) AS total_soft_max_output,
       round(p, 6) AS output_perc FROM p_0""")
def softmax(spark, sf_dir):
    rows = layers.softmax_rows(_output_z(spark, sf_dir), ["id"], 10)
    return rows.selectExpr("id", "out AS output", "round(e, 6) AS soft_max_vals",
                           "round(total, 6) AS total_soft_max_output", "round(p, 6) AS output_perc")


def _scored_rows(spark, sf_dir, engine):
    images, state = digits(spark, sf_dir)
    return plans.output_rows(plans.score(images, state, engine)).selectExpr("id", "output", _P)


@query("forward_pass", _ROWS)
def forward_pass(spark, sf_dir):
    return _scored_rows(spark, sf_dir, "long")


@query("array_forward", _ROWS)
def array_forward(spark, sf_dir):
    return _scored_rows(spark, sf_dir, "array")


@query("block_forward", _ROWS)
def block_forward(spark, sf_dir):
    return _scored_rows(spark, sf_dir, "block")


PREDICTED = sqltext.DIGITS + """,
pred AS (SELECT rid AS id, label, CAST(arg_max(k, p) AS INTEGER) AS prediction
         FROM (SELECT rid, label, k, p FROM p_0 ORDER BY rid, k) GROUP BY rid, label)"""


@query("predict_argmax", PREDICTED + " SELECT id, prediction FROM pred UNION ALL SELECT -1, NULL")
def predict_argmax(spark, sf_dir):
    """Also for an image without features, whose prediction is NULL."""
    images, state = digits(spark, sf_dir)
    unknown = images.limit(1).selectExpr("-1L AS id", "CAST(NULL AS INT) AS label", "CAST(NULL AS ARRAY<DOUBLE>) AS x")
    return plans.predict(images.unionByName(unknown), state, "long").select("id", "prediction")


@query("array_predict", PREDICTED + " SELECT id, label, prediction FROM pred")
def array_predict(spark, sf_dir):
    return plans.predict(*digits(spark, sf_dir), "array")


@query("accuracy", PREDICTED + """
SELECT avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END) AS pct_right, count(*) AS n_images FROM pred""")
def accuracy(spark, sf_dir):
    return reports.accuracy(plans.predict(*digits(spark, sf_dir)))


@query("cross_entropy_loss", sqltext.DIGITS + """
SELECT round(avg(-ln(p)), 6) AS cross_entropy_loss FROM p_0 WHERE k = label""")
def cross_entropy_loss(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    return losses.cross_entropy(plans.logits(images, state)).selectExpr(*r6("cross_entropy_loss"))


@query("cross_entropy_saturated", sqltext.chain(
    sqltext.EMBEDDINGS_X.replace("AS DOUBLE) AS v", "AS DOUBLE) * 20000e0 AS v"), sqltext.pattern_params(64, 10, 10), sqltext.forward()) + """,
lse AS (SELECT rid, max(z) AS top, max(CASE WHEN k = label THEN z END) AS own FROM z2_0 GROUP BY rid)
SELECT round(avg(top + ln(s) - own) / 1e3, 6) AS cross_entropy_loss
FROM lse JOIN (SELECT rid, sum(exp(z - top)) AS s FROM z2_0 JOIN lse USING (rid) GROUP BY rid) USING (rid)""")
def cross_entropy_saturated(spark, sf_dir):
    """Inputs so large that the share of many labels underflows to 0; their losses count all the same."""
    images = readers.embedding_images(spark, sf_dir, 20000.0)
    loss = losses.cross_entropy(plans.logits(images, State.pattern(spark, DIGITS)))
    return loss.selectExpr("round(cross_entropy_loss / 1e3D, 6) AS cross_entropy_loss")


@query("sql_functions", sqltext.chain(sqltext.EMBEDDINGS_X) + """,
r AS (SELECT rid, i, greatest(v, 0e0) AS positive,
      exp(v - max(v) OVER (PARTITION BY rid)) AS e FROM x)
SELECT rid AS id, i AS pixel_id, round(positive, 6) + 0e0 AS positive,
       round(e / sum(e) OVER (PARTITION BY rid), 6) AS share FROM r""")
def sql_functions(spark, sf_dir):
    C.register_sql_functions(spark)
    shares = readers.embedding_images(spark, sf_dir).selectExpr("id", "x", "sg_softmax(x) AS s")
    rows = shares.selectExpr("id", "s", "posexplode(x) AS (pixel_id, v)")
    return rows.selectExpr("id", "pixel_id", "round(sg_relu(v), 6) AS positive", "round(s[pixel_id], 6) AS share")


_LINES = sqltext.chain(sqltext.LINEITEM_X, sqltext.pattern_params(4, 10, 8), sqltext.forward())


@query("lineitem_forward", _LINES + """
SELECT l_orderkey AS id, label, CAST(arg_max(k, p) AS INTEGER) AS prediction, round(max(p), 6) AS p
FROM p_0 JOIN lines USING (rid) GROUP BY rid, l_orderkey, label""")
def lineitem_forward(spark, sf_dir):
    scored = plans.score(readers.lineitem_features(spark, sf_dir), State.pattern(spark, LINES))
    return scored.selectExpr("id", "label", f"{C.argmax('p')} AS prediction", "round(array_max(p), 6) AS p")


AWKWARD = Network(4, 3, 3)
_AWKWARD = sqltext.chain(sqltext.LINE_NUMBERED, """
x AS MATERIALIZED (
  SELECT rid, l_linenumber AS label, 0 AS i, l_quantity / 50e0 AS v FROM lines WHERE l_linenumber IN (1, 2, 5)
  UNION ALL SELECT rid, l_linenumber, 1, l_extendedprice / 100000e0 FROM lines WHERE l_linenumber IN (1, 5)
  UNION ALL SELECT rid, l_linenumber, 2, l_discount * 10e0 FROM lines WHERE l_linenumber IN (1, 2)
  UNION ALL SELECT rid, l_linenumber, 3, l_tax * 10e0 FROM lines WHERE l_linenumber = 1)""",
    sqltext.pattern_params(4, 3, 3), sqltext.forward()) + """
SELECT l_orderkey % 50 AS id, l_linenumber AS label, CAST(arg_max(k, p) AS INTEGER) AS prediction, round(max(p), 6) AS p
FROM lines LEFT JOIN p_0 USING (rid) WHERE l_linenumber <> 7 GROUP BY rid, l_orderkey, l_linenumber"""


def awkward_images(spark, sf_dir):
    """By line number: full, with NULLs, NULL, empty, short, nothing but NULLs, one feature too many. Ids repeat."""
    q, p, d, t = "l_quantity / 50D", "l_extendedprice / 100000D", "l_discount * 10D", "l_tax * 10D"
    none = "CAST(NULL AS DOUBLE)"
    return readers.read_table(spark, sf_dir, "lineitem").selectExpr("l_orderkey % 50 AS id", "l_linenumber AS label", f"""
        CASE l_linenumber WHEN 1 THEN array({q}, {p}, {d}, {t}) WHEN 2 THEN array({q}, {none}, {d}, {none})
        WHEN 4 THEN CAST(array() AS ARRAY<DOUBLE>) WHEN 5 THEN array({q}, {p}) WHEN 6 THEN array({none}, {none}, {none}, {none})
        WHEN 7 THEN array({q}, {p}, {d}, {t}, {q}) END AS x""")


def _forward_awkward(engine):
    @query(f"forward_awkward_{engine}", _AWKWARD)
    def forward_awkward(spark, sf_dir):
        fitting = awkward_images(spark, sf_dir).where("x IS NULL OR size(x) <= 4")
        scored = plans.score(fitting, State.pattern(spark, AWKWARD), engine)
        return scored.selectExpr("id", "label", f"{C.argmax('p')} AS prediction", "round(array_max(p), 6) AS p")


for _engine in ("columns", "block", "array", "long"):
    _forward_awkward(_engine)


@query("width_violations", "SELECT l_orderkey % 50 AS id, 5 AS n_features FROM lineitem WHERE l_linenumber = 7")
def width_violations(spark, sf_dir):
    return reports.width_violations(awkward_images(spark, sf_dir), 4)


@query("ratio_to_report", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
       max(l_extendedprice) OVER (PARTITION BY l_returnflag) AS max_value,
       round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_returnflag) * 1e6, 6) AS ratio_ppm
FROM lineitem""")
def ratio_to_report(spark, sf_dir):
    lines = readers.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    shares = layers.ratio_to_report(lines, "l_extendedprice", ["l_returnflag"])
    return shares.selectExpr("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "max_value",
                             "round(ratio * 1e6D, 6) AS ratio_ppm")


@query("ratio_to_total", """
SELECT l_orderkey, l_linenumber, max(l_extendedprice) OVER () AS max_value,
       round(l_extendedprice / sum(l_extendedprice) OVER () * 1e6, 6) AS ratio_ppm
FROM lineitem""")
def ratio_to_total(spark, sf_dir):
    lines = readers.read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return layers.ratio_to_report(lines, "l_extendedprice").selectExpr(
        "l_orderkey", "l_linenumber", "max_value", "round(ratio * 1e6D, 6) AS ratio_ppm")


@query("softmax_mergeable", """
SELECT l_orderkey, l_linenumber, l_suppkey, round(e / sum(e) OVER (PARTITION BY l_orderkey), 6) AS share
FROM (SELECT *, exp(l_extendedprice / 1e2 - max(l_extendedprice / 1e2) OVER (PARTITION BY l_orderkey)) AS e FROM lineitem)""")
def softmax_mergeable(spark, sf_dir):
    """Shares of an order's lines, with exponents of up to a thousand, as it runs when a key has too many rows for an array."""
    z = readers.read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice / 1e2D AS z")
    return layers.softmax_rows_mergeable(z, ["l_orderkey"]).selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", "round(p, 6) AS share")
