"""Training loops and their trajectories."""

from sparkgrad.catalog import sqltext
from sparkgrad.catalog.forward import LINES, digits
from sparkgrad.catalog.registry import query, r6
from sparkgrad.catalog.sigmoid import TARGET, pairs, sql_steps
from sparkgrad.operators import reports
from sparkgrad.plans import training
from sparkgrad.plans.network import State
from sparkgrad.plans.training import Options, ParamStore, TrainLog, train
from sparkgrad.sources import readers

LR = 0.5
_PARAMS = "SELECT layer, unit, input, round(w, 6) + 0e0 AS weight FROM"


def param_rows(state):
    return state.params.selectExpr("layer", "out AS unit", "`in` AS input", "round(w, 6) AS weight")


def steps_sql(x, start, steps, lr=LR, where=None, **back):
    parts = [x, start]
    for n in range(steps):
        keep = where(n) if where else "TRUE"
        parts += [sqltext.forward(n, where=keep), sqltext.backward(n, **back), sqltext.update(n, lr)]
    return sqltext.chain(*parts) + f" {_PARAMS} ({sqltext.all_params(steps)})"


DIGIT_START = (sqltext.EMBEDDINGS_X, sqltext.pattern_params(64, 10, 10))


@query("train_steps", steps_sql(*DIGIT_START, 2))
def train_steps(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    return param_rows(train([images] * 2, state, ParamStore(spark), Options(lr=LR), "array"))


@query("train_steps_block", steps_sql(*DIGIT_START, 2))
def train_steps_block(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    return param_rows(train([images] * 2, state, ParamStore(spark), Options(lr=LR), "block"))


@query("train_steps_long", steps_sql(*DIGIT_START, 2))
def train_steps_long(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    return param_rows(train([images] * 2, state, ParamStore(spark), Options(lr=LR), "long"))


_LOGGED = sqltext.chain(*DIGIT_START, sqltext.forward(0), sqltext.backward(0), sqltext.update(0, LR), sqltext.forward(1)) + """,
logged AS (SELECT iter, rid AS id, label, CAST(arg_max(k, p) AS INTEGER) AS prediction FROM (
  SELECT 0 AS iter, rid, label, k, p FROM p_0 UNION ALL SELECT 1, rid, label, k, p FROM p_1 ORDER BY iter, rid, k)
  GROUP BY iter, rid, label)"""


def _logged(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    log = TrainLog(spark)
    train([images] * 2, state, ParamStore(spark), Options(lr=LR), log=log)
    return log.read()


@query("train_log", _LOGGED + " SELECT iter, TRUE AS timed, id, label, prediction FROM logged")
def train_log(spark, sf_dir):
    """What two training steps wrote: the predictions that each started from, with the time of the insert."""
    return _logged(spark, sf_dir).selectExpr("iter", "insert_time <= current_timestamp() AS timed", "id", "label", "prediction")


@query("accuracy_from_log", _LOGGED + """
SELECT iter, avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END) AS pct_right, count(*) AS n_images FROM logged GROUP BY iter""")
def accuracy_from_log(spark, sf_dir):
    return reports.accuracy(_logged(spark, sf_dir), "iter")


@query("train_minibatches", steps_sql(*DIGIT_START, 4, where=lambda n: f"rid % 4 = {n}"))
def train_minibatches(spark, sf_dir):
    """One epoch: every image is used once, in four batches."""
    images, state = digits(spark, sf_dir)
    return param_rows(train(training.split_batches(images, 4), state, ParamStore(spark), Options(lr=LR)))


ONE_BY_ONE = (7, 3, 42)


@query("train_one_by_one", steps_sql(*DIGIT_START, 3, where=lambda n: f"rid = {ONE_BY_ONE[n]}"))
def train_one_by_one(spark, sf_dir):
    """Steps of one image each, looked up in a layout of the whole table by id."""
    images, state = digits(spark, sf_dir)
    batches = training.one_by_one(training.ImageStore(images), ONE_BY_ONE)
    return param_rows(train(batches, state, ParamStore(spark), Options(lr=LR)))


def _as_written_sql():
    early = ("late AS MATERIALIZED (SELECT k, j, w - 0.5e0 * g AS w FROM w2_0 JOIN "
             "(SELECT k, j, avg(d * a) AS g FROM dd JOIN h_0 USING (rid) GROUP BY k, j) USING (k, j))")
    dd = "dd AS MATERIALIZED (SELECT rid, k, 2e0 * (p - CASE WHEN k = label THEN 1e0 ELSE 0e0 END) AS d FROM p_0)"
    back = sqltext.backward(0, back="late").replace(
        "SELECT j, avg(dh) AS g FROM er_0", "SELECT j, avg(e) AS g FROM er_0")
    return sqltext.chain(*DIGIT_START, sqltext.forward(0), dd, early, back, sqltext.update(0, LR)) + (
        f" {_PARAMS} ({sqltext.all_params(1)})")


@query("train_step_as_written", _as_written_sql())
def train_step_as_written(spark, sf_dir):
    """Hidden error from the updated output weights, hidden bias without the ReLU mask."""
    images, state = digits(spark, sf_dir)
    opts = Options(lr=LR, hidden_error_weights="updated", mask_hidden_bias=False)
    return param_rows(train([images], state, ParamStore(spark), opts))


@query("train_steps_lineitem", steps_sql(sqltext.LINEITEM_X, sqltext.pattern_params(4, 10, 8), 2))
def train_steps_lineitem(spark, sf_dir):
    lines = readers.lineitem_features(spark, sf_dir)
    return param_rows(train([lines] * 2, State.pattern(spark, LINES), ParamStore(spark), Options(lr=LR)))


_PAIR_CHAIN = sqltext.chain(sqltext.PAIRS_X, sqltext.SEED_PARAMS, *sql_steps(2, LR, 1.0, TARGET),
                            sqltext.forward(2, "sigmoid", "sigmoid"))


def _pair_run(spark, sf_dir, log=None):
    examples, state = pairs(spark, sf_dir)
    store = ParamStore(spark)
    opts = Options(lr=LR, clip=1.0, update_bias=False, target=TARGET)
    last = train([examples] * 2, state, store, opts, log=log)
    if log is not None:
        log.write(examples, last)
    return examples, state.net, store


_NAMED_W = " UNION ALL ".join(f"""
SELECT {n} AS iter, 'W' || (i * 2 + j + 1) AS weight_name, w FROM w1_{n}
UNION ALL SELECT {n}, 'W' || (4 + j * 2 + k + 1), w FROM w2_{n}""" for n in range(3))


@query("weight_trajectory", _PAIR_CHAIN + f" SELECT iter, weight_name, round(w, 6) + 0e0 AS updated_weight FROM ({_NAMED_W})")
def weight_trajectory(spark, sf_dir):
    _, net, store = _pair_run(spark, sf_dir)
    return reports.weight_trajectory(store.history(), net).selectExpr("iter", "weight_name", *r6("updated_weight"))


def _mean_by_iteration(spark, sf_dir, column):
    """(iter, unit, value): mean of an activation array over all examples, from the log of the run."""
    log = TrainLog(spark)
    _pair_run(spark, sf_dir, log)
    return log.means(column)


_MEAN_H = " UNION ALL ".join(f"SELECT {n} AS iter, j + 1 AS hidden, avg(a) AS v FROM h_{n} GROUP BY j" for n in range(3))
_MEAN_P = " UNION ALL ".join(f"SELECT {n} AS iter, k + 1 AS output_node, avg(p) AS v FROM p_{n} GROUP BY k" for n in range(3))


@query("activation_trajectory", _PAIR_CHAIN + f" SELECT iter, hidden, round(v, 6) AS hidden_value FROM ({_MEAN_H})")
def activation_trajectory(spark, sf_dir):
    log = _mean_by_iteration(spark, sf_dir, "a")
    return reports.activation_trajectory(log).selectExpr("iter", "hidden + 1 AS hidden", *r6("hidden_value"))


@query("prediction_trajectory", _PAIR_CHAIN + f"""
SELECT iter, output_node, round(v, 6) AS predicted_value, CASE output_node WHEN 1 THEN 0.01e0 ELSE 0.99e0 END AS actual_value
FROM ({_MEAN_P})""")
def prediction_trajectory(spark, sf_dir):
    actual = f"element_at(array({', '.join(f'{t}D' for t in TARGET)}), unit + 1)"
    log = _mean_by_iteration(spark, sf_dir, "p").selectExpr(
        "iter", "unit AS output", "value AS predicted_value", f"{actual} AS actual_value")
    return reports.prediction_trajectory(log).selectExpr(
        "iter", "output + 1 AS output_node", *r6("predicted_value"), "actual_value")
