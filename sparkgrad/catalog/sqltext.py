"""SQL (DuckDB dialect) for the checks: one CTE chain per network and step."""

from __future__ import annotations

EMBEDDINGS_X = """
x AS MATERIALIZED (
  SELECT vec_id AS rid, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i,
         CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings)"""

LINE_NUMBERED = """
lines AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM lineitem)"""

LINEITEM_X = LINE_NUMBERED + """,
x AS MATERIALIZED (
  SELECT rid, l_linenumber AS label, 0 AS i, l_quantity / 50e0 AS v FROM lines
  UNION ALL SELECT rid, l_linenumber, 1, l_extendedprice / 100000e0 FROM lines
  UNION ALL SELECT rid, l_linenumber, 2, l_discount * 10e0 FROM lines
  UNION ALL SELECT rid, l_linenumber, 3, l_tax * 10e0 FROM lines)"""

PAIRS_X = LINE_NUMBERED + """,
x AS MATERIALIZED (
  SELECT rid, CAST(NULL AS INTEGER) AS label, 0 AS i, l_discount AS v FROM lines
  UNION ALL SELECT rid, CAST(NULL AS INTEGER), 1, l_tax FROM lines)"""


def pattern_params(n_in: int, n_hidden: int, n_out: int) -> str:
    """Deterministic start parameters w1_0 (j, i, w), b1_0 (j, b), w2_0 (k, j, w), b2_0 (k, b)."""
    def matrix(out: str, at: str, a: int, b: int, rows: int, cols: int) -> str:
        return f"""SELECT CAST({out} AS INTEGER) AS {out}, CAST({at} AS INTEGER) AS {at},
           (CAST(({out} * {a} + {at} * {b}) % 1000 AS DOUBLE) / 1000e0 * 2e0 - 1e0) * sqrt(6e0 / {cols}e0) AS w
    FROM range({rows}) AS o({out}), range({cols}) AS n({at})"""

    return f"""
w1_0 AS MATERIALIZED ({matrix('j', 'i', 7919, 104729, n_hidden, n_in)}),
b1_0 AS MATERIALIZED (SELECT CAST(j AS INTEGER) AS j, 0.01e0 * j AS b FROM range({n_hidden}) AS o(j)),
w2_0 AS MATERIALIZED ({matrix('k', 'j', 6947, 15485, n_out, n_hidden)}),
b2_0 AS MATERIALIZED (SELECT CAST(k AS INTEGER) AS k, 0.01e0 * k AS b FROM range({n_out}) AS o(k))"""


# The published two-input worked example.
SEED_PARAMS = """
w1_0 AS (SELECT * FROM (VALUES (0, 0, 0.15e0), (0, 1, 0.20e0), (1, 0, 0.25e0), (1, 1, 0.30e0)) AS t(j, i, w)),
b1_0 AS (SELECT * FROM (VALUES (0, 0.35e0), (1, 0.35e0)) AS t(j, b)),
w2_0 AS (SELECT * FROM (VALUES (0, 0, 0.40e0), (0, 1, 0.50e0), (1, 0, 0.45e0), (1, 1, 0.55e0)) AS t(k, j, w)),
b2_0 AS (SELECT * FROM (VALUES (0, 0.6e0), (1, 0.6e0)) AS t(k, b))"""


def forward(n: int = 0, hidden: str = "relu", output: str = "softmax", where: str = "TRUE") -> str:
    """CTEs z1_n, h_n (rid, label, j, a), z2_n (.., k, z), p_n (.., k, e, total, p) of step n."""
    squash = {"relu": "greatest(z, 0e0)", "sigmoid": "1e0 / (1e0 + exp(-z))"}
    if output == "softmax":
        p = f"""
e_{n} AS MATERIALIZED (SELECT rid, label, k, exp(z - max(z) OVER (PARTITION BY rid)) AS e FROM z2_{n}),
p_{n} AS MATERIALIZED (SELECT *, e / total AS p FROM (
  SELECT *, sum(e) OVER (PARTITION BY rid) AS total FROM e_{n}))"""
    else:
        p = f"""
p_{n} AS MATERIALIZED (SELECT rid, label, k, {squash['sigmoid']} AS p FROM z2_{n})"""
    return f"""
z1_{n} AS MATERIALIZED (SELECT rid, label, j, sum(w * v) + max(b) AS z
  FROM x JOIN w1_{n} USING (i) JOIN b1_{n} USING (j) WHERE {where} GROUP BY rid, label, j),
h_{n} AS MATERIALIZED (SELECT rid, label, j, {squash[hidden]} AS a FROM z1_{n}),
z2_{n} AS MATERIALIZED (SELECT rid, label, k, sum(w * a) + max(b) AS z
  FROM h_{n} JOIN w2_{n} USING (j) JOIN b2_{n} USING (k) GROUP BY rid, label, k),{p}"""


def backward(n: int = 0, hidden: str = "relu", output: str = "softmax", delta: str = "sq2",
             targets: tuple[float, ...] = (), back: str | None = None) -> str:
    """CTEs d_n (rid, k, d), er_n (rid, j, e, dh) and mean gradients g1_n, gb1_n, g2_n, gb2_n."""
    if output == "softmax":
        d = f"{'2e0 * ' if delta == 'sq2' else ''}(p - CASE WHEN k = label THEN 1e0 ELSE 0e0 END)"
    else:
        cases = " ".join(f"WHEN {k} THEN {t}e0" for k, t in enumerate(targets))
        d = f"(p - CASE k {cases} END) * p * (1e0 - p)"
    mask = "CASE WHEN a > 0 THEN e ELSE 0e0 END" if hidden == "relu" else "a * (1e0 - a) * e"
    return f"""
d_{n} AS MATERIALIZED (SELECT rid, k, {d} AS d FROM p_{n}),
er_{n} AS MATERIALIZED (SELECT rid, j, e, {mask} AS dh FROM (
  SELECT rid, j, sum(d * w) AS e FROM d_{n} JOIN {back or f'w2_{n}'} USING (k) GROUP BY rid, j) JOIN h_{n} USING (rid, j)),
g2_{n} AS MATERIALIZED (SELECT k, j, avg(d * a) AS g FROM d_{n} JOIN h_{n} USING (rid) GROUP BY k, j),
gb2_{n} AS MATERIALIZED (SELECT k, avg(d) AS g FROM d_{n} GROUP BY k),
g1_{n} AS MATERIALIZED (SELECT j, i, avg(dh * v) AS g FROM er_{n} JOIN x USING (rid) GROUP BY j, i),
gb1_{n} AS MATERIALIZED (SELECT j, avg(dh) AS g FROM er_{n} GROUP BY j)"""


def update(n: int, lr: float, clip: float | None = None, update_bias: bool = True) -> str:
    """CTEs of the parameters after step n; ``clip`` bounds the output layer only."""
    g2 = "g" if clip is None else f"greatest(least(g, {clip}e0), -{clip}e0)"
    step = f"{lr}e0"
    bias = step if update_bias else "0e0"
    m = n + 1
    return f"""
w1_{m} AS MATERIALIZED (SELECT j, i, w - {step} * g AS w FROM w1_{n} JOIN g1_{n} USING (j, i)),
b1_{m} AS MATERIALIZED (SELECT j, b - {bias} * g AS b FROM b1_{n} JOIN gb1_{n} USING (j)),
w2_{m} AS MATERIALIZED (SELECT k, j, w - {step} * {g2} AS w FROM w2_{n} JOIN g2_{n} USING (k, j)),
b2_{m} AS MATERIALIZED (SELECT k, b - {bias} * g AS b FROM b2_{n} JOIN gb2_{n} USING (k))"""


def all_params(n: int) -> str:
    """One frame (layer, unit, input, w) of the parameters at step n; input -1 is the bias."""
    return f"""
SELECT 1 AS layer, j AS unit, i AS input, w FROM w1_{n}
UNION ALL SELECT 1, j, -1, b FROM b1_{n}
UNION ALL SELECT 2, k, j, w FROM w2_{n}
UNION ALL SELECT 2, k, -1, b FROM b2_{n}"""


def chain(*parts: str) -> str:
    return "WITH " + ",".join(parts)


DIGITS = chain(EMBEDDINGS_X, pattern_params(64, 10, 10), forward())
DIGITS_BACK = DIGITS + "," + backward()
