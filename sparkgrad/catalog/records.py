"""Created tables, logs, keyed updates, latest rows and constraints."""

from pyspark.sql import functions as F

from sparkgrad.catalog.forward import PREDICTED as _PRED
from sparkgrad.catalog.forward import digits
from sparkgrad.catalog.registry import query
from sparkgrad.operators import reports, update
from sparkgrad.plans.forward import predict
from sparkgrad.session import scratch_path
from sparkgrad.sources import readers, sinks
from sparkgrad.sources.latest import LatestTable
from sparkgrad.sources.sequence import Sequence, append_numbered, read_numbered


@query("ctas_roundtrip", """
SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity
FROM lineitem GROUP BY ALL""")
def ctas_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "ctas")
    lines = readers.read_table(spark, sf_dir, "lineitem")
    grouped = lines.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    sinks.create_table_as(lines.select("l_orderkey"), path)
    return sinks.create_table_as(grouped, path)  # replaces the first table


@query("append_log", _PRED + """
SELECT 0 AS iter, id, label, CAST(NULL AS INTEGER) AS prediction FROM pred
UNION ALL SELECT 1, id, label, prediction FROM pred""")
def append_log(spark, sf_dir):
    path = scratch_path(spark, "log")
    images, state = digits(spark, sf_dir)
    sinks.append_log(images.selectExpr("id", "label", "CAST(NULL AS INT) AS prediction"), path, 0)
    for _ in range(2):  # a repeated iteration replaces itself
        sinks.append_log(predict(images, state), path, 1)
    return sinks.read_log(spark, path).select("iter", "id", "label", "prediction")


@query("update_from", """
WITH last_line AS (
  SELECT l_orderkey, l_extendedprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC) = 1)
SELECT o_orderkey, coalesce(l_extendedprice, o_totalprice) AS o_totalprice
FROM orders LEFT JOIN last_line ON o_orderkey = l_orderkey""")
def update_from(spark, sf_dir):
    orders = readers.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    # line number and price in cents as one number; a price has fewer than 12 digits
    lines = readers.read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "l_extendedprice", "l_shipdate",
        "l_linenumber * 1000000000000L + CAST(round(l_extendedprice * 100D) AS BIGINT) AS place")
    last = update.one_per_key(lines, ["o_orderkey"], "l_extendedprice", ["l_shipdate", "place"])
    return update.update_from(orders, last, ["o_orderkey"], "o_totalprice", "l_extendedprice")


@query("update_two_keys", """
WITH newest AS (
  SELECT user_id, event_type, value AS latest FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT event_id, user_id, event_type, latest AS value FROM events JOIN newest USING (user_id, event_type)""")
def update_two_keys(spark, sf_dir):
    events = readers.read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    newest = update.latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"], ["value"])
    target = events.select("event_id", "user_id", "event_type", "value")
    return update.update_from(target, newest, ["user_id", "event_type"], "value", "value")


@query("constraint_violations", """
SELECT 'duplicate' AS reason, l_orderkey AS id, CAST(NULL AS DOUBLE) AS value, count(*) AS n
FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
UNION ALL
SELECT 'prediction', l_orderkey, l_quantity, count(*) FROM lineitem
WHERE NOT (l_quantity BETWEEN 0 AND 9) GROUP BY l_orderkey, l_quantity
UNION ALL
SELECT 'label', l_orderkey, CAST(l_linenumber AS DOUBLE), count(*) FROM lineitem
WHERE NOT (l_linenumber BETWEEN 0 AND 9) GROUP BY l_orderkey, l_linenumber""")
def constraint_violations(spark, sf_dir):
    log = readers.read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS id", "l_linenumber AS label", "l_quantity AS prediction")
    return reports.constraint_violations(log, "id", {"label": (0, 9), "prediction": (0, 9)})


@query("latest_n", "SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def latest_n(spark, sf_dir):
    events = readers.read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return update.latest_n(events, ["ts", "event_id"], 100)


@query("latest_weights", """
SELECT user_id, event_type, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_weights(spark, sf_dir):
    events = readers.read_table(spark, sf_dir, "events")
    return update.latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"], ["ts", "value"])


@query("weight_history_topk", """
SELECT ts, 'W_' || event_type AS weight_name, value FROM events WHERE event_type IN ('click', 'view')
ORDER BY ts DESC, weight_name DESC LIMIT 10""")
def weight_history_topk(spark, sf_dir):
    named = readers.read_table(spark, sf_dir, "events").selectExpr("ts", "concat('W_', event_type) AS weight_name", "value")
    return reports.top_history(named, "weight_name", ["W_click", "W_view"], ["ts", "weight_name"], 10)


@query("submission_export", _PRED + ' SELECT id AS "ImageId", prediction AS "Label" FROM pred')
def submission_export(spark, sf_dir):
    path = scratch_path(spark, "submission")
    predicted = predict(*digits(spark, sf_dir)).selectExpr("id AS ImageId", "prediction AS Label")
    sinks.export_csv(predicted, path, "ImageId")
    return spark.read.option("header", True).schema("ImageId BIGINT, Label INT").csv(path)


@query("latest_incremental", """
SELECT user_id, event_type, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_incremental(spark, sf_dir):
    """A table of newest rows, refreshed after each of two loads of the log."""
    events = readers.read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    log = scratch_path(spark, "events-log")
    table = LatestTable(spark, log, scratch_path(spark, "latest"), ["user_id", "event_type"], ["ts", "event_id"], ["ts", "value"])
    for k, load in enumerate(("event_type <=> 'view'", "NOT event_type <=> 'view'")):
        sinks.append_log(events.where(load), log, k)
        newest = table.refresh()
    return newest


@query("assign_row_id_appended", """
SELECT row_number() OVER (ORDER BY o_orderstatus <> 'F', o_orderkey) AS id, o_orderkey, o_orderstatus FROM orders""")
def assign_row_id_appended(spark, sf_dir):
    """Two loads numbered by one stored sequence; the second one runs twice and keeps its numbers."""
    orders = readers.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path, numbers = scratch_path(spark, "numbered"), Sequence(spark, scratch_path(spark, "sequence"))
    append_numbered(orders.where("o_orderstatus = 'F'"), path, numbers, "finished", "o_orderkey")
    for _ in range(2):
        append_numbered(orders.where("o_orderstatus <> 'F'"), path, numbers, "others", "o_orderkey")
    return read_numbered(spark, path).select("id", "o_orderkey", "o_orderstatus")
