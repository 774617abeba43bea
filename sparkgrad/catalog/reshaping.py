"""Sources, row ids, reshaping, grids and initial parameters."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkgrad.catalog.registry import query, r6
from sparkgrad.functions.keyed_random import keyed_uniform
from sparkgrad.operators import init, reports, reshape
from sparkgrad.session import materialize, scratch_path
from sparkgrad.sources import dialect, readers, row_ids, schemas

_LONG = """
SELECT vec_id AS id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pixel_id,
       CAST(unnest(embedding) AS DOUBLE) AS pixel_value
FROM embeddings"""


def _csv(spark, sf_dir, name):
    path = scratch_path(spark, name)
    wide = reshape.widen(readers.embedding_images(spark, sf_dir), 64)
    wide.write.option("header", True).csv(path)
    return path


@query("csv_scan", f"SELECT id, label, pixel_id, round(pixel_value, 6) AS pixel_value FROM ({_LONG})")
def csv_scan(spark, sf_dir):
    wide = readers.read_csv(spark, _csv(spark, sf_dir, "images-csv"), schemas.image_schema(64))
    return reshape.unpivot_pixels(wide, ["id", "label"]).selectExpr("id", "label", "pixel_id", *r6("pixel_value"))


@query("csv_scan_inferred", f"""
SELECT id, label, round(sum(pixel_value), 6) AS pixel_sum, count(*) AS n_pixels FROM ({_LONG}) GROUP BY id, label""")
def csv_scan_inferred(spark, sf_dir):
    wide = readers.read_csv(spark, _csv(spark, sf_dir, "inferred-csv"))
    images = reshape.pack_features(wide, 64)
    return images.selectExpr(
        "CAST(id AS BIGINT) AS id", "label", "round(aggregate(x, 0D, (s, v) -> s + v), 6) AS pixel_sum",
        "CAST(size(x) AS BIGINT) AS n_pixels")


@query("csv_rejects", """
SELECT event_id, user_id, event_type, CAST(NULL AS VARCHAR) AS line FROM events WHERE event_type <> 'error'
UNION ALL
SELECT NULL, NULL, NULL, event_id || ';n/a;error' FROM events WHERE event_type = 'error'""")
def csv_rejects(spark, sf_dir):
    """The events as CSV whose errors have no user: found dialect, typed rows, and the lines that don't fit."""
    path = scratch_path(spark, "events-csv")
    user = F.expr("CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(user_id AS STRING) END").alias("user_id")
    readers.read_table(spark, sf_dir, "events").select("event_id", user, "event_type").write.option(
        "header", True).option("sep", ";").csv(path)
    schema = StructType().add("event_id", "long").add("user_id", "long").add("event_type", "string")
    rows, rejects = dialect.load_csv(spark, path, schema, scratch_path(spark, "events-loaded"))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return rows.withColumn("line", F.lit(None).cast("string")).unionByName(rejects.select(*none, "line"))


@query("assign_row_id", "SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey, o_custkey FROM orders")
def assign_row_id(spark, sf_dir):
    orders = readers.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return row_ids.assign_row_ids_by(orders, "o_orderkey").select("id", "o_orderkey", "o_custkey")


@query("assign_row_id_hot_key", """
SELECT l_quantity, min(id) AS first_id, max(id) AS last_id, count(*) AS n_rows
FROM (SELECT l_quantity, row_number() OVER (ORDER BY l_quantity) AS id FROM lineitem) GROUP BY l_quantity""")
def assign_row_id_hot_key(spark, sf_dir):
    lines = readers.read_table(spark, sf_dir, "lineitem").select("l_quantity")
    return row_ids.assign_row_ids_by(lines, "l_quantity").groupBy("l_quantity").agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("n_rows"))


@query("assign_row_id_scan", """
SELECT count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id, CAST(sum(id) AS BIGINT) AS id_sum,
       count(DISTINCT id) AS n_ids
FROM (SELECT row_number() OVER () AS id FROM lineitem)""")
def assign_row_id_scan(spark, sf_dir):
    lines = readers.read_table(spark, sf_dir, "lineitem").select("l_orderkey")
    return row_ids.assign_row_ids(lines).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.sum("id").alias("id_sum"), F.countDistinct("id").alias("n_ids"))


@query("select_image", f"""
SELECT id, label, pixel_id, round(pixel_value, 6) AS pixel_value FROM ({_LONG}) WHERE label = 7""")
def select_image(spark, sf_dir):
    chosen = readers.embedding_images(spark, sf_dir).where(F.col("label") == 7)
    long = reshape.to_long(chosen, "id", "label")
    return long.selectExpr("id", "label", "`in` AS pixel_id", "round(v, 6) AS pixel_value")


@query("preview", """
SELECT least(count(*), 10) AS n_rows, least(count(*), 10) AS n_known FROM embeddings""")
def preview(spark, sf_dir):
    """Which rows come is open: they are counted, and those that are rows of the table."""
    table = readers.read_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    rows = materialize(reports.preview(table, 10), "preview")  # the same rows on both sides
    found = table.join(F.broadcast(rows), ["vec_id", "label"], "left_semi").distinct().withColumn("known", F.lit(1))
    known = rows.join(F.broadcast(found), ["vec_id", "label"], "left")  # at most 10 rows each
    return known.agg(F.count(F.lit(1)).alias("n_rows"), F.count("known").alias("n_known"))


@query("image_grid", f"""
SELECT id, CAST(pixel_id // 8 AS INTEGER) AS "row", CAST(pixel_id % 8 AS INTEGER) AS "col",
       round(pixel_value, 6) AS "value" FROM ({_LONG})""")
def image_grid(spark, sf_dir):
    grid = reshape.to_grid(readers.embedding_images(spark, sf_dir), 8)
    return grid.selectExpr("id", "row", "col", *r6("value"))


@query("unpivot_pixels", """
SELECT l_orderkey, l_linenumber, pixel, CAST(ltrim(pixel, 'pixel') AS INTEGER) AS pixel_id, pixel_value
FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity AS pixel0, l_extendedprice AS pixel1,
                      l_discount AS pixel2, l_tax AS pixel3 FROM lineitem)
      ON pixel0, pixel1, pixel2, pixel3 INTO NAME pixel VALUE pixel_value)""")
def unpivot_pixels(spark, sf_dir):
    wide = readers.read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity AS pixel0", "l_extendedprice AS pixel1",
        "l_discount AS pixel2", "l_tax AS pixel3")
    return reshape.unpivot_pixels(wide, ["l_orderkey", "l_linenumber"])


@query("pixel_keys", """
WITH named AS (
  SELECT rid, unnest(['id', 'label', 'pixel0', 'pixel1', 'pixel2', 'pixel3']) AS pixel,
         unnest([CAST(l_orderkey AS DOUBLE), CAST(l_linenumber AS DOUBLE), l_quantity, l_extendedprice, l_discount, l_tax]) AS v
  FROM (SELECT row_number() OVER () AS rid, * FROM lineitem)),
w AS (SELECT CAST(i AS INTEGER) AS i, CAST(i + 1 AS DOUBLE) / 10e0 AS w FROM range(4) AS r(i))
SELECT pixel, i AS pixel_id, count(*) AS n, round(sum(v * w) / 1e3, 3) AS weighted
FROM named JOIN w ON CAST(ltrim(pixel, 'pixel') AS INTEGER) = i WHERE pixel NOT IN ('id', 'label') GROUP BY pixel, i""")
def pixel_keys(spark, sf_dir):
    """Pixel names as data: filtered by value, stripped to a number, and joined with numbered weights."""
    named = readers.read_table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS DOUBLE) AS id", "CAST(l_linenumber AS DOUBLE) AS label", "l_quantity AS pixel0",
        "l_extendedprice AS pixel1", "l_discount AS pixel2", "l_tax AS pixel3")
    rows = reshape.named_values(named, named.columns)
    weights = init.grid(spark, 1, 4).selectExpr("`in` AS pixel_id", "CAST(`in` + 1 AS DOUBLE) / 10D AS w")
    joined = reshape.pixels_only(rows, ("id", "label")).join(weights, "pixel_id")
    return joined.groupBy("pixel", "pixel_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value") * F.col("w")) / 1e3, 3).alias("weighted"))


_GRID = """
shape AS (SELECT max(len(embedding)) AS n_in, max(label) + 1 AS n_out FROM embeddings),
grid AS (SELECT CAST(j AS INTEGER) AS j, CAST(i AS INTEGER) AS i, n_in
         FROM (SELECT j, n_in, unnest(range(n_in)) AS i FROM (SELECT n_in, unnest(range(n_out)) AS j FROM shape)))"""
_DRAW = "CAST('0x' || substr(md5({seed} || ':' || j || ':' || i), 1, 13) AS BIGINT) / 4503599627370496e0"


def _cells(spark, sf_dir):
    """The grid of the shape found in the data: two numbers on the driver, the cells from a range."""
    shape = readers.infer_shape(readers.embedding_images(spark, sf_dir)).first()
    return init.grid(spark, shape["n_out"], shape["n_in"]).withColumn("fan_in", F.lit(shape["n_in"]))


@query("grid", f"WITH {_GRID} SELECT j AS neuron, i AS input_layer FROM grid")
def grid(spark, sf_dir):
    return _cells(spark, sf_dir).selectExpr("out AS neuron", "`in` AS input_layer")


@query("uniform_init", f"""
WITH {_GRID} SELECT j AS neuron, i AS input_layer, round({_DRAW.format(seed="'11'")}, 6) AS weight FROM grid""")
def uniform_init(spark, sf_dir):
    drawn = init.uniform_init(_cells(spark, sf_dir), 11)
    return drawn.selectExpr("out AS neuron", "`in` AS input_layer", "round(w, 6) AS weight")


@query("he_init", f"""
WITH {_GRID} SELECT j AS neuron, i AS input_layer,
  round((({_DRAW.format(seed="'12'")}) * 2e0 - 1e0) * sqrt(6e0 / n_in), 6) + 0e0 AS weight FROM grid""")
def he_init(spark, sf_dir):
    drawn = init.he_init(_cells(spark, sf_dir), 12)
    return drawn.selectExpr("out AS neuron", "`in` AS input_layer", "round(w, 6) AS weight")


@query("pack_weights", f"""
WITH {_GRID} SELECT j AS "output", i AS position, round(({_DRAW.format(seed="'13'")}) * 0.01e0, 6) AS weight FROM grid""")
def pack_weights(spark, sf_dir):
    packed = reshape.pack_weights(init.small_init(_cells(spark, sf_dir), 13))
    return packed.selectExpr("out AS output", "posexplode(weights) AS (position, weight)").selectExpr(
        "output", "position", *r6("weight"))


@query("zero_bias", 'SELECT DISTINCT label AS "output", 0e0 AS bias FROM embeddings')
def zero_bias(spark, sf_dir):
    outs = readers.read_table(spark, sf_dir, "embeddings").selectExpr("label AS out").distinct()
    return init.zero_bias(outs).selectExpr("out AS output", "b AS bias")


@query("random_histogram", """
SELECT CAST(floor(20 * (CAST('0x' || substr(md5('5:' || l_orderkey || ':' || l_linenumber || ':' || l_partkey
       || ':' || l_suppkey), 1, 13) AS BIGINT) / 4503599627370496e0)) AS INTEGER) AS bucket, count(*) AS total
FROM lineitem GROUP BY 1""")
def random_histogram(spark, sf_dir):
    lines = readers.read_table(spark, sf_dir, "lineitem")
    drawn = lines.select(keyed_uniform(5, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("u"))
    return reports.histogram(drawn, "u", 20)
