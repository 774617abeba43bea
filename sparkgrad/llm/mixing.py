"""Mixing sources to target weights by pivotal dependent rounding.

Targets: all words are shared among the sources by weight; a source takes at most
``max_copies`` times its own words, and what it can't take is shared again among the rest.
That is one water level over the table of sources, found by raising it until no further source is capped.

A document of a source with target / size = 1.3 is wanted 1.3 times: once for certain, and once
more with probability 0.3. The fractions are rounded together, not one by one: two documents
meet, words move from one to the other until one of the two fractions is 0 or 1, and the other
goes on to the next meeting. The direction is random and leaves each expectation as it is; the
sum of expected words is kept exactly. The last fraction of a source goes to the nearer side, and documents of the last meeting that are small enough
change sides to close what is missing; so a source misses its target by at most half of one document, and
mostly by a few words.

Meetings are dealt over a reduction tree: hashed blocks of about ``BLOCK`` units are folded in
parallel; one unit at most is left of each, with one in ``STRIDE`` that wait for the end, and what is left of ``STRIDE``
blocks forms one of the next level. A source with a third of all rows is thereby as parallel as any other. Built-in
expressions only; all randomness is a hash of ``seed`` and the keys, so reruns agree.

Defined results: NULL is a source of its own, last in the order; NULL, empty and blank texts
have size 0 and take 0 words; rows equal in source, key, size and text hash are one unit and are taken
equally often; an empty table gives an empty result. Sources may be many: they are ranked by name with a range partitioning
and their level is found with sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.llm.text import free_name, let, n_words, read, unit
from sparkgrad.session import materialize
from sparkgrad.sources.row_ids import assign_row_ids_by

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BLOCK = 64
STRIDE = 8
SEED = 8


def targets(units: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source: source, source_size, n_units, target. ``units`` has source, size, n."""
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                          F.count("*").alias("n_units"))
    named = sources.withColumn("name", F.struct(F.col("source").isNull().alias("last"), F.col("source").alias("source")))
    ranked = materialize(assign_row_ids_by(named, "name", "rank").withColumn("weight", F.get(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights)).cast("int"))
    ).withColumn("cap", (F.col("source_size") * max_copies).cast("double")), "mix-sources")
    level, capped = 0.0, None
    while True:  # a higher level caps more sources, which raises it again
        full = F.col("cap") < F.lit(level) * F.col("weight")
        r = ranked.agg(F.sum(F.col("source_size").cast("double")).alias("total"), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)).alias("spent"),
                       F.sum(F.when(~full, F.col("weight"))).alias("left"), F.coalesce(F.sum(full.cast("long")), F.lit(0)).alias("n")).first()
        if r["n"] == capped or not r["left"]:
            break
        level, capped = (r["total"] - r["spent"]) / r["left"], r["n"]
    return ranked.select("source", "source_size", "n_units", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def meet(r: Column, x: Column, seed: int) -> Column:
    """Struct (rest, out) after the fractions of two units met; ``out.copies`` is decided."""
    room_r, room_x = (1 - r["part"]) * r["mass"], (1 - x["part"]) * x["mass"]
    has_r, has_x = r["part"] * r["mass"], x["part"] * x["mass"]
    sizes = F.struct(F.least(room_r, has_x).alias("up"), F.least(has_r, room_x).alias("down"))

    def move(s: Column) -> Column:
        rises = unit(F.lit(seed), r["id"], r["size"], r["h"], x["id"], x["size"], x["h"]) * (s["up"] + s["down"]) < s["down"]

        def decided(up: Column) -> Column:
            words = F.when(up, s["up"]).otherwise(-s["down"])
            ends = F.when(up, room_r <= has_x).otherwise(has_r <= room_x)
            one = lambda u, part: F.struct(*[u[c].alias(c) for c in ("size", "id", "h", "n", "base")],
                                           part.alias("part"), u["mass"].alias("mass"))
            clip = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
            side = up.cast("double")
            return F.when(ends, F.struct(one(x, clip(x["part"] - words / x["mass"])).alias("rest"), one(r, side).alias("out"))
                          ).otherwise(F.struct(one(r, clip(r["part"] + words / r["mass"])).alias("rest"), one(x, 1 - side).alias("out")))

        return let(rises, decided)

    return let(sizes, move)


def fold(units: DataFrame, last: bool, seed: int) -> DataFrame:
    """Per (source, block): arrays of the units that are decided and of those (one in STRIDE, and one) that go to the next level."""
    kind = units.schema["u"].dataType.simpleString()
    start = F.struct(F.lit(None).cast(kind).alias("rest"), F.array().cast(f"array<{kind}>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        met = let(meet(acc["rest"], x, seed), lambda m: F.struct(
            m["rest"].alias("rest"), F.concat(acc["done"], F.array(m["out"])).alias("done")))
        return F.when(acc["rest"].isNull(), F.struct(x.alias("rest"), acc["done"].alias("done"))).otherwise(met)

    grouped = units.groupBy("source", "source_size", "target", "block").agg(F.sort_array(F.collect_list("u"), asc=False).alias("units"))
    if last:
        return grouped.withColumn("f", F.aggregate("units", start, step)).select(
            "source", "source_size", "target", "block", settled(F.col("f")["done"], F.col("f")["rest"]).alias("done"),
            F.array().cast(f"array<{kind}>").alias("rest"))
    # some units of each size wait for the last level, where they close the gap
    waits = lambda i: ((i + 1) % STRIDE == 0) | (i == F.size("units") - 1)
    core = F.filter("units", lambda u, i: ~waits(i))
    return grouped.withColumn("f", F.aggregate(core, start, step)).select(
        "source", "source_size", "target", "block", F.col("f")["done"].alias("done"),
        F.filter(F.concat(F.array(F.col("f")["rest"]), F.filter("units", lambda u, i: waits(i))), lambda u: u.isNotNull()).alias("rest"))


def settled(done: Column, r: Column) -> Column:
    """The units decided last, from large to small, and the last fraction, which goes to the nearer side.

    What that misses, in words, is closed by decided units that change sides where this brings the sum nearer: a
    unit that is no larger than the gap is taken instead of left out, or the other way round.
    """
    on = lambda u, part: F.struct(*[u[c].alias(c) for c in ("size", "id", "h", "n", "base")], part.alias("part"), u["mass"].alias("mass"))
    side = F.round(r["part"])
    kept = lambda gap, units: F.struct(gap.alias("gap"), units.alias("units"))

    def close(acc: Column, u: Column) -> Column:
        wants = F.when(u["part"] == 0, acc["gap"] >= u["mass"]).otherwise(-acc["gap"] >= u["mass"])
        moved = F.when(u["part"] == 0, -u["mass"]).otherwise(u["mass"])
        return let(wants, lambda w: kept(acc["gap"] + F.when(w, moved).otherwise(0.0), F.concat(
            acc["units"], F.array(on(u, F.when(w, 1 - u["part"]).otherwise(u["part"]))))))

    first = kept((r["part"] - side) * r["mass"], F.array(on(r, side)))
    return F.aggregate(F.sort_array(done, asc=False), first, close, lambda acc: acc["units"])


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED,
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per unit: source, id, size, h (text hash), n (equal rows), source_size, target, copies.

    Writes its intermediates to the shared folder, so the number of levels can be read off.
    """
    spark = docs.sparkSession
    units = materialize(docs.select(F.col(source).alias("source"), F.col(key).alias("id"), n_words(F.col(text)).alias("size"),
                                    F.xxhash64(F.col(text).cast("string")).alias("h")).groupBy("source", "id", "size", "h").agg(F.count("*").alias("n")), "mix-units")
    shares = materialize(targets(units, weights, max_copies), "mix-shares")
    most = shares.agg(F.max("n_units")).first()[0] or 0
    wanted = units.join(shares.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    wanted = wanted.withColumn("base", F.floor("ratio")).withColumn("part", F.col("ratio") - F.col("base"))
    whole = (F.col("part") == 0) | (F.col("size") == 0)
    out = ["source", "id", "size", "h", "n", "source_size", "target", "copies"]
    parts = [wanted.where(whole).withColumn("copies", F.col("base")).select(out)]
    level = wanted.where(~whole).select("source", "source_size", "target", F.pmod(
        F.xxhash64(F.lit(seed), "id", "size", "h"), F.ceil(F.col("n_units") / BLOCK)).alias("block"), F.struct(
        "size", "id", "h", "n", "base", "part", (F.col("size") * F.col("n")).cast("double").alias("mass")).alias("u"))
    blocks = -(-most // BLOCK)
    while blocks:
        folded = materialize(fold(level, blocks == 1, seed), "mix-level")
        parts.append(folded.select("*", F.explode("done").alias("d")).select(
            "source", F.col("d.id").alias("id"), F.col("d.size").alias("size"), F.col("d.h").alias("h"), F.col("d.n").alias("n"), "source_size", "target",
            (F.col("d.base") + F.col("d.part")).cast("long").alias("copies")))
        level = folded.select(
            "source", "source_size", "target", F.floor(F.col("block") / STRIDE).alias("block"), F.explode("rest").alias("u"))
        blocks = 0 if blocks == 1 else -(-blocks // STRIDE)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with the input's columns; one taken three times is there three times."""
    key, text, source = (options.get(c, d) for c, d in (("key", "doc_id"), ("text", "text"), ("source", "source")))
    taken = mix(docs, **options).where("copies > 0").select("source", "id", "h", F.col("copies").cast("int").alias("copies"))
    on = (docs[key].eqNullSafe(taken["id"]) & docs[source].eqNullSafe(taken["source"]) & (F.xxhash64(docs[text].cast("string")) == taken["h"]))
    copy = free_name(docs.columns, "copy")
    return docs.join(taken, on).select(*[docs[c] for c in docs.columns], F.explode(
        F.sequence(F.lit(1), taken["copies"])).alias(copy)).drop(copy)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix(read(spark, sf_dir, "documents")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return m.select(F.col("id").alias("doc_id"), "size", F.col("source_size").cast("long").alias("source_size"),
                    "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source", "copies")
