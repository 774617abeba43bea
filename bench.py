"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and three times for the median. Results go to the
``noop`` sink, so all rows and columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sparkgrad import catalog  # noqa: E402
from sparkgrad.catalog.forward import DIGITS, LINES  # noqa: E402
from sparkgrad.catalog.sigmoid import TARGET, seed_state  # noqa: E402
from sparkgrad.plans.forward import score  # noqa: E402
from sparkgrad.plans.network import State  # noqa: E402
from sparkgrad.plans.training import Options, ParamStore, train  # noqa: E402
from sparkgrad.session import build_session, materialize  # noqa: E402
from sparkgrad.sources.readers import embedding_images, lineitem_features, lineitem_pairs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def sink(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
                          spark__driver__memory="16g", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    images, state = embedding_images(spark, SF_DIR), State.pattern(spark, DIGITS)
    copies = images.select("id", "label", F.explode(F.sequence(F.lit(0), F.lit(49))).alias("c"), "x").drop("c")
    replicas = materialize(copies.repartition(int(CPUS) * 2), "replicas")
    pairs, pair_state = lineitem_pairs(spark, SF_DIR), seed_state(spark)
    lines, line_state = lineitem_features(spark, SF_DIR), State.pattern(spark, LINES)

    def steps(data, start, count, engine):
        sink(train([data] * count, start, ParamStore(spark), Options(lr=0.5), engine).params)

    runs = {name: (lambda q=name: sink(catalog.QUERIES[q](spark, SF_DIR))) for name in (
        "forward_pass", "array_forward", "block_forward", "predict_argmax", "accuracy", "unpivot_pixels",
        "latest_weights", "latest_n", "update_from", "constraint_violations", "ratio_to_report", "assign_row_id_scan",
        "assign_row_id_hot_key", "random_histogram", "all_gradients", "block_gradients", "variant_sweep", "csv_scan")}
    runs |= {
        "long_forward_x50": lambda: sink(score(replicas, state, "long")),
        "array_forward_x50": lambda: sink(score(replicas, state, "array")),
        "block_forward_x50": lambda: sink(score(replicas, state, "block")),
        "block_forward_lineitem": lambda: sink(score(lines, line_state, "block")),
        "columns_forward_pairs": lambda: sink(score(pairs, pair_state)),
        "train_2_steps_pairs": lambda: sink(train([pairs] * 2, pair_state, ParamStore(spark), Options(
            lr=0.5, target=TARGET, clip=1.0, update_bias=False)).params),
        "train_10_steps_array": lambda: steps(images, state, 10, "array"),
        "train_10_steps_block": lambda: steps(images, state, 10, "block"),
        "train_2_steps_x50_array": lambda: steps(replicas, state, 2, "array"),
        "train_2_steps_x50_block": lambda: steps(replicas, state, 2, "block"),
        "train_2_steps_lineitem_block": lambda: steps(lines, line_state, 2, "block"),
    }
    chosen = sys.argv[1:] or list(runs)
    took = {}
    for name in chosen:
        times = []
        for _ in range(4):
            start = time.time()
            runs[name]()
            times.append(time.time() - start)
        took[name] = round(statistics.median(times[1:]), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
