"""

Usage: python scripts/compare_strategies.py [sf_dir] [cpus]
Prints one JSON line with the median of 3 timings (seconds, noop sink) per variant.
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from zoneflow.functions import TEAM_SYNONYM_RULES, canonicalize  # noqa: E402
from zoneflow.operators import fill_from_latest_known, merge_grouped, merge_joined  # noqa: E402
from zoneflow.plans.standins import pick_team, season_of, table  # noqa: E402
from zoneflow.session import build_session  # noqa: E402


def timed(build, repeat=3):
    """Median seconds of building the plan (eager steps included) and running it."""
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def sequential_chain(df, column):
    """The reference's shape: one projection per rule (55 stacked CASE projections)."""
    for src, dst in TEAM_SYNONYM_RULES:
        df = df.withColumn(column, F.when(F.col(column) == src, F.lit(dst)).otherwise(F.col(column)))
    return df


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.1"
    cpus = argv[1] if len(argv) > 1 else "4"
    spark = build_session(master=f"local[{cpus}]", **{"spark.sql.shuffle.partitions": "16"})
    li = table(spark, sf, "lineitem")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    sources = [
        li.select(key.alias("name"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity")).alias("q"),
                  F.col("l_returnflag").alias("flag")),
        li.select(key.alias("name"), F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("price")),
        li.select(key.alias("name"), F.col("l_discount").alias("discount"), F.col("l_linestatus").alias("flag")),
    ]
    teams = li.select(pick_team("l_orderkey").alias("team"), "l_quantity")
    country = (F.when(F.col("l_returnflag") == "R", F.lit(None)).when(F.col("l_returnflag") == "A", F.lit("NA"))
               .otherwise(F.concat(F.lit("C"), (F.col("l_partkey") % 3).cast("string"))))
    season = season_of("l_shipdate")
    spread = li.select(pick_team("l_suppkey").alias("team"), season.alias("season"), country.alias("country"))
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit("HOT")).otherwise(F.col("l_suppkey").cast("string"))
    skewed = li.select(hot.alias("team"), season.alias("season"), country.alias("country"))

    results = {
        "merge_grouped_3x_lineitem": timed(lambda: merge_grouped(sources)),
        "merge_joined_3x_lineitem": timed(lambda: merge_joined(sources)),
        "synonyms_folded_map": timed(lambda: teams.withColumn("team", canonicalize("team"))),
        "synonyms_55_step_chain": timed(lambda: sequential_chain(teams, "team")),
        "fill_spread": timed(lambda: fill_from_latest_known(spread, "team", "country", "season")),
        "fill_hot_third": timed(lambda: fill_from_latest_known(skewed, "team", "country", "season")),
    }
    print(json.dumps({"sf_dir": sf, "cpus": int(cpus), "median_of": 3, "seconds": results}))


if __name__ == "__main__":
    main(sys.argv[1:])
