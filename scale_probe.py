"""How the view's time grows with its input, with and without a hot key.

Usage: python scale_probe.py [copies ...]   (default: 1 10 40)

The input is the sf0.1 stand-in raw table repeated ``copies`` times with
``explode(sequence(...))`` (new vehicle ids and event ids per copy), written
to a new folder under spark.checkpoint.dir. The skewed variant gives a third
of all rows the same (missing) vehicle id, the hot key of B4.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import functions as F

    from transitlens.plans.positions import train_positions
    from transitlens.session import build_session, scratch_path
    from transitlens.sources import standin

    copies = [int(x) for x in sys.argv[1:]] or [1, 10, 40]
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(shuffle_partitions=16)
    base = standin.arrivals(spark, sf)
    stations, lines = standin.stations(spark, sf), standin.lines(spark, sf)
    n0 = base.count()

    def grown(k: int, skew: bool):
        r = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("copy"))
        vid = F.concat_ws("-", "vehicle_id", F.col("copy").cast("string"))
        if skew:
            vid = F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(vid)
        return (r.withColumn("vehicle_id", vid)
                .withColumn("event_id", F.col("event_id") + F.col("copy") * 10**7).drop("copy"))

    for k in copies:
        for skew in (False, True):
            path = scratch_path(spark, f"scale-{k}-{int(skew)}")
            grown(k, skew).write.parquet(path)
            raw = spark.read.parquet(path)
            best = None
            for _ in range(2):
                t0 = time.perf_counter()
                train_positions(raw, stations, lines).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            print(f"rows={n0 * k:>10} hot_key={'yes' if skew else 'no ':3} sec={best:.2f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
