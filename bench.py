"""Time the headline queries on whole tables; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. With BENCH_COMPARE=1 the slower
"""

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from logweir.functions.ip import ip_to_long
from logweir.operators import geo, records
from logweir.registry import fixtures as X
from logweir.registry.queries import QUERIES
from logweir.schema import GEO_LABELS, RECORD_FIELDS
from logweir.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BATCH = """parse_pipe parse_json ods_rows rcode_typed csv_dedup ip_to_long ipv6_hex geo_dim_load geo_enrich
geo_enrich_asof cidr_lookup cidr6_lookup prefix_counts prefix_counts_salted prefix_map hop_count_top10
hop_count_sql tumble_count set_insert set_members delete_keys clients_per_resolver""".split()
STREAM = "hop_count_top10_stream hop_count_append ods_load dwd_load upsert_latest partition_commit".split()


def normalise_in_python(spark, sf_dir):
    """The normalising projection as a Python function over partitions."""
    rows = X.dns(spark, sf_dir).select(*RECORD_FIELDS)

    def clean(frames):
        for f in frames:
            f["domain"] = f["domain"].str.lower()
            f["authority_record"] = f["authority_record"].fillna("").str.lower()
            f["add_msg"] = f["add_msg"].fillna("")
            yield f

    return rows.mapInPandas(clean, rows.schema)


def normalise_in_columns(spark, sf_dir):
    return records.normalise(X.dns(spark, sf_dir))


def range_join(spark, sf_dir):
    """The location lookup as a plain range condition, which plans as a nested loop."""
    asked = X.dns(spark, sf_dir).select("seq", ip_to_long(F.col("client_ip")).alias("ip"))
    segments = X.saved_geo(spark, sf_dir)
    return asked.join(segments, F.col("ip").between(F.col("seg_lo"), F.col("seg_hi")), "left")


def block_join(spark, sf_dir):
    asked = X.dns(spark, sf_dir).select("seq", "client_ip")
    return geo.locate(asked, X.saved_geo(spark, sf_dir), GEO_LABELS)


COMPARE = [normalise_in_columns, normalise_in_python, block_join, range_join]


def seconds(spark, fn, runs):
    """Median time to produce every row of a query, after one run to warm up."""
    times = []
    for i in range(runs + 1):
        start = time.perf_counter()
        fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {name: seconds(spark, QUERIES[name], 1) for name in BATCH + STREAM}
    total = round(sum(timed.values()), 3)
    if os.environ.get("BENCH_COMPARE"):
        timed.update({fn.__name__: seconds(spark, fn, 3) for fn in COMPARE})
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timed, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
