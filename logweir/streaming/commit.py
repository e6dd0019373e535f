"""Hour-partitioned sink that publishes a partition once event time has passed it.

A partition is published when its hour plus `wait` is at or before the watermark (largest event time seen minus
`delay`): a success file is put in its folder and a record in the log of committed partitions. Rows of a batch go to
folders named by the query's run and the batch, so a repeated batch replaces its own rows, and a new checkpoint adds
to what earlier ones have written. The open hours and the watermark are the state: one small document in a ledger,
replaced with every batch, which a new checkpoint takes over. Rows that come for an hour after its publication are
written like others and recorded as late.
"""

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from logweir.streaming.ledger import Ledger, run_of
from logweir.streaming.sinks import triggered

HOUR = ["dt", "hr"]
#: Small files that are put at the same time: each is a few calls that wait for the file system.
PUT_AT_ONCE = 16
COMMITTED = StructType(
    [StructField("dt", StringType()), StructField("hr", StringType()), StructField("rows", LongType()),
     StructField("run", StringType()), StructField("batch", LongType())]
)


def exists(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def put_file(spark, path, text=""):
    """A small file written whole, in place of an earlier one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def put_marks(spark, paths):
    """Empty files, several at a time."""
    if not paths:
        return
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = jvm.org.apache.hadoop.fs.Path(paths[0]).getFileSystem(conf)
    with ThreadPoolExecutor(PUT_AT_ONCE) as pool:
        list(pool.map(lambda p: files.create(jvm.org.apache.hadoop.fs.Path(p), True).close(), paths))


def _recorded(spark, folder):
    if not exists(spark, folder):
        return spark.createDataFrame([], COMMITTED)
    return spark.read.schema(COMMITTED).json(folder)


def committed_partitions(spark, path):
    """Published partitions with the rows they had then and the run and batch that published them."""
    return _recorded(spark, f"{path}/committed")


def late_partitions(spark, path):
    """Rows that came for an hour after its publication, per run and batch."""
    return _recorded(spark, f"{path}/late")


def seconds_of(interval):
    """Length of an interval text such as "10 seconds" or "1 hour"."""
    number, unit = interval.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def begin_micros(hour):
    day, hr = hour.split(" ")
    begin = dt.datetime.fromisoformat(day).replace(hour=int(hr), tzinfo=dt.timezone.utc)
    return int(begin.timestamp()) * 1_000_000


def advanced(state, seen, delay, wait):
    """(new state, due, late) for the rows per hour of a batch, `seen`: hour -> (rows, largest time in micros).

    The state holds the open hours with their rows, the largest time seen and the time up to which hours are published.
    """
    latest = max([state["latest"], *(micros for _, micros in seen.values())])
    passed = latest - (seconds_of(delay) + seconds_of(wait)) * 1_000_000
    opened, late = dict(state["open"]), {}
    for hour, (rows, _) in seen.items():
        if begin_micros(hour) <= state["published"] and hour not in opened:
            late[hour] = rows
        else:
            opened[hour] = opened.get(hour, 0) + rows
    due = {h: n for h, n in opened.items() if begin_micros(h) <= passed}
    still = {h: n for h, n in opened.items() if h not in due}
    return {"open": still, "latest": latest, "published": max(state["published"], passed)}, due, late


def commit_stream(
    rows, path, checkpoint, time="event_time", delay="10 seconds", wait="1 hour", fmt="orc", every=None
):
    """One query at a time may write to `path`."""

    def publish(batch, batch_id):
        spark = batch.sparkSession
        run, ledger = run_of(spark, checkpoint), Ledger(spark, f"{path}/state")
        number, state = ledger.latest()
        state = state or {"open": {}, "latest": -(2**62), "published": -(2**62), "applied": {}}
        if state["applied"].get(run, -1) >= batch_id:
            return
        part = f"{run}-{batch_id}"
        placed = batch.withColumns({"dt": F.date_format(time, "yyyy-MM-dd"), "hr": F.date_format(time, "HH")})
        # A row per hour of the batch comes to the driver, counted before the rows are written.
        found = placed.where(F.col(time).isNotNull()).groupBy(*HOUR).agg(
            F.count(F.lit(1)).alias("n"), F.unix_micros(F.max(time)).alias("micros")).collect()
        # Rebalanced, so that an hour gets few files, and a large hour more than one task.
        # Tasks move their files into the staging folder themselves; folders are replaced from there once all are done.
        settings = {"partitionOverwriteMode": "dynamic", "mapreduce.fileoutputcommitter.algorithm.version": "2"}
        placed.withColumn("part", F.lit(part)).hint("rebalance", *HOUR).write.mode("overwrite").options(
            **settings
        ).partitionBy(*HOUR, "part").format(fmt).save(f"{path}/data")

        seen = {f"{r['dt']} {r['hr']}": (r["n"], r["micros"]) for r in found}
        news, due, late = advanced(state, seen, delay, wait)
        put_marks(spark, [f"{path}/data/dt={day}/hr={hr}/_SUCCESS" for day, hr in (hour.split(" ") for hour in due)])
        for folder, hours in (("committed", due), ("late", late)):
            if hours:
                lines = [dict(zip(HOUR, h.split(" ")), rows=n, run=run, batch=batch_id) for h, n in sorted(hours.items())]
                put_file(spark, f"{path}/{folder}/{part}.json", "".join(json.dumps(line) + "\n" for line in lines))
        # Only now is the batch done; before, it is repeated with the same results.
        if not ledger.publish({**news, "applied": {**state["applied"], run: batch_id}}, number):
            raise RuntimeError(f"another query has written to {path}")

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish)
    return triggered(writer, every).start()
