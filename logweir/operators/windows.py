"""Counts over tumbling and sliding time windows, and top-k over them."""

from pyspark.sql import functions as F

from logweir.functions.parsing import time_text


def windowed(df, size, slide=None, keys=("client_ip",), time="event_time", agg=None, watermark=None):
    """One aggregate per window and key, with the window bounds as columns.

    Without `slide` the windows tumble. A row enters size/slide windows inside the scan stage and
    is counted there before the shuffle, so a busy client sends one row per window and task.
    """
    if watermark:
        df = df.withWatermark(time, watermark)
    window = F.window(time, size, slide) if slide else F.window(time, size)
    value = F.count(F.lit(1)).alias("n") if agg is None else agg
    counted = df.groupBy(window.alias("window"), *keys).agg(value)
    measures = [c for c in counted.columns if c not in ("window", *keys)]
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *measures
    )


def top_k(counts, k=10, measure="n", descending=True):
    """First k rows by the measure; window start and client settle ties."""
    first = F.desc(measure) if descending else F.asc(measure)
    return counts.orderBy(first, "window_start", "client_ip").limit(k)


def client_window_counts(timed, size="2 minutes", slide="30 seconds", watermark=None):
    return windowed(timed, size, slide, watermark=watermark)


def with_arrival_time(df, column="arrival_ts", transport=None):
    """Adds the time a row arrives, for windows over arrival rather than event time.

    `transport` names the time stamp the transport gives a message (`timestamp` of a Kafka row); without one it is
    the clock of the batch.
    """
    return df.withColumn(column, F.col(transport).cast("timestamp") if transport else F.current_timestamp())


def arrival_window_sums(df, arrival="arrival_ts", watermark="1 minute"):
    """Sum of ones per client over arrival time, 2 minutes every 30 seconds.

    The arrival clock does not go back by more than `watermark`, so on a stream the state of a window is dropped
    that long after its end.
    """
    total = F.sum("one").alias("n")
    return windowed(df.withColumn("one", F.lit(1)), "2 minutes", "30 seconds", time=arrival, agg=total, watermark=watermark)


def hop_counts_sql(spark, view, k=10):
    """The sliding count as a SQL text over a registered table or view."""
    return spark.sql(
        f"""
        SELECT window.start AS window_start, window.end AS window_end, client_ip, ip_count
        FROM (
          SELECT window(event_time, '2 minutes', '30 seconds') AS window, client_ip,
                 count(client_ip) AS ip_count
          FROM {view} GROUP BY 1, 2)
        ORDER BY ip_count DESC, window_start, client_ip
        LIMIT {int(k)}
        """
    )


def bounds_as_text(counts):
    """Window bounds as text, for files and for comparison across engines."""
    return counts.withColumns({c: time_text(F.col(c)) for c in ("window_start", "window_end")})
