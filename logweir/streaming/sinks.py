"""Stream sinks. Every sink needs a checkpoint folder: it is what identifies a query's progress."""

from pyspark.sql import functions as F


def stream_writer(df, fmt, mode="append", options=None):
    """Any sink by format name, output mode and options."""
    return df.writeStream.format(fmt).outputMode(mode).options(**(options or {}))


def triggered(writer, every=None):
    """Run on an interval ("60 seconds"), or once over everything that is there."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def run_to_end(query):
    """Wait for a query; a failed one raises here."""
    query.awaitTermination()
    return query


def to_table(
    df, name, checkpoint, path=None, partition_by=("year", "month", "day"), fmt="orc", every=None
):
    """Append to a partitioned table, which the first start creates."""
    options = {"checkpointLocation": checkpoint, **({"path": path} if path else {})}
    writer = triggered(stream_writer(df, fmt, options=options), every)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.toTable(name)


def to_csv(df, path, checkpoint, header=True, every=None):
    options = {"checkpointLocation": checkpoint, "path": path, "header": str(header).lower()}
    return triggered(stream_writer(df, "csv", options=options), every).start()


def to_console(df, checkpoint, mode="append", rows=30, every=None):
    options = {"checkpointLocation": checkpoint, "truncate": "false", "numRows": str(rows)}
    return triggered(stream_writer(df, "console", mode, options), every).start()


def tuple_lines(df):
    """Rows as text lines of the form `(a,b,c)`."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")")).alias("value"))


def to_text(df, path, checkpoint, max_rows_per_file=None, every=None):
    """Rolling text files: a new file per trigger and, if set, per number of rows."""
    options = {"checkpointLocation": checkpoint, "path": path}
    if max_rows_per_file:
        options["maxRecordsPerFile"] = str(max_rows_per_file)
    return triggered(stream_writer(tuple_lines(df), "text", options=options), every).start()


def to_jdbc(df, url, table, checkpoint, properties=None, batch_rows=10_000, batch_column=None, every=None):
    """Insert each batch into a JDBC table, a connection per partition and many rows per round trip.

    Delivery is at least once: a batch that is repeated after a failure is inserted again. With
    `batch_column` each row carries its batch number, by which the target can tell repeats.
    An error fails the batch, and Spark retries.
    """
    settings = {"batchsize": str(batch_rows), **(properties or {})}

    def insert(batch, batch_id):
        rows = batch.withColumn(batch_column, F.lit(batch_id)) if batch_column else batch
        rows.write.jdbc(url, table, mode="append", properties=settings)

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(insert)
    return triggered(writer, every).start()
