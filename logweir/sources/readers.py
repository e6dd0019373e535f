"""Batch and stream readers. Every endpoint is an argument; every text column stays a string."""

from logweir.schema import GEO_FILE_SCHEMA, RECORD_SCHEMA


def stream_reader(spark, source, options=None):
    """Any stream source by format name and options (kafka, socket, rate, files)."""
    return spark.readStream.format(source).options(**(options or {}))


def kafka_options(
    servers, topic, starting_offsets="latest", max_offsets=None, fail_on_data_loss=False, retries=3
):
    """Options of a Kafka scan; `starting_offsets` may be earliest, latest or per-partition JSON."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "fetchOffset.numRetries": str(retries),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(spark, servers, topic, **kwargs):
    return stream_reader(spark, "kafka", kafka_options(servers, topic, **kwargs)).load()


def file_stream(spark, path, schema, fmt="parquet", files_per_trigger=None):
    """Files that appear in a folder; `files_per_trigger` is the intake limit of one batch."""
    options = {} if files_per_trigger is None else {"maxFilesPerTrigger": str(files_per_trigger)}
    return stream_reader(spark, fmt, options).schema(schema).load(path)


def table_stream(spark, name, files_per_trigger=None):
    """Follow a table that another job fills."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.table(name)


def csv_records(spark, path, header=False, sep=","):
    """Delimited files of nine string columns."""
    return spark.read.schema(RECORD_SCHEMA).csv(path, header=header, sep=sep)


def text_lines(spark, path):
    return spark.read.text(path)


def geo_file(spark, path):
    """Pipe-delimited address ranges; the unused field is never read."""
    return spark.read.schema(GEO_FILE_SCHEMA).csv(path, sep="|").drop("unused")


def table_head(spark, name, n, order_by=()):
    """The first n rows of a table, in a fixed order when order columns are named."""
    table = spark.table(name)
    return (table.orderBy(*order_by) if order_by else table).limit(n)
