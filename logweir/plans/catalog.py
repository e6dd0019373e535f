"""Catalog and table definition helpers over Spark SQL."""

from logweir.schema import RECORD_FIELDS


def use_database(spark, name, catalog=None, create=False):
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if create:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.catalog.setCurrentDatabase(name)


def list_databases(spark):
    return spark.sql("SHOW DATABASES")


def list_tables(spark, database=None):
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def drop_table(spark, name):
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(spark, name, schema, fmt="orc", partition_by=(), path=None, options=None):
    """Create a table if it is not there; partition columns are part of the schema."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}"]
    if options:
        parts.append("OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")")
    if partition_by:
        parts.append("PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")")
    if path:
        parts.append(f"LOCATION '{path}'")
    spark.sql(" ".join(parts))


def insert_select(spark, target, source, partition="hour", expression="substr(`time`, 1, 10)"):
    """Append the records of `source` to a table whose last column is the partition.

    One partition per 14-digit time would be one per second; the hour cut from it is used instead.
    The rebalance hint splits a large hour over several tasks and files.
    """
    columns = ", ".join(f"`{c}`" for c in [*[c for c in RECORD_FIELDS if c != "time"], "time"])
    spark.sql(
        f"INSERT INTO {target} SELECT /*+ REBALANCE({partition}) */ * FROM "
        f"(SELECT {columns}, {expression} AS {partition} FROM {source})"
    )
