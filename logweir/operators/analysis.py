"""Reports on the records themselves."""

from pyspark.sql import functions as F


def domain_mismatch(records):
    """Records answered for another domain than the one asked for."""
    answered = F.lower("authority_record")
    return records.where((F.col("authority_record") != "") & (F.lower("domain") != answered))


def rcode_counts(records):
    return records.groupBy("rcode").agg(F.count(F.lit(1)).alias("n"))


def clients_per_resolver(records):
    """Requests and distinct clients per resolving server.

    Pairs are reduced first, on resolver and client together, so a busy resolver is spread out.
    """
    pairs = records.groupBy("dns_ip", "client_ip").agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy("dns_ip").agg(
        F.count("client_ip").alias("clients"), F.sum("_n").alias("requests")
    )
