"""Helpers the corpus operators share: local bindings, words and shingles, stored intermediates."""

from pyspark.sql import functions as F

from logweir.session import work_folder

#: A word is a run of letters and digits, read in lower case.
WORD = r"[\p{L}\p{N}]+"


def let(value, body):
    """`body(value)` with `value` worked out once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column):
    """Text column with null read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text):
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def shingles(text, k=5, whole=False):
    """Hashes of the k-word windows of a text, in order and with repeats.

    A text of fewer than k words has none; with `whole` its words count as one window if there are any.
    """

    def windows(h):
        slide = F.transform(
            F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)])
        )
        rest = F.array().cast("array<bigint>")
        if whole:
            rest = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(rest)
        return F.when(F.size(h) >= k, slide).otherwise(rest)

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), windows)


def shared_folder(spark, label):
    """A fresh folder under the shared folder the cluster names in `spark.checkpoint.dir`."""
    return work_folder(spark, f"corpus/{label}")


def stored(df, label):
    """The rows written as a table in the shared folder and read back, which cuts the lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_within(df, rows, limit):
    """Broadcast hint for a table measured at `rows` rows, only up to `limit` of them."""
    return F.broadcast(df) if rows <= limit else df
