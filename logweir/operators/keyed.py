"""Keyed sets, key/value rows and hash fields as tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from logweir.operators.skew import lookup_join


def latest_rows(df, keys, order):
    """The last written row of every key.

    `row_number = 1` is reduced per task before the shuffle, so a key with many writes sends one
    row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def set_insert(existing, additions, keys=("key", "member")):
    """Set after an insert: every (key, member) once, `added` where the insert brought it.

    Both sides meet in one aggregation, so repeats are dropped before the shuffle.
    """
    both = existing.select(*keys, F.lit(False).alias("_new")).unionByName(
        additions.select(*keys, F.lit(True).alias("_new"))
    )
    return both.groupBy(*keys).agg(F.min("_new").alias("added"))


def inserted_keys(inserted, key="key"):
    """Per key, how many members an insert added and whether there was any."""
    n = F.count_if(F.col("added")).alias("n_added")
    return inserted.groupBy(key).agg(n).withColumn("any_added", F.col("n_added") > 0)


def set_members(pairs, wanted, key="key", member="member", **options):
    """Distinct members of the wanted keys; `wanted` is a table of keys."""
    # Other keys go before repeats are removed, so that only wanted members are shuffled.
    of_wanted = lookup_join(
        pairs.select(key, member), wanted.select(key).distinct(), [key], "left_semi", salt_by=[member], **options
    )
    return of_wanted.dropDuplicates()


def members_of(pairs, keys, key="key", member="member"):
    """Distinct members of a few keys given by value."""
    return pairs.where(F.col(key).isin(*keys)).select(key, member).dropDuplicates()


def delete_keys(df, gone, keys=("key",), **options):
    """Rows whose key is not in the table of deleted keys."""
    keys = list(keys)
    return lookup_join(df, gone.select(*keys).distinct(), keys, "left_anti", **options)


def delete_fields(df, gone, key="key", field="field", **options):
    """Rows of a hash table, long form, without the listed fields of the listed keys."""
    return delete_keys(df, gone, (key, field), **options)


def drop_map_fields(df, column, fields):
    """The same on a map column: entries under the given names are dropped."""
    kept = F.map_filter(column, lambda k, _: ~k.isin(*fields))
    return df.withColumn(column, kept)
