"""Keyed upsert of a stream into a keyed table: the last write of an id wins."""

from logweir.streaming.keyed_table import BUCKETS, KeyedTable
from logweir.streaming.ledger import run_of
from logweir.streaming.sinks import triggered


def upsert_stream(
    df, path, checkpoint, keys=("id",), order=("seq",), mode="append", every=None, buckets=BUCKETS, compact_every=None
):
    """Write a stream of keyed rows. `order` ranks the writes inside one batch.

    A batch costs what it brings. With `compact_every` the table is folded after each so many batches.
    """

    def put(batch, batch_id):
        spark = batch.sparkSession
        table = KeyedTable(spark, path, keys, buckets)
        table.upsert(batch, order, run_of(spark, checkpoint), batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(put)
    return triggered(writer, every).start()


def delete_stream(keys_df, path, checkpoint, keys=("id",), every=None):
    """Delete the keys a stream brings. Nothing is deleted from a table that holds no rows yet."""

    def drop(batch, batch_id):
        spark = batch.sparkSession
        KeyedTable(spark, path, keys).delete(batch, run_of(spark, checkpoint), batch_id)

    writer = keys_df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(drop)
    return triggered(writer, every).start()


def read_upserts(spark, path, keys=("id",)):
    """Current rows of the table at `path`."""
    return KeyedTable(spark, path, keys).read()


def compact_upserts(spark, path, keys=("id",)):
    """Fold all batches written so far, also while a stream goes on writing."""
    return KeyedTable(spark, path, keys).compact()
