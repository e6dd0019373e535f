"""A keyed table of versioned writes: upserts, deletes and inserts of new keys, merged on reading.

Every write goes to a folder of its own, bucketed by key, and becomes visible with the next document of the table's
ledger, which lists the live folders in order. Reading opens them as the partitions of one bucketed table, so the rows
of a key meet in their bucket without a shuffle, and the last write of a key wins; a tombstone hides it. Compaction
writes the merged rows to one folder and swaps it for the folders it has folded, also while streams go on writing.
A stream's batch is known by its query's id and its number, so it is applied once, and a new checkpoint adds to what
earlier ones have written.
"""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from logweir.operators.keyed import latest_rows
from logweir.streaming.ledger import Ledger, remove

BUCKETS = 16


class KeyedTable:
    """`keys` name the key columns. They and the number of buckets are fixed by the first write."""

    def __init__(self, spark, path, keys=("id",), buckets=BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.ledger = Ledger(spark, f"{self.path}/ledger")
        self._given = list(keys), buckets

    def state(self):
        number, state = self.ledger.latest()
        keys, buckets = self._given
        return number, state or {"keys": keys, "buckets": buckets, "schema": None, "next": 1, "live": [], "applied": {}}

    # Writing

    def upsert(self, rows, order=(), run=None, batch=None):
        """Rows replace those of their keys. `order` ranks the writes of one key inside `rows`."""
        keys = self.state()[1]["keys"]
        return self._add(latest_rows(rows, keys, order) if order else rows.dropDuplicates(keys), False, run, batch)

    def delete(self, keys, run=None, batch=None):
        """Tombstones for a table of keys. Keys that are written later come back."""
        number, state = self.state()
        if state["schema"] is None:
            return False
        names = state["keys"]
        empty = self.spark.createDataFrame([], state["schema"])
        rows = empty.unionByName(keys.select(*names).distinct(), allowMissingColumns=True)
        return self._add(rows, True, run, batch)

    def insert_new(self, rows, run=None, batch=None):
        """Rows whose keys the table does not hold, each key once; those it holds stay as they are.

        Only the row groups of touched buckets are read, and the table is not shuffled.
        """
        state = self.state()[1]
        fresh = rows.dropDuplicates(state["keys"])
        if state["live"]:
            fresh = self._unheld(fresh, state)
        return self._add(fresh, False, run, batch)

    def _unheld(self, fresh, state):
        """The rows whose keys the table does not hold. They are brought to the buckets, the table stays where it is."""
        keys = state["keys"]
        # One number per bucket at most.
        touched = [r["b"] for r in fresh.select(self._bucket(state).alias("b")).distinct().collect()]
        held = self._current(state, F.col("_bucket").isin(*touched)).select(*keys)
        held = held.withColumnsRenamed({k: f"_held_{k}" for k in keys})
        named = fresh.repartition(state["buckets"], *keys)
        new = named.join(held.hint("merge"), [F.col(k) == F.col(f"_held_{k}") for k in keys], "left_anti")
        # A key with a null equals only itself; those are few, as each is held once.
        blank = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        of_held = reduce(lambda a, b: a | b, [F.col(f"_held_{k}").isNull() for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]
        return new.where(~blank).unionByName(fresh.where(blank).join(held.where(of_held), same, "left_anti"))

    def _bucket(self, state):
        return F.pmod(F.hash(*state["keys"]), F.lit(state["buckets"])).cast("int")

    def _add(self, rows, gone, run, batch):
        number, state = self.state()
        if run is not None and state["applied"].get(run, -1) >= batch:
            return False
        kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        if state["schema"] not in (None, kind):
            raise ValueError(f"the table holds {state['schema']}, not {kind}")
        folder = self._written(rows.withColumns({"_bucket": self._bucket(state), "_gone": F.lit(gone)}), state)
        while True:
            if run is not None:
                state["applied"][run] = batch
            state["schema"] = kind
            state["live"].append([state["next"], folder])
            state["next"] += 1
            if self.ledger.publish(state, number):
                return True
            number, state = self.state()
            if run is not None and state["applied"].get(run, -1) >= batch:
                remove(self.spark, f"{self.path}/data/{folder}")
                return False

    def _written(self, rows, state):
        folder = uuid.uuid4().hex
        name = f"keyed_{folder}"
        rows.repartition(state["buckets"], *state["keys"]).write.format("parquet").bucketBy(
            state["buckets"], *state["keys"]).sortBy(*state["keys"]).option("path", f"{self.path}/data/{folder}").saveAsTable(name)
        # The files stay: the table is external.
        self.spark.sql(f"DROP TABLE {name}")
        return folder

    # Reading

    def _opened(self, state):
        """The live folders as partitions `_write` of one bucketed table of the session's catalog."""
        name = f"keyed_{uuid.uuid4().hex}"
        keys = ", ".join(f"`{k}`" for k in state["keys"])
        self.spark.sql(
            f"CREATE TABLE {name} ({state['schema']}, _bucket INT, _gone BOOLEAN, _write BIGINT) USING parquet PARTITIONED BY (_write) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {state['buckets']} BUCKETS LOCATION '{self.path}/data'")
        parts = " ".join(f"PARTITION (_write = {n}) LOCATION '{self.path}/data/{folder}'" for n, folder in state["live"])
        self.spark.sql(f"ALTER TABLE {name} ADD {parts}")
        return self.spark.table(name)

    def _current(self, state, among="true"):
        """The last write of each key, without keys whose last write is a tombstone."""
        return latest_rows(self._opened(state).where(among), state["keys"], ["_write"]).where(~F.col("_gone"))

    def read(self, write_column=None):
        """Current rows; `write_column` names a column for the number of the write each one comes from."""
        state = self.state()[1]
        if not state["live"]:
            return self.spark.createDataFrame([], state["schema"] or ", ".join(f"`{k}` string" for k in state["keys"]))
        rows = self._current(state)
        named = [F.col("_write").alias(write_column)] if write_column else []
        return rows.select(*[c for c in rows.columns if c not in ("_bucket", "_gone", "_write")], *named)

    def last_write(self):
        """Number of the last write, 0 before the first."""
        return self.state()[1]["next"] - 1

    # Upkeep

    def compact(self):
        """Fold all writes so far into one folder and drop tombstones. Writes that come meanwhile stay behind it.

        The folded folders are kept for readers that have opened them until `clean` is called.
        """
        number, state = self.state()
        if len(state["live"]) < 2:
            return False
        folded = state["live"]
        rows = self._current(state).drop("_write")
        folder = self._written(rows, state)
        while True:
            behind = [w for w in state["live"] if w not in folded]
            if len(behind) + len(folded) != len(state["live"]):
                # Another compaction was first.
                remove(self.spark, f"{self.path}/data/{folder}")
                return False
            state["live"] = [[folded[-1][0], folder], *behind]
            if self.ledger.publish(state, number):
                return True
            number, state = self.state()

    def clean(self):
        """Remove the folders that no write of the state refers to. Call it when nothing is being written."""
        live = {folder for _, folder in self.state()[1]["live"]}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if files.exists(path):
            for f in files.listStatus(path):
                if f.getPath().getName() not in live:
                    files.delete(f.getPath(), True)
