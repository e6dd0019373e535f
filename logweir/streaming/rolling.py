"""Rolling text files: the small files of a text sink packed into files of a set size, a few at a time.

A roll looks at the names, sizes and times of the files it has not packed yet and fills bins in order of time. A bin is
closed when it is full, when its first file is old enough, or when nothing has been added for a while; files of the bin
that is still open wait for the next roll. Closed bins are written by one job, a file per bin, and become part of the
rolled text with the next document of the ledger. Files that are packed are not read again.
"""

import time
import uuid

from pyspark.sql import functions as F

from logweir.streaming.ledger import Ledger

# A file is rolled at 800 MiB, after 300 seconds, or after 20 seconds without new rows.
ROLL_BYTES = 800 * 1024 * 1024
ROLL_SECONDS = 300
IDLE_SECONDS = 20
#: Names of packed files are remembered for so long behind the newest of them; all older files count as packed.
REMEMBERED_SECONDS = 86_400


def listed(spark, folder):
    """(time in seconds, name, bytes) of the text files of a folder, in order of time."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = [f for f in files.listStatus(path) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    return sorted((f.getModificationTime() / 1000, f.getPath().getName(), f.getLen()) for f in found)


def planned(files, now, file_bytes=ROLL_BYTES, roll_seconds=ROLL_SECONDS, idle_seconds=IDLE_SECONDS):
    """Closed bins, lists of (time, name, bytes), filled in the given order."""
    bins, size = [], 0
    for f in files:
        if not bins or (size and size + f[2] > file_bytes):
            bins.append([])
            size = 0
        bins[-1].append(f)
        size += f[2]
    if bins and size < file_bytes and now - bins[-1][0][0] < roll_seconds and now - bins[-1][-1][0] < idle_seconds:
        bins.pop()
    return bins


def roll_text(spark, source, target, now=None, **limits):
    """Pack the new files of `source`; the number of files written. Session settings stay as they are."""
    ledger = Ledger(spark, f"{target}/_ledger")
    number, state = ledger.latest()
    state = state or {"through": 0, "packed": {}, "folders": []}
    new = [f for f in listed(spark, source) if f[1] not in state["packed"] and f[0] >= state["through"]]
    bins = planned(new, time.time() if now is None else now, **limits)
    if not bins:
        return 0
    place = {name: i for i, files in enumerate(bins) for _, name, _ in files}
    where = spark.createDataFrame(list(place.items()), "_name string, _bin int")
    rows = spark.read.text([f"{source}/{name}" for name in place]).select("value", F.col("_metadata.file_name").alias("_file"))
    rows = rows.join(F.broadcast(where), F.col("_file") == F.col("_name"))
    folder = uuid.uuid4().hex
    rows.repartitionById(len(bins), F.col("_bin")).select("value").write.text(f"{target}/{folder}")

    packed = {**state["packed"], **{name: t for files in bins for t, name, _ in files}}
    through = max(state["through"], max(packed.values()) - REMEMBERED_SECONDS)
    waiting = [f[0] for f in new if f[1] not in packed]
    through = min([through, *waiting])
    packed = {name: t for name, t in packed.items() if t >= through}
    if not ledger.publish({"through": through, "packed": packed, "folders": [*state["folders"], folder]}, number):
        raise RuntimeError(f"another roll has written to {target}")
    return len(bins)


def rolled_text(spark, target):
    """All rolled lines, as column `value`."""
    state = Ledger(spark, f"{target}/_ledger").latest()[1]
    if not state:
        return spark.createDataFrame([], "value string")
    return spark.read.text([f"{target}/{folder}" for folder in state["folders"]])
