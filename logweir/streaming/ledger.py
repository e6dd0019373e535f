"""Numbered JSON documents in a folder: the latest one is the state of a sink, a new one replaces it at once.

A document is written beside the folder's numbered files and renamed to the next number, which fails if another writer
was first. A reader sees the old state or the new one, never a part. Earlier documents are removed but for a few.
"""

import json
import uuid

KEPT = 5


class Ledger:
    def __init__(self, spark, path):
        jvm = spark._jvm
        self._path, self._jvm = path.rstrip("/"), jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._file("").getFileSystem(self._conf)
        options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        self._no_overwrite = spark.sparkContext._gateway.new_array(options, 1)
        self._no_overwrite[0] = options.NONE

    def _file(self, name):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{name}" if name else self._path)

    def _numbers(self):
        if not self._fs.exists(self._file("")):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._file(""))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def latest(self):
        """(number, document) of the state, (0, None) before the first one."""
        while True:
            numbers = self._numbers()
            if not numbers:
                return 0, None
            try:
                stream = self._fs.open(self._file(f"{numbers[-1]:020d}.json"))
            except Exception:
                if self._numbers()[-1:] == numbers[-1:]:
                    raise
                continue  # Removed meanwhile, as there are newer ones.
            try:
                reader = self._jvm.org.apache.commons.io.IOUtils
                return numbers[-1], json.loads(reader.toString(stream, "UTF-8"))
            finally:
                stream.close()

    def publish(self, document, after):
        """Make `document` the state if the state is still number `after`; False if another writer was first."""
        part = self._file(f"_{uuid.uuid4().hex}")
        stream = self._fs.create(part, False)
        try:
            stream.write(bytearray(json.dumps(document, sort_keys=True).encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), self._conf)
        try:
            context.rename(part, self._file(f"{after + 1:020d}.json"), self._no_overwrite)
        except Exception:
            self._fs.delete(part, False)
            if self._numbers()[-1:] == [after]:
                raise
            return False
        for number in self._numbers()[:-KEPT]:
            self._fs.delete(self._file(f"{number:020d}.json"), False)
        return True


def run_of(spark, checkpoint):
    """The id of the query that owns a checkpoint folder: the same after a restart, another in a new folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def remove(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
