"""Product codes of vectors by Lloyd's rounds over parts that stay with their owners.

A vector's components become integers floor(scale * x), and the vector is cut into consecutive parts. The member
table holds every distinct part once per place of its making, with its number of copies, and is bucketed by its owner
(position, entry, salt). A round works in the owners: the sums of an entry are taken where its members lie, without an
exchange, and only those sums are merged over the salts. With the new codebooks each owner finds the nearest entries
of its members; members that keep their entry are written back to their own bucket, and only those that change it go
through a shuffle. A hot entry is spread over its salts, a hot vector is combined before the first shuffle.

Rows whose vector is null or holds a null or non-finite component are dropped. Dimensions are those of the kept
row with the smallest id; a vector of another length, or one with a component of `LIMIT` or more (whose squared
distances would pass 64 bits), stays in the result with a null code and error, and teaches nothing. Ids may repeat
or be null; equal ids are ordered by their vectors, null ids come last. With fewer rows than entries there are fewer
entries. Parts differ in length by one at most if the dimensions cannot be divided. An empty table gives no rows.
"""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logweir.llm.common import broadcast_within, shared_folder, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components from here on are not coded: 127 squares of differences up to 2^28 still fit 64 bits.
LIMIT = 2.0**15
#: Members an owner should hold at most, if all rows were of one entry, and members a bucket should hold.
OWNED, BUCKETED = 1_000_000, 1_000_000
MAX_BUCKETS = 20_000
OWNER = ["position", "entry", "salt"]


def finite(vector):
    v = F.col(vector)
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def codable(vector, dims):
    return (F.size(vector) == dims) & F.forall(F.col(vector), lambda x: F.abs(x) < LIMIT)


def cuts(dims, parts):
    return [dims * i // parts for i in range(parts + 1)]


def integers(vectors, scale):
    """Matrix of floor(scale * x) of a list array without nulls; exact for 32-bit floats."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).astype(np.int64).reshape(len(vectors), -1)


def nearest(parts, entries):
    """(index of the nearest entry, squared distance) of each row of parts; ties go to the lower index."""
    far = np.stack([((parts - e) ** 2).sum(axis=1) for e in np.asarray(entries, dtype=np.int64)], axis=1)
    best = far.argmin(axis=1)
    return best, far[np.arange(len(parts)), best]


def salted(parts, salts):
    """A salt that is a function of the part alone."""
    mixed = np.zeros(len(parts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in parts.T:
            mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(salts)).astype(np.int32)


def members(rows, books, dims, scale, salts):
    """Parts with their nearest entry, copies within a batch combined: position, entry, salt, n, c0, c1, ..."""
    at = cuts(dims, len(books))
    width = max(b - a for a, b in zip(at[:-1], at[1:]))

    def cut(batches):
        for batch in batches:
            whole = integers(batch.column(0), scale)
            if not len(whole):
                continue
            for position, book in enumerate(books):
                part, n = np.unique(whole[:, at[position]:at[position + 1]], axis=0, return_counts=True)
                entry, _ = nearest(part, book)
                padded = np.zeros((len(part), width), dtype=np.int64)
                padded[:, :part.shape[1]] = part
                yield batch_of(np.full(len(part), position), entry, salted(part, salts), n, padded)

    return rows.mapInArrow(cut, schema(width))


def schema(width, more=""):
    return "position int, entry int, salt int, n long, " + ", ".join(f"c{i} int" for i in range(width)) + more


def batch_of(position, entry, salt, n, part, more=None):
    columns = {"position": position, "entry": entry, "salt": salt, "n": n, **{f"c{i}": c for i, c in enumerate(part.T)}, **(more or {})}
    return pa.RecordBatch.from_pydict(
        {name: pa.array(c, pa.int64() if name == "n" else pa.int32()) for name, c in columns.items()})


def reassigned(homes, books, dims):
    """Members with the entry that is nearest by new codebooks, as column `now`."""
    at = cuts(dims, len(books))
    width = len(homes.columns) - 4

    def look(batches):
        for batch in batches:
            position = batch.column("position").to_numpy()
            part = np.stack([batch.column(f"c{i}").to_numpy() for i in range(width)], axis=1).astype(np.int64)
            now = np.zeros(len(position), dtype=np.int64)
            for p in np.unique(position):
                mine = position == p
                now[mine], _ = nearest(part[mine, :at[p + 1] - at[p]], books[p])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(now, pa.int32())], [*batch.schema.names, "now"])

    return homes.mapInArrow(look, schema(width, ", now int"))


def housed(rows, buckets):
    """The member rows written as a table bucketed by owner; (name, folder)."""
    name, folder = f"members_{uuid.uuid4().hex[:12]}", shared_folder(rows.sparkSession, "vector-members")
    rows.write.format("parquet").bucketBy(buckets, *OWNER).option("path", folder).saveAsTable(name)
    return name, folder


def vacated(spark, name, folder):
    """Drop a member table that a later one has replaced."""
    spark.sql(f"DROP TABLE {name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def owned_sums(homes):
    """Copies and component sums per owner. Members lie with their owner, so nothing is exchanged."""
    sums = [F.sum(F.col("n") * F.col(c)).alias(c) for c in homes.columns[4:]]
    return homes.groupBy(*OWNER).agg(F.sum("n").alias("n"), *sums)


def updated(homes, books, dims):
    """New codebooks: each entry with members becomes floor(sum / count) of its parts."""
    at, owned = cuts(dims, len(books)), owned_sums(homes)
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in owned.columns[3:]]
    # One row per entry in use, whatever the number of members.
    merged = owned.groupBy("position", "entry").agg(*wide).collect()
    new = [list(book) for book in books]
    for row in merged:
        position, entry, n, *sums = (int(x) for x in row)
        new[position][entry] = [s // n for s in sums[:at[position + 1] - at[position]]]
    return new


def migrated(homes, books, dims, buckets):
    """Members under new codebooks: those that keep their entry as they lie, the others shuffled to their owner."""
    looked = reassigned(homes, books, dims)
    stay = looked.where(F.col("now") == F.col("entry")).drop("now")
    go = looked.where(F.col("now") != F.col("entry")).withColumn("entry", F.col("now")).drop("now")
    return stay.unionByName(go.repartition(buckets, *OWNER))


def trained(df, vec_id="vec_id", vector="embedding", parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE):
    """(codebooks, dims): per part a list of entries, each a list of integers. Empty for a table without vectors."""
    spark = df.sparkSession
    kept = df.where(finite(vector)).select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    order = [F.col("id").isNull(), F.col("id"), F.col("v")]
    lead = kept.orderBy(*order).limit(1).collect()
    if not lead:
        return [], 0
    dims = len(lead[0]["v"])
    usable = kept.where(codable("v", dims))
    # As many rows as there are entries.
    first = usable.orderBy(*order).limit(entries).collect()
    if not first or not dims:
        return [], dims
    at = cuts(dims, parts)
    whole = np.floor(np.array([r["v"] for r in first]) * scale).astype(np.int64).tolist()
    books = [[row[a:b] for row in whole] for a, b in zip(at[:-1], at[1:])]

    n = usable.count()
    salts = max(4, -(-n // OWNED))
    buckets = min(MAX_BUCKETS, max(8, -(-n * parts // BUCKETED)))
    placed = members(usable.select("v"), books, dims, scale, salts).repartition(buckets, *OWNER)
    home = housed(placed, buckets)
    for r in range(rounds):
        if r:
            last, home = home, housed(migrated(spark.table(home[0]), books, dims, buckets), buckets)
            vacated(spark, *last)
        books = updated(spark.table(home[0]), books, dims)
    vacated(spark, *home)
    return books, dims


def coded(df, books, dims, vector="embedding", scale=SCALE):
    """The rows with a finite vector, with columns code and error; both are null where a vector cannot be coded."""
    at = cuts(dims, len(books)) if books else []

    @F.arrow_udf("struct<code:string,error:long>")
    def code(vectors: pa.Array) -> pa.Array:
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        whole = integers(vectors.drop_null(), scale) if valid.any() else np.zeros((0, dims), dtype=np.int64)
        found = [nearest(whole[:, a:b], book) for a, b, book in zip(at[:-1], at[1:], books)]
        texts, errors = np.full(len(valid), None, dtype=object), np.full(len(valid), None, dtype=object)
        if len(whole):
            numbers = np.stack([best for best, _ in found], axis=1).tolist()
            texts[valid] = ["".join(f"{i:02x}" for i in row) for row in numbers]
            errors[valid] = np.sum([far for _, far in found], axis=0).tolist()
        return pa.StructArray.from_arrays(
            [pa.array(texts.tolist(), pa.string()), pa.array(errors.tolist(), pa.int64())], ["code", "error"])

    kept = df.where(finite(vector))
    if not books:
        return kept.withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("bigint")})
    v = F.when(codable(vector, dims), F.col(vector).cast("array<double>"))
    others = [f"`{c}`" for c in df.columns if c.lower() not in ("code", "error", "_coded")]
    return kept.withColumn("_coded", code(v)).select(*others, "_coded.code", "_coded.error")


def books_text(books):
    return ",".join(str(x) for book in books for entry in book for x in entry)


def with_label_error(rows, label="label"):
    """Adds the error summed over rows of one label, nulls together. `rows` should be a stored table."""
    sums = stored(rows.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error")), "vector-labels")
    sums = broadcast_within(sums, sums.count(), 100_000)
    return rows.join(sums, F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")


def compressed(df, vec_id="vec_id", vector="embedding", label="label", **options):
    """vec_id, label, code, error, label_error, codebooks_sha256 of every row with a finite vector."""
    books, dims = trained(df, vec_id, vector, **options)
    narrow = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = stored(coded(narrow, books, dims, "vector", options.get("scale", SCALE)).drop("vector"), "vector-codes")
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return with_label_error(rows).withColumn("codebooks_sha256", F.lit(digest))
