"""Work on keys that hold a large share of all rows: measured broadcast, salted joins, staged sums."""

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from logweir.functions.parsing import network_prefix
from logweir.session import ensure_checkpoint_dir

FIXED_WIDTH = (BooleanType, DatetimeType, NumericType)
BROADCAST_BYTES = 128 * 1024 * 1024
ROWS_PER_TASK = 5_000_000
# Salts of the two stages of a staged aggregation.
STAGES = (99, 9)
# The sketch of frequent keys: keys it tells of at most, and keys it keeps counters for.
REPORTED_KEYS = 2_000
TRACKED_KEYS = 50_000


def sized_bytes(df):
    """Size of a row in memory: its text plus a fixed share per row and column.

    Arrays, maps and structs are counted by their text form.
    """
    sized = [f.name for f in df.schema.fields if not isinstance(f.dataType, FIXED_WIDTH)]
    text = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in sized), F.lit(0))
    return text.cast("bigint") + 16 + 12 * len(df.columns)


def measured_bytes(df):
    """Size of a table's rows in memory."""
    return df.agg(F.coalesce(F.sum(sized_bytes(df)), F.lit(0))).first()[0]


def heavy_hitters(df, keys, more_than):
    """[(hash of the key, estimated rows)] of the keys that hold more than so many rows, most frequent first.

    One pass with a mergeable frequent-items sketch per task, so nothing but the sketches is shuffled. It tracks
    TRACKED_KEYS keys; an estimate can be too high by rows / (0.75 * TRACKED_KEYS) at most, and a key that holds
    more than that is never missed.
    """
    tracked = F.expr(f"approx_top_k(_key, {REPORTED_KEYS}, {TRACKED_KEYS})").alias("found")
    hashed = df.where(F.col(keys[0]).isNotNull()).select(F.xxhash64(*keys).alias("_key"))
    found = hashed.agg(tracked).first()["found"] or []
    return [(r["item"], r["count"]) for r in found if r["count"] > more_than]


def hot_keys(df, keys, rows_per_task=ROWS_PER_TASK):
    """Hashes of keys with more rows than one task should take, and into how many salts to split each."""
    hot = [(h, -(-n // rows_per_task)) for h, n in heavy_hitters(df, keys, rows_per_task)]
    return df.sparkSession.createDataFrame(hot, "_hash bigint, _salts int")


def lookup_join(
    left,
    right,
    on,
    how="left",
    residual=None,
    salt_by=None,
    broadcast_bytes=BROADCAST_BYTES,
    rows_per_task=ROWS_PER_TASK,
    stored=False,
):
    """Equi-join of a large table with a lookup table that has few rows per key.

    The lookup table is broadcast only if its measured size allows. Otherwise both sides shuffle
    on the key, and the rows of each hot key that the sketch finds are spread over as many tasks as
    its count asks for, with the matching lookup rows repeated once per salt. `salt_by` names columns
    that tell rows of one key apart (an offset or sequence number); the result does not depend on it.
    On a stream keys are not salted: a batch holds no more rows than the intake limit lets in.
    `residual` is a further condition over columns of both sides. A lookup table that is not yet
    `stored` is written to the checkpoint folder first, so that measuring it does not compute it twice.
    """
    if not stored:
        ensure_checkpoint_dir(right.sparkSession)
        right = right.checkpoint()
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in on], *[c for c in right.columns if c not in on]
    )
    match = [F.col(k) == F.col(f"_r_{k}") for k in on] + ([residual] if residual is not None else [])
    drop = [f"_r_{k}" for k in on] + ["_salt", "_r_salt"]

    if measured_bytes(right) <= broadcast_bytes:
        return left.join(F.broadcast(renamed), _all(match), how).drop(*drop)

    # A null key matches nothing; hashing it by row keeps such rows from meeting in one task.
    spread = F.xxhash64(*(salt_by or left.columns))
    anywhere = F.pmod(spread, F.lit(1 << 20))
    if left.isStreaming:
        # The rows of a stream cannot be counted ahead; a batch is bounded by the intake limit.
        salted = left.withColumn("_salt", F.when(F.col(on[0]).isNull(), anywhere).otherwise(F.lit(0)).cast("int"))
        copies = renamed.withColumn("_r_salt", F.lit(0))
    else:
        hot = hot_keys(left, on, rows_per_task)
        of_left = hot.select(F.col("_hash").alias("_h_left"), "_salts")
        salt = F.when(F.col(on[0]).isNull(), anywhere).otherwise(F.pmod(spread, F.coalesce("_salts", F.lit(1))))
        salted = left.join(F.broadcast(of_left), F.xxhash64(*on) == F.col("_h_left"), "left")
        salted = salted.withColumn("_salt", salt.cast("int")).drop("_h_left", "_salts")
        copies = renamed.join(F.broadcast(hot), F.xxhash64(*[f"_r_{k}" for k in on]) == F.col("_hash"), "left").withColumn(
            "_r_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        ).drop("_salts", "_hash")
    return salted.join(copies.hint("merge"), _all(match + [F.col("_salt") == F.col("_r_salt")]), how).drop(*drop)


def _all(conditions):
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def client_prefixes(records, targets, keep=()):
    """Client network prefix of every record that asks for one of the targets."""
    asked = records.where(F.col("target_ip").isin(*targets))
    return asked.select(*keep, "target_ip", network_prefix(F.col("client_ip")).alias("prefix"))


def prefix_counts(prefixes):
    """Rows per target and prefix. Counting before any collecting keeps a hot target spread out."""
    return prefixes.groupBy("target_ip", "prefix").agg(F.count(F.lit(1)).alias("n"))


def salted_agg(df, keys, aggs, salt_by, hot=None, stages=STAGES):
    """Staged aggregation: rows of a hot key are first reduced per salt, then per coarser salt.

    `aggs` maps an output name to (function, column) with function in count, sum, min, max.
    `hot` is a condition; rows outside it get a single salt. Without one the hot keys are found by a
    sketch: those that hold more than one part in REPORTED_KEYS of all rows. The salt is a hash of
    `salt_by`, so a task that runs again puts its rows in the same groups. Each stage's salt is a
    function of the one before. Equal to the plain aggregation for any stages and any hot keys.
    """
    if hot is None:
        found = heavy_hitters(df, keys, df.count() // REPORTED_KEYS)
        hot = F.xxhash64(*keys).isin([h for h, _ in found])
    merge = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
    salt = F.when(hot, F.pmod(F.xxhash64(*salt_by), F.lit(stages[0]))).otherwise(F.lit(0))
    step = df.withColumn("_salt", salt.cast("int"))
    step = step.groupBy(*keys, "_salt").agg(
        *[getattr(F, fn)(col).alias(name) for name, (fn, col) in aggs.items()]
    )
    merged = [getattr(F, merge[fn])(name).alias(name) for name, (fn, _) in aggs.items()]
    for n in stages[1:]:
        step = step.withColumn("_salt", F.pmod(F.col("_salt"), F.lit(n)))
        step = step.groupBy(*keys, "_salt").agg(*merged)
    return step.groupBy(*keys).agg(*merged)


def salted_prefix_counts(prefixes, salt_by, hot=None, stages=STAGES):
    return salted_agg(prefixes, ["target_ip", "prefix"], {"n": ("count", F.lit(1))}, salt_by, hot, stages)


def part_of(text, parts):
    """Stable part number of a text, the same in any engine that has MD5."""
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, parts).cast("int")


def _parts(counted, keys, weight, limit):
    """How many parts each key needs so that no part holds much more than `limit`."""
    total = counted.groupBy(*keys).agg(F.sum(weight).alias("_total"))
    parts = F.greatest(F.ceil(F.col("_total") / limit), F.lit(1)).cast("int").alias("parts")
    return total.select(*keys, parts).checkpoint()


def prefix_maps(counts, keys=("target_ip",), parts=1, max_entries=None):
    """Histogram per key as maps of prefix to count, each key in `parts` maps, which hold every prefix once.

    With `max_entries` a key is given as so many maps that each holds about that number at most, so that no row has
    to hold an unbounded group; their number is in the column `parts`.
    """
    entries = counts.withColumn("prefix", F.coalesce("prefix", F.lit("")))
    keys, sized = list(keys), []
    if max_entries:
        ensure_checkpoint_dir(counts.sparkSession)
        entries = entries.checkpoint()
        needed = _parts(entries, keys, F.lit(1), max_entries)
        entries = lookup_join(entries, needed, keys, "inner", salt_by=["prefix"], stored=True)
        parts, sized = F.col("parts"), ["parts"]
    else:
        parts = F.lit(parts)
    placed = entries.withColumn("part", part_of(F.col("prefix"), parts))
    # Sorted by prefix, so that equal histograms are equal rows.
    entry = F.sort_array(F.collect_list(F.struct("prefix", "n")))
    return placed.groupBy(*keys, "part", *sized).agg(F.map_from_entries(entry).alias("counts"))


def merge_maps(maps, keys=("target_ip",)):
    """Sum of maps that share a key, entry by entry, in long form."""
    entries = maps.select(*keys, F.explode("counts").alias("prefix", "n"))
    return entries.groupBy(*keys, "prefix").agg(F.sum("n").alias("n"))


def prefix_lists(prefixes, row_id, parts=1, max_items=None):
    """All prefixes seen per target, repeats included, as sorted arrays, each target in `parts` of them.

    A target's rows are split by `row_id`; all parts together hold every row once. With `max_items` a target is given
    as so many arrays that each holds about that number at most, counted first; their number is in the column `parts`.
    """
    rows, sized = prefixes.withColumn("prefix", F.coalesce("prefix", F.lit(""))), []
    if max_items:
        ensure_checkpoint_dir(prefixes.sparkSession)
        needed = _parts(rows.groupBy("target_ip").agg(F.count(F.lit(1)).alias("n")), ["target_ip"], "n", max_items)
        rows = lookup_join(rows, needed, ["target_ip"], "inner", salt_by=[row_id], stored=True)
        parts, sized = F.col("parts"), ["parts"]
    else:
        parts = F.lit(parts)
    placed = rows.withColumn("part", part_of(F.col(row_id).cast("string"), parts))
    return placed.groupBy("target_ip", "part", *sized).agg(F.sort_array(F.collect_list("prefix")).alias("prefixes"))


def histogram_lines(maps):
    """One text line per map: `(key,{entry=count, ...})`."""
    entries = F.transform(
        F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    line = F.concat(
        F.lit("("), F.col("target_ip"), F.lit(",{"), F.array_join(entries, ", "), F.lit("})")
    )
    return maps.select(line.alias("value"))


def last_digit(key, n):
    """Partition number of a key: its last character as a digit, modulo n; 0 for other endings."""
    return F.coalesce(F.pmod(F.right(key, F.lit(1)).try_cast("int"), F.lit(n)), F.lit(0))


def place_by_digit(df, key, n):
    """Each row in the partition its key's last digit asks for. Use on reduced rows."""
    return df.repartitionById(n, last_digit(F.col(key), n))
