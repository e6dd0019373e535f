"""Lookup of addresses in disjoint segments by cells of a fixed prefix.

A segment is filed once, under the smallest cell that holds both its ends: of the cell sizes in use, the finest in
which its first and last address agree. An address asks the cell it lies in at each size in use, and since segments
are disjoint, one of all candidates can match at most. Nothing is cut into pieces, whatever a segment covers, and the
log is neither counted nor shuffled where the segments of a size fit a broadcast. A size whose segments do not fit is
joined by a shuffle on its cell; adaptive execution splits the busy cells, and rows without an address are spread.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from logweir.operators.skew import BROADCAST_BYTES, sized_bytes

#: Cell sizes, finest first: host bits of an IPv4 cell, leading hex digits of an IPv6 cell. A cell holds at most 256
#: segments filed under it for IPv4 and 15 for IPv6, as each of them crosses a border of the next finer size. So an
#: address meets few candidates, however many segments there are.
V4_CELLS = (8, 16, 24, 32)
V6_CELLS = tuple(range(32, -1, -1))
#: Sizes that can hold 65,791 segments at most in all cells together, whatever the table: always broadcast.
BOUNDED = {V4_CELLS: (24, 32), V6_CELLS: (3, 2, 1, 0)}
#: The sizes broadcast in one lookup hold so many times the bytes of a single broadcast at most.
BROADCASTS = 4


def worked_out(df, **columns):
    """`df` with computed columns, each worked out once per row.

    They come out of an inlined one-element array. As plain projections they would be repeated in every filter, join key
    and expression on top of them, and reading an address costs more than all joins that use it.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def v4_cell(address, size):
    return F.shiftright(address, size)


def v6_cell(digits, size):
    return F.substring(digits, 1, size)


def filed(segments, cell, sizes):
    """Segments (seg_lo, seg_hi, labels) with the `cell_size` they are filed under."""
    lo, hi = F.col("seg_lo"), F.col("seg_hi")
    found = F
    for size in sizes:
        found = found.when(cell(lo, size) == cell(hi, size), F.lit(size))
    return segments.withColumn("cell_size", found)


def measured_sizes(segments):
    """{cell size: bytes} of filed segments; one row per size in use comes to the driver."""
    rows = segments.groupBy("cell_size").agg(F.sum(sized_bytes(segments)).alias("size")).collect()
    return {r["cell_size"]: r["size"] for r in rows}


def locate_in(df, segments, labels, address, cell, sizes, broadcast_bytes=BROADCAST_BYTES):
    """`df` with the labels of the segment that holds `address`, nulls where none does. For tables and streams.

    `segments` should be a stored table: it is measured, and read once per cell size in use.
    """
    segments = filed(segments, cell, sizes)
    measured = measured_sizes(segments)
    sent, left = set(BOUNDED[sizes]), BROADCASTS * broadcast_bytes
    for size in sorted(set(measured) - sent, key=measured.get):
        if measured[size] <= min(left, broadcast_bytes):
            sent.add(size)
            left -= measured[size]
    located, found = worked_out(df, _address=address), []
    for size in [s for s in sizes if s in measured]:
        part = segments.where(F.col("cell_size") == size).select(
            cell(F.col("seg_lo"), size).alias("_cell"), F.col("seg_lo").alias("_lo"), F.col("seg_hi").alias("_hi"),
            F.struct(*labels).alias(f"_held_{size}"))
        asked = cell(F.col("_address"), size)
        if size in sent:
            part = F.broadcast(part)
        else:
            # A null matches nothing; as text of its own kind it does not send all such rows to one task.
            part = part.withColumn("_cell", F.col("_cell").cast("string")).hint("merge")
            nowhere = F.concat(F.lit("-"), F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)).cast("string"))
            asked = F.coalesce(asked.cast("string"), nowhere)
        held = F.col("_address").between(F.col("_lo"), F.col("_hi"))
        located = located.join(part, (asked == F.col("_cell")) & held, "left").drop("_cell", "_lo", "_hi")
        found.append(f"_held_{size}")
    if not found:
        kinds = {f.name: f.dataType for f in segments.schema.fields}
        return df.select(*df.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in labels])
    return located.select(*df.columns, *[F.coalesce(*[F.col(f"{h}.{c}") for h in found]).alias(c) for c in labels])


def followed(points, column, after="after"):
    """Distinct values of a column, each with the next larger one (null for the last).

    The values are put in order by ranges. The value after the last one of a range is the first of the next range that
    has any, taken from a table with a row per range, so no task holds more than its range.
    """
    placed = points.select(column).distinct().repartitionByRange(F.col(column))
    placed = placed.withColumn("_range", F.spark_partition_id()).checkpoint()
    firsts = placed.groupBy("_range").agg(F.min(column).alias("_first"))
    border = firsts.select(F.col("_range").alias("_r"), F.lead("_first").over(Window.orderBy("_range")).alias("_border"))
    inside = F.lead(column).over(Window.partitionBy("_range").orderBy(column))
    spans = placed.withColumn("_inside", inside).join(F.broadcast(border), F.col("_range") == F.col("_r"), "left")
    return spans.select(column, F.coalesce("_inside", "_border").alias(after))


def innermost_segments(blocks, labels, after, before, top):
    """Disjoint segments (seg_lo, seg_hi, labels) that give each address the labels of its longest block.

    `blocks` holds one row (_len, _first, _last, labels) per network; they are nested or apart, so those of one length
    follow each other. The answer can only change at a block's first address or one past its last. These edges are put
    in order by ranges, and a running value per length in use (129 at most) holds the block of that length that began
    last: the longest of them that has not ended is the winner. What a range takes over from the ones before it comes
    from a table with a row per range. `after` and `before` step an address, `top` is the highest one.
    """
    lengths = sorted((r["_len"] for r in blocks.select("_len").distinct().collect()), reverse=True)
    if not lengths:
        return blocks.select(F.col("_first").alias("seg_lo"), F.col("_last").alias("seg_hi"), *labels)
    held = F.struct("_last", *labels).alias("_held")
    edges = F.array(
        F.struct(F.col("_first").alias("seg_lo"), "_len", held),
        F.struct(after(F.col("_last")).alias("seg_lo"), F.lit(None).cast("int").alias("_len"), F.lit(None).alias("_held")))
    edges = blocks.select(F.inline(edges)).where(F.col("seg_lo").isNotNull())
    placed = edges.repartitionByRange("seg_lo").withColumn("_range", F.spark_partition_id()).checkpoint()

    def of_length(n):
        return F.when(F.col("_len") == n, F.col("_held"))

    begun = [F.max_by(of_length(n), F.when(F.col("_len") == n, F.col("seg_lo"))).alias(f"_last_{n}") for n in lengths]
    ranges = placed.groupBy("_range").agg(F.min("seg_lo").alias("_start"), *begun)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    border = ranges.select(
        F.col("_range").alias("_r"), F.lead("_start").over(Window.orderBy("_range")).alias("_border"),
        *[F.last(f"_last_{n}", ignorenulls=True).over(earlier).alias(f"_from_{n}") for n in lengths])
    inside = Window.partitionBy("_range").orderBy("seg_lo")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.select(
        "_range", "seg_lo", F.lead("seg_lo").over(inside).alias("_next"),
        *[F.last(of_length(n), ignorenulls=True).over(so_far).alias(f"_at_{n}") for n in lengths])
    # Of the edges at one address the last one has seen all of them.
    running = running.where(F.col("_next").isNull() | (F.col("_next") != F.col("seg_lo")))
    running = running.join(F.broadcast(border), F.col("_range") == F.col("_r"))

    def winner(n):
        block = F.coalesce(f"_at_{n}", f"_from_{n}")
        return F.when(block["_last"] >= F.col("seg_lo"), block)

    spans = running.select(
        "seg_lo", F.coalesce("_next", "_border").alias("_after"), F.coalesce(*map(winner, lengths)).alias("_held"))
    spans = spans.where(F.col("_held").isNotNull())
    return spans.select("seg_lo", F.coalesce(before(F.col("_after")), F.lit(top)).alias("seg_hi"), *[f"_held.{c}" for c in labels])
