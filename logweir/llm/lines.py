"""Line de-duplication by how many sites a line is found on.

A HyperLogLog sketch of the sites is merged per line hash; lines whose estimate is near the threshold get
an exact distinct count. A line on as many sites is boilerplate: its first place in the corpus (smallest
document id, text hash and line number) stays, all others go. Blank lines stay. Lines are compared trimmed
and in lower case. A null text holds no line and stays null; a null site is no site; repeated rows share
their places, so the first of them stays in each.
"""

from pyspark.sql import functions as F

from logweir.llm.common import broadcast_within, let, stored

#: Lines of fewer sites in the estimate than LOW of the threshold are few, of more than HIGH are many.
LOW, HIGH = 0.75, 1.25
BROADCAST_ROWS = 1_000_000
#: Wide lines that are looked up by each text where it lies, 60 bytes each.
LOOKED_UP = 500_000


def line_hashes(docs, doc_id, site, text):
    """doc_id, text_hash, site, pos, line (hash) for every line that is not blank."""
    trimmed = F.transform(F.split(F.col(text), "\n"), lambda s: F.trim(F.lower(s)))
    coded = F.transform(trimmed, lambda s, i: F.when(s != "", F.struct(i.alias("pos"), F.xxhash64(s).alias("line"))))
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(site).alias("site"),
        F.explode(F.array_compact(coded)).alias("l"),
    ).select("doc_id", "text_hash", "site", "l.pos", "l.line")


def spread(rows, threshold=5):
    """line, n_sites, first, exact (whether counted exactly) of the lines found on `threshold` sites or more."""
    # A line found fewer than `threshold` times cannot be on as many sites and needs no sketch.
    often = rows.groupBy("line").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "pos")).alias("first"))
    often = stored(often.where(F.col("n") >= threshold).select("line", "first"), "line-often")
    n_often = often.count()
    pairs = rows.join(broadcast_within(often.select("line"), n_often, BROADCAST_ROWS), "line").select("line", "site")
    pairs = stored(pairs, "line-sites")
    rough = pairs.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", 12)).alias("est"))
    rough = stored(rough, "line-estimates")
    near = rough.where(F.col("est").between(LOW * threshold, HIGH * threshold)).select("line")
    exact = pairs.join(broadcast_within(near, n_often, BROADCAST_ROWS), "line").where(F.col("site").isNotNull()).distinct()
    exact = exact.groupBy("line").agg(F.count(F.lit(1)).alias("n_sites"))
    sure = rough.where(F.col("est") > HIGH * threshold).select("line", F.col("est").alias("n_sites"), F.lit(False).alias("exact"))
    settled = exact.where(F.col("n_sites") >= threshold).select("line", "n_sites", F.lit(True).alias("exact"))
    return sure.unionByName(settled).join(often, "line")


def lookup_table(wide, rows):
    """(column, buckets): the wide lines of a stored table of `rows` rows as one array of small buckets.

    The column is a scalar subquery, so the array is worked out once and sent to each task.
    """
    buckets = 1 << max(0, (rows - 1).bit_length())
    number = F.pmod(F.col("line"), F.lit(buckets)).cast("int").alias("bucket")
    filled = wide.groupBy(number).agg(F.collect_list(F.struct("line", "first")).alias("held"))
    numbers = wide.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    table = numbers.join(filled, "bucket", "left").agg(F.array_sort(F.collect_list(F.struct("bucket", "held"))).alias("table"))
    return table.select(F.transform("table", lambda b: b["held"])).scalar(), buckets


def removals(rows, wide):
    """doc_id, text_hash, drop: the line numbers to go, for the texts that lose lines."""
    hit = rows.join(wide, "line")
    later = ~F.struct("doc_id", "text_hash", "pos").eqNullSafe(F.col("first"))
    return hit.where(later).groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("drop"))


def without_boilerplate(docs, threshold=5, doc_id="doc_id", site="source", text="text", looked_up=LOOKED_UP):
    """The documents with all their columns, less the lines of wide spread. Documents left blank stay.

    Each text looks its lines up where it lies, in a table of the wide lines; texts are not moved. Only if there are
    more than `looked_up` wide lines, the numbers of the lines to go are brought to the texts by a join.
    """
    rows = line_hashes(docs, doc_id, site, text)
    wide = stored(spread(rows, threshold).select("line", "first"), "line-wide")
    n_wide = wide.count()
    if not n_wide:
        return docs
    body, here = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    if n_wide <= looked_up:
        table, buckets = lookup_table(wide, n_wide)
        name = "_wide_lines" + "_" * max(map(len, docs.columns))

        def goes(line, i, text_hash):
            held = lambda h: F.exists(F.get(name, F.pmod(h, F.lit(buckets)).cast("int")), lambda w: (
                (w["line"] == h) & ~F.struct(here, text_hash, i).eqNullSafe(w["first"])))
            trimmed = F.trim(F.lower(line))
            return (trimmed != "") & F.coalesce(let(F.xxhash64(trimmed), held), F.lit(False))

        new = let(F.xxhash64(body), lambda h: F.array_join(F.filter(F.split(body, "\n"), lambda s, i: ~goes(s, i, h)), "\n"))
        # A null text stays null, by its split.
        looked = docs.withColumn(name, table)
        return looked.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
    gone = stored(removals(rows, wide), "line-drops")
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("drop").alias("_drop"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, here.alias("_doc"), body.alias("_text"))
    both = keyed.join(gone, F.col("_doc").eqNullSafe(F.col("_id")) & (F.xxhash64("_text") == F.col("_hash")), "left")
    # The dropped numbers become a text of marks, one per line, so each line is tested by one look-up.
    flags = F.map_from_arrays("_drop", F.transform("_drop", lambda _: F.lit(True)))
    kept = F.array_join(F.filter(F.split("_text", "\n"), lambda s, i: F.try_element_at("_flags", i).isNull()), "\n")
    both = both.withColumn("_flags", F.when(F.col("_drop").isNotNull(), flags))
    new = F.when(F.col("_flags").isNull(), F.col("_text")).otherwise(kept)
    return both.select(*[new.alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns])
