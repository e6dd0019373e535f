"""Exact Jaccard join of n-gram sets, light sets by subsets and heavy sets by inverted lists.

A document's set is its distinct k-word shingles; with fewer words, the whole sequence is one shingle. Documents
with equal sets are one class from the start. Two sets of s and t shingles are similar if they share at least
`needed(s, t)` of them, so:

- Light sets (fewer shingles than the boundary) enumerate their subsets of that fixed size, for each size of a
  partner. Of the sets that share such a subset one of the smaller size is similar to all, so each is linked with the
  first of these and no pairs are formed.
- Heavy sets scan inverted lists of the shingles that come first when a set is ordered from rare to frequent. Sets
  that share none of their first s - needed + 1 shingles cannot be similar. How frequent a shingle is, is read from a
  sketch of counters over all documents, so passages that many documents share come last and make no lists. First
  each member of a list is compared with the one that has the fewest rarer shingles; then lists whose members are
  still of several components compare all pairs of different components. Nothing is left out.

The boundary is where the subsets to be written plus the list places to be scanned are fewest, both counted.
Candidates are verified on whole sets, which are made again for the candidates only and never kept for all documents.

Documents without words or text have no shingles and are linked with nothing. Null ids are kept and never lead a
component; repeated rows are linked with each other. Shingles are compared by 64-bit hashes, classes by 128 bits.
"""

import hashlib
import itertools
import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

from logweir.llm.common import broadcast_within, stored
from logweir.llm.near import components, mixed

#: Similar from 90 of 100 on.
SHARE = (90, 100)
#: Sets of this size or more are never light.
MOST_LIGHT = 40
#: Counters of the sketch per block, and blocks at most (one byte each where it is broadcast, 16 MB in all).
BLOCK, MAX_BLOCKS = 1 << 16, 256
#: Keys and ids up to which a table of candidates is broadcast.
BROADCAST_KEYS = 300_000


def needed(s, t, share=SHARE):
    """Shingles that sets of s and t must share: the least c with share of (s + t - c) <= c. Columns or numbers."""
    part, whole = share
    return (part * (s + t) + part + whole - 1) // (part + whole) if isinstance(s, int) else F.floor(
        (part * (s + t) + part + whole - 1) / (part + whole)).cast("int")


def partners(s, share=SHARE):
    """Sizes of sets that one of s shingles can be similar to."""
    part, whole = share
    return range(-(-s * part // whole), s * whole // part + 1)


class Hashed(dict):
    """Hashes of words, kept while there are few."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingled(text, hashes, k):
    """Sorted distinct shingle hashes (uint64) of a text."""
    words = (text or "").encode().lower().split()
    h = np.fromiter((hashes[w] for w in words), dtype=np.uint64, count=len(words))
    width = min(k, len(h))
    if not width:
        return h
    with np.errstate(over="ignore"):
        found = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for j in range(width):
            found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - width + 1 + j])
    return np.unique(found)


def slices(batches, rows=1000):
    """Batches cut small, so that a task holds the sets of few documents at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def slots_of(grams, slots):
    return (mixed(grams) & np.uint64(slots - 1)).astype(np.int64)


def frequencies(docs, text, k, slots):
    """One byte per counter: the size class of the number of sets a shingle of that slot is in."""
    blocks = max(1, slots // BLOCK)
    size = slots // blocks

    def count(batches):
        seen, hashes = np.zeros(slots, dtype=np.int32), Hashed()
        for batch in slices(batches):
            for t in batch.column(0).to_pylist():
                np.add.at(seen, slots_of(shingled(t, hashes, k), slots), 1)
        for block in range(blocks):
            part = seen[block * size:(block + 1) * size]
            if part.any():
                # Tasks are merged in two steps, so that no step holds the counters of all tasks.
                salt = TaskContext.get().partitionId() // 256
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([block], pa.int32()), "salt": pa.array([salt], pa.int32()),
                     "counts": pa.array([packed(part)], pa.binary())})

    def merge(key, rows):
        total = sum(unpacked(c) for c in rows["counts"])
        return pd.DataFrame({"block": [int(key[0])], "salt": [0], "counts": [packed(total)]})

    kind = "block int, salt int, counts binary"
    parts = docs.select(F.col(text)).mapInArrow(count, kind)
    parts = parts.groupBy("block", "salt").applyInPandas(merge, kind).groupBy("block").applyInPandas(merge, kind)
    classes = np.zeros(slots, dtype=np.uint8)
    # A fixed number of blocks, whatever the number of documents.
    for row in parts.collect():
        n = unpacked(row["counts"])
        classes[row["block"] * size:(row["block"] + 1) * size] = np.minimum(np.round(4 * np.log2(n + 1)), 255)
    return classes


def packed(counts):
    counts = counts.astype(np.min_scalar_type(int(counts.max())))
    return counts.dtype.char.encode() + zlib.compress(counts.tobytes(), 1)


def unpacked(data):
    data = bytes(data)
    return np.frombuffer(zlib.decompress(data[1:]), dtype=data[:1].decode()).astype(np.int64)


def described(docs, text, k, share, classes):
    """id, text_hash, key, n, first (rarest shingles) and light (all shingles of a small set) of each document."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(classes)
    part, whole = share

    def describe(batches):
        often, hashes = known.value, Hashed()
        for batch in slices(batches):
            sets = [shingled(t, hashes, k) for t in batch.column("text").to_pylist()]
            first = []
            for s in sets:
                upto = len(s) - -(-len(s) * part // whole) + 1 if len(s) else 0
                order = np.lexsort((s, often[slots_of(s, len(often))]))
                first.append(s[order[:upto]].view(np.int64))
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
            light = [s.view(np.int64) if 0 < len(s) < MOST_LIGHT else None for s in sets]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(keys, pa.string()), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array(first, longs), pa.array(light, longs)], ["id", "text_hash", "key", "n", "first", "light"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(describe, f"id {kind}, text_hash long, key string, n int, first array<long>, light array<long>")


def subset_sizes(s, below, share=SHARE):
    """(smaller size, larger size, subset size) for the partners of a light set of s shingles."""
    return [(min(s, t), max(s, t), needed(s, t, share)) for t in partners(s, share) if t < below]


def subset_count(s, below, share=SHARE):
    return sum(math.comb(s, c) for _, _, c in subset_sizes(s, below, share))


def boundary(sizes, share=SHARE):
    """The size from which sets are heavy. `sizes`: size -> (sets, list places scanned for them), for small sizes."""

    def cost(x):
        light = sum(n * subset_count(s, x, share) for s, (n, _) in sizes.items() if s < x)
        # Light sets with heavy partners are in the lists as well.
        listed = sum(places for s, (_, places) in sizes.items() if partners(s, share)[-1] >= x)
        return light + listed

    return min(range(1, MOST_LIGHT + 1), key=lambda x: (cost(x), x))


def light_links(sets, below, share):
    """Pairs (a, b) of keys of light sets: each set with the first smaller set of a shared subset."""

    def enumerate_subsets(batches):
        for batch in batches:
            lo, hi, subset, key = [], [], [], []
            for name, grams in zip(batch.column("key").to_pylist(), batch.column("light")):
                g = mixed(np.asarray(grams.as_py(), dtype=np.int64).view(np.uint64))
                with np.errstate(over="ignore"):
                    for small, large, c in subset_sizes(len(g), below, share):
                        # A subset's hash is the sum of all its shingles' less that of those left out.
                        gone = np.array(list(itertools.combinations(range(len(g)), len(g) - c)), dtype=np.int64)
                        made = g.sum() - g[gone].sum(axis=1) if gone.size else np.array([g.sum()])
                        lo += [small] * len(made)
                        hi += [large] * len(made)
                        subset += made.view(np.int64).tolist()
                        key += [name] * len(made)
            yield pa.RecordBatch.from_pydict({"lo": pa.array(lo, pa.int32()), "hi": pa.array(hi, pa.int32()), "subset": pa.array(subset, pa.int64()),
                                              "key": pa.array(key, pa.string())})

    made = sets.where(F.col("n") < below).select("key", "light")
    made = stored(made.mapInArrow(enumerate_subsets, "lo int, hi int, subset long, key string"), "jaccard-subsets")
    size = sets.select("key", "n")
    by = ["lo", "hi", "subset"]
    sized = made.join(size, "key")
    # A set of the smaller size is similar to all others of the bucket; two of the larger size need not be.
    both = sized.groupBy(*by).agg(F.min(F.struct("n", "key")).alias("head"), F.max(F.struct("n", "key")).alias("tail"))
    both = both.where("head <> tail AND head.n = lo AND tail.n = hi").select(*by, F.col("head.key").alias("a"))
    return made.join(both, by).where("a <> key").select("a", F.col("key").alias("b"))


def verified(pairs, reps, docs, k, share):
    """The pairs of keys (a, b) whose whole sets are similar."""
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-pairs")
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    asked = stored(reps.join(keys, "key").select("key", F.col("rep.id").alias("_id"), F.col("rep.text_hash").alias("_hash")), "jaccard-asked")
    asked = broadcast_within(asked, asked.count(), BROADCAST_KEYS)
    met = docs.join(asked, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))).select("key", "text")

    def sets(batches):
        hashes = Hashed()
        for batch in slices(batches):
            made = [shingled(t, hashes, k).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made, pa.list_(pa.int64()))], ["key", "grams"])

    # Rows that repeat both id and text give the set once.
    met = stored(met.mapInArrow(sets, "key string, grams array<long>").dropDuplicates(["key"]), "jaccard-sets")
    left = met.select(F.col("key").alias("a"), F.col("grams").alias("ga"))
    right = met.select(F.col("key").alias("b"), F.col("grams").alias("gb"))
    common = F.size(F.array_intersect("ga", "gb"))
    enough = common >= needed(F.size("ga"), F.size("gb"), share)
    return stored(pairs.join(left, "a").join(right, "b").where(enough).select("a", "b"), "jaccard-links")


def similar_at(s, i, t, j, share):
    """Whether places i and j of the orders of two sets leave room for enough common shingles."""
    c = needed(s, t, share)
    return (i <= s - c) & (j <= t - c)


def components_of(docs, text="text", doc_id="doc_id", k=3, share=SHARE):
    """id, n, key, label, first_id: for every document its set size and component, and the component's smallest id."""
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    letters = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    # About one counter for eight words.
    slots = 1 << max(8, min((BLOCK * MAX_BLOCKS).bit_length() - 1, (letters // 48).bit_length()))
    classes = frequencies(rows, "text", k, slots)
    members = stored(described(rows, text="text", k=k, share=share, classes=classes), "jaccard-members")

    # One row per distinct set, with the first document that has it.
    lead = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("rep")
    reps = members.where("n > 0").groupBy("key").agg(lead, F.any_value("n").alias("n"), F.any_value("first").alias("first"), F.any_value("light").alias("light"))
    reps = stored(reps, "jaccard-sets")
    entries = reps.select("key", "n", F.posexplode("first").alias("place", "gram"))
    lists = stored(entries.groupBy("gram").agg(
        F.count(F.lit(1)).alias("length"), F.min(F.struct("place", "key", "n")).alias("head")).where("length > 1"), "jaccard-lists")
    entries = stored(entries.join(lists, "gram"), "jaccard-entries")

    places = entries.where(F.col("n") < MOST_LIGHT).groupBy("n").agg(F.sum("length").alias("places"))
    sizes = reps.where(F.col("n") < MOST_LIGHT).groupBy("n").agg(F.count(F.lit(1)).alias("sets")).join(places, "n", "left")
    below = boundary({r["n"]: (r["sets"], r["places"] or 0) for r in sizes.collect()}, share)

    heavy = (F.col("n") >= below) | (F.col("n_b") >= below)
    head = [F.col("head.key").alias("b"), F.col("head.n").alias("n_b"), F.col("head.place").alias("place_b")]
    first = entries.select("key", "n", "place", *head).where((F.col("key") != F.col("b")) & heavy)
    first = first.where(similar_at(F.col("n"), F.col("place"), F.col("n_b"), F.col("place_b"), share)).select(F.col("key").alias("a"), "b")
    links = verified(first.unionByName(light_links(reps, below, share)), reps, rows, k, share)
    labels = components(links)

    # Lists whose members are not yet of one component compare what is of different components.
    named = entries.select("gram", "key", "n", "place").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    named = stored(named, "jaccard-named")
    open_lists = named.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("gram")
    left = named.join(open_lists, "gram", "left_semi")
    right = left.select("gram", *[F.col(c).alias(f"{c}_b") for c in ("key", "n", "place", "label")])
    room = similar_at(F.col("n"), F.col("place"), F.col("n_b"), F.col("place_b"), share)
    rest = left.join(right, "gram").where((F.col("key") < F.col("key_b")) & (F.col("label") != F.col("label_b")) & heavy & room)
    more = verified(rest.select(F.col("key").alias("a"), F.col("key_b").alias("b")), reps, rows, k, share)
    if not more.isEmpty():
        labels = components(stored(links.unionByName(more), "jaccard-links"))

    found = stored(members.select("id", "n", "key").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key")), "jaccard-found")
    smallest = found.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("id").alias("first_id"))
    return found.join(smallest, "label", "left").select("id", "n", "key", "label", F.coalesce("first_id", "id").alias("first_id"))
