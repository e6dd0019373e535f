"""Near-duplicates by DartMinHash: weighted signatures from hashed darts, joined in bands, verified exactly.

A shingle of weight w owns the strip [0, w) of a plane whose height is rank. Darts fall on the strip by a
process seeded by the shingle alone; each dart belongs to one coordinate, and a document's coordinate is its
earliest dart. Only darts below a rank that fills all coordinates are thrown, so the work is a shingle's
first dart plus a thousand or so. Texts with equal shingle counts are one class from the start and are joined as
one. In each bucket members are compared with one of them, first in a few bands, then in all, then with more of
those that are still of other groups, until a bucket holds no two members of different groups that were not compared; members of one group
are not compared again, so a group of copies does not emit all its pairs. Strips that only one group holds are in no
overlap with another, so a text that has more of them than a link allows is not compared any further. Texts without words are one class
where they are equal character by character; null is a text of its own, apart from the empty one.
A text of fewer than five words is one shingle. Null ids are kept and never lead a group.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logweir.llm.common import WORD, broadcast_within, stored, text_of, words

#: A pair of similarity 0.8 shares a band with a chance of 0.9986, one of 0.5 with 0.2, one of 0.3 with 0.006.
BANDS, ROWS = 28, 7
LEADERS = 4
#: Bands of the first round, which brings most copies of a group under one label before the others are asked.
FIRST_BANDS = 4
#: Keys of 32 characters up to which the classes to be compared are broadcast, so other strips are not shuffled.
BROADCAST_KEYS = 300_000


def mixed(x):
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def uniform(x):
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def darts(elements, weights, n, sizes=None):
    """Earliest dart of each of n coordinates, one row per text, for elements (uint64) with positive weights.

    The elements of the texts follow one another, `sizes` of them each (one text, if not given; none empty).
    """
    sizes = np.array([len(elements)] if sizes is None else sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    # Only darts below a rank that is likely to fill all coordinates of a text are thrown.
    limit = n * (np.log(n) + 3) / np.bincount(text, weights, minlength=len(sizes))
    # Strips of width one; the last strip of an element may be partly its own.
    strips = np.ceil(weights).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), strips)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(strips) - strips, strips)
    with np.errstate(over="ignore"):
        seeds = mixed(elements[owner] + np.uint64(0x9E3779B97F4A7C15) * (level.astype(np.uint64) + np.uint64(1)))
    part, text = weights[owner] - level, text[owner]
    signature, earliest = np.zeros(len(sizes) * n, dtype=np.uint64), np.full(len(sizes) * n, np.inf)
    unfilled = np.ones(len(sizes), dtype=bool)
    while unfilled.any():
        again = unfilled[text]
        live, width, home = seeds[again], part[again], text[again]
        rank, throw = np.zeros(len(live)), 0
        while len(live):
            throw += 1
            with np.errstate(over="ignore"):
                dart = mixed(live ^ mixed(np.full(1, throw, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            rank = rank - np.log(uniform(dart))
            near = rank <= limit[home]
            live, rank, dart, width, home = live[near], rank[near], dart[near], width[near], home[near]
            inside = uniform(mixed(dart + np.uint64(1))) < width
            place = (mixed(dart + np.uint64(2)) % np.uint64(n)).astype(np.int64)
            cell, when, which = (home * n + place)[inside], rank[inside], dart[inside]
            np.minimum.at(earliest, cell, when)
            first = when == earliest[cell]
            signature[cell[first]] = which[first]
        unfilled = ~np.isfinite(earliest.reshape(-1, n)).all(axis=1)
        limit = limit * 2
    return signature.reshape(-1, n)


def strips(hashes, k):
    """Sorted hashes of the k-word windows of a text's word hashes; a window's repeats differ by their number.

    Each is one strip of unit width of the window's weight, its count.
    """
    h = np.asarray(hashes, dtype=np.int64).view(np.uint64)
    width = min(k, len(h))
    if not width:
        return h
    with np.errstate(over="ignore"):
        found = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for j in range(width):
            found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - width + 1 + j])
        found.sort()
        first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
        number = np.arange(len(found)) - np.repeat(first, np.diff(np.r_[first, len(found)]))
        found = np.where(number > 0, mixed(found + number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), found)
    return np.sort(found)


def signed(rows, k, n=BANDS * ROWS, together=200_000):
    """doc_id, text_hash, key, n, signature for rows of (doc_id, text_hash, blank, hashes); n counts the strips.

    `blank` is the key of a text without words.
    Texts are thrown for together, up to about `together` strips and coordinates at a time.
    """

    def thrown(made):
        out, at = [None] * len(made), 0
        while at < len(made):
            group, size = [], 0
            while at < len(made) and (not group or size + len(made[at]) + n <= together):
                if len(made[at]):
                    group.append(at)
                    size += len(made[at]) + n
                at += 1
            if group:
                elements = np.concatenate([made[i] for i in group])
                found = darts(elements, np.ones(len(elements)), n, [len(made[i]) for i in group])
                for i, row in zip(group, found.view(np.int64)):
                    out[i] = row
        return out

    def throw(batches):
        for batch in batches:
            made = cut(batch.column("hashes"), k)
            keys = [hashlib.blake2b(g.tobytes(), digest_size=16).hexdigest() if len(g) else blank
                    for g, blank in zip(made, batch.column("blank").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.string()),
                 pa.array([len(g) for g in made], pa.int64()), pa.array(thrown(made), pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "key", "n", "signature"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(throw, f"doc_id {kind}, text_hash long, key string, n long, signature array<long>")


def cut(hashes, k):
    """The strips of each row of an Arrow list of word hashes."""
    ends, values = hashes.offsets.to_numpy(), hashes.values.to_numpy()
    return [strips(values[low:high], k) for low, high in zip(ends[:-1], ends[1:])]


def stripped(rows, k):
    """key, grams for rows of (key, hashes)."""

    def strip(batches):
        for batch in batches:
            made = [g.view(np.int64) for g in cut(batch.column("hashes"), k)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made, pa.list_(pa.int64()))], ["key", "grams"])

    return rows.mapInArrow(strip, "key string, grams array<long>")


def weighted_jaccard(a, b):
    """Weighted Jaccard of two arrays of strips: repeats are numbered, so they compare as sets."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def alike(pairs, met, threshold):
    """The pairs (a, b) of keys whose texts are similar, by exact comparison; `met` has key and grams."""
    left = met.select(F.col("key").alias("a"), F.col("grams").alias("ga"))
    right = met.select(F.col("key").alias("b"), F.col("grams").alias("gb"))
    similar = weighted_jaccard(F.col("ga"), F.col("gb")) >= threshold
    return stored(pairs.join(left, "a").join(right, "b").where(similar).select("a", "b"), "near-links")


def ceilings(waiting, met):
    """key, ceiling: how many strips of each waiting text are also in a waiting text of another label.

    No overlap of texts of different labels is larger. Texts without such a strip are left out.
    """
    who = waiting.select("key", "label").distinct()
    held = met.join(who, "key").select(
        F.xxhash64("key").alias("text"), F.xxhash64("label").alias("group"), F.explode("grams").alias("gram"))
    one = held.groupBy("gram").agg(F.min("text").alias("text"), F.max("text").alias("last"), F.min("group").alias("low"), F.max("group").alias("high"))
    one = stored(one.where("low = high").select("gram", "text", (F.col("text") == F.col("last")).alias("alone")), "near-lone")
    # Most strips of one label are in one text only, which the sums name; the others are looked up in their texts.
    several = held.join(one.where("not alone").select("gram"), "gram").select("text")
    lone = one.where("alone").select("text").unionByName(several).groupBy("text").agg(F.count(F.lit(1)).alias("lone"))
    sizes = met.join(who, "key").select("key", F.xxhash64("key").alias("text"), F.size("grams").alias("all"))
    return sizes.join(lone, "text", "left").select("key", (F.col("all") - F.coalesce("lone", F.lit(0))).alias("ceiling"))


def buckets(bands, rows):
    """Column of the bucket of each band of the signature."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(b, F.slice("signature", b * rows + 1, F.lit(rows))))


def grouped(texts, threshold, bands=BANDS, rows=ROWS, leaders=LEADERS):
    """(links, labels) as `settled` gives them, for texts with key, grams and signature."""
    reps = texts.select("key", F.size("grams").alias("n"), buckets(bands, rows).alias("buckets")).dropDuplicates(["key"])
    return settled(reps, lambda asked: texts.select("key", "grams").join(asked, "key", "left_semi").dropDuplicates(["key"]), threshold, leaders)


def settled(reps, strips_of, threshold, leaders=LEADERS):
    """(links, labels): similar pairs (a, b) of different classes, and the label of each class that has one.

    `reps` has key, n and buckets; `strips_of` gives key and grams of a table of keys. Every member of a bucket
    has a turn, a number spread evenly over the bucket's size by the key's hash. A round compares the members
    whose turn has come, the first one at first, with those of other labels in the bucket; a bucket whose other
    members share one label is settled. Each round reaches three times as far as the one before, so the last
    member is reached in few rounds, and no pair of a bucket with different labels that can be similar is left out.
    From the third round on, when few texts are left, `ceilings` rules pairs and whole texts out before that.
    """
    entries = reps.select("key", F.col("n").alias("size"), F.posexplode("buckets").alias("band", "bucket"))
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("low")).where("n > 1")
    # The same keys come first in all buckets, so the bands ask for the same pairs.
    turn = (place - F.col("low")) * F.col("n") / F.lit(1 << 30)
    waiting = stored(entries.join(shared, "bucket").select("band", "bucket", "key", "size", turn.alias("turn")), "near-entries")
    met = stored(strips_of(stored(waiting.select("key").distinct(), "near-asked")), "near-met")
    waiting = waiting.select("*", F.col("key").alias("label"), F.col("size").alias("ceiling"))
    links, upto, first = None, 0, True
    while True:
        asking = waiting.where(F.col("band") < FIRST_BANDS) if first else waiting
        pairs = asked_once(asking, upto, threshold)
        found = alike(stored(pairs, "near-pairs"), met, threshold)
        links = found if links is None else stored(links.unionByName(found).distinct(), "near-links")
        labels = components(links)
        done = F.col("turn") <= upto
        waiting = waiting.where(~done | (F.col("band") >= FIRST_BANDS) if first else ~done).drop("label").join(labels, "key", "left").select(
            "band", "bucket", "key", "size", "turn", F.coalesce("label", "key").alias("label"), "ceiling")
        waiting = unsettled(waiting)
        if not first:
            waiting = waiting.drop("ceiling").join(ceilings(waiting, met), "key")
            waiting = unsettled(waiting.where(F.col("ceiling") / F.col("size") >= threshold))
        if waiting.isEmpty():
            return links, labels
        upto, first = upto if first else 3 * upto + leaders, False


def asked_once(asking, upto, threshold):
    """The pairs (a, b) of texts of different labels that a round compares: those whose turn has come with the others
    of their buckets. A pair that meets in several buckets is made in the first of them alone."""

    def listed(rows, name):
        return rows.groupBy("key").agg(F.sort_array(F.collect_list("bucket")).alias(name))

    come = asking.where(F.col("turn") <= upto)
    heads = come.join(listed(come, "head_buckets"), "key").select(
        "bucket", "head_buckets", F.col("key").alias("head"), F.col("label").alias("head_label"),
        F.col("size").alias("head_size"), F.col("ceiling").alias("head_ceiling"))
    # Sizes too far apart, or too few strips that others have, rule a pair out before its strips are fetched.
    most = F.least("ceiling", "head_ceiling")
    close = (F.least("size", "head_size") >= threshold * F.greatest("size", "head_size")) & (
        most / (F.col("size") + F.col("head_size") - most) >= threshold)
    once = ((F.col("turn") > upto) | (F.col("key") > F.col("head"))) & (
        F.get(F.array_intersect("buckets", "head_buckets"), F.lit(0)) == F.col("bucket"))
    pairs = asking.join(listed(asking, "buckets"), "key").join(heads, "bucket")
    return pairs.where((F.col("label") != F.col("head_label")) & close & once).select(
        F.least("key", "head").alias("a"), F.greatest("key", "head").alias("b")).distinct()


def unsettled(waiting):
    """The members of buckets that hold more than one label."""
    mixed_up = waiting.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return stored(waiting.join(mixed_up.select("bucket"), "bucket", "left_semi"), "near-entries")


def components(links):
    """key, label: the smallest key of the connected part, by labels that spread and skip until none changes."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both, "near-both")
    labels = stored(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "near-labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("key")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(seen, F.col("key") == F.col("a")).select("key", F.col("label").alias("old"), F.least("label", "near").alias("via"))
        step = stored(step, "near-step")
        hop = step.select(F.col("key").alias("via"), F.col("via").alias("far"))
        labels = stored(step.join(hop, "via", "left").select("key", "old", F.least("via", "far").alias("label")), "near-labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("key", "label")


def classes(docs, threshold=0.8, k=5, doc_id="doc_id", text="text"):
    """doc_id, text_hash, key, label, first_id, first_hash, n_links for every document.

    `label` names the group and (first_id, first_hash) its first document. n_links counts the similar
    classes that were compared with the document's own.
    """
    t = text_of(text)
    hashes = F.transform(words(t), lambda w: F.xxhash64(w)).alias("hashes")
    blank = F.when(~t.rlike(WORD), F.concat(F.lit("blank-"), F.coalesce(F.md5(F.col(text)), F.lit("null")))).alias("blank")
    # The hash of a null text is not that of the empty one.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), blank, hashes)
    signatures = signed(rows, k).withColumn("buckets", buckets(BANDS, ROWS)).drop("signature")
    # Strips are not kept: those of the texts that meet another are made once more.
    kept = stored(signatures, "near-texts")

    def strips_of(asked):
        one = kept.join(asked, "key", "left_semi").groupBy("key").agg(F.min(F.struct(
            F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one"))
        one = stored(one.select("key", F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash")), "near-places")
        one = broadcast_within(one, one.count(), BROADCAST_KEYS)
        texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), t.alias("text"))
        texts = texts.join(one, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
        # Rows that repeat both id and text are one; the texts are moved for that, which are smaller than their strips.
        texts = texts.select("key", "text").dropDuplicates(["key"])
        return stripped(texts.select("key", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes")), k)

    links, labels = settled(kept.where("n > 0").select("key", "n", "buckets").dropDuplicates(["key"]), strips_of, threshold)
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n_links"))
    named = labels.join(degree, "key", "left")
    members = kept.select("doc_id", "text_hash", "key").join(named, "key", "left")
    members = stored(members.withColumn("label", F.coalesce("label", "key")), "near-members")
    first = members.groupBy("label").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
    return members.join(first, "label", "left").select(
        "doc_id", "text_hash", "key", "label", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def one_of_each(docs, threshold=0.8, k=5, doc_id="doc_id", text="text"):
    """The first document of every group, with all its columns."""
    found = classes(docs, threshold, k, doc_id, text)
    late = ~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash")))
    gone = stored(found.where(late).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "near-gone")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.col(doc_id).alias("_doc"), F.xxhash64(F.col(text)).alias("_text"))
    left = keyed.join(gone, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_anti")
    # Rows that repeat both id and text are one document.
    return left.dropDuplicates(["_doc", "_text"]).select("_row.*")
