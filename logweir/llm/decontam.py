"""Benchmark decontamination: short items found inside long documents by the part of their words held there.

Items are partitioned by their number of shingles; the sketch of a partition keeps so many of the smallest
shingle hashes that any document holding the asked part of an item must hold one of them. Documents are
probed with all their shingles, and what is found is verified by exact containment. An item of n words, fewer
than k, is one shingle of n words, and documents are probed with their windows of n words for each such n.
In scripts without spaces each character is a word. Texts without words match nothing. Items and documents are
rows of id and text, so null and repeated ids are each verified by themselves; the best row of an id is reported.
"""

from pyspark.sql import functions as F

from logweir.llm.common import broadcast_within, let, stored, text_of

#: Sketch rows up to which the item side is broadcast: 16 bytes each and the hash table around them.
BROADCAST_ROWS = 1_000_000


#: Letters of scripts that are written without spaces.
SINGLE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
WORD = rf"[\p{{L}}\p{{N}}&&[{SINGLE}]]|[\p{{L}}\p{{N}}&&[^{SINGLE}]]+"


def hashed_words(text):
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def windows(text, sizes):
    """Distinct hashes of the windows of a text of each of the sizes."""

    def of(h, k):
        slide = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(F.slice(h, i + 1, F.lit(k))))
        return F.when(F.size(h) >= k, slide).otherwise(F.array().cast("array<bigint>"))

    return let(hashed_words(text), lambda h: F.array_distinct(F.concat(*[of(h, k) for k in sizes])))


def sketched(benchmark, threshold, k, item_id="item_id", text="text"):
    """item (id and text hash, never null), item_id, words (k at most), grams (distinct shingles), n, keys: the smallest hashes of the item, as its size class asks."""
    t = text_of(text)
    whole = let(hashed_words(t), lambda h: F.when(F.size(h).between(1, k - 1), F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))
    grams = F.concat(windows(t, [k]), whole)
    # concat_ws leaves a null id out.
    item = F.concat_ws(":", F.col(item_id).cast("string"), F.xxhash64(t).cast("string")).alias("item")
    items = benchmark.select(
        item, F.col(item_id).alias("item_id"), F.least(F.size(hashed_words(t)), F.lit(k)).alias("words"), F.sort_array(grams).alias("grams"))
    items = items.where(F.size("grams") > 0).dropDuplicates(["item"])
    items = items.withColumn("n", F.size("grams"))
    # Size class c holds sizes 2^c to 2^(c+1) - 1; the largest size of a class may miss the most shingles.
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n"))) + 1) - 1
    keys = F.floor(largest * (1 - threshold) + 1e-9).cast("int") + 1
    return items.withColumn("keys", F.slice("grams", F.lit(1), F.least(keys, F.col("n"))))


def found_rows(docs, benchmark, threshold=0.8, k=5, doc_id="doc_id", text="text"):
    """doc_id, text_hash, item_id, n_item, n_found for each document row and item row found to the threshold or more."""
    items = stored(sketched(benchmark, threshold, k), "bench-items")
    keys = items.select("item", F.explode("keys").alias("gram"))
    n_keys = keys.count()
    sizes = sorted({k, *(r.words for r in items.select("words").distinct().collect())})
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    probes = rows.select("doc_id", "text_hash", F.explode(windows(F.col("text"), sizes)).alias("gram"))
    found = probes.join(broadcast_within(keys, n_keys, BROADCAST_ROWS), "gram").select("doc_id", "text_hash", "item").distinct()
    found = stored(found, "bench-candidates")
    hits = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_set("item").alias("items"))
    n_hits = hits.count()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    held = rows.join(broadcast_within(hits, n_hits, 100_000), same).select(
        "doc_id", "text_hash", "items", windows(F.col("text"), sizes).alias("doc_grams"))
    pairs = held.select("doc_id", "text_hash", "doc_grams", F.explode("items").alias("item")).join(
        broadcast_within(items.select("item", "item_id", "grams", "n"), n_keys, BROADCAST_ROWS), "item")
    common = F.size(F.array_intersect("grams", "doc_grams"))
    exact = pairs.select("doc_id", "text_hash", "item_id", F.col("n").cast("bigint").alias("n_item"), common.cast("bigint").alias("n_found"))
    return exact.where(F.col("n_found") >= threshold * F.col("n_item"))


def contained(docs, benchmark, threshold=0.8, k=5, doc_id="doc_id", text="text"):
    """doc_id, item_id, n_item, n_found, containment for each item a document holds to the threshold or more."""
    rows = found_rows(docs, benchmark, threshold, k, doc_id, text)
    row = F.struct((F.col("n_found") / F.col("n_item")).alias("containment"), "n_item", "n_found")
    return rows.groupBy("doc_id", "item_id").agg(F.max(row).alias("best")).select(
        "doc_id", "item_id", "best.n_item", "best.n_found", "best.containment")


def clean(docs, benchmark, threshold=0.8, k=5, doc_id="doc_id", text="text"):
    """The documents that hold no item, with all their columns."""
    bad = found_rows(docs, benchmark, threshold, k, doc_id, text)
    bad = stored(bad.select(F.col("doc_id").alias("_bad"), F.col("text_hash").alias("_hash")).distinct(), "bench-held")
    bad = broadcast_within(bad, bad.count(), BROADCAST_ROWS)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.col(doc_id).alias("_doc"), F.xxhash64(text_of(text)).alias("_text"))
    same = F.col("_doc").eqNullSafe(F.col("_bad")) & (F.col("_text") == F.col("_hash"))
    return keyed.join(bad, same, "left_anti").select("_row.*")
