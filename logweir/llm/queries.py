"""Queries of the corpus operators, each over its whole table with production parameters."""

from pyspark.sql import functions as F

from logweir.llm import chat, classifier, decontam, jaccard, lines, near, pieces, quality, runs, secrets, tokens, urls, vectors
from logweir.llm.common import let


def read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontaminate(spark, sf_dir):
    """Every benchmark item that a document holds to four fifths or more."""
    return decontam.contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_token_counts(spark, sf_dir):
    return tokens.counted(read(spark, sf_dir, "documents"))


def op3_secrets(spark, sf_dir):
    rows = secrets.scanned(read(spark, sf_dir, "documents"))
    every = F.sort_array(F.concat("base", "added"))

    def found(kind):
        # A lambda with a second parameter would be handed the position there.
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [found(kind) for kind, *_ in secrets.KINDS]
    return rows.select("doc_id", *counts, F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
                       secrets.joined(every).alias("spans"))


def op4_quality_classifier(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    trees = classifier.trained(docs, labels.where(~held))
    rows = classifier.scored(docs, trees)
    return rows.select("doc_id", held.alias("held_out"), "score", "predicted")


def op5_sampled_pieces(spark, sf_dir):
    """Sampled pieces of every text, and whether decoding them gives the text back."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.round_trip(docs, "ids", "back").select(
        "doc_id", F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("back", 256).alias("decoded_sha256"), F.col("back").eqNullSafe(F.col("text")).alias("lossless"))


def op6_line_dedup(spark, sf_dir):
    """Every document with its lines before and after, and the digest of what is left."""
    docs = read(spark, sf_dir, "documents").withColumn("_n", F.size(F.split("text", "\n")))
    left = lines.without_boilerplate(docs)
    n = F.size(F.split("text", "\n"))
    return left.select("doc_id", F.col("_n").cast("bigint").alias("n_lines"), n.cast("bigint").alias("n_left"),
                       F.sha2("text", 256).alias("text_sha256"))


def op7_url_filter(spark, sf_dir):
    return urls.judged(read(spark, sf_dir, "pages"))


def op8_chat_format(spark, sf_dir):
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok").alias("text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    return chat.digest(given.unionByName(extra))


def op9_quality_rules(spark, sf_dir):
    rows = quality.judged(read(spark, sf_dir, "documents"))
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *figures, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op10_near_dedup(spark, sf_dir):
    """Each document with the id of its group, the smallest of the group's document ids."""
    rows = near.classes(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.coalesce("first_id", "doc_id").alias("class_id"), "n_links")


def op11_jaccard_join(spark, sf_dir):
    """Each document with the size of its set of 3-word shingles and its component of similar sets."""
    rows = jaccard.components_of(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.col("n").cast("bigint").alias("n_shingles"), F.col("first_id").alias("component_id"))


def op12_vector_codes(spark, sf_dir):
    rows = vectors.compressed(read(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def planted(docs):
    """Documents with a periodic tail in every tenth text, as the contract of op13 lays down."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(w):
        n, a = F.size(w), F.pmod(g, F.size(w)).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i))), " ")

    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    changed = let(words, lambda w: F.when(F.size(w) > 0, tail(w)))
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(changed, F.col("text"))).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    """Runs of every text, the longest one, and the text without what repeats in them."""
    rows = runs.periodic(planted(read(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.less")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_token_counts": op2_token_counts,
    "op3_secrets": op3_secrets,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_sampled_pieces": op5_sampled_pieces,
    "op6_line_dedup": op6_line_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_chat_format": op8_chat_format,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_dedup": op10_near_dedup,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_vector_codes": op12_vector_codes,
    "op13_periodic_runs": op13_periodic_runs,
}
