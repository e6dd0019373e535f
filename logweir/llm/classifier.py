"""Quality classifier: histogram gradient-boosted trees over statistics of a text.

The statistics are one Spark projection. The trees are fitted with numpy on a sample of labelled rows whose
size is bounded by `sample`, flattened into arrays, and walked for whole batches of rows at once. Null texts
are empty ones; repeated rows are scored each on their own; without labels every score is one half.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logweir.llm.common import let, text_of
from logweir.llm.quality import count_of, judged

FEATURES = ["n_words", "mean_word", "symbol_ratio", "exclaim_ratio", "capital_ratio", "stop_ratio", "dup_line_ratio",
            "repeat_ratio", "digit_ratio", "unique_ratio", "line_words"]


def features(docs, doc_id="doc_id", text="text"):
    """doc_id and the statistics of every text as doubles."""
    t = text_of(text)
    more = F.struct(
        F.col(doc_id).alias("doc_id"), count_of(t, "0-9").alias("digits"), F.length(t).alias("chars"),
        F.size(F.split(t, "\n")).alias("lines"),
        let(F.split(F.lower(t), r"\s+"), lambda w: F.size(F.array_distinct(w)) / F.size(w)).alias("unique"))
    rated = judged(docs.select(more.alias("doc_id"), t.alias("text")))
    derived = {
        "digit_ratio": F.col("doc_id.digits") / F.greatest(F.col("doc_id.chars"), F.lit(1)),
        "unique_ratio": F.col("doc_id.unique"),
        "line_words": F.col("n_words") / F.col("doc_id.lines"),
    }
    rated = rated.withColumns(derived)
    return rated.select(F.col("doc_id.doc_id").alias("doc_id"), *[F.col(c).cast("double").alias(c) for c in FEATURES])


@dataclass
class Trees:
    """Complete binary trees of one depth: node i has the children 2i + 1 and 2i + 2."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def scores(self, x):
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fitted(x, y, n_trees=60, depth=4, bins=64, rate=0.15, ridge=1.0, least=5):
    """Trees for the log-odds of y, grown level by level from histograms of gradients."""
    if not len(y):
        return Trees(0.0, depth, *np.zeros((3, 0, 0)))
    share = np.clip(y.mean(), 0.01, 0.99)
    n_inner, n_nodes = 2**depth - 1, 2 ** (depth + 1) - 1
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    base = float(np.log(share / (1 - share)))
    raw = np.full(len(y), base)
    feature = np.zeros((n_trees, n_nodes), dtype=np.int64)
    threshold = np.full((n_trees, n_nodes), np.inf)
    value = np.zeros((n_trees, n_nodes))
    for tree in range(n_trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                shape = (width, len(cuts) + 1)
                cell = (node - first) * shape[1] + codes[:, f]
                hist = [np.bincount(cell, w, minlength=width * shape[1]).reshape(shape).cumsum(1) for w in (g, h, np.ones(len(g)))]
                (gl, hl, nl), (gt, ht, nt) = [a[:, :-1] for a in hist], [a[:, -1:] for a in hist]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(nl < least) | (nt - nl < least)] = 0
                top = gain.argmax(1)
                better = np.flatnonzero(gain[np.arange(width), top] > best + 1e-9)
                best[better] = gain[better, top[better]]
                feature[tree, first + better] = f
                threshold[tree, first + better] = cuts[top[better]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[tree, node]] > threshold[tree, node])
        sums = np.bincount(node, g, minlength=n_nodes), np.bincount(node, h, minlength=n_nodes)
        value[tree, n_inner:] = (rate * sums[0] / (sums[1] + ridge))[n_inner:]
        raw += value[tree, node]
    return Trees(base, depth, feature, threshold, value)


def trained(docs, labels, label="quality", sample=20_000, doc_id="doc_id", text="text"):
    """Trees fitted on the `sample` labelled rows of the smallest id hashes (all, if there are fewer)."""
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(
        F.max(label).alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    plain = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text"))
    texts = plain.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select(F.struct("_id", "_y").alias("_row"), "text")
    rows = features(texts, "_row").orderBy("doc_id._id", *FEATURES).limit(sample).select("doc_id._y", *FEATURES).toPandas()
    return fitted(rows[FEATURES].to_numpy(dtype=float), rows["_y"].to_numpy(dtype=float))


def scored(docs, trees, doc_id="doc_id", text="text"):
    """doc_id, score, predicted for every document."""

    def walk(batches):
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(trees.scores(x))], ["doc_id", "score"])

    rows = features(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(walk, f"doc_id {kind}, score double")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
