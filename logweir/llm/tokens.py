"""Token counts: texts as flat files of token ids without an index, counted by a scan for the separator.

A file is the token stream of one partition of the texts, each text followed by the end-of-document id, cut
into blocks of a fixed number of ids that know nothing of the texts. Each block is searched on its own in
numpy; a prefix sum over the blocks of a file stitches the texts that cross blocks.
"""

import base64
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from logweir.llm.common import stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_TEXT = 50256
BLOCK = 1 << 16
#: The vocabulary's rule for cutting a text into words (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(vocabulary):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def flat_blocks(docs, vocabulary=VOCABULARY, block=BLOCK, end=END_OF_TEXT, doc_id="doc_id", text="text"):
    """Rows (file, block, ids) of the token files, and (file, ordinal, doc_id) naming their texts in order.

    A task holds one block and the text it reads. Null texts are empty: a separator alone.
    """

    def write(frames):
        code, file = encoding(vocabulary), TaskContext.get().partitionId()
        held, size, n_block, ordinal = [], 0, 0, 0
        for frame in frames:
            out = []
            for key, t in zip(frame["doc_id"], frame["text"]):
                ids = np.array([*(code.encode_ordinary(t) if isinstance(t, str) else ()), end], dtype="<u4")
                out.append((file, None, None, ordinal, key))
                held.append(ids)
                size, ordinal = size + len(ids), ordinal + 1
                if size >= block:
                    whole = np.concatenate(held)
                    full = size // block * block
                    for at in range(0, full, block):
                        out.append((file, n_block, whole[at:at + block].tobytes(), None, None))
                        n_block += 1
                    held, size = [whole[full:]], size - full
            made = pd.DataFrame(out, columns=["file", "block", "ids", "ordinal", "doc_id"]).astype(
                {"block": "Int64", "ordinal": "Int64"})
            for at in range(0, len(made), 500):
                yield made.iloc[at:at + 500]
        if size:
            yield pd.DataFrame({"file": [file], "block": [n_block], "ids": [np.concatenate(held).tobytes()]}).assign(
                ordinal=pd.array([None], "Int64"), doc_id=None)

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(write, "file long, block long, ids binary, ordinal long, doc_id string")


def counts(blocks, end=END_OF_TEXT):
    """(file, ordinal, n_tokens) of every text of the token files, without its separator."""

    def search(frames):
        for frame in frames:
            for file, block, raw in zip(frame["file"], frame["block"], frame["ids"]):
                ids = np.frombuffer(raw, dtype="<u4")
                ends = np.flatnonzero(ids == end)
                lengths = np.diff(ends, prepend=-1) - 1
                tail = len(ids) - (ends[-1] + 1 if len(ends) else 0)
                yield pd.DataFrame({"file": [file], "block": [block], "lengths": [lengths.tolist()], "tail": [int(tail)]})

    found = blocks.select("file", "block", "ids").mapInPandas(search, "file long, block long, lengths array<long>, tail long")
    found = stored(found, "token-scan")
    # Running number of texts ended before a block, and the ids since the last end: the tails of the blocks
    # that share the count of ends with the block before. One short row per block goes through the window.
    by_file = Window.partitionBy("file").orderBy("block")
    small = found.select("file", "block", F.size("lengths").alias("n"), "tail")
    before = small.withColumn("ended", F.coalesce(
        F.sum("n").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # The group of a block's tail is the number of ends up to and with it.
    tails = before.withColumn("upto", F.col("ended") + F.col("n")).groupBy("file", "upto").agg(F.sum("tail").alias("carry"))
    first = found.join(before.select("file", "block", "ended"), ["file", "block"])
    texts = first.select("file", "ended", F.posexplode("lengths").alias("at", "length"))
    joined = texts.join(tails.withColumnRenamed("upto", "ended"), ["file", "ended"], "left")
    n = F.col("length") + F.when(F.col("at") == 0, F.coalesce("carry", F.lit(0))).otherwise(F.lit(0))
    return joined.select("file", (F.col("ended") + F.col("at")).alias("ordinal"), n.alias("n_tokens"))


def counted(docs, vocabulary=VOCABULARY, block=BLOCK, end=END_OF_TEXT, doc_id="doc_id", text="text"):
    """doc_id, n_tokens for every row of the documents."""
    files = stored(flat_blocks(docs, vocabulary, block, end, doc_id, text), "token-files")
    names = files.where(F.col("ordinal").isNotNull()).select("file", "ordinal", F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"))
    return names.join(counts(files.where(F.col("block").isNotNull()), end), ["file", "ordinal"], "left").select("doc_id", "n_tokens")
