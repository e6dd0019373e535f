"""Piece encoding in small parts: every text cut once, in one Python process, without holding a batch's results."""

import gc
import os
import re
import sys
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from logweir.llm import pieces  # noqa: E402
from logweir.llm.queries import QUERIES  # noqa: E402
from logweir.llm.queries import QUERIES  # noqa: E402

TEXTS = ["", None, " one two", "▁ mark é", "中文" * 40, "a b\n" * 90, "x" * 700, "\u0000 😀"]


def once(df):
    """The plan asks one Python node, and names no function of it twice."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    nodes = re.findall(r"(?:ArrowEvalPython|MapInArrow) .*", plan)
    return len(nodes) == 1 and len(re.findall(r"\b(?:encode|go)\(", nodes[0])) == 1


def test_pipeline_stage_cuts_each_text_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert once(corpus_pipeline.piece_encoding(spark, docs, sf_dir))


def test_op5_cuts_each_text_once(spark, sf_dir):
    assert once(QUERIES["op5_sampled_pieces"](spark, sf_dir))


def test_words_of_a_round_are_freed_at_once():
    """Without the collector of cycles, which may come by much later than the next rounds."""
    v = pieces.vocabulary(pieces.MODEL, pieces.ALPHA)
    gc.collect()
    gc.disable()
    try:
        v.sampled(["some words freed at once"], ["1"])
        assert not [o for o in gc.get_objects() if type(o) is defaultdict and " freed" in o]
    finally:
        gc.enable()


def test_parts_of_a_batch(monkeypatch):
    """Parts stay within their bytes or hold one row, and together are the whole batch, sliced arrays too."""
    v = pieces.vocabulary(pieces.MODEL, pieces.ALPHA)
    texts, keys = pa.array(["skipped", *TEXTS]).slice(1), pa.array([str(i) for i in range(-1, len(TEXTS))]).slice(1)
    ids, counts = v.sampled(TEXTS, keys.to_pylist())
    monkeypatch.setattr(pieces, "HANDED", 300)
    found = list(pieces.cut(v, texts, keys, 0))
    assert len(found) > 3 and [n for part in found for n in part.value_lengths().fill_null(0).to_pylist()] == counts.tolist()
    assert [i for part in found for i in part.flatten().to_pylist()] == ids.tolist()
    assert [t for part in found for t in pieces.spelt(v, part).to_pylist()] == TEXTS
    assert list(pieces.parts([200, 100, 1, 900, 0, 300], 300)) == [(0, 2), (2, 1), (3, 1), (4, 2)]
    assert not list(pieces.cut(v, texts.slice(0, 0), keys.slice(0, 0), 0)) and not list(pieces.parts([], 300))


def test_long_text_is_not_cut_into_words_at_once(monkeypatch):
    text = " " + "".join(f"word{i % 50} {'y' * (i % 9)}  \n" for i in range(400))
    whole = pieces.CHUNK.findall(text)
    monkeypatch.setattr(pieces, "TOGETHER", 100)
    lists = list(pieces.words_of(text))
    assert [w for words in lists for w in words] == whole and max(sum(map(len, words)) for words in lists) < 120
    assert list(pieces.words_of(" ab c")) == [[" ab", " c"]]


def test_round_trip_equals_the_columns(spark):
    """Extra columns stay, columns of the new names are replaced, null keys and empty tables too."""
    rows = [(None if i == 2 else i, t, [1, None], "old") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, more array<int>, back string").repartition(2)
    got = pieces.round_trip(df, "ids", "back")
    assert got.columns == ["doc_id", "text", "more", "ids", "back"]
    plain = df.withColumn("ids", pieces.encoded(F.col("text"), F.col("doc_id"))).withColumn("back", pieces.decoded(F.col("ids")))
    expected = sorted(map(repr, plain.select(got.columns).collect()))
    assert sorted(map(repr, got.collect())) == expected and all(r.back == r.text for r in got.collect())
    assert got.schema["ids"].dataType == plain.schema["ids"].dataType and pieces.round_trip(df.limit(0), "ids", "back").count() == 0
