"""Line de-duplication against plain Python over the whole table, on both ways of finding the lines to go."""

import collections
import hashlib

import pytest

from logweir.llm import lines, secrets
from logweir.llm.queries import QUERIES
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, source string, line long, _wide_lines string, first string"


def spread_lines(rows, threshold=5):
    """Trimmed lower-case lines on `threshold` sites or more."""
    sites = collections.defaultdict(set)
    for _, text, site in rows:
        for s in (text or "").split("\n"):
            if s.strip(" ") and site is not None:
                sites[s.lower().strip(" ")].add(site)
    return {s for s, on in sites.items() if len(on) >= threshold}


def test_whole_table_keeps_each_wide_line_once(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    wide, seen, want = spread_lines(rows), set(), {}
    # The first place is that of the smallest id: ids are all different here.
    for doc_id, text, _ in sorted(rows):
        left = []
        for s in text.split("\n"):
            key = s.lower().strip(" ")
            if key not in wide or key not in seen:
                left.append(s)
            seen.add(key)
        want[doc_id] = hashlib.sha256("\n".join(left).encode()).hexdigest()
    assert wide
    assert {r.doc_id: r.text_sha256 for r in QUERIES["op6_line_dedup"](spark, sf_dir).collect()} == want


@pytest.mark.parametrize("looked_up", [0, 1000])
def test_both_ways_agree_on_edge_rows(spark, looked_up):
    rows = [(i, f"Wide Line\nown {i}\n\n wide line ", f"s{i}") for i in range(6)] + [
        (6, None, "s1"), (7, "", "s2"), (8, " \n ", "s3"), (0, "Wide Line\nown 0\n\n wide line ", "s0"), (None, "wide line\nx", "s9"),
        (9, "few\nwide line" + "\nfew" * 3, None), (10, "long " * 200_000 + "\nwide line", "s1")]
    df = spark.createDataFrame([(*r, 1, "w", "f") for r in rows], DOCS)
    got = lines.without_boilerplate(df, looked_up=looked_up)
    assert got.columns == df.columns
    # A null id comes first in the order of places.
    want = {i: f"own {i}\n" for i in range(6)} | {6: None, 7: "", 8: " \n ", None: "wide line\nx", 9: "few\nfew\nfew\nfew", 10: "long " * 200_000}
    assert collections.Counter((r.doc_id, r.text) for r in got.collect()) == collections.Counter((r[0], want[r[0]]) for r in rows)
    assert lines.without_boilerplate(df.limit(0), looked_up=looked_up).count() == 0


def test_secrets_in_a_very_long_text_are_found_in_linear_time(spark):
    """Two million characters of prose full of short runs of a-f, with one key of each kind behind them."""
    key = "9f86d081884c7d659a2feaa0c55ad015"
    text = "a bad cafe faced a decade of deaf bees. " * 50_000 + f"password: hunter22 AKIA{'A1' * 8} {key}"
    found = secrets.scanned(spark.createDataFrame([(1, text), (2, None), (3, ""), (1, text)], "doc_id long, text string"))
    got = [(r.doc_id, [(s.kind, s.end - s.start) for s in r.base]) for r in found.select("doc_id", F.col("base")).collect()]
    one = (1, [("assign", 18), ("access", 20), ("hex", 32)])
    assert sorted(got) == [one, one, (2, []), (3, [])]
