"""Jaccard join, vector codes and periodic runs against plain brute force, whole tables and edge rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.llm import jaccard, runs, vectors
from logweir.llm.queries import QUERIES

DOCS = "doc_id long, text string, id string, key string, n int, label string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def made(spark, rows):
    """Rows of (doc_id, text) with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "i", "k", 7, "l") for r in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


# Jaccard join


def set_of(text, k=3):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def similar_components(docs):
    """place -> (set size, smallest id of the component), by counting the shared shingles of all pairs."""
    sets = [set_of(t) for _, t in docs]
    lists, shared, root = collections.defaultdict(list), collections.Counter(), list(range(len(docs)))
    for i, s in enumerate(sets):
        for g in s:
            shared.update((j, i) for j in lists[g])
            lists[g].append(i)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 90 * (len(sets[a]) + len(sets[b]) - n):
            root[find(b)] = find(a)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def edited(seed=5):
    """Texts of many sizes around the boundary, each with a few edits of the same base."""
    rng, out = random.Random(seed), []
    for n in [1, 2, 3, 4, 8, 11, 12, 13, 14, 20, 21, 22, 23, 24, 31, 32, 33, 42, 60, 150]:
        base = [f"{rng.choice('abcdefgh')}{rng.randrange(200)}" for _ in range(n)]
        for _ in range(10):
            x = list(base)
            for _ in range(rng.randrange(3)):
                kind = rng.random()
                if kind < 0.4 and x:
                    x[rng.randrange(len(x))] = f"z{rng.randrange(30)}"
                elif kind < 0.7:
                    x.append(f"y{rng.randrange(4)}")
                elif kind < 0.9:
                    x.insert(0, f"q{rng.randrange(4)}")
                elif x:
                    x.pop()
            text = " ".join(x)
            out.append((len(out), text.upper() if rng.random() < 0.1 else text))
    return out


def joined(df):
    return sorted(((r.id, r.n, r.first_id) for r in jaccard.components_of(df).collect()), key=str)


def test_join_equals_all_pairs_on_the_whole_table(spark, sf_dir, docs):
    got = QUERIES["op11_jaccard_join"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == similar_components(docs)


@pytest.mark.parametrize("below", [1, 13, 36])
def test_join_is_the_same_for_any_boundary(spark, monkeypatch, below):
    monkeypatch.setattr(jaccard, "boundary", lambda sizes, share: below)
    rows = edited()
    assert joined(made(spark, rows)) == similar_components(rows)


def test_chosen_boundary_takes_the_cheaper_way():
    assert jaccard.boundary({}) == 1
    # Many list places to scan for sets with few subsets, then few places for sets with thousands of subsets.
    assert 14 <= jaccard.boundary({12: (10, 100_000), 35: (10, 20)}) <= 35
    assert jaccard.boundary({12: (10, 1)}) <= 12


def test_join_edges(spark):
    a, b = "one two three four", "é ß x " * 30_000
    rows = [(1, a), (1, a), (2, "ONE two\tthree\x0bfour"), (3, None), (4, ""), (5, " \n"), (6, None), (7, "hi there"), (8, "HI  there"),
            (None, "hi there"), (None, "alone"), (9, b), (10, b + "x"), (11, "É ß x"), (12, "é ß x")]
    assert joined(made(spark, rows)) == sorted(
        [(d, n, f if f is not None else d) for d, n, f in similar_components(rows)], key=str)
    assert joined(made(spark, rows).limit(0)) == []


def test_large_cluster_is_compared_through_its_first_member(spark):
    """Four hundred edits of one text: the first round needs one pair for each, not all pairs."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        x = list(base)
        for _ in range(rng.choice([1, 1, 2, 4])):
            x[rng.randrange(120)] = f"n{rng.randrange(10**9)}"
        rows.append((i, " ".join(x)))
    assert joined(made(spark, rows)) == similar_components(rows)


# Vector codes


def lloyd(rows, parts=8, entries=16, rounds=6):
    """(codes, errors, label errors, digest) by plain Python, for (id, vector, label)."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], r[1]))
    cut = [[v[len(v) * p // parts:len(v) * (p + 1) // parts] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            held = collections.defaultdict(list)
            for c in cut:
                held[near(c[p], books[p])[0]].append(c[p])
            books[p] = [[sum(x) // len(held[e]) for x in zip(*held[e])] if e in held else entry for e, entry in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found, by_label = [], collections.Counter()
    for (i, _, label), c in zip(kept, cut):
        best = [near(c[p], books[p]) for p in range(parts)]
        found.append((i, "".join(f"{k:02x}" for k, _ in best), sum(d for _, d in best), label))
        by_label[label] += found[-1][2]
    return sorted((i, code, error, by_label[label], digest) for i, code, error, label in found)


def test_codes_equal_plain_lloyd_on_the_whole_table(spark, sf_dir):
    got = QUERIES["op12_vector_codes"](spark, sf_dir)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    given = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, got.collect())) == lloyd(given)


VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, entry int, salt int"


def vector_rows(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], VECTORS)


def test_code_edges(spark):
    rng = np.random.default_rng(2)
    # A third of all rows are one vector; ids repeat; there are null labels and unusable vectors.
    rows = [(int(i), np.float32(rng.normal(size=24)).tolist(), int(i) % 3 or None) for i in range(40)]
    rows += [(100 + i, rows[3][1], 1) for i in range(25)] + [rows[5], rows[5]]
    bad = [(200, None, 1), (201, [1.0, None] + [0.0] * 22, 1), (202, [float("nan")] * 24, 1), (203, [float("inf")] * 24, None)]
    got = vectors.compressed(vector_rows(spark, rows + bad))
    result = sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect())
    assert result == lloyd(rows)
    odd = [(300, [0.5] * 23, 1), (301, [1e30] + [0.0] * 23, 1)]
    more = {r.vec_id: r for r in vectors.compressed(vector_rows(spark, rows + odd)).collect()}
    assert more[300].code is None and more[301].error is None and len(more) == len({r[0] for r in rows}) + 2
    few = vectors.compressed(vector_rows(spark, rows[:5]))
    assert sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in few.collect()) == lloyd(rows[:5])
    assert vectors.compressed(vector_rows(spark, rows).limit(0)).count() == 0
    assert vectors.compressed(vector_rows(spark, bad)).count() == 0


def test_only_parts_that_change_entry_are_shuffled(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("embedding").cast("array<double>").alias("v"))
    books, dims = vectors.trained(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), rounds=1)
    name, folder = vectors.housed(vectors.members(rows, books, dims, 4096, 4).repartition(8, *vectors.OWNER), 8)
    home = spark.table(name)
    plan = vectors.owned_sums(home)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    newer = vectors.updated(home, books, dims)
    plan = vectors.migrated(home, newer, dims, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and re.search(r"Exchange.*\n.*Project.*\n.*Filter .*NOT", plan)
    # All members of an owner lie in one bucket file's partition, and moved ones are there afterwards.
    moved = vectors.migrated(home, newer, dims, 8)
    again = vectors.housed(moved, 8)
    after = spark.table(again[0])
    assert after.count() == home.count() == rows.count() * 8
    assert vectors.reassigned(after, newer, dims).where("now <> entry").count() == 0
    for n, f in ((name, folder), again):
        vectors.vacated(spark, n, f)


# Periodic runs


def plain_runs(w, times=4, least=6):
    """(start, length, period) by looking at every period."""
    found = {}
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            if w[i] == w[i + q]:
                j = i
                while j + q < len(w) and w[j] == w[j + q]:
                    j += 1
                if j - i + q >= max(least, times * q):
                    found.setdefault((i, j - i + q), q)
                i = j
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("times,least", [(4, 6), (2, 2)])
def test_runs_equal_plain_search_on_random_words(times, least):
    rng = np.random.default_rng(1)
    for _ in range(400):
        texts = []
        for _ in range(rng.integers(1, 5)):
            t = rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(0, 40))).tolist()
            if len(t) > 5 and rng.random() < 0.5:
                a, p = int(rng.integers(0, len(t))), int(rng.integers(1, 5))
                t = [w if i < a else t[a + (i - a) % p] if a + (i - a) % p < len(t) else w for i, w in enumerate(t)]
            texts.append(t)
        got = runs.runs(sum(texts, []), [len(t) for t in texts], times, least).tolist()
        assert got == [[i, *r] for i, t in enumerate(texts) for r in plain_runs(t, times, least)]


def test_branching_squares_in_slices(monkeypatch):
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 2, 3000)
    whole = runs.runs(codes, [1000, 2000]).tolist()
    monkeypatch.setattr(runs, "TESTED", 50)
    assert runs.runs(codes, [1000, 2000]).tolist() == whole


def wanted_runs(doc_id, text):
    w = WORDS.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, best[1] * 1000 // best[2] if found else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_query_equals_plain_search_on_the_whole_table(spark, sf_dir, docs):
    got = QUERIES["op13_periodic_runs"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    # Plain search is quadratic: texts above 3000 words are compared by the planted run alone.
    short = {d: t for d, t in docs if len((t or "").split()) <= 3000}
    rows = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(rows) == len(docs)
    assert {d: rows[d] for d in short} == {d: wanted_runs(d, t) for d, t in short.items()}
    assert any(r[1] for r in rows.values())


def test_run_edges(spark):
    long = "ab " * 300_000
    rows = [(1, "a b a b a b a b c"), (1, "a b a b a b a b c"), (None, "x x x x x"), (2, None), (3, ""), (4, " \n\t"), (5, long),
            (6, "x\x0bx x\x1cx x x x x x"), (7, "y y y y y y")]
    got = collections.Counter(
        (r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in runs.periodic(made(spark, rows)).collect())
    assert got == collections.Counter([
        (1, 9, ((0, 8, 2),), "a b c"), (1, 9, ((0, 8, 2),), "a b c"), (None, 5, (), "x x x x x"), (2, 0, (), ""), (3, 0, (), ""), (4, 0, (), ""),
        (5, 300_000, ((0, 300_000, 1),), "ab"), (6, 8, (), "x x x\x1cx x x x x x"), (7, 6, ((0, 6, 1),), "y")])
    assert runs.periodic(made(spark, rows).limit(0)).count() == 0
