"""Secrets, URL filter and chat formatting against plain Python, whole tables at the smallest scale."""

import hashlib
import math
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from logweir.llm import chat, secrets, urls
from logweir.llm.queries import QUERIES

PATTERNS = [
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 6, 2),
    ("access", re.compile("AKIA[A-Z0-9]+"), 20, 0),
    ("hex", re.compile("[0-9a-f]+"), 24, 0),
]


def base_spans(text):
    out = []
    for rank, (kind, pattern, least, group) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            if len(m.group(group)) >= least:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_secrets_over_the_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op3_secrets"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == sha(want)
        assert set(want.split(",")) - {""} <= set(r.spans.split(","))


@pytest.mark.parametrize("text", [None, "", "😀 secret=api_key=abcdef password: 'hunter22'", "token=ab " * 50,
                                  "a AKIA" + "Q" * 16 + " " + "0f" * 12, "q" * 30000, "Secret = \nABCDEFG"])
def test_secret_edges(spark, text):
    df = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, base string")
    row = secrets.scanned(df).select("*", secrets.joined(F.col("base")).alias("j")).first()
    assert row.j == base_spans(text)


def test_entropy_finds_a_key_and_lets_words_be(spark):
    key = "9fKx2LmQ7vTz1RbW8sYc4HnD6"
    rows = [(1, f"see {key} here"), (2, "internationalisation_and_localisation"), (3, "=" * 60),
            (4, "123e4567-e89b-12d3-a456-426614174000"), (5, "0123456789" * 4)]
    found = {r.doc_id: [(s.start, s.end) for s in r.added]
             for r in secrets.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: [(4, 4 + len(key))], 2: [], 3: [], 4: [], 5: []}


def added(spark, rows):
    return {r.doc_id: [(s.start, s.end) for s in r.added]
            for r in secrets.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_entropy_finds_keys_of_each_class_and_no_words_or_sequences(spark):
    rng = random.Random(7)
    kinds = [string.digits, string.ascii_lowercase, string.ascii_uppercase, "0123456789ABCDEF", string.ascii_letters + string.digits]
    keys = {i: "".join(rng.choice(k) for _ in range(48)) for i, k in enumerate(kinds)}
    found = added(spark, [(i, f"see {k} here") for i, k in keys.items()])
    for spans in found.values():
        assert spans and all(4 <= a < b <= 52 for a, b in spans) and sum(b - a for a, b in spans) >= 40
    words = [string.ascii_lowercase, string.ascii_uppercase[::-1], "1234567890" * 3, "counterrevolutionaries",
             "rindfleischetikettierungsueberwachung", "electroencephalographically", "src/main/java/org/apache/spark/catalyst"]
    assert not any(added(spark, list(enumerate(words))).values())


def test_entropy_judges_the_window_and_not_the_candidate(spark):
    rng = random.Random(11)
    hexes = {i: "".join(rng.choice("0123456789ABCDEF") for _ in range(32)) for i in range(20)}
    found = added(spark, [(i, f"ID={k}") for i, k in hexes.items()])
    assert all(any(b > 3 for _, b in spans) for spans in found.values())
    key, uuid = "9fKx2LmQ7vTz1RbW8sYc4HnD6aEj3GpU5oXi0ZtC", "123e4567-e89b-12d3-a456-426614174000"
    found = added(spark, [(1, f"examples/{key}"), (2, f"sample_id={key}"), (3, f"see {key[:16]}."), (4, f"ID={uuid}"),
                          (5, "4716 4716238890125537"), (6, "sample_of_identification"), (7, f"{uuid}={key}")])
    assert [found[i][-1][1] for i in (1, 2, 7)] == [9 + 40, 10 + 40, 37 + 40]
    assert all(spans[-1][0] <= at for spans, at in ((found[1], 9), (found[2], 10)))
    assert (found[3], found[4], found[5], found[6]) == ([(4, 20)], [], [], [])


def test_chat_round_trip_over_the_whole_table(spark, sf_dir):
    want = {-7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn", "role", "text").collect():
        want.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    rows = QUERIES["op8_chat_format"](spark, sf_dir).collect()
    assert len(rows) == len(want)
    for r in rows:
        ts = want[r.conv_id]
        loss = "".join(t for role, t in ts if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(ts), sha("".join(f"{a}\n{b}\n" for a, b in ts)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_chat_control_strings_and_parts(spark):
    hard = ["<|end|>", r"\l|<|", "\\", "\\b<", "<|im|>user<|text|>", "", "|>", "x" * 50000]
    rows = spark.createDataFrame([(1, i, "<|end|>", t) for i, t in enumerate(hard)], "conv_id long, turn long, role string, text string")
    back = chat.formatted(rows).select(chat.read_back(F.col("formatted")).alias("t")).first().t
    assert [t.text for t in back] == hard
    parts = [("text", "a", None, None), ("image", None, "i.png", 256.0), ("audio", None, "a.wav", 2.0)]
    typed = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.turns(typed, "parts").first()
    assert row.formatted == "<|im|>user<|text|>a<|image:0|><|audio:1|><|end|>"
    assert [(a.ref, a.tokens) for a in row.attachments] == [("i.png", 256), ("a.wav", 50)]
    assert chat.digest(rows.limit(0)).count() == 0


def plainly_visited(parts):
    """(body, text read back, text under the mask, attachments) of typed parts, in plain Python."""
    body, text, said, found = "", "", "", []
    units = {"image": 1, "audio": 25, "document": 600}
    for part in parts:
        kind, t, ref, n = part or (None, None, None, None)

        def escaped(x):
            x = x.replace("\\", "\\b").replace("<|", "\\l|")
            return x[:-1] + "\\l" if x.endswith("<") else x

        if kind in (None, "text"):
            body, text, said = body + escaped(t or ""), text + (t or ""), said + (t or "")
        else:
            body += f"<|{escaped(kind)}:{len(found)}|>".replace("|>", "|\\g", escaped(kind).count("|>"))
            text += f"<|{kind}:{len(found)}|>"
            found.append((ref, math.ceil(n * units[kind]) if kind in units and n is not None and n == n else 0))
    return body, text, said, found


def test_chat_parts_equal_a_plain_visitor(spark):
    """Control strings cut over neighbouring parts, types that hold marks, null parts, NaN and null units."""
    rng = random.Random(5)
    bits = ["<", "|", "|end|>", "<|", "end|>", "\\", "\\l", "a", "", "|>", ":0|>", "im|>user<|text|>", None]
    kinds = ["text", None, "image", "audio", "document", "video", "x|>y", "<|end", "z<"]
    turns = []
    for _ in range(150):
        parts = [(k := rng.choice(kinds), rng.choice(bits), f"r{i}" if k not in ("text", None) else None,
                  rng.choice([None, float("nan"), 0.5, 3.0])) for i in range(rng.randrange(7))]
        turns.append([None if rng.random() < 0.05 else p for p in parts])
    rows = [(i, 0, "assistant", parts) for i, parts in enumerate(turns)]
    typed = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    back = {r.conv_id: r for r in chat.formatted(typed, "parts").withColumn("t", chat.read_back(F.col("formatted"))).collect()}
    digests = {r.conv_id: r for r in chat.digest(typed, "parts").collect()}
    for i, parts in enumerate(turns):
        body, text, said, found = plainly_visited(parts)
        assert back[i].formatted == f"<|im|>assistant<|text|>{body}<|end|>"
        assert [(t.role, t.text, t.said) for t in back[i].t] == [("assistant", text, said)]
        assert [(a.ref, a.tokens) for a in back[i].attachments] == found
        assert (digests[i].loss_sha256, digests[i].n_attachments) == (sha(said), len(found))
        assert digests[i].attachment_tokens == sum(n for _, n in found)


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host):]).group()


def test_urls_over_the_whole_table(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    rows = QUERIES["op7_url_filter"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path = plain_url(pages[r.page_id])
        fits = [(len(d + p), d + p, v) for v, d, p in urls.RULES if (host == d or host.endswith("." + d)) and path.startswith(p)]
        rule = max(fits)[1] if fits else None
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("allow", "block")


def test_url_edges_and_purity(spark):
    rows = [(1, None), (2, "nothing"), (3, "HTTP://A.com"), (4, "x://h.COM?q/"), (4, "x://h.COM?q/")]
    rows += [(10 + i, f"http://z.com/de/{i}") for i in range(8)] + [(30, "http://z.com/de"), (31, "http://z.com/xx/1")]
    got = urls.judged(spark.createDataFrame(rows, "page_id long, url string"))
    by = {r.page_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert (by[1].host, by[1].path, by[1].rule, by[3].host, by[4].host) == ("", "", None, "a.com", "h.com")
    assert by[10].verdict == "block" and by[1].verdict in ("allow", "block")


def test_unruled_pages_are_judged_by_their_template(spark):
    rules = [("block", "z.net", "/ads/"), ("allow", "z.net", "/news/")]
    paths = [f"ads/{i}" for i in range(30)] + ["news/list", "news/archive"] * 15 + ["promo/1", "promo/2", "blog/list", "blog/archive"]
    urls_of = [f"http://z.net/{p}" for p in paths] + [f"http://y.net/{p}" for p in paths[-4:]]
    got = urls.judged(spark.createDataFrame(list(enumerate(urls_of)), "page_id long, url string"), rules=rules).where("rule is null").collect()
    assert {(r.host, r.path): r.verdict for r in got} == {
        (h, f"/{p}"): "block" if p.startswith("promo") else "allow" for h in ("z.net", "y.net") for p in paths[-4:]}


def test_branches_with_other_children_are_not_alike(spark):
    shapes = [(top, kid, leaf) for top, kids in (("aa", "kl"), ("bb", "mn"), ("cc", "kl")) for kid in kids for leaf in "xy"]
    pages = spark.createDataFrame([("h", list(s), 1) for s in shapes], "host string, shape array<string>, label int")
    got = {r.shape[0]: r.template for r in urls.templates(pages).collect()}
    assert got["aa"] == got["cc"] != got["bb"]


def test_templates_do_not_change_with_the_table_and_reach_the_last_segment(spark):
    slugs = ["".join(string.ascii_lowercase[(i // 26**j) % 26] for j in range(3)) for i in range(40)]
    paths = [("post", s) for s in slugs] + [("post", "top", "x")] * 40 + [("a", "b", "c", "d", x) for x in ("bad", "good")]
    rows = [("h", list(p), {"bad": 1, "good": 0}.get(p[-1])) for p in paths]
    once, often = ({tuple(r.shape): r for r in urls.templates(spark.createDataFrame(
        rows * n, "host string, shape array<string>, label int")).collect()} for n in (1, 10))
    assert {k: r.template.split(":")[0] for k, r in once.items()} == {k: r.template.split(":")[0] for k, r in often.items()}
    for got in (once, often):
        assert all(got["post", s].template.endswith("/*") for s in slugs) and not got["post", "top", "x"].template.split("/")[2] == "*"
        assert got["a", "b", "c", "d", "bad"].purity > got["a", "b", "c", "d", "good"].purity
    assert often["a", "b", "c", "d", "bad"].rejected and not often["a", "b", "c", "d", "good"].rejected


def test_a_very_long_path_takes_no_pass_per_segment(spark):
    """Alone on its host's branch, a path of 2000 segments is followed at once; an empty table has no verdicts."""
    rows = [(i, f"http://a.com/x/{i}") for i in range(20)] + [(99, "http://a.com/" + "/".join(f"s{i % 7}" for i in range(2000)))]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in urls.judged(df).collect()}
    assert len(got) == 21 and got[99].template.count("/") == 2000 and got[0].template.endswith("/*")
    assert urls.judged(df.limit(0)).count() == 0


def test_labels_speak_for_the_same_path_on_other_hosts(spark):
    rules = [("block", "a.net", "/ads/"), ("allow", "a.net", "/news/")]
    paths = [f"{top}/{i}" for top in ("ads", "news") for i in range(20)]
    rows = list(enumerate([f"http://{h}.net/{p}" for h in "ab" for p in paths]))
    got = urls.judged(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).where("rule is null").collect()
    assert len(got) == 40 and all(r.verdict == ("block" if r.path.startswith("/ads") else "allow") for r in got)
