"""Secret scan: patterns of known kinds, and runs of high entropy found by a sliding window.

All spans count code points, the end exclusive. A null text is an empty one and holds no secret; each
row is scanned on its own, so repeated rows give repeated results and no shuffle is needed.
"""

import math
from functools import reduce

from pyspark.sql import functions as F

from logweir.llm.common import let, text_of

#: kind, pattern, least length, group the length is taken of (fixed values). Runs are taken whole, so the least length
#: can stand in the pattern of `access` and `hex`; a short value of `assign` consumes its text and fails afterwards.
KINDS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", r"AKIA[A-Z0-9]{16,}", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
]
#: Every match of a kind holds one of these, in either case.
MARKS = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",)}
#: Strings the entropy window looks at, whole runs. One shorter than the window is a window of its own, unless it is all
#: digits (cards, accounts, times).
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[0-9]*[A-Za-z+/_=-]|[0-9]{20})[A-Za-z0-9+/_=-]{16,}"
WINDOW = 20
#: class of a window (the first whose pattern holds for all of it) and the bits per character that make it hot, for a
#: full window; a shorter one needs the same part of the bits it can have.
CLASSES = [("digits", r"^[0-9]+$", 2.6), ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", 3.0), ("letters", r"^([a-z]+|[A-Z]+)$", 3.4),
           ("mixed", r"", 3.6)]
#: No window reaches into such an identifier, or holds such a mark of a sample.
IDENTIFIER = r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])"
SAMPLE = r"(?i)(example|sample|placeholder|changeme|xxxx)"
#: Characters that join words; frequent pairs of letters in English, French, German and Spanish words (fixed values).
JOINTS = "/_=+-"
PAIRS = """ab ac ad ag ai ak al am an ap ar as at au av be bi bl bo br ca ce ch ci ck cl co cr ct da de di do du ea ec ed ee ef
eg ei el em en ep er es et eu ev fe ff fi fl fo fr ft fu ge gh gi gr gu ha he hi ho hr ht ia ib ic id ie if ig ih il im in io ir is
it iv ja ju ke la le li ll lo lu ly ma me mi mm mo na nc nd ne ng ni nn no ns nt oc od of og ol om on op or os ot ou ov ow pa pe
pf pl po pr qu ra rc rd re ri rm rn ro rr rs rt ru sa sc se sh si so sp ss st su ta te th ti to tr ts tt tu ty ub uc ue ui ul
um un up ur us ut va ve vi vo we wi wo za ze zu""".split()
#: A window is words or a sequence if so large a share of its neighbouring characters are such pairs or steps.
WORDLIKE, STEPLIKE = 0.6, 0.7


def located(text, pattern, group=0, least=0, marks=()):
    """Array of (start, end, of) for the leftmost non-overlapping matches; `of` is the named group.

    Only matches whose group has `least` characters are kept, so the array grows with what is found. A text with a
    match holds one of the `marks` in lower case, if any are given.
    """
    gaps = F.split(text, pattern, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(
        m.alias("m"), (F.regexp_extract(m, pattern, group) if group else m).alias("g")))

    def walk(found, gaps):
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,of:string>>").alias("out"))

        def step(acc, i):
            begin = acc["at"] + F.length(F.get(gaps, i))
            end = begin + F.length(F.get(found, i)["m"])
            span = F.struct(begin.alias("start"), end.alias("end"), F.get(found, i)["g"].alias("of"))
            long = F.length(F.get(found, i)["g"]) >= least
            return F.struct(end.alias("at"), F.when(long, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step, lambda acc: acc["out"])

    none = F.array().cast("array<struct<start:int,end:int,of:string>>")
    # A search for fixed text is much faster than the pattern and rules out most texts.
    marked = reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(m)) for m in marks], F.lit(not marks))
    return F.when(marked & text.rlike(pattern), let(found, lambda f: let(gaps, lambda g: walk(f, g)))).otherwise(none)


def spans_of(kind, rank, text, pattern, least, group):
    return F.transform(located(text, pattern, group, least, MARKS.get(kind, ())), lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def neighbours(chars):
    """Pairs of neighbouring characters: (word, joint, step) as 0 or 1.

    A word pair is frequent in words and not one of a small letter and a capital behind it; a joint pair has
    a joint; a step goes to the same, the next or the last character code.
    """

    def pair(i):
        a, b = F.get(chars, i - 1), F.get(chars, i)
        word = F.lower(F.concat(a, b)).isin(PAIRS) & ~(a.rlike("[a-z]") & b.rlike("[A-Z]"))
        joint = F.lit(JOINTS).contains(a) | F.lit(JOINTS).contains(b)
        step = F.abs(F.ascii(a) - F.ascii(b)) <= 1
        return F.struct(word.cast("int").alias("word"), joint.cast("int").alias("joint"), step.cast("int").alias("step"))

    return F.transform(F.sequence(F.lit(1), F.size(chars) - 1), pair)


def plain(pairs):
    """Whether the pairs of a window are those of joined words, or of a sequence."""

    def share(s):
        total = lambda name: F.aggregate(s, F.lit(0), lambda n, p: n + p[name])
        return (total("word") >= WORDLIKE * (F.size(s) - total("joint"))) | (total("step") >= STEPLIKE * F.size(s))

    return let(pairs, share)


def least_bits(string):
    """Bits per character that make a window of the string's class hot."""
    value = F.lit(CLASSES[-1][2])
    for _, pattern, bits in reversed(CLASSES[:-1]):
        value = F.when(string.rlike(pattern), F.lit(bits)).otherwise(value)
    return value


def hot_ranges(string, window=WINDOW):
    """(start, end) of the parts of a string covered by hot windows: those whose bits per character reach what
    their own class asks.

    Windows of words, sequences and samples, and those that reach into an identifier, are left out.
    The counts of the characters move with the window: one comes in, one goes out, and the sum of
    c * log2(c) is corrected by those two alone.
    """

    def bits(c):
        return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))

    lowest = min(bits for _, _, bits in CLASSES)

    def walk(string, chars, letters, pairs, window):
        part = F.log2(window) / math.log2(WINDOW)

        def asked(at, entropy):
            return let(F.substring(string, at + 1, window), lambda s: (
                (entropy >= least_bits(s) * part) & ~s.contains(" ") & ~s.rlike(SAMPLE)))

        state = F.struct(
            F.transform(letters, lambda _: F.lit(0)).alias("counts"),
            F.lit(0.0).alias("sum"),
            F.array().cast("array<struct<start:int,end:int>>").alias("out"),
        )

        def step(acc, i):
            comes = F.array_position(letters, F.get(chars, i)).cast("int")
            goes = F.when(i >= window, F.array_position(letters, F.get(chars, i - window)).cast("int")).otherwise(F.lit(0))
            plus = F.get(acc["counts"], comes - 1)
            minus = F.get(acc["counts"], goes - 1)
            same = comes == goes
            total = F.when(same, acc["sum"]).otherwise(
                acc["sum"] + bits(plus + 1) - bits(plus)
                + F.when(goes > 0, bits(minus - 1) - bits(minus)).otherwise(F.lit(0.0)))
            counts = F.when(same, acc["counts"]).otherwise(F.transform(
                acc["counts"],
                lambda c, k: c + (k == comes - 1).cast("int") - (k == goes - 1).cast("int")))
            entropy = F.log2(window) - total / window
            begin, end = i - (window - 1), i + 1
            last = F.get(acc["out"], F.size(acc["out"]) - 1)
            grown = F.when(
                last["end"] >= begin,
                F.concat(F.slice(acc["out"], F.lit(1), F.size(acc["out"]) - 1),
                         F.array(F.struct(last["start"].alias("start"), end.alias("end")))),
            ).otherwise(F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end")))))
            hot = (begin >= 0) & (entropy >= lowest * part) & asked(begin, entropy) & ~plain(F.slice(pairs, begin + 1, window - 1))
            return F.struct(counts.alias("counts"), total.alias("sum"), F.when(hot, grown).otherwise(acc["out"]).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), state, step, lambda acc: acc["out"])

    def walked(string):
        return let(F.split(string, ""), lambda c: let(F.array_distinct(c), lambda d: let(neighbours(c), lambda p: let(
            F.least(F.lit(window), F.size(c)), lambda w: walk(string, c, d, p, w)))))

    return let(F.regexp_replace(string, IDENTIFIER, " " * 36), walked)


def entropy_spans(text, rank):
    """Spans of high entropy in the candidates."""
    parts = F.transform(located(text, CANDIDATE), lambda s: F.transform(hot_ranges(s["of"]), lambda r: F.struct(
        (s["start"] + r["start"]).alias("start"), F.lit(rank).alias("rank"),
        (s["start"] + r["end"]).alias("end"), F.lit("entropy").alias("kind"))))
    return F.flatten(parts)


def scanned(docs, doc_id="doc_id", text="text"):
    """doc_id, `base` and `added`: arrays of (start, rank, end, kind), sorted by start, then kind."""
    t = text_of(text)
    base = [spans_of(kind, i, t, p, least, group) for i, (kind, p, least, group) in enumerate(KINDS)]
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.sort_array(F.concat(*base)).alias("base"),
        entropy_spans(t, len(KINDS)).alias("added"),
    )


def joined(spans):
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
