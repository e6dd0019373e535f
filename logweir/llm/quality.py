"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Words are runs of anything but space and the control characters 9 to 13. A null text is an empty one.
Repeated rows are judged each on their own, and columns the rules do not read may have any name.
"""

from pyspark.sql import functions as F

from logweir.llm.common import let, text_of

#: Bodies of character classes.
BLANKS = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
#: Frequent words of English, French, German and Spanish (fixed values).
STOP_WORDS = """the of and to in is that it a for der die und den von ist das zu mit im
le la les de des et en un une que el los las y se del por con para""".split()

#: name, figure, lowest and highest value allowed; null leaves a side open.
RULES = [
    ("words", "n_words", 50, None),
    ("mean_word_length", "mean_word", 2.0, 15.0),
    ("symbols_per_word", "symbol_ratio", None, 0.1),
    ("marks_per_word", "exclaim_ratio", None, 0.3),
    ("capitals", "capital_ratio", None, 0.5),
    ("stop_words_per_word", "stop_ratio", 0.02, None),
    ("repeated_lines", "dup_line_ratio", None, 0.5),
    ("repeated_words", "repeat_ratio", None, 0.5),
]


def share(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def count_of(text, characters):
    """How many of the characters (a regular-expression class body) the text holds."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def repeated_window_words(h):
    """Number of words inside a 3-word window that is found twice or more, from the words' hashes.

    A window's hash gives up its lowest bits for the position, as many as the text needs. Sorted,
    equal windows are neighbours; the marked positions are sorted again and each adds the words up
    to the next one, three at most.
    """
    bits = F.ceil(F.log2(F.size(h) + F.lit(1))).cast("int")
    shift = lambda name, value, n: F.call_function(name, value, n)

    def counted(w, n):
        packed = F.transform(w, lambda x, i: shift("shiftleft", shift("shiftright", x, n), n).bitwiseOR(i.cast("bigint")))

        def marked(s):
            cut = lambda j: shift("shiftright", F.get(s, j), n)
            twice = F.filter(
                s, lambda x, j: (shift("shiftright", x, n) == cut(j + 1)) | (shift("shiftright", x, n) == cut(j - 1))
            )
            low = shift("shiftleft", F.lit(1).cast("bigint"), n) - 1
            return F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(low)))

        covered = lambda p: F.aggregate(
            F.sequence(F.lit(1), F.size(p)),
            F.lit(0).cast("bigint"),
            lambda sum_, k: sum_ + F.coalesce(F.least(F.get(p, k) - F.get(p, k - 1), F.lit(3)), F.lit(3)),
        )
        found = let(let(F.sort_array(packed), marked), lambda p: F.when(F.size(p) > 0, covered(p)))
        # A set of the hashes shows without sorting that a text repeats no window.
        return F.when(F.size(F.array_distinct(w)) < F.size(w), found)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2))
    )
    repeats = let(bits, lambda n: let(windows, lambda w: counted(w, n)))
    return F.coalesce(F.when(F.size(h) > 3, repeats), F.lit(0)).cast("bigint")


def figures(text):
    """The figures the rules speak of, as columns of one projection. `text` must not be null."""
    return [
        let(
            F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != ""),
            lambda ws: F.struct(
                F.transform(ws, lambda w: F.xxhash64(w)).alias("h"),
                F.size(F.filter(ws, lambda w: F.lower(w).isin(STOP_WORDS))).alias("n_stop"),
            ),
        ).alias("_words"),
        F.length(F.regexp_replace(text, f"[{BLANKS}]+", "")).cast("bigint").alias("word_chars"),
        count_of(text, SYMBOLS).cast("bigint").alias("n_symbols"),
        count_of(text, "!").alias("_n_exclaim"),
        count_of(text, r"\p{Lu}").alias("_n_upper"),
        let(
            F.filter(F.split(text, "\n"), lambda s: s.rlike(f"[^{BLANKS}]")),
            lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("u")),
        ).alias("_lines"),
    ]


def judged(docs, rules=RULES, doc_id="doc_id", text="text"):
    """One row per document: the figures, what the base test says, the rules that fail and the verdict."""
    raw = docs.select(F.col(doc_id).alias("doc_id"), *figures(text_of(text)))
    counted = raw.select(
        "doc_id",
        F.size("_words.h").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.col("_lines")["n"] - F.col("_lines")["u"]).cast("bigint").alias("n_dup_lines"),
        repeated_window_words(F.col("_words.h")).alias("n_repeat_words"),
        F.col("_words.n_stop").alias("_n_stop"),
        *["_n_exclaim", "_n_upper", "_lines"],
    )
    n = F.col("n_words")
    ratios = {
        "mean_word": share(F.col("word_chars"), n),
        "symbol_ratio": share(F.col("n_symbols"), n),
        "exclaim_ratio": share(F.col("_n_exclaim"), n),
        "capital_ratio": share(F.col("_n_upper"), F.col("word_chars")),
        "stop_ratio": share(F.col("_n_stop"), n),
        "dup_line_ratio": share(F.col("n_dup_lines"), F.col("_lines")["n"]),
        "repeat_ratio": share(F.col("n_repeat_words"), n),
    }
    base = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    rated = counted.withColumns({**ratios, "base_failed": base})
    failed = []
    for name, figure, low, high in rules:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(figure) < low)
        if high is not None:
            bad = bad | (F.col(figure) > high)
        failed.append(F.when(bad, F.lit(name)))
    rated = rated.withColumn("failed_rules", F.array_compact(F.array(*failed)))
    keep = ~F.col("base_failed") & (F.size("failed_rules") == 0)
    return rated.withColumn("kept", keep).drop("_n_exclaim", "_n_stop", "_n_upper", "_lines")


def keep_good(docs, rules=RULES, doc_id="doc_id", text="text"):
    """The documents that pass, with all their columns. Judged row by row, so no join is needed."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(row.alias("doc_id"), F.col(text).alias("text"))
    rated = judged(packed, rules).select("doc_id", "kept")
    # Behind a one-row array the filter is not pushed into the figures, which would multiply them.
    apart = rated.select(F.inline(F.array(F.struct(F.col("doc_id").alias("row"), F.col("kept").alias("ok")))))
    return apart.where("ok").select("row.*")
