"""Chat formatting: typed content parts flattened into marked turns, with a loss mask read back from the text.

A turn is `<|im|>role<|text|>body<|end|>`. Inside roles and texts a backslash is written `\\b` and the
opening of a mark `<|` is written `\\l|`; a `<` that ends a part is written `\\l` too, so neither a text nor two
neighbouring parts can hold a mark, and reading back restores them. In the type of an attachment `|>` is written
`|\\g`. Null roles, texts and parts are empty; null and NaN units count no tokens. The loss mask leaves out
placeholders. Turns with equal numbers are ordered by role and text; repeated rows stay.
"""

from pyspark.sql import functions as F

OPEN, BODY, CLOSE = "<|im|>", "<|text|>", "<|end|>"
PARTS = "array<struct<type:string,text:string,ref:string,units:double>>"
#: Tokens that one unit of an attachment stands for: image patches, audio seconds, document pages.
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 600}


def escaped(text):
    plain = F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\l|"))
    return F.regexp_replace(plain, r"<\z", r"\\l")


def unescaped(text):
    opened = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.replace(opened, F.lit("\\b"), F.lit("\\"))


def text_part(text):
    """A plain text as an array of one typed part."""
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                    F.lit(None).cast("double").alias("units"))
    return F.array(part).cast(PARTS)


def tokens_of(part):
    count = F.lit(0)
    for kind, per in TOKENS_PER_UNIT.items():
        count = F.when(part["type"] == kind, F.ceil(F.coalesce(F.nanvl(part["units"], F.lit(0.0)), F.lit(0.0)) * per).cast("int")).otherwise(count)
    return count


def flattened(parts):
    """(body, attachments): each part visited in order; text escaped, the others as numbered placeholders."""
    start = F.struct(
        F.lit("").alias("body"),
        F.array().cast("array<struct<n:int,type:string,ref:string,tokens:int>>").alias("attachments"),
    )

    def visit(acc, part):
        n = F.size(acc["attachments"])
        mark = F.concat(F.lit("<|"), F.replace(escaped(part["type"]), F.lit("|>"), F.lit("|\\g")), F.lit(":"), n.cast("string"), F.lit("|>"))
        plain = F.coalesce(part["type"], F.lit("text")) == "text"
        taken = F.struct(n.alias("n"), part["type"].alias("type"), part["ref"].alias("ref"), tokens_of(part).alias("tokens"))
        return F.struct(
            F.concat(acc["body"], F.when(plain, escaped(F.coalesce(part["text"], F.lit("")))).otherwise(mark)).alias("body"),
            F.when(plain, acc["attachments"]).otherwise(F.concat(acc["attachments"], F.array(taken))).alias("attachments"),
        )

    return F.aggregate(F.coalesce(parts, F.array().cast(PARTS)), start, visit)


def turns(rows, parts=None):
    """One formatted row per turn: conv_id, turn, role, formatted, attachments, attachment_tokens.

    `parts` is an array column of (type, text, ref, units); without it the column `text` is the only part.
    """
    content = F.col(parts) if parts else text_part(F.coalesce(F.col("text"), F.lit("")))
    role = F.coalesce(F.col("role"), F.lit(""))
    made = rows.select("conv_id", "turn", role.alias("role"), flattened(content).alias("_f"))
    return made.select(
        "conv_id", "turn", "role",
        F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(BODY), F.col("_f.body"), F.lit(CLOSE)).alias("formatted"),
        F.col("_f.attachments").alias("attachments"),
        F.aggregate(F.col("_f.attachments"), F.lit(0), lambda s, a: s + a["tokens"]).alias("attachment_tokens"),
    )


def formatted(rows, parts=None):
    """One row per conversation with its whole text; the turns are formatted before they are brought together."""
    listed = F.sort_array(F.collect_list(F.struct("turn", "role", "formatted", "attachments", "attachment_tokens")))
    packed = turns(rows, parts).groupBy("conv_id").agg(listed.alias("_t"))
    return packed.select(
        "conv_id",
        F.array_join("_t.formatted", "").alias("formatted"),
        F.flatten("_t.attachments").alias("attachments"),
        F.aggregate("_t.attachment_tokens", F.lit(0).cast("bigint"), lambda s, n: s + n).alias("attachment_tokens"),
    )


def read_back(text):
    """Array of (role, text, said) read from a formatted conversation, unescaped; `said` is the text without placeholders."""
    pieces = F.filter(F.split(text, r"<\|end\|>", -1), lambda p: p != "")
    bare = F.transform(pieces, lambda p: F.substring(p, F.lit(len(OPEN) + 1), F.length(p)))

    def turn(p):
        body = F.substring(p, F.instr(p, BODY) + len(BODY), F.length(p))
        # Texts are escaped, so whatever is still marked is a placeholder.
        said = unescaped(F.regexp_replace(body, r"(?s)<\|.*?\|>", ""))
        return F.struct(unescaped(F.substring_index(p, BODY, 1)).alias("role"), unescaped(body).alias("text"), said.alias("said"))

    return F.transform(bare, turn)


def digest(rows, parts=None):
    """Figures and digests of each conversation, read back from its formatted text."""
    figures = [F.size("attachments").cast("bigint").alias("n_attachments"), "attachment_tokens"]
    back = formatted(rows, parts).select("conv_id", "formatted", read_back(F.col("formatted")).alias("t"), *figures)
    whole = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("t", lambda t: t["role"] == "assistant"), lambda t: t["said"]), "")
    return back.select(
        "conv_id", F.size("t").cast("bigint").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "n_attachments", "attachment_tokens",
    )
