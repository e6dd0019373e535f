"""URL filter: rules by host and path, and a tree of path templates for the URLs no rule covers.

A null URL or one without `://` has an empty host and path and no rule. URLs with equal host and path
are judged alike. The tree is built from counts per host and shape, so a hot host is combined before
the shuffle. Branches of a place have one form if the same children hold about the same shares of their
pages, which needs no label; a form's labelled pages thereby speak for the branches without labels, in its
host first and then over all hosts. Within a form, branches with labels are templates apart by tenths. Labels also
speak for the same path, its wildcards included, on other hosts. A place with one shape left is followed to its end
at once, so a very long path takes no pass per segment of its own.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import stored

#: verdict, domain, path prefix (fixed values).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Segments that vary by nature: numbers, hex strings, dates, long mixed identifiers.
VARIABLE = r"^([0-9._-]+(\.[a-z]{1,5})?|[0-9a-fA-F-]{8,}|(?=.*[0-9])[A-Za-z0-9_-]{12,})$"
#: At a place in the tree with more different segments than this, each that has less than one such part of the
#: place's pages becomes a wildcard.
FANOUT = 20
#: Steps in which the share of a branch's pages below a child is compared.
SHARES = 4
#: Pages a parent's share counts for when its child's is smoothed; share of blocked pages that rejects.
PRIOR, REJECT = 4.0, 0.5


def host_path(url):
    """Host in lower case A-Z and path of a URL; both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    known = F.coalesce(at > 0, F.lit(False))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(known, lower).otherwise(""), F.when(known, path).otherwise("")


def rule_of(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that covers host and path, else null."""
    fits = []
    for verdict, domain, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        covers = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        fits.append(F.when(covers, F.struct(F.lit(domain + prefix).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits)


def shaped(path):
    """Segments of a path; those that vary by nature are wildcards."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(segments, lambda s: F.when(s.rlike(VARIABLE), "*").otherwise(s))


def followed(leaves, level):
    """The leaves with their last segments, from `level` on, put to form, template and name in one projection.

    Each is the only shape of its place, so each segment is a branch with one child that holds all its pages.
    """
    rest = F.when(F.size("shape") > level, F.sequence(F.lit(level), F.size("shape") - 1)).otherwise(F.array().cast("array<int>"))
    child = lambda i: F.struct(F.coalesce(F.get("shape", i + 1), F.lit("")).alias("child"), F.lit(SHARES).alias("part"))
    step = lambda i: F.when(F.get("shape", i) == "*", "*").otherwise(
        F.concat(F.lit("~"), F.lower(F.hex(F.xxhash64(F.array(child(i)))))))
    rate = (F.col("bad") + PRIOR * F.col("bad") / F.greatest("seen", F.lit(1))) / (F.col("seen") + PRIOR)
    tenth = F.when(F.col("seen") > 0, F.concat(F.lit(":"), F.round(rate * 10).cast("int"))).otherwise("")
    tail = lambda part: F.array_join(F.transform(rest, lambda i: F.concat(F.lit("/"), part(i))), "")
    return leaves.withColumns({
        "form": F.concat("form", tail(step)), "template": F.concat("template", tail(lambda i: F.concat(step(i), tenth))),
        "named": F.concat("named", tail(lambda i: F.get("shape", i)))})


def templates(pages):
    """Verdict per host and shape from the template tree, down to the last segment of the deepest path.

    `pages` has host, shape (array) and label (1 block, 0 allow, null unknown). Returns host, shape, template, purity, rejected.
    """
    leaves = pages.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("seen"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad"))
    # Each level reads the one before several times, so each is written down once.
    leaves = stored(leaves.withColumns({"form": F.lit(""), "template": F.lit(""), "named": F.lit("")}), "url-shapes")
    place, pages_of = ["host", "form"], lambda: [F.sum(c).alias(c) for c in ("n", "seen", "bad")]
    level, ended = 0, []
    while True:
        # Leaves that are alone at their place, or at their end, need no further level.
        lone = leaves.groupBy(*place).agg((F.count(F.lit(1)) == 1).alias("lone"))
        leaves = stored(leaves.join(lone, place), f"url-places{level}")
        done = F.col("lone") | (F.size("shape") <= level)
        ended.append(followed(leaves.where(done), level).drop("lone"))
        leaves = leaves.where(~done).drop("lone")
        if leaves.isEmpty():
            break
        # One row per branch below each parent; the rare ones of many become a wildcard.
        leaves = leaves.withColumn("segment", F.coalesce(F.get("shape", F.lit(level)), F.lit("")))
        kids = leaves.groupBy(*place, "segment", F.coalesce(F.get("shape", F.lit(level + 1)), F.lit("")).alias("child")).agg(*pages_of())
        kids = stored(kids, f"url-kids{level}")
        branch = kids.groupBy(*place, "segment").agg(*pages_of(), F.count(F.lit(1)).alias("kids"))
        spread = branch.groupBy(*place).agg(
            F.count(F.lit(1)).alias("fan"), F.sum("n").alias("all_n"),
            (F.sum("bad") / F.greatest(F.sum("seen"), F.lit(1))).alias("share"))
        # Children that are many and each rare count as one wildcard child.
        below = kids.select(*place, "segment", "child", "n").join(
            branch.select(*place, "segment", F.col("n").alias("total"), "kids"), [*place, "segment"])
        rare = (F.col("kids") > FANOUT) & (F.col("n") * FANOUT < F.col("total")) & (F.col("child") != "")
        below = below.groupBy(*place, "segment", F.when(rare, "*").otherwise(F.col("child")).alias("child")).agg(
            F.sum("n").alias("n"), F.first("total").alias("total"))
        part = F.struct("child", F.round(F.col("n") / F.col("total") * SHARES).cast("int").alias("part"))
        profile = below.groupBy(*place, "segment").agg(F.sort_array(F.collect_list(part)).alias("profile"))
        near = branch.join(profile, [*place, "segment"]).join(spread, place)
        wild = (F.col("fan") > FANOUT) & (F.col("n") * FANOUT < F.col("all_n"))
        step = F.when(wild | (F.col("segment") == "*"), "*").otherwise(F.concat(F.lit("~"), F.lower(F.hex(F.xxhash64("profile")))))
        rate = (F.col("bad") + PRIOR * F.col("share")) / (F.col("seen") + PRIOR)
        tenth = F.when(F.col("seen") > 0, F.concat(F.lit(":"), F.round(rate * 10).cast("int"))).otherwise("")
        name = F.when(step == "*", "*").otherwise(F.col("segment"))
        steps = near.where(F.col("segment") != "").select(*place, "segment", step.alias("step"), tenth.alias("tenth"), name.alias("name"))
        grown = {
            "form": F.when(F.col("step").isNull(), F.col("form")).otherwise(F.concat("form", F.lit("/"), "step")),
            "template": F.when(F.col("step").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "step", "tenth")),
            "named": F.when(F.col("step").isNull(), F.col("named")).otherwise(F.concat("named", F.lit("/"), "name"))}
        leaves = leaves.join(steps, [*place, "segment"], "left").withColumns(grown)
        leaves = stored(leaves.drop("segment", "step", "tenth", "name"), f"url-level{level}")
        level += 1
    leaves = stored(reduce(DataFrame.unionByName, ended), "url-leaves")
    # A template's share is smoothed by that of its path over all hosts, this by its form's in the host, that by the
    # host's, and that by the form's share over all hosts.
    whole = leaves.agg((F.sum("bad") / F.greatest(F.sum("seen"), F.lit(1))).alias("all_share")).first()["all_share"]

    def smoothed(bad, seen, prior):
        return (F.col(bad) + PRIOR * prior) / (F.col(seen) + PRIOR)

    forms = leaves.groupBy("form").agg(F.sum("seen").alias("f_seen"), F.sum("bad").alias("f_bad"))
    forms = forms.select("form", smoothed("f_bad", "f_seen", F.lit(whole or 0.0)).alias("all_prior"))
    host = leaves.groupBy("host").agg(F.sum("seen").alias("h_seen"), F.sum("bad").alias("h_bad"))
    alike = leaves.groupBy(*place).agg(F.sum("seen").alias("p_seen"), F.sum("bad").alias("p_bad")).join(host, "host").join(forms, "form")
    alike = alike.select(*place, smoothed("p_bad", "p_seen", smoothed("h_bad", "h_seen", F.col("all_prior"))).alias("prior"))
    names = leaves.groupBy("named").agg(F.sum("seen").alias("n_seen"), F.sum("bad").alias("n_bad"))
    own = leaves.groupBy(*place, "template").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad")).join(alike, place)
    pure = leaves.select(*place, "template", "named").distinct().join(own, [*place, "template"]).join(names, "named")
    judged = pure.select(*place, "template", "named", smoothed("bad", "seen", smoothed("n_bad", "n_seen", F.col("prior"))).alias("purity"))
    return leaves.select("host", "shape", "form", "template", "named").join(judged, [*place, "template", "named"]).drop("form", "named").withColumn(
        "rejected", F.col("purity") >= REJECT)


def judged(pages, page_id="page_id", url="url", rules=RULES):
    """page_id, host, path, rule, verdict, template, purity for every page."""
    host, path = host_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumns({"_r": rule_of(F.col("host"), F.col("path"), rules), "shape": shaped(F.col("path"))})
    labelled = rows.select("host", "shape", F.when(F.col("_r.verdict") == "block", 1).when(F.col("_r.verdict") == "allow", 0).alias("label"))
    found = templates(labelled)
    method = F.when(F.coalesce("rejected", F.lit(False)), "block").otherwise("allow")
    return rows.join(found, ["host", "shape"], "left").select(
        "page_id", "host", "path", F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", method).alias("verdict"),
        "template", "purity")
