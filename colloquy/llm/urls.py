"""URL filter by a path-template tree (operator 6), in Spark SQL only.

Pages collapse to (host, shape) counts: digit runs in a path are wildcards
right away.  Level by level, a path segment stays literal under its host and
parent template only if it has a few rows there and its labelled rows differ from
its siblings' by a two-proportion test, whatever the host's size; other siblings merge into ``*``.  A
template is rejected when the smoothed share of blocked pages among its
labelled ones reaches the threshold; the smoothing leans on the parent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import settle

# Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MIN_ROWS = 3            # a literal segment has at least so many rows under its parent
Z = 1.96
SMOOTH = 2.0            # labelled rows that the parent's purity counts for
DAMP = 0.5              # of the parent's purity
REJECT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path of ``url``; both empty for null or without ``://``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return pages.select("page_id", F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER).alias("host"),
                        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"))


def with_rules(rows: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` (like ``net/``) and ``said``: of the rules that fit, the longest."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p) for _, h, p in ordered]
    pick = lambda values: F.coalesce(*[F.when(f, F.lit(v)) for f, v in zip(fits, values)], F.lit(None).cast("string"))
    return rows.withColumn("rule", pick([h + p for _, h, p in ordered])).withColumn("said", pick([v for v, _, _ in ordered]))


def shape(path):
    """Path segments with digit runs and long hexadecimal names as ``#``."""
    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.transform(parts, lambda s: F.regexp_replace(F.regexp_replace(s, "[0-9a-fA-F]{12,}", "#"), "[0-9]+", "#"))


def template_verdicts(shapes: DataFrame) -> DataFrame:
    """host, shape, judged for counted shapes (host, shape, n, labelled, blocked).

    One round per level at which some template still can split.  A template is
    finished, and its shapes leave the rounds with its purity, when it holds
    fewer than MIN_ROWS rows, one rest of a path, no labels, or one label for
    all its rows: nothing below could differ.  Segments that all shapes of a
    template share are passed at once, so a long path costs no rounds of its
    own."""
    counts = ("n", "labelled", "blocked")
    total = shapes.groupBy("host").agg(*[F.sum(c).alias(c) for c in counts])
    smooth = lambda own: (F.col("blocked") + SMOOTH * own) / (F.col("labelled") + SMOOTH)
    # the host is the root; without labels its purity is 0: nothing speaks against it
    nodes = total.select("host", smooth(F.lit(0.0)).alias("purity"))
    cur = settle(shapes.withColumn("node", F.lit("")).withColumn("tail", F.col("shape")).join(nodes, "host"), "templates")
    done = []
    while True:
        sums = cur.groupBy("host", "node").agg(*[F.sum(c).alias("p_" + c) for c in counts],
                                               F.min("tail").alias("_a"), F.max("tail").alias("_z"))
        # the least and the greatest rest share what all rests share
        differ = F.array_position(F.zip_with("_a", "_z", lambda x, y: x.eqNullSafe(y)), False)
        one_label = (F.col("p_labelled") == F.col("p_n")) & F.col("p_blocked").isin(F.lit(0), F.col("p_labelled"))
        over = (F.col("p_n") < MIN_ROWS) | (F.col("_a") == F.col("_z")) | (F.col("p_labelled") == 0) | one_label
        state = settle(cur.join(sums.withColumn("_shared", (differ - 1).cast("int")).withColumn("_over", over).drop("_a", "_z"),
                                ["host", "node"]), "template-state")
        done.append(state.filter("_over").select("host", "shape", "purity"))
        cur = state.filter("NOT _over")
        if not cur.limit(1).count():
            break
        passed = F.concat("node", F.array_join(F.transform(F.slice("tail", 1, F.col("_shared")), lambda x: F.concat(F.lit("/"), x)), ""))
        cur = (cur.withColumn("_s", F.coalesce(F.get(F.col("tail"), F.col("_shared")), F.lit("$"))).withColumn("_passed", passed)
               .withColumn("tail", F.slice("tail", F.col("_shared") + 2, F.greatest(F.size("tail") - F.col("_shared"), F.lit(0)))))
        both = cur.groupBy("host", "node", "_s").agg(*[F.sum(c).alias(c) for c in counts],
                                                     *[F.first("p_" + c).alias("p_" + c) for c in counts])
        rest = F.col("p_labelled") - F.col("labelled")
        rate = F.try_divide("blocked", "labelled")
        other = F.try_divide(F.col("p_blocked") - F.col("blocked"), rest)
        pooled = F.try_divide("p_blocked", "p_labelled")
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("labelled")) + F.try_divide(F.lit(1), rest)))
        differs = F.coalesce((F.col("labelled") > 0) & (rest > 0) & (error > 0) & (F.abs(rate - other) >= Z * error), F.lit(False))
        # siblings without labels and siblings with labels are not alike either
        mixed = (F.col("p_labelled") > 0) & (((F.col("labelled") == 0) & (rest > 0)) | ((F.col("labelled") > 0) & (rest == 0)))
        often = F.col("n") >= MIN_ROWS
        named = both.select("host", "node", "_s", F.when(
            (F.col("_s") == "$") | (often & (differs | mixed)), F.col("_s")).otherwise("*").alias("_name"))
        moved = (cur.join(named, ["host", "node", "_s"]).withColumn("node", F.concat("_passed", F.lit("/"), "_name"))
                 .select("host", "shape", *counts, "node", "tail", "purity"))
        moved = settle(moved, "templates")
        sums = moved.groupBy("host", "node").agg(F.first("purity").alias("up"), *[F.sum(c).alias(c) for c in ("labelled", "blocked")])
        purity = sums.select("host", "node", smooth(DAMP * F.col("up")).alias("purity"))
        cur = moved.drop("purity").join(purity, ["host", "node"])
    found = reduce(DataFrame.unionByName, done)
    return found.select("host", "shape", F.when(F.col("purity") >= REJECT, "block").otherwise("allow").alias("judged"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages (page_id, url):
    the rule's verdict where one fits, else the template's.  Null and repeated
    ids are kept as they are; rows without a host form a host of their own."""
    rows = with_rules(parsed(pages), rules).withColumn("shape", shape(F.col("path")))
    flag = lambda c: F.sum(F.coalesce(c.cast("long"), F.lit(0)))
    shapes = settle(rows.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), flag(F.col("said").isNotNull()).alias("labelled"),
        flag(F.col("said") == "block").alias("blocked")), "shapes")
    out = rows.join(template_verdicts(shapes), ["host", "shape"])
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", "judged").alias("verdict"))
