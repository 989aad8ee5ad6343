"""URL filters: given rules first, then a path-template tree per host.

A path becomes a template: segments that look like numbers or ids turn into wildcards. The tree is built level by level over
templates with their counts, not over urls, as deep as templates part: a child whose shares of blocked and allowed urls do
not differ significantly from those of its siblings together is variable, and so are branches that do not differ among the others.
A leaf is rejected if the smoothed share of blocked urls among its labelled ones, those a rule decides, is high. Everything
is DataFrame expressions, aggregates and joins.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept

#: The rules of the registered query: verdict, and host with path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@dataclass(frozen=True)
class Tree:
    """Parameters of the template tree.

    ``z``: how many standard errors shares must differ by; for a child among many siblings more, as by chance one of
    many differs. ``prior``: urls that the overall share counts as. ``purity``: the smoothed blocked share from
    which a template is rejected.
    """

    z: float = 1.96
    prior: float = 5.0
    purity: float = 0.9


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host and path; both empty without ``://``."""
    at = F.instr("url", "://")
    after = F.when(at > 0, F.col("url").substr(at + 3, F.length("url"))).otherwise("")
    rest = F.coalesce(after, F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase).alias("host"),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def ruled(urls: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    """``urls`` with the longest rule that fits and its verdict, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(slash + path))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return urls.withColumns({"rule": rule, "ruled": verdict})


def segments(path: str, depth: int | None = None) -> Column:
    """The segments of a path with numbers and ids made wildcards; if ``depth`` is given, those beyond it as one."""
    clean = F.regexp_replace(path, r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "<id>")
    clean = F.regexp_replace(clean, r"(?<![0-9A-Za-z])(?=[0-9a-f]*[0-9])[0-9a-f]{8,}(?![0-9A-Za-z])", "<id>")
    clean = F.regexp_replace(clean, r"[0-9]+", "<n>")
    found = F.filter(F.split(clean, "/"), lambda s: s != "")
    if depth is None:
        return found
    rest = F.when(F.size(found) > depth, F.array(F.lit("**"))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.slice(found, 1, depth), rest)


def differ(a: Column, b: Column, n: Column, m: Column, z: Column) -> Column:
    """Whether the shares a / n and b / m are more than z standard errors apart."""
    share = (a + b) / (n + m)
    error = F.sqrt(share * (1 - share) * (1 / n + 1 / m))
    return F.abs(a / n - b / m) > z * error


def next_level(templates: DataFrame, level: int, tree: Tree) -> DataFrame:
    """``templates`` (host, template, segments, branch, n, blocked, allowed) with the branch of one more level."""
    at, labels, share = ["host", "branch"], ["blocked", "allowed"], ["blocked_share", "allowed_share"]
    counts = [F.sum(c).alias(c) for c in ("n", *labels)]
    deep = templates.where(F.size("segments") > level).withColumn("segment", F.col("segments")[level])
    nodes = deep.groupBy(*at, "segment").agg(*counts)
    parents = nodes.groupBy(*at).agg(F.count("*").alias("children"), *[F.sum(c).alias(f"all_{c}") for c in ("n", *labels)])
    strict = F.sqrt(tree.z**2 + 2 * F.log("children"))
    others = F.col("all_n") - F.col("n")
    apart = [differ(F.col(c), F.col(f"all_{c}") - F.col(c), F.col("n"), others, strict) for c in labels]
    named = F.when(F.col("children") > 1, apart[0] | apart[1]).otherwise(False)
    # Named children with the same shares are one class, the variable ones another: classes are few however many children there are.
    nodes = nodes.join(parents, at).withColumn("named", named)
    nodes = nodes.select(*at, "segment", "n", *labels, *[F.when(F.col("named"), F.col(c) / F.col("n")).otherwise(-1.0).alias(s) for c, s in zip(labels, share)])
    classes = nodes.groupBy(*at, *share).agg(*counts)
    row = F.struct((F.col("blocked") / F.col("n")).alias("x"), (F.col("allowed") / F.col("n")).alias("y"), *share, "n", *labels)
    ordered = classes.groupBy(*at).agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def joined(group: Column, r: Column) -> Column:
        """The groups so far, with a class in the last one of them or in one more."""
        new = differ(r["blocked"], group["blocked"], r["n"], group["n"], F.lit(tree.z)) | differ(r["allowed"], group["allowed"], r["n"], group["n"], F.lit(tree.z))
        new = F.when(group["n"] > 0, new).otherwise(True)
        sums = [F.when(new, r[c]).otherwise(group[c] + r[c]).alias(c) for c in ("n", *labels)]
        number = group["number"] + F.when(new, 1).otherwise(0)
        made = F.struct(r[share[0]].alias(share[0]), r[share[1]].alias(share[1]), number.alias("number"))
        return F.struct(*sums, number.alias("number"), F.concat(group["made"], F.array(made)).alias("made"))

    none = F.from_json(F.lit("[]"), f"array<struct<{share[0]}:double,{share[1]}:double,number:int>>")
    start = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("n", *labels)], F.lit(0).alias("number"), none.alias("made"))
    merged = ordered.select(*at, F.explode(F.aggregate("rows", start, joined, lambda g: g["made"])).alias("made")).select(*at, "made.*")
    names = merged.select(*at, *share, F.concat_ws("/", "branch", F.col("number").cast("string")).alias("longer"))
    grown = nodes.join(names, [*at, *share]).select(*at, "segment", "longer")
    moved = templates.withColumn("segment", F.when(F.size("segments") > level, F.col("segments")[level]))
    return moved.join(grown, [*at, "segment"], "left").withColumn("branch", F.coalesce("longer", "branch")).drop("longer", "segment")


def undecided(templates: DataFrame, level: int) -> DataFrame:
    """The branches of ``templates`` that a further level can part: those of more than one template, one of them longer."""
    branches = templates.groupBy("host", "branch").agg(F.count("*").alias("templates"), F.max(F.size("segments")).alias("longest"))
    return branches.where((F.col("templates") > 1) & (F.col("longest") > level)).select("host", "branch")


def leaves(urls: DataFrame, tree: Tree) -> DataFrame:
    """The branch of every template: host, template, branch, and whether its leaf is rejected."""
    # The template is kept as text: arrays of segments are taken from it again where they are needed.
    counts = urls.groupBy("host", "template").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("allowed"),
    )
    templates = kept(counts, "templates")
    parts = F.filter(F.split("template", "/"), lambda s: s != "")
    built = templates.select("*", parts.alias("segments"), F.lit("").alias("branch"))
    # A template alone in its branch stays so: each level goes on with the others only.
    ended, level = [], 0
    while True:
        going = kept(undecided(built, level), "undecided")
        ended.append(built.join(going, ["host", "branch"], "left_anti"))
        if going.isEmpty():
            break
        built = kept(next_level(built.join(going, ["host", "branch"], "left_semi"), level, tree), "branches")
        level += 1
    built = reduce(DataFrame.unionByName, ended)
    total = templates.agg(F.sum("blocked"), F.sum(F.col("blocked") + F.col("allowed"))).first()
    base = total[0] / total[1] if total[1] else 0.0
    ends = ["host", "branch"]
    leaf = built.groupBy(*ends).agg(F.sum("blocked").alias("blocked"), F.sum(F.col("blocked") + F.col("allowed")).alias("labelled"))
    purity = (F.col("blocked") + tree.prior * base) / (F.col("labelled") + tree.prior)
    # Without a label of its own a leaf is not rejected, however common blocking is elsewhere.
    leaf = leaf.select(*ends, ((F.col("labelled") > 0) & (purity >= tree.purity)).alias("rejected"))
    return built.select("host", "template", "branch").join(leaf, ends)


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, tree: Tree = Tree()) -> DataFrame:
    """page_id, host, path, the rule that fits or null, and the verdict of every url of ``pages`` (page_id, url).

    One row per input row. A null url, or one without ``://``, has an empty host and path and is judged like any
    other; a null page_id stays null. With no labelled url nothing is rejected. Other columns are not read.
    """
    urls = ruled(parsed(pages), rules)
    urls = urls.withColumn("template", F.concat(F.lit("/"), F.array_join(segments("path"), "/")))
    rejected = kept(leaves(urls, tree).where("rejected").select("host", "template", "rejected"), "rejected")
    judged = urls.join(rejected, ["host", "template"], "left")
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
