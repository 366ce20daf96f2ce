"""URL verdicts from rules, and from trees of path templates, of hosts and of their parent domains, where no rule fits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnocast.session import checkpointed

#: (host, path, verdict). Fixed values.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: A general path with more than one in so many pages has its pages spread over so many tasks when they meet its verdict.
HOT_ONE_IN, SALTS = 1000, 64
#: A node with more children than this has variable segments: those below this share of the node.
CHILDREN, RARE_SHARE = 20, 0.05
#: Siblings whose shares of bad pages differ by less than this many standard errors are one branch.
Z_SAME = 1.64
#: A template is rejected at this share of bad pages, smoothed by so many pages of the average kind, if so many are labelled.
PURITY, SMOOTHING, LEAST_LABELLED = 0.9, 10.0, 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null and where there is no ``://``."""
    host, path = (F.coalesce(F.regexp_extract(url, _PARTS, i), F.lit("")) for i in (1, 2))
    return F.translate(host, _UPPER, _LOWER), path


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last one set wins: the longest, then the one with the longer host, then one that blocks.
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2], r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        text = F.when(fits, rule_host + rule_path).otherwise(text)
        verdict = F.when(fits, says).otherwise(verdict)
    return text, verdict


def _counts() -> list[Column]:
    bad = F.coalesce(F.sum("label"), F.lit(0)).alias("bad")
    return [F.count("*").alias("pages"), F.count("label").alias("labelled"), bad]


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("pages", "labelled", "bad")]


def _segments(path: Column) -> Column:
    """The path's segments with runs of digits and hex ids made general."""
    return F.transform(
        F.filter(F.split(path, "/"), lambda x: x != ""),
        lambda x: F.regexp_replace(
            F.regexp_replace(x, r"(?i)(?<![0-9a-z])(?=[0-9a-f-]*[0-9])[0-9a-f-]{12,}(?![0-9a-z])", "<id>"), "[0-9]+", "<n>"
        ),
    )


def _branches(child: DataFrame, children: int, rare_share: float, z_same: float) -> DataFrame:
    """``(host, prefix, child, branch)``: the branch that each child of a node belongs to."""
    node = ["host", "prefix"]
    sums = _sums()
    kids = child.groupBy(*node, "child").agg(*sums)
    whole = kids.groupBy(*node).agg(F.count("*").alias("kinds"), F.sum("pages").alias("total"))
    rare = (F.col("kinds") > children) & (F.col("pages") < rare_share * F.col("total")) & (F.col("child") != "")
    kids = kids.join(whole, node).withColumn("general", F.when(rare, "*").otherwise(F.col("child")))
    known = kids.groupBy(*node, "general").agg(*sums).where("labelled > 0 and general <> ''")
    # Few rows per node: what is rare among many is one wildcard by now.
    order = Window.partitionBy(*node).orderBy(F.col("bad") / F.col("labelled"), "general")
    n, b, m, c = F.col("labelled"), F.col("bad"), F.lag("labelled").over(order), F.lag("bad").over(order)
    pooled = (b + c) / (n + m)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    apart = F.coalesce((spread > 0) & (F.abs(b / n - c / m) > z_same * spread), F.lit(False)).cast("int")
    groups = known.withColumn("apart", apart).withColumn("cluster", F.sum("apart").over(order))
    joint = groups.groupBy(*node, "cluster").agg(F.sort_array(F.collect_list("general")).alias("names"))
    joint = joint.where(F.size("names") > 1).select(
        *node, F.explode("names").alias("general"), F.concat(F.lit("{"), F.array_join("names", "|"), F.lit("}")).alias("joint")
    )
    named = kids.join(joint, [*node, "general"], "left")
    return named.select(*node, "child", F.coalesce("joint", "general").alias("branch"))


def templates(pages: DataFrame, children: int = CHILDREN, rare_share: float = RARE_SHARE, z_same: float = Z_SAME) -> DataFrame:
    """``(host, segments, template, labelled, bad)`` for the ``pages(host, path, label)``; ``label`` is 1 bad, 0 good or null.

    Equal general paths collapse first. Level by level, down to the last segment, the rare children of a node with many are made one
    wildcard, and branches whose shares of bad pages are alike are joined, so their subtrees grow together.
    ``labelled`` and ``bad`` count the pages of the whole template.
    """
    general = pages.select("host", _segments(F.col("path")).alias("segments"), "label")
    return _grow(general.groupBy("host", "segments").agg(*_counts()), children, rare_share, z_same)


def _grow(counted: DataFrame, children: int = CHILDREN, rare_share: float = RARE_SHARE, z_same: float = Z_SAME) -> DataFrame:
    """The templates of ``counted(host, segments, pages, labelled, bad)``, a row for each general path of a host or domain.

    Every round takes the nodes that still branch one level down. What all paths of a node have in common is passed at
    once, and a node with one path is done, so there are as many rounds as a path has forks and not as it has segments.
    """
    node = ["host", "prefix"]
    done = []
    tree = checkpointed(counted).withColumns({"prefix": F.lit(""), "rest": F.col("segments")})
    while True:
        ends = tree.groupBy(*node).agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
        common = F.expr("size(filter(sequence(0, size(low)), k -> slice(low, 1, k) = slice(high, 1, k))) - 1")
        ends = ends.select(*node, F.slice("low", F.lit(1), common).alias("common"), (F.col("low") == F.col("high")).alias("alone"))
        tree = tree.join(ends, node)
        tree = tree.withColumns(
            {
                "prefix": F.concat("prefix", F.array_join(F.transform("common", lambda x: F.concat(F.lit("/"), x)), "")),
                "rest": F.slice("rest", F.size("common") + 1, F.size("rest")),
            }
        ).drop("common")
        over = F.col("alone") | (F.size("rest") == 0)
        tree = checkpointed(tree)
        # A path that ends at a fork is still one of the fork's children.
        forks = tree.where(~F.col("alone"))
        done.append(tree.where(over).drop("alone", "rest"))
        if forks.isEmpty():
            break
        child = forks.withColumn("child", F.coalesce(F.get("rest", 0), F.lit("")))
        branches = _branches(child, children, rare_share, z_same)
        step = child.where("child <> ''").join(branches, [*node, "child"]).withColumn("prefix", F.concat("prefix", F.lit("/"), "branch"))
        tree = checkpointed(step.withColumn("rest", F.slice("rest", F.lit(2), F.size("rest"))).drop("child", "branch", "alone"))
    whole = reduce(DataFrame.union, done)
    total = whole.groupBy(*node).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    return whole.select(*node, "segments", "pages").join(total, node).withColumnRenamed("prefix", "template")


def _domains(host: Column) -> Column:
    """The domains above a host, nearest first, each with a dot before it: ``.b.c`` and ``.c`` of ``a.b.c``."""
    parts = F.split(host, r"\.")
    above = F.transform(
        F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))),
        lambda n: F.concat(F.lit("."), F.array_join(F.slice(parts, n, F.size(parts)), ".")),
    )
    return F.when(F.size(parts) > 1, above).otherwise(F.array().cast("array<string>"))


def evidence(pages: DataFrame, least_labelled: int = LEAST_LABELLED) -> DataFrame:
    """``(host, segments, template, pages, labelled, bad, source, above)``: what speaks for each general path of ``pages(host, path, label)``.

    A host's own template speaks if ``least_labelled`` of its pages are labelled; else that of the nearest domain
    above it with so many, in a tree over all hosts of that domain; else the host's own. ``template`` is always the host's
    own, ``source`` the host or domain (with a dot before it) that speaks, ``above`` the share of bad pages of the nearest domain
    above the host with so many labels, if any. Nothing is shared beyond the last label of a host.
    """
    general = pages.select("host", _segments(F.col("path")).alias("segments"), "label")
    # Equal paths collapse before they are copied to the domains, so a hot host costs one row for each path.
    counted = checkpointed(general.groupBy("host", "segments").agg(*_counts()))
    copies = counted.withColumn("host", F.explode(F.concat(F.array("host"), _domains(F.col("host")))))
    known = checkpointed(_grow(copies.groupBy("host", "segments").agg(*_sums())))
    own = counted.select("host", "segments").join(known, ["host", "segments"])
    weak = own.where(F.col("labelled") < least_labelled)
    above = weak.select("host", "segments", F.posexplode(_domains(F.col("host"))).alias("up", "source"))
    strong = known.where(F.col("labelled") >= least_labelled).select(F.col("host").alias("source"), "segments", "labelled", "bad")
    near = above.join(strong, ["source", "segments"]).groupBy("host", "segments")
    near = near.agg(F.min(F.struct("up", "source", "labelled", "bad")).alias("near"))
    marks = copies.groupBy("host").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    marks = marks.where(F.col("labelled") >= least_labelled).select(F.col("host").alias("source"), (F.col("bad") / F.col("labelled")).alias("share"))
    hosts = counted.select("host").distinct().select("host", F.posexplode(_domains(F.col("host"))).alias("up", "source"))
    parents = hosts.join(marks, "source").groupBy("host").agg(F.min(F.struct("up", "share")).alias("parent"))
    return own.join(near, ["host", "segments"], "left").join(parents, "host", "left").select(
        "host", "segments", "template", "pages", *(F.coalesce(f"near.{c}", c).alias(c) for c in ("labelled", "bad")),
        F.coalesce("near.source", "host").alias("source"), F.col("parent.share").alias("above"),
    )


def judge(
    pages: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    labels: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    purity: float = PURITY,
    smoothing: float = SMOOTHING,
    least_labelled: int = LEAST_LABELLED,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` for each row of ``pages``.

    The longest rule that fits decides. Elsewhere the page's template does, or, where too few of its pages are labelled, that of
    the nearest domain above its host (see ``evidence``): the page is blocked if enough pages are labelled and their
    share of bad ones, smoothed by that of the domain above or else of all pages, ``purity``, reaches the bound, else allowed. Labels are those of
    ``labels(page_id, bad)``, or, without it, the verdicts of the rules on the pages that they decide. A null URL, or one
    without ``://``, has an empty host and path. Null labels and ids of labels are ignored; a page with several labels
    counts as bad if any says so. Repeated rows each get a row. An empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": rule, "says": says})
    if labels is None:
        parsed = parsed.withColumn("label", F.when(F.col("says").isNotNull(), (F.col("says") == "block").cast("long")))
    else:
        marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
        parsed = parsed.join(marks.agg(F.max(F.col("bad").cast("long")).alias("label")), "id", "left")
    known = checkpointed(evidence(parsed.select("host", "path", "label"), least_labelled))
    mean = parsed.agg((F.sum("label") / F.count("label")).alias("mean"))
    average = F.coalesce(F.lit(mean.head()[0]).cast("double"), F.lit(0.0))
    # At most HOT_ONE_IN paths can hold more than one in HOT_ONE_IN pages; theirs are met in many tasks.
    total = known.agg(F.sum("pages")).head()[0] or 0
    keys = ["host", "segments"]
    hot = F.broadcast(known.where(F.col("pages") * HOT_ONE_IN > total).select(*keys, F.lit(True).alias("hot")))
    salts = F.when(F.col("pages") * HOT_ONE_IN > total, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "path", F.monotonically_increasing_id()), F.lit(SALTS))).otherwise(0).cast("int")
    judged = parsed.withColumn("segments", _segments(F.col("path"))).join(hot, keys, "left").withColumn("salt", salt)
    judged = judged.join(known.withColumn("salt", F.explode(salts)).drop("pages"), [*keys, "salt"])
    smooth = (F.col("bad") + F.coalesce("above", average) * smoothing) / (F.col("labelled") + smoothing)
    rejected = (F.col("labelled") >= least_labelled) & (smooth >= purity)
    verdict = F.coalesce("says", F.when(rejected, "block").otherwise("allow"))
    return judged.select(
        F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "template", smooth.alias("purity")
    )
