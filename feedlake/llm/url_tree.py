"""URL filter: listed rules first, then a path-template tree per host.

The tree is grown level by level with grouped counts, over every prefix of a path. A segment value stays
a branch of its own if it has enough rows and its slot holds few distinct values or it stands out among
them; all others become a wildcard. At each level sibling branches whose address shapes are distributed
alike (chi-square distance) are merged and grow on as one. The purity of a node is the share of blocked
rows among its labelled ones (those under a rule), smoothed towards its parent. A page under no rule is
rejected where the node at which its path ends has labelled rows and is pure enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import Lists, map_lists
from feedlake.session import landed

#: (verdict, host, path prefix)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: A branch has so many rows at least, and the values of its slot so many on average or it so many times their average.
MIN_ROWS, STAND_OUT = 10, 4
#: Levels of the tree; what lies deeper belongs to the tail of its template.
MAX_LEVELS = 8
#: Sibling branches merge below this chi-square distance of their shape shares (0 alike, 1 disjoint).
MERGE_BELOW = 0.2
#: Steps of the grid on the roots of shape shares. Two branches of one cell differ by 5 / GRID ** 2 at most, less than MERGE_BELOW.
GRID = 8
#: Half the pseudo rows that a node has of its parent's purity, and the share from which a template is rejected.
SMOOTHING = 1.0
REJECT_FROM = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_SHAPES = ("plain", "slash", "file", "query", "anchor")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of an address; both empty without ``://`` or when it is null."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(url, _PARTS, 2)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule, as its text and its verdict; both null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name = F.when(fits, F.lit(domain + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _shape(url: Column, path: Column) -> Column:
    """What kind of address it is: the statistic by which branches are compared."""
    return (
        F.when(F.contains(url, F.lit("?")), "query").when(F.contains(url, F.lit("#")), "anchor")
        .when(path.endswith("/"), "slash").when(path.rlike(r"\.\w+$"), "file").otherwise("plain")
    )


def _pattern(path: Column) -> Column:
    """The non-empty segments of a path, numbers and long hexadecimal ids as wildcards."""
    variable = r"\d|^[0-9a-fA-F-]{12,}$"
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.when(s.rlike(variable), F.lit("*")).otherwise(s))


def _smoothed(bad: Column, labelled: Column, parent: Column) -> Column:
    return (bad + 2 * SMOOTHING * parent) / (labelled + 2 * SMOOTHING)


def _counts() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("n", "n_labelled", "n_blocked", *_SHAPES)]


def grow(rows: DataFrame) -> DataFrame:
    """Every distinct address pattern with the node at which it ends: host, pattern, template, n_node, purity, ...

    ``n_node`` counts the labelled rows of the node, that is of all paths that begin with its template. ``rows`` has
    host, path, shape and verdict (of the rules, or null). They are counted per pattern before anything else, so a host
    with a third of all rows costs no more than its patterns.
    """
    spark = rows.sparkSession
    own = {s: F.count(F.when(F.col("shape") == s, 1)) for s in _SHAPES}
    rows = rows.groupBy("host", _pattern(F.col("path")).alias("pattern")).agg(
        F.count("*").alias("n"), F.count("verdict").alias("n_labelled"), F.count(F.when(F.col("verdict") == "block", 1)).alias("n_blocked"),
        *[count.alias(s) for s, count in own.items()],
    )
    rows = landed(spark, rows, "url-patterns")
    depth, labelled, bad = rows.agg(F.max(F.size("pattern")), F.sum("n_labelled"), F.sum("n_blocked")).first()
    everywhere = _smoothed(F.lit(bad or 0), F.lit(labelled or 0), F.lit(0.5))
    roots = rows.groupBy("host").agg(F.sum("n_labelled").alias("n_node"), F.sum("n_blocked").alias("_bad"))
    roots = roots.select("host", F.lit("").alias("template"), "n_node", _smoothed(F.col("_bad"), F.col("n_node"), everywhere).alias("purity"))
    rows = rows.join(roots, "host")
    for level in range(min(depth or 0, MAX_LEVELS)):
        here = rows.where(F.size("pattern") > level).withColumn("_value", F.get("pattern", F.lit(level)))
        grown = landed(spark, _branches(here), f"url-level-{level}")
        nodes = landed(spark, _merged(grown), f"url-nodes-{level}")
        grown = grown.drop("template", "n_node", "purity").withColumnsRenamed({"_parent": "template"}).join(nodes, ["host", "template", "branch"])
        grown = grown.withColumn("template", F.concat_ws("/", "template", "group")).drop("branch", "group", "_value")
        rows = rows.where(F.size("pattern") <= level).unionByName(grown)
    return rows


def _branches(here: DataFrame) -> DataFrame:
    """Add ``branch``, the value of the next segment or a wildcard, by the rows of the value and the distinct values of its slot."""
    value = here.groupBy("host", "template", "_value").agg(F.sum("n").alias("_n"))
    slot = value.groupBy("host", "template").agg((F.sum("_n") / F.count("*")).alias("_mean"))
    kept = value.where(F.col("_n") >= MIN_ROWS).join(slot, ["host", "template"])
    kept = kept.where((F.col("_mean") >= MIN_ROWS) | (F.col("_n") >= STAND_OUT * F.col("_mean")))
    kept = kept.select("host", "template", "_value", F.lit(True).alias("_kept"))
    here = here.join(kept, ["host", "template", "_value"], "left")
    return here.withColumn("branch", F.when(F.col("_kept"), F.col("_value")).otherwise(F.lit("*"))).withColumn("_parent", F.col("template")).drop("_kept")


def _apart(a: dict, b: dict) -> float:
    """The chi-square distance of the shape shares of two branches."""
    shares = [(a[s] / a["n"], b[s] / b["n"]) for s in _SHAPES]
    return sum((p - q) ** 2 / (p + q) for p, q in shares if p + q) / 2


def _leaders(rows: Lists) -> Lists:
    """Every cell of a node with its group: the first cell, from the one with most rows on, that is alike and leads itself."""
    out: Lists = {name: [] for name in ("host", "template", "cell", "group")}
    for host, template, cells in zip(rows["host"], rows["template"], rows["cells"]):
        leads: list[dict] = []
        for cell in sorted(cells, key=lambda c: (-c["n"], c["lead"])):
            lead = next((x for x in leads if _apart(cell, x) < MERGE_BELOW), None)
            if lead is None:
                leads.append(lead := cell)
            for name, value in zip(out, (host, template, cell["cell"], lead["lead"])):
                out[name].append(value)
    return out


def _merged(grown: DataFrame) -> DataFrame:
    """host, template (of the parent), branch, group, n_node, purity: siblings of like shape are one node, named after the largest.

    Branches are gathered by cells of a grid over their shape shares first; a node has a bounded number of cells
    however many branches it has, so comparing its cells with each other stays small.
    """
    node = grown.groupBy("host", "template", "branch").agg(*_counts(), F.first("purity").alias("_above"))
    cell = F.concat_ws(",", *[F.floor(F.sqrt(F.col(s) / F.col("n")) * GRID).cast("string") for s in _SHAPES])
    node = node.withColumn("cell", cell)
    cells = node.groupBy("host", "template", "cell").agg(*_counts(), F.max(F.struct("n", "branch"))["branch"].alias("lead"))
    cells = cells.groupBy("host", "template").agg(F.collect_list(F.struct("cell", "lead", "n", *_SHAPES)).alias("cells"))
    group = map_lists(cells, lambda: _leaders, "host string, template string, cell string, group string")
    node = node.join(group, ["host", "template", "cell"])
    whole = node.groupBy("host", "template", "group").agg(
        F.sum("n_labelled").alias("n_node"), F.sum("n_blocked").alias("_bad"), F.first("_above").alias("_above")
    )
    whole = whole.withColumn("purity", _smoothed(F.col("_bad"), F.col("n_node"), F.col("_above"))).drop("_bad", "_above")
    return node.select("host", "template", "branch", "group").join(whole, ["host", "template", "group"])


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    The listed rule decides where one fits; else the node of the template tree at which the path ends. Null urls and urls without
    ``://`` have an empty host and path and are judged like any other. Repeated pages keep their rows; other columns
    are not read; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("verdict", verdict)
    rows = rows.withColumn("shape", _shape(F.coalesce("url", F.lit("")), F.col("path")))
    grown = grow(rows).where((F.col("n_node") > 0) & (F.col("n_labelled") < F.col("n")) & (F.col("purity") >= REJECT_FROM))
    bad = landed(pages.sparkSession, grown.select("host", "pattern").distinct(), "url-templates")
    free = rows.where("rule is null").withColumn("pattern", _pattern(F.col("path")))
    free = free.join(bad.withColumn("_bad", F.lit(True)), ["host", "pattern"], "left")
    free = free.withColumn("verdict", F.when(F.col("_bad"), F.lit("block")).otherwise(F.lit("allow")))
    columns = ["page_id", "host", "path", "rule", "verdict"]
    return rows.where("rule is not null").select(columns).unionByName(free.select(columns))
