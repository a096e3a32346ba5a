"""URL filter: host and path rules, and a path-template tree for urls that no rule fits.

Per host, digit runs in path segments become a mark and, level by level, rare children of crowded nodes become a
wildcard, down to the last segment of every path. Branches of a host that look alike, with the same shapes below and no statistical difference in their
labels (Wilson intervals), are merged. Labels are the verdicts of the rules. A template goes when its smoothed
share of blocked labels is high enough and enough of its urls are labelled; without such evidence it stays.

Everything is DataFrame operations. Only the url column is read. Tree steps run on counts for each host and marked
path, so a host with a third of all rows shrinks to its templates before it is shuffled.

Defined results: a null url or one without ``://`` has an empty host and path and is allowed; rows with a null id and
repeated rows get a verdict each; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Segments that ``oracle`` tells apart: it holds for paths of no more than these. The Spark code has no such bound.
LEVELS = 3
CROWD = 12
MIN_LABELLED = 5
SMOOTHING = 2.0
REJECT_AT = 0.8
_Z = 1.96
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    there = F.instr(url, "://")
    rest = F.when(there > 0, F.substring(url, there + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[Rule], host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _upper_and_lower(blocked: Column, n: Column) -> tuple[Column, Column]:
    """Wilson interval of a share."""
    p, z2 = blocked / n, _Z * _Z
    centre, width = (p + z2 / (2 * n)) / (1 + z2 / n), _Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    return centre + width, centre - width


def _segments(path: Column) -> Column:
    """Marked segments."""
    return F.filter(F.split(F.regexp_replace(path, "[0-9]+", "{n}"), "/"), lambda x: x != "")


def _generalised(paths: DataFrame) -> DataFrame:
    """g beside parts: the segments, with '*' for a child that holds less than 1/CROWD of a node with more than CROWD
    children. Where a path ends it is a child '' of its node.

    One step for each level. A node below which fewer than CROWD paths go on has no crowded node under it, so its paths
    are finished: a few deep paths cost no steps of their own."""
    steps, done, k = paths.withColumn("g", F.array().cast("array<string>")), [], 0
    node = ["host", "g"]
    while True:
        deep = steps.groupBy(*node).agg(F.count_if(F.size("parts") > k).alias("deep")).where(F.col("deep") >= CROWD).select(*node, F.lit(True).alias("live"))
        told = written(steps.join(deep, node, "left").withColumn("live", F.coalesce("live", F.lit(False))), "url-nodes")
        rest = F.when(F.size("parts") > k, F.slice("parts", k + 1, F.greatest(F.size("parts") - k, F.lit(0)))).otherwise(F.array().cast("array<string>"))
        done.append(told.where(~F.col("live")).drop("live").withColumn("g", F.array_remove(F.concat("g", rest), "")))
        live = told.where("live").drop("live")
        if live.isEmpty():
            break
        live = live.withColumn("own", F.coalesce(F.get("parts", F.lit(k)), F.lit("")))
        children = live.groupBy(*node, "own").agg(F.sum("n").alias("child_n"))
        nodes = children.groupBy(*node).agg(F.count("*").alias("kinds"), F.sum("child_n").alias("node_n"))
        rare = (children.join(nodes, node).where((F.col("kinds") > CROWD) & (F.col("child_n") * CROWD < F.col("node_n")))
                .select(*node, "own", F.lit("*").alias("star")))
        steps = live.join(rare, [*node, "own"], "left").withColumn("g", F.concat("g", F.array(F.coalesce("star", "own")))).drop("star", "own")
        steps = written(steps, "url-level")  # each level reads the one before several times
        k += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def rejected_paths(pages: DataFrame) -> DataFrame:
    """(host, parts) of the marked paths whose merged template is rejected. ``pages`` has host, parts and label (allow,
    block or null)."""
    count = lambda verdict: F.sum((F.coalesce("label", F.lit("")) == verdict).cast("long"))
    paths = pages.groupBy("host", "parts").agg(F.count("*").alias("n"), count("allow").alias("allowed"), count("block").alias("blocked"))
    paths = _generalised(written(paths, "url-paths"))
    paths = paths.withColumn("g1", F.coalesce(F.get("g", F.lit(0)), F.lit(""))).withColumn("below", F.concat_ws("/", F.slice("g", 2, F.greatest(F.size("g"), F.lit(1)))))
    paths = written(paths.select("host", "parts", "g1", "below", "allowed", "blocked"), "url-templates")
    # a branch's shape is the set of what lies below it, as its size and two sums of hashes, so that no task holds the set
    templates = paths.groupBy("host", "g1", "below").agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
    hashed = lambda seed: F.sum(F.xxhash64("below", F.lit(seed)).cast("decimal(20,0)")).cast("string")
    branches = templates.groupBy("host", "g1").agg(F.concat_ws(" ", F.count("*").cast("string"), hashed(1), hashed(2)).alias("shape"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    n = F.col("a") + F.col("b")
    upper, lower = _upper_and_lower(F.col("b"), F.when(n > 0, n))
    kind = F.when(n == 0, "none").when(lower > 0.5, "block").when(upper < 0.5, "allow").otherwise("mixed")
    branches = branches.select("host", "g1", F.concat_ws("|", kind, "shape").alias("branch"))
    placed = written(paths.join(branches, ["host", "g1"]), "url-branches")
    merged = placed.groupBy("host", "branch", "below").agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
    share = (F.col("b") + 0.5 * SMOOTHING) / (F.col("a") + F.col("b") + SMOOTHING)
    gone = merged.where((F.col("a") + F.col("b") >= MIN_LABELLED) & (share >= REJECT_AT)).select("host", "branch", "below")
    return placed.join(gone, ["host", "branch", "below"]).select("host", "parts")


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict), one row per row of ``pages``."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", rule_of(rules, F.col("host"), F.col("path")))
    rows = rows.select("id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("label"), _segments(F.col("path")).alias("parts"))
    gone = rejected_paths(rows).withColumn("gone", F.lit("block"))
    return rows.join(gone, ["host", "parts"], "left").select("id", "host", "path", "rule", F.coalesce("label", "gone", F.lit("allow")).alias("verdict"))


def oracle(rules: list[Rule]) -> str:
    """The same in DuckDB SQL over the view ``pages``."""
    fit = [(f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r) for r in sorted(rules, key=lambda r: -len(r.host + r.path))]
    case = lambda value: "CASE " + " ".join(f"WHEN {c} THEN '{value(r)}'" for c, r in fit) + " END"
    segs = ", ".join(f"coalesce(parts[{k}], '') AS s{k}" for k in range(1, LEVELS + 1))
    marks, marked = ", ".join(f"s{k}" for k in range(1, LEVELS + 1)), ", ".join(f"g{k}" for k in range(2, LEVELS + 1))
    steps, last = "", "p0"
    for k in range(1, LEVELS + 1):
        above = ", ".join(["host", *[f"g{j}" for j in range(1, k)]])
        steps += f""",
c{k} AS (SELECT {above}, s{k}, sum(n) AS child_n FROM {last} GROUP BY ALL),
n{k} AS (SELECT {above}, count(*) AS kinds, sum(child_n) AS node_n FROM c{k} GROUP BY ALL),
p{k} AS (SELECT {last}.*, CASE WHEN kinds > {CROWD} AND child_n * {CROWD} < node_n THEN '*' ELSE {last}.s{k} END AS g{k}
  FROM {last} JOIN c{k} USING ({above}, s{k}) JOIN n{k} USING ({above}))"""
        last = f"p{k}"
    z2 = _Z * _Z
    return f"""WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, {case(lambda r: r.host + r.path)} AS rule, {case(lambda r: r.verdict)} AS label,
  list_filter(string_split(regexp_replace(path, '[0-9]+', '{{n}}', 'g'), '/'), lambda x: x <> '') AS parts FROM parsed),
seg AS (SELECT page_id, host, path, rule, label, {segs}, CASE WHEN len(parts) > {LEVELS} THEN '**' ELSE '' END AS tail FROM ruled),
p0 AS (SELECT host, {marks}, tail, count(*) AS n, count(*) FILTER (label = 'allow') AS allowed, count(*) FILTER (label = 'block') AS blocked FROM seg GROUP BY ALL){steps},
placed0 AS (SELECT *, concat_ws('/', {marked}, tail) AS below FROM {last}),
b0 AS (SELECT host, g1, array_to_string(list_sort(list(DISTINCT below)), ' ') AS shape, sum(allowed) AS a, sum(blocked) AS b FROM placed0 GROUP BY host, g1),
b1 AS (SELECT *, nullif(a + b, 0) AS m, b / nullif(a + b, 0) AS p FROM b0),
b2 AS (SELECT *, (p + {z2} / (2 * m)) / (1 + {z2} / m) AS centre, {_Z} * sqrt(p * (1 - p) / m + {z2} / (4 * m * m)) / (1 + {z2} / m) AS width FROM b1),
b3 AS (SELECT host, g1, concat_ws('|', CASE WHEN m IS NULL THEN 'none' WHEN centre - width > 0.5 THEN 'block' WHEN centre + width < 0.5 THEN 'allow' ELSE 'mixed' END, shape) AS branch FROM b2),
placed AS (SELECT * FROM placed0 JOIN b3 USING (host, g1)),
gone AS (SELECT host, branch, below FROM placed GROUP BY ALL
  HAVING sum(allowed) + sum(blocked) >= {MIN_LABELLED} AND (sum(blocked) + {0.5 * SMOOTHING}) / (sum(allowed) + sum(blocked) + {SMOOTHING}) >= {REJECT_AT}),
marked AS (SELECT DISTINCT host, {marks}, tail, 'block' AS gone FROM placed JOIN gone USING (host, branch, below))
SELECT page_id, host, path, rule, coalesce(label, gone, 'allow') AS verdict FROM seg LEFT JOIN marked USING (host, {marks}, tail)"""
