"""URL filters: block and allow rules first, then personalised PageRank of trust and reversed distrust over the links between hosts (expressions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import join_checked, materialise

#: Fixed values of the contract: (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Share of a host's mass that goes on along its links, most links of a walk, and the least distrust that blocks a host (a seed keeps 0.15 of its own).
DAMPING, WALK, THRESHOLD = 0.85, 20, 0.01
#: Broadcast bound for tables of a host and two numbers a row.
HOST_ROWS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST, PATH = "://([^/?#]*)", "://[^/?#]*([^?#]*)"
#: Host of an absolute link, or of one that leaves the scheme out.
LINK = r"""[Hh][Rr][Ee][Ff][\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'<>\x00-\x20]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/``, ``?`` or ``#`` (A-Z lower-cased), and from there up to ``?`` or ``#``; both empty for null or without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER), F.regexp_extract(url, PATH, 1)


def ranked(rules: Sequence[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    """(verdict, rule, host, path), the longest first; of equally long ones that with the longer host, then the blocking one."""
    parts = [(v, r, r.split("/", 1)[0].lower(), "/" + r.split("/", 1)[1] if "/" in r else "") for v, r in rules]
    return sorted(parts, key=lambda x: (-len(x[1]), -len(x[2]), x[0] != "block", x[1]))


def matched(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(verdict, rule) of the longest rule that fits, else null. A rule fits its host and all subdomains if the path starts with its own."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule"))) for v, r, h, p in ranked(rules)]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<verdict string, rule string>")


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: pages of ``src`` (host, html) that link to another host ``dst``; a page counts once for a host however often it links to it."""
    found = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER)))
    links = pages.filter("host <> '' and html like '%//%'").select(F.col("host").alias("src"), F.explode(found).alias("dst"))
    return links.filter("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """host, trust, distrust: personalised PageRank from every trusted seed along the links and from every blocked seed against them.

    ``seeds``: host, kind ('trust' or 'distrust'), one unit of mass each. The rank is the sum over walks of up to WALK links: of the
    mass at a host 1 - DAMPING stays and DAMPING is dealt over its links by their pages. A host without links lets its mass go;
    giving it back to the seeds would multiply all ranks of a kind by one number, and here a rank does not hang on the number
    of seeds. Each step is a join and an aggregate of host rows, written to the shared folder.
    """
    both = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    both = both.union(links.select(F.lit("distrust"), "dst", "src", "n"))
    out = both.groupBy("kind", "host").agg(F.sum("n").alias("all"))
    edges = materialise(both.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all")).alias("share")), "host-edges")
    mass = materialise(seeds.select("kind", "host", F.lit(1 - DAMPING).alias("x")), "host-mass")
    total = mass
    for _ in range(WALK):
        on = edges.join(mass, ["kind", "host"]).groupBy("kind", "to").agg((F.sum(F.col("x") * F.col("share")) * DAMPING).alias("x"))
        mass = materialise(on.select("kind", F.col("to").alias("host"), "x"), "host-mass")
        if not mass.head(1):
            break
        total = total.union(mass)
    rank = [F.round(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("x"))), F.lit(0.0)), 12).alias(k) for k in ("trust", "distrust")]  # rounded: not a matter of the order of sums
    return total.groupBy("host").agg(*rank)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row of ``pages`` (page_id, url, html).

    The verdict is that of the longest rule that fits the url. Where none fits it is the host's: a host of whose pages more than half
    fit allowing (blocking) rules is a trusted (blocked) seed, and a host is blocked if its distrust is THRESHOLD or more
    and greater than its trust; in a tie it is allowed. Links are read from whole ``html`` texts; links within a host are none.
    ``rules`` is a short list that becomes part of the plan. A null url, or one without ``://``, has an empty host and path,
    is no node of the graph and is allowed. A null html has no links. Repeated rows and rows with a null page_id are judged
    like others (their links count again), other columns are ignored, and an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("html").cast("string").alias("html"))
    hit = matched(F.col("host"), F.col("path"), rules)
    urls = rows.select("page_id", "host", "path", hit["rule"].alias("rule"), hit["verdict"].alias("by_rule"))
    share = [(2 * F.count_if(F.col("by_rule") == v) > F.count(F.lit(1))).alias(v) for v in ("allow", "block")]
    marked = urls.filter("host <> ''").groupBy("host").agg(*share)
    seeds = materialise(marked.filter("allow or block").select("host", F.when(F.col("allow"), "trust").otherwise("distrust").alias("kind")), "host-seeds")
    links = materialise(host_links(rows), "host-links")
    scores = materialise(propagate(seeds, links), "host-scores")
    out = join_checked(urls, scores, ["host"], "left", HOST_ROWS)
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    own = F.when((distrust >= THRESHOLD) & (distrust > trust), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``judge`` of all pages."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")


def _fits_sql(rule: tuple[str, str, str, str]) -> str:
    _, _, host, path = rule
    return f"(host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '{path}')"


_LINK_SQL = LINK.replace("'", "''")
ORACLE = {
    "op11_url_filter": f"""
WITH RECURSIVE p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{HOST}', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '{PATH}', 1) AS path, html FROM pages),
u AS (SELECT page_id, host, path, CASE {" ".join(f"WHEN {_fits_sql(r)} THEN '{r[1]}'" for r in ranked(RULES))} END AS rule FROM p),
v AS (SELECT *, CASE {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in RULES)} END AS by_rule FROM u),
seeds AS (
  SELECT host, CASE WHEN 2 * count(*) FILTER (by_rule = 'allow') > count(*) THEN 'trust' ELSE 'distrust' END AS kind FROM v WHERE host <> '' GROUP BY host
  HAVING 2 * count(*) FILTER (by_rule = 'allow') > count(*) OR 2 * count(*) FILTER (by_rule = 'block') > count(*)),
found AS (SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(html, '{_LINK_SQL}', 1), lambda h: translate(h, '{UPPER}', '{LOWER}')))) AS dst FROM p WHERE host <> ''),
links AS (SELECT src, dst, count(*) AS n FROM found WHERE src <> dst GROUP BY src, dst),
both_ways AS (SELECT 'trust' AS kind, src AS host, dst AS too, n FROM links UNION ALL SELECT 'distrust', dst, src, n FROM links),
edges AS (SELECT kind, host, too, n / sum(n) OVER (PARTITION BY kind, host) AS share FROM both_ways),
walk AS (
  SELECT 0 AS k, kind, host, {1 - DAMPING!r}::DOUBLE AS x FROM seeds
  UNION ALL
  SELECT w.k + 1, w.kind, e.too, sum(w.x * e.share) * {DAMPING} FROM walk w JOIN edges e ON e.kind = w.kind AND e.host = w.host WHERE w.k < {WALK} GROUP BY w.k + 1, w.kind, e.too),
scores AS (SELECT host, round(coalesce(sum(x) FILTER (kind = 'trust'), 0), 12) AS trust, round(coalesce(sum(x) FILTER (kind = 'distrust'), 0), 12) AS distrust FROM walk GROUP BY host)
SELECT page_id, v.host, path, rule, coalesce(by_rule, CASE WHEN distrust >= {THRESHOLD} AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
FROM v LEFT JOIN scores ON scores.host = v.host"""
}
