"""URL filters: fixed rules first, then a path-template tree per host.

Paths are generalised in three steps. Digits become ``{n}``, so pages that differ in
numbers share one path. The paths of a host form a tree; a branch among very many sparse
ones is variable and becomes ``*``. Siblings are ordered by their labelled share of good
pages and cut where two neighbours differ by a two-sided test; what stays together is similar and is
merged into one ``*``, numbered where a node has several. What is left are templates. A template is blocked when its share of good labelled pages, smoothed towards
its host's and all hosts' shares, is too low.

Everything is DataFrame work. Pages are aggregated to generalised paths at once, so the
tree is built from few rows and a host with a third of all pages is a few of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickstream.llm.frames import keep

# A node with this many branches turns those with less than 1/MANY of its pages into "*".
MANY = 16
# Neighbouring labelled shares that differ by fewer standard errors than this are similar.
SIMILAR = 1.96
# Weight, in labelled pages, of the host's share in a template's and of all pages' in a host's.
SMOOTHING = 8.0
MIN_PURITY = 0.5


@dataclass(frozen=True)
class Rule:
    """``host/path``: holds for the host and its subdomains where paths begin with the path."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


# Fixed values of the registered query.
RULES = [
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path`` (replaced where they exist)."""
    at = F.instr(F.col(url), "://")
    rest = F.coalesce(F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1), _UPPER, _UPPER.lower())
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)})


def matching_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as struct(length, verdict, rule), or null.

    Rules are looked up by each suffix of the host, so their number matters little. Of
    rules of one length that fit, ``block`` wins.
    """
    if not rules:
        return F.lit(None).cast("struct<length: int, verdict: string, rule: string>")
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    entries = []
    for name, own in by_host.items():
        entries += [F.lit(name), F.array(*[
            F.struct(F.lit(len(r.text)).alias("length"), F.lit(r.verdict).alias("verdict"),
                     F.lit(r.text).alias("rule"), F.lit(r.path).alias("path")) for r in own])]
    table = F.create_map(*entries)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)),
                               lambda r: r.isNotNull()))
    fits = F.filter(found, lambda r: path.startswith(r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(r["length"], r["verdict"], r["rule"])))


def generalised(path: Column) -> Column:
    return F.regexp_replace(path, "[0-9]+", "{n}")


def template_verdicts(paths: DataFrame) -> DataFrame:
    """(host, gpath, template, purity) from (host, gpath, n, good, bad), one row per path."""
    segments = F.split("gpath", "/")
    steps = paths.select("host", "gpath", "n", "good", "bad", F.posexplode(segments).alias("depth", "segment"),
                         segments.alias("all"))
    steps = steps.withColumn("parent", F.array_join(F.slice("all", 1, F.col("depth")), "/")).drop("all")
    # A node and its parent's name tell branches apart; depth keeps "" and "/" apart.
    edge = ["host", "depth", "parent"]
    branches = steps.groupBy(*edge, "segment").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    nodes = branches.groupBy(*edge).agg(F.count("*").alias("branches"), F.sum("n").alias("all_n"))
    variable = (F.col("branches") >= MANY) & (F.col("n") * MANY < F.col("all_n"))
    starred = branches.join(nodes, edge).withColumn(
        "kind", F.when(variable, F.lit("*")).otherwise(F.col("segment")))
    # At most MANY kinds are left under a node, which bounds the windows.
    labelled = F.col("good") + F.col("bad")
    kinds = starred.groupBy(*edge, "kind").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).withColumn(
        "share", (F.col("good") + 1.0) / (labelled + 2.0)).withColumn(
        "spread", F.col("share") * (1 - F.col("share")) / (labelled + 2.0))
    by_share = Window.partitionBy(*edge).orderBy("share", "kind")
    gap = F.col("share") - F.lag("share").over(by_share)
    apart = gap >= SIMILAR * F.sqrt(F.col("spread") + F.lag("spread").over(by_share))
    kinds = kinds.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int")).withColumn(
        "cluster", F.sum("apart").over(by_share.rowsBetween(Window.unboundedPreceding, 0)))
    together = F.count("*").over(Window.partitionBy(*edge, "cluster"))
    number = F.when(F.col("cluster") > 0, F.col("cluster").cast("string")).otherwise(F.lit(""))
    kinds = kinds.withColumn("name", F.when(
        (together > 1) | (F.col("kind") == "*"), F.concat(F.lit("*"), number)).otherwise(F.col("kind")))
    merged = starred.select(*edge, "segment", "kind").join(
        kinds.select(*edge, "kind", "name"), [*edge, "kind"]).select(*edge, "segment", "name")
    named = steps.join(merged, [*edge, "segment"]).groupBy("host", "gpath").agg(
        F.first("good").alias("good"), F.first("bad").alias("bad"),
        F.sort_array(F.collect_list(F.struct(
            "depth", "name"))).alias("names"))
    named = named.select("host", "gpath", "good", "bad", F.array_join("names.name", "/").alias("template"))

    overall = paths.agg(((F.sum("good") + 1.0) / (F.sum("good") + F.sum("bad") + 2.0)).alias("all_share"))
    hosts = named.groupBy("host").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    hosts = hosts.join(F.broadcast(overall)).select("host", (
        (F.col("g") + SMOOTHING * F.col("all_share")) / (F.col("g") + F.col("b") + SMOOTHING)).alias("host_share"))
    templates = named.groupBy("host", "template").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    templates = templates.join(hosts, "host").select("host", "template", (
        (F.col("g") + SMOOTHING * F.col("host_share")) / (F.col("g") + F.col("b") + SMOOTHING)).alias("purity"))
    return named.join(templates, ["host", "template"]).select("host", "gpath", "template", "purity")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[Rule] = RULES, url: str = "url",
               key: str = "label_key", good: str = "good") -> DataFrame:
    """The pages with host, path, rule, verdict, template and purity (replaced where they exist).

    ``labels`` holds (key, good) with good true or false; pages carry the key in a column
    of that name, or null. Null keys and labels count for nothing; of several labels of one
    key a bad one wins. Null urls and urls without ``://`` have empty host and path and are
    judged as one template. Without labels only rules block. Other columns stay.
    """
    names = ["host", "path", "rule", "verdict", "template", "purity"]
    parsed = with_parts(pages.drop(*names), url).withColumn("__gpath", generalised(F.col("path")))
    marks = labels.where(F.col(key).isNotNull() & F.col(good).isNotNull()).groupBy(
        F.col(key).alias("__key")).agg(F.min(F.col(good).cast("int")).alias("__good"))
    sizes = parsed.groupBy("host", F.col("__gpath").alias("gpath")).agg(F.count("*").alias("n"))
    marked = parsed.join(marks, F.col(key) == F.col("__key")).groupBy("host", F.col("__gpath").alias("gpath")).agg(
        F.sum("__good").alias("good"), F.sum(1 - F.col("__good")).alias("bad"))
    paths = keep(sizes.join(marked, ["host", "gpath"], "left").na.fill(0, ["good", "bad"]), "paths")
    verdicts = template_verdicts(paths).select(
        F.col("host").alias("__host"), F.col("gpath").alias("__path"), "template", "purity")
    judged = parsed.join(
        verdicts, (F.col("host") == F.col("__host")) & (F.col("__gpath") == F.col("__path")), "left")
    rule = matching_rule(rules, F.col("host"), F.col("path"))
    method = F.when(F.col("purity") < MIN_PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("__rule", rule).withColumns({
        "rule": F.col("__rule.rule"), "verdict": F.coalesce(F.col("__rule.verdict"), method),
    }).drop("__rule", "__host", "__path", "__gpath")


def url_report(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict, with template and purity, of all pages.

    A page's last number in the path is the id of the document it was taken into, whose
    quality label judges it.
    """
    keyed = with_parts(pages.select("page_id", "url")).withColumn(
        "label_key", F.expr("try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS BIGINT)"))
    marks = labels.select(F.col("doc_id").alias("label_key"), (F.col("quality") > 0).alias("good"))
    return judge_urls(keyed, marks).select(
        "page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 9).alias("purity"))


URL_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(r, ''), '^([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(r, ''), '^([^/?#]*)([^?#]*)', 2) AS path
  FROM rest
), keyed AS (
  SELECT *, regexp_replace(path, '[0-9]+', '{n}', 'g') AS gpath,
    try_cast(nullif(regexp_extract(path, '([0-9]+)[^0-9]*$', 1), '') AS BIGINT) AS k
  FROM parsed
), marks AS (
  SELECT doc_id AS k, min(CASE WHEN quality > 0 THEN 1 ELSE 0 END) AS good
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), paths AS (
  SELECT host, gpath, count(*) AS n, coalesce(sum(m.good), 0) AS good, coalesce(sum(1 - m.good), 0) AS bad
  FROM keyed LEFT JOIN marks m USING (k) GROUP BY host, gpath
), listed AS (SELECT *, string_split(gpath, '/') AS segs FROM paths),
steps AS (
  SELECT host, gpath, n, good, bad, d AS depth, segs[d + 1] AS segment,
    array_to_string(segs[1:d], '/') AS parent
  FROM listed, range(0, 100) t(d) WHERE d < len(segs)
), branches AS (
  SELECT host, depth, parent, segment, sum(n) AS n, sum(good) AS good, sum(bad) AS bad
  FROM steps GROUP BY ALL
), nodes AS (
  SELECT host, depth, parent, count(*) AS branches, sum(n) AS all_n FROM branches GROUP BY ALL
), starred AS (
  SELECT b.*, CASE WHEN branches >= 16 AND n * 16 < all_n THEN '*' ELSE segment END AS kind
  FROM branches b JOIN nodes USING (host, depth, parent)
), shares AS (
  SELECT host, depth, parent, kind,
    (sum(good) + 1.0::DOUBLE) / (sum(good) + sum(bad) + 2.0::DOUBLE) AS share,
    sum(good) + sum(bad) + 2.0::DOUBLE AS l
  FROM starred GROUP BY host, depth, parent, kind
), spreads AS (SELECT *, share * (1 - share) / l AS spread FROM shares),
gaps AS (
  SELECT *, CASE WHEN share - lag(share) OVER w >= 1.96::DOUBLE * sqrt(spread + lag(spread) OVER w)
                 THEN 1 ELSE 0 END AS apart
  FROM spreads WINDOW w AS (PARTITION BY host, depth, parent ORDER BY share, kind)
), clusters AS (
  SELECT *, sum(apart) OVER (PARTITION BY host, depth, parent ORDER BY share, kind
                             ROWS UNBOUNDED PRECEDING)::BIGINT AS cluster FROM gaps
), kinds AS (
  SELECT host, depth, parent, kind, CASE
    WHEN count(*) OVER (PARTITION BY host, depth, parent, cluster) > 1 OR kind = '*'
      THEN '*' || CASE WHEN cluster > 0 THEN cluster::VARCHAR ELSE '' END
    ELSE kind END AS name
  FROM clusters
), merged AS (
  SELECT host, depth, parent, segment, name FROM starred JOIN kinds USING (host, depth, parent, kind)
), named AS (
  SELECT host, gpath, first(good) AS good, first(bad) AS bad,
    string_agg(name, '/' ORDER BY depth) AS template
  FROM steps JOIN merged USING (host, depth, parent, segment) GROUP BY host, gpath
), overall AS (SELECT (sum(good) + 1.0::DOUBLE) / (sum(good) + sum(bad) + 2.0::DOUBLE) AS a FROM paths),
hosts AS (
  SELECT host, (sum(good) + 8.0::DOUBLE * any_value(a)) / (sum(good) + sum(bad) + 8.0::DOUBLE) AS host_share
  FROM named, overall GROUP BY host
), templates AS (
  SELECT host, template, (sum(good) + 8.0::DOUBLE * any_value(host_share)) / (sum(good) + sum(bad) + 8.0::DOUBLE) AS purity
  FROM named JOIN hosts USING (host) GROUP BY host, template
), ruled AS (
  SELECT k.*, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM keyed k
)
SELECT page_id, r.host, r.path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN purity < 0.5 THEN 'block' ELSE 'allow' END AS verdict, t.template, round(purity, 9) AS purity
FROM ruled r JOIN named n ON n.host = r.host AND n.gpath = r.gpath
JOIN templates t ON t.host = n.host AND t.template = n.template
"""
