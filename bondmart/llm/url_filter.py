"""URL verdicts from rules and a path-template tree, in DataFrame functions only.

Rules judge first. What no rule fits is judged by its path template. Digits
in path segments become {n}, hexadecimal identifiers {x} and long slugs {s}.
Then, host by host and level by level from the root, the segments that share a
position are generalised:

* If the distinct paths spread over many segments (an effective number, the
  inverse Simpson index, of 20 or more), each segment with under a tenth of them
  becomes a wildcard (*).
* Labelled branches whose blocked share is statistically alike (within 1.96
  standard deviations of the pooled share) are merged (~).

Labels are the distinct paths that a rule judges. A position's branch purity is
(sum of its labelled branches' blocked shares + 1) / (labelled branches + 2), so
one branch, however large, is one vote. A template with labels is blocked if
its purity, smoothed by two votes of its position's branch purity, is at least 0.8.
A template without labels backs off to the branch purity of the deepest position
on its way that has labels; without any it stays allowed.

All measures are shares of distinct paths: repeated rows, and more paths of the
same spread, leave the tree as it is. Every level is used: a subtree leaves the
loop once it has no labels (its verdict is known) or nothing left to judge, so the
number of passes is the depth of the subtrees that mix both, not of the urls.
Only counts by distinct template move between levels; rows are pre-aggregated
where they lie, so a host with a third of all pages is a few rows.

Defined cases: a null url, or one without ://, has an empty host and path;
repeated rows each get their row; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bondmart.llm.common import materialize, table

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
SPREAD = 20          # effective number of segments at a position with wildcards
COMMON = 10          # a segment with a tenth of a position's paths keeps its name
CHI = 3.8416         # 1.96 squared
PURITY = 0.8
SQL_LEVELS = 8       # levels written out in OP10_SQL; the operator has no bound
END = "/"            # stands for the end of a path; no segment holds it

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule (host, path) that fits, and its verdict; else nulls.
    The rules are one array constant, so that many of them don't grow the code."""
    known = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        known.append(F.struct(F.lit(name).alias("host"), F.lit(slash + rest).alias("path"),
                              F.lit(rule).alias("rule"), F.lit(rules[rule]).alias("verdict")))
    if not known:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    fits = F.filter(F.array(*known), lambda r: path.startswith(r["path"]) & (
        (host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))))
    return F.get(fits, F.lit(0))["rule"], F.get(fits, F.lit(0))["verdict"]


def _segment(s: Column) -> Column:
    # hex digits only, a letter after a digit; both patterns are linear in the segment
    return (F.when((F.length(s) >= 8) & s.rlike(r"^[0-9a-f]++$") & s.rlike(r"[0-9][a-f]"), F.lit("{x}"))
            .when((F.length(s) >= 25) | s.rlike(r"-.*-.*-"), F.lit("{s}"))
            .otherwise(F.regexp_replace(s, "[0-9]+", "{n}")))


def typed_segments(path: Column) -> Column:
    """All segments of a path with their variable parts typed."""
    parts = F.split(path, "/", -1)
    return F.transform(F.slice(parts, 2, F.size(parts)), _segment)


def _level(tree: DataFrame, level: int) -> DataFrame:
    """tree(host, segments, path, n, blocked, labelled, vote) with ``path`` (the
    generalised segments so far) one level longer, ``vote`` the branch purity of
    the position, and of the branch taken: ``name``, ``b`` blocked of ``m`` labelled
    paths, ``open`` others."""
    tree = tree.withColumn("segment", F.coalesce(F.get("segments", F.lit(level)), F.lit(END)))
    kids = tree.groupBy("host", "path", "segment").agg(
        F.sum("n").alias("n"), F.sum("blocked").alias("b"), F.sum("labelled").alias("m"))
    voter = F.col("m") > 0
    nodes = kids.groupBy("host", "path").agg(
        F.sum("n").cast("double").alias("all_n"), F.sum(F.col("n") * F.col("n")).cast("double").alias("squares"),
        F.count(F.when(voter & (F.col("segment") != END), 1)).alias("alike"),
        F.sum("b").cast("double").alias("all_b"), F.sum("m").cast("double").alias("all_m"),
        F.count(F.when(voter, 1)).alias("voters"),
        F.sum(F.when(voter, F.expr("b * 1000 div m"))).alias("shares"))  # whole numbers: the same in any order
    b, m, all_b, all_m = F.col("b").cast("double"), F.col("m").cast("double"), F.col("all_b"), F.col("all_m")
    apart = (b * all_m - all_b * m) * (b * all_m - all_b * m)
    spread = F.col("all_n") * F.col("all_n") >= F.col("squares") * SPREAD
    name = (F.when(F.col("segment") == END, F.col("segment"))
            .when(spread & (F.col("n") * COMMON < F.col("all_n")), F.lit("*"))
            .when((F.col("alike") >= 2) & voter & (apart <= all_b * (all_m - all_b) * m * CHI), F.lit("~"))
            .otherwise(F.col("segment")))
    named = kids.join(nodes, ["host", "path"]).withColumn("name", name)
    sums = named.groupBy("host", "path", "name").agg(
        F.sum("b").alias("b"), F.sum("m").alias("m"), F.sum(F.col("n") - F.col("m")).alias("open"))
    taken = named.select("host", "path", "segment", "name", "voters", "shares").join(sums, ["host", "path", "name"])
    vote = F.when(F.col("voters") > 0, (F.col("shares") + 1000).cast("double") / (F.col("voters") * 1000 + 2000))
    return tree.join(taken, ["host", "path", "segment"]).select(
        "host", "segments", F.concat_ws("/", "path", "name").alias("path"), "n", "blocked", "labelled",
        F.coalesce(vote, F.col("vote")).alias("vote"), "name", "b", "m", "open")


def template_tree(pages: DataFrame) -> DataFrame:
    """host, segments, path (generalised up to where the labels end), purity of
    each distinct template of pages(host, path, verdict: block, allow or null)
    that has a page without a verdict and a label in its host."""
    paths = pages.select("host", "path", "verdict").distinct().withColumn("segments", typed_segments(F.col("path")))
    tree = paths.groupBy("host", "segments").agg(
        F.lit("").alias("path"), F.count("*").alias("n"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked"),
        F.count("verdict").alias("labelled"), F.lit(0.5).alias("vote"))
    mixed = tree.groupBy("host").agg(F.sum("labelled").alias("m"), F.sum("n").alias("all")).where("m > 0 and m < all")
    tree = materialize(tree.join(mixed.select("host"), "host", "left_semi"), "templates")
    done = []
    level = 0
    while not tree.isEmpty():
        step = materialize(_level(tree, level), "templates")
        ended = (F.col("m") == 0) | (F.col("name") == END)
        purity = F.when(F.col("m") == 0, F.col("vote")).otherwise(
            (F.col("b") + F.col("vote") * 2) / (F.col("m") + 2))
        done.append(step.where(ended & (F.col("n") > F.col("labelled"))).select(
            "host", "segments", "path", purity.alias("purity")))
        tree = step.where(~ended & (F.col("open") > 0)).drop("name", "b", "m", "open")
        level += 1
    out = tree.select("host", "segments", "path", F.col("vote").alias("purity"))  # no rows
    for part in done:
        out = out.unionByName(part)
    return out


def judge(pages: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of pages(page_id, url)."""
    rules = RULES if rules is None else rules
    host, path = split_url(F.col("url"))
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumn("rule", rule).withColumn("verdict", verdict)
    bad = template_tree(parsed).where(F.col("purity") >= PURITY).select(
        F.col("host").alias("bad_host"), F.col("segments").alias("bad_segments"))
    columns = ("page_id", "host", "path", "rule", "verdict")
    ruled = parsed.where("rule is not null").select(*columns)
    rest = parsed.where("rule is null").withColumn("segments", typed_segments(F.col("path"))).join(
        bad, (F.col("host") == F.col("bad_host")) & (F.col("segments") == F.col("bad_segments")), "left")
    rest = rest.withColumn("verdict", F.when(F.col("bad_host").isNull(), F.lit("allow")).otherwise("block"))
    return ruled.unionByName(rest.select(*columns))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def sql(known: dict[str, str]) -> str:
    """The same in DuckDB, for tables that mix labels down to SQL_LEVELS levels."""
    rules = []
    for rule in sorted(known, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        rules.append(f"WHEN (host = '{name}' OR host LIKE '%.{name}') AND starts_with(path, '{slash + rest}') THEN '{rule}'")
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in known.items())
    out = [f"""
WITH a AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS h, coalesce(rest, '') AS rest FROM a
), c AS (
  SELECT page_id, translate(h, '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM b
), d AS (SELECT *, CASE {' '.join(rules)} END AS rule FROM c
), parsed AS MATERIALIZED (
  SELECT *, CASE rule {verdicts} END AS rule_verdict,
    list_transform(string_split(path, '/')[2:], lambda s: CASE
      WHEN regexp_matches(s, '^[0-9a-f]*[0-9][0-9a-f]*[a-f][0-9a-f]*$') AND length(s) >= 8 THEN '{{x}}'
      WHEN length(s) >= 25 OR regexp_matches(s, '-.*-.*-') THEN '{{s}}'
      ELSE regexp_replace(s, '[0-9]+', '{{n}}', 'g') END) AS segments
  FROM d
), t0 AS MATERIALIZED (
  SELECT host, segments, '' AS path, count(*) AS n, count(*) FILTER (rule_verdict = 'block') AS blocked,
         count(rule_verdict) AS labelled, CAST(0.5 AS DOUBLE) AS vote
  FROM (SELECT DISTINCT host, path, segments, rule_verdict FROM parsed) GROUP BY host, segments
)"""]
    for i in range(1, SQL_LEVELS + 1):
        out.append(f""", k{i} AS MATERIALIZED (
  SELECT host, path, coalesce(segments[{i}], '{END}') AS segment, CAST(sum(n) AS BIGINT) AS n,
         CAST(sum(blocked) AS BIGINT) AS b, CAST(sum(labelled) AS BIGINT) AS m FROM t{i - 1} GROUP BY ALL
), g{i} AS (
  SELECT host, path, CAST(sum(n) AS DOUBLE) AS all_n, CAST(sum(n * n) AS DOUBLE) AS squares,
         count(*) FILTER (m > 0 AND segment <> '{END}') AS alike, CAST(sum(b) AS DOUBLE) AS all_b,
         CAST(sum(m) AS DOUBLE) AS all_m, count(*) FILTER (m > 0) AS voters,
         CAST(sum(CASE WHEN m > 0 THEN b * 1000 // m END) AS BIGINT) AS shares
  FROM k{i} GROUP BY host, path
), s{i} AS MATERIALIZED (
  SELECT host, path, segment, n, b, m, voters, shares, CASE WHEN segment = '{END}' THEN segment
    WHEN all_n * all_n >= squares * {SPREAD} AND n * {COMMON} < all_n THEN '*'
    WHEN alike >= 2 AND m > 0
      AND (b * all_m - all_b * m) * (b * all_m - all_b * m) <= all_b * (all_m - all_b) * m * {CHI} THEN '~'
    ELSE segment END AS name
  FROM k{i} JOIN g{i} USING (host, path)
), u{i} AS (
  SELECT host, path, name, CAST(sum(b) AS BIGINT) AS b, CAST(sum(m) AS BIGINT) AS m, CAST(sum(n - m) AS BIGINT) AS open
  FROM s{i} GROUP BY host, path, name
), w{i} AS MATERIALIZED (
  SELECT t.host, t.segments, t.path || '/' || s.name AS path, t.n, t.blocked, t.labelled, s.name, u.b, u.m, u.open,
         CASE WHEN s.voters > 0 THEN CAST(s.shares + 1000 AS DOUBLE) / (s.voters * 1000 + 2000) ELSE t.vote END AS vote
  FROM t{i - 1} t JOIN s{i} s ON s.host = t.host AND s.path = t.path AND s.segment = coalesce(t.segments[{i}], '{END}')
  JOIN u{i} u ON u.host = s.host AND u.path = s.path AND u.name = s.name
), t{i} AS MATERIALIZED (
  SELECT host, segments, path, n, blocked, labelled, vote FROM w{i} WHERE m > 0 AND name <> '{END}' AND open > 0
)""")
    done = " UNION ALL ".join(
        f"SELECT host, segments, CASE WHEN m = 0 THEN vote ELSE (b + vote * 2) / (m + 2) END AS purity FROM w{i} "
        f"WHERE (m = 0 OR name = '{END}') AND n > labelled" for i in range(1, SQL_LEVELS + 1))
    return "".join(out) + f""", bad AS (SELECT host, segments FROM ({done}) WHERE purity >= {PURITY})
SELECT p.page_id, p.host, p.path, p.rule,
       coalesce(p.rule_verdict, CASE WHEN bad.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM parsed p LEFT JOIN bad ON bad.host = p.host AND bad.segments = p.segments
"""


OP10_SQL = sql(RULES)
