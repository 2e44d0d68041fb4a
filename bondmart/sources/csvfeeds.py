"""CSV feed ingest (S1 strict arity, S2 header handling, S3 GBK).

A feed file is read as lines (distributed, one split per block), then each
line is checked and parsed JVM-side:

* arity (S1): number of fields = 1 + commas outside double quotes; a line
  is kept only with exactly the layout's field count;
* required cells: non-NULL and non-empty (empty unquoted cells parse as
  NULL);
* types: dates strictly ``yyyy-MM-dd`` (invalid days rejected, not rolled
  over), decimals by ``try_cast``; a required cell that fails its type is a
  rejected line.

``read_records`` puts records together whose quoted cells hold line breaks.
A line with bytes that its encoding doesn't know is rejected with their offset.
A line is dropped as a header only if it equals the feed's header text, so a
dump of several parts, with a header in some of them or in none, loses no data
row. ``load`` returns the rejected lines of all feeds with their feed name;
the nightly job counts them in its data-quality table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bondmart.functions.scalars import parse_date
from bondmart.session import snapshot
from bondmart.sources.feeds import LAYOUTS, Feeds

LINE = "value"


def token_count(line: Column) -> Column:
    """Fields in an RFC-4180 line: quoted sections cannot hold separators. A
    doubled quote is two adjacent sections, which hold the same commas. After
    an unbalanced quote the rest of the line counts as unquoted."""
    unquoted = F.regexp_replace(line, r'"[^"]*+"', "q")
    return F.size(F.split(unquoted, ",", -1))


def read_lines(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Lines of text files as column ``value``; with an ``encoding`` (e.g. GBK,
    S3) decoded strictly, see ``decoded``."""
    lines = spark.read.text(path)
    if encoding is None or encoding.upper().replace("-", "") == "UTF8":
        return lines
    return decoded(lines, encoding)


MAX_RECORD_LINES = 1000


def read_records(spark: SparkSession, path: str, max_lines: int = MAX_RECORD_LINES) -> tuple[DataFrame, DataFrame]:
    """Records of CSV files whose quoted cells may hold line breaks, wherever
    the files are cut into splits.

    A line begins a record if the quotes before it in its file are even in
    number. Each split's parity is counted on its own, a prefix sum over the
    splits of a file gives the parity at each split's start, and a second pass
    numbers the records; only lines of records with several lines are brought
    together. Returns (value) and the lines of stretches of over ``max_lines``
    lines, which an unclosed quote opens: (value, reason).
    """
    lines = snapshot(spark.read.option("lineSep", "\n").text(path).select(
        LINE, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id")), "lines")  # stored, as row ids must not change
    quotes = F.length(LINE) - F.length(F.replace(LINE, F.lit('"'), F.lit("")))
    lines = lines.withColumn("quotes", quotes)
    in_file, earlier = Window.partitionBy("file").orderBy("block"), (Window.unboundedPreceding, -1)

    def before_blocks(per_block: DataFrame, name: str) -> DataFrame:
        """The sum of a count over a file's earlier splits; a row a split."""
        return per_block.select("file", "block", F.coalesce(F.sum(name).over(in_file.rowsBetween(*earlier)), F.lit(0)).alias(name))

    opened = before_blocks(lines.groupBy("file", "block").agg(F.sum("quotes").alias("open")), "open")
    in_block = Window.partitionBy("file", "block").orderBy("id")
    before = F.coalesce(F.sum("quotes").over(in_block.rowsBetween(*earlier)), F.lit(0))
    lines = lines.withColumn("before", before).join(opened, ["file", "block"])
    lines = lines.withColumn("begins", ((F.col("open") + F.col("before")) % 2 == 0).cast("int"))
    whole = (F.col("begins") == 1) & (F.col("quotes") % 2 == 0)
    begun = before_blocks(lines.groupBy("file", "block").agg(F.sum("begins").alias("begun")), "begun")
    numbered = lines.withColumn("nth", F.sum("begins").over(in_block)).where(~whole).join(begun, ["file", "block"])
    parts = numbered.select("file", (F.col("begun") + F.col("nth")).alias("record"), "block", "id", LINE)
    sizes = parts.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.join(sizes, ["file", "record"])
    several = parts.where(F.col("n") <= max_lines).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "id", LINE))).alias("p"))  # at most max_lines lines
    value = F.array_join(F.transform("p", lambda x: x[LINE]), "\n")
    plain = lines.where(whole).select(LINE).unionByName(several.select(value.alias(LINE)))
    return (plain.select(F.regexp_replace(LINE, "\r$", "").alias(LINE)),
            parts.where(F.col("n") > max_lines).select(LINE, F.lit("open quote").alias("reason")))


def decoded(lines: DataFrame, encoding: str) -> DataFrame:
    """S3: (value, bad_at) of lines whose bytes are in ``encoding``: ``bad_at``
    is the offset of the first byte that isn't a character (null: none), and
    such a line's value has its bad bytes as \\xNN, never replacement characters.

    The text reader hands a line's bytes through as they are (in GBK no
    character holds a line feed). Spark's own ``decode`` knows such charsets only
    under a switch for the whole session, hence an Arrow UDF.
    """

    @F.pandas_udf("value string, bad_at long")
    def strictly(raw: pd.Series) -> pd.DataFrame:
        out = []
        for b in raw:
            try:
                out.append((bytes(b).decode(encoding), None))
            except UnicodeDecodeError as e:
                out.append((bytes(b).decode(encoding, "backslashreplace"), e.start))
        return pd.DataFrame({"value": [t for t, _ in out], "bad_at": pd.array([at for _, at in out], "Int64")})

    return lines.select(strictly(F.col(LINE).cast("binary")).alias("_d")).select("_d.value", "_d.bad_at")


def encoded(lines: DataFrame, encoding: str) -> DataFrame:
    """Lines as strings that hold the bytes of ``encoding``, for the text writer."""

    @F.pandas_udf("binary")
    def raw(text: pd.Series) -> pd.Series:
        return text.map(lambda t: t.encode(encoding))

    return lines.select(raw(LINE).cast("string").alias(LINE))


def header_text(name: str) -> str:
    """The header line of a feed without a text of its own: its column names."""
    return ",".join(c for c, _ in LAYOUTS[name]["columns"])


def _typed(raw: Column, typ: str) -> Column:
    if typ == "date":
        return parse_date(raw)
    if typ.startswith("decimal"):
        return raw.try_cast(typ)
    return raw


def parse_lines(lines: DataFrame, name: str, line_col: str = LINE,
                header_line: str | None = None, drop_containing: str | None = None,
                rejects: bool = False, keep: tuple[str, ...] = ()):
    """Parse feed lines into the typed layout of ``name``.

    ``header_line``: header text to drop (S2), compared without case. ``drop_containing``:
    opt-in reproduction of the original jobs' header test, which drops every
    line containing the token (data rows included). ``keep``: columns of
    ``lines`` carried along. Returns the typed
    DataFrame, or (typed, rejected lines) when ``rejects``; rejected lines have
    their ``keep`` columns and a reason (arity, or the first bad column).
    """
    layout = LAYOUTS[name]
    cols = layout["columns"]
    n = len(cols)
    req = layout.get("required")
    req = list(range(n)) if req is None else req
    line = F.col(line_col)
    x = lines.select(line.alias(LINE), *keep).filter(F.length(LINE) > 0)
    if header_line is not None:
        x = x.filter(F.lower(F.trim(LINE)) != header_line.strip().lower())
    if drop_containing:
        x = x.filter(~F.col(LINE).contains(drop_containing))
    schema = ", ".join(f"_{i} string" for i in range(n))
    p = x.select(
        F.col(LINE), *keep, token_count(F.col(LINE)).alias("_n"),
        # only lines of the right arity are parsed; quotes are doubled inside quotes
        F.from_csv(F.when(token_count(F.col(LINE)) == n, F.col(LINE)), schema,
                   {"mode": "PERMISSIVE", "escape": '"'}).alias("_r"),
    )
    typed = [_typed(F.col(f"_r._{i}"), t).alias(c) for i, (c, t) in enumerate(cols)]
    p = p.select(F.col(LINE), *keep, "_n", *[F.col(f"_r._{i}").alias(f"_raw{i}") for i in range(n)], *typed)
    ok = F.col("_n") == n
    for i in req:
        c = cols[i][0]
        ok = ok & F.col(f"_raw{i}").isNotNull() & (F.col(f"_raw{i}") != "") & F.col(c).isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    good = p.filter(ok).select(*[c for c, _ in cols], *keep)
    if not rejects:
        return good
    bad = [F.when(~F.coalesce((F.col(f"_raw{i}") != "") & F.col(cols[i][0]).isNotNull(), F.lit(False)), F.lit(cols[i][0]))
           for i in req]
    reason = F.coalesce(F.when(F.col("_n") != n, F.lit("arity")), *bad)
    return good, p.filter(~ok).select(LINE, *keep, reason.alias("reason"))


def read_feed(spark: SparkSession, name: str, path: str, header: str | None = None,
              encoding: str | None = None, drop_containing: str | None = None, rejects: bool = False):
    """One feed file/folder -> typed DataFrame (and rejected lines)."""
    lines = read_lines(spark, path, encoding)
    if "bad_at" not in lines.columns:
        return parse_lines(lines, name, header_line=header or header_text(name), drop_containing=drop_containing, rejects=rejects)
    sound = parse_lines(lines.where("bad_at is null"), name, header_line=header or header_text(name),
                        drop_containing=drop_containing, rejects=rejects)
    if not rejects:
        return sound
    bad = lines.where("bad_at is not null").select(LINE, F.concat(F.lit("byte "), F.col("bad_at").cast("string")).alias("reason"))
    return sound[0], sound[1].unionByName(bad)


def load(spark: SparkSession, paths: dict[str, str], headers: dict[str, str] | None = None,
         encoding: str | None = None) -> tuple[Feeds, DataFrame]:
    """All fifteen feeds from CSV dumps (``paths``: feed name -> path;
    ``headers``: header text of feeds whose header isn't their column names),
    and the rejected lines of all of them as (feed, line)."""
    headers, feeds, rejected = headers or {}, {}, []
    for name in Feeds.names():
        feeds[name], bad = read_feed(spark, name, paths[name], headers.get(name), encoding, rejects=True)
        rejected.append(bad.select(F.lit(name).alias("feed"), F.col(LINE).alias("line")))
    out = rejected[0]
    for r in rejected[1:]:
        out = out.unionByName(r)
    return Feeds(**feeds), out


def dump(feeds: Feeds, root: str, header: bool = True) -> dict[str, str]:
    """Write feeds as CSV dumps, one folder per feed; the paths for ``load``.
    Columns of a layout that a feed lacks are written as ``x``."""
    paths = {}
    for name in Feeds.names():
        df = getattr(feeds, name)
        cols = [(F.col(c) if c in df.columns else F.lit("x")).cast("string").alias(c)
                for c, _ in LAYOUTS[name]["columns"]]
        paths[name] = f"{root.rstrip('/')}/{name}"
        df.select(*cols).write.option("header", header).option("escape", '"').option("emptyValue", "").csv(paths[name])
    return paths
