"""Drop lines that too large a share of a site's pages carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.session import store


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(text: Column) -> Column:
    """One key per distinct line that is not blank."""
    lines = F.filter(_lines(text), lambda line: F.trim(line) != "")
    return F.array_distinct(F.transform(lines, _key))


def boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.02,
    min_pages: int = 5, distinct: bool = False,
) -> DataFrame:
    """(host, line_keys): the lines on more than `ratio` of the host's pages and `min_pages` or more.

    A page is a row or, if `distinct`, a text: rows of a host with equal texts are one page, as texts
    and in the host's total. They are combined before the shuffle, so a large group of copies is
    one row per task. A host has at most (distinct lines per page) / ratio such lines, so its row stays small however
    many pages it has. Lines are counted before the shuffle and spread by (host, line).
    """
    pages = docs.select(F.col(host).alias("host"), _keys(F.col(text)).alias("keys"), F.xxhash64(text).alias("page"))
    if distinct:
        pages = store(pages.groupBy("host", "page").agg(F.first("keys").alias("keys")), "distinct-pages")
    totals = store(pages.groupBy("host").agg(F.count("*").alias("pages")), "host-pages")
    counts = store(
        pages.select("host", F.explode_outer("keys").alias("key")).filter("key is not null").groupBy("host", "key")
        .agg(F.count("*").alias("with_line")).filter(F.col("with_line") >= min_pages), "line-pages")
    same_host = F.col("host").eqNullSafe(F.col("of_host"))
    frequent = counts.join(totals.withColumnRenamed("host", "of_host"), same_host).filter(
        F.col("with_line") > ratio * F.col("pages"))
    return frequent.groupBy("host").agg(F.collect_list("key").alias("line_keys"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.02,
    min_pages: int = 5, distinct: bool = False,
) -> DataFrame:
    """All rows and columns, with boilerplate lines removed from the text; adds `n_lines_dropped`.

    A page is a row: repeated rows count as pages of their own, so a large group of copies loses all
    its lines. With `distinct`, equal texts of a host are one page and copies keep theirs. Lines are compared without spaces at
    their ends; blank lines are never dropped, not even between dropped ones. Rows with a null host
    form one host. A null text stays null. A text may become empty. An input column named like the
    added one is replaced.

    The stored table of boilerplate has a known size, so the planner broadcasts it only if it is
    small; otherwise rows meet it by host, and a hot host is split at run time.
    """
    common = store(
        boilerplate(docs, host, text, ratio, min_pages, distinct)
        .select(F.col("host").alias("_of_host"), F.col("line_keys").alias("_line_keys")),
        "boilerplate")
    joined = docs.join(common, docs[host].eqNullSafe(common["_of_host"]), "left")
    # Few of a host's boilerplate lines are on one page.
    here = F.array_intersect(_keys(F.col(text)), F.col("_line_keys"))
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda line: (F.trim(line) == "") | ~F.array_contains(
        F.col("_here"), _key(line)))
    joined = joined.withColumn("_here", here)
    cleaned = F.when(F.size("_here") > 0, F.array_join(kept, "\n")).otherwise(F.col(text))
    dropped = F.when(F.size("_here") > 0, F.size(lines) - F.size(kept)).otherwise(F.lit(0))
    return joined.select(
        *[cleaned.alias(text) if c == text else F.col(c) for c in docs.columns
          if c != "n_lines_dropped"],
        dropped.cast("long").alias("n_lines_dropped"))


def check_sql(ratio: float = 0.02, min_pages: int = 5) -> str:
    """The same over `documents`, for a plain SQL engine."""
    return f"""
    WITH lines AS (
      SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
      FROM documents),
    seen AS (SELECT DISTINCT doc_id, source, trim(line) AS line FROM lines WHERE trim(line) <> ''),
    totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
    frequent AS (
      SELECT s.source, s.line FROM seen s JOIN totals t ON s.source IS NOT DISTINCT FROM t.source
      GROUP BY s.source, s.line, t.pages
      HAVING count(*) >= {min_pages} AND count(*) > {ratio} * t.pages),
    marked AS (
      SELECT l.doc_id, l.pos, l.line, f.line IS NOT NULL AS dropped
      FROM lines l LEFT JOIN frequent f
        ON l.source IS NOT DISTINCT FROM f.source AND trim(l.line) = f.line),
    texts AS (
      SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped) AS cleaned,
             CAST(count(*) FILTER (dropped) AS BIGINT) AS n_lines_dropped
      FROM marked GROUP BY doc_id)
    SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.cleaned, '') END AS text,
           t.n_lines_dropped
    FROM documents d JOIN texts t ON d.doc_id = t.doc_id
    """
