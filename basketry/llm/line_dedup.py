"""Boilerplate lines of a site: lines that stand on a large share of its pages.

Per host, the pages that hold a line are counted and divided by the pages of the host; lines beyond the
ratio are dropped from all pages of that host, the rest of the page stays as it is.

Defined cases: lines are the parts between line feeds, compared exactly (by a 64-bit hash within their
host). Blank lines never count and always stay. A page that holds a line twice counts once; both go. A row
without host belongs to no site and keeps its text; a NULL text stays NULL with no lines. Every row is a
page, repeated rows too. A line on a single page is not repeated and stays, so a host of one page loses nothing. An
empty table gives an empty result. Other columns pass through under their own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .hot_join import join_spread

MAX_RATIO = 0.05
MIN_PAGES = 2  # the least that is repetition
_BLANK = "^[\\x20\\x09-\\x0D]*$"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(docs: DataFrame, host_col: str, text_col: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host with boilerplate: `_host` and `_dropped`, the hashes of its boilerplate lines.

    A host has fewer such lines than its mean number of lines per page divided by the ratio, so the array is
    small however large the host. All counts combine on the map side.
    """
    pages = docs.select(F.col(host_col).alias("_host"), F.col(text_col).alias("_text")).filter(F.col("_host").isNotNull())
    distinct = F.array_distinct(F.filter(_lines(F.col("_text")), lambda x: ~x.rlike(_BLANK)))
    # The outer form: the inner one gets an inferred filter that would split every text once more.
    lines = pages.select("_host", F.explode_outer(F.transform(distinct, lambda x: F.xxhash64(x))).alias("_line"))
    counts = lines.groupBy("_host", "_line").agg(F.count("_line").alias("_pages"))
    counts = counts.filter(F.col("_line").isNotNull() & (F.col("_pages") >= min_pages))
    totals = pages.groupBy("_host").agg(F.count("*").alias("_total"))
    frequent = counts.join(totals, "_host").filter(F.col("_pages") > F.lit(max_ratio) * F.col("_total"))
    return frequent.groupBy("_host").agg(F.collect_list("_line").alias("_dropped"))


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    length_col: str | None = None,
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    counts: bool = False,
) -> DataFrame:
    """`docs` with boilerplate lines taken out of `text_col`; `length_col`, if given, follows the new text.

    With `counts`, the columns n_lines and n_dropped are added (in place of columns so named).
    """
    found = boilerplate(docs, host_col, text_col, max_ratio, min_pages)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), F.col(host_col).alias("_host"))
    rows = join_spread(rows, found, "_host")
    lines = _lines(F.col("_row")[text_col])
    kept = F.filter(lines, lambda x: x.rlike(_BLANK) | ~F.array_contains("_dropped", F.xxhash64(x)))
    text = F.when(F.col("_dropped").isNull(), F.col("_row")[text_col]).otherwise(F.array_join(kept, "\n"))
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    n_kept = F.when(F.col("_dropped").isNull(), n_lines).otherwise(F.coalesce(F.size(kept), F.lit(0)).cast("long"))
    made = {text_col: text}
    if length_col:
        changed = F.col("_dropped").isNotNull() & F.col("_row")[text_col].isNotNull()
        kind = docs.schema[length_col].dataType
        made[length_col] = F.when(changed, F.length(text).cast(kind)).otherwise(F.col("_row")[length_col])
    if counts:
        made |= {"n_lines": n_lines, "n_dropped": n_lines - n_kept}
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"] if counts else docs.columns
    return rows.select(*[made.get(c, F.col("_row")[c]).alias(c) for c in columns])


def op9_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "source", "text")
    return drop_boilerplate(docs, counts=True)


OP9_SQL = f"""
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS at
    FROM documents
), site AS (
    SELECT source, count(*) AS total FROM documents GROUP BY source
), shared AS (
    SELECT source, line, count(DISTINCT doc_id) AS pages
    FROM lines WHERE NOT regexp_full_match(line, '[\\x20\\x09-\\x0D]*') GROUP BY source, line
), boiler AS (
    SELECT source, line FROM shared JOIN site USING (source)
    WHERE pages >= {MIN_PAGES} AND pages > {MAX_RATIO}::DOUBLE * total
), cleaned AS (
    SELECT l.doc_id, count(*) AS n_lines, count(b.line) AS n_dropped,
           string_agg(l.line, chr(10) ORDER BY l.at) FILTER (WHERE b.line IS NULL) AS text
    FROM lines l LEFT JOIN boiler b ON b.source = l.source AND b.line = l.line
    GROUP BY l.doc_id
)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NOT NULL THEN coalesce(c.text, '') END AS text,
       coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN cleaned c USING (doc_id)
"""
