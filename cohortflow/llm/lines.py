"""Line dedup by site-relative frequency (DataFrame functions only).

Pages are grouped by host; a line's ratio is the number of the host's distinct
pages that contain it over the number of the host's distinct pages.  Lines whose
ratio is over ``max_ratio`` on at least ``min_pages`` pages are boilerplate and go
from every page of that host.  Two things make the evidence sound:

* The ratio that is compared is the lower end of its confidence interval (Wilson,
  one standard error), so three of fifty pages prove less than 30 of 500.
* Near copies are one page.  A page of which more than ``REPEATED`` of the lines
  are candidates repeats other pages as a whole; all such pages of a host
  together count once, in a line's pages and in the host's, and the lines are
  judged again.

A line is what stands between two ``\\n``; it is compared without the spaces,
tabs and returns around it.  Blank lines are never counted and never dropped.
Pages whose host and text are equal count once (a page copied a thousand times
is one page), so repeated rows change nothing.  A null host is a host of its
own; null text stays null and has no lines.  A kept line is returned unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import col, fresh, materialize

MAX_RATIO = 0.05
MIN_PAGES = 3
#: Share of a page's distinct lines beyond which it is a copy, not a user, of them.
REPEATED = 2 / 3
#: A host's boilerplate lines are broadcast while all of them together take no
#: more than this (16 bytes a line); beyond it they are joined by host.
BROADCAST_BYTES = 32 << 20


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def _key(line: Column) -> Column:
    """128 bits that stand for a trimmed line."""
    t = _trimmed(line)
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(t, F.lit("line")).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _lower_ratio() -> Column:
    """Lower end of the interval of n / pages."""
    n, p = F.col("pages").cast("double"), F.col("n") / F.col("pages")
    return (p + 0.5 / n - F.sqrt(p * (1 - p) / n + 0.25 / (n * n))) / (1 + 1 / n)


def _per_host(counts: DataFrame, totals: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    """(host, keys, heads) of the lines that pass, from (host, key, n), (host, pages)."""
    return (
        counts.where(F.col("n") >= min_pages).withColumnRenamed("host", "h").join(totals, F.col("h").eqNullSafe(F.col("host")))
        .where(_lower_ratio() > max_ratio)
        .groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("keys"))
        .withColumn("heads", F.transform("keys", lambda k: k["a"]))
    )


def _with_side(df: DataFrame, host: Column, found: DataFrame, name: str, how: str = "left") -> DataFrame:
    """``df`` plus its host's row of the written ``found``, as a struct."""
    size = found.agg(F.sum(F.size("keys")) * 24 + F.sum(F.coalesce(F.length("host"), F.lit(0)) + 16)).first()[0] or 0
    side = found.select(F.struct("host", "keys", "heads").alias(name))
    if size <= BROADCAST_BYTES:
        side = F.broadcast(side)
    return df.join(side, host.eqNullSafe(F.col(name)["host"]), how)


def boilerplate_lines(docs: DataFrame, host_col: str, text_col: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, keys, heads): per host with boilerplate, the sorted keys of its
    lines.  A host has fewer than (mean lines a page) / max_ratio of them, so
    the arrays are bounded whatever the host's size."""
    pages = docs.select(col(host_col).cast("string").alias("host"), col(text_col).cast("string").alias("text"))
    text_key = (F.xxhash64("text"), F.xxhash64("text", F.lit("page")))
    once = materialize(
        pages.select("host", *(k.alias(n) for k, n in zip(text_key, "pq", strict=True)), F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: _trimmed(x) != ""), _key)).alias("keys"))
        .groupBy("host", "p", "q").agg(F.first("keys").alias("keys"))
    )
    totals = once.groupBy("host").agg(F.count("*").alias("pages"))
    counts = once.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n"))
    candidates = materialize(_per_host(counts, totals, max_ratio, min_pages))
    # pages of hosts with candidates, and which of their lines are candidates
    mine = _with_side(once.select("host", "keys"), F.col("host"), candidates, "c", "inner")
    known = F.filter("keys", lambda k: F.array_contains(F.col("c")["heads"], k["a"]) & F.array_contains(F.col("c")["keys"], k))
    mine = mine.select("host", F.size("keys").alias("size"), known.alias("known"))
    mine = mine.withColumn("copy", F.size("known") > F.col("size") * F.lit(REPEATED))
    alone = F.count_if(~F.col("copy")) + F.max(F.col("copy").cast("long"))
    totals = mine.groupBy("host").agg(alone.alias("pages"))
    counts = mine.select("host", "copy", F.explode("known").alias("key")).groupBy("host", "key").agg(alone.alias("n"))
    return _per_host(counts, totals, max_ratio, min_pages)


def with_boilerplate(docs: DataFrame, host_col: str, text_col: str, name: str, **params) -> DataFrame:
    """``docs`` plus column ``name``: struct(host, keys, heads) or null."""
    found = materialize(boilerplate_lines(docs, host_col, text_col, **params))
    return _with_side(docs, col(host_col).cast("string"), found, name)


def kept_lines(text: Column, found: Column) -> Column:
    """The lines of ``text`` that are not among the host's boilerplate."""

    def keep(x: Column) -> Column:
        t = _trimmed(x)
        return (t == "") | ~(F.array_contains(found["heads"], F.xxhash64(t)) & F.array_contains(found["keys"], _key(x)))

    return F.when(found["host"].isNull() & found["keys"].isNull(), _lines(text)).otherwise(F.filter(_lines(text), keep))


def dedup_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, n_chars_col: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with boilerplate lines taken out of the
    text (``n_chars_col``, if given, becomes the new length)."""
    name, kept = fresh(docs, "boilerplate", "kept")
    out = with_boilerplate(docs, host_col, text_col, name, max_ratio=max_ratio, min_pages=min_pages)
    cols = {text_col: F.array_join(kept_lines(col(text_col).cast("string"), F.col(name)), "\n")}
    out = out.withColumns(cols)
    if n_chars_col:
        out = out.withColumn(n_chars_col, F.char_length(col(text_col)).cast("long"))
    return out.select(*map(col, docs.columns))


def line_report(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", **params) -> DataFrame:
    """One row per page: id, host, n_lines, n_dropped, and the text that stays."""
    base = docs.select(col(id_col).alias("doc_id"), col(host_col).cast("string").alias("source"), col(text_col).cast("string").alias("text"))
    out = with_boilerplate(base, "source", "text", "found", **params).withColumn("kept", kept_lines(F.col("text"), F.col("found")))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines(F.col("text"))))
    return out.select(
        "doc_id", "source", n.cast("long").alias("n_lines"),
        (n - F.when(F.col("kept").isNull(), 0).otherwise(F.size("kept"))).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )


#: DuckDB SQL for ``line_report`` over ``documents`` with the default parameters.
LINE_REPORT_SQL = f"""
WITH pages AS (SELECT DISTINCT source, text FROM documents),
totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
lines AS (SELECT DISTINCT source, text, trim(l, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS line
          FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS l FROM pages)),
own AS (SELECT source, text, line FROM lines WHERE line <> ''),
first_pass AS (SELECT l.source, l.line FROM (SELECT source, line, count(*) AS n FROM own GROUP BY source, line) l
               JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
               WHERE n >= {MIN_PAGES} AND {{LOWER}} > {MAX_RATIO}),
pages2 AS (SELECT o.source, o.text, count(f.line) > count(*) * {REPEATED!r}::DOUBLE AS copy
           FROM own o LEFT JOIN first_pass f ON o.source IS NOT DISTINCT FROM f.source AND o.line = f.line GROUP BY o.source, o.text),
-- pages without a line of their own are no copies
totals2 AS (SELECT t.source, t.pages - coalesce(c.n, 0) + (coalesce(c.n, 0) > 0)::BIGINT AS pages
            FROM totals t LEFT JOIN (SELECT source, count(*) AS n FROM pages2 WHERE copy GROUP BY source) c ON t.source IS NOT DISTINCT FROM c.source),
boiler AS (SELECT l.source, l.line
           FROM (SELECT o.source, o.line, count(*) FILTER (WHERE NOT p.copy) + max(p.copy::BIGINT) AS n
                 FROM own o JOIN first_pass f ON o.source IS NOT DISTINCT FROM f.source AND o.line = f.line
                 JOIN pages2 p ON o.source IS NOT DISTINCT FROM p.source AND o.text = p.text GROUP BY o.source, o.line) l
           JOIN totals2 t ON l.source IS NOT DISTINCT FROM t.source
           WHERE n >= {MIN_PAGES} AND {{LOWER}} > {MAX_RATIO}),
per_host AS (SELECT source, list(line) AS bad FROM boiler GROUP BY source)
SELECT d.doc_id, d.source, len(string_split(d.text, chr(10)))::BIGINT AS n_lines,
       (len(string_split(d.text, chr(10))) - len(k))::BIGINT AS n_dropped, array_to_string(k, chr(10)) AS text
FROM (SELECT d.*, list_filter(string_split(d.text, chr(10)), lambda x: coalesce(NOT list_contains(h.bad, trim(x, chr(32) || chr(9) || chr(13) || chr(11) || chr(12))), true)) AS k
      FROM documents d LEFT JOIN per_host h ON d.source IS NOT DISTINCT FROM h.source) d
""".replace(
    "{LOWER}", "(n / pages + 0.5 / pages - sqrt(n / pages * (1 - n / pages) / pages + 0.25 / (pages * pages))) / (1 + 1 / pages)"
)
