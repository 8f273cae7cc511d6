"""Substring dedup by De Bruijn compaction: long spans of words that also stand
in a document with a smaller id.

Edges are windows of ``window`` consecutive words.  The graph is never built
word by word: consecutive edges of a document that share a minimizer (the
smallest hash among their ``anchor``-word grams) form a path piece, so equal
edges always meet under the same minimizer.

1. One pass over the texts writes each document's pieces.
2. Pieces whose minimizer stands in one document only leave (a join).
3. Equal pieces become one, with its first source (smallest id, place): a
   nonbranching path.  A minimizer with several distinct pieces branches: there
   the edges of each piece's first source are taken apart, edges that also stand
   under a smaller id get that source, and runs of them on one source diagonal
   are compacted again.
4. Occurrences join their piece; runs that continue each other on the same
   diagonal are compacted into long repeated spans.
5. Source coordinates verify every span: the words at both places are digested
   (128 bits) and only equal spans count.

Groups are never gathered: a passage in a third of all documents is one piece
(plus its ends), pre-aggregated before each shuffle.

Nulls and ties: null text has no words; a null id sorts after all others;
documents with equal ids are neither smaller nor larger, so they never remove
each other's words; repeated rows get equal results.  Texts under one window
long are never touched.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import _mix, col, free_shuffles, fresh, materialize, minimizers, release, small_side, text_or_empty, window_hashes
from cohortflow.llm.texts import base_rows, covered, key_columns, over_texts, requested

WINDOW = 50
ANCHOR = 10
PIECES = "array<struct<m:long,p:long,start:int,n:int>>"


def _word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), ">u8").astype(np.uint64)


def pieces_of(words: list[bytes], window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(minimizer hash, piece hash, first edge, number of edges) arrays."""
    if len(words) < window:
        return (np.empty(0, np.int64),) * 4
    v = _word_hashes(words)
    grams, edges = window_hashes(v, anchor), window_hashes(v, window)
    at = minimizers(grams, window - anchor + 1)
    start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    stop = np.append(start[1:], len(at)) - 1
    # first and last edge cover the whole piece: it has at most window - anchor + 1 edges
    piece = _mix(_mix(edges[start], edges[stop]), (stop - start).astype(np.uint64))
    return grams[at[start]].view(np.int64), piece.view(np.int64), start, stop - start + 1


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """One row per document: n_words, sha256 of its words, its pieces."""

    def one(text: bytes, _) -> tuple:
        words = text.split()
        cols = [x.tolist() for x in pieces_of(words, window, anchor)]
        return len(words), hashlib.sha256(b" ".join(words)).hexdigest(), [dict(zip(("m", "p", "start", "n"), r)) for r in zip(*cols)]

    return over_texts(base_rows(docs, id_col, text_col), one, f"n_words long, sha string, pieces {PIECES}")


def repeated_spans(docs: DataFrame, scanned: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(id, tag, lo, len, src, stag, slo): verified spans of words, compacted,
    that also start at ``slo`` of a document with a smaller id."""
    every = scanned.select("id", "tag", F.explode("pieces").alias("x")).select("id", "tag", "x.*")
    shared = materialize(every.groupBy("m").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("m"))
    found = materialize(every.join(small_side(shared, 8), "m"))
    free_shuffles(docs)
    first = F.min(F.struct("id", "tag", "start")).alias("s")
    paths = materialize(found.groupBy("m", "p").agg(first, F.max("id").alias("last"), F.first("n").alias("n")))
    branching = materialize(paths.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m"))

    # a whole piece stands at its first source
    runs = paths.where("s.id < last").select("m", "p", F.lit(0).alias("lo"), F.col("n").alias("len"), F.col("s.id").alias("src"), F.col("s.tag").alias("stag"), F.col("s.start").alias("slo"))

    # branching pieces: their edges, from the text of each piece's first source,
    # may stand in a document with a smaller id than the piece's
    ask = paths.join(small_side(branching, 8), "m").select("s.id", "s.tag", F.struct("m", "p", F.col("s.start").alias("start"), "n").alias("x"))

    def edges(text: bytes, request: list[dict]) -> tuple:
        h = window_hashes(_word_hashes(text.split()), window).view(np.int64)
        return ([{**r, "h": h[r["start"] : r["start"] + r["n"]].tolist()} for r in request],)

    taken = over_texts(requested(docs, ask, id_col, text_col, "x"), edges, "out array<struct<m:long,p:long,start:int,n:int,h:array<long>>>")
    taken = materialize(taken.select("id", "tag", F.explode("out").alias("x")).select("id", "tag", "x.m", "x.p", "x.start", F.posexplode("x.h").alias("off", "h")))
    free_shuffles(docs)
    several = materialize(taken.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("h"))
    both = materialize(taken.join(small_side(several, 8), "h"))
    origin = both.groupBy("h").agg(F.min(F.struct("id", "tag", (F.col("start") + F.col("off")).alias("at"))).alias("o"))
    edge = both.join(origin, "h").where("o.id < id").select("m", "p", "off", F.col("o.id").alias("src"), F.col("o.tag").alias("stag"), (F.col("o.at") - F.col("off")).alias("diag"))
    # runs of edges on one diagonal (a row listed twice asks twice: dense ranks)
    line = W.partitionBy("m", "p", "src", "stag", "diag").orderBy("off")
    edge = edge.withColumn("island", F.col("off") - F.dense_rank().over(line))
    edge = edge.groupBy("m", "p", "src", "stag", "diag", "island").agg(F.min("off").alias("lo"), (F.max("off") - F.min("off") + 1).alias("len"))
    runs = runs.unionByName(edge.select("m", "p", "lo", "len", "src", "stag", (F.col("diag") + F.col("lo")).alias("slo")))

    hits = found.join(runs, ["m", "p"]).where("src < id").select("id", "tag", (F.col("start") + F.col("lo")).alias("lo"), "len", "src", "stag", "slo").distinct()
    line = W.partitionBy("id", "tag", "src", "stag", F.col("slo") - F.col("lo")).orderBy("lo")
    hits = hits.withColumn("new", F.when(F.lag("lo").over(line) + F.lag("len").over(line) >= F.col("lo"), 0).otherwise(1))
    hits = hits.withColumn("diag", F.col("slo") - F.col("lo")).withColumn("part", F.sum("new").over(line))
    spans = hits.groupBy("id", "tag", "src", "stag", "diag", "part").agg(F.min("lo").alias("lo"), F.max(F.col("lo") + F.col("len")).alias("hi"))
    spans = spans.select("id", "tag", "lo", (F.col("hi") - F.col("lo") + (window - 1)).alias("len"), "src", "stag", (F.col("lo") + F.col("diag")).alias("slo"))
    spans = materialize(spans)
    release(found, paths, branching, taken, shared, several, both)
    free_shuffles(docs)
    return _verified(docs, spans, id_col, text_col)


def _verified(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The spans whose words are equal at both coordinates."""
    place = lambda i, t, lo: F.struct(F.col(i).alias("id"), F.col(t).alias("tag"), F.col(lo).alias("lo"), "len")
    ask = spans.select(place("id", "tag", "lo").alias("x")).union(spans.select(place("src", "stag", "slo").alias("x"))).distinct()

    def digests(text: bytes, request: list[dict]) -> tuple:
        words = text.split()
        return ([{"lo": r["lo"], "len": r["len"], "d": xxhash.xxh3_128_digest(b" ".join(words[r["lo"] : r["lo"] + r["len"]]))} for r in request],)

    rows = requested(docs, ask.select("x.id", "x.tag", F.struct("x.lo", "x.len").alias("x")), id_col, text_col, "x")
    got = materialize(over_texts(rows, digests, "out array<struct<lo:int,len:int,d:binary>>").select("id", "tag", F.explode("out").alias("x")).select("id", "tag", "x.*").distinct())
    mine = got.withColumnRenamed("d", "d1")
    theirs = got.select(F.col("id").alias("src"), F.col("tag").alias("stag"), F.col("lo").alias("slo"), "len", F.col("d").alias("d2"))
    return spans.join(mine, ["id", "tag", "lo", "len"]).join(theirs, ["src", "stag", "slo", "len"]).where("d1 = d2").select("id", "tag", "lo", "len", "src", "stag", "slo")


def span_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256."""
    scanned = materialize(scan(docs, id_col, text_col, window, anchor))
    spans = materialize(repeated_spans(docs, scanned, id_col, text_col, window))

    def cut(text: bytes, request: list[dict]) -> tuple:
        words = text.split()
        gone = covered(len(words), request)
        kept = [w for w, g in zip(words, gone.tolist()) if not g]
        return len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()

    rows = requested(docs, spans.select("id", "tag", F.struct("lo", "len").alias("x")), id_col, text_col, "x")
    cut_rows = over_texts(rows, cut, "n_words long, n_removed long, kept_sha256 string").drop("id", "tag")
    touched = spans.select("id", "tag").distinct()
    rest = scanned.join(touched, ["id", "tag"], "left_anti").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
    return rest.unionByName(cut_rows)


def drop_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str | None = None, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs``, all rows and columns, repeated spans cut out of the text with
    the white space behind them; other texts are returned unchanged."""
    scanned = materialize(scan(docs, id_col, text_col, window, anchor).drop("sha"))
    spans = repeated_spans(docs, scanned, id_col, text_col, window)
    lists = materialize(spans.groupBy("id", "tag").agg(F.collect_list(F.struct("lo", "len")).alias("request")))
    release(scanned)
    total = lists.agg(F.sum(F.size("request"))).first()[0] or 0
    side = small_side(lists, 52 + 40 * total // max(1, lists.count()))
    key_id, key_tag, request = fresh(docs, "id", "tag", "request")
    side = side.select(F.col("id").alias(key_id), F.col("tag").alias(key_tag), F.col("request").alias(request))
    id_key, tag_key = key_columns(id_col, text_or_empty(text_col))
    out = docs.join(side, (id_key == F.col(key_id)) & (tag_key == F.col(key_tag)), "left")

    @F.arrow_udf("string")
    def without(text: pa.Array, request: pa.Array) -> pa.Array:
        return pa.array([_cut_text(t.as_py(), r.as_py()) for t, r in zip(text, request)], pa.string())

    new = F.when(F.col(request).isNull(), col(text_col)).otherwise(without(F.when(F.col(request).isNotNull(), col(text_col)), F.col(request)))
    out = out.withColumn(text_col, new)
    if n_chars_col:
        out = out.withColumn(n_chars_col, F.char_length(col(text_col)).cast("long"))
    return out.select(*map(col, docs.columns))


def _cut_text(text: str | None, request: list[dict] | None) -> str | None:
    if text is None or request is None:
        return text
    ends = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)]
    gone = covered(len(ends), request)
    lead = text[: ends[0][0]] if ends else text
    return lead + "".join(text[a:b] for (a, b), g in zip(ends, gone.tolist()) if not g)
