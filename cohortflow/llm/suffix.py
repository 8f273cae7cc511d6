"""Suffix-array dedup: bytes covered by a long string that also starts earlier.

Every string of ``LENGTH`` bytes of a text is a suffix cut at that depth; a
suffix that equals an earlier one covers its bytes.  The array is sparse: each
string is represented under its leading token, the smallest hash among its
``GRAM``-byte grams, and consecutive strings of a text under one token form a
piece.  Equal strings have equal tokens at equal offsets, so they always meet.

1. One pass over the texts writes each text's pieces.  A text that equals that
   of a smaller id is a copy and is settled at once.
2. Pieces whose token stands once in the corpus leave.
3. Equal pieces become one.  All but the first occurrence (id, place) of a piece
   are covered whole; what is left to decide is the first occurrences of tokens
   with more than one distinct piece.
4. Their suffixes are range-partitioned by leading token with sampled splitters
   (token, then source, so a hot token is cut over several buckets).  A bucket
   sorts its suffixes by multikey quicksort, eight bytes a character, and equal
   suffixes are covered but for the first.
5. Compare across boundaries: a token cut by a splitter hands on its buckets'
   first suffixes in blocks (by offset and hash, as many as it has buckets), and
   the blocks of all its buckets are sorted together.
6. Spans are merged and cut from the texts.

No group is gathered: a passage in a third of all texts is one piece and, at its
ends, tokens that are split.  A bucket's size is set by ``BUCKET`` suffixes.

Nulls and ties: null text is empty; a null id sorts after all others.  Equal
rows are one document listed twice and get equal results; different texts under
one id are ordered by a tag of the text.  Texts under ``LENGTH`` bytes lose
nothing.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import _mix, free_shuffles, materialize, minimizers, partitions_for, release, runs, small_side, whole_runs
from cohortflow.llm.texts import base_rows, covered, over_texts, requested

LENGTH = 100
GRAM = 24  # three eight-byte characters
BUCKET = 400_000
PER_BUCKET = 20  # sampled pieces a splitter is chosen from
BLOB = np.dtype([("a", "<u8"), ("b", "<u8"), ("id", "<i8"), ("tag", "<i8"), ("at", "<i4")])


def pieces_of(text: bytes) -> tuple[np.ndarray, ...]:
    """(token, first string, number of strings, token's place) arrays."""
    n = len(text) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 4
    eight = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    m = len(text) - GRAM + 1
    grams = _mix(_mix(eight[:m].astype(np.uint64), eight[8 : 8 + m]), eight[16 : 16 + m])
    grams = _mix(grams, grams >> np.uint64(17))
    at = minimizers(grams, LENGTH - GRAM + 1)
    start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return grams[at[start]].view(np.int64), start, np.append(start[1:], n) - start, at[start]


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: size, digests, pieces (token, content, place)."""

    def one(text: bytes, _) -> tuple:
        m, start, n, _at = (x.tolist() for x in pieces_of(text))
        digest = xxhash.xxh3_64_intdigest
        p = [digest(text[s : s + k + LENGTH - 1]) for s, k in zip(start, n)]
        p = np.array(p, np.uint64).view(np.int64).tolist()
        whole = hashlib.sha256(text)
        d = whole.digest()
        k1, k2 = int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:16], "big", signed=True)
        return len(text), whole.hexdigest(), k1, k2, [dict(zip(("m", "p", "start", "n"), r)) for r in zip(m, p, start, n)]

    return over_texts(base_rows(docs, id_col, text_col), one, "n_bytes long, sha string, k1 long, k2 long, pieces array<struct<m:long,p:long,start:int,n:int>>")


def equal_suffixes(buf: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the suffixes at ``pos``, to depth ``LENGTH``: the
    suffixes that equal another one, and their group numbers.

    A character is eight bytes.  Each level sorts by it and goes deeper only
    into the parts whose characters are equal; ``buf`` has eight spare bytes."""
    eight = np.ndarray((len(buf) - 7,), ">u8", buf, strides=(1,))
    active, group = np.arange(len(pos)), np.zeros(len(pos), np.int64)
    for depth in range(0, LENGTH, 8):
        key = eight[pos[active] + depth].astype(np.uint64)
        if depth + 8 > LENGTH:
            key >>= np.uint64(8 * (depth + 8 - LENGTH))
        order = np.lexsort((key, group)) if depth else np.argsort(key)
        key, group, active = key[order], group[order], active[order]
        bounds = runs(group, key)
        size = np.diff(bounds)
        number = np.repeat(np.arange(len(size)), size)
        many = np.repeat(size > 1, size)
        active, group = active[many], number[many]
        if not len(active):
            break
    return active, group


def _later(active: np.ndarray, group: np.ndarray, ids: np.ndarray, tags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of ``active`` that are not the first (id, tag, place) of their group."""
    order = np.lexsort((at[active], tags[active], ids[active], group))
    a, g = active[order], group[order]
    return a[1:][g[1:] == g[:-1]]


def _spans(ids: np.ndarray, tags: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Places as spans: rows (id, tag, lo, len, nothing handed on)."""
    order = np.lexsort((at, tags, ids))
    ids, tags, at = ids[order], tags[order], at[order]
    keep = np.ones(len(at), bool)
    keep[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]) | (at[1:] != at[:-1])
    ids, tags, at = ids[keep], tags[keep], at[keep]
    bounds = runs(ids, tags, at - np.arange(len(at)))
    s = bounds[:-1]
    n = len(s)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[s].astype(np.int64)), pa.array(tags[s].astype(np.int64)), pa.array(at[s].astype(np.int32)), pa.array(np.diff(bounds).astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
        names=["id", "tag", "lo", "len", "m", "part", "blob"],
    )


def _bucket_sort(cuts: dict[int, int], table: pa.Table) -> Iterable[pa.RecordBatch]:
    """One bucket: spans of equal suffixes, and blocks for tokens that are cut
    (``cuts``: by how many splitters)."""
    text, n = table.column("text").combine_chunks(), table.column("n").to_numpy().astype(np.int64)
    m, ids, tags = (table.column(c).to_numpy() for c in ("m", "id", "tag"))
    start, off = table.column("start").to_numpy().astype(np.int64), table.column("off").to_numpy().astype(np.int64)
    buf = np.append(np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in text]), np.zeros(8, np.uint8))
    begin = np.concatenate([[0], np.cumsum(n + LENGTH - 1)[:-1]])
    piece = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    pos, wid, wtag, at = begin[piece] + step, ids[piece], tags[piece], start[piece] + step
    later = _later(*equal_suffixes(buf, pos), wid, wtag, at)
    if len(later):
        yield _spans(wid[later], wtag[later], at[later])
    cut = np.array([x in cuts for x in m.tolist()], bool)
    first = cut[piece]
    first[later] = False
    raw = buf.tobytes()
    for token in np.unique(m[cut]).tolist():
        own = np.flatnonzero(first & (m[piece] == token))
        buckets = cuts[token] + 1
        by_offset, by_hash = min(buckets, 7), -(-buckets // 7)
        blob = np.empty(len(own), BLOB)
        hashes = [xxhash.xxh3_128_intdigest(raw[p : p + LENGTH]) for p in pos[own].tolist()]
        blob["a"], blob["b"] = [h >> 64 for h in hashes], [h & (2**64 - 1) for h in hashes]
        blob["id"], blob["tag"], blob["at"] = wid[own], wtag[own], at[own]
        part = (off[piece[own]] - step[own]) * by_offset // LENGTH * by_hash + (blob["b"] % by_hash).astype(np.int64)
        for k in np.unique(part).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.array([token], pa.int64()), pa.array([k], pa.int32()), pa.array([blob[part == k].tobytes()], pa.binary())],
                names=["id", "tag", "lo", "len", "m", "part", "blob"],
            )


def _across(blobs: list[bytes]) -> Iterable[pa.RecordBatch]:
    """One block of a cut token, from all its buckets."""
    x = np.concatenate([np.frombuffer(b, BLOB) for b in blobs])
    order = np.lexsort((x["at"], x["tag"], x["id"], x["b"], x["a"]))
    x = x[order]
    again = np.flatnonzero((x["a"][1:] == x["a"][:-1]) & (x["b"][1:] == x["b"][:-1])) + 1
    if len(again):
        yield _spans(x["id"][again], x["tag"][again], x["at"][again].astype(np.int64))


def _splitters(asked: DataFrame, pieces: int, buckets: int) -> list[tuple]:
    """At most ``buckets`` - 1 sorted (token, id, start): the quantiles of a sample
    of ``PER_BUCKET`` pieces a bucket, ranked where it lies. Only they come here."""
    each = max(1, pieces // (PER_BUCKET * buckets))
    key = [F.col("x.m").alias("m"), "id", F.col("x.start").alias("start")]
    sample = materialize(asked.where(F.pmod(F.xxhash64("id", "tag", "x.start"), F.lit(each)) == 0).select(*key))
    parts = materialize(sample.repartitionByRange("m", "id", "start").withColumn("b", F.spark_partition_id()))
    counts = parts.groupBy("b").agg(F.count("*").alias("n"))  # a row a partition
    line = W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("b", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("off"))
    rank = F.row_number().over(W.partitionBy("b").orderBy("m", "id", "start")) - 1 + F.col("off")
    total = sample.count()
    step = lambda r: F.floor(r * F.lit(buckets) / F.lit(max(1, total)))
    chosen = parts.join(F.broadcast(before), "b").withColumn("r", rank).where((F.col("r") > 0) & (step(F.col("r")) > step(F.col("r") - 1)))
    out = sorted(tuple(r) for r in chosen.select("m", "id", "start").collect())
    release(sample, parts)
    return out


def _first_occurrence_spans(docs: DataFrame, asked: DataFrame, id_col: str, text_col: str, repeated: DataFrame) -> DataFrame:
    """Spans of the suffixes, among the pieces asked for, that equal an earlier
    one.  ``asked``: (id, tag, x = struct(m, start, n)), written.  ``repeated``:
    (id, tag) of rows listed more than once; their pieces are cut once."""
    size = asked.agg(F.sum("x.n"), F.count("*")).first()
    buckets = partitions_for(size[0] or 0, BUCKET, 1)
    splitters = _splitters(asked, size[1] or 0, buckets) if buckets > 1 else []
    shared = docs.sparkSession.sparkContext.broadcast((splitters, Counter(m for m, *_ in splitters)))

    def cut(text: bytes, request: list[dict]) -> tuple:
        out, place = [], {}
        for r in request:
            if not place:
                place = {s: a for _, s, _, a in zip(*(x.tolist() for x in pieces_of(text)))}
            s, row = r["start"], {k: r[k] for k in ("m", "start", "n")}
            out.append(row | {"off": place[s] - s, "text": text[s : s + r["n"] + LENGTH - 1]})
        return (out,)

    rows = over_texts(requested(docs, asked, id_col, text_col, "x", repeated), cut, "out array<struct<m:long,start:int,n:int,off:int,text:binary>>")
    rows = rows.select("id", "tag", F.explode("out").alias("x")).select("id", "tag", "x.*")

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        at = shared.value[0]
        for b in batches:
            keys = zip(b.column("m").to_pylist(), b.column("id").to_pylist(), b.column("start").to_pylist())
            yield b.append_column("bucket", pa.array([bisect_right(at, k) for k in keys], pa.int32()))

    head = "id long, tag long, m long, start int, n int, off int, text binary"
    dealt = rows.mapInArrow(deal, f"{head}, bucket int").repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for table in whole_runs(batches, ["bucket"]):
            bounds = runs(table.column("bucket").to_numpy())
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield from _bucket_sort(shared.value[1], table.slice(s, e - s))

    out = materialize(dealt.mapInArrow(sort, "id long, tag long, lo int, len int, m long, part int, blob binary"))

    def across(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for table in whole_runs(batches, ["m", "part"]):
            bounds = runs(table.column("m").to_numpy(), table.column("part").to_numpy())
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield from _across([x.as_py() for x in table.column("blob").slice(s, e - s)])

    blocks = out.where("blob is not null").select("m", "part", "blob").repartition("m", "part").sortWithinPartitions("m", "part")
    more = blocks.mapInArrow(across, "id long, tag long, lo int, len int, m long, part int, blob binary")
    return out.where("blob is null").unionByName(more).select("id", "tag", "lo", F.col("len"))


def repeated_spans(docs: DataFrame, scanned: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tag, lo, len): merged spans of bytes that are covered."""
    heads = scanned.groupBy("id", "tag", "n_bytes", "k1", "k2").agg(F.count("*").alias("times"))
    repeated = materialize(heads.where("times > 1").select("id", "tag"))
    heads = heads.drop("times")
    first = heads.groupBy("k1", "k2").agg(F.min(F.struct("id", "tag")).alias("f"), F.count("*").alias("c")).where("c > 1").drop("c")
    copies = materialize(heads.join(first, ["k1", "k2"]).where("id <> f.id or tag <> f.tag").select("id", "tag", "n_bytes"))
    rest = scanned.join(small_side(copies.select("id", "tag"), 16), ["id", "tag"], "left_anti")
    every = rest.select("id", "tag", F.explode("pieces").alias("x")).select("id", "tag", "x.*")
    tokens = materialize(every.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m"))
    free_shuffles(docs)
    found = materialize(every.join(small_side(tokens, 8), "m").select("m", "p", "id", "tag", "start", "n").distinct())
    free_shuffles(docs)
    paths = materialize(found.groupBy("m", "p").agg(F.min(F.struct("id", "tag", "start")).alias("f"), F.first("n").alias("n")))
    again = found.join(paths.select("m", "p", "f"), ["m", "p"]).where("struct(id, tag, start) <> f").select("id", "tag", F.col("start").alias("lo"), F.col("n").alias("len"))
    again = materialize(_merged(again))
    release(found, tokens)
    free_shuffles(docs)
    branching = materialize(paths.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m"))
    asked = materialize(paths.join(small_side(branching, 8), "m").select("f.id", "f.tag", F.struct("m", F.col("f.start").alias("start"), "n").alias("x")))
    release(paths, branching)
    free_shuffles(docs)
    spans = _merged(again.unionByName(_first_occurrence_spans(docs, asked, id_col, text_col, repeated)))
    whole = copies.where(F.col("n_bytes") >= LENGTH).select("id", "tag", F.lit(0).alias("lo"), (F.col("n_bytes") - LENGTH + 1).cast("int").alias("len"))
    spans = materialize(spans.unionByName(whole))
    release(again, asked, copies, repeated)
    free_shuffles(docs)
    return spans.withColumn("len", F.col("len") + (LENGTH - 1))


def _merged(spans: DataFrame) -> DataFrame:
    """Strings' spans whose places touch, as one (within a document)."""
    line = W.partitionBy("id", "tag").orderBy("lo", "len")
    upto = F.max(F.col("lo") + F.col("len")).over(line.rowsBetween(W.unboundedPreceding, -1))
    parts = spans.withColumn("part", F.sum(F.when(F.col("lo") <= upto, 0).otherwise(1)).over(line))
    return parts.groupBy("id", "tag", "part").agg(F.min("lo").alias("lo"), F.max(F.col("lo") + F.col("len")).alias("hi")).select("id", "tag", "lo", (F.col("hi") - F.col("lo")).alias("len"))


def span_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    scanned = materialize(scan(docs, id_col, text_col))
    spans = repeated_spans(docs, scanned, id_col, text_col)
    heads = materialize(scanned.drop("pieces", "k1", "k2"))
    release(scanned)

    def cut(text: bytes, request: list[dict]) -> tuple:
        gone = covered(len(text), request)
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        return len(text), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()

    rows = requested(docs, spans.select("id", "tag", F.struct("lo", "len").alias("x")), id_col, text_col, "x")
    cut_rows = over_texts(rows, cut, "n_bytes long, n_removed long, n_spans long, kept_sha256 string").drop("id", "tag")
    touched = materialize(spans.select("id", "tag").distinct())
    zero = F.lit(0).cast("long")
    rest = heads.join(small_side(touched, 16), ["id", "tag"], "left_anti").select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"))
    return rest.unionByName(cut_rows)
