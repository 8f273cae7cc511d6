"""SimHash near-dedup: tiled exact comparison of 64-bit fingerprints.

A text's words (ASCII letters lower-cased) make shingles of ``shingle`` words;
a fingerprint bit is set if it is set in over half of the shingles' XXH64 values
(seed 42).  Distinct fingerprints are compared by exclusive-or and bit counts,
tile by tile, and a tile pair whose population counts differ by more than the
radius is skipped.  Fingerprints within the radius are linked; a component is
named by its smallest document id.

Spark deals the work out: two fingerprints within ``radius`` bits agree on at
least ``blocks - radius`` of ``blocks`` bit blocks, so each choice of that many
blocks makes buckets that hold every linked pair at least once.  A bucket is one
tiled comparison; one of more than ``TILE`` rows is cut into tiles by population
count, and each tile pair that is not skipped is a unit of its own, so no task
holds a hot bucket.  A unit returns a forest (at most one edge a row), never all
its pairs; components of the forests are found by Spark joins.

Nulls: null text is an empty text, with fingerprint zero, linked like any other;
a null id keeps its row, and names a component only if it has no other id (then
null).  Repeated rows each get their row.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import Forest, col, connected_components, fresh, materialize, release, runs, small_side, whole_runs

SHINGLE = 3
RADIUS = 3
BLOCKS = 5
#: Rows of a tile: buckets beyond it are cut, so it bounds a unit's memory.
TILE = 2048
SEED = 42


def fingerprint(raw: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one UTF-8 text, as an unsigned number."""
    words = (raw or b"").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        h = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + (1 << 16)], stops[k : k + (1 << 16)])])
        ones += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed long."""

    def prints(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), shingle) for x in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(prints, "doc_id long, fp long")


def _bucket_keys(fp: Column, radius: int, blocks: int) -> Column:
    """array<struct(t, key)>: one bucket per choice of agreeing blocks."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    out = []
    for t, keep in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in keep)
        out.append(F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("key")))
    return F.array(*out)


def _units(prints: DataFrame, radius: int, blocks: int, tile: int) -> DataFrame:
    """(t, key, unit, side, pop, fp): the rows of each unit of comparison.

    ``unit`` 0 compares a bucket with itself; in cut buckets a unit is a pair of
    tiles, its first tile on side 0 and its second on side 1."""
    rows = prints.select(F.explode(_bucket_keys(F.col("fp"), radius, blocks)).alias("b"), F.bit_count("fp").alias("pop"), "fp").select("b.t", "b.key", "pop", "fp")
    sizes = rows.groupBy("t", "key", "pop").agg(F.count("*").alias("n"))
    hot = materialize(sizes.groupBy("t", "key").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("pop", F.ceil(F.col("n") / tile).cast("int")))).alias("cuts")).where(F.col("n") > tile).select("t", "key", "cuts"))  # at most 65 counts each
    cold = rows.join(hot, ["t", "key"], "left_anti").select("t", "key", F.lit(0).cast("long").alias("unit"), F.lit(0).alias("side"), "pop", "fp")
    own = F.pmod(F.xxhash64("fp"), F.col("cuts")[F.col("pop")]).cast("int")
    cut = rows.join(hot, ["t", "key"]).withColumn("own", own)
    # partner tiles (other population count, other cut), within the radius
    near = F.filter(F.map_keys("cuts"), lambda q: F.abs(q - F.col("pop")) <= radius)
    cut = cut.withColumn("q", F.explode(near)).withColumn("c", F.explode(F.sequence(F.lit(0), F.col("cuts")[F.col("q")] - 1)))
    tile_no = lambda p, c: (p.cast("long") * 16777216 + c).alias("x")
    cut = cut.select("t", "key", "pop", "fp", tile_no(F.col("pop"), F.col("own")).alias("a"), tile_no(F.col("q"), F.col("c")).alias("b"))
    unit = F.xxhash64(F.least("a", "b"), F.greatest("a", "b"))
    cut = cut.select("t", "key", F.when(unit == 0, 1).otherwise(unit).alias("unit"), F.when(F.col("a") <= F.col("b"), 0).otherwise(1).alias("side"), "pop", "fp")
    return cold.unionByName(cut)


def _near(fp: np.ndarray, pop: np.ndarray, side: np.ndarray, radius: int, step: int = 512) -> np.ndarray:
    """Component roots within one unit (its rows sorted by population count)."""
    forest, both = Forest(len(fp)), bool(side.any())
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if both else left
    for i in range(0, len(left), step):
        a = left[i : i + step]
        for j in range(0 if both else i, len(right), step):
            b = right[j : j + step]
            if pop[b[0]] - pop[a[-1]] > radius or pop[a[0]] - pop[b[-1]] > radius:
                continue
            x, y = np.nonzero(np.bitwise_count(fp[a][:, None] ^ fp[b][None, :]) <= radius)
            forest.link(a[x], b[y])
    return forest.root


def links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(u, v): a spanning forest of the links between distinct fingerprints."""
    keys = ["t", "key", "unit"]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for table in whole_runs(batches, keys):
            k = [table.column(c).to_numpy() for c in keys]
            fp, pop, side = (table.column(c).to_numpy() for c in ("fp", "pop", "side"))
            bounds = runs(*k)
            many = np.flatnonzero(np.diff(bounds) > 1)
            u, v = [], []
            for s, e in zip(bounds[many].tolist(), bounds[many + 1].tolist()):
                if e - s == 2:
                    if 0 < ((int(fp[s]) ^ int(fp[s + 1])) & (2**64 - 1)).bit_count() <= radius:
                        u.append(fp[s : s + 1])
                        v.append(fp[s + 1 : s + 2])
                    continue
                root = _near(fp[s:e].view(np.uint64), pop[s:e], side[s:e], radius)
                own = np.flatnonzero(root != np.arange(e - s))
                u.append(fp[s:e][own])
                v.append(fp[s:e][root[own]])
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    units = _units(prints, radius, blocks, tile)
    return units.repartition(*keys).sortWithinPartitions(*keys, "pop", "fp").mapInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id."""
    rows = materialize(fingerprints(docs, id_col, text_col, shingle))
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    parts = connected_components(links(prints.select("fp"), radius, blocks, tile))
    parts = prints.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    names = parts.groupBy("component").agg(F.min("first").alias("component_id"))
    named = materialize(parts.join(names, "component").select("fp", "component_id"))
    out = rows.join(named, "fp")
    release(prints)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs``, all columns, one row of each component: that of the smallest
    id.  An id on several rows keeps a row for each distinct text."""
    (key,) = fresh(docs, "component")
    found = materialize(near_duplicates(docs, id_col, text_col, **params))
    named = found.where("component_id is null or doc_id = component_id")
    winners = named.groupBy("component_id").agg(F.count("*").alias("n"))
    # ids only: the texts stay where they are while 16 bytes a winner are few
    winners = materialize(winners.select(F.col("component_id").alias(key), "n"))
    once, more = small_side(winners.where("n = 1").select(key), 16), winners.where("n > 1").select(key)
    own = col(id_col).cast("long").eqNullSafe(F.col(key))
    again = docs.join(small_side(more, 16), own, "left_semi").dropDuplicates([id_col, text_col])
    return docs.join(once, own, "left_semi").unionByName(again)
