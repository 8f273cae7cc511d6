"""Conflict-constrained best-fit packing of documents into token windows.

A document longer than ``capacity`` words is cut into full segments and a rest.
Segments are packed longest first: bins are kept in order of their residual
room, each with a bitmap of the sources and one of the duplicate clusters it
holds; the search starts at the successor of the segment's length (the tightest
bin with room) and goes on through larger residuals until a bin has neither the
segment's source nor its cluster; if none has, a new bin opens.  So no bin holds
two documents of one source or two copies of one text, and every word of every
document stands in exactly one bin.

Greedy packing is sequential, so Spark deals segments by hash into shards of
about ``SHARD`` segments and packs each on its own: a shard's size, and so a
task's memory and time, does not depend on the input, on a hot source or on a
large cluster (these spread over all shards).  Only ids and lengths are
shuffled, never texts.

Ties: equal lengths go by id (nulls last), segment, cluster; bins of equal
residual by age.  Null source is a source of its own; null text is empty.  A
document without words needs no room: one row with 0 words and a null bin.
Repeated rows are copies of one cluster and land in different bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import SPACE, col, materialize, partitions_for, runs, text_or_empty, whole_runs

CAPACITY = 2048
SHARD = 4096


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, place in the bin) of every segment, in the order given."""
    bit: dict = {}
    order: list[tuple[int, int]] = []  # (residual, bin), sorted
    held: list[tuple[int, int, int]] = []  # by bin: sources, clusters, segments
    out = []
    for n, source, cluster in zip(lengths, sources, clusters, strict=True):
        s = 1 << bit.setdefault(("source", source), len(bit))
        c = 1 << bit.setdefault(("cluster", cluster), len(bit))
        k = bisect_left(order, (n, -1))
        while k < len(order) and (held[order[k][1]][0] & s or held[order[k][1]][1] & c):
            k += 1
        if k < len(order):
            room, b = order.pop(k)
        else:
            room, b = capacity, len(held)
            held.append((0, 0, 0))
        was = held[b]
        held[b] = (was[0] | s, was[1] | c, was[2] + 1)
        out.append((b, was[2]))
        insort(order, (room - n, b))
    return out


def segments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, source, cluster, segment, start, n_tokens) per segment.

    Without ``cluster_col`` a cluster is the words of a text, case aside."""
    words = F.array_remove(F.split(F.lower(text_or_empty(text_col)), f"{SPACE}+"), "")
    rows = docs.select(
        col(id_col).cast("long").alias("doc_id"), col(source_col).cast("string").alias("source"), words.alias("w"),
        (col(cluster_col).cast("long") if cluster_col else F.lit(None).cast("long")).alias("c"),
    ).select("doc_id", "source", F.coalesce("c", F.xxhash64("w")).alias("cluster"), F.size("w").alias("n"))
    last = F.greatest(F.ceil(F.col("n") / capacity).cast("int") - 1, F.lit(0))
    rows = rows.select("doc_id", "source", "cluster", "n", F.explode(F.sequence(F.lit(0), last)).alias("segment"))
    return rows.select("doc_id", "source", "cluster", "segment", (F.col("segment").cast("long") * capacity).alias("start"), F.least(F.lit(capacity), F.col("n") - F.col("segment") * capacity).cast("long").alias("n_tokens"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """One row per segment: doc_id, segment, start, n_tokens, source, bin_id,
    place (order within the bin)."""
    rows = materialize(segments(docs, id_col, text_col, source_col, cluster_col, capacity))
    full = rows.where("n_tokens > 0")
    shards = partitions_for(full.count(), shard)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for table in whole_runs(batches, ["shard"]):
            bounds = runs(table.column("shard").to_numpy())
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                part = table.slice(s, e - s).combine_chunks()
                got = best_fit(*(part.column(c).to_pylist() for c in ("n_tokens", "source", "cluster")), capacity)
                first = part.column("shard")[0].as_py() << 24
                cols = [part.column(c).combine_chunks() for c in ("doc_id", "segment", "start", "n_tokens", "source")]
                cols += [pa.array([first + b for b, _ in got], pa.int64()), pa.array([p for _, p in got], pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "segment", "start", "n_tokens", "source", "bin_id", "place"])

    schema = "doc_id long, segment int, start long, n_tokens long, source string, bin_id long, place int"
    dealt = full.withColumn("shard", F.pmod(F.xxhash64("doc_id", "segment", "cluster"), F.lit(shards)))
    order = ["shard", F.desc("n_tokens"), F.asc_nulls_last("doc_id"), "segment", "cluster"]
    packed = dealt.repartition("shard").sortWithinPartitions(*order).mapInArrow(run, schema)
    empty = rows.where("n_tokens = 0").select("doc_id", "segment", "start", "n_tokens", "source", F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("int").alias("place"))
    return packed.unionByName(empty)
