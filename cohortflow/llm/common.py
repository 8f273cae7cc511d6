"""Helpers shared by the operators: tables, shared-folder writes, components."""

from __future__ import annotations

import atexit
import contextlib
import gc
import re
import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for lineage cuts: ``spark.checkpoint.dir`` of the session.

    Unset, a local master gets a folder of its own; any other master raises,
    because executors would write to disks that nobody else can read."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, *folders: str) -> DataFrame:
    """Write ``df`` to the shared folder, in folders by these columns, and read
    it back (cuts lineage and survives lost executors). The copy goes with
    ``release``, or at exit."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).parquet(path)
    atexit.register(_forget, df.sparkSession, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _forget(spark: SparkSession, path: str) -> None:
    """At exit: the session may be gone already."""
    with contextlib.suppress(Exception):
        _delete(spark, path)


def release(*frames: DataFrame | None) -> None:
    """Delete what ``materialize`` wrote for frames that are no longer read."""
    for df in frames:
        if df is not None and (path := getattr(df, "_llm_path", None)):
            _delete(df.sparkSession, path)


def free_shuffles(df: DataFrame) -> None:
    """Collect garbage here and in the driver's JVM, so that Spark's cleaner
    deletes the shuffle files of steps whose results are written."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def fresh(df: DataFrame | Iterable[str], *names: str) -> list[str]:
    """Names that no column of ``df`` has, in any letter case."""
    taken = {c.lower() for c in (df.columns if isinstance(df, DataFrame) else df)}
    out = []
    for name in names:
        n = f"_{name}"
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def col(name: str) -> Column:
    """A top-level column, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(col(text_col).cast("string"), F.lit(""))


def partitions_for(rows: int, per_partition: int, least: int = 1) -> int:
    return max(least, -(-rows // per_partition))


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns);
    component is the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): each is
    one minimum per node and one join, so no neighbourhood is ever gathered; a
    star with a third of all edges is pre-aggregated before its shuffle and its
    join partition can be split."""
    a, b = F.least("u", "v"), F.greatest("u", "v")
    cur = materialize(edges.select(col(u).alias("u"), col(v).alias("v")).where("u <> v").select(a.alias("v"), b.alias("u")).distinct())
    state = None
    while True:
        new_state = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new_state == state:
            break
        state = new_state
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        release(cur)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        cur = materialize(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
        release(large)
    roots = cur.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


class Forest:
    """Components of ``n`` items inside one task; ``root`` is the smallest
    index of each item's component."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Link the pairs (i[k], j[k]): each round hooks every root to the
        smallest root it touches, so the rounds are logarithmic."""
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            up = np.arange(len(self.root))
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(nxt := up[up], up):
                up = nxt
            self.root = up[self.root]


def runs(*keys: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal rows in sorted ``keys``: starts, then n."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), n)


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterable[pa.Table]:
    """Regroup a sorted stream of Arrow batches so that no run of equal
    ``keys`` is cut; only the last, open run is held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == v
        cut = int(batch.num_rows - np.argmin(same[::-1])) if not same.all() else 0
        if cut or (held and [held[-1].column(k)[0].as_py() for k in keys] != last):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


#: Frames of at most this many bytes are broadcast; beyond it they are shuffled.
BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """A written ``df`` as the side of a join: broadcast if all its rows, at
    ``row_bytes`` each, stay under ``BROADCAST_BYTES``; else left to a shuffle
    join, whose hot partitions Spark splits."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def hash_sample(df: DataFrame, key: list[Column], most: int, seed: str) -> DataFrame:
    """About 0.95 * ``most`` rows of ``df`` (all, if there are no more), chosen
    by a hash of ``key``: the same rows in every run and partitioning, with no
    sort. The number of rows kept is binomial, so ``most`` (from some hundreds
    on) bounds it in practice; nothing is sent anywhere to choose them."""
    n = df.count()
    if n <= most:
        return df
    return df.where(F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 40)) < int(0.95 * most / n * (1 << 40)))


def present_labels(ids: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``known`` (i, one label column; unique i), written, whose i is
    among ``ids`` (one column i, any repeats and nulls)."""
    known = materialize(known)
    label = known.columns[1]
    found = ids.where("i is not null").join(small_side(known, 24), "i")
    return materialize(found.groupBy("i").agg(F.max(label).alias(label)))


def class_sample(known: DataFrame, label: str, key: list[Column], most: int, seed: str) -> DataFrame:
    """About ``most`` rows of ``known`` (all, if there are no more), by hash, with
    a ``weight``.  One rate for both classes, but for a class that would have
    under a quarter of ``most`` rows: it keeps up to that many.  weight is the
    class's share of ``known`` over its share of the sample."""
    counts = {r[label]: r["n"] for r in known.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total, rare = sum(counts.values()), most // 4
    if total <= most:
        return known.withColumn("weight", F.lit(1.0))
    want = {c: min(n, max(rare, int(0.95 * most * n / total))) for c, n in counts.items()}
    over = sum(want.values()) - int(0.95 * most)
    if over > 0:  # the larger class makes room
        big = max(want, key=want.get)
        want[big] -= over
    below = [F.lit(1 << 40) if want[c] == n else F.lit(int(want[c] / n * (1 << 40))) for c, n in counts.items()]
    weight = [F.lit((n / total) / (want[c] / sum(want.values()))) for c, n in counts.items()]
    pick = lambda values: F.coalesce(*(F.when(F.col(label) == F.lit(c), v) for c, v in zip(counts, values)))
    rows = known.where(F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 40)) < pick(below))
    return rows.withColumn("weight", pick(weight))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def window_hashes(v: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every window of ``length`` items of ``v`` (uint64 hashes
    of the items), by doubling; equal windows have equal hashes anywhere."""
    m = len(v) - length + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out, off, size, cur = None, 0, 1, v
    while True:
        if length & size:
            part = cur[off : off + m]
            out = part if out is None else _mix(out[:m], part)
            off += size
        if size * 2 > length:
            return _mix(out[:m], np.uint64(length) + np.zeros(1, np.uint64))
        cur = _mix(cur[:-size], cur[size:])
        size *= 2


def minimizers(h: np.ndarray, w: int, chunk: int = 1 << 22) -> np.ndarray:
    """For every ``w`` consecutive values of ``h``, the index of the smallest
    (the first, if several are: order by the value's high bits, then place)."""
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    bits = np.uint64(23)
    low = np.uint64((1 << 23) - 1)
    out = []
    for s in range(0, n, chunk):
        x = h[s : min(s + chunk, n) + w - 1]
        m = -(-len(x) // w) * w
        p = np.full(m, ~np.uint64(0))
        p[: len(x)] = ((x >> bits) << bits) | np.arange(len(x), dtype=np.uint64)
        a = p.reshape(-1, w)
        ahead = np.minimum.accumulate(a, 1).ravel()
        back = np.minimum.accumulate(a[:, ::-1], 1)[:, ::-1].ravel()
        c = len(x) - w + 1
        out.append((np.minimum(back[:c], ahead[w - 1 : w - 1 + c]) & low).astype(np.int64) + s)
    return np.concatenate(out)
