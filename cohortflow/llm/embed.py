"""Embedding near-dedup by the epsilon grid order join.

Two unit vectors have cosine >= t exactly if their distance is <= eps =
sqrt(2 - 2t).  Vectors are projected on ``BOX`` orthonormal principal directions
(a projection never lengthens a distance; the length of what the directions
leave is one more coordinate).  The cells of the first ``LEAD`` on a grid of width
eps are compared in lexicographic order (label first), and the ordered sequence
is cut into intervals of at most ``BLOCK`` vectors or ``BLOCK_BYTES``.  Two
intervals of one label whose boxes lie more than eps apart are provably distant
and never meet.  The others are joined as a unit: recursively halved, skipping
provably distant halves, down to leaves that are compared in double precision.

Equal vectors of a label are one vector with a count, so a vector copied a
million times is one row.  A unit returns counts and a forest, at most one row a
vector, never its pairs.  Components are found by Spark joins.

The directions are fitted on at most ``SAMPLE`` vectors (by hash); they only
decide how much is skipped, not what is found: recall is 1.

Nulls: vectors that are null, empty, zero or hold null or non-finite components,
and vectors with a null label, link with nothing (0 links, own component).
Vectors of different length never link.  A null id keeps its row and names no
component unless it is alone (then null).  Repeated rows count as other vectors.
Labels are whole numbers or compared as strings.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.llm.common import Forest, col, connected_components, hash_sample, materialize, release, runs, whole_runs

COSINE = 0.98
LEAD = 6  # directions of the grid
BOX = 16  # directions of the boxes
BLOCK = 8192  # vectors of an interval, in at most BLOCK_BYTES as doubles
BLOCK_BYTES = 4 << 20
SAMPLE = 4096
LEAF = 128
_AXES = [f"y{k}" for k in range(BOX + 1)]


def principal_directions(distinct: DataFrame) -> np.ndarray:
    """``BOX`` orthonormal rows fitted on a bounded sample of unit vectors, for
    the sample's most common length; other lengths use their first axes."""
    rows = hash_sample(distinct, [F.col("h1"), F.col("h2")], SAMPLE, "directions").select("vector").collect()
    lengths = [len(r[0]) for r in rows]
    if not lengths:
        return np.zeros((0, 0))
    dim = max(set(lengths), key=lambda d: (lengths.count(d), d))
    x = np.array([r[0] for r in rows if len(r[0]) == dim], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.linalg.svd(x - x.mean(axis=0), full_matrices=False)[2][:BOX]


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` times powers of two, so that no square overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _project(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The directions of the rows of ``x`` on ``basis``, then the length of what it
    leaves: distances between these rows are lower bounds."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    y = np.zeros((len(x), BOX + 1))
    seen = x @ basis.T if x.shape[1] == basis.shape[1] else x[:, :BOX]
    y[:, : seen.shape[1]] = seen
    y[:, BOX] = np.sqrt(np.maximum(0, 1 - (y[:, :BOX] ** 2).sum(axis=1)))
    return y


def _order(distinct: DataFrame, basis: np.ndarray, eps: float) -> DataFrame:
    """Adds dim and projections, puts the rows in grid order (``place``) and cuts
    the intervals (``block``)."""
    keep = ["node", "label", "copies", "vector"]

    def project(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            vectors = [np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) for v in b.column("vector")]
            y = np.concatenate([_project(_scaled(v[None]), basis) for v in vectors]) if vectors else np.zeros((0, BOX + 1))
            columns = [*(b.column(k) for k in keep), pa.array([len(v) for v in vectors], pa.int32()), *(pa.array(y[:, k]) for k in range(BOX + 1))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "dim", *_AXES])

    types = [f"{k} {distinct.schema[k].dataType.simpleString()}" for k in keep]
    head = ", ".join([*types, "dim int", *(f"{y} double" for y in _AXES)])
    # written first: the range bounds below are sampled from rows that stay put
    rows = materialize(distinct.select(*keep).mapInArrow(project, head))
    order = ["label", "dim", *(F.floor(F.col(y) / eps) for y in _AXES[:LEAD]), "node"]

    def intervals(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        block = place = TaskContext.get().partitionId() << 32
        block, held, last = block - 1, 0, None
        for b in batches:
            label, dims = (b.column(c).to_numpy(zero_copy_only=False) for c in ("label", "dim"))
            out = np.zeros(b.num_rows, np.int64)
            bounds = runs(label, dims) if b.num_rows else [0]
            for s, e in zip(bounds[:-1], bounds[1:]):
                key = (label[s], dims[s])
                most = max(1, min(BLOCK, BLOCK_BYTES // (8 * int(dims[s]))))
                while s < e:
                    if key != last or held >= most:
                        block, held, last = block + 1, 0, key
                    n = min(e - s, most - held)
                    out[s : s + n] = block
                    s, held = s + n, held + n
            yield b.append_column("block", pa.array(out)).append_column("place", pa.array(place + np.arange(b.num_rows)))
            place += b.num_rows

    parted = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    out = materialize(parted.mapInArrow(intervals, f"{head}, block long, place long"))
    release(rows)
    return out


def _pairs(rows: DataFrame, eps: float) -> DataFrame:
    """(a, b, unit): intervals of one label, a <= b, whose boxes are within eps.

    Boxes are those of the projections themselves, not of their cells. They meet
    under the cells of the first two directions, then by their distance."""
    boxes = materialize(rows.groupBy("block", "label", "dim").agg(*(f(y).alias(f"{n}_{y}") for y in _AXES for n, f in (("lo", F.min), ("hi", F.max)))))

    def meet(df: DataFrame, prefix: str, reach: float) -> DataFrame:
        for k, y in enumerate(_AXES[:2]):
            low, high = F.col(f"{prefix}lo_{y}") - reach, F.col(f"{prefix}hi_{y}") + reach
            df = df.withColumn(f"cell{k}", F.explode(F.sequence(F.floor(low / eps), F.floor(high / eps))))
        return df

    names = [c for c in boxes.columns if c not in ("label", "dim")]
    left = meet(boxes, "", 0.0)
    right = meet(boxes.select("label", "dim", *(F.col(c).alias(f"r_{c}") for c in names)), "r_", eps)
    gaps = [F.greatest(F.lit(0.0), F.col(f"r_lo_{y}") - F.col(f"hi_{y}"), F.col(f"lo_{y}") - F.col(f"r_hi_{y}")) for y in _AXES]
    near = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= eps * eps
    got = left.join(right, ["label", "dim", "cell0", "cell1"]).where((F.col("block") <= F.col("r_block")) & near)
    return got.select(F.col("block").alias("a"), F.col("r_block").alias("b")).distinct().withColumn("unit", F.xxhash64("a", "b"))


def _join_unit(x: np.ndarray, copies: np.ndarray, near: np.ndarray, split: int, cosine: float, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """(links of each row, roots) of one unit: rows before ``split`` against the
    rest, or all rows against each other if ``split`` is the row count. ``near``
    are their projections."""
    n = len(x)
    norm, links, forest = np.sqrt((x * x).sum(axis=1)), np.zeros(n, np.int64), Forest(n)

    def far(a: slice, b: slice) -> bool:
        p, q = near[a], near[b]
        gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
        return bool((gap * gap).sum() > eps * eps)

    def compare(a: slice, b: slice) -> None:
        hit = (x[a] @ x[b].T) / (norm[a][:, None] * norm[b][None, :]) >= cosine
        if a == b:
            np.fill_diagonal(hit, False)
        links[a] += hit @ copies[b]
        if a != b:
            links[b] += hit.T @ copies[a]
        i, j = np.nonzero(hit)
        forest.link(i + a.start, j + b.start)

    def halves(s: slice) -> tuple[slice, slice]:
        mid = (s.start + s.stop) // 2
        return slice(s.start, mid), slice(mid, s.stop)

    todo = [(slice(0, n), slice(0, n))] if split == n else [(slice(0, split), slice(split, n))]
    while todo:
        a, b = todo.pop()
        if a != b and far(a, b):
            continue
        na, nb = a.stop - a.start, b.stop - b.start
        if max(na, nb) <= LEAF:
            compare(a, b)
        elif a == b:
            p, q = halves(a)
            todo += [(p, p), (p, q), (q, q)]
        else:
            todo += [(p, q) for p in (halves(a) if na > LEAF else (a,)) for q in (halves(b) if nb > LEAF else (b,))]
    return links, forest.root


def linked(rows: DataFrame, basis: np.ndarray, eps: float, cosine: float = COSINE) -> DataFrame:
    """(node, root, links) per unit and vector that has a link in it."""
    pairs = materialize(_pairs(rows, eps))
    cols = ["place", "node", "copies", "vector"]
    first = rows.join(pairs, F.col("block") == F.col("a")).select("unit", F.lit(0).alias("side"), *cols)
    second = rows.join(pairs.where("a <> b"), F.col("block") == F.col("b")).select("unit", F.lit(1).alias("side"), *cols)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for table in whole_runs(batches, ["unit"]):
            unit, side = table.column("unit").to_numpy(), table.column("side").to_numpy()
            node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
            vectors = table.column("vector").combine_chunks()
            flat, at = np.asarray(vectors.values), np.asarray(vectors.offsets)
            bounds = runs(unit)
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                x = _scaled(flat[at[s] : at[e]].astype(np.float64).reshape(e - s, -1))
                links, root = _join_unit(x, copies[s:e], _project(x, basis), int((side[s:e] == 0).sum()), cosine, eps)
                own = np.flatnonzero(links)
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array(node[s:e][own]), pa.array(node[s:e][root[own]]), pa.array(links[own])], names=["node", "root", "links"])

    units = first.unionByName(second)
    return units.repartition("unit").sortWithinPartitions("unit", "side", "place").mapInArrow(compare, "node long, root long, links long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    v = F.col("vector")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    # floats travel as they are; anything else, and all arithmetic, is double
    entries = vectors.select(col(vector_col)).schema[0].dataType
    single = isinstance(entries, T.ArrayType) and isinstance(entries.elementType, T.FloatType)
    whole = isinstance(vectors.select(col(label_col)).schema[0].dataType, T.IntegralType)
    label = col(label_col).cast("long" if whole else "string").alias("label")
    base = vectors.select(col(id_col).cast("long").alias("vec_id"), label, col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"))
    base = base.withColumn("usable", F.coalesce(usable, F.lit(False)))
    keyed = base.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64("vector", F.lit("vector"))})
    distinct = keyed.where("usable").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    distinct = materialize(distinct.withColumn("node", F.monotonically_increasing_id()))  # stays as written
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) * (1 + 1e-9) + 1e-7
    basis = principal_directions(distinct)
    rows = _order(distinct, basis, eps)
    found = materialize(linked(rows, basis, eps, cosine))
    release(rows)
    parts = connected_components(found.select("node", "root"), "node", "root").withColumnRenamed("node", "n")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = distinct.select("node", "label", "h1", "h2", "first", "copies").join(sums, "node", "left").join(parts, F.col("node") == F.col("n"), "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = materialize(named.join(names, "component").select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    alone = keyed.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = keyed.where("usable").select("vec_id", "label", "h1", "h2").join(named, ["label", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
