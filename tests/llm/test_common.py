"""Shared helpers: components, windows, minimizers, run regrouping, samples."""

import numpy as np
import pyarrow as pa
import pytest
from cohortflow.llm import common
from pyspark.sql import functions as F


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_connected_components(spark, shape):
    rng = np.random.default_rng(1)
    edges = {
        "chain": [(int(a), int(a) + 1) for a in rng.permutation(60)],
        "star": [(500, i) for i in range(300)],
        "random": [tuple(map(int, x)) for x in rng.integers(0, 200, (140, 2))],
        "none": [],
    }[shape]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in common.connected_components(df).collect()}
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(root)):
        for u, v in edges:
            if u != v:
                root[u] = root[v] = min(root[u], root[v])
    assert got == root


def test_window_hashes_depend_on_content_alone():
    rng = np.random.default_rng(2)
    v = rng.integers(0, 3, 400).astype(np.uint64)
    v[200:260] = v[20:80]
    for n in (1, 2, 7, 24, 50):
        h = common.window_hashes(v, n)
        seen = {}
        for i in range(len(v) - n + 1):
            assert seen.setdefault(v[i : i + n].tobytes(), h[i]) == h[i]
        assert len(set(h.tolist())) == len(seen)
    assert len(common.window_hashes(v, 401)) == 0


@pytest.mark.parametrize("chunk", [1 << 22, 50])
def test_minimizers(chunk):
    h = np.random.default_rng(3).integers(0, 2**63, 300).astype(np.uint64)
    h[40:60] = h[41]
    got = common.minimizers(h, 9, chunk)
    top = (h >> np.uint64(23)).tolist()
    assert got.tolist() == [min(range(i, i + 9), key=lambda j: (top[j], j)) for i in range(len(h) - 8)]


def test_whole_runs_never_cut_a_run():
    rng = np.random.default_rng(4)
    a = np.sort(rng.integers(0, 30, 200))
    cuts = [0, *np.sort(rng.integers(0, 201, 25)).tolist(), 200]
    batches = [pa.RecordBatch.from_arrays([pa.array(a[s:e]), pa.array(np.arange(s, e))], names=["k", "i"]) for s, e in zip(cuts, cuts[1:])]
    out = [t.to_pydict() for t in common.whole_runs(batches, ["k"])]
    assert [i for t in out for i in t["i"]] == list(range(200))
    keys = [set(t["k"]) for t in out]
    assert all(not (x & y) for i, x in enumerate(keys) for y in keys[:i])


def test_hash_sample(spark):
    df = spark.range(20_000)
    got = common.hash_sample(df, [F.col("id")], 2000, "x").collect()
    assert 1700 < len(got) <= 2000
    assert common.hash_sample(df.repartition(7), [F.col("id")], 2000, "x").count() == len(got)
    assert common.hash_sample(df, [F.col("id")], 20_000, "x").count() == 20_000
    assert common.hash_sample(df.limit(0), [F.col("id")], 5, "x").count() == 0


def test_shared_dir_needs_a_shared_folder_off_local_masters():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


def test_fresh_names():
    assert common.fresh(["_A", "b"], "a", "b", "c") == ["__a", "_b", "_c"]
