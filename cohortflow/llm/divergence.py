"""Source divergence audit: chi-square-like distances between the sources of a
language, and the terms that set a source apart, in exact integers.

1. One pass cuts the texts into terms and writes them by language unit: a
   language with at least 1 / ``UNITS`` of the text is a unit of its own, the
   others share one (there a term carries its language, so vocabularies stay apart).  A
   unit of more than ``UNIT_BYTES`` of text is cut into several by term hash.
2. A CountVectorizer (minDF documents, largest vocabSize) per unit builds exact
   sparse document vectors over its vocabulary, renumbered in UTF-8 order.
3. Group sums: tasks add up their vectors per (language, source) and block of
   terms; only these sums are shuffled.
4. Pairs: a task holds one block of terms of one language and evaluates only
   terms that both sources have, as what differs from the sum over either one
   alone; those sums come from the histogram of each source's counts, and terms
   that neither has are a constant times their number.
5. Terms: each block gives its first ``top`` per group; ranks are taken over these.

A block has at most ``BLOCK_CELLS`` / sources terms, so a task holds at most that
many sums, whatever the vocabulary.  The driver sees languages' sizes, and the
vocabulary of one unit at a time (as CountVectorizer's model does).

Nulls in text, lang and source are ''.  Repeated rows count each.  Every
occurring (lang, source) has its pairs, even without terms; a language without
kept terms has values 0.  Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import free_shuffles, materialize, release, runs, text_or_empty, whole_runs

MIN_DF = 3
TOP = 200
SCALE = 1_000_000_000
VOCABULARY = 2**31 - 1
UNITS = 64
UNIT_BYTES = 1 << 31
BLOCK_CELLS = 1 << 18
#: Vector entries that a task holds before it adds them up, and pairs at a time.
FLUSH = 1 << 21
#: Bytes that belong to terms: ASCII letters (lower-cased) and all beyond ASCII.
TERM_BYTES = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
NUL = b"\0"  # parts a term from its language; no term holds it


def _cut(units: dict[str, int], rest: int, parts: dict[int, int]):
    """(unit, part, lang, source, terms, kinds) rows of (lang, source, text):
    terms, and the different ones among them, joined by blanks."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                b = batch.slice(s, 512)
                unit, part, at, terms, kinds = [], [], [], [], []
                for k, (lang, text) in enumerate(zip(b.column("lang").to_pylist(), b.column("text").to_pylist())):
                    u = units.get(lang, rest)
                    words = text.lower().translate(TERM_BYTES).split()
                    if (n := parts.get(u, 1)) == 1:
                        lists = [words]
                    else:
                        lists = [[] for _ in range(n)]
                        for w in words:
                            lists[zlib.crc32(w) % n].append(w)
                    mark = lang.encode().hex().encode() + NUL if u == rest else b""
                    for p, x in enumerate(lists):
                        if x:
                            unit.append(u)
                            part.append(p)
                            at.append(k)
                            terms.append(mark + (b" " + mark).join(x))
                            kinds.append(mark + (b" " + mark).join(set(x)))
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unit, pa.int32()), pa.array(part, pa.int32()), b.column("lang").take(at), b.column("source").take(at), *(pa.array(x, pa.binary()).cast(pa.string()) for x in (terms, kinds))],
                    names=["unit", "part", "lang", "source", "terms", "kinds"],
                )

    return task


def _sums(unit: int, part: int, block: int, place: np.ndarray):
    """Adds up sparse vectors per (lang, source) and block of terms, whose
    numbers are their places in UTF-8 order."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        keys, counts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, inverse, np.concatenate(counts))
            group, term = key >> 32, key & 0xFFFFFFFF
            bounds = runs(group, term // block)
            names = list(groups)
            first = bounds[:-1]
            lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, kind))
            m = len(first)
            return pa.RecordBatch.from_arrays(
                [pa.array([names[g][0] for g in group[first]]), pa.array([names[g][1] for g in group[first]]), pa.array([unit] * m, pa.int32()), pa.array([part] * m, pa.int32()),
                 pa.array(term[first] // block), lists(term % block, pa.int32()), lists(n, pa.int64())],
                names=["lang", "source", "unit", "part", "block", "terms", "counts"],
            )

        for b in batches:
            vector = b.column("vector")
            own = np.array([groups.setdefault(x, len(groups)) for x in zip(b.column("lang").to_pylist(), b.column("source").to_pylist())], np.int64)
            size = vector.field("indices").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            keys.append((np.repeat(own, size) << 32) | place[vector.field("indices").flatten().to_numpy(zero_copy_only=False)])
            counts.append(vector.field("values").flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            held += len(counts[-1])
            if held >= FLUSH:
                yield flush()
                keys, counts, held = [], [], 0
        if held:
            yield flush()

    return task


SUMS = "lang string, source string, unit int, part int, block long, terms array<int>, counts array<long>"


def _share(count: np.ndarray, n: np.ndarray) -> np.ndarray:
    """p = 1 + floor(SCALE (count + 1) / (N + V)); n holds N + V."""
    if count.max(initial=0) >= 9_000_000_000:  # beyond 64 bits: Python's integers
        return (1 + SCALE * (count.astype(object) + 1) // n).astype(np.int64)
    return 1 + SCALE * (count + 1) // n


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


@dataclass
class _Block:
    """Sums of one block of terms of one language, by term, then source."""

    lang: str
    unit: int
    part: int
    sources: list[str]
    n: np.ndarray  # N + V of each source
    all_n: int  # N + V of the language
    term: np.ndarray
    own: np.ndarray  # source number
    count: np.ndarray


def _blocks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[_Block]:
    keys = ["lang", "unit", "part", "block"]
    for t in whole_runs(batches, keys):
        cols = [np.array(t.column(k).to_pylist(), object) for k in keys]
        bounds = runs(*cols)
        for a, z in zip(bounds[:-1], bounds[1:]):
            x = t.slice(a, z - a).combine_chunks()
            sources, own = np.unique(np.array(x.column("source").to_pylist(), object), return_inverse=True)
            n = np.zeros(len(sources), np.int64)
            n[own] = x.column("n").to_numpy()
            terms, counts = (x.column(k).combine_chunks() for k in ("terms", "counts"))
            place = terms.flatten().to_numpy().astype(np.int64) + cols[3][a] * size
            key, inverse = np.unique(place * len(sources) + np.repeat(own, terms.value_lengths().to_numpy()), return_inverse=True)
            count = np.zeros(len(key), np.int64)
            np.add.at(count, inverse, counts.flatten().to_numpy())
            yield _Block(cols[0][a], cols[1][a], cols[2][a], list(sources), n, x.column("all_n")[0].as_py(), key // len(sources), key % len(sources), count)


def _shared_terms(b: _Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(source, other, value) over the terms that both have, some ``FLUSH`` pairs
    at a time: f(p, q) - f(p, q of no count) - f(p of no count, q) + f of both."""
    zero, p = _share(np.zeros(len(b.n), np.int64), b.n), _share(b.count, b.n[b.own])
    bounds = runs(b.term)
    size = np.diff(bounds)
    each, first = np.repeat(size, size), np.repeat(bounds[:-1], size)
    before = np.cumsum(each) - each
    a = 0
    while a < len(each):
        z = max(a + 1, int(np.searchsorted(before, before[a] + FLUSH)))
        i = np.repeat(np.arange(a, z), each[a:z])
        j = np.arange(len(i)) - np.repeat(before[a:z] - before[a], each[a:z]) + first[i]
        i, j = i[i != j], j[i != j]
        x, y = b.own[i], b.own[j]
        yield x, y, _distance(p[i], p[j]) - _distance(p[i], zero[y]) - _distance(zero[x], p[j]) + _distance(zero[x], zero[y])
        a = z


def _pair_sums(size: int):
    """Per block: (lang, source, item, null, value of the terms both have), and
    (lang, source, null, count, number of terms of that count)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, size):
            m = len(b.sources)
            total: dict[int, int] = {}
            for x, y, v in _shared_terms(b):
                if m * m <= FLUSH:
                    code, got = np.arange(m * m), np.zeros(m * m, np.int64)
                    np.add.at(got, x * m + y, v)
                else:
                    code, inverse = np.unique(x * m + y, return_inverse=True)
                    got = np.zeros(len(code), np.int64)
                    np.add.at(got, inverse, v)
                use = np.flatnonzero(got)
                for c, g in zip(code[use].tolist(), got[use].tolist()):
                    total[c] = total.get(c, 0) + g
            order = np.lexsort((b.count, b.own))
            own, count = b.own[order], b.count[order]
            bounds = runs(own, count)
            name = lambda k: [b.sources[s] for s in k]
            pair = np.fromiter(total, np.int64, len(total))
            own, count = own[bounds[:-1]], count[bounds[:-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.lang] * (len(pair) + len(own))), pa.array(name(pair // m) + name(own)), pa.array(name(pair % m) + [None] * len(own), pa.string()),
                 pa.array([None] * len(pair) + count.tolist(), pa.int64()), pa.array([*total.values(), *np.diff(bounds).tolist()], pa.int64())],
                names=["lang", "source", "item", "count", "value"],
            )

    return task


def _top_terms(size: int, top: int):
    """Per block and source its first ``top`` terms by value, then place."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, size):
            bounds = runs(b.term)
            whole = np.repeat(np.add.reduceat(b.count, bounds[:-1]), np.diff(bounds))
            p, q = _share(b.count, b.n[b.own]), _share(whole, np.full(len(whole), b.all_n))
            use = np.flatnonzero(p > q)
            value = _distance(p[use], q[use])
            order = np.lexsort((b.term[use], -value, b.own[use]))
            bounds = runs(b.own[use][order])
            place = np.arange(len(order)) - np.repeat(bounds[:-1], np.diff(bounds))
            order = order[place < top]
            k = len(order)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.lang] * k, pa.string()), pa.array([b.sources[s] for s in b.own[use][order]], pa.string()), pa.array([b.unit] * k, pa.int32()), pa.array([b.part] * k, pa.int32()),
                 pa.array(b.term[use][order]), pa.array(value[order])],
                names=["lang", "source", "unit", "part", "term", "value"],
            )

    return task


def _units(groups: DataFrame) -> tuple[dict[str, int], int, dict[int, int]]:
    """Units of the large languages, that of the rest, parts of each unit."""
    sizes = groups.groupBy("lang").agg(F.sum("bytes").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    large = sizes.where(F.col("n") * UNITS >= total).orderBy("lang").collect() if total else []  # at most UNITS rows
    units = {r["lang"]: k for k, r in enumerate(large)}
    rest = total - sum(r["n"] for r in large)
    parts = {k: 1 + r["n"] // UNIT_BYTES for k, r in enumerate(large)}
    return units, len(units), parts | ({len(units): 1 + rest // UNIT_BYTES} if rest else {})


def _fit(terms: DataFrame, min_df: int) -> tuple[CountVectorizerModel, list[str], np.ndarray]:
    """The unit's model, its words in UTF-8 order, and each one's place there.
    Document frequencies come from the different terms of each document."""
    terms = terms.select(F.split("kinds", " ").alias("terms"))
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=VOCABULARY).fit(terms)
    words = model.vocabulary
    order = sorted(range(len(words)), key=words.__getitem__)  # code points sort as UTF-8 does
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    return model, [words[k] for k in order], place


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_df: int = MIN_DF, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) rows of parts 'pair' and 'term'."""
    spark = docs.sparkSession
    rows = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"), text_or_empty(text_col).alias("text"))
    groups = materialize(rows.groupBy("lang", "source").agg(F.sum(F.octet_length("text")).alias("bytes")))
    size = max(16, BLOCK_CELLS // (groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1))
    units, rest, parts = _units(groups)
    cut = rows.select("lang", "source", F.col("text").cast("binary").alias("text"))
    cut = cut.mapInArrow(_cut(units, rest, parts), "unit int, part int, lang string, source string, terms string, kinds string")
    cut = materialize(cut, "unit", "part")
    words, sums = [], []
    for unit, part in ((u, p) for u in sorted(parts) for p in range(parts[u])):
        mine = cut.where((F.col("unit") == unit) & (F.col("part") == part))
        model, vocabulary, place = _fit(mine, min_df)
        if not vocabulary:
            continue
        found = spark.createDataFrame(pa.table({"term": np.arange(len(vocabulary)), "word": vocabulary}))
        words.append(materialize(found.select(F.lit(unit).alias("unit"), F.lit(part).alias("part"), "term", *_language(unit, units))))
        vectors = model.transform(mine.select("lang", "source", F.split("terms", " ").alias("terms"))).select("lang", "source", "vector")
        sums.append(materialize(vectors.mapInArrow(_sums(unit, part, size, place), SUMS)))
        del model, vocabulary, place, found, vectors
        free_shuffles(cut)  # and the model's broadcast
    words = _union(words) if words else spark.createDataFrame([], "unit int, part int, term long, lang string, item string")
    sums = _union(sums) if sums else spark.createDataFrame([], SUMS)

    # N + V of each group and language
    kept = words.groupBy("lang").agg(F.count("*").alias("v"))
    total = sums.groupBy("lang", "source").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("m"))
    groups = groups.drop("bytes").join(total, ["lang", "source"], "left").join(kept, "lang", "left").fillna(0, ["m", "v"])
    of_lang = groups.groupBy("lang").agg((F.sum("m") + F.max("v")).alias("all_n"))
    groups = materialize(groups.join(of_lang, "lang").select("lang", "source", "v", (F.col("m") + F.col("v")).alias("n"), "all_n"))
    keys = ["lang", "unit", "part", "block"]
    blocks = sums.join(groups.select("lang", "source", "n", "all_n"), ["lang", "source"])
    blocks = materialize(blocks.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "source", "n", "all_n", "terms", "counts"))
    release(cut)
    return _pairs(blocks, groups, size).unionByName(_terms(blocks, words, size, top))


def _language(unit: int, units: dict[str, int]) -> list[Column]:
    """lang and item of a unit's words."""
    own = [x for x, k in units.items() if k == unit]
    if own:
        return [F.lit(own[0]).alias("lang"), F.col("word").alias("item")]
    lang = F.decode(F.unhex(F.substring_index("word", "\0", 1)), "UTF-8")
    return [lang.alias("lang"), F.substring_index("word", "\0", -1).alias("item")]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _sql_share(count: str, n: str) -> str:
    return f"(1 + (cast({SCALE} as decimal(18,0)) * cast({count} + 1 as decimal(20,0))) div {n})"


def _sql_distance(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def _pairs(blocks: DataFrame, groups: DataFrame, size: int) -> DataFrame:
    found = blocks.mapInArrow(_pair_sums(size), "lang string, source string, item string, count long, value long")
    found = materialize(found.groupBy("lang", "source", "item", "count").agg(F.sum("value").alias("value")))
    known = groups.where("v > 0").select("lang", "source", "n", "v", F.expr(_sql_share("0", "n")).alias("zero"))
    other = known.select("lang", F.col("source").alias("other"), F.col("n").alias("other_n"), F.col("zero").alias("other_zero"))
    both = _sql_distance("zero", "other_zero")
    # what a source's own terms change, against a term that neither has
    alone = found.where("item is null").drop("item").join(known, ["lang", "source"]).withColumn("p", F.expr(_sql_share("count", "n")))
    alone = alone.join(other, "lang").where("source <> other")
    alone = alone.select("lang", F.expr(
        f"inline(array(struct(source, other as item, value * ({_sql_distance('p', 'other_zero')} - {both}) as value),"
        f" struct(other as source, source as item, value * ({_sql_distance('other_zero', 'p')} - {_sql_distance('other_zero', 'zero')}) as value)))"
    ))
    none = known.join(other, "lang").where("source <> other").select("lang", "source", F.col("other").alias("item"), F.expr(f"v * {both}").alias("value"))
    empty = groups.where("v = 0")
    empty = empty.select("lang", "source").join(empty.select("lang", F.col("source").alias("item")), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    value = _union([none, alone, found.where("item is not null").drop("count"), empty])
    value = value.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(value, "pair")


def _terms(blocks: DataFrame, words: DataFrame, size: int, top: int) -> DataFrame:
    found = blocks.mapInArrow(_top_terms(size, top), "lang string, source string, unit int, part int, term long, value long")
    found = found.join(words.drop("lang"), ["unit", "part", "term"]).select("lang", "source", "item", "value")
    return _ranked(found, "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
