"""Language-model scoring: an interpolated modified Kneser-Ney trigram model,
counted in Spark, stored as sorted hash arrays that workers memory-map.

Tokens are a text's words (ASCII letters lower-cased) and one end.  A word is
known by its XXH64 hash; its id is its rank among all training words.

1. Words: the tasks' word counts are summed by hash and written as sorted hash
   arrays, cut by the hash's top bits.
2. Triples (u, v, w): a task counts the triples of about a million tokens, and
   sends them, as sorted compressed columns, to the shard of the middle word v.
   There every count that needs v is whole: contexts (u, v), triples, and the
   numbers of different left neighbours of (v, w).  A frequent v is dealt over
   several shards by u; its pairs are then summed under a hash of (v, w).
3. Each shard is written as hash arrays: per bucket of the hash's top bits the
   sorted 32-bit rests, with a code into the shard's table of values.
4. Word statistics of all shards are summed per range of ids.
5. Scoring: workers map the files and look up a block's triples shard by shard.

Discounts come from the counts of counts of each order (0.5, 1, 1.5 where a
count of counts is 0).  Seen contexts interpolate, unseen ones fall to the next
order; the lowest order interpolates with 1 / (V + 1), V training tokens and one
for all unknown words, so the probabilities of a context add up to 1.

Memory of a task: one block of tokens, or one shard (about ``SHARD`` training
tokens); of the driver: one number per ``WORDS_PER_FILE`` words.  The model lies
in the shared folder and grows with the different triples of the corpus; where
workers cannot map that folder, a file is copied to an unlinked local file for
as long as it is mapped.

Nulls: null text is empty (one token, the end); a null id counts as '' (crc32 0:
held out) and keeps its row.  Repeated rows are counted, and scored, each.  No
training rows: every probability is 1 (score 0), as the base formula gives.
"""

from __future__ import annotations

import atexit
import json
import os
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import _forget, col, free_shuffles, materialize, release, runs, shared_dir, text_or_empty, whole_runs

#: Tokens of a block; with one more piece of text it stays below 2^21 words.
BLOCK = 1 << 20
TEXT_PIECE = 1 << 20
#: Training tokens of a shard, of a piece of a frequent word, words of a file.
SHARD, HOT, WORDS_PER_FILE = 1 << 20, 1 << 18, 1 << 18
END = b""  # no word is empty
NONE_, START_, END_ = range(3)  # local numbers
FALLBACK = (0.5, 1.0, 1.5)


@dataclass(frozen=True)
class Sizes:
    block: int = BLOCK
    piece: int = TEXT_PIECE
    shard: int = SHARD
    hot: int = HOT
    words: int = WORDS_PER_FILE


# ---- files -------------------------------------------------------------------


@dataclass(frozen=True)
class Store:
    """Files of named arrays under a folder, written whole and memory-mapped."""

    root: str

    def _at(self, name: str) -> tuple[pyarrow.fs.FileSystem, str]:
        if "://" not in self.root and not self.root.startswith("file:"):
            return pyarrow.fs.LocalFileSystem(), f"{self.root}/{name}"
        return pyarrow.fs.FileSystem.from_uri(f"{re.sub('^file:/+', 'file:///', self.root)}/{name}")

    def write(self, name: str, arrays: dict[str, np.ndarray]) -> None:
        """A retried task writes the same bytes; the last rename wins."""
        heads, at = {}, 0
        for k, a in arrays.items():
            heads[k] = (a.dtype.str, a.shape, at)
            at += -(-a.nbytes // 8) * 8
        head = json.dumps(heads).encode()
        head += b" " * (-len(head) % 8)
        fs, path = self._at(name)
        fs.create_dir(os.path.dirname(path), recursive=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as f:
            f.write(len(head).to_bytes(8, "little") + head)
            for a in arrays.values():
                f.write(np.ascontiguousarray(a).tobytes() + bytes(-a.nbytes % 8))
        try:
            fs.move(part, path)
        except OSError:  # a file system whose rename does not overwrite
            if fs.get_file_info(path).type != pyarrow.fs.FileType.File:
                raise
            fs.delete_file(part)

    def open(self, name: str) -> dict[str, np.ndarray] | None:
        """The file's arrays, mapped; None if there is no such file."""
        fs, path = self._at(name)
        if fs.get_file_info(path).type != pyarrow.fs.FileType.File:
            return None
        if isinstance(fs, pyarrow.fs.LocalFileSystem):
            raw = np.memmap(path, np.uint8, "r").view(np.ndarray)
        else:
            with tempfile.TemporaryFile() as copy, fs.open_input_stream(path) as f:
                while piece := f.read(1 << 22):
                    copy.write(piece)
                copy.flush()
                raw = np.memmap(copy, np.uint8, "r").view(np.ndarray)
        n = 8 + int.from_bytes(raw[:8].tobytes(), "little")
        out = {}
        for k, (kind, shape, at) in json.loads(raw[8:n].tobytes()).items():
            size = int(np.prod(shape)) * np.dtype(kind).itemsize
            out[k] = raw[n + at : n + at + size].view(kind).reshape(shape)
        return out


    def mapped(self, name: str) -> dict[str, np.ndarray] | None:
        """``open``, kept mapped by the worker for its next block."""
        if len(_MAPPED) >= MAPPED:
            _MAPPED.clear()
        if (self.root, name) not in _MAPPED:
            _MAPPED[self.root, name] = self.open(name)
        return _MAPPED[self.root, name]


#: Files that a worker keeps mapped.
MAPPED = 512
_MAPPED: dict[tuple[str, str], dict[str, np.ndarray] | None] = {}


# ---- arrays ------------------------------------------------------------------


def _hash(*cols: np.ndarray) -> np.ndarray:
    h = np.zeros(len(cols[0]), np.uint64)
    for c in cols:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def _pack(cols: list[np.ndarray], kind: type) -> bytes:
    """Equal-length columns as byte planes, compressed; the first is sorted, and
    packed as differences."""
    size = np.dtype(kind).itemsize
    cols = [np.diff(cols[0], prepend=cols[0].dtype.type(0)), *cols[1:]]
    raw = b"".join(np.ascontiguousarray(c.astype(kind).view(np.uint8).reshape(-1, size).T).tobytes() for c in cols)
    return pa.compress(raw, "zstd", asbytes=True)


def _unpack(blob: bytes, n: int, k: int, kind: type) -> list[np.ndarray]:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob, n * k * size, "zstd"), np.uint8).reshape(k, size, n)
    first, *rest = (np.ascontiguousarray(p.T).view(kind).ravel() for p in planes)
    return [np.cumsum(first, dtype=kind), *rest]


def _table(name: str, h: np.ndarray, values: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted hash array: bucket starts, sorted 32-bit rests, codes, values."""
    bits = max(1, (len(h) // 8).bit_length())
    bucket, rest = h >> np.uint64(64 - bits), h & np.uint64(0xFFFFFFFF)
    order = np.argsort((bucket << np.uint64(32)) | rest)
    if values.shape[1] == 1 and len(values) and values.max() < 1 << 20:
        kinds = np.flatnonzero(np.bincount(values[:, 0]))
        code = np.searchsorted(kinds, values[:, 0])
        kinds = kinds[:, None]
    else:
        seen, code = np.unique(_hash(*values.T), return_index=True, return_inverse=True)[1:]
        kinds = values[seen]
    starts = np.searchsorted(bucket[order], np.arange((1 << bits) + 1, dtype=np.uint64))
    return {
        f"{name}.starts": starts.astype(np.uint32), f"{name}.rest": rest[order].astype(np.uint32),
        f"{name}.code": code[order].astype(np.min_scalar_type(max(0, len(kinds) - 1))), f"{name}.values": kinds.astype(np.int64),
    }


def _find(file: dict[str, np.ndarray], name: str, h: np.ndarray) -> np.ndarray:
    """Values of the hashes, zeros where they are not in the table."""
    starts, rest, code, values = (file[f"{name}.{x}"] for x in ("starts", "rest", "code", "values"))
    out = np.zeros((len(h), values.shape[1]), np.int64)
    if not len(rest) or not len(h):
        return out
    bucket = (h >> np.uint64(64 - ((len(starts) - 1).bit_length() - 1))).astype(np.int64)
    want = h.astype(np.uint32)
    at, stop = starts[bucket].astype(np.int64), starts[bucket + 1].astype(np.int64)
    middle = (at + stop) >> 1  # half of a bucket, then one place of each open bucket a round
    at = np.where((middle < stop) & (rest[np.minimum(middle, len(rest) - 1)] <= want), middle, at)
    left = np.flatnonzero(at < stop)
    at, stop, want = at[left], stop[left], want[left]
    while len(left):
        got = rest[at]
        hit = got == want
        out[left[hit]] = values[code[at[hit]]]
        at += 1
        on = (got < want) & (at < stop)
        left, at, stop, want = left[on], at[on], stop[on], want[on]
    return out


# ---- tokens ------------------------------------------------------------------


def tokens(text: bytes, piece: int) -> Iterator[list[bytes]]:
    """The tokens of a text, in lists of those of about ``piece`` bytes."""
    at = 0
    while len(text) - at > piece:
        cut = re.compile(rb"[\x20\x09-\x0D]").search(text, at + piece)
        if cut is None:
            break
        yield text[at : cut.start()].lower().split()
        at = cut.end()
    yield [*text[at:].lower().split(), END]


class _Local(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


@dataclass
class Block:
    """Consecutive triples: ``seq`` has two entries of context before each run
    of tokens, ``at`` the tokens' places in it, ``doc`` their row numbers."""

    words: list[bytes]
    seq: np.ndarray
    at: np.ndarray
    doc: np.ndarray


def blocks(texts: Iterable[bytes], sizes: Sizes) -> Iterator[Block]:
    """Blocks of about ``sizes.block`` tokens; texts may span blocks."""

    def fresh() -> _Local:
        return _Local({b" none": NONE_, b" start": START_, END: END_})  # words hold no space

    def done() -> Block:
        return Block(list(local), np.concatenate(seqs), np.concatenate(ats), np.concatenate(docs))

    local, seqs, ats, docs, n, size = fresh(), [], [], [], 0, 0
    for doc, text in enumerate(texts):
        before = [b" none", b" start"]
        for words in tokens(text, sizes.piece):
            if n >= sizes.block:
                yield done()
                local, seqs, ats, docs, n, size = fresh(), [], [], [], 0, 0
            seqs.append(np.fromiter(map(local.__getitem__, [*before, *words]), np.int64, len(words) + 2))
            ats.append(np.arange(size + 2, size + 2 + len(words)))
            docs.append(np.full(len(words), doc))
            n, size = n + len(words), size + 2 + len(words)
            before = [*before, *words][-2:]
    if seqs:
        yield done()


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)


# ---- the model ---------------------------------------------------------------


@dataclass
class Model:
    """What a task needs to know; everything else lies in the store's files."""

    store: Store
    sizes: Sizes
    offsets: np.ndarray  # first id of each file of words, then their number
    bits: int  # of the hash that name the file of a word
    n_tokens: int
    n_docs: int
    shards: int
    hot_shards: int = 1
    discounts: tuple[tuple[float, ...], ...] = ()
    pairs: int = 0  # different (v, w): sum of all left-neighbour counts of words
    unseen: float = 1.0

    @property
    def start(self) -> int:
        return int(self.offsets[-1])

    def lookup(self, words: list[bytes], stats: bool) -> tuple[np.ndarray, np.ndarray]:
        """Per local word its id (-1: unknown) and count; with ``stats`` also
        (left neighbours, pair total, pairs seen once, twice, more often)."""
        ids, got = np.full(len(words), -1), np.zeros((len(words), 6 if stats else 1), np.int64)
        ids[START_], got[START_, 0] = self.start, self.n_docs
        h = _word_hashes(words)
        h[[NONE_, START_]] = 0
        file = (h >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)
        order = np.argsort(file, kind="stable")
        bounds = runs(file[order])
        for a, b in zip(bounds[:-1], bounds[1:]):
            k, mine = file[order[a]], order[a:b]
            if (f := self.store.mapped(f"hash-{k}")) is None or not len(f["hash"]):
                continue
            at = np.minimum(np.searchsorted(f["hash"], h[mine]), len(f["hash"]) - 1)
            hit = (f["hash"][at] == h[mine]) & (mine != NONE_) & (mine != START_)
            ids[mine[hit]] = self.offsets[k] + at[hit]
            got[mine[hit], 0] = f["count"][at[hit]]
        ids[NONE_] = self.start + 1
        if stats:
            known = np.flatnonzero((ids >= 0) & (ids <= self.start))
            file = self.file_of(ids[known])
            order = np.argsort(file, kind="stable")
            bounds = runs(file[order])
            for a, b in zip(bounds[:-1], bounds[1:]):
                k, mine = file[order[a]], known[order[a:b]]
                got[mine, 1:] = self.store.mapped(f"words-{k}")["stats"][ids[mine] - self.offsets[k]]
        return ids, got

    def file_of(self, ids: np.ndarray) -> np.ndarray:
        """Start, one past the last word, is in the last file that has words."""
        return np.searchsorted(self.offsets, np.minimum(ids, self.start - 1), "right") - 1

    def shard_of(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        salt = _hash(np.where(v == self.start, w, u)) % pieces.astype(np.uint64)
        return (_hash(v, salt) % np.uint64(self.shards)).astype(np.int64)

    def pieces(self, counts: np.ndarray) -> np.ndarray:
        return 1 + counts // self.sizes.hot


def _rows(**cols: list | np.ndarray) -> pa.RecordBatch:
    kinds = {"shard": pa.int64(), "n": pa.int64(), "blob": pa.binary(), "kind": pa.int32(), "counts": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in cols.items()], names=list(cols))


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
    for b in batches:
        for x in b.column("text"):
            yield x.as_py()


def _by_run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(shard, its rows) of batches sorted by shard."""
    for t in whole_runs(batches, ["shard"]):
        shard = t.column("shard").to_numpy()
        bounds = runs(shard)
        for a, z in zip(bounds[:-1], bounds[1:]):
            yield int(shard[a]), t.slice(a, z - a)


def _count_words(sizes: Sizes):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()

        def flush() -> pa.RecordBatch:
            n = np.fromiter(got.values(), np.int64, len(got))
            return pa.RecordBatch.from_arrays([pa.array(_word_hashes(list(got)).view(np.int64)), pa.array(n)], names=["h", "n"])

        for text in _texts(batches):
            for words in tokens(text, sizes.piece):
                got.update(words)
                if len(got) > sizes.block // 2:
                    yield flush()
                    got.clear()
        if got:
            yield flush()

    return task


def _write_words(store: Store):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, t in _by_run(batches):
            h, n = t.column("h").to_numpy().view(np.uint64), t.column("n").to_numpy()
            order = np.argsort(h)
            store.write(f"hash-{k}", {"hash": h[order], "count": n[order]})
            yield _rows(shard=[k], n=[len(h)])

    return task


def _count_triples(model: Model):
    """Per block: its different triples with counts, by shard."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(_texts(batches), model.sizes):
            ids, stats = model.lookup(b.words, False)
            (v, u, w), _, n = distinct_triples(b, ids)
            shard = model.shard_of(ids[u], ids[v], ids[w], model.pieces(stats[v, 0]))
            order = np.argsort(shard.astype(np.min_scalar_type(model.shards)), kind="stable")
            shard = shard[order]
            bounds = runs(shard)
            yield _rows(
                shard=shard[bounds[:-1]], n=np.diff(bounds),
                blob=[_pack([*(ids[x[order[a:z]]] for x in (v, u, w)), n[order[a:z]]], np.uint32) for a, z in zip(bounds[:-1], bounds[1:])],
            )

    return task


def distinct_triples(b: Block, ids: np.ndarray, where: bool = False) -> tuple[tuple[np.ndarray, ...], np.ndarray | None, np.ndarray]:
    """A block's different (v, u, w), as local numbers sorted by their ids;
    ``where``: of each token, the place of its triple; times each occurs."""
    by_id = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.uint64)
    rank[by_id] = np.arange(len(ids), dtype=np.uint64)
    seq, wide = rank[b.seq], np.uint64(21)
    packed = (seq[b.at - 1] << (wide + wide)) | (seq[b.at - 2] << wide) | seq[b.at]
    if where:
        triples, place, n = np.unique(packed, return_inverse=True, return_counts=True)
    else:
        (triples, n), place = np.unique(packed, return_counts=True), None
    low = np.uint64((1 << 21) - 1)
    return tuple(by_id[((triples >> x) & low).astype(np.int64)] for x in (wide + wide, wide, np.uint64(0))), place, n


def _of_counts(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def _per_run(n: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(total, ones, twos, more) of each run of ``n``."""
    if not len(n):
        return np.zeros((0, 4), np.int64)
    return np.column_stack([np.add.reduceat(x, bounds[:-1]) for x in (n, (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n > 2).astype(np.int64))])


def _pair_stats(model: Model, v: np.ndarray, w: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows of kind 1: what pairs (sorted by v) add to the statistics of their
    words, by file of words: (id, left neighbours, total, ones, twos, more)."""
    bounds = runs(v)
    right, left = np.unique(w, return_counts=True)
    own = _per_run(n, bounds)
    ids = np.concatenate([right, v[bounds[:-1]]])
    cols = np.zeros((len(ids), 5), np.int64)
    cols[: len(right), 0] = left
    cols[len(right) :, 1:] = own
    order = np.argsort(ids, kind="stable")
    ids, cols = ids[order], cols[order]
    file = model.file_of(ids)
    cut = runs(file)
    return _rows(
        kind=[1] * (len(cut) - 1), shard=file[cut[:-1]], n=np.diff(cut), counts=[None] * (len(cut) - 1),
        blob=[_pack([ids[a:z], *cols[a:z].T], np.uint64) for a, z in zip(cut[:-1], cut[1:])],
    )


def _merge_shard(model: Model):
    """Rows per shard: kind 0 counts of counts (triples, then pairs), kind 1
    word statistics, kind 2 pairs of frequent words still to be summed."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, t in _by_run(batches):
            parts = [_unpack(b.as_py(), n.as_py(), 4, np.uint32) for b, n in zip(t.column("blob"), t.column("n"))]
            v, u, w, n = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
            del parts
            cut = runs(v)  # each part is sorted by v
            vs, number = np.unique(v[cut[:-1]], return_inverse=True)
            number, u, w, n = sum_triples(np.repeat(number, np.diff(cut)), u, w, n, (model.start + 1).bit_length())
            v = vs[number]

            # triples and contexts; those before a text's first token are pairs
            real = v != model.start
            bounds = runs(number[real], u[real])
            c = n[real]
            at = np.flatnonzero(real)[bounds[:-1]] if len(c) else np.empty(0, np.int64)
            out = _table("triple", _hash(u[real], v[real], w[real]), c[:, None])
            out |= _table("context", _hash(u[at], v[at]), _per_run(c, bounds))

            # pairs: different left neighbours, or times at the start (the last v)
            pairs, left = np.unique((number[real] << 32) | w[real], return_counts=True)
            number, w, left = (np.concatenate(x) for x in ((pairs >> 32, number[~real]), (pairs & 0xFFFFFFFF, w[~real]), (left, n[~real])))
            v, hot = vs[number], _is_hot(model, vs)[number]
            cold = ~hot
            out |= _table("pair", _hash(v[cold], w[cold]), left[cold][:, None])
            model.store.write(f"shard-{k}", out)
            yield _rows(kind=[0], shard=[k], n=[0], counts=[[*_of_counts(c), *_of_counts(left[cold])]], blob=[None])
            if cold.any():
                yield _pair_stats(model, v[cold], w[cold], left[cold])
            if hot.any():
                v, w, left = v[hot], w[hot], left[hot]
                to = (_hash(v, w) % np.uint64(model.hot_shards)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                cut = runs(to[order])
                yield _rows(
                    kind=[2] * (len(cut) - 1), shard=to[order][cut[:-1]], n=np.diff(cut), counts=[None] * (len(cut) - 1),
                    blob=[_pack([x[order[a:z]] for x in (v, w, left)], np.uint64) for a, z in zip(cut[:-1], cut[1:])],
                )

    return task


def sum_triples(v: np.ndarray, u: np.ndarray, w: np.ndarray, n: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Sorted different (v, u, w) with their summed n; u and w have ``bits``
    bits.  The n of a shard add up to about ``SHARD``, so rows can be repeated."""
    if 2 * bits + int(v.max()).bit_length() <= 63:
        keys, n = np.unique(np.repeat((v << 2 * bits) | (u << bits) | w, n), return_counts=True)
        low = (1 << bits) - 1
        return keys >> 2 * bits, (keys >> bits) & low, keys & low, n
    order = np.lexsort((w, u, v))
    v, u, w, n = v[order], u[order], w[order], n[order]
    first = runs(v, u, w)
    return v[first[:-1]], u[first[:-1]], w[first[:-1]], np.add.reduceat(n, first[:-1])


def _is_hot(model: Model, ids: np.ndarray) -> np.ndarray:
    """Which ids are dealt over several shards, by their counts."""
    counts = np.zeros(len(ids), np.int64)
    counts[ids == model.start] = model.n_docs
    words = np.flatnonzero(ids < model.start)
    file = model.file_of(ids[words])
    bounds = runs(file)
    for a, b in zip(bounds[:-1], bounds[1:]):
        k = file[a]
        counts[words[a:b]] = model.store.open(f"hash-{k}")["count"][ids[words[a:b]] - model.offsets[k]]
    return model.pieces(counts) > 1


def _merge_hot(model: Model):
    """Pairs of frequent words, summed; rows as those of ``_merge_shard``."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, t in _by_run(batches):
            parts = [_unpack(b.as_py(), n.as_py(), 3, np.uint64) for b, n in zip(t.column("blob"), t.column("n"))]
            v, w, n = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
            order = np.lexsort((w, v))
            v, w, n = v[order], w[order], n[order]
            first = runs(v, w)
            v, w, n = v[first[:-1]], w[first[:-1]], np.add.reduceat(n, first[:-1])
            model.store.write(f"hot-{k}", _table("pair", _hash(v, w), n[:, None]))
            yield _rows(kind=[0], shard=[k], n=[0], counts=[[0, 0, 0, 0, *_of_counts(n)]], blob=[None])
            yield _pair_stats(model, v, w, n)

    return task


def _write_stats(model: Model):
    """Statistics of the words of a file, as one array by id; counts of counts
    of the left neighbours, and their sum."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, t in _by_run(batches):
            out = np.zeros((model.offsets[k + 1] - model.offsets[k] + 1, 5), np.int64)
            for blob, n in zip(t.column("blob"), t.column("n")):
                ids, *cols = _unpack(blob.as_py(), n.as_py(), 6, np.uint64)
                np.add.at(out, ids.astype(np.int64) - model.offsets[k], np.column_stack(cols).astype(np.int64))
            model.store.write(f"words-{k}", {"stats": out})
            left = out[:, 0]
            yield _rows(kind=[0], shard=[k], n=[0], counts=[[*_of_counts(left), int((left > 2).sum()), int(left.sum())]], blob=[None])

    return task


SHARD_ROWS = "kind int, shard long, n long, counts array<long>, blob binary"


def discounts(n: list[int]) -> tuple[float, ...]:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and more, from the
    numbers of n-grams of count 1 to 4."""
    if min(n) <= 0:
        return (0.0, *FALLBACK)
    y = n[0] / (n[0] + 2 * n[1])
    d = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return (0.0, *d) if all(0 < x <= k + 1 for k, x in enumerate(d)) else (0.0, *FALLBACK)


def _by_shard(rows: DataFrame, shards: int) -> DataFrame:
    return rows.repartition(shards, "shard").sortWithinPartitions("shard")


def _sum_counts(rows: DataFrame, n: int) -> list[int]:
    got = rows.where("kind = 0").agg(*(F.sum(F.get("counts", F.lit(k))).alias(f"c{k}") for k in range(n))).first()
    return [x or 0 for x in got]


def train(texts: DataFrame, sizes: Sizes = Sizes()) -> Model | None:
    """A model of the texts (a column ``text``, binary, not null); None if there
    are none."""
    spark = texts.sparkSession
    store = Store(f"{shared_dir(spark)}/llm-lm-{uuid.uuid4().hex}")
    atexit.register(_forget, spark, store.root)
    words = texts.select("text").mapInArrow(_count_words(sizes), "h long, n long")
    words = materialize(words.groupBy("h").agg(F.sum("n").alias("n")))
    n_words, n_tokens = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_tokens:
        return None
    if n_words + 2 >= 1 << 32:
        raise ValueError("ids of words have 32 bits")
    bits = max(0, (-(-n_words // sizes.words) - 1).bit_length())
    file = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
    files = _by_shard(words.withColumn("shard", file), 1 << bits).mapInArrow(_write_words(store), "shard long, n long").collect()
    sized = np.zeros(1 << bits, np.int64)
    for k, n in files:
        sized[k] = n
    end = xxhash.xxh64_intdigest(END)
    n_docs = words.where(F.col("h") == F.lit(end - (1 << 64) if end >> 63 else end)).first()["n"]
    release(words)
    free_shuffles(texts)
    shards = -(-n_tokens // sizes.shard)
    model = Model(store, sizes, np.concatenate([[0], np.cumsum(sized)]), bits, n_tokens, n_docs, shards, shards)
    triples = texts.select("text").mapInArrow(_count_triples(model), "shard long, n long, blob binary")
    merged = materialize(_by_shard(triples, shards).mapInArrow(_merge_shard(model), SHARD_ROWS))
    free_shuffles(texts)
    hot = materialize(_by_shard(merged.where("kind = 2"), shards).mapInArrow(_merge_hot(model), SHARD_ROWS))
    stats = merged.where("kind = 1").unionByName(hot.where("kind = 1"))
    stats = materialize(_by_shard(stats, 1 << bits).mapInArrow(_write_stats(model), SHARD_ROWS).select("kind", "counts"))
    c, left = [a + b for a, b in zip(_sum_counts(merged, 8), _sum_counts(hot, 8))], _sum_counts(stats, 6)
    release(merged, hot, stats)
    free_shuffles(texts)
    model.discounts = (discounts(left[:4]), discounts(c[4:]), discounts(c[:4]))
    model.pairs = left[5]
    model.unseen = sum(d * n for d, n in zip(model.discounts[0][1:], (left[0], left[1], left[4]))) / model.pairs
    return model


# ---- scoring -----------------------------------------------------------------


def _less(n: np.ndarray, d: tuple[float, ...]) -> np.ndarray:
    return n - np.array(d)[np.minimum(n, 3)]


def _back_off(stats: np.ndarray, d: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(1 / total, back-off mass) of (total, ones, twos, more); (0, 1) if unseen."""
    seen, total = stats[:, 0] > 0, np.maximum(stats[:, 0], 1)
    return np.where(seen, 1 / total, 0.0), np.where(seen, stats[:, 1:] @ np.array(d[1:]) / total, 1.0)


def probabilities(model: Model, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Per token of a block: probability in its context; training count."""
    ids, stats = model.lookup(b.words, True)
    (lv, lu, lw), place, _ = distinct_triples(b, ids, where=True)
    u, v, w = ids[lu], ids[lv], ids[lw]
    n = len(w)
    one, two, three = model.discounts
    pair, triple, share, mass = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.ones(n)
    pieces = model.pieces(stats[:, 0])[lv]
    seen = np.flatnonzero(v >= 0)
    shard = model.shard_of(u[seen], v[seen], w[seen], pieces[seen])
    order = np.argsort(shard.astype(np.min_scalar_type(model.shards)), kind="stable")
    seen, shard = seen[order], shard[order]
    bounds = runs(shard)
    for a, z in zip(bounds[:-1], bounds[1:]):
        if (f := model.store.mapped(f"shard-{shard[a]}")) is None:
            continue
        mine = seen[a:z]
        look = mine[(w[mine] >= 0) & (pieces[mine] == 1)]
        pair[look] = _find(f, "pair", _hash(v[look], w[look]))[:, 0]
        look = mine[(u[mine] >= 0) & (v[mine] != model.start)]
        first = runs(v[look], u[look])  # neighbours share their context
        found = _find(f, "context", _hash(u[look[first[:-1]]], v[look[first[:-1]]]))
        share[look], mass[look] = (np.repeat(x, np.diff(first)) for x in _back_off(found, three))
        look = look[(w[look] >= 0) & (share[look] > 0)]
        triple[look] = _find(f, "triple", _hash(u[look], v[look], w[look]))[:, 0]
    hot = np.flatnonzero((v >= 0) & (w >= 0) & (pieces > 1))
    to = (_hash(v[hot], w[hot]) % np.uint64(model.hot_shards)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    hot, to = hot[order], to[order]
    bounds = runs(to)
    for a, z in zip(bounds[:-1], bounds[1:]):
        if (f := model.store.mapped(f"hot-{to[a]}")) is not None:
            pair[hot[a:z]] = _find(f, "pair", _hash(v[hot[a:z]], w[hot[a:z]]))[:, 0]
    known = ids >= 0
    p = (_less(np.where(known, stats[:, 1], 0), one) / model.pairs + model.unseen / (model.start + 1))[lw]
    word_share, word_mass = _back_off(np.where(known[:, None], stats[:, 2:], 0), two)
    p = _less(pair, two) * word_share[lv] + word_mass[lv] * p
    p = _less(triple, three) * share + mass * p
    return p[place], np.where(known, stats[:, 0], 0)[b.seq[b.at]]


def held_out(id_col: str) -> Column:
    """Documents that the model does not learn from."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (add-0.1 unigrams), score (log10 probability of the text), perplexity."""
    rows = docs.select(col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), text_or_empty(text_col).cast("binary").alias("text"))
    sizes = model.sizes if model else Sizes()
    n_train, n_words = (model.n_tokens, model.start) if model else (0, 0)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros((batch.num_rows, 4))  # tokens, known, base, score
            for b in blocks(_texts([batch]), sizes):
                if model:
                    p, c = probabilities(model, b)
                else:
                    p, c = np.ones(len(b.at)), np.zeros(len(b.at), np.int64)
                bounds = runs(b.doc)
                each = (np.ones(len(c)), c > 0, np.log10((c + 0.1) / (n_train + 0.1 * (n_words + 1))), np.log10(p))
                total[b.doc[bounds[:-1]]] += np.column_stack([np.add.reduceat(x.astype(float), bounds[:-1]) for x in each])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(total[:, k].astype(np.int64)) for k in (0, 1)), pa.array(np.full(len(total), n_train)),
                 pa.array(total[:, 2]), pa.array(total[:, 3]), pa.array(10 ** np.minimum(300, -total[:, 3] / np.maximum(1, total[:, 0])))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(task, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def score_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """``score_documents`` by a model of all documents that are not held out."""
    model = train(docs.where(~held_out(id_col)).select(text_or_empty(text_col).cast("binary").alias("text")), sizes)
    return score_documents(docs, model, id_col, text_col)
