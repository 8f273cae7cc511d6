"""BPE encoding and decoding by a tokenization automaton.

Merges are compiled in rank order, one merge gadget each.  The automaton starts
with one state and an arc for every byte symbol; a state is what may follow the
token just read.  The gadget of merge (u, v) -> w takes every path p -u-> q -v->
r, adds the arc p -w-> r, and sends p's u-arc to a copy of q without the v-arc
(and, if u = v, without the new w-arc, since runs pair from the left).  A copied
state shares all arcs with its original and stores only the arc that was cut, so
48,894 gadgets are three small tables: ``cut`` (u, v) -> rank, ``left`` and
``right``.  Whether a state has an arc is answered from these tables by undoing
gadgets, latest first, and the answer is kept in a transition table.

Every word has exactly one path.  Encoding runs the word's symbols through the
tables: at each place the arcs that the state there has are followed along a
trie of arc labels.  Decoding emits the labels of a path's arcs, joined by one
space (these tokenizers have no decoder).

Text is treated as the tokenizer's file says: its special tokens are found
first, then NFC, lower case per code point, white space dropped, words split by
the file's pattern; a word's bytes become symbols, the last with the word-end
mark.  Results of recent words are kept (``KEPT_WORDS`` entries, two
generations), which only saves time.

Nulls: null text is an empty text (no tokens, empty decoded text); ids are
carried as they are; repeated rows each get their row.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cohortflow.llm.common import col, text_or_empty

KEPT_WORDS = 400_000
FAR = 1 << 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte (byte-level BPE)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    extra = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(extra)) for b in range(256)]


def has_arc(tables: dict, t: int, s: int, before: int = FAR) -> bool:
    """Whether the state after token ``t`` has an arc ``s``, as of the gadgets
    of rank below ``before``."""
    cut, rank, left, right = tables["cut"], tables["rank"], tables["left"], tables["right"]
    while True:
        if cut.get((t << 32) | s, FAR) < before:
            return False
        rt, rs = rank[t], rank[s]
        if rt < 0 and rs < 0:
            return True
        if rt > rs:  # the state was copied from that after t's right part
            before, t = rt, right[t]
        else:  # the arc was added where its left part's arc was, and a run pairs first
            before, s = rs + 1, left[s]


def compile_automaton(path: str) -> dict[str, Any]:
    """The tables of a tokenizer file (byte-level BPE with a word-end mark)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
    size = max(vocab.values()) + 1
    tables: dict[str, Any] = {"cut": {}, "rank": [-1] * size, "left": [-1] * size, "right": [-1] * size, "labels": [""] * size}
    for label, i in vocab.items():
        tables["labels"][i] = label
    made = {i for label, i in vocab.items() if len(label.removesuffix(end) if end and label != end else label) == 1}
    for r, (a, b) in enumerate(spec["model"]["merges"]):
        u, v, w = vocab[a], vocab[b], vocab[a + b]
        if u not in made or v not in made:
            raise ValueError(f"merge {r} uses a token that no earlier merge makes")
        if w in made or not has_arc(tables, u, v, r):
            continue  # no path p -u-> q -v-> r is left: the gadget changes nothing
        tables["cut"][(u << 32) | v] = r
        tables["rank"][w], tables["left"][w], tables["right"][w] = r, u, v
        made.add(w)
    shown = byte_symbols()
    inner = [vocab[c] for c in shown]
    last = [vocab[c + end] for c in shown]
    # trie of arc labels: per node, symbol -> (node, token that ends there or -1)
    trie: list[dict[int, tuple[int, int]]] = [{}]
    lengths = [0] * size
    spelled: dict[int, tuple[int, ...]] = {i: (i,) for i in made if tables["rank"][i] < 0}
    for w in sorted(made, key=lambda i: tables["rank"][i]):
        if tables["rank"][w] >= 0:
            spelled[w] = spelled[tables["left"][w]] + spelled[tables["right"][w]]
        lengths[w], node = len(spelled[w]), 0
        for s in spelled[w][:-1]:
            if s not in trie[node]:
                trie[node][s] = (len(trie), -1)
                trie.append({})
            node = trie[node][s][0]
        last_symbol = spelled[w][-1]
        if last_symbol in trie[node]:
            trie[node][last_symbol] = (trie[node][last_symbol][0], w)
        else:
            trie[node][last_symbol] = (len(trie), w)
            trie.append({})
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for label, i in special.items():
        tables["labels"] += [""] * (i + 1 - len(tables["labels"]))
        tables["labels"][i] = label
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    return tables | {"inner": inner, "last": last, "trie": trie, "lengths": lengths, "special": special, "pattern": pattern, "arcs": [{} for _ in range(size)], "packed": [i.to_bytes(4, "little") for i in range(size)], "words": {}, "older": {}}


def encode_word(tables: dict, word: bytes) -> list[int]:
    """The token ids on the word's path."""
    n, inner, trie, arcs = len(word), tables["inner"], tables["trie"], tables["arcs"]
    if not n:
        return []
    symbols = [inner[b] for b in word]
    symbols[-1] = tables["last"][word[-1]]
    state: list[int] = [-1] * (n + 1)
    for i in range(n):
        node, known = trie[0], arcs[state[i]]
        for j in range(i, n):
            step = node.get(symbols[j])
            if step is None:
                break
            node, s = trie[step[0]], step[1]
            if s < 0 or state[j + 1] >= 0:
                continue
            if i:
                ok = known.get(s)
                if ok is None:
                    ok = known[s] = has_arc(tables, state[i], s)
                if not ok:
                    continue
            state[j + 1] = s
    out, i, lengths = [], n, tables["lengths"]
    while i:
        out.append(state[i])
        i -= lengths[state[i]]
    out.reverse()
    return out


def decode(tables: dict, ids: Iterable[int]) -> str:
    labels = tables["labels"]
    return " ".join([labels[i] for i in ids])


class Codec:
    """Encodes whole texts with the compiled tables."""

    def __init__(self, tables: dict) -> None:
        self.tables = tables
        self.split = regex.compile(tables["pattern"], regex.V0)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(tables["special"], key=len, reverse=True))) + ")")

    def word(self, w: str) -> bytes:
        """A word's packed ids; words met again lately are kept in two
        generations of at most ``KEPT_WORDS`` each."""
        t = self.tables
        got = t["older"].get(w)
        if got is None:
            got = b"".join([t["packed"][i] for i in encode_word(t, w.encode())])
        if len(t["words"]) >= KEPT_WORDS:
            t["older"], t["words"] = t["words"], {}
        t["words"][w] = got
        return got

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        make, out = self.word, []
        for k, part in enumerate(self.special.split(text) if "<" in text else (text,)):
            if k % 2:
                out.append(self.tables["special"][part].to_bytes(4, "little"))
            elif part:
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                get = self.tables["words"].get
                out.append(b"".join([get(w) or make(w) for w in self.split.findall(part)]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return decode(self.tables, np.frombuffer(ids, "<u4").tolist())


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (binary, little-endian unsigned 32-bit), decoded."""
    return _over(docs, tokenizer_path, id_col, text_col, "ids binary, decoded string", lambda ids, said: (ids, said))


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def digest(ids: bytes, said: str) -> tuple:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(said.encode()).hexdigest()

    return _over(docs, tokenizer_path, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


def _over(docs: DataFrame, path: str, id_col: str, text_col: str, schema: str, finish) -> DataFrame:
    # the tables' size is that of the vocabulary, whatever the documents
    shared = docs.sparkSession.sparkContext.broadcast(compile_automaton(path))
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*[(n, kinds[t]) for n, t in (x.split() for x in schema.split(", "))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        codec = Codec(shared.value)
        for b in batches:
            for s in range(0, b.num_rows, 256):  # bounds the batch that goes back
                part = b.slice(s, 256)
                ids = [codec.encode(x.as_py()) for x in part.column(1)]
                got = [finish(i, codec.decode(i)) for i in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*got), types))], names=["doc_id", *names])

    rows = docs.select(col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, {schema}")
