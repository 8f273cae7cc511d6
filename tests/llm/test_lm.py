"""Language-model scoring against a plain Kneser-Ney model."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from cohortflow.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TINY = lm.Sizes(block=300, piece=200, shard=500, hot=40, words=64)


def plain_tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(low), None]


def is_held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


class Plain:
    """Interpolated modified Kneser-Ney of order 3 over lists of tokens."""

    def __init__(self, texts):
        c = collections.Counter
        self.words, tri, starts = c(w for t in texts for w in t), c(), c()
        for t in texts:
            s = ["<s>", *t]
            starts[s[1]] += 1
            tri.update(zip(s, s[1:], s[2:]))
        two = c((v, w) for _, v, w in tri)
        two.update({("<s>", w): n for w, n in starts.items()})
        one = c(w for _, w in two)
        self.tables = [c({(w,): n for w, n in one.items()}), two, tri]
        self.d = [self.discounts(t.values()) for t in self.tables]
        self.total, self.kinds = collections.defaultdict(int), collections.defaultdict(lambda: [0, 0, 0, 0])
        for table in self.tables:
            for g, n in table.items():
                self.total[len(g), g[:-1]] += n
                self.kinds[len(g), g[:-1]][min(n, 3)] += 1

    @staticmethod
    def discounts(counts):
        n = [sum(1 for x in counts if x == k) for k in (1, 2, 3, 4)]
        if all(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
            if 0 < d[0] <= 1 and 0 < d[1] <= 2 and 0 < d[2] <= 3:
                return [0, *d]
        return [0, 0.5, 1, 1.5]

    def p(self, context, w):
        if context is None:
            return 1 / (len(self.words) + 1)
        k = len(context) + 1
        lower = self.p(context[1:] if k > 1 else None, w)
        total = self.total.get((k, context))
        if not total:
            return lower
        n, d = self.tables[k - 1].get((*context, w), 0), self.d[k - 1]
        return (n - d[min(n, 3)]) / total + sum(a * b for a, b in zip(d, self.kinds[k, context])) / total * lower

    def score(self, tokens):
        s = ["<s>", *tokens]
        return sum(math.log10(self.p(tuple(s[max(0, i - 2) : i]), s[i])) for i in range(1, len(s)))

    def base(self, tokens):
        n, v = sum(self.words.values()), len(self.words)
        return sum(math.log10((self.words[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)


@pytest.fixture(scope="module")
def prose(corpus):
    """Without the longest text: the plain model is slow."""
    return [(i, t if len(t or "") < 50_000 else t[:9000], s) for i, t, s in corpus]


@pytest.mark.parametrize("sizes", [lm.Sizes(), TINY])
def test_scores_equal_the_plain_model(spark, prose, sizes):
    df = spark.createDataFrame([(i, t, "clash") for i, t, _ in prose], "doc_id long, text string, TEXT_ string").repartition(3)
    plain = Plain([plain_tokens(t) for i, t, _ in prose if not is_held_out(i)])
    got = sorted(lm.score_held_out(df, sizes=sizes).collect(), key=str)
    assert len(got) == len(prose) and {r.train_tokens for r in got} == {sum(plain.words.values())}
    want = collections.defaultdict(list)
    for i, t, _ in prose:
        x = plain_tokens(t)
        want[i].append((is_held_out(i), len(x), sum(w in plain.words for w in x), plain.base(x), plain.score(x)))
    for r in got:
        assert any(
            w[:3] == (r.held_out, r.n_tokens, r.n_known) and math.isclose(w[3], r.base_score, rel_tol=1e-9) and math.isclose(w[4], r.score, rel_tol=1e-9) for w in want[r.doc_id]
        ), (r, want[r.doc_id])
    assert {r.held_out for r in got} == {True, False} and sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)
    assert math.isclose(sum(plain.p(("<s>",), w) for w in [*plain.words, "unknown word"]), 1)


def test_probabilities_of_a_context_add_up_to_one(spark, prose):
    """Over all known words and one unknown, in seen and unseen contexts."""
    df = spark.createDataFrame([(t or "",) for _, t, _ in prose], "text string").selectExpr("cast(text as binary) text")
    model = lm.train(df, TINY)
    vocabulary = sorted({w for _, t, _ in prose for w in plain_tokens(t) if w})
    first = plain_tokens(prose[0][1])
    for u, v in ((first[0], first[1]), (first[3], "never-seen"), (first[5], first[0])):
        texts = [f"{u} {v} {w}".encode() for w in [*vocabulary, "another-unknown"]] + [f"{u} {v}".encode()]
        total = 0.0
        for b in lm.blocks(texts, lm.Sizes()):
            p, _ = lm.probabilities(model, b)
            total += sum(p[(place := np.flatnonzero(b.doc == d))[2]] for d in range(len(texts)) if len(np.flatnonzero(b.doc == d)) > 2)
        assert abs(total - 1) < 1e-9


def test_nothing_to_learn_from(spark, no_docs):
    assert lm.score_held_out(no_docs).collect() == []
    out = [i for i in range(100) if is_held_out(i)][:2]
    got = lm.score_held_out(spark.createDataFrame([(out[0], "a b"), (out[1], None)], "doc_id long, text string")).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]


def test_long_texts_are_cut_at_white_space_only():
    text = ("ab  cd\n" * 5000 + "x" * 5000 + "\x0bY\xc3\x84 ").encode("latin-1")
    pieces = list(lm.tokens(text, 64))
    assert [w for p in pieces for w in p] == [*text.lower().split(), b""] and len(pieces) > 100
    whole, cut = (list(lm.blocks([text, b"", text], s)) for s in (lm.Sizes(), TINY))
    triples = lambda bs: [tuple(b.words[b.seq[k - j]] for j in (2, 1, 0)) for b in bs for k in b.at]
    assert triples(whole) == triples(cut) and len(cut) > 10 and [d for b in cut for d in b.doc] == [d for b in whole for d in b.doc]


def test_hash_tables_find_what_they_hold():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000):
        h = rng.integers(0, 2**64, n, dtype=np.uint64)
        values = rng.integers(1, 9, (n, 2))
        table = lm._table("t", h, values)
        assert (lm._find(table, "t", h) == values).all()
        assert not lm._find(table, "t", rng.integers(0, 2**64, 100, dtype=np.uint64)).any()


def test_triples_are_summed_alike_for_any_width_of_ids():
    rng = np.random.default_rng(2)
    v, u, w, n = (rng.integers(0, k, 3000) for k in (4, 9, 40, 5))
    want = collections.Counter()
    for *key, x in zip(v.tolist(), u.tolist(), w.tolist(), (n + 1).tolist()):
        want[tuple(key)] += x
    for bits in (6, 32):
        got = lm.sum_triples(v, u, w, n + 1, bits)
        assert [(*k, x) for k, x in sorted(want.items())] == list(zip(*(x.tolist() for x in got)))


def test_files_survive_a_second_writer(tmp_path):
    store = lm.Store(f"file://{tmp_path}")
    for _ in range(2):
        store.write("a/x", {"p": np.arange(5, dtype=np.uint32), "q": np.zeros((0, 4))})
    got = store.open("a/x")
    assert got["p"].tolist() == [0, 1, 2, 3, 4] and got["q"].shape == (0, 4) and store.open("a/y") is None
    assert len(list((tmp_path / "a").iterdir())) == 1
