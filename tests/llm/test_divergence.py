"""Source divergence against plain integers."""

import collections
import random
import re

import pytest
from cohortflow.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, rank int, `_terms` string, TERM string"


def plain(docs, min_df=3, top=200):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    rows = [(TERM.findall(lower(t or "")), la or "", s or "") for t, la, s in docs]
    out = []
    for lang in {la for _, la, _ in rows}:
        df = collections.Counter(w for ws, la, _ in rows if la == lang for w in set(ws))
        kept = sorted((w for w, n in df.items() if n >= min_df), key=str.encode)
        counts = collections.defaultdict(collections.Counter)
        for ws, la, s in rows:
            if la == lang:
                counts[s].update(w for w in ws if df[w] >= min_df)
        whole = sum(counts.values(), collections.Counter())
        share = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            pairs = sorted(((-sum(f(p[s][w], p[o][w]) for w in kept), o.encode()) for o in counts if o != s))
            terms = sorted((-f(p[s][w], q[w]), w.encode()) for w in kept if counts[s][w] and p[s][w] > q[w])[:top]
            out += [(lang, s, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(pairs)]
            out += [(lang, s, "term", w.decode(), -v, k + 1) for k, (v, w) in enumerate(terms)]
    return out


def frame(spark, docs):
    return spark.createDataFrame([(k, t, la, s, 5, "clash", "clash") for k, (t, la, s) in enumerate(docs)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 3))) for _ in range(300)]
    out = []
    for k in range(160):
        lang = rng.choice(["en", "en", "de", "f r", None, "f\x01r"])
        text = " ".join(rng.choice(words) if rng.random() < 0.9 else "Z" + str(k) for _ in range(rng.randint(0, 90)))
        out.append((text.upper() if k % 7 == 0 else text, lang, f"s{rng.randint(0, 5)}" if k % 11 else None))
    out += [out[3]] * 40  # a copied text in one group
    return out + [(None, "en", "empty"), ("once only", "xx", "a"), ("", "xx", "b"), ("12 34", "yy", "a"), ("Ab,aB;AB ÀÉ é\u00a0x", "en", "s1")]


def test_audit_equals_plain_integers(spark, mixed):
    got = divergence.audit(frame(spark, mixed)).collect()
    assert sorted(map(tuple, got)) == sorted(plain(mixed))
    assert got and {r.part for r in got} == {"pair", "term"}


def test_blocks_parts_and_units(spark, mixed, monkeypatch):
    """Many blocks, vocabularies cut in parts, small languages in one unit, a
    short top list, few pairs at a time."""
    for name, value in (("BLOCK_CELLS", 64), ("UNIT_BYTES", 4000), ("UNITS", 4), ("FLUSH", 50)):
        monkeypatch.setattr(divergence, name, value)
    got = divergence.audit(frame(spark, mixed), top=7).collect()
    assert sorted(map(tuple, got)) == sorted(plain(mixed, top=7))


def test_nothing_kept(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [("alpha", "en", "a"), ("beta", "en", "b"), (None, None, None)]
    assert sorted(map(tuple, divergence.audit(frame(spark, rows)).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_large_counts_stay_exact():
    import numpy as np

    count, n = np.array([0, 5, 12_345_678_901_234]), np.array([10**14 + 7] * 3)
    assert divergence._share(count, n).tolist() == [1 + 10**9 * (int(c) + 1) // (10**14 + 7) for c in count]
