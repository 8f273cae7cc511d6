"""Operators over documents against brute force, on awkward rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from cohortflow.llm import common, debruijn, lines, packing, rules, simhash, suffix, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


def components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def plain_fingerprint(text, k=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("tile", [2048, 4])
def test_simhash(docs, corpus, tile):
    got = bag(simhash.near_duplicates(docs, tile=tile).collect())
    fps = [plain_fingerprint(t) for _, t, _ in corpus]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    root = components(len(fps), pairs)
    least = {}
    for r, (i, _, _) in zip(root, corpus):
        least[r] = min(least.get(r, LAST), LAST if i is None else i)
    want = bag((i, f"{f:016x}", None if least[r] == LAST else least[r]) for (i, _, _), f, r in zip(corpus, fps, root))
    assert got == want


def test_simhash_hot_bucket_is_cut(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**62))
    fps = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 24, (300, 2))} | {int(x) for x in rng.integers(0, 2**62, 200)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = [tuple(r) for r in simhash.links(df, tile=8).collect()]
    at = {f: i for i, f in enumerate(fps)}
    assert all(0 < (u ^ v).bit_count() for u, v in edges)
    got = components(len(fps), [(at[u], at[v]) for u, v in edges])
    want = components(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert got == want


def test_simhash_keeps_one_of_each_group(docs):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = collections.Counter(r.doc_id for r in kept.collect())
    winners = {r.doc_id for r in simhash.near_duplicates(docs).collect() if r.component_id is None or r.component_id == r.doc_id}
    assert set(got) == winners and got[7] == 1  # the row listed three times stays once


def words_removed(corpus, window):
    """First document (by id, nulls last) of every window, then cut by it."""
    key = lambda i: LAST if i is None else i
    first = {}
    for i, t, _ in corpus:
        w = (t or "").encode().split()
        for s in range(len(w) - window + 1):
            k = b" ".join(w[s : s + window])
            first[k] = min(first.get(k, LAST), key(i))
    for i, t, _ in corpus:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[b" ".join(w[s : s + window])] < key(i):
                gone[s : s + window] = [True] * window
        yield i, w, gone


@pytest.mark.parametrize("window,anchor", [(50, 10), (12, 4)])
def test_substring_dedup(docs, corpus, window, anchor):
    got = bag(debruijn.span_report(docs, window=window, anchor=anchor).collect())
    want = bag((i, len(w), sum(g), hashlib.sha256(b" ".join(x for x, y in zip(w, g) if not y)).hexdigest()) for i, w, g in words_removed(corpus, window))
    assert got == want and sum(k[2] for k in want) > 500


def test_substring_dedup_cuts_texts(docs, corpus):
    out = debruijn.drop_repeated_spans(docs, n_chars_col="n_chars")
    assert out.columns == docs.columns
    got = collections.Counter((r.doc_id, b" ".join((r.text or "").encode().split())) for r in out.collect())
    assert got == collections.Counter((i, b" ".join(x for x, y in zip(w, g) if not y)) for i, w, g in words_removed(corpus, 50))
    untouched = {t for (i, t, _), (_, _, g) in zip(corpus, words_removed(corpus, 50)) if not any(g)}
    assert untouched <= {r.text for r in out.collect()}


def plain_bytes(corpus, n=100):
    key = lambda i: LAST if i is None else i
    order = sorted({(key(i), t or "") for i, t, _ in corpus}, key=lambda x: (x[0], tag(x[1])))
    seen, out = set(), {}
    for i, t in order:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - n + 1):
            x = b[s : s + n]
            gone[s : s + n] |= x in seen
            seen.add(x)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i, t] = (len(b), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return bag((i, *out[key(i), t or ""]) for i, t, _ in corpus)


def tag(text):
    """Orders texts under one id: the hash's low 31 bits, then the 32 above."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return (h & 0x7FFFFFFF) << 32 | (h >> 31 & 0xFFFFFFFF)


@pytest.mark.parametrize("bucket", [400_000, 60])
def test_suffix_array(docs, corpus, bucket, monkeypatch):
    monkeypatch.setattr(suffix, "BUCKET", bucket)
    got = bag(suffix.span_report(docs).collect())
    assert got == plain_bytes(corpus) and sum(k[2] for k in got) > 10_000


def test_dedup_beyond_every_broadcast_bound(docs, corpus, monkeypatch):
    small = bag(simhash.near_duplicates(docs).collect())
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(suffix, "BUCKET", 60)
    assert bag(simhash.near_duplicates(docs).collect()) == small
    assert bag(suffix.span_report(docs).collect()) == plain_bytes(corpus)
    want = bag((i, len(w), sum(g), hashlib.sha256(b" ".join(x for x, y in zip(w, g) if not y)).hexdigest()) for i, w, g in words_removed(corpus, 50))
    assert bag(debruijn.span_report(docs).collect()) == want


def test_rows_listed_many_times_are_cut_once(spark, corpus):
    some = [r for r in corpus if r[0] is None or r[0] < 40]
    many = some + [some[4], (None, some[9][1], "s")] * 30
    df = spark.createDataFrame([(i, t) for i, t, _ in many], "doc_id long, text string").repartition(4)
    assert bag(suffix.span_report(df).collect()) == plain_bytes(many)
    keys = texts.base_rows(df, "doc_id", "text").select("id", "tag")
    repeated = keys.groupBy("id", "tag").count().where("count > 1").select("id", "tag")
    asked = keys.distinct().withColumn("x", F.lit(1))
    assert repeated.count() >= 2 and texts.requested(df, asked, "doc_id", "text", "x", repeated).count() == asked.count()


@pytest.mark.parametrize("buckets", [2, 7, 50])
def test_splitters_are_quantiles_of_the_pieces(spark, buckets):
    n = 5000
    asked = spark.range(n).select("id", F.lit(0).cast("long").alias("tag"), F.struct((F.col("id") * 7919 % n).alias("m"), F.lit(1).alias("start"), F.lit(1).alias("n")).alias("x")).repartition(5)
    got = suffix._splitters(asked, n, buckets)
    assert len(got) == buckets - 1 and got == sorted(got)
    sizes = np.diff([0, *(m for m, _, _ in got), n])
    assert sizes.max() < 3.5 * n / buckets
    hot = asked.withColumn("x", F.struct(F.lit(5).cast("long").alias("m"), "x.start", "x.n"))
    assert len({i for _, i, _ in suffix._splitters(hot, n, buckets)}) == buckets - 1


def test_multikey_sort_finds_equal_suffixes():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[2000:2300] = text[100:400]
    text[700:1000] = 97
    pos = np.arange(len(text) - 99)
    active, group = suffix.equal_suffixes(np.append(text, np.zeros(8, np.uint8)), pos)
    raw = text.tobytes()
    at = collections.defaultdict(set)
    for p in pos.tolist():
        at[raw[p : p + 100]].add(p)
    got = collections.defaultdict(set)
    for p, g in zip(active.tolist(), group.tolist()):
        got[g].add(p)
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in at.values() if len(x) > 1)


def plain_counts(text):
    w = WORD.findall(text or "")
    c = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for i, x in enumerate(zip(w, w[1:], w[2:])) if c[x] > 1 for j in (i, i + 1, i + 2)}
    ls = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(ls) - len(set(ls)), len(covered)


def test_quality_counts_and_rules(docs, corpus, labels):
    learned = rules.learn(rules.labelled_counts(docs, labels), min_cover=1)
    got = bag(r[:7] for r in rules.score_documents(docs, learned).collect())
    base = lambda c: c[0] < 50 or 100 * c[4] > 50 * c[0]
    assert bag(k[:7] for k in got.elements()) == bag((i, *plain_counts(t), base(plain_counts(t))) for i, t, _ in corpus)
    kept = rules.keep_good(docs, learned)
    verdict = rules.score_documents(docs, learned)
    assert kept.columns == docs.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(r.doc_id for r in verdict.where("kept").collect())


def test_a_filter_on_kept_does_not_count_again(docs):
    """The optimizer must not push the verdict, and the splitting of the text
    with it, into the per-word functions of the counts."""
    rule = (rules.Condition("symbols_per_word", True, 0.3), rules.Condition("repeated_share", True, 0.2))
    plain = rules.score_documents(docs, [rule])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(plain).count("split(") == plan(plain.where("kept")).count("split(") == 2
    assert plan(rules.keep_good(docs, [rule])).count("split(") == 2


def test_learned_rules_are_the_verdict(spark):
    """Rules learned from labels (with labels of absent documents and a class
    that is rare) reject exactly what they say, over the counts of each text."""
    rng = random.Random(9)
    prose = lambda: [f"w{rng.randrange(400)}x{rng.randrange(9)}" for _ in range(80)]
    texts = [" ".join(prose()) if i % 4 else " #$ ".join(prose()) for i in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, int(i % 4 > 0)) for i in range(240)), *((9_000 + i, i % 2) for i in range(400))], "doc_id long, quality int")
    learned = rules.learn(rules.labelled_counts(docs, labels, max_labelled=200))
    assert learned
    env = lambda c: dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), c), n_lines=1, n_upper=0, greatest=max)
    holds = lambda r, c: all((eval(rules.FEATURES[x.feature], {}, env(c)) > x.threshold) == x.above for x in r)
    want = {i: not (c[0] < 50 or 100 * c[4] > 50 * c[0] or any(holds(r, c) for r in learned)) for i, c in enumerate(map(plain_counts, texts))}
    assert {r.doc_id: r.kept for r in rules.score_documents(docs, learned).collect()} == want
    assert sum(want.values()) == 180 and {r.doc_id for r in rules.score_documents(docs, learned).where("kept").collect()} == {i for i, k in want.items() if k}


def test_rules_learn_what_separates(spark):
    """Held-out accuracy of a list learned from separable statistics."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(900):
        low = i % 3 == 0
        n = int(rng.integers(60, 500))
        rows.append((n, n * 6, int(n * 0.8) if low and i % 2 else 0, 0, int(n * 0.7) if low and not i % 2 else int(rng.integers(0, 4)), 5, int(rng.integers(0, 20)), low, i % 5 == 0))
    df = spark.createDataFrame(rows, [*rules.COUNTS, "low", "prune"])
    train, test = df.limit(600), df.subtract(df.limit(600))
    learned = rules.learn(train)
    wrong = test.withColumn("r", rules.rule_number(learned)).where("(r is not null) <> low").count()
    assert learned and wrong <= 2


def test_near_copies_and_small_hosts_lose_no_ordinary_line(spark):
    """A third of a host's pages are near copies, three pages of another share a
    line by chance; only the lines that differing pages carry go."""
    line = lambda *x: " ".join(f"w{v}" for v in x)
    rows = [(i, "\n".join([line(i, k) for k in range(5)] + (["Contact us"] if i % 2 else [])), "big") for i in range(200)]
    base = [line("base", k) for k in range(9)]
    rows += [(1000 + i, "\n".join([*base[:4], line("own", i), *base[5:], "Contact us"]), "big") for i in range(100)]
    rows += [(2000 + i, "\n".join([line("s", i, k) for k in range(4)] + (["a quotation"] if i < 3 else [])), "small") for i in range(50)]
    got = {r.doc_id: r for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].n_dropped == ("Contact us" in t) for i, t, s in rows)
    assert all(r.text == "\n".join(x for x in t.split("\n") if x != "Contact us") for i, t, s in rows for r in [got[i]])


def test_line_dedup(spark, docs, corpus, tmp_path):
    import duckdb

    con = duckdb.connect()
    path = str(tmp_path / "d.parquet")
    docs.toPandas()[["doc_id", "text", "source"]].to_parquet(path)
    con.execute(f"create view documents as select doc_id::bigint as doc_id, text, source from '{path}'")
    want = bag(con.execute(lines.LINE_REPORT_SQL.replace("coalesce(", "coalesce(", 1)).fetchall())
    got = bag(lines.line_report(docs).collect())
    assert {k for k in got if k[0] not in (80,)} == {k for k in want if k[0] not in (80,)}
    assert any(k[3] for k in got) and all("All rights reserved" not in (k[4] or "") for k in got if k[1] in ("s1", "s2"))
    out = lines.dedup_lines(docs, n_chars_col="n_chars")
    assert out.columns == docs.columns and bag((r.doc_id, r.text) for r in out.collect()) == bag((k[0], k[4]) for k in got.elements())


def test_lines_join_beyond_the_broadcast_bound(docs, monkeypatch):
    want = bag(lines.line_report(docs).collect())
    monkeypatch.setattr(lines, "BROADCAST_BYTES", -1)
    assert bag(lines.line_report(docs).collect()) == want


def plain_best_fit(items, capacity):
    bins = []
    for n, s, c in items:
        fit = [(b["room"], k) for k, b in enumerate(bins) if b["room"] >= n and s not in b["s"] and c not in b["c"]]
        if fit:
            k = min(fit)[1]
        else:
            k = len(bins)
            bins.append({"room": capacity, "s": set(), "c": set(), "n": 0})
        yield k, bins[k]["n"]
        bins[k]["room"] -= n
        bins[k]["s"].add(s)
        bins[k]["c"].add(c)
        bins[k]["n"] += 1


def test_best_fit_is_the_tightest_compatible_bin():
    rng = np.random.default_rng(2)
    items = sorted(((int(n), int(s), int(c)) for n, s, c in zip(rng.integers(1, 100, 600), rng.integers(0, 9, 600), rng.integers(0, 50, 600))), reverse=True)
    assert packing.best_fit(*map(list, zip(*items)), 100) == list(plain_best_fit(items, 100))


@pytest.mark.parametrize("shard", [4096, 20])
def test_packing_loses_nothing(docs, corpus, shard):
    got = packing.pack(docs, capacity=256, shard=shard).collect()
    words = collections.Counter()
    for i, t, _ in corpus:
        words[i] += len(WORD.findall(t or ""))
    placed = collections.Counter()
    bins = collections.defaultdict(list)
    for r in got:
        placed[r.doc_id] += r.n_tokens
        if r.n_tokens:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None
    assert {k: v for k, v in placed.items() if v} == {k: v for k, v in words.items() if v}
    assert len([r for r in got if r.n_tokens == 0]) == sum(1 for _, t, _ in corpus if not WORD.findall(t or ""))
    for b in bins.values():
        assert sum(r.n_tokens for r in b) <= 256 and len({r.source for r in b}) == len(b)
        assert sorted(r.place for r in b) == list(range(len(b)))


def test_empty_tables(no_docs, labels):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.drop_near_duplicates(no_docs).collect() == []
    assert debruijn.span_report(no_docs).collect() == []
    assert debruijn.drop_repeated_spans(no_docs).collect() == []
    assert suffix.span_report(no_docs).collect() == []
    assert packing.pack(no_docs).collect() == []
    assert lines.line_report(no_docs).collect() == []
    assert rules.learn_from(no_docs, labels) == []
    assert rules.keep_good(no_docs, []).collect() == []


def test_texts_under_one_id_have_tags_of_their_own(spark):
    """Two texts whose hashes agree in 31 bits are two texts."""
    from cohortflow.llm.texts import base_rows

    seen, pair, n = {}, None, 0
    while pair is None:
        text, n = f"text {n}", n + 1
        other = seen.setdefault(tag(text), text)
        pair = (other, text) if other != text else None
    df = spark.createDataFrame([(None, t) for t in pair], "doc_id long, text string")
    tags = [r["tag"] for r in base_rows(df, "doc_id", "text").collect()]
    assert len(set(tags)) == 2 and {t >> 32 for t in tags} == {tag(pair[0])}
