"""The pipeline's stages on awkward rows, and the registered queries."""

import collections

import corpus_pipeline
import pytest
from cohortflow.llm import lines, packing, rules
from cohortflow.llm.common import materialize
from test_documents import LAST, WORD, components, plain_best_fit, plain_counts, plain_fingerprint, words_removed

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_whole_rows(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    counts, cur = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        before = cur
        cur = stage(spark, before, str(tmp_path))
        path = str(tmp_path / name.replace(" ", "-"))
        cur.write.parquet(path)
        cur = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert cur.columns == docs.columns, name
            counts.append(cur.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3] == counts[4] > 0
    # every word that the last stage was given stands in exactly one bin
    given = collections.Counter()
    for r in before.collect():
        given[r.doc_id] += len((r.text or "").encode().split())
    placed = collections.Counter()
    for r in cur.collect():
        placed[r.doc_id] += r.n_tokens
    assert placed == given


def plain_lines(docs):
    """Line dedup in plain Python over (id, text, source)."""
    trim = lambda x: x.strip(" \t\r\x0b\x0c")
    pages = {(s, t) for _, t, s in docs if t is not None}
    total = collections.Counter(s for s, _ in {(s, t) for _, t, s in docs})
    page_lines = [(s, {trim(y) for y in t.split("\n")} - {""}) for s, t in pages]

    def passes(n, pages):
        p = n / pages
        return n >= lines.MIN_PAGES and (p + 0.5 / pages - (p * (1 - p) / pages + 0.25 / pages**2) ** 0.5) / (1 + 1 / pages) > lines.MAX_RATIO

    seen = collections.Counter((s, x) for s, ls in page_lines for x in ls)
    bad = {k for k, n in seen.items() if passes(n, total[k[0]])}
    # near copies are one page
    copies = [(s, ls) for s, ls in page_lines if ls and sum((s, x) in bad for x in ls) > len(ls) * lines.REPEATED]
    total.subtract(s for s, _ in copies)
    total.update({s for s, _ in copies})
    seen.subtract((s, x) for s, ls in copies for x in ls)
    seen.update({(s, x) for s, ls in copies for x in ls})
    bad = {k for k in bad if passes(seen[k], total[k[0]])}
    return [(i, None if t is None else "\n".join(x for x in t.split("\n") if (s, trim(x)) not in bad), s) for i, t, s in docs]


def plain_simhash(docs):
    """One row per near-duplicate group; a winner's id keeps distinct texts."""
    fps = [plain_fingerprint(t) for _, t, _ in docs]
    root = components(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    least = {}
    for r, (i, _, _) in zip(root, docs):
        least[r] = min(least.get(r, LAST), LAST if i is None else i)
    winners = {least[r] for r in root}
    return sorted({(LAST if i is None else i, t, s) for i, t, s in docs if (LAST if i is None else i) in winners}, key=str)


def test_pipeline_equals_brute_force(spark, docs, labels, tmp_path):
    """Every stage against plain Python over what its predecessor kept."""
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    learned = rules.learn_from(docs, labels)
    rows = lambda df: [(r.doc_id, r.text, r.source) for r in df.collect()]
    cur, plain = docs, rows(docs)

    def rejects(text):
        n_words, chars, symbols, dups, repeats = plain_counts(text)
        if n_words < 50 or 100 * repeats > 50 * n_words:
            return True
        facts = {
            "symbols_per_word": symbols / max(n_words, 1),
            "repeated_share": repeats / max(n_words, 1),
            "duplicate_lines": dups / max(1, sum(bool(WORD.search(x)) for x in text.split("\n"))),
            "upper_share": sum("A" <= c <= "Z" for c in text) / max(chars, 1),
        }
        return any(all((facts[c.feature] > c.threshold) == c.above for c in rule) for rule in learned)

    def without_spans(docs_):
        out = []
        for (i, t, s), (_, w, gone) in zip(docs_, words_removed(docs_, 50)):
            out.append((i, b" ".join(x for x, g in zip(w, gone) if not g), s))
        return out

    steps = {
        "quality rules": lambda d: [x for x in d if not rejects(x[1] or "")],
        "line dedup": plain_lines,
        "simhash near-dedup": plain_simhash,
        "substring dedup": without_spans,
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        cur, plain = materialize(stage(spark, cur, str(tmp_path))), steps[name](plain)
        got, want = rows(cur), plain
        if name == "simhash near-dedup":
            got = [(LAST if i is None else i, t, s) for i, t, s in got]
        if name == "substring dedup":
            got = [(i, b" ".join((t or "").encode().split()), s) for i, t, s in got]
        assert sorted(got, key=str) == sorted(want, key=str), name
        plain = rows(cur)
    packed = corpus_pipeline.STAGES[-1][1](spark, cur, str(tmp_path)).collect()
    items = []
    for i, t, s in plain:
        w = (t or "").lower().encode().split()
        for k in range(max(1, -(-len(w) // packing.CAPACITY))):
            items.append((-min(packing.CAPACITY, len(w) - k * packing.CAPACITY), i, k, s, tuple(w)))
    items = sorted((x for x in items if x[0] < 0), key=lambda x: (x[0], LAST if x[1] is None else x[1], x[2]))
    want = plain_best_fit([(-x[0], x[3], x[4]) for x in items], packing.CAPACITY)
    got = {(r.doc_id, r.segment, r.n_tokens): (r.bin_id, r.place) for r in packed if r.n_tokens}
    ties = collections.Counter((x[0], x[1], x[2]) for x in items)
    assert all(got[x[1], x[2], -x[0]] == b for x, b in zip(items, want) if max(ties.values()) == 1 or ties[x[:3]] == 1)


def test_stages_on_empty_documents(spark, no_docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, str(tmp_path)).collect() == []


def test_names():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "substring dedup", "best-fit packing"]


@pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="no test tables")
def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "bin_id" in out.columns
