import re

import numpy as np
import pytest

from feedspark.llm import overlaps, similar


def sets_of(t, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, num, den):
    """{(id, text): smallest id of the component}, comparing all pairs."""
    sets = [sets_of(t, width) for _, t in rows]
    vocab = {v: i for i, v in enumerate({v for s in sets for v in s})}
    at = list(range(len(rows)))

    def top(x):
        while at[x] != x:
            at[x] = at[at[x]]
            x = at[x]
        return x

    holders = [[] for _ in vocab]
    for i, s in enumerate(sets):
        common = np.zeros(len(rows), int)
        for v in s:
            h = holders[vocab[v]]
            if h:
                common[h] += 1
            h.append(i)
        for j in np.flatnonzero(common).tolist():
            if den * common[j] >= num * (len(s) + len(sets[j]) - common[j]):
                at[top(i)] = top(j)
    low = {}
    key = lambda i: 2**63 if rows[i][0] is None else rows[i][0]
    for i in range(len(rows)):
        low[top(i)] = min(low.get(top(i), 2**63), key(i))
    return {(rows[i][0], rows[i][1]): None if low[top(i)] == 2**63 else low[top(i)] for i in range(len(rows))}


def cloud(r, n, words, edits, name, base=None):
    base = [f"{name}{i}" for i in r.integers(0, 10_000, words)] if base is None else base
    out = []
    for i in range(n):
        w = list(base)
        for at in r.choice(words, edits if isinstance(edits, int) else int(r.integers(*edits)), replace=False):
            w[at] = f"{name}e{i}p{at}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(5)
    line = " ".join(f"line{i}" for i in range(14))
    texts = [*cloud(r, 150, 120, (0, 9), "a"), *cloud(r, 90, 80, 3, "b"), *cloud(r, 6, 60, 1, "c")]
    texts += [f"{line} " + " ".join(f"own{i}x{j}" for j in range(int(r.integers(0, 30)))) for i in range(120)]
    texts += [texts[3], texts[3].upper(), None, "", " \n", "one", "One", "one two", "a b c", "a b c d", " ".join(f"w{i % 900}" for i in range(40_000))]
    ids = [None if i % 40 == 7 else int(i) for i in r.permutation(len(texts))]
    return list(zip(ids, texts, strict=True)) + [(5, "same id"), (5, "same id"), (None, "one two")]


@pytest.mark.parametrize(("small", "block", "dense"), [(16, 256, 4), (4, 16, 0), (4, 16, 10**9)])
def test_components_equal_brute_force(spark, rows, monkeypatch, small, block, dense):
    monkeypatch.setattr(overlaps, "DENSE", dense)
    df = spark.createDataFrame([(t, i, "x", 1) for i, t in rows], "text string, doc_id long, node string, keys int").repartition(5)
    got = overlaps.similar_sets(df, small=small, block=block).collect()
    assert len(got) == len(rows)
    want = brute(rows, 3, 85, 100)
    sizes = sorted((i is None, i or 0, len(sets_of(t, 3)), -1 if want[i, t] is None else want[i, t]) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in got) == sizes
    assert len({v for v in want.values()}) < len(rows) - 60
    near = similar.near_copies(df, small=small, block=block).collect()
    want = brute([(i, t) for i, t in rows if sets_of(t, 5)], 5, 80, 100)
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in near if r.n_shingles) == sorted(((i or -1), want[i, t] or -1) for i, t in rows if (i, t) in want)


def test_a_crowd_about_the_threshold(spark):
    """500 texts of which one pair in twenty links: no node is the centre of the others."""
    r = np.random.default_rng(11)
    rows = list(enumerate(cloud(r, 500, 300, 4, "z")))
    want = brute(rows, 5, 80, 100)
    got = {x.doc_id: x.component_id for x in similar.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: want[i, t] for i, t in rows}


def test_sketches_lose_no_pair():
    r = np.random.default_rng(2)
    none, kept = np.zeros(0, np.uint64), 0
    for _ in range(400):
        n = int(r.integers(1, 60))
        x = r.integers(1, 2**60, n).astype(np.uint64)
        y = np.unique(np.concatenate((x[: n - int(r.integers(0, n // 4 + 1))], r.integers(1, 2**60, int(r.integers(0, n // 4 + 1))).astype(np.uint64))))
        known = np.unique(r.choice(x, n // 2 + 1))
        rank = r.integers(1, 9, len(known)).astype(np.uint64)
        for told in ((none, none), (known, rank)):
            a, b = (overlaps.coded(np.unique(v), *told) for v in (x, y))
            for k in (1, 3, len(a)):
                assert overlaps.bottom(np.unique(x), k, *told).tolist() == a[:k].tolist()
            common = len(np.intersect1d(a, b))
            if overlaps.enough(common, len(a), len(b), (85, 100)):
                p, q = a[: overlaps.retained(len(a), (85, 100))], b[: overlaps.retained(len(b), (85, 100))]
                kept += 1
                assert len(np.intersect1d(p, q)) >= max(1, overlaps.lists_needed(len(a), len(b), (85, 100)))
            assert overlaps.common_counts([a], [b], 7)[0, 0] == common == overlaps.common(a, b)
    assert kept > 50


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert overlaps.similar_sets(none).isEmpty() and similar.near_copies(none).isEmpty()


def test_sets_are_copied_in_passes_and_removed(spark, monkeypatch):
    monkeypatch.setattr(overlaps, "PASS_ROWS", 2)
    monkeypatch.setattr(overlaps, "COPIES", 1)
    r = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(40):
        w = list(base)
        for j in r.integers(0, 60, 1 + i % 4):
            w[j] = f"x{r.integers(0, 9)}"
        texts.append((i, " ".join(w)))
    sizes, gone = [], []
    pairs_of, discard = overlaps._in_passes, overlaps.discard

    def passes(rows, key, nodes, run):
        sizes.append(-(-rows.count() // max(2, nodes)))
        return pairs_of(rows, key, nodes, run)

    monkeypatch.setattr(overlaps, "_in_passes", passes)
    monkeypatch.setattr(overlaps, "discard", lambda *t: (gone.extend(t), discard(*t)))
    got = {x.doc_id: x.component_id for x in overlaps.similar_sets(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    sets = [sets_of(t, 3) for _, t in texts]
    low = list(range(40))
    for _ in range(40):
        for i in range(40):
            for j in range(40):
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    low[i] = low[j] = min(low[i], low[j])
    assert got == dict(enumerate(low)) and max(sizes) > 1 and len(gone) >= 5


def test_copies_are_counted_in_sets_of_mean_size(spark, monkeypatch):
    monkeypatch.setattr(overlaps, "PASS_ROWS", 10)
    passes = []
    rows = spark.range(40).selectExpr("id AS k", "5D AS weight")
    got = overlaps._in_passes(rows, ["k"], 1, lambda x: (passes.append(x), x.select("k"))[1])
    assert len(passes) == 20 and sorted(x.k for x in got.collect()) == list(range(40))


def test_values_that_were_not_told_propose_few_pairs_and_copies(spark, monkeypatch):
    """Phrases of about 20 of 200 texts each: more frequent values than there is room for."""
    monkeypatch.setattr(overlaps, "TOLD", 4)
    monkeypatch.setattr(overlaps, "PAIRS", 128)
    r = np.random.default_rng(8)
    phrases = [" ".join(f"p{i}w{j}" for j in range(6)) for i in range(400)]
    texts = [" ".join(phrases[j] for j in r.choice(400, 40, replace=False)) for _ in range(200)]
    texts += [f"{t} more{i}" for i, t in enumerate(texts[:20])]
    rows, copied, real = list(enumerate(texts)), [], overlaps._in_passes

    def passes(some, key, nodes, run):
        copied.append(some.count())
        return real(some, key, nodes, run)

    monkeypatch.setattr(overlaps, "_in_passes", passes)
    got = {x.doc_id: x.component_id for x in overlaps.similar_sets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: low for (i, _), low in brute(rows, 3, 85, 100).items()}
    assert sum(copied) < 1000
