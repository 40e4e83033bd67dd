import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedspark.llm import counts, decontaminate, exact, language, licenses, packing, registry, similar, simhash, sstable, substring, urls
from feedspark.llm.common import shared_dir
from tests.oracle import same, views

BPE = P.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 700}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(40))
TEXTS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One two  three"), (5, "One two three"), (5, "One two three"), (5, "another text, same id"), (None, "no id"), (None, None),
    (6, f"x y {PASSAGE} z"), (7, f"{PASSAGE} tail"), (8, LONG), (9, "<|endoftext|> a\n\n b  c <|endoftext|>"), (10, "日本語 é½ ٣ MIT License"), (11, "la " * 50), (12, "released under the MIT License. The Apache License, Version 2.0"), (-4, "tie one"), (13, "tie  one"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(t, i, "en", None, "a", "b", "c", 7) for i, t in TEXTS]
    return spark.createDataFrame(rows, "text string, doc_id long, lang string, source string, _order_id string, _text_key string, kept string, fp int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("1 = 0")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(BPE)


def ids_of(tok, text, end):
    return np.array([*tok.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def folded(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, sf, name):
    same(registry.QUERIES[name](spark, sf), views(sf).sql(registry.SQL[name]))


def test_token_shards(spark, docs, none, tok):
    out = shared_dir(spark)
    sstable.write_token_shards(docs, BPE, 2, out, shards=3)
    got = sstable.read_token_shards(spark, out).orderBy("start").collect()
    want = sorted(((2**63 - 1 if i is None else i), t or "") for i, t in TEXTS)
    want.sort(key=lambda x: (x[0], np.uint64(xxhash.xxh64_intdigest(x[1].encode(), 42)).astype(np.int64)))
    at = 0
    for r, (i, t) in zip(got, want, strict=True):
        ids = ids_of(tok, t, 2)
        assert (r.doc_id, r.start, bytes(r.ids)) == (i, at, ids.tobytes())
        at += len(ids)
    found = sstable.lookup(spark, out, spark.createDataFrame([(5,), (8,), (99,), (-4,)], "doc_id long")).collect()
    assert sorted(r.doc_id for r in found) == [-4, 5, 5, 5, 8]
    many = shared_dir(spark)
    sstable.write_token_shards(docs, BPE, 2, many, shard_bytes=40_000)
    assert sstable.read_token_shards(spark, many).orderBy("start").collect() == got
    one_id = spark.createDataFrame([(None, f"text {i}") for i in range(4000)], "doc_id long, text string")
    spread = shared_dir(spark)
    sizes = [r.n_docs for r in sstable.write_token_shards(one_id, BPE, 2, spread, shards=8).collect()]
    assert len(sizes) >= 6 and max(sizes) < 1500
    empty = shared_dir(spark)
    sstable.write_token_shards(none, BPE, 2, empty)
    assert sstable.read_token_shards(spark, empty).isEmpty()


def test_exact(docs, none):
    got = exact.exact_duplicates(docs).collect()
    assert len(got) == len(TEXTS) and sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    for r in got:
        group = [(i, t or "") for i, t in TEXTS if hashlib.sha256("".join(words(t)).encode()).hexdigest() == r.text_sha256]
        best = min(group, key=lambda x: (-len(x[1]), 2**63 if x[0] is None else x[0]))
        assert (r.group_size, r.keep_id) == (len(group), best[0])
    kept = exact.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert {(r._order_id, r.kept) for r in kept.collect()} == {("a", "c")}
    assert exact.deduplicate(none).isEmpty()


def brute_repeats(texts):
    """{(id, kept words): words removed} by comparing all windows."""
    order = sorted({(2**63 - 1 if i is None else i, int(np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64)), t or "") for i, t in texts})
    seen, want = {}, {}
    for i, tie, t in order:
        w = words(t)
        gone = set()
        for s in range(len(w) - 19):
            if seen.setdefault(tuple(w[s : s + 20]), (i, tie, s)) != (i, tie, s):
                gone.update(range(s, s + 20))
        want[i, " ".join(x for p, x in enumerate(w) if p not in gone)] = len(gone)
    return want


def removed(rows):
    return {(2**63 - 1 if r.doc_id is None else r.doc_id, r.kept): r.n_removed for r in rows.collect()}


@pytest.mark.parametrize("crowded", [1, 1000])
def test_substring(spark, docs, none, monkeypatch, crowded):
    monkeypatch.setattr(substring, "CROWDED", crowded)
    assert removed(substring.remove_repeats(docs)) == brute_repeats(TEXTS)
    assert substring.remove_repeats(none).isEmpty()
    r = np.random.default_rng(crowded)
    pool = [" ".join(r.choice([f"v{i}" for i in range(300)], int(r.integers(8, 90)))) for _ in range(12)]
    line = " ".join(f"line{i}" for i in range(24))
    texts = [(int(i) if i % 9 else None, " ".join([*r.choice(pool, 4), line, f"own{i} " * int(r.integers(0, 60)), *r.choice(pool, 2)])) for i in r.permutation(120)]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    assert removed(substring.remove_repeats(rows)) == brute_repeats(texts)


def test_positions_come_from_the_automaton(monkeypatch):
    w = [b"w%d" % i for i in range(60)]
    rows = [(1, 0, 5, b" ".join(w[:30])), (2, 0, 7, b" ".join(w[4:34])), (3, 0, 0, b" ".join([*w[:22], *w[40:48]])), (4, 0, 0, b" ".join([b"x"] * 30))]
    want = [(2, 0, 7, 7), (3, 0, 0, 3), (4, 0, 1, 10)]
    assert list(substring.located([rows[:3], rows[3:]])) == want

    class Blind:
        def __init__(self, *_):
            self.n = 0

        def add_word(self, *_):
            self.n += 1

        def make_automaton(self):
            pass

        def iter(self, _):
            return iter(())

        def __len__(self):
            return self.n

    monkeypatch.setattr(substring.ahocorasick, "Automaton", Blind)
    assert list(substring.located([rows[:3], rows[3:]])) == []


def test_simhash(docs, none):
    got = simhash.near_duplicates(docs).collect()
    prints = {}
    for i, t in TEXTS:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[s : s + 3]).encode(), 42) for s in range(max(1, len(w) - 2))] if w else []
        prints[i, xxhash.xxh64_intdigest((t or "").encode(), 42)] = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
    for r in got:
        assert r.fp % 2**64 == prints[r.doc_id, r.text_key % 2**64]
        near, more = {r.fp % 2**64}, True
        while more:
            grown = {f for f in prints.values() if any((f ^ g).bit_count() <= 2 for g in near)}
            more, near = grown != near, grown
        reach = [i for (i, _), f in prints.items() if f in near]
        assert r.component_id == min((i for i in reach if i is not None), default=None)
    assert simhash.near_duplicates(none).isEmpty()


def test_covering_masks_lose_no_pair():
    masks = simhash.masks()
    for a in range(64):
        for b in range(a, 64):
            assert any(not (m >> a & 1 or m >> b & 1) for m in (x % 2**64 for x in masks))


def test_language(spark, docs, none, sf):
    rows = registry.QUERIES["op5_language"](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)
    net = language.train([("the cat and the dog", "en"), ("le chat et la souris", "fr")])
    got = {(r.doc_id, r.text_key): r for r in language.identify(docs, net).collect()}
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in t or "")) for (i, t) in TEXTS for r in [got[i, np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64)]])
    assert language.identify(none, net).isEmpty()
    assert {r.lang_pred for r in language.identify(docs, language.fit(none)).collect()} == {"und"}


def test_training_windows_are_bounded_and_every_language_is_learned(spark, monkeypatch):
    held = []
    monkeypatch.setattr(language, "train", lambda samples: held.append(samples))
    rows = [(" ".join(f"x{i}y{j}" for j in range(4000)), "long") for i in range(4)] + [(f"word {i}", f"l{i % 250}") for i in range(500)] + [("same text", "long")] * 50 + [("7", "none"), (None, "none"), ("abc", None)]
    language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3), per_language=40)
    language.fit(spark.createDataFrame(rows, "text string, lang string"), per_language=10**6)
    some, every = held
    count = lambda s, k: sum(lang == k for _, lang in s)
    assert {lang for _, lang in some} == {"long", *(f"l{i}" for i in range(250))} and all(len(w) == 256 for w, _ in some)
    assert 10 < count(some, "long") < 90 and count(every, "long") > 400 and count(every, "l7") == 2 and len(set(every)) == len(every)


def test_network_equals_a_naive_convolution():
    net = language.Network.new(["de", "en", "fr"], 3)
    net.bias += 0.05
    text = "The quick brown fox; l'été, ça va? " * 23
    data = text.encode().lower()
    total, z_sum = 0, np.zeros(3)
    for at in range(0, len(data), 256):
        part = data[at : at + 256]
        v = net.vectors[np.frombuffer(part.ljust(256), np.uint8)]
        best = np.full(48, -np.inf)
        for w, width in enumerate((2, 3, 4)):
            for i in range(253):
                for f in range(16):
                    n = w * 16 + f
                    best[n] = max(best[n], sum(float(v[i + k] @ net.weights[8 * k : 8 * k + 8, n]) for k in range(width)))
        z = np.maximum(best + net.bias, 0) @ net.out + net.out_bias
        z_sum += len(part) * (z - z.max() - np.log(np.exp(z - z.max()).sum()))
        total += len(part)
    p = np.exp(z_sum / total)
    p /= p.sum()
    lang, score = net.predict([text])[0]
    assert lang == ["de", "en", "fr"][int(p.argmax())] and abs(score - p.max()) < 1e-4


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Example.NET/en/x?y"), (4, "http://net"), (5, "http://b.net/q"), (6, "https://x.example.com/de/1#f"), (7, "ftp://u.org/fr/"), (None, "http://plain.io/a"), (7, "ftp://u.org/fr/")]
    pages = spark.createDataFrame([(u, i, "z", "q") for i, u in rows], "url string, page_id long, host string, hit string")
    got = urls.judge_urls(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and all(r.verdict in ("allow", "block") for r in got)
    assert [(by[i].host, by[i].path, by[i].rule) for i in (1, 2, 3, 4, 5, 6, 7)] == [("", "", None), ("", "", None), ("a.example.net", "/en/x", "example.net/en/"), ("net", "", None), ("b.net", "/q", "net/"), ("x.example.com", "/de/1", "example.com/de/"), ("u.org", "/fr/", "org/fr/")]
    assert urls.judge_urls(pages.filter("1 = 0")).isEmpty()


def test_url_features_equal_brute_force(spark):
    import math

    made = [f"http://{h}/{p}" for h in ("a.x-1.com", "b.x-1.com", "y.com", "z.net", "q.z.net", "w.org", "v.org") for p in ("de/1", "en/a?x=1&y=22", "fr/", "", "en/a?x=1&y=22")]
    rows = [(i, u) for i, u in enumerate([*made, None, "no scheme", "http://" + "n" * 5000 + ".com/a"])]
    rules = (("block", "x-1.com/de/"), ("allow", "y.com/"), ("block", "net/"))
    table = urls.with_rules(spark.createDataFrame(rows, "page_id long, url string"), rules)
    got = {r.page_id: r for r in urls.with_features(table).collect()}
    assert len(got) == len(rows)
    of = {i: (r.suffix, r.site, r.hit.verdict if r.hit else None) for i, r in got.items()}
    first = {i: (r.path[1:].split("/")[0].lower(), r.site, r.hit.verdict if r.hit else None) for i, r in got.items()}
    labels = [v for _, _, v in of.values() if v]
    prior = labels.count("block") / len(labels)
    for i, u in rows:
        u, r = u or "", got[i]
        host, _, path = u.partition("://")[2].partition("/")
        path = f"/{path}".partition("?")[0] if "/" in u.partition("://")[2] else ""
        assert (r.host, r.path, r.n_url, r.n_host, r.n_path, r.depth, r.labels) == (host, path, len(u), len(host), len(path), path.count("/"), host.count("."))
        assert r.hyphens == host.count("-") and r.n_suffix == len(host.rpartition(".")[2]) and r.parameters == (u.count("&") + 1 if "?" in u else 0)
        assert abs(r.digit_ratio - sum(map(str.isdigit, u)) / max(1, len(u))) < 1e-12
        counts = [u.lower().count(c) for c in "abcdefghijklmnopqrstuvwxyz0123456789-./_=&?:"]
        assert abs(r.entropy - sum(-k / len(u) * math.log2(k / len(u)) for k in counts if k)) < 1e-9
        others = [v for s, site, v in of.values() if s == r.suffix and site != r.site]
        want = (others.count("block") + 5 * prior) / (sum(map(bool, others)) + 5)
        assert abs(r.suffix_rate - want) < 1e-12 and abs(r.suffix_share - len(others) / len(rows)) < 1e-12
        others = [v for s, site, v in first.values() if s == first[i][0] and site != r.site]
        assert abs(r.segment_rate - (others.count("block") + 5 * prior) / (sum(map(bool, others)) + 5)) < 1e-12


def test_url_trees_take_all_features_and_no_label(spark):
    rows = [(i, f"http://h{i % 40}.{'shop-sale' if i % 2 else 'plain'}{i % 40}.com/{'a/b/c' if i % 2 else 'x'}?q={i}") for i in range(400)]
    rules = tuple(("block" if i % 2 else "allow", f"{'shop-sale' if i % 2 else 'plain'}{i}.com/") for i in range(0, 30))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.judge_urls(pages, rules).collect()
    asked = [r for r in got if r.rule is None]
    assert len(asked) > 50 and all((r.verdict == "block") == ("shop-sale" in r.host) for r in asked)
    report = urls.held_out_accuracy(pages, rules).first()
    assert report.n > 20 and report.accuracy > 0.95
    model = urls.fit(urls.with_features(urls.with_rules(pages, rules)))
    assert model.numFeatures == len(urls.FEATURES) and not {"hit", "rule", "verdict", "site"} & set(urls.FEATURES)


def test_packing(docs, none, tok, monkeypatch):
    got = sorted(packing.pack(docs, BPE, 1).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert sum(r.length for r in got) == sum(len(ids_of(tok, t, 1)) for _, t in TEXTS)
    fill: dict = {}
    for r in got:
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in fill.values()) and sorted(fill) == list(range(len(fill)))
    long = sorted((r for r in got if r.doc_id == 8), key=lambda r: r.start)
    assert b"".join(bytes(r.ids) for r in long) == ids_of(tok, LONG, 1).tobytes()
    assert packing.pack(none, BPE, 1).isEmpty()
    monkeypatch.setattr(packing, "BROADCAST_TASKS", 0)
    assert sorted(packing.pack(docs, BPE, 1).collect(), key=lambda r: (r.sequence_id, r.offset)) == got


def test_plan_is_feasible():
    r = np.random.default_rng(1)
    histogram = {int(x): int(n) for x, n in zip(*np.unique(r.integers(1, 2048, 5000), return_counts=True), strict=True)}
    slots, left, sequences = packing.plan(histogram)
    assert sequences > 500 and all(0 <= left[x] <= histogram[x] for x in histogram)
    assert sum(x * (b - a) for x, a, b, _, _ in slots) == 2048 * sequences


def test_licenses(docs, none):
    phrases = {p: label for p, label in licenses.BASE.items()}
    for r in licenses.license_scan(docs).collect():
        mine = [folded(t) for i, t in TEXTS if i == r.doc_id and len(folded(t)) == r.n_words]
        assert mine
        w = mine[0]
        hits = sorted((s, label) for p, label in phrases.items() for s in range(len(w)) if w[s : s + len(p.split())] == p.split())
        assert (r.n_base, r.base_labels) == (len(hits), ",".join(sorted({x[1] for x in hits})))
        assert (r.first_word, r.last_word) == ((hits[0][0], hits[-1][0]) if hits else (None, None))
        assert 0 <= r.score <= 1 and (r.score == 0) == (r.labels == "")
    assert licenses.license_scan(none).isEmpty()


def brute_licenses(words_of):
    """(label, start, coverage) of all matches in each text, by trying every start of every template."""
    import math

    from feedspark.llm.notices import COMMON

    entries = licenses.entries_of(licenses.BASE, licenses.TEMPLATES)
    vocabulary = {x for _, _, ws, _ in entries for x in ws if x not in COMMON}
    n = {x: sum(x in set(w) for w in words_of) for x in vocabulary}
    idf = {x: math.log((len(words_of) + 1) / (n[x] + 1)) + 1e-3 for x in vocabulary}
    out = []
    for w in words_of:
        found = []
        for kind, label, ws, must in entries:
            weight = sum(idf.get(x, 0) for x in ws)
            for start in range(-len(ws), len(w)):
                there = [0 <= start + q < len(w) and w[start + q] == x for q, x in enumerate(ws)]
                if not all(there[q] or ws[q] in COMMON for q in must):
                    continue
                share = sum(idf.get(x, 0) for x, t in zip(ws, there, strict=True) if t) / weight
                if share >= (1 - 1e-9 if kind == "base" else licenses.COVERAGE):
                    found.append((label, start, share))
        out.append(found)
    return out


def test_license_templates_equal_brute_force(spark):
    bodies = [notice for _, notice, _ in licenses.TEMPLATES]
    r = np.random.default_rng(2)
    texts = [None, "", "license " * 300, "mit " * 50 + "license", "the sublicense and or sell copies"]
    for i, b in enumerate(bodies):
        words_ = b.split()
        for gone in (0, 1, len(words_) // 3):
            own = list(words_)
            for at in r.choice(len(own), gone, replace=False):
                own[at] = "xx"
            texts.append(f"some words before {' '.join(own)} and, after: {bodies[(i * 7 + 3) % len(bodies)]}")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_licenses([folded(t) for t in texts])
    for x in licenses.license_scan(rows).collect():
        own = want[x.doc_id]
        assert x.labels == ",".join(sorted({m[0] for m in own})), (x.doc_id, x.labels, own)
        assert abs(x.score - max((m[2] for m in own), default=0)) < 1e-9
    assert sum(map(bool, want)) > 90 and {m[0] for own in want for m in own} == {t[0] for t in licenses.TEMPLATES} | set(licenses.BASE.values())


def test_counts(docs, none, tok):
    want = sorted((str(i), len((t or "").encode()), len(ids_of(tok, t, 0)) - 1) for i, t in TEXTS)
    more = [("日本語 テスト です" * 40), "=" * 3000, "ไทย ภาษา", "a\u00a0b é\u3000ü"]
    for share in (1, 50, counts.HEAD_SHARE):
        got = counts.token_counts(docs, BPE, P.PATTERN, head_share=share).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    rows = docs.sparkSession.createDataFrame([(i, t) for i, t in enumerate(more)], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in counts.token_counts(rows, BPE, P.PATTERN).collect()} == {i: len(ids_of(tok, t, 0)) - 1 for i, t in enumerate(more)}
    assert counts.token_counts(none, BPE, P.PATTERN).isEmpty()


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([("a", PASSAGE[:40]), ("b", PASSAGE), ("b", PASSAGE), (None, None), ("c", "")], "item_id string, text string")
    got = {(r.doc_id, r.n_words): r for r in decontaminate.contamination(docs, items).collect()}
    assert got[6, 43].contaminated and got[6, 43].n_hit == 40 and got[6, 43].spans[0].start == 4
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) - 2
    assert decontaminate.decontaminate(docs, items.filter("1 = 0")).count() == len(TEXTS)
    assert decontaminate.decontaminate(none, items).isEmpty()
    more = items.union(spark.createDataFrame([("d", f"{PASSAGE[60:120]} end"), ("e", " ".join(f"w{i}" for i in range(90, 120)))], "item_id string, text string"))
    plain = lambda d: sorted(map(repr, d.collect()))
    assert plain(decontaminate.contamination(docs, more)) == plain(decontaminate.contamination(docs, more, pass_chars=70))
    assert decontaminate.Finder([(None, PASSAGE), ("b", PASSAGE)]).scan(f"y {PASSAGE} z") == (42, [(1, 41)], ["b", None])


def test_pipeline(spark, docs, none, sf):
    import corpus_pipeline as C

    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for table in (docs, none):
        now = table
        for name, stage in C.STAGES[:-1]:
            before, now = now, C.materialize(stage(spark, now, sf))
            assert now.columns == docs.columns and now.count() <= before.count()
        assert C.STAGES[-1][1](spark, now, sf).select("doc_id").distinct().count() <= now.count()
    pieces = C.run(spark, sf).collect()
    assert len({r.doc_id for r in pieces}) > 100


def jaccard(a, b, k=5):
    x, y = ({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in ((a or "").lower().split(), (b or "").lower().split()))
    return len(x & y) / len(x | y)


def test_near_stage_drops_copies_from_similarity_08(spark, docs, none):
    import corpus_pipeline as C

    r = np.random.default_rng(3)
    texts = []
    for base in range(40):
        w = [f"b{base}x{i}" for i in r.integers(0, 5000, 300)]
        texts.append(" ".join(w))
        for edits in (1, 3, 5, 6, 12, 30):
            own = list(w)
            for at in r.choice(300, edits, replace=False):
                own[at] = f"e{base}y{edits}z{at}"
            texts.append(" ".join(own))
    order = list(enumerate(texts))
    root = list(range(len(texts)))
    for i, t in order:
        for j in range(i - i % 7, i):
            if jaccard(t, texts[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    rows = spark.createDataFrame(order, "doc_id long, text string")
    got = {x.doc_id: x for x in similar.near_copies(rows).collect()}
    assert {i: got[i].component_id for i in got} == dict(enumerate(root))
    assert len(set(root)) < len(root) - 120
    left = C.near_dedup(spark, rows, "").collect()
    assert sorted(x.doc_id for x in left) == sorted(set(root))
    assert similar.near_copies(docs).count() == len(TEXTS) and similar.near_copies(none).isEmpty()


@pytest.mark.parametrize("crowded", [1, 1000])
def test_substring_tells_rows_of_one_id_apart(spark, monkeypatch, crowded):
    monkeypatch.setattr(substring, "CROWDED", crowded)
    low = lambda t: int(xxhash.xxh64_intdigest(t.encode(), 42)) & 0xFFFF
    repeated = f"{PASSAGE} tail"
    clean = next(t for t in (" ".join(f"c{n}q{i}" for i in range(40)) for n in range(2_000_000)) if low(t) == low(repeated))
    rows = spark.createDataFrame([(1, f"x {PASSAGE} y"), (None, repeated), (None, clean)], "doc_id long, text string")
    got = {r.kept: (r.n_words, r.n_removed) for r in substring.remove_repeats(rows).collect()}
    assert got == {f"x {PASSAGE} y": (42, 0), "tail": (41, 40), clean: (40, 0)}


def test_decontamination_deals_windows_over_passes(spark, docs):
    item = f"{LONG[:80_000]} {PASSAGE}"
    items = spark.createDataFrame([("long", item), ("b", PASSAGE), (None, PASSAGE)], "item_id string, text string")
    plain = lambda d: sorted(map(repr, d.collect()))
    want = decontaminate.contamination(docs, items)
    assert plain(decontaminate.contamination(docs, items, pass_windows=3_000)) == plain(want)
    got = {(r.doc_id, r.n_words): r for r in want.collect()}
    assert got[6, 43].items == ["b", "long", None] and got[8, 30_000].n_hit >= 10_000
    parts = decontaminate.parts_of(items, "item_id", "text").collect()
    folded_item = folded(item)
    assert max(r.n for r in parts) <= decontaminate.PART_WINDOWS and sum(r.n for r in parts if r.item == "long") >= len({tuple(folded_item[i : i + 13]) for i in range(len(folded_item) - 12)})
    assert {w for r in parts if r.item == "long" for x in [r.t.split()] for w in zip(*(x[i:] for i in range(13)))} == set(zip(*(folded_item[i:] for i in range(13))))


def _roots(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("near", [40, 3000])
def test_covering_tables_find_every_link(spark, near):
    r = np.random.default_rng(5)
    base = [int(x) for x in r.integers(0, 2**63, 300)]
    prints = set(base)
    for x in base[:3]:  # crowds: all within three bits of one, so that buckets have to be split
        for _ in range(near // 3):
            for b in r.choice(64, int(r.integers(1, 4)), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
            x = base[int(r.integers(0, 3))]
    signed = np.array(sorted(prints), np.uint64).view(np.int64)
    want = set()
    for i, x in enumerate(signed):
        far = np.bitwise_count((signed[i + 1 :] ^ x).view(np.uint64))
        want |= {(min(int(x), int(y)), max(int(x), int(y))) for y in signed[i + 1 :][far <= 2]}
    rows = spark.createDataFrame([(int(x),) for x in signed], "fp long")
    got = [(e.a, e.b) for e in simhash.links(rows).collect()]
    assert set(got) <= want and len(got) == len(set(got)) <= 20 * len(signed) and len(want) > near // 4
    assert _roots(got) == _roots(want)
    assert max(bin(m).count("1") for m in simhash.refined(simhash.refined(simhash.masks(), 2), 2)) >= 59


def test_a_language_stage_without_labels_drops_only_texts_without_a_letter(spark, docs):
    import corpus_pipeline as C

    left = C.language_id(spark, docs.withColumn("lang", F.lit(None).cast("string")), "")
    assert sorted(map(repr, left.select("doc_id", "text").collect())) == sorted(map(repr, docs.filter(F.col("text").rlike(r"\p{L}")).select("doc_id", "text").collect()))


def test_removal_by_broadcast_or_shuffle(spark, docs):
    from feedspark.llm.common import filter_rows

    keys = docs.filter("doc_id < 6 or doc_id is null").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    for how in ("left_anti", "left_semi"):
        few, many = (filter_rows(docs, keys, how, most=most) for most in (100, 0))
        assert few.columns == many.columns == docs.columns
        assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
