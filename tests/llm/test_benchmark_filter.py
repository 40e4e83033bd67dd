import time

import numpy as np

from feedspark.llm import decontaminate as d


def test_items_that_share_a_preamble_are_built_in_linear_time():
    preamble = " ".join(f"pre{i}" for i in range(13))
    began = time.process_time()
    finder = d.Finder((f"item{i:06}", f"{preamble} a{i} b{i}") for i in range(20_000))
    n, runs, items = finder.scan(f"x {preamble} y")
    assert (n, runs, len(items), items[0], items[-1]) == (15, [(1, 14)], 20_000, "item000000", "item019999")
    assert finder.scan(f"z {preamble} a7 b7 q")[2] == items and finder.scan(preamble[:-1])[2] == []
    assert time.process_time() - began < 15


def test_names_of_shared_and_repeated_windows():
    text = " ".join(f"w{i}" for i in range(20))
    finder = d.Finder([("b", text), (None, text), ("a", text[: text.index(" w14")]), ("b", text), ("c", "short item")])
    assert finder.scan(text)[2] == ["a", "b", None] and finder.scan(f"{text} short item")[2] == ["a", "b", "c", None]
    assert finder.scan(text[text.index("w3") :])[2] == ["b", None]


def test_the_filter_stops_no_text_with_a_window(spark):
    r = np.random.default_rng(3)
    items = [(f"i{k}", " ".join(f"v{x}" for x in r.integers(0, 400, int(n)))) for k, n in enumerate(r.integers(1, 60, 80))]
    texts = [" ".join(f"v{x}" for x in r.integers(0, 400, int(n))) for n in r.integers(0, 80, 150)]
    texts += [f"a {t} b" for _, t in items[::3]] + [t.upper() for _, t in items[1::3]] + [" ".join(f"o{i}x{j}" for j in range(30)) for i in range(100)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    plain = lambda x: sorted(map(str, x.collect()))
    want = plain(d.contamination(docs, bench))
    assert plain(d.contamination(docs, bench, pass_windows=300)) == want
    rows = docs.selectExpr("doc_id", "xxhash64(text) as text_key", "coalesce(text, '') as t")
    passed = d._sifted(rows, d.parts_of(bench, "item_id", "text")).filter("t is not null").count()
    assert passed < len(texts) - 90
