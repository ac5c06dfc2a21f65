"""BagMinHash classes against all pairs in plain Python."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from pyspark.sql import functions as F

from storelens.llm import bag_minhash
from storelens.llm.components import components


def bag(text):
    words = (text or "").split()
    return Counter(tuple(words[n:n + 5]) for n in range(max(1, len(words) - 4))) if words else Counter()


def brute_force(rows):
    texts = sorted({t or "" for _, t in rows})
    bags = {t: bag(t) for t in texts}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in combinations(texts, 2):
        low, high = (bags[a] & bags[b]).total(), (bags[a] | bags[b]).total()
        if high and low / high >= 0.8:
            root[find(a)] = find(b)
    groups = defaultdict(list)
    for n, t in rows:
        groups[find(t or "")].append(n)
    return Counter(tuple(sorted(g, key=str)) for g in groups.values())


def edited(draw, words, times):
    words = list(words)
    for _ in range(times):
        words[draw.randrange(len(words))] = f"x{draw.random()}"
    return " ".join(words)


def test_classes(make_docs, odd_rows):
    draw = random.Random(9)
    rows = [*odd_rows, (11, "a b c d"), (12, "A b c d"), (13, "a a a a a a a a a a a"), (14, "a a a a a a a a a a")]
    number = 100
    for source in range(12):
        words = [f"v{draw.randrange(4000)}" for _ in range(draw.choice([30, 150, 400]))]
        for _ in range(draw.choice([1, 3, 40])):  # copies with more and more edits: many are only near some others
            rows.append((number, edited(draw, words, draw.randrange(0, max(2, len(words) // 25)))))
            number += 1
    docs = make_docs(rows)
    found = bag_minhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    classes, sizes = defaultdict(list), {}
    for r in found:
        classes[r["root"]].append(r["doc_id"])
        sizes[r["root"]] = (r["class_id"], r["class_size"])
    assert Counter(tuple(sorted(g, key=str)) for g in classes.values()) == brute_force(rows)
    for root, ids in classes.items():
        assert sizes[root] == (min((i for i in ids if i is not None), default=None), len(ids))
    left = bag_minhash.drop_near(docs)
    assert left.schema == docs.schema
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(c for c, _ in sizes.values())
    assert bag_minhash.near_duplicates(docs.limit(0)).isEmpty()


def test_columns_of_documents_may_have_any_name(spark, make_docs):
    names = ["class_id", "class_size", "root", "node", "stay_node_", "stay_id_", "own_node_", "Stay_Id__", "band", "key", "least_"]
    docs = make_docs([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")]).withColumns({name: F.lit(name) for name in names})
    left = bag_minhash.drop_near(docs)
    assert left.schema == docs.schema
    assert sorted((r["doc_id"], r["class_id"], r["root"]) for r in left.collect()) == [(1, "class_id", "root"), (3, "class_id", "root")]


def test_signatures_estimate_weighted_jaccard():
    draw = np.random.default_rng(1)
    value = draw.integers(1, 2**63, 60).astype(np.uint64)
    one, two = draw.integers(0, 12, 60), draw.integers(0, 12, 60)
    row = np.repeat([0, 1], 60)
    weight = np.concatenate([one, two])
    some = weight > 0
    size = 4096
    found = bag_minhash.signatures(row[some], np.tile(value, 2)[some], weight[some], 2, size)
    truth = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert abs((found[0] == found[1]).mean() - truth) < 4 * (truth * (1 - truth) / size) ** 0.5


def test_components_of_chains_and_stars(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 160)] + [(300, 300)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["root"] for r in components(frame).collect()}
    assert found == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 160)}
    assert components(frame.limit(0)).isEmpty()
