"""Exact duplicates and the source mixture against plain Python."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from storelens.llm import exact_dedup, source_mixing


@pytest.mark.parametrize("heavy", [1, 6, 2000])
def test_exact_groups(make_docs, odd_rows, monkeypatch, heavy):
    """No group, some groups and all groups are frequent ones; lengths and prefixes that agree without equal texts."""
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    odd_rows = [*odd_rows, *[(100 + n, "same text") for n in range(40)], (150, "lone of its length"),
                (151, "p" * 64 + "a"), (152, "p" * 64 + "b"), (153, "q" * 65)]
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    found = exact_dedup.exact_groups(make_docs(odd_rows), carry={"sha": digest}).collect()
    groups = defaultdict(list)
    for number, text in odd_rows:
        groups[text or ""].append(number)
    assert len(found) == len(odd_rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for row in found:
        ids = by_sha[row["sha"]]
        assert row["group_size"] == len(ids)
        assert row["keep_id"] == max((i for i in ids if i is not None), default=None)
    assert Counter(r["sha"] for r in found if r["kept"]) == Counter(list(by_sha))


def test_drop_exact_keeps_columns(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    left = exact_dedup.drop_exact(docs)
    assert left.schema == docs.schema
    assert sorted((r["text"] or "") for r in left.collect()) == sorted({t or "" for _, t in odd_rows})
    assert exact_dedup.drop_exact(docs.limit(0)).isEmpty()


def water_fill(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[n % 3] for n, s in enumerate(order)}
    left, open_, targets = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > most * sizes[s] + 1e-9]
        if not full:
            return targets | {s: level * weight[s] for s in open_}
        for s in full:
            targets[s] = most * sizes[s]
            left -= targets[s]
            open_.remove(s)
    return targets


def test_mixture(make_docs):
    rows = [(n, "w " * (n * 37 % 90), f"s{n * n % 7}" if n % 11 else None) for n in range(900)]
    rows += [(1000, None, "s1"), (1001, "", "only empty"), (1002, "x", "s1"), (1002, "x", "s1")]
    docs = make_docs(rows)
    found = source_mixing.mixed(docs).collect()
    assert len(found) == len(rows)
    assert sorted(found) == sorted(source_mixing.mixed(docs.repartition(5)).collect())
    sizes, taken = Counter(), Counter()
    source = {n: s for n, _, s in rows}
    for r in found:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        sizes[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    for name, target in water_fill(sizes).items():
        got = next(r for r in found if source[r["doc_id"]] == name)
        assert got["source_size"] == sizes[name]
        assert got["target"] == pytest.approx(target)
        assert abs(taken[name] - target) <= 45
    assert source_mixing.mixed(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("share", [0.4, 0.5, 0.6])
def test_small_rows_fill_what_a_long_one_leaves_open(make_docs, share):
    rows = [(n, "w " * (1 + n % 4), f"s{n % 3}") for n in range(9000)]
    rows += [(10_000 + n, "w " * 3_600, f"s{n}") for n in range(3)]
    # Copies of one id, source and text are taken alike.
    rows += [(20_000, "w w w w w", "s1")] * 3 + [(20_001, "", "s1")]
    docs = source_mixing.mix_rows(make_docs(rows))
    found = source_mixing.mix(docs, weights=(1, 1, 1), share=share, most=1).collect()
    assert len(found) == len(rows)
    for source in ("s0", "s1", "s2"):
        own = [r for r in found if r["source"] == source]
        target = own[0]["target"]
        p = target / own[0]["source_size"]
        units, n = defaultdict(int), {}
        for r in own:
            units[r["key_"]] += r["size"]
            n[r["key_"]] = r["u_"]
        left, taken, blocked = target, set(), False
        for key in sorted(units, key=lambda k: (n[k] / (1 - n[k]) / (p / (1 - p)), k)):
            if units[key] <= left and not (blocked and not units[key]):
                taken.add(key)
                left -= units[key]
            blocked |= units[key] > left and key not in taken
        rest = min((s for k, s in units.items() if k not in taken and s), default=0)
        assert abs(left) < max(rest, 1)
        got = {r["key_"] for r in own if r["copies"]}
        assert len(got ^ taken) <= 1 and taken <= got
        assert abs(sum(units[k] for k in got) - target) <= max(rest, 1) / 2 + 1e-6


def test_inclusion_is_near_its_probability(make_docs):
    rows = [(n, "w w w w", f"s{n % 4}") for n in range(4000)]
    found = source_mixing.mixed(make_docs(rows)).collect()
    halves = Counter((r["doc_id"] % 4, r["doc_id"] < 2000) for r in found for _ in range(r["copies"]))
    for s in range(4):
        low, high = halves[s, True], halves[s, False]
        assert abs(low - high) < 0.2 * (low + high)


def test_resample_repeats_whole_rows(make_docs):
    docs = make_docs([(n, "w " * (1 + n % 5), f"s{n % 3}") for n in range(120)])
    wanted = {r["doc_id"]: r["copies"] for r in source_mixing.mixed(docs).collect() if r["copies"]}
    again = source_mixing.resample(docs)
    assert again.schema == docs.schema
    assert Counter(r["doc_id"] for r in again.collect()) == Counter(wanted)
