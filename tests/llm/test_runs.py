"""Periodic runs against plain Python."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from storelens.llm import queries
from storelens.llm.periodic_runs import find_runs, periodic_runs

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every stretch with a period, longest first by period, those of a multiple of the smallest period left out."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        start = 0
        for place in range(period, len(words) + 1):
            if place == len(words) or words[place] != words[place - period]:
                length = place - start
                if length >= max(6, 4 * period):
                    found.setdefault((start, length), period)
                start = place - period + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words():
    draw = random.Random(5)
    for _ in range(800):
        texts = []
        for _ in range(draw.randint(1, 4)):
            words = draw.choices(range(draw.choice([1, 2, 3, 6])), k=draw.randint(0, 60))
            if words and draw.random() < 0.6:
                a = draw.randrange(len(words))
                p = 1 + (len(words) - a) // draw.randint(3, 8)
                words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
            texts.append(words * draw.choice([1, 1, 1, 3, 5]))
        flat = np.array(sum(texts, []), np.int64)
        got = list(zip(*(a.tolist() for a in find_runs(flat, np.repeat(np.arange(len(texts)), [len(t) for t in texts])))))
        wanted, begin = [], 0
        for words in texts:
            wanted += [(begin + s, length, p) for s, length, p in plain_runs(words)]
            begin += len(words)
        assert got == wanted


def test_long_periodic_texts():
    for words in ([0] * 200_000, [0, 1, 2, 0, 1] * 40_000, list(range(50_000)) * 4):
        got = [a.tolist() for a in find_runs(np.array(words), np.zeros(len(words), np.int64))]
        period = len(set(map(str, words))) if words[:3] != [0, 1, 2] or len(words) != 200_000 or words[3] else 5
        assert got == [[0], [200_000], [period]]


def test_odd_rows(spark, make_docs, odd_rows):
    rows = odd_rows + [(20, "a a a a a"), (21, "a a a a a a"), (22, "a b a b a b a b c"), (22, "a b a b a b a b c"), (23, "x y " * 30_000)]
    docs = make_docs(rows).withColumns({"runs": F.lit(1), "collapsed": F.lit(2), "id": F.lit(3), "n_words": F.lit(4)})
    found = periodic_runs(docs).collect()
    wanted = []
    for own, text, *_ in rows:
        words = re.findall("[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(words) if len(words) < 1000 else [(0, 60_000, 2)] if words[0] == "x" else []
        wanted.append((own, len(words), runs, collapsed(words, runs)))
    key = lambda r: (str(r[0]), r[3])
    assert sorted([(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in found], key=key) == sorted(wanted, key=key)
    assert periodic_runs(docs.limit(0)).isEmpty()


def test_query(spark):
    found = {r["doc_id"]: r for r in queries.queries()["op12_periodic_runs"](spark, SF_DIR).collect()}
    docs = pq.read_table(Path(SF_DIR) / "documents.parquet").to_pylist()
    assert len(found) == len(docs)
    seen = 0
    for doc in docs:
        words = re.findall("[^\x20\x09-\x0D]+", doc["text"] or "")
        mark = zlib.crc32(str(doc["doc_id"]).encode())
        n, g = len(words), mark // 10
        if mark % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        if n > 3000 and mark % 10:
            continue
        runs = plain_runs(words)
        seen += len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        spelled = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        milli = 1000 * best[1] // best[2] if runs else None
        assert tuple(found[doc["doc_id"]]) == (
            doc["doc_id"], len(runs), *best, milli, hashlib.sha256(spelled.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
    assert seen > 5
