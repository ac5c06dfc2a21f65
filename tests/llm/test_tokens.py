"""Token counts, ids and packing against the public library."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from storelens.llm import byte_bpe, packing, token_counts
from storelens.llm.common import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(number):
    draw = random.Random(number)
    parts = [*"aabbcst'dmrevl \n\t  .,!?019é–ßñ\u0085 　Ⅷ²x’\x1c\x00中😀_-=<>|", "'s", "'ll", "'re", "<|endoftext|>",
             "  ", "\n\n", " '", "=====", "don't", "the"]
    return ["".join(draw.choices(parts, k=draw.randrange(120))) for _ in range(number)]


def test_counts_and_ids_equal_the_library(library):
    texts = [*random_texts(1500), "", "a" * 3000, " " * 300, "<|endoftext|>" * 2, "<|endoftext", "|>", "thnd" * 2000]
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    column = pa.array(texts, pa.large_string())
    machine = byte_bpe.CountingTransducer(byte_bpe.Vocabulary(PATH), most=3000)  # small: compiled anew several times
    assert token_counts.count_batch(column, machine).tolist() == [len(w) for w in wanted]
    stream, ends = packing.token_ids(column, byte_bpe.Encoder(PATH, most=500))
    assert stream.tolist() == [i for w in wanted for i in [*w, 0]]
    assert ends.tolist() == np.cumsum([len(w) + 1 for w in wanted]).tolist()


def test_cuts_do_not_depend_on_chunks(monkeypatch):
    texts = "".join(random_texts(300))
    points = np.frombuffer(texts.encode("utf-32-le"), np.uint32)
    first = np.array([0])
    whole = byte_bpe.pretoken_cuts(points, first)
    for size in (1, 7, 1000):
        monkeypatch.setattr(byte_bpe, "CHUNK", size)
        assert (byte_bpe.pretoken_cuts(points, first) == whole).all()


@pytest.mark.parametrize("part, rounds, most", [(512, 8, 700_000), (7, 8, 700_000), (64, 1, 700_000), (64, 8, 300), (16, 2, 300)])
def test_long_pretokens_are_counted_in_parts(library, monkeypatch, part, rounds, most):
    draw = random.Random(part)
    words = [("thnd" * 1500), "=" * 5001, "中文字" * 700, "ab" * 2047 + "c", "".join(draw.choices("aeinorst", k=6000)),
             "".join(draw.choices("etaoinshrdluABCDéß中", k=4100)), "x" * 4097, "8" * 4500]
    monkeypatch.setattr(byte_bpe, "PART", part)
    monkeypatch.setattr(byte_bpe, "MOST_ROUNDS", rounds)
    monkeypatch.setattr(byte_bpe, "LONG", 100)
    machine = byte_bpe.CountingTransducer(byte_bpe.Vocabulary(PATH), most=most)
    walked = byte_bpe.CountingTransducer(machine.vocabulary)
    for word in words:
        wanted = len(library.encode(word, add_special_tokens=False).ids)
        assert machine.count(word.encode()) == wanted == walked._walk(0, word.encode())[1]


def test_maps_of_parts_are_closed_and_compose(library):
    machine = byte_bpe.CountingTransducer(byte_bpe.Vocabulary(PATH))
    word = "".join(random.Random(1).choices("aeinorst", k=4000)).encode()
    parts = np.frombuffer(word, np.uint8).reshape(-1, 40).astype(np.int64)
    part, begin, end, total = machine._maps(parts)
    maps = {(p, b): (e, t) for p, b, e, t in zip(part.tolist(), begin.tolist(), end.tolist(), total.tolist())}
    state = tokens = 0
    for n in range(len(parts)):
        assert maps[n, state] == machine._walk(state, word[40 * n:40 * n + 40])
        state, added = maps[n, state]
        tokens += added
    assert tokens == len(library.encode(word.decode(), add_special_tokens=False).ids)


def test_pretoken_of_megabytes(library):
    draw = random.Random(11)
    pieces = ["".join(draw.choices("etaoinshrdlu", k=draw.randrange(2, 9))) for _ in range(60)]
    word = "".join(draw.choices(pieces, k=1_100_000))
    assert len(word) > 4_500_000
    machine = byte_bpe.CountingTransducer(byte_bpe.Vocabulary(PATH))
    found = token_counts.count_batch(pa.array([word, "=" * 5_000_000], pa.large_string()), machine)
    assert found.tolist() == [len(library.encode(w, add_special_tokens=False).ids) for w in (word, "=" * 5_000_000)]


def test_contractions_at_the_end_of_a_text(library):
    texts = ["'r", "e'", "it'l", "l'll", "'", "''s", "we'v", "e've", "'d'm't", "x'", "re"]
    machine = byte_bpe.CountingTransducer(byte_bpe.Vocabulary(PATH))
    found = token_counts.count_batch(pa.array(texts, pa.large_string()), machine)
    assert found.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_count_query_rows(make_docs, odd_rows, library):
    found = token_counts.token_counts(make_docs(odd_rows), PATH).collect()
    wanted = Counter(
        (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512)
        for i, t in odd_rows)
    assert Counter(tuple(r) for r in found) == wanted
    assert token_counts.token_counts(make_docs(odd_rows).limit(0), PATH).isEmpty()


def check_sequences(rows, size):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return len(places)


def test_packing(make_docs, odd_rows, library):
    docs = make_docs([*odd_rows, *[(100 + n, "the " * (n % 40)) for n in range(400)]])
    found = packing.packed(docs, PATH, 64).collect()
    size = check_sequences(found, 64)
    assert size <= -(-sum(r["length"] for r in found) // 64) + 2
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces = {}
    for r in found:
        ids = [*library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 0] if r["doc_id"] not in pieces else pieces[r["doc_id"]]
        pieces[r["doc_id"]] = ids
        part = ids[r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        assert r["length"] == 64 or r["piece"] == 0
    assert sum(r["length"] for r in found if r["doc_id"] == 5) == 2 * len(pieces[5])
    assert packing.packed(docs.limit(0), PATH).isEmpty()


@pytest.mark.parametrize("seed", range(6))
def test_plan_gives_every_piece_one_place(seed):
    draw = random.Random(seed)
    counts = {draw.randrange(1, 101): draw.randrange(1, 50) for _ in range(40)}
    rows, ranks = [], {}
    for length, rank, number, sequence, offset in packing.plan_best_fit(counts, 100):
        ranks.setdefault(length, []).extend(range(rank, rank + number))
        rows += [{"sequence_id": sequence + n, "offset": offset, "length": length} for n in range(number)]
    assert {length: sorted(r) for length, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    used = check_sequences(rows, 100)
    least = max(sum(n * c for n, c in counts.items()) / 100, sum(c for n, c in counts.items() if n > 50))
    assert used <= 11 / 9 * least + 1  # what best fit with the long ones first is known to reach
