"""Byte-level BPE over batches of texts: a pre-token automaton run in parallel chunks, and a counting transducer."""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa

# What a character is to the automaton. White space that is followed by white space or the end belongs to a run,
# a blank before anything else goes to the next pre-token, other white space there stands alone. An apostrophe may
# begin a contraction of two or of three characters. The first character of a text is marked by FIRST.
LETTER, NUMBER, OTHER, BLANK, SINGLE, RUN, TWO, THREE, FIRST = range(9)
# The contractions of the public pattern.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")
# States are named after what the pre-token so far is; the last four: in a contraction with one, two, one or no
# character to come.
_IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _AFTER_BLANK, _AFTER_SINGLE, _IN_RUN, _TWO_1, _THREE_2, _THREE_1, _ENDED = range(10)
_STATES, _KINDS, _CUT = 10, 16, 16
CHUNK = 64
# A pre-token of more bytes than LONG is counted in parts of PART bytes side by side, in so many rounds at most.
LONG, PART, MOST_ROUNDS = 4096, 512, 8
# The library is handed so many words at once: what it returns for a word takes much more memory than the ids.
AT_ONCE = 2048


@lru_cache(1)
def character_kinds() -> np.ndarray:
    """Kind of every code point, white space as RUN."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = LETTER
        elif major == "N":
            kinds[point] = NUMBER
    spaces = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    kinds[spaces] = RUN
    return kinds


@lru_cache(1)
def _steps() -> np.ndarray:
    """For state * _KINDS + kind the next state, plus _CUT where a pre-token begins."""
    table = np.zeros((_STATES, _KINDS), np.uint8)
    stays = {LETTER: _IN_LETTERS, NUMBER: _IN_NUMBERS, OTHER: _IN_OTHERS}
    opens = stays | {BLANK: _AFTER_BLANK, SINGLE: _AFTER_SINGLE, RUN: _IN_RUN, TWO: _TWO_1, THREE: _THREE_2}
    for state in range(_STATES):
        for kind, begun in opens.items():
            step = begun + _CUT
            if kind in stays and state in (stays[kind], _AFTER_BLANK):
                step = stays[kind]
            elif kind in (TWO, THREE) and state in (_IN_OTHERS, _AFTER_BLANK):
                step = _IN_OTHERS
            elif kind == RUN and state == _IN_RUN:
                step = _IN_RUN
            elif kind == LETTER and state in (_TWO_1, _THREE_2, _THREE_1):
                step = _THREE_1 if state == _THREE_2 else _ENDED
            table[state, kind] = step
            table[state, kind + FIRST] = begun + _CUT if kind != RUN else _IN_RUN + _CUT
    return table.ravel()


def _kinds_of(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Kinds with what the following characters decide; ``first`` holds where texts begin."""
    kinds = character_kinds()[points]
    last = np.zeros(len(points), bool)
    last[first[1:] - 1] = True
    last[-1:] = True
    space = kinds == RUN
    joins = np.zeros(len(points), bool)
    joins[:-1] = space[:-1] & ~space[1:]
    joins &= ~last
    kinds[joins] = np.where(points[joins] == 0x20, BLANK, SINGLE)
    marks = np.flatnonzero((points == 0x27) & ~last)
    one, two = points[marks + 1], points.take(marks + 2, mode="clip")
    short = np.isin(one, [ord(c) for c in SHORT_ENDINGS])
    long = np.zeros(len(marks), bool)
    for a, b in LONG_ENDINGS:
        long |= (one == ord(a)) & (two == ord(b)) & ~last[marks + 1]
    kinds[marks[long]] = THREE
    kinds[marks[short]] = TWO
    kinds[first] += FIRST
    return kinds


def pretoken_cuts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which characters begin a pre-token, for texts that follow each other in ``points``.

    The automaton runs over all chunks of CHUNK characters at once. First each chunk is read from every state, which
    gives its state map; a prefix scan composes the maps, so each chunk learns the state it is entered in; then all
    chunks are read once more from there.
    """
    steps, kinds = _steps(), _kinds_of(points, first)
    chunks = -(-len(kinds) // CHUNK)
    padded = np.full(chunks * CHUNK, RUN + FIRST, np.uint8)
    padded[:len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    maps = np.tile(np.arange(_STATES, dtype=np.uint8), (chunks, 1))
    for kind in columns:
        maps = steps[maps * np.uint8(_KINDS) + kind[:, None]] & np.uint8(_CUT - 1)
    reach = 1
    while reach < chunks and (maps[reach:] != maps[reach:, :1]).any():  # a map with one value needs nothing before it
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    states = np.full(chunks, _ENDED, np.uint8)
    states[1:] = maps[:-1, _ENDED]
    cuts = np.empty((CHUNK, chunks), bool)
    for row, kind in enumerate(columns):
        step = steps[states * np.uint8(_KINDS) + kind]
        cuts[row] = step >= _CUT
        states = step & np.uint8(_CUT - 1)
    return cuts.T.ravel()[:len(kinds)]


class Pretokens:
    """Pre-tokens of a batch of texts: the distinct ones, and for each text a run of ``codes`` into them."""

    def __init__(self, texts: pa.Array, special: bytes) -> None:
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = (texts.buffers()[2] or pa.py_buffer(b""))[int(offsets[0]):int(offsets[-1])].to_pybytes()
        offsets = offsets - offsets[0]
        marks = _special_spans(data, offsets, special)
        bounds = np.unique(np.concatenate([offsets[:-1], marks.ravel()])) if len(marks) else np.unique(offsets[:-1])
        bounds = bounds[bounds < len(data)]
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        raw = np.frombuffer(data, np.uint8)
        at = np.flatnonzero((raw & 0xC0) != 0x80)
        if len(points):
            starts = at[pretoken_cuts(points, np.searchsorted(at, bounds))]
            for begin, end in marks:
                starts = starts[(starts <= begin) | (starts >= end)]
        else:
            starts = at
        ends = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]
        ).dictionary_encode()
        self.distinct: list[bytes] = pieces.dictionary.to_pylist()
        self.codes = pieces.indices.to_numpy()
        self.bounds = np.searchsorted(starts, offsets)

    def totals(self, of_distinct: np.ndarray) -> np.ndarray:
        """Sum over the pre-tokens of each text."""
        sums = np.concatenate([[0], np.cumsum(of_distinct[self.codes], dtype=np.int64)])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]


def _special_spans(data: bytes, offsets: np.ndarray, special: bytes) -> np.ndarray:
    """Where the special string stands inside a text."""
    spans, at = [], data.find(special)
    while at >= 0:
        end = at + len(special)
        if np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, end, "left"):
            spans.append((at, end))
            at = data.find(special, end)
        else:
            at = data.find(special, at + 1)
    return np.array(spans, np.int64).reshape(-1, 2)


class Vocabulary:
    """Tokens and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        byte_of = _byte_of()

        def spelled(token: str) -> bytes:
            return bytes(byte_of[c] for c in token)

        self.special = stored["added_tokens"][0]["content"].encode()
        special = {t["content"] for t in stored["added_tokens"]}
        self.tokens = {spelled(t): i for t, i in stored["model"]["vocab"].items() if t not in special}
        self.ranks = {}
        for rank, merge in enumerate(stored["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[spelled(left), spelled(right)] = rank
        # What a longer token can still grow out of.
        self.prefixes = {t[:n] for t in self.tokens for n in range(1, len(t))}

    def split(self, word: bytes) -> list[bytes]:
        """Tokens of one pre-token, merge by merge."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts


@lru_cache(1)
def _byte_of() -> dict[str, int]:
    """Byte-level files write printable bytes as themselves and the others as characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class CountingTransducer:
    """Deterministic transducer over the bytes of a pre-token whose transitions carry by how much the token count changes.

    An encoding is the one BPE gives exactly when each two neighbouring tokens are. So the last token of every prefix
    is its longest suffix that is a token and goes together with the last token of what stands before it. A state is
    what later bytes can still ask for: the longest suffix of the prefix that begins a token, and for each place in it
    the last token there and how many tokens fewer there were. States and transitions are compiled when a text first
    needs them; beyond ``most`` transitions compilation starts anew, so memory is bounded and counts stay the same.

    A long pre-token is read in parts at once. A part's map says for states it may be entered in which state it ends in
    and how many tokens it adds; maps are composed by a prefix scan.
    """

    def __init__(self, vocabulary: Vocabulary, most: int = 700_000) -> None:
        self.vocabulary, self.most = vocabulary, most
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, int]] = {}
        self._number((b"", (b"",), (0,)))

    def _number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def _renewed(self, *kept: np.ndarray) -> list[np.ndarray]:
        """Starts anew with the states named in ``kept`` alone and returns their new names."""
        old, ends = self.states, np.cumsum([len(k) for k in kept])[:-1]
        self._restart()
        used, place = np.unique(np.concatenate(kept), return_inverse=True)
        names = np.array([self._number(old[s >> 8]) << 8 for s in used.tolist()], np.int64)
        return np.split(names[place], ends)

    def _together(self, left: bytes, right: bytes) -> bool:
        if not left:
            return True
        pair = left, right
        if pair not in self.pairs:
            if len(self.pairs) > self.most:
                self.pairs.clear()
            self.pairs[pair] = self.vocabulary.split(left + right) == [left, right]
        return self.pairs[pair]

    def _compile(self, key: int) -> tuple[int, int]:
        window, tokens, counts = self.states[key >> 8]
        grown = window + bytes([key & 255])
        for begin in range(len(window) + 1):
            token = grown[begin:]
            if token in self.vocabulary.tokens and self._together(tokens[begin], token):
                break
        change = counts[begin] + 1
        begin = next(n for n in range(len(grown) + 1) if n == len(grown) or grown[n:] in self.vocabulary.prefixes)
        wanted = [grown[n:] in self.vocabulary.prefixes for n in range(begin, len(grown))]
        before = [(t, c - change) if w else (b"", 0) for w, t, c in zip(wanted, tokens[begin:], counts[begin:])]
        state = grown[begin:], (*(t for t, _ in before), token), (*(c for _, c in before), 0)
        step = self.steps[key] = self._number(state) << 8, change
        return step

    def count(self, word: bytes) -> int:
        if len(self.steps) > self.most:
            self._restart()
        if len(word) > LONG:
            return self._count_parts(word)
        return self._walk(0, word)[1]

    def _walk(self, state: int, word: bytes) -> tuple[int, int]:
        total, known = 0, self.steps.get
        for byte in word:
            step = known(state | byte) or self._compile(state | byte)
            state = step[0]
            total += step[1]
        return state, total

    def _step_all(self, states: np.ndarray, read: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One transition of many runs; equal ones are looked up once."""
        asked, place = np.unique(states | read, return_inverse=True)
        found = [self.steps.get(key) or self._compile(key) for key in asked.tolist()]
        found = np.array(found, np.int64).reshape(-1, 2)[place]
        return found[:, 0], found[:, 1]

    def _maps(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Maps of the rows of ``parts`` as (part, state at its begin, state at its end, tokens), by the first two.

        Every part is first read from the initial state. A state a part ends in is one the next part may be entered in,
        so that one is read from there, until nothing new comes up: a few rounds, as the state hardly depends on what
        is far behind. What is still unknown after MOST_ROUNDS is left to the caller.
        """
        part = np.zeros(0, np.int64)
        begin, end, total = part, part, part
        new, state = np.arange(len(parts)), np.zeros(len(parts), np.int64)
        for _ in range(MOST_ROUNDS):
            now, added = state, np.zeros(len(new), np.int64)
            for column in parts.T:
                if len(self.steps) > self.most:
                    state, now, begin, end = self._renewed(state, now, begin, end)
                now, change = self._step_all(now, column[new])
                added += change
            part, begin = np.append(part, new), np.append(begin, state)
            end, total = np.append(end, now), np.append(total, added)
            inner = part < len(parts) - 1
            wanted = np.unique(np.stack([part[inner] + 1, end[inner]]), axis=1)
            known = set(zip(part.tolist(), begin.tolist()))
            fresh = [n for n, pair in enumerate(zip(*wanted.tolist())) if pair not in known]
            new, state = wanted[:, fresh]
            if not len(new):
                break
        order = np.lexsort((begin, part))
        return part[order], begin[order], end[order], total[order]

    def _count_parts(self, word: bytes) -> int:
        parts = np.frombuffer(word, np.uint8)[:len(word) // PART * PART].reshape(-1, PART).astype(np.int64)
        part, begin, end, total = self._maps(parts)
        # Entry n of the scan is what n and the parts behind it come to; the last entry stands for nothing more.
        places = {pair: n for n, pair in enumerate(zip(part.tolist(), begin.tolist()))}
        last = len(part)
        behind = [places.get(pair, last) for pair in zip((part + 1).tolist(), end.tolist())]
        behind, sums = np.array([*behind, last]), np.append(total, 0)
        stop = np.append(np.where(behind[:-1] == last, np.arange(last), -1), -1)
        while (behind != last).any():
            sums = sums + sums[behind]
            stop = np.where(stop < 0, stop[behind], stop)
            behind = behind[behind]
        at = state = tokens = 0
        while at < len(parts):
            place = places.get((at, state))
            if place is not None:
                tokens += int(sums[place])
                at, state = int(part[stop[place]]) + 1, int(end[stop[place]])
                continue
            if len(self.steps) > self.most:  # the names of states in the maps no longer hold
                places, state = {}, int(self._renewed(np.array([state]))[0][0])
            state, added = self._walk(state, parts[at].astype(np.uint8).tobytes())
            at, tokens = at + 1, tokens + added
        return tokens + self._walk(state, word[len(parts) * PART:])[1]


class Encoder:
    """Token ids of pre-tokens by the public library, kept for those seen lately."""

    def __init__(self, path: str, most: int = 300_000) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads of the library only wait for each other
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self._restart()

    def _restart(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.flat, self.ends = array("I"), array("q", [0])

    def _encoded(self, words: list[bytes]) -> Iterable[list[int]]:
        return (found.ids for found in self.tokenizer.encode_batch([w.decode() for w in words], add_special_tokens=False))

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all kept pre-tokens in one array, and where those of ``words`` begin and how many they are."""
        if len(self.numbers) > self.most:
            self._restart()
        fresh = [w for w in words if w not in self.numbers]
        for at in range(0, len(fresh), AT_ONCE):
            part = fresh[at:at + AT_ONCE]
            for word, found in zip(part, self._encoded(part), strict=True):
                self.numbers[word] = len(self.numbers)
                self.flat.extend(found)
                self.ends.append(len(self.flat))
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        ends = np.array(self.ends, np.int64)
        return np.array(self.flat, np.uint32), ends[numbers], ends[numbers + 1] - ends[numbers]


def gathered(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
