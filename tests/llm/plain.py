"""The pipeline's stages in plain Python, row by row, for small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def words_of(text):
    return WORDS.findall((text or "").encode())


def word_slots(word, slots):
    """The slot of the word without case and marks around it, and the one of its shape."""
    shape = bytearray()
    for byte in word:
        if 65 <= byte <= 90:
            byte = ord("A")
        elif 97 <= byte <= 122 or byte >= 128:
            byte = ord("a")
        elif 48 <= byte <= 57:
            byte = ord("0")
        if not shape or shape[-1] != byte:
            shape.append(byte)
    half = slots // 2
    return (xxhash.xxh64_intdigest(word.lower().strip(MARKS)) % half, half + xxhash.xxh64_intdigest(bytes(shape)) % half)


def word_vectors(texts, slots, width, nonzero):
    """Unit sums of the index vectors of all neighbours of a slot."""
    sums = defaultdict(lambda: [0.0] * width)
    for text in texts:
        numbered = [word_slots(w, slots) for w in words_of(text)]
        for left, right in zip(numbered, numbered[1:]):
            for own, other in [(a, b) for a in left for b in right] + [(b, a) for a in left for b in right]:
                for n in range(nonzero):
                    drawn = xxhash.xxh64_intdigest(f"{other}-{n}")
                    sums[own][drawn % width] += 1.0 if drawn >> 63 else -1.0
    found = {}
    for slot, vector in sums.items():
        size = math.sqrt(sum(v * v for v in vector))
        found[slot] = [v / size for v in vector] if size else vector
    return found


def features(text, vectors, slots, width):
    """Mean vector of the words beside that of the shapes."""
    words, zero = words_of(text), [0.0] * width
    total = [0.0] * (2 * width)
    for word in words:
        of_word, of_shape = (vectors.get(s, zero) for s in word_slots(word, slots))
        total = [t + v for t, v in zip(total, [*of_word, *of_shape])]
    return [t / max(len(words), 1) for t in total]


def network_score(net, values):
    w, b, v, c = (p.tolist() for p in net.layers)
    x = [(value - m) / s for value, m, s in zip(values, net.mean.tolist(), net.scale.tolist())]
    hidden = [math.tanh(sum(x[i] * w[i][j] for i in range(len(x))) + b[j]) for j in range(len(b))]
    logit = sum(h * row[0] for h, row in zip(hidden, v)) + c[0]
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, logit / net.temperature))))


def teaches(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 != 0


def id_order(doc_id):
    return -math.inf if doc_id is None else doc_id


def last_of_each_text(rows):
    """Ids that stay among equal texts: the largest; (text, id) pairs."""
    stay = {}
    for doc_id, text in rows:
        text = text or ""
        if text not in stay or id_order(doc_id) > id_order(stay[text]):
            stay[text] = doc_id
    return sorted(stay.items(), key=str)


def shingles(text, size=5):
    words = words_of(text)
    return Counter(tuple(words[n:n + size]) for n in range(max(len(words) - size + 1, min(len(words), 1))))


def first_of_each_class(rows, similar=0.8):
    """Ids that stay when of texts linked by overlap of their shingles only the smallest id does."""
    bags = [shingles(text) for _, text in rows]
    sizes = [b.total() for b in bags]
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(range(len(rows)), 2):
        if min(sizes[a], sizes[b]) and min(sizes[a], sizes[b]) >= similar * max(sizes[a], sizes[b]):
            shared = (bags[a] & bags[b]).total()
            if shared >= similar * (sizes[a] + sizes[b] - shared):
                root[find(a)] = find(b)
    classes = defaultdict(list)
    for n, (doc_id, _) in enumerate(rows):
        classes[find(n)].append(doc_id)
    return sorted((min(c, key=lambda i: math.inf if i is None else i) for c in classes.values()), key=str)


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Words each source should give; sources at their limit hand the rest to the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    fixed, left = {}, share * sum(sizes.values())
    while True:
        others = [s for s in names if s not in fixed]
        level = left / sum(weight[s] for s in others) if others else 0
        full = [s for s in others if level * weight[s] > most * sizes[s]]
        if not full:
            return fixed | {s: level * weight[s] for s in others}
        for s in full:
            fixed[s] = most * sizes[s]
            left -= fixed[s]


def pieces(ids, size=2048):
    """(piece, start, length) of a document of so many ids: only the first piece may be shorter."""
    number = -(-ids // size)
    first = ids - (number - 1) * size
    starts = [0, *range(first, ids, size)]
    return [(n, s, e - s) for n, (s, e) in enumerate(zip(starts, [*starts[1:], ids]))]
