import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import DOCS, ascii_lower, documents, prose, spaced_words
from wardline.llm.contexts import Slots, chunks, codes_of, lgamma, lowered, merged, score_texts, words_of


def training(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


class Brute:
    """The same tree, written node by node: contexts are byte strings, the bits so far a string."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.longer = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for text in texts:
            data = b"\xff" * depth + text + b"\xff"
            for at in range(depth, len(data)):
                bits = f"{data[at]:08b}"
                for d in range(depth + 1):
                    context = data[at - d : at]
                    for n in range(8):
                        self.counts[context, bits[:n]][int(bits[n])] += 1
                        if d:
                            self.longer[context[1:], bits[:n]].add(context)
        self.kt, self.weights = {}, {}

    def log_kt(self, node):
        if node not in self.kt:
            a, b = self.counts[node] if node in self.counts else (0, 0)
            self.kt[node] = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) if a + b else 0.0
        return self.kt[node]

    def below(self, node):
        return sum(self.weight((c, node[1])) for c in self.longer.get(node, ()))

    def weight(self, node):
        if node not in self.weights:
            kt = self.log_kt(node)
            self.weights[node] = kt if len(node[0]) == self.depth else float(np.logaddexp(kt, self.below(node)) - math.log(2))
        return self.weights[node]

    def chance(self, context, bits, bit, d=0):
        node = (context[len(context) - d :], bits)
        a, b = self.counts[node] if node in self.counts else (0, 0)
        own = ((b, a)[bit == 0] + 0.5) / (a + b + 1)
        if d == self.depth:
            return own
        deeper = (context[len(context) - d - 1 :], bits)
        if deeper not in self.counts:
            return own
        share = 1 / (1 + math.exp(-max(min(self.log_kt(node) - self.below(node), 700), -700)))
        return share * own + (1 - share) * self.chance(context, bits, bit, d + 1)

    def log10(self, text):
        data = b"\xff" * self.depth + text + b"\xff"
        found = 0.0
        for at in range(self.depth, len(data)):
            bits = f"{data[at]:08b}"
            found += sum(math.log10(self.chance(data[at - self.depth : at], bits[:n], int(bits[n]))) for n in range(8))
        return found


def expected(data, depth):
    lowered = [(i, ascii_lower(t or "")) for i, t, *_ in data]
    taught = [t for i, t in lowered if training(i)]
    counts = Counter(w for t in taught for w in [*spaced_words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    tree = Brute([t.encode() for t in taught], depth)
    scores = {t: tree.log10(t.encode()) for t in {t for _, t in lowered}}
    out = []
    for i, t in lowered:
        tokens = [*spaced_words(t), None]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        out.append((i, held, len(tokens), sum(counts[w] > 0 for w in tokens), total, base, scores[t]))
    return sorted(out, key=lambda r: (str(r[0]), r[2], r[6]))


SMALL = [(i, t if t is None or len(t) < 3000 else t[:2500], s) for i, t, s in DOCS]
CASES = {
    "broken": SMALL,
    "prose": [(i, prose(30, i % 11), "a") for i in range(60)],
    "no training": [(i, "a b", "a") for i in range(40) if not training(i)] + [(None, "a c", "a")],
    "long word": [(1, "x" * 100 + " " + "y" * 64, "a"), (2, "x" * 100, "a"), (3, "x" * 99, "a"), (4, "A\tB\x0bc\x85d e", "a")],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("depth,block", [(2, 1 << 20), (4, 600)])
def test_scores(spark, name, depth, block):
    got = score_texts(documents(spark, CASES[name]).repartition(3), depth, block).collect()
    wanted = expected(CASES[name], depth)
    assert len(got) == len(wanted)
    for a, b in zip(sorted(map(tuple, got), key=lambda r: (str(r[0]), r[2], r[6])), wanted):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] == pytest.approx(b[6], rel=1e-7, abs=1e-7)


def test_probabilities_of_a_next_byte_sum_to_one():
    tree = Brute([b"abcabd", b"abe"], 3)
    total = 0.0
    for byte in range(256):
        bits = f"{byte:08b}"
        total += math.prod(tree.chance(b"cab", bits[:n], int(bits[n])) for n in range(8))
    assert total == pytest.approx(1.0)


def test_texts_of_the_corpus_are_likelier_than_their_words_in_disorder(spark):
    draw = random.Random(5)
    data = [(i, prose(60, i % 40), "a") for i in range(400)]
    held = [i for i, *_ in data if not training(i)]
    noise = [(10_000 + i, "".join(draw.sample(prose(60, i), 300)), "a") for i in range(20)]
    got = {r["doc_id"]: r for r in score_texts(documents(spark, data + noise)).collect()}
    per_byte = [got[i]["score"] / len(prose(60, i % 40)) for i in held]
    assert min(per_byte) > max(got[i]["score"] / 300 for i, *_ in noise if not training(i))


def strings(text, depth):
    data = b"\xff" * depth + text + b"\xff"
    return [int.from_bytes(bytes([*data[at - depth : at][::-1], data[at]]), "big") for at in range(depth, len(data))]


@pytest.mark.parametrize("depth", [2, 5, 6])
def test_strings_of_texts(depth):
    texts = ["", "é", "plain text", "", "日本" * 40, "x"]
    codes, starts = codes_of(pa.array(texts, pa.large_string()), depth)
    assert codes.tolist() == [c for t in texts for c in strings(t.encode(), depth)]
    assert starts.tolist() == [0, *np.cumsum([len(t.encode()) + 1 for t in texts])[:-1].tolist()]
    assert codes_of(pa.array(texts, pa.large_string()).slice(2, 3), depth)[0].tolist() == [c for t in texts[2:5] for c in strings(t.encode(), depth)]


def test_words_and_letters():
    texts = ["a\tb\x0b\x0c\r\nc É x\x85y  \x1cz ", "", " \n", None, "Z" * 65 + " " + "Q" * 64]
    low = lowered(pa.array(texts))
    words, owner = words_of(low)
    for n, text in enumerate(texts):
        found = [w for w, o in zip(words.to_pylist(), owner) if o == n]
        plain = re.findall(rb"[^\x20\x09-\x0D]+", ascii_lower(text or "").encode())
        assert found[-1] == b" " and [w if len(w) <= 64 else None for w in found[:-1]] == [w if len(w) <= 64 else None for w in plain]
    assert len(words[len(words) - len(texts) - 2].as_py()) == 65


def test_rows_are_taken_together():
    texts = pa.array(["a" * 4, "b" * 4, None, "c" * 30, "", "d", "e" * 9], pa.string())
    parts = [c.to_pylist() for c in chunks(texts, 10)]
    assert [t for p in parts for t in p] == texts.to_pylist() and all(len(p) == 1 or sum(len(t or "") for t in p[:-1]) <= 10 for p in parts)


def test_tables_of_numbers():
    draw = np.random.default_rng(2)
    codes = np.unique(draw.integers(0, 1 << 48, 5000))
    values = draw.normal(size=len(codes))
    slots = Slots(np.concatenate([codes, codes[:50]]), np.concatenate([values, values[:50]]))
    asked = draw.integers(0, len(codes), 20_000)
    assert (slots[codes[asked]] == values[asked]).all()
    both, n = merged([codes[:100], codes[50:200], codes[:0]], [np.ones(100, int), np.full(150, 2), np.ones(0, int)])
    assert both.tolist() == codes[:200].tolist() and n.tolist() == [1] * 50 + [3] * 50 + [2] * 100


def test_gamma():
    x = np.array([0.5, 1.0, 1.5, 2.0, 3.7, 50.0, 1e6, 1e12])
    assert lgamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-11)


def test_empty_table(spark):
    assert score_texts(documents(spark, [])).collect() == []
