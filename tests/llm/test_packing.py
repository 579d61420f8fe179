import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import DOCS, documents
from wardline.llm.packing import lay_out, pack_documents, pack_pieces, packed_sequences, plan_windows, token_pieces

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
FILE = public_tokenizers.path("byte_bpe_50k.json")


def expected_ids(text):
    tokenizer = Tokenizer.from_file(FILE)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("counts", [{}, {1: 5}, {1024: 7}, {600: 50}, {n: 3 for n in range(1, 1025)}, {700: 900, 300: 20, 24: 900}])
def test_a_plan_uses_every_piece_once(counts):
    used = Counter()
    for times, parts in plan_windows(counts):
        assert times > 0 and sum(n * k for n, k in parts) <= 1024
        used.update({n: times * k for n, k in parts})
    assert used == counts


def test_a_mixed_histogram_leaves_little_room():
    draw = np.random.default_rng(3)
    counts = Counter(draw.integers(1, 1025, 20_000).tolist())
    plan = plan_windows(counts)
    assert sum(n * k for n, k in counts.items()) / (1024 * sum(times for times, _ in plan)) > 0.99


def test_places_follow_the_plan():
    places = lay_out([(2, ((500, 2),)), (1, ((500, 1), (3, 4)))])
    sequence, offset = places.find(np.array([500] * 5 + [3] * 4), np.array([0, 1, 2, 3, 4, 0, 1, 2, 3]))
    assert sequence.tolist() == [0, 0, 1, 1, 2, 2, 2, 2, 2]
    assert offset.tolist() == [0, 500, 0, 500, 0, 500, 503, 506, 509]


def test_pieces_and_sequences(spark):
    got = pack_documents(documents(spark), RANKS).collect()
    wanted = Counter((d, tuple(expected_ids(t))) for d, t, _ in DOCS)
    # Every document's pieces, whatever copies it has, add up to its ids.
    pieces = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got)
    expected = Counter()
    for (doc_id, ids), n in wanted.items():
        for at in range(0, len(ids), 1024):
            part = np.array(ids[at : at + 1024], "<u4").tobytes()
            expected[(doc_id, at, len(part) // 4, zlib.crc32(part), len(ids))] += n
    assert pieces == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_sequences_hold_the_ids(spark):
    docs = documents(spark)
    placed = pack_pieces(token_pieces(docs, RANKS, 64), 64)
    sequences = {r["sequence_id"]: r for r in packed_sequences(placed, 64).collect()}
    for r in placed.collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert sequences[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]] == ids
    for r in sequences.values():
        assert len(r["ids"]) == (r["filled"] if r["filled"] & (r["filled"] - 1) == 0 else 64)


def test_ranks_and_file_give_the_same_ids(spark):
    docs = documents(spark, [(1, "a  b\n\n\tc <|endoftext|> it's 1234567 日本語 " + "x" * 3000, "s"), (2, DOCS[3][1], "s")])
    a, b = (sorted(map(tuple, token_pieces(docs, path).collect())) for path in (RANKS, FILE))
    assert a == b


HOT = [{600: 50}, {520: 1000, 900: 3}, {700: 900, 1024: 5}, {1000: 10**9, 3: 7, 400: 10**6}, {n: 1 + n % 5 for n in range(500, 1024)}]


@pytest.mark.parametrize("counts", HOT)
def test_cut_rests_fill_every_window_but_the_last(counts):
    plan, left = plan_windows(counts, cut=True), Counter(counts)
    for times, parts in plan:
        filled = 0
        for n, k, *size in parts:
            left[n] -= times * k
            filled += size[0] if size else n * k
            assert left[n] >= 0
            if size:
                left[n - size[0]] += times
        assert filled <= 1024
    assert not any(left.values()) and len(plan) < 5000
    least = -(-sum(n * k for n, k in counts.items()) // 1024)
    assert sum(times for times, _ in plan) <= least * 1.01 + 1


def test_parts_of_cut_pieces_fill_the_sequences():
    counts = {600: 50, 700: 31, 1000: 3}
    places = lay_out(plan_windows(counts, cut=True))
    length = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(k) for k in counts.values()])
    row, begin, size, sequence, offset = places.parts(length, rank)
    for at in range(len(length)):
        own = sorted(zip(begin[row == at].tolist(), size[row == at].tolist()))
        assert [b for b, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist() and sum(n for _, n in own) == length[at]
    taken = [sorted(zip(offset[sequence == n].tolist(), size[sequence == n].tolist())) for n in range(sequence.max() + 1)]
    for own in taken:
        assert [b for b, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()
    assert [sum(n for _, n in own) for own in taken[:-1]] == [1024] * (len(taken) - 1)


def test_a_hot_length_is_cut_to_fill(spark):
    """Copies of one text of 600 tokens would fill 59 % whole."""
    text = " one" * 599
    docs = documents(spark, [(n, text, "s") for n in range(60)] + [(90, " two" * 700, "s"), (91, None, "s")])
    texts = {n: text for n in range(60)} | {90: " two" * 700, 91: ""}
    placed = pack_pieces(token_pieces(docs, RANKS), 1024)
    sequences = {r["sequence_id"]: r for r in packed_sequences(placed).collect()}
    ids = {n: [] for n in texts}
    for r in sorted(placed.collect(), key=lambda r: (r["doc_id"], r["start"])):
        own = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(own) == r["length"] and r["start"] == len(ids[r["doc_id"]])
        assert sequences[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]] == own
        ids[r["doc_id"]] += own
    assert ids == {n: expected_ids(t) for n, t in texts.items()}
    assert len(sequences) == -(-sum(map(len, ids.values())) // 1024)
    for r in pack_documents(docs, RANKS).collect():
        own = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert (r["length"], r["ids_crc32"], r["doc_tokens"]) == (len(own) // 4, zlib.crc32(own), len(ids[r["doc_id"]]))


ADDED = [
    "end <|endoftext|> start",
    "<|endoftext|>",
    "a<|endoftext|><|endoftext|> b",
    "  <|endoftext|>  \n it's <|endoftext|",
    "<|endoftext|>" * 600 + "x <|endoftext|>y日本語 <|ENDOFTEXT|>",
]


@pytest.mark.parametrize("path", [RANKS, FILE])
def test_added_tokens_have_the_ids_of_a_plain_encode(spark, path):
    rows = token_pieces(documents(spark, [(n, text, "s") for n, text in enumerate(ADDED)]), path).collect()
    for n, text in enumerate(ADDED):
        pieces = sorted((r["start"], r["ids"]) for r in rows if r["doc_id"] == n)
        assert np.frombuffer(b"".join(ids for _, ids in pieces), "<u4").tolist() == expected_ids(text)
    assert expected_ids(ADDED[0]) == [437, 220, 50256, 923, 0]


def test_empty_table(spark):
    df = pack_documents(documents(spark, []), RANKS)
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert df.collect() == []
