import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from nestgate.llm import suffix_dedup as S
from nestgate.llm.induced_sort import permuted_prefixes, shard_string, suffix_array

DDL = "doc_id long, text string, marks string, first int"


def brute(texts, width):
    enc = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + width] for b in enc for i in range(len(b) - width + 1))
    out = []
    for b in enc:
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = [True] * width
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)

    def noise(n):
        return "".join(r.choice("abcdefghijklmnop é\n") for _ in range(n))
    shared = [noise(r.choice([150, 199, 200, 201, 350, 900])) for _ in range(8)]
    out = [None, "", "short", "a" * 1000, "ab" * 300, noise(199), "\0" * 450]
    for _ in range(40):
        out.append("".join(noise(r.randrange(0, 300)) + r.choice(shared) for _ in range(r.randrange(0, 3))) + noise(50))
    base = noise(2500)
    for _ in range(12):                                    # near copies
        b = list(base)
        for _ in range(r.randrange(1, 6)):
            b[r.randrange(len(b))] = "#"
        out.append("".join(b))
    out += [base, base, noise(700) * 2]
    return out


def run(spark, texts):
    rows = [(i, t, "c", 1) for i, t in enumerate(texts)]
    got = S.document_repeats(spark.createDataFrame(rows, DDL).repartition(4)).collect()
    return [tuple(r)[1:] for r in sorted(got)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    texts = corpus(seed)
    assert run(spark, texts) == brute(texts, 200)


def test_hot_anchors_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_SEGMENTS", 3)
    monkeypatch.setattr(S, "SHARD_BYTES", 2000)
    texts = corpus(3)
    assert run(spark, texts) == brute(texts, 200)


def test_text_beyond_the_place_bits(spark):
    """A string repeated beyond 16 MiB of one text is found like any other."""
    def noise(seed, n):
        return np.random.default_rng(seed).integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    shared, long = noise(1, 300), (1 << 24) + 400_000
    head, tail = noise(2, long), noise(3, 5000)
    got = run(spark, [head + shared + tail, "A" + shared + "B"])
    kept = [head + tail, "AB"]
    assert [(n, gone, spans) for n, gone, spans, _ in got] == [(long + 5300, 300, 1), (302, 300, 1)]
    assert [x[3] for x in got] == [hashlib.sha256(k.encode()).hexdigest() for k in kept]


def test_pieces_of_long_texts(monkeypatch):
    """Windows have the same anchors however a text is cut, and each lies in one piece."""
    texts = [t.encode() for t in corpus(4) if t]

    def anchors(blocks):
        out = {}
        for number, offset, pieces in blocks:
            h, _, piece, first, count = S._segments(pieces)
            for x, i, a, n in zip(h.tolist(), number[piece].tolist(), (first + offset[piece]).tolist(), count.tolist()):
                for w in range(a, a + n):
                    assert (i, w) not in out
                    out[i, w] = x
        return out
    whole = anchors(S._blocks(texts))
    assert len(whole) == sum(max(0, len(t) - 199) for t in texts)
    monkeypatch.setattr(S, "BLOCK_BYTES", 300)
    monkeypatch.setattr(S, "PLACE_BITS", 10)
    assert anchors(S._blocks(texts)) == whole


def test_empty_table_and_pipeline_form(spark):
    assert S.document_repeats(spark.createDataFrame([], DDL)).count() == 0
    p = "".join(chr(97 + (i * i) % 26) for i in range(230))
    df = spark.createDataFrame([(1, "A" + p, 5), (2, p + "é" + p, 5), (3, None, 5)], "doc_id long, text string, n_chars long")
    assert sorted(map(tuple, S.without_repeats(df).collect())) == [(1, "A", 1), (2, "é", 1), (3, None, None)]


@pytest.mark.parametrize("seed", range(3))
def test_suffix_arrays(seed):
    r = random.Random(seed)
    for _ in range(60):
        parts = [bytes(r.choice(b"ab\0c") for _ in range(r.randrange(0, 30))) for _ in range(r.randrange(1, 6))]
        t, _ = shard_string(parts)
        text = t.tolist()
        order = sorted(range(len(text)), key=lambda i: text[i:])
        sa = suffix_array(t, 258)
        assert sa.tolist() == order
        p = permuted_prefixes(t, sa, 12)
        for a, b in zip(order, order[1:]):
            n = next((k for k in range(12) if text[a + k:a + k + 1] != text[b + k:b + k + 1]), 12)
            assert p[b] == n


def test_dense_buckets_and_scan_agree():
    r = np.random.default_rng(1)
    t = np.concatenate((r.integers(1, 5, 3000), [0])).astype(np.uint16)
    text = t.tolist()
    assert suffix_array(t, 5).tolist() == suffix_array(t, 3000).tolist() == sorted(range(3001), key=lambda i: text[i:])


def test_names_are_not_sorted_by_a_plain_scan(monkeypatch):
    """The string of names has small buckets; an interpreted scan of it took most of a shard's time."""
    from nestgate.llm import induced_sort as I

    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 40))) for _ in range(40)]
    text = " ".join(r.choice(words) for _ in range(1500)).encode() + b"ab" * 300
    t, _ = shard_string([text, text[5000:9000]])
    want = suffix_array(t, len(t)).tolist()                   # by a plain scan: the alphabet is taken as large
    monkeypatch.setattr(I, "_induce_scan", None)
    assert suffix_array(t, 258).tolist() == want
    suffixes = [t[i:].tolist() for i in want]
    assert all(a < b for a, b in zip(suffixes, suffixes[1:]))


@pytest.mark.parametrize("symbols", [1, 2, 5, 300])
def test_names_by_doubling(symbols):
    from nestgate.llm.induced_sort import _by_doubling

    r = random.Random(symbols)
    for n in (0, 1, 2, 3, 17, 200):
        names = [r.randrange(1, symbols + 1) for _ in range(n)] * r.randrange(1, 4) + [0]
        assert _by_doubling(np.array(names, np.int32)).tolist() == sorted(range(len(names)), key=lambda i: names[i:])
