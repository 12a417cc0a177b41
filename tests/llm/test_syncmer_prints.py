import hashlib
import random

import numpy as np
import pytest

from nestgate.llm import syncmer_prints as P

DDL = "doc_id long, text string, part int, own boolean"


def slow_anchors(raw):
    """Closed syncmers gram by gram."""
    def mix(x):
        x = ((x ^ (x >> 31)) * 0xC2B2AE3D27D4EB4F) % 2**64
        return x ^ (x >> 29)
    m = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
    out = []
    for i in range(len(raw) - P.K + 1):
        w = raw[i:i + P.K]
        inner = [mix(int.from_bytes(w[j:j + P.S], "little") * m[0] % 2**64) for j in range(P.K - P.S + 1)]
        if inner.index(min(inner)) in (0, P.K - P.S):
            out.append((mix(sum(inner[P.S * q] * m[q] for q in range(3)) % 2**64), i))
    return out


@pytest.mark.parametrize("text", ["abc" * 40, "a" * 90, "The quick brown fox jumps over the lazy dog, é twice. " * 3,
                                  "x" * 24, "exactly twenty four byte"])
def test_anchors(text):
    h, at = P.anchors(text.encode())
    assert list(zip(h.tolist(), at.tolist())) == slow_anchors(text.encode())


def test_anchors_are_context_free():
    core = "".join(random.Random(1).choice("abcdefgh ") for _ in range(400)).encode()
    inside = set(P.anchors(core)[0].tolist())
    assert inside and inside <= set(P.anchors(b"other words before " + core + b" and after")[0].tolist())


def texts(n=60):
    r = random.Random(2)
    out = [None, "", "short", "é", "same " * 100, "same " * 100]
    return out + ["".join(r.choice("abcdefg éß\n") for _ in range(r.choice([5, 50, 900]))) for _ in range(n)]


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        p, q = P.fingerprint(t), P.fingerprint(e)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), p.tobytes().hex(), q.tobytes().hex(),
                    P.likeness(p, q), P.likeness(p, P.fingerprint(nxt))))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_query_against_brute_force(spark, parts):
    rows = [(3 * i + 1, t) for i, t in enumerate(texts())] + [(4, "z"), (4, "a tie of ids"), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(i, t, 1, True) for i, t in rows], DDL).repartition(4)
    got = sorted(map(tuple, P.document_prints(df, parts=parts).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_likeness():
    r = random.Random(3)
    a, b = ("".join(r.choice("abcdefgh ") for _ in range(6000)) for _ in range(2))
    pa, pb = P.fingerprint(a), P.fingerprint(b)
    assert P.likeness(pa, pa) == 1 and P.likeness(pa, pb) == 0
    assert 0.15 < P.likeness(pa, P.fingerprint(P.edited(a, b))) < 0.6
    assert P.likeness(pa, P.fingerprint("some words first " + a)) > 0.9
    empty = np.empty(0, P.ENTRY)
    assert P.likeness(empty, empty) == 1 and P.likeness(empty, pa) == 0


def test_one_row_and_empty_table(spark):
    one = P.document_prints(spark.createDataFrame([(1, "abcd", 0, True)], DDL)).collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in one] == [(1, 4, hashlib.sha256(b"abab").hexdigest())]
    assert P.document_prints(spark.createDataFrame([], DDL)).count() == 0
