import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from nestgate.llm import best_fit_pack as P

DDL = "doc_id long, text string, id string, n long, length string"


def check(out, docs, capacity):
    """Every piece against the tokenizer run on whole texts; sequences gapless and within capacity."""
    t = Tokenizer.from_file(P.default_tokenizer())
    want = Counter()
    for d, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for p, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[(d, p, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    seqs = defaultdict(list)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(seqs)


def texts(seed, n):
    r = random.Random(seed)
    out = [None, "", "  ", "x" * 700, "<|endoftext|> a<|startoftext|>b", "I'm they'll don't 1234 ABCÉ é 　 z  q",
           "\U0001f600 ΣΣ tab\tnl\ństart", "a" * 30 + "\x0b" + "b\x85c\x1cd"]
    for _ in range(n):
        out.append(" ".join("".join(r.choice("abcdefgé1'") for _ in range(r.randrange(1, 9))) for _ in range(r.randrange(1, 60))))
    return out


@pytest.mark.parametrize("capacity", [16, 128])
def test_round_trip(spark, capacity):
    rows = list(enumerate(texts(3, 120))) + [(5, "again and again")] * 20 + [(None, "no id")]
    df = spark.createDataFrame([(i, t, "c", 1, "c") for i, t in rows], DDL).repartition(5)
    out = P.pack(df, capacity=capacity).collect()
    n = check(out, rows, capacity)
    total = sum(r.length for r in out)
    assert n <= -(-total // capacity) + 2


def test_ids_are_returned_on_request(spark):
    df = spark.createDataFrame([(1, "hello world", "c", 1, "c")], DDL)
    r = P.pack(df, with_ids=True).collect()[0]
    assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and r.length == 3


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], DDL)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece(seed):
    r = np.random.default_rng(seed)
    lengths = np.minimum(r.geometric(1 / 300, 5000), 2048) if seed % 2 else r.integers(1, 2049, 5000)
    hist = Counter(map(int, lengths))
    got, n = Counter(), 0
    for used, times in P.plan(hist):
        assert sum(used) <= 2048
        n += times
        for x in used:
            got[x] += times
    assert got == hist
    assert n <= max(-(-int(lengths.sum()) // 2048) + 2, int((lengths > 1024).sum()) + 40)


def test_exact_complements():
    assert sorted(P.plan({5: 2, 3: 2, 2: 2, 10: 1}, 10)) == [((3, 3, 2, 2), 1), ((5, 5), 1), ((10,), 1)]
    assert P.plan({5: 4, 3: 4, 2: 4}, 10) == [((5, 5), 2), ((3, 3, 2, 2), 2)]
    assert P.plan({7: 1, 2: 1, 1: 1, 3: 0}, 10) == [((7, 2, 1), 1)]
    assert P.plan({6: 1, 2: 2}, 10) == [((6, 2, 2), 1)]


def test_ids_equal_the_tokenizer_on_whole_texts(monkeypatch):
    """Every white-space character and awkward neighbours, with a cache that overflows all the time."""
    monkeypatch.setattr(P, "CACHED", 7)
    t = Tokenizer.from_file(P.default_tokenizer())
    r = random.Random(5)
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    parts = ["word", "Word,", "ÉCOLE.", "it's", "'s", "x_y", "a1b2", "<|endoftext|>", "end<|startoftext|>", "ß", "ſ", "İ",
             "ΑΣ", "e\u0301", "ﬁ", "...", "don't!!", "a'", "ÿ;", "½", "\u200b", "A" * 90, "\xad", "µm", "ªº", "__a__"]
    ids = P.ChunkIds(P.default_tokenizer())
    assert ids.simple
    for _ in range(1500):
        text = "".join(r.choice(parts) + r.choice(spaces + ["", "", " "]) for _ in range(r.randrange(0, 7)))
        assert list(np.frombuffer(ids.of_text(text), "<u4")) == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_split_together(monkeypatch):
    """Many texts at a time, every usual character beside letters, numbers and signs, in blocks of any size."""
    import re

    import pyarrow as pa

    t = Tokenizer.from_file(P.default_tokenizer())
    r = random.Random(6)
    chars = [c for c in map(chr, [*range(0x180), *range(0x2000, 0x2070)]) if not re.search(P.UNUSUAL, c)]
    rows = [a + c + b for c in chars for a, b in (("", ""), ("a", "B"), ("A1", "'s"), ("'", "s"), ("!", "'"), ("é", c))]
    rows += ["".join(r.choice(chars + list("'stremvld ab") * 9) for _ in range(r.randrange(30))) for _ in range(3000)]
    rows += [None, "", " ", "x" * 700, "a<|endoftext|>b", "<|STARTOFTEXT|>", "e\u0301 İ \x1c ΑΣ", "\u3000 \u2028x"]
    want = [P.pack_ids(t.encode(x or "", add_special_tokens=False).ids) for x in rows]
    ids = P.ChunkIds(P.default_tokenizer())
    assert ids.of_texts(pa.array(rows, pa.string())) == want
    monkeypatch.setattr(P, "WORDS", 50)
    monkeypatch.setattr(P, "BLOCK_BYTES", 500)
    batch = pa.record_batch([pa.array(range(len(rows))), pa.array(rows, pa.string())], names=["id", "text"])
    blocks = list(P._blocks([batch, batch.slice(0, 0), batch.slice(5, 1)]))
    assert max(b.num_rows for b in blocks) < 500
    assert [x for b in blocks for x in ids.of_texts(b.column(1))] == want + want[5:6]


def test_other_tokenizers_encode_whole_texts(tmp_path):
    """Without lowering, with another replacement, or keeping white space: the ids of the tokenizer itself."""
    import json

    import public_tokenizers

    own = json.loads(open(P.default_tokenizer()).read())
    steps = own["normalizer"]["normalizers"]
    files = {"cased": [x for x in steps if x["type"] != "Lowercase"],
             "marked": [{"type": "Replace", "pattern": {"String": "w"}, "content": "v"}, *steps]}
    paths = [public_tokenizers.path("byte_bpe_50k.json")]
    for name, chosen in files.items():
        own["normalizer"]["normalizers"] = chosen
        (tmp_path / name).write_text(json.dumps(own))
        paths.append(str(tmp_path / name))
    for path in paths:
        ids, t = P.ChunkIds(path), Tokenizer.from_file(path)
        for text in ["Two Words, twice", "  Two\nWords ", "", "ÉCOLE"]:
            assert list(np.frombuffer(ids.of_text(text), "<u4")) == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(3))
def test_as_few_sequences_as_a_best_fit_packer(seed):
    """Against best fit decreasing, piece by piece: never more sequences than that plus one in a hundred."""
    r = random.Random(seed)
    lengths = sorted((min(2048, int(r.expovariate(1 / r.choice([60, 400, 1200]))) + 1) for _ in range(1500)), reverse=True)
    gaps: list[int] = []
    for x in lengths:
        fits = [g for g in range(len(gaps)) if gaps[g] >= x]
        if fits:
            gaps[min(fits, key=gaps.__getitem__)] -= x
        else:
            gaps.append(2048 - x)
    assert sum(times for _, times in P.plan(Counter(lengths))) <= len(gaps) * 1.01 + 1
