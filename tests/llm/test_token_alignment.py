import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from nestgate.llm import token_alignment as T

DDL = "doc_id long, text string, n_a long, row string, pairs string, ID long"


def tokens(text):
    """Ids and bytes of both sides, from the tokenizers run on the whole text."""
    a_path, b_path = T.default_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(x): x for x in same} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in same)}
    for t in text:
        if not t:
            yield None
            continue
        ia = a.encode(" " + t, add_special_tokens=False).ids
        ib = b.encode(t)
        wa = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ia]
        wb = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
              for p in map(b.id_to_piece, ib)]
        raw = (" " + t).encode()
        yield (ia, wa, ib, wb) if b"".join(wa) == raw == b"".join(wb) else None


def spans(words):
    at, out = 0, []
    for w in words:
        out.append((at, at + len(w)))
        at += len(w)
    return out


def brute(rows):
    made, docs = [], Counter()
    for found in tokens([t for _, t in rows]):
        if found is None:
            made.append(None)
            continue
        ia, wa, ib, wb = found
        sa, sb = spans(wa), spans(wb)
        links = [(x, y) for x, (p, q) in zip(ia, sa) for y, (r, s) in zip(ib, sb) if p < s and r < q]
        docs.update(set(links))
        ends = sorted({q for _, q in sa} & {q for _, q in sb})
        groups, lo = [], 0
        for e in ends:
            groups.append(",".join(str(x) for x, (_, q) in zip(ia, sa) if lo < q <= e) + "|"
                          + ",".join(str(x) for x, (_, q) in zip(ib, sb) if lo < q <= e))
            lo = e
        made.append((len(ia), len(ib), len(ends), links, ";".join(groups)))
    top = defaultdict(int)
    for (x, _), n in docs.items():
        top[x] = max(top[x], n)
    out = []
    for (d, _), m in zip(rows, made):
        if m is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, g, links, text = m
        out.append((d, n_a, n_b, g, len(links), sum(docs[p] == top[p[0]] for p in links),
                    sum(docs[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


ODD = [None, "", " ", "  ", "\n", " \n ", "a", " a", "a ", "a  \n", "x▁y", "<|endoftext|> a<s>b </s><unk>", "<0x41>",
       "tab\tand \t both\t x", "cr\r\nlf \r\n\r\n z;\r\n", "\xa0nb\xa0sp 　wide line", "fs\x1c gs\x1d\x1d x",
       "é ﬁ ½ \U0001f600\U0001f601 日本語", "nul\0byte", "I'm they'll 'tis don't", "word, (word) wôrd!? l'eau. Ünïcödé; ×÷ a×b end...", "x" * 3000,
       "1234567 12 3.14", "́ lone", "   lead", "trail   ", "a\n\n\n b\n", "​zero​ width"]


def corpus(seed, n):
    r = random.Random(seed)
    out = list(ODD)
    for _ in range(n):
        out.append("".join(r.choice([" ", "  ", "\n", " ", "\t", " "]) + "".join(
            r.choice("abcdeéç'.,1中") for _ in range(r.randrange(1, 9))) for _ in range(r.randrange(1, 40))))
    rows = list(enumerate(out))
    return rows + [(None, "no id at all"), (3, out[-1]), (3, out[-1])]


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(i, t, 1, "c", "c", 2) for i, t in rows], DDL.replace(", ID long", ", extra long"))
    out, counts = T.token_alignment(df.repartition(parts))
    return sorted((tuple(r) for r in out.collect()), key=str), counts


@pytest.mark.parametrize("heavy,unit", [(1 << 20, 1 << 19), (40, 60), (0, 1)])
def test_against_brute_force(spark, monkeypatch, heavy, unit):
    """All counts on the heavy route, on both, and on the shuffled route; texts whole and cut into units."""
    monkeypatch.setattr(T, "HEAVY", heavy)
    monkeypatch.setattr(T, "UNIT", unit)
    rows = corpus(unit, 60)
    found, _ = run(spark, rows)
    assert found == brute(rows)


def test_units_and_cache_inside_one_process(monkeypatch):
    """Worker code with small limits: the same rows when texts are cut and chunks forgotten."""
    known = T.Encoders(*T.default_paths())
    text = " ".join(str(i * 7919) for i in range(4000)) + "\n\n end"
    monkeypatch.setattr(T, "UNIT", 500)
    monkeypatch.setattr(T, "CACHED", 100)
    pieces = list(T._parts(text))
    assert "".join(pieces) == " " + text and len(pieces) > 10
    ids = []
    for p in pieces:
        places = known.places(T.CHUNK.findall(p))
        ids += [known.lists(s).take(places).flatten().to_pylist() for s in (0, 1)]
    (ia, _, ib, _), = tokens([text])
    assert sum(ids[::2], []) == ia and sum(ids[1::2], []) == ib


def test_counts_table(spark):
    _, counts = run(spark, [(1, "the cat"), (2, "the dog"), (3, "the cat")])
    rows = counts.collect()
    assert max(r.docs for r in rows) == 3 and all(r.best or any(
        s.a_id == r.a_id and s.docs > r.docs for s in rows) for r in rows)


def test_empty_table_and_long_text(spark):
    assert run(spark, [])[0] == []
    long = "lorem ipsum dolor\n" * 60_000
    (row,), _ = run(spark, [(9, long)], 1)
    (two,), _ = run(spark, [(9, "lorem ipsum dolor\n" * 2)], 1)
    (three,), _ = run(spark, [(9, "lorem ipsum dolor\n" * 3)], 1)
    assert all(row[c] == two[c] + (three[c] - two[c]) * 59_998 for c in (1, 2, 3, 4))     # every inner line is alike
