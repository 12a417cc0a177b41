import random
import re

import pytest
from pyspark.sql import functions as F

from nestgate.llm import license_scan as L

DDL = "doc_id long, text string, labels string, key string"


def words(t):
    low = (t or "").translate(str.maketrans(L.UPPER, L.LOWER))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(t):
    """The same rules by nested loops over words."""
    w = words(t)
    places, base, found, best = [], set(), set(), 0.0
    for p, label in L.PHRASES.items():
        k = p.split()
        at = [i for i in range(len(w) - len(k) + 1) if w[i:i + len(k)] == k]
        places += at
        base |= {label} if at else set()
    rows = {}
    for label, name, n, tpos, window in L.template_rows():
        rows.setdefault((label, name, n), []).append((tpos, window.split()))
    for (label, _, n), wins in rows.items():
        hits = sorted((i - tp, i, tp) for i in range(len(w) - L.K + 1) for tp, g in wins if w[i:i + L.K] == g)
        shifts = sorted({h[0] for h in hits})
        bands = [[shifts[0]]] if shifts else []
        for a, b in zip(shifts, shifts[1:]):
            if b - a > L.SLACK:
                bands.append([])
            bands[-1].append(b)
        for band in bands:
            mine = [(i, tp) for s, i, tp in hits if s in band]
            for first in {i for i, _ in mine}:                    # every span of twice the template's length
                covered = {tp for i, tp in mine if first <= i and i + L.K - first <= 2 * (n + L.K - 1)}
                if len(covered) * 100 >= n * L.MIN_COVER:
                    found.add(label)
                    best = max(best, len(covered) / n)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | found)), 1.0 if places else best)


def texts():
    r = random.Random(4)
    out = [None, "", "É ä #", "under the MIT License", "Under-the/mit\nlicense! Under the mit license",
           "under the mité license", "CC BY-NC 4.0 and Apache License, Version 2.0", "apache license version 20"]
    for ts in L.TEMPLATES.values():
        for t in ts:
            w = t.split()
            out += [t, "Zuvor é " + t.upper() + " danach " + t, " ".join(w[:len(w) // 2])]
            for _ in range(2):
                v = list(w)
                v[r.randrange(len(v))] = "changed"
                v.insert(r.randrange(len(v)), "extra words here")
                out.append(" ".join(v))
    out.append(" ".join(t for ts in L.TEMPLATES.values() for t in ts))
    mit = L.TEMPLATES["mit"][0]
    opening = " ".join(mit.split()[:7])
    out += [" ".join([opening] * 30 + [mit]), " ".join([mit] + [opening] * 30), " ".join([opening] * 60),
            " ".join([mit] * 3), " ".join(mit.split()[:40] + ["x"] * 90 + mit.split()[40:])]
    return out


def test_repeated_openings_do_not_hide_a_license(spark):
    mit = L.TEMPLATES["mit"][0]
    text = " ".join([" ".join(mit.split()[:7])] * 30 + [mit])
    (r,) = L.document_licenses(spark.createDataFrame([(1, text, "", "")], DDL)).collect()
    assert (r.labels, r.score) == ("mit", 1.0)


def test_own_templates_and_long_texts(spark, monkeypatch):
    """A whole license of thousands of words given as data, in a text of 200,000 words; also without broadcast."""
    r = random.Random(2)
    license_words = [r.choice("abcdefghij") + str(r.randrange(500)) for _ in range(3000)]
    text = " ".join(["filler"] * 100_000 + license_words[:1500] + ["new words"] + license_words[1500:] + ["more"] * 100_000)
    rows = spark.createDataFrame([(1, text, "", ""), (2, " ".join(license_words[:900]), "", "")], DDL)
    for limit in (200_000, 0):
        monkeypatch.setattr(L, "BROADCAST_WINDOWS", limit)
        got = {x.doc_id: (x.labels, x.score) for x in L.document_licenses(rows, {"own": [" ".join(license_words)]}).collect()}
        assert got[1][0] == "own" and got[1][1] > 0.99 and got[2] == ("", 0.0)


def test_against_brute_force(spark):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts())] + [(3, "under the MIT License", "x", "y"), (None, "a", "", "")]
    got = L.document_licenses(spark.createDataFrame(rows, DDL).repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r[0], *brute(r[1])) for r in rows), key=str)


def test_empty_table(spark):
    assert L.document_licenses(spark.createDataFrame([], DDL)).count() == 0


def test_short_template_is_refused():
    with pytest.raises(ValueError):
        L.template_rows({"x": ["too short"]})


def test_no_python_in_the_plan(spark):
    df = L.document_licenses(spark.createDataFrame([(1, "a", "", "")], DDL).withColumn("x", F.lit(1)))
    assert "Python" not in df._jdf.queryExecution().toString().replace("Scan ExistingRDD", "")
