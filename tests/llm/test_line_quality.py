"""Line-first quality rules: plain Python version, odd texts, and the pipeline forms under clashing column names."""

import random

import pytest
from pyspark.sql import functions as F
from test_pipeline import cut, judge

from nestgate.llm import line_quality as Q
from nestgate.llm.budget_mix import mixed_documents
from nestgate.llm.minhash_dedup import first_of_each_class
from nestgate.llm.suffix_dedup import without_repeats

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed):
    r = random.Random(seed)
    words = ["river", "Stone,", "quiet.", "the", "home", "a|b", "#", "é", "login"]
    out = [None, "", " ", "\n\n", "one", "\t\x0b tabs \r\n lines ", "x" * 4000, "home | about | login\n" * 3,
           "same line of ten words that is said over again here\n" * 4, "É" * 50 + " \x1c odd"]
    for _ in range(60):
        out.append("\n".join(" ".join(r.choice(words) + str(r.randrange(9)) * r.randrange(2) for _ in range(r.randrange(14)))
                             for _ in range(r.randrange(1, 9))))
    return out


def test_cleaned_texts_against_plain_python(spark):
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts(1))] + [(None, "a b " * 30, "en", "s", 1)] * 2
    got = Q.clean_documents(spark.createDataFrame(rows, DDL).repartition(4)).collect()
    want = [(i, judge(t), len(judge(t))) for i, t, *_ in rows if judge(t) is not None]
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in got), key=str) == sorted(want, key=str) and len(want) > 5


def test_long_text_and_empty_table(spark):
    long = " ".join(f"word{i}" for i in range(300_000))
    (r,) = Q.document_quality(spark.createDataFrame([(1, long, "", "", 0)], DDL)).collect()
    assert (r.n_words, r.kept, r.n_repeat_words) == (300_000, True, 0)
    assert Q.document_quality(spark.createDataFrame([], DDL)).count() == 0
    assert Q.clean_documents(spark.createDataFrame([], DDL)).count() == 0


OWN = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "clean_text",
       "lost_chars", "_kept_in", "KEPT_IN", "q_lines", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "decoded",
       "DECODED_", "_name", "_rows", "leaf_domain", "N_Tokens", "leaf_budget", "copies", "_time", "_p", "_p_budget", "_row",
       "node", "key", "component_id", "name", "marks", "first"]


@pytest.mark.parametrize("stage", [Q.clean_documents, first_of_each_class, without_repeats, mixed_documents])
def test_input_columns_keep_their_names_and_values(spark, stage):
    """Every result and work name of the stages as an input column: the same rows as without them."""
    base = "a sentence of more than ten plain words that stays as it is in the text "
    rows = [(i, base + " ".join(f"w{i}x{k}" for k in range(20)), "en", "src0", 1) for i in range(12)]
    plain = spark.createDataFrame(rows, DDL)
    clashing = plain.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in OWN])
    out = stage(clashing)
    assert out.columns == clashing.columns
    got = out.collect()
    assert got and all(r[c] == f"{c}{r['doc_id']}" for r in got for c in OWN)
    assert sorted(map(tuple, out.select(*plain.columns).collect())) == sorted(map(tuple, stage(plain).collect()))


def test_repeats_stage_on_odd_texts(spark):
    same = "a passage that is long enough to be cut out of both documents, because it is shared by them " * 3
    rows = [(1, "first " + same, "en", "s", 0), (2, same + " second", "en", "s", 0), (3, None, "en", "s", None), (4, "", "en", "s", 0)]
    got = {r.doc_id: r.text for r in without_repeats(spark.createDataFrame(rows, DDL)).collect()}
    assert [got[1], got[2]] == cut([rows[0][1], rows[1][1]]) and got[3] is None and got[4] == ""
