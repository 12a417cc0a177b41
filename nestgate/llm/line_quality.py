r"""Line-first quality rules in DataFrame expressions only.

Every ``\n``-line is judged on its own: punctuation noise, navigation and
boilerplate rules.  Failing lines are removed, and a document that loses more
than ``max_lost_percent`` of the characters of its lines is rejected.  The base
rules (too few words, too many words in repeated 5-word windows) are applied to
the whole text.  No shuffle, no Python: every value is an expression over the
row's own word and line arrays.

Defined results: a null text has no words and fails the base rules; lines
without a word are neither judged nor counted; an empty table gives no rows;
equal rows get equal results; other columns pass through unless a new column
has their name (then the new one replaces them; the pipeline form keeps every
input column); long texts are judged whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import behind_names

# word separators, in Java and RE2 syntax alike
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# The line rules.
NOISE = r"[#*$%&<>!?=~^_]{2,}"                 # runs of symbols: at least 3 for every 10 words
SEPARATORS = r"[|»›•·]"                        # menu separators: at least 3 for every 10 words
MENU = (r"^\W*(home|about( us)?|contact( us)?|menu|search|log ?in|sign (in|up)|register|next|previous|back|"
        r"top|share|skip to (main )?content|site ?map)(\W+(home|about( us)?|contact( us)?|menu|search|log ?in|"
        r"sign (in|up)|register|next|previous|back|top|share|site ?map))*\W*$")
MENU_WORDS = 12
BOILERPLATE = ["all rights reserved", "privacy policy", "cookie policy", "uses cookies", "terms of use",
               "terms of service", "subscribe to our", "click here", "enable javascript", "lorem ipsum"]
BOILERPLATE_WORDS = 25                         # longer lines are prose that mentions the phrase
MAX_LOST_PERCENT = 40


def line_words(line: Column) -> Column:
    """Words of a line; the regular expression only where a separator other than a blank occurs."""
    return F.array_remove(F.when(line.rlike(r"[\x09-\x0D]"), F.split(line, GAP)).otherwise(F.split(line, " ")), "")


def failed_rule(line: Column, low: Column, n: Column, marked: Column) -> Column:
    """Name of the first rule a line of ``n`` words fails; null when it passes or has no word.

    ``low``: the line in lower case.  ``marked``: whether the text has any noise or separator at all.
    """
    phrase = low.contains(BOILERPLATE[0])
    for p in BOILERPLATE[1:]:
        phrase = phrase | low.contains(p)
    return (F.when(n == 0, F.lit(None).cast("string"))
            .when(marked & (F.regexp_count(line, F.lit(NOISE)) * 10 >= n * 3), F.lit("punctuation"))
            .when((marked & (F.regexp_count(line, F.lit(SEPARATORS)) * 10 >= n * 3))
                  | ((n <= MENU_WORDS) & low.rlike(MENU)), F.lit("navigation"))
            .when((n <= BOILERPLATE_WORDS) & phrase, F.lit("boilerplate")))


def repeat_places(ranked: Column) -> Column:
    """Places of windows whose hash occurs twice or more, in order.

    ``ranked``: a stored column of (hash, place) structs in order; null where no hash repeats.
    """
    twice = F.filter(
        F.transform(ranked, lambda x, i: F.struct(
            x["i"].alias("i"),
            ((i > 0) & (F.get(ranked, i - 1)["h"] == x["h"])
             | F.coalesce(F.get(ranked, i + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
        lambda x: x["twice"])
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def covered_words(places: Column) -> Column:
    """Words in the union of [p, p + 5) over the places."""
    steps = F.zip_with(places, F.slice(places, F.lit(2), F.greatest(F.size(places), F.lit(1))),
                       lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(x, F.lit(0)))


def quality_rules(df: DataFrame, text: str = "text", max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """``df`` with the base counts, the line verdicts, ``clean_text``, ``base_failed`` and ``kept``."""
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines",
           "n_punctuation", "n_navigation", "n_boilerplate", "line_chars", "lost_chars", "clean_text"]
    df = df.drop(*[c for c in new if c != text])
    q = "q"
    while q.lower() in {c.lower() for c in df.columns}:
        q = "_" + q
    t = F.coalesce(F.col(text), F.lit(""))

    def col(name: str) -> Column:
        return F.col(f"{q}_{name}")

    out = df.withColumns({
        f"{q}_marked": t.rlike(f"{NOISE}|{SEPARATORS}"),
        f"{q}_lines": F.transform(F.split(t, "\n"), lambda x: F.struct(x.alias("line"), line_words(x).alias("w")))})
    out = out.withColumn(f"{q}_words", F.flatten(F.transform(col("lines"), lambda x: x["w"])))
    # the window hashes; one list for each document
    out = out.withColumns({
        f"{q}_n": F.size(col("words")).cast("long"),
        f"{q}_grams": F.when(F.size(col("words")) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(col("words")) - WINDOW),
            lambda i: F.xxhash64(*[F.get(col("words"), i + k) for k in range(WINDOW)]))),
        f"{q}_judged": F.transform(
            F.transform(col("lines"), lambda x: F.struct(
                x["line"].alias("line"), F.size(x["w"]).alias("n"),
                F.when(F.size(x["w"]) <= BOILERPLATE_WORDS, F.lower(x["line"])).otherwise("").alias("low"))),
            lambda x: F.struct(x["line"].alias("line"), (x["n"] == 0).alias("blank"),
                               failed_rule(x["line"], x["low"], x["n"], col("marked")).alias("rule"))),
    })

    def n_rule(name: str) -> Column:
        return F.size(F.filter(col("judged"), lambda x: x["rule"] == name)).cast("long")

    def chars(keep) -> Column:
        return F.aggregate(F.filter(col("judged"), keep), F.lit(0).cast("long"),
                           lambda acc, x: acc + F.char_length(x["line"]))

    # sorted (hash, place) pairs, only where some window repeats
    out = out.withColumn(f"{q}_ranked", F.when(
        F.size(F.array_distinct(col("grams"))) < F.size(col("grams")),
        F.sort_array(F.transform(col("grams"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    worded = F.transform(F.filter(col("judged"), lambda x: ~x["blank"]), lambda x: x["line"])
    out = out.withColumns({
        f"{q}_chars": F.aggregate(col("words"), F.lit(0).cast("long"), lambda acc, w: acc + F.char_length(w)),
        f"{q}_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        f"{q}_dup": (F.size(worded) - F.size(F.array_distinct(worded))).cast("long"),
        f"{q}_places": repeat_places(col("ranked")),
        f"{q}_nlines": F.size(worded).cast("long"),
        f"{q}_total": chars(lambda x: ~x["blank"]),
        f"{q}_lost": chars(lambda x: x["rule"].isNotNull()),
        f"{q}_p": n_rule("punctuation"), f"{q}_v": n_rule("navigation"), f"{q}_b": n_rule("boilerplate"),
        f"{q}_clean": F.when(F.col(text).isNotNull(), F.concat_ws("\n", F.transform(
            F.filter(col("judged"), lambda x: x["rule"].isNull()), lambda x: x["line"]))),
    })
    # A filter on the verdict must not move below this step: it would repeat the lists' expressions inside
    # each other.  It reads a column that is not deterministic, which keeps it above.
    out = out.withColumns({f"{q}_repeat": F.coalesce(covered_words(col("places")), F.lit(0).cast("long")),
                           f"{q}_row": F.monotonically_increasing_id()})
    failed = (col("n") < 10) | (col("repeat") * 100 > col("n") * 20)
    return out.select(
        *df.columns, col("n").alias("n_words"), col("chars").alias("word_chars"), col("symbols").alias("n_symbols"),
        col("dup").alias("n_dup_lines"), col("repeat").alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & (col("lost") * 100 <= col("total") * max_lost_percent) & (col("row") >= 0)).alias("kept"),
        col("nlines").alias("n_lines"), col("p").alias("n_punctuation"), col("v").alias("n_navigation"),
        col("b").alias("n_boilerplate"), col("total").alias("line_chars"), col("lost").alias("lost_chars"),
        col("clean").alias("clean_text"))


def document_quality(docs: DataFrame) -> DataFrame:
    """Query form: the counts and the verdict of every document."""
    return quality_rules(docs.select("doc_id", "text")).drop("text", "clean_text")


def clean_documents(docs: DataFrame) -> DataFrame:
    """Pipeline form: kept documents with their failing lines removed, in the columns of ``docs``; columns
    that share a name with one of this operator's keep their values."""
    def step(df: DataFrame) -> DataFrame:
        kept = quality_rules(df).filter("kept").withColumn("text", F.col("clean_text"))
        if "n_chars" in df.columns:
            kept = kept.withColumn("n_chars", F.char_length("text").cast(df.schema["n_chars"].dataType))
        return kept.select(*df.columns)
    return behind_names(docs, ["text", "n_chars"], step)


QUALITY_SQL = rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, list_filter(regexp_split_to_array(t, '{GAP}'), lambda x: x <> '') as ws from d),
pos as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i from w),
gram as (
  select doc_id, i, word || ' ' || lead(word, 1) over p || ' ' || lead(word, 2) over p || ' ' ||
    lead(word, 3) over p || ' ' || lead(word, 4) over p as g
  from pos window p as (partition by doc_id order by i)),
twice as (
  select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt
  from (select *, count(*) over (partition by doc_id, g) as c from gram where g is not null) where c > 1),
rep as (select doc_id, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) as n from twice group by 1),
ln0 as (select doc_id, unnest(string_split(t, chr(10))) as line from d),
ln1 as (select *, len(regexp_extract_all(line, '{WORD}')) as n from ln0),
ln as (
  select *, case
    when len(regexp_extract_all(line, '{NOISE}')) * 10 >= n * 3 then 'punctuation'
    when len(regexp_extract_all(line, '{SEPARATORS}')) * 10 >= n * 3 or (n <= {MENU_WORDS} and regexp_matches(lower(line), '{MENU}'))
      then 'navigation'
    when n <= {BOILERPLATE_WORDS} and ({' or '.join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)}) then 'boilerplate' end as rule
  from ln1 where n > 0),
lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as dup,
    count(*) filter (rule = 'punctuation') as p, count(*) filter (rule = 'navigation') as v,
    count(*) filter (rule = 'boilerplate') as b, sum(length(line)) as total,
    coalesce(sum(length(line)) filter (rule is not null), 0) as lost
  from ln group by 1),
base as (
  select w.doc_id, len(ws)::bigint as n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    len(regexp_extract_all(t, '{SYMBOLS}'))::bigint as n_symbols, coalesce(dup, 0)::bigint as n_dup_lines,
    coalesce(rep.n, 0)::bigint as n_repeat_words, coalesce(n_lines, 0)::bigint as n_lines,
    coalesce(p, 0)::bigint as n_punctuation, coalesce(v, 0)::bigint as n_navigation,
    coalesce(b, 0)::bigint as n_boilerplate, coalesce(total, 0)::bigint as line_chars,
    coalesce(lost, 0)::bigint as lost_chars
  from w left join rep on rep.doc_id = w.doc_id left join lines on lines.doc_id = w.doc_id)
select *, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and lost_chars * 100 <= line_chars * {MAX_LOST_PERCENT}
    as kept
from base
"""
