"""Quality score from compression: zstandard dictionaries of good and of bad labelled text.

A text is cut into blocks and every block is compressed under both dictionaries
(whole texts; the dictionaries stay effective in long ones).  The feature is the
difference of the two sizes over the text's bytes, and an isotonic fit on
labelled rows outside the dictionaries turns it into a calibrated score.

Only the fit works on a sample: whole texts of ``SAMPLE_ROWS`` labelled rows a class at most, in
hash order of the id, as long as ``SAMPLE_BYTES`` of text a class are not passed (a text that would
pass them is left out, the next ones are still tried); that bounds what the driver holds.  Class
shares come from all labelled rows, and texts are fitted, calibrated and scored whole.

Defined results: a null or empty text has difference 0; where a class has too
little text for a dictionary every score is the share of good labels (0.5
without labels); rows without id are not held out; equal rows get equal scores;
an empty table gives no rows; only id, text and label are read, so extra columns
cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 2500
SAMPLE_BYTES = 24 << 20
BLOCK = 4096
DICTIONARY = 65_536
LEVEL = 3
FOLDS = 5
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def blocks(text: str | None) -> list[bytes]:
    b = (text or "").encode("utf-8")
    return [b[i:i + BLOCK] for i in range(0, len(b), BLOCK)]


def differences(good: bytes, bad: bytes):
    """Function from texts to normalised size differences under two dictionaries."""
    form = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0)
    packers = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=form)
               for d in (good, bad)]

    def one(text: str | None) -> float:
        parts = blocks(text)
        if not parts:
            return 0.0
        a, b = (sum(len(p.compress(x)) for x in parts) for p in packers)
        return (b - a) / sum(map(len, parts))

    return lambda texts: np.array([one(t) for t in texts], float)


@dataclass
class Model:
    """Dictionaries (empty: none could be built), and the calibration curve."""

    good: bytes
    bad: bytes
    knots: np.ndarray
    values: np.ndarray
    share: float

    def scorer(self):
        """Function from texts to scores; made once in a task."""
        if not self.good or not self.bad:
            return lambda texts: np.full(len(texts), self.share)
        difference = differences(self.good, self.bad)

        def score(texts: list) -> np.ndarray:
            d = difference(texts)
            # a slight slope keeps the order of texts on a flat part of the fit
            curve = np.interp(d, self.knots, self.values) if len(self.knots) else np.full(len(d), self.share)
            return np.clip(0.98 * curve + 0.02 / (1 + np.exp(-np.clip(40 * d, -50, 50))), 0.0, 1.0)
        return score


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing weighted least squares (pool adjacent violators); mean x and value of each pool."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, w in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist()):
        pools.append([a * w, b * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _dictionary(samples: list[bytes]) -> bytes:
    if sum(map(len, samples)) < 8 * 1024 or len(samples) < 8:
        return b""
    size = min(DICTIONARY, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:        # samples that have nothing in common
        return b""


def fit_rows(rows: list[tuple[str, int]], share: float) -> Model:
    """Model from sampled (text, label) rows in their order; every third row calibrates."""
    built: dict[int, list[bytes]] = {0: [], 1: []}
    rest, seen = [], {0: 0, 1: 0}
    for text, label in rows:
        seen[label] += 1
        if seen[label] % 3:
            built[label] += blocks(text)
        else:
            rest.append((text, label))
    model = Model(_dictionary(built[1]), _dictionary(built[0]), np.empty(0), np.empty(0), share)
    if not model.good or not model.bad or len({y for _, y in rest}) < 2:
        return model
    x = differences(model.good, model.bad)([t for t, _ in rest])
    y = np.array([v for _, v in rest], float)
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    model.knots, model.values = isotonic(x, y, weight)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
        label: str = "quality") -> Model:
    """Model from the labelled rows that are not held out."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").alias("y"))
             .filter(~held_out(F.col("id"))))
    shares = dict(known.groupBy("y").count().collect())
    share = shares.get(1, 0) / max(1, sum(shares.values())) if shares else 0.5
    chosen = chosen_rows(docs, known, id_col, text)
    ids = docs.sparkSession.createDataFrame([(i, y) for i, y in chosen], known.schema)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")
            .groupBy("id", "y").agg(F.min("text").alias("text")).select("id", "text").toPandas())    # SAMPLE_BYTES a class
    texts = dict(zip(rows["id"], rows["text"]))
    return fit_rows([(texts[i], y) for i, y in chosen], share)


def chosen_rows(docs: DataFrame, known: DataFrame, id_col: str, text: str) -> list[tuple]:
    """The sampled (id, label) pairs in hash order; only ids, labels and sizes reach the driver."""
    order = [F.xxhash64("id"), F.col("id")]
    sample = None
    for y in (0, 1):                               # SAMPLE_ROWS rows of ids each: a bounded broadcast
        part = known.filter(F.col("y") == y).orderBy(*order).limit(SAMPLE_ROWS)
        sample = part if sample is None else sample.unionByName(part)
    sizes = (docs.select(F.col(id_col).alias("id"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).alias("n"))
             .join(F.broadcast(sample), "id").groupBy("id", "y").agg(F.max("n").alias("n"))
             .select("id", "y", "n", F.xxhash64("id").alias("h")).collect())
    out, used = [], {0: 0, 1: 0}
    for r in sorted(sizes, key=lambda r: (r["h"], r["id"])):
        if used[r["y"]] + r["n"] <= SAMPLE_BYTES:
            used[r["y"]] += r["n"]
            out.append((r["id"], r["y"]))
    return out


def score_rows(df: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(id_col, held_out, score, predicted)``."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(score(b.column(2).to_pylist()), pa.float64())],
                [id_col, "held_out", "score"])

    scored = df.select(id_col, held_out(F.col(id_col)).alias("held_out"), text).mapInArrow(
        run, f"`{id_col}` {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def document_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Query form."""
    return score_rows(docs, fit(docs, labels))
