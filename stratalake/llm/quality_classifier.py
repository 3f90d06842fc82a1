"""Quality classifier: how much better a dictionary of good text compresses a document than one of bad text."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from stratalake.llm.worker import kept
from stratalake.sources import stage

BLOCK = 4096  # bytes compressed at a time, each with the dictionary afresh: all of a long text counts
LEVEL = 3
CUT = 0.7


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are never learned from."""
    return _fold(doc_id) == 2


def _fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries, and what turns the difference of a text's sizes into odds."""

    good: bytes
    bad: bytes
    slope: float
    offset: float


def _gains(texts: list[str], good: bytes, bad: bytes) -> np.ndarray:
    """Per whole text (bad - good) / (bad + good) of its compressed sizes; 0 for an empty text."""

    def compressor(data: bytes) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(data)
        known.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=known, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    mark = hashlib.sha1(good + bad).hexdigest()
    press = kept(f"quality_{mark}", lambda: (compressor(good), compressor(bad)))
    out = np.zeros(len(texts))
    for k, text in enumerate(texts):
        if raw := text.encode():
            small, large = (sum(len(c.compress(raw[i : i + BLOCK])) for i in range(0, len(raw), BLOCK)) for c in press)
            out[k] = (large - small) / (large + small)
    return out


def size_difference(text: Column | str, good: bytes, bad: bytes) -> Column:
    """The normalised difference of a text's sizes by both dictionaries; a null text counts as empty."""

    @arrow_udf("double")
    def gain(column: pa.Array) -> pa.Array:
        return pa.array(_gains(column.fill_null("").to_pylist(), good, bad))

    return gain(text)


def _dictionary(samples: list[str], size: int) -> bytes:
    """A trained dictionary; of too few samples for that, the samples themselves."""
    raw = [s.encode() for s in samples]
    try:
        return zstandard.train_dictionary(size, raw, level=LEVEL, threads=1).as_bytes()
    except zstandard.ZstdError:
        return b"".join(raw)[-size:] or b"\0"


def _calibrate(gains: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of a weighted logistic regression of ``labels``, by Newton's method."""
    if not len(labels) or labels.min() == labels.max():
        return 0.0, math.log((weights @ labels + 1) / (weights @ (1 - labels) + 1))
    scale = np.array([10.0, 1.0])
    x = np.stack([gains, np.ones(len(gains))], axis=1) * scale
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(bend, x.T @ (weights * (p - labels)) + ridge * w)
        w -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w * scale)


def fit_quality_model(
    documents: DataFrame,
    labels: DataFrame,
    max_documents: int = 2000,
    max_blocks: int = 4000,
    dictionary_bytes: int = 110_000,
) -> QualityModel:
    """Learns from labelled documents that are not held out; only text and the label quality are looked at.

    Per label and purpose at most ``max_documents`` are taken, those with the
    smallest hash of the id. Two of the three folds give the dictionaries' text:
    at most ``max_blocks`` blocks from anywhere in these texts, per label. The
    third fold calibrates, with at most as many documents, scored whole. The
    driver holds the blocks (16 MB at most per label) and a number per document.
    """
    fold = _fold(F.col("doc_id"))
    usable = labels.filter(F.col("quality").isin(0, 1) & (fold != 2)).select("doc_id", "quality", (fold == 3).alias("tune"))
    parts = [
        usable.filter((F.col("quality") == q) & (F.col("tune") == tune))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_documents)
        for q in (0, 1)
        for tune in (False, True)
    ]
    chosen = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    # At most four times max_documents ids; their texts are looked up once.
    texts = stage(
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id"),
        "labelled-texts",
    )
    blocks = texts.filter(~F.col("tune") & (F.col("text") != "")).select(
        "quality",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.length("text") - 1) / BLOCK).cast("int")),
                lambda k: F.substr(F.col("text"), k * BLOCK + 1, F.lit(BLOCK)),
            )
        ).alias("block"),
    )
    dictionaries = []
    for q in (1, 0):
        some = blocks.filter(F.col("quality") == q).orderBy(F.xxhash64("block"), "block").limit(max_blocks)
        dictionaries.append(_dictionary([r["block"] for r in some.select("block").collect()], dictionary_bytes))
    good, bad = dictionaries
    # Both labels are sampled alike, so each document stands for as many as its label has.
    shares = dict(usable.filter("tune").groupBy("quality").count().collect())
    found = texts.filter("tune").select(size_difference("text", good, bad).alias("gain"), "quality")
    rows = np.array(sorted(tuple(r) for r in found.collect()), float).reshape(-1, 2)
    marks = rows[:, 1]
    weights = np.array([shares[int(m)] / (marks == m).sum() for m in marks])
    return QualityModel(good, bad, *_calibrate(rows[:, 0], marks, weights))


def quality_score(text: Column | str, model: QualityModel) -> Column:
    """From 0 to 1, the chance of label 1."""
    gain = size_difference(text, model.good, model.bad)
    return 1 / (1 + F.exp(-(gain * model.slope + model.offset)))


def classify_quality(documents: DataFrame, model: QualityModel, cut: float = CUT) -> DataFrame:
    """Every document's score by its whole text, and whether that reaches ``cut``.

    Null and empty texts get the score of no difference. Equal texts get equal
    scores. Without labels, or with one label only, all texts get the share of
    label 1, smoothed. An empty table gives no rows; other columns are not looked at.

    Columns: doc_id, held_out, score, predicted.
    """
    out = held_out(F.col("doc_id")).alias("held_out")
    scored = documents.select("doc_id", out, quality_score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))
