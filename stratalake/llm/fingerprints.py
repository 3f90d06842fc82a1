"""Document fingerprints: a digest of the quartiles of hashed byte triplets, and how alike two digests are."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm.worker import SLICE_BYTES

BUCKETS = 256
HEADER = 3  # bytes: the length, and how the quartiles relate
# A difference from which on digests are nothing alike: what unrelated codes of all buckets differ by on average.
FAR = 320.0
FINGERPRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def digests(texts: list[bytes]) -> np.ndarray:
    """A row of HEADER + 64 bytes for each text: length, quartile ratios, two bits for each bucket."""
    out = np.zeros((len(texts), HEADER + BUCKETS // 4), np.uint8)
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= SLICE_BYTES):
            size += len(texts[last])
            last += 1
        out[first:last] = _digests(texts[first:last])
        first = last
    return out


def _digests(texts: list[bytes]) -> np.ndarray:
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    counts = np.zeros((len(texts), BUCKETS), np.int64)
    if len(data) > 2:
        triplet = data[:-2] | (data[1:-1] << np.uint32(8)) | (data[2:] << np.uint32(16))
        bucket = ((triplet * np.uint32(0x9E3779B1)) ^ ((triplet * np.uint32(0x85EBCA77)) >> np.uint32(9))) >> np.uint32(24)
        owner = np.repeat(np.arange(len(texts)), sizes)
        inside = owner[:-2] == owner[2:]
        places = owner[:-2][inside] * BUCKETS + bucket[inside]
        counts = np.bincount(places, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
    ordered = np.sort(counts, axis=1)
    quartiles = ordered[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, :, None] > quartiles[:, None, :]).sum(axis=2).astype(np.uint8).reshape(len(texts), -1, 4)
    packed = codes[:, :, 0] | (codes[:, :, 1] << 2) | (codes[:, :, 2] << 4) | (codes[:, :, 3] << 6)
    # Eighths of a doubling; quartiles as parts of 16 of the third.
    length = np.minimum(255, np.round(8 * np.log2(1 + sizes))).astype(np.uint8)
    ratios = (15 * quartiles[:, :2] // np.maximum(quartiles[:, 2:], 1)).astype(np.uint8)
    return np.concatenate([length[:, None], ratios, packed], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, down to 0 where lengths, ratios and buckets differ by FAR steps or more."""
    head = np.abs(a[:, :HEADER].astype(np.int64) - b[:, :HEADER].astype(np.int64)) * [2, 1, 1]
    steps = head.sum(axis=1)
    for shift in (0, 2, 4, 6):
        left = ((a[:, HEADER:] >> shift) & 3).astype(np.int64)
        right = ((b[:, HEADER:] >> shift) & 3).astype(np.int64)
        steps = steps + np.abs(left - right).sum(axis=1)
    return 1.0 - np.minimum(1.0, steps / FAR)


def edit(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as many first characters of ``following``, or all of it."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order, then the row that follows the range."""
    ids: list[int | None] = []
    texts: list[str] = []
    ended = False
    for batch in batches:
        guests = batch.column("guest").to_pylist()
        for doc, text, guest in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), guests, strict=True):
            if not ended:
                ids.append(doc)
                texts.append(text)
                ended = bool(guest)  # equal ids may follow: the first is next
        if len(texts) > 1:
            yield _rows(ids, texts)
            ids, texts = ids[-1:], texts[-1:]


def _rows(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
    """Every text but the last, with the one after it."""
    edited = [edit(a, b).encode() for a, b in zip(texts, texts[1:], strict=False)]
    own, changed = digests([t.encode() for t in texts]), digests(edited)
    return pa.record_batch(
        [
            pa.array(ids[:-1], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited]),
            pa.array([d.tobytes().hex() for d in own[:-1]]),
            pa.array([d.tobytes().hex() for d in changed]),
            pa.array(likeness(own[:-1], changed)),
            pa.array(likeness(own[:-1], own[1:])),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of an edited text, and the likeness to it and to the next document.

    The next document is the one that follows by doc_id (null last; equal ids by
    text; after the last comes the first). The edited text has the last quarter
    of the characters replaced by the next document's first. Null texts are
    empty ones; the only document of a table is its own next. An empty table
    gives no rows; other columns are not looked at.

    Rows are exchanged once, into ranges of doc_id, and sorted there, so the next
    document is at hand. Only the first row of a range is also sent to the range
    before it. Ranges are as many as shuffle partitions, at even shares of the
    ids; the driver sees one id for each. A worker holds one batch of texts.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    cuts = texts.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0] or []
    range_of = _range_of(sorted(set(cuts)))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")
    firsts = documents.select(range_of("doc_id").alias("part"), "doc_id").groupBy("part").agg(F.min(order).alias("first"))
    known = sorted((r["part"], r["first"]["doc_id"]) for r in firsts.collect())
    guest_of = _guest_range(known)
    no_guest = F.array(F.struct(F.col("part").alias("to"), F.lit(0).alias("guest")))
    both = F.array(
        F.struct(F.col("part").alias("to"), F.lit(0).alias("guest")),
        F.struct(F.col("before").alias("to"), F.lit(1).alias("guest")),
    )
    ranged = texts.withColumn("part", range_of("doc_id")).withColumn("before", guest_of("doc_id", "part"))
    sent = ranged.select("doc_id", "text", F.explode(F.when(F.col("before").isNotNull(), both).otherwise(no_guest)).alias("sent"))
    placed = sent.select("doc_id", "text", "sent.*").repartitionById(max(parts, 1), F.col("to"))
    return (
        placed.sortWithinPartitions("guest", F.col("doc_id").asc_nulls_last(), "text")
        .select("doc_id", "text", "guest")
        .mapInArrow(_compared, FINGERPRINTS)
    )


def _range_of(cuts: list[int]):
    """The number of ``cuts`` below an id, by binary search; a null id lies above all."""
    ordered = np.array(cuts, np.int64)

    def run(doc_id: pa.Array) -> pa.Array:
        part = np.searchsorted(ordered, doc_id.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int32)
        part[doc_id.is_null().to_numpy(zero_copy_only=False)] = len(ordered)
        return pa.array(part)

    return F.arrow_udf(run, "int")


def _guest_range(known: list[tuple[int, int | None]]):
    """The range before that of a row which is the first of its own; else null. ``known``: ranges and their first ids."""
    size = known[-1][0] + 1 if known else 1
    before, first, no_id = np.full(size, -1, np.int32), np.zeros(size, np.int64), np.zeros(size, bool)
    for k, (part, doc_id) in enumerate(known):
        before[part] = known[k - 1][0]
        first[part], no_id[part] = doc_id or 0, doc_id is None

    def run(doc_id: pa.Array, part: pa.Array) -> pa.Array:
        at, none = part.to_numpy(zero_copy_only=False), doc_id.is_null().to_numpy(zero_copy_only=False)
        leads = (doc_id.fill_null(0).to_numpy(zero_copy_only=False) == first[at]) & (none == no_id[at])
        return pa.array(before[at], mask=~leads)

    return F.arrow_udf(run, "int")
