"""Importance resampling of raw documents towards a target sample.

Two bag-of-n-gram models over hashed unigrams and bigrams are counted, one over
the target documents and one over all of them. A document's log importance
weight is the difference of its log-likelihoods. Adding Gumbel noise and taking
the largest keys draws a sample without replacement in proportion to the
weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, hash_sample, keys, mixed, raw, settled, slices

#: Buckets of the hashed n-grams; the models are two arrays of this length.
BUCKETS = 1 << 14
#: Labelled documents that the target model is fitted on, at most about: those with the least id hashes.
TARGET_DOCS = 100_000
#: Pseudo-counts, one such weight for each bucket.
SMOOTHING = 1.0
#: Bins of one refinement round of the exact top-k threshold.
BINS = 1_000


def buckets(words: list[bytes], memo: Memo, count: int = BUCKETS) -> np.ndarray:
    """Buckets of all unigrams and bigrams of a lower-cased text."""
    one = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        two = mixed(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])
        return (np.concatenate((mixed(one), two)) % np.uint64(count)).astype(np.int64)


def ngram_counts(docs: DataFrame, text_col: str = "text", group_col: str | None = None, count: int = BUCKETS) -> DataFrame:
    """(bucket, n, n_target): counts over all rows, and over those where ``group_col`` is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(zlib.crc32)
        both = np.zeros((2, count), np.int64)
        for batch in slices(batches):
            for text, target in zip(raw(batch.column(0)), batch.column(1).to_pylist()):
                found = np.bincount(buckets(text.lower().split(), memo, count), minlength=count)
                both[0] += found
                if target:
                    both[1] += found
        yield pa.record_batch([pa.array(np.arange(count)), pa.array(both[0]), pa.array(both[1])], ["bucket", "n", "n_target"])

    group = F.col(group_col).cast("boolean") if group_col else F.lit(True)
    rows = docs.select(F.col(text_col).cast("string").alias("text"), group.alias("target"))
    each = rows.mapInArrow(run, "bucket long, n long, n_target long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


def log_ratio(counts: DataFrame, count: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_target - log p_raw for each bucket; ``count`` numbers reach the driver whatever the input's size.

    The raw model gets ``smoothing`` in each bucket. The target model is drawn
    to the raw one by as many pseudo-counts, so that what a small target does
    not show is not held against a document.
    """
    raw_n, target_n = np.full(count, smoothing), np.zeros(count)
    for row in counts.collect():
        raw_n[row.bucket] += row.n
        target_n[row.bucket] += row.n_target
    p_raw = raw_n / raw_n.sum()
    prior = smoothing * count
    return np.log((target_n + prior * p_raw) / (target_n.sum() + prior)) - np.log(p_raw)


def log_weights(docs: DataFrame, ratio: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` (id first, then text and others) with the text replaced by a column ``log_weight``."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)
    others = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(zlib.crc32)
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            ratio = sent.value
            found = [float(ratio[buckets(t.lower().split(), memo, len(ratio))].sum()) for t in raw(batch.column(at))]
            yield batch.select(others).append_column("log_weight", pa.array(found, pa.float64()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col)
    return docs.mapInArrow(run, f"{kinds}, log_weight double")


def top_threshold(keyed: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest value of ``key``, exactly: rounds of histograms that narrow one bin down.

    Only ``BINS`` counts reach the driver in a round. None for k <= 0 or an
    empty table.
    """
    low, high, n = keyed.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n or k <= 0:
        return None
    if k >= n:
        return low
    above = 0
    while True:
        if low == high:
            return low
        width = (high - low) / BINS
        within = keyed.where(F.col(key).between(low, high))
        if width == 0 or low + width == low:
            values = within.groupBy(key).count().orderBy(F.desc(key)).limit(BINS).collect()
            for value, count in values:
                above += count
                if above >= k:
                    return value
            return low
        bins = within.groupBy(F.least(F.floor((F.col(key) - low) / width), F.lit(BINS - 1)).alias("bin"))
        found = bins.agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).orderBy(F.desc("bin")).collect()
        for row in found:
            if above + row.n >= k:
                low, high = row.low, row.high
                break
            above += row.n


def resample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality",
    share: float | None = None, seed: int = 7, most: int = TARGET_DOCS,
) -> DataFrame:
    """(doc_id, log_weight, gumbel_key, kept) for every row of ``docs``.

    The target are documents that ``labels`` gives quality 1, at most ``most``
    of them; their ids are broadcast, so no text is shuffled. The raw model
    counts all documents. ``kept`` marks
    the ``share`` of rows with the largest keys; without ``share`` it is the
    share of good ones among the labelled. The noise is a function of seed, id
    and text, so a row that is computed again gets the same key, and repeated
    rows are kept or left together. Rows with a null id have no label. Null and
    empty texts have weight 0. No labels: all weights are 0 and all is kept.
    """
    good = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(quality_col).cast("int").alias("good")).where("doc_id is not null and good is not null")
    good = good.groupBy("doc_id").agg(F.max("good").alias("good"))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    target = hash_sample(good.where("good = 1"), most, F.col("doc_id"))
    marked = rows.join(F.broadcast(target), "doc_id", "left").select("text", (F.col("good") == 1).alias("target"))
    counts = ngram_counts(marked, "text", "target")
    labelled = good.agg(F.avg((F.col("good") == 1).cast("double"))).first()[0]
    share = share if share is not None else labelled if labelled is not None else 1.0
    ratio = log_ratio(counts) if labelled else np.zeros(BUCKETS)
    k1, k2 = keys(F.lit(seed), F.col("doc_id"), F.col("text"))
    weighed = log_weights(rows.select("doc_id", k1, k2, "text"), ratio)
    # 52 bits of the hash as a number strictly between 0 and 1
    uniform = (F.shiftrightunsigned("k1", 12).cast("double") + 0.5) / F.lit(float(1 << 52))
    keyed = settled(weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))).drop("k1", "k2"))
    least = top_threshold(keyed, "gumbel_key", round(share * keyed.count()))
    kept = F.lit(False) if least is None else F.col("gumbel_key") >= F.lit(least)
    return keyed.withColumn("kept", kept)
