"""Exact substring dedup by seed and extend.

A window is ``length`` consecutive words. The least hash among a window's
``seed``-word grams is its anchor (winnowing), so equal windows have equal
anchors and consecutive windows mostly share one. The first pass counts
anchors; only anchors seen twice can seed a repeat. The second pass extends
each such seed to all windows around it and groups the extensions by anchor:
windows that also occur elsewhere are marked, and the union of marked windows
is the set of maximal repeats of at least ``length`` words.

No pairs are formed. Repeats inside a batch are settled there and sent on once,
so copies shrink before the shuffle. Anchors with more than ``hot`` occurrences
are not gathered: their windows are counted by their own hashes, which combines
before the shuffle, and joined with the counts, so no task holds a hot group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, keys, mixed, raw, settled, slices

#: Most anchors that are sent to all executors (8 bytes each); above it anchors are joined by a shuffle.
BROADCAST_ANCHORS = 4_000_000
#: Occurrences from which an anchor's windows are dealt out by their own hashes.
HOT = 256
#: Words whose windows are settled together.
CHUNK_WORDS = 1_000_000
#: Windows in a row of the second pass.
RUN = 60

_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` values, by doubling: O(n log size)."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out, at, span, power, part, rest = None, 0, 1, _BASE, words, size
        while rest:
            if rest & 1:
                piece = part[at : at + count]
                out = piece.copy() if out is None else out * power + piece
                at += span
            rest >>= 1
            if rest:
                part = part[: len(part) - span] * power + part[span:]
                span, power = 2 * span, power * power
        return mixed(out)


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    count, span, out = len(values) - width + 1, 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:count], out[width - span : width - span + count])


def anchors_of(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """The anchor of each window of ``length`` words."""
    return least_in_windows(gram_hashes(hashes, seed), length - seed + 1)


def anchor_places(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hashes of the grams that are least in some window, once for each place where one starts."""
    grams, width = gram_hashes(hashes, seed), length - seed + 1
    least = least_in_windows(grams, width)
    edge = np.full(width - 1, ~np.uint64(0))
    largest = ~least_in_windows(np.concatenate((edge, ~least, edge)), width)
    return grams[grams == largest]


def runs_of(values: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values, none longer than ``most``."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1))
    sizes = np.diff(np.concatenate((starts, [len(values)])))
    if most and sizes.max() > most:
        parts = -(-sizes // most)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, whole = np.repeat(starts, parts) + inner * most, np.repeat(sizes, parts)
        sizes = np.minimum(whole - inner * most, most)
    return starts, sizes


def _memo() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


def _anchor_counts(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size = _memo(), [], 0

        def counted() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts)], ["anchor", "n"])

        for batch in slices(batches):
            for text in raw(batch.column(0)):
                words = text.split()
                if len(words) < length:
                    continue
                held.append(anchor_places(word_hashes(words, memo), length, seed))
                size += len(held[-1])
                if size > CHUNK_WORDS:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return run


def _found(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_values, values)
    return sorted_values[np.minimum(at, len(sorted_values) - 1)] == values


_ROW = "key long, k1 long, k2 long, start int, windows array<long>, known boolean, hot boolean"


def _extend(length: int, seed: int, sent=None):
    """Rows of windows around repeated seeds.

    ``sent``: a broadcast of (sorted anchors, sorted hot anchors); else the
    input's fourth and fifth columns list the row's seeds and hot seeds.
    A row with ``known`` says that its windows are repeats; the others are
    still to be compared with the rows of their key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo()
        docs: list[tuple[int, int]] = []
        parts: list[tuple[np.ndarray, ...]] = []
        size = 0

        def settle() -> list[pa.RecordBatch]:
            doc = np.concatenate([np.full(len(p[0]), i, np.int64) for i, p in enumerate(parts)])
            start, window, anchor, hot = (np.concatenate([p[k] for p in parts]) for k in range(4))
            _, first, inverse, counts = np.unique(window, return_index=True, return_inverse=True, return_counts=True)
            many = counts[inverse] > 1
            open_ = ~many
            open_[first] = True  # one row of each goes on, to tell the other batches
            out = []
            for rows, known in ((np.flatnonzero(many), True), (np.flatnonzero(open_), False)):
                if not len(rows):
                    continue
                key = np.where(hot[rows], window[rows], anchor[rows])
                near = (np.diff(rows) == 1) & (np.diff(doc[rows]) == 0) & (np.diff(start[rows]) == 1) & (key[1:] == key[:-1]) & (hot[rows][1:] == hot[rows][:-1])
                group = np.concatenate(([0], np.cumsum(~near)))
                at, sizes = runs_of(group, RUN)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate((at, [len(rows)])).astype(np.int32)), pa.array(window[rows].view(np.int64))
                )
                owner = doc[rows][at]
                ids = np.array(docs, np.int64).reshape(-1, 2)[owner]
                out.append(
                    pa.record_batch(
                        [
                            pa.array(key[at].view(np.int64)),
                            pa.array(ids[:, 0].copy()),
                            pa.array(ids[:, 1].copy()),
                            pa.array(start[rows][at].astype(np.int32)),
                            lists,
                            pa.array(np.full(len(at), known)),
                            pa.array(hot[rows][at]),
                        ],
                        ["key", "k1", "k2", "start", "windows", "known", "hot"],
                    )
                )
            return out

        for batch in slices(batches):
            k1, k2 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text in enumerate(raw(batch.column(2))):
                words = text.split()
                if len(words) < length:
                    continue
                hashes = word_hashes(words, memo)
                anchor = anchors_of(hashes, length, seed)
                if sent is None:
                    seeds, hot = (np.sort(np.array(batch.column(c)[i].as_py() or [], np.int64).view(np.uint64)) for c in (3, 4))
                else:
                    seeds, hot = sent.value
                at = np.flatnonzero(_found(seeds, anchor))
                if not len(at):
                    continue
                docs.append((k1[i], k2[i]))
                parts.append((at, gram_hashes(hashes, length)[at], anchor[at], _found(hot, anchor[at])))
                size += len(at)
                if size > CHUNK_WORDS:
                    yield from settle()
                    docs, parts, size = [], [], 0
        if parts:
            yield from settle()

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; marks the windows that occur in two or more places under their key."""

    def marks(group: pa.Table) -> pa.RecordBatch:
        group = group.combine_chunks()
        lists = group.column("windows").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat = lists.flatten().to_numpy()
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        hit = counts[inverse] > 1
        bits = np.zeros(len(sizes), np.int64)
        np.bitwise_or.at(bits, row[hit], np.int64(1) << place[hit].astype(np.int64))
        some = np.flatnonzero(bits)
        taken = group.take(pa.array(some))
        return pa.record_batch(
            [*(taken.column(c).combine_chunks() for c in ("k1", "k2", "start")), pa.array(bits[some])],
            ["k1", "k2", "start", "bits"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        earlier = np.flatnonzero(key != key[-1])
        at = int(earlier[-1]) + 1 if len(earlier) else 0
        if at == 0 and (not held or held[-1].column(0)[-1].as_py() == key[-1]):
            held.append(batch)
            continue
        yield marks(pa.Table.from_batches([*held, batch.slice(0, at)]))
        held = [batch.slice(at)]
    if held:
        yield marks(pa.Table.from_batches(held))


def repeated_windows(
    docs: DataFrame, text_col: str = "text", length: int = 35, seed: int = 12,
    broadcast_anchors: int = BROADCAST_ANCHORS, hot: int = HOT,
) -> DataFrame:
    """(k1, k2, marks) for texts with windows that also start elsewhere.

    k1 and k2 stand for the text; ``marks`` lists structs (start, bits): bit i
    is set if the window that starts at word ``start + i`` is a repeat.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    counts = docs.select(text.alias("text")).mapInArrow(_anchor_counts(length, seed), "anchor long, n long")
    seeds = settled(counts.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"))
    keyed = docs.select(*keys(text), text.alias("text"))
    if seeds.count() <= broadcast_anchors:
        table = seeds.toArrow()
        values, many = table["anchor"].to_numpy().view(np.uint64), table["n"].to_numpy()
        sent = spark.sparkContext.broadcast((np.sort(values), np.sort(values[many > hot])))
        rows = keyed.mapInArrow(_extend(length, seed, sent), _ROW)
    else:
        rows = _joined_seeds(keyed, seeds, length, seed, hot).mapInArrow(_extend(length, seed), _ROW)
    rows = settled(rows)
    whole = F.expr("cast(shiftleft(1L, size(windows)) - 1 as long)").alias("bits")
    known = rows.where("known").select("k1", "k2", "start", whole)
    open_ = rows.where("not known")
    compared = (
        open_.where("not hot").select("key", "k1", "k2", "start", "windows")
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_compare, "k1 long, k2 long, start int, bits long")
    )
    # A row of a hot anchor holds one window, or the same one at consecutive places; its key is the window's hash.
    counted = open_.where("hot")
    often = counted.groupBy("key").agg(F.sum(F.size("windows")).alias("n")).where("n > 1").select("key")
    counted = counted.join(often, "key", "left_semi").select("k1", "k2", "start", whole)
    each = known.union(compared).union(counted).groupBy("k1", "k2", "start").agg(F.bit_or("bits").alias("bits"))
    return each.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "bits")).alias("marks"))


def _joined_seeds(keyed: DataFrame, seeds: DataFrame, length: int, seed: int, hot: int) -> DataFrame:
    """The texts with the seeds that they hold, for more seeds than are broadcast."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo()
        for batch in slices(batches):
            for k1, k2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2))):
                words = text.split()
                if len(words) < length:
                    continue
                found = np.unique(anchors_of(word_hashes(words, memo), length, seed)).view(np.int64)
                ids = [pa.array(np.full(len(found), k)) for k in (k1, k2)]
                yield pa.record_batch([*ids, pa.array(found)], ["k1", "k2", "anchor"])

    rows = keyed.mapInArrow(listed, "k1 long, k2 long, anchor long").distinct()
    held = rows.join(seeds, "anchor").groupBy("k1", "k2").agg(
        F.collect_list("anchor").alias("seeds"),
        F.collect_list(F.when(F.col("n") > hot, F.col("anchor"))).alias("hot"),
    )
    return keyed.join(held, ["k1", "k2"]).select("k1", "k2", "text", "seeds", "hot")


def maximal_repeats(marks: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """(first word, end) of each maximal run of words that marked windows cover, in order.

    Neighbouring matches overlap in all but a word, so this joins what was
    found around the seeds to the left and right as far as it repeats.
    """
    starts = []
    for mark in marks or ():
        bits, start = mark["bits"], mark["start"]
        while bits:
            low = (bits & -bits).bit_length() - 1
            starts.append(start + low)
            bits &= bits - 1
    spans: list[tuple[int, int]] = []
    for start in sorted(starts):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], start + length)
        else:
            spans.append((start, start + length))
    return spans


def kept_words(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    """The words outside these spans."""
    if not spans:
        return words
    kept, at = [], 0
    for start, end in spans:
        kept += words[at:start]
        at = end
    return kept + words[at:]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, seed: int = 12,
    broadcast_anchors: int = BROADCAST_ANCHORS, hot: int = HOT,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, repeats) for every row: the text without its repeated passages.

    Words are runs of bytes other than ASCII white space. A word goes if a
    window of ``length`` words covers it whose words also start anywhere else,
    in the same text or another; every occurrence goes, so repeated rows of
    that length lose all words. Windows are judged on the input. ``kept`` joins
    the remaining words by one space, ``repeats`` lists the removed passages
    (first word, end). Null, empty and short texts lose nothing;
    null ids stay null; other columns are ignored.
    """
    text = F.col(text_col).cast("string")
    marks = repeated_windows(docs, text_col, length, seed, broadcast_anchors, hot)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keys(text), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for text, marked in zip(raw(batch.column(1)), batch.column(2).to_pylist()):
                words, spans = text.split(), maximal_repeats(marked, length)
                kept = kept_words(words, spans)
                found.append((len(words), len(words) - len(kept), b" ".join(kept), [{"start": a, "end": b} for a, b in spans]))
            counts = [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]
            spans = pa.array([x[3] for x in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            texts = pa.array([x[2] for x in found], pa.binary()).cast(pa.string())
            yield pa.record_batch([batch.column(0), *counts, texts, spans], ["doc_id", "n_words", "n_removed", "kept", "repeats"])

    joined = rows.join(marks, ["k1", "k2"], "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, repeats array<struct<start:int,end:int>>")
