"""Quality rules by cross-document line frequency.

Lines are normalised and hashed. For each host the distinct documents that
hold a line are counted, lines above the limit are removed, and documents that
lose too much of their text are rejected. Exact copies of one document, but for
case and white space, count once: a document is told apart by a 128-bit key of
its whole text. Near copies are documents of their own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keys, raw, settled, slices, unused

#: A line is removed where at least this many documents of its host hold it ...
MIN_DOCS = 5
#: ... and at least this share of the host's distinct documents.
MAX_SHARE = 0.02
#: A document that loses more than this share of its words is depleted.
MAX_LOSS = 0.5
#: Most (host, line) pairs that are broadcast; above it they are joined by a shuffle.
BROADCAST_LINES = 500_000
SYMBOLS = b"#*$%&|<>"
_DIGIT = re.compile(rb"[0-9]")

def line_hash(line: bytes) -> int | None:
    """Signed hash of a line in lower case (A-Z), numbers as 0, white space folded; None for a line without words.

    Only words made of digits alone are numbers, so that names with digits stay apart.
    """
    words = line.lower().split()
    if not words:
        return None
    if _DIGIT.search(line):
        words = [b"0" if w.isdigit() else w for w in words]
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words))).view(np.int64))


def document_key(text: bytes) -> tuple[int, int]:
    """128 bits, as two signed longs, that stand for the words of a text in lower case (A-Z)."""
    key = xxhash.xxh3_128_digest(b" ".join(text.lower().split()))
    return int.from_bytes(key[:8], "big", signed=True), int.from_bytes(key[8:], "big", signed=True)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, until = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, until)
            until = at + 3
    return covered


def measures(text: bytes) -> dict:
    """The base measures of one text."""
    words = text.split()
    joined = b"".join(words)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeats = repeated_words(words)
    return {
        "n_words": len(words),
        "word_chars": len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace")),
        "n_symbols": len(joined) - len(joined.translate(None, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeats,
        "base_failed": len(words) < 50 or 100 * repeats > 50 * len(words),
    }


def without_lines(text: bytes, frequent) -> tuple[bytes, int]:
    """The text without its frequent lines, and how many words that removes."""
    if not frequent:
        return text, 0
    kept, gone = [], 0
    for line in text.split(b"\n"):
        if line_hash(line) in frequent:
            gone += len(line.split())
        else:
            kept.append(line)
    return (b"\n".join(kept), gone) if gone else (text, 0)


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (host, line, document key); each document also has a row with a null line, to count the host's documents."""
    for batch in slices(batches):
        found = set()
        for host, text in zip(batch.column(0).to_pylist(), raw(batch.column(1))):
            key = document_key(text)
            found.add((host, None, *key))
            found.update((host, h, *key) for h in map(line_hash, text.split(b"\n")) if h is not None)
        columns, kinds = zip(*found) if found else ((), (), (), ()), (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "line", "k1", "k2"])


def _host(docs: DataFrame, host_col: str) -> Column:
    return F.coalesce(F.col(host_col).cast("string"), F.lit(""))


def frequent_lines(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE
) -> DataFrame:
    """(host, line, n_docs) of the lines above the limits.

    Counts are exact and cover all documents. Two aggregations spread the
    documents of a common line before they are counted, so that no line's
    documents meet in one task. A host's size is counted likewise, in distinct
    documents. Null hosts are one host; null texts hold no lines and count, like
    all texts without words, as one document.
    """
    picked = docs.select(_host(docs, host_col).alias("host"), F.col(text_col).cast("string").alias("text"))
    rows = picked.mapInArrow(_line_rows, "host string, line long, k1 long, k2 long")
    counts = rows.distinct().groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    counts = settled(counts.where(F.col("line").isNull() | (F.col("n_docs") >= min_docs)))
    sizes = counts.where("line is null").select("host", F.col("n_docs").alias("size"))
    lines = counts.where("line is not null").join(sizes, "host")
    return lines.where(F.col("n_docs") >= max_share * F.col("size")).select("host", "line", "n_docs")


_VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_removed_words long, kept boolean, clean string"
)


def _with_frequent(docs: DataFrame, text_col: str, host_col: str, name: str, limits: dict, broadcast_lines: int):
    """``docs`` with a column ``name`` of frequent lines, or None and a broadcast of them by host."""
    found = settled(frequent_lines(docs, text_col, host_col, **limits))
    if found.count() <= broadcast_lines:
        by_host: dict[str, set[int]] = {}
        for row in found.select("host", "line").collect():
            by_host.setdefault(row.host, set()).add(row.line)
        return None, docs.sparkSession.sparkContext.broadcast({h: frozenset(x) for h, x in by_host.items()})
    text, host = F.col(text_col).cast("string"), _host(docs, host_col)
    k1, k2 = keys(host, text)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = set()
            for k1, k2, host, text in zip(*(batch.column(c).to_pylist() for c in range(3)), raw(batch.column(3))):
                rows.update((k1, k2, host, h) for h in map(line_hash, text.split(b"\n")) if h is not None)
            columns = zip(*rows) if rows else ((), (), (), ())
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["k1", "k2", "host", "line"])

    lines = docs.select(k1, k2, host.alias("host"), text.alias("text")).mapInArrow(listed, "k1 long, k2 long, host string, line long")
    held = lines.join(found.select("host", "line"), ["host", "line"]).groupBy("k1", "k2")
    first, second = [n for n in unused(docs, 3) if n != name][:2]
    held = held.agg(F.collect_set("line").alias(name)).withColumnsRenamed({"k1": first, "k2": second})
    keyed = docs.withColumns({first: k1, second: k2})
    return keyed.join(held, [first, second], "left").drop(first, second), None


def _judge(text: bytes, frequent, max_loss: float) -> dict:
    found = measures(text)
    clean, gone = without_lines(text, frequent)
    depleted = gone > max_loss * found["n_words"]
    return found | {"n_removed_words": gone, "kept": not found["base_failed"] and not depleted, "clean": clean}


def apply_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_loss: float = MAX_LOSS, broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    """(doc_id, base measures, base_failed, n_removed_words, kept, clean) for every row.

    ``clean`` is the text without its frequent lines; ``kept`` is false if the
    base rules fail or more than ``max_loss`` of the words went. Null and empty
    texts fail the base rules. Repeated rows are all returned, null ids stay
    null, other columns are ignored.
    """
    picked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), _host(docs, host_col).alias("host")
    )
    joined, sent = _with_frequent(picked, "text", "host", "lines", {"min_docs": min_docs, "max_share": max_share}, broadcast_lines)
    names = ["doc_id", *(x.split()[0] for x in _VERDICT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if sent is None:
                lines = [frozenset(x or ()) for x in batch.column(3).to_pylist()]
            else:
                lines = [sent.value.get(h) for h in batch.column(2).to_pylist()]
            rows = [_judge(t, f, max_loss) for t, f in zip(raw(batch.column(1)), lines)]
            columns = [pa.array([r[n] for r in rows]) for n in names[1:-1]]
            clean = pa.array([r["clean"] for r in rows], pa.binary()).cast(pa.string())
            yield pa.record_batch([batch.column(0), *columns, clean], names)

    rows = (picked if joined is None else joined).select("doc_id", "text", "host", *([] if joined is None else ["lines"]))
    return rows.mapInArrow(run, f"doc_id long, {_VERDICT}")


def keep_good(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", size_col: str = "n_chars",
    min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_loss: float = MAX_LOSS, broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns, the text without its frequent lines.

    ``size_col``, if there is such a column, is set to the new text's length.
    """
    limits = {"min_docs": min_docs, "max_share": max_share}
    host_name, lines_name = unused(docs, 2)
    joined, sent = _with_frequent(docs, text_col, host_col, lines_name, limits, broadcast_lines)
    rows = (docs if joined is None else joined).withColumn(host_name, _host(docs, host_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hosts = batch.column(batch.schema.get_field_index(host_name)).to_pylist()
            if sent is None:
                lists = batch.column(batch.schema.get_field_index(lines_name)).to_pylist()
                lines = [frozenset(x or ()) for x in lists]
            else:
                lines = [sent.value.get(h) for h in hosts]
            at = batch.schema.get_field_index(text_col)
            found = [_judge(t, f, max_loss) for t, f in zip(raw(batch.column(at)), lines)]
            clean = pa.array([r["clean"] for r in found], pa.binary()).cast(pa.string())
            batch = batch.set_column(at, text_col, clean).select([f for f in batch.schema.names if f not in (host_name, lines_name)])
            yield batch.filter(pa.array([r["kept"] for r in found]))

    out = rows.mapInArrow(run, docs.schema)
    if size_col not in docs.columns:
        return out
    return out.withColumn(size_col, F.length(text_col).cast(docs.schema[size_col].dataType))
