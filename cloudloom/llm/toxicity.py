"""Toxicity: a weighted lexicon, matched by Aho-Corasick in folded text.

Folding undoes disguise: compatibility forms and look-alike letters of other
scripts become plain letters, invisible characters go, digits and signs inside
a word become the letters they stand for, marks around a word go, and single
letters with marks between them are joined.

The lexicon holds whole words and word starts with the logarithm of how much
more often toxic labelled documents have them. Phrases that only harmless
documents have are exceptions: the longest match wins, so a term inside an
exception does not count. The score is a logistic function of the weights of
the distinct words matched less a price for every distinct word of the text, so
that a long text needs more of them.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, hash_sample, settled, slices

#: Labelled documents that the lexicon and the score are fitted on, at most about (by a hash of doc_id).
TRAIN_DOCS = 20_000
#: Terms and learned exceptions, at most.
MOST_TERMS, MOST_PHRASES = 4_096, 4_096
#: Letters of word starts; toxic documents with a term, at least; likelihood ratio (in halves of nats) that chance seldom reaches.
STARTS, LEAST_DOCS, LEAST_GAIN = range(3, 9), 3, 30.0
#: Harmless documents that have a phrase, at least, for it to be an exception.
PHRASE_DOCS = 3
#: Folded phrases in which terms are harmless, whatever the labels say.
PHRASES = ("trash can", "trash bin", "trash bag", "class clown", "clown fish", "circus clown", "sore loser", "pond scum", "soap scum")
#: One fold of so many, by CRC-32 of doc_id as text, is held out.
FOLDS = 5

#: Letters of other scripts that look like Latin ones, and what digits and signs stand for.
LOOKALIKES = str.maketrans(dict(pair.split("=") for pair in (
    "а=a в=b с=c ԁ=d е=e ё=e ғ=f ɡ=g һ=h н=h і=i ї=i ı=i ӏ=l ј=j к=k м=m п=n о=o р=p ԛ=q г=r ѕ=s т=t у=y ү=y ѵ=v ԝ=w х=x "
    "α=a β=b ϲ=c ε=e η=n ι=i κ=k ν=v ο=o ρ=p τ=t υ=u χ=x ω=w ɑ=a ʟ=l ո=n օ=o ѡ=w"
).split()))
DIGITS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"})

_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_AROUND = re.compile(r"^[^\w@$]+|[\W_]+$")
_HAS_LETTER, _MARKS = re.compile(r"[^\W\d_]"), re.compile(r"[\W_]+")


def fold_word(word: str) -> str:
    """Folded words of one piece of text without white space, joined by two blanks; empty if no letter or digit is left."""
    word = _AROUND.sub("", unicodedata.normalize("NFKC", _INVISIBLE.sub("", word)).lower().translate(LOOKALIKES))
    if not word.isalpha() and _HAS_LETTER.search(word):
        word = word.translate(DIGITS)
    pieces = [p for p in _MARKS.split(word) if p]
    return "".join(pieces) if len(pieces) > 2 and all(len(p) == 1 for p in pieces) else "  ".join(pieces)


def fold(text: str | None, words: dict | None = None) -> list[str]:
    """Folded words of a whole text, in order."""
    known = Memo(fold_word) if words is None else words
    whole = "  ".join(filter(None, (known[w] for w in (text or "").split())))
    return whole.split("  ") if whole else []


def terms_of(word: str) -> list[str]:
    """A word as a whole, and its starts; a blank marks the ends of words."""
    return [f" {word} ", *(f" {word[:k]}" for k in STARTS if k < len(word))]


@dataclass(frozen=True)
class Lexicon:
    """Weighted terms, harmless phrases, and the logistic function's constant, weight and price of a word."""

    terms: dict[str, float] = field(default_factory=dict)
    phrases: tuple[str, ...] = ()
    constant: float = -30.0
    gain: float = 1.0
    price: float = 0.0

    def matcher(self) -> ahocorasick.Automaton | None:
        if not self.terms:
            return None
        automaton = ahocorasick.Automaton()
        for phrase in self.phrases:
            spaced = " " + "  ".join(phrase.split()) + " "
            automaton.add_word(spaced, (len(spaced), None))
        for term in self.terms:
            automaton.add_word(term, (len(term), term))
        automaton.make_automaton()
        return automaton


def matches(words: list[str], automaton: ahocorasick.Automaton | None) -> dict[str, str]:
    """Matched words and their terms: leftmost, longest, harmless phrases left out."""
    if automaton is None or not words:
        return {}
    text, found, free = " " + "  ".join(words) + " ", {}, 0
    for start, size, term in sorted((end - size + 1, -size, term or "") for end, (size, term) in automaton.iter(text)):
        if start >= free:
            free = start - size
            if term:
                found[text[start + 1 : text.index(" ", start + 1)]] = term
    return found


def _gain(a: Column, b: Column, toxic: int, harmless: int) -> Column:
    """Twice the log-likelihood ratio of a term that ``a`` toxic and ``b`` harmless documents have against one that does not care."""
    total, share = a + b, toxic / (toxic + harmless)

    def part(x: Column, expected: Column) -> Column:
        return F.when(x > 0, 2 * x * F.log(x / expected)).otherwise(0.0)

    none = F.lit(toxic + harmless) - total
    return part(a, total * share) + part(b, total * (1 - share)) + part(toxic - a, none * share) + part(harmless - b, none * (1 - share))


def _counted(sample: DataFrame, features_of_task) -> DataFrame:
    """(term, toxic, harmless): documents of the sample that have each feature of their folded words; the argument makes a task's function of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, features = Memo(fold_word, 50_000), features_of_task()
        for batch in slices(batches):
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in features(fold(text, memo)):
                    counts.setdefault(term, [0, 0])[0 if toxic else 1] += 1
            sides = [pa.array([c[k] for c in counts.values()], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *sides], ["term", "toxic", "harmless"])

    found = sample.select("text", "toxic").mapInArrow(count, "term string, toxic long, harmless long")
    return found.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("harmless").alias("harmless"))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a constant, by Newton's method with a small ridge."""
    x = np.c_[np.ones(len(x)), x]
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x, w = x / scale, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), x.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def labelled(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(text, toxic): labelled documents outside the held-out fold, at most about ``most`` of them. Repeated labels of a document count once, toxic if any is."""
    fold_no = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    known = labels.where("doc_id is not null and toxic is not null").select("doc_id", "toxic").where(fold_no != 0)
    some = hash_sample(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), most, F.col("doc_id"))
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", (F.col("toxic") > 0).alias("toxic"))  # at most about ``most`` numbers


def learn(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, phrases: tuple[str, ...] = PHRASES) -> Lexicon:
    """A lexicon from labelled documents. Without toxic or without harmless labels it is empty and scores everything near 0."""
    sample = settled(labelled(docs, labels, most))
    sides = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, harmless = sides.get(True, 0), sides.get(False, 0)
    if not toxic or not harmless:
        return Lexicon()
    a, b = F.col("toxic"), F.col("harmless")
    counted = _counted(sample, lambda: lambda words: {t for w in set(words) for t in terms_of(w)}).where(a >= LEAST_DOCS).where(a / toxic > b / harmless)
    ranked = counted.withColumn("gain", _gain(a, b, toxic, harmless)).where(F.col("gain") >= LEAST_GAIN)
    best = ranked.orderBy(F.desc("gain"), F.desc(F.length("term")), "term").limit(4 * MOST_TERMS).collect()
    terms: dict[str, float] = {}
    starts: set[str] = set()  # of the terms taken
    for row in best:
        term = row["term"]
        if len(terms) < MOST_TERMS and term.strip() not in starts and not any(f" {term.strip()[:k]}" in terms for k in range(1, len(term))):
            terms[term] = math.log((row["toxic"] + 0.5) / (toxic + 1)) - math.log((row["harmless"] + 0.5) / (harmless + 1))
            starts.update(term.strip()[:k] for k in range(1, len(term)))

    def pairs_of_task():
        automaton = Lexicon(terms).matcher()

        def pairs(words: list[str]) -> set[str]:
            found = matches(words, automaton)
            return {f"{x} {y}" for x, y in zip(words, words[1:]) if x in found or y in found} if found else set()

        return pairs

    learned = _counted(sample, pairs_of_task).where((a == 0) & (b >= PHRASE_DOCS)).orderBy(F.desc("harmless"), "term").limit(MOST_PHRASES)
    harmless_phrases = tuple(dict.fromkeys([*phrases, *(r["term"] for r in learned.collect())]))
    start = Lexicon(terms, harmless_phrases)
    rows = _matched(sample, start).select("toxic", "weight", "n_distinct").collect()  # three numbers for each row of the sample
    x, y = np.array([[r["weight"], r["n_distinct"]] for r in rows], float), np.array([r["toxic"] for r in rows], float)
    w = _logistic(x, y)
    if w[2] > 0:  # too few rows to see that length costs
        w = np.r_[_logistic(x[:, :1], y), 0.0]
    return Lexicon(terms, harmless_phrases, *map(float, (w[0], w[1], -w[2])))


def _matched(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with the numbers of words and of distinct ones, the weight of the distinct words matched, and those with their terms; a null text is empty."""
    names = docs.columns
    kinds = {"n_words": "long", "n_distinct": "long", "weight": "double", "matched": "array<struct<word: string, term: string>>"}
    kept = docs.select(*(c for c in names if c.lower() not in kinds))
    old = kept.columns
    at = old.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, automaton = Memo(fold_word, 100_000), lexicon.matcher()
        kind = pa.list_(pa.struct([("word", pa.string()), ("term", pa.string())]))
        for batch in slices(batches):
            sizes, kinds_of, weights, found = [], [], [], []
            for text in batch.column(at).to_pylist():
                words = fold(text, memo)
                hits = matches(words, automaton)
                sizes.append(len(words))
                kinds_of.append(len(set(words)))
                weights.append(sum(lexicon.terms[t] for t in hits.values()))
                found.append([{"word": w, "term": t.strip()} for w, t in sorted(hits.items())])
            new = [pa.array(sizes, pa.int64()), pa.array(kinds_of, pa.int64()), pa.array(weights, pa.float64()), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*old, *kinds])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + "".join(f", {n} {k}" for n, k in kinds.items())
    return kept.mapInArrow(scan, schema)


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` (with a column ``text``) with n_words, n_distinct, weight, matched and score; columns of these names are replaced.

    ``score`` is from 0 to 1 and the higher, the likelier a toxic label; an
    empty or null text has the score of no words. Rows are scored by their text
    alone, so repeated rows are scored alike, and an empty table stays empty.
    """
    z = F.lit(lexicon.constant) + F.lit(lexicon.gain) * F.col("weight") - F.lit(lexicon.price) * F.col("n_distinct")
    scored = _matched(docs, lexicon)
    return scored.select(*(c for c in scored.columns if c.lower() != "score"), (1 / (1 + F.exp(-z))).alias("score"))


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, matched) for every document, by a lexicon learned outside the held-out fold."""
    lexicon = learn(docs, labels)
    scored = score_toxicity(docs.select("doc_id", "text"), lexicon)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "matched")
