"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word's letters are a multiset, that is, a binary vector over (letter, how
often so far). One replaced letter changes two of its entries, one inserted
or deleted letter one. The entries are dealt out to parts by their letter; two
vectors that differ in at most ``d`` entries agree in all but ``d`` of the
parts. So all choices of (parts - d) parts, with what a vector has in them,
are signatures, and near words share at least one. Signatures of replaced
letters also carry the length, which stays; those of an inserted letter carry
the shorter length. An edit leaves one half of the shorter word as it is, so
that half goes into the signature too: words of the same letters in another
order then seldom meet. Signatures are joined by equality, every pair that
meets is verified, and none is left out.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled

#: What words are made of, and their letters after A-Z became a-z.
LETTER = "[A-Za-zÀ-ÿ]"
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
#: Least code points and occurrences of a word; a form is at least FORM times as frequent as its variant.
LEAST_LENGTH, LEAST_COUNT, FORM = 7, 2, 10
#: One in so many runs, by its hash, loses a letter.
TYPOS = 31
#: (parts, entries that may differ) for a replaced and for an inserted letter.
REPLACED, INSERTED = (4, 2), (3, 1)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): distinct words of at least LEAST_LENGTH code points that occur at least LEAST_COUNT times.

    Runs of letters of whole texts, of which some lose one letter, chosen by
    a hash of doc_id and run. A null text has no words, a null doc_id counts
    as an empty one.
    """
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"{LETTER}{{{LEAST_LENGTH},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("found"))
    runs = runs.select("id", F.translate("found", _UPPER, _LOWER).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % TYPOS == 0, short).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _chosen(parts: int, differ: int) -> list[Column]:
    """What a word's sorted letters are in each choice of parts; the choice itself is part of it."""
    inside = ["".join(c for c in LETTERS if ord(c) % parts == k) for k in range(parts)]
    outside = ["".join(c for c in LETTERS if c not in part) for part in inside]
    names = [F.translate("sorted", other, "") for other in outside]
    return [F.concat_ws(",", F.lit("".join(map(str, some))), *(names[k] for k in some)) for some in combinations(range(parts), parts - differ)]


def _signatures(kind: str, rule: tuple[int, int], shorter: Column) -> list[Column]:
    """Signatures for a pair whose shorter word has ``shorter`` code points: chosen parts, with the first or with the last half."""
    half = F.floor(shorter / 2).cast("int")
    halves = [F.concat(F.lit("<"), F.substring("word", F.lit(1), half)), F.concat(F.lit(">"), F.substring("word", F.length("word") - half + 1, half))]
    return [F.xxhash64(F.lit(kind), shorter, letters, side) for letters in _chosen(*rule) for side in halves]


def links(vocab: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, both ways round, once each. ``vocab`` has distinct words (word, n)."""
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    words = vocab.select("word", "n", letters.alias("sorted"), F.length("word").alias("size"))
    same = F.array(*_signatures("replaced", REPLACED, F.col("size")))
    shorter = F.array(*_signatures("inserted", INSERTED, F.col("size")))
    longer = F.when(F.col("size") > LEAST_LENGTH, F.array(*_signatures("inserted", INSERTED, F.col("size") - 1))).otherwise(F.array())
    # a word of either side of a replacement, but of one side of an insertion
    left = words.select("word", "n", F.explode(F.concat(same, shorter)).alias("signature"))
    right = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.explode(F.concat(same, longer)).alias("signature"))
    sizes = F.length("word"), F.length("near")
    met = left.join(right, "signature").where((sizes[0] < sizes[1]) | ((sizes[0] == sizes[1]) & (F.col("word") < F.col("near"))))
    near = met.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")
    back = F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return near.select(F.inline(F.array(F.struct("word", "n", "near", "near_n"), back))).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form that is reached from each word of (word, form).

    Every form is ten times as frequent as its variant, so chains are short;
    each round doubles the steps taken.
    """
    reached = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = settled(reached.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if not further.where("moved").limit(1).count():
            return further.select("word", "root")
        reached = further.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of the vocabulary of ``docs`` (doc_id, text).

    ``form`` is the most frequent near word (ties: the least in code-point
    order) if it is at least ten times as frequent, else null. Extra columns
    are ignored; repeated rows count again; an empty table has no words.
    """
    vocab = settled(vocabulary(docs))
    best = F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best")
    near = links(vocab).groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = settled(vocab.join(near, "word", "left"))
    is_form = -F.col("best.least") >= FORM * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.least")).alias("form_n"))
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
