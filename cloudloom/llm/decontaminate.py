"""Benchmark decontamination by question templates, in DataFrame functions only.

Numbers, units and names in a text become typed slots. Windows of template
tokens are hashed and joined with the benchmark's; hits of one document and one
item at one offset form an alignment. An alignment that covers enough tokens is
a leak if its slots are filled consistently: equal values of the question are
equal in the document too. So a verbatim copy and a copy with other numbers or
names are both found, and a text that merely shares a phrase is not. Windows
that are mostly slots say little by their template: they count where their
values are equal too, or in an alignment that is longer still. Windows without
any literal are not joined.

What a template makes of a word depends on its capital, so a copy in lower case
or in capitals has other templates. Windows of as many words as an alignment
must cover, without slots and in lower case, are joined beside those of the
templates; where all words are equal, the item is leaked as it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keys, settled, unused

#: Template tokens in a hashed window.
WINDOW = 8
#: Tokens that an alignment must cover. A shorter item may lack two, as its first and last word can read
#: differently in another sentence, but no fewer than a window; one shorter than a window must be whole.
COVER = 13
#: Literal tokens, of eight, from which a window counts whatever its slots hold.
LITERAL = 5
#: Tokens (or the item but two, if it is longer than a window) that an alignment of any windows must cover where values differ;
#: ``LITERAL`` of them are literal.
LONG = 20
#: Most benchmark windows that are broadcast (about 40 bytes each), and most matched documents (16 bytes each).
BROADCAST_WINDOWS = 200_000
BROADCAST_DOCS = 1_000_000
#: Unit words after a number (fixed values).
UNITS = (
    r"%|percent|mm|cm|dm|m|km|mg|g|kg|t|ml|cl|l|s|ms|h|min|hz|khz|mhz|ghz|w|kw|mw|v|a|j|kj|k|°c|°f|°|kb|mb|gb|tb|"
    r"inch|inches|foot|feet|ft|yards?|miles?|met(?:er|re)s?|kilomet(?:er|re)s?|grams?|kilograms?|tons?|lit(?:er|re)s?|"
    r"seconds?|minutes?|hours?|days?|weeks?|months?|years?|degrees?|dollars?|euros?|cents?|pounds?|usd|eur|gbp|€|£|\$"
)
#: Words after which a capitalised word is a noun of a language that writes nouns so, not a name (fixed values).
BEFORE_NOUNS = (
    "der|die|das|des|dem|den|ein|eine|einen|einem|einer|eines|kein|keine|keinen|keinem|keiner|im|am|ans|ins|zum|zur|vom|beim|"
    "jede|jeder|jedes|jeden|jedem|diese|dieser|dieses|diesen|diesem|alle|viele|wenige|einige|mehrere|mehr|sein|seine|seinen|seinem|seiner|"
    "ihr|ihre|ihren|ihrem|ihrer|wie"
)
# The look-aheads at their beginnings ask nothing new; they spare most places the looks behind.
_NUMBER = r"(?=\p{N})(?<![\p{L}\p{N}])\p{N}(?:[\p{N}.,:/]*\p{N})?(?![\p{L}\p{N}])"
_UNIT = rf"(?<=⟧) ?((?i:{UNITS}))(?![\p{{L}}\p{{N}}])"
# Not after an article either, nor right after a number, where a noun that is counted stands.
_NAME = rf"(?=\p{{Lu}})(?<=[\p{{L}}\p{{N}},;⟧] )(?<!(?<!\p{{L}})(?i:{BEFORE_NOUNS}) )(?<!⟦n[^⟧]{{1,40}}⟧ )\p{{Lu}}\p{{L}}*"
_TOKEN = r"⟦[^⟧]*⟧|[\p{L}\p{N}]+"


def template_tokens(text: Column) -> Column:
    """Lower-case tokens of a text; a slot is ``⟦`` + type (n, u or a) + value + ``⟧``.

    A name is a capitalised word that follows a word, a unit or a comma, so not
    the first of a sentence; after an article or a number it is a noun. Names
    with nothing but a blank between them are one. Punctuation is dropped. A
    null text has no tokens.
    """
    marked = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _NUMBER, "⟦n$0⟧")
    marked = F.regexp_replace(marked, _UNIT, " ⟦u$1⟧")
    marked = F.regexp_replace(marked, _NAME, "⟦a$0⟩⟧")
    marked = F.replace(F.replace(marked, F.lit("⟩⟧ ⟦a"), F.lit(" ")), F.lit("⟩⟧"), F.lit("⟧"))
    return F.regexp_extract_all(F.lower(marked), F.lit(_TOKEN), F.lit(0))


def _is_slot(token: Column) -> Column:
    return F.startswith(token, F.lit("⟦"))


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(F.when(_is_slot(t), F.substring(t, 1, 2)).otherwise(t)))


def _words(text: Column) -> Column:
    """All words of a text in lower case, without slots."""
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _paired(hashes: Column, step: int) -> Column:
    """Hash of each element and the one ``step`` places on, in order."""

    def pairs(held: Column) -> Column:
        n = F.greatest(F.size(held) - step, F.lit(0))
        return F.zip_with(F.slice(held, 1, n), F.slice(held, step + 1, n), lambda a, b: F.xxhash64(a, b))

    return F.get(F.transform(F.array(hashes), pairs), 0)  # so the elements are computed once, not for each of their uses


def _windows(hashes: Column, size: int) -> Column:
    """Hash of each window of ``size`` tokens, in order, by pairs of shorter windows; the last two may overlap."""
    width = 1
    while width < size:
        step = min(width, size - width)
        hashes, width = _paired(hashes, step), width + step
    return hashes


def _sized_windows(hashes: Column, size: Column, most: int) -> Column:
    """The same, for a size of 1 to ``most`` that a column holds."""
    return F.coalesce(*[F.when(size == k, _windows(hashes, k)) for k in range(1, most + 1)])


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, tokens, size, at, h): an item's windows.

    Items shorter than a window are one window of their own size. The only
    window of an item has a second hash, with a name as first token, as its
    first word can read like one inside another sentence. Items with a null id
    or without tokens are left out.
    """
    picked = items.select(F.col(id_col).cast("long").alias("item_id"), template_tokens(F.col(text_col)).alias("tokens"))
    sized = picked.where("item_id is not null and size(tokens) > 0").distinct().withColumn("size", F.least(F.size("tokens"), F.lit(window)))
    hashed = sized.withColumn("hashes", _hashes(F.col("tokens")))
    named = F.concat(F.array(F.xxhash64(F.lit("⟦a"))), F.slice("hashes", 2, window))
    places = F.transform(_sized_windows(F.col("hashes"), F.col("size"), window), lambda h, i: F.struct((i + 1).alias("at"), h.alias("h")))
    renamed = F.get(_sized_windows(named, F.col("size"), window), 0)
    second = F.when(F.size("hashes") == F.col("size"), F.array(F.struct(F.lit(1).alias("at"), renamed.alias("h"))))
    rows = hashed.select("item_id", "tokens", "size", F.explode(F.array_union(places, F.coalesce(second, F.slice(places, 1, 0)))).alias("w"))
    rows = rows.select("item_id", "tokens", "size", "w.at", "w.h")
    return rows.where(_n_literal(F.slice("tokens", F.col("at"), F.col("size"))) > 0)


def _verbatim_windows(items: DataFrame, id_col: str, text_col: str, cover: int) -> DataFrame:
    """(item_id, words, at, size, h): windows of ``cover`` words of each item, or the whole shorter one."""
    picked = items.select(F.col(id_col).cast("long").alias("item_id"), _words(F.col(text_col)).alias("words"))
    sized = picked.where("item_id is not null and size(words) > 0").distinct().withColumn("size", F.least(F.size("words"), F.lit(cover)))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    found = F.posexplode(_sized_windows(F.col("hashes"), F.col("size"), cover)).alias("p", "h")
    rows = sized.withColumn("hashes", hashes).select("item_id", "words", "size", found).withColumn("at", F.col("p") + 1)
    return rows.select("item_id", F.slice("words", F.col("at"), F.col("size")).alias("words"), "at", "size", "h")


def _covered(places: Column, size: Column) -> Column:
    """Tokens that windows of ``size`` at these places cover."""
    ordered = F.array_sort(places)
    gaps = F.transform(ordered, lambda p, i: F.when(i == 0, size).otherwise(F.least(size, p - F.get(ordered, i - 1))))
    return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)


def _plain(tokens: Column) -> Column:
    """Tokens without their slots' marks."""
    return F.transform(tokens, lambda t: F.when(_is_slot(t), t.substr(F.lit(3), F.length(t) - 3)).otherwise(t))


def _n_literal(tokens: Column) -> Column:
    return F.size(F.filter(tokens, lambda t: ~_is_slot(t)))


def _consistent(pairs: Column) -> Column:
    """Whether (item slot, document slot) pairs map each value to one; names also the other way."""

    def one_way(pairs: Column, side: str) -> Column:
        return F.size(F.array_distinct(F.transform(pairs, lambda p: p[side]))) == F.size(F.array_distinct(pairs))

    names = F.filter(pairs, lambda p: F.startswith(p["theirs"], F.lit("⟦a")))
    return one_way(pairs, "theirs") & one_way(names, "ours")


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, cover: int = COVER, broadcast_windows: int = BROADCAST_WINDOWS, broadcast_docs: int = BROADCAST_DOCS,
) -> DataFrame:
    """(doc_id, k1, k2, item_id, n_tokens): one row for each document and item that it leaks, by its templates or else word by word.

    k1 and k2 stand for the row's id and text; repeated rows give one row. Whole
    texts are searched. Null and empty texts and items leak nothing; documents
    with a null id are reported with it. Other columns are ignored.
    """
    bench = settled(benchmark_windows(items, item_id_col, item_text_col, window))
    exact = settled(_verbatim_windows(items, item_id_col, item_text_col, cover))
    few = bench.count() + exact.count() <= broadcast_windows
    sizes = [("template", r[0]) for r in bench.select("size").distinct().collect()]  # at most ``window`` values
    sizes += [("words", r[0]) for r in exact.select("size").distinct().collect()]  # at most ``cover``
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keys(F.col(id_col).cast("long"), text), text.alias("text"))
    if not sizes:
        return rows.where("false").select("doc_id", "k1", "k2", F.lit(0).cast("long").alias("item_id"), F.lit(0).alias("n_tokens"))
    hashed = rows.select("k1", "k2", _hashes(template_tokens(F.col("text"))).alias("template"), F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))
    # windows of every kind and size, one after the other, in one pass over the texts; ``begin`` is where each kind's begin, and their end
    begin, before = [F.lit(0)], F.lit(0)
    for kind, size in sizes:
        before = before + F.greatest(F.size(kind) - (size - 1), F.lit(0))
        begin.append(before)
    hashed = hashed.select("k1", "k2", "template", "words", F.array(*begin).alias("begin"))
    ours = hashed.select("k1", "k2", "begin", F.posexplode(F.concat(*[_windows(F.col(kind), size) for kind, size in sizes])).alias("p", "h"))
    numbers = {kind: F.create_map(*[x for k, (name, size) in enumerate(sizes) if name == kind for x in (F.lit(size), F.lit(k))]) for kind, _ in sizes}
    theirs = None
    for kind, table in (("template", bench), ("words", exact)):
        if kind in numbers:
            part = table.select(F.lit(kind).alias("kind"), numbers[kind][F.col("size")].alias("which"), "h", "item_id", "size", F.col("at").alias("item_at"))
            theirs = part if theirs is None else theirs.unionByName(part)
    if few:  # by the hash alone, a single number; whether the window is of the same kind and size is asked only where hashes are equal
        begins, ends = F.get("begin", "which"), F.get("begin", F.col("which") + 1)
        met = ours.join(F.broadcast(theirs), "h").where((F.col("p") >= begins) & (F.col("p") < ends)).withColumn("at", F.col("p") - begins + 1)
    else:  # ``begin`` is not shuffled
        which = sum((F.when(F.col("p") >= F.get("begin", k), 1).otherwise(0) for k in range(1, len(sizes))), F.lit(0))
        met = ours.select("k1", "k2", "h", which.alias("which"), (F.col("p") - F.get("begin", which) + 1).alias("at")).join(theirs, ["which", "h"])
    alignments = met.groupBy("kind", "k1", "k2", "item_id", "size", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.collect_set("item_at").alias("places"))
    alignments = settled(alignments)
    hits = alignments.where("kind = 'template'").drop("kind")
    aligned = hits.withColumn("n_tokens", _covered(F.col("places"), F.col("size")))
    tokens = bench.select("item_id", F.col("tokens").alias("theirs")).distinct()
    long = settled(
        aligned.join(F.broadcast(tokens) if few else tokens, "item_id").where(
            F.col("n_tokens") >= F.least(F.lit(cover), F.greatest(F.col("size"), F.size("theirs") - 2))
        )
    )
    copied = alignments.where("kind = 'words'").select("k1", "k2", "item_id", "shift", F.explode("places").alias("at"))
    copied = copied.groupBy("k1", "k2", "item_id", "shift").agg(F.min("at").alias("at"))
    met = long.select("k1", "k2").union(copied.select("k1", "k2")).distinct()
    near = rows.join(F.broadcast(met) if long.count() + copied.count() <= broadcast_docs else met, ["k1", "k2"], "left_semi")
    near = settled(near.dropDuplicates(["k1", "k2"]).select("k1", "k2", "doc_id", template_tokens(F.col("text")).alias("ours"), _words(F.col("text")).alias("our_words")))
    asked = exact.select("item_id", "at", "size", F.col("words").alias("theirs"))
    copies = copied.join(F.broadcast(asked) if few else asked, ["item_id", "at"]).join(near, ["k1", "k2"])
    copies = copies.where(F.slice("our_words", F.col("at") + F.col("shift"), F.col("size")) == F.col("theirs"))
    copies = copies.select("doc_id", "k1", "k2", "item_id", F.col("size").alias("n_tokens"))
    judged = long.join(near, ["k1", "k2"]).withColumns({"our_values": _plain(F.col("ours")), "their_values": _plain(F.col("theirs"))})
    size, whole = F.col("size"), F.size("theirs")
    theirs_at = lambda p: F.slice("theirs", p, size)
    equal = lambda p: F.slice("their_values", p, size) == F.slice("our_values", p + F.col("shift"), size)
    literals_equal = lambda p: F.forall(
        F.sequence(p, p + size - 1),
        lambda i: _is_slot(F.get("theirs", i - 1)) | (F.get("theirs", i - 1) == F.get("our_values", i - 1 + F.col("shift"))),
    )
    judged = judged.withColumn("places", F.filter("places", literals_equal))
    judged = judged.withColumns(
        {
            "firm": F.filter("places", lambda p: _n_literal(theirs_at(p)) * WINDOW >= size * LITERAL),
            "same": F.filter("places", equal),
        }
    ).withColumn("both", F.array_union("firm", "same"))
    enough = F.least(F.lit(cover), F.greatest(size, whole - 2))

    def tokens_of(places: str, least: Column, n_literal: int = 0) -> Column:
        """Tokens that these places cover, null if they make no leak."""
        covered = F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p, p + size - 1))))
        pairs = F.transform(
            covered, lambda i: F.struct(F.get("theirs", i - 1).alias("theirs"), F.get("ours", i - 1 + F.col("shift")).alias("ours"))
        )
        fits = _consistent(F.filter(pairs, lambda p: _is_slot(p["theirs"]))) & (_n_literal(pairs["theirs"]) >= n_literal)
        n_tokens = _covered(F.col(places), size)
        return F.when((n_tokens >= least) & fits, n_tokens)

    longer = F.when(whole > window, F.greatest(enough, F.least(F.lit(LONG), whole - 2)))
    found = F.greatest(*[tokens_of(p, enough) for p in ("firm", "same", "both")], tokens_of("places", longer, LITERAL))
    by_template = judged.withColumn("n_tokens", found).select("doc_id", "k1", "k2", "item_id", "n_tokens", F.lit(None).cast("int").alias("n_words"))
    by_words = copies.select("doc_id", "k1", "k2", "item_id", F.lit(None).cast("int").alias("n_tokens"), F.col("n_tokens").alias("n_words"))
    leaks = by_template.unionByName(by_words).groupBy("doc_id", "k1", "k2", "item_id").agg(F.coalesce(F.max("n_tokens"), F.max("n_words")).alias("n_tokens"))
    return leaks.where("n_tokens is not null")  # after the maximum, as a filter on ``found`` would repeat all its steps


def contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, n_items, n_tokens, items): one row for each document that leaks any item; items is comma-joined."""
    found = find_leaks(docs, items, **options)
    each = found.groupBy("doc_id", "k1", "k2").agg(
        F.count("*").alias("n_items"), F.max("n_tokens").cast("long").alias("n_tokens"), F.array_sort(F.collect_list("item_id")).alias("ids")
    )
    return each.select("doc_id", "n_items", "n_tokens", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("items"))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all columns."""
    found = settled(find_leaks(docs, items, id_col, text_col, **options).select("k1", "k2").distinct())
    few = found.count() <= options.get("broadcast_docs", BROADCAST_DOCS)
    names = unused(docs, 2)
    k1, k2 = keys(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    keyed = docs.withColumns(dict(zip(names, (k1, k2))))
    found = found.toDF(*names)
    return keyed.join(F.broadcast(found) if few else found, names, "left_anti").drop(*names)
