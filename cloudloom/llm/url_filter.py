"""URL filter: host and path rules first, then boosted trees on lexical features.

DataFrame functions only; the trees are Spark's own. They are fitted on labelled
URLs, by default a small table made by rule, and judge what no rule decides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_sample, settled

#: Labelled URLs that the trees are fitted on, at most about: those with the least hashes. Suffix statistics cover all.
TRAIN_URLS = 20_000
#: Rows of the table of labelled URLs that is used where none is given.
LABELLED_URLS = 6_000
#: Parts of the labelled URLs; the suffix statistics of each are those of the other parts.
FOLDS = 5
#: Most suffixes that are broadcast (about 40 bytes each).
BROADCAST_SUFFIXES = 200_000
TREES, DEPTH, SEED = 12, 4, 11
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._~:/?#&=%+@"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and its subdomains where the path begins with ``/path``."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.text.partition("/")
        return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))


# The rules of the registered query.
RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def with_rules(urls: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``urls`` (column ``url``) with host, path, and the longest fitting rule and its verdict (else null)."""
    host, path = host_and_path(F.col("url"))
    split = urls.withColumn("host", host).withColumn("path", path)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return split.withColumn("rule", rule).withColumn("rule_verdict", verdict)


#: Words that the labelled table draws names and paths from, wanted and unwanted (fixed values), and its suffixes.
_PLAIN = "news city garden river school museum recipes history travel science letters market theatre weather library sports music health photo village".split()
_LURES = "win bet free cheap pills bonus casino slots deal promo click loan rich prize offer vip hot sale gold cash".split()
_SUFFIXES = "com com com org org net de fr es info".split()


def labelled_urls(spark: SparkSession, n: int = LABELLED_URLS) -> DataFrame:
    """(url, blocked): ``n`` labelled URLs made by rule from a row number.

    Half are unwanted: host names of two or three lures with hyphens or digits,
    paths with many parameters or long codes. Wanted ones have plain names,
    some with a hyphen or a number, and paths of words or numbers. The label
    depends on no suffix, and one URL in fifty bears the other label.
    """
    pick = lambda words, salt: F.get(F.array(*[F.lit(w) for w in words]), F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(len(words))).cast("int"))
    draw = lambda salt, most: F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(most)).cast("int")
    bad = F.col("id") % 2 == 1
    scheme = F.when(draw("scheme", 3) == 0, "http://").otherwise("https://")
    front = F.get(F.array(*[F.lit(x) for x in ("", "www.", "m.", "blog.")]), draw("front", 4))
    lure = F.concat_ws("-", pick(_LURES, "a"), pick(_LURES, "b"), F.when(draw("c", 2) == 0, pick(_LURES, "c")))
    lure = F.concat(lure, F.when(draw("d", 3) == 0, draw("e", 1000).cast("string")).otherwise(""))
    plain = F.concat(pick(_PLAIN, "f"), F.when(draw("g", 20) == 0, F.concat(F.lit("-"), pick(_PLAIN, "h"))).otherwise(pick(["", "er", "s", "land", "hub"], "i")))
    between = F.when(draw("j", 2) == 0, ".example").otherwise("")
    host = F.concat(front, F.when(bad, lure).otherwise(plain), between, F.lit("."), pick(_SUFFIXES, "k"))
    code = F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 24)
    query = F.array_join(F.transform(F.sequence(F.lit(1), draw("l", 5) + 2), lambda k: F.concat(F.lit("q"), k, F.lit("="), draw("m", 9999))), "&")
    number = draw("n", 9_999).cast("string")
    path = F.when(bad & (draw("o", 3) == 0), F.concat(F.lit("/go?"), query)).when(bad & (draw("o", 3) == 1), F.concat(F.lit("/x/"), code))
    path = path.otherwise(F.concat(F.lit("/"), pick(["en", "de", "fr", "es", "a", "2024"], "p"), F.lit("/"), F.when(draw("q", 2) == 0, number).otherwise(pick(_PLAIN, "r"))))
    tail = pick(["", "", ".html", "/", "#top", "?page=2&ref=x", "?utm_source=feed"], "s")
    url = F.concat(scheme, host, path, F.when(bad & (draw("o", 3) < 2), "").otherwise(tail))
    label = (bad != (draw("t", 50) == 0)).cast("int")
    return spark.range(n).select(url.alias("url"), label.alias("blocked"))


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character over the characters of ``ALPHABET``, upper and lower case as one, all others as one more."""
    lower = F.lower(text)
    total = F.greatest(F.length(text), F.lit(1)).cast("double")
    counts = F.transform(F.array(*[F.lit(c) for c in ALPHABET]), lambda c: F.length(text) - F.length(F.replace(lower, c, F.lit(""))))
    bits = F.aggregate(
        counts,
        F.struct(F.lit(0.0).alias("bits"), F.length(text).alias("rest")),
        lambda acc, n: F.struct(
            F.when(n > 0, acc["bits"] - n / total * F.log2(n / total)).otherwise(acc["bits"]).alias("bits"), (acc["rest"] - n).alias("rest")
        ),
        lambda acc: F.when(acc["rest"] > 0, acc["bits"] - acc["rest"] / total * F.log2(acc["rest"] / total)).otherwise(acc["bits"]),
    )
    return bits


FEATURES = (
    "length", "depth", "digit_ratio", "entropy", "n_params", "query_length", "host_length", "host_labels", "host_hyphens",
    "host_digits", "path_hyphens", "suffix_block_rate", "suffix_log_count",
)


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the features of the url alone, and ``suffix``, the last label of the host."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    columns = {
        "length": F.length(url).cast("double"),
        "depth": _count(F.regexp_replace(F.col("path"), r"/+$", ""), "/"),
        "digit_ratio": _count(url, r"[0-9]") / F.greatest(F.length(url), F.lit(1)),
        "entropy": entropy(url),
        "n_params": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1),
        "query_length": F.length(query).cast("double"),
        "host_length": F.length("host").cast("double"),
        "host_labels": F.size(F.split("host", r"\.")).cast("double"),
        "host_hyphens": _count(F.col("host"), "-"),
        "host_digits": _count(F.col("host"), r"[0-9]"),
        "path_hyphens": _count(F.col("path"), "-"),
        "suffix": F.regexp_extract("host", r"[^.]*$", 0),
    }
    return urls.withColumns(columns)


def _fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("fold")), F.lit(FOLDS))


class UrlModel:
    """Suffix statistics and boosted trees; with one class among the labels it always gives that class."""

    def __init__(self, labelled: DataFrame, most: int = TRAIN_URLS, trees: int = TREES, depth: int = DEPTH):
        """``labelled``: columns url, host, path and blocked (0 or 1); about ``most`` rows are fitted at most.

        Suffix statistics count all labelled URLs. Those of a URL that is fitted
        leave out its own part of them, so that no label speaks for itself.
        """
        suffix = F.regexp_extract("host", r"[^.]*$", 0).alias("suffix")
        parts = labelled.groupBy(suffix, _fold(F.col("url")).alias("fold")).agg(F.sum("blocked").alias("bad"), F.count("*").alias("n"))
        parts = settled(parts)
        self.suffixes = settled(parts.groupBy("suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")))
        self.few = self.suffixes.count() <= BROADCAST_SUFFIXES
        classes = [r[0] for r in labelled.select("blocked").distinct().collect()]
        self.always = (classes or [0])[0] if len(classes) < 2 else None
        self.assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        if self.always is None:
            rows = lexical(hash_sample(labelled, most, F.col("url"))).withColumn("fold", _fold(F.col("url")))
            own = parts.select("suffix", "fold", F.col("bad").alias("own_bad"), F.col("n").alias("own_n"))
            rows = rows.join(F.broadcast(own) if self.few else own, ["suffix", "fold"], "left")
            fitted = self.assembler.transform(self._suffixed(rows, "own_bad", "own_n")).withColumn("label", F.col("blocked").cast("double"))
            self.model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=SEED).fit(settled(fitted.select("features", "label")))

    def _suffixed(self, rows: DataFrame, *own: str) -> DataFrame:
        """Adds the suffix statistics less a row's own share (columns ``own``); 0.5 and 0 for a suffix that is not known."""
        joined = rows.join(F.broadcast(self.suffixes) if self.few else self.suffixes, "suffix", "left")
        bad, n = (F.coalesce(F.col(c), F.lit(0)) for c in ("bad", "n"))
        if own:
            bad, n = bad - F.col(own[0]), n - F.col(own[1])
        return joined.withColumns({"suffix_block_rate": (bad + 1.0) / (n + 2.0), "suffix_log_count": F.log1p(n.cast("double"))})

    def scored(self, urls: DataFrame) -> DataFrame:
        """``urls`` with the chance (0 to 1) that they are to be blocked."""
        if self.always is not None:
            return urls.withColumn("block_score", F.lit(float(self.always)))
        found = self.model.transform(self.assembler.transform(self._suffixed(lexical(urls))))
        return found.select(*urls.columns, vector_to_array("probability")[1].alias("block_score"))

    def judge(self, urls: DataFrame) -> DataFrame:
        """``urls`` with a boolean ``model_blocks``."""
        return self.scored(urls).select(*urls.columns, (F.col("block_score") > 0.5).alias("model_blocks"))


def filter_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None,
    most: int = TRAIN_URLS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row; verdict is ``allow`` or ``block``.

    A fitting rule decides, the longest first; else the trees do. They are
    fitted on the different rows of ``labelled`` (url, blocked), by default
    :func:`labelled_urls`; rows with nulls are left out. Null urls and urls without ``://`` have empty host and
    path and are judged like any other; repeated rows are all returned, null ids
    stay null, other columns are ignored.
    """
    picked = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    ruled = with_rules(picked, rules)
    labelled = labelled_urls(pages.sparkSession) if labelled is None else labelled
    known = with_rules(labelled.select("url", F.col("blocked").cast("int").alias("blocked")).dropna().distinct(), rules)
    judged = UrlModel(known.select("url", "host", "path", "blocked"), most).judge(ruled)
    verdict = F.coalesce("rule_verdict", F.when(F.col("model_blocks"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
