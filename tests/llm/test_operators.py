"""Each operator against a plain version of its contract, on a small table or on made-up cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cloudloom.llm import automaton, bpe, crf, decontaminate, html_text, importance, pii, pii_examples, quality_rules, queries, secret_scan, simhash, substrings, url_filter
from cloudloom.llm.graph import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


class Sets:
    """Disjoint sets by least member."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.up[y] = x


# --- 1: quality rules


def test_base_measures(spark, sf_dir, rows):
    found = {r.doc_id: r for r in queries.op1_line_frequency(spark, sf_dir).collect()}
    for doc_id, text in rows:
        words = WORD.findall(text)
        windows = list(zip(words, words[1:], words[2:]))
        counts = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        r = found[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.base_failed and r.kept)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_against_sql(spark, sf_dir, name):
    import duckdb

    for folder in (sf_dir, "/root/testdata/sf0.01"):
        duck = duckdb.connect()
        duck.sql(f"create view documents as select * from '{folder}/documents.parquet'")
        found = queries.QUERIES[name](spark, folder)
        want = duck.sql(queries.ORACLE_SQL[name])
        assert sorted(want.columns) == sorted(found.columns)
        assert sorted(map(tuple, found.collect())) == sorted(want.select(*found.columns).fetchall())


def own(k, n=70):
    return " ".join(f"d{k}w{j}" for j in range(n))


def test_frequent_lines_go_and_depleted_documents_too(docs_of):
    boiler = "Subscribe to OUR  letter 2024"
    docs = [(k, f"{own(k)}\n{boiler if k % 2 else boiler.lower().replace('2024', '1999')}") for k in range(20)]
    filler = "\n".join(f"menu entry number {own(j, 12)}" for j in range(1000, 1008))
    docs += [(100 + k, own(100 + k, 40) + "\n" + filler) for k in range(8)]
    other = [(200, own(200) + "\n" + boiler, "s1")]
    copies = [(300 + k, own(300, 200)) for k in range(40)]
    table = docs_of(docs + other + copies)
    for most in (quality_rules.BROADCAST_LINES, 0):
        found = {r.doc_id: r for r in quality_rules.apply_rules(table, broadcast_lines=most).collect()}
        assert all(found[k].kept and found[k].n_removed_words == 5 and found[k].clean == own(k) for k in range(20))
        assert all(not found[100 + k].kept and not found[100 + k].base_failed for k in range(8))
        assert found[200].n_removed_words == 0  # another host
        assert all(found[300 + k].kept and found[300 + k].n_removed_words == 0 for k in range(40))
        kept = {r.doc_id: r for r in quality_rules.keep_good(table, broadcast_lines=most).collect()}
        assert set(kept) == {k for k, r in found.items() if r.kept} and kept[3].text == own(3) and kept[3].n_chars == len(own(3))


def test_documents_that_share_most_of_their_text_are_counted_apart(docs_of):
    shared = "\n".join(own(j, 20) for j in range(1000, 1009))
    docs = docs_of([(k, f"{shared}\n{own(k, 40)}") for k in range(20)] + [(100 + k, f"{shared}\n{own(0, 40).upper()}") for k in range(20)])
    counts = {r.line: r.n_docs for r in quality_rules.frequent_lines(docs).collect()}
    assert counts == {quality_rules.line_hash(own(j, 20).encode()): 20 for j in range(1000, 1009)}
    assert all(r.n_removed_words == 180 and not r.kept for r in quality_rules.apply_rules(docs).collect())


def test_share_is_of_distinct_documents_in_a_host_of_copies(docs_of):
    line = own(5000, 10)
    docs = docs_of([(k, own(0)) for k in range(985)] + [(1000 + k, f"{own(k)}\n{line}") for k in range(1, 16)])
    for most in (quality_rules.BROADCAST_LINES, 0):
        found = {r.doc_id: r for r in quality_rules.apply_rules(docs, broadcast_lines=most).collect()}
        assert all(found[1000 + k].n_removed_words == 10 and found[1000 + k].clean == own(k) for k in range(1, 16))
        assert found[0].kept and found[0].n_removed_words == 0
    assert [tuple(r) for r in quality_rules.frequent_lines(docs).collect()] == [("s0", quality_rules.line_hash(line.encode()), 15)]


# --- 2: secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
BASE = [("assign", ASSIGN, lambda m: len(m[2]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]


def plain_secrets(text):
    found = sorted((m.start(), i, k, m.end()) for i, (k, p, good) in enumerate(BASE) for m in p.finditer(text) if good(m))
    return [(k, a, b) for a, _, k, b in found]


def test_secrets_of_the_table(spark, sf_dir, rows):
    found = {r.doc_id: r for r in queries.op2_secret_automaton(spark, sf_dir).collect()}
    for doc_id, text in rows:
        want = plain_secrets(text)
        assert found[doc_id].base_sha256 == digest(want)
        assert (found[doc_id].n_assign, found[doc_id].n_access, found[doc_id].n_hex) == tuple(sum(k == n for k, *_ in want) for n in ("assign", "access", "hex"))


PIECES = ["password", "passwd", "Secret", "toKen", "api_key", "apikey", "'", '"', ":", "=", " ", "  ", "abcdefgh12345", "ABC.-/+_=", "deadbeef" * 4, "0123456789abcdef", "AKIA", "AKIA1234567890AB", "Z" * 9, "é", "x", "ſecret", "toKen"]


@pytest.fixture(scope="module")
def finder():
    return secret_scan.SecretFinder()


def test_secrets_of_made_up_texts(finder):
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices(PIECES, k=rng.randint(1, 14)))
        assert [s for s in finder.spans(text.encode()) if s[0] in secret_scan.BASE_KINDS] == plain_secrets(text), text


def test_other_keys_are_found(finder):
    text = "x ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY----- xoxb-123456789012-ab"
    assert [k for k, *_ in finder.spans(text.encode())] == ["code_host", "pem", "chat"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["ab*c", "a{2,3}", "(ab|b)+c?", "[a-c]{2}", "c", "b(a|c)*b"]), min_size=1, max_size=3, unique=True), st.text("abc", max_size=30))
def test_automaton_is_leftmost_longest(patterns, text):
    scanner = automaton.RuleScanner([(p, False) for p in patterns])
    found = scanner.matches(text.encode())
    for k, p in enumerate(patterns):
        want, at = [], 0
        while at < len(text):
            ends = [e for e in range(len(text), at, -1) if re.fullmatch(p, text[at:e])]
            if ends:
                want.append((k, at, ends[0]))
                at = ends[0]
            else:
                at += 1
        assert [f for f in found if f[0] == k] == want


# --- 3: decontamination

QUESTION = "A farmer sells 12 apples to Maria and then 7 pears to Maria at the old market before noon"


def test_reparameterised_questions_are_found_and_inconsistent_ones_not(spark, docs_of):
    bench = spark.createDataFrame([(1, QUESTION), (2, "tiny item")], "item_id long, text string")
    docs = docs_of(
        [
            (1, own(1) + " " + QUESTION + " " + own(2)),
            (2, own(3) + ". " + QUESTION.replace("12", "450").replace("7", "31").replace("Maria", "Jonas") + " " + own(4)),
            (3, own(5) + ". " + QUESTION.replace("Maria", "Jonas", 1) + " " + own(6)),
            (4, own(7)),
            (5, own(8) + " A farmer sells 12 apples to Maria " + own(9)),
            (6, own(8) + " tiny item " + own(9)),
        ]
    )
    # Inside another sentence the first word of an item reads like a name.
    short = spark.createDataFrame([(1, "Pour one cup of water over twelve beans and stir until done")], "item_id long, text string")
    inside = docs_of([(1, own(1) + " Pour one cup of water over twelve beans and stir until done " + own(2))])
    assert decontaminate.contaminated(inside, short).first().n_tokens == 11
    for options in ({}, {"broadcast_windows": 0, "broadcast_docs": 0}):
        found = {(r.doc_id, r["items"]) for r in decontaminate.contaminated(docs, bench, **options).collect()}
        assert found == {(1, "1"), (2, "1"), (6, "2")}
    assert {r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()} == {3, 4, 5}


def test_items_rich_in_slots_are_found(spark, docs_of):
    race = "Tom ran 5 km in 30 minutes and Ann ran 8 km in 50 minutes on Monday 12 May 2020."
    texts = [race, "What is 15 percent of 240?", "Compute 12 + 34 + 56 + 78 + 90.", "What is 3 times 4?", "The sum 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = [(k, f"{own(k)} {t} {own(50 + k)}") for k, t in enumerate(texts)] + [(10 + k, f"{own(k)}. {t}") for k, t in enumerate(texts)]
    other = race.replace("5 km", "7 km").replace("30", "45").replace("8 km", "9 km").replace("50 m", "70 m").replace("Ann", "Eve")
    docs += [(20, f"{own(20)}. {other} {own(21)}"), (21, f"{own(22)}. {other.replace('km in 70', 'm in 70')} {own(23)}")]
    docs += [(22, own(24) + ". What is 3 times 5? Compute 1 + 2 + 3 + 4 + 5. What is 16 percent of 240?"), (23, own(25) + " Jon is 3 times 4?")]
    docs += [(24, own(26) + ". The sum " + " ".join(map(str, range(20, 40))))]
    want = {(k + more, str(k)) for k in range(5) for more in (0, 10)} | {(20, "0")}
    for options in ({}, {"broadcast_windows": 0, "broadcast_docs": 0}):
        assert {(r.doc_id, r["items"]) for r in decontaminate.contaminated(docs_of(docs), bench, **options).collect()} == want


def test_windows_are_hashed_by_pairs_of_shorter_ones(spark):
    rng = random.Random(3)
    rows = [[rng.randrange(2) for _ in range(n)] for n in [*range(20), 60, 200]]
    table = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, h array<long>")
    for size in (1, 2, 5, 8, 13):
        found = table.select("k", decontaminate._windows(table.h, size).alias("w"))
        assert found._jdf.queryExecution().optimizedPlan().toString().split("\n")[0].count("h#") == 1  # no work that is done for each use
        windows = [(tuple(rows[r.k][i : i + size]), h) for r in found.collect() for i, h in enumerate(r.w)]
        assert len(windows) == sum(max(0, len(r) - size + 1) for r in rows)
        assert len(set(windows)) == len({w for w, _ in windows}) == len({h for _, h in windows})


def test_leaks_of_the_table(spark, sf_dir, rows):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    words = {i.item_id: re.findall(r"\w+", i.text.lower()) for i in bench}
    grams = {}
    for i, w in words.items():
        for k in range(len(w) - 12):
            grams.setdefault(tuple(w[k : k + 13]), set()).add(i)
    want = {}
    for doc_id, text in rows:
        w = re.findall(r"\w+", text.lower())
        for k in range(len(w) - 12):
            for i in grams.get(tuple(w[k : k + 13]), ()):
                want.setdefault(doc_id, set()).add(i)
    found = {r.doc_id: set(map(int, r["items"].split(","))) for r in queries.op3_template_leaks(spark, sf_dir).collect()}
    assert found == want


# --- 4: urls


def plain_rule(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for text, verdict in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")):
        name, _, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(text), text, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules_of_urls(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = {r.page_id: r for r in queries.op4_boosted_url_filter(spark, sf_dir).collect()}
    assert set(found) == set(pages)
    for page_id, url in pages.items():
        host, path, rule, verdict = plain_rule(url)
        r = found[page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(4)

    def url(bad):
        host = "-".join(f"{rng.choice(['win', 'bet', 'pill'])}{rng.randrange(999)}" for _ in range(3)) if bad else rng.choice(["news", "wiki", "shop"])
        return f"http://{host}.example.org/{'x' * rng.randrange(20)}{'?' + '&'.join(f'q{k}={rng.randrange(99)}' for k in range(5)) if bad else ''}"

    labelled = spark.createDataFrame([(url(k % 2), k % 2) for k in range(600)], "url string, blocked int")
    held = [(k, url(k % 2)) for k in range(200)]
    found = {r.page_id: r.verdict for r in url_filter.filter_urls(spark.createDataFrame(held, "page_id long, url string"), labelled=labelled).collect()}
    assert sum(found[k] == ("block" if k % 2 else "allow") for k in found) >= 190


def test_held_out_urls_of_the_labelled_table(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.sql import functions as F

    rows = url_filter.with_rules(url_filter.labelled_urls(spark)).select("url", "host", "path", "blocked").distinct().withColumn("part", url_filter._fold(F.col("url")))
    model = url_filter.UrlModel(rows.where("part > 0").drop("part"))
    found = model.scored(rows.where("part = 0").drop("part")).select("block_score", F.col("blocked").cast("double").alias("label"))
    assert BinaryClassificationEvaluator(rawPredictionCol="block_score").evaluate(found) > 0.95
    suffixes = {r.suffix: (r.bad, r.n) for r in model.suffixes.collect()}
    want = Counter()
    for r in rows.where("part > 0").collect():
        want[r.host.rsplit(".", 1)[-1], r.blocked] += 1
    assert suffixes == {s: (want[s, 1], want[s, 0] + want[s, 1]) for s in {k for k, _ in want}}


def test_verdicts_do_not_follow_the_suffix(spark, sf_dir):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = [r for r in url_filter.filter_urls(pages).collect() if r.rule is None]
    lure = re.compile(r"casino|bets|pills|spam|ads-")
    for suffix in ("com", "org"):
        own = [(bool(lure.search(r.host)), r.verdict) for r in found if r.host.endswith(suffix)]
        assert sum(v == "allow" for bad, v in own if not bad) >= 0.95 * sum(not bad for bad, _ in own)
        assert sum(v == "block" for bad, v in own if bad) >= 0.6 * sum(bad for bad, _ in own)


def test_entropy(spark):
    import math

    from pyspark.sql import functions as F

    for text in ("", "aaaa", "http://ab.example.org/q?x=1", "ééa"):
        got = spark.createDataFrame([(text,)], "t string").select(url_filter.entropy(F.col("t"))).first()[0]
        counts = Counter("é" if c not in url_filter.ALPHABET else c for c in text.lower())
        assert math.isclose(got, -sum(n / len(text) * math.log2(n / len(text)) for n in counts.values()), abs_tol=1e-9)


# --- 5: importance resampling


def test_weights_are_likelihood_ratios_and_the_sample_is_exact(spark, docs_of):
    good = [(k, " ".join(random.Random(k).choices(["sun", "sea", "sand", "sky"], k=60))) for k in range(60)]
    bad = [(100 + k, " ".join(random.Random(k).choices(["%%", "##", "@@", "!!"], k=60))) for k in range(20)]
    labels = spark.createDataFrame([(k, 1) for k in range(30)] + [(100 + k, 0) for k in range(10)], "doc_id long, quality int")
    found = importance.resample(docs_of(good + bad), labels).collect()
    kept = {r.doc_id for r in found if r.kept}
    assert kept == set(range(60))
    top = sorted(found, key=lambda r: -r.gumbel_key)[:60]
    assert {r.doc_id for r in top} == kept
    counts = np.zeros((2, importance.BUCKETS))
    memo = importance.Memo(importance.zlib.crc32)
    for k, text in good + bad:
        b = importance.buckets(text.encode().split(), memo)
        np.add.at(counts[0], b, 1)
        if k < 30:
            np.add.at(counts[1], b, 1)
    raw = (counts[0] + 1) / (counts[0] + 1).sum()
    p = np.log((counts[1] + importance.BUCKETS * raw) / (counts[1].sum() + importance.BUCKETS)) - np.log(raw)
    r = next(r for r in found if r.doc_id == 7)
    assert abs(r.log_weight - p[importance.buckets(good[7][1].encode().split(), memo)].sum()) < 1e-9


def test_threshold_is_the_kth_largest(spark):
    rng = random.Random(2)
    values = [rng.choice([1.0, 2.0, rng.gauss(0, 1e6), rng.gauss(0, 1e-9)]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 77, 250, 499, 500, 900):
        assert importance.top_threshold(df, "v", k) == sorted(values, reverse=True)[min(k, 500) - 1]
    assert importance.top_threshold(df, "v", 0) is None


def test_held_out_labels_are_told_apart(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r.doc_id: r.log_weight for r in importance.resample(docs, labels.where("doc_id % 2 = 0")).collect()}
    held = [(found[r.doc_id], r.quality) for r in labels.where("doc_id % 2 = 1").collect()]
    pairs = [(g > b) + 0.5 * (g == b) for g, q in held if q for b, p in held if not p]
    assert sum(pairs) / len(pairs) > 0.9


# --- 6: near duplicates


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(spark, sf_dir, rows):
    found = {r.doc_id: r for r in queries.op6_simhash_gray_index(spark, sf_dir).collect()}
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    sets = Sets(prints)
    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                sets.join(a, b)
    assert {k: (r.fingerprint, r.component_id) for k, r in found.items()} == {k: (f"{prints[k]:016x}", sets.find(k)) for k in ids}


@pytest.mark.parametrize("limit", [1024, 2])
def test_no_link_is_lost(spark, limit):
    rng = random.Random(1)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            v = base
            for _ in range(rng.randint(0, 5)):
                v ^= 1 << rng.randrange(64)
            prints.add(v - (1 << 64) if v >> 63 else v)
    prints = sorted(prints)
    table = spark.createDataFrame([(v,) for v in prints], "fp long")
    found = {r.node: r.root for r in connected_components(simhash.hamming_links(table, 2, node_limit=limit)).collect()}
    sets = Sets(prints)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                sets.join(a, b)
    assert {v: found.get(v, v) for v in prints} == {v: sets.find(v) for v in prints}


AS_PLANNED_FOR_LARGE = {
    "read by map tasks": {"spark.sql.adaptive.autoBroadcastJoinThreshold": "10m"},
    "split partitions": {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    },
}


@pytest.mark.parametrize("how", AS_PLANNED_FOR_LARGE)
def test_nodes_stay_whole_however_their_join_is_read(spark, how):
    rng = random.Random(4)
    prints = set()
    for _ in range(1500):
        base = rng.getrandbits(63)
        prints |= {base, base ^ 1 << rng.randrange(63), base ^ 1 << rng.randrange(63) ^ 1 << rng.randrange(63)}
    prints = sorted(prints)
    rng.shuffle(prints)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"} | AS_PLANNED_FOR_LARGE[how]
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        table = spark.createDataFrame([(v,) for v in prints], "fp long").repartition(8)
        found = {r.node: r.root for r in connected_components(simhash.hamming_links(table, 2)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    fps = np.array(prints, np.uint64)
    sets = Sets(prints)
    for k, v in enumerate(prints):
        for other in fps[np.bitwise_count(fps ^ fps[k]) <= 2].tolist():
            sets.join(v, other)
    assert {v: found.get(v, v) for v in prints} == {v: sets.find(v) for v in prints}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in connected_components(edges).collect()}
    assert found == {k: 0 for k in range(201)} | {500: 500, 501: 500}


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.integers(0, 4))
def test_gray_index_finds_all(values, distance):
    fps = np.array(sorted(values), np.uint64)
    q, at = simhash.GrayIndex(fps).near(fps, distance)
    want = {(i, j) for i, a in enumerate(fps.tolist()) for j, b in enumerate(fps.tolist()) if (a ^ b).bit_count() <= distance}
    assert set(zip(q.tolist(), at.tolist())) == want


def plain_kept(texts, shingle=5, similarity=0.8):
    """The least id of each group, by the similarity of all pairs."""
    words = [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    sets = [{tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} for w in words]
    groups = Sets(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common >= similarity * (len(a) + len(sets[j]) - common):
                groups.join(i, j)
    return {groups.find(k) for k in range(len(texts))}


@pytest.mark.parametrize("limit", [simhash.NODE_LIMIT, 12])
def test_near_copies_against_all_pairs(docs_of, limit):
    rng = random.Random(12)
    texts = []
    for k in range(40):
        base = own(k, rng.randint(60, 400)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 40)):  # up to a similarity of about 0.78
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    base = own(500, 300).split()
    for k in range(80):  # a large group, each a link or two from the next
        copy = list(base)
        copy[k * 3] = f"new{k}"
        texts.append(" ".join(copy))
    texts += ["", None, "one", "one", "one two", "a b c d", "a b c e", own(600, 300) + "\n" + own(601, 300), own(600, 300), own(601, 300)]
    kept = {r.doc_id for r in simhash.one_of_each(docs_of(list(enumerate(texts))), node_limit=limit).collect()}
    want = plain_kept(texts)
    assert want <= kept and len(kept - want) <= 0.1 * (len(texts) - len(want))


@pytest.mark.parametrize("sample", [simhash.SAMPLE, 1])
def test_no_near_copy_is_left_out(docs_of, monkeypatch, sample):
    """Links at the least similarity, that fingerprints may not show, in nodes that are divided, and under shingles that all texts share."""
    monkeypatch.setattr(simhash, "SAMPLE", sample)
    rng, texts = random.Random(5), []
    for k in range(120):
        base = own(k, rng.randint(12, 120)).split()
        copy = list(base)
        for _ in range(rng.randint(1, 2 + len(base) // 40)):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        texts += [" ".join(base), " ".join(copy)]
    shared = own(900, 60)
    texts += [shared + " " + own(901 + k, 12) for k in range(30)] + [shared + " " + own(940 + k, 40) for k in range(20)] + [shared]
    want = plain_kept(texts)
    assert 20 < len(texts) - len(want) < len(texts) - 20
    for limit in (simhash.NODE_LIMIT, 4):
        assert {r.doc_id for r in simhash.one_of_each(docs_of(list(enumerate(texts))), node_limit=limit).collect()} == want


# --- 7: byte-pair encoding


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_tokens_of_the_table(spark, sf_dir, rows, library):
    found = {r.doc_id: r for r in queries.op7_bpe_transducer(spark, sf_dir).collect()}
    for doc_id, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        r = found[doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


ODD = ["a", "e", "th", "ing", "é", "é", "Σ", "ΑΣ", "İ", "ß", "ſ", "'s", "'S", "'", "1", "²", "½", "\x1c", "\x85", "\xa0", "​", "　", "\n", "<|endoftext|>", "<|startoftext|>", "<|", "日本", "🙂", "가", "_", "!!", "a" * 30, "ab" * 300, "ǅ", "Ᲊ", "Ɤ", "\U0001df1f"]


def test_tokens_of_odd_texts(vocabulary, library):
    rng, encoder = random.Random(1), bpe.Encoder(vocabulary)
    for _ in range(1500):
        text = "".join(rng.choices(ODD, k=rng.randint(0, 12)))
        ids = library.encode(text, add_special_tokens=False).ids
        found = encoder.encode(text)
        assert ids_of(found) == ids, text
        assert "".join(bpe.decode_tokens(vocabulary, found)) == library.decode(ids, skip_special_tokens=False)


def test_texts_in_pieces(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 64)
    rng, encoder = random.Random(2), bpe.Encoder(vocabulary)
    more = ["abc" * 9, "hello", "wor ", "d'll", "12345", "日本語" * 9, "don't", "e" * 99, "привет" * 9, "İ", "й", "และ" * 9]
    for _ in range(800):
        text = "".join(rng.choices(ODD + more, k=rng.randint(0, 60)))
        size = rng.choice([1, 7, 64, 500])
        found = b"".join(encoder.feed(text[k : k + size]) for k in range(0, len(text), size)) + encoder.finish()
        assert ids_of(found) == library.encode(text, add_special_tokens=False).ids, text


def test_streamed_words_equal_whole_words(vocabulary):
    encoder, machine, rng = bpe.Encoder(vocabulary), bpe.WordMachine(vocabulary), random.Random(5)
    for _ in range(10):
        symbols = encoder.symbols("".join(rng.choices(["a", "b", "th", "in", "er", "s", "ing", "q", "é"], k=3000)).encode(), True)
        out, held = [], 0
        for symbol in symbols:
            out += machine.feed([symbol])
            held = max(held, len(machine.symbols))
        assert out + machine.finish() == vocabulary.merged(list(symbols)) and len(out) > 500
        assert held <= machine.window + bpe.STRIDE


@pytest.fixture(scope="module")
def made_up(tmp_path_factory):
    """A vocabulary of random merges over a few letters."""
    import json

    folder = tmp_path_factory.mktemp("merges")

    def make(rng):
        tokens = ["a", "b", "c"]
        merges = []
        for _ in range(rng.randint(1, 14)):
            pair = rng.choice(tokens), rng.choice(tokens)
            if len(pair[0] + pair[1]) <= 8 and pair not in merges:
                merges.append(pair)
                tokens += [pair[0] + pair[1]] * (pair[0] + pair[1] not in tokens)
        path = folder / "merges.json"
        path.write_text(json.dumps({"model": {"vocab": {t: k for k, t in enumerate(tokens)}, "merges": [" ".join(m) for m in merges]}, "added_tokens": []}))
        return bpe.Vocabulary(str(path))

    return make


def test_random_merges_are_stable_after_the_lookahead(made_up):
    rng = random.Random(8)
    for _ in range(400):
        v = made_up(rng)
        machine = bpe.WordMachine(v)
        for _ in range(12):
            symbols = [rng.randrange(3) for _ in range(rng.randint(1, 60))]
            want = v.merged(list(symbols))
            assert machine.feed(symbols) + machine.finish() == want
            cut = rng.randint(1, len(symbols))
            end = 0
            for token, other in zip(v.merged(symbols[:cut]), want):
                end += v.length[token]
                if end + v.lookahead > cut:
                    break
                assert token == other, (v.text, symbols, cut)


def test_decoding_is_incremental(vocabulary, library, monkeypatch):
    encoder = bpe.Encoder(vocabulary)
    for text in ("hello wörld", "日本 🙂 x", ""):
        ids = encoder.encode(text)
        machine = bpe.Decoder(vocabulary.bytes)
        parts = [machine.feed([i]) for i in ids_of(ids)] + [machine.finish()]
        assert "".join(parts).strip() == text and bpe.decode_text(vocabulary, ids) == "".join(parts)
        want = library.decode(ids_of(ids), skip_special_tokens=False)
        for size in (1, 2, 3):
            monkeypatch.setattr(bpe, "DECODE_TOKENS", size)
            assert "".join(bpe.decode_tokens(vocabulary, ids)) == want


# --- 8: personal data

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()]
    return 13 <= len(digits) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(digits))) % 10 == 0


def plain_personal(text):
    kinds = [("email", EMAIL, lambda m: True), ("ip", IP, lambda m: all(int(x) < 256 for x in m[0].split("."))), ("card", CARD, lambda m: luhn(m[0])), ("phone", PHONE, lambda m: 9 <= sum(c.isdigit() for c in m[0]) <= 15)]
    return [(k, m.start(), m.end()) for k, p, good in kinds for m in p.finditer(text) if good(m)]


def test_personal_data_of_the_table(spark, sf_dir, rows):
    found = {r.doc_id: r for r in queries.op8_crf_personal_data(spark, sf_dir).collect()}
    for doc_id, text in rows:
        want = plain_personal(text)
        r = found[doc_id]
        assert r.base_sha256 == digest(want) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, *_ in want) for n in pii.BASE_KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r.spans.split(","))


def test_personal_data_of_made_up_texts():
    rng = random.Random(5)
    pieces = ["a.b", "@", "x-y", "..", "1.2.3.4", "999", ".", "+1", "(555)", " 555", "-", "1234", "4111 1111 1111 1111", "4111111111111111", "é", " ", "\n", "+", "00", "255.255.255.255"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 14)))
        data = text.encode()
        assert [(pii.KINDS[k], len(data[:a].decode()), len(data[:b].decode())) for k, a, b in pii.base_spans(data)] == plain_personal(text), text


def trimmed(text, kind, a, b):
    part = text[a:b]
    return kind, a + len(part) - len(part.lstrip(".,;:!?\"'<>[]{}|#*$%&" + "()" * (kind != "phone"))), b - len(part) + len(part.rstrip(pii._TRIM))


def test_added_spans_share_what_labelled_ones_have():
    places = lambda data: [m.span() for m in re.finditer(rb"\S+", data)]
    data = b"by Ann Lee\nHead of"
    assert pii._by_lines(data, places(data), [1, 4, 5]) == [[1, 3, 5]]
    assert pii._by_lines(data, places(data), [1, 3, 5]) == [[1, 3, 5]]
    assert pii._by_lines(b"", [], [0, 1, 5]) == [[0, 1, 5]]
    usual = pii.Usual([b"Ann Lee", b"Jo van Dam"])
    assert usual.allows(b"Max Roe") and usual.allows(b"A B C D E F")
    assert not any(map(usual.allows, (b"Ann", b"A B C D E F G", b"Ann 4d44", b"es es", b"")))
    assert not pii.Usual([]).allows(b"Ann")
    digits = pii.Usual([b"030 123", b"55 55"])
    assert digits.allows(b"55 55") and not digits.allows(b"call me")


def test_held_out_spans_are_found(spark, sf_dir, rows, docs_of):
    """Sentences of held-out patterns are planted into documents of the table; the field finds them there and leaves the rest alone."""
    clean = [t for _, t in rows if not plain_personal(t)][: len(pii_examples.held_out_examples())]
    docs, want = [], {}
    for k, ((text, spans), around) in enumerate(zip(pii_examples.held_out_examples(), clean * 3)):
        head = around[:300] + "\n"
        docs.append((k, f"{head}{text}\n{around[300:600]}"))
        want[k] = {trimmed(docs[-1][1], kind, a + len(head), b + len(head)) for kind, a, b in spans}
    docs += [(1000 + k, t) for k, t in enumerate(clean)]
    found = pii.find_personal_data(docs_of(docs)).collect()
    got = {r.doc_id: {(s.kind, s.start, s.end) for s in r.spans if not s.base} for r in found}
    hits = sum(len(want[k] & got[k]) for k in want)
    assert hits >= 0.9 * sum(map(len, want.values())) and hits >= 0.9 * sum(len(got[k]) for k in want)
    assert sum(len(got[1000 + k]) for k in range(len(clean))) <= 0.03 * len(clean)
    masked = {r.doc_id: r.text for r in pii.mask_personal_data(docs_of(docs)).collect()}
    assert sum("<NAME>" in masked[k] for k in want) > 80


def test_the_field_can_be_fitted_on_other_labels(spark, docs_of):
    shape = "text string, spans array<struct<kind:string,start:int,end:int>>"
    rows = [(f"badge {k * 37 % 1000:03d}-Q was seen", [("card", 0, 0)][:0] + [("address", 6, 11)]) for k in range(60)] + [(f"{k} words were seen", []) for k in range(60)] + [(None, None)]
    labelled = spark.createDataFrame(rows, shape)
    docs = docs_of([(1, "then badge 123-Q was there"), (2, "12 words were there"), (3, None)])
    for most in (pii.TRAIN_TEXTS, 60):
        found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_personal_data(docs, labelled=labelled, most=most).collect()}
        assert found == {1: [("address", 11, 16, False)], 2: [], 3: []}
    assert [r.spans for r in pii.find_personal_data(docs, labelled=labelled.where("false")).collect()] == [[], [], []]


def enumerated(theta, ids, size):
    """Score of every labelling of one sequence."""
    from itertools import product

    emit, move, first, last = theta
    score = lambda p: first[p[0]] + last[p[-1]] + sum(emit[f, y] for y, fs in zip(p, ids) for f in fs) + sum(move[a, b] for a, b in zip(p, p[1:]))
    return {p: score(p) for p in product(range(emit.shape[1]), repeat=size)}


def test_likelihood_and_gradient_against_enumeration():
    rng = np.random.default_rng(0)
    theta = [rng.normal(size=s) for s in ((5, 3), (3, 3), (3,), (3,))]
    theta[0][4] = 0
    sequences = [([[0], [1, 2], [3], [0, 3]], [0, 1, 2, 1]), ([[2], [2]], [1, 1]), ([[1]], [2]), ([[1]], [2])]
    value, grads = crf.Likelihood(sequences, 4, 3)(theta)

    def plain(theta):
        total = 0.0
        for ids, marks in sequences:
            every = enumerated(theta, ids, len(ids))
            total += np.log(sum(np.exp(x) for x in every.values())) - every[tuple(marks)]
        return total / len(sequences)

    assert np.isclose(value, plain(theta))
    for k, grad in enumerate(grads):
        for at in np.ndindex(grad.shape):
            if k == 0 and at[0] == 4:
                continue
            moved = [x.copy() for x in theta]
            moved[k][at] += 1e-5
            assert np.isclose((plain(moved) - plain(theta)) / 1e-5, grad[at], atol=1e-4)
    model = crf.Crf(*theta)
    sizes = np.array([len(ids) for ids, _ in sequences])
    scores = np.zeros((4, 4, 3))
    for r, (ids, _) in enumerate(sequences):
        for t, fs in enumerate(ids):
            scores[r, t] = theta[0][fs].sum(axis=0)
    best = model.viterbi(scores, sizes)
    for r, (ids, _) in enumerate(sequences):
        every = enumerated(theta, ids, len(ids))
        assert tuple(best[r, : len(ids)]) == max(every, key=every.get)


def test_runs_between_certain_words_give_the_best_path_of_the_whole_text(rows):
    finder = pii.PersonalDataFinder(pii.default_field())
    model = finder.field.model
    texts = [t.encode() for t, _ in pii_examples.held_out_examples()[:40]] + [t.encode()[:2000] for _, t in rows[:20]]
    found = finder._marked(texts)
    for k, text in enumerate(texts):
        words = [None, None, *text.split(), None, None]
        ids = pii.features(words, finder.field.known)
        scores = np.array([model.emit[f].sum(axis=0) for f in ids])[None, 2:-2]
        if not scores.shape[1]:
            continue
        ends = crf.Crf(model.emit, model.move, model.move[0], model.move[:, 0])
        best = ends.viterbi(scores, np.array([scores.shape[1]]))[0]
        assert {i: int(y) for i, y in enumerate(best) if y} == found.get(k, {})


# --- 9: substrings


def plain_repeats(texts, length=35):
    words = [WORD.findall(t or "") for t in texts]
    counts = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if counts[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_anchors": 0}, {"hot": 1}, {"broadcast_anchors": 0, "hot": 2}])
def test_repeats(docs_of, options):
    rng = random.Random(6)
    passage = own(1, 60)
    texts = [own(k, rng.randint(0, 120)) for k in range(10, 30)]
    texts += [own(k, 40) + " " + " ".join(passage.split()[: rng.randint(30, 60)]) + " " + own(k + 100, 20) for k in range(40, 50)]
    texts += ["la " * 200, "a b " * 60, own(5, 35), own(5, 35), own(6, 34), own(6, 34), None, "", (own(7, 50) + "\n") * 3, own(8, 300), own(8, 299) + " end"]
    rows = {r.doc_id: r for r in substrings.remove_repeats(docs_of(list(enumerate(texts))), **options).collect()}
    found = {k: (r.n_words, r.n_removed, r.kept) for k, r in rows.items()}
    assert [found[k] for k in range(len(texts))] == plain_repeats(texts)
    for k, r in rows.items():
        words, spans = (texts[k] or "").split(), [tuple(s) for s in r.repeats]
        assert " ".join(w for i, w in enumerate(words) if not any(a <= i < b for a, b in spans)) == r.kept
        assert all(b - a >= 35 for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_repeats_of_the_table(spark, sf_dir, rows):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op9_seed_and_extend(spark, sf_dir).collect()}
    want = plain_repeats([r.text for r in rows])
    assert found == {r.doc_id: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for r, (n, gone, kept) in zip(rows, want)}


# --- 10: pages


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>one<p>two", "one\n\ntwo"),
        ("a<br>b<div>c</div>d", "a\nb\nc\nd"),
        ("<ul><li>x<li>y<ol start=3><li>z</ol></ul>", "- x\n- y\n  3. z"),
        ("<table><tr><th>Name<th>Qty<tr><td>fig<td>12</table>", "Name  Qty\nfig   12"),
        ("<table><td>a<td>b</table>", "a  b"),
        ("x<script>var a='</p>';</script><style>p{}</style><span hidden>n</span><b style='display: none'>n</b>y", "xy"),
        ("a &amp; b &lt;c&gt; &copy;", "a & b <c> ©"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("<title>t</title><body>b", "b"),
        ("<p>a  \n b</p>\n\n<p> c</p>", "a b\n\nc"),
        ("<dl><dt>t<dd>d</dl>", "t\n  d"),
        ("<html><head><title>t</title><p>Hello world", "Hello world"),
        ("<head><meta charset=x><div>Hi</div>there", "Hi\nthere"),
        ("<head>text<style>p{}</style>", "text"),
        ("<div>" * 300 + "<script>var secret=1;</script><style>p{x}</style><i style='display:none'>gone</i>shown" + "</div>" * 300 + "end", "shown\nend"),
        ("Name <input value=Bob><input type=submit value=Go><input type=hidden value=no><textarea>\na\n b</textarea>", "Name BobGo\na\n b"),
        ("<select><option>A<option>B<p>after", "A\nB\n\nafter"),
        ("<math><mi>x</mi><mo>=</mo></math><svg><title>no</title><text>lab</text></svg>", "x=lab"),
        ("<table><tr><td colspan=2>wide head<td>c<tr><td>a<td>bbb<td>d<tr><td rowspan=2>r<td>1<td>2<tr><td>3<td>4</table>",
         "wide head  c\na  bbb  d\nr  1    2\n   3    4"),
        ("<table><caption>cap</caption><tr><td>a<table><tr><td>n<td>m</table><td>z<tr><td>q<td>w</table>", "cap\na     z\n\nn  m\nq     w"),
        (f"<table><tr><td>{'w' * 90}<td>x<tr><td>a<td>b</table>", f"{'w' * 90}  x\na{' ' * 61}b"),
        ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
        ("<ul><li><p>a<p>b<li>c<ul><li>d</ul></ul>e", "- a\n\n  b\n\n- c\n  - d\n\ne"),
        ("<ruby>a<rp>(<rt>b<rp>)</ruby>", "ab"),
        ("</p>x</div></b>", "x"),
        ("", ""),
    ],
)
def test_layout(html, text):
    assert html_text.visible_text(html) == text


def test_pages_of_any_shape_take_time_and_room_in_proportion():
    wide = "<table><tr><td>" + "w" * 5_000 + "<td>x" + "<tr><td>a<td>b" * 2_000
    spans = "<table><tr>" + ("<td>" + "y" * 60) * 300 + "<tr><td colspan=299>a<td>x" * 2_000
    nested = "<table><tr><td>" + "x" * 60 + "<td>" + ("<table><tr><td>" + "x" * 60 + "<td>") * 300 + "y<br>" * 1_000
    lists = "<ul><li>x" * 3_000
    for page in (wide, spans, nested, lists, "<div>" * 30_000 + "deep", "<b>" * 30_000 + "<p>x" * 2_000):
        found = html_text.visible_text(page)
        assert len(found) < 60 * len(page) and found.count("w") == page.count("w") and found.count("y") == page.count("y")


def plain_lines(page):
    """The lines of a page, from its tags alone: a break at each block tag and line break, a marker at each list item."""
    import html as entities

    body = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script.*?</script>", "", page)
    lines, marker = [], ""
    for part in re.split(r"(</?(?:html|body|nav|ul|li|div|article|h1|p|footer|br)\b[^>]*>)", body):
        text = " ".join(entities.unescape(re.sub(r"<[^>]*>", "", part)).split())
        if part.startswith("<li"):
            marker = "- "
        elif text:
            lines.append(marker + text)
            marker = ""
    return lines


def test_layout_of_the_table(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op10_layout_text(spark, sf_dir).collect():
        assert [x for x in r.text.split("\n") if x] == plain_lines(pages[r.page_id]) and r.n_chars == len(r.text)
        assert "\n\n\n" not in r.text
        paragraphs = re.findall(r"<p>([^<]+)</p><p>([^<]+)</p>", pages[r.page_id])
        assert all(f"{' '.join(a.split())}\n\n{' '.join(b.split())}" in r.text for a, b in paragraphs if "&" not in a + b)


def test_all_visible_words_of_the_table(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = {r.page_id: r.text for r in queries.op10_layout_text(spark, sf_dir).collect()}
    import html as entities

    for page_id, page in pages.items():
        body = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script.*?</script>", " ", page)
        assert found[page_id].split() and [w for w in entities.unescape(re.sub(r"<[^>]*>", " ", body)).split()] == [w for w in found[page_id].split() if w != "-" or "- " not in found[page_id]]
