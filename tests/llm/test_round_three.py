"""The conversation trie, toxicity and spelling variants against plain versions, and their awkward inputs."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cloudloom.llm import prefix_trie, toxicity, variants

TURNS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_trie(rows):
    conv = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, role or "", text or ""))
    rebuilt = {}
    for c, turns in conv.items():
        turns.sort(key=lambda v: v[:2])
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = [v[2:] for v in sorted(conv.get(c - c % 20, []), key=lambda v: v[:2])[:h]] + [v[2:] for v in turns[h:]]
    nodes = collections.defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in nodes if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, members in nodes.items():
        words = len(WORD.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(members) - 1) * words
            leaves[k[:d]] += not kids[k]
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(rebuilt[c]) == len(k)))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def trie(df):
    return sorted(tuple(r)[:8] for r in prefix_trie.prefix_trie(df).collect())


def some_conversations(seed, n=70):
    rng = random.Random(seed)
    say = ["", "yes", "no", "tell me  more", "a b\tc", "ß é 日本", None]
    rows = []
    for c in rng.sample(range(200), n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, None if t == 0 and c % 7 == 0 else t, rng.choice(["user", "assistant", None, ""]), rng.choice(say)))
    rng.shuffle(rows)
    return rows


def test_trie_against_plain_version(spark):
    rows = some_conversations(1)
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("extra") for c in ("depth", "f1", "at", "k1", "words", "l0", "h")})
    assert trie(df) == plain_trie(rows)


def test_trie_of_awkward_tables(spark):
    assert trie(spark.createDataFrame([], TURNS)) == []
    assert trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)) == []
    same = [(c, t, "user", "hello there") for c in range(0, 300, 20) for t in range(3)]  # one hot group
    repeated = [(40, 0, "user", "twice"), (40, 0, "user", "twice"), (47, None, None, None)]
    rows = same[:9] + same[9:] + [(c + 100_001, t, r, x) for c, t, r, x in repeated]
    assert trie(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)


def test_trie_of_a_conversation_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie.running, "__defaults__", (False, 16))
    rows = [(c, t, "user", f"turn {t if c < 20 or t < 90 else -t}") for c in (0, 5, 7, 25) for t in range(100)]
    assert trie(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)


def test_equal_hashes_of_unlike_turns_are_noticed(spark, monkeypatch):
    real = prefix_trie._hashes

    def weak(role, text, seed):
        return real(role, text, seed) if seed else [(F.length("text") % 2).cast("long").alias(k) for k in ("k1", "k2")]

    monkeypatch.setattr(prefix_trie, "_hashes", weak)
    rows = some_conversations(2, 40)
    assert trie(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)
    monkeypatch.setattr(prefix_trie, "_hashes", lambda role, text, seed: [F.lit(7).cast("long").alias(k) for k in ("k1", "k2")])
    with pytest.raises(RuntimeError):
        prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))


def test_powers(spark):
    exponents = [0, 1, 2, 31, 4096, 2**31 - 1]
    df = spark.createDataFrame([(e,) for e in exponents], "e long")
    got = df.select("e", *(prefix_trie._power(b, F.col("e")).alias(f"p{k}") for k, b in enumerate(prefix_trie.BASES))).collect()
    assert [tuple(r) for r in got] == [(e, *(pow(b, e, prefix_trie.PRIME) for b in prefix_trie.BASES)) for e in exponents]


# --- spelling variants ---------------------------------------------------------------------------------------------


def plain_variants(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    words = {w: c for w, c in n.items() if c >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    form, count = {}, {}
    for w in words:
        others = [x for x in words if x != w and near(w, x)]
        count[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, words[w], count[w], form[w] or "", words.get(form[w], 0), root))
    return sorted(out)


def found_variants(df):
    found = variants.spelling_variants(df).select("word", "n", "n_near", F.coalesce("form", F.lit("")), F.coalesce("form_n", F.lit(0)), "root")
    return sorted(tuple(r) for r in found.collect())


def some_words(seed, n=250):
    rng = random.Random(seed)
    letters = "abeéÀnrtsß"
    stems = ["".join(rng.choice(letters) for _ in range(rng.choice([7, 8, 9, 11]))) for _ in range(12)]
    words = []
    for _ in range(n):
        w = list(rng.choice(stems))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            k = rng.randrange(len(w))
            w[k : k + rng.choice([0, 1])] = rng.choice(["", rng.choice(letters), rng.choice(letters)])
        words += ["".join(w)] * rng.choice([1, 2, 2, 3, 25, 300])
    rng.shuffle(words)
    return words


def test_variants_against_plain_version(docs_of):
    words = some_words(3)
    rows = [(k, " ".join(words[k::7]).upper() if k == 3 else ", ".join(words[k::7])) for k in range(7)] + [(None, " ".join(words[:50])), (9, None), (10, "")]
    assert found_variants(docs_of(rows)) == plain_variants(rows)


def test_every_kind_of_edit_is_found(spark):
    rng = random.Random(5)
    base = "abcdefgéßy"
    made = {base: 50}
    for k in range(len(base) + 1):
        made[base[:k] + "z" + base[k:]] = 2
        if k < len(base):
            made[base[:k] + base[k + 1 :]] = 3
            made[base[:k] + rng.choice("xq") + base[k + 1 :]] = 4
    vocab = spark.createDataFrame(list(made.items()), "word string, n long")
    got = {r["near"] for r in variants.links(vocab).where(F.col("word") == base).collect()}
    assert got == set(made) - {base}


def test_chains_of_forms_reach_the_last(docs_of):
    counts = {"abcdefgh": 5000, "abcdefgx": 400, "abcdefyx": 30, "abcdezyx": 2}
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(counts.items())]
    assert found_variants(docs_of(rows)) == plain_variants(rows)


def test_variants_of_awkward_tables(docs_of, awkward):
    assert found_variants(docs_of([])) == []
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found_variants(awkward) == plain_variants(rows)


# --- toxicity ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "folded"),
    [("1d10t!!", ["idiot"]), ("$TUP1D", ["stupid"]), ("m0r0n$$$", ["moron"]), ("ѕсum", ["scum"]), ("ｌｏｓｅｒ", ["loser"]), ("s​cum", ["scum"]), ("i.d.i.o.t", ["idiot"]),
     ("2024 a1", ["2024", "ai"]), ("end.next", ["end", "next"]), ("*** - $", ["$"]), ("", []), (None, []), ("réeux", ["réeux"])],
)
def test_folding(text, folded):
    got = toxicity.fold(text)
    assert [w for w in got if w.isalnum()] == [w for w in folded if w.isalnum()]


def plain_matches(words, lexicon):
    """Leftmost, longest: phrases over terms, word by word."""
    phrases, found, k = {tuple(p.split()) for p in lexicon.phrases}, {}, 0
    while k < len(words):
        ahead = max((len(p) for p in phrases if tuple(words[k : k + len(p)]) == p), default=0)
        term = max((t for t in lexicon.terms if f" {words[k]} ".startswith(t)), key=len, default=None)
        if ahead > 1:
            k += ahead
            continue
        if term:
            found[words[k]] = term
        k += 1
    return found


def test_matching_against_plain_version():
    rng = random.Random(9)
    lexicon = toxicity.Lexicon({" idiot ": 5.0, " idio": 2.0, " scum ": 4.0, " trash ": 3.0, " réeu": 1.0}, ("trash can", "soap scum", "can idiot scum"))
    pool = ["idiot", "idiots", "idio", "scum", "trash", "can", "soap", "réeux", "réeu", "x", "scummy"]
    for _ in range(300):
        words = [rng.choice(pool) for _ in range(rng.randrange(12))]
        assert toxicity.matches(words, lexicon.matcher()) == plain_matches(words, lexicon), words


def some_labels(n=400):
    rng = random.Random(11)
    plain = [f"{a}{b}" for a in ("er", "on", "the", "ing", "ou") for b in ("an", "re", "sh", "ti")]
    bad = ["idiot", "scum", "1diot", "SCUM!!", "vileword", "vilething"]
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(plain) for _ in range(rng.choice([5, 30, 200]))]
        toxic = k % 6 == 0
        if toxic:
            for _ in range(1 + len(words) // 15):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        elif k % 10 == 1:
            words[2:2] = ["soap", "scum"]
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark, docs_of):
    docs, labels = some_labels()
    found = toxicity.toxic_documents(docs_of(docs), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in found if r["held_out"]]
    assert {r["doc_id"] for r in found if r["held_out"]} == {k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(p == t for p, t in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)


def test_scores_do_not_see_held_out_labels(spark, docs_of):
    docs, labels = some_labels(150)
    other = [(k, 1 - t) if zlib.crc32(str(k).encode()) % 5 == 0 else (k, t) for k, t in labels]
    scores = [sorted((r["doc_id"], r["score"]) for r in toxicity.toxic_documents(docs_of(docs), spark.createDataFrame(x, "doc_id long, toxic int")).collect()) for x in (labels, other)]
    assert scores[0] == scores[1]


def test_toxicity_of_awkward_tables(spark, docs_of, awkward):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxic_documents(docs_of([]), none).count() == 0
    found = toxicity.toxic_documents(awkward, none).collect()
    assert len(found) == awkward.count() and all(r["predicted"] == 0 and 0 <= r["score"] < 0.01 for r in found)
    odd = spark.createDataFrame([(1, None), (None, 1), (5, 1), (5, 0), (4, 0), (6, 0), (77, 1)], "doc_id long, toxic int")
    assert toxicity.toxic_documents(awkward, odd).count() == awkward.count()
    scored = toxicity.score_toxicity(awkward.withColumns({c: F.lit("x") for c in ("n_words", "score", "weight")}), toxicity.Lexicon({" one ": 3.0}, (), -1.0, 1.0, 0.1))
    assert {r["doc_id"]: r["n_words"] for r in scored.where("doc_id in (2, 8, 9)").collect()} == {2: 0, 8: 1, 9: 2}
