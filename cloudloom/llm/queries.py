"""The registered queries of this subpackage, one ``opN_<name>`` for each operator, and their SQL.

Each query runs its operator with production parameters over its whole table
and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html_text, importance, pii, prefix_trie, quality_rules, secret_scan, simhash, substrings, toxicity, url_filter, variants


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.apply_rules(_table(spark, sf_dir, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *base, "base_failed", "kept", "n_removed_words")


def _digest(found: DataFrame, kinds: tuple[str, ...], is_base=None) -> DataFrame:
    """Counts of the base spans of each kind, a digest of them, and all spans as text."""
    is_base = is_base or (lambda s: s["kind"].isin(*kinds))
    base = found.select("doc_id", "spans", F.filter("spans", is_base).alias("base"))

    def of(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(_joined("base"), 256).alias("base_sha256")
    return base.select("doc_id", *map(of, kinds), digest, _joined("spans").alias("spans"))


def op2_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(secret_scan.find_secrets(_table(spark, sf_dir, "documents")), secret_scan.BASE_KINDS)


def op3_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_boosted_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"))


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_simhash_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.find_personal_data(_table(spark, sf_dir, "documents")), pii.BASE_KINDS, lambda s: s["base"])


def op9_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", F.length("text").cast("long").alias("n_chars"), "text")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))
    return found.drop("turn_conv_id", "turn")


def op12_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxic_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_frequency": op1_line_frequency,
    "op2_secret_automaton": op2_secret_automaton,
    "op3_template_leaks": op3_template_leaks,
    "op4_boosted_url_filter": op4_boosted_url_filter,
    "op5_importance_resampling": op5_importance_resampling,
    "op6_simhash_gray_index": op6_simhash_gray_index,
    "op7_bpe_transducer": op7_bpe_transducer,
    "op8_crf_personal_data": op8_crf_personal_data,
    "op9_seed_and_extend": op9_seed_and_extend,
    "op10_layout_text": op10_layout_text,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_toxicity_lexicon": op12_toxicity_lexicon,
    "op13_spelling_variants": op13_spelling_variants,
}

#: CRC-32 in SQL: a list of table entries, and a list of bytes taken through it.
_CRC_TABLE = "crc_table as (select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) tab)"
_CRC = "xor(list_reduce(list_prepend(4294967295, {bytes}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"
_BYTES = "flatten(list_transform(string_split({text}, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195::bigint, unicode(c)::bigint - 64] end))"

#: DuckDB SQL of the queries that SQL can express over whole tables in reasonable time.
ORACLE_SQL: dict[str, str] = {
    "op1_line_frequency": r"""
with d as (select doc_id, coalesce(source, '') host, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
k as (select *, translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ident, row_number() over () r from d),
raw as (select r, host, ident, unnest(string_split(t, chr(10))) line from k),
lines as (select r, host, ident, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') lw from raw),
norm as (select r, host, ident, line, len(lw) n, regexp_replace(
  ' ' || translate(array_to_string(lw, '  '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || ' ', ' [0-9]+ ', ' 0 ', 'g') nl from lines where len(lw) > 0),
size as (select host, count(distinct ident) size from k group by host),
often as (select norm.host, nl from norm join size on norm.host = size.host group by norm.host, nl, size having count(distinct ident) >= 5 and count(distinct ident) >= 0.02 * size),
gone as (select r, sum(n) n from norm where (host, nl) in (select host, nl from often) group by r),
dup as (select r, count(*) - count(distinct line) n from norm group by r),
win as (select r, unnest(range(1, len(ws) - 1)) i, ws from k),
grams as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] g from win),
twice as (select r, g from grams group by r, g having count(*) > 1),
rep as (select r, count(distinct p) n from (select grams.r, unnest(range(i, i + 3)) p from grams join twice on grams.r = twice.r and grams.g = twice.g) x group by r),
m as (select k.r, doc_id, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols, coalesce(dup.n, 0)::bigint n_dup_lines,
  coalesce(rep.n, 0)::bigint n_repeat_words, coalesce(gone.n, 0)::bigint n_removed_words
  from k left join dup on k.r = dup.r left join rep on k.r = rep.r left join gone on k.r = gone.r),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and n_removed_words <= 0.5 * n_words kept, n_removed_words from b""",
    "op9_seed_and_extend": r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
win as (select doc_id, i, array_to_string(ws[i:i+34], ' ') k from (select doc_id, ws, unnest(range(1, len(ws) - 33)) i from w) s),
rep as (select k from win group by k having count(*) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 35)) p from win where k in (select k from rep)),
kept as (select w.doc_id, string_agg(ws[j], ' ' order by j) t
  from (select doc_id, ws, unnest(range(1, len(ws) + 1)) j from w) w left join gone on w.doc_id = gone.doc_id and w.j = gone.p
  where gone.p is null group by w.doc_id),
n as (select doc_id, count(*) n from gone group by doc_id)
select w.doc_id, len(ws)::bigint n_words, coalesce(n.n, 0)::bigint n_removed, sha256(coalesce(t, '')) kept_sha256
from w left join kept on w.doc_id = kept.doc_id left join n on w.doc_id = n.doc_id""",
    "op11_conversation_trie": "with " + _CRC_TABLE + r""",
turns as (select conv_id c, turn, coalesce(role, '') r, coalesce(text, '') x from conversations where conv_id is not null),
convs as (select c, list({'r': r, 'x': x} order by turn nulls first) ts from turns group by c),
heads as (select c, ts, """ + _CRC.format(bytes=_BYTES.format(text="c::varchar")) + r""" % 4 h from convs, crc_table),
rebuilt as (select a.c, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) s from heads a left join convs b on b.c = a.c - a.c % 20),
members as (select c, len(s) n, d, s[1:d] k, case when d > 0 then len(regexp_extract_all(s[d].x, '[^\x20\x09-\x0D]+')) else 0 end w from (select c, s, unnest(range(0, len(s) + 1)) d from rebuilt) m),
nodes as (select k, d, min(c) conv_id, count(*) n_convs, max(w) w, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (n = d), '')) ends_sha256 from members group by k, d),
kids as (select k[1:d - 1] k, count(*) n from nodes where d > 0 group by all),
known as (select nodes.*, coalesce(kids.n, 0) n_children from nodes left join kids on nodes.k = kids.k),
under as (select a.k, sum((b.n_convs - 1) * b.w)::bigint saved, count(*) filter (b.n_children = 0) leaves from known a join known b on b.d >= a.d and b.k[1:a.d] = a.k group by a.k)
select x.conv_id, x.d::bigint as depth, p.conv_id parent_conv_id, x.n_convs, x.n_children, u.leaves n_leaves, u.saved saved_tokens, x.ends_sha256
from known x join under u on x.k = u.k left join nodes p on x.d > 0 and p.k = x.k[1:x.d - 1] and p.d = x.d - 1""",
    "op13_spelling_variants": "with " + _CRC_TABLE + r""",
runs as (select distinct doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run, count(*) over (partition by doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) n
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) run from documents) r where length(run) >= 7),
hashed as (select run, n, """ + _CRC.format(bytes=_BYTES.format(text="coalesce(doc_id::varchar, '') || ':' || run")) + r""" h from runs, crc_table),
words as (select case when h % 31 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end word, n from hashed),
v as (select word, sum(n)::bigint n from words where length(word) >= 7 group by word having sum(n) >= 2),
cut as (select word, n, unnest(range(1, length(word) + 1)) i from v),
same as (select word, n, word[1:i - 1] || '*' || word[i + 1:] p from cut),
near as (select a.word, a.n, b.word near, b.n near_n from same a join same b on a.p = b.p and a.word <> b.word
  union select cut.word, cut.n, v.word, v.n from cut join v on v.word = cut.word[1:i - 1] || cut.word[i + 1:]
  union select v.word, v.n, cut.word, cut.n from cut join v on v.word = cut.word[1:i - 1] || cut.word[i + 1:]),
best as (select word, n, count(*) n_near, arg_min(near, (-near_n, encode(near))) near, max(near_n) near_n from near group by word, n),
forms as (select v.word, v.n, coalesce(n_near, 0) n_near, case when near_n >= 10 * v.n then near end form, case when near_n >= 10 * v.n then near_n end form_n from v left join best on v.word = best.word),
steps as (with recursive s as (select word, word root, 0 k from forms union all select s.word, f.form, k + 1 from s join forms f on s.root = f.word where f.form is not null) select word, arg_max(root, k) root from s group by word)
select forms.word, n, n_near, form, form_n, root from forms join steps on forms.word = steps.word""",
}
