"""The queries of the corpus operators: each applies its operator to the whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.llm import bpe, fingerprint, licenses, minhash, packing, quality_model, quality_rules, secret_scan, sharding, spelling, substring, suffix, whitening
from vectorloom.llm.common import table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates on 4-word shingles at a Jaccard similarity of 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 4, 80)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and risk-controlled rules for every document."""
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op2_quality_rules that its labels do not decide, so that SQL can state them."""
    return op2_quality_rules(spark, sf_dir).drop("kept", "rejected_by")


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every text by a factorisation machine."""
    return quality_model.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs every document into sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, 2, 1024)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes words of 13-word windows that also start in a document with a smaller id."""
    return substring.digest(table(spark, sf_dir, "documents"), 13)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text, by rules and a character convolutional network."""
    return secret_scan.findings(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of every text and of its edited text."""
    return fingerprint.edited_pairs(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes bytes of 50-byte strings that also start in a document with a smaller id."""
    return suffix.digest(table(spark, sf_dir, "documents"), 50)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text; returns counts and digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts with the more frequent form that each is a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals all documents to 24 shards of nearly equal bytes."""
    return sharding.sharded(table(spark, sf_dir, "documents"), 24)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitens every embedding to eight components."""
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as long)"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_quality_rules": op2_quality_rules,
    "quality_base": quality_base,
    "op3_quality_model": op3_quality_model,
    "op4_packing": op4_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_licenses": op6_licenses,
    "op7_secrets": op7_secrets,
    "op8_fingerprints": op8_fingerprints,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_sharding": op12_sharding,
    "op13_whitening": op13_whitening,
}

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _base_sql() -> str:
    return rf"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') t, {WORDS} w from documents),
places as (select r, w, unnest(range(1, len(w) - 1)) i from d where len(w) >= 3),
again as (select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2]) n from places),
covered as (select r, count(distinct i + k) n from again, range(3) s(k) where again.n > 1 group by r),
c as (select r, doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines, coalesce(covered.n, 0) as n_repeat_words from d left join covered using (r))
select doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c"""


def _licenses_sql() -> str:
    split = r"list_filter(string_split_regex({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in licenses.PHRASES.items())
    templates = ", ".join(f"('{label}', {licenses.template_words(w)!r})" for label, w in licenses.TEMPLATES)
    return f"""
with d as (select row_number() over () r, doc_id, {split.format(LOWER)} w from documents),
p as (select * from (values {phrases}) p(words, label)),
places as (select r, i - 1 as pos, label from d, p, unnest(range(1, len(w) + 1)) u(i) where w[i] = words[1] and w[i:i + len(words) - 1] = words),
base as (select r, count(*) n, min(pos) a, max(pos) b from places group by r),
t as (select k, label, len(words) m, unnest(words) word from (select row_number() over () k, * from (values {templates}) t(label, words))),
x as (select r, unnest(w) word, unnest(range(1, len(w) + 1)) pos from d),
runs as (select r, label, m, count(distinct word) over (partition by r, k order by pos range between current row and {licenses.SPAN - 1} following) c from x join t using (word)),
found as (select r, label, max(c / m) c from runs where 100 * c >= {licenses.PERCENT} * m group by r, label),
l as (select r, string_agg(label, ',' order by label) s from (select r, label from places union select r, label from found) group by r),
b as (select r, string_agg(label, ',' order by label) s from (select distinct r, label from places) group by r)
select doc_id, len(w) as n_words, coalesce(base.n, 0) as n_base, a as first_word, b as last_word, coalesce(b.s, '') as base_labels, coalesce(l.s, '') as labels,
 greatest(case when base.n > 0 then 1.0::double else 0.0::double end, coalesce((select max(c) from found where found.r = d.r), 0.0::double)) as score
from d left join base using (r) left join l using (r) left join b using (r)"""


#: The table of crc32's bytes, and the crc32 of a text's UTF-8 bytes with it.
CRC_TABLE = "(select list_transform(range(256), lambda k: list_reduce(range(8), lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k)) tab)"


def crc_sql(text: str) -> str:
    listed = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint)"
    return f"xor(list_reduce({listed}, lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1]), 4294967295), 4294967295)"


ORACLES: dict[str, str] = {
    "quality_base": _base_sql(),
    "op1_minhash_dedup": f"""
with recursive d as (select doc_id, {WORDS.replace("coalesce(text, '')", LOWER)} w from documents),
s as (select distinct doc_id, case when len(w) < 4 then array_to_string(w, ' ') else array_to_string(w[i:i + 3], ' ') end g from d, unnest(range(1, greatest(len(w) - 2, 2))) r(i) where len(w) > 0),
n as (select doc_id, count(*) n from s group by doc_id),
pairs as (select x.doc_id a, y.doc_id b, count(*) k from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
ends as (select a, b from links union select b, a from links),
reach(a, b) as (select a, b from ends union select reach.a, ends.b from reach join ends on ends.a = reach.b),
c as (select a, least(a, min(b)) m from reach group by a)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(m, d.doc_id) as component_id, coalesce(m, d.doc_id) = d.doc_id as kept
from d left join n using (doc_id) left join c on c.a = d.doc_id""",
    "op5_substring_dedup": f"""
with d as (select doc_id, {WORDS} w from documents),
x as (select doc_id, i, array_to_string(w[i:i + 12], ' ') k from d, unnest(range(1, len(w) - 11)) r(i)),
f as (select k, min(doc_id) m from x group by k),
g as (select distinct doc_id, i + j pos from x join f using (k), unnest(range(13)) r(j) where m < doc_id),
o as (select doc_id, unnest(w) word, unnest(range(1, len(w) + 1)) pos from d),
e as (select o.doc_id, count(g.pos) n, string_agg(word, ' ' order by o.pos) filter (g.pos is null) kept from o left join g on g.doc_id = o.doc_id and g.pos = o.pos group by o.doc_id)
select doc_id, len(w) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join e using (doc_id)""",
    "op6_licenses": _licenses_sql(),
    "op9_suffix_dedup": """
with d as (select doc_id, hex(encode(coalesce(text, ''))) h from documents),
x as (select doc_id, i, substr(h, 2 * i + 1, 100) k from d, unnest(range(0, length(h) // 2 - 49)) r(i)),
f as (select k, min(doc_id) m from x group by k having count(*) > 1),
g as (select doc_id, i from x join f using (k) where m < doc_id),
o as (select doc_id, i, coalesce(i > 49 + max(i) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), true) new from g),
z as (select doc_id, i, sum(new::int) over (partition by doc_id order by i) k from o),
spans as (select doc_id, min(i) a, max(i) + 50 b from z group by doc_id, k),
merged as (select doc_id, a, b, coalesce(a > lag(b) over (partition by doc_id order by a), true) apart from spans),
cuts as (select doc_id, list(struct_pack(a := a, b := b) order by a) s, sum(b - a) n, sum(apart::int) k from merged group by doc_id),
kept as (select doc_id, string_agg(substr(h, 2 * p + 1, 2 * (q - p)), '' order by p) kept from (select doc_id, h, unnest(list_prepend(0, list_transform(s, lambda v: v.b))) p, unnest(list_append(list_transform(s, lambda v: v.a), length(h) // 2)) q from d join cuts using (doc_id)) group by doc_id)
select d.doc_id, length(h) // 2 as n_bytes, cast(coalesce(n, 0) as bigint) as n_removed, cast(coalesce(k, 0) as bigint) as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256
from d left join cuts using (doc_id) left join kept using (doc_id)""",
    "op11_spelling_variants": f"""
with recursive t as materialized {CRC_TABLE},
r as (select doc_id, run, count(*) n from (select doc_id, unnest(regexp_extract_all({LOWER}, '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) run from documents) where length(run) >= 5 group by doc_id, run),
h as (select run, n, {crc_sql("concat(doc_id, ':', run)")} h from r, t),
c as (select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end word, n from h),
w as materialized (select word, cast(sum(n) as bigint) n from c where length(word) >= 5 group by word having sum(n) >= 3),
x as materialized (select word, i, substr(word, 1, i) || substr(word, i + 2) rest from w, unnest(range(length(word))) u(i)),
near as (select a.word, b.word other from x a join x b on a.rest = b.rest and a.i = b.i and a.word <> b.word union select word, rest from x where rest in (select word from w) union select rest, word from x where rest in (select word from w)),
best as (select near.word as word, count(*) n_near, arg_max(struct_pack(other := other, n := w.n), (w.n, -k)) b from (select near.word, other, row_number() over (partition by near.word order by other) k from near) near join w on w.word = other group by near.word),
f as materialized (select w.word, w.n, coalesce(n_near, 0) n_near, case when b.n >= 2 * w.n then b.other end form, case when b.n >= 2 * w.n then b.n end form_n from w left join best using (word)),
far(word, root) as (select word, coalesce(form, word) from f union all select far.word, f.form from far join f on f.word = far.root where f.form is not null and far.root <> far.word)
select f.word, form, root, n, n_near, form_n from f join (select word, arg_min(root, n) root from (select far.word, far.root, -f.n n from far join f on f.word = far.root) group by word) using (word)""",
    "op12_sharding": f"""
with recursive t as materialized {CRC_TABLE},
c as (select doc_id, strlen(coalesce(text, '')) + 8 as size, cast(coalesce({crc_sql("coalesce(text, '')")}, 0) as bigint) text_crc32 from documents, t),
d as materialized (select *, cast(('0x' || substr(md5(concat_ws(':', doc_id, text_crc32, size)), 1, 8))::bigint % 4096 as int) v from c),
w as materialized (select v, v % 24 home, bytes, row_number() over (order by bytes desc, v) k, ceil(sum(bytes) over () / 24) share from (select cast(u.v as int) v, cast(coalesce(sum(size), 0) as bigint) bytes from range(4096) u(v) left join d on d.v = u.v group by u.v)),
m(k, loads, v, shard) as (select 0::bigint, list_transform(range(24), lambda x: 0::bigint), null::int, null::bigint
 union all select k, list_transform(loads, lambda x, i: x + case when i = s + 1 then bytes else 0 end), v, s
 from (select w.k, loads, w.v, bytes, case when loads[home + 1] + bytes <= share then home else list_position(loads, list_min(loads)) - 1 end s from m join w on w.k = m.k + 1))
select doc_id, size, text_crc32, 'bytes' as law, cast(shard as int) as shard, row_number() over (partition by shard order by doc_id, text_crc32, size) - 1 as slot, null::int as grown_shard from d join m using (v)""",
}
