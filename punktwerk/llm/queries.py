"""The registered queries of the corpus operators: each applies its operator,
with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punktwerk.llm import (conversation_trie, exact_dedup, language_id, licenses, mixing, near_join, packing, pii, quality_model, quality_rules,
                           secret_scan, spelling, token_files)
from punktwerk.llm.common import documents

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file; a parameter of the operators."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "times")


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), 2)


# Words, lines and 8-word windows by unnesting; sketches, quartiles and fences
# in integers, so both engines agree to the last digit.
# signal, part, whole, percent of the high quantile, tenths of the reach, prior
_SIGNALS_SQL = [("symbols", "n_symbols", "word_chars", 95, 4, 1000), ("upper", "n_upper", "n_letters", 97, 50, 150), ("dup_lines", "n_dup_lines", "n_lines", 98, 30, 1000),
                ("repeats", "n_repeat_words", "n_words", 98, 45, 300), ("stutter", "n_stutter", "n_words", 97, 50, 150)]
_RATIO_SQL = {n: f"(10000 * {part}) // greatest({whole}, 1)" for n, part, whole, *_ in _SIGNALS_SQL}
_HIGH_SQL = "case signal " + " ".join(f"when '{n}' then {high}" for n, _, _, high, *_ in _SIGNALS_SQL) + " end"
_PRIOR_SQL = "case signal " + " ".join(f"when '{n}' then {prior}" for n, *_, prior in _SIGNALS_SQL) + " end"
_BIN_SQL = "case when r < 64 then r else (length(bin(r)) - 6) * 32 + (r >> (length(bin(r)) - 6)) end"
_LOW_SQL = "case when b < 64 then b else (b - (b // 32 - 1) * 32) << (b // 32 - 1) end"


def _spread_sql(level: str, keys: str) -> str:
    part = f"partition by {keys}, signal" if keys else "partition by signal"
    sel = f"{keys}, " if keys else ""
    return (f"{level} as (select *, top - mid as spread from (select {sel}signal, max(total) as docs, min(case when 2 * run >= total then v end) as mid, "
            f"min(case when 100 * run >= {_HIGH_SQL} * total then v end) as top from (select *, {_LOW_SQL} as v, sum(n) over ({part} order by b) as run, "
            f"sum(n) over ({part}) as total from (select {sel}signal, b, sum(n) as n from sk group by {sel}signal, b)) group by {sel}signal))")


ORACLES["op3_quality_rules"] = f"""
with t as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as x from documents),
w as (select *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') as ws, list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from t),
p as (select rid, len(ws) as n, unnest(range(1, len(ws) - 6)) as k, ws from w where len(ws) >= 8),
g as (select rid, k, count(*) over (partition by rid, array_to_string(ws[k:k + 7], ' ')) as m from p),
rep as (select rid, count(distinct k + o) as n_repeat_words from (select rid, k, unnest(range(0, 8)) as o from g where m > 1) group by rid),
c as (select w.rid, doc_id, lang, source, len(ws) as n_words, cast(coalesce(list_sum(list_transform(ws, lambda v: length(v))), 0) as bigint) as word_chars,
  len(regexp_extract_all(x, '[#*$%&|<>]')) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
  len(ls) as n_lines, len(regexp_extract_all(x, '[A-Z]')) as n_upper, len(regexp_extract_all(x, '[A-Za-z]')) as n_letters,
  len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) as n_stutter from w left join rep on rep.rid = w.rid),
sk as (select lang, source, signal, {_BIN_SQL} as b, count(*) as n from (""" + " union all ".join(
    f"select lang, source, '{n}' as signal, {r} as r from c where not (n_words < 20 or 100 * n_repeat_words > 30 * n_words)" for n, r in _RATIO_SQL.items()) + f""") group by all),
{_spread_sql("qs", "lang, source")}, {_spread_sql("ql", "lang")}, {_spread_sql("qa", "")},
qb as (select signal, mid, prior, greatest(least(spread, 2 * prior), prior // 2) as spread from (select *, {_PRIOR_SQL} as prior from qa)),
lb as (select ql.lang, ql.signal, qb.spread as whole, least(qb.spread, prior) as most, (ql.docs * ql.mid + 200 * qb.mid) // (ql.docs + 200) as mid,
  (ql.docs * greatest(least(ql.spread, 2 * least(qb.spread, prior)), qb.spread // 2) + 200 * qb.spread) // (ql.docs + 200) as spread from ql join qb using (signal)),
f as (select qs.lang, qs.source, qs.signal, (qs.docs * qs.mid + 200 * lb.mid) // (qs.docs + 200) as mid,
  (qs.docs * greatest(least(qs.spread, 2 * most), whole // 2) + 200 * lb.spread) // (qs.docs + 200) as spread
  from qs join lb on lb.lang is not distinct from qs.lang and lb.signal = qs.signal),
lim as (select lang, source, """ + ", ".join(
    f"max(case when signal = '{n}' then mid + {reach} * spread // 10 end) as max_{n}" for n, _, _, _, reach, _ in _SIGNALS_SQL) + """ from f group by lang, source),
v as (select c.*, lim.* exclude (lang, source), n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed
  from c left join lim on lim.lang is not distinct from c.lang and lim.source is not distinct from c.source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and """ + " and ".join(
    f"coalesce({_RATIO_SQL[n]} <= max_{n} or {part} <= 2, true)" for n, part, *_ in _SIGNALS_SQL) + " as kept, " + ", ".join(
    f"cast(max_{n} as bigint) as max_{n}" for n in _RATIO_SQL) + " from v"


@query("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *[f"max_{s.name}" for s in quality_rules.SIGNALS])


ORACLES["op6_exact_dedup"] = """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x from documents),
g as (select doc_id, max(doc_id) over (partition by x) as keep_id, count(*) over (partition by x) as group_size, sha256(x) as text_sha256 from t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g"""


@query("op6_exact_dedup")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), 1)


ORACLES["op8_near_join"] = """
with recursive t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, array_to_string(ws[k:k + 4], ' ') as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as k from t where len(ws) > 0)),
n as (select doc_id, count(*) as n_shingles from s group by doc_id),
o as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n_shingles + y.n_shingles - c)),
r as (select doc_id as node, doc_id as seen from t union select r.node, l.b from r join l on l.a = r.seen)
select t.doc_id, coalesce(n.n_shingles, 0) as n_shingles, m.component_id
from t left join n using (doc_id) join (select node as doc_id, min(seen) as component_id from r group by node) m using (doc_id)"""


@query("op8_near_join")
def op8_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_groups(documents(spark, sf_dir))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


@query("op9_quality_model")
def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, sf_dir), key="a key for the test tables")


@query("op11_conversation_trie")
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(documents(spark, sf_dir, "conversations"))


def crc32_sql(text: str) -> str:
    """DuckDB: the unsigned CRC-32 of a text's UTF-8 bytes, by the table
    ``crc_table`` (k: its 256 entries), which the statement defines."""
    data = f"hex(encode({text}))"
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length({data}) // 2), "
            f"lambda i: cast('0x' || substr({data}, 2 * i + 1, 2) as bigint))), "
            f"lambda a, b: xor(a >> 8, crc_table.k[(xor(a, b) & 255) + 1])), 4294967295)")


_BIT = "case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end"
CRC_TABLE_SQL = ("crc_bits as (select i, i::bigint as v, 0 as step from range(256) r(i) union all "
                 f"select i, {_BIT}, step + 1 from crc_bits where step < 8), "
                 "crc_table as (select list(v order by i) as k from crc_bits where step = 8)")

ORACLES["op13_spelling"] = rf"""
with recursive {CRC_TABLE_SQL},
r as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run from documents),
c as (select doc_id, run, count(*) as n from r group by doc_id, run),
h as (select run, n, {crc32_sql("coalesce(doc_id::varchar, '') || ':' || run")} as h from c, crc_table),
w as (select word, sum(n)::bigint as n from (select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
  else run end as word, n from h) where length(word) >= 6 group by word having sum(n) >= 5),
d as (select word, n, i, substr(word, 1, i::int - 1) || substr(word, i::int + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from w)),
p as (select a.word as a, b.word as b from d a join d b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select d.word, w.word from d join w on w.word = d.rest union select w.word, d.word from d join w on w.word = d.rest),
m as (select p.a as word, count(*) as n_near, max(w.n) as form_n, min((-w.n, p.b)) as best from p join w on w.word = p.b group by p.a),
f as (select w.word, w.n, coalesce(m.n_near, 0) as n_near, case when m.form_n >= 5 * w.n then m.form_n end as form_n,
  case when m.form_n >= 5 * w.n then struct_extract_at(m.best, 2) end as form from w left join m using (word)),
s as (select word, word as root, 0 as steps from f union all select s.word, f.form, s.steps + 1 from s join f on f.word = s.root where f.form is not null)
select f.word, f.form, g.root, f.n, f.n_near, f.form_n from f join (select word, arg_max(root, steps) as root from s group by word) g using (word)"""


@query("op13_spelling")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(documents(spark, sf_dir))


@query("op12_secret_scan")
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


# Defined after crc32_sql: nodes by the joined digests of their turns; the
# ancestors of a node are the prefixes of its smallest member.
ORACLES["op11_conversation_trie"] = f"""
with recursive {CRC_TABLE_SQL},
t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role, h) - 1 as pos, h, bytes from (select conv_id, turn,
  coalesce(role, '') as role, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as h,
  strlen(coalesce(text, '')) as bytes from conversations where conv_id is not null)),
l as (select c, count(*) as n from t group by c),
v as (select l.c, l.c - l.c % 5 as base, x.h, least(x.h, coalesce(b.n, 0)) as head, l.n from l
  join (select c, {crc32_sql("c::varchar")} % 9 as h from l, crc_table) x on x.c = l.c left join l b on b.c = l.c - l.c % 5),
r as (select v.c, head + pos - v.h + 1 as d, t.h, bytes from t join v on v.c = t.c where pos >= v.h
  union all select v.c, pos + 1, t.h, bytes from t join v on v.base = t.c where pos < head),
p as (select c, 0 as d, '' as name, null::varchar as up, 0 as bytes from v union all
  select c, d, string_agg(h, ',') over w as name, coalesce(string_agg(h, ',') over (w rows between unbounded preceding and 1 preceding), '') as up, bytes
  from r window w as (partition by c order by d)),
z as (select *, max(d) over (partition by c) as total from p),
n as (select d, name, any_value(up) as up, min(c) as c, count(*) as n_convs, (count(*) - 1) * max(bytes) as saved,
  sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (d = total), '')) as ends_sha256 from z group by d, name),
k as (select up, count(*) as n_children from n where up is not null group by up),
a as (select p.name, sum(n.saved) as saved, count(*) filter (k.n_children is null) as leaves
  from n left join k on k.up = n.name join p on p.c = n.c and p.d <= n.d group by p.name)
select n.c as conv_id, n.d::bigint as depth, u.c as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children, a.leaves as n_leaves,
  a.saved::bigint as saved_tokens, n.ends_sha256 from n join a using (name) left join k on k.up = n.name left join n u on u.name = n.up"""
