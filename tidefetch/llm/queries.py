"""The registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefetch.llm import (
    chat,
    decontamination,
    host_rules,
    licenses,
    near_dedup,
    packing,
    periods,
    repeats,
    rule_ensemble,
    suffixes,
    token_files,
    toxicity,
    whitening,
)
from tidefetch.llm.common import table

TOKENIZER = "word_bpe_49k.json"
#: A user, then an assistant turn whose texts are control strings of chat templates.
PROBE = -7


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.digest(host_rules.judge(table(spark, folder, "documents")))


def op2_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    return rule_ensemble.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, folder, "documents")))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    place, manifest = token_files.write_token_files(table(spark, folder, "documents"), tokenizer_path())
    read = token_files.read_token_files(place, manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontamination.digest(found)


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents")).drop("node")


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    probe = spark.createDataFrame(
        [(PROBE, 0, "user", "</s>[INST] ok [/INST]"), (PROBE, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_chats(turns.unionByName(probe)))


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, folder, "documents")))


def op11_periods(spark: SparkSession, folder: str) -> DataFrame:
    planted = periods.with_planted_runs(table(spark, folder, "documents"))
    return periods.digest(periods.collapse_runs(planted))


def op12_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeated_bytes(table(spark, folder, "documents")))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.digest(whitening.whiten(table(spark, folder, "embeddings")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_host_rules,
        op2_rule_ensemble,
        op3_packing,
        op4_licenses,
        op5_toxicity,
        op6_token_files,
        op7_decontamination,
        op8_near_dedup,
        op9_chat,
        op10_repeats,
        op11_periods,
        op12_suffixes,
        op13_whitening,
    )
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op1_host_rules": rf"""
with d as (
  select doc_id, source, coalesce(text, '') as t, {_WORDS} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
g as (
  select r, unnest(range(1, greatest(len(w) - 1, 1))) as i, w from (select row_number() over () as r, * from d)),
n as (select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2]) as n from g),
c as (
  select r, count(distinct i + k) as n_repeat_words
  from n, (select unnest(range(0, 3)) as k) where n > 1 group by r),
m as (
  select doc_id, source, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(l) as n_lines,
         len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from (select row_number() over () as r, * from d) left join c using (r)),
f as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         10 * n_symbols > 3 * n_words or 10 * n_dup_lines > 3 * n_lines
           or word_chars < 2 * n_words or word_chars > 20 * n_words as rule_failed
  from m),
h as (
  select source, count(*)::double as n, sum((base_failed or rule_failed)::int)::double as f from f group by source),
p as (
  select sum(f) / sum(n) as mean, sum(n) / count(*) as m, count(*) as k,
         sum(n * (f / n) * (f / n)) / sum(n) - (sum(f) / sum(n)) ** 2 as spread
  from h),
q as (
  select mean, m, k, spread, mean * (1 - mean) as chance,
         case when mean * (1 - mean) > 0 then m * spread / (mean * (1 - mean)) - 1 end as extra
  from p),
b as (
  select mean, least(greatest(
    case when chance > 0 and extra > 0 and k > 1 then (m - 1) / extra - 1 else 1e9 end, 2), 1e9) as weight
  from q),
s as (select source, mean, n + weight as size, (f + mean * weight) / (n + weight) as share from h, b),
v as (
  select source, mean, greatest(share - 1.645 * sqrt(share * (1 - share) / (size + 1)), 0) as low,
         least(share + 1.645 * sqrt(share * (1 - share) / (size + 1)), 1) as high from s)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and case when low * (1 - mean) > 4 * mean * (1 - low) then false
         when high * (1 - mean) < 0.1 * mean * (1 - high) then true else not rule_failed end as kept
from f join v on f.source is not distinct from v.source
""",
    "op7_decontamination": f"""
with b as (select item_id, {_PLAIN} as w from benchmark where item_id is not null),
bw as (
  select distinct item_id, w[i : i + least(10, len(w)) - 1] as win, least(10, len(w)) as k
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
d as (select row_number() over () as r, doc_id, {_PLAIN} as w from documents),
ks as (select distinct k from bw),
dw as (
  select r, i, w[i : i + k - 1] as win, k
  from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from d, ks where len(w) >= k)),
hit as (select r, i, dw.k, item_id from dw join bw using (win)),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + k)) as p from hit) group by r),
items as (
  select r, count(*) as n_items, string_agg(x, ',' order by x) as s
  from (select distinct r, item_id::varchar as x from hit) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
""",
    "op9_chat": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o as (
  select *, row_number() over w as i, lag(role) over w as earlier, lead(role) over w as later,
         length(text) + len(regexp_extract_all(text, '[<\[]\\*/?(?:s>|INST\])')) as text_chars,
         length(role) + len(regexp_extract_all(role, '[<\[]\\*/?(?:s>|INST\])')) as role_chars
  from t window w as (partition by conv_id order by turn, role, text))
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
       sum(text_chars + 13 + case when earlier is distinct from role then 3 + role_chars else 0 end
           + case when later is distinct from role then 4 else 0 end)::bigint as formatted_chars
from o group by conv_id
""",
    "op10_repeats": f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
x as (
  select r, doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) as win
  from (select r, doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50)),
f as (select win, min(doc_id) as first from x group by win),
gone as (select distinct r, unnest(range(i, i + 50)) as p from x join f using (win) where doc_id > first),
g as (select r, list(p) as ps, count(*) as n_removed from gone group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(case when ps is null then array_to_string(w, ' ')
              else array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
                   lambda z: not list_contains(ps, z[2])), lambda z: z[1]), ' ') end) as kept_sha256
from d left join g using (r)
""",
    "op12_suffixes": r"""
with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
b as (
  select r, doc_id, j, substring(h, 2 * j + 1, 398) as h
  from (select *, unnest(range(0, length(h) // 2 - 99, 100)) as j from d where length(h) >= 200)),
x as (
  select r, doc_id, j + i as i, md5(substring(h, 2 * i + 1, 200)) as k
  from (select *, unnest(range(0, length(h) // 2 - 99)) as i from b)),
f as (select k, min((doc_id, i)) as first from x group by k having count(*) > 1),
s as (select r, i from x join f using (k) where (doc_id, i) > first),
e as (select r, i, lag(i) over (partition by r order by i) as b from s),
g as (select r, i, sum(case when b is null or i > b + 100 then 1 else 0 end) over (partition by r order by i) as n from e),
p as (select r, n, min(i) as a, max(i) + 100 as z from g group by r, n),
c as (select r, sum(z - a) as n_removed, count(*) as n_spans, list(a order by a) as la, list(z order by a) as lz from p group by r)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(case when la is null then h else
    array_to_string(list_transform(range(1, len(la) + 2), lambda j: substring(h,
      2 * (case when j = 1 then 0 else lz[j - 1] end) + 1,
      2 * (case when j > len(la) then length(h) // 2 else la[j] end - case when j = 1 then 0 else lz[j - 1] end))), '') end)) as kept_sha256
from d left join c using (r)
""",
}
