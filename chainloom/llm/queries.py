"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainloom.llm.blocks import extract, fit
from chainloom.llm.compression import score_quality
from chainloom.llm.decontam import contamination
from chainloom.llm.forest import near_duplicates
from chainloom.llm.licenses import COPYRIGHT_LINE, EQUIVALENT, KNOWN, LICENSE_WORDS, MARKS, known_digests, scan_licenses
from chainloom.llm.mixture import mixture
from chainloom.llm.periodic import periodic_runs, run_digests, with_loops
from chainloom.llm.shared import table
from chainloom.llm.sharding import shard
from chainloom.llm.substrings import remove_repeats
from chainloom.llm.tokenfiles import Tokens, round_trip as token_round_trip
from chainloom.llm.turns import damaged, repairs
from chainloom.llm.urls import judge
from chainloom.llm.warc import round_trip

A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), known_digests(spark))


def op2_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op3_recurrent_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))


def op4_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"))


def op5_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op6_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_benchmark_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_de_bruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("text")


def op9_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op10_host_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def op11_suffix_tree_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_loops(table(spark, sf_dir, "documents"))))


def op12_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_round_trip(table(spark, sf_dir, "documents"), Tokens(str(public_tokenizers.path("word_bpe_49k.json"))))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repairs(damaged(table(spark, sf_dir, "conversations")))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_canonical(text: str) -> str:
    out = f"regexp_replace(translate({text}, {A_TO_Z}), {sql_text(COPYRIGHT_LINE)}, '', 'g')"
    for pattern, equal in EQUIVALENT:
        if pattern.startswith("["):
            out = f"regexp_replace({out}, {sql_text(pattern)}, {sql_text(equal)}, 'g')"
        else:
            out = f"replace({out}, {sql_text(pattern)}, {sql_text(equal)})"
    return f"sha256(trim(regexp_replace({out}, {sql_text(MARKS)}, ' ', 'g')))"


#: States of a conversation in the SQL: nothing yet, system, user, assistant. A state's value is one text, cost, edits
#: and repaired turns, so that the least text is the cheapest with the least edits.
UNKNOWN = "'999999999:' || chr(1)"


def sql_edit(state: str, cost: str, edit: str, line: str = "''") -> str:
    cut = f"instr({state}, chr(1))"
    return f"(lpad(cast(cast(substr({state}, 1, 9) as integer) + {cost} as varchar), 9, '0') || substr({state}, 10, {cut} - 10) || '{edit}' || substr({state}, {cut}) || {line})"


def sql_inserted(role: str, *states: str) -> str:
    line = f"chr(10) || '{role}:'"
    return ", ".join(sql_edit(s, "2", "I", line) for s in states)


def sql_repair() -> str:
    kept, user, assistant = ("chr(10) || role || ':' || text", "chr(10) || 'user:' || text", "chr(10) || 'assistant:' || text")
    to_user = ("c0", "c1", "c3")
    return rf"""
with recursive named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name
  from conversations
), cases as (
  select *, xor(list_reduce(
    list_concat([cast(4294967295 as bigint)], list_transform(range(1, length(name) + 1), lambda i: cast(ascii(name[i]) as bigint))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, zero: xor(x >> 1, 3988292384 * (x & 1)) + zero)
  ), 4294967295) % 20 as c from named
), damaged as (
  select conv_id, turn, case when c = 4 then 'user' else role end as role,
    case when c = 1 then '' when c = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from cases, range(0, 2) t(copy) where c <> 0 and (copy = 0 or c = 3)
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as i from damaged
), placed as (
  select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    not regexp_matches(text, '[^ 	-
]') as blank,
    not regexp_matches(text, '[.!?][ 	-
]*$') as cut
  from numbered
), rows as (
  select *, lag(role[1:1]) over (partition by conv_id order by i) || role[1:1] as pair, lag(i) over (partition by conv_id order by i) as earlier from placed
), solve(conv_id, i, v0, v1, v2, v3) as (
  select conv_id, cast(0 as bigint), '000000000:' || chr(1), {UNKNOWN}, {UNKNOWN}, {UNKNOWN} from (select distinct conv_id from conversations)
  union all
  select conv_id, i,
    {sql_edit('c0', '3', 'D')},
    least({sql_edit('c1', '3', 'D')}, case when first = 's' then {sql_edit('c0', 'extra', 'K', kept)} else {UNKNOWN} end),
    least({sql_edit('c2', '3', 'D')}, case when first = 'u' then least({', '.join(sql_edit(c, 'extra', 'K', kept) for c in to_user)}) else {UNKNOWN} end,
      case when first <> 'd' then least({', '.join(sql_edit(c, '2 + extra', 'R', user) for c in to_user)}) else {UNKNOWN} end),
    least({sql_edit('c3', '3', 'D')}, case when first = 'a' then {sql_edit('c2', 'extra', 'K', kept)} else {UNKNOWN} end,
      case when first <> 'd' then {sql_edit('c2', '2 + extra', 'R', assistant)} else {UNKNOWN} end)
  from (
    select p.conv_id, p.i, p.role, p.text, case when cut then 1 else 0 end as extra,
      case when blank or again then 'd' when p.role[1:1] in ('s', 'u', 'a') then p.role[1:1] else '?' end as first,
      v0 as c0, v1 as c1, least(w2, {sql_inserted('user', 'w3')}) as c2, w3 as c3
    from (
      select conv_id, i, v0, v1, w2, least(v3, {sql_inserted('assistant', 'w2')}) as w3
      from (select *, least(v2, {sql_inserted('user', 'v0', 'v1', 'v3')}) as w2 from solve)
    ) s join placed p on p.conv_id is not distinct from s.conv_id and p.i = s.i + 1
  )
), best as (
  select conv_id, least(v0, v3, {sql_inserted('assistant', 'w2')}) as value
  from (select *, least(v2, {sql_inserted('user', 'v0', 'v1', 'v3')}) as w2 from solve qualify i = max(i) over (partition by conv_id))
), counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (blank) as blank, count(*) filter (again and not blank) as duplicate,
    count(*) filter (cut and not blank and not again) as truncated,
    count(*) filter (earlier is not null and pair not in ('su', 'ua', 'au')) as illegal
  from rows group by conv_id
)
select b.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(value[1:9] as bigint) as cost,
  substr(value, 11, instr(value, chr(1)) - 11) as audit, sha256(substr(value, instr(value, chr(1)) + 2)) as repaired_sha256
from best b left join counts c on b.conv_id is not distinct from c.conv_id
"""


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_extendible_hashing": op2_extendible_hashing,
    "op3_recurrent_labeller": op3_recurrent_labeller,
    "op4_compression_bands": op4_compression_bands,
    "op5_sainte_lague": op5_sainte_lague,
    "op6_lsh_forest": op6_lsh_forest,
    "op7_benchmark_ngrams": op7_benchmark_ngrams,
    "op8_de_bruijn": op8_de_bruijn,
    "op9_warc_writer": op9_warc_writer,
    "op10_host_segmentation": op10_host_segmentation,
    "op11_suffix_tree_runs": op11_suffix_tree_runs,
    "op12_token_records": op12_token_records,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE = {
    "op1_license_scan": f"""
with known as (
  select digest, min(license) as license from (
    select {sql_canonical('text')} as digest, license
    from (values {', '.join(f'({sql_text(n)}, {sql_text(t)})' for n, t in KNOWN)}) t(license, text)
  ) group by digest
), whole as (select doc_id, {sql_canonical("coalesce(text, '')")} as digest from documents
), lines as (
  select doc_id, line from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from documents)
  where regexp_matches(translate(line, {A_TO_Z}), {sql_text(LICENSE_WORDS)})
), notices as (
  select doc_id, count(*) as n, string_agg(distinct license, ',' order by license) as names
  from (select doc_id, {sql_canonical('line')} as digest from lines) join known using (digest) group by doc_id
)
select doc_id, digest, license, coalesce(n, 0) as n_notices, coalesce(names, '') as notices
from whole left join known using (digest) left join notices using (doc_id)
""",
    "op2_extendible_hashing": """
with hashed as (
  select doc_id, octet_length(encode(coalesce(text, ''))) as n_bytes,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 15) as bigint) as h
  from documents
), levels as (
  select doc_id, n_bytes, d as depth, h // cast(power(2, 60 - d) as bigint) as prefix from hashed, range(0, 31) t(d)
), sums as (
  select depth, prefix, sum(n_bytes) as shard_bytes from levels group by all having sum(n_bytes) <= 1048576
), leaves as (
  select doc_id, n_bytes, min(depth) as depth, min_by(prefix, depth) as prefix, min_by(shard_bytes, depth) as shard_bytes
  from levels join sums using (depth, prefix) group by doc_id, n_bytes
)
select doc_id, cast(n_bytes as bigint) as n_bytes, cast(depth as integer) as depth, cast(shard_bytes as bigint) as shard_bytes,
  case when depth = 0 then '' else lpad(bin(prefix), cast(depth as integer), '0') end as shard
from leaves
""",
    "op7_benchmark_ngrams": rf"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {A_TO_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), b as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), {A_TO_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), bw as (
  select distinct item, least(len(w), 10) as k,
    unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) as x
  from b where len(w) > 0
), starts as (
  select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as pos from d, (select distinct k from bw) where len(w) >= k
), hit as (
  select doc_id, pos, s.k, item from starts s join bw on bw.k = s.k and bw.x = array_to_string(w[pos:pos + s.k - 1], ' ')
), covered as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(pos, pos + k)) as p from hit) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hit) group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join named using (doc_id)
""",
    "op6_lsh_forest": rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {A_TO_Z}), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from words
), flat as (select doc_id, len(s) as n, unnest(s) as x from sets
), pairs as (
  select a.doc_id as a, b.doc_id as b from flat a join flat b on a.x = b.x and a.doc_id < b.doc_id
  where 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(a, b) as (
  select doc_id, doc_id from sets
  union select r.a, e.b from reach r join (select a, b from pairs union select b, a from pairs) e on r.b = e.a
), least_id as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sets join least_id using (doc_id)
""",
    "op8_de_bruijn": rf"""
with d as (select doc_id, {SQL_WORDS} as w from documents
), edges as (
  select doc_id, pos, array_to_string(w[pos:pos + 12], ' ') as e from (select doc_id, w, unnest(range(1, len(w) - 11)) as pos from d)
), owners as (select e, min(doc_id) as owner from edges group by e
), gone as (
  select distinct doc_id, unnest(range(pos, pos + 13)) as p from edges join owners using (e) where doc_id > owner
), words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d
), left_over as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by p) as t from words anti join gone using (doc_id, p) group by doc_id
)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join left_over using (doc_id)
""",
    "op13_turn_repair": sql_repair(),
}
