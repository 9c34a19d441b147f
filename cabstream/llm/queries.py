"""Registered queries of the training-data operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.llm import (
    ann, binary_output, conversation_trie, decontaminate, lang_id, license_scan, line_dedup, packing, sharding, simhash,
    spelling, substring_dedup, token_counts)
from cabstream.llm.common import read_table
from cabstream.session import work_folder

SHARDS = 24
CAPACITY = 4096

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file, the same on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


SUBSTRING_SQL = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select doc_id, w, unnest(generate_series(1, len(w) - 19)) as s from docs where len(w) >= 20),
windows as (select doc_id, s, array_to_string(w[s:s + 19], ' ') as k from starts),
ranked as (select doc_id, s, row_number() over (partition by k order by doc_id, s) as n from windows),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from docs),
covered as (select x.doc_id, x.pos, x.word, max(r.s) over (partition by x.doc_id order by x.pos
  rows between 19 preceding and current row) is not null as gone
  from words x left join ranked r on r.doc_id = x.doc_id and r.s = x.pos and r.n > 1),
summed as (select doc_id, count(*) as n_words, count(*) filter (where gone) as n_removed,
  string_agg(word, ' ' order by pos) filter (where not gone) as kept from covered group by doc_id)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256 from documents d left join summed s on s.doc_id = d.doc_id"""


@query("op2_substring_dedup", SUBSTRING_SQL)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(read_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"),
                                    capacity=CAPACITY, end_id=1)


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(read_table(spark, sf_dir, "documents"),
                                           read_table(spark, sf_dir, "benchmark"))


LINE_SQL = r"""
with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
lines as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from docs),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
bad as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(b.key) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where b.key is null), '')) as kept_sha256
from keyed left join bad b on keyed.key = b.key group by doc_id"""


@query("op5_line_dedup", LINE_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_repeated_lines(docs, min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "token-files")
    binary_output.write_token_files(read_table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"),
                                    end_id=2)
    return binary_output.read_documents(spark, path)


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), every=50, k=5)


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.languages(read_table(spark, sf_dir, "documents"))


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    sized = docs.select("doc_id", (F.length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.uniform_shards(sized, SHARDS, ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"),
                                     limit=CAPACITY)


#: The byte table of CRC-32, as a list in SQL, and the unsigned CRC-32 of a list of bytes by it.
CRC_TABLE = """crc as (select list(v order by i) as crc_table from (select i, list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
  lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as v from range(256) r(i)))"""


def crc_sql(codes: str) -> str:
    return (f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, crc_table[xor(c & 255, b) + 1]), "
            "4294967295::bigint), 4294967295)")


@query("op11_license_scan")
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


SPELLING_SQL = rf"""
with recursive {CRC_TABLE},
runs as (select coalesce(doc_id::varchar, '') as d, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents where text is not null),
counted as (select d, run, count(*) as n, hex(encode(d || ':' || run)) as x from runs where length(run) >= 7 group by d, run),
hashed as (select run, n, {crc_sql("list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)")} as h
  from counted cross join crc),
garbled as (select case when h % 31 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word, n from hashed),
v as (select word, sum(n)::bigint as n from garbled where length(word) >= 7 group by word having sum(n) >= 2),
cut as (select word, n, length(word) as l, i, run_without as rest from (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as run_without
  from (select word, n, unnest(generate_series(1, length(word))) as i from v))),
pairs as (select distinct a.word, b.word as near, b.n as near_n from cut a join cut b
    on a.rest = b.rest and a.i = b.i and a.l = b.l and a.word <> b.word
  union select distinct c.word, v.word, v.n from cut c join v on v.word = c.rest
  union select distinct v.word, c.word, c.n from cut c join v on v.word = c.rest),
best as (select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from pairs group by word),
forms as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * v.n then near end as form,
  case when near_n >= 10 * v.n then near_n end as form_n from v left join best b on b.word = v.word),
walk as (select word, word as at from forms union all
  select w.word, f.form from walk w join forms f on f.word = w.at where f.form is not null),
roots as (select w.word, w.at as root from walk w join forms f on f.word = w.at where f.form is null)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n from forms f join roots r on r.word = f.word"""


@query("op12_spelling_variants", SPELLING_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(read_table(spark, sf_dir, "documents"), min_chars=7, min_count=2, garble=31)
    return spelling.variants(counts, ratio=10)


TRIE_SQL = f"""
with {CRC_TABLE},
t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
  coalesce(text, '')) as p, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} as x
  from conversations where conv_id is not null),
c as (select conv_id, list(x order by p) as own from t group by conv_id),
h as (select *, {crc_sql("list_transform(string_split(conv_id::varchar, ''), lambda s: ascii(s)::bigint)")} % 6 as h from c cross join crc),
r as (select h.conv_id, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) as turns
  from h left join c b on b.conv_id = h.conv_id - h.conv_id % 100),
v as (select conv_id, turns, unnest(generate_series(0, len(turns))) as depth from r),
k as (select conv_id, depth, case when depth = 0 then [] else turns[1:depth] end as path, len(turns) = depth as ends from v),
n as (select depth, path, min(conv_id) as conv_id, count(*) as n_convs,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from k group by depth, path),
f as (select n.*, p.conv_id as parent_conv_id, count(*) over (partition by n.depth, case when n.depth > 1
  then n.path[1:n.depth - 1] else [] end) as same, case when n.depth > 1 then n.path[1:n.depth - 1] else [] end as up
  from n left join n p on p.depth = n.depth - 1 and p.path = (case when n.depth > 1 then n.path[1:n.depth - 1] else [] end)),
g as (select depth - 1 as depth, up as path, count(*) as n_children from f where depth > 0 group by all),
w as (select f.*, coalesce(g.n_children, 0) as n_children,
  case when f.depth = 0 then 0 else (n_convs - 1) * length(f.path[f.depth].t) end as saved
  from f left join g on g.depth = f.depth and g.path = f.path),
a as (select depth, path, n_children, saved, unnest(generate_series(0, depth)) as e from w),
s as (select e as depth, case when e = 0 then [] else path[1:e] end as path, count(*) filter (where n_children = 0) as n_leaves,
  sum(saved)::bigint as saved_tokens from a group by all)
select w.conv_id, w.depth, w.parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
from w join s on s.depth = w.depth and s.path = w.path"""


@query("op13_conversation_trie", TRIE_SQL)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.ordered_turns(read_table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    rebuilt = conversation_trie.with_shared_starts(
        turns, base=conv - conv % 100, head=F.crc32(conv.cast("string")) % 6, most=5)
    return conversation_trie.prefix_trie(*rebuilt)
