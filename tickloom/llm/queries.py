"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    decontaminate, html_text, licences, negatives, packing, quality, secret_scan, similar, spelling, tokens, topk, urls, warc)
from tickloom.llm.common import table
from tickloom.session import workspace

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(plan: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        REGISTRY[name] = plan
        if sql:
            SQL[name] = sql
        return plan

    return register


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


@query("op1_warc_salvage")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.page_records(warc.read_archives(spark, folder))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(licences.document_files(table(spark, sf_dir, "documents")))


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op6_benchmark_decontamination", f"""
with shingled as (
  select kind, id, list_distinct(case
           when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
           when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s,
         case when kind = 'd' then list_distinct(flatten(list_transform(range(1, 5), lambda k: list_transform(
           range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) else [] end as short
  from (select 'd' as kind, doc_id as id, {WORDS.format(text=LOWERED)} as w from documents
        union all select 'i', item_id, {WORDS.format(text=LOWERED)} from benchmark)),
items as (select id as item_id, len(s) as n_item, unnest(s) as shingle from shingled where kind = 'i'),
held as (select distinct id as doc_id, unnest(list_concat(s, short)) as shingle from shingled where kind = 'd')
select doc_id, item_id, items.n_item::bigint as n_item, count(*) as n_common, count(*)::double / items.n_item as containment
from held join items using (shingle) group by doc_id, item_id, items.n_item having 100 * count(*) >= 80 * items.n_item""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_ngram_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.similar_components(table(spark, sf_dir, "documents"))


@query("op8_url_filter")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.fit(urls.labelled_urls(spark)))


@query("op9_quality_rules", rf"""
with worded as (
  select doc_id, coalesce(text, '') as t, {WORDS.format(text="coalesce(text, '')")} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
         row_number() over () as r
  from documents),
windows as (
  select r, p, count(*) over (partition by r, w[p], w[p + 1], w[p + 2]) as n
  from (select r, w, unnest(range(1, len(w) - 1)) as p from worded)),
repeats as (
  select r, count(distinct q) as n_repeat_words
  from (select r, unnest([p, p + 1, p + 2]) as q from windows where n > 1) group by r),
measured as (
  select doc_id, len(w)::bigint as n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from worded left join repeats using (r)),
failed as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 100 * n_symbols > 10 * word_chars or 100 * n_dup_lines > 30 * n_lines
            or word_chars < 2 * n_words or word_chars > 15 * n_words) as kept
from failed""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


@query("op11_spelling_variants", r"""
with recursive crc as (
  select list_transform(range(256), lambda b: list_reduce(
           list_prepend(b::bigint, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
runs as (
  select coalesce(doc_id::varchar, '') as doc, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as run
  from documents),
counted as (select doc, run, count(*) as n from runs where length(run) >= 6 group by all),
summed as (
  select run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(strlen(hashed) // 2), lambda i: ('0x' || substr(hashed, 2 * i + 1, 2))::bigint)),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) as h
  from (select run, n, hex(encode(doc || ':' || run)) as hashed from counted), crc),
words as (
  select word, sum(n)::bigint as n
  from (select case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n
        from summed)
  where length(word) >= 6 group by word having sum(n) >= 5),
dropped as (
  select word, n, p, left(word, p - 1) as head, substr(word, p + 1) as tail
  from (select word, n, unnest(range(1, length(word) + 1))::int as p from words)),
near as (
  select a.word, b.word as other, b.n as other_n
  from dropped a join dropped b on a.head = b.head and a.tail = b.tail and a.p = b.p and a.word <> b.word
  union select d.word, w.word, w.n from dropped d join words w on d.head || d.tail = w.word
  union select w.word, d.word, d.n from dropped d join words w on d.head || d.tail = w.word),
best as (
  select word, count(*) as n_near, first(other order by other_n desc, other) as other, max(other_n) as other_n
  from near group by word),
formed as (
  select word, n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= 5 * n then other end as form,
         case when other_n >= 5 * n then other_n end as form_n
  from words left join best using (word)),
followed as (
  select word, word as root from formed where form is null
  union all select f.word, o.root from followed o join formed f on f.form = o.word)
select word, form, root, n, n_near, form_n from formed join followed using (word)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(table(spark, sf_dir, "documents"))


VECTORS = """
rows as (
  select row_number() over () as r, vec_id, {columns} list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 {where})"""


@query("op12_topk_search", f"""
with {VECTORS.format(columns="", scale=1024, where="")},
scored as (
  select q.r, q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from rows q join rows c on q.r <> c.r where q.vec_id % 100 = 0)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by r order by score desc, vec_id nulls last) as rank from scored) where rank <= 10""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op13_hard_negatives", f"""
with {VECTORS.format(
    columns="case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,", scale=256,
    where="and label is not null")},
scored as (
  select a.r, a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
         list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from rows a join rows c on a.r <> c.r where a.vec_id % 50 = 0),
positives as (
  select r, anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by r order by score desc, vec_id nulls last) as slot
  from scored where same qualify slot <= 5)
select p.anchor_id, positive_id, row_number() over (partition by p.r, slot order by s.score desc, s.vec_id nulls last)::int as rank,
       s.vec_id as negative_id, positive_score, s.score as negative_score
from positives p join scored s on p.r = s.r and not s.same
where 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
qualify rank <= 3""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    return negatives.mine(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0,
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
