"""Queries of this subpackage: (spark, sf_dir) -> DataFrame, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from rowmill.llm import bpe, collocations, cuckoo, langid, line_dedup, ngram_join, nn_descent, packing, pii, pivot_topk, quality, spelling, token_scan
from rowmill.llm.common import table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return nn_descent.nearest(emb, emb.where(F.col("vec_id") % 20 == 0))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.document_tokens(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return pivot_topk.search(emb, emb.where(F.col("vec_id") % 100 == 0))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_cuckoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.dedup_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_ngram_join, op2_pii, op3_quality, op4_line_dedup, op5_nn_descent, op6_langid, op7_token_scan, op8_bpe, op9_packing, op10_pivot_topk,
              op11_collocations, op12_spelling, op13_cuckoo)
}

ORACLE: dict[str, str] = {
    "op4_line_dedup": r"""
with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) as own from documents),
lines as (select doc_id, generate_subscripts(own, 1) as pos, unnest(own) as line from docs),
keys as (
  select doc_id, pos, line,
    translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines),
often as (select k, max(doc_id) as keeper from keys where length(k) >= 20 group by k having count(distinct doc_id) >= 3)
select doc_id, count(*) as n_lines,
  count(*) filter (where keeper is not null and keeper <> doc_id) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where keeper is null or keeper = doc_id), '')) as kept_sha256
from keys left join often using (k) group by doc_id""",
    "op1_ngram_join": r"""
with recursive words as (
  select doc_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') as w from documents),
shingled as (
  select doc_id, case when len(w) = 0 then [coalesce(text, '')]
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) end as s
  from words),
sets as (select distinct list_sort(s) as s from shingled),
named as (select row_number() over (order by s) as k, s, len(s) as n from sets),
member as (select doc_id, k from shingled join named on list_sort(shingled.s) = named.s),
copies as (select k, count(*) as c from member group by k),
grams as (select k, n, unnest(s) as g from named),
pairs as (
  select a.k as i, b.k as j from grams a join grams b on a.g = b.g and a.k <> b.k
  where 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)
  group by a.k, b.k, a.n, b.n having 10 * count(*) >= 8 * (a.n + b.n - count(*))),
reach(i, j) as (select k, k from named union select reach.i, pairs.j from reach join pairs on reach.j = pairs.i),
class as (select i, min(j) as label from reach group by i),
links as (select i, sum(c) as links from pairs join copies on pairs.j = copies.k group by i),
label as (select label, min(doc_id) as class_id from class join member on class.i = member.k group by label)
select doc_id, class_id, cast(coalesce(links.links, 0) + copies.c - 1 as bigint) as n_links
from member join class on member.k = class.i join label using (label)
join copies on copies.k = member.k left join links on links.i = member.k""",
    "op11_collocations": r"""
with d as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from d),
words as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces),
sizes as (select lang, w, unnest([1, 2, 3, 4, 5]) as size from words),
grams as (
  select lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(list_slice(w, i, i + size - 1), ' '))) as phrase
  from sizes where len(w) >= size),
counts as (select lang, size, phrase, count(*) as f from grams group by all),
total as (select lang, sum(f) as n from counts where size = 1 group by lang),
often as (select lang, size, string_split(phrase, ' ') as w, phrase, f from counts where f >= 100),
inside as (
  select lang, f, size, unnest(list_transform(range(1, size), lambda k: k)) as k, w from often where size > 2),
parts as (
  select distinct lang, f, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase
  from (select lang, f, k, w, unnest(range(1, size - k + 2)) as i from inside)),
covered as (select distinct o.lang, o.phrase from often o join parts p on o.lang = p.lang and o.phrase = p.phrase where 100 * p.f >= 100 * o.f),
own as (select * from often anti join covered using (lang, phrase) where size > 1),
cuts as (select lang, phrase, f as a, w, size, unnest(range(1, size)) as k from own),
scored as (
  select c.lang, c.phrase, c.a, c.k, p.f as l, q.f as r, n, (cast(1000 as hugeint) * c.a * n) // (cast(p.f as hugeint) * q.f) as score
  from cuts c join total on total.lang = c.lang
  join often p on p.lang = c.lang and p.phrase = array_to_string(list_slice(c.w, 1, c.k), ' ')
  join often q on q.lang = c.lang and q.phrase = array_to_string(list_slice(c.w, c.k + 1, c.size), ' ')),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from ranked where rank <= 2000""",
    "op13_cuckoo": r"""
with own as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by t) as group_size,
  row_number() over best = 1 as kept, sha256(t) as text_sha256
from own window best as (partition by t order by doc_id nulls last rows between unbounded preceding and unbounded following)""",
    "op10_pivot_topk": """
with ints as (
  select distinct vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, q.v as asked, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from ints q join ints c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
ranked as (select *, row_number() over (partition by query_id, asked order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as int) as rank, vec_id, score from ranked where rank <= 10""",
}
