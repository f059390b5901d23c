"""DuckDB statements equal to the queries of this subpackage, where SQL can express them."""

from __future__ import annotations

from hourcast.llm.line_dedup import Winnow

_CFG = Winnow()
_WHITE = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL: dict[str, str] = {}

# Lines end after a line feed or after . ! ? and a space; U+0001, which no text holds, marks the ends.
# From the definition: equal lines of any two places make diagonals, their runs count from min_chars characters on.
SQL["op1_line_dedup"] = rf"""with docs as (select doc_id, coalesce(text, '') as text, dense_rank() over (order by doc_id, coalesce(text, '')) as d from documents),
parts as (select d, unnest(list_filter(string_split(regexp_replace(text, '([.!?] |\n)', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')) as part,
                 generate_subscripts(list_filter(string_split(regexp_replace(text, '([.!?] |\n)', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> ''), 1) as nth
          from (select distinct d, text from docs)),
h as (select d, trim(part, {_WHITE}) as line, length(trim(part, {_WHITE})) as n, row_number() over (partition by d order by nth) - 1 as p
      from parts where trim(part, {_WHITE}) <> ''),
eq as (select x.d, x.p, x.n, y.d as e, x.p - y.p as shift, x.p - row_number() over (partition by x.d, y.d, x.p - y.p order by x.p) as run
       from h x join h y on x.line = y.line and (y.d < x.d or y.d = x.d and y.p < x.p)),
runs as (select d, min(p) as a, max(p) as b from eq group by d, e, shift, run having sum(n) >= {_CFG.min_chars}),
gone as (select distinct h.d, h.p, h.n from runs join h on h.d = runs.d and h.p between runs.a and runs.b),
per as (select d, count(*) as n_dropped, sum(n)::bigint as dropped_chars, string_agg(p, ',' order by p) as dropped from gone group by d)
select doc_id, (select count(*) from h where h.d = docs.d) as n_lines, coalesce(n_dropped, 0) as n_dropped,
       coalesce(dropped_chars, 0) as dropped_chars, coalesce(dropped, '') as dropped
from docs left join per using (d)"""

# Shingles as text, links by counting shared ones, components by spreading the smallest id.
SQL["op4_ngram_join"] = r"""with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\x20\x09-\x0D]+'), lambda s: s <> '') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
             else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from w),
e as (select doc_id, len(s) as n, unnest(s) as t from s),
pairs as (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as shared
          from e a join e b on a.t = b.t and a.doc_id < b.doc_id group by all),
links as (select a, b from pairs where 100 * shared >= 75 * (na + nb - shared)),
two as (select a, b from links union all select b, a from links),
reach as (select doc_id as x, doc_id as y from s union select reach.x, two.b from reach join two on two.a = reach.y)
select s.doc_id, len(s.s)::bigint as n_shingles, c.component_id
from s join (select x, min(y) as component_id from reach group by x) c on c.x = s.doc_id"""

SQL["op9_exact_top_k"] = """with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select vec_id as query_id, min(v) as q from v where vec_id % 50 = 0 group by vec_id),
s as (select query_id, vec_id, list_dot_product(q::double[], v::double[])::bigint as score
      from q join v on v.vec_id <> q.query_id and len(v) = len(q)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5"""

SQL["op11_hard_negatives"] = """with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
a as (select vec_id as anchor_id, min({'l': label, 'v': v}) as a from v where vec_id % 50 = 0 group by vec_id),
s as (select anchor_id, vec_id, label = a.l as same, list_dot_product(a.v::double[], v::double[])::bigint as score
      from a join v on v.vec_id <> a.anchor_id and len(v) = len(a.v)),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 100 * score between 50 * positive_score and 95 * positive_score
qualify rank <= 3"""
