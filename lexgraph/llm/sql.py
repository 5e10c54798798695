"""DuckDB SQL of the training-data queries that SQL can express on whole tables."""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^ \\t\\n\\x0B\\f\\r]+')"

BACKOFF = f"""
with docs as (select doc_id, {_WORDS} w from documents where doc_id is not null),
w as (select doc_id, unnest(w) a, unnest(range(len(w))) i from docs),
g as (select doc_id, i, a w1, lag(a) over p || ' ' || a w2, lag(a, 2) over p || ' ' || lag(a) over p || ' ' || a w3 from w window p as (partition by doc_id order by i)),
c1 as (select w1, count(*) n from g group by 1), d1 as (select doc_id, w1, count(*) n from g group by 1, 2),
c2 as (select w2, count(*) n from g where w2 is not null group by 1), d2 as (select doc_id, w2, count(*) n from g where w2 is not null group by 1, 2),
c3 as (select w3, count(*) n from g where w3 is not null group by 1), d3 as (select doc_id, w3, count(*) n from g where w3 is not null group by 1, 2),
total as (select count(*) n from w),
size as (select doc_id, len(w) n from docs),
f as (
  select g.doc_id, g.i, c1.n - d1.n f1, coalesce(c2.n - d2.n, 0) f2, coalesce(c3.n - d3.n, 0) f3, size.n own
  from g join c1 using (w1) join d1 using (doc_id, w1) join size using (doc_id)
  left join c2 on c2.w2 = g.w2 left join d2 on d2.doc_id = g.doc_id and d2.w2 = g.w2
  left join c3 on c3.w3 = g.w3 left join d3 on d3.doc_id = g.doc_id and d3.w3 = g.w3),
h as (select f.*, lag(f1) over p b1, lag(f2) over p b2, total.n all_words from f, total window p as (partition by doc_id order by i)),
s1 as (select *, case when f1 > 0 then ln(f1::double / (all_words - own)) else ln((f1 + 1)::double / (all_words - own + all_words)) end s1 from h),
s2 as (select *, case when f2 > 0 and b1 > 0 then ln(f2::double / b1) when i >= 1 then s1 + ln(0.4::double) else s1 end s2 from s1),
s3 as (select *, case when f3 > 0 and b2 > 0 then ln(f3::double / b2) when i >= 2 then s2 + ln(0.4::double) else s2 end s3 from s2)
select size.doc_id, size.n::bigint n_words, round(coalesce(sum(s3), 0), 4) log_score, round(sum(s3) / nullif(size.n, 0), 6) per_word
from size left join s3 using (doc_id) group by size.doc_id, size.n
"""

LINES = """
with d as (select doc_id, string_split(text, chr(10)) p from documents where doc_id is not null),
l as (select doc_id, unnest(range(len(p))) line_no, unnest(p) line from d where p is not null),
k as (select doc_id, line_no, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '[ \\t\\x0B\\f\\r]+'), lambda x: x <> ''))) ws from l),
s as (select *, len(ws) n, row_number() over (partition by ws order by doc_id, line_no) copy from k where len(ws) >= 5),
r as (select row_number() over (order by doc_id, line_no) id, doc_id, line_no, ws, n from s where copy = 1),
w as (select id, n, unnest(ws) w from r),
f as (select w, count(*) df from w group by 1),
h as (select id, n, w, row_number() over (partition by id order by df, w) p from w join f using (w)),
x as (select * from h where p <= n - ceil(n * 80 / 100.0) + 1),
c as (select distinct a.id a, b.id b from x a join x b on a.w = b.w and a.id > b.id and a.n * 100 >= b.n * 80 and b.n * 100 >= a.n * 80),
m as (select a.doc_id, a.line_no from c join r a on a.id = c.a join r b on b.id = c.b where len(list_intersect(a.ws, b.ws)) * 100 >= (a.n + b.n - len(list_intersect(a.ws, b.ws))) * 80),
gone as (select distinct doc_id, line_no from m union select doc_id, line_no from s where copy > 1),
g as (select doc_id, count(*) n, string_agg(line_no::varchar, ',' order by line_no) removed from gone group by 1)
select d.doc_id, coalesce(len(p), 0)::bigint n_lines, coalesce(g.n, 0)::bigint n_removed, coalesce(removed, '') removed from d left join g using (doc_id)
"""

NEAR = f"""
with recursive docs as (select doc_id, {_WORDS} w from documents where doc_id is not null),
s as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) g from docs),
n as (select doc_id, len(g) n from s),
u as (select doc_id, unnest(g) g from s),
p as (select a.doc_id a, b.doc_id b, count(*) c from u a join u b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b where 100 * c >= 80 * (x.n + y.n - c)),
link2 as (select a, b from e union select b, a from e),
reach(a, b) as (select a, b from link2 union select r.a, x.b from reach r join link2 x on r.b = x.a),
m as (select a doc_id, least(a, min(b)) component_id from reach group by a)
select n.doc_id, n.n::bigint n_shingles, coalesce(m.component_id, n.doc_id) component_id, coalesce(m.component_id, n.doc_id) = n.doc_id kept from n left join m using (doc_id)
"""

VECTORS = """
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) e from embeddings where label is not null and embedding is not null),
ok as (select * from v where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
e as (select a.vec_id a, b.vec_id b from ok a join ok b on a.label = b.label and a.vec_id < b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.98),
link2 as (select a, b from e union select b, a from e),
reach(a, b) as (select a, b from link2 union select r.a, x.b from reach r join link2 x on r.b = x.a),
m as (select a vec_id, least(a, min(b)) c from reach group by a), d as (select a vec_id, count(*) n from link2 group by 1)
select vec_id, coalesce(d.n, 0)::bigint n_links, coalesce(m.c, vec_id) component_id, coalesce(m.c, vec_id) = vec_id kept from embeddings left join m using (vec_id) left join d using (vec_id)
"""

MIXING = r"""
with recursive own as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+'))::bigint n_tokens from documents),
docs as (select * from own where n_tokens > 0),
sizes as (select source, count(*) n_docs, sum(n_tokens)::bigint n_tokens from docs group by 1),
f as (select list(source order by source) s, list(n_tokens::double order by source) t, sum(n_tokens)::double total from sizes),
p as (select s, total, list_transform(t, lambda x: x / total) p from f),
flat(i, lo, hi) as (select 0, 0.0::double, 1.0::double union all
  select i + 1, case when ok then (lo + hi) / 2 else lo end, case when ok then hi else (lo + hi) / 2 end from (
    select i, lo, hi, (select -list_sum(list_transform(list_transform(p, lambda x: pow(x, (lo + hi) / 2)), lambda y: y / list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2))) * ln(y / list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2)))))) from p)
      >= 0.98 * (select ln(len(p)) from p) ok from flat where i < 50)),
most(i, lo, hi) as (select 0, 0.0::double, 1.0::double union all
  select i + 1, case when bad then (lo + hi) / 2 else lo end, case when bad then hi else (lo + hi) / 2 end from (
    select i, lo, hi, (select list_max(list_transform(p, lambda x: pow(x, (lo + hi) / 2) / list_sum(list_transform(p, lambda y: pow(y, (lo + hi) / 2))) / x)) from p) > 4.0 bad from most where i < 50)),
a as (select greatest(
  case when (select -list_sum(list_transform(p, lambda y: y * ln(y))) >= 0.98 * ln(len(p)) from p) then 1.0 else (select lo from flat where i = 50) end,
  case when (select list_max(list_transform(p, lambda x: 1 / len(p) / x)) > 4.0 from p) then (select hi from most where i = 50) else 0.0 end) a),
w as (select unnest(s) source, unnest(list_transform(p, lambda x: pow(x, a.a) / list_sum(list_transform(p, lambda y: pow(y, a.a))))) w, total from p, a),
b as (select source, greatest(1, ceil(n_docs / 512.0))::bigint n_blocks, floor(w * total + 1e-6)::bigint // n_tokens whole, floor(w * total + 1e-6)::bigint % n_tokens rest from w join sizes using (source)),
dealt as (select doc_id, source, n_tokens, ('0x' || substr(md5(concat_ws(':', doc_id::varchar, '0')), 1, 12))::bigint % n_blocks block, whole, rest from docs join b using (source)),
blocks as (select source, block, sum(n_tokens) t, md5(concat_ws(':', source, block::varchar, '0')) o from dealt group by 1, 2),
starts as (select source, block, coalesce(sum(t) over (partition by source order by o, block rows between unbounded preceding and 1 preceding), 0) before from blocks),
inside as (select d.*, before, coalesce(sum(n_tokens) over (partition by d.source, d.block order by md5(concat_ws(':', doc_id::varchar, '1')), doc_id, n_tokens rows between unbounded preceding and 1 preceding), 0) inner_sum from dealt d join starts using (source, block))
select doc_id, source, n_tokens, whole epoch from inside where before + inner_sum < rest
union all select doc_id, source, n_tokens, unnest(range(whole)) from dealt where whole > 0
"""
