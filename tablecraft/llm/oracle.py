"""DuckDB counterparts of the queries that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_mix_sources"] = r"""
with d as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 9))::bigint as draw
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
p as (select *, row_number() over (order by source asc nulls last) - 1 as place from s),
w as (select *, [5, 2, 1][(place % 3 + 1)::int]::bigint as weight, source_size * 3 as most, sum(source_size) over ()::bigint as total from p),
f as (
  select *,
    coalesce(sum(most) over (order by most / weight, place rows between unbounded preceding and 1 preceding), 0)::bigint as most_before,
    sum(weight) over (order by most / weight, place rows between current row and unbounded following)::bigint as weight_left
  from w),
g as (select *, most::double * weight_left <= (total - most_before)::double * weight as is_full from f),
h as (
  select *, sum(case when is_full then most else 0 end) over ()::bigint as full_most,
    sum(case when is_full then 0 else weight end) over ()::bigint as open_weight
  from g),
t as (
  select source, source_size,
    case when is_full then most::double else (total - full_most)::double * weight / open_weight::double end as target
  from h),
c as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from t),
b as (select *, target - whole * source_size as budget from c),
r as (
  select d.*, b.source_size, b.target, b.whole, b.budget,
    sum(size) over (partition by d.source order by draw range between unbounded preceding and current row)::bigint as reached,
    sum(size) over (partition by d.source, draw)::bigint as width,
    coalesce(sum(size) over (partition by d.source, draw order by size, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as ahead
  from d join b on d.source is not distinct from b.source),
e as (select source, min(draw) as last_draw from r where reached > budget and budget > 0 group by source),
k as (
  select r.*, whole + case
    when e.last_draw is null then 0
    when draw < e.last_draw then 1
    when draw = e.last_draw and budget - (reached - width) - ahead >= size / 2 then 1
    else 0 end as copies
  from r left join e on r.source is not distinct from e.source)
select doc_id, size, source_size, target, (copies * size)::bigint as taken, source, copies::bigint as copies from k
"""

ORACLE_SQL["op5_exact_dedup"] = """
with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)
"""

ORACLE_SQL["op12_contamination"] = r"""
with d as (
  select doc_id, row_number() over () as row_no,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
b as (
  select coalesce(item_id::varchar, '') as item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
bw as (
  select distinct item, least(len(words), 10) as n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') as shown
  from (select *, unnest(range(1, greatest(len(words) - 10, 0) + 2)) as i from b where len(words) > 0)),
sizes as (select distinct n from bw),
dw as (
  select row_no, i, n, array_to_string(words[i:i + n - 1], ' ') as shown
  from (select row_no, words, n, unnest(range(1, len(words) - n + 2)) as i from d cross join sizes where len(words) >= n)),
found as (select row_no, i, n, item from dw join bw using (n, shown)),
hit as (
  select row_no, count(distinct place) as n_hit
  from (select row_no, unnest(range(i, i + n)) as place from (select distinct row_no, i, n from found)) group by row_no),
items as (
  select row_no, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
  from (select distinct row_no, item from found) group by row_no)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (row_no) left join items using (row_no)
"""
