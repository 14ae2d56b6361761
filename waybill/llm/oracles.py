"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = f"""
with recursive words as (
  select doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents
), grams as (
  select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 1) + 1),
    lambda i: array_to_string(w[i:i + 2], ' '))) as g from words where len(w) > 0
), sizes as (
  select doc_id, count(*) as n from grams group by doc_id
), links as (
  select a.doc_id as u, b.doc_id as v from grams a join grams b on a.g = b.g
  join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  where a.doc_id <> b.doc_id and 10 * least(x.n, y.n) >= 9 * greatest(x.n, y.n)
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reach as (
  select doc_id as u, doc_id as v from documents
  union
  select reach.u, links.v from reach join links on reach.v = links.u
)
select d.doc_id as doc_id, coalesce(max(s.n), 0) as n_shingles, min(r.v) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id join reach r on r.u = d.doc_id group by d.doc_id
"""

OP4 = r"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source
), weighted as (
  select *, cast([3, 1, 2][1 + cast((row_number() over (order by source is null, source) - 1) % 3 as int)] as double) as weight,
    2.0::double * source_size as stop from sources
), sums as (
  select *, coalesce(sum(stop) over (order by stop / weight, source is null, source
      rows between unbounded preceding and 1 preceding), 0.0::double) as before_stop,
    sum(weight) over (order by stop / weight, source is null, source rows between current row and unbounded following) as rest,
    cast(sum(source_size) over () as bigint) as total from weighted
), multiples as (
  select *, (1.5::double * total - before_stop) / rest as multiple from sums
), targets as (
  select source, source_size, least(stop, weight * (select max(multiple) from multiples)) as target,
    cast(('0x' || substr(md5('waybill-mix' || coalesce(source, '')), 1, 8)) as bigint)::double / 4294967296.0::double as shift
  from multiples
), ranked as (
  select s.doc_id, s.size, t.source_size, t.target, t.shift,
    case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as each,
    row_number() over (partition by s.source order by s.size, md5('waybill-mix' || coalesce(cast(s.doc_id as varchar), '')),
      s.doc_id nulls last) as rank
  from sized s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  cast(floor(each * rank + shift) - floor(each * (rank - 1) + shift) as bigint) * size as taken from ranked
"""

OP5 = """
with rows as (
  select row_number() over () as r, doc_id, source, text from documents
), lines as (
  select r, source, unnest(range(1, len(string_split(text, chr(10))) + 1)) as place, unnest(string_split(text, chr(10))) as line from rows
  where text is not null
), boilerplate as (
  select line from lines where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by line having count(distinct source) >= 10
), kept as (
  select r, cast(count(*) as bigint) as n_lines, cast(count(*) filter (line in (select line from boilerplate)) as bigint) as n_removed,
    coalesce(string_agg(line, chr(10) order by place) filter (line not in (select line from boilerplate)), '') as text
  from lines group by r
)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, kept.text as text
from rows left join kept on rows.r = kept.r
"""

ORACLES = {"op5_line_dedup": OP5, "op4_mix_sources": OP4, "op9_ngram_jaccard_join": OP9}
