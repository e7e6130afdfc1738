"""DuckDB SQL of this folder's queries, where SQL can express them."""

from __future__ import annotations

MIX = r"""
with k as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5(concat_ws(':', 'mix-1', doc_id::varchar, text)) as key
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
         ((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1)::bigint as w
  from k group by source),
c as (
  select *, source_size * 3 as cap, sum(source_size) over () as total, sum(w) over () as all_w,
         coalesce(sum(source_size * 3) over b, 0) as cap_before, coalesce(sum(w) over b, 0) as w_before
  from s window b as (order by (source_size * 3)::double / w, encode(source) nulls last
                      rows between unbounded preceding and 1 preceding)),
d as (select *, cap * (all_w - w_before) <= (total - cap_before) * w as capped from c),
t as (
  select source, source_size,
         case when capped then cap::double
              else (max(case when not capped then total - cap_before end) over () * w)::double
                   / (max(case when not capped then all_w - w_before end) over ())::double end as target
  from d),
e as (
  select k.*, t.source_size, t.target,
         case when t.source_size > 0 then floor(t.target / t.source_size)::bigint else 0 end as epochs,
         count(*) over (partition by k.source, key) as same,
         sum(size) over (partition by k.source order by key)
           - count(*) over (partition by k.source, key) * size as start
  from k join t on k.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(floor(target)::bigint - epochs * source_size - start, same * size)) // same)::bigint as taken
from e
"""

URLS = r"""
with p as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
r(r_host, r_path, r_verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
n as (select *, row_number() over () as row from p),
m as (
  select n.row, r_host || r_path as rule, r_verdict,
         row_number() over (partition by n.row order by length(r_host || r_path) desc, length(r_host) desc) as place
  from n join r on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path))
select n.page_id, n.host, n.path, m.rule, coalesce(m.r_verdict, 'allow') as verdict
from n left join m on n.row = m.row and m.place = 1
"""

QUALITY = r"""
with d as (
  select row_number() over () as row, doc_id, source as host, coalesce(text, '') as text from documents),
w as (select row, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as word,
             generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) as i from d),
g as (select row, i, lead(i, 4) over o as last,
             word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o || ' '
                  || lead(word, 3) over o || ' ' || lead(word, 4) over o as gram
      from w window o as (partition by row order by i)),
c as (select row, i, count(*) over (partition by row, gram) as times from g where last is not null),
v as (select row, count(distinct i + k)::bigint as n_repeat_words
      from c, unnest([0, 1, 2, 3, 4]) as t(k) where times > 1 group by row),
l as (select row, doc_id, host, unnest(string_split(text, chr(10))) as raw from d),
x as (select row, doc_id, host, raw, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) as words,
             trim(regexp_replace(translate(regexp_replace(raw, '[\x09-\x0D]', ' ', 'g'),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' {2,}', ' ', 'g'), ' ') as line
      from l where regexp_matches(raw, '[^\x20\x09-\x0D]')),
u as (select row, (count(*) - count(distinct raw))::bigint as n_dup_lines from x group by row),
f as (select host, line from x group by host, line having count(distinct doc_id) > 20),
y as (select row, sum(words)::bigint as removed from x join f on x.host is not distinct from f.host and x.line = f.line group by row),
s as (select d.row, d.doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::bigint as n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
             coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
             coalesce(removed, 0) as n_removed_words
      from d left join u on d.row = u.row left join v on d.row = v.row left join y on d.row = y.row),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words, base_failed,
       not base_failed and not (n_words - n_removed_words < 10 or n_words - n_removed_words < 0.3::double * n_words) as kept
from b
"""

LLM_SQL: dict[str, str] = {"op5_mix_sources": MIX, "op6_url_filter": URLS, "op8_quality_rules": QUALITY}
