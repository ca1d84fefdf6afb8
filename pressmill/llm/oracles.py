"""SQL (DuckDB) that gives the rows of the queries it can express."""

ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORDS = rf"regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = rf"""
with d as (select row_number() over () as r, doc_id, coalesce({ITEM_WORDS}, []) as w from documents),
b as (select item_id, w, least(len(w), 13) as n from (select item_id, {ITEM_WORDS} as w from benchmark) where len(w) > 0),
bw as (select distinct cast(item_id as varchar) as item, n, list_slice(w, i, i + n - 1) as g
       from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from b)),
lens as (select distinct n from bw),
dw as (select r, n, i, list_slice(w, i, i + n - 1) as g
       from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lens where len(w) >= n)),
hits as (select r, dw.n, i, item from dw join bw on dw.n = bw.n and dw.g = bw.g),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r),
items as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as s from hits group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(s, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (r) left join items using (r)
"""

OP6 = """
with d as (select row_number() over () as r, doc_id, text, string_split(text, chr(10)) as l from documents),
lines as (select r, i, l[i] as line, greatest(length(l[i]), 8) as x from (select r, l, unnest(range(1, len(l) + 1)) as i from d)),
ahead as (select a.r, a.i, a.i + k as e, sum(b.x) as s from lines a, (select unnest(range(0, 8)) as k)
          join lines b on b.r = a.r and b.i between a.i and a.i + k where exists (select 1 from d where d.r = a.r and len(d.l) >= a.i + k)
          group by a.r, a.i, k),
behind as (select a.r, a.i - k as i, a.i as e, sum(b.x) as s from lines a, (select unnest(range(0, 8)) as k)
          join lines b on b.r = a.r and b.i between a.i - k and a.i where a.i - k >= 1 group by a.r, a.i, k),
win as (select r, i, min(e) as e from ahead where s >= 64 group by r, i
        union select r, max(i) as i, e from behind where s >= 64 group by r, e),
keyed as (select win.r, doc_id, win.i, win.e, list_slice(l, win.i, win.e) as g from win join d using (r)),
later as (select r, i, e from (select *, row_number() over (partition by g order by doc_id, r, i) as n from keyed) where n > 1),
gone as (select distinct r, unnest(range(i, e + 1)) as i from later),
kept as (select r, string_agg(line, chr(10) order by i) as t from lines where not exists (select 1 from gone where gone.r = lines.r and gone.i = lines.i) group by r),
n as (select r, count(*) as n from gone group by r)
select doc_id, cast(coalesce(len(l), 0) as bigint) as n_lines, cast(coalesce(n, 0) as bigint) as n_deleted,
  cast(coalesce(length(t), 0) as bigint) as kept_chars, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (r) left join n using (r)
"""

OP10 = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text,
             coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
win as (select r, i, list_slice(w, i, i + 2) as g from (select r, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)),
rep as (select r, i from (select r, i, count(*) over (partition by r, g) as n from win) where n > 1),
words as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 3)) as p from rep) group by r),
lines as (select r, line from (select r, unnest(string_split(text, chr(10))) as line from d where text <> '')),
dup as (select r, count(*) as n_lines, count(*) filter (regexp_matches(line, '[^\x20\x09-\x0D]'))
          - count(distinct line) filter (regexp_matches(line, '[^\x20\x09-\x0D]')) as n from lines group by r),
m as (select doc_id, cast(len(w) as bigint) as n_words, cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
        cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, coalesce(n_lines, 0) as n_lines,
        coalesce(dup.n, 0) as n_dup_lines, coalesce(words.n, 0) as n_repeat_words,
        cast(len(list_filter(w, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) as bigint) as n_letter_words
      from d left join words using (r) left join dup using (r)),
f as (select *, (n_words < 50)::bigint + 2 * (100 * n_repeat_words > 50 * n_words)::bigint + 4 * (n_words > 100000)::bigint
        + 8 * (word_chars < 2 * n_words)::bigint + 16 * (word_chars > 20 * n_words)::bigint + 32 * (10 * n_symbols > n_words)::bigint
        + 64 * (10 * n_dup_lines > 5 * n_lines)::bigint + 128 * (10 * n_letter_words < 6 * n_words)::bigint as failed from m)
select *, (failed & 3) <> 0 as base_failed, failed = 0 as kept from f
"""
