"""DuckDB SQL for the queries that SQL can express.

The others need a tokenizer, a hash that DuckDB lacks, a fitted model or an
alignment; tests hold them against brute-force versions.
"""

from __future__ import annotations

#: SHA-1 has 40 hex digits; five of them are 20 bits, which are four base-32 letters.
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(x, (i // 4 * 5 + 1)::int, 5))::bigint >> ((3 - i % 4) * 5)::int) & 31)::int, 1)), '')"""

ORACLE: dict[str, str] = {
    "op3_warc_archives": f"""
with p as (select page_id, coalesce(html, '') h from pages),
d as (select page_id, octet_length(encode(h)) b, sha1(h) x, max(page_id) over (partition by h) w from p)
select page_id, b::bigint payload_bytes, {_BASE32} payload_digest,
  case when w is null or page_id = w then 'response' else 'revisit' end record_type,
  case when w is null or page_id = w then null else w end refers_to
from d""",
    # crc32 by its table: 256 remainders of the polynomial 0xEDB88320.
    "op11_spelling_variants": r"""
with recursive
table_of(k, c) as (
  select i, i from range(256) t(i)),
step(k, c, r) as (
  select k, c, 0 from table_of
  union all
  select k, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, r + 1 from step where r < 8),
crc_table as (select list(c order by k) as t from step where r = 8),
runs as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
  from documents),
distinct_runs as (
  select run, count(*) as n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as bytes
  from runs group by doc_id, run),
hashed as (
  select run, n, xor(4294967295, list_reduce(
    list_transform(range(0, length(bytes), 2), lambda i: ('0x' || substr(bytes, i::int + 1, 2))::bigint),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295)) as h
  from distinct_runs, crc_table),
words as (
  select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word,
         sum(n)::bigint as n
  from hashed group by 1 having length(word) >= 6 and sum(n) >= 5),
gaps as (
  select word, n, i, substr(word, 1, i::int) as l, substr(word, i::int + 2) as r
  from (select word, n, unnest(range(length(word))) as i from words)),
near as (
  select a.word, b.word as near, b.n as near_n from gaps a join gaps b using (l, r) where a.word <> b.word
  union select a.word, b.word, b.n from gaps a join words b on a.l || a.r = b.word
  union select b.word, a.word, a.n from gaps a join words b on a.l || a.r = b.word),
best as (
  select word, count(*) as n_near, max(near_n) as best_n from near group by word),
formed as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near,
         (select min(x.near) from near x where x.word = w.word and x.near_n = b.best_n and b.best_n >= 5 * w.n) as form,
         case when b.best_n >= 5 * w.n then b.best_n end as form_n
  from words w left join best b using (word)),
up(word, top, depth) as (
  select word, word, 0 from formed
  union all
  select u.word, f.form, depth + 1 from up u join formed f on f.word = u.top where f.form is not null)
select f.word, f.form, (select arg_max(u.top, u.depth) from up u where u.word = f.word) as root, f.n, f.n_near, f.form_n
from formed f""",
    "op12_minhash_near_dedup": r"""
with recursive
lists as (
  select doc_id, row_number() over () as r, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, r, case when coalesce(length(w), 0) = 0 then [] when length(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, length(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as s
  from lists),
sorted as (select doc_id, r, length(s) as n, md5(array_to_string(list_sort(s), chr(10))) as k, s from sets),
kinds as (select k, any_value(n) as n, any_value(s) as s, min(doc_id) as id from sorted where n > 0 group by k),
items as (select k, n, unnest(s) as g from kinds),
links as (
  select a.k as x, b.k as y from items a join items b on a.g = b.g and a.k <> b.k
  where 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.k, a.n, b.k, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(x, y) as (
  select k, k from kinds
  union
  select r.x, l.y from reach r join links l on l.x = r.y),
roots as (select r.x as k, min(t.id) as component_id from reach r join kinds t on t.k = r.y group by r.x)
select s.doc_id, s.n as n_shingles, case when s.n = 0 then s.doc_id else t.component_id end as component_id,
  (case when s.n = 0 then s.doc_id else t.component_id end) is not distinct from s.doc_id as kept
from sorted s left join roots t on t.k = s.k and s.n > 0""",
}
