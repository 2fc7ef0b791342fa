"""SQL twins of the corpus queries that SQL can express."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"

# Which documents a mix takes is seeded; its source sizes have a twin, used in the tests.
SOURCE_SIZES = f"""
select source, sum(len(regexp_extract_all(coalesce(text, ''), '{NOT_SPACE}')))::bigint as source_size
from documents group by source order by source nulls last
"""

ORACLE = {
    "op3_line_dedup": """
with lines as (
  select doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos, unnest(string_split(text, chr(10))) as line
  from documents where text is not null
), ahead as (
  select doc_id, pos, line, lead(line, 1) over w as l1, lead(line, 2) over w as l2
  from lines window w as (partition by doc_id order by pos)
), runs as (
  select doc_id, pos, 3 as n, line, l1, l2 from ahead where l2 is not null
  union all select doc_id, pos, 2, line, l1, null from ahead where l1 is not null and length(line) + length(l1) >= 200
  union all select doc_id, pos, 1, line, null, null from ahead where length(line) >= 200
), firsts as (
  select n, line, l1, l2, min(struct_pack(doc_id := doc_id, pos := pos)) as f from runs group by all
), later as (
  select r.doc_id, r.pos, r.n from runs r join firsts f
  on r.n = f.n and r.line = f.line and r.l1 is not distinct from f.l1 and r.l2 is not distinct from f.l2
  where r.doc_id <> f.f.doc_id or f.f.pos + r.n <= r.pos
), gone as (
  select distinct doc_id, pos + k as pos from later, (values (0), (1), (2)) t(k) where k < n
), heads as (
  select doc_id, count(*) as n_runs from gone g
  where not exists (select 1 from gone h where h.doc_id = g.doc_id and h.pos = g.pos - 1) group by doc_id
), per_doc as (
  select l.doc_id, count(*) as n_lines, count(g.pos) as n_removed,
         string_agg(l.line, chr(10) order by l.pos) filter (where g.pos is null) as kept
  from lines l left join gone g using (doc_id, pos) group by l.doc_id
)
select d.doc_id, coalesce(p.n_lines, 0)::bigint as n_lines, coalesce(p.n_removed, 0)::bigint as n_removed,
       coalesce(h.n_runs, 0)::bigint as n_runs, sha256(coalesce(p.kept, '')) as kept_sha256
from documents d left join per_doc p using (doc_id) left join heads h using (doc_id)
""",
    "op5_decontaminate": f"""
with items as (
  select item_id, {_WORDS} as ws from benchmark
), windows as (
  select distinct item_id, least(len(ws), 13) as n, array_to_string(list_slice(ws, i, i + least(len(ws), 13) - 1), ' ') as w
  from (select item_id, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) as i from items where len(ws) > 0)
), docs as (
  select doc_id, {_WORDS} as ws from documents
), grams as (
  select doc_id, n, pos, array_to_string(list_slice(ws, pos, pos + n - 1), ' ') as w
  from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as pos
        from docs, (select distinct n from windows) where len(ws) >= n)
), hits as (
  select g.doc_id, g.pos, g.n, b.item_id from grams g join windows b on g.n = b.n and g.w = b.w
), covered as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(pos, pos + n)) as place from (select distinct doc_id, pos, n from hits)) group by doc_id
), named as (
  select doc_id, count(distinct item_id) as n_items,
         array_to_string(list_sort(list_distinct(list(item_id::varchar))), ',') as ids from hits group by doc_id
)
select d.doc_id, len(d.ws)::bigint as n_words, coalesce(c.n_hit, 0)::bigint as n_hit, coalesce(n.n_items, 0)::bigint as n_items,
       sha256(coalesce(n.ids, '')) as items_sha256,
       coalesce(c.n_hit, 0) > 0 and 20 * coalesce(c.n_hit, 0) >= len(d.ws) as contaminated
from docs d left join covered c using (doc_id) left join named n using (doc_id)
""",
    "op6_exact_dedup": f"""
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g')) as text_sha256,
         length(coalesce(text, '')) as n_chars from documents
), g as (
  select text_sha256, count(*)::bigint as group_size, arg_min(doc_id, struct_pack(c := -n_chars, i := doc_id)) as keep_id
  from d group by text_sha256
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)
""",
    "op12_ngram_join": f"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{NOT_SPACE}') as ws from documents
), sets as (
  select doc_id, list_distinct(case when len(ws) >= 5 then [array_to_string(list_slice(ws, i, i + 4), ' ') for i in range(1, len(ws) - 3)]
                                    when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s from docs
), grams as (
  select doc_id, unnest(s) as g from sets
), links as (
  select a.doc_id as x, b.doc_id as y
  from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
  join sets sa on sa.doc_id = a.doc_id join sets sb on sb.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, len(sa.s), len(sb.s)
  having 100 * count(*) >= 80 * (len(sa.s) + len(sb.s) - count(*))
), reach(x, y) as (
  select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x
)
select d.doc_id, len(d.s)::bigint as n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) as component_id
from sets d left join reach r on r.x = d.doc_id group by d.doc_id, len(d.s)
""",
}
