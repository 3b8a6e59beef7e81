"""DuckDB SQL for those training-data queries that SQL can express.

op3 (fitted model), op5 (edit distance of any stretch), op6 (tokenizer), op7
(CRC-32), op9 (HTML), op10 and op12 (SimHash) have none; tests compare them with
brute force.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
with recursive
w as (
  select doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as ws
  from documents),
s as (
  select distinct doc_id, case when len(ws) < 5 then array_to_string(ws, ' ')
         else array_to_string(ws[i + 1 : i + 5], ' ') end as sh
  from (select doc_id, ws, unnest(range(greatest(1, len(ws) - 4))) as i from w where len(ws) > 0)),
d as (select doc_id, count(*) as n, md5(string_agg(sh, chr(31) order by sh)) as k from s group by doc_id),
c as (select k, min(doc_id) as rep, any_value(n) as n from d group by k),
cs as (select c.rep, c.n, s.sh from c join s on s.doc_id = c.rep),
common as (
  select a.rep as a, b.rep as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as x
  from cs a join cs b on a.sh = b.sh and a.rep < b.rep group by a.rep, b.rep),
links as (select a, b from common where 100 * x >= 85 * (na + nb - x)),
edges as (select a, b from links union select b, a from links),
reach(node, seen) as (
  select rep, rep from c
  union
  select r.node, e.b from reach r join edges e on e.a = r.seen),
comp as (select node, min(seen) as component from reach group by node)
select doc.doc_id, coalesce(d.n, 0)::bigint as n_shingles,
       coalesce(comp.component, doc.doc_id) as component_id,
       doc.doc_id = coalesce(comp.component, doc.doc_id) as kept
from documents doc left join d on d.doc_id = doc.doc_id
left join c on c.k = d.k left join comp on comp.node = c.rep
"""

OP2 = rf"""
with recursive
docs as (
  select doc_id, case when source is null then 't' else 's' || source end as sk,
         coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size from documents),
src as (
  select sk, sum(size)::bigint as s, [5, 2, 1][1 + (row_number() over (order by sk) - 1) % 3] as w
  from docs group by sk),
-- sources are capped in the order of 3 * size / weight until the common share fits all others
ratio as (
  select *, 3.0 * s / w as r, sum(s) over () as total from src),
sorted as (
  select *, sum(3 * s) over (order by r, sk rows unbounded preceding) - 3 * s as full_before,
         sum(w) over (order by r desc, sk desc rows unbounded preceding) as free_from from ratio),
cut as (
  select min(r) as r from sorted where w::hugeint * (total - full_before) <= 3 * s::hugeint * free_from),
tgt as (
  select ratio.sk, s, ratio.r < cut.r as capped, w from ratio, cut),
rest as (
  select sum(s) - 3 * coalesce(sum(s) filter (where capped), 0) as left_over,
         sum(w) filter (where not capped) as free, sum(s) as total from tgt),
target as (
  select sk, s, case when capped then (3 * s)::double
         else (w * left_over)::double / free::double end as target, total from tgt, rest),
blk as (
  select *, greatest(ceil(s::double / b), least(s, 256))::bigint as nb
  from (select *, least(2048, greatest(1, total // 131072)) as b from target)),
share as (
  select *, case when s > 0 then target * nb / s else 0.0 end as share from blk),
placed as (
  select *, coalesce(sum(share) over (order by sk rows between unbounded preceding and 1 preceding), 0) as before,
         sum(share) over () as ideal from share),
slots as (
  select i as slot, (i * 2654435769) % 4294967296 as p
  from (select unnest(range(round((select max(ideal) from placed))::bigint)) as i)),
owned as (
  select slot, sk, nb from slots join (
    select sk, nb, floor(before * (4294967296.0 / ideal)) as lo,
           case when before + share >= ideal * (1 - 1e-12) then 4294967296.0
                else floor((before + share) * (4294967296.0 / ideal)) end as hi
    from placed where share > 0) on p >= lo and p < hi),
laps as (
  select sk, k, count(*) as laps from (
    select sk, r % nb as k, r // nb as lap
    from (select sk, nb, row_number() over (partition by sk order by slot) - 1 as r from owned))
  where lap < 3 group by sk, k),
stream as (
  select doc_id, docs.sk, size, s, target, nb, coalesce(sum(size) over (
    partition by docs.sk order by ('0x' || substr(md5(concat_ws(chr(31), doc_id, docs.sk, size)), 1, 8))::bigint,
    doc_id, size rows between unbounded preceding and 1 preceding), 0) as a
  from docs join blk on blk.sk = docs.sk),
piece as (
  select doc_id, sk, a, size, s, nb, unnest(range((a::hugeint * nb // s)::bigint,
         ((a + size - 1)::hugeint * nb // s)::bigint + 1)) as k from stream where size > 0),
got as (
  select doc_id, sum(laps * (least(a + size, ((k + 1)::hugeint * s + nb - 1) // nb)
                             - greatest(a, (k::hugeint * s + nb - 1) // nb)))::bigint as taken
  from piece join laps using (sk, k) group by doc_id)
select doc_id, size, s as source_size, target, coalesce(taken, 0)::bigint as taken
from stream left join got using (doc_id)
"""

OP4 = r"""
with cut as (
  select doc_id, regexp_extract_all(text, '\n|[^\n]+?(?:[.!?][ \t]+|\n|\z)') as us
  from documents where text is not null),
units as (select doc_id, unnest(us) as t, unnest(range(len(us))) as unit from cut),
placed as (
  select doc_id, unit, regexp_extract_all(lower(t), '[^\s]+') as ws, length(t) - ends_with(t, chr(10))::int as n,
         coalesce(sum(length(t)) over (partition by doc_id order by unit
                  rows between unbounded preceding and 1 preceding), 0) as start
  from units),
hashed as (
  select doc_id, unit, start, start + n as "end", len(ws) as words, md5(array_to_string(ws, ' ')) as digest
  from placed where len(ws) >= 7),
ranked as (
  select *, row_number() over (partition by digest order by doc_id, unit) as place,
         first_value(doc_id) over (partition by digest order by doc_id, unit) as kept_doc_id,
         first_value(unit) over (partition by digest order by doc_id, unit) as kept_unit
  from hashed)
select doc_id, unit, start::bigint as start, "end"::bigint as "end", words, digest, kept_doc_id, kept_unit
from ranked where place > 1
"""

OP8 = r"""
with split as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
address as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from split),
rules(h, p, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fit as (
  select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(verdict, length(h || p)) as verdict
  from (select distinct page_id, host, path from address) join rules
    on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id)
select a.page_id, host, path, rule, coalesce(verdict, case
  when regexp_matches(lower(path), '/(login|signin|signup|cart|checkout|search)(/|$)')
    or regexp_matches(lower(host || path), '(^|[./])(ads|adserver|casino|porn|xxx)([./]|$)')
    or regexp_matches(lower(host || path), '\.(zip|exe|jpg|png|gif|mp4)$') then 'block'
  else 'allow' end) as verdict
from address a left join fit using (page_id)
"""


OP11 = r"""
with
pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
total as (select lang, sum(len(ws))::bigint as n from w group by lang),
f as materialized (
  select lang, k, phrase, count(*) as f from (
    select lang, k, array_to_string(ws[i : i + k - 1], ' ') as phrase from (
      select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w, (select unnest(range(1, 5)) as k)))
  group by all having count(*) >= 30),
cuts as (
  select lang, phrase, f as a, c, array_to_string(p[1 : c], ' ') as first, array_to_string(p[c + 1 : k], ' ') as rest from (
    select *, string_split(phrase, ' ') as p, unnest(range(1, k)) as c from f where k > 1)),
best as (
  select cuts.lang, cuts.phrase, a, min(struct_pack(score := (2000000::hugeint * a) // (x.f + y.f), c := c, l := x.f, r := y.f)) as b
  from cuts join f x on x.lang = cuts.lang and x.phrase = first join f y on y.lang = cuts.lang and y.phrase = rest
  group by cuts.lang, cuts.phrase, a),
parts as (
  select lang, part, max(f) as f from (
    select lang, f, array_to_string(p[i : i + m - 1], ' ') as part from (
      select *, unnest(range(1, k - m + 2)) as i from (
        select *, string_split(phrase, ' ') as p, unnest(range(2, k)) as m from f where k > 2)))
  group by all),
ranked as (
  select best.lang, best.phrase, a, b.l as l, b.r as r, b.score::bigint as score, row_number() over (
    partition by best.lang order by b.score desc, a desc, best.phrase) as rank
  from best left join parts on parts.lang = best.lang and part = best.phrase
  where parts.f is null or 100 * parts.f::hugeint < 80 * a::hugeint)
select ranked.lang, rank, phrase, a, l, r, n, score from ranked join total on total.lang = ranked.lang where rank <= 2000
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain k-means in whole numbers: every part against every entry, round by round."""
    steps = [f"""
kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pieces as materialized (
  select vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] as c
  from kept, (select unnest(range({parts})) as p)),
b0 as materialized (
  select p, row_number() over (partition by p order by vec_id) - 1 as e, c from pieces
  where vec_id in (select vec_id from kept order by vec_id limit {entries}))"""]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} as materialized (
  select vec_id, p, any_value(c) as c, min(struct_pack(d := d, e := e)) as best from (
    select x.vec_id, x.p, x.c, b.e,
           coalesce(list_sum(list_transform(list_zip(x.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0) as d
    from pieces x join b{k} b on b.p = x.p) group by vec_id, p)""")
        if k < rounds:
            steps.append(f"""
b{k + 1} as materialized (
  select b.p, b.e, coalesce(n.c, b.c) as c from b{k} b left join (
    select p, e, list(m order by i) as c from (
      select p, e, i, (s - ((s % n) + n) % n) // n as m from (
        select p, best.e as e, i, sum(c[i])::hugeint as s, count(*) as n
        from a{k}, unnest(range(1, len(c) + 1)) as t(i) group by all)) group by p, e) n on n.p = b.p and n.e = b.e)""")
    return f"""with {",".join(steps)},
coded as (
  select vec_id, string_agg(printf('%02x', best.e), '' order by p) as code, sum(best.d)::bigint as error
  from a{rounds} group by vec_id),
joined as (select k.vec_id, k.label, code, error from kept k join coded using (vec_id)),
books as (
  select sha256(string_agg(x, ',' order by p, e, i)) as digest from (
    select p, e, unnest(range(1, len(c) + 1)) as i, unnest(c)::varchar as x from b{rounds}))
select vec_id, code, error, label, sum(error) over (partition by label)::bigint as label_error, digest as codebooks_sha256
from joined, books"""


OP13 = _vector_codes()

ORACLES: dict[str, str] = {
    "op1_near_duplicates": OP1,
    "op2_mix_sources": OP2,
    "op4_repeated_lines": OP4,
    "op8_url_rules": OP8,
    "op11_phrases": OP11,
    "op13_vector_codes": OP13,
}
