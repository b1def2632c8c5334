"""The registered queries that SQL can express, for a second engine to check on whole tables."""

from __future__ import annotations

from . import license

LINE_DEDUP = """
with d as materialized (
  select row_number() over () rid, doc_id, source, string_split(coalesce(text, ''), chr(10)) ls from documents),
p as (
  select rid, source, list_aggregate(list_transform(ls, lambda x: {'n': length(x), 'line': x}), 'max') page,
         unnest(list_distinct(ls)) line
  from d),
l as (
  select source, line, count(*) n, case when length(line) >= 20 then count(distinct page) end different from p
  where trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '' group by 1, 2),
t as (select source, count(*) pages from d group by 1),
b as (
  select l.source, list(line) bl from l join t on t.source is not distinct from l.source
  where n >= 5 and (n > 0.1e0 * pages or (different >= 5 and different > 0.01e0 * pages)) group by 1),
k as (
  select doc_id, d.source, ls, case when bl is null then ls else list_filter(ls, lambda x: not list_contains(bl, x)) end kept
  from d left join b on b.source is not distinct from d.source)
select doc_id, source, array_to_string(kept, chr(10)) as text, cast(len(ls) as bigint) n_lines,
       cast(len(ls) - len(kept) as bigint) n_dropped
from k
"""

CHAT_FORMATTING = """
with c as (
  select conv_id, turn, coalesce(role, 'user') role, coalesce(text, '') as text from conversations),
last as (select conv_id, max(turn) t, arg_max(text, turn) tx from c where role = 'assistant' group by 1),
sides as (
  select conv_id, 'chosen' side, turn, role, text from c
  union all
  select c.conv_id, 'rejected', c.turn, c.role,
         case when c.role = 'assistant' and c.turn = l.t then o.tx else c.text end
  from c left join last l on l.conv_id = c.conv_id left join last o on o.conv_id = xor(c.conv_id, 1)
  where l.t is null or c.turn < l.t or (c.role = 'assistant' and c.turn = l.t and o.conv_id is not null)),
p as (select *, row_number() over (partition by conv_id, side order by turn, role, text) place from sides),
a as (
  select conv_id, place, max(case when side = 'chosen' then role end) cr, max(case when side = 'chosen' then text end) ct,
         max(case when side = 'rejected' then role end) rr, max(case when side = 'rejected' then text end) rt
  from p group by 1, 2),
d as (
  select conv_id, cast(coalesce(min(case when cr is distinct from rr or ct is distinct from rt then place end) - 1,
         count(*)) as bigint) common
  from a group by 1),
r as (
  select p.conv_id, side, place, common, role, text, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) s,
         place <= common shared
  from p join d on d.conv_id = p.conv_id),
o as (
  select *, coalesce(sum(length(s)) over (partition by conv_id, side, shared order by place
         rows between unbounded preceding and 1 preceding), 0) + length('<|im_start|>' || role) + 1 first
  from r),
m as (
  select conv_id, side, shared, place, common, s, role,
         cast(first as bigint) || ':' || cast(first + length(text) + 10 as bigint) span
  from o)
select conv_id pair_id, common common_turns,
       coalesce(string_agg(s, '' order by place) filter (side = 'chosen' and shared), '') prompt,
       coalesce(string_agg(s, '' order by place) filter (side = 'chosen' and not shared), '') chosen_text,
       coalesce(string_agg(s, '' order by place) filter (side = 'rejected' and not shared), '') rejected_text,
       coalesce(string_agg(span, ',' order by place) filter (side = 'chosen' and not shared and role = 'assistant'), '')
         chosen_spans,
       coalesce(string_agg(span, ',' order by place) filter (side = 'rejected' and not shared and role = 'assistant'), '')
         rejected_spans
from m group by 1, 2
"""

JACCARD_JOIN = """
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') ws
  from documents),
s as (
  select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' ')) end) sh
  from w),
p as (select doc_id, len(sh) n, unnest(sh) g from s),
o as (
  select a.doc_id x, b.doc_id y, a.n na, b.n nb, count(*) k
  from p a join p b on a.g = b.g and a.doc_id < b.doc_id and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n
  group by 1, 2, 3, 4),
l as (select x, y from o where 100 * k >= 85 * (na + nb - k)),
e as (select x, y from l union all select y, x from l),
r as (select doc_id n, doc_id c from s union select e.y, r.c from r join e on e.x = r.n)
select s.doc_id, cast(len(sh) as bigint) n_shingles, min(r.c) component_id
from s join r on r.n = s.doc_id group by 1, 2
"""


SOURCE_DIVERGENCE = """
with d as materialized (
  select row_number() over () rid, coalesce(lang, '') lang, coalesce(source, '') source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') ts
  from documents),
t as (select rid, lang, source, unnest(ts) term from d),
voc as (select lang, term, count(*) total from t group by 1, 2 having count(distinct rid) >= 10),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) n from t group by 1, 2, 3),
v as (select lang, count(*) v, sum(total) n from voc group by 1),
dense as (
  select g.lang, g.source, voc.term, coalesce(c.n, 0) n, voc.total
  from g join voc on voc.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = voc.term),
s as (select lang, source, sum(n) n from dense group by 1, 2),
p as (
  select dense.lang, dense.source, term, dense.n k,
         1 + (1000000000::hugeint * (dense.n + 2)) // (s.n + 2 * v.v) p,
         1 + (1000000000::hugeint * (total + 2)) // (v.n + 2 * v.v) q
  from dense join s on s.lang = dense.lang and s.source = dense.source join v on v.lang = dense.lang),
pairs as (
  select a.lang, a.source, b.source item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) w
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join p x on x.lang = a.lang and x.source = a.source
  left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by 1, 2, 3),
terms as (select lang, source, term item, ((p - q) * (p - q)) // (p + q) w from p where k > 0 and p > q),
r as (
  select lang, source, 'pair' part, item, w, row_number() over (partition by lang, source order by w desc, item) r from pairs
  union all
  select lang, source, 'term', item, w, row_number() over (partition by lang, source order by w desc, item) from terms
  qualify row_number() over (partition by lang, source order by w desc, item) <= 10)
select lang, source, part, item, cast(w as bigint) as value, cast(r as integer) as rank from r
"""

LICENSE_SCAN = """
with p as (
  select pattern, base, label, string_split(words, ' ') ws, case when keys = '' then [] else string_split(keys, '|') end ks
  from (values {patterns}) t(pattern, base, label, words, keys)),
pu as (select pattern, base, unnest(ws) w, generate_subscripts(ws, 1) - 1 place from p),
d as materialized (
  select row_number() over () rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') dws
  from documents),
u as materialized (
  select rid, w, pos from (select rid, unnest(dws) w, generate_subscripts(dws, 1) - 1 pos from d) where w in (select w from pu)),
f as (select w, count(distinct rid) n from u group by 1),
rare as (
  select pattern, w from (
    select x.pattern, x.w, base, row_number() over (partition by x.pattern order by coalesce(n, 0), x.w) r
    from (select distinct pattern, base, w from pu) x left join f on f.w = x.w) y
  where r <= case when base then 1 else 4 end),
votes as (
  select distinct u.rid, pu.pattern, base, u.pos - pu.place as start, u.w
  from rare join pu on pu.pattern = rare.pattern and pu.w = rare.w join u on u.w = rare.w),
c as (
  select rid, pattern, start from votes group by rid, pattern, base, start
  having count(*) >= case when base then 1 else 2 end),
h as (
  select c.rid, start, base, label, ws, ks,
         list_transform(range(len(ws)), lambda j: case when start + j >= 0 then dws[start + j + 1] end) here
  from c join p on p.pattern = c.pattern join d on d.rid = c.rid),
m as (
  select *, len(list_filter(range(len(ws)), lambda j: here[j + 1] = ws[j + 1])) matched,
         ' ' || array_to_string(here, ' ') || ' ' window_text
  from h),
ok as (
  select rid, start, base, label, matched, len(ws) n from m
  where case when base then matched = len(ws) else 100 * matched >= 70 * len(ws)
             and len(list_filter(ks, lambda k: not contains(window_text, ' ' || k || ' '))) = 0 end),
s as (
  select rid, count(*) filter (base) n_base, min(start) filter (base) first_word, max(start) filter (base) last_word,
         string_agg(distinct label, ',' order by label) filter (base) base_labels,
         string_agg(distinct label, ',' order by label) labels, max(matched / n) filter (not base) share
  from ok group by 1)
select doc_id, cast(len(dws) as bigint) n_words, cast(coalesce(n_base, 0) as bigint) n_base, cast(first_word as bigint) first_word,
       cast(last_word as bigint) last_word, coalesce(base_labels, '') base_labels, coalesce(labels, '') labels,
       cast(coalesce(share, case when n_base > 0 then 0.5e0 end, 0e0) as double) score
from d left join s on s.rid = d.rid
""".replace(
    "{patterns}",
    ", ".join(
        f"({number}, {base}, '{label}', '{' '.join(words)}', '{'|'.join(keys)}')"
        for number, (label, base, words, keys) in enumerate(license.patterns())
    ),
)

FILL_IN_MIDDLE = """
with d as (
  select doc_id, coalesce(text, '') t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) x from documents),
h as (
  select doc_id, t, length(t) n, ('0x' || substr(x, 1, 8))::ubigint h1, ('0x' || substr(x, 9, 8))::ubigint h2,
         ('0x' || substr(x, 17, 8))::ubigint h3, ('0x' || substr(x, 25, 8))::ubigint h4
  from d),
f as (
  select *, cast(least(h1 % (n + 1), h2 % (n + 1)) as bigint) a, cast(greatest(h1 % (n + 1), h2 % (n + 1)) as bigint) b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end form
  from h),
o as (
  select *, substring(t, 1, a) p, substring(t, a + 1, b - a) m, substring(t, b + 1, n - b) s from f)
select doc_id, cast(n as bigint) n, form, case when form <> 'plain' then a end prefix_chars,
       case when form <> 'plain' then b - a end middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
       sha256(t) restored_sha256
from o
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_ngram_jaccard_join": JACCARD_JOIN,
        "op7_chat_formatting": CHAT_FORMATTING,
        "op9_line_dedup": LINE_DEDUP,
        "op11_source_divergence": SOURCE_DIVERGENCE,
        "op12_license_scan": LICENSE_SCAN,
        "op13_fill_in_middle": FILL_IN_MIDDLE,
    }
