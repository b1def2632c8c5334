"""The registered queries as plain SQL over the same tables, for a second engine to check."""

from __future__ import annotations

from weftable.bindings import tables as t


def _values(rows, columns: str) -> str:
    def cell(x):
        if x is None:
            return "cast(null as varchar)"
        return f"'{x}'" if isinstance(x, str) else str(x)

    body = ", ".join("(" + ", ".join(cell(x) for x in row) + ")" for row in rows)
    return f"(select * from (values {body}) as v({columns}))"


def _numbered(codes) -> str:
    return _values(list(enumerate(codes)), "i, code")


BASE = """
with fold as (
  select n_nationkey k, case when r_name in ('EUROPE','ASIA','AMERICA') then n_name else 'ROW' end c
  from nation join region on n_regionkey = r_regionkey),
br as (select distinct p_brand lib, cast(substring(p_brand, 7) as int) b from part),
ind as (
  select p_type industry, row_number() over (order by p_type) - 1 i from (select distinct p_type from part) x),
xw as (
  select lib, industry from br join ind on b % 6 = i
  union all
  select lib, industry from br join ind on b % 5 = 0 and (b + 1) % 6 = i),
flows as (
  select s_nationkey rn, fs.c rc, p_brand rs, p_type rt, cast(substring(p_brand, 7) as int) - 1 ri,
         c_nationkey un, fu.c uc, 'Brand#' || cast(o_custkey % 25 + 1 as varchar) us, o_custkey % 25 ui,
         l_returnflag rf, l_linenumber ln, o_orderpriority pr,
         cast(l_extendedprice as decimal(18,2)) v,
         cast(case when l_linenumber = 7 then -l_extendedprice else l_extendedprice end as decimal(18,2)) dv,
         cast(l_quantity as decimal(18,2)) tls
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey
  join fold fs on fs.k = s_nationkey join fold fu on fu.k = c_nationkey),
em as (
  select c_nationkey n, f.c country, 'Brand#' || cast(user_id % 25 + 1 as varchar) lib, user_id % 25 si,
         event_type, extract(year from ts) y, cast(value as decimal(18,2)) v
  from events join customer on user_id = c_custkey join fold f on f.k = c_nationkey),
va as (select rc country, rt industry, cast(sum(v) as double) va from flows group by 1, 2),
cs as (select distinct c country from fold),
k0 as (
  select country, lib, industry, va, count(*) over (partition by country, lib) n,
         sum(va) over (partition by country, lib) t, count(va) over (partition by country, lib) nn
  from cs cross join xw left join va using (country, industry)),
ky as (
  select country, lib, industry,
         case when n = 1 then 1.0e0 when nn < n then null when t = 0 then null else va / t end w from k0),
z as (select rc, rs, uc, us, cast(sum(v) as double) v from flows group by 1, 2, 3, 4)
"""

ISO3 = f"iso3 as {_numbered(t.NATION_ISO3)}"
# Written out here, so that an error in the library's own tables shows.
ISO2 = """iso2 as (select * from (values
  ('ZAF', 'ZA'), ('USA', 'US'), ('CHN', 'CN'), ('AUT', 'AT'), ('SAU', 'SA'), ('NGA', 'NG'), ('CAN', 'CA'),
  ('IND', 'IN'), ('DEU', 'DE'), ('ISR', 'IL'), ('EGY', 'EG'), ('MEX', 'MX'), ('IDN', 'ID'), ('FRA', 'FR'),
  ('TUR', 'TR'), ('MAR', 'MA'), ('BRA', 'BR'), ('JPN', 'JP'), ('GRC', 'GR'), ('ARE', 'AE'), ('KEN', 'KE'),
  ('ARG', 'AR'), ('KOR', 'KR'), ('GBR', 'GB'), ('QAT', 'QA')) as v(code3, code2))"""
MAPPED = """(select * from (values
  ('A01', 'A01T02'), ('A02', 'A01T02'), ('A03', 'A03'), ('B', 'BZ'), ('C10T12', 'C10T12'), ('C17', 'C17T18'),
  ('C18', 'C17T18'), ('C31_32', 'CM'), ('C33', 'CM'), ('D35', 'D35'), ('E36', 'EZ'), ('E37T39', 'EZ'), ('F', 'FZ'),
  ('G45', 'GZ'), ('G46', 'GZ'), ('H49', 'H49'), ('I', 'IZ'), ('J58', 'JA'), ('J62_63', 'JC'), ('K64', 'KZ'),
  ('L', 'LZ'), ('M71', 'MZ'), ('O84', 'OZ'), ('T', 'TZ')) as v(code, industry))"""
MARKED = """(select * from (values
  ('D01T02', 'A01T02', 'A01'), ('D01T02', 'A01T02', 'A02'), ('D05T06', 'BZ', 'B'), ('D07T08', 'BZ', 'B'),
  ('D45T47', 'GZ', 'G45'), ('D45T47', 'GZ', 'G46'), ('D45T47', 'GZ', 'G47'), ('D61', 'J61', 'J61'),
  ('D69T75', 'MZ', 'M69_70'), ('D69T75', 'MZ', 'M71'), ('D69T75', 'MZ', 'M72'), ('D69T75', 'MZ', 'M73'),
  ('D69T75', 'MZ', 'M74_75'), ('D99', 'UZ', 'U')) as v(raw, industry, code))"""
KEPT_CODES = (
    "'AT', 'AU', 'BE', 'BG', 'BR', 'CA', 'CH', 'CN', 'CY', 'CZ', 'DE', 'DK', 'EE', 'ES', 'FI', 'FR', 'GB', 'GR',"
    " 'HR', 'HU', 'ID', 'IE', 'IN', 'IT', 'JP', 'KR', 'LT', 'LU', 'LV', 'MT', 'MX', 'NL', 'NO', 'PL', 'PT', 'RO',"
    " 'RU', 'SE', 'SI', 'SK', 'TR', 'US', 'ZA', 'SA', 'KE'"
)
WIDE = f"wc as {_numbered(t.WIDE_CODES)}"
FLAT = f"fc as {_numbered(t.FLAT_CODES)}"
VAC = f"vc as {_numbered(t.VALUE_ADDED_CODES)}"

SECTION = (
    "case when substring({0}, 1, 1) in ('B','E','F','G','I','K','L','M','N','O','P','Q','R','S','T','U')"
    " then substring({0}, 1, 1) || 'Z'"
    " when replace({0}, '_', 'T') = 'C31T33' then 'CM' when replace({0}, '_', 'T') = 'D' then 'D35'"
    " when replace({0}, '_', 'T') = 'J58T60' then 'JA' when replace({0}, '_', 'T') = 'J62T63' then 'JC'"
    " else replace({0}, '_', 'T') end"
)
COMPAT_SECTION = SECTION.replace(" when replace({0}, '_', 'T') = 'J62T63' then 'JC'", "")

WIDE_DEMAND = (
    "case {0} when '1-URGENT' then 'HFCE' when '2-HIGH' then 'GGFC' when '3-MEDIUM' then 'GFCF'"
    " when '4-NOT SPECIFIED' then 'DPABR' else 'INVNT' end"
)
WIDE_COMPONENT = (
    "case {0} when 'GGFC' then 'P3_S13' when 'HFCE' then 'P3_S14' when 'NPISH' then 'P3_S15'"
    " when 'GFCF' then 'P51G' else 'P5M' end"
)
FLAT_COMPONENT = (
    "case {0} when '1-URGENT' then 'P3_S14' when '2-HIGH' then 'P3_S13' when '3-MEDIUM' then 'P51G'"
    " when '4-NOT SPECIFIED' then 'X_NONE' else 'P5M' end"
)
GWP = "case {0} when 'click' then 1 when 'view' then 28 when 'purchase' then 265 when 'error' then 23500 else 0 end"

# Kept countries of the nation table by alpha-2 code.
KEPT2 = """
kept2 as (
  select distinct coalesce(code2, 'ROW') country
  from fold join iso3 on i = k left join iso2 on code3 = code where c <> 'ROW')
"""


def _fold2(code: str) -> str:
    return f"case when {code} in (select country from kept2) then {code} else 'ROW' end"


def _compare(sums: str, keys: str, money: bool = True) -> str:
    rate = " * cast(0.9 as decimal(3,1))" if money else ""
    return f"""
, s as ({sums}),
sa as (select {keys}, v{rate} a from s where f = 'A'),
sn as (select {keys}, v n from s where f = 'N'),
sr as (select {keys}, v r from s where f = 'R')
select {keys}, cast(coalesce(a, 0) as double) src_a, cast(coalesce(n, 0) as double) src_n,
       cast(coalesce(r, 0) as double) src_r
from sa full join sn using ({keys}) full join sr using ({keys})
"""


def _compare_rounded(source: str, sums: str, keys: str, out: str) -> str:
    """One account of the written comparison; the rate applies to money only."""
    rate = "" if source == "emissions" else " * 0.9e0"
    return f"""
select '{source}' account, {out},
       round(coalesce(sum(case when rf = 'A' then v{rate} end), 0), 3) src_a,
       round(coalesce(sum(case when rf = 'N' then v end), 0), 3) src_n,
       round(coalesce(sum(case when rf = 'R' then v end), 0), 3) src_r
from ({sums}) x group by {keys}
"""


def _tails() -> dict[str, str]:
    none = "cast(null as varchar)"
    q: dict[str, str] = {}

    q["z_two_sided"] = """
select kr.country || '_' || kr.industry resource_id, ku.country || '_' || ku.industry use_id,
       round(sum(z.v * kr.w * ku.w), 3) as value
from z join ky kr on kr.country = rc and kr.lib = rs join ky ku on ku.country = uc and ku.lib = us
where kr.w <> 0 and ku.w <> 0 group by 1, 2
union all
select rc || '_UNWEIGHTED', uc || '_UNWEIGHTED', round(sum(v), 3) from z
where not exists (select 1 from ky where country = rc and lib = rs and w <> 0)
   or not exists (select 1 from ky where country = uc and lib = us and w <> 0) group by 1, 2
"""
    q["repartition_key"] = "select country, lib src, industry, round(w, 9) weight from ky"
    q["key_conservation"] = """
, src as (select rc country, rs lib, cast(sum(v) as double) v from flows group by 1, 2),
tot as (select country, sum(v) raw_total from src group by 1),
dist as (select country, sum(v * w) dist_total from src join ky using (country, lib) group by 1)
select country, round(raw_total, 2) raw_total, abs(raw_total - dist_total) <= 1e-9 * abs(raw_total) conserved
from tot join dist using (country)
"""
    q["z_conservation"] = """
, raw as (select rc country, sum(v) raw_total from z group by 1),
dist as (
  select rc country, sum(z.v * kr.w * ku.w) dist_total
  from z join ky kr on kr.country = rc and kr.lib = rs join ky ku on ku.country = uc and ku.lib = us group by 1)
select country, round(raw_total, 2) raw_total,
       coalesce(abs(raw_total - dist_total) <= 1e-9 * abs(raw_total), false) conserved
from raw left join dist using (country)
"""
    q["global_total"] = """
select 'raw' side, round_even(sum(v), 0) total from z
union all
select 'aligned', round_even(sum(z.v * kr.w * ku.w), 0)
from z join ky kr on kr.country = rc and kr.lib = rs join ky ku on ku.country = uc and ku.lib = us
"""
    q["coverage_gaps"] = """
, xw2 as (
  select lib, industry from xw where lib not in ('Brand#7', 'Brand#14')
  union all select 'Brand#99', industry from xw where lib = 'Brand#1'),
k2 as (
  select country, lib, industry, va, count(*) over (partition by country, lib) n,
         sum(va) over (partition by country, lib) t, count(va) over (partition by country, lib) nn
  from cs cross join xw2 left join va using (country, industry)),
ky2 as (
  select country, lib, case when n = 1 then 1.0e0 when nn < n then null when t = 0 then null else va / t end w
  from k2),
seen as (select distinct rc country, rs lib from flows),
known as (select distinct country, lib from ky2)
select country, lib src, 'unmapped' gap from (select * from seen except select * from known) a
union all
select country, lib, 'unused' from (select * from known except select * from seen) b
union all
select distinct country, lib, 'no_weight' from ky2 where w is null
"""
    q["va_weighted"] = """
, x as (select rc country, rs lib, cast(sum(tls) as double) tls, cast(sum(v) as double) va from flows group by 1, 2),
y as (select country, lib, 'TLS' component, tls v from x union all select country, lib, 'VA', va from x),
g as (select ky.*, component from ky cross join (select 'TLS' component union all select 'VA') c)
select g.country, g.industry, g.component,
       case when count(v * w) = count(*) then round(sum(v * w), 3) end as value
from g left join y on y.country = g.country and y.lib = g.lib and y.component = g.component
group by 1, 2, 3
"""
    q["d_weighted_dense"] = """
, comp as (select distinct pr component from flows where pr <> '4-NOT SPECIFIED' and dv > 0),
d as (
  select rc country, rs lib, uc counterpartarea, pr component, cast(sum(dv) as double) v
  from flows where dv > 0 and pr <> '4-NOT SPECIFIED' group by 1, 2, 3, 4),
grid as (select ky.country, ky.lib, ky.industry, w, component, cs.country counterpartarea
         from ky cross join comp cross join cs)
select g.country, g.industry, g.component, g.counterpartarea, round(coalesce(sum(d.v * g.w), 0), 3) as value
from grid g left join d on d.country = g.country and d.lib = g.lib
  and d.component = g.component and d.counterpartarea = g.counterpartarea
group by 1, 2, 3, 4
"""
    q["emissions_weighted"] = f"""
, e as (select country, lib, cast(sum(v * {GWP.format('event_type')}) as double) v from em group by 1, 2)
select ky.country, ky.industry,
       case when count(v * w) = count(*) then round(sum(v * w) / 1000, 5) end as value
from ky left join e on e.country = ky.country and e.lib = ky.lib group by 1, 2
"""
    q["z_recode"] = """
select rc resource_country, rt resource_type, uc use_country, us use_src, cast(sum(v) as double) as value
from flows group by 1, 2, 3, 4
"""
    q["va_recode"] = f""", {VAC}
select uc country, rt industry, case when code = 'D21X31' then 'TLS' else 'VA' end component,
       cast(sum(v) as double) as value
from flows join vc on i = ln - 1 where code <> 'ZZ' group by 1, 2, 3
"""
    q["d_recode"] = f"""
, x as (select *, case when ln = 1 then 'NPISH' else {WIDE_DEMAND.format('pr')} end code from flows)
select rc country, rt industry, uc counterpartarea, {WIDE_COMPONENT.format('code')} component,
       cast(sum(dv) as double) as value
from x group by 1, 2, 3, 4
"""
    q["emissions_recode"] = f""", {ISO3}, {ISO2}, {WIDE}, {KEPT2}
select {_fold2('code2')} country, {SECTION.format('wc.code')} industry, cast(sum(v) * 1000000 as double) as value
from em join iso3 on iso3.i = n left join iso2 on code3 = iso3.code join wc on wc.i = si
where y = 2024 and event_type in ('click', 'view') group by 1, 2
"""
    q["weighted_accounts"] = f"""
, rows_ as (select distinct rc, rs from flows), cols_ as (select distinct uc, us from flows),
dense as (
  select r.rc, r.rs, k.uc, k.us, coalesce(z.v, 0) v from rows_ r cross join cols_ k
  left join z on z.rc = r.rc and z.rs = r.rs and z.uc = k.uc and z.us = k.us),
x as (select rc country, rs lib, cast(sum(tls) as double) tls, cast(sum(v) as double) va,
             cast(sum(dv) as double) dva from flows group by 1, 2),
y as (select country, lib, 'TLS' component, tls v from x union all select country, lib, 'VA', va + dva from x),
g as (select ky.*, component from ky cross join (select 'TLS' component union all select 'VA') c),
d0 as (
  select rc, rs, uc, case pr when '1-URGENT' then 'P3_S13' when '2-HIGH' then 'P3_S14' when '3-MEDIUM' then 'P51G'
         when '5-LOW' then 'P5M' end component, cast(sum(dv) as double) v
  from flows group by 1, 2, 3, 4),
comp as (select * from (values ('P3_S13'), ('P3_S14'), ('P3_S15'), ('P51G'), ('P5M')) c(component)),
dg as (select ky.*, component, cs.country area from ky cross join comp cross join cs),
e0 as (select country, lib, cast(sum(v * {GWP.format('event_type')}) as double) v from em group by 1, 2)
select 'Z' account, kr.country a, kr.industry b, ku.country c, ku.industry d,
       round(sum(dense.v * kr.w * ku.w), 3) as value
from dense join ky kr on kr.country = rc and kr.lib = rs join ky ku on ku.country = uc and ku.lib = us
where kr.w <> 0 and ku.w <> 0 group by 1, 2, 3, 4, 5
union all
select 'Z', rc, 'UNWEIGHTED', uc, 'UNWEIGHTED', round(sum(v), 3) from dense
where not exists (select 1 from ky where country = rc and lib = rs and w <> 0)
   or not exists (select 1 from ky where country = uc and lib = us and w <> 0) group by 1, 2, 3, 4, 5
union all
select 'VA', g.country, g.industry, {none}, g.component,
       case when count(v * w) = count(*) then round(sum(v * w), 3) end
from g left join y on y.country = g.country and y.lib = g.lib and y.component = g.component
group by 1, 2, 3, 4, 5
union all
select 'D', dg.country, dg.industry, dg.area, dg.component, round(coalesce(sum(d0.v * dg.w), 0), 3)
from dg left join d0 on d0.rc = dg.country and d0.rs = dg.lib and d0.uc = dg.area
  and d0.component = dg.component and d0.v > 0
group by 1, 2, 3, 4, 5
union all
select 'emissions', ky.country, ky.industry, {none}, {none},
       case when count(v * w) = count(*) then round(sum(v * w) / 1000, 3) end
from ky left join e0 on e0.country = ky.country and e0.lib = ky.lib group by 1, 2, 3, 4, 5
"""
    q["wide_accounts"] = f""", {ISO3}, {ISO2}, {WIDE}, {KEPT2},
w as (
  select ra.code || '_' || rw.code rl, ua.code || '_' || case when ln >= 5 then {WIDE_DEMAND.format('pr')}
         else uw.code end cl, ln >= 5 dm, dv, tls
  from flows join iso3 ra on ra.i = rn join iso3 ua on ua.i = un join wc rw on rw.i = ri join wc uw on uw.i = ui),
rl as (
  select distinct w.rl, {_fold2('code2')} country, {SECTION.format('substring(w.rl, 5)')} industry
  from w left join iso2 on code3 = substring(w.rl, 1, 3)),
cl as (
  select distinct w.cl, dm, {_fold2('code2')} country,
         case when dm then {WIDE_COMPONENT.format('substring(w.cl, 5)')}
              else {SECTION.format('substring(w.cl, 5)')} end item
  from w left join iso2 on code3 = substring(w.cl, 1, 3)),
cell as (select w.rl, w.cl, sum(dv) v from w group by 1, 2),
va_ as (select w.cl, 'VA' component, sum(dv) v from w group by 1 union all select w.cl, 'TLS', sum(tls) from w group by 1)
select case when dm then 'D' else 'Z' end account, rl.country a, rl.industry b, cl.country c, cl.item d,
       round(cast(sum(coalesce(v, 0)) as double), 3) as value
from rl cross join cl left join cell on cell.rl = rl.rl and cell.cl = cl.cl group by 1, 2, 3, 4, 5
union all
select 'VA', cl.country, cl.item, {none}, component, round(cast(sum(v) as double), 3)
from cl join va_ on va_.cl = cl.cl where not dm group by 1, 2, 3, 4, 5
"""
    q["wide_release"] = q["wide_accounts"] + f"""
union all
select 'emissions', {_fold2('code2')}, {SECTION.format('wc.code')}, {none}, {none},
       round(cast(sum(v) * 1000000 as double), 3)
from em join iso3 on iso3.i = n left join iso2 on code3 = iso3.code join wc on wc.i = si
where y = 2024 and event_type in ('click', 'view') group by 1, 2, 3, 4, 5
"""
    flat_source = f"""
, {FLAT}, {VAC}, mp as {MAPPED},
s as (
  select rc, uc, dv, case when ln in (4, 5) then vc.code else fr.code end r,
         case when ln in (6, 7) then {FLAT_COMPONENT.format('pr')} when ln in (4, 5) then fr.code else fu.code end k
  from flows join fc fr on fr.i = ri join fc fu on fu.i = ui join vc on vc.i = ui % 7),
j as (select s.*, mr.industry ir, mk.industry ik from s left join mp mr on mr.code = r left join mp mk on mk.code = k)
"""
    q["flat_accounts"] = flat_source + f"""
select 'Z' account, rc a, ir b, uc c, ik d, round(cast(sum(dv) as double), 3) as value
from j where ir is not null and ik is not null group by 1, 2, 3, 4, 5
union all
select 'VA', uc, ik, {none}, case when r = 'D21X31' then 'TLS' else 'VA' end, round(cast(sum(dv) as double), 3)
from j where ik is not null and r in ('D21X31','OP_RES','OP_NRES','D1','D29X39','B2A3G') group by 1, 2, 3, 4, 5
union all
select 'D', rc, ir, uc, k, round(cast(sum(dv) as double), 3)
from j where ir is not null and (k like '%P3%' or k like '%P5%') group by 1, 2, 3, 4, 5
union all
select 'emissions', country, industry, {none}, {none}, round(cast(sum(v) * 1000 as double), 3)
from em join fc on fc.i = si join mp on mp.code = fc.code group by 1, 2, 3
"""
    q["flat_release"] = q["flat_accounts"]
    q["reference_value_added"] = flat_source + """
select uc country, ik industry, cast(sum(dv) as double) as value
from j where ik is not null and r in ('D21X31','OP_RES','OP_NRES','D1','D29X39','B2A3G')
  and k not like '%P3%' and k not like '%P5%' group by 1, 2
"""
    q["compare_z"] = _compare(
        "select rf f, rc || '_' || rt resource_id, uc || '_' || us use_id, sum(v) v from flows group by 1, 2, 3",
        "resource_id, use_id",
    )
    q["compare_va"] = _compare(
        "select rf f, uc || '_' || us id, case when ln = 1 then 'TLS' else 'VA' end component, sum(v) v"
        " from flows group by 1, 2, 3",
        "id, component",
    )
    q["compare_d"] = _compare(
        "select rf f, rc || '_' || rs id, uc counterpartarea, pr component, sum(dv) v from flows group by 1, 2, 3, 4",
        "id, counterpartarea, component",
    )
    q["compare_emissions"] = _compare(
        "select case event_type when 'click' then 'A' when 'error' then 'A' when 'purchase' then 'R' else 'N' end f,"
        " country || '_' || lib id, sum(v) v from em group by 1, 2",
        "id",
        money=False,
    )
    q["compare_written"] = "\nunion all\n".join(
        [
            _compare_rounded(
                "Z",
                "select rf, rc || '_' || rt a, uc || '_' || us b, cast(sum(v) as double) v from flows group by 1, 2, 3",
                "a, b",
                f"a, b, {none} c",
            ),
            _compare_rounded(
                "VA",
                "select rf, rc || '_' || rt a, pr b, cast(sum(v) as double) v from flows group by 1, 2, 3",
                "a, b",
                f"a, b, {none} c",
            ),
            _compare_rounded(
                "D",
                "select rf, rc || '_' || rt a, pr b, uc c, cast(sum(v) as double) v from flows group by 1, 2, 3, 4",
                "a, b, c",
                "a, b, c",
            ),
            _compare_rounded(
                "emissions",
                "select rf, rc || '_' || rt a, cast(sum(v) as double) v from flows group by 1, 2",
                "a",
                f"a, {none} b, {none} c",
            ),
        ]
    )
    q["currency_convert"] = """
select rc resource_country, rt resource_type,
       round(cast(sum(case when rf = 'A' then v end) as double) * 0.75e0, 5) value_a,
       round(cast(sum(case when rf = 'N' then v end) as double) * 0.75e0, 5) value_n,
       cast(sum(tls) as double) quantity
from flows group by 1, 2
"""
    q["rate_scan"] = """
, rate as (select count(*) / 1000.0e0 x from orders where extract(year from o_orderdate) = 2000)
select rc resource_country, round(cast(sum(v) as double) * any_value(x), 6) as value
from flows cross join rate group by 1
"""
    flags = _values(
        [
            ("STANDARD", "D01T02"),
            ("MEDIUM", "D05T06"),
            ("ECONOMY", "D07T08"),
            ("PROMO", "D45T47"),
            ("SMALL", "D69T75"),
            ("LARGE", "D61"),
        ],
        "kind, raw",
    )
    crosswalk = f"""
, fl as {flags}, mp as {MARKED},
marked as (
  select distinct case when p_brand = 'Brand#25' then 'Extra-territorial organizations and bodies' else p_brand end src,
         case when p_brand = 'Brand#25' then 'D99' else fl.raw end raw
  from part join fl on kind = p_type),
cw as (select src, marked.raw raw_industry, industry, code from marked join mp on mp.raw = marked.raw)
"""
    q["crosswalk_build"] = crosswalk + "select src, raw_industry, industry, code from cw"
    q["crosswalk_scan"] = q["crosswalk_build"]
    q["crosswalk_pairs"] = crosswalk + """
select a.industry, sources, codes
from (select industry, count(*) sources from (select distinct src, industry from cw) x group by 1) a
join (select industry, count(*) codes from (select distinct code, industry from cw) y group by 1) b
  on a.industry = b.industry
"""
    q["country_fold"] = "select distinct c country from customer join fold on k = c_nationkey"
    q["fold_unlisted"] = """
select case when c_mktsegment <> 'HOUSEHOLD' then c else 'ROW' end country,
       cast(sum(cast(c_acctbal as decimal(18,2))) as double) balance, count(*) n
from customer join fold on k = c_nationkey group by 1
"""
    q["hybrid_grid"] = "select country, industry from cs cross join ind"
    lines = (
        "select l_returnflag flag, l_linenumber line, count(*) n,"
        " cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as value from lineitem where l_partkey {0}"
        " (select p_partkey from part where p_type in ('PROMO', 'SMALL')) group by 1, 2"
    )
    q["semi_join_filter"] = lines.format("in")
    q["anti_join_filter"] = lines.format("not in")
    q["lookup_first_match"] = """
select industry, l_returnflag flag, count(*) n, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as value
from lineitem join part on l_partkey = p_partkey
left join (select lib, min(industry) industry from xw group by 1) f on lib = p_brand group by 1, 2
"""
    gappy = (
        "case when l_returnflag = 'A' and l_linenumber = 7 then null"
        " else cast(l_extendedprice as decimal(18,2)) end"
    )
    q["null_propagating_sum"] = (
        f"select l_returnflag flag, cast(case when count({gappy}) = count(*) then sum({gappy}) end as double) as value"
        " from lineitem group by 1"
    )
    q["null_as_zero_sum"] = (
        f"select l_returnflag flag, l_linenumber line, cast(coalesce(sum({gappy}), 0) as double) as value"
        " from lineitem group by 1, 2"
    )
    per_part = (
        "select l_partkey partkey, "
        + ", ".join(
            f"sum(case when l_returnflag = '{f}' then cast(l_extendedprice as decimal(18,2)) end) flag_{f.lower()}"
            for f in "ANR"
        )
        + " from lineitem group by 1"
    )
    q["row_total_wide"] = (
        f"select partkey, cast(flag_a + flag_n + flag_r as double) total from ({per_part}) x"
    )
    q["unpivot_wide"] = " union all ".join(
        f"select partkey, 'flag_{f}' flag, cast(flag_{f} as double) as value from ({per_part}) x" for f in "anr"
    )
    q["transpose_labels"] = """
select uc resource_country, rc use_country, cast(sum(v) as double) as value from flows group by 1, 2
"""
    q["append_union"] = """
select l_returnflag flag, l_linenumber line, count(*) * case when l_returnflag = 'A' then 2 else 1 end n,
       cast(sum(cast(l_extendedprice as decimal(18,2))) * case when l_returnflag = 'A' then 2 else 1 end as double)
         as value
from lineitem group by 1, 2
"""
    q["unite_id"] = """
select rc || '_' || case when rt = 'PROMO' then 'NA' else rt end id, cast(sum(v) as double) as value
from flows group by 1
"""
    q["split_id"] = """
select cast(rn as varchar) nation, rc || '_' || rt rest, cast(sum(v) as double) as value from flows group by 1, 2
"""
    q["section_recode"] = f""", {WIDE}
select {SECTION.format('code')} industry, {COMPAT_SECTION.format('code')} compat_industry,
       cast(sum(v) as double) as value
from flows join wc on i = ri group by 1, 2
"""
    q["iso_map"] = f""", {ISO3}, {ISO2}
select case when code2 in ({KEPT_CODES}) then code2 else 'ROW' end country, count(*) n
from customer join iso3 on i = c_nationkey left join iso2 on code3 = code group by 1
"""
    q["regex_component_filter"] = f"""
, x as (select *, {FLAT_COMPONENT.format('pr')} code from flows)
select case when regexp_matches(code, 'P3|P5') then 'demand' when ln < 7 then 'value added' else 'other' end kind,
       code, cast(sum(v) as double) as value
from x where left(rt, 2) in ('ST', 'SM', 'ME', 'PR') group by 1, 2
"""
    stressors = _values(
        [(event, name) for event, (name, _) in t.EVENT_STRESSORS.items()], "event, stressor"
    )
    q["gas_factors"] = f""", st as {stressors},
x as (
  select stressor, v, case when event = 'signup' then 1 when stressor like '%CO2%' then 1
         when stressor like '%CH4%' then 28 when stressor like '%N2O%' then 265
         when stressor like '%SF6%' then 23500 else 0 end gwp
  from em join st on event = event_type)
select stressor, gwp, cast(sum(v * gwp) as double) as value from x group by 1, 2
"""
    q["vintage_asof"] = """
select cast(extract(year from o_orderdate) as int) as year,
       case when extract(year from o_orderdate) >= 2000 then 'third'
            when extract(year from o_orderdate) >= 1998 then 'second'
            when extract(year from o_orderdate) >= 1996 then 'first' end as location,
       count(*) n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as value
from orders group by 1, 2
"""
    q["matrix_roundtrip"] = """
, s as (select rc, rs, uc, us, sum(dv) v from flows group by 1, 2, 3, 4)
select r.rc resource_country, r.rs resource_src, k.uc use_country, k.us use_src,
       cast(coalesce(v, 0) as double) as value
from (select distinct rc, rs from flows) r cross join (select distinct uc, us from flows) k
left join s on s.rc = r.rc and s.rs = r.rs and s.uc = k.uc and s.us = k.us
"""
    q["matrix_two_labels"] = """
, s as (select rc, rs, uc, us, sum(tls) v from flows group by 1, 2, 3, 4)
select r.rc resource_country, r.rs resource_src, k.uc use_country, k.us use_src,
       cast(coalesce(v, 0) as double) as value
from (select distinct rc, rs from flows) r cross join (select distinct uc, us from flows) k
left join s on s.rc = r.rc and s.rs = r.rs and s.uc = k.uc and s.us = k.us
union all
select rc, rs, cast(null as varchar), cast(null as varchar), cast(sum(v) as double) from s group by 1, 2
"""
    q["nan_demand"] = """
, s as (
  select rc country, rs src, uc counterpartarea, sum(dv) v, case pr when '1-URGENT' then 'P3_S13'
    when '2-HIGH' then 'P3_S14' when '3-MEDIUM' then 'P51G' when '5-LOW' then 'P5M' end component
  from flows where not (uc = 'ROW' and pr = '5-LOW') group by 1, 2, 3, pr)
select country, src, component, counterpartarea, round(cast(v as double), 3) as value
from s where v > 0 and component is not null
"""
    q["gas_factors_first"] = f""", st as {stressors},
x as (
  select stressor, v, case when event = 'view' then 1 when stressor like '%CO2%' then 1
         when stressor like '%CH4%' then 28 when stressor like '%N2O%' then 265
         when stressor like '%SF6%' then 23500 else 0 end gwp
  from em join st on event = event_type)
select stressor, gwp, cast(sum(v * gwp) as double) as value from x group by 1, 2
"""
    q["csv_roundtrip"] = """
select uc || '_' || us use_id, rc || '_' || rt resource_id, cast(sum(dv) as double) as value
from flows group by 1, 2
"""
    q["matrix_blank_lines"] = """
, s as (select rc, rs, uc, us, sum(v) v from flows group by 1, 2, 3, 4)
select r.rc resource_country, r.rs resource_src, k.uc use_country, k.us use_src,
       case when r.rc < 'G' then null else cast(coalesce(v, 0) as double) end as value
from (select distinct rc, rs from flows) r cross join (select distinct uc, us from flows) k
left join s on s.rc = r.rc and s.rs = r.rs and s.uc = k.uc and s.us = k.us
"""
    q["matrix_quoted"] = """
, s as (select rc, rs, uc, us, sum(dv) v from flows group by 1, 2, 3, 4)
select r.rc resource_country, r.rs || ', of "' || r.rc || '"' resource_src,
       k.uc use_country, k.us || ', of "' || k.uc || '"' use_src, cast(coalesce(v, 0) as double) as value
from (select distinct rc, rs from flows) r cross join (select distinct uc, us from flows) k
left join s on s.rc = r.rc and s.rs = r.rs and s.uc = k.uc and s.us = k.us
"""
    q["units_in_files"] = """
with l as (
  select case when event_type = 'view' then 'CH4 - ' else 'CO2 - ' end || user_id stressor, event_id, event_id % 3 = 0 done,
         (20 * (event_id % 1000) * (event_id % 1000) * (event_id % 1000)) // 1000000000 part
  from events),
f as (select stressor, done, row_number() over (partition by stressor order by part, event_id) r from l)
select stressor, cast(case when done or stressor like 'CO2%' then 1 else 28 end as integer) gwp from f where r = 1
"""
    q["asof_orders"] = """
with o as (select o_custkey % 50 as key, o_orderdate as day, max(o_orderkey) as release from orders group by 1, 2)
select l_orderkey, l_linenumber, o.release
from lineitem l asof left join o on l.l_suppkey % 50 = o.key and l.l_shipdate >= o.day
"""
    q["replaced_sink"] = """
select rc resource_country, rt resource_type, uc use_country, -cast(sum(dv) as double) as value
from flows where rc <> 'ROW' group by 1, 2, 3
"""
    q["partitioned_sink"] = """
select rc resource_country, rt resource_type, uc use_country,
       cast(sum(dv) as double) * case when rc = 'ROW' then -1 else 1 end as value
from flows group by 1, 2, 3
"""
    return q


# Queries on a single table need none of the shared relations.
_PLAIN = {
    "semi_join_filter",
    "anti_join_filter",
    "null_propagating_sum",
    "null_as_zero_sum",
    "row_total_wide",
    "unpivot_wide",
    "append_union",
    "vintage_asof",
    "units_in_files",
    "asof_orders",
}


def oracle_sql() -> dict[str, str]:
    return {
        name: tail if name in _PLAIN else f"{BASE}{tail}" for name, tail in _tails().items()
    }
