"""SQL of the pipeline's queries, for a second engine over the same tables."""
from __future__ import annotations

from ..functions.text import NA_LITERALS, STOP30, STOP55
from ..operators.scoring import FEATURES

_q = lambda xs: ", ".join("'" + x + "'" for x in xs)


def na(c: str) -> str:
    return f"case when {c} in ({_q(NA_LITERALS)}) then null else {c} end"


def norm(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]+', ' ', 'g'))"


def prepared(table: str) -> str:
    return f"select distinct entity_id, {norm('(' + na('business_name') + ')')} as name_norm, {norm('(' + na('business_address') + ')')} as address_norm, {na('country')} as country from {table}"


def base(split: str = "test") -> str:
    return f"""s1 as ({prepared(split + '_source1')}),
tg as (select *, 'S2' as target_source from ({prepared(split + '_source2')}) union all select *, 'S3' from ({prepared(split + '_source3')}))"""


def t1(c: str) -> str:
    return f"list_filter(list_distinct(string_split({c}, ' ')), lambda x: x <> '')"


def t3(c: str) -> str:
    return f"list_filter(list_distinct(string_split({c}, ' ')), lambda x: len(x) >= 3)"


def t55(c: str) -> str:
    return f"list_filter(list_distinct(string_split({c}, ' ')), lambda x: len(x) >= 3 and x not in ({_q(STOP55)}))"


def t30(c: str) -> str:
    return f"list_filter(list_distinct(string_split({c}, ' ')), lambda x: len(x) >= 3 and x not in ({_q(STOP30)}))"


def nums(c: str) -> str:
    return f"list_distinct(regexp_extract_all({c}, '[0-9]+'))"


def chars(c: str) -> str:
    return f"list_filter(list_distinct(string_split({c}, '')), lambda x: x <> '')"


def letters(c: str) -> str:
    return chars(f"replace({c}, ' ', '')")


def joined(a: str, sep: str = " ") -> str:
    return f"array_to_string(list_sort({a}), '{sep}')"


def isect(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b}))"


def jac(a: str, b: str, both: str = "0.0") -> str:
    u = f"len(list_distinct(list_concat({a}, {b})))"
    return f"case when {u} = 0 then cast({both} as double) else {isect(a, b)}::double / {u} end"


def ovl(a: str, b: str) -> str:
    return f"{isect(a, b)}::double / greatest(1, least(len({a}), len({b})))"


def toks(src: str, kind) -> str:
    return f"(select entity_id, country, 'name' as field, unnest({kind('name_norm')}) as token from {src} union all select entity_id, country, 'address', unnest({kind('address_norm')}) from {src})"


def utoks(src: str, kind) -> str:
    return f"(select entity_id, country, unnest(list_distinct(list_concat({kind('name_norm')}, {kind('address_norm')}))) as token from {src})"


EVERYONE = f"everyone as (select distinct * from ({prepared('test_source1')} union all {prepared('test_source2')} union all {prepared('test_source3')}))"
TRUTH = r"""raw as (select distinct source1_entity_id as s, matched_entity_ids as m from train_matches),
truth as (select distinct s, rtrim(unnest(regexp_extract_all(m, 'S[0-9]-[0-9]+(?:[,/][0-9]+[A-Z]?["''])?')), '"''') as t from raw where m is not null)"""
TRUE = f"""{base('train')}, {TRUTH},
p as (select truth.s, truth.t, a.name_norm as sn, a.address_norm as sa, a.country as sc, b.name_norm as tn, b.address_norm as ta, b.country as tc
  from truth join s1 a on a.entity_id = truth.s join tg b on b.entity_id = truth.t)"""


TRUE_LEFT = TRUE.replace("from truth join s1 a", "from truth left join s1 a").replace("join tg b on b.entity_id = truth.t)", "left join tg b on b.entity_id = truth.t)")


def exact(field: str) -> str:
    return f"select a.entity_id as s, b.entity_id as t from s1 a join tg b on a.country = b.country and a.{field}_norm = b.{field}_norm where a.{field}_norm <> ''"


def named(sql: str) -> str:
    return f"select s as source1_entity_id, t as candidate_entity_id from ({sql})"


DF1 = f"df1 as (select field, token, count(*) as df from {toks('tg', t1)} group by all)"
DFU = f"dfu as (select country, token, count(*) as df from {utoks('tg', t55)} where country is not null group by all)"


def rarest(kn: int, ka: int, cutoff: int) -> str:
    return f"""rare as (select s, country, field, token, df, rn from (select k.entity_id as s, k.country, k.field, k.token, d.df,
  row_number() over (partition by k.entity_id, k.country, k.field order by d.df, k.token) as rn
  from {toks('s1', t1)} k join df1 d on d.field = k.field and d.token = k.token where d.df <= {cutoff})
  where rn <= case when field = 'name' then {kn} else {ka} end)"""


def candidates(kn: int, ka: int, cutoff: int, cap: int, bonus: str, exact_blocks: bool) -> str:
    more = f" union all select s, t, 1 from ({exact('name')}) union all select s, t, 1 from ({exact('address')})" if exact_blocks else ""
    return f"""{DF1}, {rarest(kn, ka, cutoff)},
rawc as (select s, t, max(protected) as protected from (select r.s, k.entity_id as t, 0 as protected from rare r join {toks('tg', t1)} k
  on k.country = r.country and k.field = r.field and k.token = r.token{more}) group by s, t),
shared as (select c.s, c.t, x.field, count(*) as n, sum(10000.0::double / d.df) as w from rawc c join {toks('s1', t1)} x on x.entity_id = c.s
  join {toks('tg', t1)} y on y.entity_id = c.t and y.field = x.field and y.token = x.token join df1 d on d.field = x.field and d.token = x.token group by all),
sc as (select c.s, c.t, c.protected, round(coalesce((select sum(case when h.field = 'name' then 100.0 else 150.0 end * h.n + h.w) from shared h where h.s = c.s and h.t = c.t), 0)
  + case when a.name_norm = b.name_norm and a.name_norm <> '' then {bonus} else 0 end + case when a.address_norm = b.address_norm and a.address_norm <> '' then {bonus} else 0 end, 4)::double as score
  from rawc c join s1 a on a.entity_id = c.s join tg b on b.entity_id = c.t),
cand as (select s, t, protected, score from (select *, sum(protected) over (partition by s) as np, row_number() over (partition by s, protected order by score desc, t) as rn from sc)
  where protected = 1 or rn <= greatest(0, {cap} - np))"""


V2 = base() + ", " + candidates(3, 3, 25, 20, "1000000.0", True)
V2_PRODUCTION = base() + ", " + candidates(3, 3, 500, 500, "1000000.0", True)
V1_PRODUCTION = base() + ", " + candidates(2, 2, 1000, 500, "100000.0", False)
V1 = base() + ", " + candidates(2, 2, 50, 20, "100000.0", False)
CHEAP = f"""cheap as (select *, round(name_exact * 100.0::double + address_exact * 100.0::double + no * 30.0::double + ao * 40.0::double + least(name_shared, 5) * 8.0::double
  + least(address_shared, 5) * 10.0::double + nj * 5.0::double + aj * 5.0::double, 4) as score from (select c.s, c.t,
  (a.name_norm = b.name_norm and a.name_norm <> '')::bigint as name_exact, (a.address_norm = b.address_norm and a.address_norm <> '')::bigint as address_exact,
  {isect(t3('a.name_norm'), t3('b.name_norm'))}::bigint as name_shared, {isect(t3('a.address_norm'), t3('b.address_norm'))}::bigint as address_shared,
  {ovl(t3('a.name_norm'), t3('b.name_norm'))} as no, {ovl(t3('a.address_norm'), t3('b.address_norm'))} as ao,
  {jac(chars('a.name_norm'), chars('b.name_norm'))} as nj, {jac(chars('a.address_norm'), chars('b.address_norm'))} as aj
  from cand c join s1 a on a.entity_id = c.s join tg b on b.entity_id = c.t where a.country = b.country)),
stage1 as (select s, t, score, rank from (select s, t, score, row_number() over (partition by s order by score desc, t) as rank from cheap
  where name_exact = 1 or address_exact = 1 or name_shared >= 2 or address_shared >= 2 or score >= 30) where rank <= 20)"""

# Candidates and stage 1 without cutoffs, caps and ranks: pairs of a country that share any token of a field or are equal in it, by the keep rule.
ALL_CANDIDATES = f"""{base()}, cand as (select distinct s, t from (select x.entity_id as s, y.entity_id as t from {toks('s1', t1)} x
  join {toks('tg', t1)} y using (country, field, token) union all {exact('name')} union all {exact('address')}))"""
ALL_KEPT = CHEAP.replace(") where rank <= 20)", "))")


def features(pairs: str, training: bool) -> str:
    kind, ch, both = (t1, letters, "1.0") if training else (t3, chars, "0.0")
    cols = ["coalesce(a.country = b.country, false)::bigint as country_match"]
    for f in ("name", "address"):
        x, y = f"a.{f}_norm", f"b.{f}_norm"
        cols += [
            f"({x} = {y} and {x} <> '')::bigint as {f}_exact", f"round({jac(kind(x), kind(y), both)}, 6) as {f}_jaccard", f"round({ovl(kind(x), kind(y))}, 6) as {f}_overlap",
            f"{isect(kind(x), kind(y))}::bigint as {f}_shared_tokens", f"round({jac(ch(x), ch(y))}, 6) as {f}_char_similarity", f"abs(len({x}) - len({y}))::bigint as {f}_length_diff",
            f"round(least(len({x}), len({y}))::double / greatest(1, len({x}), len({y})), 6) as {f}_length_ratio",
        ]
    cols += ["starts_with(c.t, 'S2')::bigint as target_is_s2", "starts_with(c.t, 'S3')::bigint as target_is_s3"]
    label = "label, " if training else ""
    return f"select c.s as source1_entity_id, c.t as candidate_entity_id, {label}{', '.join(FEATURES)} from (select c.*, {', '.join(cols)} from {pairs} c join s1 a on a.entity_id = c.s join tg b on b.entity_id = c.t) c"


TRAIN = f"""{base('train')}, {TRUTH},
chosen as (select s from (select distinct s from truth) order by md5(s), s limit 20000),
pos as (select truth.s, truth.t, 1::bigint as label from truth semi join chosen on chosen.s = truth.s),
nblock as (select distinct s, t from ({exact('name')} union all {exact('address')}) where s in (select s from chosen)),
neg as (select s, t, 0::bigint as label from (select n.s, n.t, row_number() over (partition by n.s order by md5(n.s || n.t), n.t) as rn from nblock n anti join truth x on x.s = n.s and x.t = n.t) n
  join (select s as cs, count(*) as k from truth group by s) on cs = s where rn <= 3 * k),
tp as (select * from pos union all select * from neg)"""


ALIKE_P = f"round((round({jac(t3('a.name_norm'), t3('b.name_norm'))}, 6) + round({jac(t3('a.address_norm'), t3('b.address_norm'))}, 6)) / 2, 6)"
ALIKE = f"{V2}, {CHEAP}, alike as (select c.s, c.t, {ALIKE_P} as p from stage1 c join s1 a on a.entity_id = c.s join tg b on b.entity_id = c.t)"
BEST = "best as (select s, t, p from (select *, row_number() over (partition by s order by p desc, t) as rn from alike where p >= 0.5) where rn = 1)"
ALIKE_TRAIN_P = f"round((round({jac(t1('a.name_norm'), t1('b.name_norm'), '1.0')}, 6) + round({jac(t1('a.address_norm'), t1('b.address_norm'), '1.0')}, 6)) / 2, 6)"
ALIKE_TRAIN = f"{TRAIN}, alike as (select c.s, c.t, c.label = 1 as y, {ALIKE_TRAIN_P} as p from tp c join s1 a on a.entity_id = c.s join tg b on b.entity_id = c.t)"


def _describe(c: str, name: str) -> str:
    qs = ", ".join(f"round(quantile_cont({c}, {q}), 6) as {name}_{l}" for q, l in ((0.25, "p25"), (0.5, "median"), (0.75, "p75")))
    return f"round(avg({c}), 6) as {name}_mean, round(stddev_samp({c}), 6) as {name}_std, round(min({c}), 6) as {name}_min, {qs}, round(max({c}), 6) as {name}_max"


def rate(c: str) -> str:
    return f"round(avg(coalesce({c}, false)::int::double), 6)"


def dist(c: str, more: dict | None = None) -> str:
    qs = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99} | (more or {})
    return f"round(avg({c}), 4) as mean, " + ", ".join(f"round(quantile_cont({c}, {q}), 4) as {n}" for n, q in qs.items()) + f", max({c}) as max"


def cut(cutoffs: list[int]) -> str:
    return f"(select unnest({cutoffs})::bigint as cutoff)"


RARE = [5, 10, 20, 50, 100, 250, 500, 1000, 2500, 5000]
MIN_FREQ = [50, 100, 250, 500, 1000, 2500, 5000]
NUMBERS = [10, 25, 50, 100, 250, 500, 1000]
HYBRID = [25, 50, 100, 250, 500, 1000, 2500, 5000]


def by_cutoff(base_where: str, cutoffs: list[int]) -> str:
    return f"""with {TRUE}, q as (select * from p {base_where}), d as (select country, field, token, count(*) as df from {toks('tg', t30)} where country is not null group by all),
sh as (select s, t, sc as country, 'name' as field, unnest(list_intersect({t30('sn')}, {t30('tn')})) as token from q union all select s, t, sc, 'address', unnest(list_intersect({t30('sa')}, {t30('ta')})) from q),
l as (select s, t, min(df) filter (field = 'name') as n, min(df) filter (field = 'address') as a from sh join d using (country, field, token) group by s, t)
select cutoff, count(*) as n_pairs, {rate('n <= cutoff')} as name, {rate('a <= cutoff')} as address, {rate('coalesce(n <= cutoff, false) or coalesce(a <= cutoff, false)')} as either
from q left join l using (s, t) cross join {cut(cutoffs)} group by cutoff"""


def sampled(split: str) -> str:
    return f"{base(split)}, smp as (select * from s1 where entity_id in (select entity_id from (select distinct entity_id from s1) order by md5(entity_id), entity_id limit 2000))"


BASE_BLOCK = f"select distinct k.entity_id as s, y.entity_id as t from {toks('smp', t55)} k join {toks('tg', t55)} y on k.country = y.country and k.field = y.field and k.token = y.token"


def rare_union(src: str, n: int, cutoff: int) -> str:
    return f"""select distinct r.s, y.entity_id as t from (select s, country, token from (select k.entity_id as s, k.country, k.token, row_number() over (partition by k.entity_id, k.country order by df, k.token) as rn
  from {utoks(src, t55)} k join dfu using (country, token) where df <= {cutoff}) where rn <= {n}) r join {utoks('tg', t55)} y on y.country = r.country and y.token = r.token"""


def hybrid(n: int, cutoff: int) -> str:
    r = rare_union("smp", n, cutoff)
    return f"select s, t from ({r}) union select s, t from ({BASE_BLOCK}) where s not in (select s from ({r}) group by s having count(*) >= 100)"


def per_ref(sql: str) -> str:
    return f"select e.entity_id as source1_entity_id, coalesce(n, 0) as n_candidates from smp e left join (select s, count(*) as n from ({sql}) group by s) on s = e.entity_id"


def sweep(cutoffs: list[int], hybrids: bool) -> str:
    grid = ", ".join(f"({c}, {n})" for c in cutoffs for n in (1, 2, 3, 4))
    more = f"""union all select 'BASELINE', s, t from basep union all
  select 'HYBRID / ' || c || ' / ' || n || ' / 100', s, t from (select c, n, s, t from pr union select g.c, g.n, b.s, b.t from basep b cross join grid g where not exists
    (select 1 from size z where z.s = b.s and z.c = g.c and z.n = g.n and z.k >= 100))""" if hybrids else ""
    more_names = "union all select 'BASELINE' union all select 'HYBRID / ' || c || ' / ' || n || ' / 100' from grid" if hybrids else ""
    return f"""with {sampled('train')}, {DFU}, {TRUTH}, st as (select * from truth where s in (select entity_id from smp)), grid(c, n) as (values {grid}), basep as ({BASE_BLOCK}),
ranks as (select k.entity_id as s, k.country, k.token, df, row_number() over (partition by k.entity_id, k.country order by df, k.token) as rn from {utoks('smp', t55)} k join dfu using (country, token)),
met as (select r.s, y.entity_id as t, r.df, r.rn from ranks r join {utoks('tg', t55)} y on y.country = r.country and y.token = r.token where r.rn <= 4 and r.df <= {max(cutoffs)}),
pr as (select distinct c, n, s, t from met join grid on df <= c and rn <= n), size as (select c, n, s, count(*) as k from pr group by all),
names as (select 'RAREST / ' || c || ' / ' || n as method from grid {more_names}),
cands as (select 'RAREST / ' || c || ' / ' || n as method, s, t from pr {more}),
per as (select method, s, count(*) as k from cands group by all), hits as (select method, count(*) as h from cands semi join st on st.s = cands.s and st.t = cands.t group by method)
select m.method, any_value(round(100.0::double * coalesce(h, 0) / (select count(*) from st), 4)) as recall, round(avg(coalesce(k, 0)), 4) as mean, round(quantile_cont(coalesce(k, 0), 0.5), 4) as median,
  round(quantile_cont(coalesce(k, 0), 0.95), 4) as p95, round(quantile_cont(coalesce(k, 0), 0.99), 4) as p99, max(coalesce(k, 0)) as max
from names m cross join smp left join per p on p.method = m.method and p.s = smp.entity_id left join hits on hits.method = m.method group by m.method"""


def ranked(src: str, name_w: str) -> str:
    return f"""ranked as (select s, t, score, row_number() over (partition by s order by score desc, t) as rank from (select k.entity_id as s, y.entity_id as t,
  round(sum({name_w}), 4) as score from {toks(src, t55)} k join known d using (country, token) join {toks('tg', t55)} y on y.country = k.country and y.field = k.field and y.token = k.token group by 1, 2) qualify rank <= 50)"""


IDF = "ln(((select count(*) from tg) + 1)::double / (df + 1)) + 1"
KNOWN_U = f"{DFU}, known as (select country, token, {IDF} as idf from dfu where df <= 100)"
KNOWN_S = f"known as (select country, token, {IDF} as idf from (select country, token, count(*) as df from {toks('tg', t55)} where country is not null group by all) where df <= 100)"
W_IDF = "case when k.field = 'name' then 1.5 else 1.0 end * idf"
W_CNT = "case when k.field = 'name' then 9.0::double + 0.8 * idf else 12.0::double + idf end"

CROSS = f"""with {base()}, ut as (select target_source, country, entity_id as t, unnest(list_distinct(list_concat({t30('name_norm')}, {t30('address_norm')}))) as token from tg),
d as (select target_source, country, token from ut where country is not null group by all having count(*) <= 25),
hits as (select distinct y.target_source, k.entity_id as s, y.t from {utoks('s1', t30)} k join ut y on y.country = k.country and y.token = k.token semi join d on d.target_source = y.target_source and d.country = y.country and d.token = y.token),
cnt as (select ts as target_source, e.entity_id as s, coalesce(n, 0) as n from (select distinct entity_id from s1) e cross join (values ('S2'), ('S3')) v(ts)
  left join (select target_source, s, count(*) as n from hits group by all) h on h.target_source = ts and h.s = e.entity_id)"""

MATCHES = f"""{TRUTH}, mc as (select r.s as source1_entity_id, coalesce(n, 0) as n, coalesce(n2, 0) as n_s2, coalesce(n3, 0) as n_s3 from (select distinct s from raw) r
  left join (select s, count(*) as n, count(*) filter (starts_with(t, 'S2')) as n2, count(*) filter (starts_with(t, 'S3')) as n3 from truth group by s) g on g.s = r.s)"""
NAMES2 = f"""rows2 as (select {na('country')} as country, {norm('(' + na('business_name') + ')')} as name_norm from test_source2),
names2 as (select country, name_norm, count(*) as n from rows2 where name_norm <> '' and country is not null group by all)"""


def _tokens(kind) -> str:
    return f"with {EVERYONE} select entity_id, {joined(kind('name_norm'))} as name_tokens, {joined(kind('address_norm'))} as address_tokens from everyone"


def _id_list() -> str:
    return f"list_filter(list_transform(string_split(coalesce({na('matched_entity_ids')}, ''), ','), lambda x: trim(x, ' ')), lambda x: x <> '')"


def _flags(n: str, a: str) -> str:
    return f"""with {TRUE_LEFT}, f as (select s, t, substr(t, 1, 2) as source, coalesce({n}, false) as n, coalesce({a}, false) as a from p), g as (select * from f union all select s, t, 'all', n, a from f)
select source, count(*) as n_pairs, {rate('n')} as name, {rate('a')} as address, {rate('n or a')} as either from g group by source"""


def _union_shared() -> str:
    u = lambda n, a: f"list_distinct(list_concat({t55(n)}, {t55(a)}))"
    return f"list_intersect({u('sn', 'sa')}, {u('tn', 'ta')})"


def oracle_sql() -> dict[str, str]:
    profile_cols = ("entity_id", "business_name", "business_address", "country")
    miss = ", ".join(f"count(*) filter (({na(c)}) is null) as {c}" for c in profile_cols)
    jx, jy = t1("sa"), t1("ta")
    return {
        "normalize_text": f"with {EVERYONE} select * from everyone",
        "tokens_min1": _tokens(t1), "tokens_min3": _tokens(t3), "tokens_stop55": _tokens(t55), "tokens_stop30": _tokens(t30),
        "token_list_stop30": f"with {EVERYONE} select entity_id, array_to_string(list_filter(string_split(name_norm, ' '), lambda x: len(x) >= 3 and x not in ({_q(STOP30)})), ' ') as name_tokens from everyone",
        "numeric_tokens": f"with {EVERYONE} select entity_id, {joined(nums('address_norm'))} as numbers from everyone",
        "char_set": f"with {EVERYONE} select entity_id, {joined(chars('name_norm'), '')} as name_chars from everyone",
        "char_set_nospace": f"with {EVERYONE} select entity_id, {joined(letters('name_norm'), '')} as name_chars from everyone",
        "id_list_parse": f"select distinct source1_entity_id, array_to_string({_id_list()}, '|') as ids, len({_id_list()}) as n_ids from train_matches",
        "id_provenance": f"with {base()} select entity_id, substr(entity_id, 1, 2) as prefix, starts_with(entity_id, 'S2')::bigint as is_s2, starts_with(entity_id, 'S3')::bigint as is_s3 from tg",
        "token_df_field_global": f"with {base()}, {DF1} select * from df1",
        "token_df_country_field": f"with {base()} select country, field, token, count(*) as df from {toks('tg', t55)} where country is not null group by all",
        "token_df_union": f"with {base()}, {DFU} select * from dfu",
        "token_df_sum": f"with {base()} select country, token, count(*) as df from {toks('tg', t55)} where country is not null group by all",
        "token_df_distinct_per_source": f"with {base()} select target_source, country, token, count(*) as df from (select target_source, country, unnest(list_distinct(list_concat({t30('name_norm')}, {t30('address_norm')}))) as token from tg) where country is not null group by all",
        "numeric_df": f"with {base()} select country, token, count(*) as df from (select country, unnest({nums('address_norm')}) as token from tg) where country is not null group by all",
        "idf": f"with {base()}, {DFU} select country, token, df, round({IDF}, 6) as idf from dfu",
        "exact_name_block": f"with {base()} {named(exact('name'))}",
        "exact_address_block": f"with {base()} {named(exact('address'))}",
        "training_exact_block": f"with {base('train')} {named('select distinct s, t from (' + exact('name') + ' union all ' + exact('address') + ')')}",
        "baseline_token_block": f"with {sampled('test')} {per_ref(BASE_BLOCK)}",
        "rarest_tokens": f"with {base()}, {DF1}, {rarest(3, 3, 25)} select s as source1_entity_id, field, token, df, rn from rare",
        "rarest_union_block": f"with {base()}, {DFU} {named(rare_union('s1', 3, 25))}",
        "hybrid_fallback": f"with {sampled('test')}, {DFU} {per_ref(hybrid(3, 25))}",
        "topk_idf": f"with {base()}, {KNOWN_U}, {ranked('s1', W_IDF)} select s as source1_entity_id, t as candidate_entity_id, score, rank from ranked",
        "hybrid_rank": f"with {base()}, {KNOWN_S}, {ranked('s1', W_CNT)} select s as source1_entity_id, t as candidate_entity_id, score, rank from ranked",
        "cross_field_block": f"{CROSS} select target_source, s as source1_entity_id, n as n_candidates from cnt",
        "candidate_volume": f"""{CROSS}, vol as (select * from cnt union all select 'all', s, sum(n)::bigint from cnt group by s) select target_source, count(*) as n_references, {dist('n', {"p90": 0.9, "p999": 0.999})}, min(n) as least, round(stddev_samp(n), 4) as std,
          count(*) filter (n = 0) as n_empty, {', '.join(f'count(*) filter (n > {k}) as over_{k}' for k in (10, 100, 500, 1000, 5000))} from vol group by target_source""",
        "candidates_v2": f"with {V2} select s as source1_entity_id, t as candidate_entity_id, protected::bigint as protected, score from cand",
        "candidates_v1": f"with {V1} select s as source1_entity_id, t as candidate_entity_id, score from cand",
        "candidates_v2_production": f"with {V2_PRODUCTION} select s as source1_entity_id, t as candidate_entity_id, protected::bigint as protected, score from cand",
        "candidates_v1_production": f"with {V1_PRODUCTION} select s as source1_entity_id, t as candidate_entity_id, score from cand",
        "stage1_top20_production": f"with {V2_PRODUCTION}, {CHEAP} select s as source1_entity_id, t as candidate_entity_id, score, rank from stage1",
        "topk_idf_production": f"""with {base()}, {KNOWN_U.replace("df <= 100)", "df <= 5000)")}, {ranked('s1', W_IDF).replace("rank <= 50", "rank <= 1000")} select s as source1_entity_id, t as candidate_entity_id, score, rank from ranked""",
        "hybrid_rank_production": f"""with {base()}, {KNOWN_S.replace("df <= 100)", "df <= 5000)")}, {ranked('s1', W_CNT).replace("rank <= 50", "rank <= 1000")} select s as source1_entity_id, t as candidate_entity_id, score, rank from ranked""",
        "protected_cap": f"with {V2} select s as source1_entity_id, sum(protected)::bigint as n_protected, count(*) as n_kept from cand group by s",
        "run_totals": f"""with {V2}, k as (select coalesce(n, 0) as k from (select distinct entity_id from s1) left join (select s, count(*) as n from cand group by s) on s = entity_id)
          select count(*) as n_references, sum(k)::bigint as n_pairs, round(avg(k), 4) as mean, max(k) as max, count(*) filter (k = 0) as n_empty from k""",
        "stage1_cheap_score": f"with {V2}, {CHEAP} select s as source1_entity_id, t as candidate_entity_id, name_exact, address_exact, name_shared, address_shared, score from cheap",
        "stage1_top20": f"with {V2}, {CHEAP} select s as source1_entity_id, t as candidate_entity_id, score, rank from stage1",
        "stage1_reduction": f"with {V2}, {CHEAP} select b as n_before, a as n_after, round(100.0::double * (1 - a::double / b), 4) as reduction_percent from (select (select count(*) from cand) as b, (select count(*) from stage1) as a)",
        "features_serving": f"with {ALL_CANDIDATES}, {ALL_KEPT} {features('(select s, t from stage1)', False)}",
        "features_training": f"with {TRAIN} {features('tp', True)}",
        "truth_pairs": f"with {TRUTH} select s as source1_entity_id, t as target_entity_id from truth",
        "training_positives": f"with {TRAIN} select s as source1_entity_id, t as candidate_entity_id, label from pos",
        "training_negatives": f"with {TRAIN} select s as source1_entity_id, t as candidate_entity_id, label from neg",
        "stratified_split": f"""with {TRAIN} select s as source1_entity_id, t as candidate_entity_id, label, case when rn <= floor(n * 0.2) then 'test' else 'train' end as part from
          (select s, t, label, row_number() over (partition by label order by md5(s || t), s, t) as rn, count(*) over (partition by label) as n from tp)""",
        "jaccard_variants": f"""with {TRUE} select s as source1_entity_id, t as candidate_entity_id, round({jac(jx, jy, '1.0')}, 6) as both_empty_one, round({jac(jx, jy)}, 6) as empty_union_zero,
          round(case when len({jx}) = 0 or len({jy}) = 0 then 0.0::double else {jac(jx, jy)} end, 6) as any_empty_zero, round({ovl(jx, jy)}, 6) as overlap from p""",
        "recall_block_exact": _flags("sc = tc and sn = tn and sn <> ''", "sc = tc and sa = ta and sa <> ''"),
        "recall_shared_token": _flags(f"sc = tc and {isect(t30('sn'), t30('tn'))} > 0", f"sc = tc and {isect(t30('sa'), t30('ta'))} > 0"),
        "recall_rare_cutoff": by_cutoff("where sc = tc", RARE),
        "recall_min_freq": by_cutoff("", MIN_FREQ),
        "recall_shared_count": f"""with {TRUE}, k as (select {isect(t55('sn'), t55('tn'))} as n, {isect(t55('sa'), t55('ta'))} as a from p) select threshold, {rate('n >= threshold')} as name, {rate('a >= threshold')} as address,
          {rate('n >= threshold or a >= threshold')} as either from k cross join (select unnest(range(1, 6)) as threshold) group by threshold""",
        "recall_numeric": f"""with {TRUE}, d as (select country, token, count(*) as df from (select country, unnest({nums('address_norm')}) as token from tg) where country is not null group by all),
          l as (select s, t, min(df) as least from (select s, t, sc as country, unnest(list_intersect({nums('sa')}, {nums('ta')})) as token from p) join d using (country, token) group by s, t)
          select cutoff, count(*) as n_pairs, {rate('least <= cutoff')} as recall from p left join l using (s, t) cross join {cut(NUMBERS)} group by cutoff""",
        "recall_hybrid_rule": f"""with {TRUE}, {DFU}, x as (select s, t, sc as country, {_union_shared()} as shared from p), l as (select s, t, min(df) as least from (select s, t, country, unnest(shared) as token from x) join dfu using (country, token) group by s, t)
          select cutoff, count(*) as n_pairs, {rate('coalesce(least <= cutoff, false) or len(shared) >= 2')} as recall from x left join l using (s, t) cross join {cut(HYBRID)} group by cutoff""",
        "weighted_score_dist": f"""with {TRUE}, {DFU}, x as (select s, t, sc as country, 1.5 as w, unnest(list_intersect({t55('sn')}, {t55('tn')})) as token from p union all select s, t, sc, 1.0, unnest(list_intersect({t55('sa')}, {t55('ta')})) from p),
          g as (select s, t, sum(w * coalesce({IDF}, 1.0)) as v from x left join dfu using (country, token) group by s, t), sc as (select round(coalesce(v, 0.0::double), 4)::double as score from p left join g using (s, t))
          select count(*) as n_pairs, {dist('score')} from sc""",
        "similarity_profile": f"""with {TRUE_LEFT}, z as (select coalesce(sn, '') as sn, coalesce(sa, '') as sa, coalesce(tn, '') as tn, coalesce(ta, '') as ta, sc, tc from p),
          x as (select sn = tn and sn <> '' as nx, sa = ta and sa <> '' as ax, coalesce(sc = tc, false) as cx, {jac(t1('sn'), t1('tn'))} as nj, {jac(t1('sa'), t1('ta'))} as aj from z)
          select count(*) as n_pairs, {rate('nx')} as name_exact, {rate('ax')} as address_exact, {rate('cx')} as country_match, {rate('nx and ax')} as both_exact, {_describe('nj', 'name_jaccard')}, {_describe('aj', 'address_jaccard')} from x""",
        "dangling_pairs": f"""with {base('train')}, {TRUTH}, m as (select s, t, s not in (select entity_id from s1) as no_s, t not in (select entity_id from tg) as no_t from truth)
          select s as source1_entity_id, t as target_entity_id, case when no_s and no_t then 'both' when no_s then 'reference' else 'target' end as missing from m where no_s or no_t""",
        "best_match_alike": f"with {ALIKE}, {BEST} select entity_id as source1_entity_id, coalesce(t, '') as matched_entity_ids from (select distinct entity_id from s1) left join best on s = entity_id",
        "all_matches_alike": f"""with {ALIKE} select entity_id as source1_entity_id, coalesce(m, '') as matched_entity_ids from (select distinct entity_id from s1)
          left join (select s, string_agg(distinct t, ',' order by t) as m from alike where p >= 0.5 group by s) on s = entity_id""",
        "scored_matches_alike": f"with {ALIKE}, {BEST} select s as source1_entity_id, t as matched_entity_ids, p as match_probability from best",
        "match_totals_alike": f"""with {ALIKE}, {BEST} select count(*) as n_references, count(t) as n_matched, count(*) - count(t) as n_unmatched from (select distinct entity_id from s1) left join best on s = entity_id""",
        "metrics_alike": f"""with {ALIKE_TRAIN}, n as (select count(*) filter (p >= 0.5 and y) as tp, count(*) filter (p >= 0.5 and not y) as fp, count(*) filter (p < 0.5 and y) as fn from alike),
          steps as (select p, count(*) filter (y) as pos, count(*) as k from alike group by p), run as (select pos, sum(pos) over (order by p desc) as tp, sum(k) over (order by p desc) as k from steps),
          r as (select tp / (tp + fp) as precision, tp / (tp + fn) as recall, (select sum(pos * tp / k) / sum(pos) from run) as average_precision from n)
          select round(precision, 6) as precision, round(recall, 6) as recall, round(2 * precision * recall / (precision + recall), 6) as f1,
          round(1.25 * precision * recall / (0.25 * precision + recall), 6) as f05, round(average_precision, 6) as average_precision from r""",
        "report_alike": f"""with {ALIKE_TRAIN}, c as (select unnest([true, false]) as c), per as (select c, count(*) filter ((p >= 0.5) = c and y = c) as tp, count(*) filter ((p >= 0.5) = c and y <> c) as fp,
          count(*) filter ((p >= 0.5) <> c and y = c) as fn from alike cross join c group by c),
          r as (select c, coalesce(tp / nullif(tp + fp, 0), 0) as pr, coalesce(tp / nullif(tp + fn, 0), 0) as re, tp, tp + fn as n from per), f as (select *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) as f1 from r)
          select case when c then '1' else '0' end as class, round(pr, 6) as precision, round(re, 6) as recall, round(f1, 6) as f1, n as support from f
          union all select 'accuracy', null, null, round(sum(tp) / sum(n), 6), sum(n)::bigint from f
          union all select 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6), sum(n)::bigint from f
          union all select 'weighted avg', round(sum(pr * n) / sum(n), 6), round(sum(re * n) / sum(n), 6), round(sum(f1 * n) / sum(n), 6), sum(n)::bigint from f""",
        "threshold_sweep_alike": f"""with {ALIKE_TRAIN}, h as (select unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::double as threshold),
          n as (select threshold, count(*) filter (p >= threshold and y) as tp, count(*) filter (p >= threshold) as k, count(*) filter (y) as pos from alike cross join h group by threshold),
          r as (select threshold, tp / nullif(k, 0) as pr, tp / pos as re from n) select threshold, round(pr, 6) as precision, round(re, 6) as recall, round(1.25 * pr * re / nullif(0.25 * pr + re, 0), 6) as f05 from r""",
        "sweep_rarest": sweep([10, 25, 50, 100], False),
        "sweep_hybrid": sweep([10, 25, 50], True),
        "recall_at_k": f"""with {sampled('train')}, {TRUTH}, st as (select * from truth where s in (select entity_id from smp)), k as (select unnest([50, 100, 250, 500, 1000])::bigint as k),
          a as (with {KNOWN_U.replace("df <= 100)", "df <= 5000)")}, {ranked('smp', W_IDF).replace("rank <= 50", "rank <= 1000")} select * from ranked),
          b as (with {KNOWN_S.replace("df <= 100)", "df <= 5000)")}, {ranked('smp', W_CNT).replace("rank <= 50", "rank <= 1000")} select * from ranked)
          select 'idf' as ranking, k, count(*) as n_true, count(*) filter (rank <= k) as found, {rate('rank <= k')} as recall from st left join a using (s, t) cross join k group by k
          union all select 'hybrid', k, count(*), count(*) filter (rank <= k), {rate('rank <= k')} from st left join b using (s, t) cross join k group by k""",
        "missing_values": " union all ".join(f"select 'S{i}' as source, count(*) as n_rows, {miss} from train_source{i}" for i in (1, 2, 3)),
        "dup_ids": " union all ".join(f"select 'S{i}' as source, count(*) as n_rows, count(*) - count(distinct entity_id) as n_duplicates from train_source{i}" for i in (1, 2, 3)),
        "country_counts": f"select {na('country')} as country, count(*) as n from train_source1 group by 1",
        "match_count_hist": f"with {MATCHES} select n as n_matches, count(*) as n_references from mc group by n",
        "match_summary": f"with {MATCHES} select count(*) filter (n = 0) as unmatched, count(*) filter (n = 1) as singletons, count(*) filter (n > 1) as multi, max(n) as most from mc",
        "match_type": f"""with {MATCHES} select case when n_s2 > 0 and n_s3 > 0 then 'BOTH_S2_S3' when n_s2 > 0 then 'S2_ONLY' when n_s3 > 0 then 'S3_ONLY' else 'NONE' end as match_type,
          count(*) as n, sum(n_s2)::bigint as n_s2, sum(n_s3)::bigint as n_s3 from mc group by 1""",
        "match_by_country": f"with {base('train')}, {MATCHES} select country, count(*) as n_references, round(avg(n), 6) as mean, quantile_cont(n, 0.5) as median, min(n) as least, max(n) as most from mc join s1 on entity_id = source1_entity_id where country is not null group by country",
        "name_dup_profile": f"with {NAMES2} select n as occurrences, count(*) as n_names from names2 group by n",
        "name_dup_summary": f"""with {NAMES2}, r as (select count(*) filter (name_norm = '') as n_empty, count(*) filter (name_norm <> '') as n_rows from rows2)
          select any_value(n_empty) as n_empty, any_value(n_rows) as n_rows, count(*) as n_names, sum(case when n = 1 then n else 0 end)::bigint as rows_unique, sum(case when n > 1 then n else 0 end)::bigint as rows_duplicated,
          round(avg(n), 6) as mean, round(stddev_samp(n), 6) as std, min(n) as least, round(quantile_cont(n, 0.25), 6) as p25, round(quantile_cont(n, 0.5), 6) as median, round(quantile_cont(n, 0.75), 6) as p75, max(n) as most,
          round(sum(case when n = 1 then n else 0 end) / any_value(n_rows), 6) as share_unique, round(sum(case when n > 1 then n else 0 end) / any_value(n_rows), 6) as share_duplicated from names2 cross join r""",
        "unique_names_by_country": f"select country, count(distinct name_norm) as n_names from ({prepared('test_source2')}) where name_norm <> '' and country is not null group by country",
        "top_names": f"with {NAMES2} select country, name_norm, n from names2 order by n desc, country, name_norm limit 20",
        "inspect_entity": f"""with {TRUTH}, one as (select s from truth group by s order by count(*) desc, s limit 1) select distinct 'reference' as role, entity_id, business_name, business_address, country from train_source1 where entity_id in (select s from one)
          union select distinct 'match', entity_id, business_name, business_address, country from (select * from train_source2 union all select * from train_source3) where entity_id in (select t from truth where s in (select s from one))""",
    }
