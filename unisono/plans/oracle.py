"""DuckDB SQL that checks the registered queries on the same tables."""

from __future__ import annotations

import re

from unisono.functions.offsets import ABBREVIATION
from unisono.functions.text import ATTRIBUTION, CONJUNCTIONS, DATELINE, STOPWORDS, STRIP, SYNDICATION, TEMPLATE, TOKEN
from unisono.operators.research import POISSON, PRIME
from unisono.operators.surge import RANKINGS
from unisono.params import P


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(map(_q, words)) + "]"


_CLEAN = "text"
for _p in STRIP:
    _CLEAN = f"regexp_replace({_CLEAN}, {_q(_p)}, ' ', 'g')"
_FOLD = "regexp_replace(regexp_replace({t}, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')"
CONTENT = f"len(list_filter(string_split({{g}}, ' '), lambda t: not list_contains({_list(STOPWORDS)}, t)))"

STM = f"""stm0 as (
  select doc_id, 'doc:' || doc_id as id, source as bioguide, case when cast(substr(source, 4) as int) % 2 = 0 then 'D' else 'R' end as party,
    cast(date '2024-01-01' + cast((doc_id // 20) % 30 as int) as date) as day, case when doc_id % 37 = 0 then 2 else 1 end as lane,
    'S' || (cast(substr(source, 4) as int) % 5) as state, 118 as congress, text,
    regexp_matches(substr({_FOLD.format(t='text')}, 1, 240), {_q(SYNDICATION)}) as syndicated, lower({_FOLD.format(t='text')}) as folded
  from documents
), stm_sig as (select day, folded from stm0 group by all having count(distinct bioguide) > 1),
stm1 as (
  select s.*, case when g.day is not null then 'joint:' || sha256(strftime(s.day, '%Y-%m-%d') || chr(1) || s.folded)[:24] end as joint_group
  from stm0 s left join stm_sig g on s.day = g.day and s.folded = g.folded
), stm as (select *, coalesce(joint_group, bioguide, id) as unit from stm1)"""
SENT = f"""seg as (select doc_id, unnest(string_split(regexp_replace({_CLEAN}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) as s from documents),
sent as (select doc_id, regexp_extract_all(lower(regexp_replace(s, {_q(DATELINE)}, '')), {_q(TOKEN)}) as toks from seg)"""


def grams(lo: int, hi: int) -> str:
    return f"""raw_grams as (
  select distinct doc_id, array_to_string(toks[i + 1 : i + n], ' ') as ngram
  from (select doc_id, toks, n, unnest(range(len(toks) - n + 1)) as i from sent cross join (select unnest(range({lo}, {hi + 1})) as n) where len(toks) >= n)
), grams as (select * from raw_grams where not regexp_matches(ngram, {_q(TEMPLATE)}) and {CONTENT.format(g='ngram')} >= 2)"""




def _masked(text: str, pattern: str) -> str:
    """Every match blanked at its length."""
    p = _q(pattern)
    return f"array_to_string(list_transform(list_zip(regexp_split_to_array({text}, {p}), list_append(regexp_extract_all({text}, {p}), '')), lambda z: z[1] || repeat(' ', length(z[2])::int)), '')"


def _placed(source: str, keys: str, text: str, token: str, name: str) -> str:
    """Tokens of `text` with their places, from `start` (a column) on."""
    return f"""{name}_lists as (
  select {keys}, start, regexp_extract_all({text}, {_q(token)}) as toks, list_transform(regexp_split_to_array({text}, {_q(token)}), lambda g: length(g)) as gaps from {source}
), {name}_flat as (
  select {keys}, start, unnest(toks) as tok, unnest(gaps[1:len(toks)]) as gap, generate_subscripts(toks, 1) as k from {name}_lists where len(toks) > 0
), {name} as (
  select {keys}, k, tok, start + (sum(gap + length(tok)) over w)::bigint - length(tok) as s, start + (sum(gap + length(tok)) over w)::bigint as e
  from {name}_flat window w as (partition by {keys} order by k)
)"""


HELD_FORMS = ("all rights reserved", "version 2.0", "idiot")
_MASKS = ""
for _i, _p in enumerate(STRIP):
    _MASKS += f"m{_i + 1} as materialized (select doc_id, {_masked('text', _p)} as text from m{_i}), "
_FORM_HITS = " union all ".join(
    f"select doc_id, s, e from (select doc_id, s, lead(e, {len(f) - 1}) over (partition by doc_id order by k) as e, "
    + " and ".join(f"lead(tok, {i}) over (partition by doc_id order by k) = {_q(w)}" for i, w in enumerate(f))
    + " as hit from plain) where hit"
    for f in (re.findall("[a-z0-9]+", x) for x in HELD_FORMS)
)
HELD = f"""m0 as (select doc_id, coalesce(text, '') as text from documents), {_MASKS}
pieces as (
  select doc_id, unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) as piece,
    unnest(list_append(list_transform(regexp_extract_all(text, '[.!?](\\s+)', 1), lambda x: length(x)), 0)) as gap, unnest(range(len(regexp_extract_all(text, '[.!?]\\s+')) + 1)) as no
  from m{len(STRIP)}
), sents as (
  select doc_id, no, piece, (sum(length(piece) + gap) over (partition by doc_id order by no))::bigint - length(piece) - gap as begin, length(regexp_extract(piece, {_q(DATELINE)})) as head from pieces
), bodies as (select doc_id, no, lower(substr(piece, head + 1)) as body, begin + head as start from sents),
{_placed("bodies", "doc_id, no", "body", TOKEN, "placed")},
lows as (select doc_id, lower(coalesce(text, '')) as body, 0 as start from documents),
{_placed("lows", "doc_id", "body", "[a-z0-9]+", "plain")},
spans as ({_FORM_HITS}),
lists as (select doc_id, no, list(tok order by k) as toks, list(s order by k) as ss, list(e order by k) as es from placed group by all),
runs as (
  select doc_id, array_to_string(toks[i + 1 : i + n], ' ') as ngram, ss[i + 1] as s, es[i + n] as e
  from (select *, unnest(range(len(toks) - n + 1)) as i from lists cross join (select unnest(range({P.ngram_min}, {P.ngram_max + 1})) as n) where len(toks) >= n)
), fit as (select * from runs where {CONTENT.format(g='ngram')} >= 2 and not regexp_matches(ngram, {_q(TEMPLATE)})),
judged as (
  select f.doc_id, ngram, bool_or(not exists (select 1 from spans p where p.doc_id = f.doc_id and p.s < f.e and p.e > f.s)) as free from fit f group by all
)"""
OCC = f"""{STM}, {SENT}, {grams(P.ngram_min, P.ngram_max)},
el as (select * from stm where lane = 1 and not syndicated and party in ('D', 'R', 'I')),
occ_all as (select g.ngram, e.* from grams g join el e using (doc_id)),
cells_all as (select ngram, day, party, count(distinct unit) as units from occ_all group by all)"""
LEDGER = f"""{OCC}, cand as (select distinct ngram from cells_all where units >= {P.quorum}),
occ as (select * from occ_all where ngram in (select ngram from cand)),
cells as (select * from cells_all where ngram in (select ngram from cand)),
tot as (select ngram, max(units) as peak_units, sum(units)::bigint as total_uses from cells group by 1),
un as (select ngram, count(distinct unit) as distinct_units from occ group by 1),
strata as (select congress, party, count(*) as docs from el group by all),
dfs as (select ngram, max(df / docs) as df_share from (select congress, party, ngram, count(distinct doc_id) as df from occ group by all) join strata using (congress, party) group by 1),
fst as (select ngram, min(struct_pack(day := day, doc_id := doc_id, bioguide := bioguide)) as f from occ group by 1),
tie as (select o.ngram, list_sort(list(distinct o.bioguide)) as ties from occ o join fst on o.ngram = fst.ngram where o.day = fst.f.day and o.bioguide <> fst.f.bioguide group by 1),
phrases as (
  select t.ngram, t.peak_units, t.total_uses, u.distinct_units, round(d.df_share, 6) as df_share, round(1 - least(1.0, d.df_share), 3) as df_weight, f.f.day as first_day, f.f.bioguide as first_bioguide, coalesce(ties, []) as ties
  from tot t join un u using (ngram) join dfs d using (ngram) join fst f using (ngram) left join tie using (ngram)
  where d.df_share <= {P.df_share_max} and t.peak_units >= {P.quorum} and t.total_uses >= {P.total_uses_min} and u.distinct_units >= 2
), daily as (select * from cells where ngram in (select ngram from phrases))"""
VELOCITY = """ser as (select ngram, day, max(units) as units from daily where party in ('D', 'R') group by all),
vel as (select *, avg(units) over (partition by ngram order by day rows between 14 preceding and 1 preceding) as m from ser),
velo as (select ngram, day, units, round(case when m is null then units::double when m = 0 then units / 0.5 else units / m end, 2) as velocity from vel)"""
LOW = CONTENT.format(g="ngram") + " < 2"
WEAK = f"({LOW} or (list_contains({_list(CONJUNCTIONS)}, string_split(ngram, ' ')[1]) and (ends_with(ngram, '''s') or ends_with(ngram, 's'''))))"
_LAST = "string_split({g}, ' ')[-1]"
SCAFFOLD = (
    f"case when list_has_any(string_split({{g}}, ' '), {_list(ATTRIBUTION)}) then 'REJECT_ATTRIBUTION_FRAME' when list_contains({_list(STOPWORDS)}, {_LAST}) or ends_with({_LAST}, '''s') or ends_with({_LAST}, 's''') "
    f"or ends_with({_LAST}, '’s') or ends_with({_LAST}, 's’') then 'REJECT_INCOMPLETE_SYNTACTIC_SPAN' end"
)
FOCUS = "2024-01-15"
RANKED = f"""{LEDGER}, {VELOCITY}, side as (
  select ngram, coalesce(max(case when party = 'D' then units end), 0) as d, coalesce(max(case when party = 'R' then units end), 0) as r from daily where day = date '{FOCUS}' and party in ('D', 'R') group by 1
), ranked as (
  select ngram, case when d >= r then 'D' else 'R' end as party, greatest(d, r) as peak, velocity, df_weight, {CONTENT.format(g='ngram')}::int as content
  from side join velo using (ngram) join phrases using (ngram) where velo.day = date '{FOCUS}' and greatest(d, r) >= {P.quorum} and not {WEAK}
)"""
_RORD = "order by peak desc, content desc, df_weight desc, velocity desc, ngram"
EV = """ev as (select event_type as phrase, cast(user_id as varchar) as unit, case when user_id % 2 = 0 then 'D' else 'R' end as party, cast(ts as date) as day, ts, value, event_id from events),
den as (select party, day, count(distinct unit) as trials from ev group by all),
dly as (select phrase, party, day, count(distinct unit) as successes from ev where value > 50 group by all)"""
SURGE = f"""{EV}, cal as (
  select party, day, trials, coalesce(sum(trials) over w, 0)::bigint as base_n, min(day) over w as base_from, max(day) over w as base_to from den where trials > 0
  window w as (partition by party order by day rows between {P.surge_window} preceding and 1 preceding)
), bas as (
  select d.phrase, d.party, d.day, d.successes as k, c.trials as n, c.base_n, coalesce((select sum(x.successes) from dly x where x.phrase = d.phrase and x.party = d.party and x.day between c.base_from and c.base_to), 0)::bigint as base_k,
    case when c.base_to is not null then coalesce((select x.successes from dly x where x.phrase = d.phrase and x.party = d.party and x.day = c.base_to), 0) / (select trials from den z where z.party = d.party and z.day = c.base_to) end as prior_share
  from dly d join cal c using (party, day) where d.successes > 0
), mea as (
  select *, k / n as share, least((base_k + 0.5) / (base_n + 1), 1.0) as base from bas
), mea2 as (
  select *, share / base as ratio, share - base as change, share - coalesce(prior_share, 0) as spread,
    case when k <= 0 or base >= 1 then 1.0 else least(1.0, list_sum(list_transform(range(least(k, n), n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(base) + (n - i) * ln(1 - base))))) end as p
  from mea
), sk as (
  select *, abs(coalesce(max(case when party = 'D' then share end) over (partition by phrase, day), 0) - coalesce(max(case when party = 'R' then share end) over (partition by phrase, day), 0)) as skew,
    row_number() over (partition by day order by p, phrase, party) as r, count(*) over (partition by day) as m from mea2
), bh as (select *, least(1.0, min(p * m / r) over (partition by day order by r desc rows between unbounded preceding and current row)) as q from sk)"""

_CUT = "'[.!?]\\s+|\n+'"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SENTENCES = f"""p as (
  select doc_id, unnest(regexp_split_to_array(text, {_CUT})) as body, unnest(list_append(regexp_extract_all(text, {_CUT}), '')) as sep, unnest(range(len(regexp_extract_all(text, {_CUT})) + 1)) as no
  from documents where text is not null
), pp as (
  select doc_id, no, body || case when sep[1:1] in ('.', '!', '?') then sep[1:1] else '' end as piece,
    (sum(length(body) + length(sep)) over (partition by doc_id order by no))::bigint - length(body) - length(sep) as start from p
), q as (select *, regexp_matches(rtrim(piece, {_BLANK}), {_q('(?i)' + ABBREVIATION.pattern.replace(chr(92) + 'b', '(?:^|[^\\pL\\pN_])'))}) as goes_on from pp where trim(piece, {_BLANK}) <> ''),
i as (select *, sum(case when before then 0 else 1 end) over (partition by doc_id order by no) as part from (select *, coalesce(lag(goes_on) over (partition by doc_id order by no), false) as before from q)),
spans as (
  select doc_id, (min(start + length(piece) - length(ltrim(piece, {_BLANK}))))::int as start, (max(start + length(rtrim(piece, {_BLANK}))))::int as end_ from i group by doc_id, part
)"""

ORACLE_SQL: dict[str, str] = {
    "normalize_dedupe": "select 'sha256:' || sha256('https://example.test/' || source || chr(10) || text) as id, min(doc_id) as doc_id from documents where trim(text) <> '' group by 1",
    "sentence_places": f'with {SENTENCES} select doc_id, start, end_ as "end" from spans',
    "held_ngrams": f"with {HELD} select doc_id, count(*) filter (free) as kept, count(*) filter (not free) as dropped from judged group by 1",
    "exact_joint_groups": f"with {STM} select day, count(*) as n, count(distinct bioguide) as offices, min(doc_id) as first_doc from stm where joint_group is not null group by day, folded",
    "syndication_flag": f"with {STM} select syndicated, count(*) as n from stm group by 1",
    "clean_text_lengths": f"select doc_id, length({_CLEAN})::int as n from documents",
    "sentence_token_counts": f"with {SENT} select doc_id, count(*)::int as sentences, sum(len(toks))::bigint as tokens from sent where len(toks) > 0 group by 1",
    "text_features": r"""select doc_id, len(regexp_extract_all(text, '\S+'))::bigint as words, len(regexp_extract_all(lower(text), '[.!?]+'))::bigint as sentences, (length(text) - length(replace(text, '!', '')))::bigint as exclamations,
      (length(text) - length(replace(text, ';', '')))::bigint as semicolons, (length(text) - length(replace(text, '?', '')))::bigint as questions, len(regexp_extract_all(lower(text), '(?:^|[^a-z])i(?:[^a-z]|$)'))::bigint as first_person, regexp_matches(text, '[A-Z]{4,}') as has_caps
      from documents where len(regexp_extract_all(text, '\S+')) >= 20""",
    "doc_ngrams_counts": f"with {SENT}, {grams(3, 6)} select doc_id, count(*) as grams from raw_grams group by 1",
    "lowcontent_filter": f"with {SENT}, {grams(3, 6)} select doc_id, count(*) as grams from grams group by 1",
    "sync_candidates": f"with {OCC} select ngram, day, party, units from cells_all where units >= {P.quorum}",
    "ledger_phrases": f"with {LEDGER} select * exclude (ties), array_to_string(ties, ',') as ties from phrases",
    "ledger_daily": f"with {LEDGER} select ngram, day, party, units from daily",
    "phrase_summary": f"""with {LEDGER} select ngram, max(units) as peak, arg_max(day, struct_pack(u := units, d := -(day - date '1970-01-01'), p := case party when 'D' then 2 when 'R' then 1 else 0 end)) as peak_day,
      arg_max(party, struct_pack(u := units, d := -(day - date '1970-01-01'), p := case party when 'D' then 2 when 'R' then 1 else 0 end)) as peak_party, (max(day) - min(day))::int as span, count(distinct day) as active_days from daily group by 1""",
    "discipline_index": f"""with {LEDGER}, docs as (select party, day, count(*) as docs from el group by all), used as (select party, day, count(distinct unit) as u from occ where ngram in (select ngram from phrases) group by all)
      select party, day, docs, coalesce(u, 0) as units, round(least(coalesce(u, 0), docs) / docs, 6) as share from docs left join used using (party, day)""",
    "velocity": f"with {LEDGER}, {VELOCITY} select ngram, day, units, velocity from velo",
    "top_synchronized_day": f"with {RANKED} select * from ranked {_RORD} limit 50",
    "top_by_party": f"with {RANKED} select * replace (rank::int as rank) from (select *, row_number() over (partition by party {_RORD}) as rank from ranked) where rank <= 10",
    "adoption_curve": f"with {LEDGER}, c as (select ngram, day, max(units) as units from daily where day >= date '2024-01-08' group by all) select ngram, count(*) as days, sum(units)::bigint as uses, max(units) as peak, arg_max(day, struct_pack(u := units, d := -(day - date '1970-01-01'))) as peak_day from c group by 1",
    "adoption_exemplars": f"with {LEDGER} select ngram, day, party, units from (select *, row_number() over (partition by party order by units desc, day, ngram) as r from daily where day <= date '2024-01-20' and day > date '2024-01-13' and units >= 3) where r = 1",
    "coverage_by_year_party": "select year(o_orderdate)::int as year, count(*) filter (o_orderpriority like '1%') as urgent, count(*) filter (o_orderpriority not like '1%') as other from orders group by 1",
    "ledger_merge": f"""with {STM}, sh as (select congress, doc_id % 3 as shard, bioguide as ngram, min(day) as first_day, count(*) as peak_units, round(1.0 / count(*), 6) as df_weight from stm group by all)
      select ngram, min(first_day) as first_day, min(struct_pack(d := first_day, s := shard)).s as first_shard, max(peak_units) as peak_units, min(df_weight) as df_weight, count(*) as shards from sh group by 1""",
    "lane_partition_check": f"with {STM}, i as (select congress, id, count(distinct lane) as lanes, count(*) as n from stm group by all) select congress::int as congress, sum(n)::bigint as statements, count(*) as ids, count(*) filter (lanes > 1) as shared_ids from i group by 1",
    "cross_party_days": f"with {OCC}, w as (select ngram, day, max(units) filter (party = 'D') as d, max(units) filter (party = 'R') as r from cells_all group by all) select day, count(*) as phrases from w where d >= 2 and r >= 2 group by 1",
    "duet_candidates": f"""with {OCC}, w as (select ngram, day, max(units) filter (party = 'D') as d, max(units) filter (party = 'R') as r from cells_all group by all),
      x as (select ngram, day, least(d, r) as "both", greatest(d, r) as "either" from w where d >= 2 and r >= 2)
      select * replace (rank::int as rank) from (select *, row_number() over (partition by day order by "both" desc, "either" desc, ngram) as rank from x) where rank <= 50""",
    "log_odds_phrases": f"""with {LEDGER}, h as (select case when day < date '2024-01-16' then 'early' else 'late' end as era, party, ngram, sum(units)::bigint as n from daily group by all),
      t as (select *, sum(n) over (partition by party, ngram) - n as rest, sum(n) over (partition by party, era) as te, sum(n) over (partition by party) as ta from h),
      s as (select era, party, ngram, n, round(ln((n + 0.5) / (te - n + 0.5)) - ln((rest + 0.5) / (ta - te - rest + 0.5)), 6) as log_odds from t)
      select * replace (rank::int as rank) from (select *, row_number() over (partition by era, party order by log_odds desc, n desc, ngram) as rank from s) where rank <= 10""",
    "phrase_receipts": f"""with {LEDGER}, {VELOCITY}, pk as (select ngram, arg_max(day, struct_pack(u := units, d := -(day - date '1970-01-01'))) as day from ser group by 1),
      o1 as (select o.ngram, o.day, o.party, o.unit, min(o.doc_id) as doc_id from occ o join pk using (ngram, day) group by all)
      select ngram, day, party, doc_id, rank::int as rank from (select *, row_number() over (partition by ngram, party order by unit, doc_id) as rank from o1) where rank <= 3 and unit not like 'joint:%'""",
    "surge_baseline": f"with {SURGE} select phrase, party, day, k, n, base_k, base_n, round(prior_share, 6) as prior_share from bas",
    "surge_binomial": f"with {SURGE} select phrase, party, day, round(share, 6) as share, round(base, 6) as base, round(ratio, 6) as ratio, round(change, 6) as change, round(p, 4) as p, round(skew, 6) as skew, round(spread, 6) as spread from bh",
    "surge_bh": f"with {SURGE} select phrase, party, day, round(q, 6) as q, change >= {P.surge_change} and ratio >= {P.surge_ratio} and q <= {P.surge_q} as surge from bh",
    "surge_weekday_baseline": f"""with {EV}, c as (select party, day, trials, coalesce(sum(trials) over (partition by party, isodow(day) order by day rows between 28 preceding and 1 preceding), 0)::bigint as base_n from den)
      select d.phrase, d.party, d.day, d.successes as k, c.base_n, coalesce((select sum(x.successes) from dly x where x.phrase = d.phrase and x.party = d.party and x.day < d.day and isodow(x.day) = isodow(d.day)), 0)::bigint as base_k from dly d join c using (party, day)""",
    "overdispersion": f"""with {EV}, b as (select * from (select *, row_number() over (partition by party order by day desc) as r from den where trials > 0 and day < (select max(day) from den)) where r <= {P.surge_window}),
      x as (select q.phrase, b.party, b.trials as t, coalesce(d.successes, 0) as s from (select distinct phrase, party from dly) q join b using (party) left join dly d on d.phrase = q.phrase and d.party = b.party and d.day = b.day),
      j as (select *, sum(s) over (partition by phrase, party) / sum(t) over (partition by phrase, party) as p from x)
      select phrase, party, count(*) as days, round(sum((s - t * p) ** 2 / (t * p * (1 - p))) / (count(*) - 1), 6) as dispersion from j where p > 0 and p < 1 group by 1, 2 having count(*) >= 3""",
    "burst_sessions": """with d as (select user_id, cast(ts as date) as day, count(*) as c from events group by all), g as (select *, case when day - lag(day) over (partition by user_id order by day) <= 2 then 0 else 1 end as new from d),
      b as (select *, sum(new) over (partition by user_id order by day) as burst from g)
      select user_id, burst::int as burst, min(day) as start, max(day) as stop, sum(c)::bigint as total, arg_max(day, struct_pack(c := c, d := -(day - date '1970-01-01'))) as peak_day, (arg_max(day, struct_pack(c := c, d := -(day - date '1970-01-01'))) - min(day))::int as width from b group by user_id, burst""",
    "eligible_offices_asof": """with iv as (select o_custkey as office, cast(o_orderdate as date) as s, cast(o_orderdate + interval 90 day as date) as e, c_nationkey % 2 as party from orders join customer on o_custkey = c_custkey),
      days as (select unnest(generate_series(date '1996-01-01', date '1996-12-01', interval 1 month))::date as day)
      select day, party::int as party, count(distinct office) as eligible from days join iv on day >= s and day < e group by all""",
    "source_state_asof": """with iv as (select o_custkey as office, cast(o_orderdate as date) as s, cast(o_orderdate + interval 365 day as date) as e, o_orderpriority as st from orders),
      f as (select distinct c_custkey as office, date '1997-06-01' as day from customer), h as (select office, arg_max(st, struct_pack(s := s, st := st)) as state from f join iv using (office) where day >= s and day < e group by 1)
      select office, day, coalesce(state, 'unattestable') as state from f left join h using (office)""",
    "participation": f"""with {LEDGER}, n as (select distinct doc_id from occ where ngram in (select ngram from phrases)), s as (select s.*, n.doc_id is not null as hit from stm s left join n using (doc_id))
      select party, day, count(distinct bioguide) as offices, count(distinct case when hit then bioguide end) as offices_in, count(distinct doc_id) as publications, count(distinct case when hit then doc_id end) as publications_in,
        round(count(distinct case when hit then bioguide end) / count(distinct bioguide), 6) as office_share, round(count(distinct case when hit then doc_id end) / count(distinct doc_id), 6) as publication_share from s group by all""",
    "concordance": f"""with {LEDGER}, h as (select distinct doc_id from occ where ngram in (select ngram from phrases where peak_units >= 3))
      select bioguide, party, count(*) as statements, count(h.doc_id) as on_script, round(count(h.doc_id) / count(*), 6) as overlap from stm left join h using (doc_id) where joint_group is null and lane = 1 and party in ('D', 'R') group by 1, 2 having count(*) >= 10""",
    "unison": f"""with {OCC}, solo as (select * from stm where joint_group is null and lane = 1 and day <= date '{FOCUS}' and day > date '{FOCUS}' - 7), act as (select party, day, count(distinct bioguide) as active from solo group by all having count(distinct bioguide) >= 5),
      us as (select ngram, party, day, count(distinct bioguide) as offices from occ_all where doc_id in (select doc_id from solo) group by all having count(distinct bioguide) >= 3),
      r as (select *, round(offices / active, 6) as share from us join act using (party, day)), o as (select * from (select *, row_number() over (partition by ngram order by share desc, offices desc, day, party) as rn from r) where rn = 1)
      select ngram, party, day, offices, active, share, {CONTENT.format(g='ngram')}::int as content from o order by share desc, offices desc, content desc, ngram limit 5""",
    "silence_board": f"""with {STM}, tax as (select * from (values ('idiot', 'insult'), ('license', 'license'), ('anon', 'person'), ('pathetic', 'insult'), ('rights', 'license'), ('zzzz', 'nothing')) t(seed, topic)),
      c as (select topic, party, count(distinct doc_id) as n from stm join tax on contains(lower(text), seed) group by all),
      nw as (select * from (values ('insult', 0.005), ('license', null), ('person', 0.2), ('nothing', 0.4)) t(topic, volume)),
      w as (select topic, volume, coalesce(sum(n) filter (party = 'D'), 0)::bigint as d, coalesce(sum(n) filter (party = 'R'), 0)::bigint as r from nw left join c using (topic) group by 1, 2), t as (select sum(d) as td, sum(r) as tr from w)
      select topic, d, r, case when volume is null then 'excluded' when td < 25 or tr < 25 then 'unscored' when volume >= 0.05 and d <= 2 and r <= 2 then 'silent' when volume <= 0.01 and (d >= 5 or r >= 5) then 'void' else 'covered' end as verdict from w, t""",
    "symmetry_report": f"with {STM} select day, count(distinct case when party = 'D' then bioguide end) as \"D_offices\", count(*) filter (party = 'D') as \"D_statements\", count(distinct case when party = 'R' then bioguide end) as \"R_offices\", count(*) filter (party = 'R') as \"R_statements\" from stm group by 1",
    "classify_phrase": f"""with {LEDGER}, fam as (select ngram, count(distinct coalesce(joint_group, id)) as families from occ group by 1)
      select ngram, case when {SCAFFOLD.format(g='ngram')} is not null then 'scaffold' when regexp_matches(ngram, {_q(TEMPLATE)}) then 'procedural' when {LOW} then 'unknown' when families < 3 then 'unknown' else 'message' end as class from phrases join fam using (ngram)""",
    "scaffold_reasons": f"with {LEDGER} select ngram, coalesce({SCAFFOLD.format(g='ngram')}, '') as reason, {WEAK} as weak from phrases",
    "shingle_jaccard_pairs": f"""with t as (select doc_id, date '2024-01-01' + cast((doc_id // 20) % 30 as int) as day, regexp_extract_all(lower(text), {_q(TOKEN)}) as toks from documents), u as (select * from t where len(toks) >= 24),
      s as (select doc_id, day, unnest(list_distinct(list_transform(range(len(toks) - 4), lambda i: array_to_string(toks[i + 1 : i + 5], ' ')))) as sh from u), n as (select doc_id, count(*) as n from s group by 1),
      j as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id and abs(a.day - b.day) <= 1 group by all)
      select a, b, round(c / (x.n + y.n - c), 6) as jaccard from j join n x on x.doc_id = a join n y on y.doc_id = b where c / (x.n + y.n - c) >= 0.72""",
    "fragment_components": f"""with {STM}, {SENT}, {grams(4, 5)}, f as (select doc_id, party, day, ngram as gram from grams join stm using (doc_id)), l as (select party, day, gram, min(doc_id) as a from f group by all having count(*) > 1),
      e as (select distinct a, doc_id as b from f join l using (party, day, gram) where doc_id <> a), bidi as (select a, b from e union select b, a from e),
      reach as (with recursive r as (select a as id, a as c from bidi union select r.id, bidi.b as c from r join bidi on bidi.a = r.c) select id, min(c) as component from r group by 1)
      select id, component from reach""",
    "spearman_rho": """with r as (select l_returnflag as g, rank() over (partition by l_returnflag order by l_quantity) + (count(*) over (partition by l_returnflag, l_quantity) - 1) / 2 as x, rank() over (partition by l_returnflag order by l_extendedprice) + (count(*) over (partition by l_returnflag, l_extendedprice) - 1) / 2 as y from lineitem)
      select g as l_returnflag, count(*) as n, round(corr(x, y), 6) as rho from r group by 1""",
    "mann_whitney": """with v as (select c_nationkey % 2 = 0 as g, round(c_acctbal) as v from customer), r as (select g, rank() over (order by v) + (count(*) over (partition by v) - 1) / 2 as r from v), t as (select sum(c ** 3 - c) as ties from (select count(*) as c from v group by v)),
      a as (select count(*) filter (g) as n1, count(*) filter (not g) as n2, sum(r) filter (g) as r1 from r)
      select n1::double as n1, n2::double as n2, r1 - n1 * (n1 + 1) / 2 as u, round(2 * (r1 - n1 * (n1 + 1) / 2) / (n1 * n2) - 1, 6) as r, round((r1 - n1 * (n1 + 1) / 2 - n1 * n2 / 2) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))), 6) as z from a, t""",
    "gini_top_decile": """with s as (select o_custkey, round(sum(o_totalprice), 2) as v from orders group by 1), r as (select v, row_number() over (order by v) as i, count(*) over () as n from s)
      select round(2 * sum(i * v) / (max(n) * sum(v)) - (max(n) + 1) / max(n), 4) as gini, round(sum(v) filter (i > n - ceil(n / 10)) / sum(v), 4) as top_decile from r""",
    "quintile_slices": "with r as (select c_custkey, row_number() over (order by c_acctbal, c_custkey) - 1 as i, count(*) over () as n from customer) select ((5 * (i + 1) - 1) // n)::int as slice, count(*) as n from r group by 1",
    "split_half_trend": """with d as (select cast(ts as date) as day, count(*) as v from events group by 1), s as (select case when day < date '2024-01-16' then 'A' else 'B' end as half, (day - date '2024-01-01')::double as x, v::double as v from d),
      r as (select half, rank() over (partition by half order by x) as x, rank() over (partition by half order by v) + (count(*) over (partition by half, v) - 1) / 2 as y from s), c as (select half, count(*) as n, corr(x, y) as rho from r group by 1),
      e as (select half, case when n < 3 then null when rho > 0.1 then 1 when rho < -0.1 then -1 else 0 end as dir from c)
      select max(dir) filter (half = 'A')::int as a, max(dir) filter (half = 'B')::int as b, coalesce(max(dir) filter (half = 'A'), 9) = 1 and coalesce(max(dir) filter (half = 'B'), 9) = 1 as confirmed from e""",
    "weekday_excess": """with o as (select isodow(cast(ts as date)) - 1 as wd, count(*) as n from events where event_type = 'purchase' group by 1), b as (select isodow(cast(ts as date)) - 1 as wd, count(*) as n from events group by 1)
      select wd::int as wd, round(coalesce(o.n / (select sum(n) from o), 0) / (b.n / (select sum(n) from b)), 6) as excess from b left join o using (wd)""",
    "event_window_rates": """with a as (select * from (values (date '1996-11-05'), (date '1998-11-03'), (date '2000-11-07')) t(anchor)), d as (select cast(o_orderdate as date) as day, count(*) as n from orders group by 1)
      select anchor, coalesce(sum(n) filter (day < anchor), 0)::bigint as before, coalesce(sum(n) filter (day > anchor), 0)::bigint as after from a join d on day <> anchor and abs(day - anchor) <= 90 group by 1""",
    "before_after_did": """with r as (select o_custkey % 2 = 0 as t, o_orderdate >= timestamp '1998-01-01' as p, o_totalprice as v from orders)
      select round((avg(v) filter (t and p) - avg(v) filter (t and not p)) - (avg(v) filter (not t and p) - avg(v) filter (not t and not p)), 4) as did from r""",
    "same_state_pairs": "select n_regionkey::int as region, sum(n * (n - 1) / 2)::bigint as pairs from (select n_regionkey, n_nationkey, count(*) as n from customer join nation on c_nationkey = n_nationkey group by all) group by 1",
    "range_join_conversion": """with c as (select o_custkey as office, o_orderkey as key, cast(o_orderdate as date) as day, [o_orderpriority, o_orderstatus] as tokens from orders where o_orderkey % 2 = 0), a as (select o_custkey as office, cast(o_orderdate as date) as act_day, [o_orderpriority, o_orderstatus] as act from orders where o_orderkey % 2 = 1),
      j as (select c.office, key, day, bool_or(coalesce(act_day > day and act_day <= day + 180 and len(list_intersect(tokens, act)) >= 2, false)) as converted from c left join a using (office) group by all)
      select * from j where day + 180 <= (select max(act_day) from a)""",
    "pairwise_jaccard_weekly": """with s as (select distinct date_trunc('week', ts)::date as week, user_id % 2 as party, user_id, event_type from events), z as (select week, party, user_id, count(*) as n from s group by all),
      p as (select week, party, (count(*) * (count(*) - 1) / 2)::bigint as pairs from z group by all having count(*) > 1),
      j as (select a.week, a.party, a.user_id as u, b.user_id as v, count(*) as c from s a join s b on a.week = b.week and a.party = b.party and a.event_type = b.event_type and a.user_id < b.user_id group by all),
      q as (select j.week, j.party, sum(c / (x.n + y.n - c)) as s from j join z x on x.week = j.week and x.party = j.party and x.user_id = u join z y on y.week = j.week and y.party = j.party and y.user_id = v group by all)
      select week, party, pairs, round(coalesce(s, 0) / pairs, 6) as mean_jaccard from p left join q using (week, party)""",
    "strat_sample_hash": "select doc_id, lang, rank::int as rank from (select doc_id, lang, row_number() over (partition by lang order by sha256('seed' || chr(10) || doc_id), doc_id) as rank from documents) where rank <= 20",
    "date_split": f"with {STM} select case when day <= date '2024-01-15' then 'train' when day <= date '2024-01-22' then 'validation' else 'test' end as split, count(*) as n from stm group by 1",
    "kappa_alpha": """with p as (select quality as a, toxic as b from labels), n as (select count(*) as n, count(*) filter (a = b) as same from p), m as (select l, sum(ca) as ca, sum(cb) as cb from (select a as l, 1 as ca, 0 as cb from p union all select b, 0, 1 from p) group by 1),
      x as (select sum(ca * cb) as prod, sum((ca + cb) ** 2) as sq from m)
      select n, round(same / n, 6) as observed, round((same / n - prod / (n * n)) / (1 - prod / (n * n)), 6) as kappa, round(1 - (1 - same / n) / ((4 * n * n - sq) / (2 * n * (2 * n - 1))), 6) as alpha from n, x""",
    "confusion_precision": """with c as (select quality as gold, 1 - toxic as predicted, count(*) as n from labels group by all), t as (select *, sum(n) over (partition by predicted) as tot, sum(case when gold = predicted then n else 0 end) over (partition by predicted) as hit from c), w as (select *, hit / tot as p from t)
      select gold, predicted, n, round(p, 6) as precision, round(greatest(0, (p + 1.96 ** 2 / (2 * tot)) / (1 + 1.96 ** 2 / tot) - 1.96 * sqrt(p * (1 - p) / tot + 1.96 ** 2 / (4 * tot * tot)) / (1 + 1.96 ** 2 / tot)), 6) as low,
        round(least(1, (p + 1.96 ** 2 / (2 * tot)) / (1 + 1.96 ** 2 / tot) + 1.96 * sqrt(p * (1 - p) / tot + 1.96 ** 2 / (4 * tot * tot)) / (1 + 1.96 ** 2 / tot)), 6) as high from w""",
    "newcombe_gap": """with a as (select count(*) filter (doc_id % 2 = 0 and quality <> toxic) as k1, count(*) filter (doc_id % 2 = 0) as n1, count(*) filter (doc_id % 2 = 1 and quality <> toxic) as k2, count(*) filter (doc_id % 2 = 1) as n2 from labels), p as (select *, k1 / n1 as p1, k2 / n2 as p2 from a),
      w as (select *, (p1 + 3.8416 / (2 * n1)) / (1 + 3.8416 / n1) as m1, 1.96 * sqrt(p1 * (1 - p1) / n1 + 3.8416 / (4 * n1 * n1)) / (1 + 3.8416 / n1) as h1, (p2 + 3.8416 / (2 * n2)) / (1 + 3.8416 / n2) as m2, 1.96 * sqrt(p2 * (1 - p2) / n2 + 3.8416 / (4 * n2 * n2)) / (1 + 3.8416 / n2) as h2 from p)
      select round(p1, 6) as error_d, round(p2, 6) as error_r, round(p1 - p2 - sqrt((p1 - greatest(0, m1 - h1)) ** 2 + (least(1, m2 + h2) - p2) ** 2), 6) as gap_low, round(p1 - p2 + sqrt((least(1, m1 + h1) - p1) ** 2 + (p2 - greatest(0, m2 - h2)) ** 2), 6) as gap_high from w""",
    "family_pairs": """with r as (select cast(doc_id // 100 as int) as day, 'D' as party, quality as g, toxic as p from labels), b as (select sum(n * (n - 1) / 2) as x from (select count(*) as n from r group by day, party, g, p)), g as (select sum(n * (n - 1) / 2) as y from (select count(*) as n from r group by day, party, g)), p as (select sum(n * (n - 1) / 2) as z from (select count(*) as n from r group by day, party, p))
      select x::bigint as "both", y::bigint as gold, z::bigint as predicted, round(x / z, 6) as precision, round(x / y, 6) as recall from b, g, p""",
    "readiness_same_weekday": """with c as (select cast(o_orderdate as date) as day, count(*) as n from orders group by 1),
      h as (select c.day, c.n, count(p.n) as observations, median(p.n) as lg, count(case when c.day - p.day <= 21 then p.n end) as k, median(case when c.day - p.day <= 21 then p.n end) as sh from c left join c p on c.day - p.day > 0 and c.day - p.day <= 42 and (c.day - p.day) % 7 = 0 group by 1, 2),
      e as (select day, n, observations, case when k = 3 and sh < lg then sh else lg end as expected from h)
      select *, coalesce(expected >= 20 and observations >= 2, false) as judgeable, case when not coalesce(expected >= 20 and observations >= 2, false) then true else n / nullif(expected, 0) >= 0.4 end as ready from e""",
    "streak_runs": "with d as (select distinct user_id, cast(ts as date) as day from events), i as (select *, day - cast(row_number() over (partition by user_id order by day) as int) as isl from d) select user_id, min(day) as start, max(day) as stop, count(*) as length from i group by user_id, isl",
    "windowed_drop": """with d as (select event_type, cast(ts as date) as day, count(*) filter (value < 20) as dropped, count(*) as offered from events group by all),
      w as (select *, sum(dropped) over x as ps, sum(offered) over x as ws from d window x as (partition by event_type order by day range between interval 6 days preceding and current row))
      select event_type, day, ps::bigint as part_sum, ws::bigint as whole_sum, round(ps / ws, 6) as share, case when ws < 30 then 'unknown' when round(ps / ws, 6) >= 0.25 then 'red' else 'green' end as verdict from w""",
    "spend_projection": """with d as (select cast(ts as date) as day, round(sum(value), 2) as usd from events where event_type = 'purchase' group by 1), m as (select day, sum(usd) over w as mtd, count(*) over w as seen from d window w as (partition by date_trunc('month', day) order by day rows unbounded preceding))
      select day, round(mtd, 2) as month_to_date, round(mtd + mtd / seen * (last_day(day) - day), 0) as projection from m""",
    "status_worst": "select source, case max(case when avg_len is null then 1 when avg_len > 8000 then 5 when avg_len > 4000 then 4 else 3 end) when 1 then 'unknown' when 5 then 'red' when 4 then 'amber' else 'green' end as status from (select source, lang, avg(n_chars) as avg_len from documents group by all) group by 1",
    "coverage_gate": """with u as (select lang as source, case when cast(substr(source, 4) as int) % 2 = 0 then 'D' else 'R' end as party, source as member_id from documents),
      a as (select source, count(distinct case when party = 'D' then member_id end) as d, count(distinct case when party = 'R' then member_id end) as r from u group by 1)
      select source, d, r, 1.0::double as attributed, true as provenance, least(d, r) >= 5 and least(d, r) * 3 >= greatest(d, r) as passed from a""",
    "grouping_sets_cells": "select coalesce(event_type, 'all') as event_type, coalesce(half, 'both') as half, count(*) as n, round(avg(value), 6) as mean from (select event_type, case when ts < timestamp '2024-01-16' then 'A' else 'B' end as half, value from events) group by grouping sets ((event_type, half), (event_type), ())",
    "contains_join_citations": f"""with {STM}, t as (select * from (values ('licensed under'), ('all rights reserved'), ('idiot')) t(phrase))
      select phrase, doc_id, day, rank::int as rank from (select phrase, doc_id, day, row_number() over (partition by phrase order by day, doc_id) as rank from stm join t on contains(lower(text), phrase)) where rank <= 6""",
    "evidence_append_dedupe": "select source, lang, min(doc_id) as doc_id from (select source, lang, doc_id from documents where doc_id % 2 = 0 union all select source, lang, doc_id + 1000000 from documents) group by 1, 2",
    "stream_daily_counts": "select cast(ts as date) as day, event_type as phrase, count(distinct user_id) as units from events group by all",
    "stream_session_bursts": """with o as (select cast(user_id as varchar) as unit, ts, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 6 hours then 0 else 1 end as new from events), s as (select *, sum(new) over (partition by unit order by ts rows unbounded preceding) as k from o)
      select unit, min(ts) as start, max(ts) + interval 6 hours as stop, count(*) as n from s group by unit, k""",
    "redact_spans": r"""select doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(text, '\b[\w.+-]+@[\w-]+\.[\w.-]+\b', '[email]', 'g'), '\b\d{1,3}(?:\.\d{1,3}){3}\b', '[ip]', 'g'), '(?:\+\d{1,2}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}', '[phone]', 'g')) as sha from documents""",
    "html_strip_lengths": r"""with b as (select page_id, replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') as b from pages), l as (select page_id, list_filter(list_transform(string_split(b, chr(10)), lambda s: trim(s)), lambda s: s <> '' and not regexp_matches(s, '^\[.*\]$') and not regexp_matches(s, '^_+$')) as l from b)
      select page_id, length(array_to_string(l, chr(10)))::int as n from l""",
    "envelope_hashes": "select 'nation' as resource, n_nationkey::int as n_nationkey, sha256('{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || '}') as sha256 from nation",
    "quotes_numbers": r"""select doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\d+(?:[.,]\d+)*'))), '|') as numbers, len(regexp_extract_all(text, '\d+(?:[.,]\d+)*'))::int as n from documents where regexp_matches(text, '\d')""",
    "vector_topk": """with q as (select vec_id as query_id, embedding as e from embeddings where vec_id % 50 = 0), s as (select query_id, vec_id, round(list_cosine_similarity(q.e::double[], x.embedding::double[]), 6) as cosine from q join embeddings x on x.vec_id <> query_id)
      select query_id, vec_id, cosine, rank::int as rank from (select *, row_number() over (partition by query_id order by cosine desc, vec_id) as rank from s) where rank <= 5""",
}

_INDEX = """mo as (select o_custkey as ngram, cast(date_trunc('month', o_orderdate) as date) as day, count(*) as units from orders group by all),
  idx as (select ngram, max(units) as peak, min(day) filter (units = top) as peak_day, min(day) as first_day, max(day) as last_day from (select *, max(units) over (partition by ngram) as top from mo) group by ngram)"""
ORACLE_SQL |= {
    "phrase_index": f"with {_INDEX} select * from idx",
    "ignition_widths": f"with {_INDEX} select cast(year(first_day) as int) as year, count(*) as n, median(least(peak_day - first_day, 900)) as width from idx where peak >= 2 and peak_day >= first_day group by 1 having count(*) >= 2",
    "lifespans": f"with {_INDEX} select cast(year(first_day) as int) as year, count(*) as n, median(last_day - first_day) as lifespan from idx where peak >= 2 group by 1 having count(*) >= 2",
    "sync_ceiling": f"""with {_INDEX}, act as (select year(o_orderdate) as y, count(distinct o_custkey) as active from orders group by 1)
      select cast(y as int) as year, max(peak) as peak, round(max(peak) / max(active), 6) as ceiling from idx join act on y = year(peak_day) group by 1""",
    "month_effect": f"""with {_INDEX}, f as (select count(*) filter (month(first_day) = 8) as i, count(*) filter (month(first_day) <> 8) as o from idx where peak >= 2),
      b as (select sum(units) filter (month(day) = 8) as ni, sum(units) filter (month(day) <> 8) as no from mo)
      select round(1000.0 * i / ni, 6) as inside, round(1000.0 * o / no, 6) as outside, round((1000.0 * i / ni) / (1000.0 * o / no), 6) as ratio from f, b""",
    "ingroup_share": f"with {STM} select party, count(*) as n, count(joint_group) as joint, round(count(joint_group) / count(*), 6) as share from stm where party in ('D', 'R') group by 1",
    "anchor_snap": """with a as (select unnest([date '1996-11-05', date '1998-11-03', date '2000-11-07']) as anchor),
      o as (select case when o_orderpriority like '1%' then 'D' else 'R' end as party, anchor - cast(o_orderdate as date) as lead, o_orderstatus = 'F' as hit, anchor from orders, a where anchor - cast(o_orderdate as date) between 1 and 270),
      r as (select anchor, party, count(*) filter (hit and lead <= 90) / nullif(count(*) filter (lead <= 90), 0) as pre, count(*) filter (hit and lead > 90) / nullif(count(*) filter (lead > 90), 0) as prior from o group by all)
      select anchor, party, round(pre, 6) as pre, round(prior, 6) as prior, coalesce(pre > prior, false) as snap from r""",
    "gravity_half_life": """with d as (select cast(o_orderdate as date) as day, year(o_orderdate) as y, count(*) as n from orders group by all),
      p as (select y, n as peak, day as peak_day from d qualify row_number() over (partition by y order by n desc, day) = 1),
      k as (select p.*, i from p, (select unnest(range(1, 22)) as i)),
      low as (select k.y, min(i) as i from k left join d on d.y = k.y and d.day = k.peak_day + cast(k.i as int) where coalesce(d.n, 0) < k.peak / 2 group by 1)
      select cast(p.y as int) as year, peak, peak_day, cast(coalesce(i, 21) as int) as half_life from p left join low using (y)""",
    "top_by_velocity": f"with {RANKED} select * from ranked order by velocity desc, peak desc, ngram limit 50",
    "monthly_counts": "select strftime(o_orderdate, '%Y-%m') as month, count(*) as n from orders group by 1",
    "statement_meta": """with y as (select year(o_orderdate) as y, count(distinct o_custkey) as offices from orders group by 1)
      select cast(y as int) as year, cast(isodow(o_orderdate) - 1 as int) as wd, count(*) as n, max(offices) as offices from orders join y on y = year(o_orderdate) group by 1, 2""",
    "phrase_persistence": f"with {_INDEX} select ngram, count(*) as active_days, cast(max(day) - min(day) as int) as span from mo where day >= date '1996-01-01' and day < date '1998-01-01' group by 1",
    "style_rates": f"""with {STM}, m as (select day, len(regexp_extract_all(text, ';')) as s, len(regexp_extract_all(text, '!')) as e, len(regexp_extract_all(text, '[.!?]+(\\s|$)')) as t from stm)
      select day, case when sum(t) > 0 then round(1000.0 * sum(s) / sum(t), 6) end as semicolons, round(sum(e) / count(*), 6) as exclamations from m group by 1""",
    "first_capitals": f"with {STM} select day, doc_id, bioguide, party from stm where regexp_matches(text, '\\b[A-Z]{{4,}}\\b') order by day, doc_id limit 1",
}

CONTESTS = """cr as (
  select year(o_orderdate)::int as cycle, c_nationkey as state, (c_custkey % 3)::int as district, o_orderkey % 7 = 0 as special,
    case when o_orderstatus = 'P' then 'GEN RUNOFF' when o_orderstatus = 'F' then 'gen' when o_orderkey % 2 = 0 then '' else 'primary' end as stage,
    'A. ' || c_mktsegment as candidate, o_orderpriority[1:1] as party, floor(o_totalprice)::bigint as votes from orders join customer on o_custkey = c_custkey
), cs as (select *, contains(lower(stage), 'runoff') as runoff from cr where lower(stage) like '%gen%' or lower(stage) like '%runoff%' or stage = ''),
cu as (select * from cs qualify runoff = max(runoff) over (partition by cycle, state, district, special)),
cl as (select cycle, state, district, special, upper(candidate) as candidate, party, sum(votes)::bigint as votes from cu group by all),
cc as (select cycle, state, district, special, candidate, sum(votes)::bigint as votes, first(party order by votes desc, party) as party from cl group by all),
ck as (select *, row_number() over (partition by cycle, state, district, special order by votes desc, candidate) as r from cc),
contests as (
  select cycle, state, district, special, max(candidate) filter (r = 1) as winner, max(party) filter (r = 1) as party, max(votes) filter (r = 1) as winner_votes,
    coalesce(max(votes) filter (r = 2), 0)::bigint as runnerup_votes, sum(votes)::bigint as total_votes,
    round((max(votes) filter (r = 1) - coalesce(max(votes) filter (r = 2), 0)) / sum(votes), 6) as mov from ck group by all having sum(votes) > 0
), tm as (
  select 'P' || (p_partkey % 97) as bioguide, (p_partkey % 25)::int as state, ((p_partkey // 25) % 3)::int as district, ((p_partkey // 11) % 5 + 1)::varchar as party,
    make_date(((p_partkey // 75) % 8 + 1995)::int, 1, 3) + (p_partkey % 4)::int as start, ['BUILDING', 'MACHINERY', 'AUTOMOBILE', 'HOUSEHOLD', 'FURNITURE'][(p_partkey % 5 + 1)::int] as name from part
), pl as (
  select c.*, t.bioguide, t.start, t.party = c.party as pe, t.name = split_part(c.winner, ' ', 2) as named, abs(t.start - make_date(c.cycle + 1, 1, 3)) as days
  from contests c join tm t on t.state = c.state and t.district = c.district and (year(t.start) = c.cycle + 1 or (c.special and year(t.start) = c.cycle))
), p1 as (select *, count(*) over w as pool, count(*) filter (named) over w as n_named from pl window w as (partition by cycle, state, district, special)),
p2 as (select *, (n_named = 0 or named) as base, count(*) filter ((n_named = 0 or named) and pe) over (partition by cycle, state, district, special) as n_pe from p1),
p3 as (select *, base and (n_pe = 0 or pe) as narrow from p2),
p4 as (select *, count(*) filter (narrow) over w as n_narrow, min(days) filter (narrow) over w as best from p3 window w as (partition by cycle, state, district, special)),
p5 as (
  select cycle, state, district, special, any_value(pool) as pool, any_value(n_named) as n_named, any_value(n_pe) as n_pe, any_value(n_narrow) as n_narrow, count(distinct bioguide) filter (narrow and days = best) as offices,
    min(bioguide) as only_one, min(bioguide) filter (named) as by_name, min(bioguide) filter (narrow) as by_narrow, min(bioguide) filter (narrow and days = best) as by_date from p4 group by all
), linked as (
  select c.*, case when pool = 1 then only_one when n_named = 1 then by_name when n_narrow = 1 then by_narrow when offices = 1 then by_date end as bioguide,
    case when pool = 1 then 'exact' when n_named = 1 then 'name' when n_narrow = 1 then case when n_named > 0 then 'name+party' when n_pe > 0 then 'exact' else 'relaxed' end
      when offices = 1 then case when n_named > 0 then 'name+date' when n_pe > 0 then 'date' else 'relaxed+date' end end as matched_via,
    case when pool is null then 'no_term' when not (pool = 1 or n_named = 1 or n_narrow = 1 or offices = 1) then 'ambiguous' end as reason
  from contests c left join p5 using (cycle, state, district, special)
)"""
ORACLE_SQL |= {
    "contest_margins": f"with {CONTESTS} select * from contests",
    "contest_terms": f"with {CONTESTS} select cycle, state, district, special, winner, bioguide, matched_via, reason from linked",
    "contest_coverage": f"with {CONTESTS} select cycle, special, count(bioguide) as matched, count(*) - count(bioguide) as unmatched, count(*) filter (matched_via in ('relaxed', 'relaxed+date')) as relaxed, round(100 * count(bioguide) / count(*), 1) as match_pct from linked group by all",
    "era_top_phrases": f"""with {LEDGER}, eo as (select case when day < date '2024-01-16' then 'early' else 'late' end as era, * from occ where ngram in (select ngram from phrases)),
      ec as (select era, party, ngram, day, count(distinct unit) as peak, list(distinct unit) as members from eo group by all having count(distinct unit) >= 3),
      eb as (select * from ec qualify row_number() over (partition by era, party, ngram order by peak desc, day) = 1),
      left_over as (select * from eb a where not exists (select 1 from eb b where b.era = a.era and b.party = a.party and b.ngram <> a.ngram and contains(' ' || b.ngram || ' ', ' ' || a.ngram || ' ') and len(list_filter(a.members, lambda m: not list_contains(b.members, m))) = 0))
      select era, party, rank::int as rank, ngram, peak, day as peak_day, len(members)::bigint as members from (select *, row_number() over (partition by era, party order by peak desc, ngram desc) as rank from left_over) where rank <= 8""",
    "member_index": f"with {LEDGER} select bioguide, count(distinct ngram) as phrases, count(distinct day) as days, min(day) as first_day, max(day) as last_day from occ where ngram in (select ngram from phrases) and bioguide is not null group by 1",
}

_STEPS = ("detected", "acknowledged", "contained", "corrected", "closed")
_KINDS = ("view", "click", "signup", "purchase", "error")
_REACHED = ["detected_at is not null"]
for _a, _b in zip(_STEPS, _STEPS[1:]):
    _REACHED.append(f"{_REACHED[-1]} and {_b}_at >= {_a}_at")
_DUE = "detected_at + to_hours({hours}) < now and ({step}_at is null or {step}_at > detected_at + to_hours({hours}))"
LIFECYCLE = f"""with e as (
  select 'corr-' || user_id || '-' || (event_id % 5) as correction_id, ts, ['critical', 'major', 'minor'][(user_id % 3 + 1)::int] as severity,
    [{', '.join(map(_q, _STEPS))}][list_position([{', '.join(map(_q, _KINDS))}], event_type)] as step from events
), c as (
  select correction_id, min(severity) as severity, {', '.join(f"min(ts) filter (step = {_q(s)}) as {s}_at" for s in _STEPS)}, (select max(ts) - interval 1 hour from events) as now from e group by 1
), h as (select *, case severity when 'critical' then 1 when 'major' then 24 else 72 end as ack, case severity when 'critical' then 24 when 'major' then 72 else 336 end as cor from c)
select correction_id, severity, {', '.join(f'{s}_at' for s in _STEPS)}, case {' '.join(f"when {r} then {_q(s)}" for s, r in reversed(list(zip(_STEPS, _REACHED))))} else 'none' end as state,
  coalesce({_DUE.format(hours='ack', step='acknowledged')}, false) as late_acknowledge, coalesce({_DUE.format(hours='cor', step='corrected')}, false) as late_correct from h"""
ORACLE_SQL |= {"correction_lifecycle": LIFECYCLE, "correction_table": LIFECYCLE}

_TOKS = f"""lows as (select doc_id, lower(text) as body, 0 as start from documents where text is not null),
{_placed("lows", "doc_id", "body", TOKEN, "words")},
wl as (select doc_id, list(tok order by k) as toks, list(s order by k) as ss, list(e order by k) as es from words group by 1),
hits as (select *, unnest(list_filter(range(1, len(toks)), lambda i: toks[i] = 'licensed' and toks[i + 1] = 'under')) as i from wl),
occs as (select doc_id, ss[i]::int as start, es[i + 1]::int as end_, toks[greatest(1, i - 5):i - 1] as l, toks[i + 2:i + 6] as r from hits)"""
_PREFIX = "substr(text, 1, start)"
_REDACTED = ORACLE_SQL["redact_spans"].split("sha256(", 1)[1].rsplit(") as sha", 1)[0]
_KEYED = _REDACTED.replace("(text,", "('k ' || text,", 1)
ORACLE_SQL |= {
    "phrase_occurrences": f"""with {_TOKS} select doc_id, start, end_ as "end", array_to_string(l, ' ') as before, array_to_string(r, ' ') as after,
      (length({_PREFIX}) - length(replace(replace(replace({_PREFIX}, '"', ''), '“', ''), '”', ''))) % 2 = 1 as quoted, list_has_any(l[-3:], ['not', 'never', 'no']) as negated from occs join documents using (doc_id)""",
    "sql_occurrences": f"""with {_TOKS} select doc_id, start, end_ as "end", array_to_string(l, ' ') as before, array_to_string(r, ' ') as after from occs""",
    "sql_low_content": f"""with {SENT}, g as (select distinct doc_id, array_to_string(toks[i + 1 : i + 3], ' ') as ngram from (select doc_id, toks, unnest(range(len(toks) - 2)) as i from sent where len(toks) >= 3)),
      c as (select doc_id, {CONTENT.format(g='ngram')} as n from g where not regexp_matches(ngram, {_q(TEMPLATE)})) select doc_id, count(*) as grams, count(*) filter (n < 2) as low, sum(n)::bigint as content from c group by 1""",
    "redacted_records": f"""select doc_id, {_REDACTED} <> text as changed, sha256({_REDACTED} || '|' || {_REDACTED} || '|' || source || '|' || {_KEYED}) as sha from documents where text is not null""",
    "density_matched": "select doc_id, lang from (select doc_id, lang, row_number() over (partition by lang order by sha256('seed|' || doc_id)) as r from documents) where r <= (select min(n) from (select count(*) as n from documents group by lang))",
    "gold_seal": "with h as (select sha256('seed' || chr(10) || doc_id || chr(10) || coalesce(lang, '') || chr(10) || coalesce(source, '')) as h from documents) select count(*) as rows, sha256(count(*) || ':' || "
    + " || ':' || ".join(f"sum(('0x' || h[{1 + 8 * i}:{8 + 8 * i}])::bigint)" for i in range(8))
    + ") as seal from h",
}
_RANKS = " union all ".join(
    f"select {_q(name)} as ranking, day, phrase, party, rank::int as rank from (select *, row_number() over (partition by day order by {', '.join([*keys, 'phrase', 'party'])}) as rank from sg where {cond}) where rank <= 50"
    for name, (cond, keys) in RANKINGS.items()
)
ORACLE_SQL |= {"surge_rankings": f"with {SURGE}, sg as (select *, change >= {P.surge_change} and ratio >= {P.surge_ratio} and q <= {P.surge_q} as surge from bh) {_RANKS}"}
_HASHED = f"((({{x}}) * ({{x}}) + {{y}}) % {PRIME})"
_DRAWS = f"""with r as (select c_nationkey % 2 = 0 as cell, c_acctbal as v, c_custkey as key, d from customer, range(500) t(d)),
a as (select *, (key * 48271 + d * 69621 + 12345) % {PRIME} as x from r), b as (select *, {_HASHED.format(x='x', y='key')} as x2 from a), c as (select *, {_HASHED.format(x='x2', y='d')} as x3 from b),
w as (select *, {' + '.join(f'(x3 >= {int(c * PRIME)})::int' for c in POISSON)} as w from c),
g as (select d, sum(v * w) filter (cell) / sum(w) filter (cell) - sum(v * w) filter (not cell) / sum(w) filter (not cell) as gap from w group by d)
select round(quantile_cont(gap, 0.025), 6) as low, round(quantile_cont(gap, 0.975), 6) as high from g"""
ORACLE_SQL |= {"bootstrap_gap": _DRAWS}

_A_YEAR = "regexp_full_match(coalesce(toks[{i}], ''), '(19|20)[0-9]{{2}}')"
NAMES = f"""nm0 as (select regexp_extract_all(lower(regexp_split_to_array(text, '[.\n]')[1]), {_q(TOKEN)}) as t, cast(item_id as varchar) as cite from benchmark),
nm as (select array_to_string(t, ' ') as name, min(cite) as cite, len(t) as n, any_value(t) as t from nm0 where len(t) > 0 and cite is not null group by 1, 3),
dt as (select doc_id, regexp_extract_all(lower(text), {_q(TOKEN)}) as toks from documents where text is not null),
tk as (select doc_id, unnest(toks) as tok, generate_subscripts(toks, 1)::int as k from dt),
tw as (select *, lead(tok, 1) over w as t2, lead(tok, 2) over w as t3 from tk window w as (partition by doc_id order by k)),
nc as (select tw.doc_id, k, name, cite, nm.n::int as n from tw join nm on tok = t[1] and t2 = t[2] where nm.n > 1 union all select tw.doc_id, k, name, cite, 1 from tw join nm on tok = name where nm.n = 1),
nh as (select nc.doc_id, k - 1 as first, n, cite,
    case when toks[k + n] = 'of' and {_A_YEAR.format(i="k + n + 1")} then 2 when {_A_YEAR.format(i="k + n")} then 1 else 0 end as year
  from nc join dt on dt.doc_id = nc.doc_id and name = array_to_string(toks[k : k + n - 1], ' ')),
nl as (select doc_id, list({{'free': first + n + year, 'runs': [{{'first': first, 'last': first + n + year - 1, 'cite': cite}}]}} order by first, n desc) as xs from nh group by 1),
nr as (select doc_id, list_reduce(xs, lambda a, x: case when x.runs[1].first >= a.free then {{'free': x.free, 'runs': list_concat(a.runs, x.runs)}} else a end) as z from nl),
nruns as (select doc_id, r.first as first, r.last as last, r.cite as cite from (select doc_id, unnest(z.runs) as r from nr))"""
ORACLE_SQL |= {
    "name_runs": f"with {NAMES} select * from nruns",
    "name_verdicts": f"""with {SENT}, {grams(3, 3)}, {NAMES}, ng as (select distinct array_to_string(t[j + 1 : j + 3], ' ') as ngram from (select t, unnest(range(len(t) - 2)) as j from nm where len(t) >= 3)),
      wanted as (select doc_id, ngram from raw_grams where ngram in (select ngram from ng)),
      o as (select doc_id, k - 1 as i, k + 1 as b, concat_ws(' ', tok, t2, t3) as ngram,
        k - 1 + coalesce(list_position(list_transform([tok, t2, t3], lambda t: not list_contains({_list(STOPWORDS)}, t)), true), 1) - 1 as a from tw where t3 is not null and concat_ws(' ', tok, t2, t3) in (select ngram from ng)),
      j as (select o.doc_id, o.ngram, o.i, coalesce(bool_or((r.first <= a and r.last >= b) or (r.first < a and a <= r.last and r.last < b) or (a < r.first and r.first <= b and b < r.last)), false) as hit, min(r.cite) as cite
        from o join wanted using (doc_id, ngram) left join nruns r on r.doc_id = o.doc_id and r.first <= o.b and r.last >= o.i group by all),
      per as (select doc_id, ngram, bool_and(hit) as ok, min(cite) as cite from j group by all)
      select ngram, count(*) as docs, count(*) filter (ok) as name_docs, min(cite) filter (ok) as cite, round(count(*) filter (ok) / count(*), 6) as ratio, count(*) filter (ok) / count(*) >= {P.nomenclature_ratio} as tagged from per group by 1""",
}

CLAIMS = f"""{LEDGER}, mem as (select distinct o.ngram || '|' || strftime(o.day, '%Y-%m-%d') || '|' || o.party as claim_id, o.ngram as phrase, o.doc_id
  from occ_all o join daily using (ngram, day, party) where daily.units >= {P.quorum}),
lows as (select doc_id, lower(text) as body, 0 as start from documents where text is not null),
{_placed("lows", "doc_id", "body", TOKEN, "words")},
wl as (select doc_id, list(tok order by k) as toks, list(s order by k) as ss, list(e order by k) as es from words group by 1),
pw as (select doc_id, array_to_string(toks[i + 1 : i + n], ' ') as phrase, ss[i + 1] as s, es[i + n] as e
  from (select *, unnest(range(len(toks) - n + 1)) as i from wl cross join (select unnest(range({P.ngram_min}, {P.ngram_max + 1})) as n) where len(toks) >= n)),
co as (select m.claim_id, m.phrase, doc_id, t.id, bioguide, coalesce(joint_group, id) as family, coalesce(joint_group, bioguide) as unit_id, s, e, substr(text, s + 1, e - s) as surface
  from mem m join pw using (doc_id, phrase) join stm t using (doc_id)),
canon as (select claim_id, min(struct_pack(a := length(surface), b := lower(surface), c := id, d := s, x := surface, e := e)) as q, count(distinct bioguide) as offices, count(distinct doc_id) as publications,
  count(distinct family) as families, count(distinct unit_id) as support_units from co group by 1),
torn as (select claim_id, bool_or(not list_has_any(list_transform(string_split(regexp_replace({_CLEAN.replace("text", "surface")}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)),
  lambda x: contains(' ' || array_to_string(regexp_extract_all(lower(regexp_replace(x, {_q(DATELINE)}, '')), {_q(TOKEN)}), ' ') || ' ', ' ' || phrase || ' ')), [true])) as torn from co group by 1),
carry as (select claim_id, count(distinct coalesce(joint_group, bioguide)) as carrying from mem join raw_grams r on r.doc_id = mem.doc_id and r.ngram = phrase join stm on stm.doc_id = mem.doc_id group by 1)"""
_FAULT = "cast('0x' || md5(claim_id)[1:2] as int) % 8"
ORACLE_SQL |= {
    "canonical_claims": f"""with {CLAIMS} select claim_id, q.x as support_text, 'occ:' || sha256(claim_id || chr(10) || q.c || chr(10) || q.d || chr(10) || q.e)[1:24] as support_occurrence_id, offices, publications, families, support_units, coalesce(carrying, 0) as carrying
      from canon left join carry using (claim_id)""",
    "claim_checks": f"""with {CLAIMS}, sets as (select m.claim_id, count(distinct co.doc_id) <> count(distinct m.doc_id) as apart, min(m.doc_id) = any_value(f.low) as low_in from mem m left join co on co.claim_id = m.claim_id and co.doc_id = m.doc_id
        left join (select claim_id, min(doc_id) as low from co group by 1) f on f.claim_id = m.claim_id group by 1),
      k as (select claim_id, {_FAULT} as f, support_units, coalesce(carrying, 0) as carrying, apart, low_in, torn from canon left join carry using (claim_id) join sets using (claim_id) join torn using (claim_id))
      select claim_id, carrying, concat_ws(',', case when carrying < {P.quorum} then 'key_quorum' end, case when carrying <> support_units + (f = 5)::int then 'support_count' end, case when f = 7 then 'verbatim' end,
        case when f = 1 then 'invariant:identity' end, case when f = 2 then 'invariant:support_phrase' end, case when f = 3 or torn then 'invariant:occurrence_offsets' end,
        case when (f = 4 and (low_in or apart)) or (f <> 4 and apart) then 'invariant:support_set' end, case when f in (5, 6) then 'invariant:unit_counts' end, case when f in (2, 7) then 'invariant:render_binding' end) as reasons from k""",
}

ORACLE_SQL |= {
    "comparison_lanes": f"""with {STM}, r as (select bioguide, day, case when day < date '2024-01-16' then 'imported' else 'scraped' end as lane, split, case when split = 'time' then day <= date '2024-01-15' else day(day) % 2 = 0 end as half
        from stm0 cross join (values ('time'), ('parity')) v(split) where split = 'time' or day <= date '2024-01-15' or bioguide like '%1'),
      g as (select bioguide, split, count(*) filter (half) as a_n, count(*) filter (not half) as b_n, count(distinct lane) filter (half) as al, count(distinct lane) filter (not half) as bl, count(distinct lane) as l, min(day) as f, max(day) as t from r group by all)
      select bioguide, split, a_n, b_n, 0::bigint as untagged, f <= date '2024-01-15' and t > date '2024-01-15' as spans_seam,
        case when least(a_n, b_n) = 0 then 'empty' when al > 1 or bl > 1 then 'mixed' when l > 1 then 'two_instruments' when least(a_n, b_n) < 3 then 'underpowered' else 'ok' end as verdict from g""",
    "gold_universe": f"""with {RANKED}, shown as (select ngram from ranked {_RORD} limit 50),
      pk as (select ngram, party, arg_max(day, struct_pack(u := units, d := -(day - date '1970-01-01'))) as day, max(units) as units from daily where party in ('D', 'R') and units >= 2 and day >= date '2024-01-05' group by all),
      hc as (select ngram, day, party, count(distinct bioguide) as headcount from occ_all group by all),
      u as (select pk.ngram, pk.party, pk.day, pk.units, hc.headcount, case when regexp_matches(ngram, '\\bidiot\\b') then 'private' when {SCAFFOLD.format(g="ngram")} is not null then 'scaffold' when regexp_matches(ngram, {_q(TEMPLATE)}) then 'procedural'
        when {LOW} then 'unknown' when units < {P.quorum} then 'unknown' else 'message' end as predicted_class, ngram in (select ngram from shown) as pub from pk join hc using (ngram, day, party))
      select 'gold:' || sha256(ngram || chr(10) || party || chr(10) || strftime(day, '%Y-%m-%d'))[1:24] as candidate_id, ngram, party, day, year(day)::int as year, units, headcount, predicted_class,
        concat_ws(',', case when pub then 'public_surface' end, case when predicted_class = 'private' then 'private,rare_class' end, case when headcount > units then 'family_collapse' end, case when units in (2, 3) then 'boundary_quorum' end) as impact_tags,
        (pub::int * 8 + (predicted_class = 'private')::int * 10 + (headcount > units)::int * 3 + (units in (2, 3))::int * 2)::int as priority from u""",
    "annotation_issues": """with r as (select (doc_id - case when doc_id % 11 = 0 then doc_id % 22 else 0 end)::varchar as c, doc_id % 7 = 0 as noa, doc_id % 5 = 0 as second, toxic = 1 as bad, doc_id % 3 = 0 as nof from labels),
      i as (select c, 'no_annotator' as issue from r where noa union all select c, 'wrong_annotator' from r where not noa and second union all select c, 'class' from r where bad union all select c, 'no_family' from r where nof
        union all select c, 'duplicate' from r group by c having count(*) > 1) select issue, count(*) as n, count(distinct c) as candidates from i group by 1""",
}

_P_NODES = 20_000  # Simpson's rule
ORACLE_SQL |= {
    "spearman_p": f"""with r as (select o_orderpriority, rank() over (partition by o_orderpriority order by o_custkey) + (count(*) over (partition by o_orderpriority, o_custkey) - 1) / 2 as x,
        rank() over (partition by o_orderpriority order by o_totalprice) + (count(*) over (partition by o_orderpriority, o_totalprice) - 1) / 2 as y from orders),
      c as (select o_orderpriority, count(*) as n, corr(x, y) as rho from r group by 1),
      a as (select *, n - 2 as df, atan(abs(rho) * sqrt((n - 2) / (1 - rho * rho)) / sqrt(n - 2)) as low from c),
      b as (select *, (least(pi() / 2, low + 40 / sqrt(df)) - low) / {_P_NODES} as h from a),
      s as (select o_orderpriority, sum(case when i in (0, {_P_NODES}) then 1 when i % 2 = 1 then 4 else 2 end * greatest(0, cos(low + i * h)) ** (df - 1)) * any_value(h) / 3 as area from b cross join range({_P_NODES + 1}) t(i) group by 1)
      select o_orderpriority, n, round(rho, 6) as rho, round(least(1, 2 * area * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi())), 5) as p from b join s using (o_orderpriority)""",
}
