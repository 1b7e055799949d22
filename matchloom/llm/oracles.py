"""SQL with the rows of the queries that SQL can express."""

from __future__ import annotations

from .quality_rules import ALPHA, COST, DELTA, EVEN, SCORES, STEPS

_WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(table: str, key: str, n: int) -> str:
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""(select {key}, unnest(list_distinct(case when len(w) = 0 then [] when len(w) < {n} then [len(w) || ':' || array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - {n} + 2), lambda i: {run}) end)) as s from (select {key}, {_WORDS.format(text=_LOW)} as w from {table}) x)"""


OP2 = f"""
with recursive sh as materialized (select * from {_shingles("documents", "doc_id", 4)} y),
n as (select doc_id, count(*) as n from sh group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as materialized (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 80 * (x.n + y.n - shared)),
both_ways as materialized (select a, b from links union all select b, a from links),
reach as (select a, b from both_ways union select r.a, l.b from reach r join both_ways l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) as component_id, d.doc_id = least(d.doc_id, coalesce(r.low, d.doc_id)) as kept
from documents d left join n on n.doc_id = d.doc_id left join (select a, min(b) as low from reach group by a) r on r.a = d.doc_id"""

_DOUBLED = f"(length(bin({{x}} // {EVEN})) - 1)"
_STEP = f"case when {{x}} <= {EVEN} then {{x}} else {EVEN} + {_DOUBLED} * {EVEN // 2} + (({{x}} >> {_DOUBLED}) - {EVEN}) // 2 end"
_SCORES = [("symbols", "n_symbols", "n_words"), ("repeats", "n_repeat_words", "n_words"), ("dup_lines", "n_dup_lines", "n_words"), ("upper", "n_upper", "word_chars"), ("length", "word_chars", "n_words")]
_LEVEL = "(select {delta} / (greatest(1, count(distinct stratum)) * {m}) from holdout)"
_COUNTS = f"""
words as materialized (select doc_id, coalesce('=' || lang, '') as stratum, coalesce(text, '') as text, {_WORDS.format(text="coalesce(text, '')")} as w from documents),
windows as (select doc_id, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as t from words),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, t) as c from windows) x where c > 1),
repeats as (select doc_id, count(distinct i + k) as n_repeat_words from again, (values (0), (1), (2)) s(k) group by doc_id),
text_lines as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from words),
base as materialized (select words.doc_id, stratum, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
  cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
  coalesce(n_repeat_words, 0) as n_repeat_words, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as n_upper
  from words join text_lines on words.doc_id = text_lines.doc_id left join repeats on words.doc_id = repeats.doc_id),
scored as materialized (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  {", ".join(f"{_STEP.format(x=f'cast(floor({count} / greatest({of}, 1) * {STEPS}) as bigint)')} as {name}" for name, count, of in _SCORES)} from base)"""

OP7 = f"""
with {_COUNTS},
known as (select doc_id, min(quality) = 1 as good from labels where quality is not null group by doc_id),
holdout as materialized (select s.*, good from scored s join known k on s.doc_id = k.doc_id where not base_failed),
bins as (select stratum, score, cast(step as bigint) as step, count(*) filter (good) as good, count(*) filter (not good) as bad from (
  {" union all ".join(f"select stratum, good, '{s}' as score, {s} as step from holdout" for s in SCORES)}) x group by 1, 2, 3),
sums as (select stratum, score, step, sum(good) over w as good, sum(bad) over w as bad, sum(good) over (partition by stratum, score) as n, lead(step) over w as under
  from bins window w as (partition by stratum, score order by step desc)),
tests as (select *, list_sum(list_transform(range(0, cast(good as bigint) + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - (case when n = i then 0 else lgamma(n - i + 1) end)
  + i * ln({ALPHA / len(SCORES)}) + (n - i) * ln(1 - {ALPHA / len(SCORES)})))) as tail from sums where n > 0 and good < n),
ranked as (select *, row_number() over (partition by stratum, score order by bad - {COST} * good desc, step desc) as place from tests
  where tail <= {_LEVEL.format(delta=DELTA, m=len(SCORES))} and bad - {COST} * good > 0),
cuts as (select stratum, score, case when under is null then step - 1 else (step + under) // 2 end as cut from ranked where place = 1)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not exists (select 1 from cuts c where c.stratum = s.stratum and ({" or ".join(f"c.score = '{s}' and s.{s} > c.cut" for s in SCORES)})) as kept
from scored s"""

OP8 = f"""
with items as materialized (select * from {_shingles("benchmark", "item_id", 5)} y), sizes as (select item_id, count(*) as n_item from items group by item_id),
shared as (select d.doc_id, i.item_id, count(*) as n_shared from {_shingles("documents", "doc_id", 5)} d join items i on d.s = i.s group by 1, 2)
select doc_id, shared.item_id, n_shared, n_item from shared join sizes on shared.item_id = sizes.item_id where 100 * n_shared >= 80 * n_item"""

_LETTERS = "(values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16))"
_FIVE = [f"p{k}" for k in range(1, 6)]

OP12 = f"""
with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
words as (select doc_id, part, text, {_WORDS.format(text="text")} as w, min(doc_id) over (partition by text) as first from texts),
marks as materialized (select part, w.doc_id, case when len(w) < 100 then 1 else 0 end + case when 100 * len(list_distinct(w)) < 80 * len(w) then 2 else 0 end
  + case when 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) then 4 else 0 end
  + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end + case when first < w.doc_id then 16 else 0 end as failed,
  coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from words w left join (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id) l on w.doc_id = l.doc_id),
combos as materialized (select part, failed, count(*) as n, sum(good) as good, sum(toxic) as toxic from marks group by part, failed),
letters as (select * from {_LETTERS} t(f, bit)),
orders as (select {", ".join(f"{p}.f as f{p}, {p}.bit as b{p}" for p in _FIVE)} from {" join ".join(f"letters {p}" + (" on " + " and ".join(f"{p}.f <> {q}.f" for q in _FIVE[:k]) if k else "") for k, p in enumerate(_FIVE))}),
steps as materialized ({" union all ".join(f"select {' || '.join(f'f{q}' for q in _FIVE)} as filter_order, {k + 1} as step, b{p} as own, {' + '.join(['0', *(f'b{q}' for q in _FIVE[:k])])} as earlier from orders" for k, p in enumerate(_FIVE))}),
lines as materialized (select part, filter_order, step, own, cast(coalesce(sum(n) filter (failed & (own | earlier) = 0), 0) as bigint) as kept,
  cast(coalesce(sum(n) filter (failed & own <> 0 and failed & earlier = 0), 0) as bigint) as removed, cast(coalesce(sum(n) filter (failed & own <> 0 and failed & earlier <> 0), 0) as bigint) as redundant,
  cast(coalesce(sum(n) filter (failed = own), 0) as bigint) as unique_fails, cast(coalesce(sum(good) filter (failed & own <> 0 and failed & earlier = 0), 0) as bigint) as good_lost,
  cast(coalesce(sum(toxic) filter (failed & own <> 0 and failed & earlier = 0), 0) as bigint) as toxic_lost from combos, steps group by part, filter_order, step, own)
select part, filter_order, cast(step as int) as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, cast(sum(removed) over (partition by part, own) as bigint) as shapley from lines"""

OP13 = f"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOW}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
words as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces where regexp_matches(piece, '[^\x20\x09]')),
found as (select lang, unnest(w) as phrase, 1 as size from words
  union all select lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 from words where len(w) > 1
  union all select lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 from words where len(w) > 2),
f as materialized (select lang, phrase, size, cast(count(*) as hugeint) as a from found group by lang, phrase, size having count(*) >= 10),
split as materialized (select lang, phrase, size, a, string_split(phrase, ' ') as w from f where size > 1),
cuts as (select lang, phrase, a, 1 as k, w[1] as x, case when size = 2 then w[2] else w[2] || ' ' || w[3] end as y from split
  union all select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from split where size = 3),
scores as (select c.lang, c.phrase, c.a, k, l.a as l, r.a as r, 1000000 * c.a * c.a // (l.a * r.a) as score
  from cuts c join f l on l.lang = c.lang and l.phrase = x join f r on r.lang = c.lang and r.phrase = y),
best as (select * from (select *, row_number() over (partition by lang, phrase order by score, k) as place from scores) z where place = 1),
longer as (select lang, phrase, max(a) as most from (select lang, w[1] || ' ' || w[2] as phrase, a from split where size = 3 union all select lang, w[2] || ' ' || w[3], a from split where size = 3) z group by lang, phrase),
n as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
ranked as (select b.*, row_number() over (partition by b.lang order by score desc, a desc, encode(b.phrase)) as rank from best b left join longer g on g.lang = b.lang and g.phrase = b.phrase where most is null or 100 * most < 50 * a)
select ranked.lang, rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, n, cast(score as bigint) as score from ranked join n on n.lang = ranked.lang where rank <= 2000"""

ORACLES = {"op2_minhash_near_dup": OP2, "op7_quality_rules": OP7, "op8_decontamination": OP8, "op12_filter_audit": OP12, "op13_collocations": OP13}
