"""What some of the queries return, in SQL for DuckDB."""

from vanewatch.llm.rules import COMMON, PUNCTUATION, Limits

_LIMITS = Limits()

QUALITY_RULES = r"""
with recursive d as (
  select doc_id, lang, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZPUNCTUATION',
           'abcdefghijklmnopqrstuvwxyzSPACES'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as plain,
         row_number() over () as r
  from documents
), top as (
  select lang as top_lang, list(word order by place) as words from (
    select lang, word, row_number() over (partition by lang order by count(*) desc, word) as place
    from (select lang, unnest(list_distinct(plain)) as word from d) group by lang, word)
  where place <= COMMON group by lang
), f as (
  select r, doc_id, lang, t, w, plain, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) as n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
         length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) as upper,
         length(regexp_replace(t, '\P{L}+', '', 'g')) as letters,
         length(regexp_replace(t, '\P{Nd}+', '', 'g')) as digits
  from d
), p as (
  select r, i, list_slice(w, i, i + 7) as s from (select r, w, unnest(range(1, len(w) - 6)) as i from f where len(w) >= 8)
), q as (
  select r, i from (select r, i, count(*) over (partition by r, s) as c from p) where c > 1
), v as (
  select r, sum(least(8, coalesce(lead_i - i, 8))) as n_repeat_words
  from (select r, i, lead(i) over (partition by r order by i) as lead_i from q) group by r
), h as (
  select f.*, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         [upper, letters - upper, digits, length(t) - word_chars, n_symbols, word_chars - letters - digits - n_symbols] as shape,
         list_transform(coalesce(words, []), lambda x: len(list_filter(plain, lambda y: y = x))) as hit
  from f left join v using (r) left join top on lang is not distinct from top_lang
), g as (
  select *, list_concat(list_concat(hit, list_transform(range(COMMON - len(hit)), lambda x: 0)),
    [len(plain) - coalesce(list_sum(hit), 0)::bigint]) as hits,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from h
), shapes as (
  select lang, list(s order by k) as ref_shape from
    (select lang, k, sum(x) as s from (select lang, unnest(shape) as x, unnest(range(6)) as k from g where not base_failed) group by lang, k) group by lang
), words as (
  select lang, list(s order by k) as ref_hits from
    (select lang, k, sum(x) as s from (select lang, unnest(hits) as x, unnest(range(len(hits))) as k from g where not base_failed) group by lang, k) group by lang
), totals as (
  select lang, sum(n_words) as ref_total from g where not base_failed group by lang
), j as (
  select g.*, ref_total,
         list_transform(shape, lambda x: x / list_sum(shape)) as p1, list_transform(ref_shape, lambda x: x / list_sum(ref_shape)) as q1,
         list_transform(hits, lambda x: x / list_sum(hits)) as p2, list_transform(ref_hits, lambda x: x / list_sum(ref_hits)) as q2
  from g left join shapes s on g.lang is not distinct from s.lang left join words o on g.lang is not distinct from o.lang
         left join totals z on g.lang is not distinct from z.lang
), e as (
  select *,
    sqrt(greatest(0, list_sum(list_transform(list_zip(p1, q1), lambda x:
      (case when x[1] > 0 then x[1] * log2(2 * x[1] / (x[1] + x[2])) else 0 end
       + case when x[2] > 0 then x[2] * log2(2 * x[2] / (x[1] + x[2])) else 0 end) / 2)))) as class_distance,
    sqrt(greatest(0, list_sum(list_transform(list_zip(p2, q2), lambda x:
      (case when x[1] > 0 then x[1] * log2(2 * x[1] / (x[1] + x[2])) else 0 end
       + case when x[2] > 0 then x[2] * log2(2 * x[2] / (x[1] + x[2])) else 0 end) / 2)))) as word_distance
  from j
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words, base_failed,
       not base_failed
       and not (coalesce(ref_total, 0) >= GUARD_REFERENCE and length(t) >= GUARD_CHARS and coalesce(class_distance, 0) > CLASS_LIMIT)
       and not (coalesce(ref_total, 0) >= GUARD_REFERENCE and n_words >= GUARD_WORDS and coalesce(word_distance, 0) > WORD_LIMIT) as kept
from e
""".replace("PUNCTUATION", PUNCTUATION.replace("'", "''")).replace("SPACES", " " * len(PUNCTUATION)).replace("COMMON", str(COMMON))
QUALITY_RULES = (
    QUALITY_RULES.replace("GUARD_REFERENCE", str(_LIMITS.guard_reference))
    .replace("GUARD_CHARS", str(_LIMITS.guard_chars))
    .replace("GUARD_WORDS", str(_LIMITS.guard_words))
    .replace("CLASS_LIMIT", str(_LIMITS.class_distance))
    .replace("WORD_LIMIT", str(_LIMITS.word_distance))
)

NGRAM_JACCARD = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), s as (
  select distinct doc_id, list_slice(w, i, i + 2) as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from d where len(w) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), o as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), l as (
  select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)
), e as (
  select a, b from l union all select b, a from l
), reach as (
  select doc_id, doc_id as root from documents
  union
  select e.b, reach.root from reach join e on e.a = reach.doc_id
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, min(root) as component_id
from reach left join n using (doc_id) group by doc_id, n
"""

SUFFIX_DEDUP = r"""
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as x from documents
), w as (
  select doc_id, p, substr(x, 2 * p + 1, 100) as s
  from (select doc_id, x, unnest(range(greatest(len(x) // 2 - 49, 0))) as p from d)
), g as (
  select doc_id, p from (select doc_id, p, min(doc_id) over (partition by s) as first from w) where first < doc_id
), k as (
  select doc_id, p, lag(p) over (partition by doc_id order by p) as before from g
), r as (
  select doc_id, p, sum(case when before is null or p > before + 50 then 1 else 0 end) over (partition by doc_id order by p) as span
  from k
), m as (
  select doc_id, span, min(p) as a, max(p) + 50 as b from r group by doc_id, span
), c as (
  select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as since from m
), t as (
  select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans, max(b) as rest,
         string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' order by a) as kept
  from c join d using (doc_id) group by doc_id
)
select doc_id, (len(x) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(rest, 0) + 1))) as kept_sha256
from d left join t using (doc_id)
"""

#: The hash of an id is its CRC-32, taken bit by bit: eight shifts a character.
PERIODIC_RUNS = r"""
with d as (
  select row_number() over () as r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda y: y <> '') as w,
         xor(list_reduce(
           list_concat([4294967295], flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
           lambda acc, c: xor(xor(acc, c) >> 1, 3988292384 * (xor(acc, c) & 1))), 4294967295) as h
  from documents
), b as (
  select *, len(w)::bigint as n, h // 10 as g, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a from d
), c as (
  select *, 1 + (n - a) // (3 + g % 8) as p from b
), x as (
  select r, doc_id, n, case when a is null then w else list_concat(list_slice(w, 1, a),
           list_slice(flatten(list_transform(range((n - a) // p + 1), lambda k: list_slice(w, a + 1, a + p))), 1, n - a)) end as x
  from c
), periods as (
  select r, n, x, unnest(range(1, n // 3 + 1)) as q from x where n >= 24
), grid as (
  select r, n, x, q, unnest(range(0, n - 2 * q + 1, q)) as i from periods
), hits as (
  select r, n, x, q, i from grid
  where x[i + 1] = x[i + q + 1] and x[i + q] = x[i + 2 * q] and list_slice(x, i + 1, i + q) = list_slice(x, i + q + 1, i + 2 * q)
), chains as (
  select *, lag(i) over (partition by r, q order by i) as before from hits
), stretches as (
  select r, q, coalesce(list_filter(range(i), lambda m: x[m + 1] <> x[m + q + 1])[-1] + 1, 0) as s,
         coalesce(list_filter(range(i + 2 * q, n), lambda m: x[m + 1] <> x[m - q + 1])[1], n) as e
  from chains where before is null or before < i - q
), runs as (
  select r, s, e - s as l, min(q) as q from stretches where e - s >= greatest(24, 3 * q) group by r, s, e
), best as (
  select r, s, l, q, row_number() over (partition by r order by l::decimal(38, 18) / q desc, s, q) as place from runs
), lists as (
  select r, count(*) as n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' order by s, q) as lines,
         list({'a': s + q, 'b': s + l}) as gone
  from runs group by r
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, s::bigint as start, l::bigint as length, q::bigint as period,
       (1000 * l // q)::bigint as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
       sha256(array_to_string(case when gone is null then x else list_transform(
         list_filter(range(n), lambda m: len(list_filter(gone, lambda z: m >= z.a and m < z.b)) = 0), lambda m: x[m + 1]) end, ' ')) as collapsed_sha256
from x left join lists using (r) left join best on x.r = best.r and place = 1
"""
