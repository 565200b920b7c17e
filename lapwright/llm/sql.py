"""DuckDB SQL for the registered queries that SQL can express; written on its own, not derived from the jobs."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATION = rf"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), b as (
  select item_id, w, least(len(w), 10) as n from (
    select item_id,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark)
  where len(w) > 0
), bw as (
  select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as gram
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from b)
), lens as (select distinct n from bw),
dw as (
  select r, i, n, array_to_string(w[i : i + n - 1], ' ') as gram
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lens where len(w) >= n)
), hit as (select dw.r, dw.i, dw.n, dw.gram from dw where (n, gram) in (select n, gram from bw)),
places as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r
), items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as listed
  from (select distinct hit.r, cast(bw.item_id as varchar) as item from hit join bw using (n, gram)
        where bw.item_id is not null)
  group by r
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(listed, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (r) left join items using (r)
"""

# name, when it is zero, value, count, factor, size
_MEASURES = (
    ("word_length", "n_words = 0", "100 * word_chars // n_words", "word_chars", 100, "n_words"),
    ("symbol_share", "word_chars = 0", "10000 * n_symbols // word_chars", "n_symbols", 10000, "word_chars"),
    ("copied_line_share", "n_lines = 0", "10000 * n_dup_lines // n_lines", "n_dup_lines", 10000, "n_lines"),
    ("echo_share", "n_words = 0", "10000 * n_echoes // n_words", "n_echoes", 10000, "n_words"),
)


def quality_rules() -> str:
    values = ", ".join(f"case when {zero} then 0 else {value} end as {m}" for m, zero, value, *_ in _MEASURES)
    long = " union all ".join(
        f"select r, lang, source, '{m}' as measure, {m} as v, cast({count} as double) as n, cast({size} as double) / {factor} as size from measured"
        for m, _, _, count, factor, size in _MEASURES
    )
    figures = ("q10", "q50", "q90", "off")

    def level(name: str, *keys: str) -> str:
        by = "".join(f"{k}, " for k in keys)
        same = "".join(f"q.{k} is not distinct from s.{k} and " for k in keys)
        return f"""{name}_steps as (
  select {by}measure, step, count(*) as n,
         case when step < 32 then step else (step % 16 + 16) * cast(pow(2, step // 16 - 1) as bigint) end as start
  from steps group by {by}measure, step
), {name}_q as (
  select {by}measure, max(total) as docs, min(start) filter (where below * 100 >= total * 10) as q10,
         min(start) filter (where below * 100 >= total * 50) as q50, min(start) filter (where below * 100 >= total * 90) as q90
  from (select *, sum(n) over (partition by {by}measure order by step) as below, sum(n) over (partition by {by}measure) as total
        from {name}_steps)
  group by {by}measure
), {name} as (
  select q.*, f.off from {name}_q q join (
    select {"".join(f"q.{k}, " for k in keys)}q.measure, floor(sum(cast(s.n as double) * abs(s.start - q.q50)) / max(q.docs)) as off
    from {name}_q q join {name}_steps s on {same}q.measure = s.measure group by {"".join(f"q.{k}, " for k in keys)}q.measure
  ) f on {"".join(f"q.{k} is not distinct from f.{k} and " for k in keys)}q.measure = f.measure)"""

    def drawn(of: str, towards: str) -> str:
        return ", ".join(f"floor(({of}.docs * cast({of}.{c} as double) + 200 * {towards}.{c}) / ({of}.docs + 200)) as {c}" for c in figures)

    return rf"""
with base as (
  select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents
), windows as (
  select r, i, w[i : i + 7] as win from (select r, w, unnest(range(1, len(w) - 6)) as i from base where len(w) >= 8)
), twice as (
  select r, count(distinct p) as n_repeat_words from (
    select r, unnest(range(i, i + 8)) as p from (
      select r, i, count(*) over (partition by r, win) as n from windows) where n > 1)
  group by r
), counts as (
  select r, doc_id, lang, source, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(l) - coalesce(len(list_distinct(l)), 0) as bigint) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, cast(len(l) as bigint) as n_lines,
         cast(len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as bigint) as n_echoes
  from base left join twice using (r)
), measured as (select *, {values} from counts),
long as ({long}),
steps as (
  select *, case when v < 16 then v else (length(bin(v)) - 4) * 16 + (v >> (length(bin(v)) - 5)) - 16 end as step from long
),
{level("own", "lang", "source")},
{level("by_lang", "lang")},
{level("by_all")},
language as (select l.lang, l.measure, {drawn("l", "a")} from by_lang l join by_all a on l.measure = a.measure),
final as (
  select o.lang, o.source, o.measure, {drawn("o", "l")}
  from own o join language l on o.lang is not distinct from l.lang and o.measure = l.measure
), fence as (
  select lang, source, measure, case when measure = 'word_length' then q10 - 3 * greatest(q50 - q10, off) end as low,
         case when measure = 'word_length' then q90 + 3 * greatest(q90 - q50, off)
              else least(q90 + 3 * greatest(q90 - q50, off), floor((q50 + 10000) / 2)) end as high
  from final
), failures as (
  select s.r, string_agg(s.measure, ',' order by case s.measure {" ".join(f"when '{m[0]}' then {i}" for i, m in enumerate(_MEASURES))} end) as failed
  from steps s join fence f
    on s.lang is not distinct from f.lang and s.source is not distinct from f.source and s.measure = f.measure
  where s.size > 0 and (s.n - 3 * sqrt(s.n) > f.high * s.size or s.n + 3 * sqrt(s.n) < f.low * s.size)
  group by s.r
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and failed is null as kept,
       coalesce(failed, '') as failed
from measured left join failures using (r)
"""

LINE_DEDUP = r"""
with lines as (
  select r, doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words from (
    select r, doc_id, unnest(range(len(l))) as pos, unnest(l) as line from (
      select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents))
  where regexp_matches(line, '[^\x20\x09-\x0D]')
), numbered as (
  select *, row_number() over (partition by r order by pos) as i,
         sum(words) over (partition by r order by pos) - words as before
  from lines
), seqs as (
  select r, doc_id, list(line order by i) as l, list(words order by i) as w, list(pos order by i) as p,
         list(before order by i) as b
  from numbered group by r, doc_id
), runs as (  -- every run with 50 words or more, but for those far longer than needed
  select r, doc_id, i, e, array_to_string(l[i : e], chr(10)) as content from (
    select *, unnest(range(i, least(i + 60, len(l) + 1))) as e from (select *, unnest(range(1, len(l) + 1)) as i from seqs))
  where b[e] + w[e] - b[i] >= 50 and b[e] - b[i] - w[i] < 60
), firsts as (
  select content, min((doc_id, i)) as first from runs group by content having count(*) > 1
), gone as (
  select distinct r, unnest(range(i, e + 1)) as i from runs join firsts using (content) where (doc_id, i) > first
), ranked as (select r, i, i - row_number() over (partition by r order by i) as g from gone),
ranges as (
  select r, s.p[min(i)] as first, s.p[max(i)] as last
  from (select r, i, g, p from ranked join seqs s using (r)) s group by r, g, s.p
), cut as (
  select r, sum(last - first + 1) as n_removed, string_agg(first || '-' || last, ',' order by first) as removed,
         list(first) as f, list(last) as t
  from ranges group by r
), docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents)
select doc_id, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(removed, '') as removed,
       case when n_removed is null then text else coalesce((
         select string_agg(x.line, chr(10) order by x.pos) from (
           select unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos) x
         where not exists (select 1 from (select unnest(f) as a, unnest(t) as z) y where x.pos between y.a and y.z)), '')
       end as text
from docs left join cut using (r)
"""


def _whole(condition: str = "true") -> str:
    """Kept rows of embeddings with their components as whole numbers."""
    odd = "coalesce(list_bool_or([x is null or not isfinite(x) for x in embedding]), false)"
    return f"""select *, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as q
  from embeddings where embedding is not null and not {odd} and {condition}"""


HARD_NEGATIVES = f"""
with e as (
  select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label, q
  from ({_whole("label is not null")})
), s as (
  select a.vec_id as anchor, a.label = e.label as same, e.vec_id as id,
         cast(list_inner_product(cast(a.q as double[]), cast(e.q as double[])) as bigint) as score
  from e a join e on a.vec_id % 100 = 0 and a.vec_id <> e.vec_id
), p as (
  select * from s where same qualify row_number() over (partition by anchor order by score desc, id) <= 5
), n as (
  select p.anchor as anchor_id, p.id as positive_id, s.id as negative_id, p.score as positive_score,
         s.score as negative_score,
         row_number() over (partition by p.anchor, p.id order by s.score desc, s.id) as nth
  from p join s on s.anchor = p.anchor and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
)
select anchor_id, positive_id, cast(nth as integer) as rank, negative_id, positive_score, negative_score
from n where nth <= 10
"""


def vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    def assigned(k: int) -> str:
        return f"""a{k} as (
  select r, part, x, entry, d from (
    select p.r, p.part, p.x, b.entry, list_sum([(p.x[i] - b.x[i]) * (p.x[i] - b.x[i]) for i in range(1, len(p.x) + 1)]) as d
    from cut p join b{k} b using (part))
  qualify row_number() over (partition by r, part order by d, entry) = 1
)"""

    def moved(k: int) -> str:
        return f"""b{k + 1} as (
  select part, entry, coalesce(m.x, b.x) as x from b{k} b left join (
    select part, entry, list(cast(floor(total / n) as bigint) order by i) as x from (
      select part, entry, i, sum(v) as total, count(*) as n
      from (select part, entry, unnest(x) as v, unnest(range(1, len(x) + 1)) as i from a{k}) group by part, entry, i)
    group by part, entry) m using (part, entry)
)"""

    steps = ", ".join(f"{assigned(k)}, {moved(k)}" for k in range(rounds))
    return f"""
with v as (select row_number() over (order by vec_id) as r, vec_id, label, q from ({_whole()})),
cut as (
  select r, part, q[part * m + 1 : (part + 1) * m] as x
  from (select r, q, len(q) // {parts} as m, unnest(range({parts})) as part from v)
), b0 as (select part, r - 1 as entry, x from cut where r <= {entries}),
{steps}, {assigned(rounds)},
done as (
  select r, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' order by part) as code, cast(sum(d) as bigint) as error
  from a{rounds} group by r
), book as (
  select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) as digest from b{rounds}
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       digest as codebooks_sha256
from v join done using (r), book
"""
