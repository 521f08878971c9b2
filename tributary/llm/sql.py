"""The queries that SQL can express, as DuckDB reads them."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

STATEMENTS = {}

STATEMENTS["op1_decontamination"] = rf"""
with doc as (
  select row_number() over () as r, doc_id,
         coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents
), item as (
  select cast(item_id as varchar) as item,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), win as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[p:p + 9], ' ') as t
  from (select *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as p from item where len(w) > 0)
), hit as (
  select distinct r, p, n, item
  from (select r, n, p, array_to_string(w[p:p + n - 1], ' ') as t
        from (select r, w, n, unnest(range(1, len(w) - n + 2)) as p
              from doc, (select distinct n from win) where len(w) >= n))
  join win using (n, t)
), words as (
  select r, count(distinct q) as n_hit from (select r, unnest(range(p, p + n)) as q from hit) group by r
), items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct r, item from hit) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(list, '')) as items_sha256,
       n_hit is not null as contaminated
from doc left join words using (r) left join items using (r)
"""

_QUALITY_NGRAMS = {3: 0.60, 5: 0.40, 7: 0.35, 10: 0.30}


def _repeats(n: int) -> str:
    return f"""
gram{n} as (
  select r, p, count(*) over (partition by r, w[p:p + {n - 1}]) as times
  from (select r, w, unnest(range(1, len(w) - {n} + 2)) as p from doc where len(w) >= {n})
), rep{n} as (
  select r, count(*) as words, sum(len(w[q])) as chars
  from (select distinct r, unnest(range(p, p + {n})) as q from gram{n} where times > 1)
  join doc using (r) group by r
)"""


STATEMENTS["op10_quality_rules"] = rf"""
with doc as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
), {", ".join(_repeats(n) for n in _QUALITY_NGRAMS)},
line as (
  select r, p, l, row_number() over (partition by r, l order by p) as nth
  from (select r, unnest(string_split(text, chr(10))) as l,
               generate_subscripts(string_split(text, chr(10)), 1) as p from doc)
  where regexp_matches(l, '[^\x20\x09-\x0D]')
), lines as (
  select r, count(*) as n_lines, count(*) filter (nth > 1) as n_dup_lines, sum(len(l)) as line_chars,
         coalesce(sum(len(l)) filter (nth > 1), 0) as dup_line_chars
  from line group by r
), m as (
  select r, doc_id, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: len(x))), 0) as bigint) as word_chars,
         cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_lines, 0) as n_lines,
         cast(coalesce(line_chars, 0) as bigint) as line_chars,
         cast(coalesce(dup_line_chars, 0) as bigint) as dup_line_chars,
         {", ".join(f"coalesce(rep{n}.words, 0) as repeat_words_{n}, cast(coalesce(rep{n}.chars, 0) as bigint) as repeat_chars_{n}" for n in _QUALITY_NGRAMS)}
  from doc left join lines using (r) {" ".join(f"left join rep{n} using (r)" for n in _QUALITY_NGRAMS)}
), b as (
  select *, n_words < 50 or 100 * repeat_words_3 > 50 * n_words as base_failed from m
)
select * exclude (r), repeat_words_3 as n_repeat_words,
       not (base_failed or n_symbols > 0.20::double * word_chars
            or n_dup_lines > 0.5::double * n_lines or dup_line_chars > 0.5::double * line_chars
            or {" or ".join(f"repeat_chars_{n} > {s}::double * word_chars" for n, s in _QUALITY_NGRAMS.items())}) as kept
from b
"""

_SECRETS = {  # kind: pattern, group of the value, least length
    "assign": (
        r"""(?:(?i)(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    "access": ("AKIA[A-Z0-9]{14,}", 0, 1),
    "hex": ("[0-9a-f]{16,}", 0, 1),
    "forge": ("gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    "chat": ("xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    "pem": ("-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
}


def _secret(rank: int, kind: str) -> str:
    pattern, group, least = _SECRETS[kind]
    return f"""
  select r, repository, owner, {rank} as rank, '{kind}' as kind, {least} as least, i,
         sum(len(gap) + len(whole)) over (partition by r order by i) as stop, len(whole) as size, value
  from (select r, repository, owner, unnest(range(1, len(whole) + 1)) as i, unnest(whole) as whole,
               unnest(gap[:len(whole)]) as gap, unnest(value) as value
        from (select r, repository, owner, regexp_extract_all(text, '{pattern}') as whole,
                     regexp_split_to_array(text, '{pattern}') as gap,
                     regexp_extract_all(text, '{pattern}', {group}) as value from doc))"""


STATEMENTS["op9_secret_scan"] = f"""
with doc as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
         coalesce(source, '') || '/' || coalesce(lang, '') as repository, coalesce(source, '') as owner
  from documents
), found as ({" union all ".join(_secret(i, k) for i, k in enumerate(_SECRETS))}
), good as (select *, kind || ':' || cast(stop - size as bigint) || ':' || cast(stop as bigint) as span
            from found where len(value) >= least
), held as (
  select value, count(distinct repository) as repositories, count(distinct owner) as owners
  from good group by value
), judged as (
  select good.*, case when owners >= 3 and repositories >= 3 then 'example'
                      when owners = 1 and len(list_distinct(string_split(value, ''))) >= 8 then 'live'
                      else 'shared' end as verdict
  from good join held using (value)
), each as (
  select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
         count(*) filter (kind = 'hex') as n_hex,
         string_agg(span, ',' order by stop - size, rank) filter (rank < 3) as base,
         string_agg(span, ',' order by stop - size, rank) as spans,
         count(*) filter (verdict = 'live') as n_live, count(*) filter (verdict = 'shared') as n_shared,
         count(*) filter (verdict = 'example') as n_example
  from judged group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
       coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live,
       coalesce(n_shared, 0) as n_shared, coalesce(n_example, 0) as n_example
from doc left join each using (r)
"""

STATEMENTS["op2_reply_trees"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), said as (
  select *, len(replace(replace(text, '\', '\\'), '<|', '<\|')) as body,
         len(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) as head from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(len(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(12 + head + 1 + body + 11) as bigint) as formatted_chars
from said group by conv_id
"""

_SUMS = ", ".join(f"cast(sum(cast('0x' || substr(h, {at}, 15) as bigint)) as varchar)" for at in (1, 16, 31, 46))


def _leaves(source: str) -> str:
    return f"""
  select page_id, url, count(*) as copies, cast(sum(strlen(rec)) as bigint) as length,
         sha256(concat_ws(':', cast(count(*) as varchar), {_SUMS})) as digest
  from (select *, sha256(rec) as h from (
    select page_id, url, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
           || 'WARC-Record-ID: <urn:record:' || coalesce(cast(page_id as varchar), '') || '>' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
           || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
           || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) as rec
    from {source}))
  group by page_id, url"""


STATEMENTS["op8_merkle_fixity"] = f"""
with copied as (select page_id, url, substr(html, 1, 32768) as html from pages where html <> ''),
ours as ({_leaves("pages")}), theirs as ({_leaves("copied")}),
placed as (
  select *, row_number() over (order by page_id nulls first, url nulls first) - 1 as number from ours
)
select p.page_id, p.url, number, number // 4096 as file,
       cast(sum(p.length) over (partition by number // 4096 order by number) - p.length as bigint) as "offset",
       p.length, p.copies, p.digest,
       case when t.digest is null then 'missing' when t.digest <> p.digest then 'corrupt' else 'ok' end as status
from placed p left join theirs t
  on p.page_id is not distinct from t.page_id and p.url is not distinct from t.url
"""

STATEMENTS["op6_minhash_components"] = rf"""
with recursive doc as (
  select row_number() over () as r, doc_id,
         coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) as w
  from documents
), shingle as (
  select distinct r, s from (
    select r, w[p] || ' ' || w[p + 1] as s from (select r, w, unnest(range(1, len(w))) as p from doc)
    union all select r, w[1] from doc where len(w) = 1)
), n as (select r, count(*) as n from shingle group by r
), pair as (
  select a.r as x, b.r as y, count(*) as c from shingle a join shingle b on a.s = b.s and a.r <> b.r group by all
), edge as (
  select x, y from pair join n p on x = p.r join n q on y = q.r where 100 * c >= 80 * (p.n + q.n - c)
), reach as (
  select r as x, r as y from doc union select reach.x, edge.y from reach join edge on reach.y = edge.x
), least as (
  select x, min(doc_id) as component_id from reach join doc on y = doc.r group by x
)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from doc left join n using (r) join least on x = doc.r
"""

# Texts as hex digits; blocks of 1,000 bytes carry the 99 behind them, so that no row holds a whole text.
STATEMENTS["op7_prefix_free_parsing"] = """
with doc as (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), block as (
  select r, doc_id, b, substr(h, 2000 * b + 1, 2198) as t
  from (select r, doc_id, h, unnest(range(0, len(h) // 2000 + 1)) as b from doc)
), string as (
  select r, doc_id, 1000 * b + q as p, md5_number(substr(t, 2 * q + 1, 200)) as d
  from (select r, doc_id, b, t, unnest(range(0, least(1000, len(t) // 2 - 99))) as q
        from block where len(t) >= 200)
), late as (
  select r, p from (select r, p, row_number() over (partition by d order by doc_id, p) as n from string)
  where n > 1
), island as (
  select r, p, sum(begins) over (partition by r order by p) as i
  from (select r, p, case when p <= lag(p) over (partition by r order by p) + 100 then 0 else 1 end as begins
        from late)
), run as (select r, min(p) as s, max(p) + 100 as e from island group by r, i
), gap as (
  select r, s, e, substr(h, 2 * coalesce(lag(e) over (partition by r order by s), 0) + 1,
                         2 * (s - coalesce(lag(e) over (partition by r order by s), 0))) as before
  from run join doc using (r)
), each as (
  select r, cast(sum(e - s) as bigint) as n_removed, count(*) as n_spans, max(e) as last,
         string_agg(before, '' order by s) as front
  from gap group by r
)
select doc_id, cast(len(h) // 2 as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed,
       coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from doc left join each using (r)
"""

STATEMENTS["op12_filter_interactions"] = r"""
with doc as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
         coalesce(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), []) as w
  from documents
), earliest as (select text, min(doc_id) as least from doc group by text
), said as (
  select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic
  from labels group by doc_id
), failed as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
         case when len(w) < 50 then 'A' else '' end
         || case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end
         || case when 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * len(text) then 'C' else '' end
         || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
         || case when least < doc_id then 'E' else '' end as f
  from doc join earliest using (text) left join said using (doc_id)
), cell as (
  select part, f, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from failed group by part, f
), letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as x
), ordered as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letter a join letter b on b.x <> a.x join letter c on c.x not in (a.x, b.x)
  join letter d on d.x not in (a.x, b.x, c.x) join letter e on e.x not in (a.x, b.x, c.x, d.x)
), step as (
  select filter_order, step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before
  from (select filter_order, cast(unnest(range(1, 6)) as integer) as step from ordered)
), gone as (
  select part, filter_order, step, own, n, good, toxic, f = own as alone, contains(f, own) as fails,
         translate(f, before, '') <> f as earlier
  from cell, step
), counted as (
  select part, filter_order, step, own,
         sum(n) filter (not fails and not earlier) as kept, sum(n) filter (fails and not earlier) as removed,
         sum(n) filter (fails and earlier) as redundant, sum(n) filter (alone) as unique_fails,
         sum(good) filter (fails and not earlier) as good_lost,
         sum(toxic) filter (fails and not earlier) as toxic_lost
  from gone group by part, filter_order, step, own
)
select part, filter_order, step, cast(coalesce(kept, 0) as bigint) as kept,
       cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
       cast(coalesce(unique_fails, 0) as bigint) as unique_fails,
       cast(coalesce(good_lost, 0) as bigint) as good_lost,
       cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
       cast(coalesce(sum(removed) over (partition by part, own), 0) as bigint) as shapley
from counted
"""
