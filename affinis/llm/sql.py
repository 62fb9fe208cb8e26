"""DuckDB forms of the queries that SQL can express."""

from __future__ import annotations

from .quality import MAX_DOCS, MIN_LEFT
from .secrets import ACCESS, ASSIGN, GENERIC, HEX, KINDS, MAX_OWNERS, MAX_REPOS

_WORD, _SPACE = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

QUALITY = f"""
    with d as (select row_number() over () as k, doc_id, coalesce(source, chr(0)) as host, coalesce(text, '') as t from documents),
    w as (select k, regexp_extract_all(t, '{_WORD}') as w from d),
    tri as (select k, x.i as i, x.s as s from (select k, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'i': i, 's': w[i:i + 2]}})) as x from w)),
    hit as (select k, i from tri qualify count(*) over (partition by k, s) > 1),
    cover as (select k, count(distinct p) as n from (select k, unnest([i, i + 1, i + 2]) as p from hit) group by k),
    lines as (select k, host, unnest(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}'))) as line from d),
    plain as (select k, host, trim(regexp_replace(translate(line, {_FOLD}), '{_SPACE}', ' ', 'g')) as s from lines),
    often as (select host, s from plain group by 1, 2 having count(distinct k) > {MAX_DOCS}),
    lost as (select k, sum(len(string_split(s, ' ')))::bigint as n from plain semi join often using (host, s) group by k),
    dup as (select k, count(*) - count(distinct line) as n from lines group by k),
    m as (
        select doc_id, len(w) as n_words, length(regexp_replace(t, '{_SPACE}', '', 'g')) as word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols,
            coalesce(dup.n, 0) as n_dup_lines, coalesce(cover.n, 0) as n_repeat_words, len(w) - coalesce(lost.n, 0) as n_left
        from d join w using (k) left join cover using (k) left join dup using (k) left join lost using (k))
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_left >= {MIN_LEFT} * n_words as kept from m"""


def _spans(pattern: str, rank: int, group: int) -> str:
    """Rows (k, s, r, e, v) of a pattern's matches: gaps and matches in turn give their places."""
    p = pattern.replace("'", "''")
    return f"""
        select k, x.s as s, {rank} as r, x.e as e, x.v as v from (
            select k, unnest(list_transform(range(1, len(h) + 1), lambda i: {{
                's': list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda y: length(y))), 0),
                'e': list_sum(list_transform(g[1:i], lambda y: length(y))) + list_sum(list_transform(h[1:i], lambda y: length(y))), 'v': vs[i]}})) as x
            from (select k, regexp_split_to_array(t, '{p}') as g, regexp_extract_all(t, '{p}') as h, regexp_extract_all(t, '{p}', {group}) as vs
                from d where regexp_matches(t, '{p}')))"""


_KIND = "case r " + " ".join(f"when {i} then '{k}'" for i, k in enumerate(KINDS)) + " end || ':' || s || ':' || e"
SECRETS = f"""
    with d as (select row_number() over () as k, doc_id, coalesce(source, '') as owner, concat_ws('/', source, lang) as repo, coalesce(text, '') as t from documents),
    base as (select * from ({_spans(ASSIGN, 0, 2)}) where length(v) >= 6 union all {_spans(ACCESS, 1, 0)} union all {_spans(HEX, 2, 0)}),
    loose as (select * from ({_spans(GENERIC, 3, 0)}) where regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Za-z]')),
    more as (select * from loose where not exists (select 1 from base where base.k = loose.k and loose.s < base.e and base.s < loose.e)),
    every as (select * from base union all select * from more),
    live as (select v from every join d using (k) group by v having count(distinct owner) <= {MAX_OWNERS} and count(distinct (owner, repo)) <= {MAX_REPOS}),
    told as (select *, v in (select v from live) as live from every),
    sums as (
        select k, count_if(r = 0) as a, count_if(r = 1) as b, count_if(r = 2) as c, count_if(r = 3 and live) as g, count_if(r < 3 and live) as l, count_if(r < 3 and not live) as x,
            string_agg({_KIND}, ',' order by s, r) filter (where r < 3) as base, string_agg({_KIND}, ',' order by s, r) filter (where r < 3 or live) as spans
        from told group by k)
    select doc_id, coalesce(a, 0) as n_assign, coalesce(b, 0) as n_access, coalesce(c, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
        coalesce(g, 0) as n_generic, coalesce(l, 0) as n_live, coalesce(x, 0) as n_example from d left join sums using (k)"""
