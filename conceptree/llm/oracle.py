"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from conceptree.llm.rules import STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_NEARDUP = rf"""
with recursive
w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as ws
    from documents
),
s as (
    select distinct doc_id, array_to_string(ws[i : i + 3], ' ') as x
    from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) as i from w where len(ws) > 0)
),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (
    select a.doc_id as a, b.doc_id as b, count(*) as n_both
    from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2
),
links as (
    select a, b from pairs join n na on na.doc_id = a join n nb on nb.doc_id = b
    where 100 * n_both >= 80 * (na.n + nb.n - n_both)
),
both_ways as (select a, b from links union all select b, a from links),
reach as (
    select doc_id, doc_id as root from documents
    union
    select e.b, r.root from reach r join both_ways e on e.a = r.doc_id where r.root < e.b
),
c as (select doc_id, min(root) as component_id from reach group by doc_id)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d join c using (doc_id) left join n using (doc_id)
"""

_WARC = """
with p as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex,
        max(page_id) over (partition by coalesce(html, '')) as top
    from pages
),
b as (
    select *, array_to_string(list_transform(range(1, 41),
        lambda k: substr('0000000100100011010001010110011110001001101010111100110111101111',
            4 * (strpos('0123456789abcdef', substr(hex, k, 1)) - 1) + 1, 4)), '') as bits
    from p
)
select page_id, payload_bytes::bigint as payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
        + 16 * substr(bits, 5 * i + 1, 1)::int + 8 * substr(bits, 5 * i + 2, 1)::int + 4 * substr(bits, 5 * i + 3, 1)::int
        + 2 * substr(bits, 5 * i + 4, 1)::int + substr(bits, 5 * i + 5, 1)::int, 1)), '') as payload_digest,
    case when page_id = top then 'response' else 'revisit' end as record_type,
    case when page_id <> top then top end as refers_to
from b
"""

_PASSAGES = rf"""
with w as (select doc_id, {_WORDS} as ws from documents),
win as (
    select doc_id, i, array_to_string(ws[i : i + 19], ' ') as x
    from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from w where len(ws) >= 20)
),
later as (
    select doc_id, i from (select doc_id, i, row_number() over (partition by x order by doc_id, i) as r from win) where r > 1
),
gone as (select distinct doc_id, i + j as k from later, range(20) t(j)),
left_over as (
    select doc_id, count(*) as n, string_agg(word, ' ' order by k) as kept
    from (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as k from w) anti join gone using (doc_id, k)
    group by doc_id
)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from w left join left_over using (doc_id)
"""

_TOPK = """
with e as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from e q join e c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20
"""

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

_RULES = rf"""
with w as (
    select doc_id, coalesce(text, '') as t, {_WORDS} as ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ 	-
]')) as ls
    from documents
),
win as (
    select doc_id, i, ws[i : i + 2] as x
    from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)
),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, x) as n from win) where n > 1),
covered as (select doc_id, count(distinct i + j) as n from twice, range(3) t(j) group by doc_id),
b as (
    select w.doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
        (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols,
        (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
        len(ls) as n_lines, len(list_filter(ws, lambda x: lower(x) in ({_STOPS}))) as n_stops
    from w left join covered c using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    n_words >= 50 and 2 * n_repeat_words <= n_words and word_chars / n_words between 2 and 14
        and n_symbols / n_words <= 0.1 and n_stops / n_words >= 0.01 and n_dup_lines / n_lines <= 0.5
        and n_words / n_lines >= 1 as kept
from b
"""

_AUDIT = rf"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, {_WORDS} as ws from documents),
f as (
    select doc_id, part, case when len(ws) < 200 then 'A' else '' end
        || case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 'B' else '' end
        || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 'C' else '' end
        || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
        || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as fails
    from d
),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
c as (
    select part, fails, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
    from f left join l using (doc_id) group by part, fails
),
x(k) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
    select a.k || b.k || c.k || d.k || e.k as filter_order from x a, x b, x c, x d, x e
    where a.k not in (b.k, c.k, d.k, e.k) and b.k not in (c.k, d.k, e.k) and c.k not in (d.k, e.k) and d.k <> e.k
),
steps as (
    select filter_order, i::int as step, substr(filter_order, i, 1) as own, substr(filter_order, 1, i - 1) as ahead
    from orders, range(1, 6) r(i)
),
m as (
    select s.*, part, n, good, toxic, contains(fails, own) as failing, fails = own as only_this,
        translate(fails, ahead, '') <> fails as gone
    from steps s, c
),
r as (
    select part, filter_order, step, own, sum(case when not failing and not gone then n else 0 end)::bigint as kept,
        sum(case when failing and not gone then n else 0 end)::bigint as removed,
        sum(case when failing and gone then n else 0 end)::bigint as redundant,
        sum(case when only_this then n else 0 end)::bigint as unique_fails,
        sum(case when failing and not gone then good else 0 end)::bigint as good_lost,
        sum(case when failing and not gone then toxic else 0 end)::bigint as toxic_lost
    from m group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    sum(removed) over (partition by part, own)::bigint as shapley
from r
"""

SQL: dict[str, str] = {
    "op1_warc": _WARC,
    "op6_passages": _PASSAGES,
    "op8_topk": _TOPK,
    "op9_neardup": _NEARDUP,
    "op10_rules": _RULES,
    "op11_audit": _AUDIT,
}
