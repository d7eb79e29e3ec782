"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from eventloom.llm.licenses import PHRASES, TEMPLATES, WORD, templates_of

ORACLE_SQL: dict[str, str] = {}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Each page's own host and path, the outcome its number leads to, then shares shrunk level by level.
ORACLE_SQL["op3_url_filter"] = f"""
with parts as (
    select page_id,
        {_LOWER.format(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages
), marked as (
    select doc_id, max((coalesce(toxic = 1, false) or coalesce(quality = 0, false))::int) as bad
    from labels where toxic is not null or quality is not null group by doc_id
), hosts as (
    select host, count(bad) as n, coalesce(sum(bad), 0)::bigint as k,
        array_to_string(string_split(host, '.')[-2:], '.') as dom, string_split(host, '.')[-1] as suf
    from parts left join marked
        on try_cast(regexp_extract(path, '/([0-9]{{1,18}})(\\.[a-z]+)?/?$', 1) as bigint) = doc_id
    group by host
), top as (select (sum(k) + 0.5) / (sum(n) + 1) as m from hosts),
sufs as (select suf, sum(n) as n, sum(k) as k, any_value(m) as m from hosts, top group by suf),
suf_rho as (
    select 1 / greatest(0.001, least(0.999, coalesce((sum(n * (k / n - m) ** 2 / (m * (1 - m))) - count(*))
        / nullif(sum(n - 1), 0), 0))) - 1 as s from sufs where n > 0
), suf_mean as (select suf, (k + s * m) / (n + s) as m from sufs, suf_rho),
doms as (
    select dom, suf, n, k, m from (select dom, suf, sum(n) as n, sum(k) as k from hosts group by dom, suf)
    join suf_mean using (suf)
), dom_rho as (
    select 1 / greatest(0.001, least(0.999, coalesce((sum(n * (k / n - m) ** 2 / (m * (1 - m))) - count(*))
        / nullif(sum(n - 1), 0), 0))) - 1 as s from doms where n > 0
), dom_mean as (select dom, (k + s * m) / (n + s) as m from doms, dom_rho),
own as (select host, n, k, m from hosts join dom_mean using (dom)),
own_rho as (
    select 1 / greatest(0.001, least(0.999, coalesce((sum(n * (k / n - m) ** 2 / (m * (1 - m))) - count(*))
        / nullif(sum(n - 1), 0), 0))) - 1 as s from own where n > 0
), judged as (
    select host, n, k, (k + s * m) / (n + s) as p, n + s + 1 as w from own, own_rho
), rules(rule, verdict, name, start) as (values
    ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
    ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'),
    ('com/de/', 'block', 'com', '/de/')
), fitting as (
    select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
    from parts join rules on (host = name or ends_with(host, '.' || name)) and starts_with(path, start)
    group by page_id
)
select page_id, host, path, rule,
    coalesce(verdict, case when p - 1.645 * sqrt(p * (1 - p) / w) > 0.5 then 'block' else 'allow' end) as verdict,
    n::bigint as host_labelled, k::bigint as host_bad
from parts join judged using (host) left join fitting using (page_id)
"""

# All pairs of a query and another row.
ORACLE_SQL["op4_exact_topk"] = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
    where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0 and vec_id is not null
), scored as (
    select q.vec_id as query_id, c.vec_id,
        list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
    from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0
), ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
    from scored
)
select * from ranked where rank <= 10
"""

_WORDS = f"regexp_extract_all({_LOWER.format('{}')}, '{WORD}')"
_HITS = " || ".join(
    "list_transform(list_filter(range(0, len(w)), lambda i: "
    + " and ".join(f"w[i + {k + 1}] = '{part}'" for k, part in enumerate(phrase.split()))
    + f"), lambda i: {{'at': i, 'label': '{label}'}})"
    for phrase, label in PHRASES.items()
)
_TEMPLATES = ", ".join(f"({list(t.words)}, {t.needed}, {t.span}, '{t.label}')" for t in templates_of(TEMPLATES))

# Every start of a run against every template; a run's state is its place times 1000 and its count of words.
ORACLE_SQL["op5_license_scan"] = f"""
with words as (
    select doc_id, coalesce(text, '') as t, {_WORDS.format("coalesce(text, '')")} as w from documents
), base as (
    select doc_id, len(w)::bigint as n_words, {_HITS} as hits from words
), starts as (
    select doc_id, w, wording, needed, span, label, unnest(list_filter(range(0, len(w)), lambda i:
        list_contains(wording, w[i + 1]) and
        len(list_filter(w[i + 1 : i + span], lambda x: list_contains(wording, x))) >= needed)) as i
    from words, (values {_TEMPLATES}) templates(wording, needed, span, label)
), found as (
    select doc_id, label, needed, len(wording) as size, list_reduce([i * 1000] || range(1, len(wording) + 1),
        lambda s, j: case when list_contains(
            w[s // 1000 + 1 : least(s // 1000 + 1 + span - len(wording), i + span)], wording[j])
        then (s // 1000 + list_position(
            w[s // 1000 + 1 : least(s // 1000 + 1 + span - len(wording), i + span)], wording[j])) * 1000 + s % 1000 + 1
        else s end) % 1000 as n
    from starts
), more as (
    select doc_id, list(label) as labels, max(n / size) as score from found where n >= needed group by doc_id
)
select doc_id, n_words, len(hits)::bigint as n_base,
    list_min(list_transform(hits, lambda h: h.at))::bigint as first_word,
    list_max(list_transform(hits, lambda h: h.at))::bigint as last_word,
    array_to_string(list_sort(list_distinct(list_transform(hits, lambda h: h.label))), ',') as base_labels,
    array_to_string(list_sort(list_distinct(list_transform(hits, lambda h: h.label) || coalesce(labels, []))), ',')
        as labels,
    coalesce(score, 0)::double as score
from base left join more using (doc_id)
"""

# Checksums of texts, byte by byte: a table of remainders, and the fold over a text's bytes.
_CRC_TABLE = """
crc_table as (
    select list(c order by i) as remainders from (
        select i, list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
        from range(256) t(i)
    )
)
"""
_CRC = """
xor(4294967295, list_reduce([4294967295::bigint] || list_transform(range(1, length(hex({0})) + 1, 2),
    lambda k: ('0x' || substr(hex({0}), k, 2))::bigint),
    lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])))
"""

# Features counted over both tables, then every document weighed and all scores sorted.
ORACLE_SQL["op11_importance_resample"] = f"""
with {_CRC_TABLE}, texts as (
    select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents
    union all select null, {_WORDS.format("coalesce(text, '')")} from benchmark
), numbered as (
    select row_number() over () as row, doc_id, w from texts
), features as (
    select row, doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as f
    from numbered
), coded as (
    select f, {_CRC.format("f")} % 10000 as bucket from (select distinct f from features), crc_table
), counted as (
    select bucket, count(doc_id) as s, count(*) - count(doc_id) as t from features join coded using (f) group by bucket
), totals as (select sum(s) as all_s, sum(t) as all_t from counted),
gains as (
    select bucket, floor(1000 * ln((t + 1)::double * (all_s + 10000) / ((s + 1)::double * (all_t + 10000))))::bigint as gain
    from counted, totals
), weights as (
    select row, count(*) as n, floor(sum(gain) / count(*)::double)::bigint as weight
    from features join coded using (f) join gains using (bucket) where doc_id is not null group by row
), scored as (
    select doc_id, len(w) as n_words, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
        ('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint as h
    from numbered left join weights using (row) where doc_id is not null
), final as (
    select *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::bigint as score from scored
), ranked as (
    select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n
    from final where n_words >= 20
)
select doc_id, n_features, weight, score, case when rank <= 25 * n // 100 then rank end::bigint as rank
from final left join ranked using (doc_id)
"""


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edit(cost: str, letter: str, state: int, seen: str) -> str:
    """A way to go on: its cost and audit, behind those of ``state``."""
    return f"{{'c': {cost} + {seen}{state}.c, 's': '{letter}' || {seen}{state}.s}}"


_AFTER = {0: 2, 1: 2, 2: 3, 3: 2}
_KEPT = {0: "when 's' then {s} when 'u' then {u} else {x}", 1: "when 'u' then {u} else {x}",
         2: "when 'a' then {a} else {x}", 3: "when 'u' then {u} else {x}"}
_NONE = "{'c': 1000000000::bigint, 's': ''}"


def _row_edits(p: int) -> str:
    keep = _KEPT[p].format(
        s=_edit("cut", "K", 1, "v"), u=_edit("cut", "K", 2, "v"), a=_edit("cut", "K", 3, "v"), x=_NONE
    )
    stay = _least(f"case class {keep} end", _edit("3 + cut", "R", _AFTER[p], "v"))
    return _least(_edit("4", "D", p, "v"), f"case when fault in ('blank', 'duplicate') then {_NONE} else {stay} end")


_WITH_INSERTS = {
    0: _least("e0", _edit("3", "I", 2, "e"), _edit("6", "II", 3, "e")),
    1: _least("e1", _edit("3", "I", 2, "e"), _edit("6", "II", 3, "e")),
    2: _least("e2", _edit("3", "I", 3, "e")),
    3: _least("e3", _edit("3", "I", 2, "e")),
}

# Message by message from the end: cost and audit of the best way on from each state.
ORACLE_SQL["op13_conversation_repair"] = rf"""
with recursive {_CRC_TABLE}, kinds as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_CRC.format(
        "(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as kind
    from conversations, crc_table
), damaged as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
        unnest(case when kind = 3 then [1, 2] else [1] end) as copy
    from kinds where kind <> 0
), numbered as (
    select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
        regexp_extract(text, '(?s)([^ 	-
])[ 	-
]*$', 1) as last,
        case when role[1:1] in ('s', 'u', 'a') then role[1:1] else '-' end as class
    from damaged
), marked as (
    select *, case when last = '' then 'blank'
        when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
        when last not in ('.', '!', '?') then 'truncated' end as fault,
        class || lead(class) over (partition by conv_id order by i) as pair
    from numbered
), dp as (
    select conv_id, max(i) + 1 as i, {{'c': 0::bigint, 's': ''}} as v0, {{'c': 6::bigint, 's': 'II'}} as v1,
        {{'c': 3::bigint, 's': 'I'}} as v2, {{'c': 0::bigint, 's': ''}} as v3
    from marked group by conv_id
    union all
    select conv_id, i, {', '.join(f"{_WITH_INSERTS[p]} as v{p}" for p in range(4))} from (
        select conv_id, i, {', '.join(f"{_row_edits(p)} as e{p}" for p in range(4))} from (
            select m.*, v0, v1, v2, v3, case when fault = 'truncated' then 3 else 0 end as cut
            from dp join marked m on m.conv_id is not distinct from dp.conv_id and m.i = dp.i - 1
        )
    )
), best as (select conv_id, v0.c as cost, v0.s as audit from dp where i = 1),
letters as (
    select conv_id, j, substr(audit, j, 1) as letter from (select *, unnest(range(1, length(audit) + 1)) as j from best)
), placed as (
    select *, sum((letter <> 'I')::int) over (partition by conv_id order by j) as i,
        sum((letter <> 'D')::int) over (partition by conv_id order by j) as o
    from letters
), steps as (
    select p.*, m.role, m.text, max((letter = 'K' and class = 's')::int) over (partition by p.conv_id) as headed
    from placed p left join marked m on m.conv_id is not distinct from p.conv_id and m.i = p.i and letter <> 'I'
), fixed as (
    select conv_id, sha256(string_agg(case when letter = 'K' then role when (o - headed) % 2 = 1 then 'user'
        else 'assistant' end || ':' || case when letter = 'I' then '' else text end, chr(10) order by j)) as sha
    from steps where letter <> 'D' group by conv_id
), counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
    from marked group by conv_id
)
select c.conv_id, {', '.join(f"coalesce({n}, 0)::bigint as {n}" for n in
    ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))},
    coalesce(audit, '') as audit, coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join counts x on x.conv_id is not distinct from c.conv_id
left join best b on b.conv_id is not distinct from c.conv_id
left join fixed f on f.conv_id is not distinct from c.conv_id
"""
