"""DuckDB SQL that gives the rows of the registered queries which SQL can express.

Each is written from the contract of its query, in the plainest way: a sort where the operator refines histograms, a walk from
blocked addresses where it finds components.
"""

from __future__ import annotations

from collections.abc import Sequence

from .url_filter import Rule

#: One match for each place where the chat template escapes a control string, escaped or not.
_CONTROL = r"<\\*(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|</?SYS>>)|\[\\*/?INST\]"

CHAT = rf"""
with c as (
  select conv_id::bigint as conv_id, turn::bigint as turn, role, text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as i,
    coalesce(role, '') as role, coalesce(text, '') as text, replace(replace(coalesce(role, ''), '%', '%25'), chr(10), '%0A') as shown
  from c
), g as (
  select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by i) as told,
    coalesce(string_agg(text, '' order by i) filter (where role = 'assistant'), '') as learned,
    sum(length('<|im_start|>') + length(shown) + len(regexp_extract_all(shown, '{_CONTROL}')) + 1
      + length(text) + len(regexp_extract_all(text, '{_CONTROL}')) + length('<|im_end|>') + 1) as chars
  from t group by conv_id
)
select conv_id, n_turns, sha256(told) as turns_sha256, length(learned)::bigint as loss_chars, sha256(learned) as loss_sha256, chars::bigint as formatted_chars from g
"""

MIXING = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as h
  from documents
), s as (
  select source, sum(size)::double as n, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight from d group by source
), r as (
  select *, 2 * n / weight as ratio,
    (1.5 * sum(n) over () - coalesce(sum(2 * n) over (order by 2 * n / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by 2 * n / weight, source nulls last rows between current row and unbounded following) as level
  from s
), t as (
  select source, n, least(2 * n, coalesce(weight * max(level) filter (where level <= ratio) over (), 2 * n)) as target from r
), p as (
  select *, case when n > 0 then floor(target / n) else 0 end as passes from t
), u as (
  select d.*, p.n, p.target, p.passes, p.target - p.passes * p.n as rest, sum(d.size) over (partition by d.source order by d.h) as upto, sum(d.size) over (partition by d.source, d.h) as cell
  from d join p on d.source is not distinct from p.source
)
select doc_id, size, n::bigint as source_size, target, (case when size = 0 then 0
  when upto < rest or (upto - cell < rest and 2 * (rest - upto + cell) >= cell) then passes + 1 else passes end * size)::bigint as taken
from u
"""


#: Revisits of the derived records, by an as-of join over plain rows.
REVISITS = r"""
with p as (
  select page_id, 1704067200 + (coalesce(page_id, 0) * 7919) % 2592000 as sec, '"' || left(sha256(coalesce(html, '')), 8) || '"' as tag,
    regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as bare, url
  from pages
), c as (
  select page_id, sec, tag, case when url is not null then regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '')
    || case when regexp_matches(bare, '^[^/?]*/') then '' else '/' end || regexp_extract(bare, '(?s)^[^/?]*(.*)$', 1) end as canonical
  from p
), full_ as (
  select canonical, sec, max(page_id * 4) as original, arg_max(tag, page_id) as tag from c where canonical is not null group by canonical, sec
), revisits as (
  select page_id * 4 + 1 as record_id, canonical, sec + 86400 as sec, tag, 'W/' || tag as etag, 'max-age=90' as cache_control from c
  union all
  select page_id * 4 + 2, canonical, sec + 172800, case when page_id % 5 = 0 then '"changed"' else tag end, case when page_id % 5 = 0 then '"changed"' else tag end, 'max-age=60' from c
), j as (
  select r.*, f.original, f.tag as found from revisits r asof left join full_ f on r.canonical = f.canonical and r.sec > f.sec
), s as (
  select *, case when original is null then 'missing' when tag = found then 'resolved' else 'mismatch' end as status from j
)
select record_id, canonical, sec::bigint as captured_at, status, case when status = 'resolved' then original end as original_id, case when status = 'resolved' then etag end as etag,
  case when status = 'resolved' then cache_control end as cache_control, case when status = 'resolved' then 'text/html' end as content_type
from s
"""


def _node(url: str) -> str:
    """SQL for an address without fragment and default port, scheme and host in lower case."""
    host = rf"regexp_replace({_host(url)}, ':(80|443)?$', '')"
    return rf"case when {host} <> '' then lower(coalesce(regexp_extract({url}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1), '')) || '://' || {host} || case when {_path(url)} = '' then '/' else {_path(url)} end || regexp_extract({url}, '(?s)\A[^?#]*(\?[^#]*)', 1) end"


def _spelled(url: str) -> str:
    """SQL for the spelling that servers redirect to."""
    host = rf"regexp_replace(regexp_replace({_host(url)}, '^www\.', ''), ':(80|443)?$', '')"
    path = rf"regexp_replace(regexp_replace(regexp_replace({_path(url)}, '/+$', ''), '\.html$', ''), '/index$', '')"
    query = rf"array_to_string(list_sort(list_filter(string_split(regexp_extract({url}, '(?s)\A[^?#]*\?([^#]*)', 1), '&'), lambda q: q <> '' and split_part(q, '=', 1) <> 'ref' and not starts_with(split_part(q, '=', 1), 'utm_'))), '&')"
    return f"case when {host} <> '' then 'https://' || {host} || {path} || case when {query} <> '' then '?' || {query} else '' end end"


def _host(url: str) -> str:
    return rf"translate(coalesce(regexp_extract({url}, '(?s)\A.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _path(url: str) -> str:
    return rf"coalesce(regexp_extract({url}, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '')"


def url_verdicts(rules: Sequence[Rule]) -> str:
    """SQL for the verdicts of all pages under ``rules``: the longest rule, else block for what a blocked address reaches.

    Of links in html, all canonical and refresh tags outside comments and scripts with an address in full or from the root are read; other
    relative forms are left to the test against a parser.
    """
    longest = sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict))
    fits = [f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')" for r in longest]
    name = " ".join(f"{f} then '{r.name}'" for f, r in zip(fits, longest, strict=True))
    verdict = " ".join(f"{f} then '{r.verdict}'" for f, r in zip(fits, longest, strict=True))
    return rf"""
with recursive p as (
  select page_id, url, html, {_host("url")} as host, {_path("url")} as path, {_node("url")} as node from pages
), j as (
  select page_id, host, path, node, case {name} end as rule, case {verdict} end as own from p
), shown as (
  select url, node, regexp_replace(regexp_replace(html, '(?s)<!--.*?(-->|\z)', '', 'g'), '(?is)<(?:script|style)\b[^>]*>.*?</(?:script|style)', '', 'g') as html from p
), tags as (
  select url, node, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\s(?:"[^"]*"|''[^'']*''|[^''">])*>')) as tag,
    nullif(regexp_extract(html, '(?is)<base\s(?:[^>]*?\s)?href\s*=\s*["'']?\s*([^"''\s>]+)', 1), '') as base from shown
), valued as (
  select *, regexp_extract(tag, '(?is)\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^"''\s>]+))', ['q', 's', 'n']) as h,
    regexp_extract(tag, '(?is)\srel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^"''\s>]+))', ['q', 's', 'n']) as r from tags
), goals as (
  select url, coalesce(base, url) as base, node, replace(trim(replace(h.q || h.s || h.n, '&amp;', '&')), ' ', '%20') as t from valued
    where regexp_matches(tag, '(?is)\A<link') and list_contains(string_split(lower(r.q || r.s || r.n), ' '), 'canonical')
  union all
  select url, coalesce(base, url), node, replace(regexp_extract(tag, '(?is)url\s*=\s*["'']?\s*([^"''\s>]+)', 1), '&amp;', '&') from tags where regexp_matches(tag, '(?is)\A<meta.*\shttp-equiv\s*=\s*["'']?refresh')
), links as (
  select node as a, case when starts_with(t, '//') then split_part(base, '//', 1) || t when starts_with(t, '/') then split_part(base, '://', 1) || '://' || {_host("base")} || t else t end as goal from goals where t <> ''
), named as (
  select a, {_node("goal")} as b from links union select node, {_node(_spelled("url"))} from p
), both_ways as (
  select a, b from named where a <> b union select b, a from named where a <> b
), named_only as (
  select a, {_host("a")} as host, {_path("a")} as path from both_ways
), reached(node) as (
  select node from j where own = 'block' and node is not null union select a from named_only where case {verdict} end = 'block' union select e.b from reached r join both_ways e on e.a = r.node
)
select page_id, host, path, rule, coalesce(own, case when node in (select node from reached) then 'block' else 'allow' end) as verdict from j
"""


#: crc32 by its table of 256 entries, made by the eight steps of each.
RESAMPLING = r"""
with steps as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc
), words as (
  select 'd' as side, doc_id as id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from documents
  union all
  select 'b', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark
), named as (
  select w, hex(encode(w)) as h from (select distinct w from words)
), hashed as (
  select w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::bigint)), lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295) % 10000 as bucket
  from named, steps
), counts as (
  select bucket, count(*) filter (side = 'd')::double as s, count(*) filter (side = 'b')::double as t from words join hashed using (w) group by bucket
), gains as (
  select bucket, floor(1000 * ln((t + 1) * ((select sum(s) from counts) + 10000) / ((s + 1) * ((select sum(t) from counts) + 10000)))) as gain from counts
), weights as (
  select id, count(*) as n, floor(sum(gain) / count(*))::bigint as weight from words join hashed using (w) join gains using (bucket) where side = 'd' group by id
), scored as (
  select doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from documents left join weights on id = doc_id
), ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as able from scored where n_features >= 20
)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score::bigint as score, case when place <= able * 10 // 100 then place end::bigint as rank
from scored left join ranked using (doc_id)
"""

NEGATIVES = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), positives as (
  select * from pairs where same qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.other_id as positive_id, row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id)::int as rank,
  n.other_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) <= 3
"""

REPEATS = r"""
with d as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents
), windows as (
  select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) as h from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d)
), repeated as (
  select doc_id, i from windows qualify row_number() over (partition by h order by doc_id, i) > 1
), gone as (
  select distinct doc_id, unnest(range(i, i + 20)) as i from repeated
), words as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from d
), kept as (
  select doc_id, string_agg(word, ' ' order by i) as kept, count(*) as n from words anti join gone using (doc_id, i) group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, len(d.w) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (doc_id)
"""
