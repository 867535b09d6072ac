"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

import string

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def crc32(key: str) -> str:
    """The unsigned crc32 of the bytes of an ASCII text, bit by bit."""
    byte = "lambda x, y: xor(x >> 1, (x & 1) * 3988292384::bigint)"
    values = f"list_transform(range(1, strlen({key}) + 1), lambda i: ascii({key}[i])::bigint)"
    step = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), {byte})"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, {values}), {step}))"


def told(column: str) -> str:
    return f"coalesce(strlen({column}) || ':' || {column}, '-')"


def leaf(text: str) -> str:
    columns = ("cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text)
    return f"sha256({' || '.join(map(told, columns))})"


EXACT_DEDUP = """
    with d as (select doc_id, coalesce(text, '') as text from documents),
    g as (select text, max(doc_id) as keep_id, count(*) as group_size from d group by text)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(d.text) as text_sha256
    from d join g on d.text = g.text
"""

LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"
MERKLE = f"""
with recursive keyed as (select *, coalesce(cast(doc_id as varchar), '') as key from documents),
made as (
  select doc_id, source, {leaf('text')} as leaf, {leaf(LOWERED)} as lowered, {crc32("key")} % 5 = 0 as tampered from keyed),
placed as (
  select *, row_number() over (order by source nulls first, doc_id nulls first, leaf) as row,
    dense_rank() over (order by source nulls first) - 1 as tree,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as rank, count(*) over (partition by source) as size from made),
below as (
  select tree, 0 as h, rank as idx, leaf as digest, size as n from placed
  union all
  select tree, h + 1, idx >> 4, sha256(string_agg(digest, '' order by idx)), (n + 15) // 16 from below where n > 1 group by tree, h, idx >> 4, n),
subroots as (select tree, h as height, digest as subroot from below where n = 1),
above as (
  select 0 as h, tree as idx, subroot as digest, count(*) over () as n from subroots
  union all
  select h + 1, idx >> 4, sha256(string_agg(digest, '' order by idx)), (n + 15) // 16 from above where n > 1 group by h, idx >> 4, n),
nodes as (select tree, h, idx, digest, n from below union all select -1, h, idx, digest, n from above),
levels as (select distinct tree, h from nodes where n > 1),
steps as (
  select row, h as step, p.tree, h, rank >> (4 * h) as idx from placed p join levels l on l.tree = p.tree
  union all
  select row, height + h, -1, h, p.tree >> (4 * h) from placed p join subroots using (tree), levels l where l.tree = -1),
runs as (
  select row, step, nodes.idx, digest, nodes.idx = steps.idx as own from steps
  join nodes on nodes.tree = steps.tree and nodes.h = steps.h and nodes.idx >> 4 = steps.idx >> 4),
proofs as (select row, sha256(coalesce(string_agg(digest, '' order by step, idx) filter (not own), '')) as proof from runs group by row),
folds as (
  select row, 0 as step, case when tampered then lowered else leaf end as here from placed
  union all
  select f.row, f.step + 1, sha256(string_agg(case when own then here else digest end, '' order by idx))
  from folds f join runs r on r.row = f.row and r.step = f.step group by f.row, f.step)
select doc_id, leaf, subroot, (select digest from above where n = 1) as root, coalesce(proof, sha256('')) as proof_sha256, folded_root,
  folded_root = (select digest from above where n = 1) as verified
from placed join subroots using (tree) left join proofs using (row)
  join (select row, arg_max(here, step) as folded_root from folds group by row) using (row)
"""

#: Edits before and at a row: state before, inserts, edit, first letter of the role (null: any), state after, cost.
WANTED, AFTER = "uuau", {"0s": 1, "0u": 2, "1u": 2, "2a": 3, "3u": 2}


def _edits() -> list[str]:
    rows = []
    for state in range(4):
        here = state
        for inserts in range(3):
            here = here if not inserts else AFTER[f"{here}{WANTED[here]}"]
            rows.append(f"({state}, {inserts}, 'D', null, {here}, {2 * inserts + 3})")
            rows += [f"({state}, {inserts}, 'K', '{i}', {AFTER[f'{here}{i}']}, {2 * inserts})" for i in "sua" if f"{here}{i}" in AFTER]
            rows.append(f"({state}, {inserts}, 'R', null, {AFTER[f'{here}{WANTED[here]}']}, {2 * inserts + 2})")
    return rows


BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
REPAIR = f"""
with recursive
keyed as (select *, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations),
fated as (select conv_id, coalesce(cast(conv_id as varchar), '') as conv, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc32("key")} % 20 as fate from keyed),
damaged as (
  select conv, turn, case when fate = 4 then 'user' else role end as role,
    case fate when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case fate when 0 then [] when 3 then [0, 1] else [0] end) as copy from fated),
ordered as (
  select *, row_number() over (partition by conv order by turn nulls first, role, sha256(conv || ':' || strlen(role) || ':' || role || text), copy) - 1 as pos,
    rtrim(text, {BLANKS}) as bare from damaged),
judged as (
  select *, case when bare = '' then 'b' when row_number() over (partition by conv, role, text order by pos) > 1 then 'd'
    when bare[-1] not in ('.', '!', '?') then 't' else '' end as fault, left(role, 1) as initial, left(lead(role) over (partition by conv order by pos), 1) as next from ordered),
edits(before, inserts, edit, initial, after, cost) as (values {", ".join(_edits())}),
ends(before, inserts) as (values (0, 0), (1, 2), (2, 1), (3, 0)),
sizes as (select conv, count(*) as n from judged group by conv),
paths as (
  select conv, cast(0 as bigint) as pos, 0 as state, struct_pack(cost := 0, audit := '') as best from sizes
  union all
  select p.conv, p.pos + 1, e.after, min(struct_pack(cost := p.best.cost + e.cost + case when r.fault = 't' and e.edit <> 'D' then 1 else 0 end,
    audit := p.best.audit || repeat('I', e.inserts) || e.edit))
  from paths p join judged r on r.conv = p.conv and r.pos = p.pos join edits e on e.before = p.state
  where e.edit = 'D' or r.fault not in ('b', 'd') and (e.edit = 'R' or e.initial = r.initial)
  group by p.conv, p.pos + 1, e.after),
solved as (
  select conv, min(struct_pack(cost := best.cost + 2 * inserts, audit := best.audit || repeat('I', inserts))) as best
  from paths join sizes using (conv) join ends on before = state where pos = n group by conv),
marks as (select conv, best.audit as audit, unnest(range(1, length(best.audit) + 1)) as place from solved),
placed as (
  select conv, place, audit[place] as edit, length(replace(audit[1:place - 1], 'I', '')) as pos,
    length(replace(audit[1:place - 1], 'D', '')) as kept from marks),
emitted as (
  select m.conv, place, kept, case when edit <> 'I' then text else '' end as text, case when edit = 'K' then role end as given,
    max(case when edit = 'K' and kept = 0 and initial = 's' then 1 else 0 end) over (partition by m.conv) as system
  from placed m left join judged r on r.conv = m.conv and r.pos = m.pos where edit <> 'D'),
digests as (
  select conv, sha256(string_agg(coalesce(given, case when (kept - system) % 2 = 0 then 'user' else 'assistant' end) || ':' || text, chr(10) order by place)) as digest
  from emitted group by conv),
counts as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
    count(*) filter (fault = 't') as truncated, count(*) filter (next is not null and initial || next not in ('su', 'ua', 'au')) as illegal from judged group by conv)
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, cast(coalesce(best.cost, 0) as bigint) as cost, coalesce(best.audit, '') as audit, coalesce(digest, sha256('')) as repaired_sha256
from (select distinct conv_id, conv from fated) left join counts using (conv) left join solved using (conv) left join digests using (conv)
"""


def _attribute(name: str) -> str:
    pattern = rf"""(?i)[\s"''/]{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''<>]+))"""
    parts = ", ".join(f"regexp_extract(tag, '{pattern}', {group})" for group in (1, 2, 3))
    return f"replace(concat({parts}), '&amp;', '&') as {name.replace('-', '_')}"


ATTRIBUTES = ", ".join(map(_attribute, ("rel", "href", "http-equiv", "content")))
URLS = rf"""
with recursive
given as (select page_id, url, html, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
seen as (
  select page_id, url, html, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), '{UPPER}', '{LOWER}') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) as query from given),
tags as (select url, host, path, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^<>]*>')) as tag from seen),
attributes as (
  select *, {ATTRIBUTES} from tags),
targets as (
  select url, host, path, trim(case when regexp_matches(' ' || lower(rel) || ' ', '\scanonical\s') then href
    when lower(http_equiv) = 'refresh' then regexp_extract(content, '(?i)^[0-9.\s]*[;,]\s*url\s*=\s*["'']?([^"'']*)', 1) else '' end) as target from attributes),
whole as (
  select url, case when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') then target
    when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') or host = '' or target[1] = '#' then null
    when starts_with(target, '//') then split_part(url, '://', 1) || ':' || target
    else split_part(url, '://', 1) || '://' || host || case target[1] when '/' then '' when '?' then path
      else case when path = '' then '/' else regexp_extract(path, '^(.*/)?') end end || target end as target from targets where target <> ''),
split_targets as (select url, case when strpos(target, '://') > 0 then substr(target, strpos(target, '://') + 3) else '' end as rest from whole where target is not null),
linked as (
  select url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
    regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) as query from split_targets),
addressed as (select *, case when host <> '' then host || case when path = '' then '/' else path end || coalesce(query, '') end as address from seen),
linked_to as (select url, host, path, case when host <> '' then host || case when path = '' then '/' else path end || coalesce(query, '') end as address from linked),
edges as (select distinct a.address as a, l.address as b from linked_to l join addressed a on a.url = l.url where a.address is not null and l.address is not null),
both_ways as (select a, b from edges union select b, a from edges),
reach as (select a as node, a as other from both_ways union select reach.node, b from reach join both_ways on other = a),
known as (select distinct address, host, path from (select address, host, path from addressed union all select address, host, path from linked_to) where address is not null),
rules(decision, rule_host, rule_path) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
ruled as (
  select host, path, max(struct_pack(length := length(rule_host || rule_path), allowed := decision = 'allow', rule := rule_host || rule_path, decision := decision)) as best
  from (select distinct host, path from known) join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by host, path),
classed as (
  select known.*, coalesce(least_other, address) as class, best.rule as rule, best.decision as decision from known
  left join (select node, min(other) as least_other from reach group by node) on node = address left join ruled using (host, path)),
shared as (select class, min(decision) as shared from classed where decision is not null group by class)
select page_id, s.host, s.path, rule, coalesce(decision, shared, 'allow') as verdict, s.address, c.class
from addressed s left join classed c on c.address = s.address and c.path = s.path left join shared using (class)
"""

ORACLE: dict[str, str] = {
    "op1_exact_dedup": EXACT_DEDUP, "op11_merkle_manifest": MERKLE, "op12_conversation_repair": REPAIR, "op13_url_filter": URLS,
}
