"""DuckDB SQL of the llm queries that SQL can express."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text."""
    step = "list_reduce(list_prepend(xor(c, b), range(8)::ubigint[]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    codes = f"list_transform(string_split({text}, ''), lambda t: ascii(t)::ubigint)"
    return f"xor(list_reduce(list_prepend(4294967295::ubigint, {codes}), lambda c, b: {step}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tree(name: str, nodes: str) -> str:
    """The levels above `nodes` (grp, idx, n, digest), and each node's run as `before,after`."""
    return f"""
{name} as (
  select 0 as level, grp, idx, n, digest from {nodes}
  union all
  select level + 1, grp, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by idx)) from {name} where n > 1
  group by level, grp, idx // 16, n),
{name}_runs as (
  select a.level, a.grp, a.idx, coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx < a.idx), '') || ',' ||
    coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx > a.idx), '') as run
  from {name} a join {name} b on a.level = b.level and a.grp is not distinct from b.grp and a.idx // 16 = b.idx // 16
  where a.n > 1 group by all),
{name}_paths as (
  select p.grp, p.idx, list(r.run order by r.level) as path from {nodes} p
  join {name}_runs r on p.grp is not distinct from r.grp and p.idx // (16 ** r.level)::bigint = r.idx group by all)"""


MERKLE = f"""
with recursive rows as (
  select *, {_leaf("text")} as leaf,
    case when {_crc32("doc_id::varchar")} % 5 = 0 then {_leaf(LOWER)} else {_leaf("text")} end as other from documents),
leaves as (
  select *, source as grp, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx,
    count(*) over (partition by source) as n, leaf as digest from rows),
{_tree("low", "leaves")},
subroots as (
  select 0 as grp, row_number() over (order by encode(grp) nulls first) - 1 as idx, count(*) over () as n, digest, grp as source from low where n = 1),
{_tree("high", "subroots")},
found as (
  select l.*, s.digest as subroot, (select digest from high where n = 1) as root,
    list_concat(coalesce(a.path, []), coalesce(b.path, [])) as path
  from leaves l join subroots s on l.source is not distinct from s.source
  left join low_paths a on a.grp is not distinct from l.grp and a.idx = l.idx left join high_paths b on b.idx = s.idx)
select doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), ',', '')) as proof_sha256, folded as folded_root, folded = root as verified
from (select *, list_reduce(list_prepend(other, path), lambda d, run: sha256(split_part(run, ',', 1) || d || split_part(run, ',', 2))) as folded from found)
"""


def _edit(price: str, letter: str, line: str, after: str) -> str:
    """Taking an edit whose line is followed by what `after` (costs c, audit a, lines l) holds."""
    lines = f"{after}.l" if letter == "D" else f"{line} || coalesce(chr(10) || {after}.l, '')"
    return f"struct_pack(c := {price} + {after}.c, a := '{letter}' || {after}.a, l := {lines})"


def _conversation_step() -> str:
    """One row before what acc.v holds for the states: nothing yet, system, user, assistant."""
    follows, roles = (3, 3, 4, 3), {3: "user", 4: "assistant"}
    keeps = ({"s": 2, "u": 3}, {"u": 3}, {"a": 4}, {"u": 3})
    stay = "case when x.f = 3 then 5 else 0 end"
    states, filled = [], []
    for state in range(4):
        after = follows[state]
        kept = " ".join(f"when x.k = '{k}' then {_edit(stay, 'K', 'x.r || chr(58) || x.t', f'acc.v[{to}]')}" for k, to in keeps[state].items())
        stays = f"case when x.f not in (1, 2) then {{}} end"  # noqa: F541
        moved = _edit(f"1 + {stay}", "R", f"'{roles[after]}:' || x.t", f"acc.v[{after}]")
        states.append(f"list_min([{_edit('2', 'D', '', f'acc.v[{state + 1}]')}, {stays.format(f'case {kept} end')}, {stays.format(moved)}])")
        one = _edit("5", "I", f"'{roles[after]}:'", f"w[{after}]")
        again = follows[after - 1]
        two = _edit("5", "I", f"'{roles[after]}:'", f"({_edit('5', 'I', chr(39) + roles[again] + ':' + chr(39), f'w[{again}]')})")
        filled.append(f"list_min([w[{state + 1}], {one}, {two}])")
    return f"struct_pack(k := x.k, f := x.f, r := x.r, t := x.t, v := list_transform([[{', '.join(states)}]], lambda w: [{', '.join(filled)}])[1])"


_FIRST = ("struct_pack(k := '', f := 0, r := '', t := '', v := [struct_pack(c := 0, a := '', l := null::varchar), "
          "struct_pack(c := 10, a := 'II', l := 'user:' || chr(10) || 'assistant:'), struct_pack(c := 5, a := 'I', l := 'assistant:'), struct_pack(c := 0, a := '', l := null::varchar)])")
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_KEY = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"

CONVERSATIONS = f"""
with hit as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_crc32(_KEY)} % 20 as damage from conversations),
damaged as (
  select conv_id, turn, case when damage = 4 then 'user' else role end as role,
    case damage when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from (select *, unnest(range(case when damage = 3 then 2 else 1 end)) from hit) where damage <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, encode(role), encode(text)) as place from damaged),
told as (
  select *, left(role, 1) as k, rtrim(text, {_WHITE}) as ended, row_number() over (partition by conv_id, role, text order by place) > 1 as seen from placed),
faulty as (select *, case when ended = '' then 1 when seen then 2 when right(ended, 1) not in ('.', '!', '?') then 3 else 0 end as f from told),
pairs as (select *, lag(k) over (partition by conv_id order by place) as k0 from faulty),
folded as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (f = 1) as blank, count(*) filter (f = 2) as duplicate,
    count(*) filter (f = 3) as truncated, count(*) filter (k0 is not null and k0 || k not in ('su', 'ua', 'au')) as illegal,
    list_reduce(list(struct_pack(k := k, f := f, r := role, t := text, v := null::struct(c integer, a varchar, l varchar)[]) order by place desc),
      lambda acc, x: {_conversation_step()}, {_FIRST}).v[1] as best
  from pairs group by conv_id)
select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(best.c, 0)::bigint as cost, coalesce(best.a, '') as audit, sha256(coalesce(best.l, '')) as repaired_sha256
from (select distinct conv_id from conversations) i left join folded d on i.conv_id is not distinct from d.conv_id
"""

REPEATS = """
with bytes as (select doc_id, hex(encode(coalesce(text, ''))) as x, octet_length(encode(coalesce(text, ''))) as n from documents),
blocks as (select doc_id, x, n, unnest(range(0, greatest(n - 49, 0), 500)) as base from bytes),
pieces as (select doc_id, base, substr(x, 2 * base + 1, 1098) as piece, least(500, n - 49 - base) as starts from blocks),
places as (select doc_id, base, piece, unnest(range(starts)) as k from pieces),
strings as (select doc_id, base + k as p, substr(piece, 2 * k + 1, 100) as s from places),
firsts as (select s, min(doc_id) as first from strings group by s having min(doc_id) < max(doc_id)),
hits as (select doc_id, p, lag(p) over (partition by doc_id order by p) as before from strings join firsts using (s) where doc_id > first),
numbered as (select doc_id, p, sum(case when before is null or p > before + 50 then 1 else 0 end) over (partition by doc_id order by p) as run from hits),
runs as (select doc_id, min(p) as a, max(p) + 50 as b from numbered group by doc_id, run),
cuts as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as s, a as e from runs
  union all select d.doc_id, coalesce(max(r.b), 0), any_value(d.n) from bytes d left join runs r using (doc_id) group by d.doc_id),
kept as (select c.doc_id, string_agg(substr(x, 2 * s + 1, 2 * (e - s)), '' order by s) as x from cuts c join bytes using (doc_id) group by c.doc_id),
sums as (select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans from runs group by doc_id)
select d.doc_id, d.n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(k.x)) as kept_sha256
from bytes d join kept k using (doc_id) left join sums using (doc_id)
"""
