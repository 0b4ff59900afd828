"""DuckDB SQL for the corpus queries that SQL can express, written from their definitions."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]"

CHAT = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized as (
  select *, row_number() over (partition by conv_id order by turn, role, text) as pos, count(*) over (partition by conv_id) as n,
    length('<|turn|><|text|><|end|>') + length(role) + length(text) + len(regexp_extract_all(role || ' ' || text, '\\'))
      + len(regexp_extract_all(role || ' ' || text, '<\||<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]')) as chars
  from rows
), running as (
  select *, sum(chars) over (partition by conv_id order by pos) as upto from sized
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(upto) filter (where role = 'assistant' or pos = n)::bigint as formatted_chars
from running group by conv_id
"""

QUALITY_RULES = rf"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce(source, '') as host, coalesce(text, '') as body,
    regexp_extract_all(coalesce(text, ''), '{_WORD}+') as words from documents
), windows as (
  select rid, i, array_to_string(words[i:i + 7], ' ') as win from (select rid, words, unnest(range(1, len(words) - 6)) as i from docs where len(words) >= 8)
), twice as (
  select rid, i from (select rid, i, count(*) over (partition by rid, win) as n from windows) where n > 1
), covered as (
  select rid, count(distinct p) as n_repeat_words from (select rid, unnest(range(i, i + 8)) as p from twice) group by rid
), lines as (
  select rid, count(*) - count(distinct line) as n_dup_lines from (select rid, unnest(string_split(body, chr(10))) as line from docs)
  where regexp_matches(line, '{_WORD}') group by rid
), measured as (
  select doc_id, host, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    len(regexp_extract_all(body, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from docs left join covered using (rid) left join lines using (rid)
), failed as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measured
), hosts as (
  select host, count(*) as n, sum(base_failed::int) as f from failed group by host
), moments as (
  select sum(f)::double / sum(n) as mean, sum(n * (f::double / n) * (f::double / n)) / sum(n) as square from hosts
), prior as (
  select mean, case when square - mean * mean > 1e-12 then least(greatest(mean * (1 - mean) / (square - mean * mean) - 1, 1.0), 1000.0) else 1000.0 end as weight
  from moments
), verdicts as (
  select host, (f + mean * weight) / (n + weight) > 0.5 as host_rejected from hosts, prior
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not host_rejected as kept
from failed join verdicts using (host)
"""

LEXICAL_SEARCH = r"""
with docs as (
  select row_number() over () as did, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
), items as (
  select row_number() over () as iid, item_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from benchmark
), total as (
  select count(*) filter (where len(terms) > 0) as n_docs, sum(len(terms))::bigint as n_terms from docs
), wanted as (
  select distinct iid, item_id, translate(unnest(terms), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from items
), counts as (
  select did, doc_id, n, term, count(*)::bigint as tf from (
    select did, doc_id, len(terms)::bigint as n, translate(unnest(terms), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from docs)
  where term in (select term from wanted) group by all
), weights as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w from counts, total group by term
), scored as (
  select iid, item_id, did, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::bigint as score
  from counts join weights using (term) join wanted using (term), total group by all
), ranked as (
  select *, row_number() over (partition by iid order by score desc, doc_id nulls first)::int as rank from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


def _cheapest(*ways: str) -> str:
    """The cheapest of some structs {c: cost, a: audit, o: repaired lines}, then the least audit; null ways do not count."""
    return f"list_min(list_filter([{', '.join(ways)}], lambda w: w is not null))"


def _edit(rest: str, cost: str, letter: str, line: str = "''", when: str = "true") -> str:
    return f"case when {when} then {{'c': {cost} + {rest}.c, 'a': '{letter}' || {rest}.a, 'o': {line} || {rest}.o}} end"


def _before_inserts(state: str, keeps: dict[str, str], turn: str) -> str:
    """Ways on from ``state`` over row r: delete, keep (initial to next state), make it the row that is due."""
    name = "user" if turn == "u" else "assistant"
    stays = "r.fault not in ('blank', 'duplicate')"
    extra = "case when r.fault = 'truncated' then 5 else 0 end"
    kept = [_edit(f"p.{to}", extra, "K", "chr(10) || r.role || ':' || r.text", f"{stays} and r.initial = '{initial}'") for initial, to in keeps.items()]
    return _cheapest(_edit(f"p.{state}", "2", "D"), *kept, _edit(f"p.{turn}", f"1 + {extra}", "R", f"chr(10) || '{name}:' || r.text", stays))


_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, [ascii(c)::bigint for c in string_split({key}, '')]),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

STRUCTURE_REPAIR = rf"""
with recursive marked as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_CRC.format(key="coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind from conversations
), hurt as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(case when kind = 3 then [1, 2] else [1] end) as copy
  from marked where kind != 0
), ordered as (
  select *, substr(role, 1, 1) as initial, row_number() over (partition by conv_id order by turn nulls first, md5(length(role)::varchar || ':' || role || text), copy) as pos,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen from hurt
), faults as (
  select *, lag(initial) over (partition by conv_id order by pos) || initial as pair,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when seen > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault from ordered
), counted as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (where fault = 'blank')::bigint as blank,
    count(*) filter (where fault = 'duplicate')::bigint as duplicate, count(*) filter (where fault = 'truncated')::bigint as truncated,
    count(*) filter (where pair not in ('su', 'ua', 'au'))::bigint as illegal
  from faults group by conv_id
), steps as (
  select conv_id, n + 1 as pos, {{'c': 0::bigint, 'a': '', 'o': ''}} as z, {{'c': 10::bigint, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} as s,
    {{'c': 5::bigint, 'a': 'I', 'o': chr(10) || 'assistant:'}} as u, {{'c': 0::bigint, 'a': '', 'o': ''}} as a from counted
  union all
  select conv_id, pos, {_cheapest('z0', _edit('u1', '5', 'I', "chr(10) || 'user:'"))} as z, {_cheapest('s0', _edit('u1', '5', 'I', "chr(10) || 'user:'"))} as s,
    u1 as u, a1 as a from (
      select *, {_cheapest('u0', _edit('a0', '5', 'I', "chr(10) || 'assistant:'"))} as u1, {_cheapest('a0', _edit('u0', '5', 'I', "chr(10) || 'user:'"))} as a1 from (
        select r.conv_id, r.pos, {_before_inserts('z', {'s': 's', 'u': 'u'}, 'u')} as z0, {_before_inserts('s', {'u': 'u'}, 'u')} as s0,
          {_before_inserts('u', {'a': 'a'}, 'a')} as u0, {_before_inserts('a', {'u': 'u'}, 'u')} as a0
        from steps p join faults r on r.conv_id is not distinct from p.conv_id and r.pos = p.pos - 1))
)
select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(z.c, 0) as cost, coalesce(z.a, '') as audit, sha256(coalesce(substr(z.o, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) i left join counted c on i.conv_id is not distinct from c.conv_id
  left join (select * from steps where pos = 1) t on i.conv_id is not distinct from t.conv_id
"""


def _weight(column: str, weights: dict[str, int]) -> str:
    return "case " + " ".join(f"when {column} = '{k}' then {v}" for k, v in weights.items()) + " else 1 end" if weights else "1"


def _level(name: str, level: str, parents: list[str], source: str, weights: dict[str, int]) -> str:
    """One level of the tree: each parent's budget among its children, up to their caps."""
    group = ", ".join(parents) if parents else "1"
    keys = ", ".join([*parents, level])
    return f"""{name}_in as (
  select {keys}, sum(c.cap) as cap, {_weight(level, weights)} as w, any_value({source}) as budget
  from {'caps c join ' + 'lvl' + str(len(parents)) + ' p using (' + ', '.join(parents) + ')' if parents else 'caps c'} group by {keys}
), {name}_ranked as (
  select *, coalesce(sum(cap) over (partition by {group} order by cap::double / w, {level} rows between unbounded preceding and 1 preceding), 0) as before,
    sum(w) over (partition by {group} order by cap::double / w, {level} rows between current row and unbounded following) as rest_w
  from {name}_in
), {name}_full as (
  select *, cap::hugeint * rest_w <= greatest(budget - before, 0)::hugeint * w as is_full from {name}_ranked
), {name} as (
  select {keys}, case when is_full then cap else (greatest(budget - coalesce(sum(cap) filter (where is_full) over (partition by {group}), 0), 0)::hugeint * w)
    // greatest(coalesce(sum(w) filter (where not is_full) over (partition by {group}), 0), 1) end as budget
  from {name}_full
)"""


def mixing(budget_share: float, max_epochs: int, seed: int, weights: dict[str, dict[str, int]]) -> str:
    return rf"""
with docs as (
  select doc_id, coalesce('dom' || (nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '')::int % 4)::varchar, '') as domain, coalesce(lang, '') as lang,
    coalesce(source, '') as source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+'))::bigint as n_tokens, md5(coalesce(text, '')) as body
  from documents
), leaves as (select domain, lang, source, sum(n_tokens) as n_tokens from docs group by all),
caps as (select *, n_tokens * {max_epochs} as cap from leaves),
{_level('lvl1', 'domain', [], f'(select floor(sum(n_tokens) * {budget_share}) from leaves)', weights.get('domain', {}))},
{_level('lvl2', 'lang', ['domain'], 'p.budget', weights.get('lang', {}))},
{_level('lvl3', 'source', ['domain', 'lang'], 'p.budget', weights.get('source', {}))},
plan as (
  select domain, lang, source, (budget // greatest(n_tokens, 1))::bigint as passes, (budget % greatest(n_tokens, 1))::bigint as rest
  from lvl3 join leaves using (domain, lang, source)
), ordered as (
  select *, sum(n_tokens) over (partition by domain, lang, source order by md5('{seed}:' || passes || ':' || coalesce(doc_id::varchar, '') || ':' || body), doc_id, n_tokens
    rows unbounded preceding) as upto
  from docs join plan using (domain, lang, source)
)
select doc_id, domain, lang, source, n_tokens, passes + (rest > 0 and upto <= rest)::bigint as copies from ordered
where passes + (rest > 0 and upto <= rest)::bigint > 0
"""
