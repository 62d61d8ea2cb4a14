"""DuckDB twins of the queries that SQL can say."""

from __future__ import annotations

_ORDERED = """
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as place
  from {rows}
)"""

#: crc32 by its table of 256 steps, of which each is eight shifts.
_CRC = """
steps as (
  select list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from (select unnest(generate_series(0, 255)) as i)
),
heads as (
  select conv_id, conv_id - conv_id % 5 as first_id,
    xor(list_reduce(list_concat([4294967295], [ord(x)::bigint for x in string_split(conv_id::varchar, '')]),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 9 as h
  from (select distinct conv_id from conversations where conv_id is not null), steps
)"""

PREFIX_TRIE = f"""
with {_ORDERED.format(rows="conversations").strip()},
{_CRC.strip()},
whole as (
  select conv_id, role, text, row_number() over (partition by conv_id order by own, place) as depth
  from (
    select h.conv_id, 0 as own, place, role, text from heads h join turns t on t.conv_id = h.first_id and place <= h.h
    union all
    select h.conv_id, 1 as own, place, role, text from heads h join turns t on t.conv_id = h.conv_id and place > h.h)
),
paths as (
  select conv_id, depth, strlen(text) as size,
    md5(string_agg(md5(strlen(role) || ':' || role || text), '') over (partition by conv_id order by depth)) as node
  from whole
  union all
  select conv_id, 0, 0, '' from heads
),
lengths as (select conv_id, max(depth) as length from paths group by conv_id),
steps_up as (
  select node, depth, size, conv_id, lag(node) over (partition by conv_id order by depth) as parent,
    depth = length as ends
  from paths join lengths using (conv_id)
),
nodes as (
  select node, any_value(depth) as depth, any_value(size) as size, any_value(parent) as parent,
    min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from steps_up group by node
),
children as (select parent as node, count(*) as n from nodes where parent is not null group by parent),
below as (
  select distinct a.node as top, b.node from paths a join paths b on a.conv_id = b.conv_id and a.depth <= b.depth
),
sums as (
  select top, count(*) filter (where c.n is null) as n_leaves, sum((n_convs - 1) * size) as saved
  from below join nodes using (node) left join children c using (node) group by top
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children,
  s.n_leaves, s.saved::bigint as saved_tokens, n.ends_sha256
from nodes n join sums s on s.top = n.node left join nodes p on p.node = n.parent left join children c on c.node = n.node
"""

CHAT_FORMAT = f"""
with spoken as (
  select conv_id, turn, role, text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
{_ORDERED.format(rows="spoken").strip()}
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(role) + length(text) + 24
    + len(regexp_extract_all(text, '<\\\\*\\|(im_start|im_end|endoftext)\\|>')))::bigint as formatted_chars
from turns group by conv_id
"""
