"""DuckDB SQL of the prefix trie, the shards and the vector codes."""

from __future__ import annotations

#: CRC-32 of a list of byte values named `bytes`: each value is taken in, then eight shifts.
CRC32 = """xor(list_reduce(
    list_prepend(4294967295::bigint, flatten(list_transform(bytes, lambda b: list_prepend(b::bigint, [-1, -1, -1, -1, -1, -1, -1, -1]::bigint[])))),
    lambda c, s: case when s >= 0 then xor(c, s) when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end), 4294967295::bigint)"""

PREFIX_TRIE = f"""
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first) as r,
    md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as id,
    octet_length(encode(coalesce(text, ''))) as size
  from conversations where conv_id is not null),
c as (
  select conv_id, conv_id - conv_id % 5 as base, {CRC32} % 9 as h
  from (select distinct conv_id, list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)) as bytes from t)),
rebuilt as (
  select c.conv_id, 0 as own, t.r, t.id, t.size from c join t on t.conv_id = c.base and t.r <= c.h
  union all
  select c.conv_id, 1, t.r, t.id, t.size from c join t on t.conv_id = c.conv_id and t.r > c.h),
prefixes as (
  select conv_id, 0 as depth, '' as k, 0 as size from c
  union all
  select conv_id, row_number() over w, string_agg(id, '') over w, size
  from rebuilt window w as (partition by conv_id order by own, r)),
lasts as (select conv_id, max(depth) as depth from prefixes group by conv_id),
ending as (
  select k, string_agg(conv_id::varchar, ',' order by conv_id) as ids from prefixes semi join lasts using (conv_id, depth) group by k),
nodes as (
  select k, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
    case when depth > 0 then left(k, 32 * (depth - 1)::int) end as up
  from prefixes group by k, depth),
children as (select up as k, count(*) as n from nodes where up is not null group by up),
counted as (
  select nodes.*, coalesce(children.n, 0) as n_children from nodes left join children on children.k = nodes.k),
subtrees as (
  select left(k, (32 * i)::int) as k, sum((n_children = 0)::int) as n_leaves, sum((n_convs - 1) * size) as saved
  from (select *, unnest(range(depth + 1)) as i from counted) group by 1)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs, n.n_children::bigint as n_children,
  s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from counted n join subtrees s on s.k = n.k left join nodes p on p.k = n.up left join ending e on e.k = n.k
"""

SHARDING = f"""
with sized as (
  select doc_id, coalesce(text, '') as text, octet_length(encode(coalesce(text, ''))) + 1 as size from documents),
placed as (
  select *, sum(size) over (order by doc_id nulls first rows unbounded preceding) - size as before, sum(size) over () as total,
    row_number() over (order by doc_id nulls first) as place,
    list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::int) as bytes
  from sized),
cut as (select *, (8 * (2 * before + size)) // (2 * total) as shard from placed)
select doc_id, size::bigint as size, {CRC32}::bigint as text_crc32, 'bytes' as law, shard::int as shard,
  (place - min(place) over (partition by shard))::bigint as slot, null::int as grown_shard
from cut
"""


def _pivot_codes(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    steps = [f"""
kept as materialized (
  select vec_id, label, row_number() over (order by vec_id) as n, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
pieces as materialized (
  select n, q, list_slice(v, q * (len(v) // {parts}) + 1, (q + 1) * (len(v) // {parts})) as p
  from (select *, unnest(range({parts})) as q from kept)),
book0 as materialized (select q, n - 1 as e, p as c from pieces where n <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""
near{k} as materialized (
  select n, q, any_value(p) as p, min(row(list_sum(list_transform(range(1, len(p) + 1), lambda i: (p[i] - c[i]) * (p[i] - c[i])))::bigint, e)) as best
  from pieces join book{k} using (q) group by n, q)""")
        if k < rounds:
            steps.append(f"""
means{k} as (
  select q, e, list((s - ((s % m) + m) % m) // m order by i)::bigint[] as c
  from (
    select q, e, i, sum(x) as s, count(*) as m
    from (select q, best[2] as e, unnest(range(1, len(p) + 1)) as i, unnest(p) as x from near{k}) group by 1, 2, 3)
  group by q, e),
book{k + 1} as materialized (
  select b.q, b.e, coalesce(m.c, b.c) as c from book{k} b left join means{k} m on m.q = b.q and m.e = b.e)""")
    return "with" + ",".join(steps) + f""",
codes as (
  select n, string_agg(printf('%02x', best[2]), '' order by q) as code, sum(best[1]) as error from near{rounds} group by n)
select vec_id, code, error::bigint as error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(array_to_string(c, ','), ',' order by q, e)) from book{rounds}) as codebooks_sha256
from kept join codes using (n)
"""


PIVOT_CODES = _pivot_codes()
