"""DuckDB SQL for the queries of this subpackage that SQL can express.

Word counts, spans, digests and targets follow the contracts' definitions in
SQL's own means: list functions over split texts, windows over the sources, and
a recursive query for the components.
"""

from __future__ import annotations

# Links by brute force over equal labels; components by walking the links.
OP1 = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
), good as (
  select * from v
  where label is not null and e is not null and len(e) > 0
    and len([x for x in e if x is null or not isfinite(x)]) = 0
    and list_aggregate([abs(x) for x in e], 'max') > 0
), link as (
  select a.vec_id as a, b.vec_id as b
  from good a join good b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.93
), reach(node, seen) as (
  select a, b from link
  union
  select r.node, l.b from reach r join link l on l.a = r.seen
)
select v.vec_id,
       (select count(*) from link where link.a = v.vec_id) as n_links,
       least(v.vec_id, coalesce((select min(seen) from reach where reach.node = v.vec_id), v.vec_id)) as component_id,
       v.vec_id = least(v.vec_id, coalesce((select min(seen) from reach where reach.node = v.vec_id), v.vec_id)) as kept
from v
"""

_ESCAPED = r"""
replace(replace(replace(replace(replace(replace(replace(replace(replace(replace({0},
  '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'), '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'),
  '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>'), '<start_of_turn>', '<\start_of_turn>'), '<end_of_turn>', '<\end_of_turn>')
"""

OP5 = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
select conv_id,
       count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(8 + 8 + 8 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}))::bigint as formatted_chars
from c group by conv_id
"""

OP7 = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents
), s as (
  select source, sum(size)::bigint as source_size, count(*) as n,
         ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as weight
  from d group by source
), l as (
  select *, row_number() over w as place,
    (sum(source_size) over () - 3 * coalesce(sum(source_size) over (w rows between unbounded preceding and 1 preceding), 0))::double
      / sum(weight) over (w rows between current row and unbounded following) as level
  from s window w as (order by source_size / weight, source nulls last)
), t as (
  select source, source_size,
    least(coalesce(first_value(level) over (order by case when level * weight <= 3 * source_size then place end nulls last) * weight, 3.0 * source_size), 3.0 * source_size) as target,
    ('0x' || substr(md5('mix-1:' || coalesce('=' || source, 'null')), 1, 8))::ubigint::double / 4294967296.0 as draw
  from l
), p as (
  select d.doc_id, d.size, t.source_size, t.target, t.draw,
         case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
         row_number() over (partition by d.source order by d.size, d.doc_id nulls first) - 1 as place
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       ((floor(draw + rate * (place + 1)) - floor(draw + rate * place))::bigint * size)::bigint as taken
from p
"""

_RULES = (
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)


def _spans(kind: str, pattern: str, group: int, least: int, k: int) -> str:
    return f"""
  select doc_id, {k} as k, '{kind}' as kind,
         (list_sum([length(x) for x in gaps[1:i]]) + list_sum([length(x) for x in found[1:i]]) - length(found[i]))::bigint as s,
         (list_sum([length(x) for x in gaps[1:i]]) + list_sum([length(x) for x in found[1:i]]))::bigint as e,
         length(vals[i]) >= {least} as good
  from (
    select doc_id, string_split_regex(t, '{pattern}') as gaps, regexp_extract_all(t, '{pattern}') as found,
           regexp_extract_all(t, '{pattern}', {group}) as vals
    from (select doc_id, coalesce(text, '') as t from documents)
  ), lateral (select unnest(range(1, len(found) + 1)) as i)
  where length(vals[i]) >= {least}
"""


OP10 = f"""
with spans as ({" union all ".join(_spans(*r, k) for k, r in enumerate(_RULES))}
), joined as (
  select doc_id, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access,
         count(*) filter (where k = 2) as n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' order by s, k) as spans
  from spans group by doc_id
)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
       coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join joined j on d.doc_id = j.doc_id
"""

# Members by the digests of their turns, chained; subtrees by walking every node's own prefixes.
OP11 = """
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) - 1 as pos
  from conversations where conv_id is not null
), c as (
  select conv_id, conv_id - conv_id % 5 as base, count(*) as n,
         xor(list_reduce([ord(x) for x in string_split(conv_id::varchar, '')]::ubigint[],
           lambda a, b: list_reduce(range(8)::ubigint[], lambda r, i: xor(r >> 1, 3988292384::ubigint * (r & 1)), xor(a, b)),
           4294967295::ubigint), 4294967295::ubigint) % 9 as h
  from t group by conv_id
), r as (
  select c.conv_id, t.pos, t.role, t.text from c join t on t.conv_id = c.base where t.pos < c.h
  union all
  select c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.role, t.text
  from c join t on t.conv_id = c.conv_id left join c b on b.conv_id = c.base where t.pos >= c.h
), m as (
  select conv_id, (pos + 1)::bigint as depth, strlen(text) as bytes,
         md5(string_agg(md5(length(role) || ':' || role || ':' || text), '' order by pos)
             over (partition by conv_id order by pos rows between unbounded preceding and current row)) as k
  from r
  union all select conv_id, 0, 0, '' from c
), n as (
  select k, depth, min(conv_id) as conv_id, count(*) as n_convs, min(bytes) as bytes from m group by k, depth
), p as (
  select n.k, u.k as parent, un.conv_id as parent_conv_id
  from n join m u on u.conv_id = n.conv_id and u.depth = n.depth - 1 join n un on un.k = u.k and un.depth = u.depth
), leaf as (
  select n.*, (select count(*) from p where p.parent = n.k) as n_children from n
), s as (
  select m.k, m.depth, count(*) filter (where l.n_children = 0) as n_leaves, sum((l.n_convs - 1) * l.bytes)::bigint as saved_tokens
  from leaf l join m on m.conv_id = l.conv_id and m.depth <= l.depth group by m.k, m.depth
), e as (
  select k, depth, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from m where depth = (select max(depth) from m x where x.conv_id = m.conv_id) group by k, depth
)
select l.conv_id, l.depth, p.parent_conv_id, l.n_convs, l.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from leaf l join s on s.k = l.k and s.depth = l.depth left join p on p.k = l.k left join e on e.k = l.k and e.depth = l.depth
"""

ORACLE = {
    "op1_embedding_near_dedup": OP1,
    "op5_chat_formatting": OP5,
    "op7_source_mixing": OP7,
    "op10_secret_scan": OP10,
    "op11_prefix_trie": OP11,
}
