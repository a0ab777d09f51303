"""DuckDB SQL of this subpackage's queries, over the same tables."""

from __future__ import annotations

_COMPONENTS = """
walk(node, seen) as (
  select id, id from nodes
  union
  select w.node, l.v from walk w join links l on l.u = w.seen
)"""

OP2 = f"""
with recursive vecs as (
  select vec_id, embedding::double[] as x from embeddings
), nodes as (
  select vec_id as id, x,
    x is not null and len(x) > 0 and len(list_filter(x, lambda v: v is null or not isfinite(v))) = 0
      and coalesce(list_max(list_transform(x, lambda v: abs(v))), 0) > 0 as sound
  from vecs
), links as (
  select a.id as u, b.id as v from nodes a join nodes b
    on a.id <> b.id and a.sound and b.sound and len(a.x) = len(b.x) and list_cosine_similarity(a.x, b.x) >= 0.9
), {_COMPONENTS}
select n.id as vec_id, (select count(*) from links where u = n.id) as n_links,
  min(w.seen) as component_id, n.id = min(w.seen) as kept
from nodes n join walk w on w.node = n.id group by n.id
"""

OP3 = f"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents
), sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s
  from words
), flat as (
  select doc_id, unnest(s) as x from sets
), nodes as (
  select doc_id as id, len(s) as n from sets
), common as (
  select a.doc_id as u, b.doc_id as v, count(*) as c from flat a join flat b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2
), links as (
  select u, v from common join nodes a on a.id = u join nodes b on b.id = v where 100 * c >= 85 * (a.n + b.n - c)
), {_COMPONENTS}
select n.id as doc_id, n.n as n_shingles, min(w.seen) as component_id, n.id = min(w.seen) as kept
from nodes n join walk w on w.node = n.id group by n.id, n.n
"""

#: No page of the given tables names another url canonical or refreshes to one, so that aliases
#: decide nothing there; the alias rules are tested against brute force.
OP4 = """
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), rules(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best as (
  select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as verdict
  from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict, case when rule is null then 'default' else 'rule' end as decided_by
from parts left join best using (page_id)
"""

OP8 = """
with rows as (
  select vec_id, list_transform(embedding::double[], lambda x: floor(1024 * x)::bigint) as x from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]))::bigint as score
  from rows q join rows c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(q.x) = len(c.x)
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 10
"""

OP10 = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized as (
  select *, length(replace(replace(replace(text, '\', '\\'), '</turn>', '\</turn>'), '<turn ', '\<turn ')) + length(replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\</turn>'), '<turn ', '\<turn '), '>', '\>')) + 15 as size
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(size)::bigint as formatted_chars
from sized group by conv_id
"""

ORACLE = {"op2_vectors": OP2, "op3_minhash": OP3, "op4_urls": OP4, "op8_topk": OP8, "op10_chat": OP10}
