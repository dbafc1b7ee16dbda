"""DuckDB twins of the queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10 = rf"""
with d as (select row_number() over () as rid, doc_id,
                  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select cast(item_id as varchar) as item,
             regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bs as (select item, w, least(len(w), 10) as size from b where len(w) > 0),
bw as (select distinct item, size, array_to_string(w[s:s + size - 1], ' ') as gram
       from (select item, w, size, unnest(range(1, len(w) - size + 2)) as s from bs)),
dw as (select rid, s, size, array_to_string(w[s:s + size - 1], ' ') as gram
       from (select rid, w, size, unnest(range(1, len(w) - size + 2)) as s
             from d cross join (select distinct size from bw) where len(w) >= size)),
hit as (select rid, item, s, dw.size as size from dw join bw on dw.gram = bw.gram and dw.size = bw.size),
pos as (select rid, count(distinct p) as n from (select rid, unnest(range(s, s + size)) as p from hit) group by rid),
it as (select rid, count(distinct item) as n, string_agg(distinct item, ',' order by item) as items from hit group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(pos.n, 0) as bigint) as n_hit,
       cast(coalesce(it.n, 0) as bigint) as n_items, sha256(coalesce(it.items, '')) as items_sha256,
       coalesce(pos.n, 0) > 0 as contaminated
from d left join pos using (rid) left join it using (rid)
"""

OP13 = r"""
with t as (select conv_id as c, turn, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as id,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
           from conversations where conv_id is not null),
own as (select c, list({'id': id, 'words': words} order by turn nulls first, id) as p from t group by c),
crc_step as (select i::bigint as byte, list_reduce(list_prepend(i::bigint, range(8)),
                  lambda x, _: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as v from range(256) r(i)),
crc_table as (select list(v order by byte) as tab from crc_step),
h as (select c, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda d: ascii(d)::bigint)),
                  lambda x, b: xor(tab[(xor(x, b) & 255) + 1], x >> 8)), 4294967295) % 4 as h from own, crc_table),
path as (select own.c as c, list_concat(coalesce(b.p, [])[1:h.h], own.p[h.h + 1:]) as p
         from own join h on own.c = h.c left join own b on b.c = own.c - own.c % 20),
member as (select c, d, array_to_string(list_transform(p[1:d], lambda x: x.id), ' ') as node, len(p) = d as ends,
                  coalesce(p[d].words, 0) as words
           from (select c, p, unnest(range(0, len(p) + 1)) as d from path)),
node as (select d, node, min(c) as conv_id, count(*) as n_convs, any_value(words) as words,
                sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where ends), '')) as ends_sha256
         from member group by d, node),
kids as (select d - 1 as d, case when d = 1 then '' else left(node, length(node) - 65) end as node, count(*) as n
         from node where d > 0 group by all),
full_node as (select node.*, coalesce(kids.n, 0) as n_children,
                     case when node.d > 1 then left(node.node, length(node.node) - 65) else '' end as up
              from node left join kids on kids.d = node.d and kids.node = node.node),
share as (select a as d, case when a = 0 then '' else left(node, a * 65 - 1) end as node,
                 sum((n_children = 0)::int) as leaves, sum((n_convs - 1) * words) as saved
          from (select *, unnest(range(0, d + 1)) as a from full_node) group by all)
select f.conv_id, f.d as depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, s.leaves::bigint as n_leaves,
       s.saved::bigint as saved_tokens, f.ends_sha256
from full_node f join share s on s.d = f.d and s.node = f.node left join full_node u on u.d = f.d - 1 and u.node = f.up
"""

OP6 = rf"""
with recursive d as (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as g, least(len(w), 4) as size
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.size = b.size and a.doc_id < b.doc_id group by all),
link as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
step as (select a, b from link union select b, a from link),
reach as (select doc_id as a, doc_id as b from d union select reach.a, step.b from reach join step on step.a = reach.b)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, (select min(b) from reach where reach.a = d.doc_id) as component_id
from d left join n using (doc_id)
"""

OP12 = rf"""
with piece as (select coalesce(lang, 'und') as lang,
                      unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as p from documents),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from piece),
gram as (select lang, w[s:s + k - 1] as g, count(*) as f
         from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as s from w cross join (values (1), (2), (3)) t(k)) group by all),
total as (select lang, sum(f)::bigint as n from gram where len(g) = 1 group by lang),
cand as (select lang, g, f as a from gram where len(g) > 1 and f >= 10),
inner_part as (select lang, g[1:2] as g, a from cand where len(g) = 3 union all select lang, g[2:3], a from cand where len(g) = 3),
kept as (select * from cand c where not exists
         (select 1 from inner_part i where i.lang = c.lang and i.g = c.g and 100 * i.a >= 50 * c.a)),
cut as (select c.lang, c.g, a, k, x.f as l, y.f as r, (1000000::hugeint * a * a) // (x.f::hugeint * y.f) as score
        from (select *, unnest(range(1, len(g))) as k from kept) c
        join gram x on x.lang = c.lang and x.g = c.g[1:k] join gram y on y.lang = c.lang and y.g = c.g[k + 1:]),
weak as (select *, row_number() over (partition by lang, g order by score, k) as o from cut),
named as (select *, array_to_string(g, ' ') as phrase from weak where o = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from named)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join total using (lang) where rank <= 2000
"""

ORACLE_SQL = {"op6_jaccard_join": OP6, "op10_decontamination": OP10, "op12_collocations": OP12, "op13_prefix_trie": OP13}
