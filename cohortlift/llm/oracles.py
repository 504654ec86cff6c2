"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others rest on learnt scores, tokenizers, hashed draws or match positions; tests/llm holds them
against brute force.
"""

from __future__ import annotations

_OP1 = r"""
with recursive
w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents),
g as (
  select distinct doc_id, unnest(
    case when len(ws) >= 3 then list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
         when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s
  from w),
n as (select doc_id, count(*) as n, list_sort(list(s)) as all_s from g group by doc_id),
k as (select doc_id, n, min(doc_id) over (partition by all_s) as class_id from n),
p as (select a.doc_id as u, b.doc_id as v, count(*) as c from g a join g b on a.s = b.s and a.doc_id < b.doc_id group by all),
l as (
  select u, v from p join n x on x.doc_id = u join n y on y.doc_id = v where 100 * c >= 90 * (x.n + y.n - c)),
e as (select u, v from l union all select v, u from l),
r(root, node) as (
  select doc_id, doc_id from documents union select r.root, e.v from r join e on r.node = e.u)
select d.doc_id, coalesce(k.n, 0) as n_shingles, m.component_id, coalesce(k.class_id, d.doc_id) as class_id
from documents d left join k using (doc_id)
join (select node as doc_id, min(root) as component_id from r group by node) m using (doc_id)
"""

_OP3 = """
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(cast(x as double) * 64)) as e from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.r, q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on q.r <> c.r where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by r order by score desc, vec_id) as n from s)
select query_id, cast(n as int) as rank, vec_id, score from r where n <= 20
"""


_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_OP11 = f"""
with recursive
crc(i, step, c) as (
  select i, 0, i from range(256) r(i)
  union all
  select i, step + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc where step < 8),
crcs as (select list(c order by i) as t from crc where step = 8),
d as (select row_number() over () as r, doc_id, {_WORDS} as ws from documents),
f as (select r, unnest(ws) as w from d),
b as (select unnest({_WORDS}) as w from benchmark),
v as (select distinct w from (select w from f union all select w from b)),
k as (
  select w, xor(list_reduce(
    list_prepend(4294967295, list_transform(
      range(octet_length(encode(w))), lambda i: cast('0x' || substr(hex(encode(w)), 2 * i + 1, 2) as bigint))),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket
  from v, crcs),
s as (select bucket, count(*) as n from f join k using (w) group by bucket),
t as (select bucket, count(*) as n from b join k using (w) group by bucket),
g as (
  select bucket, cast(floor(1000 * ln(
    cast(coalesce(t.n, 0) + 1 as double) * cast((select count(*) from f) + 10000 as double)
    / (cast(coalesce(s.n, 0) + 1 as double) * cast((select count(*) from b) + 10000 as double)))) as bigint) as gain
  from s full join t using (bucket)),
m as (select r, sum(gain) as total, count(*) as n from f join k using (w) join g using (bucket) group by r),
w as (
  select r, doc_id, coalesce(n, 0) as n_features,
    cast(coalesce((total - ((total % n) + n) % n) / n, 0) as bigint) as weight,
    cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) as h
  from d left join m using (r)),
c as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296.0::double))) as bigint) as score from w),
p as (
  select r, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from c where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
from c left join p using (r)
"""

_OP12 = f"""
with
d as (select row_number() over () as r, doc_id, {_WORDS} as ws from documents),
i as (select cast(item_id as varchar) as item, {_WORDS} as ws from benchmark),
w as (
  select distinct item, unnest(case when len(ws) = 0 then [] else list_transform(
    range(1, greatest(len(ws) - 10, 0) + 2), lambda b: ws[b:b + 9]) end) as run from i),
g as (
  select r, n, b, ws[b:b + n - 1] as run
  from d, (select distinct len(run) as n from w), unnest(range(1, len(ws) - n + 2)) as u(b)),
h as (select g.r, g.n, g.b, w.item from g join w using (run)),
hit as (select r, count(distinct pos) as n_hit from (select r, unnest(range(b, b + n)) as pos from h) group by r),
its as (
  select r, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as digest
  from (select distinct r, item from h) group by r)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(digest, sha256('')) as items_sha256, n_hit is not null as contaminated
from d left join hit using (r) left join its using (r)
"""


def _op13(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds of assigning and averaging, each a query over the one before."""
    steps = [f"""
k as (
  select row_number() over (order by vec_id) as r, vec_id, label,
    list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
x as (
  select r, (pos - 1) // (len(e) // {parts}) as part, (pos - 1) % (len(e) // {parts}) as place, e[pos] as x
  from k, unnest(range(1, len(e) + 1)) as u(pos)),
c0 as (select r - 1 as entry, part, place, x as c from x where r <= {entries})"""]
    for step in range(rounds + 1):
        steps.append(f"""
d{step} as (
  select r, part, entry, sum((x - c) * (x - c)) as distance
  from x join c{step} using (part, place) group by r, part, entry),
a{step} as (
  select r, part, arg_min(entry, (distance, entry)) as entry, min(distance) as distance from d{step} group by r, part)""")
        if step < rounds:
            steps.append(f"""
m{step} as (
  select part, entry, place, cast(sum(x) as bigint) as total, count(*) as n
  from x join a{step} using (r, part) group by part, entry, place),
c{step + 1} as (
  select part, entry, place, coalesce((total - ((total % n) + n) % n) // n, c) as c
  from c{step} left join m{step} using (part, entry, place))""")
    return f"""
with {",".join(steps)},
o as (
  select r, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(distance) as bigint) as error
  from a{rounds} group by r),
f as (select sha256(string_agg(cast(c as varchar), ',' order by part, entry, place)) as digest from c{rounds})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  digest as codebooks_sha256
from k join o using (r), f
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_ngram_jaccard_join": _OP1, "op3_ball_tree_top_k": _OP3, "op11_importance_resampling": _OP11,
        "op12_decontamination": _OP12, "op13_vector_codes": _op13(),
    }
