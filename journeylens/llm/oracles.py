"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

NEAR_COPIES = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from worded),
posted as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
pairs as (
  select x.doc_id as a, y.doc_id as b, any_value(x.n) as na, any_value(y.n) as nb, count(*) as shared
  from posted x join posted y on x.shingle = y.shingle and x.doc_id <> y.doc_id
    and 100 * x.n >= 75 * y.n and 100 * y.n >= 75 * x.n
  group by 1, 2),
links as (select a, b from pairs where 100 * shared >= 75 * (na + nb - shared)),
reach as (
  select a as node, b as other from links
  union
  select r.node, l.b from reach r join links l on l.a = r.other)
select doc_id, len(s) as n_shingles,
  least(doc_id, coalesce((select min(other) from reach where node = doc_id), doc_id)) as component_id
from sets
"""

ARCHIVED = """
with hashed as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
firsts as (select payload_digest, max(page_id) as first_id from hashed where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest,
  case when first_id <> page_id then 'revisit' else 'response' end as record_type,
  case when first_id <> page_id then first_id end as refers_to
from hashed left join firsts using (payload_digest)
"""

NEAR_DUPLICATES = """
with recursive wide as (select vec_id, cast(embedding as double[]) as e from embeddings),
usable as (
  select vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as norm from wide
  where e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (
  select x.vec_id as a, y.vec_id as b from usable x join usable y
    on x.vec_id <> y.vec_id and len(x.e) = len(y.e) and list_inner_product(x.e, y.e) >= 0.9 * x.norm * y.norm),
reach as (
  select a as node, b as other from links
  union
  select r.node, l.b from reach r join links l on l.a = r.other)
select vec_id, (select count(*) from links where a = vec_id) as n_links,
  least(vec_id, coalesce((select min(other) from reach where node = vec_id), vec_id)) as component_id,
  vec_id <= coalesce((select min(other) from reach where node = vec_id), vec_id) as kept
from embeddings
"""


def centroid_clusters(width: int = 64, clusters: int = 40, rounds: int = 5) -> str:
    """Lloyd's rounds one after another, every distance computed."""
    parts = [
        f"""kept as materialized (
  select vec_id, list_transform(cast(embedding as double[]), lambda x: cast(floor(256 * x) as bigint)) as v
  from embeddings where len(embedding) = {width}
    and len(list_filter(cast(embedding as double[]), lambda x: x is null or not isfinite(x))) = 0)""",
        f"""c0 as materialized (
  select row_number() over (order by h, v) - 1 as k, v as c from (
    select v, sha256('2:' || coalesce(cast(vec_id as varchar), '')) as h from kept order by h, v limit {clusters}))""",
    ]
    distance = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} as materialized (
  select vec_id, any_value(v) as v, min(d) as distance, arg_min(k, (d, k)) as k from (
    select row_id, vec_id, v, k, {distance} as d from (select *, row_number() over () as row_id from kept), c{i})
  group by row_id, vec_id)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} as materialized (
  select k, coalesce(m, c) as c from c{i} left join (
    select k, list(cast(floor(s / n) as bigint) order by i) as m from (
      select k, i, sum(v[i]) as s, count(*) as n from a{i}, range(1, {width + 1}) as r(i) group by k, i)
    group by k) using (k))"""
            )
    return (
        "with "
        + ",\n".join(parts)
        + f"""
select vec_id, cast(k as integer) as cluster, cast(distance as bigint) as distance,
  cast(sum(distance) over (partition by k) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia,
  sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (k)"""
    )


TARGET_RESAMPLING = r"""
with words as (
  select 'd' as side, row_number() over () as row_id, doc_id, text from documents
  union all select 'b', row_number() over (), null, text from benchmark),
split as materialized (
  select side, row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from words),
features as materialized (
  select side, row_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f
  from split),
-- crc32 half a byte at a time
hashed as materialized (
  select f, xor(list_reduce(
      list_transform(range(1, len(x) + 1), lambda i:
        cast(instr('0123456789ABCDEF', x[i + case when i % 2 = 1 then 1 else -1 end]) - 1 as bigint)),
      lambda c, n: xor(c >> 4, half[xor(c, n) % 16 + 1]), 4294967295::bigint), 4294967295::bigint) % 10000 as bucket
  from (select distinct f, hex(f) as x from features),
    (select [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580,
      3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]::bigint[] as half)),
counted as (
  select bucket, count(*) filter (side = 'd') as s, count(*) filter (side = 'b') as t
  from features join hashed using (f) group by bucket),
gains as (
  select bucket, floor(1000 * ln((t + 1.0)::double * (sum(s) over () + 10000)::double
    / ((s + 1)::double * (sum(t) over () + 10000)::double))) as gain from counted),
weights as (
  select row_id, sum(gain) as total from features join hashed using (f) join gains using (bucket)
  where side = 'd' group by row_id),
scored as (
  select row_id, doc_id, greatest(2 * len(w) - 1, 0) as n_features, len(w) as n_words,
    coalesce(floor(total / (2 * len(w) - 1)), 0) as weight,
    ('0x' || sha256('7:' || coalesce(cast(doc_id as varchar), ''))[1:8])::bigint as h
  from split left join weights using (row_id) where side = 'd'),
drawn as (
  select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as score from scored),
ordered as (
  select row_id, row_number() over (order by score desc, doc_id) as place, 25 * count(*) over () // 100 as k
  from drawn where n_words >= 20)
select doc_id, cast(n_features as bigint) as n_features, cast(weight as bigint) as weight, cast(score as bigint) as score,
  cast(case when place <= k then place end as bigint) as rank
from drawn left join ordered using (row_id)
"""

REPEATED_PASSAGES = """
with bytes as materialized (
  select row_number() over () as row_id, doc_id, hex(coalesce(text, '')) as x from documents),
windows as materialized (
  select row_id, i, md5_number(substr(x, 2 * i + 1, 400)) as h
  from bytes, unnest(range(0, len(x) // 2 - 199)) as u(i)),
again as (select h from windows group by h having count(*) > 1),
starts as (select row_id, i from windows semi join again using (h)),
marked as (
  select row_id, i, lag(i) over (partition by row_id order by i) as before from starts),
numbered as (
  select row_id, i, sum(case when before is null or i > before + 200 then 1 else 0 end)
    over (partition by row_id order by i) as span from marked),
spans as (select row_id, span, min(i) as s, max(i) + 200 as e from numbered group by row_id, span),
gaps as (
  select row_id, span, s, e, coalesce(lag(e) over (partition by row_id order by s), 0) as since from spans),
kept as (
  select row_id, count(*) as n_spans, sum(e - s) as n_removed, max(e) as last_e,
    string_agg(substr(x, 2 * since + 1, 2 * (s - since)), '' order by s) as parts
  from gaps join bytes using (row_id) group by row_id)
select doc_id, cast(len(x) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(case when n_spans is null then x else parts || substr(x, 2 * last_e + 1) end)) as kept_sha256
from bytes left join kept using (row_id)
"""
