"""The SQL of those queries that SQL can express, for a second engine over the same tables."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_NEAR_JOIN = rf"""
with recursive listed as (
    select doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) as words from documents
), cut as (
    select doc_id, case when len(words) between 1 and 2 then [array_to_string(words, ' ')]
                        when len(words) = 0 then []
                        else list_distinct(list_transform(range(1, len(words) - 1),
                                 lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) end as shingles
    from listed
), sized as (
    select doc_id, shingles, len(shingles)::bigint as n from cut
), single as (
    select doc_id, n, unnest(shingles) as shingle from sized
), shared as (
    select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as both_n
    from single a join single b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), links as (
    select a, b from shared where 100 * both_n >= 90 * (na + nb - both_n)
), edges as (
    select a, b from links union all select b, a from links
), reached as (
    select doc_id as a, doc_id as b from sized
    union
    select reached.a, edges.b from reached join edges on reached.b = edges.a
)
select doc_id, n as n_shingles, (select min(b) from reached where a = doc_id) as component_id from sized
"""

OP2_TOP_K = """
with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id as vec_id,
           cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
    from vectors q join vectors c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % 100 = 0
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored
)
select query_id, cast(place as integer) as rank, vec_id, score from ranked where place <= 10
"""

OP11_WARC = """
with records as (
    select page_id, coalesce(html, '') as payload,
           min(page_id) over (partition by coalesce(html, '')) as first_id
    from pages
), judged as (
    select *, strlen(payload) >= 100 and coalesce(page_id > first_id, false) as again from records
)
select page_id, strlen(payload) as payload_bytes, sha256(payload) as payload_digest,
       case when again then 'revisit' else 'response' end as record_type,
       case when again then first_id end as refers_to
from judged
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP12_LEXICAL = f"""
with lowered as (
    select doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), listed as (
    select doc_id, regexp_extract_all(text, '{_TERM}') as terms from lowered where text is not null
), sized as (
    select row_number() over () as doc, doc_id, terms, len(terms) as n from listed where len(terms) > 0
), totals as (
    select count(*)::bigint as total_docs, sum(n)::bigint as total_terms from sized
), counted as (
    select doc, term, count(*)::bigint as tf from (select doc, unnest(terms) as term from sized) group by doc, term
), weighed as (
    select term, cast(floor(1000 * ln((2 * total_docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
    from counted, totals group by term, total_docs
), asked as (
    select distinct item, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) as term
    from (select row_number() over () as item, item_id, text from benchmark)
), scored as (
    select item, item_id, doc, sized.doc_id,
           cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total_docs) // total_terms)))) as bigint) as score
    from asked join weighed using (term) join counted using (term) join sized using (doc), totals
    group by item, item_id, doc, sized.doc_id
), ranked as (
    select *, row_number() over (partition by item order by score desc, doc_id) as place from scored where score > 0
)
select item_id, cast(place as integer) as rank, doc_id, score from ranked where place <= 10
"""


def _means(rounds: int = 10, k: int = 8, dims: int = 64) -> str:
    """Every round as two tables: each vector's centroid, and the moved centroids."""
    assign = """
select vec_id, v, cluster, distance from (
    select vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as distance
    from vectors, {centroids}
) qualify row_number() over (partition by vec_id order by distance, cluster) = 1"""
    move = """
select cluster, coalesce(moved, c) as c from {centroids} left join (
    select cluster, list(cast((total - ((total % n) + n) % n) // n as bigint) order by dim) as moved from (
        select cluster, dim, sum(x)::hugeint as total, count(*) as n
        from (select cluster, unnest(v) as x, generate_subscripts(v, 1) as dim from {assigned}) group by cluster, dim
    ) group by cluster
) using (cluster)"""
    steps = [
        f"""vectors as materialized (
    select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v from embeddings
    where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)""",
        f"""c0 as materialized (
    select cast(row_number() over (order by h) - 1 as integer) as cluster, v as c
    from (select sha256('3:' || vec_id) as h, v from vectors order by h limit {k})
)""",
    ]
    for i in range(rounds):
        steps.append(f"a{i} as materialized ({assign.format(centroids=f'c{i}')}\n)")
        steps.append(f"c{i + 1} as materialized ({move.format(centroids=f'c{i}', assigned=f'a{i}')}\n)")
    last = f"c{rounds}"
    steps.append(f"final as materialized ({assign.format(centroids=last)}\n)")
    return f"""with {', '.join(steps)}
select vec_id, cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
       cast(sum(distance) over () as bigint) as inertia,
       sha256(array_to_string(c, ',')) as centroid_sha256
from final join {last} using (cluster)"""


ORACLES: dict[str, str] = {
    "op1_near_join": OP1_NEAR_JOIN,
    "op2_top_k": OP2_TOP_K,
    "op11_warc": OP11_WARC,
    "op12_lexical": OP12_LEXICAL,
    "op13_centroids": _means(),
}
