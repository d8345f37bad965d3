"""Checking SQL of the queries that SQL can express."""

from __future__ import annotations


# Rows of ``embeddings`` that take part, and for each query its best 20.
_BEST = """
with usable as (
    select vec_id, {vector} as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0{more}
),
scored as (
    select q.vec_id as query_id, c.vec_id as vec_id, {score} as score
    from usable q join usable c on c.vec_id <> q.vec_id
    where q.vec_id % 20 = 0
),
ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank,
        vec_id, score
    from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
"""

_TOP_K = _BEST.format(
    vector="list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint))",
    more="",
    score="cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint)",
)

_NEAREST = _BEST.format(
    vector="cast(embedding as double[])",
    more="\n      and len(list_filter(embedding, lambda x: x <> 0)) > 0",
    score="list_inner_product(q.v, c.v)",
)

_FINITE = "len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

# Clusters: one round assigns every vector and moves the centroids.
_KEPT = f"""
with kept as materialized (
    select row_number() over () as place, vec_id,
        list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as q
    from embeddings
    where embedding is not null and len(embedding) = 64 and {_FINITE}
),
centroids0 as materialized (
    select n - 1 as cluster, q as c
    from (select q, row_number() over (order by sha256('1:' || vec_id), q) as n from kept)
    where n <= 16
)"""

_ASSIGN = """,
assigned{n} as materialized (
    select place, cluster, d from (
        select place, cluster, d, row_number() over (partition by place order by d, cluster) as first
        from (
            select place, cluster, cast(list_sum(list_transform(range(1, 65),
                lambda i: (q[i] - c[i]) * (q[i] - c[i]))) as bigint) as d
            from kept cross join centroids{n}
        )
    ) where first = 1
)"""

_MOVE = """,
means{n} as (
    select cluster, list(case when s % rows <> 0 and s < 0 then s // rows - 1 else s // rows end
        order by i) as c
    from (
        select cluster, i, cast(sum(q[i]) as bigint) as s, count(*) as rows
        from assigned{n} join kept using (place), range(1, 65) as t(i)
        group by cluster, i
    ) group by cluster
),
centroids{next} as materialized (
    select cluster, coalesce(m.c, o.c) as c
    from centroids{n} o left join means{n} m using (cluster)
)"""

_CLUSTERS = (
    _KEPT
    + "".join(_ASSIGN.format(n=n) + _MOVE.format(n=n, next=n + 1) for n in range(3))
    + _ASSIGN.format(n=3)
    + """
select vec_id, cast(cluster as integer) as cluster, d as distance,
    cast(sum(d) over (partition by cluster) as bigint) as cluster_inertia,
    cast(sum(d) over () as bigint) as inertia,
    sha256(array_to_string(c, ',')) as centroid_sha256
from assigned3 join kept using (place) join centroids3 using (cluster)
"""
)

_HARD_NEGATIVES = f"""
with kept as materialized (
    select row_number() over () as place, vec_id,
        case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null and {_FINITE}
),
scored as materialized (
    select a.place as anchor, a.vec_id as anchor_id, c.place, c.vec_id,
        c.label = a.label as same,
        cast(coalesce(list_sum(list_transform(range(1, len(a.v) + 1),
            lambda i: a.v[i] * c.v[i])), 0) as bigint) as score
    from kept a join kept c on a.place <> c.place and len(a.v) = len(c.v)
    where a.vec_id % 100 = 0
),
positives as (
    select * from (
        select *, row_number() over (partition by anchor order by score desc, vec_id, place) as n
        from scored where same
    ) where n <= 5
),
matched as (
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id,
        p.score as positive_score, n.score as negative_score,
        row_number() over (
            partition by p.anchor, p.place order by n.score desc, n.vec_id, n.place
        ) as rank
    from positives p join scored n on n.anchor = p.anchor and not n.same
        and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score,
    negative_score
from matched where rank <= 10
"""


def statements() -> dict[str, str]:
    return {
        "op2_exact_top_k": _TOP_K,
        "op4_nearest_neighbours": _NEAREST,
        "op11_centroid_clusters": _CLUSTERS,
        "op13_hard_negatives": _HARD_NEGATIVES,
    }
