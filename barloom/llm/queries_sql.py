"""What the queries return, as DuckDB SQL, where SQL can say it."""

SQL = {
    "op9_topk": """
        with v as (select vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as t from embeddings
                   where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
        p as (select q.vec_id as query_id, c.vec_id,
                     cast(list_sum([a[1] * a[2] for a in list_zip(q.t, c.t)]) as bigint) as score
              from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
        select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5""",
    "op10_vectors": """
        with recursive v as (select vec_id, label, [cast(x as double) for x in embedding] as e from embeddings
                   where label is not null and embedding is not null
                     and len([x for x in embedding if x is null or not isfinite(x)]) = 0
                     and len([x for x in embedding if x <> 0]) > 0),
        l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
              where list_cosine_similarity(a.e, b.e) >= 0.93),
        reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join l on r.b = l.a),
        c as (select a as vec_id, min(b) as component_id from reach group by a),
        n as (select a as vec_id, count(*) as n_links from l group by a)
        select c.vec_id, coalesce(n_links, 0) as n_links, component_id, c.vec_id = component_id as kept
        from c left join n using (vec_id)""",
    "op11_negatives": """
        with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                          [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as t from embeddings
                   where label is not null and embedding is not null
                     and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
        p as (select q.vec_id as anchor_id, c.vec_id, q.label = c.label as same,
                     cast(list_sum([a[1] * a[2] for a in list_zip(q.t, c.t)]) as bigint) as score
              from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
        g as (select anchor_id, vec_id as positive_id, score as positive_score from p where same
              qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
        n as (select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
                     row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as rank
              from g join p using (anchor_id)
              where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
        select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
        from n where rank <= 3""",
}
