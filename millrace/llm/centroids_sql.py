"""The SQL of the clustering query, its rounds written out one after the other."""


def centroids_sql(k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1) -> str:
    def assigned(r: int) -> str:
        return f"""
    a{r} AS (
        SELECT rid, vec_id, v, c AS cluster, d AS distance FROM (
            SELECT x.rid, x.vec_id, x.v, m.c, list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, m.v) + list_inner_product(m.v, m.v) AS d,
                   row_number() OVER (PARTITION BY x.rid ORDER BY d, m.c) AS place
            FROM kept x CROSS JOIN c{r} m) WHERE place = 1)"""

    def means(r: int) -> str:
        return f"""
    m{r} AS (
        SELECT cluster, list(floor(s / n) ORDER BY i) AS v FROM (
            SELECT cluster, i, sum(x) AS s, count(*) AS n
            FROM (SELECT cluster, unnest(v) AS x, unnest(range({dim})) AS i FROM a{r}) GROUP BY ALL) GROUP BY cluster),
    c{r + 1} AS (SELECT c, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN m{r} m ON m.cluster = o.c)"""

    steps = ",".join(f"{assigned(r)},{means(r)}" for r in range(rounds))
    return f"""
    WITH kept AS (
        SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale}.0::DOUBLE * x::DOUBLE)) AS v
        FROM embeddings
        WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = {dim}),
    c0 AS (
        SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v
        FROM kept ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}),{steps},{assigned(rounds)}
    SELECT vec_id, cluster::INT AS cluster, distance::BIGINT AS distance,
           (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
           (SELECT sha256(array_to_string(list_transform(m.v, lambda x: x::BIGINT::VARCHAR), ',')) FROM c{rounds} m WHERE m.c = cluster) AS centroid_sha256
    FROM a{rounds}
    """
