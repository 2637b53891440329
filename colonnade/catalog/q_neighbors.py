"""2.15 Neighbor graphs and graph clustering (exact, on a metric index)."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.ml import neighbors as N
from colonnade.ml import spectral as S
from colonnade.sources.tables import Tables


def _space(spark, d):
    return N.Space(Tables(spark, d).embeddings, "vec_id", "embedding")


_DIST_SQL = """
e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.id AS i, b.id AS j, list_distance(a.v, b.v) AS dist FROM e a, e b)"""


@query("knn_graph", sql=f"""
WITH {_DIST_SQL},
r AS (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY dist, j) AS rk FROM d),
a AS (SELECT i AS src, j AS dst FROM r WHERE rk <= 5),
b AS (SELECT src, dst, 0.5 AS w FROM a UNION ALL SELECT dst, src, 0.5 FROM a)
SELECT src, dst, CAST(sum(w) AS DOUBLE) AS weight FROM b GROUP BY src, dst""")
def q_knn_graph(spark, d):
    return N.knn_graph(_space(spark, d), 5)


@query("core_distance", sql=f"""
WITH {_DIST_SQL},
r AS (SELECT i, dist, row_number() OVER (PARTITION BY i ORDER BY dist, j) AS rk FROM d)
SELECT i AS id, round(dist, 6) AS core_distance FROM r WHERE rk = 5""")
def q_core_distance(spark, d):
    out = N.core_distance(_space(spark, d), 5)
    return out.select("id", F.round("core_distance", 6).alias("core_distance"))


@query("single_link", sql=f"""
WITH RECURSIVE {_DIST_SQL.strip()},
ed AS (SELECT i AS src, j AS dst FROM d WHERE dist < 1.1 AND i <> j),
cc(id, comp) AS (SELECT id, id FROM e UNION SELECT ed.dst, cc.comp FROM cc JOIN ed ON ed.src = cc.id)
SELECT id, min(comp) AS cluster FROM cc GROUP BY id""")
def q_single_link(spark, d):
    return N.single_link(_space(spark, d), 1.1)


@query("density_clusters", sql=f"""
WITH RECURSIVE {_DIST_SQL.strip()},
nb AS (SELECT i, j FROM d WHERE dist <= 1.15),
core AS (SELECT i AS id FROM nb GROUP BY i HAVING count(*) >= 3),
ed AS (SELECT i AS src, j AS dst FROM nb WHERE i IN (SELECT id FROM core) AND j IN (SELECT id FROM core) AND i <> j),
cc(id, comp) AS (SELECT id, id FROM core UNION SELECT ed.dst, cc.comp FROM cc JOIN ed ON ed.src = cc.id),
lab AS (SELECT id, min(comp) AS comp FROM cc GROUP BY id),
bd AS (SELECT nb.i AS id, min(lab.comp) AS b FROM nb JOIN lab ON lab.id = nb.j GROUP BY nb.i)
SELECT e.id, coalesce(lab.comp, bd.b, -1) AS cluster FROM e LEFT JOIN lab USING (id) LEFT JOIN bd USING (id)""")
def q_density_clusters(spark, d):
    return N.density_clusters(_space(spark, d), 1.15, 3)


@query("spectral")
def q_spectral(spark, d):
    return S.spectral(_space(spark, d), n_clusters=10, n_neighbors=10, tol=1e-2)
