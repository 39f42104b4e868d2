"""Edges, straight lines and shifts of rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.operators import edges as E
from geolith.plans.registry import Registry
from geolith.plans.tables import DAYS, HOURS, RASTER_SQL, event_raster

query = Registry()

#: Weak and strong slopes, angles of lines, votes that make a line, and the gaps and lengths of segments.
LOW, HIGH, ANGLES, VOTES, GAP, LENGTH = 8.0, 24.0, 24, 6, 3.0, 4.0

_EDGES_SQL = f"""{RASTER_SQL},
k AS (SELECT a, b, (2 - abs(a)) * b AS wx, (2 - abs(b)) * a AS wy FROM range(-1, 2) p(a), range(-1, 2) q(b)),
g AS (SELECT r.i - a AS i, r.j - b AS j, round(sum(z * wx), 6) AS gx, round(sum(z * wy), 6) AS gy FROM raster r, k GROUP BY 1, 2 HAVING count(*) = 9),
s AS MATERIALIZED (SELECT i, j, abs(gx) + abs(gy) AS size, CASE WHEN abs(gy) < abs(gx) * {E.TAN!r}::DOUBLE THEN 0 WHEN abs(gx) < abs(gy) * {E.TAN!r}::DOUBLE THEN 2 WHEN (gx > 0) = (gy > 0) THEN 1 ELSE 3 END AS s FROM g),
o AS (SELECT * FROM (VALUES (0, 0, 1), (1, 1, 1), (2, 1, 0), (3, 1, -1)) v(s, a, b)),
t AS MATERIALIZED (SELECT s.i, s.j, s.size FROM s JOIN o USING (s) LEFT JOIN s f ON f.i = s.i + a AND f.j = s.j + b LEFT JOIN s p ON p.i = s.i - a AND p.j = s.j - b
  WHERE s.size > {LOW} AND s.size > coalesce(p.size, 0) AND s.size >= coalesce(f.size, 0)),
edges AS (SELECT i, j FROM t WHERE size > {HIGH} UNION SELECT t.i, t.j FROM edges e JOIN t ON abs(t.i - e.i) <= 1 AND abs(t.j - e.j) <= 1)"""

_VOTES_SQL = f"""n AS (SELECT k, k * {E.math.pi / ANGLES!r}::DOUBLE AS a FROM range({ANGLES}) r(k)), c AS MATERIALIZED (SELECT i, j, k, a, floor(j * cos(a) + i * sin(a) + 0.500001)::INT AS rho FROM edges, n),
v AS MATERIALIZED (SELECT k, rho, count(*) AS votes FROM c GROUP BY k, rho HAVING count(*) >= {VOTES}),
u AS (SELECT k, rho, votes, k AS ok, rho AS orho FROM v UNION ALL SELECT k + {ANGLES}, -rho, votes, k, rho FROM v UNION ALL SELECT k - {ANGLES}, -rho, votes, k, rho FROM v),
found AS MATERIALIZED (SELECT k, rho, votes FROM v WHERE NOT EXISTS (SELECT 1 FROM u WHERE abs(u.k - v.k) <= 1 AND abs(u.rho - v.rho) <= 1 AND (u.ok, u.orho) <> (v.k, v.rho) AND (u.votes, -u.ok, -u.orho) > (v.votes, -v.k, -v.rho)))"""


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.edges(event_raster(spark, sf_dir), LOW, HIGH, HOURS)


@query(f"WITH RECURSIVE {_EDGES_SQL} SELECT i, j FROM edges")
def q_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells on edges: greatest slopes along their own direction, weak ones where they are linked to strong ones."""
    return _edges(spark, sf_dir)


@query(f"WITH RECURSIVE {_EDGES_SQL}, {_VOTES_SQL} SELECT k::INT AS k, rho, votes FROM found")
def q_hough_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straight lines through edge cells by votes: angle, distance and votes of the local maxima."""
    return E.lines(_edges(spark, sf_dir), ANGLES, VOTES)


@query(f"""
WITH RECURSIVE {_EDGES_SQL}, {_VOTES_SQL}, p AS (SELECT k, rho, round(i * cos(a) - j * sin(a), 6) AS t FROM c JOIN found USING (k, rho)),
w AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY k, rho ORDER BY t) > {GAP} THEN 1 ELSE 0 END AS fresh FROM p), x AS (SELECT *, sum(fresh) OVER (PARTITION BY k, rho ORDER BY t) AS run FROM w)
SELECT k::INT AS k, rho, round(min(t), 4) AS start, round(max(t), 4) AS stop, count(*) AS cells FROM x GROUP BY k, rho, run HAVING max(t) - min(t) >= {LENGTH}
""")
def q_hough_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of edge cells along the lines found."""
    cells = _edges(spark, sf_dir)
    found = E.segments(cells, E.lines(cells, ANGLES, VOTES), ANGLES, GAP, LENGTH)
    return found.select("k", "rho", F.round("start", 4).alias("start"), F.round("stop", 4).alias("stop"), "cells")


_TURN = f"2 * {E.math.pi!r}::DOUBLE"


@query(f"""
WITH {RASTER_SQL}, a AS (SELECT i, j, z, (i + 3) % {DAYS} AS si, (j + {HOURS} - 5) % {HOURS} AS sj, z + ((i * 31 + j * 17) % 7) / 10.0 AS w FROM raster),
q AS MATERIALIZED (SELECT u, v FROM range({DAYS}) x(u), range({HOURS}) y(v)),
f AS MATERIALIZED (SELECT u, v, sum(z * cos({_TURN} * ((u * i) % {DAYS} / {DAYS}.0 + (v * j) % {HOURS} / {HOURS}.0))) AS ar, -sum(z * sin({_TURN} * ((u * i) % {DAYS} / {DAYS}.0 + (v * j) % {HOURS} / {HOURS}.0))) AS ai,
  sum(w * cos({_TURN} * ((u * si) % {DAYS} / {DAYS}.0 + (v * sj) % {HOURS} / {HOURS}.0))) AS br, -sum(w * sin({_TURN} * ((u * si) % {DAYS} / {DAYS}.0 + (v * sj) % {HOURS} / {HOURS}.0))) AS bi FROM a, q GROUP BY u, v),
r AS MATERIALIZED (SELECT u, v, (ar * br + ai * bi) / m AS cr, (ai * br - ar * bi) / m AS ci FROM (SELECT *, sqrt((ar * ar + ai * ai) * (br * br + bi * bi)) AS m FROM f)),
s AS (SELECT x.u AS i, x.v AS j, sum(cr * cos({_TURN} * ((r.u * x.u) % {DAYS} / {DAYS}.0 + (r.v * x.v) % {HOURS} / {HOURS}.0)) - ci * sin({_TURN} * ((r.u * x.u) % {DAYS} / {DAYS}.0 + (r.v * x.v) % {HOURS} / {HOURS}.0))) / {DAYS * HOURS} AS c FROM q x, r GROUP BY 1, 2)
SELECT (CASE WHEN i > {DAYS // 2} THEN i - {DAYS} ELSE i END)::INT AS di, (CASE WHEN j > {HOURS // 2} THEN j - {HOURS} ELSE j END)::INT AS dj, round(c, 5) AS response FROM s ORDER BY c DESC, i, j LIMIT 1
""")
def q_phase_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a raster that was turned round by (3, -5) cells, with something added, is to be moved back, from the spectra's phases."""
    r = event_raster(spark, sf_dir)
    i, j = F.col("i"), F.col("j")
    moved = r.select(((i + 3) % DAYS).cast("int").alias("i"), ((j + HOURS - 5) % HOURS).cast("int").alias("j"), (F.col("z") + (i * 31 + j * 17) % 7 / 10.0).alias("z"))
    return E.phase_shift(r, moved, DAYS, HOURS, window=False).select("di", "dj", F.round("response", 5).alias("response"))
