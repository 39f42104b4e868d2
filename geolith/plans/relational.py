"""Filters, joins, aggregates, windows and gates on the relational tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geolith.functions.geo import GridSpec
from geolith.operators.gates import gate, missing_and_extra, summary, with_fallback
from geolith.operators.proximity import box_totals, nearest_within, prioritised_union
from geolith.operators.ranking import exclusive_sum, first_of, longest_run, percentiles
from geolith.plans.registry import Registry
from geolith.plans.tables import POINTS_SQL, table, vector_points

query = Registry()


@query("""
WITH c AS (SELECT CAST(floor((110000 - l_extendedprice) / 5760) AS BIGINT) AS c, CAST(floor((l_quantity * 1000 - 0) / 5760) AS BIGINT) AS r FROM lineitem)
SELECT c, r, count(*) AS n FROM c WHERE c BETWEEN 0 AND 19 AND r BETWEEN 0 AND 8 GROUP BY c, r
""")
def q_patch_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = GridSpec(110000.0, 0.0, 5760.0, 20, 9)
    c, r = grid.cell_of(F.col("l_extendedprice"), F.col("l_quantity") * 1000)
    return table(spark, sf_dir, "lineitem").select(c.alias("c"), r.alias("r")).filter("c IS NOT NULL AND r IS NOT NULL").groupBy("c", "r").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.25), 6) AS p25, round(quantile_cont(o_totalprice, 0.5), 6) AS p50, round(quantile_cont(o_totalprice, 0.75), 6) AS p75,
       round(quantile_cont(o_totalprice, 0.95), 6) AS p95, min(o_totalprice) AS low, max(o_totalprice) AS high, count(*) AS n
FROM orders GROUP BY o_orderstatus
""")
def q_area_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice")
    p = percentiles(o, "o_orderstatus", "o_totalprice", [0.25, 0.5, 0.75, 0.95], 1000.0)
    d = o.groupBy("o_orderstatus").agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.count(F.lit(1)).alias("n")).join(p, "o_orderstatus")
    return d.select("o_orderstatus", *[F.round(F.col("p")[k], 6).alias(n) for k, n in enumerate(("p25", "p50", "p75", "p95"))], "low", "high", "n")


@query("""
SELECT CASE WHEN c_acctbal IS NULL THEN 'bad' WHEN c_nationkey NOT BETWEEN 3 AND 20 THEN 'outside' WHEN c_acctbal < 400 THEN 'small' ELSE 'kept' END AS reason,
       count(*) AS n, round(sum(c_acctbal), 2) AS total
FROM customer GROUP BY 1
""")
def q_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.when(F.col("c_acctbal").isNull(), "bad").when(~F.col("c_nationkey").between(3, 20), "outside").when(F.col("c_acctbal") < 400, "small").otherwise("kept")
    return table(spark, sf_dir, "customer").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderpriority DESC, o_orderkey LIMIT 100")
def q_topk_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority").orderBy(F.desc("o_totalprice"), F.desc("o_orderpriority"), "o_orderkey").limit(100)


@query("""
SELECT l_orderkey, l_linenumber, max(l_quantity) OVER (PARTITION BY l_orderkey) AS floors, max(l_quantity) OVER (PARTITION BY l_orderkey) * 3 + 3 AS height FROM lineitem
""")
def q_parcel_max_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    floors = F.max("l_quantity").over(Window.partitionBy("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", floors.alias("floors"), (floors * 3 + 3).alias("height"))


@query("""
WITH t AS (SELECT l_suppkey, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1)
SELECT s_suppkey, coalesce(total, 0) AS total, CASE WHEN total >= 16000 THEN 38 WHEN total >= 15000 THEN 20 WHEN total >= 14000 THEN 12 ELSE 9 END AS width
FROM supplier LEFT JOIN t ON s_suppkey = l_suppkey
""")
def q_river_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.round(F.sum("l_quantity"), 2).alias("total"))
    width = F.when(F.col("total") >= 16000, 38).when(F.col("total") >= 15000, 20).when(F.col("total") >= 14000, 12).otherwise(9)
    return table(spark, sf_dir, "supplier").select("s_suppkey").join(total, "s_suppkey", "left").select("s_suppkey", F.coalesce("total", F.lit(0.0)).alias("total"), width.alias("width"))


@query("""
SELECT CAST(floor(l_extendedprice / 2500) AS BIGINT) AS tile, round(sum(l_tax), 4) AS area, round(sum(l_quantity), 2) AS length
FROM lineitem GROUP BY 1 HAVING sum(l_tax) > 30 OR sum(l_quantity) > 15000
""")
def q_tile_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem").groupBy(F.floor(F.col("l_extendedprice") / 2500).alias("tile")).agg(F.sum("l_tax").alias("a"), F.sum("l_quantity").alias("b"))
    return d.filter("a > 30 OR b > 15000").select("tile", F.round("a", 4).alias("area"), F.round("b", 2).alias("length"))


@query("""
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1
""")
def q_first_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_of(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query(f"""
WITH {POINTS_SQL}, k AS (SELECT *, round_even(x / 10, 0) AS kx, round_even(y / 10, 0) AS ky FROM points)
SELECT kx, ky, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY kx, ky ORDER BY vec_id) AS n FROM k) WHERE n = 1
""")
def q_rounded_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = vector_points(spark, sf_dir).withColumns({"kx": F.rint(F.col("x") / 10), "ky": F.rint(F.col("y") / 10)})
    return first_of(k, ["kx", "ky"], ["vec_id"]).select("kx", "ky", "vec_id")


@query(f"""
WITH {POINTS_SQL}, a AS (SELECT * FROM points WHERE src = 0),
b AS (SELECT * FROM points p WHERE src = 1 AND NOT EXISTS (SELECT 1 FROM a WHERE abs(a.x - p.x) <= 0.8 AND abs(a.y - p.y) <= 0.8)), ab AS (SELECT * FROM a UNION ALL SELECT * FROM b),
c AS (SELECT * FROM points p WHERE src = 2 AND NOT EXISTS (SELECT 1 FROM ab WHERE abs(ab.x - p.x) <= 0.8 AND abs(ab.y - p.y) <= 0.8))
SELECT vec_id, src FROM ab UNION ALL SELECT vec_id, src FROM c
""")
def q_prioritised_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = vector_points(spark, sf_dir)
    return prioritised_union([points.filter(F.col("src") == k) for k in range(3)], "vec_id", 0.8).select("vec_id", "src")


@query("""
WITH b AS (SELECT p_partkey, p_retailprice * 30 AS x0, p_retailprice * 30 + 400 AS x1, p_size * 900.0 AS y0, p_size * 900.0 + 1500 AS y1 FROM part)
SELECT p_partkey, count(*) AS n, round(sum(l_tax), 4) AS total
FROM b JOIN lineitem ON l_extendedprice BETWEEN x0 AND x1 AND l_quantity * 1000 BETWEEN y0 AND y1 GROUP BY p_partkey
""")
def q_box_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("p_retailprice") * 30, F.col("p_size") * 900.0
    boxes = table(spark, sf_dir, "part").select("p_partkey", x.alias("x0"), (x + 400).alias("x1"), y.alias("y0"), (y + 1500).alias("y1"))
    points = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("x"), (F.col("l_quantity") * 1000).alias("y"), "l_tax")
    return box_totals(points, boxes, "p_partkey", "l_tax", 1000.0).select("p_partkey", "n", F.round("total", 4).alias("total"))


@query(f"""
WITH {POINTS_SQL}, d AS (SELECT a.vec_id, b.vec_id AS ref, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM points a JOIN points b ON a.src = 1 AND b.src = 0)
SELECT vec_id, ref, round(d, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, ref) AS n FROM d WHERE d <= 2) WHERE n = 1
""")
def q_nearest_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = vector_points(spark, sf_dir)
    refs = p.filter("src = 0").select("x", "y", F.col("vec_id").alias("ref"))
    return nearest_within(p.filter("src = 1"), refs, "vec_id", "ref", 2.0).select("vec_id", "ref", F.round("distance", 6).alias("distance"))


@query("""
WITH e AS (SELECT n_nationkey AS c, t AS r FROM nation, (SELECT DISTINCT c_mktsegment AS t FROM customer)), a AS (SELECT DISTINCT c_nationkey AS c, c_mktsegment AS r FROM customer WHERE c_acctbal > 8000 OR c_nationkey > 22)
SELECT c, r, 'missing' AS side FROM e WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.c = e.c AND a.r = e.r)
UNION ALL SELECT c, r, 'extra' AS side FROM a WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.c = a.c AND e.r = a.r)
""")
def q_completeness_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    expected = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c")).crossJoin(F.broadcast(c.select(F.col("c_mktsegment").alias("r")).distinct()))  # a handful of segments
    actual = c.filter("c_acctbal > 8000 OR c_nationkey > 22").select(F.col("c_nationkey").alias("c"), F.col("c_mktsegment").alias("r")).distinct()
    return missing_and_extra(expected, actual, ["c", "r"])


@query("""
WITH a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), b AS (SELECT DISTINCT o_orderkey AS k FROM orders)
SELECT (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS extra, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS missing,
       (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) = 0 AND (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) = 0 AS same
""")
def q_set_equality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct(), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).distinct()
    d = missing_and_extra(b, a, ["k"]).agg(F.count_if(F.col("side") == "extra").alias("extra"), F.count_if(F.col("side") == "missing").alias("missing"))
    return d.select("extra", "missing", ((F.col("extra") == 0) & (F.col("missing") == 0)).alias("same"))


@query("""
WITH s AS (SELECT doc_id, md5(coalesce(text, '')) AS h FROM documents), b AS (SELECT doc_id, md5(CASE WHEN lang = 'de' THEN upper(coalesce(text, '')) ELSE coalesce(text, '') END) AS h FROM documents WHERE lang <> 'es')
SELECT coalesce(s.doc_id, b.doc_id) AS doc_id, CASE WHEN b.h IS NULL THEN 'new' WHEN s.h IS NULL THEN 'gone' ELSE 'changed' END AS state FROM s FULL JOIN b ON s.doc_id = b.doc_id WHERE s.h IS DISTINCT FROM b.h
""")
def q_md5_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    d = table(spark, sf_dir, "documents")
    s = d.select("doc_id", F.md5(t).alias("h"))
    b = d.filter("lang <> 'es'").select("doc_id", F.md5(F.when(F.col("lang") == "de", F.upper(t)).otherwise(t)).alias("g"))
    return s.join(b, "doc_id", "full").filter(~F.col("h").eqNullSafe(F.col("g"))).select("doc_id", F.when(F.col("g").isNull(), "new").when(F.col("h").isNull(), "gone").otherwise("changed").alias("state"))


@query("""
SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors, round(avg(CAST(event_type = 'purchase' AS INT)), 6) AS purchase_share, round(sum(value) FILTER (value > 100) / nullif(sum(value), 0), 6) AS large_share
FROM events GROUP BY user_id
""")
def q_conditional_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.round(F.avg((F.col("event_type") == "purchase").cast("int")), 6).alias("purchase_share"),
        F.round(F.sum(F.when(F.col("value") > 100, F.col("value"))) / F.nullif(F.sum("value"), F.lit(0)), 6).alias("large_share"),
    )


@query("""
SELECT user_id, count(DISTINCT event_type) AS kinds, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS listed, count(*) FILTER (event_type NOT IN ('view', 'click', 'error')) = 0 AS within FROM events GROUP BY user_id
""")
def q_distinct_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("s"))
    known = F.array(*map(F.lit, ("view", "click", "error")))
    return d.select("user_id", F.size("s").cast("long").alias("kinds"), F.array_join(F.array_sort("s"), ",").alias("listed"), (F.size(F.array_except("s", known)) == 0).alias("within"))


@query("""
WITH d AS (SELECT DISTINCT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day FROM events WHERE value > 60),
g AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY user_id ORDER BY day) <= 2 THEN 0 ELSE 1 END AS new FROM d),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY day) AS run FROM g), s AS (SELECT user_id, run, min(day) AS start, max(day) AS finish FROM r GROUP BY 1, 2)
SELECT user_id, start, finish FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY finish - start DESC, start) AS n FROM s) WHERE n = 1
""")
def q_longest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("long")
    return longest_run(table(spark, sf_dir, "events").filter("value > 60").select("user_id", day.alias("day")).distinct(), "user_id", "day")


@query("""
WITH q AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem)
SELECT l_orderkey, k, n, coalesce(sum(n) OVER (PARTITION BY l_orderkey ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM q
""")
def q_prefix_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")).cast("long")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", k.alias("k"), F.col("l_quantity").cast("long").alias("n")).withColumn("at", exclusive_sum("n", "l_orderkey", "k"))


@query("""
WITH t AS (SELECT user_id, event_type, max(ts) AS last FROM events GROUP BY 1, 2), o AS (SELECT user_id, max(last) FILTER (event_type = 'view') AS made, max(last) FILTER (event_type IN ('click', 'error')) AS needs FROM t GROUP BY 1)
SELECT user_id, CASE WHEN made IS NULL THEN 'missing' WHEN needs IS NULL OR made >= needs - INTERVAL 1 SECOND THEN 'fresh' ELSE 'stale' END AS state FROM o
""")
def q_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = lambda *kinds: F.max(F.when(F.col("event_type").isin(*kinds), F.col("ts")))
    d = table(spark, sf_dir, "events").groupBy("user_id").agg(last("view").alias("made"), last("click", "error").alias("needs"))
    fresh = F.col("needs").isNull() | (F.col("made") >= F.col("needs") - F.expr("INTERVAL 1 SECOND"))
    return d.select("user_id", F.when(F.col("made").isNull(), "missing").when(fresh, "fresh").otherwise("stale").alias("state"))


@query("""
SELECT 'orders priced' AS item, CASE WHEN bool_and(o_totalprice > 0) THEN 'PASS' ELSE 'FAIL' END AS status, CAST(count(*) AS VARCHAR) AS detail FROM orders
UNION ALL SELECT 'nations 25', CASE WHEN count(*) = 25 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS VARCHAR) FROM nation
UNION ALL SELECT 'balances', CASE WHEN bool_or(c_acctbal < 0) THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) FILTER (c_acctbal < 0) AS VARCHAR) FROM customer
UNION ALL SELECT 'events valued', CASE WHEN bool_and(value IS NOT NULL) THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) FILTER (value IS NULL) AS VARCHAR) FROM events
""")
def q_gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    n = F.count(F.lit(1))
    return summary([
        gate(t("orders"), "orders priced", F.bool_and(F.col("o_totalprice") > 0), n), gate(t("nation"), "nations 25", n == 25, n),
        gate(t("customer"), "balances", ~F.bool_or(F.col("c_acctbal") < 0), F.count_if(F.col("c_acctbal") < 0)),
        gate(t("events"), "events valued", F.bool_and(F.col("value").isNotNull()), F.count_if(F.col("value").isNull())),
    ])


@query("""
WITH s AS (SELECT doc_id, lang, n_chars, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS rank, source FROM documents)
SELECT source, rank, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rank, doc_id) AS n FROM s WHERE n_chars > 4000) WHERE n = 1
""")
def q_source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").filter("n_chars > 4000").select("source", "doc_id", "lang")
    own = [d.filter("lang = 'en'"), d.filter("lang = 'de'"), d.filter("lang NOT IN ('en', 'de')")]
    return with_fallback(own[0].drop("lang"), [o.drop("lang") for o in own[1:]], "source").select("source", "rank", "doc_id")


@query("SELECT event_type, p_brand, count(*) AS n FROM events JOIN part ON p_partkey = user_id AND coalesce(p_type, '') <> 'SMALL' WHERE event_type IS DISTINCT FROM 'error' GROUP BY 1, 2")
def q_road_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").filter(F.coalesce("p_type", F.lit("")) != "SMALL").select(F.col("p_partkey").alias("user_id"), "p_brand")
    return table(spark, sf_dir, "events").filter(~F.col("event_type").eqNullSafe("error")).join(parts, "user_id").groupBy("event_type", "p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT s_suppkey, n_name, 'found' AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey AND n_nationkey < 20
UNION ALL SELECT s_suppkey, NULL AS n_name, 'no nation' AS state FROM supplier WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = s_nationkey AND n_nationkey < 20)
""")
def q_lookup_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    n = table(spark, sf_dir, "nation").filter("n_nationkey < 20").select("n_nationkey", "n_name")
    found = n.withColumn("state", F.lit("found"))
    return s.join(found, "n_nationkey", "left").select("s_suppkey", "n_name", F.coalesce("state", F.lit("no nation")).alias("state"))


@query("""
WITH l AS (SELECT user_id AS tile, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'split' ELSE 'done' END AS status, ts, event_id FROM events),
last AS (SELECT tile, status FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY ts DESC, event_id DESC) AS n FROM l) WHERE n = 1)
SELECT tile, status FROM last WHERE status <> 'done' ORDER BY tile LIMIT 40
""")
def q_resume_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "split").otherwise("done")
    ledger = table(spark, sf_dir, "events").select(F.col("user_id").alias("tile"), status.alias("status"), "ts", "event_id")
    last = first_of(ledger, ["tile"], [F.desc("ts"), F.desc("event_id")])
    return last.filter("status <> 'done'").select("tile", "status").orderBy("tile").limit(40)


@query("SELECT l_orderkey, l_partkey, l_extendedprice, l_quantity FROM lineitem WHERE l_extendedprice > 20000 AND l_extendedprice < 60000 AND l_quantity > 10 AND l_quantity < 20")
def q_parquet_bbox_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = (F.col("l_extendedprice") > 20000) & (F.col("l_extendedprice") < 60000) & (F.col("l_quantity") > 10) & (F.col("l_quantity") < 20)
    return table(spark, sf_dir, "lineitem").filter(inside).select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")


@query("""
SELECT event_type, k, n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, k) AS place FROM (SELECT event_type, CAST(user_id AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY 1, 2)) WHERE place <= 5
""")
def q_topk_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").groupBy("event_type", F.col("user_id").cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return d.withColumn("place", F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("n"), "k"))).filter("place <= 5").drop("place")


@query("""
WITH g AS (SELECT n_nationkey AS c, r_regionkey AS r FROM nation, region) SELECT c, r, 2 * (c // 13) + (r // 3) AS quadrant FROM g WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c AND n_regionkey = r)
""")
def q_cartesian_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    cells = n.select(F.col("n_nationkey").alias("c")).crossJoin(F.broadcast(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("r"))))  # 25 by 5 cells of a fixed grid
    had = n.select(F.col("n_nationkey").alias("c"), F.col("n_regionkey").alias("r"))
    return cells.join(had, ["c", "r"], "left_anti").select("c", "r", (F.floor(F.col("c") / 13) * 2 + F.floor(F.col("r") / 3)).cast("int").alias("quadrant"))


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 'tower' WHEN o_totalprice >= 250000 THEN 'block' WHEN o_orderpriority = '1-URGENT' THEN 'hall' ELSE 'house' END AS kind,
       round(0.6 * ln(1 + o_totalprice) + 0.4 * (o_custkey % 10), 6) AS score
FROM orders
""")
def q_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_totalprice")
    kind = F.when(p >= 400000, "tower").when(p >= 250000, "block").when(F.col("o_orderpriority") == "1-URGENT", "hall").otherwise("house")
    return table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("kind"), F.round(F.log1p(p) * 0.6 + (F.col("o_custkey") % 10) * 0.4, 6).alias("score"))


@query(f"""
WITH {POINTS_SQL}, c AS (SELECT *, CAST(floor(x / 12) AS BIGINT) AS cx, CAST(floor(y / 12) AS BIGINT) AS cy FROM points)
SELECT vec_id FROM (SELECT *, row_number() OVER (PARTITION BY cx, cy ORDER BY x + y DESC, vec_id) AS n FROM c) WHERE n = 1 OR src = 0
""")
def q_grid_thin(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = vector_points(spark, sf_dir).withColumns({"cx": F.floor(F.col("x") / 12), "cy": F.floor(F.col("y") / 12)})
    place = F.row_number().over(Window.partitionBy("cx", "cy").orderBy(F.desc(F.col("x") + F.col("y")), "vec_id"))
    return c.withColumn("n", place).filter("n = 1 OR src = 0").select("vec_id")
