"""Queries over lineages, paths of relationships and identities of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import identity as I
from ..operators import ledger as L
from ..sources.tables import table
from .common import rounded, sites

SQL: dict[str, str] = {}


def _derived(spark: SparkSession, sf: str) -> DataFrame:
    """part as geometries derived from one another: half the key is the parent, with planted faults."""
    k = F.col("k")
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("long").alias("k"))
    parent = F.when(k == 1, None).when(k % 97 == 0, k).when(k % 89 == 0, k + 10_000_000).when(k % 101 == 0, k + 1).when(k % 101 == 1, k - 1).when(k % 103 == 0, None).otherwise(F.floor(k / 2))
    state = F.when(k == 1, "SOURCE_NATIVE").when(k % 61 == 0, "SOURCE_NATIVE").when(k % 67 == 0, "UNRESOLVED").when(k % 71 == 0, "BOGUS").when(k < 64, "FULL").when(k < 256, "CANONICALIZED_FULL").when(k < 1024, "SIMPLIFIED").when(k % 13 == 0, "FULL").otherwise("MVT")
    rows = p.select(k.alias("id"), parent.alias("parent"), state.alias("state"))
    rows = rows.withColumn("origin", F.when((F.col("state") == "SOURCE_NATIVE") | (F.col("id") % 59 == 0), "SOURCE_NATIVE").otherwise("DERIVED"))
    return rows.unionByName(rows.where("id % 53 = 0"))


_DERIVED = """once AS (SELECT p_partkey::BIGINT AS id, CASE WHEN p_partkey = 1 THEN NULL WHEN p_partkey % 97 = 0 THEN p_partkey WHEN p_partkey % 89 = 0 THEN p_partkey + 10000000 WHEN p_partkey % 101 = 0 THEN p_partkey + 1
 WHEN p_partkey % 101 = 1 THEN p_partkey - 1 WHEN p_partkey % 103 = 0 THEN NULL ELSE p_partkey // 2 END AS parent,
 CASE WHEN p_partkey = 1 OR p_partkey % 61 = 0 THEN 'SOURCE_NATIVE' WHEN p_partkey % 67 = 0 THEN 'UNRESOLVED' WHEN p_partkey % 71 = 0 THEN 'BOGUS' WHEN p_partkey < 64 THEN 'FULL' WHEN p_partkey < 256 THEN 'CANONICALIZED_FULL'
 WHEN p_partkey < 1024 THEN 'SIMPLIFIED' WHEN p_partkey % 13 = 0 THEN 'FULL' ELSE 'MVT' END AS state FROM part),
 r AS (SELECT *, CASE WHEN state = 'SOURCE_NATIVE' OR id % 59 = 0 THEN 'SOURCE_NATIVE' ELSE 'DERIVED' END AS origin FROM once)"""


def lineage_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Everything that is wrong with a lineage of derived geometries."""
    return L.lineage_faults(_derived(spark, sf))


# What a child of a state may be, as pairs; everything else is a reversal.
_ALLOWED = ", ".join(f"('{k}','{c}')" for k, v in L.DERIVATIONS.items() for c in v)

SQL["lineage_faults"] = f"""WITH RECURSIVE {_DERIVED}, good AS (SELECT unnest(['SOURCE_NATIVE','FULL','CANONICALIZED_FULL','SIMPLIFIED','DELIVERY_MINIMIZED','MVT']) AS s), fine(a, b) AS (VALUES {_ALLOWED}),
 met AS (SELECT c.id, c.parent, c.state, p.id AS there, p.state AS above FROM r c LEFT JOIN r p ON p.id = c.parent WHERE c.parent IS NOT NULL AND c.parent <> c.id),
 bad AS (SELECT * FROM met WHERE state IN (FROM good) AND above IN (FROM good) AND NOT EXISTS (SELECT 1 FROM fine WHERE a = above AND b = state)),
 up AS (SELECT id FROM r WHERE id NOT IN (SELECT id FROM met WHERE there IS NOT NULL) UNION SELECT met.id FROM met JOIN up ON met.parent = up.id)
 SELECT id, 'DUPLICATE_ID' AS fault, NULL::VARCHAR AS other FROM r WHERE id % 53 = 0 UNION ALL SELECT id, 'UNRESOLVED_LINEAGE', NULL FROM r WHERE state = 'UNRESOLVED' UNION ALL SELECT id, 'INVALID_STATE', state FROM r WHERE state = 'BOGUS'
 UNION ALL SELECT id, 'SOURCE_NATIVE_HAS_PARENT', parent::VARCHAR FROM r WHERE state = 'SOURCE_NATIVE' AND parent IS NOT NULL UNION ALL SELECT id, 'MISSING_PARENT', NULL FROM r WHERE state IN (FROM good) AND state <> 'SOURCE_NATIVE' AND parent IS NULL
 UNION ALL SELECT id, 'ORIGIN_CONFLICT', origin FROM r WHERE state IN (FROM good) AND (origin = 'SOURCE_NATIVE') <> (state = 'SOURCE_NATIVE') UNION ALL SELECT id, 'SELF_EDGE', NULL FROM r WHERE parent = id
 UNION ALL SELECT id, 'PARENT_NOT_FOUND', parent::VARCHAR FROM met WHERE there IS NULL UNION ALL SELECT id, CASE WHEN above = 'MVT' THEN 'MVT_AUTHORITY_REVERSAL' ELSE 'LOSSY_AUTHORITY_REVERSAL' END, parent::VARCHAR FROM bad
 UNION ALL SELECT id, 'LINEAGE_CYCLE', NULL FROM r WHERE id NOT IN (FROM up)"""


def lineage_levels(spark: SparkSession, sf: str) -> DataFrame:
    """part as records with several parents, some of them on cycles, in the order in which they can be made."""
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("long").alias("id"))
    k = F.col("id")
    up = F.array_compact(F.array(F.when(k > 1, F.floor(k / 2)), F.when(k > 2, F.floor(k / 3)), F.when(k % 97 == 0, 2 * k)))
    return L.levels(p, p.select("id", F.explode(up).alias("parent")))


SQL["lineage_levels"] = """WITH RECURSIVE n AS (SELECT p_partkey::BIGINT AS id FROM part), l AS (SELECT id, id // 2 AS up FROM n WHERE id > 1 UNION SELECT id, id // 3 FROM n WHERE id > 2 UNION SELECT id, 2*id FROM n WHERE id % 97 = 0),
 off AS (SELECT id FROM l WHERE up NOT IN (FROM n) UNION SELECT a.id FROM l a JOIN l b ON a.up = b.id AND b.up = a.id UNION SELECT l.id FROM l JOIN off ON l.up = off.id),
 w AS (SELECT id, 0 AS level FROM n WHERE id NOT IN (SELECT id FROM l) UNION SELECT l.id, level + 1 FROM l JOIN w ON l.up = w.id WHERE l.id NOT IN (FROM off))
 SELECT id, max(level)::BIGINT AS level FROM n LEFT JOIN w USING (id) GROUP BY id"""


def _relations(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("u"))
    classes = F.array(*(F.lit(c) for c in ("VERIFIED",) * 6 + ("CONTEXT", "HYPOTHESIZED", "UNRESOLVED", "CONTRADICTED")))
    kind = F.element_at(F.array(F.lit(None).cast("string"), F.lit("water"), F.lit("passage")), (F.col("u") % 3 + 1).cast("int"))
    out = None
    for step, factor in ((1, 7), (7, 3)):
        e = s.select("u", (F.col("u") + step).alias("v"), F.element_at(classes, ((F.col("u") * factor) % 10 + 1).cast("int")).alias("class"), kind.alias("kind"))
        out = e if out is None else out.unionByName(e)
    return out


def path_states(spark: SparkSession, sf: str) -> DataFrame:
    """The best state of a path between places some steps apart."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("start"))
    return L.path_states(s.select("start", F.explode(F.array(*(F.col("start") + d for d in (0, 2, 9, 20, 50)))).alias("goal")), _relations(spark, sf))


SQL["path_states"] = """WITH RECURSIVE s AS (SELECT s_suppkey::BIGINT AS u FROM supplier), c AS (SELECT [0,0,0,0,0,0,2,2,3,4] AS ranks),
 e AS (SELECT u, u+1 AS v, ranks[(u*7)%10+1] AS k, [NULL,'water','passage'][u%3+1] AS d FROM s, c UNION SELECT u, u+7, ranks[(u*3)%10+1], [NULL,'water','passage'][u%3+1] FROM s, c),
 b AS (SELECT u, v, k, CASE WHEN k = 0 THEN d END AS d FROM e UNION SELECT v, u, k, CASE WHEN k = 0 THEN d END FROM e),
 w AS (SELECT 0 AS hop, u AS start, u AS spot, 0 AS k, NULL::VARCHAR AS d FROM s UNION
 SELECT hop+1, start, b.v, CASE WHEN greatest(w.k, b.k) = 0 AND w.d <> b.d THEN 1 ELSE greatest(w.k, b.k) END, CASE WHEN greatest(w.k, b.k) = 0 AND NOT coalesce(w.d <> b.d, false) THEN coalesce(w.d, b.d) END FROM w JOIN b ON b.u = w.spot WHERE hop < 6 AND b.v <> start),
 best AS (SELECT start, spot AS goal, min(k) AS k FROM w WHERE hop > 0 GROUP BY ALL)
 SELECT start, goal, coalesce(['VERIFIED','MIXED_KINDS','HYPOTHETICAL','UNRESOLVED','CONTRADICTED'][k+1], 'NO_PATH') AS state FROM (SELECT u AS start, u + unnest([0,2,9,20,50]) AS goal FROM s) LEFT JOIN best USING (start, goal)"""


def given_paths(spark: SparkSession, sf: str) -> DataFrame:
    """orders as paths of relationships, a line as an edge."""
    flag = F.col("l_returnflag")
    kind = F.when(F.col("l_suppkey") % 4 == 0, "air").when(F.col("l_suppkey") % 4 == 1, "water")
    cls = F.when(F.col("l_linenumber") < 3, "VERIFIED").when(flag == "A", "CONTRADICTED").when(flag == "R", "UNRESOLVED").when(F.col("l_linenumber") == 3, "CONTEXT").otherwise("VERIFIED")
    return L.path_state(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("path"), cls.alias("class"), kind.alias("kind")))


SQL["given_paths"] = """WITH e AS (SELECT l_orderkey AS path, CASE WHEN l_linenumber < 3 THEN 0 WHEN l_returnflag = 'A' THEN 4 WHEN l_returnflag = 'R' THEN 3 WHEN l_linenumber = 3 THEN 2 ELSE 0 END AS k,
 CASE l_suppkey % 4 WHEN 0 THEN 'air' WHEN 1 THEN 'water' END AS d FROM lineitem),
 g AS (SELECT path, count(*) AS n_edges, count(*) FILTER (k > 0) AS n_weak, max(k) AS k, count(DISTINCT d) AS kinds, min(d) AS d FROM e GROUP BY path)
 SELECT path, CASE WHEN k = 0 AND kinds > 1 THEN 'MIXED_KINDS' ELSE ['VERIFIED','','HYPOTHETICAL','UNRESOLVED','CONTRADICTED'][k+1] END AS state, CASE WHEN k = 0 AND kinds < 2 THEN d END AS kind, n_edges, n_weak FROM g"""

RULES = [
    I.NumberRule("SPRINGS", "MONITORING"),
    I.RepeatRule("SPRINGS"),
    I.PlaceRule(("WELLS",), ("UTILITY",), 1_200.0, ((1_200.0, 0.82), (300.0, 0.60)), 1_200.0),
    I.PlaceRule(("WELLS",), ("MONITORING",), 1_500.0, ((1_500.0, 0.80),), 400.0),
]
CLASSES = {"GROUNDWATER_POINT": ("WELLS", "UTILITY", "MONITORING", "SPRINGS")}


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """customer and supplier as records of four sources."""
    c, s = sites(spark, sf), sites(spark, sf, "supplier")
    source = F.element_at(F.array(F.lit("WELLS"), F.lit("UTILITY"), F.lit("SPRINGS")), (F.col("id") % 3 + 1).cast("int"))
    left = c.select((F.col("id") * 2).alias("id"), source.alias("source"), F.concat(F.lit("Pozo "), F.col("name")).alias("name"), F.when(F.col("id") % 3 == 2, (F.col("id") % 1009).cast("string")).alias("number"), "lon", "lat", F.col("id").alias("ord"))
    right = s.select((F.col("id") * 2 + 1).alias("id"), F.lit("MONITORING").alias("source"), F.concat(F.lit("Well "), F.col("name")).alias("name"), F.col("id").cast("string").alias("number"), "lon", "lat", F.col("id").alias("ord"))
    return left.unionByName(right)


def identity_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of records that a number or a place and a name join."""
    return rounded(I.identity_edges(_records(spark, sf), RULES), "distance_m", "similarity")


def identity_assets(spark: SparkSession, sf: str) -> DataFrame:
    """What the records make when those that bind are one."""
    records = _records(spark, sf)
    # Members need no list of pairs, and direct confidence comes by numbers alone.
    by_number = [r for r in RULES if not isinstance(r, I.PlaceRule)]
    return I.canonical_assets(records, I.identity_edges(records, by_number), CLASSES, I.identity_members(records, RULES))


QUERIES = {f.__name__: f for f in (lineage_faults, lineage_levels, path_states, given_paths, identity_edges, identity_assets)}
