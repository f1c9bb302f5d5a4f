"""Tree and sample-sheet queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from basetide import adapters as A
from basetide.catalog.common import fragment, query, r6
from basetide.functions import sequences as S
from basetide.operators import samples, tree
from basetide.sources.newick import newick_to_nodes

fragment("v_nodes", """
  SELECT c_custkey AS tree_id, 'c' || c_custkey AS node, CAST(NULL AS VARCHAR) AS parent, CAST(NULL AS DOUBLE) AS branch_length,
         'N' AS trait FROM customer
  UNION ALL SELECT o_custkey, 'o' || o_orderkey, 'c' || o_custkey, o_totalprice, 'N' FROM orders
  UNION ALL SELECT o_custkey, 'l' || l_orderkey || '-' || l_linenumber, 'o' || l_orderkey, max(l_quantity),
                   CASE WHEN max(l_returnflag) = 'R' THEN 'Y' ELSE 'N' END
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_orderkey, l_linenumber""")
fragment("v_typed", """
  SELECT n.*, upper(n.node) AS label, CASE WHEN k.parent IS NULL THEN 'tip' WHEN n.parent IS NULL THEN 'ROOT' ELSE 'internal' END
         AS node_type FROM v_nodes n LEFT JOIN (SELECT DISTINCT tree_id, parent FROM v_nodes) k
  ON k.tree_id = n.tree_id AND k.parent = n.node""")
fragment("v_under", """
  SELECT tree_id, node AS tip, node AS anc FROM v_typed WHERE node_type = 'tip'
  UNION ALL SELECT u.tree_id, u.tip, n.parent FROM v_under u JOIN v_nodes n ON u.tree_id = n.tree_id AND u.anc = n.node
            WHERE n.parent IS NOT NULL""")


@query("clade_table", """
  SELECT t.tree_id, t.node, string_agg(upper(u.tip), ';' ORDER BY upper(u.tip)) AS clade, t.node_type, t.branch_length, t.label
  FROM v_typed t LEFT JOIN v_under u ON u.tree_id = t.tree_id AND u.anc = t.node
  GROUP BY t.tree_id, t.node, t.node_type, t.branch_length, t.label""")
def clade_table(spark, d):
    return tree.tree_info(A.customer_trees(spark, d))


@query("propagated_trait", """
  SELECT t.tree_id, t.node, t.node_type, CASE WHEN t.node_type <> 'tip' AND bool_and(x.trait = 'Y') THEN 'Y' ELSE t.trait END AS trait
  FROM v_typed t LEFT JOIN v_under u ON u.tree_id = t.tree_id AND u.anc = t.node
  LEFT JOIN v_nodes x ON x.tree_id = u.tree_id AND x.node = u.tip
  GROUP BY t.tree_id, t.node, t.node_type, t.trait""")
def propagated_trait(spark, d):
    out = tree.propagate_trait(A.customer_trees(spark, d), "trait")
    return out.select("tree_id", "node", "node_type", "trait")


@query("ancestor_pairs", """
  SELECT a.tree_id, a.node, a.parent AS ancestor, 1 AS steps FROM v_nodes a WHERE a.parent IS NOT NULL
  UNION ALL SELECT a.tree_id, a.node, b.parent, 2 FROM v_nodes a JOIN v_nodes b
  ON a.tree_id = b.tree_id AND a.parent = b.node WHERE b.parent IS NOT NULL""")
def ancestor_pairs(spark, d):
    return tree.ancestor_pairs(A.customer_trees(spark, d))


@query("annotated_tips", """
  SELECT replace(c_name, '#', '_') AS label, CASE WHEN c_acctbal > 0 AND c_mktsegment <> '' THEN 'Y' ELSE 'N' END AS echo
  FROM customer""")
def annotated_tips(spark, d):
    c = A.table(spark, d, "customer")
    nodes = c.select(F.col("c_nationkey").alias("tree_id"), F.replace("c_name", F.lit("#"), F.lit("_")).alias("label"))
    info = c.select(F.replace("c_name", F.lit("#"), F.lit(" ")).alias("species"),
                    F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise("").alias("echo"))
    return tree.annotate_tree(nodes, info, "echo").select("label", "echo")


def _newicks(spark, d):
    """One two-level Newick text per customer with orders: ((o1:1.5,o2:2.5)all:0.5)c7; in order number."""
    o = A.table(spark, d, "orders").select(
        "o_custkey", F.struct("o_orderkey", F.concat(F.lit("o"), F.col("o_orderkey").cast("string"), F.lit(":"),
                                                     F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("t")).alias("x"))
    tips = F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["t"]), ",")
    text = F.concat(F.lit("(("), tips, F.lit(")all:0.5)c"), F.col("o_custkey").cast("string"), F.lit(";"))
    return o.groupBy("o_custkey").agg(tips.alias("tips")).select(
        F.col("o_custkey").cast("string").alias("tree_id"), F.concat(
            F.lit("(("), F.col("tips"), F.lit(")all:0.5)c"), F.col("o_custkey").cast("string"), F.lit(";")).alias("newick"))


fragment("v_tipno", """
  SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k,
         count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""")


@query("newick_edges", """
  SELECT CAST(o_custkey AS VARCHAR) AS tree_id, CAST(k AS INTEGER) AS node, CAST(n + 2 AS INTEGER) AS parent,
         'o' || o_orderkey AS label, round(o_totalprice, 2) AS branch_length FROM v_tipno
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), CAST(n + 2 AS INTEGER), CAST(n + 1 AS INTEGER), 'all', 0.5 FROM v_tipno WHERE k = 1
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), CAST(n + 1 AS INTEGER), NULL, 'c' || o_custkey, NULL FROM v_tipno WHERE k = 1""")
def newick_edges(spark, d):
    return newick_to_nodes(_newicks(spark, d))


@query("topologies", """
  SELECT CAST(o_custkey AS VARCHAR) AS tree_id, '((' || string_agg('o' || o_orderkey, ',' ORDER BY o_orderkey) || '))' AS topology,
         CAST(count(*) AS INTEGER) AS tips FROM orders GROUP BY o_custkey""")
def topologies(spark, d):
    return _newicks(spark, d).select("tree_id", S.strip_topology("newick").alias("topology"),
                                     F.size(S.tip_labels("newick")).alias("tips"))


fragment("v_gc", """
  SELECT CAST(event_id AS VARCHAR) AS accession, CASE WHEN event_id % 3 = 0 THEN value END AS own,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
fragment("v_filled", """
  SELECT accession, coalesce(own, CASE WHEN k BETWEEN 20 AND 90 THEN k END) AS gc,
         CASE WHEN own IS NOT NULL THEN 'sheet' WHEN k BETWEEN 20 AND 90 THEN 'lookup' WHEN k >= 20 THEN 'no_value'
              ELSE 'failed' END AS gc_source FROM v_gc""")


def _filled(spark, d):
    lookup = A.reports(spark, d).select("accession", S.gc_from_report("report").alias("gc"))
    return samples.fill_gc(A.samples(spark, d), lookup)


@query("filled_gc", "SELECT accession, round(CAST(gc AS DOUBLE), 6) AS gc, gc_source FROM v_filled")
def filled_gc(spark, d):
    return _filled(spark, d).select("accession", r6("gc", "gc"), "gc_source")


@query("gc_sources", "SELECT gc_source, count(*) AS n FROM v_filled GROUP BY 1")
def gc_sources(spark, d):
    return samples.gc_report(_filled(spark, d))


@query("average_gc", "SELECT round(avg(gc) / 100, 6) AS avg_gc FROM v_filled")
def average_gc(spark, d):
    return samples.avg_gc(_filled(spark, d)).select(r6("avg_gc", "avg_gc"))
