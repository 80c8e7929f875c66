"""Coverage, quality, scoring and fingerprint metrics on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.bindings.base import Tables, query
from corpusgate.bindings.joins import _source_texts
from corpusgate.functions import aggregates as agg
from corpusgate.functions import columns as c
from corpusgate.operators import comparing, documents, linking, metrics

N = "*"


@query(
    "coverage_by_customer",
    "A1 A24",
    """
WITH l AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned FROM lineitem GROUP BY 1),
g AS (SELECT o_custkey, grouping(o_custkey)::INT AS is_total, count(*) AS claim_count, count(l_orderkey) AS mapped_claim_count,
  count(*) FILTER (o_orderstatus = 'F') AS machine_checked_count, count(*) FILTER (returned = 1) AS kernel_linked_count
  FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY ROLLUP (o_custkey))
SELECT *, mapped_claim_count / claim_count AS mapped_share, machine_checked_count / claim_count AS machine_checked_share,
  kernel_linked_count / claim_count AS kernel_linked_share, coalesce(machine_checked_count / nullif(mapped_claim_count, 0), 0) AS completion_share FROM g
""",
)
def coverage_by_customer(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey").agg(F.max(F.col("l_returnflag") == "R").alias("returned"))
    rows = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_custkey", "o_orderstatus", "l_orderkey", "returned")
    return metrics.coverage(
        rows, ["o_custkey"], F.col("l_orderkey").isNotNull(), F.col("o_orderstatus") == "F", F.col("returned"), totals=True
    )


@query(
    "extraction_runs",
    "A2",
    """
SELECT s.source AS paper_id, count(d.doc_id) AS claim_count, count(*) FILTER (d.n_chars >= 200) AS claims_with_source_span,
  (SELECT count(*) FROM pages p WHERE regexp_extract(p.url, '^([a-z]+)', 1) = s.source) AS assumption_count, '2024-05-01T00:00:00Z' AS recorded_at, 'batch' AS extraction_mode
FROM (SELECT DISTINCT source FROM documents UNION SELECT DISTINCT regexp_extract(url, '^([a-z]+)', 1) FROM pages) s LEFT JOIN documents d ON d.source = s.source GROUP BY s.source
""",
)
def extraction_runs(t: Tables) -> DataFrame:
    claims = t.documents.selectExpr(
        "source AS paper_id",
        """named_struct('source_file', source, 'start', named_struct('page', 1, 'offset', 0),
             'end', CASE WHEN n_chars >= 200 THEN named_struct('page', 1, 'offset', n_chars) END) AS source_span""",
    )
    assumptions = t.pages.select(F.regexp_extract("url", "^([a-z]+)", 1).alias("paper_id"))
    papers = claims.select("paper_id").union(assumptions).distinct()
    return metrics.extraction_run(claims, assumptions, papers, F.expr("timestamp '2024-05-01 00:00:00'"), "batch")


@query(
    "mapping_totals",
    "A4",
    """
SELECT count(*) AS paper_count, sum(mapped)::BIGINT AS mapped_claims, sum(claims)::BIGINT AS total_claims FROM (
  SELECT o_custkey, count(*) AS claims, count(*) FILTER (o_orderstatus = 'F') AS mapped FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1)
""",
)
def mapping_totals(t: Tables) -> DataFrame:
    with_mapping = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
    claims = t.orders.join(with_mapping, "o_custkey", "left_semi")
    per = claims.groupBy("o_custkey").agg(F.count(N).alias("claims"), F.count_if(F.col("o_orderstatus") == "F").alias("mapped"))
    return per.agg(F.count(N).alias("paper_count"), F.sum("mapped").alias("mapped_claims"), F.sum("claims").alias("total_claims"))


@query(
    "card_totals",
    "A5 A39",
    """
SELECT l_returnflag, grouping(l_returnflag)::INT AS is_total, count(*) AS declaration_count, count(*) FILTER (l_linestatus = 'F') AS machine_checked_count,
  (count(*) FILTER (l_linestatus = 'F')) / count(*) AS fraction FROM lineitem GROUP BY ROLLUP (l_returnflag)
""",
)
def card_totals(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_returnflag").agg(
        F.count(N).alias("declaration_count"), F.count_if(F.col("l_linestatus") == "F").alias("machine_checked_count")
    )
    out = metrics.with_totals(per, "l_returnflag", ["declaration_count", "machine_checked_count"])
    return out.withColumn("fraction", c.ratio("machine_checked_count", "declaration_count"))


@query(
    "checked_fraction",
    "A39",
    """
SELECT count(*) AS declaration_count, count(*) FILTER (l_linestatus = 'F') AS machine_checked_count,
  (count(*) FILTER (l_linestatus = 'F')) / count(*) AS fraction_machine_checked FROM lineitem
""",
)
def checked_fraction(t: Tables) -> DataFrame:
    cards = t.lineitem.selectExpr("CASE WHEN l_linestatus = 'F' THEN 'machine_checked' ELSE 'mapped' END AS proof_status")
    return metrics.checked_fraction(cards, "proof_status")


@query(
    "completion_rate_by_priority",
    "A6",
    """
WITH g AS (SELECT o_orderpriority, grouping(o_orderpriority)::INT AS is_total, count(*) FILTER (o_orderstatus <> 'P')::BIGINT AS mapped,
  count(*) FILTER (o_orderstatus = 'F')::BIGINT AS checked FROM orders GROUP BY ROLLUP (o_orderpriority))
SELECT *, coalesce(checked / nullif(mapped, 0), 0) AS rate, CASE WHEN is_total = 1 THEN checked / 40.0::DOUBLE END AS progress FROM g
""",
)
def completion_rate_by_priority(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") != "P").alias("mapped"), F.count_if(F.col("o_orderstatus") == "F").alias("checked")
    )
    return metrics.completion_rate(counts, "o_orderpriority", "checked", "mapped", target=40)


DEGREE = """
WITH e AS ({edges}), d AS (SELECT node, sum(i) AS fan_in, sum(o) AS fan_out FROM (SELECT src AS node, 0 AS i, 1 AS o FROM e UNION ALL SELECT dst, 1, 0 FROM e) GROUP BY 1)
SELECT (sum(fan_in) FILTER (fan_in > 1))::DOUBLE / sum(fan_in) AS dependency_reuse_ratio, sum(fan_in)::BIGINT AS total_edges, count(*) FILTER (fan_in > 0) AS declarations_with_in_degree,
  sum(fan_in)::DOUBLE / count(*) AS average_fan_in, sum(fan_out)::DOUBLE / count(*) AS average_fan_out, max(fan_in)::BIGINT AS max_fan_in, max(fan_out)::BIGINT AS max_fan_out,
  count(*) FILTER (fan_in > 1) AS shared_targets_count FROM d
"""


@query("degree_metrics_supplier_part", "A7", DEGREE.format(edges="SELECT concat('s', l_suppkey) AS src, concat('p', l_partkey) AS dst FROM lineitem"))
def degree_metrics_supplier_part(t: Tables) -> DataFrame:
    return metrics.degree_metrics(t.lineitem.selectExpr("concat('s', l_suppkey) AS src", "concat('p', l_partkey) AS dst"))


@query(
    "degree_metrics_distinct_edges",
    "A7",
    DEGREE.format(edges="SELECT DISTINCT concat('s', l_suppkey) AS src, concat('p', l_partkey) AS dst FROM lineitem"),
)
def degree_metrics_distinct_edges(t: Tables) -> DataFrame:
    return metrics.degree_metrics(t.lineitem.selectExpr("concat('s', l_suppkey) AS src", "concat('p', l_partkey) AS dst").distinct())


@query(
    "graph_or_cards",
    "A8",
    """
SELECT paper_id, src, dst, count(*) AS n FROM (
  SELECT o_custkey AS paper_id, concat('o', o_orderkey) AS src, concat('c', o_custkey) AS dst FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT c_custkey, concat('n', c_nationkey), concat('c', c_custkey) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P')) GROUP BY ALL
""",
)
def graph_or_cards(t: Tables) -> DataFrame:
    # Edges of open orders are blank: such a stated graph is invalid but still hides the cards.
    stated = t.orders.where("o_orderstatus <> 'P'").selectExpr(
        "o_custkey AS paper_id", "CASE WHEN o_orderstatus = 'F' THEN concat('o', o_orderkey) ELSE '' END AS src", "concat('c', o_custkey) AS dst"
    )
    derived = t.customer.selectExpr("c_custkey AS paper_id", "concat('n', c_nationkey) AS src", "concat('c', c_custkey) AS dst")
    out = metrics.graph_or_cards(stated, stated, derived)
    return out.groupBy("paper_id", "src", "dst").agg(F.count(N).alias("n"))


@query(
    "symbol_conflict_by_brand",
    "A9",
    """
WITH n AS (SELECT p_brand, p_name, count(*) AS n, count(*) FILTER (p_type = 'PROMO') AS f FROM part GROUP BY ALL),
g AS (SELECT p_brand, grouping(p_brand)::INT AS is_total, sum(n)::BIGINT AS symbol_count, sum(f)::BIGINT AS with_flags, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS overloaded
  FROM n GROUP BY ROLLUP (p_brand))
SELECT *, (with_flags + overloaded) / symbol_count AS conflict_rate FROM g
""",
)
def symbol_conflict_by_brand(t: Tables) -> DataFrame:
    return metrics.symbol_conflicts(t.part, "p_brand", "p_name", F.col("p_type") == "PROMO")


@query(
    "cross_brand_duplicate_names",
    "A10",
    """
SELECT p_name, p_brand, CASE WHEN p_size > 40 THEN concat('index_', p_partkey) ELSE concat('y', p_partkey) END AS location FROM part
WHERE p_name IN (SELECT p_name FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1)
""",
)
def cross_brand_duplicate_names(t: Tables) -> DataFrame:
    rows = t.part.selectExpr("p_name", "p_brand", "p_partkey", "CASE WHEN p_size > 40 THEN '' ELSE concat('y', p_partkey) END AS id")
    return metrics.cross_group_duplicates(rows, "p_name", "p_brand", "id", "p_partkey")


KEYWORDS = """length(regexp_replace(concat(' ', regexp_replace(text, '[^A-Za-z0-9_]+', '  ', 'g'), ' '), ' {w} ', concat(' {w} ', chr(1)), 'g'))
  - length(concat(' ', regexp_replace(text, '[^A-Za-z0-9_]+', '  ', 'g'), ' '))"""


@query(
    "keyword_counts",
    "A11 T8",
    f"""
SELECT doc_id, ({KEYWORDS.format(w="License")})::BIGINT AS "License", ({KEYWORDS.format(w="the")})::BIGINT AS the FROM documents
WHERE ({KEYWORDS.format(w="License")}) + ({KEYWORDS.format(w="the")}) > 0
""",
)
def keyword_counts(t: Tables) -> DataFrame:
    return documents.keyword_counts(t.documents, "doc_id", "text", ["License", "the"])


@query(
    "keyword_totals_by_source",
    "A11 T8",
    f"""
SELECT source, grouping(source)::INT AS is_total, count(*) AS files_scanned, sum({KEYWORDS.format(w="License")})::BIGINT AS "License", sum({KEYWORDS.format(w="the")})::BIGINT AS the
FROM documents GROUP BY ROLLUP (source)
""",
)
def keyword_totals_by_source(t: Tables) -> DataFrame:
    return documents.keyword_totals(t.documents, "text", ["License", "the"], "source")


LATENCY = """SELECT user_id, min(ts) FILTER (event_type = 'signup') AS a, min(ts) FILTER (event_type = 'purchase') AS b FROM events GROUP BY 1"""


def _latency_rows(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("a"),
        F.min(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("b"),
    )


@query(
    "median_signup_to_purchase",
    "A12 F",
    f"""
SELECT count(*) AS count, min(s) AS min, max(s) AS max, median(s) AS median FROM (SELECT (epoch_us(b) - epoch_us(a)) / 1e6 AS s FROM ({LATENCY})) WHERE s >= 0
""",
)
def median_signup_to_purchase(t: Tables) -> DataFrame:
    return agg.latency_summary(_latency_rows(t), "a", "b")


@query(
    "median_price_by_status",
    "A12",
    "SELECT o_orderstatus, count(*) AS count, min(o_totalprice) AS min, max(o_totalprice) AS max, median(o_totalprice) AS median FROM orders GROUP BY 1",
)
def median_price_by_status(t: Tables) -> DataFrame:
    return agg.exact_median(t.orders, ["o_orderstatus"], "o_totalprice")


@query(
    "unlinked_claims",
    "A13",
    """
SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1
""",
)
def unlinked_claims(t: Tables) -> DataFrame:
    linked = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.array("l_partkey").alias("links")).dropDuplicates(["o_orderkey"])
    claims = t.orders.join(linked, "o_orderkey", "left")
    parents = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
    return metrics.unlinked_rows(claims, c.has_items("links"), parents, "o_custkey").groupBy("o_custkey").agg(F.count(N).alias("n"))


@query(
    "dimension_visibility",
    "A14",
    """
SELECT p_brand, count(*) FILTER (p_size > 40 OR p_type = 'PROMO') AS with_count, count(*) FILTER (NOT (p_size > 40 OR p_type = 'PROMO')) AS without_count FROM part GROUP BY 1
""",
)
def dimension_visibility(t: Tables) -> DataFrame:
    rows = t.part.selectExpr(
        "p_brand", "CASE WHEN p_size > 40 THEN 'm' ELSE '' END AS unit", "CASE WHEN p_type = 'PROMO' THEN 'count' END AS kind", "' ' AS dimension"
    )
    return metrics.dimension_visibility(rows, "kind", "unit", "dimension", "p_brand")


@query(
    "reused_parts_across_nations",
    "A15 K2",
    """
SELECT dst FROM (SELECT concat('p', l_partkey) AS dst, s_nationkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
GROUP BY 1 HAVING count(DISTINCT s_nationkey) > 1 ORDER BY 1 LIMIT 100
""",
)
def reused_parts_across_nations(t: Tables) -> DataFrame:
    nations = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    edges = t.lineitem.join(nations, "l_suppkey").selectExpr("concat('p', l_partkey) AS dst", "s_nationkey")
    return metrics.reused_targets(edges, "dst", "s_nationkey")


@query(
    "error_document_count",
    "A16",
    """
SELECT true AS from_files, (SELECT count(*) FROM labels WHERE toxic = 1) AS error_count
UNION ALL SELECT false, count(*) FILTER (contains(lower(text), 'license') AND contains(lower(text), 'under')) FROM documents
""",
)
def error_document_count(t: Tables) -> DataFrame:
    # Once with records at hand, once with none, where the documents that name both words stand in.
    errors, words = t.labels.where("toxic = 1"), ("license", "under")
    kept = metrics.error_count(errors, t.labels, t.documents, words=words)
    return kept.unionByName(metrics.error_count(errors.where("false"), t.labels.where("false"), t.documents, words=words))


@query(
    "conditional_counts",
    "A17",
    """
SELECT count(*) FILTER (l_returnflag <> 'N') AS claims_with_linked_assumptions,
  count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS disputed_claims_with_formal_targets,
  (SELECT count(*) FROM part WHERE p_size <= 25) AS kernels_with_linked_cards FROM lineitem
""",
)
def conditional_counts(t: Tables) -> DataFrame:
    claims = t.lineitem.selectExpr(
        "CASE l_returnflag WHEN 'N' THEN array() ELSE array(l_partkey) END AS linked_assumptions",
        "CASE l_returnflag WHEN 'R' THEN 'disputed' ELSE 'mapped' END AS status",
        "CASE l_linestatus WHEN 'F' THEN array('t') ELSE array() END AS linked_formal_targets",
    )
    kernels = t.part.selectExpr("CASE WHEN p_size <= 25 THEN array(p_name) END AS linked_theorem_cards")
    return metrics.research_counts(claims, kernels)


@query(
    "ordered_bundle_checksum",
    "A30",
    """
WITH d AS (SELECT sha256(concat(l_orderkey, chr(1), l_linenumber, chr(1), l_partkey)) AS d,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, sha256(concat(l_orderkey, chr(1), l_linenumber, chr(1), l_partkey))) - 1 AS pos FROM lineitem),
a AS (SELECT pos // 1000 AS pos, sha256(string_agg(d, ',' ORDER BY pos)) AS d FROM d GROUP BY 1),
b AS (SELECT pos // 1000 AS pos, sha256(string_agg(d, ',' ORDER BY pos)) AS d FROM a GROUP BY 1)
SELECT (SELECT count(*) FROM lineitem) AS n, d AS checksum FROM b
""",
)
def ordered_bundle_checksum(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", agg.row_digest("l_orderkey", "l_linenumber", "l_partkey").alias("d"))
    return agg.ordered_checksum(rows, ["l_orderkey", "l_linenumber"], "d")


REVIEW = """CASE o_orderpriority WHEN '1-URGENT' THEN 'blocked' WHEN '2-HIGH' THEN 'accepted' WHEN '3-MEDIUM' THEN 'unreviewed' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'odd' END"""


def _reviewed(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "c_mktsegment", f"{REVIEW} AS reviewer_status", "CASE WHEN o_totalprice > 250000 THEN 'because' ELSE ' ' END AS notes",
        "CASE o_orderstatus WHEN 'F' THEN 'machine_checked' ELSE 'mapped' END AS proof_status",
    )


@query(
    "status_pivot_by_segment",
    "A18",
    f"""
SELECT c_mktsegment, grouping(c_mktsegment)::INT AS is_total, count(*) AS total_cards, count(*) FILTER (s = 'accepted') AS accepted, count(*) FILTER (s = 'blocked') AS blocked,
  count(*) FILTER (s = 'reviewed') AS reviewed, count(*) FILTER (s = 'unreviewed') AS unreviewed, count(*) FILTER (s IS NULL) AS missing_status, count(*) FILTER (s = 'odd') AS invalid_status,
  count(*) FILTER (s = 'blocked' AND o_totalprice <= 250000) AS blocked_without_notes, count(*) FILTER (s = 'accepted' AND o_orderstatus <> 'F') AS accepted_not_checked,
  count(*) FILTER (s = 'unreviewed' AND o_orderstatus = 'F') AS checked_but_unreviewed
FROM (SELECT *, {REVIEW} AS s FROM orders JOIN customer ON c_custkey = o_custkey) GROUP BY ROLLUP (c_mktsegment)
""",
)
def status_pivot_by_segment(t: Tables) -> DataFrame:
    return metrics.reviewer_status(_reviewed(t), "c_mktsegment", "reviewer_status", "notes", "proof_status")


@query(
    "reviewer_report",
    "A19",
    """
WITH r AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'machine_checked' WHEN 'O' THEN 'disputed' ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'unparsed' ELSE 'weird' END END AS s,
  CASE WHEN o_totalprice > 250000 THEN 'with_notes' ELSE 'without_notes' END AS notes, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderpriority END AS k FROM orders)
SELECT 'status' AS section, s AS key, count(*) AS n FROM r GROUP BY 2 UNION ALL SELECT 'disputed', notes, count(*) FROM r WHERE s = 'disputed' GROUP BY 2
UNION ALL SELECT 'invalid_status', s, count(*) FROM r WHERE s = 'weird' GROUP BY 2 UNION ALL SELECT 'value_kind', k, count(*) FROM r WHERE k IS NOT NULL GROUP BY 2
""",
)
def reviewer_report(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(
        "CASE o_orderstatus WHEN 'F' THEN 'machine_checked' WHEN 'O' THEN ' disputed ' ELSE CASE WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE 'weird' END END AS status",
        "CASE WHEN o_totalprice > 250000 THEN 'why' ELSE ' ' END AS review_notes", "CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE o_orderpriority END AS value_kind",
    )
    return metrics.reviewer_report(rows, "status", "review_notes", "value_kind")


@query(
    "evaluated_entries",
    "A21",
    """
WITH p AS (SELECT l_orderkey AS g, l_partkey AS k, l_returnflag AS v FROM lineitem WHERE l_quantity < 25),
q AS (SELECT l_orderkey AS g, l_partkey AS k, min(l_returnflag) AS v FROM lineitem GROUP BY ALL),
s AS (SELECT count(*) FILTER (p.v = q.v) AS tp, count(*) AS n_pred, (SELECT count(*) FROM q WHERE g IN (SELECT g FROM p)) AS n_gold FROM p LEFT JOIN q USING (g, k))
SELECT tp, n_pred, n_gold, tp / n_pred AS precision, tp / n_gold AS recall, 2.0::DOUBLE * (tp / n_pred) * (tp / n_gold) / (tp / n_pred + tp / n_gold) AS f1, 1.0 - tp / n_pred AS disagreement FROM s
""",
)
def evaluated_entries(t: Tables) -> DataFrame:
    rows = t.lineitem.selectExpr("l_orderkey AS g", "l_partkey AS k", "l_returnflag AS v", "l_quantity")
    gold = rows.groupBy("g", "k").agg(F.min("v").alias("v"))
    return metrics.evaluate_entries(rows.where("l_quantity < 25").drop("l_quantity"), gold, ["g", "k"], "v", "g")


@query(
    "review_decisions",
    "A21",
    """
SELECT count(*) AS bundles, count(*) FILTER (event_type <> 'view') AS decided, count(*) FILTER (event_type = 'signup') AS accepted, count(*) FILTER (event_type = 'click') AS rejected,
  count(*) FILTER (event_type = 'error') AS edited, count(*) FILTER (event_type = 'purchase') AS pending, round(sum(value) FILTER (event_type <> 'error'), 4) AS reviewer_seconds,
  count(*) FILTER (event_type <> 'error') AS reviewer_observations, (count(*) FILTER (event_type = 'signup')) / (count(*) FILTER (event_type <> 'view')) AS acceptance_rate FROM events
""",
)
def review_decisions(t: Tables) -> DataFrame:
    rows = t.events.selectExpr(
        "CASE event_type WHEN 'signup' THEN 'accepted' WHEN 'click' THEN 'rejected' WHEN 'error' THEN 'edited' WHEN 'purchase' THEN 'pending' END AS decision",
        "CASE WHEN event_type <> 'error' THEN value END AS seconds",
    )
    out = metrics.decision_counts(rows, "decision", "seconds")
    return out.withColumn("reviewer_seconds", F.round("reviewer_seconds", 4))


@query(
    "sidecar_footprint",
    "A22",
    """
SELECT kind, count(event_id) AS files FROM (VALUES ('signup'), ('error'), ('nothing')) v(kind) LEFT JOIN events ON event_type = kind GROUP BY 1
""",
)
def sidecar_footprint(t: Tables) -> DataFrame:
    files = t.events.selectExpr("concat('papers/u', user_id, '/', event_type, '.json') AS path")
    return metrics.presence_counts(files, "path", ["signup", "error", "nothing"])


@query(
    "unresolved_link_totals",
    "A22 A33",
    """
SELECT p_brand, count(*) AS rows, sum(CASE WHEN p_size > 25 THEN 2 ELSE 0 END)::BIGINT AS unresolved FROM part GROUP BY 1
""",
)
def unresolved_link_totals(t: Tables) -> DataFrame:
    rows = t.part.selectExpr("p_brand", "CASE WHEN p_size > 25 THEN array(p_name, p_type) WHEN p_size > 20 THEN array() END AS open_links")
    return rows.groupBy("p_brand").agg(F.count(N).alias("rows"), F.sum(c.count_items("open_links")).alias("unresolved"))


@query(
    "dashboard_rollup",
    "A24 A25",
    f"""
WITH o AS (SELECT *, {REVIEW} AS s FROM orders JOIN customer ON c_custkey = o_custkey),
cv AS (SELECT c_mktsegment, count(*) AS customers, count(*) FILTER (c_acctbal >= 0) AS in_credit FROM customer GROUP BY 1),
b AS (SELECT c_mktsegment, count(*) FILTER (s = 'blocked') AS blocked, count(*) FILTER (s = 'reviewed') AS reviewed, count(*) FILTER (s = 'accepted') AS accepted,
  count(*) FILTER (s IS NULL OR s NOT IN ('blocked', 'reviewed', 'accepted')) AS unreviewed FROM o GROUP BY 1)
SELECT c_mktsegment, grouping(c_mktsegment)::INT AS is_total, sum(customers)::BIGINT AS customers, sum(in_credit)::BIGINT AS in_credit, sum(blocked)::BIGINT AS blocked,
  sum(reviewed)::BIGINT AS reviewed, sum(accepted)::BIGINT AS accepted, sum(unreviewed)::BIGINT AS unreviewed FROM cv JOIN b USING (c_mktsegment) GROUP BY ROLLUP (c_mktsegment)
""",
)
def dashboard_rollup(t: Tables) -> DataFrame:
    counters = t.customer.groupBy("c_mktsegment").agg(F.count(N).alias("customers"), F.count_if(F.col("c_acctbal") >= 0).alias("in_credit"))
    return metrics.dashboard(_reviewed(t), counters, "c_mktsegment", "reviewer_status")


@query(
    "snapshot_table",
    "A25",
    """
SELECT paper_id, grouping(paper_id)::INT AS is_total, sum(e)::BIGINT AS edges, sum(m)::BIGINT AS checked FROM (
  SELECT concat('b', p_brand) AS paper_id, 1 + (p_size > 25)::INT AS e, (p_type = 'PROMO')::INT AS m FROM part) GROUP BY ROLLUP (paper_id)
""",
)
def snapshot_table(t: Tables) -> DataFrame:
    rows = t.part.selectExpr(
        "concat('b', p_brand) AS paper_id", "CASE WHEN p_size > 25 THEN array(1, 2) ELSE array(1) END AS graph", "p_type = 'PROMO' AS checked"
    )
    per = rows.groupBy("paper_id").agg(F.sum(c.count_items("graph")).alias("edges"), F.count_if("checked").alias("checked"))
    return metrics.with_totals(per, "paper_id", ["edges", "checked"])


SLICE60 = "('0x' || substr(d, {}, 15))::UBIGINT::DECIMAL(20,0)"
FINGERPRINT = "sha256(concat(count(*), ':', " + ", ':', ".join(f"sum({SLICE60.format(1 + 15 * i)})::DECIMAL(38,0)" for i in range(4)) + "))"


@query(
    "release_totals",
    "A26 A30",
    f"""
SELECT (SELECT count(*) FROM customer) AS papers, (SELECT count(*) FROM orders) AS claims, (SELECT count(*) FROM lineitem) AS declarations,
  (SELECT count(*) FROM supplier WHERE s_acctbal >= 0) AS tested_kernels, {FINGERPRINT} AS bundle
FROM (SELECT sha256(concat(p_partkey, chr(1), p_name, chr(1), p_brand)) AS d FROM part)
""",
)
def release_totals(t: Tables) -> DataFrame:
    bundle = t.part.select(agg.row_digest("p_partkey", "p_name", "p_brand").alias("d")).agg(
        agg.multiset_fingerprint(F.col("d")).alias("bundle")
    )
    count = lambda df: df.agg(F.count(N)).scalar()
    return (
        bundle.withColumn("papers", count(t.customer))
        .withColumn("claims", count(t.orders))
        .withColumn("declarations", count(t.lineitem))
        .withColumn("tested_kernels", count(t.supplier.where("s_acctbal >= 0")))
    )


@query(
    "group_fingerprint",
    "A29 A30 F",
    f"""
SELECT p_brand, {FINGERPRINT} AS build_hash FROM (SELECT p_brand, sha256(concat(p_partkey, chr(1), p_name, chr(1), p_type, chr(1), p_size)) AS d FROM part) GROUP BY 1
""",
)
def group_fingerprint(t: Tables) -> DataFrame:
    rows = t.part.select("p_brand", agg.row_digest("p_partkey", "p_name", "p_type", "p_size").alias("d"))
    return rows.groupBy("p_brand").agg(agg.multiset_fingerprint(F.col("d")).alias("build_hash"))


@query(
    "order_fingerprint",
    "A29",
    f"""
SELECT l_orderkey, {FINGERPRINT} AS build_hash FROM (SELECT l_orderkey, sha256(concat(l_linenumber, chr(1), l_partkey, chr(1), l_suppkey, chr(1), l_returnflag)) AS d FROM lineitem) GROUP BY 1
""",
)
def order_fingerprint(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", agg.row_digest("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").alias("d"))
    return rows.groupBy("l_orderkey").agg(agg.multiset_fingerprint(F.col("d")).alias("build_hash"))


GRAPH_SQL = """SELECT o_custkey, o_orderkey, o_orderstatus, coalesce(n, 0) AS deps FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_quantity > 48 GROUP BY 1) ON l_orderkey = o_orderkey"""


def _graph_cards(t: Tables) -> DataFrame:
    deps = t.lineitem.where("l_quantity > 48").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(N).alias("deps"))
    return t.orders.join(deps, "o_orderkey", "left")


@query(
    "graph_quality_by_customer",
    "A27 V14",
    f"""
SELECT *, CASE WHEN cards >= 6 AND sparse_ratio >= 0.60 THEN 'sparse' WHEN cards >= 6 AND edge_density <= 0.25 AND sparse_ratio >= 0.40 THEN 'low_density' END AS warning FROM (
  SELECT o_custkey, count(*) AS cards, sum(deps) / count(*) AS edge_density, (count(*) FILTER (deps = 0)) / count(*) AS sparse_ratio FROM ({GRAPH_SQL}) GROUP BY 1)
""",
)
def graph_quality_by_customer(t: Tables) -> DataFrame:
    return metrics.graph_quality(_graph_cards(t), "o_custkey", F.col("deps"))


@query(
    "graph_bootstrap",
    "A28 V14",
    f"""
SELECT o_custkey, count(*) AS cards FROM ({GRAPH_SQL}) WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
GROUP BY 1 HAVING count(*) >= 3 AND max(deps) = 0
""",
)
def graph_bootstrap(t: Tables) -> DataFrame:
    checked = t.orders.where("o_orderstatus = 'F'")
    return metrics.graph_bootstrap(_graph_cards(t), checked, "o_custkey", F.col("deps"))


@query(
    "duplicate_line_keys",
    "A31 V2",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_line_keys(t: Tables) -> DataFrame:
    return linking.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "policy_report",
    "A32",
    """
WITH d AS (SELECT p_name FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1)
SELECT 'duplicate_name' AS rule, p_name AS subject, 1::BIGINT AS observed, (p_name IN ('red ring', 'hot rod'))::BIGINT AS allowed, (p_name IN ('red ring', 'hot rod'))::INT AS ok FROM d
UNION ALL SELECT 'unlinked_rows', '', count(*), 999, (count(*) <= 999)::INT FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'without_dimension', '', count(*), 100, (count(*) <= 100)::INT FROM part WHERE p_size <= 40
""",
)
def policy_report(t: Tables) -> DataFrame:
    dup = metrics.shared_names(t.part, "p_name", "p_brand")
    unlinked = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
    out = metrics.policy_report(dup, "p_name", unlinked, t.part.where("p_size <= 40"), ["red ring", "hot rod"], 999, 100)
    return out.withColumn("ok", F.col("ok").cast("int"))


@query(
    "normalization_report",
    "A33",
    """
SELECT p_brand, sum(n)::BIGINT AS symbol_count, count(*) FILTER (n > 1) AS duplicate_name_count FROM (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY ALL) GROUP BY 1
""",
)
def normalization_report(t: Tables) -> DataFrame:
    return metrics.normalization_report(t.part, "p_brand", "p_name")


@query(
    "pages_index",
    "A34",
    """
SELECT paper_id, path, count(*) AS n FROM (SELECT c_custkey AS paper_id, concat('/papers/', c_custkey) AS path FROM customer
  UNION ALL SELECT o_custkey, concat('/claims/', o_orderkey) FROM orders
  UNION ALL SELECT o_custkey, concat('/theorem-cards/', l_partkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY ALL
""",
)
def pages_index(t: Tables) -> DataFrame:
    papers = t.customer.select(F.col("c_custkey").alias("paper_id"))
    claims = t.orders.select(F.col("o_custkey").alias("paper_id"), F.col("o_orderkey").alias("id"))
    cards = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("paper_id"), F.col("l_partkey").alias("id"))
    return metrics.pages_index(papers, claims, cards).groupBy("paper_id", "path").agg(F.count(N).alias("n"))


@query(
    "edges_from_cards",
    "A35",
    """
SELECT l_orderkey AS paper_id, concat('s', l_suppkey) AS src, concat('p', l_partkey) AS dst, CASE WHEN l_returnflag = 'R' THEN 'high' ELSE 'medium' END AS confidence, count(*) AS n
FROM lineitem GROUP BY ALL
""",
)
def edges_from_cards(t: Tables) -> DataFrame:
    cards = t.lineitem.selectExpr(
        "l_orderkey AS paper_id", "concat('p', l_partkey) AS id", "array(concat(' s', l_suppkey), ' ') AS dependency_ids",
        "CASE WHEN l_returnflag = 'R' THEN 'source_tier1' END AS dependency_extraction_method",
    )
    return metrics.edges_from_cards(cards).groupBy("paper_id", "src", "dst", "confidence").agg(F.count(N).alias("n"))


@query(
    "declaration_index",
    "A36",
    """
WITH f AS (SELECT p_brand AS paper_id, p_partkey AS pos, p_name AS lean_decl FROM part WHERE p_type IN ('PROMO', 'SMALL')),
o AS (SELECT concat('Brand#', s_nationkey) AS paper_id, s_suppkey AS pos, s_name AS lean_decl FROM supplier),
k AS (SELECT * FROM f UNION ALL SELECT * FROM o WHERE paper_id NOT IN (SELECT paper_id FROM f))
SELECT * FROM k UNION ALL SELECT concat('Brand#', n_nationkey + 10), i, concat(n_name, i) FROM nation, (VALUES (0), (1)) v(i)
WHERE concat('Brand#', n_nationkey + 10) NOT IN (SELECT paper_id FROM k)
""",
)
def declaration_index(t: Tables) -> DataFrame:
    fresh = t.part.where("p_type IN ('PROMO', 'SMALL')").selectExpr("p_brand AS paper_id", "p_partkey AS pos", "p_name AS lean_decl")
    old = t.supplier.selectExpr("concat('Brand#', s_nationkey) AS paper_id", "s_suppkey AS pos", "s_name AS lean_decl")
    manifest = t.nation.selectExpr("concat('Brand#', n_nationkey + 10) AS paper_id", "array(concat(n_name, 0), concat(n_name, 1)) AS declaration_index")
    return metrics.declaration_index(fresh, old, manifest)


@query(
    "regression_check",
    "A38",
    """
WITH a AS (SELECT count(*)::DOUBLE AS n, avg(o_totalprice) AS p FROM orders)
SELECT 1 AS phase, 'lines' AS task, '_runtime_seconds' AS metric, (SELECT count(*) FROM lineitem)::DOUBLE AS value, 120.0::DOUBLE AS limit_value
UNION ALL SELECT 2, 'absent', '', NULL, NULL
UNION ALL SELECT 2, 'orders', 'n', n, 1e12 FROM a UNION ALL SELECT 3, 'orders', 'n_high', n, 1.0 FROM a
""",
)
def regression_check(t: Tables) -> DataFrame:
    wide = t.orders.agg(F.count(N).alias("n"), F.count(N).alias("n_high"), F.count_if(F.col("o_orderstatus") == "F").alias("closed"))
    actuals = metrics.metric_rows(wide, "orders", ["n", "n_high", "closed"])
    limits = metrics.threshold_table(
        t.spark,
        {"orders": {"n": 1e12, "closed": 1.0, "unknown_metric": 5.0, "_note": 0.0}, "absent": {"n": 1.0}},
        {"orders": {"n_high": 1.0, "closed": 1e12}, "also_absent": {"n": 0.0}},
    )
    runtimes = t.lineitem.agg(F.count(N).cast("double").alias("value")).select(F.lit("lines").alias("task"), "value")
    return metrics.regression_check(actuals, limits, runtimes, 120.0)


@query(
    "expected_coverage",
    "A1 V9",
    """
WITH k AS (SELECT o_custkey, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R') AS linked FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT concat('c', o.o_custkey) AS paper_id, count(*) AS claim_count, count(*) FILTER (o_orderpriority <> '5-LOW') AS mapped_claim_count,
  count(*) FILTER (o_orderstatus = 'F') AS machine_checked_count, coalesce(any_value(k.linked), count(*) FILTER (o_orderstatus = 'O')) AS kernel_linked_count
FROM orders o LEFT JOIN k USING (o_custkey) GROUP BY 1
""",
)
def expected_coverage(t: Tables) -> DataFrame:
    claims = t.orders.selectExpr(
        "concat('c', o_custkey) AS paper_id", "CASE WHEN o_orderpriority <> '5-LOW' THEN array('t') ELSE array() END AS linked_formal_targets",
        "CASE o_orderstatus WHEN 'F' THEN 'machine_checked' WHEN 'O' THEN 'linked_to_kernel' ELSE 'mapped' END AS status",
    )
    cards = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "concat('c', o_custkey) AS paper_id", "concat('o', l_orderkey) AS claim_id", "CASE WHEN l_returnflag = 'R' THEN array('k') ELSE array() END AS executable_links"
    )
    return metrics.expected_coverage(claims, cards)


@query(
    "release_diff_self",
    "J13",
    "SELECT o_orderpriority AS g, o_custkey AS i FROM orders WHERE 1 = 0",
)
def release_diff_self(t: Tables) -> DataFrame:
    rows = t.orders.groupBy(F.col("o_orderpriority").alias("g"), F.col("o_custkey").alias("i")).agg(F.max("o_orderstatus").alias("s"))
    return comparing.status_changes(rows, rows.select("*"), ["g", "i"], "s").select("g", "i")


@query(
    "published_card_counts",
    "S12 A1 A36",
    """
SELECT concat('k', p_partkey) AS paper_id, 5::BIGINT AS declarations, CASE WHEN p_size > 25 THEN 5 ELSE 4 END::BIGINT AS edges FROM part
""",
)
def published_card_counts(t: Tables) -> DataFrame:
    docs, cards = _source_texts(t)
    cards = cards.withColumn("dependency_extraction_method", F.lit(""))
    full = documents.with_dependencies(cards, documents.dependency_edges(cards, docs, "Corpus"))
    return full.groupBy("paper_id").agg(F.count(N).alias("declarations"), F.sum(F.size("dependency_ids")).alias("edges"))
