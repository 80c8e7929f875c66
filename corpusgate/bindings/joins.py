"""Referential, matching and merging operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.bindings.base import Tables, query
from corpusgate.functions import columns as c
from corpusgate.operators import comparing, documents, linking, metrics, similarity
from corpusgate.plans import publication



@query(
    "orphan_orders_without_lines",
    "J2a",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def orphan_orders_without_lines(t: Tables) -> DataFrame:
    return linking.orphans(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query(
    "orphan_documents_without_label",
    "J2a V4",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def orphan_documents_without_label(t: Tables) -> DataFrame:
    return linking.orphans(t.documents, t.labels, {"doc_id": "doc_id"}).select("doc_id")


@query(
    "orphan_event_users",
    "J2c J2f",
    """
SELECT event_id, user_id + 1400 AS user_key FROM events WHERE event_type <> 'error' AND user_id + 1400 NOT IN (SELECT c_custkey FROM customer)
""",
)
def orphan_event_users(t: Tables) -> DataFrame:
    child = t.events.selectExpr("event_id", "CASE WHEN event_type <> 'error' THEN user_id + 1400 END AS user_key")
    return linking.orphans(child, t.customer, {"user_key": "c_custkey"}, skip_if_parent_empty=True)


@query(
    "orphan_lines_by_group",
    "J2f",
    """
WITH p AS (SELECT p_type AS g, p_partkey AS k FROM part WHERE p_size <= 25 AND p_type <> 'PROMO'),
c AS (SELECT l_orderkey, l_linenumber, p_type AS g, l_partkey AS k FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT g, k, count(*) AS n FROM c WHERE g IN (SELECT g FROM p) AND (g, k) NOT IN (SELECT (g, k) FROM p) GROUP BY ALL
""",
)
def orphan_lines_by_group(t: Tables) -> DataFrame:
    # PROMO has no parent rows at all, so its references are not judged.
    parent = t.part.where("p_size <= 25 AND p_type <> 'PROMO'").selectExpr("p_type AS g", "p_partkey AS k")
    types = t.part.selectExpr("p_partkey AS k", "p_type AS g")
    child = t.lineitem.selectExpr("l_partkey AS k").join(types, "k")
    lost = linking.orphans(child, parent, {"g": "g", "k": "k"}, skip_if_parent_empty=True, parent_group=["g"])
    return lost.groupBy("g", "k").agg(F.count(F.lit(1)).alias("n"))


@query(
    "orphan_dependencies",
    "J2b J2g",
    """
SELECT concat('s', l_suppkey) AS ref, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
GROUP BY 1 UNION ALL SELECT concat('x', l_linenumber), count(*) FROM lineitem GROUP BY 1
""",
)
def orphan_dependencies(t: Tables) -> DataFrame:
    cards = t.lineitem.selectExpr("array(concat('s', l_suppkey), '', concat('x', l_linenumber)) AS dependency_ids")
    parents = t.supplier.where("s_acctbal >= 0").selectExpr("concat('s', s_suppkey) AS id")
    lost = linking.array_orphans(cards, "dependency_ids", parents, "id")
    return lost.groupBy("ref").agg(F.count(F.lit(1)).alias("n"))


@query(
    "orphan_mapping_keys",
    "J2d J2e",
    """
SELECT concat('k', o_orderkey) AS paper_id, concat('c', o_custkey) AS ref FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""",
)
def orphan_mapping_keys(t: Tables) -> DataFrame:
    mapping = t.orders.selectExpr("concat('k', o_orderkey) AS paper_id", "map(concat('c', o_custkey), 'd') AS claim_to_decl")
    claims = t.customer.where("c_acctbal >= 0").selectExpr("concat('c', c_custkey) AS id")
    keys = mapping.withColumn("ref", F.explode(F.map_keys("claim_to_decl")))
    return linking.orphans(keys, claims, {"ref": "id"}).select("paper_id", "ref")


@query(
    "cards_without_path",
    "J2h",
    """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'N' AND o_orderstatus = 'F' GROUP BY ALL
""",
)
def cards_without_path(t: Tables) -> DataFrame:
    cards = t.lineitem.selectExpr("l_orderkey", "l_linenumber", "CASE WHEN l_returnflag = 'N' THEN ' ' ELSE 'f.lean' END AS file_path")
    named = t.orders.selectExpr("o_orderkey AS l_orderkey", "CASE WHEN o_orderstatus = 'F' THEN 'N.S' ELSE '' END AS namespace")
    bad = cards.where(~c.not_blank("file_path")).join(named.where(c.not_blank("namespace")), "l_orderkey", "left_semi")
    return bad.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


DECLARED = """CASE c_mktsegment WHEN 'MACHINERY' THEN '1-urgent' WHEN 'BUILDING' THEN '2-high' WHEN 'AUTOMOBILE' THEN '3-medium'
  WHEN 'FURNITURE' THEN '4-not specified' ELSE '5-low' END"""


@query(
    "undeclared_index_entries",
    "J2i",
    f"""
SELECT concat('c', o_custkey) AS paper_id, concat('N.', lower(o_orderpriority)) AS decl, count(*) AS n FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND {DECLARED} = lower(o_orderpriority)) GROUP BY ALL
""",
)
def undeclared_index_entries(t: Tables) -> DataFrame:
    mapping = t.customer.selectExpr("concat('c', c_custkey) AS paper_id", "'N' AS namespace", f"{DECLARED} AS short")
    declared = mapping.select("paper_id", c.qualified("namespace", "short").alias("decl"))
    listed = t.orders.selectExpr("concat('c', o_custkey) AS paper_id", "concat('N.', lower(o_orderpriority)) AS decl")
    lost = linking.orphans(listed, declared, {"paper_id": "paper_id", "decl": "decl"})
    return lost.groupBy("paper_id", "decl").agg(F.count(F.lit(1)).alias("n"))


def _word_paths(texts: DataFrame, name: str) -> DataFrame:
    words = F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)))
    return texts.select(F.explode(F.transform(words, lambda w: F.concat(F.lit("/"), w))).alias(name))


LINKS_SQL = """SELECT page_id, unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS ref FROM pages"""
KNOWN_SQL = """SELECT DISTINCT concat('/', unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS id FROM benchmark"""


@query(
    "resolve_page_links",
    "J1 P1 F",
    f"""
WITH l AS (SELECT DISTINCT page_id, ref FROM ({LINKS_SQL} UNION ALL SELECT page_id, '/ghost' FROM pages)), k AS ({KNOWN_SQL})
SELECT page_id, coalesce(string_agg(ref, ' ' ORDER BY ref) FILTER (ref IN (SELECT id FROM k)), '') AS resolved,
  string_agg(ref, ' ' ORDER BY ref) FILTER (ref NOT IN (SELECT id FROM k)) AS unresolved,
  count(*) FILTER (ref IN (SELECT id FROM k)) AS n_resolved, count(*) FILTER (ref NOT IN (SELECT id FROM k)) AS n_unresolved
FROM l GROUP BY 1
""",
)
def resolve_page_links(t: Tables) -> DataFrame:
    child = t.pages.select(
        "page_id",
        F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), F.lit(1)).alias("links"),
        F.array(F.lit("/ghost")).alias("pending"),
    )
    known = _word_paths(t.benchmark, "id")
    out = linking.resolve_links(child, ["page_id"], [], "links", known, "id", "pending")
    return out.select(
        "page_id",
        F.array_join(F.sort_array("links"), " ").alias("resolved"),
        F.array_join("links_unresolved", " ").alias("unresolved"),
        F.col("links_count").alias("n_resolved"),
        F.col("links_unresolved_count").alias("n_unresolved"),
    )


@query(
    "resolve_order_parts",
    "J1",
    """
WITH l AS (SELECT l_orderkey, l_returnflag, l_linestatus, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey,
    l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25) AS hit, concat('s', l_suppkey) AS s FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, count(*) AS n, sum(CASE WHEN hit THEN 1 ELSE 0 END)::BIGINT AS resolved,
  sum(CASE WHEN hit THEN 1 ELSE 2 END)::BIGINT AS unresolved FROM l GROUP BY ALL
""",
)
def resolve_order_parts(t: Tables) -> DataFrame:
    # Each line links a part and a supplier code; only parts up to size 25 are known.
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    lines = t.lineitem.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    child = lines.select(
        *key, "copies", F.array(F.concat(F.lit("p"), "l_partkey"), F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("p"), "l_partkey")).alias("links")
    )
    known = t.part.where("p_size <= 25").select(F.concat(F.lit("p"), "p_partkey").alias("id"))
    out = linking.resolve_links(child, [*key, "copies"], [], "links", known, "id")
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return out.groupBy(*ids).agg(
        F.sum("copies").alias("n"),
        F.sum(F.col("links_count") * F.col("copies")).alias("resolved"),
        F.sum(F.col("links_unresolved_count") * F.col("copies")).alias("unresolved"),
    )




@query(
    "derived_cards",
    "J3 P6 P8 P9 W4",
    """
WITH e AS (SELECT concat('m-', o_orderkey) AS paper_id, i, o_orderstatus, o_orderkey, o_custkey, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS n
  FROM orders, (VALUES (1), (2)) v(i) WHERE o_orderstatus <> 'P' OR i = 1),
j AS (SELECT e.*, CASE WHEN i = 1 AND c_custkey IS NOT NULL THEN CASE WHEN c_mktsegment = 'BUILDING' THEN 'machine_checked' WHEN c_mktsegment = 'FURNITURE' THEN 'linked_to_kernel' ELSE 'mapped' END
  ELSE 'mapped' END AS proof_status FROM e LEFT JOIN customer ON c_custkey = o_custkey)
SELECT CASE WHEN n = 1 THEN concat('m_', o_orderkey, '_card_001') ELSE concat(paper_id, '_card_00', i) END AS id,
  CASE i WHEN 1 THEN concat('c', o_custkey) ELSE 'none' END AS claim_id, CASE i WHEN 1 THEN 'N.S.first' ELSE 'N.S.second' END AS lean_decl,
  'formal/N/S.lean' AS file_path, proof_status,
  CASE proof_status WHEN 'machine_checked' THEN 'fully_machine_checked' WHEN 'linked_to_kernel' THEN 'numerically_witnessed' ELSE 'human_review_only' END AS verification_boundary,
  CASE proof_status WHEN 'machine_checked' THEN 'accepted' WHEN 'linked_to_kernel' THEN 'reviewed' ELSE 'unreviewed' END AS reviewer_status
FROM j
""",
)
def derived_cards(t: Tables) -> DataFrame:
    mapping = t.orders.selectExpr(
        "concat('m-', o_orderkey) AS paper_id",
        "' N.S' AS namespace",
        "cast(NULL AS string) AS target_file",
        "CASE WHEN o_orderstatus = 'P' THEN map(concat('c', o_custkey), 'first') ELSE map(concat('c', o_custkey), 'first', 'none', 'second') END AS claim_to_decl",
    )
    kind = "CASE c_mktsegment WHEN 'BUILDING' THEN 'machine_checked' WHEN 'FURNITURE' THEN 'linked_to_kernel' ELSE NULL END AS status"
    claims = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "concat('m-', o_orderkey) AS paper_id", "0 AS pos", "concat('c', o_custkey) AS id", kind
    )
    out = linking.derive_cards(mapping, claims)
    return out.select("id", "claim_id", "lean_decl", "file_path", "proof_status", "verification_boundary", "reviewer_status")


@query(
    "enriched_links",
    "J4 U3",
    """
WITH k AS (SELECT DISTINCT concat('s', l_suppkey) AS sid, concat('p', l_partkey) AS cid FROM lineitem WHERE l_returnflag = 'R'
  UNION SELECT concat('own', p_brand), concat('p', p_partkey) FROM part WHERE p_size > 30)
SELECT concat('p', p_partkey) AS id, coalesce(string_agg(sid, ',' ORDER BY sid), '') AS links FROM part LEFT JOIN k ON cid = concat('p', p_partkey) GROUP BY 1
""",
)
def enriched_links(t: Tables) -> DataFrame:
    cards = t.part.selectExpr(
        "concat('p', p_partkey) AS id",
        "CASE WHEN p_size > 30 THEN array(concat('own', p_brand), '') ELSE cast(array() AS array<string>) END AS links",
    )
    kernels = t.lineitem.where("l_returnflag = 'R'").selectExpr("concat('s', l_suppkey) AS sid", "array(concat('p', l_partkey)) AS cards")
    out = linking.enrich_links(cards, "id", "links", kernels, "sid", "cards")
    return out.select("id", F.array_join("links", ",").alias("links"))


@query(
    "link_pairs",
    "J4 U3",
    """
SELECT DISTINCT concat('p', l_partkey) AS id, concat('s', l_suppkey) AS link FROM lineitem UNION SELECT concat('p', p_partkey), concat('own', p_brand) FROM part WHERE p_size > 30
""",
)
def link_pairs(t: Tables) -> DataFrame:
    cards = t.part.selectExpr(
        "concat('p', p_partkey) AS id", "CASE WHEN p_size > 30 THEN array(concat('own', p_brand), '') ELSE cast(array() AS array<string>) END AS links"
    )
    kernels = t.lineitem.selectExpr("concat('s', l_suppkey) AS sid", "array(concat('p', l_partkey)) AS cards")
    return linking.link_pairs(cards, "id", "links", kernels, "sid", "cards")


@query(
    "kernel_index",
    "J5",
    """
SELECT DISTINCT p_brand AS paper_id, concat('s', l_suppkey) AS kernel_id FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F'
""",
)
def kernel_index(t: Tables) -> DataFrame:
    kernels = t.lineitem.where("l_linestatus = 'F'").selectExpr("concat('s', l_suppkey) AS kernel_id", "array(concat('p', l_partkey)) AS linked")
    cards = t.part.selectExpr("p_brand AS paper_id", "concat('p', p_partkey) AS id")
    return linking.linking_sources(kernels, "linked", cards, "id", ["paper_id"])


@query(
    "carried_over_review",
    "J6 W13",
    """
WITH o AS (SELECT o_custkey, o_orderpriority, max_by(o_orderstatus, o_orderkey) AS st, max_by(CASE WHEN o_totalprice > 200000 THEN 'note' ELSE '' END, o_orderkey) AS notes
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY ALL)
SELECT n.o_orderkey, coalesce(CASE WHEN o.st <> 'P' THEN o.st END, 'unreviewed') AS reviewer_status, coalesce(nullif(o.notes, ''), 'fresh') AS notes
FROM orders n LEFT JOIN o USING (o_custkey, o_orderpriority) WHERE n.o_orderdate >= TIMESTAMP '1998-01-01'
""",
)
def carried_over_review(t: Tables) -> DataFrame:
    split = F.expr("timestamp '1998-01-01 00:00:00'")
    new = t.orders.where(F.col("o_orderdate") >= split).selectExpr(
        "o_orderkey", "o_custkey", "o_orderpriority", "'unreviewed' AS reviewer_status", "'fresh' AS notes"
    )
    old = t.orders.where(F.col("o_orderdate") < split).selectExpr(
        "o_orderkey", "o_custkey", "o_orderpriority", "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS reviewer_status",
        "CASE WHEN o_totalprice > 200000 THEN 'note' ELSE '' END AS notes",
    )
    out = linking.carry_over(new, old, ["o_custkey", "o_orderpriority"], ["reviewer_status"], ["notes"], old_order=["o_orderkey"])
    return out.select("o_orderkey", "reviewer_status", "notes")


@query(
    "span_alignment",
    "J7",
    """
SELECT count(*) AS total_compared, count(*) FILTER (n_chars <> length(text) OR toxic = 1) AS alignment_error_count,
  (count(*) FILTER (n_chars <> length(text) OR toxic = 1))::DOUBLE / count(*) AS alignment_error_rate
FROM documents JOIN labels USING (doc_id)
""",
)
def span_alignment(t: Tables) -> DataFrame:
    corpus = t.documents.selectExpr("doc_id", "named_struct('file', source, 'end', n_chars) AS source_span")
    texts = t.documents.select("doc_id", "source", F.length("text").cast("long").alias("n"))
    ref = t.labels.join(texts, "doc_id").selectExpr(
        "doc_id", "CASE WHEN toxic = 1 THEN NULL ELSE named_struct('file', source, 'end', n) END AS source_span"
    )
    return linking.align_spans(corpus, ref, ["doc_id"])


@query(
    "prf_quality_rule",
    "J8 A20 U2",
    """
WITH p AS (SELECT doc_id, source FROM documents WHERE n_chars >= 300), g AS (SELECT doc_id, source FROM documents JOIN labels USING (doc_id) WHERE quality = 1),
s AS (SELECT (SELECT count(*) FROM p JOIN g USING (doc_id)) AS tp,
  (SELECT count(*) FROM p WHERE source IN (SELECT source FROM g)) AS n_pred, (SELECT count(*) FROM g) AS n_gold)
SELECT tp::BIGINT AS tp, n_pred::BIGINT AS n_pred, n_gold::BIGINT AS n_gold, tp / n_pred AS precision, tp / n_gold AS recall,
  2.0::DOUBLE * (tp / n_pred) * (tp / n_gold) / (tp / n_pred + tp / n_gold) AS f1 FROM s
""",
)
def prf_quality_rule(t: Tables) -> DataFrame:
    pred = t.documents.where("n_chars >= 300").select("doc_id", "source")
    gold = t.documents.join(t.labels.where("quality = 1"), "doc_id").select("doc_id", "source")
    return metrics.prf_micro(metrics.match_gold(pred, gold, ["source"], "doc_id"))


@query(
    "missing_routes",
    "J9",
    """
SELECT DISTINCT ref AS path FROM (SELECT unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS ref FROM pages)
WHERE ref NOT IN (SELECT concat('/', unnest(regexp_extract_all(text, '[A-Za-z]+'))) FROM documents)
""",
)
def missing_routes(t: Tables) -> DataFrame:
    wanted = t.pages.select(F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), F.lit(1))).alias("path"))
    return linking.missing_routes(wanted, _word_paths(t.documents, "path"))


@query(
    "plan_differences",
    "J10",
    """
WITH plan AS (SELECT c_custkey AS k, c_nationkey AS g, c_mktsegment AS v FROM customer),
m AS (SELECT c_custkey AS k, c_nationkey AS g, CASE WHEN c_acctbal < 500 THEN 'OTHER' ELSE c_mktsegment END AS v FROM customer WHERE c_acctbal >= 0 AND c_nationkey <> 7)
SELECT plan.k, plan.g, plan.v AS expected, m.v AS actual, CASE WHEN m.v IS NULL THEN 'missing' ELSE 'mismatch' END AS kind
FROM plan LEFT JOIN m USING (k, g) WHERE plan.g <> 7 AND m.v IS DISTINCT FROM plan.v
UNION ALL SELECT NULL, g, NULL, NULL, 'no_mapping' FROM (SELECT DISTINCT g FROM plan WHERE g NOT IN (SELECT g FROM m))
""",
)
def plan_differences(t: Tables) -> DataFrame:
    plan = t.customer.selectExpr("c_custkey AS k", "c_nationkey AS g", "c_mktsegment AS v")
    mapping = t.customer.where("c_acctbal >= 0 AND c_nationkey <> 7").selectExpr(
        "c_custkey AS k", "c_nationkey AS g", "CASE WHEN c_acctbal < 500 THEN 'OTHER' ELSE c_mktsegment END AS v"
    )
    return linking.plan_differences(plan, mapping, ["k", "g"], "v", group="g")


STATUS_NAME = "CASE o_orderstatus WHEN 'F' THEN 'machine_checked' WHEN 'O' THEN 'mapped' ELSE 'disputed' END"


def _state(t: Tables, first: str, last: str) -> DataFrame:
    rows = t.orders.where(f"o_orderdate >= timestamp '{first} 00:00:00' AND o_orderdate < timestamp '{last} 00:00:00'")
    return rows.groupBy(F.col("o_custkey").alias("k")).agg(F.max_by(F.expr(STATUS_NAME), "o_orderkey").alias("s"))


def _state_sql(first: str, last: str) -> str:
    return f"""SELECT o_custkey AS k, max_by({STATUS_NAME}, o_orderkey) AS s FROM orders
      WHERE o_orderdate >= TIMESTAMP '{first}' AND o_orderdate < TIMESTAMP '{last}' GROUP BY 1"""


BEFORE, AFTER = ("1995-01-01", "1998-04-01"), ("1998-04-01", "2002-01-01")


@query(
    "status_changes",
    "J11",
    f"""
WITH b AS ({_state_sql(*BEFORE)}), n AS ({_state_sql(*AFTER)})
SELECT k, coalesce(b.s, '') AS "from", coalesce(n.s, '(removed)') AS "to" FROM b FULL JOIN n USING (k) WHERE b.s IS DISTINCT FROM n.s
""",
)
def status_changes(t: Tables) -> DataFrame:
    return comparing.status_changes(_state(t, *BEFORE), _state(t, *AFTER), ["k"], "s")


@query(
    "rank_changes",
    "J12",
    f"""
WITH b AS ({_state_sql(*BEFORE)}), n AS ({_state_sql(*AFTER)}), r AS (SELECT * FROM (VALUES ('machine_checked', 5), ('mapped', 2), ('disputed', -1)) v(s, rank)),
j AS (SELECT k, b.s AS f, n.s AS t, rb.rank AS fr, rn.rank AS tr FROM b FULL JOIN n USING (k) LEFT JOIN r rb ON rb.s = b.s LEFT JOIN r rn ON rn.s = n.s)
SELECT k, CASE WHEN f IS NULL OR tr > fr THEN 'new' ELSE 'broken' END AS kind, f AS "from", t AS "to" FROM j WHERE f IS NULL OR t IS NULL OR tr <> fr
""",
)
def rank_changes(t: Tables) -> DataFrame:
    return comparing.rank_changes(_state(t, *BEFORE), _state(t, *AFTER), ["k"], "s")


DIFF_SQL = """
b AS (SELECT o_orderpriority AS g, o_custkey AS i, max_by(o_orderstatus, o_orderkey) AS s, max_by(sha256(o_totalprice::VARCHAR), o_orderkey) AS d
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-04-01' AND o_orderstatus <> 'P' GROUP BY ALL),
n AS (SELECT o_orderpriority AS g, o_custkey AS i, max_by(o_orderstatus, o_orderkey) AS s, max_by(sha256(o_totalprice::VARCHAR), o_orderkey) AS d
  FROM orders GROUP BY ALL)"""


def _version(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_orderpriority").alias("g"), F.col("o_custkey").alias("i")).agg(
        F.max_by("o_orderstatus", "o_orderkey").alias("s"),
        F.max_by(c.sha256(F.col("o_totalprice").cast("string")), "o_orderkey").alias("d"),
    )


def _versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = t.orders.where("o_orderdate < timestamp '1998-04-01 00:00:00' AND o_orderstatus <> 'P'")
    return _version(base), _version(t.orders)


@query(
    "group_changes",
    "J13 U1",
    f"""
WITH {DIFF_SQL}
SELECT g, count(b.s) AS items_before, count(n.s) AS items_after, count(*) FILTER (b.s IS NULL) AS items_added, count(*) FILTER (n.s IS NULL) AS items_removed,
  count(*) FILTER (b.s <> n.s) AS status_changed, count(*) FILTER (b.d <> n.d) AS text_drifted, 'changed' AS change, count(n.s) - count(b.s) AS item_delta
FROM b FULL JOIN n USING (g, i) GROUP BY g
""",
)
def group_changes(t: Tables) -> DataFrame:
    base, curr = _versions(t)
    return comparing.group_changes(base, curr, "g", "i", "s", "d")


@query(
    "text_drift",
    "J14",
    f"WITH {DIFF_SQL} SELECT g, i, b.d AS before, n.d AS after FROM b JOIN n USING (g, i) WHERE b.d <> n.d",
)
def text_drift(t: Tables) -> DataFrame:
    base, curr = _versions(t)
    return comparing.text_drift(base, curr, ["g", "i"], "d")


@query(
    "set_changes",
    "U1 J13",
    f"""
WITH {DIFF_SQL}
SELECT g, i, 'added' AS change FROM (SELECT g, i FROM n EXCEPT SELECT g, i FROM b)
UNION ALL SELECT g, i, 'removed' FROM (SELECT g, i FROM b EXCEPT SELECT g, i FROM n)
""",
)
def set_changes(t: Tables) -> DataFrame:
    base, curr = _versions(t)
    return comparing.set_changes(base, curr, ["g", "i"])


TOKENS = "SELECT DISTINCT {id}, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS tok FROM {table}"


@query(
    "suggest_benchmark_for_documents",
    "J15 K1",
    f"""
WITH a AS ({TOKENS.format(id="doc_id", text="text", table="documents")}), b AS ({TOKENS.format(id="item_id", text="text", table="benchmark")}),
na AS (SELECT doc_id, count(*) AS na FROM a GROUP BY 1), nb AS (SELECT item_id, count(*) AS nb FROM b GROUP BY 1),
s AS (SELECT doc_id, item_id, count(*) AS shared FROM a JOIN b USING (tok) GROUP BY ALL),
r AS (SELECT doc_id, item_id, shared / (na + nb - shared) AS score FROM s JOIN na USING (doc_id) JOIN nb USING (item_id))
SELECT doc_id, item_id, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, item_id) AS rank FROM r) WHERE rank <= 5
""",
)
def suggest_benchmark_for_documents(t: Tables) -> DataFrame:
    return similarity.suggest_by_overlap(t.documents, "doc_id", "text", t.benchmark, "item_id", "text", "item_id")


CONV_TOK = TOKENS.format(id="conv_id, turn", text="text", table="conversations WHERE role = '{role}'")


@query(
    "suggest_replies_in_conversation",
    "J15 K1",
    f"""
WITH a AS ({CONV_TOK.format(role="user")}), b AS (SELECT conv_id, turn AS reply, tok FROM ({CONV_TOK.format(role="assistant")})),
na AS (SELECT conv_id, turn, count(*) AS na FROM a GROUP BY ALL), nb AS (SELECT conv_id, reply, count(*) AS nb FROM b GROUP BY ALL),
s AS (SELECT conv_id, turn, reply, count(*) AS shared FROM a JOIN b USING (conv_id, tok) GROUP BY ALL),
r AS (SELECT conv_id, turn, reply, shared / (na + nb - shared) AS score FROM s JOIN na USING (conv_id, turn) JOIN nb USING (conv_id, reply))
SELECT conv_id, turn, reply, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, reply) AS rank FROM r) WHERE rank <= 2
""",
)
def suggest_replies_in_conversation(t: Tables) -> DataFrame:
    users = t.conversations.where("role = 'user'").select("conv_id", "turn", "text")
    replies = t.conversations.where("role = 'assistant'").select("conv_id", F.col("turn").alias("reply"), "text")
    return similarity.suggest_by_overlap(users, "turn", "text", replies, "reply", "text", "reply", ["conv_id"], k=2)


ND_SQL = """
tok AS (SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS tok FROM documents),
sets AS (SELECT doc_id, lang, count(*) AS n, string_agg(tok, ' ' ORDER BY tok) AS s FROM tok GROUP BY ALL),
cls AS (SELECT lang, s, min(doc_id) AS id, count(*) AS copies, any_value(n) AS n FROM sets GROUP BY ALL),
ct AS (SELECT c.id, c.lang, c.n, c.copies, t.tok FROM cls c JOIN tok t ON t.doc_id = c.id),
sh AS (SELECT x.lang, x.id AS a, y.id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, any_value(x.copies) AS n_a, any_value(y.copies) AS n_b, count(*) AS k
  FROM ct x JOIN ct y ON x.lang = y.lang AND x.tok = y.tok AND x.id < y.id AND least(x.n, y.n) >= 0.75 * greatest(x.n, y.n) GROUP BY ALL),
pairs AS (SELECT lang, a, b, k / (na + nb - k) AS similarity, n_a, n_b, n_a * n_b AS n_pairs FROM sh WHERE k / (na + nb - k) >= 0.75
  UNION ALL SELECT lang, id, id, 1.0, copies, copies, (copies * (copies - 1) // 2) FROM cls WHERE copies > 1)"""


@query(
    "near_duplicate_documents",
    "J16",
    f"WITH {ND_SQL} SELECT lang, a, b, similarity::DOUBLE AS similarity, n_a, n_b, n_pairs::BIGINT AS n_pairs FROM pairs",
)
def near_duplicate_documents(t: Tables) -> DataFrame:
    return similarity.near_duplicates(t.documents, "doc_id", ["lang"], "text")


@query(
    "exact_copy_classes",
    "J16 A10",
    f"WITH {ND_SQL} SELECT s.doc_id AS row_id, c.id AS class_id FROM sets s JOIN cls c USING (lang, s)",
)
def exact_copy_classes(t: Tables) -> DataFrame:
    _, members = similarity.token_classes(t.documents, "doc_id", ["lang"], "text")
    return members


@query(
    "unreused_near_duplicates",
    "V6 J16",
    """
WITH d AS (SELECT doc_id, lang, text FROM documents WHERE source NOT IN ('src1', 'src2', 'src3')),
tok AS (SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS tok FROM d),
sets AS (SELECT doc_id, lang, count(*) AS n FROM tok GROUP BY ALL),
sh AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM tok x JOIN tok y ON x.lang = y.lang AND x.tok = y.tok AND x.doc_id <> y.doc_id GROUP BY ALL),
p AS (SELECT a, b FROM sh JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE k / (x.n + y.n - k) >= 0.75)
SELECT a AS doc_id, count(*) AS partners, min(b) AS first_partner FROM p GROUP BY 1
""",
)
def unreused_near_duplicates(t: Tables) -> DataFrame:
    kind = """CASE source WHEN 'src1' THEN 'bridge_lemma' WHEN 'src2' THEN '' WHEN 'src3' THEN 'cross_paper_anchor'
              ELSE 'experimental_invariant' END AS value_kind"""
    rows = t.documents.selectExpr("doc_id", "lang", "text", kind)
    return similarity.unreused_near_duplicates(rows, "doc_id", ["lang"], "text")


@query(
    "substring_contamination",
    "J17",
    "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)",
)
def substring_contamination(t: Tables) -> DataFrame:
    items = t.benchmark.select("item_id", F.col("text").alias("passage"))
    return similarity.contains_join(t.documents.select("doc_id", "text"), "text", items, "passage").select("doc_id", "item_id")


@query(
    "upserted_part_prices",
    "J18",
    """
WITH e AS (SELECT p_partkey AS id, p_partkey AS pos, p_retailprice AS price, p_brand AS brand FROM part),
p AS (SELECT l_partkey AS id, l_suppkey * 100000000 + l_orderkey * 10 + l_linenumber AS pos, l_extendedprice AS price, l_returnflag AS brand FROM lineitem WHERE l_quantity >= 45
  UNION ALL SELECT 10000000 + o_orderkey, o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 400000),
g AS (SELECT id, max(pos) AS pos FROM p GROUP BY 1),
l AS (SELECT id, max(price) AS price FROM p JOIN g USING (id, pos) GROUP BY 1)
SELECT id, coalesce(l.price, e.price) AS price, CASE WHEN e.id IS NULL THEN 1 ELSE 0 END AS appended FROM e FULL JOIN l USING (id)
""",
)
def upserted_part_prices(t: Tables) -> DataFrame:
    existing = t.part.selectExpr("p_partkey AS id", "p_partkey AS pos", "p_retailprice AS price")
    lines = t.lineitem.where("l_quantity >= 45").selectExpr(
        "l_partkey AS id", "l_suppkey * 100000000 + l_orderkey * 10 + l_linenumber AS pos", "l_extendedprice AS price"
    )
    # Several lines can share a place; the highest price then stands for it.
    lines = lines.groupBy("id", "pos").agg(F.max("price").alias("price"))
    fresh = t.orders.where("o_totalprice > 400000").selectExpr("10000000 + o_orderkey AS id", "o_orderkey AS pos", "o_totalprice AS price")
    merged = linking.upsert(existing, lines.unionByName(fresh), ["id"], "pos")
    return merged.select("id", "price", "appended")


@query(
    "upsert_preview",
    "J18",
    """
SELECT p_partkey AS id, p_retailprice AS before, 1000.0::DOUBLE AS after FROM part WHERE p_type = 'PROMO' AND p_retailprice <> 1000.0
UNION ALL SELECT 5000000 + s_suppkey, NULL, s_acctbal FROM supplier
""",
)
def upsert_preview(t: Tables) -> DataFrame:
    existing = t.part.selectExpr("p_partkey AS id", "p_partkey AS pos", "p_retailprice AS price", "p_brand AS group_id")
    changes = t.part.where("p_type = 'PROMO'").selectExpr("p_partkey AS id", "p_partkey AS pos", "1000.0D AS price", "p_brand AS group_id", "p_brand AS wanted")
    stray = t.part.where("p_type = 'LARGE'").selectExpr("p_partkey AS id", "p_partkey AS pos", "1.0D AS price", "p_brand AS group_id", "'elsewhere' AS wanted")
    fresh = t.supplier.selectExpr("5000000 + s_suppkey AS id", "s_suppkey AS pos", "s_acctbal AS price", "'s' AS group_id", "'s' AS wanted")
    proposals = changes.unionByName(stray).unionByName(fresh)
    merged = linking.upsert(existing, proposals, ["id"], "pos", expect=("group_id", "wanted"))
    out = linking.upsert_preview(existing, merged, ["id"], ["price"])
    return out.select("id", F.col("before.price").alias("before"), F.col("after.price").alias("after"))


@query(
    "merged_map_entries",
    "J19",
    """
SELECT coalesce(p.p_brand, u.g) AS g, coalesce(p.k, u.k) AS k, coalesce(u.v, p.v) AS v FROM
 (SELECT p_brand, p_name AS k, count(*) AS v FROM part GROUP BY ALL) p
 FULL JOIN (SELECT p_brand AS g, p_name AS k, -1::BIGINT AS v FROM part WHERE p_size > 45 GROUP BY ALL
   UNION ALL SELECT p_brand, concat('new ', p_type), 0 FROM part GROUP BY ALL) u ON p.p_brand = u.g AND p.k = u.k
""",
)
def merged_map_entries(t: Tables) -> DataFrame:
    existing = t.part.groupBy(F.col("p_brand").alias("g"), F.col("p_name").alias("k")).agg(F.count(F.lit(1)).alias("v"))
    big = t.part.where("p_size > 45").selectExpr("p_brand AS g", "p_name AS k", "-1L AS v").distinct()
    fresh = t.part.selectExpr("p_brand AS g", "concat('new ', p_type) AS k", "0L AS v").distinct()
    return linking.merge_entries(existing, big.unionByName(fresh), ["g", "k"], "v")


@query(
    "claims_with_links",
    "J20",
    """
SELECT l_orderkey, l_linenumber, l_partkey, count(*) AS n, min(p_name) AS p_name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <= 25 GROUP BY ALL
""",
)
def claims_with_links(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.array("l_partkey", F.lit(-1).cast("long")).alias("links"))
    parts = t.part.where("p_size <= 25").select("p_partkey", "p_name")
    out = linking.rows_with_links(rows, ["l_orderkey", "l_linenumber"], [], "links", parts, "p_partkey")
    return out.groupBy("l_orderkey", "l_linenumber", F.col("linked_id").alias("l_partkey")).agg(
        F.count(F.lit(1)).alias("n"), F.min("p_name").alias("p_name")
    )


@query(
    "card_lookup",
    "J21 W10",
    """
WITH cards AS (SELECT concat('p', p_partkey) AS id, p_brand AS paper_id, p_partkey AS pos, concat('N.', replace(p_name, ' ', '_')) AS decl, p_type AS claim_id FROM part),
keys AS (SELECT DISTINCT concat('p', l_partkey) AS lookup FROM lineitem UNION SELECT DISTINCT decl FROM cards UNION SELECT DISTINCT claim_id FROM cards UNION SELECT replace(p_name, ' ', '_') FROM part UNION SELECT 'nothing'),
m AS (SELECT lookup, 0 AS kind, paper_id, pos, id FROM keys JOIN cards ON id = lookup UNION ALL SELECT lookup, 1, paper_id, pos, id FROM keys JOIN cards ON decl = lookup
  UNION ALL SELECT lookup, 2, paper_id, pos, id FROM keys JOIN cards ON claim_id = lookup UNION ALL SELECT lookup, 3, paper_id, pos, id FROM keys JOIN cards ON substr(decl, 3) = lookup)
SELECT lookup, id AS card_id, paper_id, kind FROM (SELECT *, row_number() OVER (PARTITION BY lookup ORDER BY kind, paper_id, pos) AS rn FROM m) WHERE rn = 1
""",
)
def card_lookup(t: Tables) -> DataFrame:
    cards = t.part.selectExpr(
        "concat('p', p_partkey) AS id", "p_brand AS paper_id", "p_partkey AS pos", "concat('N.', replace(p_name, ' ', '_')) AS lean_decl", "p_type AS claim_id"
    )
    lines = t.lineitem.selectExpr("concat('p', l_partkey) AS lookup")
    keys = lines.union(cards.select("lean_decl")).union(cards.select("claim_id")).union(cards.select(c.last_part("lean_decl")))
    keys = keys.union(t.region.selectExpr("'nothing'"))
    return linking.card_lookup(keys, cards)


@query(
    "kernel_lookup",
    "J22",
    """
SELECT coalesce(k.id, r.kernel_id) AS kernel_id, CASE WHEN k.id IS NULL THEN 'unknown' ELSE k.domain END AS domain, r.paper_id, CASE WHEN k.id IS NULL THEN 1 ELSE 0 END AS placeholder
FROM (SELECT concat('s', s_suppkey) AS id, concat('nation', s_nationkey) AS domain FROM supplier WHERE s_acctbal >= 0) k
FULL JOIN (SELECT DISTINCT concat('s', l_suppkey) AS kernel_id, concat('o', l_orderkey) AS paper_id FROM lineitem WHERE l_returnflag = 'A') r ON k.id = r.kernel_id
""",
)
def kernel_lookup(t: Tables) -> DataFrame:
    kernels = t.supplier.where("s_acctbal >= 0").selectExpr("concat('s', s_suppkey) AS id", "concat('nation', s_nationkey) AS domain")
    refs = t.lineitem.where("l_returnflag = 'A'").selectExpr("concat('s', l_suppkey) AS kernel_id", "concat('o', l_orderkey) AS paper_id")
    out = linking.kernel_lookup(kernels, refs)
    return out.withColumn("placeholder", F.col("placeholder").cast("int"))


@query(
    "recomputed_vs_stored",
    "J23 V9",
    """
WITH s AS (SELECT l_orderkey, max(l_linenumber)::DOUBLE AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1),
r AS (SELECT l_orderkey, count(*)::DOUBLE AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)
SELECT s.l_orderkey, 'lines' AS metric, s.lines AS stored, r.lines AS expected FROM s JOIN r USING (l_orderkey) WHERE s.lines <> r.lines
""",
)
def recomputed_vs_stored(t: Tables) -> DataFrame:
    stored = t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("lines"), F.sum("l_quantity").alias("quantity"))
    fresh = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    return linking.compare_recomputed(stored, fresh, ["l_orderkey"], ["lines", "quantity"])


@query(
    "word_mentions",
    "J24",
    """
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z0-9'']+')) AS name FROM benchmark)
SELECT doc_id, name FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9'']+')) AS name FROM documents) JOIN w USING (name) WHERE name <> 'the'
""",
)
def word_mentions(t: Tables) -> DataFrame:
    words = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9']+"), F.lit(0)))
    names = t.benchmark.select(words.alias("name")).distinct()
    docs = t.documents.select("doc_id", "text", F.lit("the").alias("own"))
    return similarity.mention_join(docs, "doc_id", "text", names, "name", "own").select("doc_id", "name")


@query(
    "shortest_prefix_names",
    "J25",
    """
WITH n AS (SELECT min(doc_id) AS pos, w AS name FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) GROUP BY 2),
k AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS tok FROM benchmark)
SELECT tok, name AS match FROM (SELECT tok, name, row_number() OVER (PARTITION BY tok ORDER BY length(name), pos, name) AS rn FROM k JOIN n ON starts_with(name, tok)
  WHERE name <> concat(tok, 's')) WHERE rn = 1
""",
)
def shortest_prefix_names(t: Tables) -> DataFrame:
    def words(df: DataFrame) -> DataFrame:
        return df.select("*", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))).alias("w"))

    names = words(t.documents).groupBy(F.col("w").alias("name")).agg(F.min("doc_id").alias("pos"))
    tokens = words(t.benchmark).select(F.col("w").alias("tok"), F.concat("w", F.lit("s")).alias("own")).distinct()
    return similarity.prefix_join(tokens, "tok", names, "name", "pos", self_name="own").select("tok", "match")


@query(
    "page_owner_by_path",
    "J26",
    """
WITH f AS (SELECT page_id, regexp_replace(regexp_extract(url, '://([^?#]*)', 1), '/$', '') AS path FROM pages),
o AS (SELECT DISTINCT regexp_extract(url, '://([^?#/]*/[a-z]+)', 1) AS prefix FROM pages),
p AS (SELECT prefix, row_number() OVER (ORDER BY prefix) AS pos FROM o)
SELECT f.page_id, min_by(concat('o:', prefix), pos) AS owner FROM f JOIN p ON f.path = prefix OR starts_with(f.path, concat(prefix, '/')) GROUP BY 1
""",
)
def page_owner_by_path(t: Tables) -> DataFrame:
    files = t.pages.select("page_id", F.regexp_replace(F.regexp_extract("url", "://([^?#]*)", 1), "/$", "").alias("path"))
    # Prefixes are dotted on input; dots of host names are kept apart by a comma.
    files = files.withColumn("path", F.translate("path", ".", ","))
    host = F.regexp_extract("url", "://([^?#/]*/[a-z]+)", 1)
    prefixes = t.pages.select(host.alias("host")).distinct().select(
        F.translate("host", ".", ",").alias("prefix"), F.concat(F.lit("o:"), "host").alias("owner"), F.col("host").alias("pos")
    )
    owned = similarity.path_prefix_join(files.select("path").distinct(), "path", prefixes, "prefix", "owner", "pos")
    return files.join(owned, "path").select("page_id", "owner")


@query(
    "owner_by_declared_namespace",
    "J26",
    """
SELECT concat('d', o_orderkey) AS path, CASE o_orderstatus WHEN 'F' THEN concat('own_', o_orderpriority) WHEN 'O' THEN 'own_1-URGENT' END AS owner FROM orders
""",
)
def owner_by_declared_namespace(t: Tables) -> DataFrame:
    files = t.orders.selectExpr(
        "concat('d', o_orderkey) AS path",
        """CASE o_orderstatus WHEN 'F' THEN concat('namespace Un.known\\nnamespace N.x', substr(o_orderpriority, 1, 1))
             WHEN 'O' THEN 'namespace  N.x1 namespace N.x2' ELSE 'none' END AS text""",
    )
    owners = t.orders.selectExpr(
        "concat('N.x', substr(o_orderpriority, 1, 1)) AS prefix", "concat('own_', o_orderpriority) AS owner", "o_orderpriority AS pos"
    ).distinct()
    out = similarity.path_prefix_join(files, "path", owners, "prefix", "owner", "pos", text="text")
    return out.select("path", "owner")


@query(
    "dependency_edges",
    "T1 T2 T3 T4 J24 J25 W5 A35",
    """
WITH c AS (SELECT concat('k', p_partkey) AS p, p_size FROM part)
SELECT p AS paper_id, concat(p, '_card_2') AS card_id, concat(p, '_card_1') AS dependency_id, 1 AS tier FROM c
UNION ALL SELECT p, concat(p, '_card_3'), concat(p, '_card_2'), 0 FROM c
UNION ALL SELECT p, concat(p, '_card_4'), concat(p, '_card_1'), 1 FROM c
UNION ALL SELECT p, concat(p, '_card_5'), concat(p, '_card_3'), CASE WHEN p_size > 25 THEN 1 ELSE 0 END FROM c
UNION ALL SELECT p, concat(p, '_card_5'), concat(p, '_card_4'), 0 FROM c WHERE p_size > 25
""",
)
def dependency_edges(t: Tables) -> DataFrame:
    docs, cards = _source_texts(t)
    return documents.dependency_edges(cards, docs, "Corpus")


def _source_texts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A small source file and five cards per part."""
    docs = t.part.selectExpr(
        "concat('formal/k', p_partkey, '.lean') AS path",
        """concat('/- base_def is\\n not used -/\\n@[simp]\\ndef base_def := Core\\n', '-- ring_step in a comment\\n',
             'theorem unfolded : T := by\\n  unfold base_d\\n  rfl\\n', 'lemma ring_step : T := by ring\\n',
             'theorem aliased : T := by\\n  exact Core.mul\\n',
             CASE WHEN p_size > 25 THEN concat('noncomputable def last_one : T :=\\n  Corpus.K', p_partkey, ".ring_step + aliased'\\n aliased")
               ELSE 'noncomputable def last_one : T :=\\n  ring_step' END, '\\nend Corpus\\n  base_def') AS text""",
    )
    names = "array('base_def', 'unfolded', 'ring_step', 'aliased', 'last_one')"
    cards = t.part.selectExpr("p_partkey", f"posexplode({names}) AS (pos, short)").selectExpr(
        "concat('k', p_partkey) AS paper_id", "pos", "concat('k', p_partkey, '_card_', pos + 1) AS id",
        "concat('Corpus.K', p_partkey, '.', short) AS lean_decl", "concat('formal/k', p_partkey, '.lean') AS file_path",
    )
    return docs, cards


@query(
    "published_dependencies",
    "T4 A35 J3",
    """
WITH c AS (SELECT concat('k', p_partkey) AS p, p_size FROM part)
SELECT p AS paper_id, concat(p, '_card_1') AS src, concat(p, '_card_2') AS dst, 'high' AS confidence FROM c
UNION ALL SELECT p, concat(p, '_card_2'), concat(p, '_card_3'), 'medium' FROM c
UNION ALL SELECT p, concat(p, '_card_1'), concat(p, '_card_4'), 'high' FROM c
UNION ALL SELECT p, concat(p, '_card_3'), concat(p, '_card_5'), CASE WHEN p_size > 25 THEN 'high' ELSE 'medium' END FROM c
UNION ALL SELECT p, concat(p, '_card_4'), concat(p, '_card_5'), 'high' FROM c WHERE p_size > 25
""",
)
def published_dependencies(t: Tables) -> DataFrame:
    docs, cards = _source_texts(t)
    cards = cards.withColumn("dependency_extraction_method", F.lit(""))
    full = documents.with_dependencies(cards, documents.dependency_edges(cards, docs, "Corpus"))
    return metrics.edges_from_cards(full)


@query(
    "lookup_indices",
    "A37 W10 U3",
    """
SELECT 'declaration' AS kind, p_name AS k, min_by(concat('p', p_partkey), (p_brand, p_partkey)) AS v FROM part GROUP BY p_name
UNION ALL SELECT 'claim', concat('o', o_orderkey), concat('c', o_custkey) FROM orders
UNION ALL SELECT DISTINCT 'kernel', concat('s', l_suppkey), concat('o', l_orderkey) FROM lineitem
UNION ALL SELECT 'route', route, '' FROM (SELECT concat('p', p_partkey) AS route FROM part UNION SELECT p_name FROM part)
""",
)
def lookup_indices(t: Tables) -> DataFrame:
    cards = t.part.selectExpr("concat('p', p_partkey) AS id", "p_brand AS paper_id", "p_partkey AS pos", "p_name AS lean_decl")
    claims = t.orders.selectExpr("concat('o', o_orderkey) AS id", "concat('c', o_custkey) AS paper_id")
    manifests = t.lineitem.selectExpr("concat('o', l_orderkey) AS paper_id", "array(concat('s', l_suppkey)) AS kernel_index")
    kernels = t.supplier.selectExpr("concat('s', s_suppkey) AS id", "s_suppkey AS pos", "array('x') AS linked_theorem_cards")
    out = publication.lookup_tables(cards, claims, manifests, kernels)

    def rows(df: DataFrame, kind: str, key: str, value: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("k"), F.expr(value).alias("v"))

    return (
        rows(out["declaration_to_card"], "declaration", "lean_decl", "card_id")
        .unionByName(rows(out["claim_to_paper"], "claim", "id", "paper_id"))
        .unionByName(rows(out["kernel_to_paper"], "kernel", "kernel_id", "paper_id"))
        .unionByName(rows(out["route_ids"], "route", "route", "''"))
    )


@query(
    "kernel_first_seen",
    "A37 W12",
    """
SELECT concat('s', l_suppkey) AS kernel_id, concat('p', l_partkey) AS card_id, min(l_orderkey) AS first_order FROM lineitem GROUP BY ALL
""",
)
def kernel_first_seen(t: Tables) -> DataFrame:
    rows = t.lineitem.selectExpr("concat('s', l_suppkey) AS kernel_id", "concat('p', l_partkey) AS card_id", "l_orderkey")
    out = metrics.reverse_index(rows, "kernel_id", "card_id", ["l_orderkey"])
    return out.select("kernel_id", "card_id", F.col("first_seen.l_orderkey").alias("first_order"))
