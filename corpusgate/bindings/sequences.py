"""Order-dependent, text, check and numeric operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.bindings.base import Tables, query
from corpusgate.bindings.joins import _source_texts
from corpusgate.functions import columns as c
from corpusgate.operators import checks, documents, linking, numeric, ordering
from corpusgate.schemas import Rule
from corpusgate.sources import export

N = "*"


@query(
    "part_name_overload_later",
    "W1",
    "SELECT p_partkey, (row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) > 1)::INT AS overloaded FROM part",
)
def part_name_overload_later(t: Tables) -> DataFrame:
    out = ordering.later_duplicates(t.part, ["p_brand", "p_name"], "p_partkey", "overloaded")
    return out.select("p_partkey", F.col("overloaded").cast("int").alias("overloaded"))


@query(
    "part_name_overload_all",
    "W2",
    "SELECT p_partkey, (count(*) OVER (PARTITION BY p_brand, p_name) > 1)::INT AS overloaded FROM part",
)
def part_name_overload_all(t: Tables) -> DataFrame:
    out = ordering.all_duplicates(t.part, ["p_brand", "p_name"], "overloaded")
    return out.select("p_partkey", F.col("overloaded").cast("int").alias("overloaded"))


STOP = ", ".join(f"'{w}'" for w in c.VOCABULARY_STOPWORDS)


@query(
    "vocabulary_first24",
    "W3 K3",
    f"""
WITH w AS (SELECT source, doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS ord FROM (SELECT source, doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS toks FROM documents)),
f AS (SELECT source, token, min((doc_id, ord)) AS first FROM w WHERE length(token) >= 2 AND token NOT IN ({STOP}) GROUP BY ALL)
SELECT source, token, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY first) AS rank FROM f) WHERE rank <= 24
""",
)
def vocabulary_first24(t: Tables) -> DataFrame:
    out = ordering.first_seen_vocabulary(t.documents, "source", "doc_id", "text", 24, tokens=c.alnum_tokens("text"))
    return out.select("source", "token", "rank")


@query(
    "sequential_keys",
    "W4",
    """
WITH n AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_orderkey, CASE WHEN n = 1 THEN concat('c_', o_custkey, '_card_001') ELSE concat('c-', o_custkey, '_card_', lpad(i::VARCHAR, 3, '0')) END AS key FROM n
""",
)
def sequential_keys(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr("concat('c-', o_custkey) AS paper_id", "o_orderkey")
    out = ordering.sequential_keys(rows, "paper_id", [F.col("o_orderkey")], chunk=F.floor(F.col("o_orderkey") / 5000))
    return out.select("o_orderkey", "key")


@query(
    "previous_declaration",
    "W5 T2",
    """
SELECT concat('formal/k', p_partkey, '.lean') AS path, i::INT AS pos, name, lag(name) OVER (PARTITION BY p_partkey ORDER BY i) AS previous
FROM part, (VALUES (0, 'base_def'), (1, 'unfolded'), (2, 'ring_step'), (3, 'aliased'), (4, 'last_one')) v(i, name)
""",
)
def previous_declaration(t: Tables) -> DataFrame:
    docs, _ = _source_texts(t)
    clean = docs.select("path", documents.strip_comments(F.col("text")).alias("text"))
    return documents.segments(clean, "path", "text").select("path", "pos", "name", "previous")


@query(
    "trend_drop",
    "W6",
    """
WITH d AS (SELECT event_type, date_trunc('day', ts)::DATE AS day, (count(*) FILTER (value > 10)) / count(*) AS fraction FROM events GROUP BY ALL),
l AS (SELECT *, lag(fraction) OVER (PARTITION BY event_type ORDER BY day) AS previous FROM d)
SELECT event_type, day, fraction, previous FROM l WHERE fraction < previous
""",
)
def trend_drop(t: Tables) -> DataFrame:
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        c.ratio(F.count_if(F.col("value") > 10), F.count(N)).alias("fraction")
    )
    return ordering.value_drops(daily, ["event_type"], "day", "fraction")


@query("keep_last_100", "W7", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100")
def keep_last_100(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return ordering.keep_latest(rows, [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 100)


@query(
    "appended_trend",
    "W7 A39",
    """
WITH h AS (SELECT date_trunc('hour', ts)::VARCHAR AS timestamp, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT '2025-01-01 00:00:00', count(*) FROM orders)
SELECT timestamp, n FROM h ORDER BY timestamp DESC LIMIT 100
""",
)
def appended_trend(t: Tables) -> DataFrame:
    hourly = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("timestamp")).agg(F.count(N).alias("n"))
    entry = t.orders.agg(F.count(N).alias("n")).select(F.lit("2025-01-01 00:00:00").alias("timestamp"), "n")
    return export.append_trend(hourly, entry)


@query(
    "text_budget",
    "W8",
    """
WITH r AS (SELECT conv_id, turn, text, length(text) AS n, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM conversations)
SELECT conv_id, string_agg(substr(text, 1, least(2000 - used, n)::BIGINT), '' ORDER BY turn) AS text FROM r WHERE used < 2000 GROUP BY 1
""",
)
def text_budget(t: Tables) -> DataFrame:
    return ordering.budgeted_text(t.conversations, "conv_id", "turn", "text", 2000, chunk=F.floor(F.col("turn") / 4))


@query(
    "numbered_headings",
    "W9 T5",
    """
WITH h AS (SELECT page_id, regexp_extract_all(html, '<h[1-6][^>]*>(.*?)</h[1-6]>', 1, 's') AS hs FROM pages)
SELECT page_id, i::INT AS section, substr(trim(regexp_replace(h, '<[^>]*>', '', 'g')), 1, 500) AS informal_text FROM (SELECT page_id, unnest(hs) AS h, generate_subscripts(hs, 1) AS i FROM h)
""",
)
def numbered_headings(t: Tables) -> DataFrame:
    return documents.headings(t.pages, "page_id", "html").select("page_id", "section", "informal_text")


@query(
    "first_and_last_wins",
    "W10",
    """
SELECT p_name, min_by(p_brand, p_partkey) AS first_brand, max_by(p_brand, p_partkey) AS last_brand FROM part GROUP BY 1
""",
)
def first_and_last_wins(t: Tables) -> DataFrame:
    first = ordering.first_wins(t.part.withColumn("first_brand", F.col("p_brand")), ["p_name"], "first_brand", ["p_partkey"])
    last = ordering.last_wins(t.part.withColumn("last_brand", F.col("p_brand")), ["p_name"], "last_brand", ["p_partkey"])
    return first.join(last, "p_name")


@query(
    "monotone_breaks",
    "W11",
    """
WITH r AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders)
SELECT o_custkey, o_orderkey, o_totalprice, previous FROM r WHERE previous > o_totalprice + 1e-9
""",
)
def monotone_breaks(t: Tables) -> DataFrame:
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    out = ordering.monotone_breaks(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", chunk=month)
    return out.select("o_custkey", "o_orderkey", "o_totalprice", "previous")


@query(
    "ordered_distinct_tokens",
    "W12 F",
    """
WITH w AS (SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS ord FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS toks FROM documents)),
f AS (SELECT doc_id, tok, min(ord) AS ord FROM w GROUP BY ALL)
SELECT doc_id, string_agg(tok, ' ' ORDER BY ord) AS tokens FROM f GROUP BY 1
""",
)
def ordered_distinct_tokens(t: Tables) -> DataFrame:
    toks = F.array_distinct(c.alnum_tokens("text"))
    return t.documents.where(F.size(toks) > 0).select("doc_id", F.array_join(toks, " ").alias("tokens"))


@query(
    "timestamp_set_once",
    "W13",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '2024-05-01T00:00:00Z' END AS first_artifact_at FROM orders",
)
def timestamp_set_once(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr("o_orderkey", "CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN '' END AS old")
    return rows.select("o_orderkey", ordering.set_once(F.col("old"), F.lit("2024-05-01T00:00:00Z")).alias("first_artifact_at"))


@query(
    "top_lines_per_order",
    "K1",
    """
SELECT l_orderkey, l_extendedprice, rank::INT AS rank FROM (SELECT l_orderkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC) AS rank FROM lineitem) WHERE rank <= 5
""",
)
def top_lines_per_order(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_extendedprice")
    return ordering.top_k(rows, ["l_orderkey"], [F.col("l_extendedprice").desc()], 5)


@query(
    "first_violation",
    "K5 V7",
    """
SELECT concat('c', o_custkey) AS group_id, concat('o', o_orderkey) AS row_id FROM orders WHERE o_orderstatus = 'P' AND o_totalprice <= 250000
ORDER BY o_custkey, o_orderkey LIMIT 1
""",
)
def first_violation(t: Tables) -> DataFrame:
    bad = checks.lifecycle(_claims(t)).withColumn("c", F.substring("group_id", 2, 20).cast("long"))
    return bad.orderBy("c", F.substring("row_id", 2, 20).cast("long")).limit(1).select("group_id", "row_id")


def _claims(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "concat('c', o_custkey) AS paper_id", "concat('o', o_orderkey) AS id", "o_orderkey AS pos",
        "CASE o_orderstatus WHEN 'F' THEN 'machine_checked' WHEN 'O' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'odd' ELSE 'mapped' END ELSE 'disputed' END AS status",
        "CASE WHEN o_totalprice > 250000 THEN 'why' ELSE ' ' END AS review_notes",
    )


@query(
    "set_equality",
    "U4",
    """
SELECT l_orderkey, l_linenumber, sum((l_partkey = l_suppkey)::INT)::BIGINT AS n_equal FROM lineitem GROUP BY ALL
""",
)
def set_equality(t: Tables) -> DataFrame:
    a, b = F.array("l_partkey", "l_suppkey", "l_partkey"), F.array("l_suppkey")
    same = (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count_if(same).alias("n_equal"))


# --- checks -----------------------------------------------------------------------------------

ORDER_RULES = [
    Rule("o_orderstatus", "one_of", ("F", "O")),
    Rule("o_orderpriority", "pattern", "^[1-4]-[A-Z]+$"),
    Rule("o_totalprice", "at_most", 400000),
    Rule("comment", "required"),
    Rule("comment", "filled"),
]


@query(
    "schema_conformance",
    "V1",
    """
SELECT o_orderkey, 'o_orderstatus' AS field, 'one_of' AS rule FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 'o_orderpriority', 'pattern' FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-4]-[A-Z]+$')
UNION ALL SELECT o_orderkey, 'o_totalprice', 'at_most' FROM orders WHERE o_totalprice > 400000
UNION ALL SELECT o_orderkey, 'comment', 'required' FROM orders WHERE o_custkey < 100
UNION ALL SELECT o_orderkey, 'comment', 'filled' FROM orders WHERE o_custkey >= 100 AND o_custkey < 200
UNION ALL SELECT o_orderkey, 'extra', 'unknown_field' FROM orders WHERE o_orderstatus = 'O'
""",
)
def schema_conformance(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(
        "*", "CASE WHEN o_custkey < 100 THEN NULL WHEN o_custkey < 200 THEN '' ELSE 'c' END AS comment",
        """concat('{"o_orderkey": 1, "o_orderstatus": "x"', CASE WHEN o_orderstatus = 'O' THEN ', "extra": 2' ELSE '' END, '}') AS raw""",
    )
    allowed = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "comment"]
    return checks.conformance(rows, ORDER_RULES, ["o_orderkey"], raw="raw", allowed=allowed)


@query(
    "nested_conformance",
    "V1 V13",
    """
SELECT p_partkey, 'source.kind' AS field, 'one_of' AS rule FROM part WHERE p_type = 'LARGE'
UNION ALL SELECT p_partkey, 'tags', 'min_items' FROM part WHERE p_size <= 10
UNION ALL SELECT p_partkey, 'tags', 'items_pattern' FROM part WHERE p_size > 10
UNION ALL SELECT p_partkey, 'tags', 'items_one_of' FROM part WHERE p_size > 10 AND p_type <> 'PROMO'
""",
)
def nested_conformance(t: Tables) -> DataFrame:
    rows = t.part.selectExpr(
        "p_partkey", "named_struct('kind', p_type) AS source",
        "CASE WHEN p_size > 10 THEN array('PROMO', p_type) ELSE cast(array() AS array<string>) END AS tags",
    )
    rules = [
        Rule("source.kind", "required"),
        Rule("source.kind", "one_of", ("PROMO", "SMALL", "STANDARD", "ECONOMY", "MEDIUM")),
        Rule("tags", "min_items", 1),
        Rule("tags", "items_pattern", "^[a-z]+$"),
        Rule("tags", "items_one_of", ("PROMO",)),
        Rule("tags", "items_filled"),
    ]
    return checks.conformance(rows, rules, ["p_partkey"])


NORM_SQL = """
SELECT 'duplicate claim id' AS message, group_id, row_id FROM (SELECT concat('o', l_orderkey) AS group_id, concat('l', l_linenumber) AS row_id FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT concat('linked_assumptions references missing p', l_partkey), concat('o', l_orderkey), concat('l', l_linenumber) FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 25
UNION ALL SELECT 'duplicate symbol id', 'all', p_name FROM part GROUP BY p_name HAVING count(*) > 1
"""


@query("normalization_integrity", "V2 A31 J2f", f"SELECT message, group_id, row_id, count(*) AS n FROM ({NORM_SQL}) GROUP BY ALL")
def normalization_integrity(t: Tables) -> DataFrame:
    claims = t.lineitem.selectExpr(
        "concat('o', l_orderkey) AS paper_id", "concat('l', l_linenumber) AS id", "array(concat('p', l_partkey)) AS linked_assumptions",
        "cast(array() AS array<string>) AS linked_symbols",
    )
    known = t.part.where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    assumptions = t.lineitem.join(known, "l_partkey").selectExpr("concat('o', l_orderkey) AS paper_id", "concat('p', l_partkey) AS id").distinct()
    symbols = t.part.selectExpr("'all' AS paper_id", "p_name AS id")
    out = checks.normalization_integrity(claims, assumptions, symbols)
    return out.groupBy("message", "group_id", "row_id").agg(F.count(N).alias("n"))


@query(
    "provenance_integrity",
    "V3 J2i",
    """
SELECT concat('c', c_custkey) AS group_id, concat('c', c_custkey) AS row_id, 'manifest with all-zero source hash' AS message FROM customer
  WHERE c_acctbal < 0 AND c_nationkey < 20 AND NOT (c_mktsegment = 'BUILDING' AND c_custkey NOT IN (SELECT o_custkey FROM orders))
UNION ALL SELECT concat('c', o_custkey), concat('o', o_orderkey), 'missing source_span' FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT concat('c', c_custkey), concat('N.', c_mktsegment), 'declaration without mapped claim' FROM customer WHERE c_nationkey < 20 AND c_mktsegment <> 'MACHINERY'
""",
)
def provenance_integrity(t: Tables) -> DataFrame:
    papers = t.customer.selectExpr(
        "concat('c', c_custkey) AS id", "CASE c_mktsegment WHEN 'BUILDING' THEN array('x', 'hardness.primary:units') WHEN 'MACHINERY' THEN NULL ELSE array('y') END AS tags",
        "named_struct('sha256', CASE WHEN c_acctbal < 0 THEN repeat('0', 64) ELSE sha2(c_name, 256) END) AS source",
    )
    claims = t.orders.selectExpr(
        "concat('c', o_custkey) AS paper_id", "concat('o', o_orderkey) AS id",
        "CASE WHEN o_orderstatus <> 'P' THEN named_struct('source_file', 'f') END AS source_span",
    )
    manifests = t.customer.where("c_nationkey < 20").selectExpr("concat('c', c_custkey) AS paper_id", "array(concat('N.', c_mktsegment)) AS declaration_index")
    mapping = t.customer.selectExpr("concat('c', c_custkey) AS paper_id", "' N ' AS namespace", "map('k', 'MACHINERY') AS claim_to_decl")
    return checks.provenance(papers, claims, manifests, mapping).select("group_id", "row_id", "message")


@query(
    "extraction_run_required",
    "V4",
    "SELECT DISTINCT o_custkey::VARCHAR AS group_id FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)",
)
def extraction_run_required(t: Tables) -> DataFrame:
    claims = t.orders.select(F.col("o_custkey").alias("paper_id"))
    runs = t.events.select(F.col("user_id").alias("paper_id"))
    return checks.extraction_run_required(claims, runs).select("group_id")


GRAPH_FINDINGS = """
WITH papers AS (SELECT DISTINCT concat('c', o_custkey) AS p FROM orders),
cards AS (SELECT concat('c', o_custkey) AS p, concat('c', o_custkey, '_', l_orderkey, '_', l_linenumber) AS id, l_orderkey, l_suppkey, l_partkey, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
claims AS (SELECT concat('c', o_custkey) AS p, concat('o', o_orderkey) AS id FROM orders WHERE o_orderstatus <> 'P')
SELECT concat('card claim is missing: o', l_orderkey) AS message, p AS group_id, id AS row_id FROM cards WHERE (p, concat('o', l_orderkey)) NOT IN (SELECT (p, id) FROM claims) AND p IN (SELECT p FROM claims)
UNION ALL SELECT concat('card dependency is missing: s', l_suppkey), p, id FROM cards WHERE p IN (SELECT p FROM claims)
UNION ALL SELECT concat('card dependency is missing: ', p, '_', l_orderkey, '_1'), p, id FROM cards
  WHERE p IN (SELECT p FROM claims) AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)
UNION ALL SELECT concat('claim symbol is missing: ', s), concat('c', o_custkey), concat('o', o_orderkey)
  FROM orders JOIN customer ON c_custkey = o_custkey, (VALUES ('BUILDING'), ('MACHINERY')) v(s) WHERE o_orderstatus <> 'P' AND c_acctbal >= 0 AND c_mktsegment <> s
UNION ALL SELECT concat('card kernel is missing: p', l_partkey), p, id FROM cards WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25) AND p IN (SELECT p FROM claims)
UNION ALL SELECT 'card without file_path', p, id FROM cards WHERE l_returnflag = 'N' AND p IN (SELECT p FROM claims)
UNION ALL SELECT concat('mapping claim is missing: o', o_orderkey), concat('c', o_custkey), concat('c', o_custkey) FROM orders WHERE o_orderstatus = 'P' AND concat('c', o_custkey) IN (SELECT p FROM claims)
UNION ALL SELECT concat('manifest kernel is missing: n', c_nationkey), concat('c', c_custkey), concat('c', c_custkey) FROM customer WHERE concat('c', c_custkey) IN (SELECT p FROM claims)
UNION ALL SELECT concat('claim assumption is missing: ', o_orderpriority), concat('c', o_custkey), concat('o', o_orderkey) FROM orders JOIN customer ON c_custkey = o_custkey
  WHERE o_orderstatus <> 'P' AND c_mktsegment = 'BUILDING' AND o_orderpriority <> '1-URGENT'
UNION ALL SELECT concat('kernel card is missing: ', p_name), '', concat('p', p_partkey) FROM part WHERE p_size <= 25
"""


@query("graph_integrity", "V5 J2a J2b J2c J2d J2e J2f J2g J2h", f"SELECT message, group_id, row_id, count(*) AS n FROM ({GRAPH_FINDINGS}) GROUP BY ALL")
def graph_integrity(t: Tables) -> DataFrame:
    claims = t.orders.where("o_orderstatus <> 'P'").selectExpr(
        "concat('c', o_custkey) AS paper_id", "concat('o', o_orderkey) AS id", "array(o_orderpriority, '') AS linked_assumptions", "array('BUILDING', 'MACHINERY') AS linked_symbols"
    )
    assumptions = t.customer.where("c_mktsegment = 'BUILDING'").selectExpr("concat('c', c_custkey) AS paper_id", "'1-URGENT' AS id")
    symbols = t.customer.where("c_acctbal >= 0").selectExpr("concat('c', c_custkey) AS paper_id", "c_mktsegment AS id")
    mapping = t.orders.selectExpr("concat('c', o_custkey) AS paper_id", "'N.S' AS namespace", "map(concat('o', o_orderkey), 'd') AS claim_to_decl")
    cards = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "concat('c', o_custkey) AS paper_id", "concat('c', o_custkey, '_', l_orderkey, '_', l_linenumber) AS id", "concat('o', l_orderkey) AS claim_id",
        "'d' AS lean_decl", "CASE l_returnflag WHEN 'N' THEN ' ' ELSE 'f' END AS file_path", "array(concat('s', l_suppkey), concat('c', o_custkey, '_', l_orderkey, '_1')) AS dependency_ids",
        "array(concat('p', l_partkey)) AS executable_links",
    )
    manifests = t.customer.selectExpr("concat('c', c_custkey) AS paper_id", "array(concat('n', c_nationkey)) AS kernel_index")
    kernels = t.part.where("p_size <= 25").selectExpr("concat('p', p_partkey) AS id", "array(p_name) AS linked_theorem_cards")
    out = checks.graph_integrity(claims, assumptions, symbols, mapping, cards, manifests, kernels)
    return out.groupBy("message", "group_id", "row_id").agg(F.count(N).alias("n"))


@query(
    "claim_lifecycle",
    "V7",
    """
SELECT concat('o', o_orderkey) AS row_id, CASE WHEN o_orderstatus = 'O' THEN 'invalid status odd' ELSE 'disputed without review_notes' END AS message FROM orders
WHERE (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') OR (o_orderstatus = 'P' AND o_totalprice <= 250000)
""",
)
def claim_lifecycle(t: Tables) -> DataFrame:
    return checks.lifecycle(_claims(t)).select("row_id", "message")


@query(
    "card_review_rules",
    "V8",
    """
SELECT concat('o', o_orderkey) AS row_id, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'reviewer_status is required' WHEN '5-LOW' THEN 'invalid reviewer_status odd'
  WHEN '1-URGENT' THEN 'blocked without notes' ELSE 'accepted but not machine_checked' END AS message FROM orders
WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') OR (o_orderpriority = '1-URGENT' AND o_totalprice <= 250000) OR (o_orderpriority = '2-HIGH' AND o_orderstatus <> 'F')
""",
)
def card_review_rules(t: Tables) -> DataFrame:
    cards = t.orders.selectExpr(
        "concat('c', o_custkey) AS paper_id", "concat('o', o_orderkey) AS id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'blocked' WHEN '2-HIGH' THEN 'accepted' WHEN '3-MEDIUM' THEN 'unreviewed' WHEN '5-LOW' THEN 'odd' END AS reviewer_status",
        "CASE WHEN o_totalprice > 250000 THEN 'why' END AS notes", "CASE o_orderstatus WHEN 'F' THEN 'machine_checked' ELSE 'mapped' END AS proof_status",
    )
    return checks.card_review(cards).select("row_id", "message")


@query(
    "coverage_integrity",
    "V9 J23",
    """
WITH linked AS (SELECT o_custkey AS k, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R') AS linked FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
r AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f,
  coalesce(any_value(linked), count(*) FILTER (o_orderstatus = 'O')) AS o FROM orders LEFT JOIN linked ON k = o_custkey GROUP BY 1),
s AS (SELECT c_custkey, c_nationkey, coalesce(n, 0) AS n, coalesce(f, 0) AS f, coalesce(o, 0) AS o FROM customer LEFT JOIN r ON o_custkey = c_custkey)
SELECT concat('c', c_custkey) AS group_id, concat('claim_count is ', c_nationkey, ', expected ', n) AS message FROM s WHERE c_nationkey <> n
UNION ALL SELECT concat('c', c_custkey), concat('mapped_claim_count is null, expected ', n) FROM s
UNION ALL SELECT concat('c', c_custkey), concat('kernel_linked_count is 1, expected ', o) FROM s WHERE o <> 1
UNION ALL SELECT concat('c', c_custkey), 'manifest without claims' FROM s WHERE n = 0
""",
)
def coverage_integrity(t: Tables) -> DataFrame:
    claims = t.orders.selectExpr(
        "concat('c', o_custkey) AS paper_id", "concat('o', o_orderkey) AS id", "array('t') AS linked_formal_targets",
        "CASE o_orderstatus WHEN 'F' THEN 'machine_checked' WHEN 'O' THEN 'linked_to_kernel' ELSE 'mapped' END AS status",
    )
    cards = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "concat('c', o_custkey) AS paper_id", "concat('o', l_orderkey) AS claim_id",
        "CASE l_returnflag WHEN 'R' THEN array('k') ELSE array() END AS executable_links",
    )
    counted = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    manifests = t.customer.join(counted, F.col("o_custkey") == F.col("c_custkey"), "left").selectExpr(
        "concat('c', c_custkey) AS paper_id",
        """named_struct('claim_count', cast(c_nationkey AS bigint), 'mapped_claim_count', cast(NULL AS bigint),
             'machine_checked_count', coalesce(f, 0L), 'kernel_linked_count', 1L) AS coverage_metrics""",
    )
    return checks.coverage_integrity(manifests, claims, cards).select("group_id", "message")


@query(
    "kernel_witness",
    "V10",
    """
SELECT concat('s', s_suppkey) AS row_id, concat('linked kernel has test_status ', CASE WHEN s_acctbal < 0 THEN 'missing' ELSE 'failing' END) AS message
FROM supplier WHERE s_acctbal < 5000 AND s_nationkey < 20
""",
)
def kernel_witness(t: Tables) -> DataFrame:
    kernels = t.supplier.selectExpr(
        "concat('s', s_suppkey) AS id", "CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 5000 THEN 'failing' ELSE ' tested ' END AS test_status",
        "CASE WHEN s_nationkey < 20 THEN array('c') ELSE array() END AS linked_theorem_cards",
    )
    return checks.kernel_witness(kernels).select("row_id", "message")


@query(
    "kernel_contract",
    "V11 U4",
    """
WITH k AS (SELECT concat('s', s_suppkey) AS row_id, s_nationkey AS n FROM supplier)
SELECT row_id, 'missing io_typing' AS message FROM k WHERE n < 5
UNION ALL SELECT row_id, 'missing contract_v1' FROM k WHERE n < 3
UNION ALL SELECT row_id, 'witness_type must be numerically_witnessed' FROM k WHERE n BETWEEN 3 AND 8
UNION ALL SELECT row_id, 'io names must match unit names' FROM k WHERE n BETWEEN 9 AND 11
UNION ALL SELECT row_id, 'domain lacks a sign hint' FROM k WHERE n BETWEEN 9 AND 11
UNION ALL SELECT row_id, 'domain lacks a sign hint' FROM k WHERE n = 12
UNION ALL SELECT row_id, 'domains must be non-empty' FROM k WHERE n = 12
UNION ALL SELECT row_id, 'expected obligations must equal linked cards' FROM k WHERE n BETWEEN 13 AND 15
UNION ALL SELECT row_id, 'satisfied obligations must equal linked cards' FROM k WHERE n = 15
UNION ALL SELECT row_id, 'unsatisfied obligations remain' FROM k WHERE n = 16
UNION ALL SELECT row_id, 'units must be non-empty' FROM k WHERE n = 17
UNION ALL SELECT row_id, 'io names must match unit names' FROM k WHERE n = 17
UNION ALL SELECT row_id, 'expected obligations must be non-empty' FROM k WHERE n = 18
UNION ALL SELECT row_id, 'expected obligations must equal linked cards' FROM k WHERE n = 18
""",
)
def kernel_contract(t: Tables) -> DataFrame:
    io = "array(named_struct('name', CASE WHEN s_nationkey BETWEEN 9 AND 11 THEN 'Q' ELSE 'K' END, 'numeric_kind', 'nonnegative_float'), named_struct('name', 'P', 'numeric_kind', 'positive_float'))"
    none = "map_from_arrays(cast(array() AS array<string>), cast(array() AS array<string>))"
    kernels = t.supplier.selectExpr(
        "concat('s', s_suppkey) AS id", "'tested' AS test_status", "array('a', 'b') AS linked_theorem_cards",
        f"CASE WHEN s_nationkey >= 5 THEN named_struct('inputs', {io}, 'outputs', array(named_struct('name', 'y', 'numeric_kind', 'float'))) END AS io_typing",
        f"""CASE WHEN s_nationkey >= 3 THEN named_struct(
            'units', named_struct('inputs', CASE WHEN s_nationkey = 17 THEN {none} ELSE map('K', 'u', 'P', 'v') END, 'outputs', map('y', 'w')),
            'domains', named_struct('inputs', CASE WHEN s_nationkey = 12 THEN {none} ELSE map('K', 'K >= 0', 'P', 'P > 0') END, 'outputs', map('y', '0 <= y')),
            'witness_type', CASE WHEN s_nationkey BETWEEN 3 AND 8 THEN 'guess' ELSE 'numerically_witnessed' END,
            'obligations', named_struct(
              'expected_linked_theorem_cards', CASE WHEN s_nationkey BETWEEN 13 AND 15 THEN array('a') WHEN s_nationkey = 18 THEN cast(array() AS array<string>) ELSE array('b', 'a') END,
              'satisfied_linked_theorem_cards', CASE WHEN s_nationkey = 15 THEN array('a', 'z') ELSE array('a', 'b', 'b') END,
              'unsatisfied_linked_theorem_cards', CASE WHEN s_nationkey = 16 THEN array('q') ELSE cast(array() AS array<string>) END)) END AS contract_v1""",
    )
    return checks.kernel_contract(kernels).select("row_id", "message")


@query(
    "snapshot_quality",
    "V12",
    """
WITH s AS (SELECT concat(CASE WHEN c_mktsegment = 'BUILDING' THEN 'release-' WHEN c_mktsegment = 'MACHINERY' THEN 'v' ELSE 'w' END, c_custkey) AS row_id, * FROM customer)
SELECT row_id, 'missing or empty title' AS message FROM s WHERE c_acctbal < 0
UNION ALL SELECT row_id, 'narrative too short' FROM s WHERE length(c_mktsegment) < 10 AND c_nationkey >= 3
UNION ALL SELECT row_id, 'narrative too short' FROM s WHERE c_nationkey < 3
UNION ALL SELECT row_id, 'release baseline without highlights' FROM s WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey >= 10
""",
)
def snapshot_quality(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr(
        "concat(CASE WHEN c_mktsegment = 'BUILDING' THEN 'release-' WHEN c_mktsegment = 'MACHINERY' THEN 'v' ELSE 'w' END, c_custkey) AS baseline_id",
        "CASE WHEN c_acctbal < 0 THEN ' ' ELSE c_name END AS title", "CASE WHEN c_nationkey >= 3 THEN concat(' ', c_mktsegment) END AS narrative",
        "CASE WHEN c_nationkey < 10 THEN array('h') END AS highlights",
    )
    return checks.snapshot_quality(rows).select("row_id", "message")


@query(
    "gate_report",
    "V15 U5",
    """
WITH f AS (SELECT 'reviewer_lifecycle' AS check_id, concat('c', o_custkey) AS g, o_orderkey AS place, concat('o', o_orderkey) AS r FROM orders
    WHERE (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') OR (o_orderstatus = 'P' AND o_totalprice <= 250000)
  UNION ALL SELECT 'extraction_run_required', o_custkey::VARCHAR, 0, o_custkey::VARCHAR FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events))
  UNION ALL SELECT 'normalization_integrity', concat('o', l_orderkey), 0, concat('l', l_linenumber) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)),
o AS (SELECT * FROM (VALUES (0, 'json_schemas_and_kernels', 'error'), (1, 'normalization_integrity', 'error'), (2, 'provenance_integrity', 'error'), (3, 'extraction_run_required', 'error'),
  (4, 'graph_integrity', 'error'), (5, 'claim_value_policy', 'error'), (6, 'reviewer_lifecycle', 'error'), (7, 'theorem_card_reviewer', 'error'), (8, 'coverage_integrity', 'error'),
  (9, 'snapshot_quality', 'warn'), (10, 'dependency_graph_bootstrap', 'warn'), (11, 'dependency_graph_quality', 'warn'), (12, 'suggestion_sidecars', 'warn'), (13, 'missing_identifier_hint', 'hint')) v(step, check_id, kind))
SELECT step, check_id, CASE WHEN count(g) = 0 THEN 'ok' ELSE 'error' END AS status, count(g) AS findings, min((g, place, r))[1] AS group_id, min((g, place, r))[3] AS row_id
FROM o LEFT JOIN f USING (check_id) GROUP BY ALL
""",
)
def gate_report(t: Tables) -> DataFrame:
    return checks.gate_report(_findings(t)).select("step", "check_id", "status", "findings", "group_id", "row_id")


def _findings(t: Tables) -> DataFrame:
    keys = t.lineitem.selectExpr("concat('o', l_orderkey) AS paper_id", "concat('l', l_linenumber) AS id")
    runs = checks.extraction_run_required(t.orders.select(F.col("o_custkey").alias("paper_id")), t.events.select(F.col("user_id").alias("paper_id")))
    return checks.union_all(
        [checks.lifecycle(_claims(t)), runs, checks.duplicate_violations(keys, ["paper_id", "id"], "normalization_integrity", "paper_id", "id")]
    )


@query(
    "gate_verdict",
    "V15 K5",
    """
SELECT 0 AS ok, 'normalization_integrity' AS first_failure, (SELECT count(*) FROM orders WHERE (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') OR (o_orderstatus = 'P' AND o_totalprice <= 250000))
 + (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events))
 + (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS findings
""",
)
def gate_verdict(t: Tables) -> DataFrame:
    out = checks.verdict(checks.gate_report(_findings(t)))
    return out.withColumn("ok", F.col("ok").cast("int"))


# --- text -------------------------------------------------------------------------------------


@query(
    "stripped_comments",
    "T1",
    """
SELECT page_id, sha256(regexp_replace(regexp_replace(html, '/-.*?-/', '', 'gs'), '--[^' || chr(10) || ']*', '', 'g')) AS text_sha FROM pages
""",
)
def stripped_comments(t: Tables) -> DataFrame:
    return t.pages.select("page_id", c.sha256(documents.strip_comments(F.col("html"))).alias("text_sha"))


@query(
    "declaration_bodies",
    "T2",
    """
SELECT concat('formal/k', p_partkey, '.lean') AS path, i::INT AS pos, name, CASE WHEN i < 4 THEN body WHEN p_size > 25 THEN concat('Corpus.K', p_partkey, '.ring_step + aliased''', chr(10), ' aliased') ELSE 'ring_step' END AS body
FROM part, (VALUES (0, 'base_def', 'Core'), (1, 'unfolded', concat('by', chr(10), '  unfold base_d', chr(10), '  rfl')), (2, 'ring_step', 'by ring'),
  (3, 'aliased', concat('by', chr(10), '  exact Core.mul')), (4, 'last_one', '')) v(i, name, body)
""",
)
def declaration_bodies(t: Tables) -> DataFrame:
    docs, _ = _source_texts(t)
    clean = docs.select("path", documents.strip_comments(F.col("text")).alias("text"))
    return documents.segments(clean, "path", "text").select("path", "pos", "name", c.strip("body").alias("body"))


@query(
    "alias_pairs",
    "T3",
    "SELECT concat('formal/k', p_partkey, '.lean') AS path, 'Core' AS symbol, 'base_def' AS local_name FROM part",
)
def alias_pairs(t: Tables) -> DataFrame:
    docs, _ = _source_texts(t)
    return documents.aliases(docs, "path", "text")


FORMULA = "concat('Sec $\\\\theta_', p_size, ' = K P$ and $$\\\\', lower(p_type), ' + x^2$$ end')"


@query(
    "section_formulas",
    "T5 T10 K3",
    """
SELECT p_partkey, 2::BIGINT AS equations, array_to_string(list_sort(['K', 'P', lower(p_type), 'theta', 'x']), ',') AS symbols FROM part
""",
)
def section_formulas(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.expr(FORMULA).alias("body"))
    out = documents.section_formulas(rows, ["p_partkey"], "body")
    return out.select("p_partkey", c.count_items("candidate_equations").alias("equations"), F.array_join("candidate_symbols", ",").alias("symbols"))


@query(
    "macro_definitions",
    "T6 W10",
    """
SELECT p_partkey, 'foo' AS name, concat('a{', p_name, '}b') AS definition FROM part UNION ALL SELECT p_partkey, 'bar', 'x' FROM part
UNION ALL SELECT p_partkey, 'baz', p_type FROM part
""",
)
def macro_definitions(t: Tables) -> DataFrame:
    text = F.expr(
        "concat('\\\\def\\\\foo{late} \\\\newcommand{\\\\foo}[1]{ a{', p_name, '}b } \\\\newcommand{bar}{x}\\n\\\\newcommand{\\\\foo}{again} \\\\def\\\\baz{', p_type, '}')"
    )
    return documents.macro_definitions(t.part.select("p_partkey", text.alias("text")), "p_partkey", "text")


@query(
    "markdown_pairs",
    "T7",
    """
SELECT c_custkey, concat('a', c_nationkey) AS key, c_mktsegment AS value FROM customer UNION ALL SELECT c_custkey, 'b', 'last' FROM customer
""",
)
def markdown_pairs(t: Tables) -> DataFrame:
    text = F.expr(
        "concat('# T\\n| Claim id | decl |\\n|---|---|\\n| a', c_nationkey, ' | `', c_mktsegment, '` | x |\\n| b | first |\\n  | b | `last` |\\nno | row | here\\n| alone |')"
    )
    return documents.markdown_pairs(t.customer.select("c_custkey", text.alias("text")), "c_custkey", "text")


PATCH = "substr(text, 1, 40)"


def _patches(t: Tables) -> DataFrame:
    first = t.documents.selectExpr("doc_id", "0 AS seq", f"{PATCH} AS find", "concat('[', lang, ']') AS replace")
    second = t.documents.selectExpr("doc_id", "1 AS seq", "concat('[', lang, ']') AS find", "'' AS replace").where("find <> '[de]'")
    missing = t.labels.selectExpr("doc_id", "2 AS seq", "CASE WHEN toxic = 1 THEN '' ELSE 'e' END AS find", "'E' AS replace")
    return first.unionByName(second).unionByName(missing)


@query(
    "unique_find_check",
    "V16 F",
    f"""
WITH p AS (SELECT doc_id, 0 AS seq, {PATCH} AS find FROM documents UNION ALL SELECT doc_id, 1, concat('[', lang, ']') FROM documents WHERE lang <> 'de'
  UNION ALL SELECT doc_id, 2, CASE WHEN toxic = 1 THEN '' ELSE 'e' END FROM labels),
m AS (SELECT p.*, CASE WHEN find = '' THEN 0 ELSE (length(text) - length(replace(text, find, ''))) // length(find) END AS n FROM p JOIN documents USING (doc_id))
SELECT doc_id, seq, CASE WHEN find = '' THEN 'empty_find' WHEN n = 0 THEN 'not_found' ELSE 'not_unique' END AS issue, n::BIGINT AS matches FROM m WHERE n <> 1
""",
)
def unique_find_check(t: Tables) -> DataFrame:
    out = documents.replacement_issues(t.documents, "doc_id", "text", _patches(t))
    return out.select("doc_id", "seq", "issue", "matches")


@query(
    "edit_ready_proposals",
    "A21 V16 A23",
    f"""
WITH m AS (SELECT doc_id, source, lang, (length(text) - length(replace(text, {PATCH}, ''))) // length({PATCH}) AS n, (length(text) - length(replace(text, 'q', ''))) AS q FROM documents WHERE length(text) > 0)
SELECT source AS paper_id, concat('e', doc_id) AS proposal_id FROM m WHERE lang <> 'es' AND n = 1 AND (lang <> 'fr' OR q = 1)
""",
)
def edit_ready_proposals(t: Tables) -> DataFrame:
    docs = t.documents.where(F.length("text") > 0)
    proposals = docs.selectExpr(
        "source AS paper_id", "concat('e', doc_id) AS proposal_id",
        "CASE lang WHEN 'es' THEN concat('other/d', doc_id) ELSE concat('formal/d', doc_id) END AS target_file",
        f"""CASE lang WHEN 'fr' THEN array(named_struct('find', {PATCH}, 'replace', ''), named_struct('find', 'q', 'replace', 'k'))
             ELSE array(named_struct('find', {PATCH}, 'replace', '')) END AS replacements""",
    )
    texts = docs.selectExpr("concat('formal/d', doc_id) AS path", "text")
    return documents.edit_ready(proposals, texts)


@query(
    "unsafe_patches",
    "V16",
    """
SELECT event_id, CASE event_type WHEN 'error' THEN 'unsafe_path' WHEN 'click' THEN 'unsafe_path' ELSE 'missing_document' END AS issue FROM events WHERE event_type <> 'view'
""",
)
def unsafe_patches(t: Tables) -> DataFrame:
    path = "CASE event_type WHEN 'error' THEN 'formal/../a' WHEN 'click' THEN 'b' WHEN 'view' THEN 'formal/AFRICA' ELSE concat('formal/', event_type) END"
    patches = t.events.selectExpr("event_id", f"{path} AS path", "props AS find", "'' AS replace")
    held = t.region.selectExpr("concat('formal/', r_name) AS path", "'' AS text")
    out = documents.replacement_issues(held, "path", "text", patches, root="formal/")
    return out.where("issue <> 'not_found'").select("event_id", "issue")


@query(
    "applied_replacements",
    "T9",
    f"""
WITH d AS (SELECT doc_id, text, lang, {PATCH} AS find, concat('[', lang, ']') AS tag FROM documents WHERE length(text) > 0),
s AS (SELECT *, (length(text) - length(replace(text, find, ''))) // length(find) = 1 AS ok1, replace(text, find, tag) AS t1 FROM d),
u AS (SELECT *, CASE WHEN lang = 'de' THEN ok1 ELSE ok1 AND (length(t1) - length(replace(t1, tag, ''))) // length(tag) = 1 END AS ok2, CASE WHEN lang = 'de' THEN t1 ELSE replace(t1, tag, '') END AS t2 FROM s)
SELECT doc_id, (NOT ok2)::INT AS rejected, sha256(CASE WHEN ok2 THEN t2 ELSE text END) AS new_sha FROM u
""",
)
def applied_replacements(t: Tables) -> DataFrame:
    docs = t.documents.where(F.length("text") > 0)
    patches = _patches(t).where("seq < 2")
    out = documents.apply_replacements(docs, "doc_id", "text", patches)
    return out.select("doc_id", F.col("rejected").cast("int").alias("rejected"), c.sha256("new_text").alias("new_sha"))


@query(
    "patched_documents",
    "T9 V16",
    f"""
WITH d AS (SELECT doc_id, text, lang, {PATCH} AS find, concat('[', lang, ']') AS tag, toxic FROM documents LEFT JOIN labels USING (doc_id)),
s AS (SELECT *, find <> '' AND (length(text) - length(replace(text, find, ''))) // length(find) = 1 AS ok1, replace(text, find, tag) AS t1 FROM d),
u AS (SELECT *, CASE WHEN lang = 'de' THEN ok1 ELSE ok1 AND (length(t1) - length(replace(t1, tag, ''))) // length(tag) = 1 END AS ok2, CASE WHEN lang = 'de' THEN t1 ELSE replace(t1, tag, '') END AS t2 FROM s),
v AS (SELECT *, CASE toxic WHEN 1 THEN false WHEN 0 THEN ok2 AND length(t2) - length(replace(t2, 'e', '')) = 1 ELSE ok2 END AS ok3, CASE toxic WHEN 0 THEN replace(t2, 'e', 'E') ELSE t2 END AS t3 FROM u)
SELECT doc_id, (NOT coalesce(ok3, false))::INT AS rejected, (coalesce(ok3, false) AND t3 <> text)::INT AS modified, sha256(CASE WHEN ok3 THEN t3 ELSE text END) AS new_sha FROM v
""",
)
def patched_documents(t: Tables) -> DataFrame:
    out = documents.apply_replacements(t.documents, "doc_id", "text", _patches(t))
    return out.select("doc_id", F.col("rejected").cast("int").alias("rejected"), F.col("modified").cast("int").alias("modified"), c.sha256("new_text").alias("new_sha"))


@query(
    "replacement_preview",
    "T9 P25 F",
    """
SELECT doc_id, CASE WHEN length(text) > 200 THEN concat(substr(text, 1, 200), '...') ELSE text END AS before, source AS after FROM documents
""",
)
def replacement_preview(t: Tables) -> DataFrame:
    return documents.replacement_preview(t.documents.selectExpr("doc_id", "text AS find", "source AS replace"))


# --- numeric ----------------------------------------------------------------------------------

PRESSURES = [0.0, 0.1, 0.25, 0.5, 1.0, 2.0, 4.0]
AMOUNTS = [-1.0, 0.0, 0.05, 0.5, 1.0, 4.0]
GRID_P = "(VALUES (0.0::DOUBLE), (0.1::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE), (4.0::DOUBLE)) v(p)"
GRID_C = "(VALUES (-1.0::DOUBLE), (0.0::DOUBLE), (0.05::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE), (4.0::DOUBLE)) v(c)"


@query(
    "sweep_saturating_ratio",
    "J27 N1 N3 F",
    f"""
SELECT p_partkey, p, round(CASE WHEN 1 + k * p = 0 THEN 0 ELSE (k * p) / (k * p + 1) END, 9) + 0.0::DOUBLE AS theta FROM (SELECT p_partkey, (p_size - 4.0::DOUBLE) / 4 AS k FROM part), {GRID_P}
""",
)
def sweep_saturating_ratio(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", ((F.col("p_size") - 4.0) / 4).alias("k"))
    out = numeric.sweep(rows, "theta", c.saturating_ratio("k", "p"), p=PRESSURES)
    return out.select("p_partkey", "p", F.round("theta", 9).alias("theta"))


@query(
    "sweep_power_law",
    "J27 N2 N3 N4 F",
    f"""
SELECT p_partkey, c, CASE WHEN c <= 0 OR n = 0 THEN NULL ELSE round(1.1::DOUBLE * pow(c, 1.0 / n), 9) END AS amount
FROM (SELECT p_partkey, (p_size - 10)::DOUBLE / 2 AS n FROM part), {GRID_C}
""",
)
def sweep_power_law(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", ((F.col("p_size") - 10) / 2.0).alias("n"))
    out = numeric.sweep(rows, "amount", c.power_law(F.lit(1.1), "c", "n"), c=AMOUNTS)
    clean = F.when(~F.isnan("amount"), F.round("amount", 9))
    return out.select("p_partkey", "c", clean.alias("amount"))


@query(
    "witness_bounds_and_nan",
    "N4 N2",
    f"""
SELECT 'bounds' AS rule, p_partkey, p AS x FROM (SELECT p_partkey, (p_size - 4.0::DOUBLE) / 4 AS k FROM part), {GRID_P}
WHERE (CASE WHEN 1 + k * p = 0 THEN 0 ELSE k * p / (k * p + 1) END) NOT BETWEEN 0 AND 1
UNION ALL SELECT 'nan', p_partkey, c FROM part, {GRID_C} WHERE (c <= 0 OR p_size = 10) AND c >= 0
""",
)
def witness_bounds_and_nan(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", ((F.col("p_size") - 4.0) / 4).alias("k"))
    theta = numeric.sweep(rows, "theta", c.saturating_ratio("k", "p"), p=PRESSURES)
    bounds = numeric.out_of_bounds(theta, "theta", 0.0, 1.0).select(F.lit("bounds").alias("rule"), "p_partkey", F.col("p").alias("x"))
    grid = numeric.sweep(t.part.select("p_partkey", (F.col("p_size") - 10.0).alias("n")), "amount", c.power_law(F.lit(1.1), "c", "n"), c=AMOUNTS)
    # The stated domain starts at zero, so the kernel's NaN there is reported; negative input may be NaN.
    nan = numeric.unexpected_nan(grid, "amount", F.col("c") >= 0)
    return bounds.unionByName(nan.select(F.lit("nan").alias("rule"), "p_partkey", F.col("c").alias("x")))


@query(
    "witness_monotone_and_invariant",
    "N4 W11 F",
    f"""
WITH g AS (SELECT p_partkey, p, k, CASE WHEN 1 + k * p = 0 THEN 0 ELSE k * p / (k * p + 1) END AS theta FROM (SELECT p_partkey, (p_size - 4.0::DOUBLE) / 4 AS k FROM part), {GRID_P}),
l AS (SELECT *, lag(theta) OVER (PARTITION BY p_partkey ORDER BY p) AS previous FROM g)
SELECT 'monotone' AS rule, p_partkey, p FROM l WHERE previous > theta + 1e-9
UNION ALL SELECT 'square', p_partkey, p FROM g WHERE abs(k * k * p - k * p) > greatest(1e-9 * greatest(abs(k * k * p), abs(k * p)), 1e-12)
""",
)
def witness_monotone_and_invariant(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", ((F.col("p_size") - 4.0) / 4).alias("k"))
    grid = numeric.sweep(rows, "theta", c.saturating_ratio("k", "p"), p=PRESSURES)
    breaks = numeric.grid_monotone_breaks(grid, ["p_partkey"], "p", "theta")
    square = numeric.not_equal(grid, F.col("k") * F.col("k") * F.col("p"), F.col("k") * F.col("p"))
    # Swapping the factors must not change the ratio, so this check adds no rows.
    swapped = numeric.not_equal(grid, c.saturating_ratio("k", "p"), c.saturating_ratio("p", "k"))
    parts = (("monotone", breaks), ("square", square), ("swapped", swapped))
    return checks.union_all([df.select(F.lit(name).alias("rule"), "p_partkey", "p") for name, df in parts])


@query(
    "unique_part_links",
    "J1 W12 U3",
    """
SELECT p_partkey, 2 + (p_brand <> p_type)::INT AS n_links FROM part
""",
)
def unique_part_links(t: Tables) -> DataFrame:
    links = F.array_distinct(F.concat(F.array("p_name", "p_brand"), F.array("p_type", "p_name")))
    return t.part.select("p_partkey", F.size(links).alias("n_links"))


@query(
    "orphans_of_self",
    "J2a",
    "SELECT l_orderkey FROM lineitem WHERE 1 = 0",
)
def orphans_of_self(t: Tables) -> DataFrame:
    return linking.orphans(t.lineitem, t.lineitem, {"l_orderkey": "l_orderkey"}).select("l_orderkey")
