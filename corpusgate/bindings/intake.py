"""Sources, sinks and intake on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.bindings.base import Tables, query
from corpusgate.operators import metrics, shapes
from corpusgate.plans import publication
from corpusgate.session import checkpoint_dir
from corpusgate.sources import entities, export, intake
from corpusgate.streaming import intake as streaming

DOMAIN_OF_TYPE = """CASE p_type WHEN 'STANDARD' THEN 'physics' WHEN 'ECONOMY' THEN 'control'
  WHEN 'MEDIUM' THEN ' chemistry ' WHEN 'PROMO' THEN '' WHEN 'LARGE' THEN 'geology' ELSE 'mathematics' END"""


@query(
    "parse_entity_arrays",
    "S1 S2",
    """
SELECT event_id, pos::INT AS pos, k FROM (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events) e,
  (VALUES (0), (2)) v(pos)
""",
)
def parse_entity_arrays(t: Tables) -> DataFrame:
    # The middle item is no object and is dropped; positions stay those of the stored array.
    raw = t.events.select(
        F.col("event_id").alias("paper_id"), F.concat(F.lit("["), "props", F.lit(', "note", '), "props", F.lit("]")).alias("raw")
    )
    parsed = entities.parse_array(raw, "k bigint")
    return parsed.select(F.col("paper_id").alias("event_id"), "pos", "k")


@query(
    "read_lenient_objects",
    "S2 S3",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE value >= 5
""",
)
def read_lenient_objects(t: Tables) -> DataFrame:
    # Small values get a cut-off object and are left out like an unreadable file.
    raw = t.events.select(
        F.col("event_id").alias("paper_id"), F.expr("CASE WHEN value >= 5 THEN props ELSE concat(props, '{') END").alias("raw"), "value"
    )
    broken = raw.withColumn("raw", F.expr("CASE WHEN value >= 5 THEN raw ELSE substr(raw, 1, 4) END"))
    return entities.parse_object(broken, "k bigint").select(F.col("paper_id").alias("event_id"), "k")


# Events as stored objects: some of their fields have another type than the reader or the schema expects.
STORED_EVENT = """CASE
  WHEN value < 2 THEN concat('{"k": "', value, '", "at": {"user": ', user_id, '}, "tags": ["', event_type, '"]}')
  WHEN value < 4 THEN concat('{"k": ', user_id, ', "at": {"user": "', user_id, '", "zone": {"x": 1}}, "tags": ["', event_type, '", 5, null]}')
  WHEN value < 6 THEN concat('{"k": ', user_id, '.5, "at": {}, "tags": "', event_type, '", "more": {"k": ', user_id, '}}')
  WHEN value < 8 THEN substr(props, 1, 4)
  WHEN value < 10 THEN concat('[', props, ']')
  ELSE concat(substr(props, 1, length(props) - 1), ', "at": {"user": ', user_id, '.0}}') END"""
EVENT_SHAPE = "k bigint, at struct<user:bigint,place:string>, tags array<string>, label map<string,string>"


def _stored_events(t: Tables) -> DataFrame:
    return t.events.selectExpr("event_id AS paper_id", "event_id", f"{STORED_EVENT} AS raw")


@query(
    "json_shape_findings",
    "V1 V13",
    f"""
WITH r AS (SELECT event_id, {STORED_EVENT} AS raw FROM events),
ok AS (SELECT event_id, raw::JSON AS j FROM r WHERE json_valid(raw) AND substr(raw, 1, 1) = '{{')
SELECT event_id, '' AS place, 'unparsable' AS rule, NULL AS found FROM r WHERE NOT json_valid(raw)
UNION ALL SELECT event_id, '', 'wrong_type', 'array' FROM r WHERE json_valid(raw) AND substr(raw, 1, 1) = '['
UNION ALL SELECT event_id, 'k', 'wrong_type', CASE json_type(j, '$.k') WHEN 'VARCHAR' THEN 'string' ELSE 'number' END
  FROM ok WHERE json_type(j, '$.k') IN ('VARCHAR', 'DOUBLE')
UNION ALL SELECT event_id, 'tags', 'wrong_type', 'string' FROM ok WHERE json_type(j, '$.tags') = 'VARCHAR'
UNION ALL SELECT event_id, 'tags[1]', 'wrong_type', 'integer' FROM ok WHERE json_type(j, '$.tags[1]') = 'UBIGINT'
UNION ALL SELECT event_id, 'tags[2]', 'wrong_type', 'null' FROM ok WHERE json_type(j, '$.tags[2]') = 'NULL'
UNION ALL SELECT event_id, 'at.user', 'wrong_type', 'string' FROM ok WHERE json_type(j, '$.at.user') = 'VARCHAR'
UNION ALL SELECT event_id, 'at.zone', 'unknown_field', 'object' FROM ok WHERE json_type(j, '$.at.zone') IS NOT NULL
UNION ALL SELECT event_id, 'more', 'unknown_field', 'object' FROM ok WHERE json_type(j, '$.more') IS NOT NULL
UNION ALL SELECT event_id, '', 'missing_field', 'tags' FROM ok WHERE json_type(j, '$.tags') IS NULL
UNION ALL SELECT event_id, 'at', 'missing_field', 'user' FROM ok WHERE json_type(j, '$.at.user') IS NULL
""",
)
def json_shape_findings(t: Tables) -> DataFrame:
    known = shapes.paths(EVENT_SHAPE, {"": {"k", "tags"}, "at": {"user"}})
    return shapes.shape_findings(_stored_events(t), ["event_id"], "raw", known)


@query(
    "rescued_event_fields",
    "S2 S3",
    f"""
WITH r AS (SELECT event_id, {STORED_EVENT} AS raw FROM events),
p AS (SELECT *, NOT json_valid(raw) AS broken, json_valid(raw) AND substr(raw, 1, 1) = '[' AS listed FROM r),
o AS (SELECT event_id, broken, listed, CASE WHEN broken OR listed THEN NULL ELSE raw::JSON END AS j FROM p),
f AS (SELECT *, json_type(j, '$.k') = 'UBIGINT' AS good_k, json_type(j, '$.at.user') = 'VARCHAR' OR (j->>'$.at.user') LIKE '%.0' AS bad_at,
  json_type(j, '$.tags') = 'VARCHAR' AS bad_tags FROM o)
SELECT event_id, CASE WHEN broken THEN 'unparsable' WHEN listed THEN 'wrong shape' WHEN NOT good_k OR bad_at OR bad_tags THEN 'rescued' END AS reason,
  NOT (broken OR listed) AS usable, CASE WHEN good_k THEN CAST(j->>'$.k' AS BIGINT) END AS k,
  CASE WHEN NOT good_k THEN CAST(j->'$.k' AS VARCHAR) END AS rescued_k,
  CASE WHEN bad_tags THEN CAST(j->'$.tags' AS VARCHAR) END AS rescued_tags,
  CASE WHEN json_type(j, '$.tags') = 'ARRAY' THEN json_array_length(j, '$.tags') END AS n_tags
FROM f
""",
)
def rescued_event_fields(t: Tables) -> DataFrame:
    # Rows in = usable rows + unusable ones; a field that does not fit is null in its row and kept as JSON.
    rows = entities.object_rows(_stored_events(t).drop("event_id"), EVENT_SHAPE)
    return rows.select(
        F.col("paper_id").alias("event_id"), "reason", "usable", "k",
        F.expr("rescued['k']").alias("rescued_k"), F.expr("rescued['tags']").alias("rescued_tags"),
        F.when(F.col("tags").isNotNull(), F.size("tags")).cast("bigint").alias("n_tags"),
    )


@query(
    "map_objects",
    "S3",
    """
SELECT p_partkey, claim_id, short_decl FROM (
  SELECT p_partkey, concat('c_', p_brand) AS claim_id, p_name AS short_decl FROM part
  UNION ALL SELECT p_partkey, concat('c_', p_type), p_brand FROM part)
""",
)
def map_objects(t: Tables) -> DataFrame:
    raw = t.part.select(
        F.col("p_partkey").alias("paper_id"),
        F.expr("""concat('{"namespace": "N", "claim_to_decl": {"c_', p_brand, '": "', p_name, '", "c_', p_type, '": "', p_brand, '"}}')""").alias("raw"),
    )
    mapping = entities.parse_object(raw, "namespace string, claim_to_decl map<string,string>")
    return entities.mapping_long(mapping).select(F.col("paper_id").alias("p_partkey"), "claim_id", "short_decl")


@query(
    "catalog_index",
    "S4 K4",
    """
SELECT concat('c', c_custkey) AS id, CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END AS title,
  CASE WHEN c_acctbal < 0 THEN 0 ELSE 1900 + c_nationkey END AS year,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'other' ELSE lower(c_mktsegment) END AS domain
FROM customer
""",
)
def catalog_index(t: Tables) -> DataFrame:
    papers = t.customer.selectExpr(
        "concat('c', c_custkey) AS paper_id",
        "concat('c', c_custkey) AS id",
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS title",
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE 1900 + c_nationkey END AS year",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE lower(c_mktsegment) END AS domain",
    )
    return entities.catalog(papers).drop("paper_id")


def _intake_rows(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "concat(' c', p_partkey) AS paper_id",
        f"{DOMAIN_OF_TYPE} AS domain",
        "CASE WHEN p_size > 25 THEN concat(' ', p_name) ELSE '' END AS title",
        "CASE WHEN p_size > 10 THEN cast(1900 + p_size AS string) ELSE NULL END AS year",
    )


@query(
    "intake_admitted",
    "S5 S6",
    f"""
WITH r AS (SELECT concat('c', p_partkey) AS id, trim({DOMAIN_OF_TYPE}) AS domain,
    CASE WHEN p_size > 25 THEN p_name END AS title, CASE WHEN p_size > 10 THEN 1900 + p_size END AS year FROM part),
g AS (SELECT id, CASE WHEN domain = '' THEN 'other' ELSE domain END AS domain, title, year FROM r WHERE domain <> 'geology'),
c AS (SELECT concat('c', c_custkey) AS id, c_name AS title, 1990 AS year, 'probability' AS domain FROM customer)
SELECT coalesce(g.id, c.id) AS id, coalesce(g.title, c.title, '(no title yet)') AS title,
  coalesce(g.year, c.year, 1900) AS year, coalesce(g.domain, c.domain) AS domain
FROM c FULL JOIN g ON c.id = g.id
""",
)
def intake_admitted(t: Tables) -> DataFrame:
    known = t.customer.selectExpr(
        "concat('c', c_custkey) AS id", "c_name AS title", "1990 AS year", "'probability' AS domain"
    )
    return intake.admit(known, _intake_rows(t))


@query(
    "intake_rejected",
    "S5",
    "SELECT concat('c', p_partkey) AS group_id, 'invalid domain geology' AS message FROM part WHERE p_type = 'LARGE'",
)
def intake_rejected(t: Tables) -> DataFrame:
    return intake.intake_violations(_intake_rows(t)).select("group_id", "message")


@query(
    "admit_skeletons",
    "S6 P5",
    """
SELECT concat('s-', s_suppkey, '.x') AS paper_id, '(no title yet)' AS title, 1900 AS year, repeat('0', 64) AS sha256,
  concat('Corpus.Papers.s_', s_suppkey, '_x') AS namespace, 0::BIGINT AS entries
FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
""",
)
def admit_skeletons(t: Tables) -> DataFrame:
    ids = t.supplier.selectExpr("concat('s-', s_suppkey, '.x') AS paper_id", "s_acctbal")
    mapped = ids.where("s_acctbal < 0").selectExpr(
        "paper_id", "'Kept' AS namespace", "cast(NULL AS string) AS target_file", "map('a', 'b') AS claim_to_decl"
    )
    mapping = intake.default_mappings(ids, mapped, "Corpus.Papers").where("namespace <> 'Kept'")
    papers = intake.skeletons(ids.select("paper_id")).withColumnRenamed("id", "paper_id")
    return mapping.join(papers, "paper_id").select(
        "paper_id", "title", "year", "source.sha256", "namespace", F.size("claim_to_decl").cast("long").alias("entries")
    )


@query(
    "fingerprint_sources",
    "S7 P27",
    """
SELECT c_custkey AS doc_id, coalesce(sha256(text), repeat('0', 64)) AS sha256
FROM customer LEFT JOIN documents ON c_custkey = doc_id
""",
)
def fingerprint_sources(t: Tables) -> DataFrame:
    files = t.documents.select(F.col("doc_id").alias("path"), F.col("text").cast("binary").alias("content"))
    wanted = t.customer.select(F.col("c_custkey").alias("doc_id"))
    return entities.fingerprint_sources(wanted, files, "doc_id")


@query(
    "input_digests",
    "P27 F",
    "SELECT conv_id, turn, sha256(role) AS role_sha256, sha256(text) AS text_sha256 FROM conversations",
)
def input_digests(t: Tables) -> DataFrame:
    out = entities.input_digests(t.conversations, ["conv_id", "turn"], ["role", "text"])
    return out.select("conv_id", "turn", F.col("input_sha256.role").alias("role_sha256"), F.col("input_sha256.text").alias("text_sha256"))


@query(
    "intake_inventory",
    "S8",
    """
SELECT regexp_extract(url, '://([^/]+)/', 1) AS paper_id, regexp_extract(url, '([^/]+)$', 1) AS source_file,
  '2024-05-01T00:00:00Z' AS created_at FROM pages
""",
)
def intake_inventory(t: Tables) -> DataFrame:
    files = t.pages.select(F.col("url").alias("path"))
    when = F.expr("timestamp '2024-05-01 00:00:00'")
    return entities.intake_inventory(files, F.regexp_extract("path", "://([^/]+)/", 1), when)


@query(
    "snapshot_rows",
    "S9",
    """
SELECT concat('c', o_custkey) AS paper_id, 'claim' AS kind, concat('o', o_orderkey) AS item_id, o_orderstatus AS status, NULL AS digest FROM orders
UNION ALL SELECT source, 'assumption', concat('d', doc_id), NULL, sha256(text) FROM documents
UNION ALL SELECT concat('o', l_orderkey), 'declaration', concat('p', l_partkey), l_linestatus, NULL FROM lineitem
UNION ALL SELECT concat('o', o_orderkey), 'declaration', concat('m', o_custkey), '', NULL FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""",
)
def snapshot_rows(t: Tables) -> DataFrame:
    claims = t.orders.selectExpr("concat('c', o_custkey) AS paper_id", "concat('o', o_orderkey) AS id", "o_orderstatus AS status")
    texts = t.documents.selectExpr("source AS paper_id", "concat('d', doc_id) AS id", "text")
    cards = t.lineitem.selectExpr("concat('o', l_orderkey) AS paper_id", "concat('p', l_partkey) AS lean_decl", "l_linestatus AS proof_status")
    manifests = t.orders.selectExpr("concat('o', o_orderkey) AS paper_id", "array(concat('m', o_custkey)) AS declaration_index")
    return export.snapshot_rows(claims, texts, cards, manifests)


@query(
    "gold_span_scaffold",
    "S11",
    """
SELECT source AS paper_id, doc_id AS claim_id, 1 AS start_page, n_chars AS end_offset FROM documents WHERE n_chars >= 200
""",
)
def gold_span_scaffold(t: Tables) -> DataFrame:
    span = """CASE WHEN n_chars >= 200 THEN named_struct('source_file', source, 'start', named_struct('page', 1, 'offset', 0L),
              'end', named_struct('page', 1, 'offset', n_chars)) END AS source_span"""
    claims = t.documents.selectExpr("source AS paper_id", "doc_id AS id", span).withColumn("id", F.col("id").cast("string"))
    spans = intake.scaffold_gold(claims, claims)["gold_spans"]
    return spans.select(
        "paper_id", F.col("claim_id").cast("long").alias("claim_id"), "source_span.start.page", F.col("source_span.end.offset").alias("end_offset")
    ).withColumnRenamed("page", "start_page")


@query(
    "export_totals",
    "S10 A3",
    """
SELECT 'claims' AS metric, count(*)::DOUBLE AS value FROM orders UNION ALL SELECT 'cards', count(*)::DOUBLE FROM lineitem
UNION ALL SELECT 'papers', count(*)::DOUBLE FROM customer UNION ALL SELECT 'symbols', count(*)::DOUBLE FROM part
UNION ALL SELECT 'texts', count(*)::DOUBLE FROM documents
""",
)
def export_totals(t: Tables) -> DataFrame:
    return metrics.entity_totals(claims=t.orders, cards=t.lineitem, papers=t.customer, symbols=t.part, texts=t.documents)


@query(
    "published_version",
    "S10 S12",
    """
SELECT concat('c', c_custkey) AS paper_id, coalesce(n, 0) AS claims, coalesce(s, 0) AS cards,
  CASE WHEN c_acctbal < 0 THEN '2020-01-01T00:00:00Z' ELSE '2024-05-01T00:00:00Z' END AS first_artifact_at
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) b ON b.o_custkey = c_custkey
""",
)
def published_version(t: Tables) -> DataFrame:
    path = f"{checkpoint_dir(t.spark)}/corpusgate/published-{uuid.uuid4().hex}"
    papers = t.customer.selectExpr(
        "concat('c', c_custkey) AS paper_id", "CASE WHEN c_acctbal < 0 THEN '2020-01-01T00:00:00Z' ELSE '' END AS first_artifact_at"
    )
    claims = t.orders.selectExpr("concat('c', o_custkey) AS paper_id", "o_orderkey AS id", "o_orderstatus AS status")
    cards = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr("concat('c', o_custkey) AS paper_id", "l_linenumber AS id")
    export.commit_version({"papers": papers, "claims": claims.where("status = 'F'"), "cards": cards}, path)
    held = export.read_version(t.spark, path)
    again = publication.first_artifacts(held["papers"], F.lit("2024-05-01T00:00:00Z"))
    export.commit_version({"papers": again, "claims": claims, "cards": held["cards"]}, path)
    now = export.read_version(t.spark, path)
    count = lambda name: now[name].groupBy("paper_id").agg(F.count(F.lit(1)).alias(name))
    out = now["papers"].join(count("claims"), "paper_id", "left").join(count("cards"), "paper_id", "left")
    return out.fillna(0, ["claims", "cards"]).select("paper_id", "claims", "cards", "first_artifact_at")


@query(
    "salvage_json",
    "S13 F",
    """
SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
  CASE event_type WHEN 'error' THEN 'no object' WHEN 'signup' THEN 'unparsable' END AS reason FROM events
""",
)
def salvage_json(t: Tables) -> DataFrame:
    noisy = t.events.selectExpr(
        "event_id",
        """CASE event_type
             WHEN 'view' THEN concat('Answer:\\n```json\\n', props, '\\n```\\nDone }')
             WHEN 'click' THEN concat('  text before ', props, ' and after')
             WHEN 'purchase' THEN props
             WHEN 'signup' THEN concat('{ broken ', props)
             ELSE 'nothing here' END AS answer""",
    )
    return entities.salvage_json(noisy, "answer", "k bigint").select("event_id", "parsed.k", "reason")


@query(
    "report_markdown",
    "S14",
    """
SELECT concat('# Orders by status', chr(10), chr(10), string_agg(concat('- ', o_orderstatus, ': ', n), chr(10) ORDER BY o_orderstatus)) AS markdown
FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
""",
)
def report_markdown(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return export.markdown_lines(counts, "Orders by status", "o_orderstatus", "n")


def _stream(t: Tables, name: str) -> DataFrame:
    # a pattern, as a stream takes a single file only by one
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.folder}/{name}.parquet*")


@query(
    "streamed_latency_pairs",
    "ST3",
    """
WITH e AS (SELECT user_id, ts, event_type = 'signup' AS s FROM events WHERE event_type IN ('signup', 'purchase')),
g AS (SELECT *, count(*) FILTER (NOT s) OVER (PARTITION BY user_id ORDER BY ts, s DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ends
  FROM (SELECT event_id, user_id, ts, event_type = 'signup' AS s FROM events WHERE event_type IN ('signup', 'purchase'))),
p AS (SELECT user_id, ends, min(ts) FILTER (s) AS started, min(ts) FILTER (NOT s) AS ended FROM g GROUP BY 1, 2),
w AS (SELECT date_trunc('milliseconds', max(ts) - INTERVAL 1 HOUR) AS passed FROM e)
SELECT user_id, epoch_us(started) AS started_us, epoch_us(ended) - epoch_us(started) AS us FROM p, w
WHERE started IS NOT NULL AND ended IS NOT NULL AND ended < passed
""",
)
def streamed_latency_pairs(t: Tables) -> DataFrame:
    # The whole table as a stream, run until it is used up; pairs that end in the last hour are still open then.
    events = _stream(t, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    pairs = streaming.latency_pairs(events, "user_id", "ts", "event_type", "signup", "purchase", "1 hour", "36500 days")
    out = f"{checkpoint_dir(t.spark)}/corpusgate/streamed-{uuid.uuid4().hex}"
    streaming.write_batches(pairs, streaming.table_sink(out), out.rsplit("/", 1)[1]).awaitTermination()
    return streaming.written(t.spark, out).select(
        "user_id", F.unix_micros("started").alias("started_us"), (F.unix_micros("ended") - F.unix_micros("started")).alias("us")
    )


@query(
    "streamed_open_references",
    "ST2",
    """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
""",
)
def streamed_open_references(t: Tables) -> DataFrame:
    # Customers of one segment come after the orders; the last batch finds them, and orders of another segment stay open.
    orders = _stream(t, "orders").select("o_orderkey", "o_custkey")
    out, on = f"{checkpoint_dir(t.spark)}/corpusgate/ledger-{uuid.uuid4().hex}", {"o_custkey": "c_custkey"}
    early = t.customer.where("c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
    streaming.write_batches(orders, streaming.orphan_ledger(lambda: early, on, out), out.rsplit("/", 1)[1]).awaitTermination()
    return streaming.settled_orphans(t.spark, out, t.customer.where("c_mktsegment <> 'BUILDING'"), on)
