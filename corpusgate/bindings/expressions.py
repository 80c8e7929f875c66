"""Column expressions, row predicates and symbol rules on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.bindings.base import Tables, query
from corpusgate.functions import columns as c
from corpusgate.operators import checks, documents, linking, metrics, similarity, symbols

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'machine_checked' WHEN 'O' THEN 'linked_to_kernel' ELSE 'stubbed' END"
BOUNDARY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'fully_machine_checked' WHEN '2-HIGH' THEN 'machine_checked_plus_axioms'
  WHEN '3-MEDIUM' THEN 'human_review_only' WHEN '4-NOT SPECIFIED' THEN '' ELSE 'numerically_witnessed' END"""
SQL_SQUEEZE = "trim(regexp_replace(lower({}), '[^a-z0-9]+', '_', 'g'), '_')"


@query(
    "link_and_span_predicates",
    "P1 P2",
    """
SELECT count(*) FILTER (text LIKE '%@%') AS with_links, count(*) FILTER (NOT text LIKE '%@%') AS without_links,
  count(*) FILTER (n_chars > 0 AND source <> 'src3') AS span_complete FROM documents
""",
)
def link_and_span_predicates(t: Tables) -> DataFrame:
    rows = t.documents.selectExpr(
        "CASE WHEN contains(text, '@') THEN array('mail') WHEN lang = 'de' THEN array() ELSE NULL END AS links",
        """named_struct('source_file', CASE WHEN source = 'src3' THEN '' ELSE source END, 'start', named_struct('page', 1, 'offset', 0),
           'end', CASE WHEN n_chars > 0 THEN named_struct('page', 1, 'offset', n_chars) END) AS span""",
    )
    return rows.agg(
        F.count_if(c.has_items("links")).alias("with_links"),
        F.count_if(~c.has_items("links")).alias("without_links"),
        F.count_if(c.span_complete("span")).alias("span_complete"),
    )


@query(
    "canonical_names",
    "P3 P4 F",
    f"""
SELECT page_id, CASE WHEN s = '' THEN 'symbol' ELSE s END AS canonical,
  CASE WHEN d = '' THEN 'unnamed' WHEN regexp_matches(d, '^[0-9]') THEN concat('c_', d) ELSE d END AS ident
FROM (SELECT page_id, {SQL_SQUEEZE.format("url")} AS s, {SQL_SQUEEZE.format("regexp_extract(url, '/([^/]*)$', 1)")} AS d FROM pages)
""",
)
def canonical_names(t: Tables) -> DataFrame:
    tail = F.regexp_extract("url", "/([^/]*)$", 1)
    return t.pages.select("page_id", c.canonical_name("url").alias("canonical"), c.identifier(tail).alias("ident"))


@query(
    "default_namespaces",
    "P5 P6",
    """
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN concat('Corpus.Chem.Gas', upper(substr(lower(c_mktsegment), 1, 1)), substr(lower(c_mktsegment), 2), 1900 + c_nationkey)
    ELSE concat('Corpus.Papers.', lower(c_mktsegment), '_', c_custkey, '_x') END AS namespace,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN concat('formal/Corpus/Chem/Gas', upper(substr(lower(c_mktsegment), 1, 1)), substr(lower(c_mktsegment), 2), 1900 + c_nationkey, '.lean')
    WHEN c_acctbal < 0 THEN 'own/path.lean'
    ELSE concat('formal/Corpus/Papers/', lower(c_mktsegment), '_', c_custkey, '_x.lean') END AS target_path
FROM customer
""",
)
def default_namespaces(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr(
        "c_custkey",
        """CASE WHEN c_mktsegment = 'MACHINERY' THEN concat('gas-', lower(c_mktsegment), '_adsorption.', 1900 + c_nationkey)
             ELSE concat(lower(c_mktsegment), '-', c_custkey, '.x') END AS paper_id""",
        "CASE WHEN c_acctbal < 0 AND c_mktsegment <> 'MACHINERY' THEN ' own/path.lean ' ELSE ' ' END AS target_file",
    )
    ns = c.default_namespace("paper_id", "Corpus.Papers", "adsorption", "Corpus.Chem")
    named = rows.withColumn("namespace", ns)
    return named.select("c_custkey", "namespace", c.target_path("namespace", "target_file").alias("target_path"))


@query(
    "inferred_declarations",
    "P7 J28",
    """
SELECT concat('c', o_custkey) AS paper_id, concat('x_claim_', o_orderkey) AS claim_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN concat('t_', o_orderkey) WHEN '2-HIGH' THEN 'tail' WHEN '3-MEDIUM' THEN 'plain'
    WHEN '4-NOT SPECIFIED' THEN concat('claim_c_', o_orderkey) ELSE 'kept' END AS short_decl
FROM orders
""",
)
def inferred_declarations(t: Tables) -> DataFrame:
    claims = t.orders.selectExpr(
        "concat('c', o_custkey) AS paper_id",
        "o_orderkey AS pos",
        "concat('x_claim_', o_orderkey) AS id",
        """CASE o_orderpriority WHEN '1-URGENT' THEN array(' ', concat('N.S.t_', o_orderkey)) WHEN '2-HIGH' THEN array('Other.x.tail', 'b')
             WHEN '3-MEDIUM' THEN array('plain') WHEN '4-NOT SPECIFIED' THEN array(' ') ELSE array('N.S.lost') END AS linked_formal_targets""",
        "o_orderpriority",
    )
    existing = claims.selectExpr(
        "paper_id", "id AS claim_id", "CASE WHEN o_orderpriority = '5-LOW' THEN 'kept' ELSE ' ' END AS short_decl"
    )
    namespaces = t.customer.selectExpr("concat('c', c_custkey) AS paper_id", "'N.S' AS namespace")
    return linking.fill_mapping(claims, existing, namespaces)


@query(
    "status_rules",
    "P8 P9 P10 P11",
    f"""
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'fully_machine_checked' WHEN 'O' THEN 'numerically_witnessed' ELSE 'human_review_only' END AS boundary,
  CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'reviewed' ELSE 'unreviewed' END AS reviewer,
  CASE WHEN b = '' THEN 'human_review_only' ELSE b END AS suggested_boundary,
  CASE WHEN s = 'machine_checked' AND b = 'fully_machine_checked' THEN 0 ELSE 1 END AS needs_repair,
  CASE WHEN s IN ('stubbed', 'compiles_with_sorries') THEN 'consider_completing_proof' WHEN b = 'human_review_only' THEN 'consider_machine_verification'
    WHEN b = 'machine_checked_plus_axioms' THEN 'consider_axiom_reduction' WHEN s <> 'machine_checked' THEN 'consider_completing_proof'
    ELSE 'consider_review' END AS action
FROM (SELECT *, {STATUS} AS s, {BOUNDARY} AS b FROM orders)
""",
)
def status_rules(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr("o_orderkey", f"{STATUS} AS s", f"{BOUNDARY} AS b")
    return rows.select(
        "o_orderkey",
        c.status_to_boundary("s").alias("boundary"),
        c.derive_reviewer_status("s").alias("reviewer"),
        c.suggest_boundary("b").alias("suggested_boundary"),
        c.needs_repair("s", "b").cast("int").alias("needs_repair"),
        c.suggested_action("s", "b").alias("action"),
    )


@query(
    "repair_proposals",
    "P11",
    f"""
SELECT action, count(*) AS n FROM (SELECT CASE WHEN s = 'stubbed' THEN 'consider_completing_proof' WHEN b = 'human_review_only' THEN 'consider_machine_verification'
    WHEN b = 'machine_checked_plus_axioms' THEN 'consider_axiom_reduction' WHEN s <> 'machine_checked' THEN 'consider_completing_proof'
    ELSE 'consider_review' END AS action
  FROM (SELECT {STATUS} AS s, {BOUNDARY} AS b FROM orders) WHERE NOT (s = 'machine_checked' AND b = 'fully_machine_checked')) GROUP BY 1
""",
)
def repair_proposals(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(f"{STATUS} AS s", f"{BOUNDARY} AS b").where(c.needs_repair("s", "b"))
    return rows.groupBy(c.suggested_action("s", "b").alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "default_value_kinds",
    "P13",
    """
SELECT coalesce(nullif(v, ''), CASE WHEN ty IN ('definition', 'theorem') THEN 'foundational_law' ELSE 'bridge_lemma' END) AS value_kind, count(*) AS n
FROM (SELECT CASE WHEN o_totalprice > 300000 THEN 'executable_contract' ELSE '' END AS v,
        CASE o_orderstatus WHEN 'F' THEN 'definition' WHEN 'O' THEN 'theorem' ELSE 'identity' END AS ty FROM orders) GROUP BY 1
""",
)
def default_value_kinds(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(
        "CASE WHEN o_totalprice > 300000 THEN 'executable_contract' ELSE ' ' END AS v",
        "CASE o_orderstatus WHEN 'F' THEN 'definition' WHEN 'O' THEN 'theorem' ELSE 'identity' END AS ty",
    )
    return rows.groupBy(c.default_value_kind("ty", "v").alias("value_kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "missing_identifiers",
    "P14",
    """
SELECT concat('c', c_custkey) AS group_id, 'no DOI or arXiv id' AS message FROM customer
WHERE 2000 + c_nationkey <= 2015 AND c_mktsegment NOT IN ('BUILDING', 'FURNITURE')
""",
)
def missing_identifiers(t: Tables) -> DataFrame:
    papers = t.customer.selectExpr(
        "concat('c', c_custkey) AS id",
        "2000 + c_nationkey AS year",
        """named_struct('doi', CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END,
             'arxiv_id', CASE WHEN c_mktsegment = 'FURNITURE' THEN c_name ELSE '' END) AS source""",
    )
    return checks.missing_identifier(papers, F.lit(2015)).select("group_id", "message")


@query(
    "disputed_snippets",
    "P15",
    "SELECT lang AS paper_id, doc_id AS id, substr(text, 1, 80) AS snippet FROM documents JOIN labels USING (doc_id) WHERE toxic = 1",
)
def disputed_snippets(t: Tables) -> DataFrame:
    claims = t.documents.join(t.labels, "doc_id").selectExpr(
        "lang AS paper_id", "doc_id AS id", "text AS informal_text", "CASE WHEN toxic = 1 THEN 'disputed' ELSE 'parsed' END AS status"
    )
    return checks.disputed(claims)


@query("search_index", "P16", "SELECT doc_id, source, substr(text, 1, 200) AS snippet FROM documents")
def search_index(t: Tables) -> DataFrame:
    return similarity.search_index(t.documents, "doc_id", "source", "text")


@query(
    "search_many",
    "P17",
    """
WITH q AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS query FROM part UNION SELECT DISTINCT upper(lang) FROM documents UNION SELECT ' ')
SELECT d.doc_id, q.query FROM documents d JOIN q ON trim(q.query) <> ''
 AND (contains(lower(substr(d.text, 1, 200)), lower(q.query)) OR contains(lower(d.source), lower(q.query)) OR contains(lower(d.lang), lower(q.query)))
""",
)
def search_many(t: Tables) -> DataFrame:
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("query"))
    langs = t.documents.select(F.upper("lang").alias("query"))
    blank = t.region.select(F.lit(" ").alias("query"))
    wanted = words.union(langs).union(blank).distinct()
    rows = similarity.search_index(t.documents, "doc_id", "source", "text").join(t.documents.select("doc_id", "lang"), "doc_id")
    return similarity.search_rows(rows, ["snippet", "source", "lang"], wanted, "query").select("doc_id", "query")


@query(
    "declaration_listing",
    "P18 U5",
    """
SELECT paper_id, lean_decl, source, count(*) AS n FROM (
  SELECT concat('o', o_orderkey) AS paper_id, concat('c', o_custkey) AS lean_decl, 'manifest' AS source FROM orders
  UNION ALL SELECT concat('o', l_orderkey), concat('p', l_partkey), 'theorem_cards' FROM lineitem) GROUP BY ALL
""",
)
def declaration_listing(t: Tables) -> DataFrame:
    rows = _declarations(t)
    return rows.groupBy("paper_id", "lean_decl", "source").agg(F.count(F.lit(1)).alias("n"))


def _declarations(t: Tables) -> DataFrame:
    manifest = t.orders.selectExpr("concat('o', o_orderkey) AS paper_id", "array(concat('c', o_custkey)) AS declaration_index")
    cards = t.lineitem.selectExpr(
        "concat('o', l_orderkey) AS paper_id", "concat('p', l_partkey) AS lean_decl",
        "concat('formal\\\\', l_returnflag, '\\\\', l_linestatus, '.lean') AS file_path", "l_linestatus AS proof_status", "concat('s', l_suppkey) AS claim_id",
    )
    return metrics.declaration_rows(manifest, cards)


@query(
    "declarations_in_file",
    "P18",
    "SELECT concat('p', l_partkey) AS lean_decl, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1",
)
def declarations_in_file(t: Tables) -> DataFrame:
    rows = metrics.declarations_in_file(_declarations(t), " R\\F.lean")
    return rows.groupBy("lean_decl").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dependencies_of",
    "P19 W12",
    """
SELECT concat('o', l_orderkey) AS paper_id, concat('p', l_partkey) AS lean_decl, dep AS dependency_id, min(l_linenumber) AS first_pos FROM (
  SELECT l_orderkey, l_partkey, l_linenumber, unnest([concat('s', l_suppkey), concat('q', l_quantity::INT)]) AS dep FROM lineitem)
GROUP BY ALL
""",
)
def dependencies_of(t: Tables) -> DataFrame:
    cards = t.lineitem.selectExpr(
        "concat('o', l_orderkey) AS paper_id", "concat('p', l_partkey) AS lean_decl", "l_linenumber AS pos",
        "array(concat('s', l_suppkey), concat('q', cast(l_quantity AS int))) AS dependency_ids",
    )
    deps = metrics.dependencies_of(cards, cards)
    return deps.select("paper_id", "lean_decl", "dependency_id", F.col("first_seen.pos").alias("first_pos"))


SYMBOL_SQL = """SELECT p_brand AS paper_id, p_partkey AS pos, concat('y', p_partkey) AS id, p_name AS normalized_name,
  CASE WHEN p_size > 40 THEN 'length' ELSE '' END AS dimension, CASE WHEN p_size > 45 THEN 'm' ELSE '' END AS unit, p_type FROM part"""


def _symbols(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_brand AS paper_id",
        "p_partkey AS pos",
        "concat('y', p_partkey) AS id",
        "p_name AS normalized_name",
        "p_name AS raw_latex",
        """named_struct('kind', cast(NULL AS string), 'unit', CASE WHEN p_size > 45 THEN 'm' ELSE '' END,
             'dimension', CASE WHEN p_size > 40 THEN 'length' ELSE '' END) AS dimensional_metadata""",
        "CASE p_type WHEN 'PROMO' THEN array('role_unclear', 'bogus') WHEN 'LARGE' THEN array('overloaded_symbol') ELSE array() END AS ambiguity_flags",
    )


@query(
    "suggested_ambiguity_flags",
    "P20 W2 U3",
    f"""
SELECT id, array_to_string(list_sort(flags), ',') AS flags FROM (
  SELECT id, list_distinct(list_filter([CASE p_type WHEN 'PROMO' THEN 'role_unclear' WHEN 'LARGE' THEN 'overloaded_symbol' END,
     CASE WHEN count(*) OVER (PARTITION BY paper_id, normalized_name) > 1 THEN 'overloaded_symbol' END,
     CASE WHEN dimension <> '' AND unit = '' THEN 'unit_unclear' END], lambda x: x IS NOT NULL)) AS flags FROM ({SYMBOL_SQL}))
WHERE len(flags) > 0
""",
)
def suggested_ambiguity_flags(t: Tables) -> DataFrame:
    out = symbols.suggest_ambiguity(_symbols(t))
    return out.select("id", F.array_join(F.sort_array("suggested_flags"), ",").alias("flags"))


@query(
    "applied_ambiguity_flags",
    "P20",
    f"""
SELECT id, array_to_string(new, ',') AS flags FROM (
  SELECT id, list_sort(list_distinct(list_filter([CASE p_type WHEN 'PROMO' THEN 'role_unclear' WHEN 'LARGE' THEN 'overloaded_symbol' END,
     CASE WHEN count(*) OVER (PARTITION BY paper_id, normalized_name) > 1 THEN 'overloaded_symbol' END,
     CASE WHEN dimension <> '' AND unit = '' THEN 'unit_unclear' END], lambda x: x IS NOT NULL))) AS new,
     CASE p_type WHEN 'PROMO' THEN ['bogus', 'role_unclear'] WHEN 'LARGE' THEN ['overloaded_symbol'] ELSE []::VARCHAR[] END AS old FROM ({SYMBOL_SQL}))
WHERE new <> old
""",
)
def applied_ambiguity_flags(t: Tables) -> DataFrame:
    out = symbols.apply_ambiguity(_symbols(t)).where("changed")
    return out.select("id", F.array_join("ambiguity_flags", ",").alias("flags"))


@query(
    "normalized_symbols",
    "P3 P12 W1 A33",
    f"""
SELECT id, replace(normalized_name, ' ', '_') AS normalized_name, 'unknown' AS kind, unit, dimension,
  array_to_string(list_sort(list_distinct(list_filter(
    CASE p_type WHEN 'PROMO' THEN ['bogus', 'role_unclear'] WHEN 'LARGE' THEN ['overloaded_symbol'] ELSE []::VARCHAR[] END
    || [CASE WHEN row_number() OVER (PARTITION BY paper_id, normalized_name ORDER BY pos) > 1 THEN 'overloaded_symbol' END],
    lambda x: x IS NOT NULL))), ',') AS flags
FROM ({SYMBOL_SQL})
""",
)
def normalized_symbols(t: Tables) -> DataFrame:
    out = symbols.normalize_symbols(_symbols(t))
    return out.select("id", "normalized_name", "dimensional_metadata.*", F.array_join("ambiguity_flags", ",").alias("flags"))


@query(
    "incident_edges",
    "P21",
    """
WITH n AS (SELECT concat('p', p_partkey) AS node FROM part WHERE p_brand = 'Brand#3' UNION SELECT concat('s', s_suppkey) FROM supplier WHERE s_acctbal < 0),
e AS (SELECT concat('s', l_suppkey) AS src, concat('p', l_partkey) AS dst FROM lineitem)
SELECT src, dst, count(*) AS n FROM e WHERE src IN (SELECT node FROM n) OR dst IN (SELECT node FROM n) GROUP BY ALL
""",
)
def incident_edges(t: Tables) -> DataFrame:
    edges = t.lineitem.selectExpr("concat('s', l_suppkey) AS src", "concat('p', l_partkey) AS dst")
    nodes = t.part.where("p_brand = 'Brand#3'").selectExpr("concat('p', p_partkey) AS node").unionByName(
        t.supplier.where("s_acctbal < 0").selectExpr("concat('s', s_suppkey) AS node")
    )
    return metrics.incident_edges(edges, nodes).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


@query(
    "distinct_nodes",
    "P22 U3",
    "SELECT concat('s', l_suppkey) AS node FROM lineitem UNION SELECT concat('p', l_partkey) FROM lineitem",
)
def distinct_nodes(t: Tables) -> DataFrame:
    edges = t.lineitem.selectExpr("concat('s', l_suppkey) AS src", "concat('p', l_partkey) AS dst")
    return metrics.distinct_nodes(edges)


@query(
    "dimension_rules",
    "P23 P24",
    """
SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 1 ELSE 0 END AS dimensionless,
  CASE WHEN p_type = 'LARGE' THEN NULL WHEN p_type = 'MEDIUM' THEN NULL ELSE concat(p_name, ' / s') END AS unit FROM part
""",
)
def dimension_rules(t: Tables) -> DataFrame:
    rows = t.part.selectExpr(
        "p_partkey",
        "CASE p_type WHEN 'PROMO' THEN 'Theta' WHEN 'SMALL' THEN 'ga_mma' ELSE p_name END AS name",
        """CASE p_type WHEN 'LARGE' THEN concat('x in [', p_name, '] non-negative') WHEN 'MEDIUM' THEN p_brand
             WHEN 'PROMO' THEN concat('x Unit ', p_name, ' / s ') ELSE concat('x in [', p_name, ' / s] tail') END AS text""",
    )
    return rows.select(
        "p_partkey", c.is_dimensionless_name("name").cast("int").alias("dimensionless"), c.unit_from_text("text").alias("unit")
    )


@query(
    "dimension_suggestions",
    "J17 P23 P24",
    """
WITH k AS (SELECT s_suppkey AS pos, CASE WHEN s_acctbal > 5000 THEN concat('the red ring ', s_suppkey, ' and blue rod in [u', s_suppkey, ']')
     WHEN s_acctbal > 2000 THEN concat('cold gear is dimensionless ', s_suppkey) ELSE concat('New plate non-negative ', s_suppkey) END AS text,
     CASE WHEN s_acctbal > 5000 THEN concat('unit=u', s_suppkey) WHEN s_acctbal > 2000 THEN 'dimension=dimensionless' END AS v FROM supplier),
m AS (SELECT n, min_by(v, pos) AS v FROM (SELECT DISTINCT p_name AS n FROM part) JOIN k ON contains(lower(k.text), lower(n)) WHERE v IS NOT NULL GROUP BY n)
SELECT concat('y', p_partkey) AS id, v AS suggested, 'kernel' AS source FROM part JOIN m ON n = p_name WHERE p_size <= 40 AND p_type <> 'PROMO'
UNION ALL SELECT concat('y', p_partkey), 'dimension=dimensionless,kind=dimensionless', 'heuristic' FROM part WHERE p_size <= 40 AND p_type = 'PROMO'
""",
)
def dimension_suggestions(t: Tables) -> DataFrame:
    syms = t.part.selectExpr(
        "p_brand AS paper_id",
        "concat('y', p_partkey) AS id",
        "CASE WHEN p_type = 'PROMO' THEN 'al_pha' ELSE p_name END AS normalized_name",
        "named_struct('kind', cast(NULL AS string), 'unit', '', 'dimension', CASE WHEN p_size > 40 THEN 'length' ELSE '' END) AS dimensional_metadata",
    )
    texts = t.supplier.selectExpr(
        "s_suppkey AS pos",
        """CASE WHEN s_acctbal > 5000 THEN concat('the red ring ', s_suppkey, ' and blue rod in [u', s_suppkey, ']')
             WHEN s_acctbal > 2000 THEN concat('cold gear is dimensionless ', s_suppkey) ELSE concat('New plate non-negative ', s_suppkey) END AS text""",
    )
    return symbols.dimension_suggestions(syms, texts).select("id", "suggested", "source")


TARGET_FILE = """CASE event_type WHEN 'error' THEN 'formal/../x.lean' WHEN 'view' THEN ' formal\\\\A.lean'
  WHEN 'click' THEN 'other/B.lean' ELSE concat('formal/U', user_id, '.lean') END AS target_file"""


def _proposals(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "concat('e', event_id) AS proposal_id",
        TARGET_FILE,
        "event_type AS edit_kind",
        "CASE WHEN value > 10 THEN array(named_struct('find', props, 'replace', event_type), named_struct('find', event_type, 'replace', '')) ELSE array() END AS replacements",
    )


@query(
    "proposal_patches",
    "P25",
    """
SELECT concat('e', event_id) AS proposal_id, CASE event_type WHEN 'view' THEN 'formal/A.lean' ELSE concat('formal/U', user_id, '.lean') END AS path,
  seq, CASE seq WHEN 0 THEN props ELSE event_type END AS find, CASE seq WHEN 0 THEN event_type ELSE '' END AS replace
FROM events, (VALUES (0), (1)) s(seq) WHERE value > 10 AND event_type NOT IN ('error', 'click')
""",
)
def proposal_patches(t: Tables) -> DataFrame:
    return documents.proposal_patches(_proposals(t))


@query(
    "proposal_footprint",
    "A23",
    """
SELECT event_type AS edit_kind, count(*) AS proposals, count(*) FILTER (value > 10) AS with_replacements,
  count(*) FILTER (value > 10 AND event_type NOT IN ('error', 'click')) AS conversion_ready FROM events GROUP BY 1
""",
)
def proposal_footprint(t: Tables) -> DataFrame:
    return metrics.proposal_footprint(_proposals(t), "edit_kind", F.size("replacements"), "target_file")


@query(
    "normalized_categories",
    "P26",
    """
SELECT CASE event_type WHEN 'view' THEN 'proof_repair' WHEN 'click' THEN 'lemma_extraction' ELSE event_type END AS kind, count(*) AS n
FROM events GROUP BY 1
""",
)
def normalized_categories(t: Tables) -> DataFrame:
    raw = F.expr("CASE event_type WHEN 'view' THEN ' Proof_Fix' WHEN 'click' THEN 'NEW_LEMMA ' ELSE upper(event_type) END")
    return t.events.groupBy(c.normalize_category(raw).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "formatted_pairs",
    "P28",
    "SELECT p_partkey, concat(p_name, ': ', p_type, ', ', p_brand, ': ', p_size) AS pairs FROM part",
)
def formatted_pairs(t: Tables) -> DataFrame:
    pairs = t.part.selectExpr(
        "p_partkey", "array(named_struct('name', p_name, 'kind', p_type), named_struct('name', p_brand, 'kind', cast(p_size AS string))) AS p"
    )
    return pairs.select("p_partkey", c.format_pairs("p", "name", "kind").alias("pairs"))


@query(
    "literal_counts",
    "F",
    """
SELECT doc_id, ((length(text) - length(replace(text, 'er', ''))) / 2)::BIGINT AS n_er,
  CASE WHEN length(text) > 200 THEN concat(substr(text, 1, 200), '...') ELSE text END AS shown FROM documents
""",
)
def literal_counts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", c.literal_count("text", F.lit("er")).alias("n_er"), c.truncated("text", 200).alias("shown"))


@query(
    "fnv_digests",
    "F",
    """
SELECT p_partkey, format('{:x}', h) AS digest FROM (
  SELECT p_partkey, list_reduce(list_prepend(2166136261::UBIGINT, list_transform(string_split(p_name, ''), lambda ch: ascii(ch)::UBIGINT)),
    lambda h, c: (xor(h, c) * 16777619::UBIGINT) & 4294967295::UBIGINT) AS h FROM part)
""",
)
def fnv_digests(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", c.fnv1a_hex("p_name").alias("digest"))


@query(
    "parsed_instants",
    "F",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS at_us,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS shown FROM events
""",
)
def parsed_instants(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(c.instant_text("ts"))
    return t.events.select("event_id", F.unix_micros(c.parse_instant(text)).alias("at_us"), c.instant_text("ts").alias("shown"))


@query(
    "set_functions",
    "F U3 U4",
    """
SELECT l_orderkey, l_linenumber, sum(CASE WHEN l_partkey = l_suppkey THEN 1 ELSE 2 END)::BIGINT AS union_size,
  round(sum(CASE WHEN l_partkey = l_suppkey THEN 1.0::DOUBLE ELSE 0.0 END), 6)::DOUBLE AS similarity FROM lineitem GROUP BY ALL
""",
)
def set_functions(t: Tables) -> DataFrame:
    a, b = F.array("l_partkey"), F.array("l_suppkey")
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.size(F.array_union(a, b)).cast("long").alias("u"), c.jaccard(a, b).alias("j")
    )
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.sum("u").alias("union_size"), F.round(F.sum("j"), 6).alias("similarity"))
