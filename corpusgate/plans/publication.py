"""Publication: cards, manifests and indices of all papers as one DataFrame plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgate.functions import aggregates as agg
from corpusgate.functions import columns as c
from corpusgate.operators import documents, linking, metrics, ordering
from corpusgate.session import durable
from corpusgate.sources import export


@dataclass
class Corpus:
    """The entity tables of a corpus, as read by :mod:`corpusgate.sources.entities`."""

    papers: DataFrame
    claims: DataFrame
    assumptions: DataFrame
    symbols: DataFrame
    mapping: DataFrame
    cards: DataFrame
    manifests: DataFrame
    kernels: DataFrame
    docs: DataFrame
    runs: DataFrame | None = None


def published_cards(corpus: Corpus, namespace_root: str) -> DataFrame:
    """Derived cards with reviewer state carried over, dependencies and executable links."""
    cards = linking.derive_cards(corpus.mapping, corpus.claims)
    old = corpus.cards.select("paper_id", "pos", "claim_id", "lean_decl", "reviewer_status", "notes")
    cards = linking.carry_over(
        cards, old, ["paper_id", "claim_id", "lean_decl"], ["reviewer_status"], ["notes"], old_order=["pos"]
    )
    edges = documents.dependency_edges(cards, corpus.docs, namespace_root, keep_self=True)
    cards = documents.with_dependencies(cards, edges)
    return linking.enrich_links(cards, "id", "executable_links", corpus.kernels, "id", "linked_theorem_cards")


def build_fingerprint(corpus: Corpus, cards: DataFrame) -> DataFrame:
    """``(paper_id, build_hash, build_hash_version)`` of every paper.

    Version 2 covers the paper's input rows, with a mark for each kind it has none of, its cards, source hash,
    linking kernels and id. A paper without claims gets version 1: its id, declarations and their files.
    Rows are hashed one by one and combined without order inside a paper, so a paper of any size is
    aggregated like any other. The value is this library's own and not comparable with other tools.
    """
    def rows(df: DataFrame, kind: str, cols: list[str]) -> DataFrame:
        text = F.to_json(F.struct(*cols))
        return df.select("paper_id", F.lit(kind).alias("kind"), agg.row_digest(F.lit(kind), text).alias("d"))

    def one(df: DataFrame, kind: str, *cols: Column) -> DataFrame:
        return df.select("paper_id", F.lit(kind).alias("kind"), agg.row_digest(F.lit(kind), *cols).alias("d"))

    papers = corpus.papers.select(F.col("id").alias("paper_id"), "source")
    kernels = linking.linking_sources(
        corpus.kernels.select(F.col("id").alias("kernel_id"), "linked_theorem_cards"), "linked_theorem_cards", cards, "id", ["paper_id"]
    )
    declared = cards.where(c.not_blank("lean_decl"))
    filed = cards.where(c.not_blank("file_path"))
    parts = [
        rows(corpus.claims, "claims", ["pos", "raw"]),
        rows(corpus.assumptions, "assumptions", ["pos", "raw"]),
        rows(corpus.symbols, "symbols", ["pos", "raw"]),
        rows(corpus.mapping, "mapping", ["raw"]),
        rows(cards, "cards", [x for x in sorted(cards.columns) if x != "paper_id"]),
        one(papers, "source", c.strip("source.sha256")),
        one(kernels, "kernels", F.col("kernel_id")),
        one(papers, "id", F.col("paper_id")),
        one(declared, "declaration", F.col("lean_decl")),
        one(filed, "file", c.strip("file_path")),
    ]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    old = F.col("kind").isin("id", "declaration", "file")
    inputs = ["claims", "assumptions", "symbols", "mapping"]
    held = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in inputs]
    per = both.groupBy("paper_id").agg(
        agg.multiset_fingerprint(F.when(~F.col("kind").isin("declaration", "file"), F.col("d"))).alias("full"),
        agg.multiset_fingerprint(F.when(old, F.col("d"))).alias("brief"),
        *held,
    )
    lacks = [F.when(F.col(f"n_{k}") == 0, F.lit(f"{k}:missing")).otherwise(F.lit("")) for k in inputs]
    full = F.sha2(F.concat_ws("\u0001", "full", *lacks), 256)
    known = F.col("n_claims") > 0
    return per.select(
        "paper_id", F.when(known, full).otherwise(F.col("brief")).alias("build_hash"), F.when(known, "2").otherwise("1").alias("build_hash_version")
    )


def first_artifacts(papers: DataFrame, now: Column | None = None) -> DataFrame:
    """Papers with the time of their first publication: set once, kept ever after."""
    when = c.instant_text(F.current_timestamp()) if now is None else now
    return papers.withColumn("first_artifact_at", ordering.set_once(F.col("first_artifact_at"), when))


def publish(corpus: Corpus, namespace_root: str, now: Column | None = None, store: bool = False) -> dict[str, DataFrame]:
    """The published tables: papers, cards, edges, coverage, pages, kernel index, fingerprints, declarations.

    With ``store`` the cards, which most tables derive from, are written once.
    """
    cards = published_cards(corpus, namespace_root)
    if store:
        cards = durable(cards, "cards")
    linked = metrics.linked_claims(corpus.claims, cards)
    cov = metrics.coverage(
        linked, ["paper_id"], c.has_items("linked_formal_targets"),
        F.col("status") == "machine_checked", F.col("kernel_linked"),
    )
    pages = metrics.pages_index(corpus.papers.select(F.col("id").alias("paper_id")), corpus.claims, cards)
    kernels = corpus.kernels.select(F.col("id").alias("kernel_id"), "linked_theorem_cards")
    return {
        "papers": first_artifacts(corpus.papers, now),
        "theorem_cards": cards,
        "dependency_graph": metrics.edges_from_cards(cards),
        "coverage": cov,
        "generated_pages": pages,
        "kernel_index": linking.linking_sources(kernels, "linked_theorem_cards", cards, "id", ["paper_id"]),
        "build_hash": build_fingerprint(corpus, cards),
        "declaration_index": cards.select("paper_id", "pos", "lean_decl"),
    }


def publish_to(corpus: Corpus, namespace_root: str, path: str, now: Column | None = None) -> str:
    """Publish into ``path`` as one version, see :func:`export.commit_version`."""
    tables = publish(corpus, namespace_root, now, store=True)
    return export.commit_version(tables, path)


def lookup_tables(cards: DataFrame, claims: DataFrame, manifests: DataFrame, kernels: DataFrame) -> dict[str, DataFrame]:
    """Lookup indices as long tables."""
    listed = manifests.select("paper_id", F.posexplode("kernel_index").alias("at", "kernel_id"))
    linked = kernels.select(F.col("id").alias("kernel_id"), "pos", F.posexplode("linked_theorem_cards").alias("at", "card_id"))
    decls = cards.where(c.not_blank("lean_decl")).groupBy("lean_decl").agg(
        F.min_by("id", F.struct("paper_id", "pos")).alias("card_id")
    )
    return {
        "claim_to_paper": claims.where(c.not_blank("id")).groupBy("id").agg(F.max("paper_id").alias("paper_id")),
        "card_to_paper": cards.where(c.not_blank("id")).groupBy("id").agg(F.max("paper_id").alias("paper_id")),
        "declaration_to_card": decls,
        "kernel_to_paper": metrics.reverse_index(listed, "kernel_id", "paper_id", ["paper_id", "at"]),
        "card_to_kernel": metrics.reverse_index(linked, "card_id", "kernel_id", ["pos", "at"]),
        "route_ids": metrics.route_ids(cards),
    }
