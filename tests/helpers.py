"""Small frames in the shape of the corpus tables."""

from corpusgate import schemas

SPAN = {"source_file": "a.pdf", "start": {"page": 1, "offset": 0}, "end": {"page": 1, "offset": 9}}


def rows(spark, ddl, *items):
    """Frame with the given DDL from dicts; absent fields are null."""
    names = schemas.field_names(ddl)
    return spark.createDataFrame([tuple(i.get(n) for n in names) for i in items], ddl)


def claims(spark, *items):
    base = {"paper_id": "p1", "source_span": SPAN, "informal_text": "text", "status": "parsed", "section": "1"}
    numbered = [base | {"pos": i} | item for i, item in enumerate(items)]
    return rows(spark, "pos int, " + schemas.CLAIM, *numbered)


def cards(spark, *items):
    base = {"paper_id": "p1", "file_path": "formal/A.lean", "proof_status": "mapped", "reviewer_status": "unreviewed"}
    numbered = [base | {"pos": i} | item for i, item in enumerate(items)]
    return rows(spark, "paper_id string, pos int, " + schemas.CARD, *numbered)


def symbols(spark, *items):
    numbered = [{"paper_id": "p1", "pos": i} | item for i, item in enumerate(items)]
    return rows(spark, "pos int, " + schemas.SYMBOL, *numbered)


def assumptions(spark, *items):
    numbered = [{"paper_id": "p1", "pos": i, "text": "t"} | item for i, item in enumerate(items)]
    return rows(spark, "pos int, " + schemas.ASSUMPTION, *numbered)


def mapping(spark, *items):
    return rows(spark, schemas.MAPPING, *[{"paper_id": "p1", "namespace": "N.S"} | i for i in items])


def manifests(spark, *items):
    return rows(spark, schemas.MANIFEST, *[{"paper_id": "p1"} | i for i in items])


def papers(spark, *items):
    base = {"title": "T", "authors": ["A"], "year": 2000, "domain": "physics", "artifact_status": "admitted"}
    full = [base | {"id": "p1", "source": {"kind": "pdf", "path": "x", "sha256": "a" * 64}} | i for i in items]
    return rows(spark, schemas.PAPER, *full)


def kernels(spark, *items):
    return rows(spark, schemas.KERNEL, *items)


def messages(df):
    return sorted(r["message"] for r in df.collect())


def found(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())
