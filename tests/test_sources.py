import hashlib
import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusgate import schemas
from corpusgate.operators import checks
from corpusgate.sources import entities, export, intake
from corpusgate.streaming import intake as streaming
from tests.helpers import assumptions, cards, claims, found, manifests


@pytest.fixture()
def root():
    return Path(tempfile.mkdtemp(prefix="run-"))


def put(root, paper, name, value):
    folder = root / paper
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")


def test_arrays_are_read_leniently(spark, root):
    put(root, "p-1", "claims.json", [{"id": "a", "status": "parsed"}, "junk", 3, {"id": "b", "linked_symbols": ["s"]}])
    put(root, "p-2", "claims.json", "{not json")
    put(root, "p-3", "claims.json", {"id": "x"})
    put(root, "p-4", "claims.json", "[]")
    put(root, "p-5", "claims.json", " ")
    df = entities.read_array(spark, str(root), "claims")
    assert found(df, "paper_id", "pos", "id") == [("p-1", 0, "a"), ("p-1", 3, "b")]
    assert found(entities.read_quarantine(spark, str(root), "claims"), "paper_id") == [("p-2",), ("p-3",), ("p-5",)]
    assert entities.read_array(spark, str(root), "symbols").count() == 0


def test_objects_maps_and_catalog(spark, root):
    put(root, "b", "metadata.json", {"id": "b", "title": "B", "year": 1999})
    put(root, "a", "metadata.json", {"id": "a", "domain": ""})
    put(root, "c", "metadata.json", {"title": "no id"})
    put(root, "d", "metadata.json", "[1]")
    put(root, "a", "mapping.json", {"namespace": "N", "claim_to_decl": {"c2": "x", "c1": "y"}})
    got = entities.catalog(entities.read_object(spark, str(root), "metadata"))
    assert [tuple(r)[1:] for r in got.collect()] == [("a", "", 0, "other"), ("b", "B", 1999, "other")]
    rows = entities.mapping_long(entities.read_object(spark, str(root), "mapping"))
    assert found(rows, "paper_id", "pos", "claim_id", "short_decl") == [("a", 0, "c2", "x"), ("a", 1, "c1", "y")]


def test_unknown_field_reaches_the_checks(spark, root):
    put(root, "p", "symbols.json", [{"id": "s", "paper_id": "p", "raw_latex": "x", "normalized_name": "x", "surprise": 1}])
    df = entities.read_array(spark, str(root), "symbols").withColumn("paper_id", F.lit("p"))
    got = checks.conformance(df, schemas.RULES["symbols"], ["id"], raw="raw", allowed=schemas.field_names(schemas.SYMBOL))
    assert found(got, "field", "rule") == [("surprise", "unknown_field")]


def test_source_hashes(spark, root):
    (root / "a.pdf").write_bytes(b"\x00\xffdata")
    files = entities.source_files(spark, str(root / "*.pdf"))
    name = F.regexp_extract("path", "([^/]+)$", 1)
    wanted = spark.createDataFrame([("a.pdf",), ("gone.pdf",)], "path string")
    got = entities.fingerprint_sources(wanted, files.withColumn("path", name))
    assert found(got, "path", "sha256") == [("a.pdf", hashlib.sha256(b"\x00\xffdata").hexdigest()), ("gone.pdf", "0" * 64)]
    seen = entities.intake_inventory(files, F.lit("p"), F.expr("timestamp '2024-01-02 03:04:05'"))
    assert found(seen, "paper_id", "source_file", "created_at") == [("p", "a.pdf", "2024-01-02T03:04:05Z")]


def test_intake_csv(spark, root):
    (root / "in.csv").write_text("paper_id,domain,title,year\n p1 ,physics, New ,2001\n,physics,x,1\np2,,,\np3,geology,y,1\np1,chemistry,,\n")
    rows = intake.read_intake_csv(spark, str(root / "in.csv"))
    assert found(intake.intake_violations(rows), "row_id", "message") == [("p3", "invalid domain geology")]
    known = spark.createDataFrame([("p1", "Old", 1990, "other"), ("p9", "Stay", 1991, "control")], "id string, title string, year int, domain string")
    assert found(intake.admit(known, rows), "id", "title", "year", "domain") == [
        ("p1", "New", 2001, "chemistry"), ("p2", "(no title yet)", 1900, "other"), ("p9", "Stay", 1991, "control")
    ]
    (root / "bad.csv").write_text("id\nx\n")
    with pytest.raises(ValueError):
        intake.read_intake_csv(spark, str(root / "bad.csv"))


def test_intake_order_outlives_a_shuffle(spark, root):
    folder = root / "many"
    folder.mkdir()
    (folder / "b.csv").write_text("paper_id,domain,title,year\np1,control,Last,\np2,physics,,abc\n")
    (folder / "a.csv").write_text("paper_id,domain,title,year\n" + "".join(f"p1,physics,t{i},{2000 + i}\n" for i in range(9)) + "p2,physics,Kept,2000\n")
    rows = intake.read_intake_csv(spark, str(folder)).repartition(5, "title")
    known = spark.createDataFrame([], "id string, title string, year int, domain string")
    assert found(intake.admit(known, rows), "id", "title", "year", "domain") == [("p1", "Last", 2008, "control"), ("p2", "Kept", 2000, "physics")]
    assert found(intake.intake_violations(rows), "row_id", "message") == [("p2", "invalid year abc")]


def test_skeletons_conform(spark):
    made = intake.skeletons(spark.createDataFrame([("new-1",)], "paper_id string"))
    for col, kind in (("ingestion_status", "string"), ("tags", "array<string>")):
        made = made.withColumn(col, F.lit(None).cast(kind))
    assert checks.conformance(made, schemas.RULES["metadata"], ["id"]).count() == 0


def test_snapshots_round_trip(spark, root):
    rows = export.snapshot_rows(
        claims(spark, {"id": "c", "status": None}), assumptions(spark, {"id": "a", "text": "t"}),
        cards(spark, {"id": "k", "lean_decl": "N.a"}), manifests(spark, {"declaration_index": ["N.z"]}, {"paper_id": "p2", "declaration_index": ["N.b", ""]}),
    )
    assert found(rows, "paper_id", "kind", "item_id", "status") == [
        ("p1", "assumption", "a", None), ("p1", "claim", "c", ""), ("p1", "declaration", "N.a", "mapped"), ("p2", "declaration", "N.b", "")
    ]
    for name in ("v1.json", "last-release"):
        export.write_snapshot(rows, str(root), name, F.lit("2024-01-01T00:00:00Z"), "T", "narrative text", ["h"])
    export.write_snapshot(rows.limit(1), str(root), "v1", F.lit("2024-01-02T00:00:00Z"))
    assert export.read_snapshot(spark, str(root), "v1").count() == 1
    assert export.read_snapshot(spark, str(root), "last-release").count() == 4
    info = export.list_baselines(spark, str(root))
    assert [r["baseline_id"] for r in info.collect()] == ["last-release", "v1"]
    assert sorted(r["message"] for r in checks.snapshot_quality(info).collect()) == ["missing or empty title", "narrative too short", "release baseline without highlights"]
    for bad in ("a/b", "..", " "):
        with pytest.raises(ValueError):
            export.baseline_name(bad) if bad != " " else export.baseline_name(".json")


def test_export_and_partition_overwrite(spark, root):
    df = spark.createDataFrame([("p1", 1), ("p2", 2)], "paper_id string, v int")
    export.export_tables({"a": df, "b": df.limit(1)}, str(root / "x"))
    assert spark.read.parquet(str(root / "x/export_version")).first()["version"] == "0.3"
    export.publish_group(df, str(root / "y"))
    export.publish_group(spark.createDataFrame([("p2", 9)], df.schema), str(root / "y"))
    assert found(spark.read.parquet(str(root / "y")), "paper_id", "v") == [("p1", 1), ("p2", 9)]


def test_versions_are_whole(spark, root):
    path = str(root / "versions of")
    assert export.versions(spark, path).count() == 0
    with pytest.raises(ValueError):
        export.read_version(spark, path)
    df = spark.createDataFrame([("p1", 1), ("p2", 2)], "paper_id string, v int")
    old = export.commit_version({"a": df, "b": df.where("v = 1")}, path)
    broken = df.withColumn("v", F.expr("CASE WHEN v = 2 THEN raise_error('executor gone') ELSE 9 END").cast("int"))
    with pytest.raises(Exception, match="executor gone"):
        export.commit_version({"a": df.withColumn("v", F.lit(7)), "b": broken}, path)
    held = export.read_version(spark, path)
    assert {k: found(x, "paper_id", "v") for k, x in held.items()} == {"a": [("p1", 1), ("p2", 2)], "b": [("p1", 1)]}
    export.commit_version({"a": held["a"].withColumn("v", F.col("v") + 1)}, path)  # reads what it replaces
    assert {k: found(x, "v") for k, x in export.read_version(spark, path).items()} == {"a": [(2,), (3,)]}
    assert sorted(export.read_version(spark, path, old)) == ["a", "b"] and export.versions(spark, path).count() == 2


def test_salvage_reasons(spark):
    df = spark.createDataFrame([('```json\n{"k": 1}\n```',), ("none",), ("{bad}",), ('a {"k": 2} b',)], "t string")
    got = [(r["parsed"] and r["parsed"]["k"], r["reason"]) for r in entities.salvage_json(df, "t", "k int").collect()]
    assert got == [(1, None), (None, "no object"), (None, "unparsable"), (2, None)]


def test_trend_keeps_the_newest(spark):
    hist = spark.createDataFrame([(f"2024-01-{i:02d}", i) for i in range(1, 6)], "timestamp string, v int")
    out = export.append_trend(hist, spark.createDataFrame([("2024-02-01", 9)], hist.schema), keep=3)
    assert [r["v"] for r in out.collect()] == [9, 5, 4]


def test_stream_reads_checks_and_finds_orphans(spark, root):
    put(root, "p1", "claims.json", [{"id": "c1", "status": "odd"}, {"id": "c2", "status": "parsed"}])
    stream = streaming.entity_stream(spark, str(root), "claims", schemas.CLAIM)
    out = str(root / "out")
    parent = spark.createDataFrame([("c1",)], "id string")
    handle = streaming.orphan_sink(lambda: parent, {"id": "id"}, out)
    streaming.write_batches(stream, handle, f"orphans-{root.name}").awaitTermination(120)
    assert found(spark.read.parquet(out), "id") == [("c2",)]
    seen = []
    bad = streaming.row_violations(claims=stream)
    streaming.write_batches(bad, lambda b, i: seen.extend(b.collect()), f"rows-{root.name}").awaitTermination(120)
    assert [r["message"] for r in seen] == ["invalid status odd"]


def test_stream_latency_and_dedup(spark, root):
    data = [("2024-01-01 00:00:00", "u", "start"), ("2024-01-01 00:00:00", "u", "start"), ("2024-01-01 00:00:30", "u", "end"), ("2024-01-01 00:00:10", "v", "end"), ("2024-01-02 00:00:00", "w", "start")]
    df = spark.createDataFrame(data, "ts string, u string, kind string").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(root / "events"))
    stream = spark.readStream.schema(df.schema).parquet(str(root / "events"))
    once = streaming.deduplicated(stream, ["u", "kind", "ts"], "ts", "1 hour")
    seen = []
    streaming.write_batches(once, lambda b, i: seen.extend(b.collect()), f"dedup-{root.name}").awaitTermination(120)
    assert len(seen) == 4
    got = []
    lat = streaming.latency_stream(stream, "u", "ts", "kind", "start", "end", "1 hour", "1 hour")
    streaming.write_batches(lat, lambda b, i: got.extend(b.collect()), f"lat-{root.name}").awaitTermination(120)
    assert [(r["u"], r["seconds"]) for r in got] == [("u", 30.0)]


def test_intake_reports_a_year_that_is_no_number(spark):
    rows = spark.createDataFrame([("p1", "physics", "t", "abc"), ("p2", "physics", "t", " 2020 "), ("p3", None, None, "")], "paper_id string, domain string, title string, year string")
    assert found(intake.intake_violations(rows), "row_id", "message") == [("p1", "invalid year abc")]
    assert found(intake.normalized_intake(rows), "paper_id", "year") == [("p1", None), ("p2", 2020), ("p3", None)]


def test_mistyped_fields_are_rescued(spark, root):
    good = {"id": "a", "source_span": {"source_file": "f", "start": {"page": 1, "offset": 0}, "end": {"page": 2, "offset": 0}}}
    put(root, "p-1", "claims.json", [good, {"id": "b", "linked_symbols": "s1", "status": "parsed"}, "junk", {"id": "c", "source_span": {"start": {"page": "x"}}}])
    put(root, "p-2", "claims.json", "[{]")
    put(root, "p-3", "claims.json", '[{"id": "d", "id": "e"}, {"id": null, "linked_symbols": ["s", 5], "review_notes": 7}]')
    put(root, "p-4", "claims.json", "[]")
    rows = {(r["paper_id"], r["pos"]): r for r in entities.read_array(spark, str(root), "claims").collect()}
    assert set(rows) == {("p-1", 0), ("p-1", 1), ("p-1", 3), ("p-3", 0), ("p-3", 1)}
    assert rows["p-1", 1]["status"] == "parsed" and rows["p-1", 1]["linked_symbols"] is None
    assert rows["p-1", 0]["source_span"]["end"]["page"] == 2 and rows["p-3", 1]["review_notes"] == "7"
    got = {(r["paper_id"], r["pos"]): (r["reason"], r["usable"], r["rescued"]) for r in entities.read_rescued(spark, str(root), "claims").collect()}
    assert got["p-1", 1] == ("rescued", True, {"linked_symbols": '"s1"'})
    assert got["p-1", 2] == ("no object", False, None) and got["p-2", None] == ("unparsable", False, None)
    assert got["p-1", 3] == ("rescued", True, {"source_span": '{"start":{"page":"x"}}'})
    assert got["p-3", 0] == ("repeated keys", True, None) and len(got) == 5
    put(root, "p-1", "metadata.json", {"id": "p-1", "title": "T", "year": "abc", "authors": ["A"]})
    put(root, "p-2", "metadata.json", {"id": "p-2", "year": 2000.5, "source": {"kind": "pdf"}, "tags": None})
    put(root, "p-3", "metadata.json", '{"id"')
    papers = {r["paper_id"]: r for r in entities.read_object(spark, str(root), "metadata").collect()}
    assert set(papers) == {"p-1", "p-2"} and papers["p-1"]["title"] == "T" and papers["p-1"]["year"] is None
    got = {r["paper_id"]: (r["reason"], r["rescued"]) for r in entities.read_rescued(spark, str(root), "metadata").collect()}
    assert got == {"p-1": ("rescued", {"year": '"abc"'}), "p-2": ("rescued", {"year": "2000.5"}), "p-3": ("unparsable", None)}
    assert papers["p-2"]["source"]["kind"] == "pdf"


def test_every_entity_type_can_be_rescued(spark):
    for ddl in (*schemas.ARRAY_ENTITIES.values(), *schemas.OBJECT_ENTITIES.values()):
        raw = spark.createDataFrame([("p", "{}"), ("q", '{"paper_id": 3, "proposals": [{}, 1]}')], "paper_id string, raw string")
        assert entities.object_rows(raw, ddl).where("usable").count() == 2
