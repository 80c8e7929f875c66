"""Readers for a corpus kept as one folder of JSON files per paper.

Layout: ``<root>/<paper_id>/<entity>.json``. A missing, unreadable or wrongly shaped file yields no
rows; :func:`read_quarantine` lists such files. A field that does not fit its declared type is null in its
row, and :func:`read_rescued` has its JSON beside what could not be read at all. Convert once to parquet with
:func:`corpusgate.sources.export.export_tables` and work on that.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgate import schemas
from corpusgate.functions import columns as c

GROUP = r"([^/]+)/[^/]+$"


def _files(spark: SparkSession, pattern: str) -> DataFrame:
    """Whole files as ``(path, raw)``; no matching file gives an empty table."""
    try:
        df = spark.read.text(pattern, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "path string, raw string")
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))


def _group(path: Column | str) -> Column:
    return F.url_decode(F.regexp_extract(path, GROUP, 1))


def read_array(spark: SparkSession, root: str, entity: str, ddl: str | None = None) -> DataFrame:
    """All papers' ``<entity>.json`` arrays as ``(paper_id, pos, raw, fields…)``.

    Items that are not objects are dropped; ``pos`` stays the place in the stored array.
    """
    ddl = ddl or schemas.ARRAY_ENTITIES[entity]
    raw = _files(spark, f"{root}/*/{entity}.json")
    return parse_array(raw.withColumn("paper_id", _group("path")), ddl)


def read_single_array(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One corpus-wide JSON array file (kernels) as ``(pos, raw, fields…)``."""
    return parse_array(_files(spark, path).withColumn("paper_id", F.lit("")), ddl).drop("paper_id")


def _files_judged(raw: DataFrame, array: bool) -> DataFrame:
    """File texts with ``unusable``: why a file gives no rows, or null."""
    text = c.strip("raw")
    kind, other = ("array<string>", "map<string,string>") if array else ("map<string,string>", "array<string>")
    opens = F.startswith(text, F.lit("[" if array else "{"))
    reason = (
        F.when(F.coalesce(text, F.lit("")) == "", "empty")
        .when(~opens & F.from_json("raw", other).isNotNull(), "wrong shape")
        .when(F.from_json("raw", kind).isNull() | F.json_object_keys("raw").isNull() & F.lit(not array), "unparsable")
        .when(~opens, "wrong shape")
    )
    return raw.withColumn("unusable", reason)


def _lost(v: Column, kind: T.DataType) -> Column:
    """Whether a JSON value, or one inside it, does not fit its declared type; a missing or null value does."""
    stored = F.schema_of_variant(v)
    if isinstance(kind, T.StructType):
        own = v.try_cast("map<string,variant>").isNull()
        for field in kind.fields:
            own = own | _lost(F.try_variant_get(v, f"$.{field.name}", "variant"), field.dataType)
    elif isinstance(kind, T.ArrayType):
        items = v.try_cast("array<variant>")
        own = items.isNull() | F.exists(items, lambda x: _lost(x, kind.elementType))
    elif isinstance(kind, T.MapType):
        entries = v.try_cast("map<string,variant>")
        own = entries.isNull() | F.exists(F.map_values(entries), lambda x: _lost(x, kind.valueType))
    elif isinstance(kind, T.IntegralType):
        own = ~stored.isin("TINYINT", "SMALLINT", "INT", "BIGINT") | v.try_cast(kind).isNull()
    elif isinstance(kind, T.FractionalType):
        own = ~stored.rlike("^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)")
    elif isinstance(kind, T.BooleanType):
        own = stored != "BOOLEAN"
    else:
        own = F.lit(False)  # any value has a text
    return F.coalesce(v.isNotNull() & ~F.is_variant_null(v) & own, F.lit(False))


def _rescued(rows: DataFrame, ddl: str) -> DataFrame:
    """Texts in ``raw`` as fields beside ``rescued`` (JSON of fields that do not fit their type) and ``reason``.

    A field that does not fit is null, the others of its row stay. Rows with ``unusable`` keep that reason.
    """
    kinds = T.StructType.fromDDL(ddl)
    fields = [f for f in kinds.fields if f.name != "paper_id"]
    whole = F.when(F.col("unusable").isNull(), F.try_parse_json("raw"))
    rows = rows.withColumn("__v", whole).withColumn("__e", F.from_json("raw", ddl))

    def entry(field: T.StructField) -> Column:
        value = F.try_variant_get("__v", f"$.{field.name}", "variant")
        stored = value.isNotNull() & ~F.is_variant_null(value)
        lost = _lost(value, field.dataType) | stored & F.col(f"__e.{field.name}").isNull()
        return F.when(lost, F.struct(F.lit(field.name).alias("key"), F.to_json(value).alias("value")))

    rescued = F.map_from_entries(F.filter(F.array(*map(entry, fields)), lambda x: x.isNotNull()))
    reason = (
        F.when(F.col("unusable").isNotNull(), F.col("unusable"))
        .when(~F.startswith(c.strip("raw"), F.lit("{")), "no object")
        .when(F.col("__v").isNull(), "repeated keys")
        .when(F.size("rescued") > 0, "rescued")
    )
    usable = F.col("reason").isNull() | F.col("reason").isin("rescued", "repeated keys")
    rows = rows.withColumn("rescued", rescued).withColumn("reason", reason).withColumn("usable", usable)
    rows = rows.withColumn("rescued", F.when(F.col("reason") == "rescued", F.col("rescued")))
    parsed = [F.when(F.col("usable"), F.col(f"__e.{f.name}")).alias(f.name) for f in fields]
    place = ["pos"] if "pos" in rows.columns else []
    return rows.select("paper_id", *place, "raw", *parsed, "rescued", "reason", "usable")


def array_rows(raw: DataFrame, ddl: str) -> DataFrame:
    """Every item of array texts in ``raw`` beside ``paper_id``, and every text that has none.

    ``(paper_id, pos, raw, fields…, rescued, reason, usable)``, found in one parse: ``usable`` rows are those
    of :func:`parse_array`, rows with a ``reason`` those of :func:`quarantine`.
    """
    files = _files_judged(raw, True)
    items = F.when(F.col("unusable").isNull(), F.from_json("raw", "array<string>"))
    rows = files.select("paper_id", "unusable", F.col("raw").alias("__file"), F.posexplode_outer(items).alias("pos", "raw"))
    rows = rows.where("pos is not null or unusable is not null")
    return _rescued(rows.withColumn("raw", F.when(F.col("unusable").isNull(), F.col("raw")).otherwise(F.col("__file"))), ddl)


def object_rows(raw: DataFrame, ddl: str) -> DataFrame:
    """Every object text in ``raw`` beside ``paper_id``, as :func:`array_rows` without ``pos``."""
    return _rescued(_files_judged(raw, False), ddl)


def quarantine(rows: DataFrame) -> DataFrame:
    """What of :func:`array_rows` or :func:`object_rows` was left out or rescued, and why."""
    place = ["pos"] if "pos" in rows.columns else []
    return rows.where("reason is not null").select("paper_id", *place, "reason", "usable", "rescued", "raw")


def parse_array(raw: DataFrame, ddl: str) -> DataFrame:
    """Array texts in column ``raw`` beside ``paper_id``, parsed leniently item by item."""
    return array_rows(raw, ddl).where("usable").drop("rescued", "reason", "usable")


def read_object(spark: SparkSession, root: str, entity: str, ddl: str | None = None) -> DataFrame:
    """All papers' ``<entity>.json`` objects as ``(paper_id, raw, fields…)``."""
    ddl = ddl or schemas.OBJECT_ENTITIES[entity]
    raw = _files(spark, f"{root}/*/{entity}.json").withColumn("paper_id", _group("path"))
    return parse_object(raw, ddl)


def parse_object(raw: DataFrame, ddl: str) -> DataFrame:
    """Object texts in column ``raw`` beside ``paper_id``; a field that does not fit its type is null."""
    return object_rows(raw, ddl).where("usable").drop("rescued", "reason", "usable")


def read_quarantine(spark: SparkSession, root: str, entity: str, array: bool = True) -> DataFrame:
    """Files of an entity that cannot be used: ``(paper_id, reason)``."""
    raw = _files(spark, f"{root}/*/{entity}.json").withColumn("paper_id", _group("path"))
    return _files_judged(raw, array).where("unusable is not null").select("paper_id", F.col("unusable").alias("reason"))


def read_rescued(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Quarantine of an entity's files, items and fields, from the parse that gives its rows."""
    raw = _files(spark, f"{root}/*/{entity}.json").withColumn("paper_id", _group("path"))
    if entity in schemas.ARRAY_ENTITIES:
        return quarantine(array_rows(raw, schemas.ARRAY_ENTITIES[entity]))
    return quarantine(object_rows(raw, schemas.OBJECT_ENTITIES[entity]))


def mapping_long(mapping: DataFrame) -> DataFrame:
    """``claim_to_decl`` maps as rows ``(paper_id, pos, claim_id, short_decl)``."""
    return mapping.select("paper_id", F.posexplode("claim_to_decl").alias("pos", "claim_id", "short_decl"))


def catalog(papers: DataFrame) -> DataFrame:
    """``(paper_id, id, title, year, domain)`` with defaults; rows without an id are dropped."""
    return (
        papers.where(c.not_blank("id"))
        .select(
            "paper_id",
            "id",
            F.coalesce("title", F.lit("")).alias("title"),
            F.coalesce("year", F.lit(0)).alias("year"),
            c.filled("domain", "other").alias("domain"),
        )
        .orderBy("paper_id")
    )


def source_files(spark: SparkSession, glob: str) -> DataFrame:
    """Binary files as ``(path, modificationTime, length, content)``."""
    return spark.read.format("binaryFile").load(glob)


def fingerprint_sources(wanted: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """SHA-256 of each wanted file's bytes; 64 zeros where the file is missing."""
    hashed = files.select(F.col("path").alias(path), F.sha2("content", 256).alias("sha256"))
    return wanted.join(hashed, path, "left").withColumn("sha256", F.coalesce("sha256", F.lit(c.ZERO_DIGEST)))


def fingerprint_texts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """SHA-256 of each row's text; 64 zeros for a missing text."""
    return rows.select(key, F.coalesce(c.sha256(text), F.lit(c.ZERO_DIGEST)).alias("sha256"))


def intake_inventory(files: DataFrame, group: Column, created_at: Column) -> DataFrame:
    """Files found per paper, one row per file, with the intake time."""
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return files.select(group.alias("paper_id"), name.alias("source_file"), c.instant_text(created_at).alias("created_at"))


def input_digests(rows: DataFrame, keys: list[str], inputs: list[str]) -> DataFrame:
    """SHA-256 of each input column as one provenance struct per row."""
    packed = F.struct(*[c.sha256(F.coalesce(F.col(x), F.lit(""))).alias(x) for x in inputs])
    return rows.select(*keys, packed.alias("input_sha256"))


def salvage_json(rows: DataFrame, text: str, ddl: str, out: str = "parsed") -> DataFrame:
    """First JSON object found in noisy text, parsed; ``reason`` says why a row has none."""
    chunk = c.json_object_text(text)
    parsed = rows.withColumn("__chunk", chunk).withColumn(
        "__p",
        F.from_json("__chunk", ddl + ", __corrupt string", {"columnNameOfCorruptRecord": "__corrupt", "allowUnquotedControlChars": "true"}),
    )
    bad = F.col("__p.__corrupt").isNotNull()
    fields = schemas.field_names(ddl)
    value = F.struct(*[F.col(f"__p.{f}").alias(f) for f in fields])
    reason = F.when(F.col("__chunk").isNull(), "no object").when(bad, "unparsable")
    return parsed.withColumn(out, F.when(reason.isNull(), value)).withColumn("reason", reason).drop("__chunk", "__p")
