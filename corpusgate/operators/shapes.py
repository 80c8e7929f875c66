"""The shape of stored JSON: every value at every depth beside a table of the paths that may occur.

A text is parsed once and walked level by level inside its row; only objects and arrays that the table
knows are opened, so a text costs its known values and nothing is shuffled. The table of paths is as small
as the schema and is broadcast. Numbers are told apart as integers (2020 or 2020.0) and others; a stored
null fits no type.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgate import schemas
from corpusgate.operators import checks
from corpusgate.session import constant_rows

SEPARATORS = r"([\\.\[\*])"


@dataclass(frozen=True)
class Path:
    """A place of the schema: which kinds of values it takes, and what an object there must and may have."""

    path: str
    kinds: tuple[str, ...]
    needed: tuple[str, ...] = ()
    is_open: bool = False

    @property
    def holds_entries(self) -> bool:
        return self.path.endswith("*")


def paths(ddl: str, needed: dict[str, set[str]] | None = None, open_objects: Sequence[str] = ()) -> list[Path]:
    """The paths of a type: ``a.b`` for fields, ``a[]`` for items, ``a.*`` for the values of a map; ``""`` is the object."""
    out: list[Path] = []

    def add(path: str, kind: T.DataType) -> None:
        step = f"{path}." if path else ""
        if isinstance(kind, T.StructType):
            known = tuple(sorted((needed or {}).get(path, ())))
            loose = any(path == o or path.endswith(f".{o}") for o in open_objects)
            out.append(Path(path, ("object",), known, loose))
            for field in kind.fields:
                add(step + field.name, field.dataType)
        elif isinstance(kind, T.ArrayType):
            out.append(Path(path, ("array",)))
            add(f"{path}[]", kind.elementType)
        elif isinstance(kind, T.MapType):
            out.append(Path(path, ("object",)))
            add(f"{step}*", kind.valueType)
        elif isinstance(kind, T.IntegralType):
            out.append(Path(path, ("integer",)))
        elif isinstance(kind, T.FractionalType):
            out.append(Path(path, ("integer", "number")))
        elif isinstance(kind, T.BooleanType):
            out.append(Path(path, ("boolean",)))
        else:
            out.append(Path(path, ("string",)))

    add("", T.StructType.fromDDL(ddl))
    return out


def entity_paths(entity: str) -> list[Path]:
    return paths(schemas.SHAPES[entity], schemas.needed(entity), schemas.OPEN_OBJECTS)


def kind_of(value: Column) -> Column:
    """object, array, string, integer, number, boolean or null."""
    stored = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    whole = F.coalesce(value.try_cast("double") % 1 == 0, F.lit(False))
    return (
        F.when(stored.isin("TINYINT", "SMALLINT", "INT", "BIGINT"), "integer")
        .when(stored.isin("DECIMAL", "FLOAT", "DOUBLE"), F.when(whole, "integer").otherwise("number"))
        .when(stored == "VOID", "null")
        .otherwise(F.lower(stored))
    )


def json_values(rows: DataFrame, keep: Sequence[str], raw: str, known: Sequence[Path]) -> DataFrame:
    """Every value of the JSON texts down to the first unknown path of a branch.

    ``(keep…, parent, path, place, value)``; ``place`` names the items of arrays by number and entries of maps
    by key. A text that cannot be parsed, or repeats a key in an object, has one row with null ``path``.
    """
    maps = [p.path.removesuffix("*").removesuffix(".") for p in known if p.holds_entries]
    objects, arrays = ([p.path for p in known if kind in p.kinds] for kind in ("object", "array"))
    depth = max(p.path.count(".") + p.path.count("[]") for p in known if p.path) + 1

    def child(node: Column, key: Column, value: Column, item: bool) -> Column:
        if item:
            path, place = F.concat(node["path"], F.lit("[]")), F.concat(node["place"], F.lit("["), key.cast("string"), F.lit("]"))
        else:
            safe = F.regexp_replace(key, SEPARATORS, r"\\$1")
            step = F.when(node["path"].isin(*maps), F.lit("*")).otherwise(safe) if maps else safe
            dot = lambda to, name: F.when(to == "", name).otherwise(F.concat(to, F.lit("."), name))
            path, place = dot(node["path"], step), dot(node["place"], safe)
        return F.struct(
            node["path"].alias("parent"), path.alias("path"), place.alias("place"), value.alias("value"),
            path.isin(*objects, *arrays).alias("expand"),
        )

    start = F.struct(
        F.lit(None).cast("string").alias("parent"), F.when(F.col("__v").isNotNull(), F.lit("")).alias("path"),
        F.lit("").alias("place"), F.col("__v").alias("value"), F.col("__v").isNotNull().alias("expand"),
    )
    out = rows.select(*keep, F.try_parse_json(raw).alias("__v")).select(*keep, start.alias("n"))
    for _ in range(depth):
        n = F.col("n")
        done = F.struct(*[n[x].alias(x) for x in ("parent", "path", "place", "value")], F.lit(False).alias("expand"))
        entries = F.map_entries(F.when(n["path"].isin(*objects), n["value"].try_cast("map<string,variant>")))
        items = F.when(n["path"].isin(*arrays), n["value"].try_cast("array<variant>")) if arrays else F.lit(None).cast("array<variant>")
        children = F.concat(
            F.coalesce(F.transform(entries, lambda e: child(n, e["key"], e["value"], False)), F.array()),
            F.coalesce(F.transform(items, lambda x, i: child(n, i, x, True)), F.array()),
        )
        out = out.select(*keep, F.explode(F.when(n["expand"], F.concat(F.array(done), children)).otherwise(F.array(done))).alias("n"))
    return out.select(*keep, *[F.col(f"n.{x}").alias(x) for x in ("parent", "path", "place", "value")])


def shape_findings(rows: DataFrame, keep: Sequence[str], raw: str, known: Sequence[Path]) -> DataFrame:
    """What of the JSON texts does not have the given shape: ``(keep…, place, rule, found)``.

    Rules: unparsable, wrong_type (found: the stored kind), unknown_field and missing_field (found: its name).
    Null texts are left out.
    """
    table = constant_rows(
        rows.sparkSession, [(p.path, list(p.kinds), list(p.needed)) for p in known],
        __path="string", __kinds="array<string>", __needed="array<string>",
    )
    values = json_values(rows.where(F.col(raw).isNotNull()), keep, raw, known)
    joined = values.join(F.broadcast(table), F.col("path") == F.col("__path"), "left")  # as many rows as the schema has paths
    loose = [p.path for p in known if p.is_open]
    kind, none = kind_of(F.col("value")), F.array().cast("array<struct<rule:string,found:string>>")
    finding = lambda rule, found: F.struct(F.lit(rule).alias("rule"), found.alias("found"))
    one = (
        F.when(F.col("path").isNull(), finding("unparsable", F.lit(None).cast("string")))
        .when(F.col("__path").isNull() & ~F.coalesce(F.col("parent").isin(*loose), F.lit(False)), finding("unknown_field", kind))
        .when(F.col("__path").isNotNull() & ~F.array_contains("__kinds", kind), finding("wrong_type", kind))
    )
    keys = F.map_keys(F.col("value").try_cast("map<string,variant>"))
    missing = F.transform(F.array_except("__needed", keys), lambda x: finding("missing_field", x))
    found = F.concat(F.filter(F.array(one), lambda x: x.isNotNull()), F.when(F.size("__needed") > 0, F.coalesce(missing, none)).otherwise(none))
    return joined.select(*keep, "place", F.inline(found))


def shape_violations(
    entity: str, rows: DataFrame, group: str, row: str, raw: str = "raw", severity: str = "error", check_id: str = "json_schemas_and_kernels"
) -> DataFrame:
    """Findings of :func:`shape_findings` on an entity's stored objects in the common violation shape."""
    keep = [*dict.fromkeys([group, row]), *checks.listed_at(rows)]
    found = shape_findings(rows, keep, raw, entity_paths(entity))
    name = F.when(F.col("place") == "", F.lit(entity)).otherwise(F.concat(F.lit(f"{entity}."), "place"))
    message = F.concat(name, F.lit(" breaks "), "rule", F.coalesce(F.concat(F.lit(": "), "found"), F.lit("")))
    return checks.violations(found, check_id, group, row, message, severity=severity)
