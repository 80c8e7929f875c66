"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

Lines at an edit distance of at most one character are duplicates, and only the earliest (by document id,
then the text's 64-bit hash, then line) stays. Two lines at distance one are equal before and after one of ``SEGMENTS`` parts, so a
line first meets others on hashes of all but one part; that loses no pair and leaves few lines. These
emit their deletion variants within the part: keyed with the place for substitutions, without it against
whole lines for insertions. Equal variants meet, the earliest line of a key is the candidate, its edit
distance is verified, and the later line is dropped.

Defined cases: lines without a word are never dropped and match nothing; lines shorter than ``near_chars``
are dropped only as exact copies; null and empty texts have one line without a word; a null id comes
first; rows that share an id, or have none, are documents of their own, told apart by the hash of their
texts and compared like others; of rows that repeat id and text one stays as it is judged and the others,
numbered from 1 in ``copy``, lose all lines with a word; an empty table gives an empty
result; other columns, whatever their names, are not read, and `cleaned` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusgate.session import durable

SEGMENTS = 4
#: Code points from which on a line can be a near copy.
NEAR_CHARS = 20
#: Ids that may be broadcast.
BROADCAST_IDS = 1_000_000
WORD = r"[^\x20\x09-\x0D]"


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, doc, text): with the hash that tells the texts under one id apart."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("doc"), text.alias("text"))


def lines(texts: DataFrame) -> DataFrame:
    """(id, doc, line_no, line): every line of every text, from 0."""
    return texts.select("id", "doc", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def digest(column: Column) -> Column:
    """128 bits that tell lines apart."""
    return F.unhex(F.md5(column.cast("binary")))


def edge(size: Column, part: int) -> Column:
    """Code points before a part of a line of ``size``."""
    return F.floor(size * part / SEGMENTS).cast("int")


def part_hashes(line: Column, size: Column) -> Column:
    """Hashes of the parts: of the line's own length, then of one character less from the front and from the back.

    The last part from the front and the first from the back are never outside a part, so they are left out.
    """
    base = size - 1
    cut = lambda start, length: F.xxhash64(F.substring(line, start + 1, length))
    own = [cut(edge(size, k), edge(size, k + 1) - edge(size, k)) for k in range(SEGMENTS)]
    front = [cut(edge(base, k), edge(base, k + 1) - edge(base, k)) for k in range(SEGMENTS - 1)]
    back = [cut(edge(base, k) + 1, edge(base, k + 1) - edge(base, k)) for k in range(1, SEGMENTS)]
    return F.array(*own, *front, *back)


def roles(hashes: Column, size: Column) -> Column:
    """The keys under which a line can meet others at distance one: all but one part, for both lengths.

    At place ``role * SEGMENTS + part``; a line of role 1 stands there as if it were one character shorter.
    """
    keys = []
    for role in (0, 1):
        front = [hashes[k + role * SEGMENTS] for k in range(SEGMENTS - role)]
        back = front if role == 0 else [None, *(hashes[2 * SEGMENTS - 1 + k] for k in range(SEGMENTS - 1))]
        for part in range(SEGMENTS):
            keys.append(F.xxhash64(size - role, F.lit(part), *front[:part], *back[part + 1 :]))
    return F.array(*keys)


def variants(line: Column, size: Column, role: Column, part: Column) -> Column:
    """Deletion variants of the part: (key, kind), kind 0: whole line or its variant, 1: with its place.

    A line of role 0 sends itself and its variants with their places; of role 1 its variants alone.
    """
    base = size - role
    before = F.floor(base * part / SEGMENTS).cast("int")
    last = size - (base - F.floor(base * (part + 1) / SEGMENTS)).cast("int")
    places = F.sequence(before + 1, F.greatest(last, before + 1))
    rest = lambda i: F.concat(F.substring(line, F.lit(1), i - 1), F.substring(line, i + 1, size))
    own = F.array(F.struct(F.xxhash64(base, line).alias("key"), F.lit(True).alias("whole")))
    fixed = F.transform(places, lambda i: F.struct(F.xxhash64(base, i, rest(i)).alias("key"), F.lit(False).alias("whole")))
    loose = F.transform(places, lambda i: F.struct(F.xxhash64(base, rest(i)).alias("key"), F.lit(False).alias("whole")))
    return F.when(role == 0, F.concat(own, fixed)).otherwise(loose)


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = NEAR_CHARS) -> DataFrame:
    """Every line to drop, and the earlier line that stands for it.

    (id, doc, copy, line_no, kept_id, kept_doc, kept_line_no, exact); ``copy`` is 0 but for repeated rows.
    """
    texts = documents(docs, id_col, text_col)
    worded = lines(texts).where(F.col("line").rlike(WORD))
    sized = worded.select("id", "doc", "line_no", "line", F.length("line").alias("size"), digest(F.col("line")).alias("digest"))
    hashed = sized.select("id", "doc", "line_no", "digest", "size", part_hashes(F.col("line"), F.col("size")).alias("hashes"))
    near = F.when(F.col("size") >= near_chars, roles(F.col("hashes"), F.col("size")))
    at = F.struct("id", "doc", "line_no")
    found = durable(hashed.select("id", "doc", "line_no", "digest", near.alias("roles")), "lines")
    # one row for each distinct line: its earliest place, and a number
    distinct = found.groupBy("digest").agg(F.min(at).alias("at"), F.first("roles").alias("roles"))
    distinct = durable(distinct.withColumn("cls", F.monotonically_increasing_id()), "distinct-lines")
    keys = distinct.where("roles is not null").select("cls", F.posexplode("roles").alias("slot", "outer"))
    shared = keys.groupBy("outer").agg(F.count("*").alias("n"), F.min("slot").alias("low"))
    shared = shared.where((F.col("n") > 1) & (F.col("low") < SEGMENTS)).select("outer")
    # a line is asked for the parts in which it may differ from another: 8 at most
    asked = keys.join(shared, "outer").groupBy("cls").agg(F.collect_set("slot").alias("slots"))
    asked = durable(distinct.select("cls", "digest", "at").join(asked, "cls"), "meeting-lines")
    # the text of those lines again
    ids = durable(asked.select(F.col("at.id").alias("want")).distinct(), "meeting-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    again = texts.join(wanted, texts["id"].eqNullSafe(F.col("want")), "left_semi")
    text = lines(again).select("id", "doc", "line_no", "line", digest(F.col("line")).alias("own"))
    place = [text["id"].eqNullSafe(asked["at.id"]), text["doc"] == asked["at.doc"], text["line_no"] == asked["at.line_no"]]
    told = text.join(asked, [text["own"] == asked["digest"], *place])
    told = durable(told.select("cls", "at", "line", "slots").dropDuplicates(["cls"]), "meeting-texts")
    sent = told.select("cls", "at", F.length("line").alias("size"), "line", F.explode("slots").alias("slot"))
    role, part = (F.col("slot") >= SEGMENTS).cast("int"), F.col("slot") % SEGMENTS
    sent = sent.select("cls", "at", F.explode(variants(F.col("line"), F.col("size"), role, part)).alias("v"))
    sent = sent.select("cls", "at", "v.*").distinct()
    # under a key with places all lines are at distance one; else a whole line and its longer ones are
    least = sent.groupBy("key").agg(
        F.min(F.when(F.col("whole"), F.struct("at", "cls"))).alias("whole_least"),
        F.min(F.when(~F.col("whole"), F.struct("at", "cls"))).alias("least"),
        F.count("*").alias("n"),
    )
    many = least.where("n > 1").select("key", "whole_least", "least")
    met = sent.join(many, "key")
    candidates = F.array(F.col("whole_least"), F.when(F.col("whole") | F.col("whole_least").isNull(), F.col("least")))
    earlier = met.withColumn("other", F.explode(candidates)).where(F.col("other").isNotNull() & (F.col("other.at") < F.col("at")))
    pairs = earlier.select("cls", F.col("other.cls").alias("other"), F.col("other.at").alias("other_at")).distinct()
    sides = told.select(F.col("cls").alias("d"), F.col("line").alias("x"))
    others = told.select(F.col("cls").alias("o"), F.col("line").alias("y"))
    close = (
        pairs.join(sides, pairs["cls"] == sides["d"])
        .join(others, pairs["other"] == others["o"])
        .where(F.levenshtein("x", "y", 1) >= 0)
        .groupBy("cls")
        .agg(F.min("other_at").alias("near_at"))
    )
    verdict = distinct.select("cls", "digest", "at").join(close, "cls", "left").drop("cls")
    judged = found.select("id", "doc", "line_no", "digest").join(verdict, "digest")
    first = F.col("at.id").eqNullSafe(F.col("id")) & (F.col("at.doc") == F.col("doc")) & (F.col("at.line_no") == F.col("line_no"))
    judged = judged.withColumn("stays", first & F.col("near_at").isNull())
    # rows that repeat id and text: each of their lines stands at one place, as often as there are rows
    repeated = texts.groupBy(F.col("id").alias("rid"), F.col("doc").alias("rdoc")).agg(F.count("*").alias("rows")).where("rows > 1")
    judged = judged.join(repeated, judged["id"].eqNullSafe(F.col("rid")) & (judged["doc"] == F.col("rdoc")), "left")
    drops = judged.where("not stays or rows is not null").groupBy("id", "doc", "line_no", "at", "near_at", "stays")
    drops = drops.agg(F.count("*").alias("rows")).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("copy"))
    drops = drops.where("not stays or copy > 0")
    kept = F.coalesce("near_at", "at")
    return drops.select(
        F.col("id").alias(id_col), "doc", "copy", "line_no", kept["id"].alias("kept_id"), kept["doc"].alias("kept_doc"),
        kept["line_no"].alias("kept_line_no"), F.col("near_at").isNull().alias("exact"),
    )


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = NEAR_CHARS) -> DataFrame:
    """The documents with all their columns, without the dropped lines."""
    gone = duplicates(docs, id_col, text_col, near_chars)
    first = gone.where("copy = 0").groupBy(F.col(id_col).alias("gid"), F.col("doc").alias("gdoc")).agg(F.collect_set("line_no").alias("gone"))
    again = gone.where("copy > 0").select(F.col(id_col).alias("rid"), F.col("doc").alias("rdoc")).distinct().withColumn("repeats", F.lit(True))
    text = F.col(f"row.`{text_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col(f"row.`{id_col}`").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("doc"))
    rows = rows.join(first, rows["id"].eqNullSafe(F.col("gid")) & (F.col("doc") == F.col("gdoc")), "left")
    rows = rows.join(again, rows["id"].eqNullSafe(F.col("rid")) & (F.col("doc") == F.col("rdoc")), "left")
    # among repeated rows the first by their other values stays; no other row enters a window
    order = F.row_number().over(Window.partitionBy("id", "doc").orderBy(F.xxhash64(F.to_json("row"))))
    once = rows.where("repeats is null").withColumn("copy", F.lit(0))
    rows = once.unionByName(rows.where("repeats").withColumn("copy", order - 1))
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    drop = lambda p: F.when(F.col("copy") > 0, p["x"].rlike(WORD)).otherwise(F.coalesce(F.array_contains("gone", p["i"]), F.lit(False)))
    left = F.array_join(F.transform(F.filter(numbered, lambda p: ~drop(p)), lambda p: p["x"]), "\n")
    return rows.select(*[(left if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def per_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = NEAR_CHARS) -> DataFrame:
    """(id, n_lines, n_dropped, n_near, first_dropped) of every row."""
    split = F.split("text", "\n")
    sizes = documents(docs, id_col, text_col).select("id", "doc", F.size(split).cast("long").alias("n_lines"))
    every = sizes.groupBy("id", "doc").agg(F.max("n_lines").alias("n_lines"), F.count("*").alias("rows"))
    every = every.select("id", "doc", "n_lines", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("copy"))
    gone = duplicates(docs, id_col, text_col, near_chars)
    counts = gone.groupBy(F.col(id_col).alias("gid"), F.col("doc").alias("gdoc"), F.col("copy").alias("gcopy")).agg(
        F.count("*").alias("dropped"), F.sum((~F.col("exact")).cast("long")).alias("near"), F.min("line_no").cast("long").alias("first_dropped")
    )
    same = [every["id"].eqNullSafe(counts["gid"]), every["doc"] == counts["gdoc"], every["copy"] == counts["gcopy"]]
    return every.join(counts, same, "left").select(
        F.col("id").alias(id_col), "n_lines", F.coalesce("dropped", F.lit(0)).alias("n_dropped"), F.coalesce("near", F.lit(0)).alias("n_near"), "first_dropped"
    )
