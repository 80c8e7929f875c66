"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A file is a run of records; a record is

    length   8 bytes   payload bytes, little-endian
    mark     4 bytes   masked CRC-32 of the 8 length bytes
    payload            id of the document (8 bytes, signed), bytes per token id (1 byte: 2 or 4), then
                       the token ids, each little-endian of that width
    mark     4 bytes   masked CRC-32 of the payload
    end      1 byte    newline

The files are written by Spark's own text writer, one binary record a line, so the commit protocol of
the file system in use drops the files of failed or repeated tasks. Records are in ascending order of
the document id over the files in name order. Readers cut records by length, never at newlines.

Defined cases: a null or empty text is a record with the end id only; a null id is stored as the
smallest 64-bit number and comes first; repeated ids keep one record each, ordered by their tokens;
an empty table writes no record and gives an empty index; other columns are not read.
"""

from __future__ import annotations

import array
import statistics
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from corpusgate.llm import texts
from corpusgate.session import checkpoint_dir

#: Text bytes that one file takes; about a third of it is token ids of two bytes.
FILE_TEXT_BYTES = 16 << 20
#: Distinct words whose ids a task remembers before it forgets half of them: about 200 bytes each.
REMEMBERED_WORDS = 700_000
NO_ID = -(2**63)
HEAD = struct.Struct("<QI")
MARK = struct.Struct("<I")
LEAD = struct.Struct("<qB")
END = b"\n"


def masked(data: bytes) -> int:
    """CRC-32 turned by 15 bits plus a constant, so that a checksum of stored checksums stays useful."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(doc_id: int, ids: bytes, width: int) -> bytes:
    """One record without its end, which the writer adds."""
    payload = LEAD.pack(doc_id, width) + ids
    length = struct.pack("<Q", len(payload))
    return length + MARK.pack(masked(length)) + payload + MARK.pack(masked(payload))


def parsed(data: bytes | memoryview) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(offset, record bytes, document id, token ids) of each record; a damaged one raises ``ValueError``."""
    data, at = memoryview(data), 0
    while at < len(data):
        if at + HEAD.size > len(data):
            raise ValueError(f"record at {at} is cut short")
        length, mark = HEAD.unpack_from(data, at)
        if masked(bytes(data[at : at + 8])) != mark:
            raise ValueError(f"length mark of the record at {at} is wrong")
        body, stop = at + HEAD.size, at + HEAD.size + length + MARK.size + len(END)
        if stop > len(data):
            raise ValueError(f"record at {at} is cut short")
        payload = bytes(data[body : body + length])
        if masked(payload) != MARK.unpack_from(data, body + length)[0] or data[stop - 1 : stop] != END:
            raise ValueError(f"payload mark of the record at {at} is wrong")
        doc_id, width = LEAD.unpack_from(payload)
        yield at, stop - at, doc_id, np.frombuffer(payload, f"<u{width}", offset=LEAD.size)
        at = stop


class Symbols(dict):
    """What the pre-tokenizer makes of a character, for ``str.translate``."""

    def __init__(self, pre_tokenizer) -> None:
        super().__init__()
        self.pre_tokenizer = pre_tokenizer

    def __missing__(self, code: int) -> str:
        self[code] = "".join(x for x, _ in self.pre_tokenizer.pre_tokenize_str(chr(code)))
        return self[code]


class Known(dict):
    """Ids of words, worked out when first asked for and remembered."""

    def __init__(self, encoder: Encoder, code: str) -> None:
        super().__init__()
        self.encoder, self.code = encoder, code

    def shrink(self) -> None:
        """Forget the longer half of the words: the shorter ones come again more often."""
        longest = statistics.median(map(len, self))
        kept = {w: ids for w, ids in self.items() if len(w) < longest}
        self.clear()
        self.update(kept)

    def __missing__(self, word: str) -> bytes:
        core = word.rstrip(",.") if self.encoder.parts else ""
        if len(core) < len(word) and core.isalpha():
            ids = self[core] + self[word[len(core) :]]
        elif core.isalpha() and (low := self.encoder.lowered(core)).isalpha():
            ids = self[low] if low != core else self.packed(self.encoder.merged(low))
        else:
            ids = self.packed(self.encoder.plain([word])[0])
        self[word] = ids
        return ids

    def packed(self, ids: list[int]) -> bytes:
        return array.array(self.code, ids).tobytes()


class Encoder:
    """Encodes texts with the tokenizers library, each distinct word once while it is remembered.

    Two properties of a tokenizer allow this, and each is probed; without the first, whole texts are
    encoded, without the second, words are encoded as they stand:
    ``words``: space and newline leave no ids and nothing is joined across them;
    ``parts``: letters followed by commas or stops have the ids of the letters, then of the marks, and a run of
    letters goes through the library's normalizer, pre-tokenizer and merge model one after the other.
    """

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        self.remembered = REMEMBERED_WORDS
        self.tokenizer = Tokenizer.from_str(spec)
        self.known: dict[int, Known] = {}
        flat = lambda rows: [i for ids in self.plain(rows) for i in ids]
        probe = "the end's 12 été, ΣΣ x-y"
        self.words = not flat([" \n"]) and flat([probe.replace(" ", "\n \n")]) == flat(probe.split(" "))
        probes = ["Than", "ÉtÉ", "x", "Zyxwvutsr", "ñandú"]
        marks = [",", ".", ".,"]
        chain = self.tokenizer.pre_tokenizer is not None and self.tokenizer.normalizer is not None
        self.parts = False
        if chain:
            self.symbols = Symbols(self.tokenizer.pre_tokenizer)
            self.ascii_lower = False
            self.merge, self.normalize = self.tokenizer.model.tokenize, self.tokenizer.normalizer.normalize_str
            alphabet = "AzByCxDwEvFuGtHsIrJqKpLoMnNmOlPkQjRiShTgUfVeWdXcYbZa"
            self.ascii_lower = self.normalize(alphabet) == alphabet.lower()
            same = all(flat([a]) == self.merged(self.lowered(a)) for a in probes)
            self.parts = same and all(flat([a + b]) == flat([a, b]) for a in probes for b in marks)

    def lowered(self, word: str) -> str:
        return word.lower() if self.ascii_lower and word.isascii() else self.normalize(word)

    def merged(self, word: str) -> list[int]:
        return [t.id for t in self.merge(word if word.isascii() else word.translate(self.symbols))]

    def plain(self, rows: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)]

    def encode(self, rows: list[str], width: int) -> Iterator[bytes]:
        """Little-endian ids of each text, ``width`` bytes an id."""
        code = {2: "H", 4: "I"}[width]
        if not self.words:
            yield from (array.array(code, ids).tobytes() for ids in self.plain(rows))
            return
        known = self.known.setdefault(width, Known(self, code))
        for text in rows:
            yield b"".join(map(known.__getitem__, text.replace("\n", " ").split(" ")))
            if len(known) > self.remembered:
                known.shrink()


_ENCODERS: dict[int, Encoder] = {}


def encoder(spec: Broadcast) -> Encoder:
    """The encoder of this worker process."""
    key = zlib.crc32(spec.value.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec.value)
    return _ENCODERS[key]


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED_WORDS,
) -> None:
    """Write the records of all documents under ``path``. ``tokenizer``: path of a tokenizer file.

    One shuffle by ranges of the id; the number of files follows the text bytes. The tokenizer file is
    read by the driver (a few MB whatever the data) and broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    shared = spark.sparkContext.broadcast(spec)
    narrow = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // FILE_TEXT_BYTES), spark.sparkContext.defaultParallelism)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared)
        own.remembered = remembered
        end = end_id.to_bytes(width, "little")
        for part in texts.slices(batches):
            rows = [t or "" for t in part.column("text").to_pylist()]
            ids = part.column("id").to_pylist()
            made = [framed(i, x + end, width) for i, x in zip(ids, own.encode(rows, width))]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])

    dealt = narrow.repartitionByRange(files, "id").sortWithinPartitions("id", "text")
    made = texts.arrow(dealt, records, "record binary")
    made.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{path}/records")


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(file, record, offset, length, doc_id, n_tokens, before, ids_crc32, ids) of every record under ``path``.

    ``before``: ids of the records before it in its file; ``ids``: 4 bytes each, where asked for. Every mark
    is verified.
    """
    names = ["file", "record", "offset", "length", "doc_id", "n_tokens", "before", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.string(), *[pa.int64()] * 7] + [pa.binary()] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                before, rows = 0, []
                for k, (at, length, doc_id, ids) in enumerate(parsed(content.as_buffer())):
                    wide = ids.astype("<u4").tobytes()
                    row = (name, k, at, length, doc_id, len(ids), before, zlib.crc32(wide))
                    rows.append((*row, wide) if with_ids else row)
                    before += len(ids)
                    if len(rows) == 500:
                        yield made(rows)
                        rows = []
                if rows:
                    yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(f"{path}/records")
        .select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content")
    )
    schema = ", ".join(f"{n} {'string' if n == 'file' else 'binary' if n == 'ids' else 'long'}" for n in names)
    return texts.arrow(files.where(F.length("content") > 0), cut, schema)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Write the offset index beside the records and return it: where each record lies, and the ids before it."""
    read(spark, path, with_ids=False).write.mode("overwrite").parquet(f"{path}/index")
    rows = spark.read.parquet(f"{path}/index")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # one row a file: a thousandth of a thousandth of the tokens
    order = W.Window.orderBy("file").rowsBetween(W.Window.unboundedPreceding, -1)
    first = totals.select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    none = F.col("doc_id") == F.lit(NO_ID)
    return rows.join(first, "file").select(
        F.when(~none, F.col("doc_id")).alias("doc_id"),
        "file",
        "record",
        "offset",
        "length",
        (F.col("base") + F.col("before")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records of ``wanted`` (file, offset) in the index's terms, for shuffled reads."""
    return read(spark, path).join(wanted.select("file", "offset").distinct(), ["file", "offset"], "left_semi")


def encoded(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED_WORDS,
) -> DataFrame:
    """Write records and index (under the shared folder unless ``path`` says where) and return the index."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark)}/records-{uuid.uuid4().hex}"
    write(docs, path, tokenizer, end_id, id_col, text_col, remembered)
    out = index(spark, path)
    if isinstance(docs.schema[id_col].dataType, (T.IntegerType, T.ShortType, T.ByteType)):
        out = out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
    return out
