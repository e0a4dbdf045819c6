"""Token ids as length-delimited binary records with an offset index.

A record file is a sequence of frames, each as in the TFRecord format: the payload's
length (8 bytes, little endian), the masked CRC-32C of those 8 bytes, the payload,
and its masked CRC-32C. A payload is the width of an id in bytes (1 byte: 2 or 4)
and the ids, little endian. Beside each record file stands an index of 32-byte
entries (document id, offset of the frame, number of ids before it in the file, number
of ids), so a reader can fetch records in any order.

Texts are tokenized once per distinct word: words are the runs between ASCII white
space, which the tokenizer drops; a bounded cache per worker keeps their ids.

Files go to a shared folder through its file system; a task writes under a name of
its own and the table of parts, written by Spark after the task, names the files that
count. A lost task's file is never read. Memory is one batch of rows and one frame.

Defined results: a null text is the empty text and has only the end id. Rows are
ordered by doc_id, nulls first; repeated rows give repeated records.
Only the id and text columns are used, whatever others there are. An empty table gives
no file and no row.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from vellumflow.llm.byte_bpe import byte_characters

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CACHE_WORDS = 1_000_000
LONGEST_CACHED = 64
ROWS_AT_ONCE = 256
ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<i8"), ("before", "<i8"), ("n", "<i8")])
NO_ID = -(1 << 63)  # stands for a null doc_id in an index entry
MASK = 0xA282EAD8
CRC_BLOCK = 256
PARTS = T.StructType([T.StructField("part", T.LongType()), T.StructField("name", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("ids", T.LongType())])
PARTS_ARROW = pa.schema([("part", pa.int64()), ("name", pa.string()), ("rows", pa.int64()), ("ids", pa.int64())])
_state: dict = {}


# --- checksums ---------------------------------------------------------------------------


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The byte table of CRC-32C, and four tables that append a block of zero bytes."""
    if "crc" not in _state:
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1)
        rows = []
        for shift in (0, 8, 16, 24):
            crc = np.arange(256, dtype=np.uint32) << np.uint32(shift)
            for _ in range(CRC_BLOCK):
                crc = table[crc & 255] ^ (crc >> 8)
            rows.append(crc)
        _state["crc"] = table, np.stack(rows)
    return _state["crc"]


def crc32c(payloads: list[bytes]) -> list[int]:
    """CRC-32C of each byte string.

    Strings are padded in front to whole blocks with zeros, which leave a register of
    zero as it is; the blocks of all strings run side by side, and the registers are
    joined block by block. The usual start value is folded into the first four bytes.
    """
    table, zeros = _crc_tables()
    out = []
    counts = [max(1, -(-len(p) // CRC_BLOCK)) for p in payloads]
    for p in payloads:
        if len(p) < 4:
            crc = 0xFFFFFFFF
            for b in p:
                crc = int(table[(crc ^ b) & 255]) ^ (crc >> 8)
            out.append(crc)
        else:
            out.append(None)
    grid = np.zeros((sum(counts), CRC_BLOCK), np.uint8)
    lines, at = grid.reshape(-1), 0
    for p, c in zip(payloads, counts):
        at += c * CRC_BLOCK
        if len(p) >= 4:
            lines[at - len(p) : at] = np.frombuffer(p, np.uint8)
            lines[at - len(p) : at - len(p) + 4] ^= 255
    crc = np.zeros(len(grid), np.uint32)
    for column in np.ascontiguousarray(grid.T):
        crc = table[(crc ^ column) & 255] ^ (crc >> 8)
    z0, z1, z2, z3 = zeros.tolist() if "zeros" not in _state else _state["zeros"]
    _state["zeros"] = z0, z1, z2, z3
    blocks, at = crc.tolist(), 0
    for k, c in enumerate(counts):
        if out[k] is None:
            register = 0
            for b in blocks[at : at + c]:
                register = z0[register & 255] ^ z1[register >> 8 & 255] ^ z2[register >> 16 & 255] ^ z3[register >> 24] ^ b
            out[k] = register
        at += c
    return [r ^ 0xFFFFFFFF for r in out]


def masked(crc: int) -> int:
    """The checksum as stored: rotated by 15 bits and offset."""
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frames(payloads: list[bytes]) -> list[bytes]:
    """Each payload between its checked length and its checksum."""
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    return [
        b"".join((n, struct.pack("<I", masked(a)), p, struct.pack("<I", masked(b))))
        for n, a, p, b in zip(lengths, crc32c(lengths), payloads, crc32c(payloads))
    ]


def payloads_of(data: list[bytes]) -> list[bytes]:
    """The payloads of whole frames; a wrong length or checksum is an error."""
    found = [f[12:-4] for f in data]
    want = zip(crc32c([f[:8] for f in data]), crc32c(found))
    for f, p, (a, b) in zip(data, found, want):
        if struct.unpack_from("<QI", f) != (len(p), masked(a)) or struct.unpack("<I", f[-4:])[0] != masked(b):
            raise ValueError("damaged record")
    return found


# --- tokens ------------------------------------------------------------------------------


#: The steps before the merges that the short way below repeats: lower-case NFC text, cut by this pattern.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Words on which those steps are simple: printable ASCII and Latin-1 letters, all stable under NFC.
SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
SIMPLE_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class WordCoder:
    """Ids of words under a tokenizer file that drops white space.

    Simple words are lower-cased and cut here and only merged by the tokenizer's
    model, which is much faster; all others, and tokenizers with other steps, go
    through the tokenizer as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.cache: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.characters = byte_characters()
        steps = json.loads(self.tokenizer.to_str())
        normal = [x["type"] for x in (steps["normalizer"] or {}).get("normalizers", [])]
        cuts = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.simple = (
            normal == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": SPLIT}
            and not cuts[1]["add_prefix_space"]
        )

    def learn(self, words: list[bytes]) -> None:
        """Put the packed ids of words into the cache."""
        cache, pieces, tokenize, code = self.cache, self.pieces, self.model.tokenize, self.code
        others = []
        for word in words:
            text = word.decode("utf-8", "replace")
            if not self.simple or "<|" in text or not SIMPLE.fullmatch(text):
                others.append((word, text))
                continue
            packed = b""
            for p in SIMPLE_SPLIT.findall(text.lower()):
                ids = pieces.get(p)
                if ids is None:
                    mapped = p if p.isascii() else p.encode().decode("latin-1").translate(self.characters)
                    pieces[p] = ids = array(code, [t.id for t in tokenize(mapped)]).tobytes()
                packed += ids
            cache[word] = packed
        if others:
            found = self.tokenizer.encode_batch_fast([t for _, t in others], add_special_tokens=False)
            cache.update((w, array(code, e.ids).tobytes()) for (w, _), e in zip(others, found))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
            self.pieces.clear()
        # Bytes: ASCII white space and letters only. Marks of special tokens are not lower-cased.
        cut = [t.split() if b"<|" in t or not self.simple else t.lower().split() for t in texts]
        missing = set().union(*cut).difference(self.cache)
        if missing:
            self.learn(list(missing))
        packed = [b"".join(map(self.cache.__getitem__, words)) for words in cut]
        for word in missing:
            if len(word) > LONGEST_CACHED:
                del self.cache[word]
                for p in SIMPLE_SPLIT.findall(word.decode("utf-8", "replace").lower()):
                    self.pieces.pop(p, None)
        return packed


# --- files -------------------------------------------------------------------------------


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write(df: DataFrame, tokenizer: str, end_id: int, folder: str, partitions: int | None = None) -> DataFrame:
    """Write the token ids of ``df`` (doc_id, text) under ``folder`` in ascending doc_id
    order; the table of parts: ``part`` counts the files in that order.

    Equal ids keep their order in the input and are spread over several files if many.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(n, "doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "text")
    system, path = _file_system(folder)
    system.create_dir(f"{path}/records", recursive=True)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = _state.get(tokenizer) or _state.setdefault(tokenizer, WordCoder(tokenizer))
        end = array(coder.code, [end_id]).tobytes()
        width = bytes([len(end)])
        name = f"{path}/records/{uuid.uuid4().hex}"
        records = index = None
        offset = before = rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                if records is None:
                    system, _ = _file_system(folder)
                    records, index = system.open_output_stream(f"{name}.rec"), system.open_output_stream(f"{name}.idx")
                texts = part.column(1).cast(pa.binary()).to_pylist()
                packed = [p + end for p in coder.encode([t or b"" for t in texts])]
                framed = frames([width + p for p in packed])
                entries = np.zeros(len(packed), ENTRY)
                entries["doc_id"] = part.column(0).fill_null(NO_ID).to_numpy()
                entries["n"] = [len(p) // len(end) for p in packed]
                sizes = np.array([len(f) for f in framed])
                entries["offset"] = offset + np.cumsum(sizes) - sizes
                entries["before"] = before + np.cumsum(entries["n"]) - entries["n"]
                records.write(b"".join(framed))
                index.write(entries.tobytes())
                offset, before, rows = offset + int(sizes.sum()), before + int(entries["n"].sum()), rows + len(packed)
        if records is not None:
            records.close()
            index.close()
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "name": name, "rows": rows, "ids": before}], PARTS_ARROW)

    rows.mapInArrow(task, PARTS).write.mode("errorifexists").parquet(f"{folder}/parts")
    return parts_of(spark, folder)


def parts_of(spark: SparkSession, folder: str) -> DataFrame:
    """The table of parts, each with the number of ids in the parts before it."""
    parts = spark.read.schema(PARTS).parquet(f"{folder}/parts")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return parts.withColumn("base", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))


def frames_of(folder: str, name: str, order: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(index entries, checked payloads) of one record file, some at a time; ``order``
    picks entries by number, as a reader that shuffles would."""
    system, _ = _file_system(folder)
    with system.open_input_stream(f"{name}.idx") as file:
        entries = np.frombuffer(file.read(), ENTRY)
    with system.open_input_file(f"{name}.rec") as file:
        ends = np.append(entries["offset"][1:], file.size())
        picked = np.arange(len(entries)) if order is None else order
        for at in range(0, len(picked), ROWS_AT_ONCE):
            some = picked[at : at + ROWS_AT_ONCE]
            if order is None:
                start = int(entries["offset"][some[0]])
                block = file.read_at(int(ends[some[-1]]) - start, start)
                data = [block[int(entries["offset"][k]) - start : int(ends[k]) - start] for k in some]
            else:
                data = [file.read_at(int(ends[k] - entries["offset"][k]), int(entries["offset"][k])) for k in some]
            yield entries[some], payloads_of(data)


def ids_of(payload: bytes) -> np.ndarray:
    """The ids of a payload as unsigned 32-bit integers."""
    return np.frombuffer(payload, "<u2" if payload[0] == 2 else "<u4", offset=1).astype("<u4")


def _from_files(parts: DataFrame, folder: str, schema: T.StructType, column) -> DataFrame:
    """A row per record: doc_id, start, n_tokens and what ``column`` makes of the ids."""
    arrow_type, make = column

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                for entries, payloads in frames_of(folder, part["name"]):
                    ids = [ids_of(p) for p in payloads]
                    if [len(i) for i in ids] != entries["n"].tolist():
                        raise ValueError("index and records disagree")
                    doc = pa.array(entries["doc_id"], mask=entries["doc_id"] == NO_ID)
                    columns = [doc, pa.array(entries["before"] + part["base"]), pa.array(entries["n"]), pa.array(map(make, ids), arrow_type)]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    files = max(1, parts.count())
    return parts.repartition(files, "part").mapInArrow(task, schema)


def _schema(name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens")] + [T.StructField(name, kind)])


def read(parts: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record, read from the files."""
    return _from_files(parts, folder, _schema("ids", T.ArrayType(T.LongType())), (pa.list_(pa.int64()), lambda ids: ids.tolist()))


def digests(parts: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read from the files."""
    return _from_files(parts, folder, _schema("ids_crc32", T.LongType()), (pa.int64(), lambda ids: zlib.crc32(ids.tobytes())))
