"""Byte-level BPE through a sentencepiece model made from a rank file.

The model is serialised directly: one piece for each vocabulary entry, its bytes
written as printable characters, scored by its negative rank, with an identity
normaliser. sentencepiece then merges the adjacent pair whose merged piece has the
lowest rank, leftmost first, which is the rule of rank files. Texts are cut into
pre-tokens by the vocabulary's pattern; only distinct ones are encoded, and a
bounded cache per worker keeps their ids. Decoding is the inverse map of ids to bytes.

Defined results: a null text is the empty text and has no ids. Extra columns pass
through; ``ids``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` replace columns
of the same name. Repeated rows give repeated results, an empty table an empty one.
"""

from __future__ import annotations

import base64
import re
import struct
import sys
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "<unk>"
#: Unicode white space; Python's own class has four control characters more.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
RARE_SPACE = re.compile(f"[{SPACE}]".replace(" ", "").replace("\\t-\\r", "\\t\\v\\f\\r"))
WIDE = re.compile(f"([{SPACE}]{{2,}}[^{SPACE}]*)")
CACHE_CHUNKS = 600_000  # chunks of text whose ids a task keeps
LONGEST_CACHED = 64
BATCH_ROWS = 256
_coders: dict = {}


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file by rank; every rank from 0 must be there once."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens: list[bytes | None] = [None] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if any(t is None for t in tokens):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return tokens  # type: ignore[return-value]


def byte_characters() -> dict[int, str]:
    """A printable character for each byte value: itself in the printable Latin-1
    ranges, else the next one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value % (1 << 64))


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model of the tokens, id = rank; the unknown piece comes last."""
    chars = byte_characters()
    pieces = ["".join(chars[b] for b in t) for t in tokens]
    out = b"".join(_field(1, _field(1, p.encode()) + _field(2, -float(r)) + _field(3, 1)) for r, p in enumerate(pieces))
    out += _field(1, _field(1, UNKNOWN.encode()) + _field(2, 0.0) + _field(3, 2))
    trainer = [(3, 2), (4, len(tokens) + 1), (40, len(tokens)), (41, -1), (42, -1), (43, -1)]  # BPE; no control pieces
    out += _field(2, b"".join(_field(k, v) for k, v in trainer))
    return out + _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))


class Coder:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(tokens))
        self.find = regex.compile(pattern).findall  # its white space is that of Unicode
        chars = byte_characters()
        self.characters = chars
        self.tokens = np.array(tokens, dtype=object)
        self.whole = {t: r for r, t in enumerate(tokens)}
        self.texts = np.array([str(r) for r in range(len(tokens))], dtype=object)
        self.code = "H" if len(tokens) <= 1 << 16 else "I"
        self.type = np.dtype(self.code)
        self.cache: dict[str, bytes] = {}

    def pack(self, found: list[str]) -> dict[str, bytes]:
        """Packed ids of distinct pre-tokens."""
        raw = [x.encode("utf-8", "surrogatepass") for x in found]
        ids = self.processor.encode([r.decode("latin-1").translate(self.characters) for r in raw], num_threads=1)
        code, whole = self.code, self.whole
        # A pre-token that is a token stands for itself, whatever its merges say.
        return {x: array(code, (whole[r],) if r in whole else i).tobytes() for x, r, i in zip(found, raw, ids)}

    def learn(self, chunks: list[str]) -> None:
        """Put the packed ids of chunks into the cache."""
        cut = list(map(self.find, chunks))
        cache = self.cache
        cache.update(self.pack(list(set().union(*cut).difference(cache))))
        cache.update((c, b"".join(map(cache.__getitem__, ps))) for c, ps in zip(chunks, cut) if len(ps) != 1)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text: it is cut into recurring chunks, which are looked up."""
        if len(self.cache) > CACHE_CHUNKS:
            self.cache.clear()
        cut = [chunks_of(t) for t in texts]
        missing = list(set().union(*cut).difference(self.cache))
        if missing:
            self.learn(missing)
        packed = [np.frombuffer(b"".join(map(self.cache.__getitem__, pieces)), self.type) for pieces in cut]
        for chunk in [c for c in missing if len(c) > LONGEST_CACHED]:
            del self.cache[chunk]
        return packed

    def digest(self, ids: np.ndarray) -> str:
        """SHA-256 of the decimal ids joined by commas."""
        return sha256(",".join(self.texts[ids].tolist()).encode()).hexdigest()

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        return b"".join(self.tokens[ids].tolist())


def may_be_wide(text: str) -> bool:
    """Whether two characters of white space may stand together; a cheap look first."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return True
    return any(c in text for c in "\t\r\v\f") if text.isascii() else RARE_SPACE.search(text) is not None


def chunks_of(text: str) -> list[str]:
    """The text cut where pre-tokens always end: before a single blank (it joins what
    follows), around a single line end, and around a run of white space with the word after it."""
    out: list[str] = []
    for k, part in enumerate(WIDE.split(text) if may_be_wide(text) else [text]):
        if k % 2:
            out.append(part)
            continue
        for n, line in enumerate(part.split("\n")):
            if n:
                out.append("\n")
            if line:
                first, *others = line.split(" ")
                if first:
                    out.append(first)
                out += [" " + p for p in others]
    return out


def coder(path: str, pattern: str) -> Coder:
    """One coder per worker and vocabulary."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(read_ranks(path), pattern)
    return _coders[path, pattern]


@contextmanager
def task_coder(path: str, pattern: str) -> Iterator[Coder]:
    """The worker's coder; what a task cached goes when it ends, since workers live on."""
    own = coder(path, pattern)
    try:
        yield own
    finally:
        own.cache.clear()


def _added(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(columns.values()), names=[*kept, *columns])


def _with(df: DataFrame, fields: list[tuple[str, T.DataType]]) -> T.StructType:
    names = {n for n, _ in fields}
    return T.StructType([f for f in df.schema.fields if f.name not in names] + [T.StructField(n, t) for n, t in fields])


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``: the array of token ids of every text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_coder(path, pattern) as own:
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    part = batch.slice(at, BATCH_ROWS)
                    rows = own.encode([x or "" for x in part.column(part.schema.get_field_index(text)).to_pylist()])
                    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                    values = np.concatenate([*rows, np.zeros(0, own.type)]).astype(np.int32)
                    yield _added(part, {"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(values))})

    return df.mapInArrow(task, _with(df, [("ids", T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the bytes of every row's ids."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_coder(path, pattern) as own:
            for batch in batches:
                rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
                found = [own.decode(np.array(r or [], np.int64)) for r in rows]
                yield _added(batch, {"decoded": pa.array(found, pa.binary())})

    return df.mapInArrow(task, _with(df, [("decoded", T.BinaryType())]))


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Encode, decode and digest in one pass; the texts and ids stay in the task."""
    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    kept = [f for f in df.schema.fields if f.name not in {text, *(n for n, _ in fields)}]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_coder(path, pattern) as own:
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    part = batch.slice(at, BATCH_ROWS)
                    rows = own.encode([x or "" for x in part.column(part.schema.get_field_index(text)).to_pylist()])
                    found = {
                        "n_tokens": pa.array(map(len, rows), pa.int64()),
                        "ids_sha256": pa.array([own.digest(r) for r in rows], pa.string()),
                        "decoded_sha256": pa.array([sha256(own.decode(r)).hexdigest() for r in rows], pa.string()),
                    }
                    yield _added(part.select([f.name for f in kept]), found)

    return df.mapInArrow(task, T.StructType([*kept, *[T.StructField(n, t) for n, t in fields]]))
