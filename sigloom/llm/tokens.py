"""Operator 1: token ids as directly addressable codes.

Ids are cut into 8-bit chunks. Level 0 holds the lowest chunk of every id and a bitmap that
says which ids go on; level 1 holds the next chunk of those that do, and so on. Each bitmap has
a rank directory (set bits before every 512-bit block), so any token is read with one byte, one
bit and one rank per level, and nothing else is decoded.

A file is a Parquet table of segments in the shared folder, each with its documents' ids,
lengths and one code blob; partitions are ranges of ascending doc_id.

Tokenising: a text falls into units: white space and the Latin letters that follow it up to an
ASCII character of another kind, or else white space and what follows it up to the next white
space. A piece of the byte-level pattern ends at each such border, so no token crosses it, and
each distinct unit is encoded once by the tokenizers library and kept in a bounded memo of the
worker: units that are one piece (letters, a space before them at most) directly by the
tokenizer's model, others by the whole tokenizer. The strings of special tokens stand in a text for
their ids, as the library has it by default; such a text is cut at them first.
``special_as_text`` takes them as ordinary text.

Defined results: a null or empty text holds the end id alone; documents with a null id come
first; documents that share an id stand together, ordered by a hash of the text, and repeated rows
are encoded each, in as many partitions as they need; other columns are not read; an empty table
gives an empty file.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import stored

VOCABULARY = "byte_bpe_50k.json"
#: The Unicode white space characters.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
UNIT = re.compile(f"[{WHITE}]*[{LATIN}]++(?=[\\x00-\\x7f]|\\Z)|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
PIECE = re.compile(f" ?[{LATIN}]+")
#: Units a worker process remembers, and their greatest length (longer ones are encoded each time): about
#: 220 MB in prose, and 1.2 GB were every unit of the greatest length and of characters outside the vocabulary.
MEMO_UNITS, MEMO_LETTERS = 1_000_000, 48
BLOCK_BITS = 512
MAGIC = b"DAC1"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet by its rule: printable Latin-1 bytes stand for themselves, the
    others, in order, for the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(others)}


BYTE_LETTERS = byte_letters()


class Memo(dict):
    """Ids of units, as bytes; a unit asked for the first time, or a long one, is encoded."""

    def __init__(self, tokenizer: object) -> None:
        super().__init__()
        self.encode, self.pieces, self.single = tokenizer.encode, tokenizer.model.tokenize, PIECE.fullmatch

    def __missing__(self, unit: str) -> bytes:
        if self.single(unit):
            ids = [t.id for t in self.pieces(unit.encode().decode("latin-1").translate(BYTE_LETTERS))]
        else:
            ids = self.encode(unit, add_special_tokens=False).ids
        own = array("I", ids).tobytes()
        if len(unit) <= MEMO_LETTERS:
            self[unit] = own
        return own


class UnitEncoder:
    """Texts to little-endian uint32 ids, by one tokenizer file."""

    _of: dict[tuple[type, str, bool, int], UnitEncoder] = {}
    unit, memo_type = UNIT, Memo

    def __init__(self, path: str, special_as_text: bool = False, memo_units: int = MEMO_UNITS) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = {} if special_as_text else {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = {x: array("I", [i]).tobytes() for x, i in added.items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        if sys.byteorder != "little":
            raise RuntimeError("ids are kept in the machine's order, which must be little-endian")
        self.memo, self.memo_units = self.memo_type(self.tokenizer), memo_units

    @classmethod
    def of(cls, path: str, special_as_text: bool = False, memo_units: int = MEMO_UNITS) -> UnitEncoder:
        """One a worker process; the memo stays between tasks."""
        key = (cls, path, special_as_text, memo_units)
        if key not in cls._of:
            cls._of[key] = cls(*key[1:])
        return cls._of[key]

    def encode(self, texts: list[str]) -> list[bytes]:
        units = self.unit.findall

        def plain(t: str) -> bytes:
            if len(self.memo) > self.memo_units:
                self.memo = self.memo_type(self.tokenizer)
            return b"".join(map(self.memo.__getitem__, units(t)))

        def cut(t: str) -> bytes:  # every second part is a special token
            return b"".join(self.special[x] if k % 2 else plain(x) for k, x in enumerate(self.parts.split(t)))

        return [cut(t) if self.parts and self.parts.search(t) else plain(t) for t in texts]


class Dac:
    """Directly addressable codes over one segment's ids."""

    def __init__(self, n: int, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        self.n, self.levels = n, levels  # of a level: bytes, bitmap (packed), ranks

    @classmethod
    def of(cls, ids: np.ndarray) -> Dac:
        levels, rest = [], ids.astype(np.uint32)
        while True:
            more = rest > 0xFF
            bits = np.packbits(more, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK_BITS // 8), np.uint8)])
            per = np.bitwise_count(bits.reshape(-1, BLOCK_BITS // 8)).sum(1, dtype=np.uint32)
            ranks = np.concatenate([[0], np.cumsum(per)[:-1]]).astype("<u4") if len(per) else np.zeros(0, "<u4")
            levels.append(((rest & 0xFF).astype(np.uint8), bits, ranks))
            rest = rest[more] >> 8
            if not len(rest):
                return cls(len(ids), levels)

    def tobytes(self) -> bytes:
        parts = [MAGIC, struct.pack("<QB", self.n, len(self.levels))]
        for chunk, bits, ranks in self.levels:
            parts += [struct.pack("<QQQ", len(chunk), len(bits), len(ranks)), chunk.tobytes(), bits.tobytes(), ranks.tobytes()]
        return b"".join(parts)

    @classmethod
    def frombytes(cls, blob: bytes) -> Dac:
        """Views into the blob; nothing is decoded."""
        if blob[:4] != MAGIC:
            raise ValueError("not a code blob")
        n, k = struct.unpack_from("<QB", blob, 4)
        at, levels = 13, []
        for _ in range(k):
            a, b, c = struct.unpack_from("<QQQ", blob, at)
            at += 24
            levels.append((np.frombuffer(blob, np.uint8, a, at), np.frombuffer(blob, np.uint8, b, at + a), np.frombuffer(blob, "<u4", c, at + a + b)))
            at += a + b + 4 * c
        return cls(n, levels)

    def __getitem__(self, i: int) -> int:
        """The i-th id, by one rank a level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for chunk, bits, ranks in self.levels:
            value |= int(chunk[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK_BITS
            first = block * BLOCK_BITS // 8
            before = int(np.bitwise_count(bits[first : i >> 3]).sum()) + (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i, shift = int(ranks[block]) + before, shift + 8
        return value

    def all(self) -> np.ndarray:
        rest = None
        for chunk, bits, _ in reversed(self.levels):
            ids = chunk.astype("<u4")
            if rest is not None:
                ids[np.unpackbits(bits, count=len(chunk), bitorder="little").view(bool)] |= rest << 8
            rest = ids
        return rest if rest is not None else np.zeros(0, "<u4")


SEGMENTS = "part int, seq int, n_tokens long, doc_ids array<bigint>, doc_tokens array<bigint>, codes binary"


def encode_tokens(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None, end_id: int = 0, segment_tokens: int = 1 << 18, special_as_text: bool = False) -> DataFrame:
    """Segments of every whole text in ascending doc_id order; the end id closes each document."""
    path, end = vocabulary or vocabulary_path(), np.array([end_id], "<u4").tobytes()

    def segment(part: int, seq: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        counts = [len(x) // 4 for x in texts]
        codes = Dac.of(np.frombuffer(b"".join(texts), "<u4")).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([sum(counts)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([codes], pa.binary())],
            names=["part", "seq", "n_tokens", "doc_ids", "doc_tokens", "codes"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = UnitEncoder.of(path, special_as_text), TaskContext.get().partitionId()
        seq, ids, texts, held = 0, [], [], 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for a in range(0, len(keys), 256):
                got = encoder.encode([t or "" for t in batch.column(1).slice(a, 256).to_pylist()])
                for key, x in zip(keys[a : a + 256], got, strict=True):
                    ids.append(key)
                    texts.append(x + end)
                    held += len(x) // 4 + 1
                    if held >= segment_tokens:
                        yield segment(part, seq, ids, texts)
                        seq, ids, texts, held = seq + 1, [], [], 0
        if ids:
            yield segment(part, seq, ids, texts)

    table = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), "code"]
    table = table.withColumn("code", F.xxhash64("text")).withColumn("nth", F.monotonically_increasing_id())  # so that repeated rows can be parted
    return table.repartitionByRange(*order, "nth").sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(rows, SEGMENTS)


def segment_starts(segments: DataFrame) -> DataFrame:
    """(part, seq, segment_start): tokens of all segments before. The two windows hold one row
    a partition, and one row a segment of one partition."""
    own = segments.select("part", "seq", "n_tokens")
    parts = own.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return own.withColumn("inside", inside).join(before, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("segment_start"))


def read_documents(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), from the stored codes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, seq, keys, counts, codes = (batch.column(k)[i].as_py() for k in range(5))
                ids = Dac.frombytes(codes).all()
                ends = np.cumsum(counts)
                starts = ends - counts
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())], names=["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"])

    docs = segments.select("part", "seq", "doc_ids", "doc_tokens", "codes").mapInArrow(rows, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(segment_starts(segments), ["part", "seq"]).select("doc_id", (F.col("segment_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(segments: DataFrame, positions: DataFrame, stride: int = 1 << 20) -> DataFrame:
    """(position) -> (position, token): single tokens by global position, without decoding the
    segments they lie in. Positions outside the file give no row."""
    where = segment_starts(segments).join(segments.select("part", "seq", "n_tokens"), ["part", "seq"])
    where = where.withColumn("bin", F.explode(F.sequence(F.expr(f"segment_start div {stride}"), F.expr(f"(segment_start + n_tokens - 1) div {stride}"))))
    asked = positions.select(F.col("position").cast("long").alias("position")).where("position >= 0").withColumn("bin", F.expr(f"position div {stride}"))
    found = asked.join(where, "bin").where("position >= segment_start and position < segment_start + n_tokens")
    found = found.groupBy("part", "seq", F.expr(f"(position - segment_start) div {1 << 14}").alias("chunk")).agg(F.collect_list(F.struct("position", (F.col("position") - F.col("segment_start")).alias("i"))).alias("asked"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wanted, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                dac = Dac.frombytes(codes)
                yield pa.RecordBatch.from_arrays([pa.array([x["position"] for x in wanted], pa.int64()), pa.array([dac[x["i"]] for x in wanted], pa.int64())], names=["position", "token"])

    return found.join(segments.select("part", "seq", "codes"), ["part", "seq"]).select("asked", "codes").mapInArrow(rows, "position long, token long")


def token_file(docs: DataFrame, **options: object) -> DataFrame:
    """Segments written to the shared folder and read back."""
    return stored(encode_tokens(docs, **options), "tokens", compression="zstd")
