"""Operator 9: telephony audio in media columns.

Payload bytes are kept verbatim as 8-bit mu-law or A-law samples, or as the nibbles of IMA
ADPCM blocks, in a WAV container. Decoding expands mu-law and A-law by 256-entry tables and
ADPCM by stepping through a block's nibbles for all blocks of a batch at once, in numpy. The
16-bit PCM of every clip is resampled by half-band filters from the 8 kHz of telephony to one
common rate, 16 kHz as speech models take it, and stored without loss: samples that the half-band
filter foretells from their neighbours exactly need no room, and samples that are all levels of one
companding table take a byte each. Features are computed from the whole PCM read back. The common rate is a
parameter; at other rates, where nothing is foretold, all samples are stored.

Defined results: a null or empty text is a payload of 576 bytes 255; a long text is one long
clip; equal payloads give equal media, as the codec follows from the payload's checksum; a null
id keeps its row, and repeated rows give repeated results; other columns are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import arrow_map, byte_list, slices, stored

UNIT = 576
RATE_OUT = 16000
#: Sampling rates of clips by codec.
RATES = {"mulaw": 8000, "alaw": 8000, "adpcm": 8000}
#: Samples that filters and features work on at once.
WINDOW = 1 << 20
#: Both tables are kept; a high level and wide pages cost little beside decoding.
STORE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "12", "parquet.page.size": str(8 << 20)}
CODECS = ("mulaw", "alaw", "adpcm")
#: Format tags of the WAV container.
WAV_TAG = {"alaw": 6, "mulaw": 7, "adpcm": 0x11}
#: Index changes of IMA ADPCM by the low three bits of a nibble.
INDEX_STEP = (-1, -1, -1, -1, 2, 4, 6, 8)
#: The 89 step sizes of IMA ADPCM.
STEPS = (
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658,
    724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500,
    20350, 22385, 24623, 27086, 29794, 32767,
)


def mulaw_table() -> np.ndarray:
    """16-bit PCM of each mu-law code, by the rule of the G.711 standard."""
    code = ~np.arange(256) & 0xFF
    magnitude = ((((code & 0x0F) << 3) + 0x84) << ((code >> 4) & 7)) - 0x84
    return np.where(code & 0x80, -magnitude, magnitude).astype(np.int16)


def alaw_table() -> np.ndarray:
    """16-bit PCM of each A-law code, by the rule of the G.711 standard."""
    code = np.arange(256) ^ 0x55
    exponent, mantissa = (code >> 4) & 7, (code & 0x0F) << 4
    magnitude = np.where(exponent == 0, mantissa + 8, (mantissa + 0x108) << np.maximum(exponent - 1, 0))
    return np.where(code & 0x80, magnitude, -magnitude).astype(np.int16)


MULAW, ALAW = mulaw_table(), alaw_table()
#: The levels of both tables, ascending, and the place of every 16-bit value among them (-1: none).
LEVELS = (np.unique(MULAW), np.unique(ALAW))
PLACES = tuple(np.full(1 << 16, -1, np.int16) for _ in LEVELS)
for _place, _levels in zip(PLACES, LEVELS, strict=True):
    _place[_levels.view(np.uint16)] = np.arange(len(_levels))


def adpcm_decode(blocks: np.ndarray) -> np.ndarray:
    """IMA ADPCM, mono: uint8 [n, 4 + bytes] -> int16 [n, 1 + 2 * bytes]. One step a nibble, for
    all blocks at once; low nibbles come first."""
    head = blocks[:, :4]
    value = (head[:, 0].astype(np.int32) | head[:, 1].astype(np.int32) << 8).astype(np.int16).astype(np.int32)
    index = np.clip(head[:, 2].astype(np.int32), 0, 88)
    data = np.ascontiguousarray(blocks[:, 4:].T)
    steps, change = np.array(STEPS, np.int32), np.array(INDEX_STEP * 2, np.int32)
    out = np.empty((1 + 2 * data.shape[0], len(blocks)), np.int16)
    out[0] = value
    for i, byte in enumerate(data):
        for j, nibble in enumerate((byte & 15, byte >> 4)):
            step = steps[index]
            delta = step >> 3
            delta += np.where(nibble & 4, step, 0)
            delta += np.where(nibble & 2, step >> 1, 0)
            delta += np.where(nibble & 1, step >> 2, 0)
            value = np.clip(np.where(nibble & 8, value - delta, value + delta), -32768, 32767)
            index = np.clip(index + change[nibble], 0, 88)
            out[1 + 2 * i + j] = value
    return out.T


def wav(payload: bytes, codec: str) -> bytes:
    """A WAV file that holds the payload verbatim."""
    if codec == "adpcm":
        units = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
        data = np.hstack([np.zeros((len(units), 4), np.uint8), units]).tobytes()
        align, samples = UNIT + 4, 1 + 2 * UNIT
        fmt = struct.pack("<HHIIHHHH", WAV_TAG[codec], 1, RATES[codec], RATES[codec] * align // samples, align, 4, 2, samples)
    else:
        data = payload
        fmt = struct.pack("<HHIIHHH", WAV_TAG[codec], 1, RATES[codec], RATES[codec], 1, 8, 0)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def unwav(media: bytes) -> tuple[str, bytes]:
    """Codec and data chunk of a WAV file as above; raises ValueError on any other."""
    if media[:4] != b"RIFF" or media[8:16] != b"WAVEfmt ":
        raise ValueError("not a WAV file")
    n = struct.unpack_from("<I", media, 16)[0]
    tag = struct.unpack_from("<H", media, 20)[0]
    codec = {v: k for k, v in WAV_TAG.items()}.get(tag)
    if codec is None or media[20 + n : 24 + n] != b"data":
        raise ValueError(f"WAV format {tag} is not supported")
    size = struct.unpack_from("<I", media, 24 + n)[0]
    return codec, media[28 + n : 28 + n + size]


def payload_of(codec: str, data: bytes) -> bytes:
    return np.frombuffer(data, np.uint8).reshape(-1, UNIT + 4)[:, 4:].tobytes() if codec == "adpcm" else data


def between(pcm: np.ndarray) -> np.ndarray:
    """What a 4-tap half-band filter (-1 9 9 -1)/16 puts after each sample; ends are repeated."""
    out = np.empty(len(pcm), np.int16)
    p = np.concatenate([pcm[:1], pcm, pcm[-1:], pcm[-1:]])
    for a in range(0, len(pcm), WINDOW):
        x = p[a : a + WINDOW + 3].astype(np.int32)
        out[a : a + WINDOW] = np.clip((9 * (x[1:-2] + x[2:-1]) - x[:-3] - x[3:] + 8) >> 4, -32768, 32767)
    return out


def doubled(pcm: np.ndarray) -> np.ndarray:
    """Twice the rate: samples stay, and between them come those of the filter."""
    out = np.empty(2 * len(pcm), np.int16)
    out[0::2], out[1::2] = pcm, between(pcm)
    return out


def halved(pcm: np.ndarray) -> np.ndarray:
    """Half the rate: every second sample of the half-band filter (-1 0 9 16 9 0 -1)/32."""
    p = np.pad(pcm.astype(np.int32), 3, mode="edge")
    n = (len(pcm) + 1) // 2
    tap = lambda k: p[k : k + 2 * n - 1 : 2]
    return np.clip((16 * tap(3) + 9 * (tap(2) + tap(4)) - tap(0) - tap(6) + 16) >> 5, -32768, 32767).astype(np.int16)


def resampled(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """PCM at another rate, a power of two away."""
    while rate < to:
        pcm, rate = doubled(pcm), rate * 2
    while rate > to:
        pcm, rate = halved(pcm), rate // 2
    if rate != to:
        raise ValueError(f"no half-band way to {to} Hz")
    return pcm


def decode(media: list[bytes], rate: int = RATE_OUT) -> list[np.ndarray]:
    """PCM of each WAV file at one rate; ADPCM blocks of all files are decoded together."""
    parts = [unwav(m) for m in media]
    blocks = [np.frombuffer(d, np.uint8).reshape(-1, UNIT + 4) for c, d in parts if c == "adpcm"]
    pcm = adpcm_decode(np.vstack(blocks)) if blocks else None
    out, at = [], 0
    for codec, data in parts:
        if codec == "adpcm":
            n = len(data) // (UNIT + 4)
            sound, at = pcm[at : at + n].reshape(-1), at + n
        else:
            sound = (MULAW if codec == "mulaw" else ALAW)[np.frombuffer(data, np.uint8)]
        out.append(resampled(sound, RATES[codec], rate))
    return out


def packed(pcm: np.ndarray) -> bytes:
    """16-bit PCM without loss. As often as every second sample is what ``between`` foretells, it is
    left out. Then a byte for how often, and one for how samples follow: 0 as they are, 1 or 2
    as a byte each, their place among the levels of mu-law or A-law."""
    times = 0
    while len(pcm) and len(pcm) % 2 == 0 and times < 255 and (between(pcm[0::2]) == pcm[1::2]).all():
        pcm, times = pcm[0::2], times + 1
    for form, place in enumerate(PLACES, 1):
        places = place[pcm.astype(np.uint16)]
        if (places >= 0).all():
            return bytes((times, form)) + places.astype(np.uint8).tobytes()
    return bytes((times, 0)) + pcm.astype("<i2").tobytes()


def unpacked(stored_pcm: bytes | memoryview) -> np.ndarray:
    """The whole PCM of ``packed``."""
    times, form = stored_pcm[0], stored_pcm[1]
    if form:
        pcm = LEVELS[form - 1][np.frombuffer(stored_pcm, np.uint8, -1, 2)]
    else:
        pcm = np.frombuffer(stored_pcm, "<i2", -1, 2).astype(np.int16)
    for _ in range(times):
        pcm = doubled(pcm)
    return pcm


def feature(codec: str, rate: int, pcm: np.ndarray) -> str:
    squares, peak, crossings = 0, 0, 0
    for a in range(0, len(pcm), WINDOW):
        x = pcm[max(a - 1, 0) : a + WINDOW].astype(np.int64)
        squares += int(np.square(x[a > 0 :]).sum())
        peak = max(peak, int(np.abs(x).max()))
        crossings += int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    rms = (squares / len(pcm)) ** 0.5
    return f"{codec};rate={rate};samples={len(pcm)};rms={rms:.3f};peak={peak};crossings={crossings};pcm_crc32={zlib.crc32(pcm.astype("<i2", copy=False))}"


def encode_media(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as a WAV clip."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = byte_list(batch.column(1))
        for a, b in slices([len(x) for x in texts], 8 << 20):
            media = []
            for raw in texts[a:b]:
                payload = raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)
                media.append(wav(payload, CODECS[zlib.crc32(payload) % len(CODECS)]))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(x) for x in texts[a:b]], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return arrow_map(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), rows, "doc_id long, n_bytes long, media binary")


DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, codec string, rate int, pcm binary"


def decode_media(clips: DataFrame, rate: int = RATE_OUT) -> DataFrame:
    """Stored clips (doc_id, n_bytes, media) -> DIGESTS: digests of payload and clip as read back, and
    the resampled 16-bit PCM as ``packed`` has it."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.binary()]
    names = [f.split()[0] for f in DIGESTS.split(", ")]

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        media = batch.column(2).to_pylist()
        for a, b in slices([len(x) for x in media], 6 << 20):
            part = media[a:b]
            out: list[list] = [[] for _ in kinds]
            for m, pcm in zip(part, decode(part, rate), strict=True):
                codec, data = unwav(m)
                payload = payload_of(codec, data)
                values = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), codec, rate, packed(pcm))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))], names=names)

    return arrow_map(clips.select("doc_id", "n_bytes", "media"), rows, DIGESTS)


def describe_media(sounds: DataFrame) -> DataFrame:
    """Stored DIGESTS with features of the PCM read back in its place."""
    kept = [f.split()[0] for f in DIGESTS.split(", ")][:7]

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codecs, rates, pcm = (batch.column(k) for k in (7, 8, 9))
        found = [feature(codecs[i].as_py(), rates[i].as_py(), unpacked(memoryview(pcm[i].as_buffer()))) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(7)), pa.array(found, pa.string())], names=[*kept, "feature"])

    return arrow_map(sounds, rows, ", ".join([*DIGESTS.split(", ")[:7], "feature string"]))


def media_table(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Clips written to the shared folder and read back."""
    return stored(encode_media(docs, text, doc_id), "media", **STORE)


def sound_table(clips: DataFrame, rate: int = RATE_OUT) -> DataFrame:
    """Digests and resampled PCM written to the shared folder and read back."""
    return stored(decode_media(clips, rate), "sounds", **STORE)
