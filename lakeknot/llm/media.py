"""Media columns: texts as 8-bit WAV, read back by the wave module, with spectral-peak pair fingerprints.

``to_wav`` stores each text's bytes, padded with blanks to a positive multiple of FRAME, as 8-bit mono samples.
``fingerprint`` reads the stored bytes back, takes short-time Fourier transforms (Hann windows of FRAME samples,
centred on samples 0, HOP, 2 HOP, ... with both ends mirrored; HOP is half a frame, so no sample lies at the edge of
all its windows), keeps in each frame the strongest bin of every band as a peak, pairs each peak with another of its
frame and those of the next FAN frames, and stores the pairs as arrays: time_ms of the first peak and code (band, both
bins, distance).

Null texts are empty and give one frame of blanks; repeated texts give equal values; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_chunks, text_col

FRAME, HOP, RATE = 192, 96, 8000
#: Frames that a peak is paired with.
FAN = 2
#: Bands of bins; each gives a peak a frame.
BANDS = ((2, 12), (12, 32), (32, 97))
PAD = b" "


def wav_bytes(payload: bytes, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def wav_payload(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def to_wav(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (unpadded), media (a WAV file's bytes)."""

    def run(batches):
        for rows, data, off in text_chunks(batches, most=2 << 20):
            raw, cuts, media = data.tobytes(), off.tolist(), []
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                size = max(FRAME, -(-(z - a) // FRAME) * FRAME)
                media.append(wav_bytes(raw[a:z].ljust(size, PAD)))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(off), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col()).mapInArrow(run, "doc_id long, n_bytes long, media binary")


_HANN = (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(FRAME) / FRAME)).astype(np.float32)
#: Frames transformed at once.
BLOCK = 4096


def peak_bins(samples: np.ndarray) -> np.ndarray:
    """The strongest bin of each band, a row for each frame."""
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(samples, FRAME // 2, mode="reflect"), FRAME)[::HOP]
    out = np.empty((len(frames), len(BANDS)), np.uint32)
    for at in range(0, len(frames), BLOCK):
        spectrum = np.fft.rfft((frames[at : at + BLOCK].astype(np.float32) - np.float32(128)) * _HANN, axis=1)
        power = (spectrum.real**2 + spectrum.imag**2).astype(np.float32)
        for k, (lo, hi) in enumerate(BANDS):
            out[at : at + BLOCK, k] = power[:, lo:hi].argmax(1) + lo
    return out


def peak_pairs(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(time in ms, code) of all pairs, by time."""
    n, bands = bins.shape
    times, codes = [], []
    for gap in range(FAN + 1):
        for k in range(bands):
            first, second = bins[: n - gap, k], bins[gap:, (k + 1) % bands]
            if len(first):
                codes.append((np.uint32(k) << 18) | (first << 10) | (second << 2) | np.uint32(gap))
                times.append(np.arange(len(first), dtype=np.int64) * (HOP * 1000 // RATE))
    if not codes:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    time, code = np.concatenate(times), np.concatenate(codes)
    order = np.argsort(time, kind="stable")
    return time[order].astype(np.int32), code[order].astype(np.int32)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media", pa.binary()), ("time_ms", pa.list_(pa.int32())), ("code", pa.list_(pa.int32()))])


def _offsets(arrays: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(a) for a in arrays])), pa.int32()), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32), pa.int32()))


def fingerprint(media: DataFrame) -> DataFrame:
    """media (doc_id, n_bytes, media) with what its stored bytes hold: payload figures and the pairs' time_ms and code arrays."""

    def run(batches):
        for rows, data, off in text_chunks(batches, "media", 2 << 20):
            raw, cuts = data.tobytes(), off.tolist()
            size, sha, crc, times, codes = [], [], [], [], []
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                payload = wav_payload(raw[a:z])
                t, c = peak_pairs(peak_bins(np.frombuffer(payload, np.uint8)))
                size.append(len(payload)), sha.append(hashlib.sha256(payload).hexdigest()), crc.append(zlib.crc32(payload[-16:])), times.append(t), codes.append(c)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("n_bytes"), pa.array(size, pa.int64()), pa.array(sha, pa.string()), pa.array(crc, pa.int64()), rows.column("media"), _offsets(times), _offsets(codes)], schema=_SCHEMA)

    return media.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media binary, time_ms array<int>, code array<int>")


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the digests of its stored form and of what was read back; feature: pairs and the hash of all their times and codes."""
    out = fingerprint(to_wav(read_table(spark, sf_dir, "documents")))
    feature = F.concat_ws(":", F.lit("peaks"), F.size("code").cast("string"), F.hex(F.xxhash64("time_ms", "code")))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"))
