"""Media columns: lossless WAV payloads and spectral-peak fingerprints.

A payload's bytes become the unsigned 8-bit samples of a mono WAV; the wave
module reads them back.  Frames of samples go through a short-time Fourier
transform; local peaks of neighbouring frames pair up to codes of two
frequencies and a distance, stored with the time of the first.  Frames overlap
by half, also beyond both ends of the payload, so every sample is in two.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE = 8000
#: A payload is padded to a multiple of so many bytes.
UNIT = 576
FRAME = 192
HOP = 96
FILL = 255
#: Peaks kept of a frame, and frames that an anchor looks ahead.
PEAKS = 3
AHEAD = 3
#: Frames transformed at a time; bounds memory for very long payloads.
CHUNK = 8192


def pad(payload: bytes, unit: int = UNIT, fill: int = FILL) -> bytes:
    """The payload with ``fill`` bytes up to a positive multiple of ``unit``."""
    return payload + bytes([fill]) * (max(1, -(-len(payload) // unit)) * unit - len(payload))


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


#: No weight is zero, so that no sample is lost.
_HANN = np.hanning(FRAME + 2)[1:-1].astype(np.float32)


def spectrum_peaks(samples: np.ndarray) -> np.ndarray:
    """(frames, PEAKS) bins of the strongest local peaks of each frame, -1
    where a frame has fewer; magnitudes are rounded, so that ties, which go to
    the lower bin, are the same on every machine.  A frame has a peak unless
    its samples are all equal."""
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP].astype(np.float32)
    frames = (frames - frames.mean(axis=1, keepdims=True)) * _HANN
    mag = np.abs(np.fft.rfft(frames, axis=1))[:, 1:]
    level = np.pad(np.round(np.log2(mag + 1.0) * 64).astype(np.int32), ((0, 0), (1, 1)))
    inner = level[:, 1:-1]
    peak = (inner > level[:, :-2]) & (inner >= level[:, 2:])
    # strength first, then the lower bin: one integer orders both
    score = np.where(peak, inner * 512 + (511 - np.arange(inner.shape[1], dtype=np.int32)), -1)
    top = np.sort(np.partition(score, -PEAKS, axis=1)[:, -PEAKS:], axis=1)[:, ::-1]
    return np.where(top >= 0, 512 - (top & 511), -1)


def fingerprint(payload: bytes) -> np.ndarray:
    """Time-coded pairs as one array of int64: time << 32 | f1 << 20 | f2 << 8 | dt,
    in order of time.  A peak pairs with every peak of the ``AHEAD`` frames after it."""
    edge = np.full(HOP, FILL, np.uint8)
    samples = np.concatenate([edge, np.frombuffer(pad(payload, HOP), np.uint8), edge])
    n = len(samples) // HOP - 1
    peaks = np.concatenate([spectrum_peaks(samples[i * HOP : (min(n, i + CHUNK) + 1) * HOP]) for i in range(0, n, CHUNK)]).astype(np.int64)
    out = []
    for dt in range(1, min(AHEAD, n - 1) + 1):
        a, b = peaks[:-dt, :, None], peaks[dt:, None, :]
        t = np.arange(n - dt, dtype=np.int64)[:, None, None]
        out.append(((t << 32) | (a << 20) | (b << 8) | dt)[(a >= 0) & (b >= 0)])
    codes = np.concatenate(out)
    codes.sort()
    return codes


def with_media(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text as a WAV in a binary column.

    A null text is empty and so one frame of padding.  Rows are kept as they
    are: repeated rows and null keys stay, other columns are not read.
    """

    def encode(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                raw = [(x or "").encode() for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([to_wav(pad(x)) for x in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(encode, "doc_id long, n_bytes long, media binary")


def with_features(media: DataFrame) -> DataFrame:
    """Reads each stored WAV back: payload digests and the fingerprint array."""

    def decode(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                cols = {k: [] for k in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "fingerprint")}
                for stored in part.column(2).to_pylist():
                    payload = from_wav(stored)
                    cols["payload_bytes"].append(len(payload))
                    cols["payload_sha256"].append(hashlib.sha256(payload).hexdigest())
                    cols["tail_crc32"].append(zlib.crc32(payload[-32:]))
                    cols["media_bytes"].append(len(stored))
                    cols["media_sha256"].append(hashlib.sha256(stored).hexdigest())
                    cols["fingerprint"].append(fingerprint(payload))
                types = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "fingerprint": pa.list_(pa.int64())}
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(v, types[k]) for k, v in cols.items())], ["doc_id", "n_bytes", *cols])

    return media.mapInArrow(
        decode, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, fingerprint array<long>")
