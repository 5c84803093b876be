"""Media columns: texts as 8-bit WAV sounds, short-time Fourier transforms and spectral-peak pairs.

Each sound's spectrogram is reduced to its strongest peaks; pairs of peaks close in time form
fingerprint hashes (both frequencies and the distance) stored with the time of the first peak.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import each_text, ids_and_texts, small_batches

RATE = 8000
UNIT = 64
#: Samples of a frame and between frames, frequency bands with one peak each, and peaks paired with each peak.
FRAME, HOP, BANDS, FAN = 256, 128, 4, 3
#: Frames transformed at once, so that long sounds need bounded memory.
BLOCK_FRAMES = 8192
_WINDOW = np.hanning(FRAME).astype(np.float32)


def padded(text: str | None) -> bytes:
    """UTF-8 of a text (null: empty) with bytes 0 up to a positive multiple of 64."""
    data = (text or "").encode("utf-8", "replace")
    return data + bytes(-len(data) % UNIT or (0 if data else UNIT))


def write_wav(payload: bytes) -> bytes:
    """The payload as the samples of a mono 8-bit WAV file."""
    out = io.BytesIO()
    with wave.open(out, "wb") as sound:
        sound.setnchannels(1)
        sound.setsampwidth(1)
        sound.setframerate(RATE)
        sound.writeframes(payload)
    return out.getvalue()


def read_wav(media: bytes) -> bytes:
    """The samples of a mono 8-bit WAV file."""
    with wave.open(io.BytesIO(media), "rb") as sound:
        if (sound.getnchannels(), sound.getsampwidth()) != (1, 1):
            raise ValueError("mono 8-bit samples are expected")
        return sound.readframes(sound.getnframes())


def spectrogram(samples: np.ndarray) -> Iterator[np.ndarray]:
    """Magnitudes (frames x bins) of the short-time Fourier transform, in blocks of frames; a last part frame is padded."""
    signal = samples.astype(np.float32) - np.float32(128)
    frames = max(1, -(-(len(signal) - FRAME) // HOP) + 1)
    signal = np.concatenate([signal, np.zeros((frames - 1) * HOP + FRAME - len(signal), np.float32)])
    windows = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP]
    for at in range(0, frames, BLOCK_FRAMES):
        yield np.abs(np.fft.rfft(windows[at : at + BLOCK_FRAMES] * _WINDOW, axis=1))


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Times (frames) and bins of the strongest bin in each band of each frame that tops both neighbouring frames."""
    edges = np.linspace(1, FRAME // 2 + 1, BANDS + 1).astype(int)
    times, bins, heights = [], [], []
    start = 0
    for block in spectrogram(samples):
        at = np.stack([block[:, a:b].argmax(axis=1) + a for a, b in zip(edges, edges[1:], strict=False)], axis=1)
        bins.append(at)
        heights.append(np.take_along_axis(block, at, axis=1))
        times.append(np.arange(start, start + len(block)))
        start += len(block)
    at, height, time = np.concatenate(bins), np.concatenate(heights), np.concatenate(times)
    fence = np.full((1, BANDS), -1, height.dtype)
    before, after = np.vstack([fence, height[:-1]]), np.vstack([height[1:], fence])
    frame, band = np.nonzero((height > before) & (height >= after))
    return time[frame], at[frame, band]


def fingerprint(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of peak pairs and the times of their first peaks.

    Peaks are ordered by time and bin; each is paired with the next ``FAN`` ones. A hash holds the
    first bin, the second bin and the frames between (127 at most) in 8, 8 and 7 bits.
    """
    time, bin_ = peaks(samples)
    hashes, times = [], []
    for step in range(1, FAN + 1):
        gap = np.minimum(time[step:] - time[:-step], 127)
        hashes.append((bin_[:-step] << 15 | bin_[step:] << 7 | gap).astype(np.int32))
        times.append(time[:-step].astype(np.int32))
    hash_, when = np.concatenate(hashes), np.concatenate(times)
    order = np.lexsort((hash_, when))
    return hash_[order], when[order]


def describe_documents(docs: DataFrame, store_media: bool = False) -> DataFrame:
    """Every whole text as a sound, with digests and its fingerprint.

    ``doc_id``, ``n_bytes``, ``payload_bytes``, ``payload_sha256`` and ``tail_crc32`` (of the
    samples read back), ``media_bytes``, ``media_sha256``, ``peak_hashes`` and ``peak_times``
    (arrays of int), ``feature`` (digest of both arrays with their length), and ``media`` with
    ``store_media``. A null text counts as empty: 64 bytes 0. Rows stay as they are, other columns
    are ignored, nothing is shuffled, equal texts give equal values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in each_text(batches):
            rows, media_column = [], []
            for text in texts:
                payload = padded(text)
                media = write_wav(payload)
                back = read_wav(media)
                if back != payload:
                    raise ValueError("the samples read back differ from the payload")
                hashes, times = fingerprint(np.frombuffer(back, np.uint8))
                digest = hashlib.sha256(hashes.astype("<i4").tobytes() + times.astype("<i4").tobytes()).hexdigest()
                rows.append((
                    len((text or "").encode("utf-8", "replace")), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]),
                    len(media), hashlib.sha256(media).hexdigest(), hashes, times, f"{len(hashes)}:{digest}",
                ))
                media_column.append(media if store_media else None)
            n_bytes, payload_bytes, payload_sha, crc, media_bytes, media_sha, hashes, times, feature = zip(*rows, strict=True)
            lengths = np.r_[0, np.cumsum([len(h) for h in hashes])].astype(np.int32)
            arrays = [
                ids, pa.array(n_bytes, pa.int64()), pa.array(payload_bytes, pa.int64()), pa.array(payload_sha, pa.string()),
                pa.array(crc, pa.int64()), pa.array(media_bytes, pa.int64()), pa.array(media_sha, pa.string()),
                pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(hashes))),
                pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(times))), pa.array(feature, pa.string()),
            ]
            names = "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 peak_hashes peak_times feature".split()
            if store_media:
                arrays.append(pa.array(media_column, pa.binary()))
                names.append("media")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    small_batches(docs.sparkSession)
    schema = (
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
        "media_sha256 string, peak_hashes array<int>, peak_times array<int>, feature string" + ", media binary" * store_media
    )
    return ids_and_texts(docs).mapInArrow(run, schema)
