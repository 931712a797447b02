"""Signals: as arrays in columns, and as WAV bytes in Python batches.

Only PCM WAV is decoded by itself; other formats need the soundfile package,
which is used where it is installed.
"""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE = 1 << 15  # frames read at a time


def gap_samples(rate: int, gap_ms: float) -> int:
    """Samples of silence between two clips: rounded half to even, never negative."""
    return max(0, round(rate * gap_ms / 1000))


def join_signals(signals: Column, gap: int = 0) -> Column:
    """An array of signals as one, with ``gap`` zeros between (none at the ends)."""
    silence = F.array_repeat(F.lit(0.0).cast("float"), gap)
    parts = F.transform(signals, lambda x, i: F.when((i > 0) & F.lit(gap > 0), F.concat(silence, x)).otherwise(x))
    return F.flatten(parts)


def resample_linear(signal: Column, source: int, target: int) -> Column:
    """Linear interpolation at positions j * n / m, clamped to the last sample."""
    if source == target:
        return signal
    n = F.size(signal)
    m = F.greatest(F.lit(1), F.bround(n * F.lit(target) / F.lit(float(source))).cast("int"))

    def at(j: Column) -> Column:
        x = F.least(j * n / m, n - F.lit(1.0))
        k = F.floor(x).cast("int")
        low, high = F.get(signal, k).cast("double"), F.get(signal, F.least(k + 1, n - 1)).cast("double")
        return (low + (high - low) * (x - k)).cast("float")

    return F.when(n == 0, signal).otherwise(F.transform(F.sequence(F.lit(0), m - 1), at))


class Polyphase:
    """Band-limited resampling by up / down (coprime), fed piece by piece: zeros between samples, one low-pass filter, every ``down``-th value.

    The filter is a sinc under a Kaiser window (beta 5) over 10 periods of the lower
    rate on each side.  Only the taps that meet a sample are multiplied.  Samples that
    later values still need are carried over, so pieces give the values of the whole.
    """

    def __init__(self, up: int, down: int, block: int = 1 << 12):
        self.up, self.down, self.block, self.wide = up, down, block, 10 * max(up, down)
        t = np.arange(-self.wide, self.wide + 1)
        taps = np.sinc(t / max(up, down)) * np.kaiser(len(t), 5.0)
        self.taps = taps * (up / taps.sum())
        self.held, self.first, self.made = np.empty(0, np.float32), 0, 0  # samples held, the first one's place, values made

    def feed(self, x: np.ndarray) -> np.ndarray:
        """The values that need no sample after these."""
        self.held = np.concatenate((self.held, x))
        return self._until(max(0, -(-((self.first + len(self.held)) * self.up - self.wide) // self.down)))

    def end(self) -> np.ndarray:
        """The values that are left, with silence after the last sample."""
        return self._until(-(-(self.first + len(self.held)) * self.up // self.down))

    def _until(self, end: int) -> np.ndarray:
        out = np.empty(max(0, end - self.made), np.float32)
        seen = self.first + len(self.held)
        for first in range(self.made, end, self.block):
            centre = np.arange(first, min(first + self.block, end)) * self.down
            at = -(-(centre - self.wide) // self.up)[:, None] + np.arange(2 * self.wide // self.up + 1)  # samples under the filter
            tap = self.wide + centre[:, None] - at * self.up
            good = (at >= 0) & (at < seen) & (tap >= 0)
            held = self.held[np.clip(at - self.first, 0, len(self.held) - 1)]
            out[first - self.made : first - self.made + len(centre)] = (np.where(good, held, 0) * self.taps[np.maximum(tap, 0)]).sum(axis=1)
        self.made = max(self.made, end)
        gone = min(max(0, -(-(self.made * self.down - self.wide) // self.up) - self.first), len(self.held))
        self.held, self.first = self.held[gone:], self.first + gone
        return out


def polyphase(x: np.ndarray, up: int, down: int, block: int = 1 << 12) -> np.ndarray:
    """A whole signal through ``Polyphase``."""
    whole = Polyphase(up, down, block)
    return np.concatenate((whole.feed(x), whole.end()))


def resampled(x: np.ndarray, source: int, target: int, method: str = "polyphase") -> np.ndarray:
    if source == target or not len(x):
        return x.astype(np.float32)
    if method == "polyphase":
        g = math.gcd(source, target)
        return polyphase(x, target // g, source // g)
    m = max(1, round(len(x) * target / source))
    return np.interp(np.arange(m) * (len(x) / m), np.arange(len(x)), x).astype(np.float32)


def _samples(raw: bytes, width: int, channels: int) -> np.ndarray:
    """PCM frames as the mean of their channels."""
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / (1 << (8 * width - 1))
    return x.reshape(-1, channels).mean(axis=1, dtype=np.float32)


@contextmanager
def opened(file: BinaryIO) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
    """Rate, and the mono float32 signal in pieces of at most ``PIECE`` frames: the mean of the channels."""
    try:
        source = wave.open(file)
    except (wave.Error, EOFError) as no_wave:
        try:
            import soundfile
        except ImportError:
            raise no_wave from None
        file.seek(0)
        with soundfile.SoundFile(file) as other:
            yield other.samplerate, (x.mean(axis=1).astype(np.float32) for x in other.blocks(PIECE, dtype="float32", always_2d=True))
        return
    with source:
        width, channels = source.getsampwidth(), source.getnchannels()
        yield source.getframerate(), (_samples(raw, width, channels) for raw in iter(lambda: source.readframes(PIECE), b""))


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """(mono float32 signal, rate) of a whole file."""
    with opened(io.BytesIO(data)) as (rate, pieces):
        return np.concatenate([np.empty(0, np.float32), *pieces]), rate


def encode_pcm16(x: np.ndarray, rate: int) -> bytes:
    """PCM16 WAV of one channel, or of the columns of a matrix; samples are scaled by 32767 and clipped."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1 if x.ndim == 1 else x.shape[1])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(pcm16(x))
    return out.getvalue()


def pcm16(x: np.ndarray) -> bytes:
    """Samples scaled by 32767, rounded half to even and clipped."""
    return np.clip(np.rint(x * 32767), -32768, 32767).astype("<i2").tobytes()


def _linear(pieces: Iterator[np.ndarray], n: int, m: int) -> Iterator[np.ndarray]:
    """``m`` values of a signal of ``n`` samples, at positions j * n / m."""
    held, first, made = np.empty(0, np.float32), 0, 0
    for piece in pieces:
        held = np.concatenate((held, piece))
        seen = first + len(held)
        end = m if seen == n else min(m, int((seen - 1) * m / n))  # of what comes next the first sample isn't needed
        at = np.arange(made, end) * (n / m)
        if len(at):
            yield np.interp(at, np.arange(first, seen), held).astype(np.float32)
        made = max(made, end)
        gone = max(0, min(int(made * (n / m)) - 1, seen - 1) - first)
        held, first = held[gone:], first + gone


def signal_of(path: str, rate: int, method: str = "polyphase") -> Iterator[np.ndarray]:
    """A file's signal at ``rate`` in pieces; its length doesn't matter to the memory that takes."""
    with open(path, "rb") as file, opened(file) as (source, pieces):
        if source == rate:
            yield from pieces
        elif method == "polyphase":
            g = math.gcd(source, rate)
            whole = Polyphase(rate // g, source // g)
            yield from map(whole.feed, pieces)
            yield whole.end()
        else:
            n = sum(map(len, pieces))
            with open(path, "rb") as again, opened(again) as (_, pieces):
                yield from _linear(pieces, n, max(1, round(n * rate / source)))


def concat_files(paths: list[str], out: BinaryIO, rate: int, gap_ms: float = 0.0, method: str = "polyphase") -> None:
    """One PCM16 WAV of all files at ``rate``, with silence between, written piece by piece; its header is mended at the end."""
    if not paths:
        raise ValueError("no audio paths to concatenate")
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        for i, path in enumerate(paths):
            if i:
                w.writeframesraw(bytes(2 * gap_samples(rate, gap_ms)))
            for x in signal_of(path, rate, method):
                w.writeframesraw(pcm16(x))


def concat_wavs(clips: list[bytes], rate: int, gap_ms: float = 0.0, method: str = "polyphase") -> bytes:
    """One WAV of all clips at ``rate``, with silence between."""
    if not clips:
        raise ValueError("no audio paths to concatenate")
    silence, parts = np.zeros(gap_samples(rate, gap_ms), np.float32), []
    for i, clip in enumerate(clips):
        if i and len(silence):
            parts.append(silence)
        x, source = decode(clip)
        parts.append(resampled(x, source, rate, method))
    return encode_pcm16(np.concatenate(parts), rate)
