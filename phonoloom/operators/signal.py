"""Signal features: noise floors, band energies, class scores, cuts of long media, and PCM WAV conversion.

Columns of samples are arrays; the array path is built-in expressions. Bytes of PCM WAV files go through Arrow-batched numpy.
Other codecs need a decoder: ``decoder`` arguments take one; none is bundled.
"""

from __future__ import annotations

import io
import random
import wave
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phonoloom.functions.numbers import decibels

# Bands in Hz, both bounds included.
BANDS = {"low_hum": (0, 85), "speech": (85, 600), "high_hum": (600, 44_100)}


def centred(samples: Column, frame: int) -> Column:
    """Samples between half a frame of silence on both sides, so that frames stand around their times."""
    pad = F.array_repeat(F.lit(0.0), frame // 2)
    return F.concat(pad, samples.cast("array<double>"), pad)


def frame_rms(samples: Column, frame: int, hop: int) -> Column:
    """Root mean square of each whole frame."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(samples) - frame + 1, F.lit(1)), F.lit(hop))
    square = lambda a, x: a + x.cast("double") * x.cast("double")
    return F.transform(starts, lambda i: F.sqrt(F.aggregate(F.slice(samples, i, frame), F.lit(0.0), square) / F.lit(float(frame))))


def percentile_of(values: Column, share: float) -> Column:
    """Percentile of an array with linear interpolation."""
    ordered = F.array_sort(values)
    at = F.lit(share) * (F.size(values) - 1)
    low = F.floor(at).cast("int")
    a, b = F.get(ordered, low), F.get(ordered, F.least(low + 1, F.size(values) - 1))
    return a + (b - a) * (at - low)


def noise_level(samples: Column, frame: int = 2048, hop: int = 512) -> Column:
    """Decibels of the 10th percentile of the levels of centred frames."""
    return decibels(percentile_of(frame_rms(centred(samples, frame), frame, hop), 0.1))


def worst_of_two(samples: Column, length: int, frame: int, hop: int) -> Column:
    """The louder noise floor of the first and the last ``length`` samples."""
    return F.greatest(noise_level(F.slice(samples, 1, length), frame, hop), noise_level(F.slice(samples, -F.least(F.size(samples), F.lit(length)), length), frame, hop))


def band_energy(df: DataFrame, key: str, spectrum: str, hz_per_bin: float) -> DataFrame:
    """``key, label, low, high, energy, ratio`` of each band: bins are matched to bands by a range test on a fixed table of
    bands inside the row, both bounds included, so a bin on a bound counts in both."""
    total = F.aggregate(spectrum, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    power = F.transform(spectrum, lambda x, i: F.struct((i * F.lit(hz_per_bin)).alias("f"), (x.cast("double") * x.cast("double")).alias("e")))
    def band(label: str, low: int, high: int) -> Column:
        inside = F.filter(power, lambda p: p["f"].between(low, high))
        energy = F.aggregate(inside, F.lit(0.0), lambda a, p: a + p["e"])
        return F.struct(F.lit(label).alias("label"), F.lit(low).alias("low"), F.lit(high).alias("high"), energy.alias("energy"))

    rows = [band(label, low, high) for label, (low, high) in BANDS.items()]
    out = df.select(key, total.alias("total"), F.inline(F.array(*rows)))
    return out.select(key, "label", "low", "high", F.round("energy", 6).alias("energy"), F.round(F.when(F.col("total") > 0, F.col("energy") / F.col("total")).otherwise(0.0), 6).alias("ratio"))


def class_means(df: DataFrame, group: str, scores: str) -> DataFrame:
    """``group, class, score``: the mean of each class over the group's frames."""
    rows = df.select(group, F.posexplode(scores).alias("class", "score"))
    return rows.groupBy(group, "class").agg(F.round(F.avg(F.col("score").cast("double")), 6).alias("score"))


def top_classes(means: DataFrame, group: str, n: int = 5) -> DataFrame:
    order = Window.partitionBy(group).orderBy(F.col("score").desc(), "class")
    return means.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def media_parts(df: DataFrame, key: str, seconds: str, longest: float) -> DataFrame:
    """``key, part, from_s, to_s`` of media longer than ``longest``; parts count from 1. Null and 0 lengths have none."""
    rows = df.filter(F.col(seconds) > longest).select(key, F.col(seconds).alias("s"), F.explode(F.sequence(F.lit(1), F.ceil(F.col(seconds) / longest).cast("int"))).alias("part"))
    return rows.select(key, "part", (F.lit(longest) * (F.col("part") - 1)).alias("from_s"), F.least(F.lit(longest) * F.col("part"), F.col("s")).alias("to_s"))


def read_bytes(path: str) -> bytes:
    return Path(path).read_bytes()


def read_wav(content: bytes) -> tuple[np.ndarray, int, int]:
    """Samples (frames x channels, -1 to 1), rate and sample width of a PCM WAV file."""
    with wave.open(io.BytesIO(content)) as w:
        width, raw = w.getsampwidth(), w.readframes(w.getnframes())
        if width == 1:
            x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
        elif width == 3:
            b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
            x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float64) / (1 << 23)
        else:
            x = np.frombuffer(raw, {2: np.int16, 4: np.int32}[width]).astype(np.float64) / (1 << (8 * width - 1))
        return x.reshape(-1, w.getnchannels()), w.getframerate(), width


def write_wav(samples: np.ndarray, rate: int, width: int = 2) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(samples.shape[1])
        w.setsampwidth(width)
        w.setframerate(rate)
        whole = np.clip(np.round(samples * (1 << (8 * width - 1))), -(1 << (8 * width - 1)), (1 << (8 * width - 1)) - 1)
        if width == 1:
            w.writeframes((whole + 128).astype(np.uint8).tobytes())
        elif width == 3:
            w.writeframes(whole.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes())
        else:
            w.writeframes(whole.astype({2: "<i2", 4: "<i4"}[width]).tobytes())
    return out.getvalue()


def low_pass(mono: np.ndarray, cut: float, taps: int = 63) -> np.ndarray:
    """Without frequencies above ``cut``, a part of the sampling rate: a windowed sinc filter."""
    k = np.arange(taps) - taps // 2
    kernel = 2 * cut * np.sinc(2 * cut * k) * np.hamming(taps)
    return np.convolve(mono, kernel / kernel.sum(), "same") if len(mono) >= taps else mono


def convert(samples: np.ndarray, rate: int, to_rate: int, channels: int) -> np.ndarray:
    """Linear resampling, behind a low pass where the rate falls, and mixing to one or several equal channels."""
    mono = samples.mean(1)
    if to_rate < rate:
        mono = low_pass(mono, 0.5 * to_rate / rate)
    n = max(1, round(len(mono) * to_rate / rate)) if len(mono) else 0
    x = np.interp(np.arange(n) * rate / to_rate, np.arange(len(mono)), mono) if n and rate != to_rate else mono
    return np.repeat(x[:, None], channels, axis=1)


def convert_files(
    df: DataFrame, path: str, content: str, rate: int = 24_000, width: int = 2, channels: int = 1, decoder: Callable = read_wav, encoder: Callable = write_wav
) -> DataFrame:
    """``path, status, error, content``: conforming files are copied, others converted; a bad file is a status, not a failure.

    ``decoder(bytes)`` gives samples, rate and width; ``encoder(samples, rate, width)`` gives the bytes of the wanted format."""

    def one(data: bytes) -> tuple[str, str | None, bytes | None]:
        try:
            samples, r, w = decoder(data)
            if encoder is write_wav and decoder is read_wav and (r, w, samples.shape[1]) == (rate, width, channels):
                return "copied", None, data
            return "converted", None, encoder(convert(samples, r, rate, channels), rate, width)
        except Exception as e:  # noqa: BLE001
            return "error", f"{type(e).__name__}: {e}", None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [one(bytes(c)) if c is not None else ("error", "no content", None) for c in b["content"]]
            yield pd.DataFrame({"path": b["path"], "status": [g[0] for g in got], "error": [g[1] for g in got], "content": [g[2] for g in got]})

    return df.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInPandas(run, "path string, status string, error string, content binary")


def wav_seconds(content: Column, on_error: str = "null") -> Column:
    """Length in seconds of PCM WAV bytes. What cannot be read is null, or 0 with ``on_error='zero'``, or ends the query with
    ``on_error='fail'``."""
    if on_error not in ("null", "zero", "fail"):
        raise ValueError("on_error is null, zero or fail")

    @F.pandas_udf("double")
    def seconds(data: pd.Series) -> pd.Series:
        def one(c: bytes | None) -> float | None:
            try:
                with wave.open(io.BytesIO(bytes(c))) as w:
                    return w.getnframes() / w.getframerate()
            except Exception:
                if on_error == "fail":
                    raise
                return 0.0 if on_error == "zero" else None

        return data.map(one)

    return seconds(content)


def window_of(length: float, wanted: float, where: str = "first", draw: float = 0.0) -> tuple[float, float] | None:
    """Start and end in seconds of a window of a recording: its first or last part (the whole of a shorter one), or one that
    begins at the part ``draw`` of what is left; a shorter recording has no random window."""
    if where == "random":
        return (draw * (length - wanted), draw * (length - wanted) + wanted) if length >= wanted else None
    start = max(0.0, length - wanted) if where == "last" else 0.0
    return start, min(length, start + wanted)


def decoded(content: bytes, offset: float = 0.0, duration: float | None = None, decoder: Callable = read_wav) -> tuple[np.ndarray, int, int]:
    """Samples from ``offset`` on, for ``duration`` seconds or to the end, with rate and sample width."""
    samples, rate, width = decoder(content)
    a = round(offset * rate)
    return samples[a : None if duration is None else a + round(duration * rate)], rate, width


def stft_energy(samples: np.ndarray, rate: int, size: int = 2048, hop: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and, for each, the squared magnitudes summed over all frames of a short-time Fourier transform of one channel:
    centred frames, a periodic Hann window. Frames are transformed in blocks, so memory does not grow with the recording."""
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    padded = np.concatenate([np.zeros(size // 2), samples, np.zeros(size // 2)])
    frames = np.lib.stride_tricks.sliding_window_view(padded, size)[::hop]
    energy = np.zeros(size // 2 + 1)
    for k in range(0, len(frames), 256):
        energy += (np.abs(np.fft.rfft(frames[k : k + 256] * window, axis=1)) ** 2).sum(0)
    return np.arange(size // 2 + 1) * rate / size, energy


def energies(samples: np.ndarray, rate: int) -> tuple[float, dict[str, float]]:
    """Total energy, and that of each of ``BANDS``, both bounds included."""
    frequency, energy = stft_energy(samples, rate)
    return float(energy.sum()), {label: float(energy[(frequency >= a) & (frequency <= b)].sum()) for label, (a, b) in BANDS.items()}


def _per_file(df: DataFrame, path: str, content: str, one: Callable, shape: str) -> DataFrame:
    """``path`` and the rows that ``one(path, bytes)`` gives; a file that cannot be read is one row with its ``error``."""
    names = [f.split()[0] for f in shape.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, c in zip(b["path"], b["content"]):
                try:
                    if c is None:
                        raise ValueError("no content")
                    rows += [(p, *r, None) for r in one(p, bytes(c))]
                except Exception as e:  # noqa: BLE001
                    rows.append((p, *[None] * len(names), f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", *names, "error"])

    rows = df.select(F.col(path).alias("path"), F.col(content).alias("content"))
    return rows.mapInPandas(run, f"path string, {shape}, error string")


def file_bands(df: DataFrame, path: str, content: str, decoder: Callable = read_wav) -> DataFrame:
    """``path, duration_sec, sampling_rate, total_energy, label, low, high, energy, ratio, error``: the bands of whole recordings."""

    def one(_: str, data: bytes) -> list[tuple]:
        samples, rate, _ = decoder(data)
        total, bands = energies(samples.mean(1), rate)
        return [(len(samples) / rate, rate, total, k, *BANDS[k], e, e / total if total > 0 else 0.0) for k, e in bands.items()]

    return _per_file(df, path, content, one, "duration_sec double, sampling_rate int, total_energy double, label string, low int, high int, energy double, ratio double")


def file_noise(df: DataFrame, path: str, content: str, least: float = 1.0, part: float = 30.0, decoder: Callable = read_wav) -> DataFrame:
    """``path, noise_db, error``: the noise floor of recordings of at least ``least`` seconds, the worse one of the first and the
    last part of those that are longer than a part."""

    def level(samples: np.ndarray, frame: int = 2048, hop: int = 512) -> float:
        padded = np.concatenate([np.zeros(frame // 2), samples, np.zeros(frame // 2)])
        power = np.concatenate([[0.0], np.cumsum(padded * padded)])
        starts = np.arange(0, len(padded) - frame + 1, hop)
        rms = np.sqrt(np.maximum(power[starts + frame] - power[starts], 0) / frame)
        return 20 * float(np.log10(np.percentile(rms, 10) + 1e-6))

    def one(_: str, data: bytes) -> list[tuple]:
        samples, rate, _ = decoder(data)
        mono, length = samples.mean(1), len(samples) / rate
        if length < least:
            return []
        windows = {window_of(length, part, w) for w in ("first", "last")}
        return [(max(level(mono[round(a * rate) : round(b * rate)]) for a, b in windows),)]

    return _per_file(df, path, content, one, "noise_db double")


def energy_ratio(unfiltered: Column, filtered: Column) -> Column:
    """Energy before a filter for each part of it behind the filter; null if nothing is left."""
    return F.when(filtered > 0, unfiltered / filtered)


def above(ratio: Column, most: float = 1.1) -> Column:
    """True where a ratio is known and above the most."""
    return F.coalesce(ratio > most, F.lit(False))


def speech_energy_ratios(df: DataFrame, path: str, content: str, suppress: Callable, length: float = 30.0, seed: int = 0, decoder: Callable = read_wav) -> DataFrame:
    """``path, speech_energy_ratio, error`` of a random window of each recording that is long enough: the speech band's energy
    before and behind ``suppress(samples, rate)``, a noise filter that is plugged in. The window depends on seed and path only."""

    def one(p: str, data: bytes) -> list[tuple]:
        samples, rate, _ = decoder(data)
        mono = samples.mean(1)
        at = window_of(len(mono) / rate, length, "random", random.Random(f"{seed}|{p}").random())
        if at is None:
            return []
        part = mono[round(at[0] * rate) : round(at[1] * rate)]
        return [(energies(part, rate)[1]["speech"], energies(np.asarray(suppress(part, rate)), rate)[1]["speech"])]

    rows = _per_file(df, path, content, one, "unfiltered double, filtered double")
    return rows.select("path", energy_ratio(F.col("unfiltered"), F.col("filtered")).alias("speech_energy_ratio"), "error")


def slice_wav(content: bytes, start_ms: int, end_ms: int) -> bytes | None:
    """The part of a PCM WAV file between two times; None if the start is not before the end."""
    samples, rate, width = read_wav(content)
    a, b = start_ms * rate // 1000, min(end_ms * rate // 1000, len(samples))
    return write_wav(samples[a:b], rate, width) if a < b else None


def cut_files(df: DataFrame, media: str, chunks: str, least_ms: int = 200, read: Callable = read_bytes, cutter: Callable = slice_wav) -> DataFrame:
    """``*others, media, no, start_ms, end_ms, text, status, error, audio`` of each chunk of the column ``chunks``.

    ``read(media)`` gives a recording's bytes where it is cut, once for all its chunks: contents are never moved between
    workers. The status is ``invalid`` if the start is not before the end (or the end of the recording), ``short`` below the
    least, ``error`` for what cannot be read, else ``kept``; only that has bytes."""
    others = [c for c in df.columns if c not in (media, chunks)]
    made = "media string, no int, start_ms bigint, end_ms bigint, text string, status string, error string, audio binary"
    shape = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in others), made])

    def one(data: bytes, a, b) -> tuple[str, str | None, bytes | None]:
        if a is None or b is None:
            return "invalid", None, None
        try:
            part = cutter(data, int(a), int(b))
            if part is None:
                return "invalid", None, None
            samples, rate, _ = read_wav(part)
            return ("short", None, None) if len(samples) * 1000 < least_ms * rate else ("kept", None, part)
        except Exception as e:  # noqa: BLE001
            return "error", f"{type(e).__name__}: {e}", None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            # One recording at a time: what is held is its bytes and those of its chunks.
            for row in b.to_dict("records"):
                try:
                    data, failed = read(row[media]), None
                except Exception as e:  # noqa: BLE001
                    data, failed = b"", ("error", f"{type(e).__name__}: {e}", None)
                found = [(no, c["start_ms"], c["end_ms"], c["text"], *(failed or one(data, c["start_ms"], c["end_ms"]))) for no, c in enumerate(row[chunks])]
                yield pd.DataFrame([(*(row[c] for c in others), row[media], *f) for f in found], columns=[*others, "media", "no", "start_ms", "end_ms", "text", "status", "error", "audio"])

    return df.select(*others, media, chunks).mapInPandas(run, shape)
