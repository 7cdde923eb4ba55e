"""Audio features of payload bytes, stored as fixed-shape Arrow tensors with time spans.

A text's UTF-8 bytes, zero-filled to a positive multiple of 64, are the 8-bit samples of a mono WAV
file. The file is written to a media column and read back; every feature comes from the bytes read.
The samples are resampled by a polyphase windowed-sinc filter, cut into overlapping Hann frames and
turned into log-mel energies. Segments come from frame energies with hysteresis: one opens above
the upper threshold and lasts until the energy falls below the lower one. Tensors of SHAPE frames x mel
bands cover the signal in order, each with its time span; the last is filled with the floor value. They are written
to Arrow files as a fixed-shape tensor column, and the features are computed from what these files hold.

Cases: null counts as empty text, whose payload is 64 zero bytes; equal texts give equal values;
very long texts are processed in pieces whose joins do not show in the result; repeated rows and null doc_ids are
rows of their own; ties do not matter; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import resolved, scratch, sliced, stored, utf8

RATE = 8000
UP, DOWN = 3, 4
TAPS = 24
FRAME, HOP = 256, 128
MELS = 16
SHAPE = (16, MELS)
OPEN_DB, CLOSE_DB = -18.0, -24.0
FLOOR = np.float32(-100.0)
PIECE = 1 << 16
BATCH_BYTES = 1 << 20


def payload(raw: bytes) -> bytes:
    """raw with zero bytes up to a positive multiple of 64."""
    return raw + bytes(-len(raw) % 64 if raw else 64)


def to_wav(samples: bytes) -> bytes:
    """The samples as an 8-bit mono WAV file."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(samples)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    """The samples of a WAV file written by to_wav."""
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def _phases() -> np.ndarray:
    """(UP, TAPS) phases of a Hann-windowed sinc low-pass filter."""
    n = UP * TAPS
    t = np.arange(n) - (n - 1) / 2
    cut = 1 / max(UP, DOWN)
    h = cut * np.sinc(cut * t) * np.hanning(n + 2)[1:-1] * UP
    return h.reshape(TAPS, UP).T.astype(np.float32)


def _mel_bank() -> np.ndarray:
    """(FRAME / 2 + 1, MELS) triangular filters, evenly spaced in mel."""
    rate = RATE * UP / DOWN
    mel = np.linspace(0, 2595 * np.log10(1 + rate / 2 / 700), MELS + 2)
    hz = 700 * (10 ** (mel / 2595) - 1)
    f = np.arange(FRAME // 2 + 1)[:, None] * rate / FRAME
    rise, fall = (f - hz[:-2]) / np.diff(hz)[:-1], (hz[2:] - f) / np.diff(hz)[1:]
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


PHASES, BANK, WINDOW = _phases(), _mel_bank(), np.hanning(FRAME).astype(np.float32)


def resample(x: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Outputs lo to hi of the resampled signal; output k is centred on sample k * DOWN / UP."""
    if hi <= lo:
        return np.empty(0, np.float32)
    first = lo * DOWN // UP - TAPS // 2 + 1
    last = (hi - 1) * DOWN // UP + TAPS // 2 + 1
    part = np.zeros(last - first, np.float32)
    a, b = max(first, 0), min(last, len(x))
    if a < b:
        part[a - first : b - first] = x[a:b]
    view = np.lib.stride_tricks.sliding_window_view(part, TAPS)
    out = np.empty(hi - lo, np.float32)
    # Outputs UP apart use one phase of the filter, at samples DOWN apart.
    for k in range(lo, min(hi, lo + UP)):
        rows = view[k * DOWN // UP - TAPS // 2 + 1 - first :: DOWN][: len(range(k, hi, UP))]
        out[k - lo :: UP] = rows @ PHASES[k * DOWN % UP][::-1]
    return out


def log_mel(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(frames, MELS) log-mel energies in dB and each frame's energy in dB."""
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    total = -(-len(x) * UP // DOWN)
    frames = max(1, -(-(total - FRAME) // HOP) + 1)
    mels, energy = np.empty((frames, MELS), np.float32), np.empty(frames, np.float32)
    step = PIECE // HOP
    for lo in range(0, frames, step):
        hi = min(frames, lo + step)
        a, b = lo * HOP, (hi - 1) * HOP + FRAME
        y = np.zeros(b - a, np.float32)
        y[: min(b, total) - a] = resample(x, a, min(b, total))
        cut = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
        # float32 sums may depend on the number of rows at once; doubles rounded to 3 places do not.
        power = np.abs(np.fft.rfft(cut * WINDOW)) ** 2
        mels[lo:hi] = np.round(10 * np.log10(power @ BANK.astype(np.float64) / FRAME + 1e-10), 3)
        energy[lo:hi] = np.round(10 * np.log10((cut.astype(np.float64) ** 2).mean(axis=1) + 1e-10), 3)
    return mels, energy


def segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Frame ranges that open at OPEN_DB and end below CLOSE_DB."""
    state = np.where(energy >= OPEN_DB, 1, np.where(energy < CLOSE_DB, 0, -1))
    known = np.flatnonzero(state >= 0)
    on = np.zeros(len(state) + 2, np.int8)
    if len(known):
        last = np.searchsorted(known, np.arange(len(state)), "right") - 1
        on[1:-1] = np.where(last >= 0, state[known[np.maximum(last, 0)]], 0)
    edge = np.diff(on)
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def tensors(mels: np.ndarray) -> np.ndarray:
    """(n, *SHAPE) consecutive pieces of the log-mel matrix, the last filled with FLOOR."""
    n = -(-len(mels) // SHAPE[0])
    out = np.full((n * SHAPE[0], MELS), FLOOR, np.float32)
    out[: len(mels)] = mels
    return out.reshape(n, *SHAPE)


def tensor_column(parts: np.ndarray) -> pa.ExtensionArray:
    """The pieces as an Arrow fixed-shape tensor array."""
    return pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(parts))


def span(first: int, last: int) -> tuple[float, float]:
    """Seconds covered by frames first to last (exclusive)."""
    per = HOP * DOWN / UP / RATE
    return first * per, ((last - 1) * HOP + FRAME) * DOWN / UP / RATE


def encode(docs: DataFrame) -> DataFrame:
    """The stored media column: doc_id, n_bytes, media (a WAV file)."""

    def run(batches):
        for part in sliced(batches, "text", BATCH_BYTES):
            raw, offsets = utf8(part.column(1))
            view = raw.tobytes()
            media = [to_wav(payload(view[a:b])) for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return stored(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, media binary"), "media")


#: A row of a tensor file: one tensor with its time span; what is said of the document stands in the row of its first tensor.
FILE_TYPE = pa.fixed_shape_tensor(pa.float32(), SHAPE)
FILE_SCHEMA = pa.schema([("number", pa.int64()), ("doc_id", pa.int64()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("tensor", FILE_TYPE), ("note", pa.string())])


def described(wav: bytes) -> tuple[np.ndarray, list[tuple[float, float]], dict]:
    """(tensors, their time spans, what is said of the document) of a stored file."""
    samples = from_wav(wav)
    mels, energy = log_mel(samples)
    parts = tensors(mels)
    times = [span(k * SHAPE[0], min(len(mels), (k + 1) * SHAPE[0])) for k in range(len(parts))]
    runs = [span(x, y) for x, y in segments(energy)]
    note = {
        "payload_bytes": len(samples),
        "payload_sha256": hashlib.sha256(samples).hexdigest(),
        "tail_crc32": zlib.crc32(samples[-64:]),
        "media_bytes": len(wav),
        "media_sha256": hashlib.sha256(wav).hexdigest(),
        "frames": len(mels),
        "segments": len(runs),
        "active_s": round(sum(b - a for a, b in runs), 3),
    }
    return parts, times, note


def write_tensors(media: DataFrame) -> list[str]:
    """Write the tensors of a media column as Arrow files below the shared folder; returns their names.

    A task writes under a name of its own, and only names that successful tasks report count.
    """
    folder = scratch(media.sparkSession, "tensors")

    def run(batches):
        writer, sink, name, number = None, None, None, 0
        for part in sliced(batches, "media", BATCH_BYTES):
            if writer is None:
                name = f"{folder}/part-{uuid.uuid4().hex}.arrow"
                fs, at = resolved(name)
                fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                sink = fs.open_output_stream(at, compression=None)
                writer = pa.ipc.new_file(sink, FILE_SCHEMA, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            ids, n_bytes = part.column(0).to_pylist(), part.column(1).to_pylist()
            rows, made = [], []
            for k, wav in enumerate(part.column(2).to_pylist()):
                parts, times, note = described(wav)
                notes = [json.dumps(note | {"n_bytes": n_bytes[k]}), *[None] * (len(parts) - 1)]
                rows += [(number + k, ids[k], a, b, text) for (a, b), text in zip(times, notes, strict=True)]
                made.append(parts)
            number += len(ids)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [FILE_SCHEMA.field(i).type for i in (0, 1, 2, 3, 5)], strict=True)]
            writer.write_batch(pa.RecordBatch.from_arrays([*columns[:4], tensor_column(np.concatenate(made)), columns[4]], schema=FILE_SCHEMA))
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["file"])

    return sorted(r["file"] for r in media.select("doc_id", "n_bytes", "media").mapInArrow(run, "file string").collect())


def _files(spark, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "k int, file string").repartition(max(1, len(names)), "k")


def _stored_tensors(name: str) -> Iterator[pa.RecordBatch]:
    fs, at = resolved(name)
    with fs.open_input_file(at) as source:
        reader = pa.ipc.open_file(source)
        for k in range(reader.num_record_batches):
            yield reader.get_batch(k)


PIECES_SCHEMA = "doc_id long, start_s double, end_s double, tensor array<float>, shape array<int>"


def pieces(spark, names: list[str]) -> DataFrame:
    """The tensors of Arrow files, a row for each, flattened with their shape and time span."""

    def run(batches):
        for batch in batches:
            for name in batch.column(1).to_pylist():
                for part in _stored_tensors(name):
                    flat = part.column(4).storage.cast(pa.list_(pa.float32()))
                    yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), part.column(3), flat, pa.array([list(SHAPE)] * part.num_rows, pa.list_(pa.int32()))], ["doc_id", "start_s", "end_s", "tensor", "shape"])

    return _files(spark, names).mapInArrow(run, PIECES_SCHEMA)


DESCRIBED_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_NOTED = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"]


def feature(note: dict, parts: np.ndarray) -> str:
    """What the stored tensors and segments of a document come to."""
    mean = parts.reshape(-1, MELS)[: note["frames"]].mean(axis=0, dtype=np.float64)
    digest = hashlib.sha256(np.ascontiguousarray(parts).tobytes()).hexdigest()[:16]
    return f"frames={note['frames']};tensors={len(parts)}x{SHAPE[0]}x{SHAPE[1]};segments={note['segments']};active_s={note['active_s']:.3f};mel={','.join(f'{v:.2f}' for v in mean)};sha={digest}"


def features(docs: DataFrame) -> DataFrame:
    """The digest of every document's stored media and of its tensors, read back from their files."""
    spark = docs.sparkSession
    names = write_tensors(encode(docs))
    if not names:
        return spark.createDataFrame([], DESCRIBED_SCHEMA)

    def run(batches):
        for batch in batches:
            for name in batch.column(1).to_pylist():
                for part in _stored_tensors(name):  # a batch holds whole documents
                    number, notes = np.asarray(part.column(0)), part.column(5).to_pylist()
                    values = part.column(4).to_numpy_ndarray()
                    head = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
                    said = [json.loads(notes[k]) for k in head]
                    told = [feature(n, values[a:b]) for n, a, b in zip(said, head, np.append(head[1:], len(number)), strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(head)), *(pa.array([n[c] for n in said]) for c in _NOTED), pa.array(told)], ["doc_id", *_NOTED, "feature"])

    return _files(spark, names).mapInArrow(run, DESCRIBED_SCHEMA)
