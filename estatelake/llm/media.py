"""Media columns: texts as ISO base media files, walked without decoding their payload.

A payload (UTF-8 bytes, filled up with spaces to a positive multiple of 192) becomes an uncompressed
video track: frames of 16 x 12 eight-bit grey samples, 25 a second, every 24th marked as a sync
sample. The reader works on any ISO media file: it walks nested boxes (also those of 64-bit size or
that reach to the end), decodes the sample tables (stts, stsc, stsz, stco or co64, stss) and gives codec,
duration and the byte ranges of keyframes; ``payload`` joins the samples by these tables.

The media are stored as a Parquet column in the shared folder; digests are computed from what is
read back. Equal texts give equal files (all times are 0).

Defined cases: null counts as empty, which is one frame of spaces; a text of any length is one file; repeated rows give
repeated results; an empty table gives an empty result; extra columns are ignored. Bytes that are no media file give a
null codec and no ranges. A table's own count is not believed beyond the bytes that it has, nor samples beyond the file's
(a track that claims more bytes than there are has none), so that no file takes more memory than some times its own length;
boxes may nest to any depth.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from estatelake.llm.common import lean, slices, staged

WIDTH, HEIGHT, FPS, SYNC_EVERY, CHUNK_FRAMES = 16, 12, 25, 24, 64
FRAME = WIDTH * HEIGHT
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"moof", b"traf", b"mvex"}
MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


# -- writing --------------------------------------------------------------------------------------


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def full_box(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", flags), *parts)


def padded(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, payload)"""
    data = (text or "").encode("utf-8", "surrogatepass")
    return len(data), data.ljust(max(1, -(-len(data) // FRAME)) * FRAME, b" ")


def write_media(payload: bytes) -> bytes:
    frames = len(payload) // FRAME
    chunks = -(-frames // CHUNK_FRAMES)
    last = frames - (chunks - 1) * CHUNK_FRAMES
    runs = [(1, CHUNK_FRAMES, 1)] * (chunks > 1 or last == CHUNK_FRAMES)
    if last != CHUNK_FRAMES:
        runs.append((chunks, last, 1))
    sync = range(1, frames + 1, SYNC_EVERY)
    ftyp = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"mp41")
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">2H", WIDTH, HEIGHT), struct.pack(">2I", 0x480000, 0x480000), bytes(4), struct.pack(">H", 1), bytes(32), struct.pack(">Hh", 40, -1))

    def moov(first: int) -> bytes:
        stbl = box(
            b"stbl",
            full_box(b"stsd", struct.pack(">I", 1), entry),
            full_box(b"stts", struct.pack(">3I", 1, frames, 1)),
            full_box(b"stss", struct.pack(f">{len(sync) + 1}I", len(sync), *sync)),
            full_box(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">3I", *r) for r in runs)),
            full_box(b"stsz", struct.pack(">2I", FRAME, frames)),
            full_box(b"stco", struct.pack(f">{chunks + 1}I", chunks, *range(first, first + chunks * CHUNK_FRAMES * FRAME, CHUNK_FRAMES * FRAME))),
        )
        dinf = box(b"dinf", full_box(b"dref", struct.pack(">I", 1), full_box(b"url ", flags=1)))
        minf = box(b"minf", full_box(b"vmhd", bytes(8), flags=1), dinf, stbl)
        mdia = box(b"mdia", full_box(b"mdhd", struct.pack(">4I2H", 0, 0, FPS, frames, 0x55C4, 0)), full_box(b"hdlr", bytes(4), b"vide", bytes(12), b"\0"), minf)
        tkhd = full_box(b"tkhd", struct.pack(">5I", 0, 0, 1, 0, frames), bytes(16), MATRIX, struct.pack(">2I", WIDTH << 16, HEIGHT << 16), flags=3)
        mvhd = full_box(b"mvhd", struct.pack(">4I", 0, 0, FPS, frames), struct.pack(">IH", 0x10000, 0x100), bytes(10), MATRIX, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    head = ftyp + moov(len(ftyp) + len(moov(0)) + 8)
    return head + box(b"mdat", payload)


# -- reading --------------------------------------------------------------------------------------


def walk(data: memoryview) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path of box kinds, start and end of the body) of each box, depth first. A size beyond the parent is cut. Paths hold
    the ``DEEP`` innermost kinds."""
    open_ = [(0, len(data), ())]
    while open_:
        start, end, path = open_.pop()
        if start + 8 > end:
            continue
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1 and start + 16 <= end:
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else min(end, start + size)
        if stop < body:
            continue
        here = (*path, kind)[-DEEP:]
        yield here, body, stop
        open_.append((stop, end, path))
        if kind in CONTAINERS:
            open_.append((body, stop, here))


DEEP = 8
_NONE = np.zeros(0, np.int64)


def _numbers(view: memoryview, at: int, end: int, n: int, kind: str = ">u4", columns: int = 1) -> np.ndarray:
    """n rows of a table of numbers, or as many as there are bytes for."""
    width = np.dtype(kind).itemsize
    n = max(0, min(n, (end - at) // (width * columns)))
    return np.frombuffer(view, kind, n * columns, at).astype(np.int64).reshape(n, columns) if n else np.zeros((0, columns), np.int64)


@dataclass
class Track:
    number: int = 0
    codec: str | None = None
    width: int = 0
    height: int = 0
    timescale: int = 0
    duration: int = 0
    sizes: np.ndarray = field(default_factory=lambda: _NONE)
    fixed: tuple[int, int] | None = None  # (size, samples), where all have one size
    chunks: np.ndarray = field(default_factory=lambda: _NONE)
    runs: np.ndarray = field(default_factory=lambda: np.zeros((0, 3), np.int64))  # first chunk, samples in each
    sync: np.ndarray | None = None
    fragments: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # offsets, sizes, sync or not
    file_bytes: int = 0

    @property
    def claimed(self) -> int:
        return self.fixed[1] if self.fixed else len(self.sizes)

    @cached_property
    def samples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, sizes, sync or not) of all samples in order, from the chunk and size tables and the fragments. Read it
        when all boxes have been."""
        offset, size = self._table()
        sync = self._sync(len(offset))
        if self.fragments:
            offset, size, sync = (np.concatenate(x) for x in zip((offset, size, sync), *self.fragments, strict=True))
        if len(offset) and (offset.min() < 0 or size.min() < 0 or size.sum() > self.file_bytes or (offset + size).max() > self.file_bytes):
            return _NONE, _NONE, np.zeros(0, bool)
        return offset, size, sync

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        n = self.claimed
        if not len(self.chunks) or not len(self.runs) or (self.fixed and self.fixed[0] * n > self.file_bytes):
            return _NONE, _NONE
        # samples in each chunk: of the last run that starts at it or before, no more than are left in all
        run = np.searchsorted(self.runs[:, 0], np.arange(1, len(self.chunks) + 1), side="right") - 1
        in_chunk = np.where(run >= 0, np.clip(self.runs[np.maximum(run, 0), 1], 0, n), 0)
        upto = np.minimum(np.cumsum(in_chunk), n)
        in_chunk = np.diff(upto, prepend=0)
        total = int(upto[-1])
        sizes = np.full(total, self.fixed[0], np.int64) if self.fixed else self.sizes[:total]
        ends = np.cumsum(sizes)
        first = upto - in_chunk
        before = np.repeat(np.concatenate([[0], ends])[first], in_chunk)
        return np.repeat(self.chunks, in_chunk) + (ends - sizes) - before, sizes

    def _sync(self, n: int) -> np.ndarray:
        """Without a sync table every sample is one."""
        if self.sync is None:
            return np.ones(n, bool)
        out = np.zeros(n + 1, bool)
        out[self.sync[(self.sync >= 1) & (self.sync <= n)]] = True
        return out[1:]

    def keyframes(self) -> np.ndarray:
        """Byte ranges [start, end) of sync samples, two columns."""
        offset, size, sync = self.samples
        return np.stack([offset[sync], offset[sync] + size[sync]], axis=1)


def _fragment(view: memoryview, track: Track, default: list[int], head: dict, a: int, b: int) -> None:
    """Add the samples of a trun box (body a to b) by the defaults of its track and of its tfhd."""
    flags, n = struct.unpack_from(">2I", view, a)
    at = a + 8
    offset, first = 0, None
    if flags & 1:
        (offset,) = struct.unpack_from(">i", view, at)
        at += 4
    if flags & 4:
        (first,) = struct.unpack_from(">I", view, at)
        at += 4
    fields = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
    rows = _numbers(view, at, b, n, columns=len(fields)) if fields else None
    count = n if rows is None else len(rows)
    of = lambda bit, otherwise: rows[:, fields.index(bit)] if bit in fields else np.full(count, otherwise, np.int64)
    size = head.get("size", default[1])
    if rows is None and size * n > track.file_bytes or (not size and rows is None):
        return
    sizes, marks = of(0x200, size), of(0x400, head.get("flags", default[2]))
    if first is not None and count:
        marks = np.concatenate([[first], marks[1:]])
    begin = head["base"] + offset if flags & 1 else head.get("next", head["base"])
    ends = np.cumsum(sizes)
    head["next"] = begin + int(ends[-1]) if count else begin
    track.fragments.append((begin + ends - sizes, sizes, marks & 0x10000 == 0))
    track.duration += int(of(0x100, head.get("duration", default[0])).sum())


def tables(data: bytes) -> list[Track]:
    """The tracks of a file, from its boxes only."""
    view, out = memoryview(data), []
    defaults: dict[int, list[int]] = {}
    moof, head = 0, {}
    for path, a, b in walk(view):
        kind = path[-1]
        if kind == b"trak":
            out.append(Track(file_bytes=len(data)))
        elif kind == b"moof":
            moof = a - 8
        elif kind == b"trex" and b - a >= 24:
            track, _, *rest = struct.unpack_from(">5I", view, a + 4)
            defaults[track] = rest
        elif kind == b"tfhd" and b - a >= 8:
            flags, track = struct.unpack_from(">2I", view, a)
            head, at = {"track": track, "base": moof}, a + 8
            for bit, name, width in ((1, "base", 8), (2, "entry", 4), (8, "duration", 4), (16, "size", 4), (32, "flags", 4)):
                if flags & bit and at + width <= b:
                    head[name] = int.from_bytes(view[at : at + width], "big")
                    at += width
        elif kind == b"trun" and b - a >= 8 and head:
            t = next((t for t in out if t.number == head["track"]), None)
            if t is not None:
                _fragment(view, t, defaults.get(t.number, [0, 0, 0]), head, a, b)
        if not out or b"trak" not in path or b - a < 8:
            continue
        t = out[-1]
        ints = lambda at, n: struct.unpack_from(f">{n}I", view, at)  # noqa: B023, E731
        table = lambda kind=">u4", columns=1: _numbers(view, a + 8, b, ints(a + 4, 1)[0], kind, columns)  # noqa: B023, E731
        if kind == b"tkhd" and b - a >= 24:
            (t.number,) = ints(a + (20 if view[a] == 1 else 12), 1)
        elif kind == b"mdhd" and b - a >= (32 if view[a] == 1 else 20):
            t.timescale, t.duration = struct.unpack_from(">IQ", view, a + 20) if view[a] == 1 else ints(a + 12, 2)
        elif kind == b"stsd" and b - a >= 16:
            t.codec = bytes(view[a + 12 : a + 16]).decode("latin-1").strip()
            if b - a >= 44:
                t.width, t.height = struct.unpack_from(">2H", view, a + 8 + 32)
        elif kind == b"stts" and not t.duration:
            t.duration = sum(n * d for n, d in table(columns=2).tolist())
        elif kind == b"stss":
            t.sync = table().reshape(-1)
        elif kind == b"stsc":
            t.runs = table(columns=3)
        elif kind == b"stsz" and b - a >= 12:
            size, n = ints(a + 4, 2)
            if size:
                t.fixed = size, n
            else:
                t.sizes = _numbers(view, a + 12, b, n).reshape(-1)
        elif kind == b"stco":
            t.chunks = table().reshape(-1)
        elif kind == b"co64":
            t.chunks = table(">u8").reshape(-1)
    return out


def read_tables(data: bytes) -> list[Track]:
    """The tracks of any bytes; none where boxes are cut off in their middle."""
    try:
        return tables(data)
    except struct.error:
        return []


def payload(data: bytes, track: Track) -> bytes:
    """The samples one after another."""
    offset, size, _ = track.samples
    if not len(offset):
        return b""
    # samples that follow one another are taken at once
    cut = np.flatnonzero(offset[1:] != offset[:-1] + size[:-1]) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(offset)]]) - 1
    return b"".join(data[a:b] for a, b in zip(offset[first].tolist(), (offset[last] + size[last]).tolist(), strict=True))


# -- the Spark jobs -------------------------------------------------------------------------------


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            made = [padded(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for n, _ in made], pa.int64()), pa.array([write_media(p) for _, p in made], pa.binary())], names=["doc_id", "n_bytes", "media"])


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: a file for each text. No shuffle."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(lean(_store), "doc_id long, n_bytes long, media binary")


PROBE = "codec string, width int, height int, samples long, duration_ms long, keyframes array<struct<start:long,end:long>>"
_PROBE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _probed(data: bytes) -> tuple[Track, np.ndarray]:
    tracks = read_tables(data)
    t = next((t for t in tracks if t.width), tracks[0] if tracks else Track())
    return t, t.keyframes()


def _samples(t: Track) -> int:
    return len(t.samples[0])


def probe_media(media: DataFrame, media_col: str = "media", id_col: str = "doc_id") -> DataFrame:
    """Codec, frame size, samples, duration and keyframe byte ranges of each file; payloads are not touched."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "media"):
                found = [_probed(x or b"") for x in batch.column("media").to_pylist()]
                ms = [t.duration * 1000 // t.timescale if t.timescale else None for t, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([t.codec for t, _ in found], pa.string()), pa.array([t.width for t, _ in found], pa.int32()), pa.array([t.height for t, _ in found], pa.int32()), pa.array([_samples(t) for t, _ in found], pa.int64()), pa.array(ms, pa.int64()), pa.array([[{"start": a, "end": b} for a, b in k.tolist()] for _, k in found], _PROBE)],
                    names=["doc_id", "codec", "width", "height", "samples", "duration_ms", "keyframes"],
                )

    return media.select(media[id_col].cast("long").alias("doc_id"), media[media_col].alias("media")).mapInArrow(lean(task), "doc_id long, " + PROBE)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def feature(t: Track, keys: np.ndarray) -> str:
    ranges = hashlib.sha256(keys.astype(">u8").tobytes()).hexdigest()[:16]
    first, last = (f"{k[0]}-{k[1]}" for k in (keys[0], keys[-1])) if len(keys) else ("", "")
    return f"codec={t.codec};size={t.width}x{t.height};samples={_samples(t)};duration_ms={t.duration * 1000 // t.timescale if t.timescale else 0};keyframes={len(keys)};first={first};last={last};ranges={ranges}"


def _digest() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in DIGEST.split(", ")]
        for whole in batches:
            for batch in slices(whole, "media"):
                rows = []
                for data in batch.column("media").to_pylist():
                    track, keys = _probed(data)
                    back = payload(data, track)
                    rows.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature(track, keys)))
                kinds = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()
                columns = zip(*rows, strict=True) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return task


def media_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the media in the shared folder, read them back and digest what was read."""
    return staged(to_media(docs, id_col, text_col), "media").mapInArrow(lean(_digest()), DIGEST)
