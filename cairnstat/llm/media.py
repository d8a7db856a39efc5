"""GIF columns: code streams, palettes, disposal, transparency, timed frames, colour histograms.

The decoder reads any GIF87a or GIF89a. A code stream is decoded a table at a time without a loop over codes: the width of
a code depends only on its number since the last clear, so all codes up to the next clear are cut out at once; the string of a code
is a copy of earlier output that starts where its parent was written, so the output is found by following
these references in doubling steps.
"""

from __future__ import annotations

import contextlib
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, table

WIDTH = 64
FRAME_ROWS = 512
BINS = 16
MOST_CODES = 4096
#: Larger pictures count as damaged (this one takes 256 MB).
MOST_PIXELS = 1 << 26


def lzw_codes(data: bytes, bits: int) -> list[int]:
    """Codes of the samples, each table opened by a clear and the last one closed by an end."""
    clear = 1 << bits
    codes = [clear]
    if data:
        known: dict[int, int] = {}
        get, add, free = known.get, codes.append, clear + 2
        at = data[0]
        for byte in data[1:]:
            found = get(at << 8 | byte)
            if found is not None:
                at = found
                continue
            add(at)
            if free < MOST_CODES:
                known[at << 8 | byte] = free
                free += 1
            else:
                add(clear)
                known.clear()
                free = clear + 2
            at = byte
        add(at)
    codes.append(clear + 1)
    return codes


def code_widths(n: int, bits: int) -> np.ndarray:
    """Width of code number 0, 1 ... since a clear."""
    known = (1 << bits) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.clip(np.floor(np.log2(known)).astype(np.int64) + 1, bits + 1, 12)


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    codes = np.array(lzw_codes(data, bits), np.int64)
    clears = np.flatnonzero(codes == 1 << bits)
    since = np.arange(len(codes)) - 1 - np.concatenate([np.repeat(clears, np.diff(np.r_[clears, len(codes)]))])
    widths = np.empty(len(codes), np.int64)
    widths[0] = bits + 1
    # a clear is the last code of the table before it, and the codes after it count from 0
    before = np.r_[0, since[:-1] + 1]
    number = np.where(codes == 1 << bits, before, since)
    widths[1:] = code_widths(int(number.max()) + 2, bits)[number[1:]]
    ends = np.cumsum(widths)
    stream = ((codes[:, None] >> np.arange(12)) & 1).astype(np.uint8)
    taken = stream[np.arange(12) < widths[:, None]]
    assert len(taken) == ends[-1]
    return np.packbits(taken, bitorder="little").tobytes()


def lzw_decode(stream: bytes, bits: int) -> np.ndarray:
    """Samples of a code stream; what follows the end, or a damaged code, is left out."""
    clear, end = 1 << bits, (1 << bits) + 1
    raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.int64)
    total, at, out = 8 * len(stream), 0, []
    reach = MOST_CODES + 8
    offsets = np.concatenate([[0], np.cumsum(code_widths(reach, bits))])
    while at + bits + 1 <= total:
        while True:
            where = at + offsets
            n = int(np.searchsorted(where, total, "right")) - 1
            o = where[:n]
            byte = o >> 3
            codes = (raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (o & 7) & ((1 << (where[1 : n + 1] - o)) - 1)
            stops = np.flatnonzero((codes == clear) | (codes == end))
            if len(stops) or n < len(offsets) - 1:
                break
            reach *= 2
            offsets = np.concatenate([[0], np.cumsum(code_widths(reach, bits))])
        m = int(stops[0]) if len(stops) else n
        if m:
            out.append(_expand(codes[:m], clear))
        if not len(stops) or codes[m] == end:
            break
        at = int(where[m + 1])
    return np.concatenate(out) if out else np.zeros(0, np.uint8)


def _expand(codes: np.ndarray, clear: int) -> np.ndarray:
    """Samples of the codes of one table."""
    number = np.arange(len(codes))
    parent = np.where(codes < clear, -1, codes - clear - 2)
    if wrong := np.flatnonzero(parent >= number).tolist():
        codes, number, parent = codes[: wrong[0]], number[: wrong[0]], parent[: wrong[0]]
    if not len(codes):
        return np.zeros(0, np.uint8)
    size, up = (parent >= 0).astype(np.int64), np.where(parent >= 0, parent, number)
    while True:  # depth in the tree of strings by doubling
        more = size[up]
        if not more.any():
            break
        size, up = size + more, up[up]
    size += 1
    start = np.cumsum(size) - size
    n = int(size.sum())
    owner = np.repeat(number, size)
    place = np.arange(n)
    source = np.where(parent[owner] >= 0, start[parent[owner]] + place - start[owner], place)
    while True:
        further = source[source]
        if np.array_equal(further, source):
            break
        source = further
    first = np.zeros(n, np.uint8)
    literal = parent < 0
    first[start[literal]] = codes[literal]
    return first[source]


@dataclass
class Frame:
    """A picture as it is shown: ``canvas`` is rows x columns x RGBA, ``box`` what the frame itself covers."""

    delay_ms: int
    box: tuple[int, int, int, int]
    disposal: int
    canvas: np.ndarray

    def histogram(self, bins: int = BINS) -> np.ndarray:
        """Visible pixels by grey level of red, green and blue: 3 x bins."""
        shown = self.canvas[self.canvas[..., 3] > 0]
        return np.stack([np.bincount(shown[:, c] // (256 // bins), minlength=bins) for c in range(3)])


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(data) and (n := data[at]):
        parts.append(data[at + 1 : at + 1 + n])
        at += 1 + n
    return b"".join(parts), at + 1


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 2 << (flags & 7)
    got = np.zeros((256, 4), np.uint8)
    got[:n, :3] = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
    got[:, 3] = 255
    return got, at + 3 * n


def decode_gif(data: bytes) -> Iterator[Frame]:
    """Frames of a GIF in order, each as it is shown; nothing for other data. Damaged data end at the damage."""
    with contextlib.suppress(ValueError, IndexError, struct.error):
        yield from _frames(data)


def _frames(data: bytes) -> Iterator[Frame]:
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        return
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    if width * height > MOST_PIXELS:  # a header asks for any size without the data for it
        return
    shared, at = _palette(data, 13, flags)
    canvas = np.zeros((height, width, 4), np.uint8)
    delay = disposal = 0
    clear_index: int | None = None
    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            body, after = _blocks(data, at + 2)
            if data[at + 1] == 0xF9 and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, 10 * int.from_bytes(body[1:3], "little")
                clear_index = body[3] if body[0] & 1 else None
            at = after
            continue
        if data[at] != 0x2C:
            return
        x, y, w, h, flags = struct.unpack_from("<HHHHB", data, at + 1)
        if w * h > MOST_PIXELS:
            return
        own, at = _palette(data, at + 10, flags)
        bits = data[at]
        stream, at = _blocks(data, at + 1)
        index = np.zeros(w * h, np.uint8)
        got = lzw_decode(stream, bits)[: w * h]
        index[: len(got)] = got
        index = index.reshape(h, w)
        if flags & 0x40:
            order = np.concatenate([np.arange(0, h, 8), np.arange(4, h, 8), np.arange(2, h, 4), np.arange(1, h, 2)])
            lines = np.empty_like(index)
            lines[order] = index
            index = lines
        kept = canvas.copy() if disposal == 3 else None
        palette = own if own is not None else shared
        pixels = palette[index] if palette is not None else np.zeros((h, w, 4), np.uint8)
        area = canvas[y : y + h, x : x + w]
        pixels, index = pixels[: area.shape[0], : area.shape[1]], index[: area.shape[0], : area.shape[1]]
        if clear_index is None:
            area[...] = pixels
        else:
            area[index != clear_index] = pixels[index != clear_index]
        yield Frame(delay, (x, y, w, h), disposal, canvas.copy())
        if disposal == 2:
            area[...] = 0
        elif kept is not None:
            canvas = kept
        delay = disposal = 0
        clear_index = None


def encode_gif(frames: list[np.ndarray], palette: np.ndarray, *, delay_ms: int = 100, disposal: int = 1, transparent: int | None = None) -> bytes:
    """GIF89a of frames of 8-bit palette indices (rows x columns, all at the upper left corner), 256 colours."""
    height, width = max(f.shape[0] for f in frames), max(f.shape[1] for f in frames)
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), palette.astype(np.uint8).tobytes()]
    for f in frames:
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (transparent is not None), delay_ms // 10, transparent or 0) + b"\0")
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, f.shape[1], f.shape[0], 0) + b"\x08")
        stream = lzw_encode(f.tobytes())
        out += [bytes([len(part)]) + part for part in (stream[k : k + 255] for k in range(0, len(stream), 255))]
        out.append(b"\0")
    return b"".join([*out, b"\x3b"])


GREY = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, 1)


def store_bytes(payload: bytes) -> bytes:
    """A payload of a multiple of WIDTH bytes as grey frames of FRAME_ROWS rows at most."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    return encode_gif([rows[k : k + FRAME_ROWS] for k in range(0, len(rows), FRAME_ROWS)], GREY)


def load_bytes(media: bytes) -> tuple[bytes, np.ndarray, list[int]]:
    """Payload, histogram (BINS) and delays of what store_bytes made."""
    parts, delays, total = [], [], np.zeros(BINS, np.int64)
    for frame in decode_gif(media):
        x, y, w, h = frame.box
        grey = np.ascontiguousarray(frame.canvas[y : y + h, x : x + w, 0])
        parts.append(grey.tobytes())
        total += np.bincount(grey.ravel() // (256 // BINS), minlength=BINS)
        delays.append(frame.delay_ms)
    return b"".join(parts), total, delays


def media_columns(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest columns of each text stored as a GIF and read back. Null and empty texts: a payload of WIDTH zero bytes.

    The feature is the histogram of grey levels over all frames, with the number of frames and the time they take. Texts of any length are
    stored whole, in as many frames as they need. Repeated rows get equal values, null keys are rows like any other, further columns are left out,
    and an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            for t in batch[1]:
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                media = store_bytes(raw + b"\0" * (-len(raw) % WIDTH or (0 if raw else WIDTH)))
                back, levels, delays = load_bytes(media)
                feature = f"{','.join(map(str, levels.tolist()))};{len(delays)}x{delays[0]}ms"
                for column, v in zip(rows, (len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature), strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([batch[0], *(pa.array(c, k) for c, k in zip(rows, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))], names)

    names = [key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    thin = df.select(key, text)
    return arrow_map(thin, run, f"`{key}` {thin.schema[0].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def frame_rows(df: DataFrame, key: str, media: str) -> DataFrame:
    """A row per frame of each GIF in a binary column: key, frame, delay_ms, disposal, width, height, red, green, blue
    (histograms of BINS levels). Null, empty and other data have no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([(key, keys), ("frame", pa.int32()), ("delay_ms", pa.int32()), ("disposal", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("red", "green", "blue"))])
        for batch in batches:
            for k, data in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                rows = []
                for n, f in enumerate(decode_gif(data or b"")):
                    levels = f.histogram().tolist()
                    rows.append({key: k, "frame": n, "delay_ms": f.delay_ms, "disposal": f.disposal, "width": f.canvas.shape[1], "height": f.canvas.shape[0], "red": levels[0], "green": levels[1], "blue": levels[2]})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    thin = df.select(key, media)
    from pyspark.sql.pandas.types import to_arrow_type

    keys = to_arrow_type(thin.schema[0].dataType)
    return arrow_map(thin, run, f"`{key}` {thin.schema[0].dataType.simpleString()}, frame int, delay_ms int, disposal int, width int, height int, red array<long>, green array<long>, blue array<long>")


def op3_gif(spark, sf_dir: str) -> DataFrame:
    """Digests and feature of every document's text, stored as a GIF and read back."""
    return media_columns(table(spark, sf_dir, "documents"))
