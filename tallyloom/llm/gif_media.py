"""GIF as a media column: encode samples, decode code streams, apply palettes, disposal and transparency, describe frames."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import strings

WIDTH = 64
#: Rows of a frame at most, when a payload is stored.
ROWS = 1024
#: Hundredths of a second that each stored frame is shown.
DELAY = 10
BINS = 8
SINGLES = [bytes([i]) for i in range(256)]


# ---- code streams ----


def lzw_codes(data: bytes) -> list[int]:
    """LZW codes of 8-bit samples: clear, codes, clear where the table of 4096 is full, end."""
    codes = [256]
    if not data:
        return [256, 257]
    out, table, free = codes.append, {}, 258
    have = data[0]
    for c in data[1:]:
        k = have << 8 | c
        if k in table:
            have = table[k]
        else:
            out(have)
            have = c
            if free < 4096:
                table[k] = free
                free += 1
            else:
                out(256)
                table, free = {}, 258
    out(have)
    out(257)
    return codes


@cache
def schedule(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Width of each code after a clear, and its bit offset, for 8-bit (or fewer) samples."""
    clear = 1 << bits
    free = clear + 2 + np.maximum(0, np.arange(8192) - 1)
    width = np.full(8192, bits + 1)
    for w in range(bits + 1, 12):
        width += free >= 1 << w
    width = np.minimum(width, 12)
    return width, np.concatenate([[0], np.cumsum(width)])


def packed_codes(codes: list[int]) -> bytes:
    """Codes of 8-bit samples as bits, low bits first."""
    values = np.array(codes, np.uint16)
    clears = np.flatnonzero(values == 256)
    last = np.zeros(len(values), np.int64)
    last[clears[clears < len(values) - 1] + 1] = clears[clears < len(values) - 1] + 1
    place = np.arange(len(values)) - np.maximum.accumulate(last)
    place[0] = 0
    width = schedule(8)[0][np.minimum(place, 8191)]
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
    return np.packbits(bits[np.arange(16) < width[:, None]], bitorder="little").tobytes()


def lzw_samples(stream: bytes, bits: int, wanted: int) -> bytes:
    """Samples of a code stream; `bits` is the sample width it begins with. Broken streams end early."""
    clear, width, offset = 1 << bits, *schedule(bits)
    data = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    total, at, out, size = 8 * len(stream), 0, [], 0
    base = SINGLES[:clear] + [b"", b""]
    table, previous, since = base.copy(), b"", 0
    while at + bits < total and size < wanted:
        n = min(len(width) - since, max(1, (total - at) // (bits + 1)))
        where = at + offset[since : since + n] - offset[since]
        wide = width[since : since + n]
        inside = where + wide <= total
        where, wide = where[inside], wide[inside]
        if not len(where):
            break
        byte = where >> 3
        found = (data[byte] | data[byte + 1] << np.uint32(8) | data[byte + 2] << np.uint32(16)) >> (where & 7).astype(np.uint32) & ((1 << wide) - 1).astype(np.uint32)
        stops = np.flatnonzero((found == clear) | (found == clear + 1))
        end = int(stops[0]) if len(stops) else len(found)
        codes = found[:end].tolist()
        if codes and not previous:
            previous = table[codes[0]] if codes[0] < clear else b""
            if not previous:
                break
            out.append(previous)
            codes = codes[1:]
        room = 4096 - len(table)
        append, add = out.append, table.append
        try:
            for c in codes[:room]:
                try:
                    x = table[c]
                except IndexError:
                    if c > len(table):
                        raise
                    x = previous + previous[:1]
                append(x)
                add(previous + x[:1])
                previous = x
            for c in codes[room:]:
                previous = table[c]
                append(previous)
        except IndexError:
            break
        if len(stops):
            if found[end] == clear + 1:
                break
            at = int(where[end] + wide[end])
            table, previous, since = base.copy(), b"", 0
        else:
            at = int(where[-1] + wide[-1])
            since = min(since + len(where), len(width) - 1)
            if since == len(width) - 1:
                since = 6000  # all further codes have 12 bits
        size = sum(map(len, out)) if len(out) < 64 else size + sum(map(len, out[-len(codes) :]))
    return b"".join(out)[:wanted]


# ---- files ----


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    palette: np.ndarray
    samples: bytes
    delay_ms: int
    disposal: int
    transparent: int | None


@dataclass
class Gif:
    width: int
    height: int
    frames: list[Frame]
    loops: int | None


#: Colours of stored samples: three bits of red, three of green and two of blue, so that all 256 differ.
COLOURS = bytes(x for i in range(256) for x in ((i >> 5) * 36, (i >> 2 & 7) * 36, (i & 3) * 85))


def encode_payload(payload: bytes) -> bytes:
    """8-bit samples as a GIF of frames of 64 samples a row, each sample a colour of the palette. The payload's length is a multiple of 64."""
    rows = len(payload) // WIDTH
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, min(rows, ROWS), 0xF7, 0, 0), COLOURS, b"\x21\xff\x0bNETSCAPE2.0\x03\x01\0\0\0"]
    for top in range(0, rows, ROWS):
        part = payload[top * WIDTH : (top + ROWS) * WIDTH]
        out += [b"\x21\xf9\x04", struct.pack("<BHBB", 1 << 2, DELAY, 0, 0), b"\x2c", struct.pack("<HHHHB", 0, 0, WIDTH, len(part) // WIDTH, 0), b"\x08"]
        stream = packed_codes(lzw_codes(part))
        for at in range(0, len(stream), 255):
            block = stream[at : at + 255]
            out += [SINGLES[len(block)], block]
        out.append(b"\0")
    return b"".join([*out, b"\x3b"])


def decode_gif(data: bytes | None) -> Gif | None:
    """The file's frames as stored; None if it isn't a GIF. A truncated file gives the frames that are complete."""
    if not data or data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        return None
    width, height, flags = struct.unpack("<HHB", data[6:11])
    at, common, frames, loops = 13, np.zeros((0, 3), np.uint8), [], None

    def palette(flags: int, at: int) -> tuple[np.ndarray, int]:
        n = 3 << ((flags & 7) + 1)
        return np.frombuffer(data[at : at + n].ljust(n, b"\0"), np.uint8).reshape(-1, 3), at + n

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while at < len(data) and data[at]:
            parts.append(data[at + 1 : at + 1 + data[at]])
            at += 1 + data[at]
        return b"".join(parts), at + 1

    if flags & 0x80:
        common, at = palette(flags, at)
    control = (0, 0, None)
    while at < len(data):
        kind = data[at]
        if kind == 0x21 and at + 1 < len(data):
            label = data[at + 1]
            body, at = blocks(at + 2)
            if label == 0xF9 and len(body) >= 4:
                control = (body[0] >> 2 & 7, struct.unpack("<H", body[1:3])[0] * 10, body[3] if body[0] & 1 else None)
            elif label == 0xFF and body[:11] == b"NETSCAPE2.0" and len(body) >= 14:
                loops = struct.unpack("<H", body[12:14])[0]
        elif kind == 0x2C and at + 11 <= len(data):
            left, top, w, h, flags = struct.unpack("<HHHHB", data[at + 1 : at + 10])
            at, own = at + 10, common
            if flags & 0x80:
                own, at = palette(flags, at)
            bits = data[at] if at < len(data) else 8
            stream, at = blocks(at + 1)
            samples = lzw_samples(stream, bits, w * h) if 1 <= bits <= 8 else b""
            if len(samples) < w * h and at > len(data):
                break
            samples = samples.ljust(w * h, b"\0")
            if flags & 0x40:  # interlaced
                order = [y for start, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(start, h, step)]
                rows = [b""] * h
                for i, y in enumerate(order):
                    rows[y] = samples[i * w : (i + 1) * w]
                samples = b"".join(rows)
            frames.append(Frame(left, top, w, h, own, samples, control[1], control[0], control[2]))
            control = (0, 0, None)
        else:
            break
    return Gif(width, height, frames, loops)


def shown_frames(gif: Gif) -> Iterator[np.ndarray]:
    """What is seen while each frame is shown: (height, width, 4), with alpha 0 or 255."""
    canvas = np.zeros((gif.height, gif.width, 4), np.uint8)
    for f in gif.frames:
        before = canvas.copy() if f.disposal == 3 else None
        box = canvas[f.top : f.top + f.height, f.left : f.left + f.width]
        index = np.frombuffer(f.samples, np.uint8).reshape(f.height, f.width)[: box.shape[0], : box.shape[1]]
        colours = np.zeros((256, 4), np.uint8)
        colours[: len(f.palette), :3] = f.palette
        colours[:, 3] = 255
        if f.transparent is None:
            box[:] = colours[index]
        else:
            see = index != f.transparent
            box[see] = colours[index[see]]
        yield canvas
        if f.disposal == 2:
            box[:] = 0
        elif f.disposal == 3:
            canvas = before


def histogram(image: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Counts of each channel's values of the pixels that aren't transparent, (3, bins)."""
    seen = image[image[..., 3] > 0]
    return np.stack([np.bincount(seen[:, c] // (256 // bins), minlength=bins) for c in range(3)])


# ---- columns ----


def with_gif(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text's UTF-8 bytes, filled with 0 to a positive multiple of 64, as a GIF (null text: empty).

    Equal texts have equal files. A very long text is one file of many frames; null ids and repeated rows are rows like
    others; an empty table gives an empty result; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = strings(b.column(1))
            for at in range(0, len(texts), 200):
                raw = [t.encode() for t in texts[at : at + 200].to_pylist()]
                media = [encode_payload(r + bytes(-len(r) % WIDTH if r else WIDTH)) for r in raw]
                yield pa.RecordBatch.from_arrays([b.column(0)[at : at + 200], pa.array([len(r) for r in raw], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def gif_frames(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row for each frame: doc_id, frame, start_ms, delay_ms, width, height, disposal, samples, histogram (red, green, blue counts in 8 bins each, of what is shown).

    Null, empty and other files than GIFs have no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "frame", "start_ms", "delay_ms", "width", "height", "disposal", "samples", "histogram"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
        for b in batches:
            for doc_id, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                gif, start, rows = decode_gif(data.as_py()), 0, []
                for i, (f, image) in enumerate(zip(gif.frames, shown_frames(gif), strict=True) if gif else ()):
                    rows.append((doc_id, i, start, f.delay_ms, f.width, f.height, f.disposal, f.samples, histogram(image).ravel().tolist()))
                    start += f.delay_ms
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = "doc_id long, frame int, start_ms long, delay_ms int, width int, height int, disposal int, samples binary, histogram array<long>"
    return media.select(F.col(id_col).cast("long").alias("doc_id"), media_col).mapInArrow(run, schema)


def read_back(media: DataFrame) -> DataFrame:
    """From (doc_id, n_bytes, media): payload_bytes, payload_sha256, tail_crc32 (of the last 64 bytes), media_bytes, media_sha256, feature, frames.

    All are computed from the decoded file. frames has, for each frame, start_ms, delay_ms and the counts of red, green
    and blue in 8 bins each of what is shown; feature has the number of frames, the time they take and the bins' shares
    over all frames in hundredths of a percent. Null media and files that are no GIF have nulls in all of these but
    media_bytes and media_sha256; other rows' nulls stay; an empty table gives an empty result.
    """

    def row(doc_id: int | None, n_bytes: int | None, data: bytes | None) -> tuple:
        stored = (len(data), hashlib.sha256(data).hexdigest()) if data is not None else (None, None)
        gif = decode_gif(data)
        if gif is None:
            return doc_id, n_bytes, None, None, None, *stored, None, None
        payload, start, frames, counts = b"".join(f.samples for f in gif.frames), 0, [], np.zeros((3, BINS), np.int64)
        for f, image in zip(gif.frames, shown_frames(gif), strict=True):
            bins = histogram(image)
            counts += bins
            frames.append({"start_ms": start, "delay_ms": f.delay_ms, **{c: b.tolist() for c, b in zip(("red", "green", "blue"), bins, strict=True)}})
            start += f.delay_ms
        shares = counts * 10000 // np.maximum(1, counts.sum(1, keepdims=True))
        feature = f"frames={len(gif.frames)};ms={start};" + ";".join(f"{c}={','.join(map(str, x.tolist()))}" for c, x in zip(("red", "green", "blue"), shares, strict=True))
        return doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *stored, feature, frames

    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames"]
    bins = pa.list_(pa.int64())
    frame = pa.struct([("start_ms", pa.int64()), ("delay_ms", pa.int32()), ("red", bins), ("green", bins), ("blue", bins)])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(frame)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [row(d, n, m.as_py()) for d, n, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    channels = "red:array<long>,green:array<long>,blue:array<long>"
    schema = f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames array<struct<start_ms:long,delay_ms:int,{channels}>>"
    return media.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("n_bytes").cast("long").alias("n_bytes"), "media").mapInArrow(run, schema)
