import hashlib
import random
import struct
import zlib

import numpy as np

from tallyloom.llm.gif_media import SINGLES, decode_gif, encode_payload, gif_frames, lzw_codes, lzw_samples, packed_codes, read_back, shown_frames, with_gif


def test_streams():
    rng = random.Random(1)
    for n in (1, 2, 63, 64, 5000, 70000):
        for alphabet in (1, 2, 30, 256):
            data = bytes(rng.randrange(alphabet) for _ in range(n))
            assert lzw_samples(packed_codes(lzw_codes(data)), 8, n) == data
    data = bytes(range(256)) * 300
    assert lzw_samples(packed_codes(lzw_codes(data)), 8, len(data)) == data
    assert lzw_samples(b"", 8, 5) == b"" and len(lzw_samples(b"\xff" * 50, 8, 50)) <= 50


def test_full_table_without_clear():
    """Other writers go on with a full table."""
    rng = random.Random(2)
    data = bytes(rng.randrange(200) for _ in range(30000))
    codes, table, have = [256], {s: i for i, s in enumerate(SINGLES)}, b""
    free = 258
    for c in data:
        if have + bytes([c]) in table:
            have += bytes([c])
        else:
            codes.append(table[have])
            if free < 4096:
                table[have + bytes([c])] = free
                free += 1
            have = bytes([c])
    codes += [table[have], 257]
    assert lzw_samples(packed_codes(codes), 8, len(data)) == data


def whole(frames, size=(2, 2), palette=bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])):
    """A small file; frames: (left, top, w, h, samples, disposal, transparent, delay)."""
    out = b"GIF89a" + struct.pack("<HHBBB", *size, 0x81, 0, 0) + palette
    for left, top, w, h, samples, disposal, clear, delay in frames:
        out += b"\x21\xf9\x04" + struct.pack("<BHBB", disposal << 2 | (clear is not None), delay, clear or 0, 0)
        stream = packed_codes(lzw_codes(bytes(samples)))
        out += b"\x2c" + struct.pack("<HHHHB", left, top, w, h, 0) + b"\x08" + bytes([len(stream)]) + stream + b"\0"
    return out + b"\x3b"


def test_disposal_and_transparency():
    red, green, blue, none = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255), (0, 0, 0, 0)
    gif = decode_gif(whole([(0, 0, 2, 2, [1, 1, 1, 1], 1, None, 5), (1, 0, 1, 1, [2], 2, None, 7), (0, 0, 2, 1, [3, 0], 3, 0, 9), (0, 1, 1, 1, [2], 0, None, 1)]))
    seen = [[tuple(p) for p in f.reshape(-1, 4).tolist()] for f in (x.copy() for x in shown_frames(gif))]
    assert seen == [[red] * 4, [red, green, red, red], [blue, none, red, red], [red, none, green, red]]
    assert [f.delay_ms for f in gif.frames] == [50, 70, 90, 10]


def test_files():
    assert decode_gif(None) is None and decode_gif(b"") is None and decode_gif(b"PNG") is None
    payload = random.Random(3).randbytes(64 * 2500)
    gif = decode_gif(encode_payload(payload))
    assert [f.height for f in gif.frames] == [1024, 1024, 452] and b"".join(f.samples for f in gif.frames) == payload
    cut = decode_gif(encode_payload(payload)[:100000])
    assert len(cut.frames) == 1


def test_columns(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    docs += [(-1, None), (-2, ""), (None, "x" * 64), (-3, "é" * 90000), (-4, "a"), (-4, "a")]
    frame = spark.createDataFrame([(d, t, 1, b"") for d, t in docs], "doc_id long, text string, n_bytes int, media binary")
    media = with_gif(frame)
    want = []
    for d, t in docs:
        raw = (t or "").encode()
        p = raw + bytes(-len(raw) % 64 if raw else 64)
        want.append((d, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    got = [tuple(r)[:5] for r in read_back(media).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    frames = gif_frames(media).collect()
    assert {r.doc_id for r in frames} == {d for d, _ in docs}
    assert all(np.sum(r.histogram) % 3 == 0 and len(r.histogram) == 24 for r in frames)
    assert read_back(with_gif(frame.limit(0))).count() == 0


def test_read_back_of_other_media(spark):
    rows = [(1, 3, None), (2, None, b"no GIF"), (None, 5, b""), (4, 0, b"GIF89a")]
    got = {r.doc_id: r for r in read_back(spark.createDataFrame(rows, "doc_id long, n_bytes long, media binary")).collect()}
    assert len(got) == 4 and all(r.payload_bytes is None and r.feature is None and r.frames is None for r in got.values())
    assert got[1].media_bytes is None and got[2].media_bytes == 6 and got[None].media_bytes == 0


def test_frames_of_stored_texts(spark):
    text = "abc" * 40_000
    got = read_back(with_gif(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"))).collect()
    r = next(x for x in got if x.doc_id == 1)
    payload = text.encode() + bytes(-len(text) % 64)
    assert len(r.frames) == 2 and [f.start_ms for f in r.frames] == [0, 100]
    for i, f in enumerate(r.frames):
        part = payload[65536 * i : 65536 * (i + 1)]
        part += payload[len(part) : 65536]  # what a shorter frame leaves uncovered
        assert f.red == [sum(1 for x in part if (x >> 5) * 36 // 32 == k) for k in range(8)] and f.blue == [sum(1 for x in part if (x & 3) * 85 // 32 == k) for k in range(8)]
