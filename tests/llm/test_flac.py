import hashlib
import random
import zlib

import numpy as np
import pytest

from colloquy.llm import flac


def payloads():
    rng = np.random.default_rng(3)
    walk = (np.cumsum(rng.integers(-2, 3, 576 * 150)) % 256).astype(np.uint8).tobytes()
    sine = (128 + 100 * np.sin(np.arange(576 * 3) / 30)).astype(np.uint8).tobytes()
    return [b"\0" * 576, b"\xff" * 1152, rng.integers(0, 256, 576 * 4, dtype=np.uint8).tobytes(), walk, sine, flac.pad("text " * 300)[1], flac.pad(None)[1]]


def test_round_trip_and_headers():
    for p, s in zip(payloads(), streams := flac.encode(payloads()), strict=True):
        info = flac.parse(s)
        assert (info["samples"], info["bits"], info["channels"], info["block"]) == (len(p), 8, 1, 576)
    assert flac.decode(streams) == payloads() and flac.decode([]) == []


def test_seeking():
    p = payloads()[3]
    s = flac.encode([p])[0]
    assert len(flac.parse(s)["seek"]) == 3
    for sample in (0, 575, 576, 576 * 64, 576 * 130 + 7, len(p) - 1):
        first, block = flac.read_block(s, sample)
        assert first == sample // 576 * 576 and block == p[first : first + 576]
    with pytest.raises(flac.FlacError):
        flac.read_block(s, len(p))


def test_damage_is_found():
    rng = random.Random(6)
    s = flac.encode([payloads()[4]])[0]
    for _ in range(150):
        bad = bytearray(s)
        bad[rng.randrange(8, len(s))] ^= 1 << rng.randrange(8)
        try:
            assert flac.decode([bytes(bad)]) == [payloads()[4]]  # only the seek table or unused fields can differ
        except flac.FlacError:
            pass
    for cut in (3, 30, len(s) - 1):
        with pytest.raises((flac.FlacError, IndexError)):
            flac.decode([s[:cut]])


class Bits:
    def __init__(self):
        self.text = ""

    def put(self, value, width):
        self.text += format(value & (1 << width) - 1, f"0{width}b") if width else ""

    def bytes(self):
        return bytes(int(self.text[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(self.text), 8))


def test_explicit_predictors_partitions_and_escapes():
    """A subframe that this encoder never writes: linear prediction with coefficients, Rice partitions, one of them raw."""
    rng = np.random.default_rng(9)
    order, precision, shift, coefs = 2, 6, 3, [15, -8]
    x = [10, 12]
    residual = rng.integers(-9, 10, 574).tolist()
    residual[300] = 60  # a long quotient under a small parameter
    b = Bits()
    b.put((0x20 | order - 1) << 1, 8)
    for v in x:
        b.put(v, 8)
    b.put(precision - 1, 4)
    b.put(shift, 5)
    for c in coefs:
        b.put(c, precision)
    b.put(0, 2)
    b.put(2, 4)  # four partitions of 144
    for part in range(4):
        own = residual[max(0, part * 144 - 2) : part * 144 + 142]
        if part == 1:
            b.put(15, 4)
            b.put(6, 5)
            for r in own:
                b.put(r, 6)
            continue
        k = 0 if part == 2 else 3
        b.put(k, 4)
        for r in own:
            z = r << 1 if r >= 0 else -2 * r - 1
            b.text += "0" * (z >> k) + "1"
            b.put(z & (1 << k) - 1, k)
    for r in residual:
        x.append(((coefs[0] * x[-1] + coefs[1] * x[-2]) >> shift) + r)
    raw = b.bytes()
    samples, end = flac.decode_bodies(np.frombuffer(raw, np.uint8)[None, :], np.array([0]))
    assert samples[0].tolist() == x and end[0] == len(raw)


def test_checksums_of_known_data():
    assert flac.crc8(b"123456789") == 0xF4
    row = np.frombuffer(b"123456789\0\0", np.uint8)[None, :]
    assert flac.crc16_many(np.repeat(row, 2, 0), np.array([9, 0])).tolist() == [0xFEE8, 0]
    assert [flac._number(n) for n in (0, 127, 128, 0x7FF, 0x800, 0xFFFF, 0x10000)] == [chr(n).encode() for n in (0, 127, 128, 0x7FF, 0x800, 0xFFFF, 0x10000)]


def test_query(spark, folder):
    long = "längst " * 30_000
    rows = [(1, "a"), (1, "a"), (2, None), (3, ""), (4, long), (5, "x" * 576)]
    out = {r.doc_id: r for r in flac.op8_flac(spark, folder(rows)).collect()}
    for i, t in dict(rows).items():
        n, p = flac.pad(t)
        r = out[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
    assert out[2].media_sha256 == out[3].media_sha256 and out[2].payload_bytes == out[5].payload_bytes == 576


def test_blocks(spark, documents):
    rows = flac.media(documents((1, "b" * 1300)), blocks=True).orderBy("sample_offset").collect()
    assert [r.sample_offset for r in rows] == [0, 576, 1152] and b"".join(bytes(r.pcm) for r in rows)[:1300] == b"b" * 1300
    assert flac.decode([bytes(rows[0].media)]) == [b"".join(bytes(r.pcm) for r in rows)]
    assert flac.media(documents()).count() == 0


def test_a_header_inside_a_frame():
    """Samples whose bytes, or Rice bits, look like the next frame's header."""
    rng = np.random.default_rng(5)
    noise = bytearray(rng.integers(0, 256, 576 * 3, dtype=np.uint8).tobytes())
    head = flac._header(1)
    for at in (100, 300):
        noise[at : at + len(head)] = bytes(b ^ 0x80 for b in head)
    payload = bytes(noise)
    (stream,) = flac.encode([payload])
    assert stream.count(head) == 3  # verbatim samples hold it as it is
    assert flac.decode([stream]) == [payload]
    assert flac.decode([stream, *flac.encode(payloads())]) == [payload, *payloads()]
    for sample in (0, 576, 1700):
        assert flac.read_block(stream, sample) == (sample // 576 * 576, payload[sample // 576 * 576 :][:576])
    for at in range(len(stream) - 600, len(stream), 37):
        bad = bytearray(stream)
        bad[at] ^= 4
        with pytest.raises(flac.FlacError):
            flac.decode([bytes(bad)])


def test_clashing_names_and_two_texts_of_one_id(documents):
    docs = documents((1, "a"), (1, "b"), (None, None)).withColumnRenamed("lang", "feature").withColumnRenamed("source", "n_bytes")
    assert sorted(r.n_bytes for r in flac.media(docs).collect()) == [0, 1, 1]
