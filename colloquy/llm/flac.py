"""FLAC as a media column: 8-bit mono streams, written, verified and read in numpy, many frames at a time.

A stream has the marker, STREAMINFO (with the MD5 of the samples), a SEEKTABLE (sample offset, byte offset and length of
every `seek_every`-th frame) and frames of 576 samples.  Each frame holds the cheapest of: a constant, a fixed linear
predictor of order 0 to 4 with Rice-coded residuals in one partition, or the samples as they are.  The
decoder handles these, and also linear predictors with explicit coefficients and residuals in several partitions;
it checks the CRC-8 of each frame header, the CRC-16 of each frame and the MD5 of all samples, and raises FlacError if one fails.

Bytes become samples by subtracting 128 (FLAC's samples are signed).  Rules: null text is the empty text; a payload is
text bytes filled up with bytes 255 to a positive multiple of 576; equal payloads give equal streams.  Rows stay as
they are; columns beyond doc_id and text are ignored.  Long texts are worked off in runs of frames.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import column, give_back, slices, table

BLOCK = 576
RATE = 8000
SEEK_EVERY = 64
#: Frames that are worked on together: this bounds memory for texts of any length.
RUN = 2048
SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


class FlacError(ValueError):
    """A stream that isn't whole or isn't what this decoder reads."""


def _crc_table(poly: int, bits: int) -> np.ndarray:
    out = np.arange(256, dtype=np.int64) << (bits - 8)
    for _ in range(8):
        out = np.where(out >> (bits - 1) & 1, (out << 1) ^ poly, out << 1) & ((1 << bits) - 1)
    return out


_CRC8, _CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = int(_CRC8[c ^ b])
    return c


def crc16_many(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-16 of the first sizes[i] bytes of each row; all rows step together, longest first."""
    order = np.argsort(-sizes, kind="stable")
    columns, left = np.ascontiguousarray(rows[order].T), sizes[order]
    crc = np.zeros(len(order), np.int64)
    for i in range(int(left.max(initial=0))):
        n = int(np.searchsorted(-left, -i))  # rows with more than i bytes
        c = crc[:n]
        crc[:n] = (c << 8 & 0xFFFF) ^ _CRC16[c >> 8 ^ columns[i, :n]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _number(n: int) -> bytes:
    """A frame number in FLAC's extended UTF-8."""
    if n < 128:
        return bytes([n])
    tail = []
    limit = 0x40
    while True:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        limit >>= 1
        if n < limit:
            return bytes([(0xFF00 >> len(tail) + 1) & 0xFF & ~(limit * 2 - 1) | n, *reversed(tail)])


def _read_number(data: bytes, at: int) -> tuple[int, int]:
    first = data[at]
    if first < 0x80:
        return first, at + 1
    more = 8 - (first ^ 0xFF).bit_length() - 1
    value = first & (0x3F >> more)
    for i in range(1, more + 1):
        value = value << 6 | data[at + i] & 0x3F
    return value, at + 1 + more


def _header(number: int) -> bytes:
    """Sync code, fixed block size; 576 samples, rate from STREAMINFO; one channel of 8 bits; number; CRC-8."""
    head = bytes([0xFF, 0xF8, 0x20, 0x02]) + _number(number)
    return head + bytes([crc8(head)])


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """Subframes of rows of 576 signed samples, without frame header and CRC-16."""
    n = len(samples)
    x = samples.astype(np.int32)
    best_bits = np.full(n, 8 + 8 * BLOCK)  # verbatim
    kind = np.full(n, -1)
    rice = np.zeros(n, np.int64)
    residuals = [x]
    for order in range(1, 5):
        residuals.append(np.diff(residuals[-1], axis=1))
    for order in range(5):
        zig = ((residuals[order] << 1) ^ (residuals[order] >> 31)).astype(np.int32)
        near = np.log2(np.maximum(zig.mean(1), 1)).astype(np.int32)  # the best parameter lies next to it
        for step in (-1, 0):
            k = np.clip(near + step, 0, 14)
            bits = 8 + 8 * order + 6 + 4 + (zig >> k[:, None]).sum(1) + (k + 1) * (BLOCK - order)
            better = bits < best_bits
            best_bits[better], kind[better], rice[better] = bits[better], order, k[better]
    constant = (x == x[:, :1]).all(1)
    kind[constant] = -2
    out: list = [b""] * n
    for i in np.flatnonzero(constant):
        out[i] = bytes([0x00, int(x[i, 0]) & 0xFF])
    plain = np.flatnonzero(kind == -1)
    for i in plain:
        out[i] = b"\x02" + samples[i].tobytes()
    for order in range(5):
        rows = np.flatnonzero(kind == order)
        if not len(rows):
            continue
        k = rice[rows][:, None]
        zig = (residuals[order][rows] << 1) ^ (residuals[order][rows] >> 31)
        # A residual is the quotient in zeros, a one, and k low bits: where the ones and low bits lie follows from sums.
        sizes = (zig >> k) + 1 + k
        ends = np.cumsum(sizes, 1)
        first = 8 + 8 * order + 6 + 4
        bits = np.zeros((len(rows), first + int(ends[:, -1].max()) + 7), np.uint8)
        bits[:, :8] = np.unpackbits(np.full((len(rows), 1), (8 + order) << 1, np.uint8), axis=1)
        if order:
            bits[:, 8 : 8 + 8 * order] = np.unpackbits((x[rows, :order] & 0xFF).astype(np.uint8), axis=1)
        bits[:, first - 4 : first] = (k >> np.arange(3, -1, -1)) & 1
        r = np.arange(len(rows))[:, None]
        bits[r, first + ends - 1 - k] = 1
        for b in range(int(k.max())):
            at = first + ends - 1 - b
            use = np.broadcast_to(k > b, at.shape) & (zig >> b & 1 == 1)
            bits[np.broadcast_to(r, at.shape)[use], at[use]] = 1
        packed = np.packbits(bits, axis=1)
        used = (first + ends[:, -1] + 7) // 8
        for i, row, size in zip(rows, packed, used, strict=True):
            out[i] = row[:size].tobytes()
    return out


def encode(payloads: list[bytes], seek_every: int = SEEK_EVERY) -> list[bytes]:
    """A FLAC stream per payload; payloads are positive multiples of 576 bytes."""
    counts = [len(p) // BLOCK for p in payloads]
    frames: list[bytes] = []
    numbers = [k for c in counts for k in range(c)]
    flat = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, BLOCK)
    for a in range(0, len(flat), RUN):
        block = (flat[a : a + RUN] ^ 0x80).view(np.int8)
        bodies = [_header(k) + sub for k, sub in zip(numbers[a : a + RUN], encode_frames(block), strict=True)]
        sizes = np.array([len(b) for b in bodies])
        rows = np.frombuffer(b"".join(b.ljust(int(sizes.max()), b"\0") for b in bodies), np.uint8).reshape(len(bodies), -1)
        frames += [b + int(c).to_bytes(2, "big") for b, c in zip(bodies, crc16_many(rows, sizes), strict=True)]
    out, at = [], 0
    for payload, count in zip(payloads, counts, strict=True):
        own = frames[at : at + count]
        at += count
        sizes = [len(f) for f in own]
        signed = (np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()
        bits = RATE << 44 | 0 << 41 | 7 << 36 | len(payload)
        info = BLOCK.to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + bits.to_bytes(8, "big") + hashlib.md5(signed).digest()
        starts = np.concatenate([[0], np.cumsum(sizes)])
        points = b"".join((k * BLOCK).to_bytes(8, "big") + int(starts[k]).to_bytes(8, "big") + BLOCK.to_bytes(2, "big") for k in range(0, count, seek_every))
        out.append(b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(points).to_bytes(3, "big") + points + b"".join(own))
    return out


def parse(stream: bytes) -> dict:
    """STREAMINFO's fields, the seek points, and where the frames begin."""
    if stream[:4] != b"fLaC":
        raise FlacError("no marker")
    at, out, last = 4, {"seek": []}, False
    while not last:
        if at + 4 > len(stream):
            raise FlacError("metadata is cut off")
        last, kind, size = bool(stream[at] & 0x80), stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
        body = stream[at + 4 : at + 4 + size]
        if kind == 0:
            bits = int.from_bytes(body[10:18], "big")
            out |= {"block": int.from_bytes(body[:2], "big"), "rate": bits >> 44, "channels": (bits >> 41 & 7) + 1, "bits": (bits >> 36 & 31) + 1, "samples": bits & (1 << 36) - 1, "md5": body[18:34]}
        elif kind == 3:
            out["seek"] = [(int.from_bytes(body[i : i + 8], "big"), int.from_bytes(body[i + 8 : i + 16], "big"), int.from_bytes(body[i + 16 : i + 18], "big")) for i in range(0, len(body), 18)]
        at += 4 + size
    if "block" not in out:
        raise FlacError("no STREAMINFO")
    if (out["channels"], out["bits"], out["block"]) != (1, 8, BLOCK):
        raise FlacError("only mono streams of 8 bits in blocks of 576 samples are read")
    return out | {"first": at}


def _bits_at(words: np.ndarray, row: np.ndarray, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """n bits (up to 32) of each row from bit position at; words[r, i] holds 64 bits from byte i on."""
    return (words[row, at >> 3] << (at & 7).astype(np.uint64) >> np.uint64(32) >> (np.uint64(32) - np.asarray(n, np.uint64))).astype(np.int64)


def _signed(v: np.ndarray, bits: np.ndarray | int) -> np.ndarray:
    return v - ((v >> (bits - 1) & 1) << bits)


_FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


def decode_bodies(raw: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decode one subframe per row of raw (bytes, padded by 16 zero bytes), from byte start: samples and end bytes.

    All rows step through their samples together; rows differ in predictor, Rice parameter and partitions.
    """
    n = len(raw)
    padded = np.pad(raw, ((0, 0), (0, 16))).astype(np.uint64)
    width = raw.shape[1] + 8
    words = np.zeros((n, width), np.uint64)
    for i in range(8):
        words |= padded[:, i : i + width] << np.uint64(56 - 8 * i)
    every = np.arange(n)
    kind = raw[every, start] >> 1 & 0x3F
    if (raw[every, start] & 0x81).any():
        raise FlacError("a subframe's padding bit or wasted bits are set")
    out = np.zeros((n, BLOCK), np.int64)
    end = np.zeros(n, np.int64)
    constant, verbatim = kind == 0, kind == 1
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    if not (constant | verbatim | fixed | lpc).all():
        raise FlacError("a reserved subframe kind")
    for r in np.flatnonzero(constant):
        out[r] = raw[r, start[r] + 1].astype(np.int8)
        end[r] = start[r] + 2
    for r in np.flatnonzero(verbatim):
        out[r] = raw[r, start[r] + 1 : start[r] + 1 + BLOCK].view(np.int8)
        end[r] = start[r] + 1 + BLOCK
    rows = np.flatnonzero(fixed | lpc)
    if not len(rows):
        return out, end
    order = np.where(lpc[rows], (kind[rows] & 31) + 1, kind[rows] - 8).astype(np.int64)
    at = (start[rows] + 1) * 8
    for i in range(int(order.max())):
        has = order > i
        out[rows[has], i] = _signed(_bits_at(words, rows[has], at[has], 8), 8)
        at[has] += 8
    coefs = np.zeros((len(rows), 32), np.int64)
    shift = np.zeros(len(rows), np.int64)
    for o, c in _FIXED.items():
        coefs[np.ix_(~lpc[rows] & (order == o), range(len(c)))] = c
    explicit = np.flatnonzero(lpc[rows])
    if len(explicit):
        precision = _bits_at(words, rows[explicit], at[explicit], 4) + 1
        if (precision == 16).any():
            raise FlacError("a reserved precision")
        shift[explicit] = _bits_at(words, rows[explicit], at[explicit] + 4, 5)
        at[explicit] += 9
        for i in range(int(order[explicit].max())):
            has = order[explicit] > i
            e = explicit[has]
            coefs[e, i] = _signed(_bits_at(words, rows[e], at[e], precision[has]), precision[has])
            at[e] += precision[has]
    method = _bits_at(words, rows, at, 2)
    if (method > 1).any():
        raise FlacError("a reserved residual coding")
    parameter_bits = np.where(method == 1, 5, 4)
    size = BLOCK >> _bits_at(words, rows, at + 2, 4)
    at += 6
    k = np.zeros(len(rows), np.int64)
    raw_bits = np.full(len(rows), -1)
    residual = np.zeros((BLOCK, len(rows)), np.int64)
    # the stream ends of rows bound the quotients; 64-bit windows hold 57 bits past any position
    for i in range(BLOCK):
        active = order <= i
        opens = active & ((i % size == 0) | (i == order))
        if opens.any():
            o = np.flatnonzero(opens)
            k[o] = _bits_at(words, rows[o], at[o], parameter_bits[o])
            at[o] += parameter_bits[o]
            escaped = k[o] == (1 << parameter_bits[o]) - 1
            raw_bits[o] = -1
            if escaped.any():
                e = o[escaped]
                raw_bits[e] = _bits_at(words, rows[e], at[e], 5)
                at[e] += 5
        a = np.flatnonzero(active) if not active.all() else slice(None)
        here, p, kk = rows[a], at[a], k[a]
        quotient = np.zeros(len(here), np.int64)
        pos = p
        window = words[here, np.minimum(pos >> 3, width - 1)] << (pos & 7).astype(np.uint64)
        top = (window >> np.uint64(8)).astype(np.float64)  # 56 bits: their highest one tells the zeros before it
        zeros = 55 - (np.frexp(top)[1].astype(np.int64) - 1)
        # rounding up to a power of two in the float can hide one zero
        wrong = (window >> (np.uint64(63) - np.minimum(zeros, 63).astype(np.uint64))) & np.uint64(1) == 0
        zeros = np.where((top > 0) & wrong, zeros + 1, zeros)
        long = np.flatnonzero((top == 0) & (raw_bits[a] < 0))
        for j in long:  # more than 55 zeros: rare, bit by bit
            q, b = 0, int(pos[j])
            line = raw[here[j]]
            while b >> 3 < len(line) and not line[b >> 3] >> (7 - (b & 7)) & 1:
                b += 1
                q += 1
            zeros[j] = q
        plain = raw_bits[a] >= 0
        quotient = np.where(plain, 0, zeros)
        low_at = p + np.where(plain, 0, quotient + 1)
        low_bits = np.where(plain, raw_bits[a], kk)
        if (low_at >> 3 >= width).any():
            raise FlacError("a frame is cut off")
        low = np.where(low_bits > 0, _bits_at(words, here, low_at, low_bits), 0)
        zig = quotient << kk | low
        residual[i, a] = np.where(plain, np.where(low_bits > 0, _signed(low, np.maximum(low_bits, 1)), 0), (zig >> 1) ^ -(zig & 1))
        at[a] = low_at + low_bits
    end[rows] = (at + 7) >> 3
    # prediction: fixed predictors are repeated sums, explicit ones step sample by sample
    samples = np.ascontiguousarray(out[rows].T)
    depth = int(order.max())
    for i in range(BLOCK):
        active = order <= i
        if not active.any():
            continue
        guess = np.zeros(len(rows), np.int64)
        for d in range(min(depth, i)):
            guess += coefs[:, d] * samples[i - 1 - d]
        samples[i] = np.where(active, (guess >> shift) + residual[i], samples[i])
    out[rows] = samples.T
    return out, end


def _frames(stream: bytes, first: int, count: int) -> list[int]:
    """Where each frame of a stream probably begins: sync code and the expected number, with a matching CRC-8.  The same bytes
    may stand inside a frame, so lengths and CRC-16 decide."""
    starts, at = [], first
    for number in range(count):
        head = _header(number)
        found = stream.find(head, at)
        if found < 0 or (number == 0 and found != first):
            raise FlacError(f"frame {number} isn't found or its header's CRC-8 is wrong")
        starts.append(found)
        at = found + len(head)
    return starts


def _frame(stream: bytes, at: int, number: int) -> tuple[bytes, int]:
    """(samples, where the next frame begins) of the frame that begins at a place: its end is where decoding ends."""
    head = _header(number)
    if stream[at : at + len(head)] != head:
        raise FlacError(f"frame {number} isn't found or its header's CRC-8 is wrong")
    window = 4 * BLOCK
    while True:
        raw = np.frombuffer(stream[at : at + window], np.uint8)[None, :]
        try:
            samples, end = decode_bodies(raw, np.array([len(head)]))
            after = int(end[0]) + 2
            if after <= raw.shape[1]:
                break
        except (FlacError, IndexError, ValueError):
            if at + window >= len(stream):
                raise FlacError(f"frame {number} is cut off or damaged") from None
        if at + window >= len(stream):
            raise FlacError(f"frame {number} is cut off")
        window *= 8
    if crc16_many(raw[:, :after], np.array([after]))[0]:
        raise FlacError("a frame's CRC-16 is wrong")
    if (samples < -128).any() or (samples > 127).any():
        raise FlacError("a sample is out of range")
    return samples[0].astype(np.int8).tobytes(), at + after


def _decode_together(streams: list[bytes], infos: list[dict]) -> list[bytes]:
    """The samples of streams, their frames cut at the headers that are found, and many decoded at once."""
    jobs = []
    for s, (stream, info) in enumerate(zip(streams, infos, strict=True)):
        starts = _frames(stream, info["first"], -(-info["samples"] // BLOCK))
        jobs += [(s, a, b, len(_header(k))) for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(stream)], strict=True))]
    parts: list[list[bytes]] = [[] for _ in streams]
    for r in range(0, len(jobs), RUN):
        run = jobs[r : r + RUN]
        sizes = np.array([b - a for _, a, b, _ in run])
        raw = np.frombuffer(b"".join(streams[s][a:b].ljust(int(sizes.max()), b"\0") for s, a, b, _ in run), np.uint8).reshape(len(run), -1)
        if (crc16_many(raw, sizes) != 0).any():  # a CRC over data and its own CRC is zero
            raise FlacError("a frame's CRC-16 is wrong")
        samples, end = decode_bodies(raw, np.array([h for *_, h in run]))
        if (end + 2 != sizes).any():
            raise FlacError("a frame's length is wrong")
        if (samples < -128).any() or (samples > 127).any():
            raise FlacError("a sample is out of range")
        for (s, *_), row in zip(run, samples.astype(np.int8), strict=True):
            parts[s].append(row.tobytes())
    return [b"".join(own) for own in parts]


def _decode_frame_by_frame(stream: bytes, info: dict) -> bytes:
    out, at = [], info["first"]
    for number in range(-(-info["samples"] // BLOCK)):
        samples, at = _frame(stream, at, number)
        out.append(samples)
    if at != len(stream):
        raise FlacError("there is something behind the last frame")
    return b"".join(out)


def decode(streams: list[bytes]) -> list[bytes]:
    """The payloads of streams, with every checksum verified.

    If cutting at headers fails for any of them, which a header's bytes inside a frame can cause, they are walked frame by frame.
    """
    infos = [parse(s) for s in streams]
    try:
        parts = _decode_together(streams, infos)
    except (FlacError, IndexError, ValueError):
        parts = []
        for stream, info in zip(streams, infos, strict=True):
            try:
                parts += _decode_together([stream], [info])
            except (FlacError, IndexError, ValueError):
                parts.append(_decode_frame_by_frame(stream, info))
    out = []
    for info, samples in zip(infos, parts, strict=True):
        signed = samples[: info["samples"]]
        if hashlib.md5(signed).digest() != info["md5"]:
            raise FlacError("the samples' MD5 is wrong")
        out.append((np.frombuffer(signed, np.uint8) ^ 0x80).tobytes())
    return out


def read_block(stream: bytes, sample: int) -> tuple[int, bytes]:
    """(first sample, PCM bytes) of the block that holds a sample, reached through the seek table."""
    info = parse(stream)
    if not 0 <= sample < info["samples"]:
        raise FlacError("no such sample")
    point = max((p for p in info["seek"] if p[0] <= sample), default=(0, 0, BLOCK))
    number, at = point[0] // BLOCK, info["first"] + point[1]
    while True:
        samples, after = _frame(stream, at, number)
        if (number + 1) * BLOCK > sample:
            return number * BLOCK, (np.frombuffer(samples, np.uint8) ^ 0x80).tobytes()
        number, at = number + 1, after


def pad(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8")
    return len(raw), raw.ljust(max(1, -(-len(raw) // BLOCK)) * BLOCK, b"\xff")


def feature(stream: bytes, payload: bytes) -> str:
    """What the decoded samples say: blocks, seek points, mean level and zero crossings."""
    x = (np.frombuffer(payload, np.uint8) ^ 0x80).view(np.int8).astype(np.int64)
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"blocks={len(x) // BLOCK};seek={len(parse(stream)['seek'])};level={int(np.abs(x).sum())};crossings={crossings}"


def media(docs: DataFrame, *, blocks: bool = False) -> DataFrame:
    """The contract's digests of every text of docs (doc_id, text), stored as FLAC and read back.

    With blocks=True one row per block instead: doc_id, sample_offset, pcm (the block's bytes), media (the stream, on the
    first block only).
    """
    docs = docs.select("doc_id", "text")

    def run(batches):
        for batch in batches:
            for part in slices(batch, most=1_000_000):
                ids, padded = column(part, "doc_id"), [pad(t) for t in column(part, "text")]
                streams = encode([p for _, p in padded])
                back = decode(streams)
                if blocks:
                    rows = [(i, at, p[at : at + BLOCK], s if at == 0 else None) for i, s, p in zip(ids, streams, back, strict=True) for at in range(0, len(p), BLOCK)]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["doc_id", "sample_offset", "pcm", "media"])
                    continue
                rows = [
                    (i, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(s), hashlib.sha256(s).hexdigest(), feature(s, p))
                    for i, (n, _), s, p in zip(ids, padded, streams, back, strict=True)
                ]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)
        give_back()

    return docs.mapInArrow(run, "doc_id long, sample_offset long, pcm binary, media binary" if blocks else SCHEMA)


def op8_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media(table(spark, sf_dir, "documents"))
