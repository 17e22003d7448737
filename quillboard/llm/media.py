"""Media columns: find out by signature what a binary column really holds.

An Aho-Corasick automaton locates the magic bytes of all known formats in one
pass; a validator per format then walks the structure and confirms its length.
That corrects declared types and carves media embedded in other bytes.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillboard.llm._arrow import utf8


class Data(bytes):
    """Bytes that remember where the marks stand that validators look for."""

    def places(self, mark: bytes) -> list[int]:
        if not hasattr(self, "_places"):
            self._places: dict[bytes, list[int]] = {}
        if mark not in self._places:
            self._places[mark] = [m.start() for m in re.finditer(b"(?=" + re.escape(mark) + b")", self)]
        return self._places[mark]

    def after(self, mark: bytes, at: int) -> int:
        """The first place of a mark at or behind ``at``; -1 without one. Each mark is searched for once."""
        found = self.places(mark)
        k = bisect.bisect_left(found, at)
        return found[k] if k < len(found) else -1

    def archives(self) -> dict[int, int]:
        """The start and end of each archive that an end record closes."""
        if not hasattr(self, "_archives"):
            self._archives: dict[int, int] = {}
            for p in self.places(b"PK\x05\x06"):
                if p + 22 <= len(self):
                    size, offset, note = struct.unpack_from("<IIH", self, p + 12)
                    if p + 22 + note <= len(self):
                        self._archives.setdefault(p - offset - size, p + 22 + note)
        return self._archives

    def coded_end(self, at: int) -> int:
        """The first FF at or behind ``at`` that ends coded image data: none of a restart or stuffing."""
        if not hasattr(self, "_ends"):
            self._ends = [m.start() for m in re.finditer(rb"\xff(?=[^\x00\xd0-\xd7])", self)]
        k = bisect.bisect_left(self._ends, at)
        return self._ends[k] if k < len(self._ends) else -1


UNIT = 192


def _png(b: bytes, at: int) -> int | None:
    p = at + 8
    if b[p : p + 8] != b"\0\0\0\rIHDR":
        return None
    while p + 12 <= len(b):
        (size,) = struct.unpack_from(">I", b, p)
        if p + 12 + size > len(b) or zlib.crc32(b[p + 4 : p + 8 + size]) != struct.unpack_from(">I", b, p + 8 + size)[0]:
            return None
        p += 12 + size
        if b[p - 8 - size : p - 4 - size] == b"IEND":
            return p - at
    return None


def _gif(b: bytes, at: int) -> int | None:
    if at + 13 > len(b):
        return None
    colours = lambda flags: 3 << ((flags & 7) + 1) if flags & 128 else 0
    p = at + 13 + colours(b[at + 10])
    while p < len(b):
        kind = b[p]
        if kind == 0x3B:
            return p + 1 - at
        if kind == 0x21:
            p += 2
        elif kind == 0x2C and p + 10 <= len(b):
            p += 11 + colours(b[p + 9])
        else:
            return None
        while p < len(b) and b[p]:
            p += b[p] + 1
        p += 1
    return None


def _jpeg(b: bytes, at: int) -> int | None:
    p = at + 2
    while p + 4 <= len(b) and b[p] == 0xFF:
        kind = b[p + 1]
        if kind == 0xD9:
            return p + 2 - at
        p += 2 + struct.unpack_from(">H", b, p + 2)[0]
        if kind == 0xDA:  # coded data: up to the next marker that is no restart or stuffing
            if (p := b.coded_end(p)) < 0:
                return None
    return p + 2 - at if b[p : p + 2] == b"\xff\xd9" else None


def _bmp(b: bytes, at: int) -> int | None:
    if at + 30 > len(b):
        return None
    size, _, pixels, header, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    rows = (abs(width) * bits + 31) // 32 * 4 * abs(height)
    return size if header in (12, 40, 108, 124) and planes == 1 and bits in (1, 4, 8, 16, 24, 32) and 14 + header <= pixels <= size == pixels + rows <= len(b) - at else None


def _riff(form: bytes) -> Callable[[bytes, int], int | None]:
    def check(b: bytes, at: int) -> int | None:
        if at + 12 > len(b) or b[at + 8 : at + 12] != form:
            return None
        size = struct.unpack_from("<I", b, at + 4)[0] + 8
        p = at + 12
        while p + 8 <= min(len(b), at + size):
            p += 8 + (struct.unpack_from("<I", b, p + 4)[0] + 1) // 2 * 2
        return size if p == at + size <= len(b) else None

    return check


def _pdf(b: bytes, at: int) -> int | None:
    """Up to the last end mark that has its own startxref: a file that was added to, or made for the web, has several.

    Another header behind an end begins another file; one before the first end is that of a
    file inside, whose end is not this one's.
    """
    end, inside, p = None, 0, at + 5
    while (eof := b.after(b"%%EOF", p)) >= 0 and p <= b.after(b"startxref", p) < eof:
        header = b.after(b"%PDF-", p)
        while 0 <= header < eof:
            inside, header = inside + 1, b.after(b"%PDF-", header + 5)
        if inside and end is not None:
            break
        if inside:
            inside -= 1
        else:
            end = eof + 5
        p = eof + 5
    return end - at if end is not None else None


def _gzip(b: bytes, at: int) -> int | None:
    z, start = zlib.decompressobj(31), at
    try:
        whole = memoryview(b)
        while not z.eof and at < len(b):  # in blocks, so neither a bomb of zeros nor a long rest takes memory
            rest = whole[at : at + (1 << 14)]
            at += len(rest)
            while rest and not z.eof:
                z.decompress(rest, 1 << 20)
                rest = z.unconsumed_tail
    except zlib.error:
        return None
    return at - len(z.unused_data) - start if z.eof else None


def _zip(b: bytes, at: int) -> int | None:
    """The end record whose directory begins where it says, counted from the first file, and whose comment is there."""
    end = b.archives().get(at)
    return None if end is None else end - at


def _crc_table(bits: int, polynomial: int) -> list[int]:
    top, out = 1 << (bits - 1), []
    for x in range(256):
        x <<= bits - 8
        for _ in range(8):
            x = (x << 1 ^ polynomial if x & top else x << 1) & ((1 << bits) - 1)
        out.append(x)
    return out


#: The polynomials of FLAC's checksums, and block sizes by their code.
CRC8, CRC16 = _crc_table(8, 0x07), _crc_table(16, 0x8005)
BLOCK_SIZES = {1: 192, 2: 576, 3: 1152, 4: 2304, 5: 4608, **{k: 256 << (k - 8) for k in range(8, 16)}}


def _flac_frame(b: bytes, p: int) -> tuple[int, int, int] | None:
    """(number, samples, whether numbers count samples) of the frame whose header, by its checksum, begins at p."""
    if p + 6 > len(b) or b[p] != 0xFF or b[p + 1] & 0xFE != 0xF8 or b[p + 3] & 1:
        return None
    size, rate, lead = b[p + 2] >> 4, b[p + 2] & 15, b[p + 4]
    more = next((k for k in range(8) if not lead << k & 0x80), 8)  # bytes of a number in the manner of UTF-8
    if size == 0 or rate == 15 or more in (1, 8):
        return None
    number, q = lead & (0x7F >> more if more else 0x7F), p + 5
    tail = max(0, more - 1)
    if q + tail + 5 > len(b):
        return None
    for x in b[q : q + tail]:
        number = number << 6 | x & 0x3F
    q += tail
    extra = {6: 1, 7: 2}.get(size, 0)
    samples = int.from_bytes(b[q : q + extra], "big") + 1 if extra else BLOCK_SIZES[size]
    q += extra + {12: 1, 13: 2, 14: 2}.get(rate, 0)
    check = 0
    for x in b[p:q]:
        check = CRC8[check ^ x]
    return (number, samples, b[p + 1] & 1) if q < len(b) and check == b[q] else None


def _flac(b: bytes, at: int) -> int | None:
    """Frame by frame: a frame ends where its checksum comes out even and the next one begins, the last where it first does."""
    p, total = at + 4, 0
    while True:
        if p + 4 > len(b):
            return None
        kind, size = b[p], int.from_bytes(b[p + 1 : p + 4], "big")
        if kind & 127 == 0 and size == 34:
            total = int.from_bytes(b[p + 17 : p + 22], "big") & (1 << 36) - 1
        p += 4 + size
        if kind & 128:
            break
    seen, frame = 0, _flac_frame(b, p)
    while frame is not None:
        number, samples, counted = frame
        seen, frame, even, check = seen + samples, None, None, 0
        for e in range(p, len(b)):
            check = check << 8 & 0xFFFF ^ CRC16[check >> 8 ^ b[e]]
            if check == 0 and e - p > 8:
                even = even or e + 1
                if total and seen >= total:
                    break
                after = _flac_frame(b, e + 1)
                if after and after[2] == counted and after[0] == number + (samples if counted else 1):
                    p, frame = e + 1, after
                    break
        if frame is None:
            return even - at if even and (not total or seen >= total) else None
    return None


def _mp4(b: bytes, at: int) -> int | None:
    p, kinds = at - 4, set()
    while p + 8 <= len(b):
        (size,), kind = struct.unpack_from(">I", b, p), b[p + 4 : p + 8]
        if size < 8 or p + size > len(b) or not kind.isalnum():
            break
        kinds.add(kind)
        p += size
    return p - (at - 4) if b"moov" in kinds or b"mdat" in kinds else None


#: Media type, magic bytes, where in the file they stand, validator (gives the length).
FORMATS: list[tuple[str, bytes, int, Callable[[bytes, int], int | None]]] = [
    ("image/png", b"\x89PNG\r\n\x1a\n", 0, _png),
    ("image/gif", b"GIF87a", 0, _gif),
    ("image/gif", b"GIF89a", 0, _gif),
    ("image/jpeg", b"\xff\xd8\xff", 0, _jpeg),
    ("image/bmp", b"BM", 0, _bmp),
    ("audio/wav", b"RIFF", 0, _riff(b"WAVE")),
    ("image/webp", b"RIFF", 0, _riff(b"WEBP")),
    ("application/pdf", b"%PDF-", 0, _pdf),
    ("application/gzip", b"\x1f\x8b\x08", 0, _gzip),
    ("application/zip", b"PK\x03\x04", 0, _zip),
    ("audio/flac", b"fLaC", 0, _flac),
    ("video/mp4", b"ftyp", 4, _mp4),
]
_automaton = None


def _magic():
    global _automaton
    if _automaton is None:
        import ahocorasick

        _automaton, by = ahocorasick.Automaton(), {}
        for k, (_, magic, _, _) in enumerate(FORMATS):
            by.setdefault(magic, []).append(k)
        for magic, kinds in by.items():
            _automaton.add_word(magic.decode("latin-1"), (len(magic), kinds))
        _automaton.make_automaton()
    return _automaton


def locate(data: bytes) -> list[tuple[int, int, str]]:
    """(start, length, type) of every confirmed medium in ``data``, by start.

    A medium inside one that is already confirmed (other than the file itself) belongs to it.
    """
    found, busy, data = [], 0, data if isinstance(data, Data) else Data(data)
    for end, (size, kinds) in _magic().iter(data.decode("latin-1")):
        at = end + 1 - size
        for kind, _, shift, check in (FORMATS[k] for k in kinds):
            if at >= shift and at >= busy and (n := check(data, at)):
                found.append((at - shift, n, kind))
                busy = at - shift + n if at > shift else busy
                break
    return found


def sniff(data: bytes) -> tuple[str, int, list[tuple[int, int, str]]]:
    """The confirmed type of the whole, its length, and the media embedded in or behind it."""
    found = locate(data)
    kind, size = next(((k, n) for at, n, k in found if at == 0), ("application/octet-stream", 0))
    return kind, size, [x for x in found if x[0]]


def sniff_media(df: DataFrame, data: str, declared: str) -> DataFrame:
    """Each row's key columns with detected_type, detected_bytes, corrected and carved.

    ``carved`` is an array of (start, length, type). Null data is empty data: type
    application/octet-stream, nothing carved. ``corrected`` says that a confirmed type
    differs from the declared one; an unconfirmed one corrects nothing. Other columns,
    whatever their names, are left out but for ``data`` and ``declared``.
    """
    slim = df.select(df[data].alias("data"), df[declared].alias("declared"))
    kind = "data binary, declared string, detected_type string, detected_bytes long, corrected boolean, carved array<struct<start: long, length: long, type: string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = [sniff(x or b"") for x in b.column("data").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "data": b.column("data"),
                "declared": b.column("declared"),
                "detected_type": pa.array([k for k, _, _ in seen], pa.string()),
                "detected_bytes": pa.array([n for _, n, _ in seen], pa.int64()),
                "corrected": pa.array([bool(n) and k != d for (k, n, _), d in zip(seen, b.column("declared").to_pylist(), strict=True)], pa.bool_()),
                "carved": pa.array([[{"start": s, "length": n, "type": k} for s, n, k in c] for _, _, c in seen], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("type", pa.string())]))),
            })

    return slim.mapInArrow(run, kind)


def to_wav(payload: bytes, rate: int = 8000) -> bytes:
    """A mono WAV file of 8-bit samples; a sample is a byte of the payload."""
    pad = len(payload) & 1
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload + b"\0" * pad


def samples(wav: bytes) -> bytes:
    """The samples of a WAV file: of its first data chunk."""
    p = 12
    while p + 8 <= len(wav):
        size = struct.unpack_from("<I", wav, p + 4)[0]
        if wav[p : p + 4] == b"data":
            return wav[p + 8 : p + 8 + size]
        p += 8 + (size + 1) // 2 * 2
    raise ValueError("a WAV file without data")


def feature(wav: bytes, declared: str) -> str:
    """What the signatures and the samples say of a stored medium."""
    kind, size, carved = sniff(wav)
    s = np.frombuffer(samples(wav), np.uint8)
    level = int(s.astype(np.int64).sum()) if len(s) else 0
    above = s >= 128
    crossings = int(np.count_nonzero(above[1:] != above[:-1]))
    return f"{kind};{size};{'corrected' if kind != declared else 'as declared'};carved={len(carved)}:{sum(n for _, n, _ in carved)};level={level};crossings={crossings}"


def media_digest(documents: DataFrame, declared: str = "text/plain") -> DataFrame:
    """Store each text as a WAV medium, read it back and describe it.

    Null texts are empty: one unit of 192 spaces. Rows with a null or repeated doc_id are
    kept as they are; an empty table gives an empty result. Memory: one batch of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b.column("text"))
            rows = []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                text = data[lo:hi].tobytes()
                stored = to_wav(text + b" " * (-len(text) % UNIT or (0 if text else UNIT)))
                payload = samples(stored)
                rows.append((len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(stored, declared)))
            names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names])

    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )
