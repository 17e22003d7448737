"""Shard files of token ids with a minimal perfect hash index.

A shard holds, in ascending doc_id order, the raw ids of its documents. Its index maps
a document key to the place of its ids: a first hash picks a bucket, the bucket's stored
seed sends each of its keys to a slot of its own, and a stored fingerprint tells other
keys apart, so that a keyed read is a constant number of small reads.

Layout, little-endian: header; seeds u32 for each bucket; fingerprints u32 and document
ordinals u32 for each slot; document keys i64; null flags u8; id offsets u64 (one more
than documents); ids u16 or u32.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from quillboard.llm._arrow import chunks, mix, utf8
from quillboard.llm._scratch import Scratch
from quillboard.llm.bpe import byte_letters

MAGIC = b"QBTOKEN1"
HEADER = struct.Struct("<8sIIIIQ")  # magic, bytes of an id, buckets, slots, documents, ids
DIRECT = 1 << 31  # a seed with this bit names the slot of a bucket's only key
SEED = np.uint64(0x9E3779B97F4A7C15)
CACHE_PIECES = 900_000
CACHE_CHARS = 32 << 20
#: The words of the byte-level tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNSETTLED = re.compile(r"[^\n -~\u00A1-\u0233]")
BATCH_BYTES = 8 << 20
#: Classes of UTF-8 bytes: white space that texts are cut at, ASCII that is no letter, ASCII letters, and the lead and
#: last bytes of two-byte letters (U+00C0 to U+023F; the signs of times and division are none, nor what ends like them).
BLANK, MARK, LETTER, LEAD, LAST = 1, 2, 4, 8, 16
CLASSES = bytes((BLANK * (b in b"\n ") | (LETTER if chr(b).isalpha() else MARK)) if b < 128 else LEAD if 0xC3 <= b <= 0xC8 else LAST if b < 0xC0 and b not in (0x97, 0xB7) else 0 for b in range(256))
OTHER_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def _slot(keys: np.ndarray, seed: np.ndarray | int, slots: int) -> np.ndarray:
    # an array, as numpy warns of scalars that go beyond 2^64
    return mix(keys.view(np.uint64) + (np.atleast_1d(np.asarray(seed, np.uint64)) + np.uint64(1)) * SEED) % np.uint64(slots)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket seeds, and the slot of each of the distinct int64 keys: no slot stays free."""
    n = len(keys)
    seeds, slots = np.zeros(max(1, (n + 3) // 4), np.uint32), np.zeros(n, np.int64)
    if not n:
        return seeds, slots
    bucket = (mix(keys.view(np.uint64)) % np.uint64(len(seeds))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    groups = sorted(np.split(order, cuts), key=len, reverse=True)
    free, tries = np.ones(n, bool), np.arange(64, dtype=np.uint64)
    alone = [g[0] for g in groups if len(g) == 1]
    for g in groups[: len(groups) - len(alone)]:
        seed = 0
        while True:
            at = np.sort(_slot(keys[g][None, :], tries[:, None] + np.uint64(seed), n).astype(np.int64), axis=1)
            good = np.flatnonzero(free[at].all(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1))
            if len(good):
                break
            seed += len(tries)
        seed += int(good[0])
        slots[g] = _slot(keys[g], seed, n).astype(np.int64)
        free[slots[g]], seeds[bucket[g[0]]] = False, seed
    for k, place in zip(alone, np.flatnonzero(free), strict=True):
        slots[k], seeds[bucket[k]] = place, DIRECT | int(place)
    return seeds, slots


def pack(keys: list[int | None], ids: list[np.ndarray], id_bytes: int) -> bytes:
    """A shard file of documents in key order; a repeated key is indexed by its first document."""
    null = np.array([k is None for k in keys], np.uint8)
    key = np.array([0 if k is None else k for k in keys], np.int64)
    shown, first = np.unique(key[null == 0], return_index=True)
    ordinal = np.flatnonzero(null == 0)[first].astype(np.uint32)
    seeds, slots = build_index(shown)
    prints, ordinals = np.zeros(len(shown), np.uint32), np.zeros(len(shown), np.uint32)
    prints[slots], ordinals[slots] = _fingerprint(shown), ordinal
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.uint64)
    head = HEADER.pack(MAGIC, id_bytes, len(seeds), len(shown), len(keys), int(offsets[-1]))
    payload = np.concatenate(ids).astype(f"<u{id_bytes}") if ids else np.empty(0, np.uint8)
    return b"".join((head, seeds.tobytes(), prints.tobytes(), ordinals.tobytes(), key.tobytes(), null.tobytes(), offsets.tobytes(), payload.tobytes()))


class Shard:
    """Random access to a shard in an open file (anything with seek and read)."""

    def __init__(self, file):
        self.file = file
        magic, self.id_bytes, self.buckets, self.slots, self.documents, self.ids = HEADER.unpack(file.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        sizes = [4 * self.buckets, 4 * self.slots, 4 * self.slots, 8 * self.documents, self.documents, 8 * (self.documents + 1)]
        self.seeds, self.prints, self.ordinals, self.keys, self.nulls, self.offsets, self.payload = (HEADER.size + sum(sizes[:k]) for k in range(7))

    def read(self, at: int, kind: str, n: int) -> np.ndarray:
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * np.dtype(kind).itemsize), kind)

    def find(self, key: int) -> int | None:
        """The ordinal of the first document of a key, or None; four small reads however large the shard is."""
        if not self.slots:
            return None
        k = np.array([key], np.int64)
        seed = int(self.read(self.seeds + 4 * int(mix(k.view(np.uint64))[0] % np.uint64(self.buckets)), "<u4", 1)[0])
        slot = seed ^ DIRECT if seed & DIRECT else int(_slot(k, seed, self.slots)[0])
        if self.read(self.prints + 4 * slot, "<u4", 1)[0] != _fingerprint(k)[0]:
            return None
        ordinal = int(self.read(self.ordinals + 4 * slot, "<u4", 1)[0])
        return ordinal if self.read(self.keys + 8 * ordinal, "<i8", 1)[0] == key else None

    def at(self, ordinal: int) -> np.ndarray:
        """The ids of a document by its place in the shard."""
        lo, hi = (int(x) for x in self.read(self.offsets + 8 * ordinal, "<u8", 2))
        return self.read(self.payload + lo * self.id_bytes, f"<u{self.id_bytes}", hi - lo)

    def get(self, key: int) -> np.ndarray | None:
        """The ids of the first document of a key, or None."""
        ordinal = self.find(key)
        return None if ordinal is None else self.at(ordinal)

    def every(self, key: int) -> Iterator[np.ndarray]:
        """The ids of each document of a key: they stand side by side."""
        ordinal = self.find(key)
        while ordinal is not None and ordinal < self.documents and self.read(self.keys + 8 * ordinal, "<i8", 1)[0] == key:
            yield self.at(ordinal)
            ordinal += 1

    def lookup(self, wanted: np.ndarray) -> np.ndarray:
        """The ordinal of the first document of each int64 key, -1 where the shard has none: one pass over the index."""
        if not self.slots or not len(wanted):
            return np.full(len(wanted), -1, np.int64)
        seeds, prints, ordinals = self.read(self.seeds, "<u4", self.buckets), self.read(self.prints, "<u4", self.slots), self.read(self.ordinals, "<u4", self.slots)
        seed = seeds[(mix(wanted.view(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(seed & np.uint32(DIRECT), (seed ^ np.uint32(DIRECT)).astype(np.uint64), _slot(wanted, seed, self.slots)).astype(np.int64)
        ordinal = np.where(prints[slot] == _fingerprint(wanted), ordinals[slot].astype(np.int64), -1)
        keys = self.read(self.keys, "<i8", self.documents)
        return np.where((ordinal >= 0) & (keys[ordinal] == wanted), ordinal, -1)

    def scan(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(key, ids before it in the shard, ids) of each document, fetched through the index.

        Documents without a key stand first; the index names the first document of each
        other key and those that share it follow. A key that the index sends elsewhere is
        an error.
        """
        keys, nulls, offsets = self.read(self.keys, "<i8", self.documents), self.read(self.nulls, "u1", self.documents), self.read(self.offsets, "<u8", self.documents + 1).astype(np.int64)
        shown, first, times = np.unique(keys[nulls == 0], return_index=True, return_counts=True)
        found = self.lookup(shown)
        if not np.array_equal(found, np.flatnonzero(nulls == 0)[first]):
            raise ValueError("the index does not lead to the documents of the shard")
        for ordinal in [*np.flatnonzero(nulls).tolist(), *(np.repeat(found, times) + np.concatenate([np.arange(n) for n in times.tolist()] or [np.empty(0, np.int64)])).astype(np.int64).tolist()]:
            lo, hi = int(offsets[ordinal]), int(offsets[ordinal + 1])
            yield None if nulls[ordinal] else int(keys[ordinal]), lo, self.read(self.payload + lo * self.id_bytes, f"<u{self.id_bytes}", hi - lo)


def cut(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """The starts of the pieces of texts of UTF-8 bytes, in ascending order; each text begins a piece of its own.

    A piece ends before white space, between letters and the ASCII marks or digits behind
    them, and behind a line end that stands alone before other characters.
    """
    kind = np.frombuffer(data.translate(CLASSES), np.uint8)
    blank = kind & BLANK != 0
    letter = kind & LETTER != 0
    letter[1:] |= (kind[:-1] & LEAD != 0) & (kind[1:] & LAST != 0)
    first = np.zeros(len(data) + 1, bool)
    first[1:-1] = (blank[1:] & ~blank[:-1]) | (letter[:-1] & (kind[1:] & MARK != 0))
    first[offsets] = True
    ends = np.flatnonzero(np.frombuffer(data, np.uint8)[:-1] == 10)
    first[ends[first[ends] & ~blank[ends + 1]] + 1] = True
    return np.flatnonzero(first[:-1])


class Encoder:
    """A byte-level tokenizer of the tokenizers library, asked only once for each piece.

    Its words never cross from a run of other characters into the spaces or line ends
    behind it, nor from letters into ASCII marks and digits, nor from a single line end
    into what follows, so a text's ids are those of its pieces. The texts of a batch are
    cut together and their distinct pieces found by Arrow. A new piece of letters whose
    classes no Unicode version has changed is cut into words here and its words go to the
    library's model at once; other pieces go through the whole of the library, and so do
    texts with other white space or with a special token in them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.words = regex.compile(WORDS)
        self.letters = {b: c for c, b in byte_letters().items()}
        self.space = self.letters[ord(" ")]
        self.apart = OTHER_WHITE + [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.id_bytes = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _spelt(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.letters)

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces: those of plain letters by the library's model, word by word."""
        code, other = "H" if self.id_bytes == 2 else "I", []
        for piece in pieces:
            bare = piece[1:] if piece[0] == " " else piece
            if UNSETTLED.search(piece):
                other.append(piece)
                continue
            if bare.isalpha() and piece.isascii():  # a single word, and its letters spell themselves
                tokens = self.model.tokenize(self.space + bare if bare is not piece else bare)
            elif bare.isalpha():
                tokens = self.model.tokenize(self._spelt(piece))
            else:
                tokens = [t for word in self.words.findall(piece) for t in self.model.tokenize(self._spelt(word))]
            self.known[piece] = array(code, [t.id for t in tokens]).tobytes()
        for lo in range(0, len(other), 1000):
            some = other[lo : lo + 1000]
            self.known.update(zip(some, (array(code, e.ids).tobytes() for e in self.library.encode_batch_fast(some, add_special_tokens=False)), strict=True))
        self.held += sum(map(len, pieces))

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts without other white space or special tokens."""
        coded = [t.encode() for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in coded]))).astype(np.int64)
        joined = b"".join(coded)
        starts = cut(joined, offsets)
        bounds = np.append(starts, len(joined)).astype(np.int64)
        distinct = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(joined)).dictionary_encode()
        pieces, which = distinct.dictionary.to_numpy(zero_copy_only=False).tolist(), distinct.indices.to_numpy()
        if len(self.known) > CACHE_PIECES or self.held > CACHE_CHARS:
            self.known.clear()
            self.held = 0
        ids = list(map(self.known.get, pieces))
        if new := [k for k, x in enumerate(ids) if x is None]:
            self._learn([pieces[k] for k in new])
            for k in new:
                ids[k] = self.known[pieces[k]]
        flat = np.frombuffer(b"".join(ids), f"<u{self.id_bytes}")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.id_bytes
        before, sizes = (np.cumsum(size) - size)[which], size[which]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        out = flat[np.repeat(before - ends[:-1], sizes) + np.arange(ends[-1])]
        return np.split(out, ends[np.searchsorted(starts, offsets[1:-1])])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, f"<u{self.id_bytes}")] * len(texts)
        plain: list[int] = []
        for k, t in enumerate(texts):
            if any(s in t for s in self.apart):
                out[k] = np.array(self.library.encode(t, add_special_tokens=False).ids, f"<u{self.id_bytes}")
            elif t:
                plain.append(k)
        if plain:
            for k, ids in zip(plain, self._together([texts[k] for k in plain]), strict=True):
                out[k] = ids
        return out


_encoders: dict[str, Encoder] = {}


def _open(path: str, mode: str):
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    if mode == "r":
        return store.open_input_file(at)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    return store.open_output_stream(at)


MANIFEST = "path string, part int, number int, first_doc long, last_doc long, n_docs long, n_ids long"


def write_token_files(documents: DataFrame, tokenizer: str, folder: str, end_id: int, scratch: Scratch, shard_bytes: int = 16 << 20) -> DataFrame:
    """Write the ids of all texts as shard files below ``folder``; returns the manifest.

    The manifest (path, part, number, first_doc, last_doc, n_docs, n_ids) has a row for
    each file. A task that runs again writes other files; only those of the attempt that
    ended well are in the manifest. Null texts are empty, null doc_ids come first,
    documents that share a doc_id (or have none) stand side by side in the order of a hash
    of their texts, so that many of them are spread over tasks. ``shard_bytes`` bounds a
    file's ids but for one longer document. Further columns are left out.
    """
    ordered = documents.select(documents["doc_id"].cast("long").alias("doc_id"), F.coalesce(documents["text"], F.lit("")).alias("text")).withColumn("spread", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        encoder, part, number = _encoders[tokenizer], TaskContext.get().partitionId(), 0
        keys, ids, held = [], [], 0

        def flush():
            nonlocal keys, ids, held, number
            path = f"{folder}/{part:06d}-{number:06d}-{uuid.uuid4().hex[:8]}.ids"
            with _open(path, "w") as f:
                f.write(pack(keys, ids, encoder.id_bytes))
            row = (path, part, number, keys[0], keys[-1], len(keys), sum(len(x) for x in ids))
            keys, ids, held, number = [], [], 0, number + 1
            return pa.RecordBatch.from_pylist([dict(zip(kind.names, row, strict=True))], schema=kind)

        kind = pa.schema([("path", pa.string()), ("part", pa.int32()), ("number", pa.int32()), *((n, pa.int64()) for n in ("first_doc", "last_doc", "n_docs", "n_ids"))])
        for b in batches:
            for lo, hi in chunks(utf8(b.column("text"))[1], BATCH_BYTES):
                some = b.slice(lo, hi - lo)
                for key, x in zip(some.column("doc_id").to_pylist(), encoder.encode(some.column("text").to_pylist()), strict=True):
                    if keys and held + (len(x) + 1) * encoder.id_bytes > shard_bytes:
                        yield flush()
                    keys.append(key)
                    ids.append(np.append(x, np.array([end_id], x.dtype)))
                    held += ids[-1].nbytes
        if keys:
            yield flush()

    return scratch.table("manifest", ordered.mapInArrow(run, MANIFEST))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back through the index of each file.

    ``start`` counts the ids of all documents before it: those of the parts before (a row
    for each write task), of the part's files before, and of the file's documents before.
    Each file is read by a task of its own.
    """
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))  # a row for each write task
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids")
    files = manifest.select("path", "part", within.alias("within")).join(parts, "part").select("path", (F.col("before") + F.col("within")).alias("base"))
    files = files.repartition(max(1, manifest.count()), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True):
                with _open(path, "r") as f:
                    rows = [(key, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for key, start, ids in Shard(f).scan()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup_token_files(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """doc_id, ids of the wanted keys: each key finds its files by range and its ids by the perfect hash.

    Files and keys meet in ranges of doc_ids of one width, so neither side is broadcast; a
    file that spans several ranges stands in each. A key that no file holds gives no row, a
    null key neither; a key that several documents share gives a row for each, whether they
    stand in one file or in several.
    """
    wanted = keys.select(keys["doc_id"].cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    files = manifest.where("last_doc is not null").select("path", F.col("first_doc").alias("first"), F.col("last_doc").alias("last"))
    low, high, n = files.agg(F.min("last"), F.max("last"), F.count("*")).first()
    low, width = low or 0, max(1, ((high or 0) - (low or 0)) // max(1, n) + 1)
    place = lambda c: F.floor((F.greatest(c, F.lit(low)) - low) / width)
    spans = files.select("path", "first", "last", F.explode(F.sequence(place(F.coalesce("first", F.lit(low))), place(F.col("last")))).alias("range"))
    met = wanted.withColumn("range", place(F.col("doc_id"))).join(spans, "range").where("doc_id <= last and (first is null or doc_id >= first)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths, doc = np.array(b.column("path").to_pylist(), object), b.column("doc_id").to_numpy()
            for path in dict.fromkeys(paths.tolist()):
                some = doc[paths == path]
                with _open(path, "r") as f:
                    shard = Shard(f)
                    got = [(k, ids.astype(np.int64)) for k in some.tolist() for ids in shard.every(k)]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.int64()), pa.array([x for _, x in got], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return met.select("path", "doc_id").repartition("path").sortWithinPartitions("path").mapInArrow(run, "doc_id long, ids array<long>")
