"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton lists the tokens that start at each place of a word. The
encoder takes the longest and keeps it if the pair with the token before it is one
that the merges would leave apart; if no match fits, it takes back the last token and
tries the next shorter one, never visiting a dead place twice. That is linear in the
word and gives exactly the tokens of the merge rules.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CACHE_WORDS = 250_000  # words; runs, which hold less, half of it
CACHE_BYTES = 64 << 20  # of a cache's texts and values
LONG = 1 << 14  # characters of a word whose matches are listed at once; longer ones are never cached
SETTLED = re.compile(r"[!-~\u00A1-\u0233]*")
END = 256  # a word's last byte b stands as chr(END + b) where the vocabulary marks word ends
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Vocabulary and merge rules of a byte-level BPE model, with its pair table."""

    def __init__(self, model: dict):
        import ahocorasick

        letters, self.suffix = byte_letters(), model.get("end_of_word_suffix") or ""
        self.vocab = model["vocab"]

        def spelled(token: str) -> str:
            ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
            body = [letters[c] for c in (token[: -len(self.suffix)] if ends else token)]
            return "".join(map(chr, body[:-1])) + chr(body[-1] + END * ends)

        self.ids = {spelled(t): k for t, k in self.vocab.items() if t}
        self.rank, self.parts, self.merged = {}, {}, {}
        for r, pair in enumerate(model["merges"]):
            a, b = (self.vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = self.ids[self._text(a) + self._text(b)]
            self.merged[a, b] = r
            if whole not in self.rank:
                self.rank[whole], self.parts[whole] = r, (a, b)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        made = set()
        for text, k in sorted(self.ids.items(), key=lambda x: self.rank.get(x[1], -1)):
            if k not in self.parts or all(p in made or p not in self.parts for p in self.parts[k]) and self._apart(*self.parts[k], float("inf"), True):
                made.add(k)  # the merges do make this token of its text
                self.automaton.add_word(text, (k, len(text)))
        self.automaton.make_automaton()
        self.longest = max(map(len, self.ids))

    def _text(self, token: int) -> str:
        if not hasattr(self, "_texts"):
            self._texts = {k: t for t, k in self.ids.items()}
        return self._texts[token]

    def _apart(self, a: int, b: int, limit: float, made: bool = False) -> bool:
        """Whether no merge joins a's end to b's start before both are complete.

        Takes the two tokens apart from the latest merge back; a merge across the border
        that outranks the merge just taken back would have come first. Equal ranks go
        from left to right. ``made``: the merge of the whole pair itself is allowed.
        """
        rank, merged = self.rank, self.merged
        while True:
            if not made and merged.get((a, b), limit) < limit:
                return False
            made = False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra > rb:
                limit, a = ra, self.parts[a][1]
            elif rb >= 0:
                limit, b = rb + 1, self.parts[b][0]
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > CACHE_WORDS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._apart(a, b, float("inf"))
        return known

    def encode(self, word: bytes) -> list[int] | array:
        text = word.decode("latin-1")
        if self.suffix:
            text = text[:-1] + chr(END + word[-1])
        if len(text) > LONG:
            return self._encode(text, _Starts(self.automaton, text, self.longest), array("q"), array("i"), array("I"))
        starts: list[list[tuple[int, int]]] = [[] for _ in text]
        for end, (token, size) in self.automaton.iter(text):
            starts[end + 1 - size].append((token, size))  # shortest first
        return self._encode(text, starts, [], [], [])

    def _encode(self, text: str, starts, place, taken, out):
        """The tokens in ``out``; places and choices of the tokens so far are in ``place`` and ``taken``."""
        dead, at, size_of, pairs = set(), 0, len(text), self.pairs
        here = starts[0]
        choice, last = len(here) - 1, -1
        while at < size_of:
            while choice >= 0:
                token, size = here[choice]
                if at + size not in dead and (last < 0 or (pairs[last, token] if (last, token) in pairs else self.fits(last, token))):
                    break
                choice -= 1
            if choice >= 0:
                place.append(at)
                taken.append(choice)
                out.append(token)
                at, last = at + size, token
                if at < size_of:
                    here = starts[at]
                    choice = len(here) - 1
            else:
                dead.add(at)
                out.pop()
                at, choice = place.pop(), taken.pop() - 1
                last, here = out[-1] if out else -1, starts[at]
        return out


class _Starts:
    """The matches that start at each place of a word, shortest first, made block by block."""

    def __init__(self, automaton, text: str, longest: int):
        self.automaton, self.text, self.longest, self.blocks = automaton, text, longest, {}

    def __getitem__(self, at: int) -> list[tuple[int, int]]:
        block = at // LONG
        if block not in self.blocks:
            if len(self.blocks) > 2:  # going back further makes them again
                self.blocks.clear()
            lo, hi = block * LONG, min(len(self.text), (block + 1) * LONG)
            found: list[list[tuple[int, int]]] = [[] for _ in range(hi - lo)]
            for end, (token, size) in self.automaton.iter(self.text, lo, min(len(self.text), hi + self.longest)):
                if lo <= end + 1 - size < hi:
                    found[end + 1 - size - lo].append((token, size))
            self.blocks[block] = found
        return self.blocks[block][at - block * LONG]


class _Runs(dict):
    """Values of runs of text, bounded in entries and in bytes; very long runs are not kept."""

    def __init__(self, make, most=CACHE_WORDS, most_bytes=CACHE_BYTES):
        super().__init__()
        self.make, self.most, self.most_bytes, self.held = make, most, most_bytes, 0

    def __missing__(self, run):
        value = self.make(run)
        size = len(run)
        if size > LONG:
            return value
        if self.held > self.most_bytes or len(self) > self.most:
            self.clear()
            self.held = 0
        self.held += 4 * size + 64 + (len(value) if value.__class__ is bytes else 0)
        self[run] = value
        return value


class WordCodec:
    """The tokenizer of a word-level BPE file: NFC, lower case, words, merges.

    Letters whose classes no Unicode version has changed are lower-cased and cut into
    words here; runs with others go through the library's own normalizer and word cutter,
    which know the Unicode version that its results rest on.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Merges(spec["model"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.marks = sorted({s[:2] for s in self.special})
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        library = Tokenizer.from_file(path)
        self.normalizer, self.cutter, self.letters = library.normalizer, library.pre_tokenizer, byte_letters()
        little = sys.byteorder == "little" and array("I").itemsize == 4
        self.word_ids = _Runs(lambda w: array("I", self.merges.encode(w.encode())).tobytes() if little else np.array(self.merges.encode(w.encode()), "<u4").tobytes())
        self.run_ids = _Runs(self._run, CACHE_WORDS // 2)
        names = {k: t for t, k in spec["model"]["vocab"].items()} | {k: t for t, k in self.special.items()}
        pieces = [names.get(k, "").encode() + b" " for k in range(max(names) + 1)]
        self.offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        self.table = np.frombuffer(b"".join(pieces), np.uint8)

    def _run(self, run: str) -> bytes:
        if SETTLED.fullmatch(run):  # composed already, and no letter's lower case depends on its place
            return b"".join(map(self.word_ids.__getitem__, self.words.findall(run.lower())))
        words = self.cutter.pre_tokenize_str(self.normalizer.normalize_str(run))
        return b"".join(self.word_ids[bytes(map(self.letters.__getitem__, w)).decode()] for w, _ in words)

    def _plain(self, text: str) -> bytes:
        runs = [r for r in WHITE.split(text) if r] if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        return b"".join(map(self.run_ids.__getitem__, runs))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not any(m in text for m in self.marks):
            return self._plain(text)
        return b"".join(np.uint32(self.special[p]).tobytes() if p in self.special else self._plain(p) for p in self.cut.split(text))

    def decode(self, ids: np.ndarray, block: int = 1 << 18) -> Iterator[bytes]:
        """The tokens with a space between, in blocks: each id's bytes by the offset table."""
        for lo in range(0, len(ids), block):
            k = ids[lo : lo + block].astype(np.int64)
            at, size = self.offsets[k], self.offsets[k + 1] - self.offsets[k]
            ends = np.cumsum(size)
            text = self.table[np.arange(ends[-1]) + np.repeat(at - ends + size, size)].tobytes()
            yield text[:-1] if lo + block >= len(ids) else text


_codecs: dict[str, WordCodec] = {}


def codec(path: str) -> WordCodec:
    """One codec for each Python worker and file."""
    if path not in _codecs:
        _codecs[path] = WordCodec(path)
    return _codecs[path]


def bpe_encode(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids: the token ids of each whole text.

    Null and empty texts have no ids; null and repeated doc_ids are kept as they are.
    Further columns are left out, so their names cannot clash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for b in batches:
            texts = b.column("text")
            for lo in range(0, len(texts), 500):
                ids = [np.frombuffer(code.encode(t or ""), "<u4") for t in texts[lo : lo + 500].to_pylist()]
                counts = np.array([len(x) for x in ids], np.int64)
                flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[lo : lo + 500], pa.array(counts), lists], names=["doc_id", "n_tokens", "ids"])

    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text: the tokens of each ids array with a space between; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for b in batches:
            texts = [None if x is None else b"".join(code.decode(np.array(x, np.int64))).decode() for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(encoded["doc_id"].cast("long").alias("doc_id"), encoded["ids"].alias("ids")).mapInArrow(run, "doc_id long, text string")


def bpe_digest(documents: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encode, decode and digest each whole text; ``with_ids`` adds the ids themselves.

    Null and empty texts have no tokens and the digests of no bytes; null and repeated
    doc_ids are kept as they are.
    """
    sha = lambda parts: (h := hashlib.sha256(), [h.update(p) for p in parts])[0].hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for b in batches:
            texts = b.column("text")
            for lo in range(0, len(texts), 500):
                raw = [code.encode(t or "") for t in texts[lo : lo + 500].to_pylist()]
                ids = [np.frombuffer(x, "<u4") for x in raw]
                columns = {
                    "doc_id": b.column("doc_id")[lo : lo + 500],
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "ids_sha256": pa.array([sha([x]) for x in raw], pa.string()),
                    "decoded_sha256": pa.array([sha(code.decode(x)) for x in ids], pa.string()),
                }
                if with_ids:
                    at = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(raw), "<i4")))
                yield pa.RecordBatch.from_pydict(columns)

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text")).mapInArrow(run, kind)
