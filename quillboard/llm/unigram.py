"""Token counts of a unigram model, without building the tokens.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each place of
a word; a Viterbi pass carries the best score and its number of pieces. Ties go to the
earlier start, an unknown character scores ten below the worst piece and counts as its
UTF-8 bytes, as in the tokenizers library's unigram model with byte fallback.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quillboard.llm.bpe import LONG, WHITE, _Runs

UNKNOWN_PENALTY = 10.0
SPACE_MARK = "▁"


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores, by id, of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max(len(p) for p, _ in pieces)
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.counted = _Runs(self.count, 500_000)

    def count(self, run: str) -> tuple[int, float]:
        """Pieces and score of the best segmentation of one word, its space mark included.

        The word goes by in blocks; of the places before a block only as many are held as
        the longest piece has characters.
        """
        word = SPACE_MARK + run
        score, pieces, base = [0.0], [0], 0  # of the places from base on
        for lo in range(0, len(word), LONG):
            hi = min(len(word), lo + LONG)
            single = bytearray(hi - lo)
            ends: list[list[tuple[int, float]]] = [[] for _ in range(hi - lo)]
            for end, match in self.automaton.iter(word, max(0, lo - self.longest), hi):
                if end >= lo:
                    ends[end - lo].append(match)  # longest first
                    single[end - lo] |= match[0] == 1
            for at in range(lo, hi):
                best, n = float("-inf"), 0
                for size, s in ends[at - lo]:
                    if (x := score[at + 1 - size - base] + s) > best:
                        best, n = x, pieces[at + 1 - size - base] + 1
                if not single[at - lo] and (x := score[-1] + self.unknown) > best:
                    best, n = x, pieces[-1] + len(word[at].encode())
                score.append(best)
                pieces.append(n)
            if hi < len(word):
                base = max(base, hi - self.longest)
                score, pieces = score[-(hi - base + 1) :], pieces[-(hi - base + 1) :]
        return pieces[-1], score[-1]


_counters: dict[str, Counter] = {}


def count_tokens(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens, score of each whole text under the vocabulary at ``path``.

    Words are what stands between white space; score is the sum of their best scores.
    Null and empty texts count 0 words, 0 tokens and score 0; null and repeated doc_ids
    are kept. Further columns are left out, so their names cannot clash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(vocabulary(path))
        known = _counters[path].counted.__getitem__
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                text = text or ""
                words = [r for r in WHITE.split(text) if r] if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
                tokens, scores = zip(*map(known, words), strict=True) if words else ((), ())
                rows.append((len(words), sum(tokens), float(sum(scores))))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["doc_id", "n_words", "n_tokens", "score"]
            )

    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text")).mapInArrow(run, "doc_id long, n_words long, n_tokens long, score double")
