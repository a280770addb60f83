"""Token counts by a linear longest-match automaton.

The vocabulary is a trie with two roots, one for pieces that start a word and one
for pieces that continue it. Each node has a failure link and the number of
pieces that are complete when it is taken. A word is read once, character by
character; the sum of those numbers is the count of greedy longest-match pieces.
No piece is built.
"""

from __future__ import annotations

import hashlib
from collections import deque

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import in_arrow

WORD_START = "▁"
_CACHED_WORDS = 500_000
_NONE = -1


class Automaton:
    """Counts greedy longest-match pieces of a word.

    ``first`` are the pieces that can start a word, ``inner`` those that can
    follow. A word that cannot be split counts as one unknown piece.
    """

    def __init__(self, first: set[str], inner: set[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in ((0, first), (1, inner)):
            for piece in pieces - {""}:
                node = root
                for char in piece:
                    if char not in self.next[node]:
                        self.next[node][char] = len(self.next)
                        self.next.append({})
                        whole.append(False)
                    node = self.next[node][char]
                whole[node] = True
        size = len(self.next)
        self.fail, self.popped = [_NONE] * size, [0] * size
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for char, child in self.next[node].items():
                queue.append(child)
                if whole[child]:
                    self.fail[child], self.popped[child] = 1, 1
                    continue
                back, popped = self.fail[node], self.popped[node]
                while back != _NONE and char not in self.next[back]:
                    popped += self.popped[back]
                    back = self.fail[back]
                if back != _NONE:
                    self.fail[child], self.popped[child] = self.next[back][char], popped

    def count(self, word: str) -> int:
        """Pieces of a word; 1 if it has no split, 0 if it is empty."""
        if not word:
            return 0
        node, total = 0, 0
        for char in word:
            while char not in self.next[node]:
                if self.fail[node] == _NONE:
                    return 1
                total += self.popped[node]
                node = self.fail[node]
            node = self.next[node][char]
        while node != 1:
            if self.fail[node] == _NONE:
                return 1
            total += self.popped[node]
            node = self.fail[node]
        return total


def pieces_of(model: bytes) -> tuple[set[str], set[str]]:
    """Pieces of a sentencepiece model that start a word, and the others.

    Control, unknown and byte pieces are left out.
    """
    reader = sentencepiece.SentencePieceProcessor(model_proto=model)
    usual = [
        reader.id_to_piece(i)
        for i in range(reader.get_piece_size())
        if not (reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i))
    ]
    return {p[1:] for p in usual if p[0] == WORD_START}, {p for p in usual if p[0] != WORD_START}


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = found = self.automaton.count(word.decode(errors="replace"))
        return found


_counters: dict[bytes, _Counts] = {}


def _counter(model: bytes) -> _Counts:
    """One per worker process, so that its words outlive a task."""
    key = hashlib.sha256(model).digest()
    if key not in _counters:
        _counters.clear()
        _counters[key] = _Counts(Automaton(*pieces_of(model)))
    return _counters[key]


def _count(model):
    def run(batches):
        counts = _counter(model.value)
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1).to_pylist():
                split = text.split()
                words.append(len(split))
                tokens.append(sum(map(counts.__getitem__, split)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, model: bytes) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_tokens of the whole text.

    Words are runs of characters other than ASCII white space; case counts.
    Null and empty texts have no words and no tokens. ``model`` is a
    sentencepiece model's bytes. Other columns are ignored.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return in_arrow(source, _count(shared), "doc_id bigint, n_words bigint, n_tokens bigint")
