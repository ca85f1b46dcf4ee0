"""Token counts by a unigram model, with forward scores shared along a trie.

A text's pre-tokens are its runs of letters and digits, led by the vocabulary's word mark
where white space or the text's begin stands before, and its runs of other signs.  The best segmentation of a pre-token maximises the sum of its pieces' log
probabilities; its forward score at a character depends only on the characters before,
so pre-tokens with a common beginning share it.  Distinct pre-tokens are inserted in a
trie whose nodes hold forward score and token count of their prefix; only nodes that are
new are computed, and the count at the last node of a pre-token is its terminal count.

The vocabulary is a public one that lists pieces by rank.  Its ranks stand for
probabilities by Zipf's law: the log probability of rank r is ``-log(r + 1)`` less a
constant.  A character that no piece covers is spelled in bytes, a token each, at the
probability of a rank beyond the last.  Of equal scores the segmentation with fewer tokens
counts, so the count is well defined.

Defined results: NULL, empty and blank texts have 0 tokens; equal texts have equal
counts; long texts and long words are whole; no rows give none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm.grams import slices

#: Leads every pre-token.
MARK = "▁"
#: Nodes of a trie; beyond them a task begins a new one, which changes no count.
NODES = 1_000_000
#: What a token costs besides its rank: with it, longer pieces beat more pieces.
CONSTANT = math.log(20.0)
_SLICE = 1 << 21

_PRETOKEN = re.compile(rf"{MARK}?\w+|{MARK}?[^\w\s{MARK}]+|{MARK}+")

RESULT = "doc_id bigint, n_tokens bigint, n_pretokens bigint, n_chars bigint"


def load_pieces(path: str) -> dict[str, float]:
    """Pieces of a public vocabulary with their log probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return {piece: -math.log(rank + 2) - CONSTANT for rank, piece in enumerate(plain)}


class Trie:
    """Pre-tokens inserted so far, with forward score and token count at each node."""

    def __init__(self, pieces: dict[str, float], nodes: int = NODES):
        self._most = nodes
        self._byte = -math.log(len(pieces) + 2) - CONSTANT
        self._pieces = ahocorasick.Automaton()
        for piece, gain in pieces.items():
            self._pieces.add_word(piece, (len(piece), gain))
        self._pieces.make_automaton()
        self._clear()

    def _clear(self) -> None:
        self._next: dict[tuple[int, str], int] = {}
        self._score, self._count = [0.0], [0]

    def count(self, word: str) -> int:
        """Tokens of a pre-token."""
        if len(self._score) > self._most:
            self._clear()
        table, counts = self._next, self._count
        path = [0]
        for char in word:
            child = table.get((path[-1], char))
            if child is None:
                self._extend(word, path)
                break
            path.append(child)
        return counts[path[-1]]

    def _extend(self, word: str, path: list[int]) -> None:
        """Add the nodes of ``word`` beyond those in ``path``, and their forward scores.

        The vocabulary's automaton names the pieces that end at each character.
        """
        table, scores, counts = self._next, self._score, self._count
        matches = self._pieces.iter(word)
        at, found = next(matches, (len(word), None))
        for end in range(len(word)):
            new = end >= len(path) - 1
            if new:
                spelled = len(word[end].encode("utf-8", "surrogatepass"))
                best = scores[path[end]] + spelled * self._byte
                fewest = counts[path[end]] + spelled
            while at == end:
                if new:
                    length, gain = found
                    before = path[end + 1 - length]
                    score, count = scores[before] + gain, counts[before] + 1
                    if score > best + 1e-9 or (score > best - 1e-9 and count < fewest):
                        best, fewest = score, count
                at, found = next(matches, (len(word), None))
            if new:
                table[path[end], word[end]] = len(scores)
                path.append(len(scores))
                scores.append(best)
                counts.append(fewest)


def pretokens(text: str) -> list[str]:
    """Pre-tokens of a text; the mark stands for white space before, or the begin."""
    return _PRETOKEN.findall(MARK + MARK.join(text.split())) if text.strip() else []


def token_counts(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """Tokens, pre-tokens and characters of every document.

    Each task has a trie of its own: nothing is shuffled, and the pre-tokens of some
    megabytes of text are counted together, so that each distinct one is sought once.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(load_pieces(path))
        for batch in batches:
            for part in slices(batch, 1, _SLICE):
                texts = [t or "" for t in part.column(1).to_pylist()]
                words = [pretokens(t) for t in texts]
                distinct = set().union(*words)
                tokens = {w: trie.count(w) for w in distinct}
                yield pa.record_batch(
                    [part.column(0),
                     pa.array([sum(map(tokens.__getitem__, w)) for w in words], pa.int64()),
                     pa.array([len(w) for w in words], pa.int64()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    ["doc_id", "n_tokens", "n_pretokens", "n_chars"],
                )

    columns = [F.col(id_col).cast("bigint"), F.col(text_col).cast("string")]
    return docs.select(*columns).mapInArrow(rows, RESULT)


def plain_count(pieces: dict[str, float], text: str) -> int:
    """The same count by a dynamic program for each word alone, for tests."""
    spell = -math.log(len(pieces) + 2) - CONSTANT
    total = 0
    for word, times in Counter(pretokens(text)).items():
        best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode("utf-8", "surrogatepass"))
            ways = [(best[end - 1][0] + n * spell, best[end - 1][1] + n)]
            ways += [
                (best[b][0] + pieces[word[b:end]], best[b][1] + 1)
                for b in range(end) if word[b:end] in pieces
            ]
            top = max(score for score, _ in ways)
            best[end] = min((w for w in ways if w[0] > top - 1e-9), key=lambda w: w[1])
        total += times * best[-1][1]
    return total
