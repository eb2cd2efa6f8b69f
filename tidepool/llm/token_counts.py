"""Token counts by a unigram model, once per shared prefix of the pre-tokens.

Each task inserts the distinct pre-tokens that it meets into a trie. A node
gets its forward score when it is made: the best sum of piece scores over all
ways to cut the characters that lead to it, from the scores of the nodes above
it. Pre-tokens with a common prefix share its nodes, so that work is done
once; the node where a pre-token ends stores its number of tokens, and a text
is the sum over its pre-tokens. Nothing is shuffled, the vocabulary is the
only thing that tasks are given, and a trie that reaches ``MAX_NODES`` is
begun anew, which bounds a task's memory and changes no result.

A pre-token of more than ``LONG_WORD`` characters (an encoded file, say)
would be one long path that nothing shares. Only its beginning goes through
the trie; behind it the same recurrence runs over the last scores alone, as
many as the longest piece has characters, and no node is made.
"""

from __future__ import annotations

import functools
import math
import re
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches

SPACE = "▁"
MAX_NODES = 1_000_000
# Longest path of the trie, and texts whose words are looked for one by one.
LONG_WORD = 512
LONG_TEXT = 1 << 20
WORD = re.compile(r"\S+")

# Zipf-Mandelbrot offset of the piece probabilities by vocabulary order.
OFFSET = 2.7


class Pieces:
    """Log probabilities of the pieces of a vocabulary file, by their order in it.

    The file orders pieces from frequent to rare. As its own scores are merge
    ranks and no probabilities, a piece of rank r gets 1 / (r + OFFSET),
    scaled to one. A character that no piece covers costs one byte token for
    each of its UTF-8 bytes, each as unlikely as the rarest piece.
    """

    def __init__(self, scores: dict[str, float], byte_score: float):
        self.scores, self.byte_score = scores, byte_score
        self.longest = max(map(len, scores), default=1)
        lengths: dict[str, set[int]] = {}
        for piece in scores:
            if len(piece) > 1:
                lengths.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {end: sorted(found) for end, found in lengths.items()}  # by the last two characters

    @classmethod
    def from_ranks(cls, pieces: list[str]) -> Pieces:
        whole = math.log(sum(1 / (r + OFFSET) for r in range(len(pieces))) or 1.0)
        scores = {p: -math.log(r + OFFSET) - whole for r, p in enumerate(pieces)}
        return cls(scores, min(scores.values(), default=0.0))

    @classmethod
    @functools.cache
    def from_file(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls.from_ranks([model.id_to_piece(i) for i in range(model.get_piece_size())
                               if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                                       or model.is_unused(i))])


    def step(self, word: str, i: int, above: Sequence[int], scores: Sequence[float],
             counts: Sequence[int]) -> tuple[float, int]:
        """Best score and least tokens up to character ``i``, from those up to the characters before it.

        ``above`` says where in ``scores`` and ``counts`` these are: the last
        for the character before ``i``, and so on back to the longest piece.
        """
        known, last = self.scores, above[-1]
        size = len(word[i].encode("utf-8", "replace"))
        best, count = scores[last] + size * self.byte_score, counts[last] + size
        single = known.get(word[i])
        if single is not None:  # bytes stand in only for characters that have no piece
            best, count = scores[last] + single, counts[last] + 1
        for back in self.lengths.get(word[i - 1:i + 1] if i else "", ()):
            if back > i + 1:
                break
            piece = known.get(word[i + 1 - back:i + 1])
            if piece is not None:
                start = above[-back]
                whole = scores[start] + piece
                if whole > best or (whole == best and counts[start] + 1 < count):
                    best, count = whole, counts[start] + 1
        return best, count


class PreTokenTrie:
    """Trie of pre-tokens with the best forward score and token count of every node."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]
        self.terminal: dict[str, tuple[int, float]] = {}

    def add(self, word: str) -> tuple[int, float]:
        """Tokens and score of a pre-token, whose nodes are made where they are new."""
        node, path = 0, [0]
        for i in range(min(len(word), LONG_WORD)):
            below = self.child.get((node, word[i]))
            if below is None:
                score, tokens = self.pieces.step(word, i, path, self.score, self.tokens)
                below = self.child[node, word[i]] = len(self.score)
                self.score.append(score)
                self.tokens.append(tokens)
            node = below
            path.append(node)
        return self._beyond(word, path) if len(word) > LONG_WORD else (self.tokens[node], self.score[node])

    def _beyond(self, word: str, path: list[int]) -> tuple[int, float]:
        """The same for a word longer than any path: only its last scores are kept."""
        last = path[-self.pieces.longest:]
        scores = deque((self.score[k] for k in last), self.pieces.longest)
        counts = deque((self.tokens[k] for k in last), self.pieces.longest)
        for i in range(LONG_WORD, len(word)):
            score, tokens = self.pieces.step(word, i, range(len(scores)), scores, counts)
            scores.append(score)
            counts.append(tokens)
        return counts[-1], scores[-1]

    def count(self, text: str) -> tuple[int, int, float]:
        """Pre-tokens, tokens and score of a text."""
        get = self.terminal.get
        words = text.split() if len(text) <= LONG_TEXT else (w.group() for w in WORD.finditer(text))
        n, tokens, score = 0, 0, 0.0
        for word in words:
            own = get(word)
            if own is None:
                own = self._new(word)
            n += 1
            tokens += own[0]
            score += own[1]
        return n, tokens, score

    def _new(self, word: str) -> tuple[int, float]:
        if len(self.score) > MAX_NODES:
            self.clear()
        found = self.add(SPACE + word)
        if len(word) < LONG_WORD:
            self.terminal[word] = found
        return found


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id_col, n_pretokens, n_tokens, log_score`` of its whole text.

    Pre-tokens are split at white space and begin with the vocabulary's space
    mark. ``log_score`` is the natural log of the best segmentation's
    probability; of equally likely ones the shorter counts. Defined cases: a
    null, empty or blank text has no tokens and score 0; repeated rows are
    counted each; a null id stays null; an empty table gives an empty result;
    other columns are ignored. A very long text, or one very long word, is
    counted whole and takes no memory beyond its own characters.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PreTokenTrie(Pieces.from_file(model_path))
        for batch in batches:
            schema = pa.schema([("_id", batch.schema.field(0).type), ("n_pretokens", pa.int64()),
                                ("n_tokens", pa.int64()), ("log_score", pa.float64())])
            rows = ((key, *trie.count(text or "")) for key, text in
                    zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            yield from in_batches(rows, schema)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string")).mapInArrow(
        run, f"_id {id_type}, n_pretokens bigint, n_tokens bigint, log_score double").withColumnRenamed("_id", id_col)
