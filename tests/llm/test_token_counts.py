import math
import random

import pytest

from tidepool.llm import token_counts
from tidepool.llm.queries import tokenizer_path
from tidepool.llm.token_counts import SPACE, Pieces, PreTokenTrie, count_tokens

PATH = tokenizer_path("piece_bpe_32k.model")


def best_cut(word, pieces):
    """All cuts of a word, by plain recursion: (score, -tokens) of the best."""
    if not word:
        return 0.0, 0
    found = []
    for n in range(1, len(word) + 1):
        own = pieces.scores.get(word[:n])
        if own is None and n == 1:
            size = len(word[0].encode())
            score, tokens = best_cut(word[1:], pieces)
            found.append((size * pieces.byte_score + score, tokens - size))
        elif own is not None:
            score, tokens = best_cut(word[n:], pieces)
            found.append((own + score, tokens - 1))
    return max(found, key=lambda x: (round(x[0], 9), x[1]))


@pytest.mark.parametrize("seed", range(20))
def test_trie_equals_all_cuts(seed):
    rng = random.Random(seed)
    pieces = Pieces.from_ranks(list(dict.fromkeys(
        "".join(rng.choice(SPACE + "abc") for _ in range(rng.randint(1, 4))) for _ in range(25))))
    trie = PreTokenTrie(pieces)
    for _ in range(60):
        word = "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9)))
        n, tokens, score = trie.count(word)
        want = best_cut(SPACE + word, pieces)
        assert n == 1 and score == pytest.approx(want[0]) and tokens == -want[1]


def test_prefixes_are_shared():
    trie = PreTokenTrie(Pieces.from_ranks(["a", "ab", "abc", SPACE]))
    trie.count("abcabc abcabd abcabc abc")
    assert len(trie.score) == 1 + 1 + 6 + 1


def test_clearing_changes_nothing(monkeypatch):
    pieces = Pieces.from_file(PATH)
    texts = ["The quick brown fox, naïve 日本 " * 3, "unrelated words appear", "The quick brown"]
    want = [PreTokenTrie(pieces).count(t) for t in texts]
    monkeypatch.setattr(token_counts, "MAX_NODES", 10)
    trie = PreTokenTrie(pieces)
    assert [trie.count(t) for t in texts] == want


@pytest.mark.parametrize("seed", range(10))
def test_words_beyond_the_longest_path(monkeypatch, seed):
    rng = random.Random(seed)
    pieces = Pieces.from_ranks(list(dict.fromkeys(
        "".join(rng.choice(SPACE + "abc") for _ in range(rng.randint(1, 5))) for _ in range(30))))
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    want = [PreTokenTrie(pieces).count(w) for w in words]
    for longest in (1, 2, 7, 20):
        monkeypatch.setattr(token_counts, "LONG_WORD", longest)
        trie = PreTokenTrie(pieces)
        assert [trie.count(w) for w in words] == want


def test_a_very_long_word_makes_no_nodes():
    import tracemalloc

    pieces = Pieces.from_file(PATH)
    word = "".join(random.Random(1).choices("QWxhZGRpbjpvcGVuIHNlc2FtZQ+/0123456789", k=300_000))
    trie = PreTokenTrie(pieces)
    tracemalloc.start()
    n, tokens, _ = trie.count(word)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1 and tokens > 50_000
    assert len(trie.score) <= token_counts.LONG_WORD + 1 and not trie.terminal
    assert most < 3 * len(word)


@pytest.mark.parametrize("space", [" ", "\n\t", "\x1c", "\x85", "\u00a0", "\u2003", "\u3000"])
def test_long_texts_split_like_short_ones(monkeypatch, space):
    pieces = Pieces.from_file(PATH)
    text = space.join(["", "one", "two", "日本", "", "one", ""]) * 3
    want = PreTokenTrie(pieces).count(text)
    monkeypatch.setattr(token_counts, "LONG_TEXT", 4)
    assert PreTokenTrie(pieces).count(text) == want and want[0] == len(text.split())


def test_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in count_tokens(docs, PATH).collect()}
    pieces, memo = Pieces.from_file(PATH), {}

    def viterbi(word):
        best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
        for j in range(1, len(word) + 1):
            for i in range(max(0, j - pieces.longest), j):
                own, tokens = pieces.scores.get(word[i:j]), 1
                if own is None and j == i + 1:
                    tokens = len(word[i].encode())
                    own = tokens * pieces.byte_score
                if own is not None:
                    whole = best[i][0] + own
                    if whole > best[j][0] or (whole == best[j][0] and best[i][1] + tokens < best[j][1]):
                        best[j] = (whole, best[i][1] + tokens)
        return best[-1]

    for r in docs.limit(60).collect():
        words = r.text.split()
        for w in words:
            memo[w] = memo.get(w) or viterbi(SPACE + w)
        assert got[r.doc_id].n_pretokens == len(words)
        assert got[r.doc_id].n_tokens == sum(memo[w][1] for w in words)
        assert got[r.doc_id].log_score == pytest.approx(sum(memo[w][0] for w in words))


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (None, "a"), (4, "a"), (4, "a"), (5, "x" * 20_000)],
                               "doc_id long, text string").selectExpr("*", "0 as n_tokens")
    got = count_tokens(df, PATH).collect()
    assert len(got) == 7
    assert all((r.n_tokens, r.log_score) == (0, 0.0) for r in got if r.doc_id in (1, 2, 3))
    assert len({r.n_tokens for r in got if r.doc_id in (4, None)}) == 1
    assert count_tokens(df.limit(0), PATH).collect() == []
