import math

import pytest
import regex
from starloom.llm import token_counts as K
from starloom.llm.packing import tokenizer_files

PIECES = {b"a": -3.0, b"b": -3.5, b"c": -4.0, b"ab": -4.0, b"abc": -5.0, b"bc": -4.1, b"ca": -9.0, b"aaaa": -5.0}


def viterbi(text, scores):
    """Token count of the best segmentation, the longest last piece on ties: every pre-token by itself."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end - 1, -1, -1):
            piece = text[start:end]
            if piece in scores and best[start][0] + scores[piece] >= best[end][0]:
                best[end] = (best[start][0] + scores[piece], best[start][1] + 1)
    return best[-1][1]


@pytest.mark.parametrize("nodes", [3, 1000])
def test_trie_matches_single_passes(nodes):
    import itertools

    trie = K.Trie(PIECES, nodes)
    words = [bytes(w) for n in range(7) for w in itertools.product(b"abc", repeat=n)]
    assert [trie.count(w) for w in words] == [viterbi(w, PIECES) for w in words]


def test_prefixes_are_computed_once():
    trie, calls = K.Trie(PIECES), []
    forward = trie._forward
    trie._forward = lambda text, end, path: calls.append(text[:end]) or forward(text, end, path)
    for word in (b"abca", b"abcb", b"abc", b"abca"):
        trie.count(word)
    assert calls == [b"a", b"ab", b"abc", b"abca", b"abcb"]
    assert trie.root[0][ord("a")][0][ord("b")][0][ord("c")][3]


def test_table_matches_brute_force(docs, prose):
    files = tokenizer_files()
    scores, split = K.unigram_scores(files[1]), regex.compile(files[2]).findall
    assert abs(sum(map(math.exp, scores.values())) - 1) < 1e-9
    rows = [(1, prose(60, 1), 9), (1, prose(60, 1), 9), (None, "Ünï 日本 123  \n x's", 0), (3, "", 0), (4, None, 0), (5, "antidisestablishmentarianism " * 300, 0)]
    found = K.count_tokens(docs(rows, "doc_id long, text string, n_tokens int")).collect()
    got = sorted((repr(r["doc_id"]), r["n_pretokens"], r["n_tokens"]) for r in found)
    expected = sorted((repr(i), len(split(t or "")), sum(viterbi(p.encode(), scores) for p in split(t or ""))) for i, t, _ in rows)
    assert got == expected
    assert K.count_tokens(docs([])).collect() == []
