import numpy as np
import pytest

from shelfwise.llm import words as W

import brute

TEXTS = ["", None, "one two  two\tTHREE\n", "é ü x", "a" * 5000 + " b", "x", "\x1c\x85 z", "日本 語"]


@pytest.mark.parametrize(("word", "low", "rule"), [(W.NOT_SPACE, False, brute.SPACED), (W.WORDLIKE, True, brute.WORDLIKE)])
def test_words_are_those_of_the_pattern(word, low, rule):
    found = W.tokenize(TEXTS, word, lower=low)
    for i, text in enumerate(TEXTS):
        span = slice(found.first[i], found.first[i + 1])
        own = [found.data[a:b].tobytes().decode() for a, b in zip(found.start[span], found.end[span], strict=True)]
        assert own == rule.findall(brute.lower(text) if low else text or "")


def test_equal_words_have_equal_keys_and_others_differ():
    words = [f"w{i}" for i in range(20_000)] + ["x" * n for n in (255, 256, 257, 2000)]
    found = W.tokenize([" ".join(words), " ".join(words)])
    n = len(words)
    assert (found.key[:n] == found.key[n:]).all()
    assert len(np.unique(found.key)) == n


def test_window_keys_follow_the_words_only():
    found = W.tokenize(["a b c d", "x a b c d y"])
    keys = W.windows(found.key, 3)
    assert keys[0] == keys[5] and keys[1] == keys[6] and len(set(keys.tolist())) == len(keys) - 2
    assert W.windows(found.key, 3, 5)[0] != keys[0] and not len(W.windows(found.key[:2], 3))
    start, text = W.whole_windows(found.first, 3)
    assert start.tolist() == [0, 1, 4, 5, 6, 7] and text.tolist() == [0, 0, 1, 1, 1, 1]
