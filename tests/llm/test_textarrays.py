import random

import pyarrow as pa
from helpers import EDGES, prose, words

from loadloom.llm import textarrays as ta


def _texts():
    rng = random.Random(3)
    return [t for _, t in EDGES] + [prose(rng, n) for n in (1, 2, 4, 5, 6, 50)] + ["A b C\rd", "ÀB", ""]


def test_words_and_hashes_agree_with_a_regular_expression():
    texts, seen = _texts(), {}
    for first, last, data, at in ta.pieces(pa.array(texts, pa.string()), limit=100):
        w = ta.words(data, at)
        k = 0
        for i in range(first, last):
            own = words(texts[i])
            assert w.counts[i - first] == len(own)
            for word in own:
                assert seen.setdefault(word, w.hashes[k]) == w.hashes[k]
                k += 1
    assert len(set(seen.values())) == len(seen)


def test_shingles_are_distinct_runs_of_five_words_or_the_whole_text():
    texts = _texts()
    for _, _, data, at in ta.pieces(pa.array(texts, pa.string())):
        for text, got in zip(texts, ta.shingle_sets(ta.words(data, at))):
            own = words(text)
            want = len({tuple(own[i : i + 5]) for i in range(len(own) - 4)}) if len(own) >= 5 else int(bool(own))
            assert len(got) == want


def test_word_order_counts():
    (_, _, data, at), = ta.pieces(pa.array(["a b c d e", "e d c b a", "a b", "b a"], pa.string()))
    assert len({int(s[0]) for s in ta.shingle_sets(ta.words(data, at))}) == 4
