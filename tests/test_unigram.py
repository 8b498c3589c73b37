"""Scored pieces: best paths against all paths, bytes, blanks, nulls."""

import random
from itertools import combinations

import pytest

from checks.fixtures import small_unigram
from corploom.functions.tokenizers import tokens_of
from corploom.functions.unigram import UnigramTokenizer, best_path

from .conftest import docs_frame


def every_path(text):
    for k in range(len(text)):
        for inner in combinations(range(1, len(text)), k):
            at = (0, *inner, len(text))
            yield [(a, b) for a, b in zip(at, at[1:])]


def brute(text, pieces, floor):
    """Of all paths the highest sum, then the longest last piece, and so on to the front."""
    scored = []
    for path in every_path(text):
        scores = [pieces[text[a:b]][1] if text[a:b] in pieces else floor if b - a == 1 else None for a, b in path]
        if None not in scores:
            scored.append((sum(scores), [b - a for a, b in reversed(path)], path))
    return max(scored)[2] if scored else []


def made(rng):
    letters = "ab▁c"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(12)}
    return {w: (i, rng.randint(-6, -1)) for i, w in enumerate(sorted(words))}


def test_best_path_equals_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        pieces = made(rng)
        text = "".join(rng.choice("ab▁cd") for _ in range(rng.randint(0, 10)))
        longest = max(map(len, pieces))
        assert [(a, b) for a, b, _ in best_path(text, pieces, longest, -9)] == brute(text, pieces, -9), (text, pieces)


def lines_of(pieces):
    return "\n".join(["<unk>\t0", "</s>\t0", *(f"<0x{b:02X}>\t0" for b in range(256)), *pieces])


@pytest.mark.parametrize("crossing", [False, True])
def test_texts(spark, crossing):
    more = ["▁of▁the\t-1.5", "▁▁\t-0.5"] if crossing else []
    tok = UnigramTokenizer(lines_of(["▁\t-2", "▁of\t-3", "▁the\t-3", "a\t-4", "▁a\t-4.5", "\n\t-6", *more]))
    texts = ["of the  a", "", None, " ", "漢 é\U0001f600\x00", "  of the\na a ", "x" * 5000, "of the", "of the"]
    rows = docs_frame(spark, texts).repartition(3).select("doc_id", tokens_of("text", tok).alias("ids")).collect()
    found = {r.doc_id: r.ids for r in rows}
    assert found[2] is None and found[1] == []
    longest = max(map(len, tok.pieces))
    for i, text in enumerate(texts):
        if text:
            assert tok.decode(found[i]) == text
            spelled = "▁" + text.replace(" ", "▁")
            path = best_path(spelled, tok.pieces, longest, tok.floor)
            whole = [n for a, b, n in path for n in ([n] if n is not None else [tok.bytes_from + c for c in spelled[a:b].encode()])]
            assert found[i] == whole
    assert (tok.pieces.get("▁of▁the", (None,))[0] in found[0]) == crossing


def test_small_file_and_end_mark():
    tok = small_unigram()
    assert tok.eos_id == 2 and tok.bytes_from == 3
    with pytest.raises(ValueError):
        _ = UnigramTokenizer("<0x00>\t0\n</s>\t0").bytes_from
