"""Recall of long benchmark items whose edits reach the limit."""

import random

import pytest

from locusmill.llm import contamination


@pytest.mark.parametrize("n", [61, 120, 250, 500])
def test_contamination_recall_of_long_items(n):
    rng = random.Random(n)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=n)) for _ in range(6)]
    items = contamination.Items(list(range(6)), texts)
    d = contamination.allowed(n)
    for k, text in enumerate(texts):
        for kinds in ("s", "sid"):
            for evenly in (True, False):
                words = text.split()
                places = [n * i // d for i in range(d)] if evenly else rng.sample(range(n), d)
                for at in sorted(places, reverse=True):
                    kind = rng.choice(kinds)
                    words[at : at + (kind != "i")] = [] if kind == "d" else [rng.choice(vocabulary)]
                doc = [*rng.choices(vocabulary, k=50), *words, *rng.choices(vocabulary, k=50)]
                # one edit more than the limit, at places that no other edit could stand for
                over = ["beyond" + str(i) if i % 4 == 0 else w for i, w in enumerate(text.split())]
                assert items.found([" ".join(doc), " ".join(over)]) == [[k], []], (k, kinds, evenly)


def test_pieces_cover_items_and_short_items_are_whole():
    assert contamination.pieces_of(60) == [(0, 60)]
    for n in range(61, 700):
        pieces = contamination.pieces_of(n)
        assert sum(s for _, s in pieces) == n and all(20 < s <= contamination.PIECE for _, s in pieces)
