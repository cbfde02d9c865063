"""Small documents with the awkward cases every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, words: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(words)]


def rows(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    passage = sentence(rng, 30, 10**6)
    base = sentence(rng, 120, 10**6)
    texts: list[str | None] = [None, "", " \n\t ", "one", "one two three", "ONE two THREE", "a " * 300, " ".join(base)]
    texts += [" ".join(base)] * 4  # exact copies
    for _ in range(30):  # near copies, many of them linked to one another
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.randint(0, 8)):
            copy[at] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    for _ in range(15):  # a shared passage in otherwise different documents
        own = sentence(rng, rng.randint(5, 90), 10**6)
        at = rng.randrange(len(own))
        texts.append(" ".join(own[:at] + passage + own[at:]))
    for _ in range(15):  # small vocabulary: many chance repeats
        texts.append(" ".join(sentence(rng, rng.randint(1, 150), 12)))
    texts.append(" ".join(sentence(rng, 20_000, 10**6)))  # very long
    texts += ["é" * 60 + " ü ", "é" * 60 + " ü ", "x" * 500, "x" * 499 + "y", "ab" * 200]
    order = list(range(len(texts)))
    rng.shuffle(order)
    out = [(i, texts[k], rng.choice(["en", "de", None]), f"src{k % 4}" if k % 7 else None, len(texts[k] or "")) for i, k in enumerate(order)]
    return [*out, out[5]]  # a repeated row
