"""The contracts of the operators, done plainly."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def passages(docs: list[tuple[int, str | None]], window: int = 13) -> dict[int, tuple]:
    first: dict[tuple, int] = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        w = words(text)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), doc)
    out = {}
    for doc, text in docs:
        w = words(text)
        cut = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < doc:
                cut[k : k + window] = [True] * window
        kept = " ".join(x for x, c in zip(w, cut, strict=True) if not c)
        out[doc] = (len(w), sum(cut), hashlib.sha256(kept.encode()).hexdigest())
    return out


def long_strings(docs: list[tuple[int, str | None]], window: int = 50) -> dict[int, tuple]:
    first: dict[bytes, int] = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        b = (text or "").encode()
        for k in range(len(b) - window + 1):
            first.setdefault(b[k : k + window], doc)
    out = {}
    for doc, text in docs:
        b = (text or "").encode()
        cut = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if first[b[k : k + window]] < doc:
                cut[k : k + window] = b"\x01" * window
        kept = bytes(x for x, c in zip(b, cut, strict=True) if not c)
        out[doc] = (len(b), sum(cut), len(re.findall(b"\x01+", bytes(cut))), hashlib.sha256(kept).hexdigest())
    return out


def shingles(text: str | None, size: int = 5) -> set[tuple]:
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}


def closure(ids: list[int], linked) -> dict[int, int]:
    """Smallest id reachable from each id."""
    ids = sorted(set(ids))
    parent = {i: i for i in ids}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near_copies(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    sets = {doc: shingles(text) for doc, text in docs}

    def linked(a: int, b: int) -> bool:
        common = len(sets[a] & sets[b])
        return common > 0 and 100 * common >= 75 * len(sets[a] | sets[b])

    group = closure(list(sets), linked)
    return {doc: (len(s), group[doc]) for doc, s in sets.items()}


def tokens(text: str | None, tokenizer, end: int = 1) -> list[int]:
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def statistics(text: str | None) -> tuple:
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen: dict[tuple, list[int]] = {}
    for k in range(len(w) - 2):
        seen.setdefault(tuple(w[k : k + 3]), []).append(k)
    repeated = {k + i for at in seen.values() if len(at) > 1 for k in at for i in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
