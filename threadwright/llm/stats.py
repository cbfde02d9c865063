"""Exact per-document text statistics, computed chunk by chunk over whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import Words, mix, row_sums, utf8, window_hashes

SYMBOLS = b"#*$%&|<>"  # fixed value


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_IS_SYMBOL = _table(SYMBOLS)
_IS_UPPER = _table(bytes(range(65, 91)))
_IS_DIGIT = _table(b"0123456789")
_IS_LETTER = _table(bytes([*range(65, 91), *range(97, 123), *range(0xC2, 0x100)]))
_IS_STOP = _table(b".!?")
_IS_PUNCT = _table(b",;:-'\"()[]{}/_=+~@^`\\")
_IS_LEAD = np.ones(256, dtype=bool)  # bytes that start a code point
_IS_LEAD[0x80:0xC0] = False


def repeated_words(words: Words, hashes: np.ndarray, size: int = 3) -> np.ndarray:
    """Per row: words covered by a window of ``size`` words that the row holds twice or more."""
    rows = len(words.offsets) - 1
    at = words.windows(size)
    if not len(at):
        return np.zeros(rows, np.int64)
    keys = mix(window_hashes(hashes, at, size) + mix(words.row[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    hit = at[order[twice]]
    covered = np.zeros(len(words) + 1, dtype=bool)
    for i in range(size):
        covered[hit + i] = True
    return row_sums(covered[:-1], words.first)


def duplicate_lines(texts: list[str | None]) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line."""
    out = np.zeros(len(texts), np.int64)
    blank = " \t\v\f\r"
    for i, text in enumerate(texts):
        if text and "\n" in text:
            lines = [line for line in text.split("\n") if line.strip(blank)]
            out[i] = len(lines) - len(set(lines))
    return out


def base_statistics(column: pa.Array) -> tuple[Words, np.ndarray, dict[str, np.ndarray]]:
    data, offsets = utf8(column)
    words = Words(data, offsets)
    hashes = words.hashes()
    spans = np.zeros(len(data) + 1, np.int8)
    spans[words.starts] += 1
    np.subtract.at(spans, words.ends, 1)
    inside = np.cumsum(spans[:-1], dtype=np.int8).astype(bool) if len(data) else np.zeros(0, bool)
    return (
        words,
        hashes,
        {
            "n_words": words.counts.astype(np.int64),
            "word_chars": row_sums(inside & _IS_LEAD[data], offsets),
            "n_symbols": row_sums(_IS_SYMBOL[data], offsets),
            "n_dup_lines": duplicate_lines(column.to_pylist()),
            "n_repeat_words": repeated_words(words, hashes),
        },
    )


def distinct_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    keys = mix(hashes + mix(words.row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = keys[order][1:] != keys[order][:-1]
    return np.bincount(words.row[order[fresh]], minlength=len(words.offsets) - 1)


FEATURES = [
    "log_words", "log_word_length", "symbol_share", "digit_share", "upper_share", "punct_share", "stop_share",
    "other_share", "line_rate", "dup_line_share", "repeat_share", "distinct_share", "short_share", "long_share",
    "symbol_word_share", "bare_symbol_share", "capital_word_share", "same_neighbour_share",
]


def features(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Base statistics and transformed ones, one row per text in the order of ``FEATURES``; all finite.

    Shares of skewed kind are taken to the square root, counts to the logarithm.
    """
    words, hashes, base = base_statistics(column)
    data, offsets = words.data, words.offsets
    rows = len(offsets) - 1
    n = np.maximum(base["n_words"], 1).astype(np.float64)
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    lengths = words.ends - words.starts

    def per_word(flags: np.ndarray) -> np.ndarray:
        return row_sums(flags, words.first) / n

    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[data], dtype=np.int64)])
    in_word = symbols[words.ends] - symbols[words.starts]
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])
    lines = np.maximum(row_sums(data == 10, offsets) + 1, 1)
    letters = row_sums(_IS_LETTER[data], offsets)
    leads = row_sums(_IS_LEAD[data], offsets)
    digits, stops, puncts = (row_sums(t[data], offsets) for t in (_IS_DIGIT, _IS_STOP, _IS_PUNCT))
    blanks = row_sums(data <= 32, offsets)
    other = np.maximum(leads - letters - digits - stops - puncts - base["n_symbols"] - blanks, 0)
    initial = data[words.starts] if len(words) else np.zeros(0, np.uint8)
    out = np.column_stack(
        [
            np.log1p(base["n_words"]),
            np.log1p(base["word_chars"] / n),
            np.sqrt(base["n_symbols"] / size),
            np.sqrt(digits / size),
            np.sqrt(row_sums(_IS_UPPER[data], offsets) / size),
            np.sqrt(puncts / size),
            np.sqrt(stops / n),
            np.sqrt(other / size),
            np.log1p(100 * lines / n),
            np.sqrt(base["n_dup_lines"] / lines),
            np.sqrt(base["n_repeat_words"] / n),
            distinct_words(words, hashes) / n,
            per_word(lengths <= 3),
            np.sqrt(per_word(lengths >= 15)),
            np.sqrt(per_word(in_word > 0)),
            np.sqrt(per_word((in_word == lengths) & (lengths > 0))),
            np.sqrt(per_word(_IS_UPPER[initial])),
            np.sqrt(per_word(same)),
        ]
    )
    return base, out.reshape(rows, len(FEATURES))
