"""Statistics of a text that the quality operators read."""

from __future__ import annotations

import numpy as np

from titlelabels.llm.common import SPACES

SYMBOLS = "#*$%&|<>"
#: Counts, then shares; all that ``measure`` gives, in this order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = (
    "log_words",
    "word_length",
    "symbol_share",
    "repeat_share",
    "dup_line_share",
    "unique_share",
    "same_next_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "stop_share",
    "bar_share",
    "line_length",
    "long_word_share",
)


def repeated_windows(codes: np.ndarray, kinds: int, size: int = 3) -> int:
    """How many words lie in a window of ``size`` words that occurs twice or more."""
    count = len(codes) - size + 1
    if count < 2:
        return 0
    keys = codes[:count]
    for k in range(1, size):
        # Numbers below 2^31 each, so that two fit into 63 bits; renumbered on the way.
        keys = keys * kinds + codes[k : k + count]
        if k + 1 < size and kinds > 1 << 20:
            keys = np.unique(keys, return_inverse=True)[1]
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(keys, twice)
    edges = np.zeros(len(codes) + 1, np.int64)
    edges[:count] += hit
    edges[size : size + count] -= hit
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure(text: str | None) -> tuple:
    """``COUNTS`` as int and ``SHARES`` as float; zeros for a null or empty text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    repeated = repeated_windows(codes, len(known))
    if not n:
        return (0, chars, symbols, dup_lines, 0, *[0.0] * len(SHARES))
    letters = np.frombuffer(data, np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, n)
    size = len(data)
    upper = int(((letters - np.uint8(65)) < 26).sum())
    lower = int(((letters - np.uint8(97)) < 26).sum())
    shares = (
        float(np.log1p(n)),
        chars / n,
        symbols / n,
        repeated / n,
        dup_lines / len(lines),
        len(known) / n,
        float((codes[1:] == codes[:-1]).sum()) / n,
        upper / (upper + lower + 1),
        float(((letters - np.uint8(48)) < 10).sum()) / size,
        text.count("!") / n,
        (text.count(".") + text.count(",")) / n,
        text.count("|") / n,
        float(np.log1p(n / len(lines))),
        float((sizes > 20).sum()) / n,
    )
    return n, chars, symbols, dup_lines, repeated, *shares


def schema() -> str:
    return ", ".join([f"{c} long" for c in COUNTS] + [f"{c} double" for c in SHARES])
