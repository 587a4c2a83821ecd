"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

A text is cut into pieces by the vocabulary's split pattern. In a piece, an Aho-Corasick
automaton finds the longest token that starts at every byte; the encoder takes the longest,
checks with the pair table that the merges could have put it after the token before it, and
goes back to a shorter one where they could not. Each byte position is given up at most once,
so the work is linear, also in a piece of a million letters. Results are those of applying
the merges in order.

Null and empty texts have no tokens. The string of an added token counts as that token.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from struct import pack

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelabels.llm.common import map_rows

#: The split of byte-level vocabularies (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words remembered per worker in either of two generations, and the longest of them in characters: some 50 MB with words of usual length.
MEMO = 1 << 17
MEMO_CHARS = 64
#: Marks of words met before, a byte each: only a word met again is remembered, as most words come once.
MET = 1 << 20
#: Pairs of tokens whose check is remembered.
CHECKED = 1 << 18
#: Tokens decoded at a time.
BLOCK = 1 << 16


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, the two halves of every merged token, and added tokens."""

    def __init__(self, text: str):
        data = json.loads(text)
        letters = byte_letters()
        model = data["model"]
        self.tokens: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        ranks = []
        for rule in model["merges"]:
            left, right = rule.split(" ") if isinstance(rule, str) else rule
            token = model["vocab"][left + right]
            pair = model["vocab"][left], model["vocab"][right]
            self.halves.setdefault(token, pair)
            self.merged.setdefault(pair, token)
            ranks.append(token)
        if ranks != sorted(set(ranks)) or (ranks and max(self.tokens.keys() - self.halves.keys()) > ranks[0]):
            raise ValueError("ids must follow the order of the merges")
        self.added = {x["content"]: x["id"] for x in data.get("added_tokens", [])}

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves exactly these two tokens.

        Undo the merges of both sides along their common edge, latest first; the pair breaks
        if somewhere the edge could have merged earlier than the merge that hides it.
        """
        bound = 1 << 62
        while True:
            if self.merged.get((left, right), bound) < bound:
                return False
            if left > right and left in self.halves:
                bound, left = left, self.halves[left][1]
            elif right in self.halves:
                bound, right = right + 1, self.halves[right][0]
            elif left in self.halves:
                bound, left = left, self.halves[left][1]
            else:
                return True


class Encoder:
    def __init__(self, text: str):
        self.words = words = Vocabulary(text)
        by_bytes = {b: i for i, b in words.tokens.items()}
        self.length = {i: len(b) for i, b in words.tokens.items()}
        self.single = {b[0]: i for b, i in by_bytes.items() if len(b) == 1}
        self.shorter = {}
        for token, i in by_bytes.items():
            self.shorter[i] = next((by_bytes[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in by_bytes), None)
        self.checked: dict[int, bool] = {}
        self.matcher = self.automaton(by_bytes)
        # A token that the merges never reach from its own bytes must not be matched.
        dead = [b for b, i in by_bytes.items() if not self.reached(i)]
        if dead:
            gone = {by_bytes.pop(b) for b in dead}
            for i, s in self.shorter.items():
                while s in gone:
                    s = self.shorter[s]
                self.shorter[i] = s
            self.matcher = self.automaton(by_bytes)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.met = bytearray(MET)
        self.split = regex.compile(SPLIT)
        added = sorted(words.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        # Decoding: all tokens in one buffer, and where each begins.
        size = max([*words.tokens, *words.added.values(), -1]) + 1
        spelled = [words.tokens.get(i, b"") for i in range(size)]
        for content, i in words.added.items():
            spelled[i] = content.encode()
        self.buffer = np.frombuffer(b"".join(spelled), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in spelled])]).astype(np.int64)

    @staticmethod
    def automaton(by_bytes: dict[bytes, int]):
        matcher = ahocorasick.Automaton()
        for token, i in by_bytes.items():
            matcher.add_word(token.decode("latin-1"), (i, len(token) - 1))
        matcher.make_automaton()
        return matcher

    def reached(self, token: int) -> bool:
        """Whether the merges, applied in order to the token's bytes, end with the token."""
        words = self.words
        parts = [self.single[b] for b in words.tokens[token]]
        while len(parts) > 1:
            found = [words.merged.get(p, 1 << 62) for p in zip(parts, parts[1:], strict=False)]
            k = min(range(len(found)), key=found.__getitem__)
            if found[k] == 1 << 62:
                break
            parts[k : k + 2] = [found[k]]
        return parts == [token]

    def piece(self, piece: str) -> bytes:
        """Ids of one piece."""
        data = piece.encode().decode("latin-1")
        n = len(data)
        longest = [0] * n
        for end, (token, less) in self.matcher.iter(data):
            longest[end - less] = token  # matches come by their ends: the last of a start is its longest
        length, shorter, checked = self.length, self.shorter, self.checked
        given_up = None
        taken: list[int] = []
        at, before, token = 0, -1, longest[0]
        while True:
            end = at + length[token]
            if given_up is None or end not in given_up:
                fits = before < 0 or checked.get(before << 32 | token)
                if fits is None:
                    fits = self.check(before, token)
                if fits:
                    taken.append(token)
                    if end == n:
                        return pack(f"<{len(taken)}I", *taken)
                    at, before, token = end, token, longest[end]
                    continue
            if shorter[token] is not None:
                token = shorter[token]
            else:
                given_up = given_up or set()
                given_up.add(at)  # so that the token taken last must be a shorter one
                token = taken.pop()
                at -= length[token]
                before = taken[-1] if taken else -1

    def check(self, left: int, right: int) -> bool:
        if len(self.checked) >= CHECKED:
            self.checked.clear()
        fits = self.checked[left << 32 | right] = self.words.fits(left, right)
        return fits

    def pieces(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        found = self.split.findall(text)
        if len(found) == 1:
            return self.piece(text)
        memo, out = self.memo, []
        for x in found:
            # The memo's keys lack the blank that stands before them.
            ids = memo.get(x[1:]) if x[0] == " " and len(x) > 1 and x[1] != " " else None
            out.append(self.piece(x) if ids is None else ids)
        return b"".join(out)

    def plain(self, text: str) -> bytes:
        """As ``pieces``; a blank between two other letters begins a piece, so that what stands between blanks can be remembered."""
        parts = text.split(" ")
        memo = self.memo
        known = list(map(memo.get, parts))
        known[0] = self.pieces(parts[0])
        if parts[0][-1:].isspace():
            return self.pieces(text)
        if None in known:
            for k, ids in enumerate(known):
                if ids is None:
                    part = parts[k]
                    if part in memo:
                        known[k] = memo[part]
                        continue
                    if not part or part[0].isspace() or part[-1].isspace():
                        return self.pieces(text)
                    known[k] = ids = self.older.get(part) or self.pieces(f" {part}")
                    if len(part) <= MEMO_CHARS:
                        self.remember(part, ids)
        return b"".join(known)

    def remember(self, part: str, ids: bytes) -> None:
        """Keeps a word that was met before; a full generation takes the place of the older one, words used since then stay."""
        mark = hash(part) % MET
        if not self.met[mark]:
            self.met[mark] = 1
            return
        if len(self.memo) >= MEMO:
            self.older.clear()
            self.older.update(self.memo)
            self.memo.clear()
            self.met = bytearray(MET)
        self.memo[part] = ids

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        if self.added is None or not self.added.search(text):
            return self.plain(text)
        added = self.words.added
        return b"".join(pack("<I", added[x]) if x in added else self.plain(x) for x in self.added.split(text))

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the text: every id is a slice of one buffer, found by the offset table."""
        out = []
        tokens = np.frombuffer(ids, "<u4")
        for k in range(0, len(tokens), BLOCK):
            block = tokens[k : k + BLOCK]
            starts = self.offsets[block]
            sizes = self.offsets[block.astype(np.int64) + 1] - starts
            ends = np.cumsum(sizes)
            where = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
            out.append(self.buffer[where].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(text: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(text)


def _vocabulary(df: DataFrame, path: str):
    """The vocabulary file's text, some 1.5 MB, sent to every executor once."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_tokens and token_ids (array of int) of every row."""
    sent = _vocabulary(df, path)

    def build():
        encode = encoder(sent.value).encode

        def row(text):
            ids = encode(text)
            return len(ids) // 4, np.frombuffer(ids, "<u4").astype(np.int32)

        return row

    return map_rows(df, [text_col], "n_tokens long, token_ids array<int>", build, keep)


def decode(df: DataFrame, path: str, ids_col: str = "token_ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the text of every row's ids; null ids give the empty text."""
    sent = _vocabulary(df, path)

    def build():
        decode = encoder(sent.value).decode
        return lambda ids: (decode(np.array(ids or [], "<u4").tobytes()).decode("utf-8", "replace"),)

    return map_rows(df, [ids_col], "text string", build, keep)


def round_trip(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Digests of the ids and of the text decoded from them: n_tokens, ids_sha256, decoded_sha256."""
    sent = _vocabulary(df, path)

    def build():
        coder = encoder(sent.value)

        def row(text):
            ids = coder.encode(text)
            back = coder.decode(ids).decode("utf-8", "replace").encode()
            return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

        return row

    out = map_rows(df, [text_col], "n_tokens long, ids_sha256 string, decoded_sha256 string", build, keep)
    return out.select(*keep, *[F.col(c) for c in ("n_tokens", "ids_sha256", "decoded_sha256")])
