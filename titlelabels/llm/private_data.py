"""Personal data by anchor expansion.

One Aho-Corasick automaton walks each text and stops at anchors: at-signs, plus signs,
digits, ``://`` and identifier cues. A local parser at the anchor finds the borders and
checks the value: domain labels, number ranges, Luhn and IBAN sums. Nothing is looked at
twice, so the work is linear in the text.

Kinds: ``email``, ``ip``, ``card`` and ``phone``, each leftmost and without overlaps within
its kind, and what only anchors show: ``account`` (a number behind an account cue, an IBAN),
``secret`` (a value behind a password or token cue, a cloud access key), ``url``.

Null and empty texts have no spans. Borders are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from titlelabels.llm.common import map_rows

KINDS = ("email", "ip", "card", "phone", "account", "secret", "url")
BASE_KINDS = KINDS[:4]
ACCOUNT_CUES = ("account", "acct", "iban", "konto", "kontonummer", "compte", "cuenta", "ssn", "passport")
SECRET_CUES = ("password", "passwd", "pwd", "passwort", "secret", "token", "api_key", "apikey", "api-key", "access_key")
SCHEMES = ("http", "https", "ftp", "ftps", "ssh", "ws", "wss")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ACCOUNT = re.compile(r"(?:[ ]?(?:number|no\.?|nr\.?|#))?[ ]?[:=#]?[ ]?([A-Z]{0,2}[0-9](?:[ -]?[A-Z0-9]){5,33})(?![A-Za-z0-9])")
SECRET = re.compile(r"""["']?[ ]?[:=][ ]?(["']?)([^\s"',;]{6,})""")
CLOUD_KEY = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")
ADDRESS = re.compile(r"""://[^\s"'<>\\^`{|}]+""")
SCHEME_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")


def luhn(digits: str) -> bool:
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    total = sum(doubled[int(d)] if k % 2 else int(d) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def iban(value: str) -> bool:
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


@lru_cache(maxsize=1)
def anchors():
    found = ahocorasick.Automaton()
    for d in "0123456789":
        found.add_word(d, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    found.add_word("AKIA", ("key", 4))
    for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.upper()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans, by kind as in ``KINDS``, then by start."""
    if not text:
        return []
    out: dict[str, set] = defaultdict(set)
    email_end = quad_end = card_end = phone_end = 0
    for last, (anchor, size) in anchors().iter(text):
        at = last + 1 - size
        if anchor == "digit":
            if at >= card_end:
                m = CARD.match(text, at)
                card_end = m.end() if m else at + 1
                if m and card_end - at >= 13:
                    number = _digits(m[0])
                    if 13 <= len(number) <= 19 and luhn(number):
                        out["card"].add((at, card_end))
            if at >= quad_end:
                m = QUAD.match(text, at)
                quad_end = (m or DIGITS.match(text, at)).end()
                if m and all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
                    out["ip"].add((at, quad_end))
        elif anchor == "at":
            start = at
            while start > email_end and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, last + 1) if start < at else None
            if m:
                email_end = m.end()
                out["email"].add((start, email_end))
        elif anchor == "plus":
            m = PHONE.match(text, at) if at >= phone_end else None
            if m:
                phone_end = m.end()
                if 9 <= len(_digits(m[0])) <= 15:
                    out["phone"].add((at, phone_end))
        elif anchor == "scheme":
            start = at
            while start > 0 and at - start < 6 and text[start - 1] in SCHEME_LETTERS:
                start -= 1
            name = next((s for s in sorted(SCHEMES, key=len, reverse=True) if text[start:at].lower().endswith(s)), None)
            m = ADDRESS.match(text, at) if name else None
            if m:
                end = at + len(m[0].rstrip(".,;:!?)]"))
                if end > last + 1:
                    out["url"].add((at - len(name), end))
        elif at and text[at - 1].isalnum():
            continue
        elif anchor == "key":
            m = CLOUD_KEY.match(text, at)
            if m:
                out["secret"].add(m.span())
        elif anchor == "secret":
            m = SECRET.match(text, last + 1)
            if m:
                out["secret"].add(m.span(2))
        else:
            m = ACCOUNT.match(text, last + 1)
            if m:
                value = m[1].replace(" ", "").replace("-", "")
                if iban(value) or (sum(c.isdigit() for c in value) >= 6 and value[-1].isdigit()):
                    out["account"].add(m.span(1))
    return [(kind, *s) for kind in KINDS for s in sorted(out.get(kind, ()))]


def masked(text: str | None) -> str | None:
    """The text with every span as ``<KIND>``; overlapping spans count as one of the kind that begins first."""
    found = sorted(spans(text), key=lambda s: (s[1], -s[2], KINDS.index(s[0])))
    if not found:
        return text
    out, at = [], 0
    for kind, start, end in found:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def find(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and an array ``spans`` of (kind, start, end) for every row."""
    return map_rows(
        df, [text_col], "spans array<struct<kind:string,start:int,end:int>>", lambda: lambda t: (spans(t),), keep
    )


def digest(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, and all spans as one string."""

    def row(text):
        found = spans(text)
        base = [s for s in found if s[0] in BASE_KINDS]
        counts = [sum(s[0] == kind for s in base) for kind in BASE_KINDS]
        return *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found)

    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_rows(df, [text_col], schema, lambda: row, keep)


def mask(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns, personal data in the text replaced; ``n_chars`` follows the text where it changed."""
    names = df.columns
    counted = "n_chars" in names
    schema = f"`{text_col}` string" + ", n_chars long" * counted

    def row(text, n_chars=None):
        new = masked(text)
        return (new, n_chars if new == text else len(new))[: 1 + counted]

    keep = [c for c in names if c != text_col and c != "n_chars"]
    return map_rows(df, [text_col, "n_chars"][: 1 + counted], schema, lambda: row, keep).select(names)
