"""Keyed permutations of whole numbers below any bound, and of texts within their format."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable, Mapping, Sequence

ROUNDS = 10
DIGITS = "0123456789"
SMALL = "abcdefghijklmnopqrstuvwxyz"
HEX_SMALL, HEX_LARGE = DIGITS + "abcdef", DIGITS + "ABCDEF"
# Beyond a-z: small and capital letters of these blocks (Latin with marks, Greek, Cyrillic), each among themselves.
BLOCKS = ((0x00C0, 0x017F), (0x0386, 0x03CE), (0x0400, 0x045F))
LETTERS = [
    "".join(c for c in map(chr, range(a, b + 1)) if unicodedata.category(c) == kind) for a, b in BLOCKS for kind in ("Ll", "Lu")
]
PLAIN = {c: a for a in (DIGITS, SMALL, SMALL.upper()) for c in a}
ANY_SCRIPT = PLAIN | {c: a for a in LETTERS for c in a}


def _round(key: bytes, kind: str, n: int, k: int, half: int, size: int) -> int:
    """Round function: a keyed digest of one half, bound to the kind of value and the size of its range."""
    data = f"{kind}:{n}:{k}:{half}".encode()
    out = b""
    while 8 * len(out) < size:
        out += hashlib.blake2b(data + len(out).to_bytes(4, "big"), key=key, digest_size=64).digest()
    return int.from_bytes(out, "big") & ((1 << size) - 1)


def _network(x: int, size: int, key: bytes, kind: str, n: int, back: bool) -> int:
    """Balanced Feistel network on ``2 * size`` bits."""
    left, right = x >> size, x & ((1 << size) - 1)
    if back:
        for k in reversed(range(ROUNDS)):
            left, right = right ^ _round(key, kind, n, k, left, size), left
    else:
        for k in range(ROUNDS):
            left, right = right, left ^ _round(key, kind, n, k, right, size)
    return left << size | right


def permuted(x: int, n: int, key: bytes, kind: str, back: bool = False, allowed: Callable[[int], bool] | None = None) -> int:
    """Image of ``x`` under a permutation of 0 .. n - 1, and with ``allowed`` of the allowed numbers among them.

    The network permutes the next even power of two; numbers outside the range
    are sent on until one falls inside, which keeps it a permutation.
    """
    if not 0 <= x < n or allowed is not None and not allowed(x):
        raise ValueError("the value is outside the permuted range")
    if n == 1:
        return x
    size = max(1, ((n - 1).bit_length() + 1) // 2)
    while True:
        x = _network(x, size, key, kind, n, back)
        if x < n and (allowed is None or allowed(x)):
            return x


def permuted_text(
    text: str, alphabets: Sequence[str], key: bytes, kind: str, back: bool = False, allowed: Callable[[str], bool] | None = None
) -> str:
    """Permute a text whose characters come from one alphabet each; with ``allowed`` among the allowed texts."""
    x, n = 0, 1
    for c, a in zip(text, alphabets, strict=True):
        x, n = x * len(a) + a.index(c), n * len(a)

    def written(x: int) -> str:
        out = []
        for a in reversed(alphabets):
            x, k = divmod(x, len(a))
            out.append(a[k])
        return "".join(reversed(out))

    return written(permuted(x, n, key, kind, back, None if allowed is None else lambda y: allowed(written(y))))


def same_kind(text: str, key: bytes, kind: str, back: bool = False, allowed: Callable[[str], bool] | None = None, letters: Mapping[str, str] = PLAIN) -> str:
    """Permute digits among digits, small letters and capitals (of ``letters``) among themselves; all other characters stay."""
    alphabets = [letters.get(c) for c in text]

    def whole(image: str) -> str:
        new = iter(image)
        return "".join(next(new) if a else c for c, a in zip(text, alphabets))

    own = "".join(c for c, a in zip(text, alphabets) if a)
    return whole(permuted_text(own, [a for a in alphabets if a], key, kind, back, None if allowed is None else lambda image: allowed(whole(image))))
