"""MD5 of many short messages at once, as array operations."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np

_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint32)
_TURNS = [np.uint32(s) for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in 4 * four]
_BACK = [np.uint32(32 - s) for s in _TURNS]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
# bytes of a message that fit one block
ONE_BLOCK = 55
# messages whose working arrays stay in a core's cache
TOGETHER = 16_384


def _one_block(words: np.ndarray) -> np.ndarray:
    """Digests (n, 4) of n padded blocks, given as (16, n) words."""
    n = words.shape[1]
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, g = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            k = i
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            k = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            k = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            k = 7 * i % 16
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        f += a
        f += _SINES[i]
        f += words[k]
        np.left_shift(f, _TURNS[i], out=g)
        np.right_shift(f, _BACK[i], out=f)
        f |= g
        f += b
        a, d, c, b, f = d, c, b, f, a
    return np.stack([x + np.uint32(s) for x, s in zip((a, b, c, d), _START, strict=True)], axis=1)


def md5_of(prefixes: Sequence[bytes], texts: Sequence[bytes]) -> list[np.ndarray]:
    """For every prefix the digests (n, 16) of prefix + text."""
    out = [np.empty((len(texts), 16), np.uint8) for _ in prefixes]
    for lo in range(0, len(texts), TOGETHER):
        own = texts[lo : lo + TOGETHER]
        size = np.fromiter(map(len, own), np.int64, len(own))
        width = int(size.max())
        chars = np.array(own, f"S{max(width, 1)}").view(np.uint8).reshape(len(own), -1)
        for prefix, made in zip(prefixes, out, strict=True):
            p = len(prefix)
            if p + width > ONE_BLOCK:
                whole = b"".join([hashlib.md5(prefix + text).digest() for text in own])
                made[lo : lo + len(own)] = np.frombuffer(whole, np.uint8).reshape(-1, 16)
                continue
            block = np.zeros((len(own), 64), np.uint8)
            block[:, :p] = np.frombuffer(prefix, np.uint8)
            block[:, p : p + chars.shape[1]] = chars
            block[np.arange(len(own)), p + size] = 0x80
            words = block.view("<u4")
            words[:, 14] = 8 * (p + size)
            digests = _one_block(np.ascontiguousarray(words.T).astype(np.uint32, copy=False))
            made[lo : lo + len(own)] = digests.astype("<u4", copy=False).view(np.uint8).reshape(-1, 16)
    return out
