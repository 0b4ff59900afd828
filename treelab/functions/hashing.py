"""Repeatable pseudo-random numbers from md5, the same in any SQL engine."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, functions as F

#: Cumulative Poisson(1) probabilities P(K <= k), k = 0..9.
POISSON_CDF = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(10)]


def text_key(*parts) -> Column:
    """``a:b:c`` as text; plain Python values become literals."""
    cols = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *cols)


def hash_key(*parts) -> Column:
    return F.md5(text_key(*parts))


def hex_to_unit(hex8: Column) -> Column:
    return F.conv(hex8, 16, 10).cast("double") / F.lit(4294967296.0)


def unit_hash(*parts) -> Column:
    """Uniform in [0, 1) from the first 32 bits of the md5 of the key."""
    return hex_to_unit(F.substring(hash_key(*parts), 1, 8))


def unit_below(fraction: float, *parts) -> Column:
    """``unit_hash(*parts) < fraction``, compared as hex digits: no number is made of the md5."""
    cut = math.ceil(fraction * 2**32)
    return F.lit(cut > 0) if cut <= 0 or cut >= 2**32 else hash_key(*parts) < F.lit(f"{cut:08x}")


def normal_hash(*parts) -> Column:
    """Standard normal by Box-Muller from two hashed uniforms."""
    u1, u2 = unit_hash(*parts, "a"), unit_hash(*parts, "b")
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def poisson_count(u: Column) -> Column:
    """Poisson(1) draw for a uniform number: the number of CDF steps at or below it."""
    out = F.lit(0)
    for step in POISSON_CDF:
        out = out + (u >= F.lit(step)).cast("int")
    return out


def ranked_subset(names: list, k: int, *key) -> list[int]:
    """Driver-side: indices of the ``k`` names with the smallest md5 of (key, name), ascending."""
    prefix = ":".join(str(p) for p in key)
    order = sorted(range(len(names)), key=lambda i: (hashlib.md5(f"{prefix}:{names[i]}".encode()).hexdigest(), i))
    return sorted(order[:k])


#: Texts whose md5 is taken side by side, so that their words stay in the cache.
SIDE_BY_SIDE = 1 << 13
_SHIFTS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]


def md5_units(texts: list[bytes], ends: list[bytes]) -> Iterator[np.ndarray]:
    """Per end, the md5 of every text with this end as four numbers of 32 bits each: the hex digits 1-8, 9-16, 17-24 and 25-32.

    Short texts of one length are hashed side by side, step by step of the md5; longer ones (over 55 bytes with their end) one by one.
    """
    size = np.array([len(t) for t in texts], np.int64)
    most = 55 - max(map(len, ends), default=0)
    same = [(int(k), np.flatnonzero(size == k)) for k in np.unique(size) if k <= most]
    blocks = []
    for k, rows in same:
        held = np.zeros((len(rows), 64), np.uint8)
        held[:, :k] = np.frombuffer(b"".join([texts[i] for i in rows]), np.uint8).reshape(len(rows), k)
        blocks.append(np.ascontiguousarray(held.view("<u4")[:, : k // 4 + 1].T))
    long = np.flatnonzero(size > most)
    for end in ends:
        out = np.empty((len(texts), 4), np.uint32)
        for (k, rows), words in zip(same, blocks, strict=True):
            rest = np.zeros(64, np.uint8)
            rest[k : k + len(end) + 1] = np.frombuffer(end + b"\x80", np.uint8)
            rest[56:64] = np.frombuffer((8 * (k + len(end))).to_bytes(8, "little"), np.uint8)
            for lo in range(0, len(rows), SIDE_BY_SIDE):
                out[rows[lo : lo + SIDE_BY_SIDE]] = _md5_block(words[:, lo : lo + SIDE_BY_SIDE], rest.view("<u4")).T
        for i in long:
            out[i] = np.frombuffer(hashlib.md5(texts[i] + end).digest(), ">u4")
        yield out


def _md5_block(words: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The digests of blocks of 64 bytes: their first words, to which ``rest`` is added, which they share."""
    first = [w + r for w, r in zip(words, rest)]
    start = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
    a, b, c, d = (np.full(words.shape[1], x, np.uint32) for x in start)
    f, g = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            at = i
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            at = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            at = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            at = 7 * i % 16
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        if at < len(first):
            np.add(f, first[at], out=f)
            np.add(f, np.uint32(_SINES[i]), out=f)
        else:
            np.add(f, np.uint32((_SINES[i] + int(rest[at])) & 0xFFFFFFFF), out=f)
        turn = _SHIFTS[i // 16][i % 4]
        np.right_shift(f, np.uint32(32 - turn), out=g)
        np.left_shift(f, np.uint32(turn), out=f)
        np.bitwise_or(f, g, out=f)
        np.add(f, b, out=a)
        a, b, c, d = d, a, b, c
    return np.stack([(x + np.uint32(y)).byteswap() for x, y in zip((a, b, c, d), start)])
