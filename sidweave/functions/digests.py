"""md5 of many short texts by whole-array steps: the twin of common.hash_int for Arrow functions."""

from __future__ import annotations

import hashlib
import math

import numpy as np

#: Arrays without an axis: numpy takes them faster than its own scalars.
LEFT = [[np.array(x, np.uint32) for x in turn] for turn in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))]
RIGHT = [[np.array(32 - int(x), np.uint32) for x in turn] for turn in LEFT]
SINES = [np.array(int(abs(math.sin(i + 1)) * 2 ** 32), np.uint32) for i in range(64)]
ZERO = np.array(0, np.uint32)
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
BLOCK, ENDING = 64, 9  # bytes of a block; a byte behind the text and its length in bits
STEP_TEXTS = 1 << 15


def numbered_tails(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 to count-1, each with md5's closing byte behind it, as rows of bytes; the numbers of digits."""
    texts = [str(i).encode() for i in range(count)]
    width = len(texts[-1]) + 1
    return np.frombuffer(b"".join((t + b"\x80").ljust(width, b"\0") for t in texts), np.uint8).reshape(count, width), np.array([len(t) for t in texts])


def numbered_hashes(heads: list[bytes], tails: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """hash_int of each head followed by each number of `tails`: rows of heads, a column for each number.

    Heads that leave no room for a number in one block are hashed one by one.
    """
    digits, lengths = tails
    out = np.empty((len(heads), len(digits)), np.uint32)
    by_length: dict[int, list[int]] = {}
    for i, head in enumerate(heads):
        by_length.setdefault(len(head), []).append(i)
    for size, rows in by_length.items():
        if size + digits.shape[1] - 1 + ENDING > BLOCK:
            texts = [bytes(d[:n]) for d, n in zip(digits, lengths)]
            for i in rows:
                out[i] = [int.from_bytes(hashlib.md5(heads[i] + t).digest()[:4], "big") for t in texts]
        else:
            step = max(1, STEP_TEXTS // len(digits))
            for some in (rows[i:i + step] for i in range(0, len(rows), step)):
                out[some] = _first_words(_words([heads[i] for i in some], size, digits, lengths), (len(some), len(digits))).byteswap()
    return out


def _words(heads: list[bytes], size: int, digits: np.ndarray, lengths: np.ndarray) -> list:
    """The sixteen words of one block each: a number, a column (one per head), a row (one per number) or both."""
    aligned = size // 4 * 4
    fixed = np.frombuffer(b"".join(h.ljust(aligned + 4, b"\0") for h in heads), "<u4").reshape(len(heads), -1).astype(np.uint32)
    ending = np.zeros((len(digits), -(-(size - aligned + digits.shape[1]) // 4) * 4), np.uint8)
    ending[:, size - aligned:size - aligned + digits.shape[1]] = digits
    last = ending.view("<u4").astype(np.uint32)
    words: list = [fixed[:, i:i + 1] for i in range(aligned // 4)]
    for i in range(last.shape[1]):
        word = np.ascontiguousarray(last[:, i])[None, :]
        words.append(word | fixed[:, -1:] if i == 0 and size > aligned else word)
    words += [ZERO] * (14 - len(words))
    return [*words, ((size + lengths) * 8).astype(np.uint32)[None, :], ZERO]


def _first_words(words: list, shape: tuple[int, int]) -> np.ndarray:
    """First word of md5 of the blocks; the last three steps do not reach it, and the first ones read words of the head alone."""
    alike = next(i for i, w in enumerate(words) if w.shape[1:] != (1,))
    a, b, c, d = (np.full((shape[0], 1), x, np.uint32) for x in START)
    f, t = np.empty_like(a), np.empty_like(a)
    for i in range(61):
        if i == alike:
            a, b, c, d = (np.broadcast_to(x, shape).copy() for x in (a, b, c, d))
            f, t = np.empty_like(a), np.empty_like(a)
        turn, step = divmod(i, 16)
        if turn == 0:
            at = i
            np.bitwise_xor(np.bitwise_and(np.bitwise_xor(c, d, f), b, f), d, f)
        elif turn == 1:
            at = (5 * i + 1) % 16
            np.bitwise_xor(np.bitwise_and(np.bitwise_xor(b, c, f), d, f), c, f)
        elif turn == 2:
            at = (3 * i + 5) % 16
            np.bitwise_xor(np.bitwise_xor(b, c, f), d, f)
        else:
            at = 7 * i % 16
            np.bitwise_xor(np.bitwise_or(np.invert(d, f), b, f), c, f)
        np.add(f, a, f)
        if words[at] is ZERO:
            np.add(f, SINES[i], f)
        elif words[at].size < f.size:
            np.add(f, words[at] + SINES[i], f)
        else:
            np.add(np.add(f, words[at], f), SINES[i], f)
        np.left_shift(f, LEFT[turn][step % 4], t)
        np.right_shift(f, RIGHT[turn][step % 4], f)
        np.add(np.bitwise_or(t, f, t), b, t)
        a, b, c, d, t = d, t, b, c, a
    return b + np.uint32(START[0])
