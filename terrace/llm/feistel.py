"""Feistel permutation of 0..n-1 with cycle walking, on numpy arrays."""

from __future__ import annotations

import numpy as np

from terrace.llm.words import mix

U = np.uint64
ROUNDS = 4


def round_keys(*seed: int) -> np.ndarray:
    key = U(0x243F6A8885A308D3)
    for part in seed:
        key = mix(np.array([key ^ U(part & 0xFFFFFFFFFFFFFFFF)], U))[0]
    with np.errstate(over="ignore"):
        return mix(key + np.arange(1, ROUNDS + 1, dtype=U))


def permute(index: np.ndarray, n: int, keys: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Where ``index`` (0..n-1) goes; a bijection of 0..n-1.

    The domain is the smallest even power of two that holds ``n`` (under four
    times ``n``); what falls outside walks on until it falls inside, which it
    must, since it started inside.
    """
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low = U((1 << half) - 1)
    order = keys[::-1] if inverse else keys
    out = index.astype(U)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> U(half), out[todo] & low
            for key in order:
                if inverse:
                    left, right = right ^ (mix(left + key) & low), left
                else:
                    left, right = right, left ^ (mix(right + key) & low)
            out[todo] = (left << U(half)) | right
            todo = todo[out[todo] >= U(n)]
    return out.astype(np.int64)
