"""Hashed n-gram features of whole texts, and logistic regression on them, in numpy."""

from __future__ import annotations

import numpy as np

#: ASCII bytes that are no letters become spaces; bytes of other scripts stay.
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def letters(text: str) -> bytes:
    """Lower-case letters and single spaces, with a space at both ends."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "


def byte_ngrams(text: str | None, size: int) -> np.ndarray:
    """Square roots of the shares of hashed 1- to 3-grams of the text's bytes: a vector of length 1, or 0."""
    data = np.frombuffer(letters(text or ""), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(size, np.float32)
    two = (data[:-1] << 8) | data[1:]
    three = (two[:-1] << 8) | data[2:]
    shift = np.uint32(32 - (size.bit_length() - 1))
    counts = np.zeros(size)
    for grams, mix in zip((data, two, three), _MIX):
        counts += np.bincount((grams * np.uint32(mix)) >> shift, minlength=size)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def word_counts(text: str | None, size: int, table: dict) -> np.ndarray:
    """Square roots of the shares of hashed words.  ``table`` keeps the place of words already seen."""
    import xxhash

    words = letters(text or "").split()
    if not words:
        return np.zeros(size, np.float32)
    if len(table) > 300_000:
        table.clear()
    places = []
    for word in words:
        place = table.get(word)
        if place is None:
            place = table[word] = xxhash.xxh64_intdigest(word) % size
        places.append(place)
    counts = np.bincount(places, minlength=size)
    return np.sqrt(counts / len(words)).astype(np.float32)


def descend(x: np.ndarray, gradient, width: int, steps: int, rate: float, decay: float):
    """Weights and offsets by accelerated gradient descent on the whole sample.

    ``gradient(scores)`` gives the derivative of the loss by the scores, row by row.
    """
    weights, offset = np.zeros((x.shape[1], width), np.float32), np.zeros(width, np.float32)
    ahead_w, ahead_b = weights, offset
    for step in range(steps):
        g = gradient(x @ ahead_w + ahead_b) / np.float32(len(x))
        new_w = ahead_w - rate * (x.T @ g + decay * ahead_w)
        new_b = ahead_b - rate * g.sum(axis=0)
        pull = np.float32(step / (step + 3))
        ahead_w, ahead_b = new_w + pull * (new_w - weights), new_b + pull * (new_b - offset)
        weights, offset = new_w, new_b
    return weights, offset


def fit_bits(x: np.ndarray, bits: np.ndarray, steps: int = 300, rate: float = 20.0, decay: float = 1e-5):
    """Logistic classifiers, one for each column of ``bits`` (-1 or 1)."""
    return descend(x, lambda s: -bits / (1 + np.exp(np.clip(bits * s, -30, 30))), bits.shape[1], steps, np.float32(rate), np.float32(decay))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_classes(x: np.ndarray, labels: np.ndarray, classes: int, steps: int = 300, rate: float = 10.0, decay: float = 1e-5):
    """Softmax regression in which every class weighs the same."""
    target = np.eye(classes, dtype=np.float32)[labels]
    sizes = np.maximum(1, np.bincount(labels, minlength=classes))
    weight = (len(labels) / (classes * sizes[labels])).astype(np.float32)[:, None]
    return descend(x, lambda s: weight * (softmax(s) - target), classes, steps, np.float32(rate), np.float32(decay))
