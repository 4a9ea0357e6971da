"""Plain readings of shared definitions, for the brute-force versions."""

import re

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(ascii_lower(text))


def shingle_set(text, k=5):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a or b else 0.0
