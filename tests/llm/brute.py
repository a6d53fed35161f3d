"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import re
import string

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~]")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))


def plain(text):
    return words(PUNCTUATION.sub(" ", (text or "").lower()))


def shingles(found, size=5):
    if not found:
        return []
    return [tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]


def classes(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def levenshtein(a, b):
    previous = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            row.append(min(previous[j] + (x != y), previous[j + 1] + 1, row[j] + 1))
        previous = row
    return previous[-1]
