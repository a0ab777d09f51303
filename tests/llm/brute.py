"""Plain versions of the operators, for comparison on small tables."""

import hashlib
import re
import zlib

import numpy as np


def components(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def near_texts(rows, n, numerator, denominator):
    """{id: (size, component)} of (id, text) rows."""
    sets = {i: shingles(t, n) for i, t in rows}
    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    pairs = {(a, b) for own in index.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    links = [(a, b) for a, b in pairs if denominator * len(sets[a] & sets[b]) >= numerator * len(sets[a] | sets[b])]
    comp = components(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc_of(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
