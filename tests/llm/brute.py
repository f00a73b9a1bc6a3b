"""Brute-force versions of the operators on small inputs."""

import hashlib
import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def roots(nodes, links):
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


def substrings(rows, m=50):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - m + 1 if doc is not None else 0):
            key = data[p : p + m]
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - m + 1 if doc is not None else 0):
            if first[data[p : p + m]] < doc:
                gone[p : p + m] = b"\1" * m
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i in range(len(data)) if gone[i] and (not i or not gone[i - 1]))
        out.append((doc, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=repr)
