"""Plain Python versions of the contracts, for small tables."""

import hashlib
import re
import zlib

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [words[i:i + size] for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest reachable node of each."""
    found = {}
    for start in sorted(nodes):
        if start in found:
            continue
        todo = [start]
        while todo:
            at = todo.pop()
            if at not in found:
                found[at] = start
                todo += [n for n in nodes if n not in found and linked(at, n)]
    return found


def hit_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def decontaminate(docs, items, size=13):
    windows = {}
    for item, text in items:
        words = hit_words(text)
        for at in range(max(1, len(words) - size + 1)) if words else ():
            windows.setdefault(tuple(words[at:at + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    for doc, text in docs:
        words, hit, found = hit_words(text), set(), set()
        for n in lengths:
            for at in range(len(words) - n + 1):
                if (w := tuple(words[at:at + n])) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[w]
        names = sorted(map(str, found))
        yield (doc, len(words), len(hit), len(found), hashlib.sha256(",".join(names).encode()).hexdigest(),
               len(hit) > 0 and 20 * len(hit) >= len(words))


def without_repeats(texts, width=200):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    seen = {}
    data = [(t or "").encode() for t in texts]
    for b in data:
        for i in range(len(b) - width + 1):
            seen[b[i:i + width]] = seen.get(b[i:i + width], 0) + 1
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        spans = len(re.findall(b"\1+", bytes(gone)))
        yield len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)


def crc(text):
    return zlib.crc32((text or "").encode())
