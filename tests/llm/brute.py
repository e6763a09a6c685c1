"""Plain single-process versions of the operators' contracts, for tests."""

import base64
import hashlib
import itertools
import re
import zlib

import xxhash


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3


PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def license_base(text):
    """(n_words, places, labels) of the base phrases."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
              if tuple(words[i:i + len(phrase)]) == phrase]
    return len(words), sorted(places), sorted({x for _, x in places})


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode("utf-8", "replace"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows, bits=2):
    """{(doc_id, text) index: (fingerprint, component id)} by comparing all pairs."""
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(doc, f"{fps[i]:016x}", least.get(root(i))) for i, (doc, _) in enumerate(rows)]


def norm(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", lower_ascii(text or "").encode("utf-8", "replace"))
    return b" " + b" ".join(words) + b" " if words else b""


def best_distance(pattern, text):
    """Least edit distance between ``pattern`` and any part of ``text``, by the table."""
    last = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        last = row
    return min(last)


def payload_digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def boilerplate(rows, min_sites):
    """Texts after removal: rows of (doc_id, source, text)."""
    sites, first = {}, {}
    far = 2**63 - 1
    for doc, source, text in rows:
        for pos, line in enumerate((text or "").split("\n")) if text is not None else ():
            key = line.strip(" \t\r")
            if key:
                sites.setdefault(key, set())
                if source is not None:
                    sites[key].add(source)
                place = (far if doc is None else doc, pos)
                first[key] = min(place, first.get(key, place))
    out = []
    for doc, source, text in rows:
        if text is None:
            out.append((doc, None, 0))
            continue
        kept, gone = [], 0
        for pos, line in enumerate(text.split("\n")):
            key = line.strip(" \t\r")
            if key and len(sites[key]) >= min_sites and (far if doc is None else doc, pos) != first[key]:
                gone += 1
            else:
                kept.append(line)
        out.append((doc, "\n".join(kept), gone))
    return out
