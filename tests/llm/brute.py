"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


class Sets:
    """Union-find that keeps the smallest member as root."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def jaccard_links(sets, percent):
    """Pairs of keys of ``sets`` that reach the threshold."""
    keys = sorted(k for k in sets if sets[k])
    for i, x in enumerate(keys):
        for y in keys[i + 1:]:
            both = len(sets[x] & sets[y])
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                yield x, y


def near(rows, width=2):
    """{id: (n, component)} of (id, text) rows with distinct ids."""
    sets = {}
    for key, text in rows:
        w = WORD.findall(lower(text or ""))
        sets[key] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    groups = Sets()
    for x, y in jaccard_links(sets, 80):
        groups.join(x, y)
    return {k: (len(s), groups.root(k)) for k, s in sets.items()}


def line_shingles(line, width=8):
    """All runs of characters; a shorter line is its own."""
    return {line[i:i + width] for i in range(max(1, len(line) - width + 1))}


def removed_lines(rows):
    """{(id, no)} of the lines that go."""
    places = {}
    for key, text in rows:
        for no, line in enumerate((text or "").split("\n")):
            if key is not None and WORD.search(line):
                places.setdefault(line.strip(" ").lower(), set()).add((key, no))
    sets = {line: line_shingles(line) for line in places}
    groups = Sets()
    for x, y in jaccard_links(sets, 80):
        groups.join(x, y)
    out = {}
    for line, found in places.items():
        out.setdefault(groups.root(line), set()).update(found)
    return set().union(*(found - {min(found)} for found in out.values())) if out else set()


def repeats(rows, match=400):
    """Sorted (id, bytes, removed, spans, digest) of (id, text) rows."""
    texts = [(key, (text or "").encode()) for key, text in rows]
    seen = Counter(t[i:i + match] for _, t in texts for i in range(len(t) - match + 1))
    out = []
    for key, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - match + 1):
            if seen[t[i:i + match]] > 1:
                gone[i:i + match] = b"\1" * match
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((key, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def contained(docs, items, width=5):
    """{(doc, item): (n_item, n_shared)} that reach the threshold."""
    def shingles(rows, of_item):
        out = {}
        for key, text in rows:
            w = WORD.findall((text or "").lower())
            sizes = [min(width, len(w))] if of_item else range(1, width + 1)
            if key is not None:
                out.setdefault(key, set()).update(tuple(w[i:i + n]) for n in sizes if n for i in range(len(w) - n + 1))
        return out
    inside, wanted = shingles(docs, False), shingles(items, True)
    return {(d, i): (len(q), len(q & s)) for d, s in inside.items() for i, q in wanted.items()
            if q and 100 * len(q & s) >= 80 * len(q)}


HEADINGS = {f"h{k}" for k in range(1, 7)}
BLOCKS = HEADINGS | {"body", "div", "li", "p", "section", "ul"}


def dense_text(page):
    """Main text of a well-formed page of BLOCKS, links and bold words, written down from the definition."""
    import math
    import xml.etree.ElementTree as ET

    root = ET.fromstring(page)
    up = {c: e for e in root.iter() for c in e}

    def chars(e):
        return sum(len(" ".join(t.split())) for t in e.itertext())

    def links(e):
        return [x for x in e.iter("a")]

    share = sum(map(chars, links(root))) / max(1, chars(root))

    def density(e):
        c, t, lt = chars(e), max(1, len(list(e.iter())) - 1), max(1, len(links(e)))
        inside = sum(map(chars, links(e)))
        if not c:
            return 0.0
        base = math.log(c / max(1, c - inside) * max(1, inside) + share * c + math.e)
        return c / t * math.log(max(1.0, c / max(1, inside) * t / lt)) / math.log(base)

    of = {e: density(e) for e in root.iter()}

    def weight(e):
        return sum(of[c] for c in reversed(e)) or of[e]

    def largest(e):
        return max(e.iter(), key=weight)

    def ancestors(e):
        return [up[e], *ancestors(up[e])] if e in up else []

    best = largest(root)
    threshold = min(of[e] for e in [best, *ancestors(best)])
    taken = {best}

    def mark(e):
        if e in taken or e not in ancestors(best) and (of[e] < threshold or chars(e) <= 4 * sum(map(chars, links(e)))):
            return
        taken.add(largest(e))
        if e not in taken:
            for c in e:
                mark(c)

    mark(root)
    over = {a for e in taken for a in ancestors(e)}
    for e in ancestors(best):
        parts = list(e)
        for i, c in enumerate(parts):
            after = next((x for x in parts[i + 1:] if x.tag not in HEADINGS), None)
            if c.tag in HEADINGS and (after in taken or after in over or e is up[best] and c.tag == "h1"):
                taken.add(c)
    out = [""]

    def show(e, on):
        on = on or e in taken
        cut = e.tag in BLOCKS
        if on and cut:
            out.append("")
        if on:
            out[-1] += e.text or ""
        for c in e:
            show(c, on)
            if on:
                out[-1] += c.tail or ""
        if on and cut:
            out.append("")

    show(root, False)
    return "\n".join(t for t in (" ".join(x.split()) for x in out) if t)
