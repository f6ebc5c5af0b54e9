"""Plain versions of the corpus operators, straight from their definitions, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def union_find(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def vectors(rows, threshold=0.9):
    """rows: {vec_id: list}. (n_links, component_id)."""
    good = {i: np.array(v, float) for i, v in rows.items()
            if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    ids = sorted(good)
    links = []
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            a, b = good[i], good[j]
            if len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links.append((i, j))
    n = Counter(x for link in links for x in link)
    roots = union_find(ids, links)
    return {i: (n[i], roots.get(i, i)) for i in rows}


def repeated_bytes(docs, length=200, keep_first=False):
    seen = Counter()
    raws = {i: (t or "").encode() for i, t in docs.items()}
    for raw in raws.values():
        for s in range(len(raw) - length + 1):
            seen[raw[s:s + length]] += 1
    out, first = {}, set()
    for i, raw in sorted(raws.items()):
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if seen[w] > 1 and (not keep_first or w in first):
                gone[s:s + length] = True
            first.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int(np.sum(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        out[i] = (len(raw), int(gone.sum()), spans, sha(kept))
    return out


def repeated_words(docs, window=35, keep_first=False):
    words = {i: SPACED.findall(t or "") for i, t in docs.items()}
    seen = Counter(tuple(w[s:s + window]) for w in words.values() for s in range(len(w) - window + 1))
    out, first = {}, set()
    for i, w in sorted(words.items()):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            run = tuple(w[s:s + window])
            if seen[run] > 1 and (not keep_first or run in first):
                gone[s:s + window] = [True] * window
            first.add(run)
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def benchmark_hits(docs, items, n=10):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(FOLD))
        size = min(n, len(w))
        for s in range(len(w) - size + 1) if w else ():
            windows[tuple(w[s:s + size])].add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for i, t in docs.items():
        w = ALNUM.findall((t or "").translate(FOLD))
        hit, found = [False] * len(w), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                names = windows.get(tuple(w[s:s + size]))
                if names:
                    hit[s:s + size] = [True] * size
                    found |= {str(x) for x in names if x is not None}
        out[i] = (len(w), sum(hit), len(found), sha(",".join(sorted(found))), any(hit))
    return out


def shingles(text, words):
    w = SPACED.findall((text or "").translate(FOLD))
    if len(w) < words:
        return {tuple(w)} if w else set()
    return {tuple(w[s:s + words]) for s in range(len(w) - words + 1)}


def near_duplicates(docs, words=4, percent=80):
    sets = {i: shingles(t, words) for i, t in docs.items()}
    lists = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    common = Counter()
    for members in lists.values():
        for k, a in enumerate(members):
            for b in members[k + 1:]:
                common[a, b] += 1
    links = [(a, b) for (a, b), c in common.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)]
    roots = union_find(docs, links)
    return {i: (len(sets[i]), roots[i]) for i in docs}


def lines_match(a, b, near=8):
    """Words of two lines: equal, or at most one word changed, dropped or added."""
    if a == b:
        return True
    if min(len(a), len(b)) < near or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def repeated_lines(docs):
    before, by_size, out = set(), defaultdict(list), {}
    for i in sorted(docs):
        lines = (docs[i] or "").split("\n")
        kept, gone = [], 0
        for line in lines:
            w = tuple(SPACED.findall(line))
            near = [x for d in (-1, 0, 1) for x in by_size[len(w) + d]] if len(w) >= 8 else []
            if w and (w in before or any(lines_match(w, x) for x in near)):
                gone += 1
            else:
                kept.append(line)
            if w and w not in before:
                before.add(w)
                by_size[len(w)].append(w)
        out[i] = (len(lines) if docs[i] else 0, gone, sha("\n".join(kept)))
    return out


def pieces_of(docs, encode, capacity=1024, end_id=2):
    out = {}
    for i, t in docs.items():
        ids = [*encode(t or ""), end_id]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for k, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            out[i, k] = (s, e - s, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[s:e])))
    return out


def signature(text, k=2, size=2, points=64, cut=8, bits=26):
    """Order MinHash entries, straight from the definition: a full sort of the ring for every point."""
    import xxhash
    symbols = re.findall(r"[^ \t\n\x0b\f\r]{1,%d}" % cut, text or "")
    if not symbols:
        return None
    top = (1 << 64) - (1 << bits)
    seen, ring = Counter(), []
    for i in range(max(len(symbols) - k, 0) + 1):
        h = 42
        for s in symbols[i:i + k]:
            h = xxhash.xxh64_intdigest(s.encode(), h)
        h &= top
        signed = (h >> bits) - (1 << 64 - bits) * (h >> 63)
        again = xxhash.xxh64_intdigest((signed % (1 << 64)).to_bytes(8, "little"), 42)
        ring.append((xxhash.xxh64_intdigest(seen[h].to_bytes(4, "little"), again) & top, i))
        seen[h] += 1
    out = []
    for b in range(points):
        mark = (-(1 << 63) + b * ((1 << 64) // points)) % (1 << 64)
        after = sorted(ring, key=lambda x: ((x[0] + x[1] - mark) % (1 << 64)))[:size]
        h = 42
        for value, _ in sorted(after, key=lambda x: x[1]):
            h = xxhash.xxh64_intdigest((value >> bits).to_bytes(8, "little"), h)
        out.append(h >> 32)
    return out


def fingerprints(rows, **kw):
    """rows: [(id, text)]. (n_chars, sha of the edited text, fingerprints, likeness to the edited and to the next text)."""
    def like(a, b):
        return 1.0 if a is None and b is None else 0.0 if a is None or b is None else sum(x == y for x, y in zip(a, b)) / len(a)

    def shown(a):
        return "".join(f"{x:08x}" for x in a or ())

    rows = sorted(rows, reverse=True)
    out = {}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        n = len(text) // 3
        edited = text[:len(text) - n] + after[:n]
        a, b, c = (signature(t, **kw) for t in (text, edited, after))
        out[i] = (len(text), sha(edited), shown(a), shown(b), like(a, b), like(a, c))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, top=10):
    """docs: {id: text}, items: [(id, text)]. {(item, rank): (doc, score)}."""
    import math
    terms = {i: Counter(TERM.findall((t or "").translate(FOLD))) for i, t in docs.items()}
    lengths = {i: sum(c.values()) for i, c in terms.items()}
    n_all, total = sum(n > 0 for n in lengths.values()), sum(lengths.values())
    df = Counter(t for c in terms.values() for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERM.findall((t or "").translate(FOLD)))
    out = {}
    for item, want in wanted.items():
        scores = []
        for i, c in terms.items():
            m = 10 + (90 * lengths[i] * n_all) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in want if c[t])
            if score > 0:
                scores.append((-score, i))
        for r, (s, i) in enumerate(sorted(scores)[:top], 1):
            out[item, r] = (i, -s)
    return out


def rebuilt(rows):
    """rows: [(conv, turn, role, text)]. {conv: [(role, text)]} after the exchange of first turns."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)  # as in SQL, of the sign of c
        out[c] = own.get(c - rest, [])[:h] + turns[h:]
    return out


def tree(convs):
    """{(smallest member, depth): row} of every distinct start of the conversations {id: [turn]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return {(min(m), len(p)): (min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                               sha(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p)))))) for p, m in members.items()}
