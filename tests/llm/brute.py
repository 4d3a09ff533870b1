"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np

SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def classes(n, links):
    """Smallest index of each index's component."""
    root = list(range(n))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(k) for k in range(n)]


def word_shingles(text, n=5):
    w = item_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def near_duplicates(rows, similarity=0.8):
    """{row number: (class_id, n_links)} of (doc_id, text) rows with distinct ids."""
    sets = [word_shingles(t) for _, t in rows]
    links = []
    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y:
            if len(x & y) >= similarity * len(x | y) - 1e-9:
                links.append((a, b))
        elif not x and not y and rows[a][1] and rows[a][1] == rows[b][1]:
            links.append((a, b))
    root = classes(len(rows), links)
    low = {}
    for k, r in enumerate(root):
        low[r] = min(low.get(r, rows[k][0]), rows[k][0])
    count = Counter(k for link in links for k in link)
    return [(low[root[k]], count[k]) for k in range(len(rows))]


def token_rows(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def base_scores(rows):
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]

    def tokens(text):
        return [*WORD.findall((text or "").translate(LOWER)), None]

    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [(i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
             float(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)))) for i, t in rows]


def line_classes(rows, size=10, similarity=0.8):
    """{(row number, line number): kept} of lines with a character other than white space."""
    lines = []
    for r, (doc_id, text) in enumerate(rows):
        for k, raw in enumerate((text or "").split("\n")):
            line = raw.strip(" \t\r\x0b\x0c").lower()
            if line:
                s = frozenset(line[i:i + size] for i in range(len(line) - size + 1)) if len(line) >= size else frozenset([line])
                lines.append((doc_id, r, k, s))
    links = [(a, b) for a, b in itertools.combinations(range(len(lines)), 2)
             if len(lines[a][3] & lines[b][3]) >= similarity * len(lines[a][3] | lines[b][3]) - 1e-9]
    root = classes(len(lines), links)
    first = {}
    for k, (doc_id, r, n, _) in enumerate(lines):
        first[root[k]] = min(first.get(root[k], (doc_id, n, k)), (doc_id, n, k))
    kept = {v[2] for v in first.values()}
    return {(r, n): k in kept for k, (_, r, n, _) in enumerate(lines)}


def contamination(rows, items, window=13):
    windows = {}
    for item_id, text in items:
        w = item_words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(str(item_id))
    out = []
    for doc_id, text in rows:
        w = item_words(text)
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                who = windows.get(tuple(w[i:i + size]))
                if who:
                    found |= who
                    hit |= set(range(i, i + size))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def rule_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))


def targets(sizes, share=1.5, limit=2.0, cycle=(5, 2, 1)):
    """{source: target} of {source: words}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(order)}
    cap = {s: limit * sizes[s] for s in order}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(cap[s] for s in capped)
        got = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if got[s] > cap[s]}
        if not over:
            return {s: cap[s] if s in capped else got[s] for s in order}
        capped |= over


def repeats(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the rest) per row."""
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    gone = {}
    for k in order:
        b = (rows[k][1] or "").encode()
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                mask[i:i + length] = True
            seen.add(s)
        gone[k] = mask
    for k, (doc_id, text) in enumerate(rows):
        b, m = (text or "").encode(), gone[k]
        kept = np.frombuffer(b, np.uint8)[~m].tobytes()
        spans = int((np.diff(np.concatenate([[0], m.view(np.int8)])) == 1).sum())
        out.append((doc_id, len(b), int(m.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def window_repeats(rows, window=13):
    """(doc_id, n_words, n_removed, sha256 of the rest) per row."""
    words = [WORD.findall(t or "") for _, t in rows]

    def before(a, b):
        return a is None and b is not None or a is not None and b is not None and a < b

    least = {}
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if key not in least or before(i, least[key]):
                least[key] = i
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if before(least[tuple(w[k:k + window])], i):
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus_words(rows, every=199, length=6, count=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= length and n >= count}


def edits_to_one(a, b):
    """Edit distance of one, by the recurrence."""
    if abs(len(a) - len(b)) > 1:
        return False
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1] == 1


def variants(counts, margin=5):
    """{word: (form, root, n, n_near, form_n)}"""
    words = sorted(counts)
    near = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if edits_to_one(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= margin * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in words}


def manifest(rows, every=7):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text) rows."""
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(digests):
        """Top, and per leaf its steps (siblings before, siblings after)."""
        steps = [[] for _ in digests]
        below = [[k] for k in range(len(digests))]
        while len(digests) > 1:
            nodes, under = [], []
            for k in range(0, len(digests), 2):
                run = digests[k:k + 2]
                for s in range(len(run)):
                    for x in below[k + s]:
                        steps[x].append((run[:s], run[s + 1:]))
                nodes.append(sha("".join(run)))
                under.append([x for b in below[k:k + 2] for x in b])
            digests, below = nodes, under
        return digests[0] if digests else None, steps

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for rows_of in groups.values():
        rows_of.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {x: tree([leaf(r) for r in groups[x]]) for x in order}
    root, above = tree([trees[x][0] for x in order])
    out = []
    for x, up in zip(order, above, strict=True):
        for row, steps in zip(groups[x], trees[x][1], strict=True):
            i, source, lang, n, text = row
            bad = zlib.crc32(("" if i is None else str(i)).encode()) % every == 0 and n is not None
            folded = leaf((i, source, lang, n + 1, text)) if bad else leaf(row)
            for left, right in [*steps, *up]:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join(d for left, right in [*steps, *up] for d in (*left, *right)))
            out.append((i, leaf(row), trees[x][0], root, proof, folded, folded == root))
    return out
