"""Plain versions of the operators, for comparison on small tables."""

import re
from collections import defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDLIKE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(_LOW)


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    words = SPACED.findall(lower(text))
    if not words:
        return frozenset()
    k = min(size, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def jaccard_groups(docs, size, num, den):
    """{id: (set size, component)} of [(id, text)]."""
    sets = {i: shingles(t, size) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    group = components(ids, links)
    return {i: (len(sets[i]), group[i]) for i in ids}


def contaminated(docs, items, size):
    """{id: (words, hit places, items)}."""
    found = defaultdict(set)
    for name, text in items:
        words = WORDLIKE.findall(lower(text))
        k = min(size, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            if name is not None:
                found[tuple(words[i:i + k])].add(name)
    out = {}
    for i, text in docs:
        words = WORDLIKE.findall(lower(text))
        hit, names = set(), set()
        for k in {len(p) for p in found}:
            for at in range(len(words) - k + 1):
                own = found.get(tuple(words[at:at + k]))
                if own:
                    names |= own
                    hit |= set(range(at, at + k))
        out[i] = (len(words), hit, names)
    return out


def without_hits(text, hit):
    """The text with each run of hit words cut out, the rest joined by a space."""
    if not hit:
        return text
    places = [m.span() for m in WORDLIKE.finditer(lower(text))]
    kept, at, i = [], 0, 0
    while i < len(places):
        if i in hit:
            kept.append(text[at:places[i][0]])
            while i + 1 in hit:
                i += 1
            at = places[i][1]
        i += 1
    kept.append(text[at:])
    return " ".join(p for p in (k.strip(" ") for k in kept) if p)


def without_repeated_lines(docs, size, words=None):
    """{id: text} of [(id, text)] in the order of ids; with ``words`` shorter runs with so many go as well."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        if text is None:
            out[i] = None
            continue
        lines = text.split("\n")
        filled = [k for k, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for n in range(1 if words else size, size + 1):
            for at in range(len(filled) - n + 1):
                run = tuple(lines[k] for k in filled[at:at + n])
                if n < size and sum(max(1, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for x in run) < words:
                    continue
                if run in seen:
                    gone |= set(filled[at:at + n])
                seen.add(run)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def without_repeated_windows(docs, size):
    """{id: (words, kept words)}."""
    words = {i: SPACED.findall(t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for at in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][at:at + size]), i)
    out = {}
    for i, own in words.items():
        gone = {k for at in range(len(own) - size + 1) if first[tuple(own[at:at + size])] < i for k in range(at, at + size)}
        out[i] = (len(own), [w for k, w in enumerate(own) if k not in gone])
    return out


def best_path(word, scores, unknown):
    """Pieces of a word (characters without a piece stay alone): largest sum, earlier starts win ties."""
    best = [(0.0, None)] + [None] * len(word)
    for start in range(len(word)):
        for end in range(start + 1, min(len(word), start + 64) + 1):
            score = scores.get(word[start:end])
            if score is None and end == start + 1:
                score = unknown
            if score is not None and (best[end] is None or best[start][0] + score > best[end][0]):
                best[end] = (best[start][0] + score, start)
    out, at = [], len(word)
    while at:
        out.append(word[best[at][1]:at])
        at = best[at][1]
    return out[::-1]


def piece_ids(text, vocabulary):
    scores = {p: s for p, s, _ in vocabulary.scored}
    ids = {p: i for p, _, i in vocabulary.scored}
    out, known = [], {}
    for word in re.findall(r" *[^ \n]+|\n| +", " " + text) if text else []:
        if word not in known:
            known[word] = [i for piece in best_path(word, scores, vocabulary.unknown) for i in
                           ([ids[piece]] if piece in ids else [int(vocabulary.byte_ids[b]) for b in piece.encode()])]
        out += known[word]
    return out
