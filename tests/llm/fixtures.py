"""Small tables with every odd case, and brute-force versions."""

import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string, line string, rep string, key string, u string"
SYLLABLES = {"en": "th er on an re he in ed nd ha at en es of or nt ea ti to it".split(), "fr": "le es de en ai ou re nt on er ent qu é eau tion ch".split()}


def prose(rng, n, lang="en"):
    words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    lines, at = [], 0
    while at < n:
        k = rng.randint(6, 30)
        lines.append(" ".join(words[at : at + k]) + ".")
        at += k
    return "\n".join(lines)


def odd_documents(seed=7):
    """Copies, near copies, shared passages, repeated lines, nulls, empty, wordless and long texts, ties and repeated rows."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(30, 220), rng.choice(["en", "fr"])) for _ in range(30)]
    shared = prose(rng, 150)
    texts = list(base)
    texts += [base[0], base[0], base[1], base[2] + " ende", base[3].replace(".", ",", 1)]
    for k in range(4, 8):
        w = base[k].split(" ")
        for _ in range(3):
            i = rng.randrange(len(w))
            texts.append(" ".join([*w[:i], "zzz", *w[i + 1 :]]))
    texts += [prose(rng, 40) + "\n" + shared + "\n" + prose(rng, 40) for _ in range(4)]
    texts += [None, "", " \t\n ", "!!! ???", "a", "one two three", "ONE TWO three", "x" * 3000, "ab" * 1500, "\n".join(["same line of some words here now."] * 40), "日本語 テキスト 漢字 " * 30, prose(rng, 4000), "été " * 300, "\x1c\x85 odd   spaces"]
    rows = [(i, t, rng.choice(["en", "fr", None]), "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    return [(*r, "x", "y", "z", None, "k", "v") for r in rows]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near_components(docs, percent=75):
    """{doc_id: (size, component)} of (doc_id, text)."""
    sets = {k: shingles(t) for k, t in docs}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            by[x].append(k)
    met = Counter((a, b) for own in by.values() for i, a in enumerate(own) for b in own[i + 1 :])
    for (a, b), n in met.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def without_passages(texts, length=400):
    """(kept bytes, spans) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((bytes(b for b, g in zip(r, gone, strict=True) if not g), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))))
    return out


def passages_and_words(texts, length=400, n=50):
    """(bytes, runs) of each text covered by strings of ``length`` bytes or of ``n`` words that start elsewhere too."""
    raws = [(t or "").encode() for t in texts]
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", r)] for r in raws]
    strings = [[(p[i][0], p[i + n - 1][1], tuple(r[a:b] for a, b in p[i : i + n])) for i in range(len(p) - n + 1)] for r, p in zip(raws, places, strict=True)]
    for own, r in zip(strings, raws, strict=True):
        own += [(i, i + length, r[i : i + length]) for i in range(len(r) - length + 1)]
    seen = Counter(x for own in strings for _, _, x in own)
    out = []
    for r, own in zip(raws, strings, strict=True):
        gone = bytearray(len(r))
        for a, b, x in own:
            if seen[x] > 1:
                gone[a:b] = b"\1" * (b - a)
        out.append((sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))))
    return out


def _words(line):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w]


def _close(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def dropped_lines(docs):
    """{(doc_id, line): exact} of lines that have an earlier equal or near one."""
    first, out, earlier = {}, {}, []
    near = {}
    for doc, text in sorted(set(docs), key=lambda r: r[0]):
        for n, line in enumerate((text or "").split("\n")):
            if not line.strip(" \t\n\x0b\f\r"):
                continue
            if line not in first:
                first[line] = (doc, n)
                words = _words(line)
                near[line] = len(words) >= 6 and any(len(e) >= 6 and _close(words, e) for e in earlier)
                earlier.append(words)
                if near[line]:
                    out[(doc, n)] = False
            else:
                out[(doc, n)] = True
    return out
