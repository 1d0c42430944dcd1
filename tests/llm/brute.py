"""Brute-force versions of the training-data queries."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def shingles(text):
    w = SPACE.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(rows):
    """(id, n_shingles, component) of (id, text) rows; every pair is compared."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[find(a)] = find(b)
    least: dict = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            r = find(k)
            least[r] = min(i, least.get(r, i))
    return [(i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)]


def quality(text):
    text = text or ""
    w = SPACE.findall(text)
    chars = sum(map(len, w))
    symbols = sum(c in "#*$%&|<>" for c in text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            hit |= set(range(i, i + 8))
    return len(w), chars, symbols, dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)


def contamination(docs, items):
    """{doc: (n_words, n_hit, items)} of dicts of texts."""
    windows = defaultdict(set)
    for i, t in items.items():
        w = alnum(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    lengths = {len(k) for k in windows}
    out = {}
    for d, t in docs.items():
        w, hit, found = alnum(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if x := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= x
        out[d] = (len(w), len(hit), sorted(map(str, found)))
    return out


def phrases(text, known):
    w, starts, labels = alnum(text), [], set()
    for label, phrase in known:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def secrets(text):
    text, out = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def url_verdicts(rows, op):
    """(id, host, path, template, purity, verdict) of (id, url, y) rows by a plain walk of the template tree."""
    parts = []
    for i, url, y in rows:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest, maxsplit=1)[0]
            path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        shape = [re.sub("[0-9]+", "#", s) if len(s) <= 64 else "{long}" for s in path.removeprefix("/").split("/", op.DEPTH - 1)]
        parts.append([i, host.translate(LOWER), path, shape, y])
    for at in range(max(len(p[3]) for p in parts)):
        for step in ("variable", "similar"):
            nodes = defaultdict(list)
            for p in parts:
                if len(p[3]) > at and not (step == "similar" and p[3][at] == "*"):
                    nodes[p[1], tuple(p[3][:at])].append(p)
            star = []
            for members in nodes.values():
                children = defaultdict(list)
                for p in members:
                    children[p[3][at]].append(p)
                if step == "variable":
                    if len(children) > op.CHILDREN and max(map(len, children.values())) < op.MAJORITY * len(members):
                        star += members
                    continue
                after = lambda ps: Counter(tuple(p[3][at + 1 :]) for p in ps)
                known = lambda ps: [p[4] for p in ps if p[4] is not None]
                whole, every = after(members), known(members)
                for own in children.values() if len(children) > 1 else ():
                    c, some = after(own), known(own)
                    cosine = sum(n * whole[k] for k, n in c.items()) / (sum(n * n for n in c.values()) * sum(n * n for n in whole.values())) ** 0.5
                    others, pool = len(every) - len(some), sum(every) / max(1, len(every))
                    z = 0.0
                    if some and others and 0 < pool < 1:
                        z = abs(sum(some) / len(some) - (sum(every) - sum(some)) / others) / (pool * (1 - pool) * (1 / len(some) + 1 / others)) ** 0.5
                    if z < op.Z and cosine >= op.SIMILAR:
                        star += own
            for p in star:
                p[3][at] = "*"
    tally = lambda ps: (sum(p[4] or 0 for p in ps), sum(p[4] is not None for p in ps))
    bad, n = tally(parts)
    share = bad / n if n else 0.0
    out = []
    groups, hosts = defaultdict(list), defaultdict(list)
    for p in parts:
        groups[p[1], tuple(p[3])].append(p)
        hosts[p[1]].append(p)
    for i, host, path, shape, _ in parts:
        hb, hl = tally(hosts[host])
        b, k = tally(groups[host, tuple(shape)])
        prior = (hb + op.STRENGTH * share) / (hl + op.STRENGTH)
        purity = 1 - (b + op.STRENGTH * prior) / (k + op.STRENGTH)
        out.append((i, host, path, "/" + "/".join(shape), purity, "block" if 1 - purity >= op.REJECT else "allow"))
    return out


def merkle(rows, arity=16):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text):
    whole trees in lists, every proof collected by walking up."""
    import hashlib
    import zlib

    sha = lambda *xs: hashlib.sha256("".join(xs).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
        return levels

    def path(levels, i):
        for level in levels[:-1]:
            low = i // arity * arity
            yield level[low:i], level[i + 1 : low + arity]
            i //= arity

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha(*map(field, r)), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            steps = [*path(trees[s], i), *path(top, k)]
            at = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                at = sha(*map(field, (*r[:4], lower(r[4]))))
            for left, right in steps:
                at = sha(*left, at, *right)
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], sha(*(x for a, b in steps for x in (*a, *b))), at, at == top[-1][0]))
    return out
