"""Plain versions of the operators' results, by the words of their contracts, on small inputs."""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def root_of(parents, x):
    while parents[x] != x:
        x = parents[x]
    return x


def components(size, pairs, keys):
    """Smallest key that each position reaches."""
    parents = list(range(size))
    for a, b in pairs:
        parents[root_of(parents, a)] = root_of(parents, b)
    least = {}
    for x in range(size):
        root = root_of(parents, x)
        least[root] = min(least.get(root, keys[x]), keys[x])
    return [least[root_of(parents, x)] for x in range(size)]


def embeddings(rows, threshold=0.9):
    """rows: (key, vector); key: (n_links, component)."""
    keys, units = [k for k, _ in rows], []
    for _, v in rows:
        bad = not v or any(x is None or not math.isfinite(x) for x in v) or not any(v)
        a = None if bad else np.array(v, np.float64) / max(abs(x) for x in v)
        units.append(None if bad else a / np.linalg.norm(a))
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j])
        and float(units[i] @ units[j]) >= threshold
    ]
    links = Counter(x for pair in pairs for x in pair)
    return list(zip(keys, (links[i] for i in range(len(rows))), components(len(rows), pairs, keys), strict=True))


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = WORD.findall(text or "")
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    inside = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed


def covered(text, n):
    """Characters of the words in n-word windows that are found twice or more."""
    words = WORD.findall(text or "")
    at = defaultdict(list)
    for i in range(len(words) - n + 1):
        at[tuple(words[i : i + n])].append(i)
    inside = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(n)}
    return sum(len(words[i]) for i in inside)


def fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows, radius=4):
    """rows: (key, text); (key, fingerprint, component)."""
    prints = [fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    return list(zip([k for k, _ in rows], prints, components(len(rows), pairs, [k for k, _ in rows]), strict=True))


def substrings(texts, length=400):
    """(n_bytes, n_removed, n_spans, sha256 of what is left) of each text."""
    raws = [(t or "").encode() for t in texts]
    counts = Counter(hash(r[i : i + length]) for r in raws for i in range(len(r) - length + 1))
    exact = Counter(
        r[i : i + length] for r in raws for i in range(len(r) - length + 1) if counts[hash(r[i : i + length])] > 1
    ) if len(counts) < 300_000 else None
    out = []
    for r in raws:
        gone = bytearray(len(r))
        at = 0
        for i in range(len(r) - length + 1):
            n = counts[hash(r[i : i + length])]
            if n > 1 and (exact is None or exact[r[i : i + length]] > 1):
                start = max(i, at)
                gone[start : i + length] = b"\x01" * (i + length - start)
                at = i + length
        kept = bytes(x for x, g in zip(r, gone, strict=True) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def base_secrets(text):
    """(start, kind, end) of the base spans, sorted; kinds 0 assign, 1 access, 2 hex."""
    text, out = text or "", []
    keys = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    for m in re.finditer(keys + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def base_digest(text):
    kinds = ["assign", "access", "hex"]
    return hashlib.sha256(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in base_secrets(text)).encode()).hexdigest()


def article(page):
    """Blocks of an <article> of paragraphs and headings, as in the driver's pages."""
    found = re.search("<article>(.*)</article>", page, re.DOTALL)
    blocks = re.split("</?(?:p|h1)>", found[1]) if found else []
    plain = [" ".join(html.unescape(re.sub("</?b>", "", b).replace("<br>", " ")).split()) for b in blocks]
    return "\n".join(b for b in plain if b)


def collocations(rows, least=10, cover=50, top=2000):
    """rows: (lang, text); (lang, rank, phrase, a, l, r, n, score)."""
    found, sums = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            sums[lang] += len(words)
            for n in (1, 2, 3):
                found[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, counts in found.items():
        frequent = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        around = Counter()
        for p, a in frequent.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    around[p[i : i + n]] = max(around[p[i : i + n]], a)
        ranked = []
        for p, a in frequent.items():
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if not around[p] or 100 * around[p] < cover * a:
                ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sums[lang], -score))
    return sorted(out)


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def search(docs, items, top=20):
    """docs, items: (key, text); (item, rank, key, score)."""
    docs = [(k, Counter(terms(t))) for k, t in docs]
    docs = [(k, c) for k, c in docs if c]
    total, df = sum(sum(c.values()) for _, c in docs), Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        wanted = Counter(t for t in terms(text) if t in df)
        scores = []
        for key, counts in docs:
            m = 75 + 25 * sum(counts.values()) * len(docs) // total
            score = 0
            for t, times in wanted.items():
                weight = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1)))
                score += times * weight * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:top], 1)]
    return out


def chat(rows):
    """rows: (conversation, turn, role, text); conversation: (turns, their digest, loss characters, digest)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        own.sort(key=lambda x: x[:2])
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        learned = "".join(text for _, _, role, text in own if role == "assistant")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, learned)]
        out[conv] = len(own), digests[0], len(learned), digests[1]
    return out
