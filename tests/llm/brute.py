"""Plain Python versions of the corpus operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# op3


def base_measures(text):
    text = text or ""
    w = words(text)
    wins = defaultdict(list)
    for i in range(len(w) - 4):
        wins[tuple(w[i : i + 5])].append(i)
    covered = {i + k for at in wins.values() if len(at) > 1 for i in at for k in range(5)}
    rows = [x for x in text.split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(rows),
        "n_dup_lines": len(rows) - len(set(rows)),
        "n_repeat_words": len(covered),
    }


def base_failed(m):
    return m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]


def bucket_end(v):
    """The largest value with the same five leading bits."""
    if v < 32:
        return v
    shift = v.bit_length() - 5
    return (((v >> shift) + 1) << shift) - 1


def quality(docs, slack, min_docs):
    """docs: (lang, source, text). Verdicts in order."""
    rows = [(lang, source, base_measures(text)) for lang, source, text in docs]

    def values(m):
        return {
            "symbols": 1000 * m["n_symbols"] // max(1, m["n_words"]) * (m["n_words"] > 0),
            "dup_lines": 1000 * m["n_dup_lines"] // max(1, m["n_lines"]) * (m["n_lines"] > 0),
            "repeats": 1000 * m["n_repeat_words"] // max(1, m["n_words"]) * (m["n_words"] > 0),
            "word_length": 100 * m["word_chars"] // max(1, m["n_words"]) * (m["n_words"] > 0),
        }

    good = [r for r in rows if not base_failed(r[2])]

    def fence(group, measure):
        ends = sorted(bucket_end(values(m)[measure]) for _, _, m in group)
        at = lambda q: next(e for k, e in enumerate(ends, 1) if 4 * k >= q * len(ends))
        reach = 3 * (at(3) - at(1)) + slack[measure]
        return (at(1) - reach if measure == "word_length" else -1), at(3) + reach

    out = []
    for lang, source, m in rows:
        if base_failed(m):
            out.append(False)
            continue
        group = [r for r in good if r[:2] == (lang, source)]
        if len(group) < min_docs:
            group = [r for r in good if r[0] == lang]
        if len(group) < min_docs:
            group = good
        v = values(m)
        out.append(all(lo <= v[k] <= hi for k in v for lo, hi in [fence(group, k)]))
    return out


# op7


def near_lines(a, b):
    """Equal, or one word edit that is at most a fifth of the longer line."""
    if a == b:
        return True
    if len(a) < len(b):
        a, b = b, a
    if len(a) < 5 or len(a) - len(b) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def line_dedup(docs):
    """docs: (doc_id, text), ids distinct. {doc_id: removed line numbers}."""
    seen, out = {}, {}
    by_len = defaultdict(list)
    for doc, text in sorted(docs):
        out[doc] = []
        for i, line in enumerate((text or "").split("\n")):
            w = tuple(words(line))
            if not w:
                continue
            if w in seen:
                if seen[w]:
                    out[doc].append(i)
                    continue
                out[doc].append(i)
                continue
            near = any(near_lines(w, o) for k in (-1, 0, 1) for o in by_len[len(w) + k])
            seen[w] = near
            by_len[len(w)].append(w)
            if near:
                out[doc].append(i)
    return out


# op9


def substring_dedup(docs, window=13):
    """docs: (doc_id, text). {doc_id: (n_words, n_removed, kept)}."""
    first = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(doc, first.get(key, doc))
    out = {}
    for doc, text in docs:
        w = words(text)
        gone = {
            i + k
            for i in range(len(w) - window + 1)
            if first[tuple(w[i : i + window])] < doc
            for k in range(window)
        }
        out[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


# op10


def simhash(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    counts = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        counts.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, c in counts.items() if 2 * c > len(shingles))


def simhash_components(docs, max_bits=2):
    """docs: (doc_id, text). {doc_id: (hex fingerprint, component)}."""
    fps = {doc: simhash(text) for doc, text in docs}
    distinct = sorted(set(fps.values()))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                parent[root(a)] = root(b)
    smallest = {}
    for doc, f in fps.items():
        smallest[root(f)] = min(doc, smallest.get(root(f), doc))
    return {doc: (f"{f:016x}", smallest[root(f)]) for doc, f in fps.items()}
