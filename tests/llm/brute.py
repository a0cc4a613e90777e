"""Plain-Python versions of the operators for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, key string, label int"


def documents(spark, texts, ids=None):
    """Rows with every column of documents and some whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ["en", "de", None][k % 3], "src%d" % (k % 2), len(t or ""), "w", None, k) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if seen[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def quality_kept(rows, prior):
    """kept of (text, lang, source) rows: fences from sketches that lean on their parent by `prior` documents."""
    limits = {"word_length": (5, 40, True), "symbol_rate": (3, 20, False), "dup_line_rate": (3, 150, False),
              "repeat_rate": (3, 60, False), "capital_rate": (3, 60, False), "shout_rate": (3, 60, False)}
    measures, failed = [], []
    for text, _, _ in rows:
        words, chars, symbols, dup, repeat = base(text)
        n_lines = sum(1 for x in (text or "").split("\n") if WORD.search(x))
        capitals, shouts = sum(c.isupper() for c in text or ""), sum(c in "!?" for c in text or "")
        per = lambda a, b, by=1000: by * a // max(b, 1)
        measures.append({"word_length": per(chars, words, 100), "symbol_rate": per(symbols, words), "dup_line_rate": per(dup, n_lines),
                         "repeat_rate": per(repeat, words), "capital_rate": per(capitals, chars), "shout_rate": per(shouts, words)})
        failed.append(words < 10 or 100 * repeat > 20 * words)

    def bucket(v):
        return v if v < 32 else 16 * (v.bit_length() - 5) + (v >> (v.bit_length() - 5))

    def cells(measure, member):
        met = defaultdict(list)
        for m, bad, row in zip(measures, failed, rows, strict=True):
            if not bad and member(row):
                met[bucket(m[measure])].append(m[measure])
        return [(b, max(vs), float(len(vs))) for b, vs in met.items()]

    def lean(child, parent):
        total = sum(n for *_, n in parent)
        return child + [(b, v, n * prior / total) for b, v, n in parent]

    def cut(sketch, part):
        upto, total = 0.0, sum(n for *_, n in sketch)
        for _, v, n in sorted(sketch):
            upto += n
            if 4 * upto >= part * total - 1e-9:
                return v
        return None

    out = []
    for m, bad, (_, lang, source) in zip(measures, failed, rows, strict=True):
        ok = not bad
        for name, (reach, least, low) in limits.items() if ok else ():
            langs = lean(cells(name, lambda r: r[1] == lang), cells(name, lambda r: True))
            sketch = lean(cells(name, lambda r: r[1:] == (lang, source)), langs)
            q1, q3 = cut(sketch, 1), cut(sketch, 3)
            wide = reach * max(q3 - q1, least)
            ok = ok and m[name] <= q3 + wide and not (low and m[name] < q1 - wide)
        out.append(ok)
    return out


def line_dedup(rows, least=50):
    """{(doc_id, text): text without later copies} of (doc_id, text) rows, distinct."""
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seqs, gone = {}, defaultdict(set)
    for r in rows:
        seqs[r] = [(p, x) for p, x in enumerate((r[1] or "").split("\n")) if WORD.search(x)]
    seen = set()
    for r in rows:
        ls = [x for _, x in seqs[r]]
        n = [len(WORD.findall(x)) for x in ls]
        runs = [(a, b) for a in range(len(ls)) for b in range(a + 1, len(ls) + 1) if sum(n[a:b]) >= least]
        for a, b in sorted(runs):
            if tuple(ls[a:b]) in seen:
                gone[r].update(range(a, b))
            seen.add(tuple(ls[a:b]))
    out = {}
    for r in rows:
        cut = {seqs[r][k][0] for k in gone[r]}
        out[r] = r[1] if not cut else "\n".join(x for p, x in enumerate(r[1].split("\n")) if p not in cut)
    return out


def shingles(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def grouped(n, linked):
    """Smallest member of each member's component; linked(i, j) for i < j."""
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    degree = [0] * n
    for i in range(n):
        for j in range(i + 1, n):
            if linked(i, j):
                degree[i] += 1
                degree[j] += 1
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)], degree


def near(a, b, percent=80):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)
