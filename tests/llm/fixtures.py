"""A small corpus with the awkward rows, and brute-force versions of the operators."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("size", T.StringType()), T.StructField("h", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("chunks", T.StringType()), T.StructField("component", T.StringType()), T.StructField("target", T.StringType())])

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def corpus(seed=3, n=60):
    """(doc_id, text, lang, source) rows: prose, near and exact copies, shared passages, awkward rows."""
    rng = random.Random(seed)
    vocab = {"en": ["the", "of", "and", *("".join(rng.choices(["the", "ing", "ou", "sh", "er", "wh"], k=3)) for _ in range(120))],
             "fr": ["le", "de", "et", *("".join(rng.choices(["eau", "é", "ou", "que", "ç", "oi"], k=3)) for _ in range(120))]}
    prose = lambda lang, k: " ".join(rng.choices(vocab[lang], k=k))
    lines = lambda lang, k: "\n".join(prose(lang, rng.randint(3, 12)) for _ in range(k))
    passage, shared = prose("en", 60), lines("en", 6)
    rows = []
    for i in range(n):
        lang = "fr" if i % 3 == 0 else "en"
        rows.append([i, lines(lang, rng.randint(2, 15)), lang, f"s{i % 4}" if i % 7 else None])
    for i, of in enumerate((1, 1, 1, 2, 4, 8)):                      # exact copies
        rows.append([100 + i, rows[of][1], rows[of][2], "s0"])
    for i in range(14):                                              # near copies, some of copies
        base = words(rows[11 + i % 3 if i < 9 else -1][1])
        for _ in range(rng.randint(0, 4)):
            base[rng.randrange(len(base))] = rng.choice(vocab["en"])
        rows.append([200 + i, " ".join(base), "en", "s1"])
    for i in range(8):                                               # passages and line chunks in common
        rows.append([300 + i, f"{prose('en', 20 + i)} {passage} {prose('en', 9)}", "en", "s2"])
        rows.append([320 + i, f"{lines('en', i)}\n{shared}\n{lines('en', 3)}", "en", "s2"])
    rows.append([400, " ".join(["la"] * 90), "fr", "s3"])            # ties, periodic text
    rows.append([401, "a b " * 50, "en", "s3"])
    rows.append([402, None, "en", "s3"])
    rows.append([403, "", None, None])
    rows.append([404, "  \t\n ", "fr", "s9"])
    rows.append([405, "one two", "en", "s0"])
    rows.append([406, "ONE two", None, "s0"])
    rows.append([407, "12 34 !!", "en", "s0"])
    rows.append([408, prose("en", 9000), "en", "s0"])                # long
    rows.append([409, "x" * 50000 + " é ß", "en", "s0"])
    rows.append([rows[5][0], rows[5][1], rows[5][2], rows[5][3]])    # a repeated row
    return [tuple(r) for r in rows]


def frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, 2, "y", "z", "t") for r in rows], SCHEMA).repartition(5)


def mixed_targets(rows):
    """Targets by resharing, source by source."""
    size = Counter()
    for _, text, _, source in rows:
        size[source] += len(words(text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, fixed = 1.5 * sum(size.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > 2 * size[s]]
        if not full:
            return size, {**fixed, **{s: left * weight[s] / total for s in open_}}
        for s in full:
            fixed[s] = 2.0 * size[s]
        left = 1.5 * sum(size.values()) - sum(fixed.values())


def without_repeats(rows, window=35):
    """{(doc_id, n_words, n_removed, sha)} counts."""
    seen = Counter()
    for _, text, *_ in rows:
        w = words(text)
        seen.update(tuple(w[k:k + window]) for k in range(len(w) - window + 1))
    out = Counter()
    for doc_id, text, *_ in rows:
        w = words(text)
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                keep[k:k + window] = [False] * window
        kept = " ".join(x for x, k in zip(w, keep) if k)
        out[(doc_id, len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, size=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def near_groups(rows, num=75):
    """doc_id -> component_id over ids."""
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(k)
    for k, (i, s) in enumerate(sets):
        for j, both in Counter(j for x in s for j in where[x] if j < k).items():
            if 100 * both >= num * (len(s) + len(sets[j][1]) - both):
                a, b = sorted((root(i), root(sets[j][0])))
                parent[b] = a
    return {i: root(i) for i in parent}
