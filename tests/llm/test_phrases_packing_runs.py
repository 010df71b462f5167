import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures as X  # noqa: E402
from sacctlens.llm import packing, periodic, phrases, queries  # noqa: E402

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SF001 = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ phrases

def brute_phrases(rows, least, most):
    count, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(X.LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3, 4):
                count[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    q = p[s:s + m]
                    held[q] = max(held[q], a)
        scored = []
        for p, a in cand.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not (p in held and 100 * held[p] >= 80 * a):
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, x, y, total[lang], -s) for rank, (s, a, p, x, y) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out)


def phrase_rows(seed):
    """Prose of a few words, with fixed phrases, separators of every kind, and the awkward rows."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(25)] + ["é", "日本", "İx", "-", "x" * 300]
    fixed = [rng.sample(vocab, k) for k in (2, 3, 4, 4)]
    rows = X.corpus()
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 30)):
            words += rng.choice(fixed) if rng.random() < 0.3 else [rng.choice(vocab)]
        text = "".join((w.upper() if rng.random() < 0.2 else w) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r", "\x0b", "\x00"]) for w in words)
        rows.append((1000 + i, text, rng.choice(["en", "de", None, "und", ""]), "s0"))
    return rows


@pytest.mark.parametrize("seed, least, most, shard, words_shard", [(1, 6, 2000, 1 << 19, 1 << 20), (2, 3, 25, 400, 60), (3, 30, 2000, 1 << 19, 16)])
def test_phrases_equal_brute_force(spark, seed, least, most, shard, words_shard):
    """With one trie and dictionary, and with many small ones."""
    rows = phrase_rows(seed)
    got = phrases.collocations(X.frame(spark, rows), least, most, shard=shard, words_shard=words_shard)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, least, most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}


def test_phrases_query_and_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute_phrases([(r.doc_id, r.text, r.lang) for r in docs.collect()], 30, 2000)
    assert sorted(tuple(r) for r in queries.op11_phrases(spark, SF001).collect()) == want
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op11_phrases(spark, str(tmp_path)).count() == 0


def test_scores_beyond_64_bits(spark):
    """Counts are multiplied as decimals."""
    got = spark.sql("SELECT cast(cast(2000000 AS decimal(38,0)) * a AS decimal(38,0)) div (cast(l AS decimal(38,0)) + r) AS s "
                    "FROM VALUES (9223372036854775807L, 9223372036854775807L, 9223372036854775807L) AS t(a, l, r)").first().s
    assert got == 1_000_000


def test_trie_accepts_exactly_its_rows():
    rng = random.Random(5)
    for _ in range(40):
        top = rng.choice([3, 40, 300, 9000])
        rows = {tuple([rng.randint(1, top) if rng.random() < 0.7 else rng.randint(1, 3) for _ in range(k)] + [0] * (4 - k))
                for k in (rng.randint(2, 4) for _ in range(rng.randint(1, 900)))}
        rows = sorted(rows)
        trie = phrases.Trie.unpack(phrases.Trie.build(np.array(rows, np.int32)).pack())
        ids = []
        for _ in range(200):
            ids += [x for x in rng.choice(rows) if x] if rng.random() < 0.7 else [rng.randint(0, top + 2) for _ in range(4)]
        ids = np.array([*ids, 0], np.int32)
        got = np.zeros(trie.count + 1, np.int64)
        for _, state in trie.walk(ids, trie.starts(ids, rows[0][0], rows[-1][0])):
            got += np.bincount(trie.end[state], minlength=len(got))
        seen = Counter(tuple(ids[i:i + k].tolist()) + (0,) * (4 - k) for k in (2, 3, 4) for i in range(len(ids) - k + 1) if ids[i:i + k].all())
        assert got[1:].tolist() == [seen[r] for r in rows]


# ------------------------------------------------------------------ packing

def check_pieces(spark, docs, rows, length=4096):
    """Exact round trip, gapless sequences, lengths and padding; returns the share of padding."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (2,)) for r in rows)
    got = packing.pack(docs, TOKENIZER, length).collect()
    sequences, ids_of = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        ids_of[r.doc_id].append((r.sequence_id, r.offset, r.start, r.doc_tokens, np.frombuffer(r.ids, "<u4").tolist()))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    back = Counter()
    for doc_id, parts in ids_of.items():
        # Pieces of one document follow one another in the stream; rows that share an id start anew at 0.
        whole = []
        for _, _, start, size, ids in sorted(parts, key=lambda p: p[:2]):
            assert start == len(whole)
            whole += ids
            if len(whole) == size:
                back[(doc_id, tuple(whole))] += 1
                whole = []
        assert not whole
    assert back == want
    return padding / max(1, sum(n for parts in sequences.values() for _, n in parts))


def test_packing_round_trip(spark):
    rows = X.corpus() + [(500, "A<|endoftext|>B <|EndOfText|>", "en", "s0"), (501, "H̱ ẖ É ǅ İ K ' it's IT'S x.y. ...", "en", "s0"),
                         (502, "日本語。 ไทย \U0001F600!", None, None), (None, "no id", "en", "s0"), (503, "word " * 30000, "en", "s0")]
    docs = X.frame(spark, rows)
    check_pieces(spark, docs, rows)
    check_pieces(spark, docs, rows, length=128)
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0


def test_packing_of_the_table_is_tight_and_the_query_digests_it(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert check_pieces(spark, docs, [(r.doc_id, r.text) for r in docs.collect()]) < 0.005
    pieces = {(r.doc_id, r.start): (r.length, zlib.crc32(bytes(r.ids)), r.doc_tokens) for r in packing.pack(docs, TOKENIZER).collect()}
    got = queries.op12_packing(spark, SF001)
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32, r.doc_tokens) for r in got.collect()} == pieces
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]


def test_cuts_are_the_cheapest():
    rng = random.Random(2)
    for _ in range(300):
        length, total = 16, rng.randint(1, 90)
        places = [0]
        for x in sorted(rng.sample(range(1, total + 1), rng.randint(1, min(total, 30)))) + [total]:
            while x - places[-1] > length:
                places.append(places[-1] + length)
            if x > places[-1]:
                places.append(x)
        penalty = [0] + [rng.choice([0, 3, 7]) for _ in places[1:]]
        best = [0] + [None] * (len(places) - 1)
        for j in range(1, len(places)):
            best[j] = min(best[i] + length - (places[j] - places[i]) for i in range(j) if places[j] - places[i] <= length) + penalty[j]
        cuts = packing.best_cuts(np.array(places), np.array(penalty), total, length)
        cost = sum(length - (b - a) + penalty[places.index(b)] for a, b in zip(cuts, cuts[1:]))
        assert cost == min(b for p, b in zip(places, best) if p >= total - length)


def test_words_with_one_hash_go_through_the_tokenizer_whole(monkeypatch):
    import pyarrow as pa
    from sacctlens.llm.textkit import buffers
    texts = pa.array(["one two three", "Two, one! four", None, ""])
    want = packing.WordIds(TOKENIZER).ids(*buffers(texts))
    real = packing.span_hashes
    monkeypatch.setattr(packing, "span_hashes", lambda b, s, e, seed: real(b, s, e, seed) % np.uint64(3) if seed == 11 else real(b, s, e, seed))
    got = packing.WordIds(TOKENIZER).ids(*buffers(texts))
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


# ------------------------------------------------------------------ periodic runs

def brute_runs(w, least=24, times=3):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, times * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def brute_digest(doc_id, text):
    w = planted(doc_id, X.words(text))
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_equal_brute_force(spark):
    rng = random.Random(9)
    rows = [r for r in X.corpus() if r[0] != 408]
    for i in range(120):
        few = [f"v{k}" for k in range(rng.choice([1, 2, 3, 30]))]
        w = rng.choices(few, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            w += rng.choices(few, k=rng.randint(1, 14)) * rng.randint(2, 9) + rng.choices(few, k=rng.randint(0, 5))
        rows.append((2000 + i, " \n".join(w), "en", "s0"))
    rows += [(None, "a " * 40, "en", "s0"), (3000, "é ß " * 30, "en", "s0")]
    docs = X.frame(spark, rows)
    found = periodic.collapse(docs.withColumn("text", periodic.repeat_tail(F.col("text"), F.col("doc_id"))))
    got = Counter(tuple(r) for r in periodic.digests(found).collect())
    assert got == Counter(brute_digest(r[0], r[1]) for r in rows)
    assert found.columns == [*[c for c in docs.columns if c != "text"], "n_words", "runs", "collapsed"]
    assert periodic.digests(periodic.collapse(docs.limit(0))).count() == 0


def test_runs_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = queries.op13_periodic_runs(spark, SF001)
    assert Counter(tuple(r) for r in got.collect()) == Counter(brute_digest(r.doc_id, r.text) for r in docs.collect())
    assert got.dtypes == [*((c, "bigint") for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")), ("runs_sha256", "string"), ("collapsed_sha256", "string")]


def test_runs_of_random_words_and_long_texts():
    rng = random.Random(1)
    for _ in range(400):
        rows = []
        for _ in range(rng.randint(1, 5)):
            few = rng.choice([1, 2, 3, 8])
            w = [rng.randrange(few) for _ in range(rng.choice([0, 1, 5, 30, 80]))]
            if rng.random() < 0.5:
                w = w[:20] + [rng.randrange(few) for _ in range(rng.randint(1, 12))] * rng.randint(2, 8) + w[20:]
            rows.append(w)
        least, times = rng.choice([(24, 3), (6, 3), (4, 2), (2, 2), (9, 4)])
        offs = np.concatenate(([0], np.cumsum([len(w) for w in rows])))
        row, start, length, period = periodic.find_runs(np.array([x for w in rows for x in w], np.int64), offs, least, times)
        got = list(zip(row.tolist(), start.tolist(), length.tolist(), period.tolist()))
        assert got == [(k, *r) for k, w in enumerate(rows) for r in brute_runs(w, least, times)]
    long = np.array([*range(7)] * 20000 + [3] * 20000)
    assert [x.tolist() for x in periodic.find_runs(long, np.array([0, len(long)]))] == [[0, 0], [0, 140000], [140000, 20000], [7, 1]]


def test_equal_hashes_do_not_make_words_equal(monkeypatch):
    from sacctlens.llm.textkit import buffers, word_spans
    import pyarrow as pa
    buf, offs = buffers(pa.array(["aa bb aa longer-word-one longer-word-two", "bb x"]))
    starts, ends, _ = word_spans(buf, offs)
    real = periodic.span_hashes
    monkeypatch.setattr(periodic, "span_hashes", lambda b, s, e, seed: real(b, s, e, seed) % np.uint64(2) if seed < 2 else real(b, s, e, seed))
    n = periodic.word_numbers(buf, starts, ends).tolist()
    assert n[0] == n[2] and n[1] == n[5] and len(set(n)) == 5


def test_new_words_share_a_text_and_keep_their_own_ids():
    words = packing.WordIds(TOKENIZER)
    new = ["plain", "unquestionableness", "don't", "x1", "a.b", "straße", "日本語", "éa", "e\u0301a", ".", "ﬁx", "ªb", *(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(600))]
    want, calls, encode = words.encode(new), [], words.encode
    words.encode = lambda texts: calls.extend(texts) or encode(texts)
    at, size, pool = words.of_words(new)
    assert [pool[a:a + n].tolist() for a, n in zip(at, size)] == want
    assert len(calls) < 20                                  # not a text for each word
    words.ends_word[:] = False                              # a tokenizer that does not mark where words end
    at, size, pool = words.of_words(new)
    assert [pool[a:a + n].tolist() for a, n in zip(at, size)] == want
