import math
import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures as X  # noqa: E402
from sacctlens.llm import bitsliced, mixing, surrogates as S  # noqa: E402


# --- op1

def test_mix_meets_the_targets(spark):
    rows = X.corpus(n=400)
    docs = X.frame(spark, rows)
    got = mixing.mix(docs).collect()
    size, target = X.mixed_targets(rows)
    source = {(i, len(X.words(t))): s for i, t, _, s in rows}
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(X.words(t))) for i, t, *_ in rows)
    taken, largest = Counter(), Counter()
    for r in got:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s], rel=1e-9)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in size:
        assert abs(taken[s] - target[s]) <= 2 * largest[s]
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs.repartition(3)).collect()))
    copies = mixing.repeated(docs)
    assert copies.count() == sum(r.copies for r in got)
    assert copies.columns == [*docs.columns, "copy"]


def test_every_size_class_is_taken_at_the_rate(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 3)), None, "abc"[i % 2]) for i in range(3000)]
    got = mixing.mix(X.frame(spark, rows)).collect()
    by = defaultdict(list)
    for r in got:
        by[(r.doc_id % 2, r.size)].append(r.copies)
    rate = {s: next(r.target / r.source_size for r in got if r.doc_id % 2 == s) for s in (0, 1)}
    for (s, _), copies in by.items():
        assert abs(sum(copies) - rate[s] * len(copies)) <= 1


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 1}, {"a": 1, "b": 1000, "c": 1000, "d": 1, None: 50}, {"a": 0, "b": 0}, {"a": 0, "b": 9}, {None: 5}])
def test_targets(spark, sizes):
    rows = [(i, " ".join(["w"] * n), None, s) for i, (s, n) in enumerate(sizes.items())]
    got = {r.doc_id: r.target for r in mixing.mix(X.frame(spark, rows)).collect()}
    want = X.mixed_targets(rows)[1] if sum(sizes.values()) else dict.fromkeys(sizes, 0)
    assert got == {i: pytest.approx(want[s]) for i, s in enumerate(sizes)}


def test_mix_of_nothing(spark):
    assert mixing.mix(X.frame(spark, [])).count() == 0
    assert [tuple(r) for r in mixing.mix(X.frame(spark, [(None, None, None, None)])).select("doc_id", "size", "taken").collect()] == [(None, 0, 0)]


# --- op9

def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, chunk string, block int, x int").repartition(4)


def brute(rows, queries, k):
    ok = lambda v: v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)
    q = lambda v: [int(np.floor(256 * float(np.float32(c)))) for c in v]
    rows = [(i, q(v)) for i, v in rows if i is not None and ok(v)]
    out = Counter()
    for qi, qv in {(i, tuple(v)) for i, v in rows if queries(i)}:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows if i != qi and len(v) == len(qv))[:k]
        out.update((qi, n + 1, i, -s) for n, (s, i) in enumerate(scored))
    return out


@pytest.mark.parametrize("block_rows,chunk", [(16384, 256), (37, 3), (1, 1)])
def test_search_equals_brute_force(spark, block_rows, chunk):
    rng = np.random.default_rng(block_rows)
    n = 40 if block_rows == 1 else 300
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(n)]
    same = rng.normal(0, 0.5, 6).tolist()
    rows += [(1000 + i, same) for i in range(60)]                                 # ties
    rows += [(2000, None), (2001, []), (2002, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (2003, [float("nan")] * 6), (2004, [float("inf")] * 6), (None, same)]
    rows += [(2050, [0.5, -0.25]), (2051, [1.0, 1.0]), (0, rows[0][1]), (2052, [0.0] * 6), (2100, [0.0] * 6), (2150, [-100.0] * 6)]
    frame = vectors(spark, rows)
    got = Counter(tuple(r) for r in bitsliced.search(frame, frame.filter("vec_id % 50 = 0"), 5, block_rows=block_rows, chunk_queries=chunk).collect())
    assert got == brute(rows, lambda i: i % 50 == 0, 5)


def test_search_of_nothing(spark):
    empty = vectors(spark, [])
    assert bitsliced.search(empty, empty).count() == 0
    one = vectors(spark, [(0, [1.0])], "double")
    assert bitsliced.search(one, one).count() == 0


def test_slices_add_up():
    rng = np.random.default_rng(2)
    values = rng.integers(-50, 90, (200, 9))
    weights = rng.integers(-130, 130, 9)
    low = values.min(axis=0)
    slices = bitsliced.slices_of(values, low, 8)
    total = bitsliced.add_slices(slices, weights, ~slices)
    got = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:200].astype(np.int64) << k for k, s in enumerate(total))
    want = (values - low) @ np.maximum(weights, 0) + (255 - (values - low)) @ np.maximum(-weights, 0)
    assert np.array_equal(got, want)


# --- op2

TEXT = ("Mr. John Smith (john.smith@corp-mail.org, +1 (017) 555-7713) paid with 4111 1111 1111 1111.\nSmith's card 4111111111111111, "
        "IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789, host 10.200.3.44, 017 555 7713. token = \"b44e15e09fd311c3cf3163b66d5a9875b883d8ce\" "
        "TOKEN = \"B44E15E09FD311C3CF3163B66D5A9875B883D8CE\". Frau Анна Иванова schrieb; Анна. Order 1234567890123456, version 1.2.3.4.5, 999.1.1.1")


def test_finds_and_formats():
    kinds = Counter(k.split(":")[0] for _, _, k, _ in S.find(TEXT))
    assert kinds == {"given": 3, "family": 3, "email": 1, "phone": 2, "card": 2, "iban": 1, "ssn": 1, "ip": 1, "secret": 2}
    new, n = S.replace(TEXT, b"k", {})
    assert n == 16 and "Order 1234567890123456, version 1.2.3.4.5, 999.1.1.1" in new and len(new.split()) == len(TEXT.split())
    before, after = S.find(TEXT), S.find(new)
    assert [k for *_, k, _ in before] == [k for *_, k, _ in after]          # same types, Luhn, check digits, gender, script
    names = dict(zip((n for *_, n in before), (n for *_, n in after)))
    assert len(names) == len({n for *_, n in before}) == len(set(names.values()))
    assert all(names[a] == b for (*_, a), (*_, b) in zip(before, after))   # coreference, whatever the format
    for s in ("John", "Smith", "corp", "7713", "1111", "0532", "123-45", "10.200", "b44e", "B44E", "Анна", "Иванова"):
        assert s not in new
    assert S.replace(TEXT, b"k", {})[0] == new != S.replace(TEXT, b"other", {})[0]


def test_no_clash_and_no_real_value(spark, monkeypatch):
    """A tiny name space forces clashes: surrogates stay distinct, and none is a real entity."""
    rows = [(i, f"mail a{i % 10}@example.com b{i // 10}@example.com and Mr. {n} Stone", None, None)
            for i, n in enumerate(["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin"] * 3)]
    rows += [(500 + i, f"x{c}{d}@example.com", None, None) for i, (c, d) in enumerate((c, d) for c in "abcdef" for d in range(10))]
    rows += [(None, None, None, None), (900, "", None, None), (901, TEXT, None, None), (901, TEXT, None, None), (902, "nothing here", None, None)]
    rows = [tuple(r) for r in rows]
    docs = X.frame(spark, rows)
    got = S.pseudonymise(docs, b"k").collect()
    assert len(got) == len(rows)
    text = {i: t for i, t, *_ in rows}
    into, real = {}, {(k.split(":")[0], n) for _, t, *_ in rows for *_, k, n in S.find(t or "")}
    for r in got:
        old = text[r.doc_id]
        if old is None:
            assert r.text is None and r.n_entities == 0
            continue
        a, b = S.find(old), S.find(r.text)
        assert len(a) == len(b) == r.n_entities
        for (*_, kind, x), (*_, kind2, y) in zip(a, b):
            assert kind == kind2 and into.setdefault((kind, x), y) == y
            assert (kind.split(":")[0], y) not in real
    assert len({(k.split(":")[0], y) for (k, _), y in into.items()}) == len(into)
    assert {r.text for r in got if r.doc_id == 902} == {"nothing here"}
    assert S.pseudonymise(X.frame(spark, []), b"k").count() == 0


FORMATS = {
    "phone": ["+14155550123", "+49 30 1234567", "06 12 34 56 78", "+33 1 23 45 67 89", "+34 612 34 56 78", "612 34 56 78", "030 1234567", "Tel. 0301234567",
              "(415) 555-0123", "+1 (415) 555-0123"],
    "ipv6": ["2001:db8::1", "fe80::12:3", "2001:DB8:0:0:8:800:200C:417A"],
    "ip": ["1.1.1.1", "10.20.30.40"],
    "given": ["name: Peter Smith", "Nom : Peter Smith", "Kind regards,\nPeter Smith\n", "Peter Smith <write@us>", "Laura Smith came", "Dr. Peter Smith"],
}


def test_each_format_is_found_and_replaced():
    for kind, texts in FORMATS.items():
        for text in texts:
            text = f"So, {text} and so on"if "\n" not in text else text
            found = S.find(text)
            assert found and found[0][2].split(":")[0] == kind, text
            new, n = S.replace(text, b"k", {})
            assert n == len(found) and [k for *_, k, _ in S.find(new)] == [k for *_, k, _ in found], (text, new)
            assert all(text[a:b] not in new for a, b, *_ in found), (text, new)
    for text in ("12:30:45 and 1:2", "std::abc a::b ::1", "version 1.2.3.4.5", "2024-01-02 10 20 30 40", "Name: the rest", "Tel. Aviv 1234567", "0.25 12345678"):
        assert S.find(text) == [], text


def test_numbers_and_people_are_one_entity_in_any_form(spark):
    for forms in (["+49 30 1234567", "030 1234567"], ["+1 415 555 0123", "(415) 555-0123", "1-415-555-0123", "+14155550123"], ["+33 1 23 45 67 89", "01 23 45 67 89"]):
        assert len({S.find(f)[0][3] for f in forms}) == 1
    texts = ["Dr Maria Lopez", "Mrs Maria Lopez", "Prof. Zora Lopez", "Mrs Zora Hill", "Mr Kim Hill", "Mrs Kim Hill", "name: Zora Hill"]
    got = {r.doc_id: r.text.split() for r in S.pseudonymise(X.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]), b"k").collect()}
    names = {}
    for i, text in enumerate(texts):
        for old, new in zip(text.split()[1:], got[i][1:]):
            assert names.setdefault(old, new) == new
    assert len(set(names.values())) == len(names) == 5
    assert {names["Maria"], names["Zora"]} <= {n for n, g in S.KNOWN.items() if g == "f"} | {names["Zora"] if names["Zora"].endswith("a") else ""}
    assert names["Kim"] in S.GIVEN[("latin", "n")] or names["Kim"].endswith("e")


def test_used_up_name_spaces_end(spark):
    """All one-letter mails of a reserved domain, and all addresses of one-digit groups, are real."""
    rows = [(i, f"{c}@example.com", None, None) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    rows += [(100 + a, " ".join(f"{a}.{b}.{c}.{d}" for b in range(1, 10) for c in range(1, 10) for d in range(1, 10)), None, None) for a in range(1, 10)]
    got = S.pseudonymise(X.frame(spark, rows), b"k").collect()
    real = {w for _, t, *_ in rows for w in t.split()}
    new = [w for r in got for w in r.text.split()]
    assert len(new) == len(real) == len(set(new)) and not real & set(new)


def test_find_is_linear_on_odd_texts():
    for text in ("a" * 300000, "1" * 300000, "1 " * 150000, "@" * 100000, "a@" * 100000, "Mr. " * 50000, "Dr Abc " * 20000):
        S.replace(text, b"k", {})


def test_plain_mentions_agree_across_random_texts():
    rng = random.Random(8)
    for _ in range(100):
        mails = [f"{'ab'[rng.randrange(2)]}{rng.randrange(99)}@m{rng.randrange(3)}.example.org" for _ in range(6)]
        new, n = S.replace(" ".join(mails), b"k", {})
        assert n == 6 and len(new.split()) == 6
        pairs = set(zip(mails, new.split()))
        assert len(pairs) == len(set(mails))


def test_top_k_of_large_components(spark):
    """Components up to 1e9 and beyond, mixed signs: exact ranks; scores beyond a long show as its bounds."""
    rng = random.Random(11)
    rows = [(1, [300000.0, 1.0]), (2, [300000.0, 0.0]), (50, [400000.0, 0.0])]
    rows += [(100 + i, [rng.choice([-1, 1]) * 10 ** rng.uniform(0, 9) for _ in range(2)]) for i in range(200)]
    rows += [(400 + i, [1e9 * (-1) ** i, -1e9]) for i in range(4)] + [(500, [1e300, 1.0]), (501, [-1e300, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    limit = 1 << 56
    exact = {i: [max(-limit, min(limit, math.floor(256 * x))) for x in v] for i, v in rows}
    bound = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    want = []
    for q in (i for i in exact if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(exact[q], v)), i) for i, v in exact.items() if i != q)[:5]
        want += [(q, rank, i, bound(-s)) for rank, (s, i) in enumerate(scores, 1)]
    for block_rows, chunk in ((16384, 256), (16, 3)):
        got = bitsliced.search(frame, frame.filter("vec_id % 50 = 0"), 5, block_rows=block_rows, chunk_queries=chunk).collect()
        assert sorted(map(tuple, got)) == sorted(want)
