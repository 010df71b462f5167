import os
import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures as X  # noqa: E402
from sacctlens.llm import cgk, common, components, linechunks, parityjoin, superkmers, textkit  # noqa: E402


@pytest.fixture(scope="module")
def rows():
    return X.corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return X.frame(spark, rows)


def test_words_match_the_pattern(rows):
    for _, text, *_ in rows:
        buf, offs = textkit.buffers(pa.array([text, "a b", text]))
        starts, ends, at = textkit.word_spans(buf, offs)
        want = X.words(text)
        assert [buf[a:b].tobytes().decode() for a, b in zip(starts, ends)] == want + ["a", "b"] + want
        assert at.tolist() == [0, len(want), len(want) + 2, 2 * len(want) + 2]


# --- op4

@pytest.mark.parametrize("window,hot,part", [(35, 10_000, 50_000), (35, 1, 7), (5, 3, 20), (1, 2, 50)])
def test_repeats_equal_brute_force(docs, rows, window, hot, part):
    got = Counter(tuple(r) for r in superkmers.remove_repeats(docs, window=window, hot_runs=hot, part_runs=part)
                  .select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == X.without_repeats(rows, window)


def test_repeats_of_empty_and_null_ids(spark):
    assert superkmers.remove_repeats(X.frame(spark, [])).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text, None, None), (None, text + " more", None, None), (7, "short", None, None)]
    got = Counter(tuple(r) for r in superkmers.remove_repeats(X.frame(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == X.without_repeats(rows)


def test_hash_collisions_are_told_apart():
    buf = np.frombuffer(b"abcabdabc", np.uint8)
    lo, hi = np.array([0, 3, 6]), np.array([3, 6, 9])
    assert superkmers.repeated_windows(buf, lo, hi, np.zeros(3, np.uint64)).tolist() == [True, False, True]


# --- op6

def test_near_copies_equal_brute_force(docs, rows):
    got = parityjoin.near_copies(docs, bucket_keys=500).collect()
    want = X.near_groups(rows)
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((i, want[i]) for i, *_ in rows)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(X.shingles(t))) for i, t, *_ in rows)


@pytest.mark.parametrize("long_list", [parityjoin.LONG_LIST, 5])
def test_near_copies_around_a_hub_that_is_not_the_smallest(spark, monkeypatch, long_list):
    """The copies link with the original only, which has the largest id."""
    monkeypatch.setattr(parityjoin, "BLOCK", 4)
    monkeypatch.setattr(parityjoin, "LONG_LIST", long_list)
    monkeypatch.setattr(parityjoin, "SENT_IDS", 0)        # the way for many ids
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(30):
        w = list(base)
        for at in rng.sample(range(0, 200, 9), 5):
            w[at] = f"x{i}"
        rows.append((i, " ".join(w), None, None))
    rows.append((99, " ".join(base), None, None))
    want = X.near_groups(rows)
    assert len(set(want.values())) == 1
    got = {r.doc_id: r.component_id for r in parityjoin.near_copies(X.frame(spark, rows)).collect()}
    assert got == want


def test_near_copies_edges(spark):
    assert parityjoin.near_copies(X.frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f", None, None), (1, "a b c d e f", None, None), (2, "A b C d e F", None, None), (3, None, None, None), (4, "", None, None), (5, "", None, None)]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in parityjoin.near_copies(X.frame(spark, rows)).collect()}
    assert got == {(None, 2, None), (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5)}


def test_keys_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    bands = parityjoin.Bands()
    for n in (1, 2, 3, 5, 9, 40, 255, 260, 400, 3000):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = a[rng.permutation(len(a))[int(rng.integers(0, len(a) // 4 + 1)):]]
            extra = rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 1))).astype(np.uint64)
            b = np.unique(np.concatenate((b, extra)))
            x, y = parityjoin.sketch_of(a).tobytes(), parityjoin.sketch_of(b).tobytes()
            if parityjoin.linked(a, b):
                assert np.intersect1d(parityjoin.keys_of(a, bands), parityjoin.keys_of(b, bands)).size
                assert parityjoin.may_link(len(a), len(b), x, y)


@pytest.mark.parametrize("ids", [list(range(10**7, 10**7 + 900)), [5, -3, 2**63 - 1, -2**63, 0], [7]])
def test_blobs_of_keys_come_back(ids):
    rng = np.random.default_rng(2)
    names, count = np.array(ids, "<i8"), rng.integers(1, 4, len(ids))
    owner = np.repeat(np.arange(len(ids)), count)
    keys = rng.integers(0, 1 << 63, len(owner)).astype(np.uint64)
    blob = parityjoin._pack(names, owner, keys)
    doc, key = parityjoin._unpack(blob)
    assert doc.tolist() == names[owner].tolist() and key.tolist() == (keys >> np.uint64(32)).tolist()
    # with many buckets a document has a key or two in each: beside these, it takes little more than a byte
    if len(ids) > 100:
        assert len(pa.compress(blob, "lz4_raw", asbytes=True)) < 4 * len(keys) + 1.5 * len(ids)


def test_sketches_are_written_once(spark, monkeypatch):
    written = []
    keep = parityjoin.materialize
    monkeypatch.setattr(parityjoin, "materialize", lambda df: written.append(df.columns) or keep(df))
    rows = [(i, "a b c d e f g h " + "x" * (i % 3), None, None) for i in range(9)]
    got = {r.doc_id: r.component_id for r in parityjoin.near_copies(X.frame(spark, rows)).collect()}
    assert got == X.near_groups(rows)
    assert sum("sketch" in columns for columns in written) == 1


# --- op10

def chunks_of(text, window, divisor):
    """The chunks as the operator cuts them, one text at a time."""
    _, _, starts, ends, _, begins = linechunks.chunk_edges(pa.array([text]), window, divisor)
    lines = text.encode().split(b"\n")
    edges = [*begins.tolist(), len(lines)]
    return [(a, [x.decode() for x in lines[a:b]]) for a, b in zip(edges, edges[1:])]


@pytest.mark.parametrize("window,divisor", [(2, 3), (1, 2), (3, 4)])
def test_line_dedup_equals_brute_force(docs, rows, window, divisor):
    first = {}
    order = sorted({(i, t) for i, t, *_ in rows if t is not None}, key=lambda r: r[0])
    for i, text in order:
        for a, lines in chunks_of(text, window, divisor):
            if len(lines) > 1 and "".join(lines).strip():
                first.setdefault("\n".join(lines), (i, a))
    want = Counter()
    for i, text, *_ in rows:
        if text is None:
            want[(i, None, 0, 0)] += 1
            continue
        kept, gone = [], 0
        for a, lines in chunks_of(text, window, divisor):
            if len(lines) > 1 and "".join(lines).strip() and first["\n".join(lines)] != (i, a):
                gone += len(lines)
            else:
                kept += lines
        want[(i, "\n".join(kept), text.count("\n") + 1, gone)] += 1
    out = linechunks.dedup(docs, window=window, divisor=divisor)
    got = Counter(tuple(r) for r in out.select("doc_id", "text", "n_lines", "n_removed_lines").collect())
    assert got == want
    assert sum(n for (_, _, _, gone), n in want.items() if gone) > 5
    assert [c for c in out.columns if c not in ("n_lines", "n_removed_lines")] == docs.columns


def runs_removed(texts):
    """The line numbers to remove of each text in order: all runs of two or more lines that begin earlier too."""
    first, out = {}, []
    for k, text in enumerate(texts):
        lines, gone = text.split("\n"), set()
        for a in range(len(lines)):
            for b in range(a + 2, len(lines) + 1):
                run = tuple(lines[a:b])
                where = first.setdefault(run, (k, a))
                if where != (k, a) and "".join(run).strip():
                    gone |= set(range(max(a, where[1] + b - a) if where[0] == k else a, b))
        out.append(gone)
    return out


def test_line_dedup_removes_all_repeated_runs(spark, docs, rows):
    rng = random.Random(9)
    awkward = []
    for i in range(120):                                             # runs of every length between other lines, periodic ones, blank lines
        size = rng.randint(2, 8)
        at = rng.randrange(40)
        awkward.append((1000 + i, "\n".join([f"before {i}"] + [f"passage {at + j}" for j in range(size)] + [f"after {i}"]), None, None))
    for i in range(40):
        awkward.append((2000 + i, "\n".join(rng.choices(["a", "b", "", " ", f"own {i}"], k=rng.randint(1, 9))), None, None))
    awkward += [(3000, "x\nx\nx\nx", None, None), (3001, "é\nß", None, None), (3002, "1\né\nß\n2", None, None)]
    for given, frame in ((rows, docs), (awkward, X.frame(spark, awkward))):
        order = sorted({(i, t) for i, t, *_ in given if t is not None})
        gone = dict(zip(order, runs_removed([t for _, t in order])))
        want = Counter()
        for i, text, *_ in given:
            if text is None:
                want[(i, None, 0, 0)] += 1
                continue
            cut = gone[(i, text)]
            kept = [x for k, x in enumerate(text.split("\n")) if k not in cut]
            want[(i, "\n".join(kept), text.count("\n") + 1, len(cut))] += 1
        got = linechunks.dedup(frame).select("doc_id", "text", "n_lines", "n_removed_lines").collect()
        assert Counter(tuple(r) for r in got) == want
        assert sum(n for (*_, removed), n in want.items() if removed) > 5


def test_line_dedup_of_nothing(spark):
    assert linechunks.dedup(X.frame(spark, [])).count() == 0


def test_boundaries_resist_shifts():
    rng = random.Random(2)
    lines = [f"line {rng.random()}" for _ in range(200)]
    a, b = "\n".join(lines), "\n".join(["new"] + lines)
    of = lambda t: {tuple(x) for _, x in chunks_of(t, 2, 3)}
    assert len(of(a) & of(b)) >= len(of(a)) - 2


# --- op3

def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(len(out))
        what = rng.random()
        if what < 0.4:
            out[k] = out[k][:-1] + "q"
        elif what < 0.7:
            out.insert(k, "zz")
        else:
            del out[k]
    return out


def edit_distance_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_closest_is_the_edit_distance():
    rng = random.Random(4)
    for _ in range(200):
        p = "".join(rng.choices("abc", k=rng.randint(1, 20)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 40)))
        assert cgk.closest(p, cgk.masks(p), t) == edit_distance_inside(p, t)


def test_leaks_reach_the_target_recall(spark):
    rng = random.Random(9)
    vocab = ["".join(rng.choices("abcdefghié", k=rng.randint(2, 9))) for _ in range(3000)]
    prose = lambda k: rng.choices(vocab, k=k)
    items = [(i, " ".join(prose(rng.randint(9, 60)))) for i in range(40)] + [(90, "too short"), (91, None), (92, "")]
    rows, exact, near = [], set(), set()
    for d in range(300):
        i = rng.randrange(40)
        w = items[i][1].split()
        if d % 3 == 0:
            body = [x.upper() + "," if k % 5 == 0 else x for k, x in enumerate(w)]
            exact.add((d, i))
        elif d % 3 == 1:
            body = edited(rng, w, max(1, int(0.08 * len(w))))
            near.add((d, i))
        else:
            body = []
        rows.append((d, " ".join(prose(rng.randint(0, 80)) + body + prose(rng.randint(0, 80))), None, None))
    rows += [(900, None, None, None), (901, "", None, None), (902, "Too short", None, None), (903, "This is too short.", None, None)]
    exact.add((902, 90))                     # two words: only as the whole text
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = X.frame(spark, rows)
    got = cgk.leaks(docs, bench).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert exact <= pairs and pairs <= exact | near
    assert len(pairs & near) >= 0.9 * len(near)
    assert all(r.distance <= cgk.MAX_EDITS * r.item_chars for r in got)
    kept = cgk.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in pairs}
    assert cgk.leaks(X.frame(spark, []), bench).count() == 0
    assert cgk.leaks(docs, bench.limit(0)).count() == 0


def noisy(rng, text, rate):
    """Each character changed, followed by another, or gone, with that probability."""
    out = []
    for c in text:
        if rng.random() >= rate:
            out.append(c)
        elif (x := rng.random()) < 2 / 3:
            out += [rng.choice("abcdefghij")] if x < 1 / 3 else [c, rng.choice("abcdefghij")]
    return "".join(out)


def test_recall_by_length_and_damage():
    """Damaged copies within MAX_EDITS in running text of the same few words; nothing else is found."""
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdefghijklmnoprst", k=rng.randint(2, 9))) for _ in range(8000)]
    weights = [1 / (k + 10) for k in range(len(vocab))]
    prose = lambda k: " ".join(rng.choices(vocab, weights, k=k))
    lengths = [8, 15, 38, 120, 240]
    items = [(i, prose(lengths[i % 5])) for i in range(200)]
    index = cgk.Index(items)
    least = {"words": [0.95] * 5, 0.0: [1.0] * 5, 0.05: [0.7, 0.95, 0.95, 0.95, 0.95], 0.1: [0.4, 0.85, 0.9, 0.95, 0.95]}
    for damage, bounds in least.items():
        hurt = lambda t: " ".join(edited(rng, t.split(), max(1, len(t.split()) // 10))) if damage == "words" else noisy(rng, t, damage)
        docs = [f"{prose(40)} {hurt(t)} {prose(40)}" for _, t in items]
        got = {(r, i) for r, i, *_ in index.leaks(pa.array(docs))}
        assert all(r == i for r, i in got)
        for k, bound in enumerate(bounds):
            mine = [i for i, t in items[k::5] if cgk.closest(t, cgk.masks(t), docs[i]) <= int(cgk.MAX_EDITS * len(t))]
            assert sum((i, i) in got for i in mine) >= bound * len(mine), (damage, lengths[k])


def test_short_items_and_scripts_without_spaces():
    items = [(1, "日本語の試験問題です。答えは何ですか"), (2, "What is this?"), (3, "yes"), (4, None), (5, "ภาษาไทยเป็นภาษาที่มีวรรณยุกต์"), (6, "what IS this"), (7, "..."), (8, "中文")]
    texts = ["前文。日本語の試験間題です。答えは何ですか。後", "so what is, this", "Yes.", "yes no", None, "", "กกภาษาไทยเป็นภาษาที่มีวรรณยุกต์ขข", "what is", "...", "中 文", "什么中文"]
    got = cgk.Index(items).leaks(pa.array(texts, pa.string()))
    assert [(r, i, d) for r, i, d, *_ in got] == [(0, 1, 1), (1, 2, 0), (1, 6, 0), (2, 3, 0), (6, 5, 0), (9, 8, 0)]
    assert [f for *_, f in got[1:4]] == [1, 1, 0]
    assert cgk.Index([]).leaks(pa.array(texts, pa.string())) == []


def test_several_groups_of_items(spark, monkeypatch):
    items = [(i, " ".join(f"{w}{i}" for w in "ab cd ef gh ij kl mn op qr st".split())) for i in range(20)]
    docs = X.frame(spark, [(i, "x y " + t + " z", None, None) for i, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(cgk, "GROUP_BYTES", 200)
    assert {(r.doc_id, r.item_id) for r in cgk.leaks(docs, bench).collect()} == {(i, i) for i in range(20)}
    assert cgk.decontaminate(docs, bench).count() == 0


def test_pairs_across_components_equal_brute_force(monkeypatch):
    monkeypatch.setattr(parityjoin, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(parityjoin, "SKETCH_BYTES", 1000)
    rng = np.random.default_rng(0)
    base = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    sets = []
    for k in range(120):
        keep = rng.permutation(len(base))[:int(rng.integers(250, 400) if k % 3 else rng.integers(20, 60))]
        sets.append(np.unique(np.concatenate((base[keep], rng.integers(0, 1 << 63, int(rng.integers(0, 90))).astype(np.uint64)))))
    rows, want = [], set()
    for run in range(40):
        members, blocks = rng.permutation(120)[:int(rng.integers(2, 40))].tolist(), int(rng.integers(1, 4))
        for d in members:
            for other in range(blocks):
                rows.append((run, min(d % blocks, other), max(d % blocks, other), d % blocks, d, d // 3, len(sets[d]), parityjoin.sketch_of(sets[d]).tobytes()))
            want |= {(d, e) for e in members if d < e and d // 3 != e // 3 and parityjoin.may_link(
                len(sets[d]), len(sets[e]), parityjoin.sketch_of(sets[d]).tobytes(), parityjoin.sketch_of(sets[e]).tobytes())}
    rows.sort(key=lambda r: r[:4])
    table = pa.table(dict(zip(("run", "x", "y", "mine", "b", "label", "n", "sketch"), map(pa.array, zip(*rows)))))
    got = [(a, b) for batch in parityjoin._open_pairs(table, 75) for a, b in zip(*(c.to_pylist() for c in batch.columns))]
    assert set(got) == want and want


@pytest.mark.parametrize("block, cut", [(2048, 1 << 14), (8, 1 << 14), (8, 20)])
def test_lists_with_one_smallest_member_meet_together(spark, monkeypatch, block, cut):
    monkeypatch.setattr(parityjoin, "BLOCK", block)
    monkeypatch.setattr(parityjoin, "LONG_LIST", 12)
    monkeypatch.setattr(parityjoin, "CUT_MEMBERS", cut)
    monkeypatch.setattr(parityjoin, "PAIRS_AT_ONCE", 500)
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    sets = [np.unique(np.concatenate((base[rng.permutation(len(base))[:270]], rng.integers(0, 1 << 63, 20).astype(np.uint64)))) for _ in range(40)]
    runs = {run: [run % 3, *sorted(set(rng.integers(3, 40, int(rng.integers(2, 25))).tolist()))] for run in range(60)}
    want = {(a, b) for m in runs.values() for a in m for b in m if a < b and a // 2 != b // 2 and parityjoin.linked(sets[a], sets[b])}
    inside = {(a, b) for m in runs.values() for a in m for b in m if a < b and a // 2 != b // 2}
    frame = spark.createDataFrame([(r, b) for r, m in runs.items() for b in m], "run long, b long")
    labels = spark.createDataFrame([(d, d // 2) for d in range(40)], "node long, component long")
    table = spark.createDataFrame([(d, len(s), *(bytearray(parityjoin.sketch_of(s, k).tobytes()) for k in (parityjoin.COARSE, parityjoin.FINE))) for d, s in enumerate(sets)],
                                  "doc_id long, n long, sketch binary, fine binary")
    got = {(r.a, r.b) for r in parityjoin.across(frame, labels, table).collect()}
    assert want and want <= got <= inside


def test_a_pair_of_many_lists_is_said_once(monkeypatch):
    """Forty lists that share their smallest member and most others: the pair is compared and said once."""
    rng = np.random.default_rng(2)
    shingles = np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64))
    sketch = parityjoin.sketch_of(shingles).tobytes()
    members = [(None, 0, d, d, len(shingles), sketch, None) for d in range(10)]
    lists = [(run, 0, None, None, None, None, sorted(rng.permutation(10)[:int(rng.integers(2, 10))].tolist())) for run in range(40)]
    types = {"run": pa.int64(), "mine": pa.int32(), "b": pa.int64(), "label": pa.int64(), "n": pa.int64(), "sketch": pa.binary(), "list": pa.list_(pa.int64())}
    table = pa.table({k: pa.array(v, t) for (k, t), v in zip(types.items(), zip(*members, *lists))})
    for c in ("x", "y"):
        table = table.append_column(c, pa.array(np.zeros(len(table), np.int32)))
    got = [p for batch in parityjoin._open_in_lists(table, np.zeros(1, np.int64), 75) for p in zip(*(c.to_pylist() for c in batch.columns))]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for *_, m in lists for a in m for b in m if a < b}


@pytest.mark.parametrize("blocks", [1, 2])
def test_a_pair_of_many_lists_is_compared_once(monkeypatch, blocks):
    """Large lists that share their members, in several strips: a pair's sketches meet once, whatever the number of lists."""
    monkeypatch.setattr(parityjoin, "PAIRS_AT_ONCE", 500)
    monkeypatch.setattr(parityjoin, "MARKED_CELLS", 1000, raising=False)
    compared, before = [], parityjoin._Sets.open
    monkeypatch.setattr(parityjoin._Sets, "open", lambda self, i, j: (compared.extend(
        (min(a, b), max(a, b)) for a, b in zip(self.doc[i].tolist(), self.doc[j].tolist())), before(self, i, j))[1])
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    sets = [np.unique(np.concatenate((base[rng.permutation(len(base))[:int(rng.integers(200, 300))]], rng.integers(0, 1 << 63, 20).astype(np.uint64)))) for _ in range(120)]
    sketches = [parityjoin.sketch_of(x).tobytes() for x in sets]
    runs = [sorted(rng.permutation(120)[:int(rng.integers(80, 120))].tolist()) for _ in range(30)]
    rows = []
    for x in range(blocks):
        for y in range(x, blocks):
            mine = sorted({x, y})
            rows += [(x, y, None, d % blocks, d, d // 3, len(sets[d]), sketches[d], None) for m in mine for d in range(m, 120, blocks)]
            rows += [(x, y, run, m, None, None, None, None, [d for d in members if d % blocks == m]) for run, members in enumerate(runs) for m in mine]
    types = {"x": pa.int32(), "y": pa.int32(), "run": pa.int64(), "mine": pa.int32(), "b": pa.int64(), "label": pa.int64(), "n": pa.int64(),
             "sketch": pa.binary(), "list": pa.list_(pa.int64())}
    table = pa.table({k: pa.array(v, t) for (k, t), v in zip(types.items(), zip(*rows))})
    start = parityjoin._group_starts(table, ("x", "y"))
    got = [p for batch in parityjoin._open_in_lists(table, start, 75) for p in zip(*(c.to_pylist() for c in batch.columns))]
    met = {(a, b) for m in runs for a in m for b in m if a < b and a // 3 != b // 3}
    want = {(a, b) for a, b in met if parityjoin.may_link(len(sets[a]), len(sets[b]), sketches[a], sketches[b])}
    assert want and want < met and sorted(got) == sorted(want)
    assert len(compared) == len(set(compared))


def test_small_tables_are_written_by_few_tasks(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40, 2)], "a long, b long")
    wrote = []
    monkeypatch.setattr(components, "materialize", lambda *x: wrote.append(common.materialize(*x)) or wrote[-1])
    got = {(r.node, r.component) for r in components.components(edges, 20).collect()}
    assert got == {(i, i // 2 * 2) for i in range(40)}
    assert len(wrote) > 2 and all(len(t.inputFiles()) == 1 for t in wrote)
    assert len(common.materialize(common.few(edges.repartition(3, "a"), 3 * common.ROWS_A_FILE)).inputFiles()) == 3
