import os
import random
import re
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
import fixtures as X  # noqa: E402
from test_text_operators import runs_removed  # noqa: E402

SF001 = "/root/testdata/sf0.001"


def deduped(rows):
    """The texts without the later occurrences of repeated runs of two or more lines; documents of which nothing is left go."""
    rows = sorted(rows, key=lambda r: r["doc_id"])
    out = []
    for r, cut in zip(rows, runs_removed([r["text"] for r in rows])):
        lines = r["text"].split("\n")
        kept = "\n".join(x for k, x in enumerate(lines) if k not in cut)
        if len(cut) < len(lines):
            out.append({**r, "text": kept} | ({"n_chars": len(kept)} if cut else {}))
    return out


def plain(text):
    return " ".join(re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.lower()))


def key(rows):
    return Counter(tuple(sorted(r.items(), key=lambda x: x[0])) for r in rows)


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    awkward = spark.createDataFrame([(9001, None, "en", "src0", 0), (9002, "", None, None, 0), (9003, "12 34", "en", "src1", 5), (9004, " \n ", "fr", "src1", 3)], docs.schema)
    docs = docs.unionByName(awkward)
    rows = [r.asDict() for r in docs.collect()]
    want = [r for r in rows if any(c.isalpha() for c in r["text"] or "")]
    bench = [plain(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontaminate", "mix_sources"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF001).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name == "line_dedup":
            want = deduped(want)
        elif name == "near_duplicates":
            group = X.near_groups([(r["doc_id"], r["text"]) for r in want])
            want = [r for r in want if group[r["doc_id"]] == r["doc_id"]]
        elif name == "decontaminate":
            want = [r for r in want if not any(f" {b} " in f" {plain(r['text'])} " for b in bench)]
        if name == "mix_sources":
            got = out.collect()
            size, target = X.mixed_targets([(r["doc_id"], r["text"], None, r["source"]) for r in want])
            assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((r["doc_id"], r["source"], len(X.words(r["text"]))) for r in want)
            for r in got:
                assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 2 * r.size
            taken, largest = Counter(), Counter()
            for r in got:
                taken[r.source] += r.taken
                largest[r.source] = max(largest[r.source], r.size)
            assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in size)
        else:
            assert out.columns == docs.columns
            assert key(r.asDict() for r in out.collect()) == key(want)
        docs = out


def test_language_id_rejects_unknown_text(spark):
    """Gibberish of any script and an unlearned language go, the documents of the learned ones stay."""
    rng = random.Random(4)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    at = docs.columns.index("lang")
    known, unlearned = [r for r in rows if r[at] != "fr"], [(r[0], r[1], None, *r[3:]) for r in rows if r[at] == "fr"]
    noise = []
    for k, letters in enumerate(("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщ", [chr(0x4E00 + c) for c in range(2000)])):
        for i in range(40):
            text = " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(30 + 10 * i))
            noise.append((10_000 + 100 * k + i, text, None, "src0", len(text)))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, spark.createDataFrame(known + unlearned + noise, docs.schema), SF001).collect()}
    assert not kept & {r[0] for r in noise}
    assert len(unlearned) > 20 and len(kept & {r[0] for r in unlearned}) <= 0.05 * len(unlearned)
    assert len(kept & {r[0] for r in known}) >= 0.99 * len(known)


def test_line_dedup_leaves_nothing_of_copies(spark):
    """Whole copies go without debris, repeated passages go from the lines around them."""
    schema = spark.read.parquet(f"{SF001}/documents.parquet").schema
    rows = []
    for n in range(2, 12):
        text = "\n".join(f"own line {n} {k}" for k in range(n))
        rows += [(100 * n, text, "en", "src0", len(text)), (100 * n + 1, text, "en", "src1", len(text)),
                 (100 * n + 2, f"before {n}\n{text}\nafter {n}", "en", "src2", len(text) + 20)]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, schema), SF001).collect()}
    want = {i: (t, c) for i, t, _, _, c in rows if i % 100 == 0}
    want |= {100 * n + 2: (t := f"before {n}\nafter {n}", len(t)) for n in range(2, 12)}
    assert got == want


def test_run_and_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF001).count() > 0
    empty = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, empty, SF001).write.parquet(str(tmp_path / name))
        assert spark.read.parquet(str(tmp_path / name)).count() == 0


def test_stages_keep_extra_columns(spark, tmp_path):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumns(
        {c: F.concat(F.lit(c), F.col("doc_id")) for c in ("n_lines", "size", "chunks", "component_id", "n", "copies", "_id", "check", "_cuts", "_CUT_id", "_cut_hash", "_cut_lines", "_cleaned",
                                                                              "_lines_before", "_lines_removed", "_gone", "counted", "text_hash")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF001).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert out.columns == docs.columns
        assert out.filter("n_lines <> concat('n_lines', doc_id) or _id <> concat('_id', doc_id) or n <> concat('n', doc_id)").count() == 0
        docs = out
    corpus_pipeline.STAGES[-1][1](spark, docs, SF001).count()


HELD = """
import re, sys
import pyarrow as pa
from pyspark import cloudpickle
import pyspark.worker

def anon():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

def task(work):
    with open(sys.argv[2], "rb") as f:
        for _ in work(iter(pa.ipc.open_stream(f))):
            pass

with open(sys.argv[1], "rb") as f:
    work = cloudpickle.load(f)
task(lambda batches: work(b.slice(0, 40) for b in batches))
before = anon()
task(work)
print(anon() - before)
"""


def test_workers_keep_no_memory_between_tasks(spark, tmp_path, monkeypatch):
    """Spark's Python workers live on: what a task has freed goes back to the system at its end."""
    import subprocess

    import pyarrow as pa
    from pyspark import cloudpickle
    from sacctlens.llm import cgk, langid, linechunks, parityjoin

    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(5000)]
    texts = ["\n".join(" ".join(rng.choices(words, k=10)) for _ in range(60)) for _ in range(4000)]
    n = len(texts)
    batch = pa.record_batch({"doc_id": pa.array(range(n), pa.int64()), "text": texts, "lang": ["en"] * n, "text_hash": pa.array(range(n), pa.int64())})
    with pa.ipc.new_stream(str(tmp_path / "rows"), batch.schema) as w:
        w.write_batch(batch)

    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts[:20])], "doc_id long, text string, lang string")
    bench = spark.createDataFrame([(1, " ".join(words[:40]))], "item_id long, text string")
    works = []
    kept = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, work, *a, **k: works.append(work) or kept(self, work, *a, **k))
    langid.accepted(docs, *langid.learn_bound(docs)[:2], bound=1.0)
    linechunks.line_chunks(docs)
    parityjoin.describe_sets(docs)
    parityjoin.shared_keys(docs, 8)
    cgk.decontaminate(docs, bench)
    assert len(works) == 7
    held = []
    for k, work in enumerate(works):
        path = tmp_path / f"work{k}"
        path.write_bytes(cloudpickle.dumps(work))
        out = subprocess.run([sys.executable, "-c", HELD, str(path), str(tmp_path / "rows")], capture_output=True, text=True, check=True,
                             env=os.environ | {"PYTHONPATH": os.pathsep.join(p for p in sys.path if p), "OMP_NUM_THREADS": "1"})
        held.append(round(float(out.stdout)))
    assert sum(held) < 70, held
