"""Whitening, the filter audit and line dedup: against brute force, and with awkward rows."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hebdo.llm import filter_audit, line_dedup, queries, whitening

MEDIUM = "/root/testdata/sf0.01"
LOWER = {k: k + 32 for k in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------------- whitening
def _matrix(values, rng):
    d = len(values)
    q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ (np.eye(d, dtype=np.longdouble) - q.T @ q) / 2
    a = (q * np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize("values", [np.linspace(5, 1, 40), [9, 9 - 1e-8, 9 - 2e-8, 4, 4 - 1e-10, *np.linspace(3, 1, 20)],
                                    [3, 2, 2, 2, *[1] * 20], [1, 0, 0, 0], [0, 0]])
def test_eigenvectors_are_exact_to_double_precision(values):
    a, q = _matrix(values, np.random.default_rng(3))
    found, x = whitening.eigenvectors(a)
    scale = max(1, max(values))
    assert np.abs(found - np.sort(np.array(values, np.longdouble))[::-1]).max() < 1e-16 * scale
    assert np.abs(a @ x - x * found).max() < 1e-16 * scale and np.abs(x.T @ x - np.eye(len(a))).max() < 1e-16
    for k, v in enumerate(values):  # vectors of their own, where neighbours are far enough
        if all(abs(v - w) > 1e-9 for j, w in enumerate(values) if j != k):
            assert abs(abs(x[:, k] @ q[:, k]) - 1) < 1e-15


def test_products_of_large_entries_are_exact():
    rng = np.random.default_rng(5)
    x = rng.integers(-2**59, 2**59, (50, 3))
    batch = pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.int64()))], names=["x"])
    got = np.zeros((3, 3), object)
    for rows in whitening.products(np.array([5, -7, 2**40]), 4)([batch]):
        for power, i, row in zip(*(c.to_pylist() for c in rows.columns)):
            got[i] += np.array([int(v) << (whitening.LIMB_BITS * power) for v in row], object)
    y = x.astype(object) - np.array([5, -7, 2**40], object)
    assert (got == y.T @ y).all()
    sums = next(whitening.column_sums([batch]))
    assert [int(v) for v in sums["total"].to_pylist()] == list(x.astype(object).sum(axis=0))


def _white(rows):
    return {r.vec_id: r for r in rows}


def test_whitening_query_against_numpy(spark):
    rows = queries.QUERIES["op11_embedding_whitening"](spark, MEDIUM).collect()
    table = spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()
    x = np.floor(256 * np.array([r.embedding for r in table], dtype=float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    want = (x - s / n) @ vectors[:, :4] / np.sqrt(values[:4])
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == 4 * len(table)
    mine = np.array([[got[r.vec_id, k + 1].whitened for k in range(4)] for r in table])
    assert np.abs(mine * np.sign((mine * want).sum(axis=0)) - want).max() < 1e-10
    for r, row in zip(table, x):
        assert got[r.vec_id, 1].deviation == int(((n * row - s) ** 2).sum()) and got[r.vec_id, 1].n == n
    assert all(abs(got[table[0].vec_id, k + 1].explained / (values[k] / values.sum()) - 1) < 1e-9 for k in range(4))
    assert max(r.identity_error for r in rows) < 1e-9


def test_whitening_of_awkward_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (None, [-1.0, 0.5]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("id", "x", "n", "whitened", "row"):
        df = df.withColumn(name, F.lit("clash"))
    out = whitening.whiten(df).collect()
    assert sorted(str(r.vec_id) for r in out) == ["1", "2", "2", "None"]
    assert {r.n for r in out} == {3} and all(len(r.whitened) == 2 for r in out) and out[0].identity_error < 1e-12
    x = np.array([[256, 0], [0, 256], [-256, 128]])
    assert {int(r.deviation) for r in out if r.vec_id == 1} == {int(((3 * x[0] - x.sum(axis=0)) ** 2).sum())}
    line = spark.createDataFrame([(k, [float(k), 2.0 * k]) for k in range(4)], df.select("vec_id", "embedding").schema)
    assert all(len(r.whitened) == 1 and abs(r.explained[0] - 1) < 1e-12 for r in whitening.whiten(line).collect())  # rank 1
    for rows in ([], [(1, [1.0])], [(1, [1.0]), (2, [1.0])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() == []


def test_deviations_beyond_64_bits(spark):
    df = spark.createDataFrame([(1, [2.0**40, 0.0]), (2, [-(2.0**40), 1.0]), (3, [0.0, 3.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(df).collect()}
    x = np.array([[2**48, 0], [-(2**48), 256], [0, 768]], object)
    assert got == {k + 1: int(((3 * x[k] - x.sum(axis=0)) ** 2).sum()) for k in range(3)}


# ------------------------------------------------------------------------- filter audit
def _counts(text):
    words = WORD.findall(text or "")
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text or "")), len(text or ""), len(re.findall(r"[#$%&*|]", text or "")))


def _agree(texts):
    got = filter_audit.text_counts(pa.array(texts, pa.string()))
    assert [tuple(int(got[c][k]) for c in filter_audit.COUNTS) for k in range(len(texts))] == [_counts(t) for t in texts]


def test_transducer_against_regular_expressions(monkeypatch):
    rng = random.Random(2)
    texts = ["", None, "a", " a ", "é", "漢字 漢字 🙂 🙂x", "A#b  A#b\n\r\x0b\x0c\t| |", "q" * 64 + " " + "q" * 65 + " " + "q" * 65]
    texts += ["".join(rng.choice("aAé漢🙂 \n#b") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    _agree(texts)
    _agree([])
    monkeypatch.setattr("hebdo.llm.textbytes.BLOCK", 64)  # texts over many blocks, inserted in small lots
    monkeypatch.setattr(filter_audit, "SUMMED", 16)
    monkeypatch.setattr(filter_audit, "INSERTED", 5)
    _agree([*texts, " ".join(str(k % 700) for k in range(3000)), "x" * 500 + " " + "x" * 500 + "é y"])


def test_long_texts_are_counted():
    _agree(["x" * 3_000_000 + " " + "x" * 3_000_000 + " y " + "x" * 2_999_999, "é " * 700_000 + "A" * 9])


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(filter_audit.SpanTable, "_hashes", lambda self, begin, length, owner: np.zeros(len(begin), np.uint64))
    _agree(["a b c a b c " + "q" * 70 + " " + "q" * 69 + "r", "c b a", "aa ab aa"])


LANGS = ["en", "de", None, ""]


def _brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    smallest = {}
    for i, text, _ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    fails = []
    for i, text, lang in docs:
        words, distinct, capitals, points, symbols = _counts(text)
        first = smallest.get(text or "")
        f = {"A": words < 100, "B": 100 * distinct < 80 * words, "C": 100 * capitals > 10 * points, "D": symbols > 0,
             "E": first is not None and (i is None or i > first)}
        fails.append((lang or "", {k for k, v in f.items() if v}, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            here = own
            for step, name in enumerate(order, 1):
                gone = [x for x in here if name in x[1]]
                here = [x for x in here if name not in x[1]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [len(here), len(gone), sum(name in x[1] for x in own) - len(gone),
                                                   sum(x[1] == {name} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[name])
    return out


def test_audit_against_brute_force(spark):
    rng = random.Random(4)
    long = [" ".join(f"w{rng.randint(0, n)}" for _ in range(130)) for n in (400, 90, 900, 5000)]
    texts = [*long, long[0] + " # X", "SHOUT " * 120, "a few words", "", None, " ", long[3] + " |"]
    docs = [(rng.choice([*range(60), None, 7, 7, 7]), rng.choice(texts), rng.choice(LANGS)) for _ in range(240)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("part", F.lit(1)).withColumn("n", F.lit(2))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = filter_audit.audit(df, known)
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
           for r in out.collect()}
    want = _brute_audit(docs, labels)
    assert out.count() == len(got) == 3 * 600 and got == want
    assert filter_audit.audit(df.limit(0), known).collect() == []


# ------------------------------------------------------------------------- line dedup
def _key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def _brute_lines(docs, min_chars=10, min_docs=2):
    held = defaultdict(set)
    name = lambda i: (i is None, i or 0)
    for i, text in docs:
        for line in (text or "").split("\n"):
            held[_key(line)].add(name(i))
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(_key(x)) >= min_chars and len(held[_key(x)]) >= min_docs and min(held[_key(x)]) != name(i))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("min_docs", [1, 2, 3])
@pytest.mark.parametrize("share", [10_000, 2])
def test_lines_against_brute_force(spark, monkeypatch, min_docs, share):
    monkeypatch.setattr(line_dedup, "HEAVY_SHARE", share)
    rng = random.Random(6)
    pool = ["a shared line of text", " A SHARED line of text\t", "short", "Ünïcode wörds hére", "ünïcode wörds hére", "exactly 10", "only nine",
            "one line in every text", "", "\r", "漢字漢字漢字漢字漢字"] + [f"line number {k} of many" for k in range(30)]
    docs = [(rng.choice([*range(40), None]), rng.choice([None, "", "\n", "\n\n"]) if rng.random() < 0.15 else
             "\n".join(["one line in every text", *rng.choices(pool, k=rng.randint(0, 8))])) for _ in range(60)]
    docs += [docs[5]] * 3 + [(5, "\n".join(f"line number {k % 30} of many" for k in range(30_000)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("row", "id", "pos", "key", "lines", "dropped", "n", "first"):
        df = df.withColumn(name, F.lit("clash"))
    out = line_dedup.drop_shared_lines(df, min_docs=min_docs)
    got = sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.s)) for r in
                 out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("s")).collect())
    assert got == _brute_lines(docs, min_docs=min_docs)
    assert out.select("row.*").columns == df.columns


def test_lines_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_shared_lines(df).collect() == []
