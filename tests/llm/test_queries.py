"""The registered queries: against DuckDB, and against brute force where SQL can't express them."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
import regex
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from hebdo.llm import queries

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
TABLES = "documents pages benchmark labels conversations".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def norm(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows(spark, name, sf_dir=SMALL):
    return queries.QUERIES[name](spark, sf_dir).collect()


def documents(spark, sf_dir=SMALL):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4)))


def near_components(texts):
    """doc_id -> smallest doc_id reachable, by comparing every pair that shares a shingle."""
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, shared in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * shared >= 75 * (len(s) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}, {i: len(s) for i, s in sets.items()}


def bpe_of(text):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    from hebdo.llm.bpe import read_ranks
    if not hasattr(bpe_of, "codec"):
        bpe_of.codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=read_ranks(path), special_tokens={})
    ids = bpe_of.codec.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_one_query_for_each_operator():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in E.queries()
    assert set(queries.ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(names)
    key = lambda r, cols: tuple(norm(r[cols.index(c)]) for c in sorted(cols))
    assert sorted(key(tuple(r), df.columns) for r in df.collect()) == sorted(key(r, names) for r in cur.fetchall())


def test_near_groups_by_brute_force(spark):
    docs = documents(spark, MEDIUM)
    component, size = near_components({i: r.text for i, r in docs.items()})
    got = {r.doc_id: r for r in rows(spark, "op6_minhash_near_dedup", MEDIUM)}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (size[i], component[i], component[i] == i) for i in docs}


def test_repeated_substrings_by_brute_force(spark):
    docs = {i: (r.text or "").encode() for i, r in documents(spark).items()}
    seen = Counter(b[p:p + 200] for b in docs.values() for p in range(len(b) - 199))
    for r in rows(spark, "op7_substring_dedup"):
        data, keep = docs[r.doc_id], bytearray(b"\1") * len(docs[r.doc_id])
        for p in range(len(data) - 199):
            if seen[data[p:p + 200]] > 1:
                keep[p:p + 200] = bytes(200)
        spans = len(re.findall(rb"\x00+", bytes(keep)))
        kept = bytes(x for x, k in zip(data, keep, strict=True) if k)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(data), keep.count(0), spans, hashlib.sha256(kept).hexdigest())


def test_byte_bpe_is_that_of_the_library(spark):
    docs = documents(spark)
    for r in rows(spark, "op8_byte_bpe"):
        text = docs[r.doc_id].text or ""
        assert (r.n_tokens, r.ids_sha256) == bpe_of(text)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_classifier_on_rows_it_never_saw(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = rows(spark, "op9_quality_classifier", MEDIUM)
    assert len(got) == len(documents(spark, MEDIUM))
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)
    assert sum(p == 1 for p, q in held if q) >= 0.98 * sum(q for _, q in held)


def test_license_scan_finds_the_notices(spark):
    docs = documents(spark, MEDIUM)
    want = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
            "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "all-rights-reserved",
            "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    expected = {(i, k, want[line]) for i, r in docs.items() for k, line in enumerate((r.text or "").split("\n"))
                if line in want}
    got = rows(spark, "op10_license_scan", MEDIUM)
    exact = {(r.doc_id, r.first_line, r.license) for r in got if not r.missing and not r.added}
    assert expected and expected <= exact


def test_pipeline_by_brute_force(spark):
    docs = documents(spark, MEDIUM)
    scores = {r.doc_id: r for r in rows(spark, "op9_quality_classifier", MEDIUM)}
    good = [i for i in docs if scores[i].predicted == 1]
    best = {}
    for i in good:
        text = docs[i].text or ""
        key = "".join(WORD.findall(text))
        best[key] = min(best.get(key, (math.inf, 0)), (-len(text), i))
    left = {i: docs[i].text for _, i in best.values()}
    component, _ = near_components(left)
    left = {i: t for i, t in left.items() if component[i] == i}
    size = {i: len(WORD.findall(t or "")) for i, t in left.items()}
    by_source = defaultdict(int)
    for i, n in size.items():
        by_source[docs[i].source] += n
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(by_source))}
    target, free = {}, set(by_source)
    while free:  # share by weight; whoever is above the cap takes the cap, the rest share again
        level = (sum(by_source.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * by_source[s]}
        target |= {s: 3 * by_source[s] for s in over} if over else {s: weight[s] * level for s in free}
        free = free - over if over else set()
    want = Counter()
    for i in left:
        rate = target[docs[i].source] / by_source[docs[i].source]
        coin = int(hashlib.md5(f"17:{i}".encode()).hexdigest()[:13], 16) / 2**52
        want[i] = int(rate) + (coin < rate - int(rate))
    out = corpus_pipeline.run(spark, MEDIUM).collect()
    assert Counter(r.doc_id for r in out) == +want
    for r in out[:100]:
        assert (r.n_tokens, r.ids_sha256) == bpe_of(docs[r.doc_id].text)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).schema.simpleString() == docs.schema.simpleString()


def test_quality_rules_run_no_python(spark):
    plan = queries.QUERIES["op2_quality_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not regex.search("Python|Pandas|Arrow", plan)
