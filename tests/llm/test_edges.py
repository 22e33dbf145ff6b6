"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib

import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from hebdo.llm import (
    bpe, chat, exact_dedup, licenses, minhash, mixing, qda, quality_rules, substring_dedup, textbytes, warc,
)

BPE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LONG = " ".join(f"w{k % 977}" for k in range(60_000))
RUN = "x" * 5000
DOCS = [
    (1, "One two three four five six seven.", "a"), (2, "One two  three four five\nsix seven.", "a"), (3, None, "a"),
    (4, "", None), (5, " \t\n", None), (6, LONG, "b"), (6, LONG, "b"), (7, RUN, "b"), (8, RUN + " y", "c"),
    (None, "One two three four five six seven.", "c"), (9, "é漢字🙂 ok", "c"), (10, "é漢字🙂 ok", None),
]
SCHEMA = "doc_id long, text string, source string"
# names that the operators use for their own columns
CLASHES = ("row", "uid", "size", "rate", "copies", "coin", "bloom_hash", "n_chars", "text_sha256", "class_id",
           "component_id", "stats", "label", "places", "hashes", "score", "target", "key", "kept")


def frame(spark, rows=DOCS):
    df = spark.createDataFrame(rows, SCHEMA)
    for k, name in enumerate(CLASHES):
        df = df.withColumn(name, F.lit(k))
    return df


def labels(spark, rows=((1, 1), (6, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int")


def run_all(spark, docs):
    """Each operator's result, as a list of rows."""
    return {
        "mix": mixing.plan_copies(docs).collect(), "mixed": mixing.mix_sources(docs).collect(),
        "quality": quality_rules.quality(docs, labels(spark)).collect(),
        "exact": exact_dedup.exact_groups(docs).collect(), "unique": exact_dedup.drop_exact_copies(docs).collect(),
        "near": minhash.near_groups(docs).collect(), "distinct": minhash.drop_near_copies(docs).collect(),
        "cut": substring_dedup.remove_repeats(docs).collect(), "tokens": bpe.encode_documents(docs, *BPE).collect(),
        "scores": qda.classify(docs, labels(spark)).collect(), "good": qda.keep_good(docs, labels(spark)).collect(),
        "licenses": licenses.scan_licenses(docs).collect(),
    }


@pytest.fixture(scope="module")
def results(spark):
    return run_all(spark, frame(spark))


def test_a_row_for_each_document(results):
    for name in ("mix", "quality", "exact", "near", "cut", "tokens", "scores"):
        assert len(results[name]) == len(DOCS), name


def test_filters_return_the_columns(spark, results):
    want = frame(spark).columns
    for name in ("mixed", "unique", "distinct", "good"):
        assert results[name] and results[name][0].__fields__ == want, name


def test_empty_table(spark):
    assert all(r == [] for r in run_all(spark, frame(spark, [])).values())
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_mixing(spark, results):
    by_source = {r.row.source: r.target for r in results["mix"]}
    sizes = {r.row.source: r.source_size for r in results["mix"]}
    assert sizes == {"a": 14, "b": 120_001, "c": 11, None: 2}
    assert sum(by_source.values()) == pytest.approx(sum(sizes.values()))
    assert all(by_source[s] <= 3 * sizes[s] for s in sizes)
    assert {r.size for r in results["mix"] if r.row.doc_id in (3, 4, 5)} == {0}
    assert all(r.copies <= 3 for r in results["mix"])
    assert len({r.copies for r in results["mix"] if r.row.doc_id == 6}) == 1
    salted = mixing.BROADCAST_SOURCES
    try:
        mixing.BROADCAST_SOURCES = -1  # too many sources for a broadcast
        other = mixing.plan_copies(frame(spark)).collect()
    finally:
        mixing.BROADCAST_SOURCES = salted
    key = lambda r: (str(r.row.doc_id), r.size, r.copies, r.target)
    assert sorted(map(key, other)) == sorted(map(key, results["mix"]))


def test_exact_groups(spark, results):
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in results["exact"])
    assert got == sorted([
        # 2 has one more character; a null id loses the tie with 1 but 2 is longer anyway
        ("1", "2", 3, False), ("2", "2", 3, True), ("None", "2", 3, False),
        ("3", "5", 3, False), ("4", "5", 3, False), ("5", "5", 3, True),
        ("6", "6", 2, True), ("6", "6", 2, False), ("7", "7", 1, True), ("8", "8", 1, True),
        ("9", "9", 2, True), ("10", "9", 2, False)])
    assert sorted(str(r.doc_id) for r in results["unique"]) == sorted("2 5 6 7 8 9".split())
    ranges = exact_dedup.exact_groups(frame(spark), max_cells=64).collect()  # several filters
    assert sorted(map(str, ranges)) == sorted(map(str, results["exact"]))


def test_bloom_filter_lets_no_repeat_through(spark):
    hashed = spark.range(20_000).select(F.xxhash64(F.col("id") % 15_000).alias("bloom_hash"))
    flagged = exact_dedup.flag_repeated(hashed, max_cells=1 << 16).groupBy("bloom_hash").agg(
        F.count(F.lit(1)).alias("n"), F.max("bloom_repeated").alias("hi"), F.min("bloom_repeated").alias("lo"))
    assert flagged.filter("n > 1 AND NOT lo").count() == 0
    assert flagged.filter("n = 1 AND hi").count() < 0.05 * 10_000


def test_one_bloom_filter_at_a_time(spark, monkeypatch):
    built, alive, build = [], [], exact_dedup.filter_bits

    def counted(*args):
        alive.append(sum(b._jbroadcast.isValid() for b in built))
        built.append(build(*args))
        return built[-1]

    monkeypatch.setattr(exact_dedup, "filter_bits", counted)
    hashed = spark.range(9_000).select("id", F.xxhash64(F.col("id") % 6_000).alias("bloom_hash"))
    flagged = exact_dedup.flag_repeated(hashed, max_cells=1 << 15)
    assert alive == [0] * 5 and not any(b._jbroadcast.isValid() for b in built)
    got = {r.id: r.bloom_repeated for r in flagged.collect()}
    assert len(got) == 9_000 and all(got[i] for i in got if i % 6_000 < 3_000)
    assert sum(got[i] for i in range(3_000, 6_000)) < 150


def test_near_groups(results):
    got = {str(r.doc_id): (r.n_shingles, r.component_id, r.kept) for r in results["near"]}
    assert got["1"] == (3, 1, True) and got["2"] == (3, 1, False) and got["None"] == (3, 1, False)
    for i in (3, 4, 5):  # nothing to compare: alone
        assert got[str(i)] == (0, i, True)
    assert got["6"][1:] == (6, True) and got["7"] == (1, 7, True) and got["8"] == (1, 8, True)
    assert got["9"] == (1, 9, True) and got["10"] == (1, 9, False)
    assert sorted(str(r.doc_id) for r in results["distinct"]) == sorted("1 3 4 5 6 6 7 8 9".split())


def test_near_groups_through_points_of_a_star(spark):
    """Chains: each text is close to the next one only."""
    base = [f"t{k}" for k in range(100)]
    rows = [(k, " ".join(f"n{j}" if j < 2 * k else w for j, w in enumerate(base)), "s") for k in range(12)]
    rows += [(100 + k, " ".join(f"n{j}" if j >= 100 - 3 * k else w for j, w in enumerate(base)), "s") for k in range(12)]
    got = {r.doc_id: r.component_id for r in minhash.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got.values()) == {0}


def test_large_bucket_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    base = [f"t{k}" for k in range(80)]
    rows = [(k, " ".join(w if j != 2 * k else f"e{k}" for j, w in enumerate(base)), "s") for k in range(40)]
    got = {r.doc_id: r.component_id for r in minhash.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got.values()) == {0}


def test_repeated_substrings(results):
    got = {str(r.row.doc_id): r for r in results["cut"]}
    assert got["7"].n_removed == 5000 and [tuple(x) for x in got["7"].spans] == [(0, 5000)]
    assert got["8"].n_removed == 5000 and bytes(got["8"].kept) == b" y"
    assert got["6"].n_removed == got["6"].n_bytes == len(LONG)
    assert got["3"].n_bytes == 0 and bytes(got["3"].kept) == b"" and got["1"].n_removed == 0


def test_substrings_of_long_texts_in_pieces(spark, monkeypatch):
    """Texts longer than a block are worked on in pieces; repeats may lie across them."""
    import random
    r = random.Random(5)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    shared = noise(700)
    texts = [noise(3_000) + shared + noise(2_500), shared[100:650] + noise(900), noise(300), shared[:199], noise(150) + shared[300:500]]
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    want = {}
    for k, t in enumerate(texts):
        mark = [False] * len(t)
        for p in range(len(t) - 199):
            if sum(u.count(t[p:p + 200]) for u in texts) > 1:
                mark[p:p + 200] = [True] * 200
        want[k] = "".join(c for c, m in zip(t, mark, strict=True) if not m)
    monkeypatch.setattr(substring_dedup, "BLOCK", 1000)
    import pyarrow as pa
    found = list(substring_dedup.find_samples([pa.RecordBatch.from_pydict({
        "uid": pa.array(range(len(texts)), pa.int64()), "text": texts})]))
    assert sum(len(b) for b in found)
    got = {x.row.doc_id: bytes(x.kept).decode() for x in substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_bpe(results):
    got = {str(r.doc_id): r for r in results["tokens"]}
    nothing = hashlib.sha256(b"").hexdigest()
    assert (got["3"].n_tokens, got["3"].ids_sha256, got["3"].decoded_sha256) == (0, nothing, nothing)
    assert got["6"].decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()


def test_bpe_like_the_library():
    import random
    import struct

    import tiktoken
    ranks = bpe.read_ranks(BPE[0])
    own = tiktoken.Encoding("own", pat_str=BPE[1], mergeable_ranks=ranks, special_tokens={})
    encoder, decoder = bpe.Encoder(ranks, BPE[1]), bpe.Decoder(ranks)
    r = random.Random(11)
    texts = ["", RUN, " " * 3000, "\n\n  a   b \t c  ", "don't they'll", "<|endoftext|>", "\x85a \xa0b c", "🙂" * 400]
    texts += ["".join(r.choice("abcdeéñ漢 '\n\t12.,!T") for _ in range(r.randint(0, 80))) for _ in range(3000)]
    for text, packed in zip(texts, encoder.encode_all(texts), strict=True):
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == own.encode_ordinary(text)
        assert decoder.text(packed, at_once=2) == text


def test_bpe_with_small_caches(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    monkeypatch.setattr(bpe, "MAX_STATES", 20)
    monkeypatch.setattr(bpe, "CHARS_AT_ONCE", 30)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 3)
    ranks = bpe.read_ranks(BPE[0])
    encoder, decoder = bpe.Encoder(ranks, BPE[1]), bpe.Decoder(ranks)
    texts = [f"some words number {k} and a longer tail that is cut up {'z' * k}" for k in range(40)] * 2
    assert [decoder.text(p, 3) for p in encoder.encode_all(texts)] == texts


def test_idle_codecs_are_let_go(monkeypatch):
    import time
    monkeypatch.setattr(bpe, "IDLE_SECONDS", 0.2)
    bpe._LOADED.clear()
    encoder, _ = bpe.loaded(*BPE)
    time.sleep(2.5)
    assert not bpe._LOADED and len(encoder.encode("still usable")) == 4 * 2
    assert bpe.loaded(*BPE)[0] is not encoder


def test_utf8_stream_cut_anywhere():
    data = "aé漢🙂z".encode() + b"\xff\xe2\x82" + "ü".encode() + b"\xf0\x9f"
    for cut in range(1, 5):
        stream = bpe.Utf8Stream()
        text = "".join(stream.feed(data[k:k + cut]) for k in range(0, len(data), cut)) + stream.end()
        assert text == data.decode("utf-8", "replace")


def test_decoded_hash_is_of_streamed_characters(monkeypatch):
    fed, feed = [], bpe.Utf8Stream.feed
    monkeypatch.setattr(bpe.Utf8Stream, "feed", lambda self, chunk: fed.append(len(chunk)) or feed(self, chunk))
    runs = []

    class Docs:  # stands for the frame: its function runs in this process
        sparkSession, schema = None, {"doc_id": type("Field", (), {"dataType": LongType()})}
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: runs.append(run)

    monkeypatch.setattr(bpe, "ship_package", lambda _: None)
    bpe.encode_documents(Docs(), *BPE)
    texts = ["é漢字🙂 ok " * 9, None, "a"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3], pa.int64()), "text": texts})
    (out,) = runs[0](iter([batch]))
    assert out.column("decoded_sha256").to_pylist() == [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
    assert sum(fed) == sum(len((t or "").encode()) for t in texts)


def test_ids_decode_to_the_text(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    ids = bpe.encode_documents(docs, *BPE, with_ids=True)
    got = sorted((str(r.doc_id), r.text) for r in bpe.decode_documents(ids, *BPE).collect())
    assert got == sorted((str(i), t or "") for i, t, _ in DOCS)


def test_classifier_without_labels(spark):
    assert {r.score for r in qda.classify(frame(spark), labels(spark, [])).collect()} == {0.5}


def test_classifier_reads_the_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    a = {r.doc_id: r.score for r in qda.classify(docs, known).collect()}
    b = {r.doc_id: r.score for r in qda.classify(docs.withColumn("source", F.lit("z")).drop("lang"), known).collect()}
    assert a == b


def test_quality_rules(results):
    got = {str(r.doc_id): r for r in results["quality"]}
    assert (got["3"].n_words, got["3"].word_chars, got["3"].base_failed, got["3"].kept, got["3"].score) == (0, 0, True, False, None)
    assert got["6"].n_words == 60_000 and got["6"].n_repeat_words == 60_000 and got["6"].base_failed
    assert got["9"].word_chars == 6


def test_quality_base_rules(spark):
    eight = "a b c d e f g h"
    text = f"# x\n{eight} i {eight}\n \n# x\nq|r"
    r = quality_rules.quality(spark.createDataFrame([(1, text, "s")], SCHEMA), labels(spark)).first()
    assert (r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (22, 3, 1, 16)


PAGES = [(1, "http://a", "p" * 1200), (2, "http://b\r\nX: y", "p" * 1200), (3, None, "p" * 999), (4, "u", "p" * 999),
         (5, "u", None), (6, "u", ""), (7, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 40),
         (None, "u", "p" * 1200), (8, "u", "é" * 700), (9, "u", "é" * 700), (9, "u", "é" * 700)]


def test_warc(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    got = sorted(map(tuple, warc.archive_round_trip(pages).collect()), key=str)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    to = {1: 2, 8: 9, None: 2}
    want = [(i, len((t or "").encode()), sha(t), "revisit" if i in to else "response", to.get(i)) for i, _, t in PAGES]
    assert got == sorted(want, key=str)
    assert warc.archive_round_trip(pages.limit(0)).collect() == []


def test_warc_filters_are_pushed_and_stretches_agree(spark, tmp_path):
    pages = spark.createDataFrame(PAGES * 3, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, str(tmp_path / "w"))
    df = warc.read_archives(spark, str(tmp_path / "w")).filter("record_type = 'revisit' AND payload_bytes > 1300")
    assert "Filter (" not in df._jdf.queryExecution().executedPlan().treeString()
    assert " Filter " not in df._jdf.queryExecution().executedPlan().treeString()
    assert df.count() == 3 and {r.payload for r in df.collect()} == {None}
    whole = sorted(map(str, warc.read_archives(spark, str(tmp_path / "w")).collect()))
    cut = spark.read.format("warc").option("stretch", 700).load(str(tmp_path / "w")).collect()
    assert sorted(map(str, cut)) == whole


TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"),
         (3, 1, "assistant", "yes"), (3, 2, "user", "more <|im_end|>"), (4, 0, "user", None), (5, 0, "user", ""),
         (6, 0, None, "user"), (7, None, "user", "z"), (7, 0, "user", "a"), (None, 0, "user", "lost"),
         (8, 0, "user", "hi"), (8, 0, "user", "hi"), (9, 0, "user", "hi"), (9, 1, "assistant", "yes"),
         (9, 2, "user", "more <|im_end|>")]


def test_chat(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(0))
    got = {r.conv_id: r for r in chat.format_conversations(turns).collect()}
    assert {c for c, r in got.items() if r.kept} == {3, 4, 5, 6, 7, 8, None}
    assert got[9].copy_of == 3 and got[2].chat is None and got[1].n_turns == 2
    assert got[3].chat.endswith("<|im_start|>user\nmore < |im_end|><|im_end|>\n")
    assert got[7].chat == "<|im_start|>user\na<|im_end|>\n<|im_start|>user\nz<|im_end|>\n"
    assert got[8].n_turns == 2  # equal rows are turns of their own


def test_chat_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)
    rows = [(c, k, "user", f"t{k}") for c, n in ((1, 10), (2, 7), (3, 10), (4, 3)) for k in range(n)]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.conv_id, r.part) for r in got if r.kept) == [(1, 0), (1, 1), (1, 2), (1, 3)]
    text = "".join(r.chat for r in sorted((r for r in got if r.kept), key=lambda r: r.part))
    assert text == "".join(f"<|im_start|>user\nt{k}<|im_end|>\n" for k in range(10))


def test_licenses(spark):
    mit = licenses.TEMPLATES[1][1]
    texts = [(1, "Intro.\n" + mit.replace("sublicense, ", "")), (2, "Released under the MIT Licence."),
             (3, "We talk about a license to drive and nothing else here at all."), (4, None),
             (5, mit[:150] + "\n" + mit[150:]), (6, "Some words before. Licensed under CC BY 4.0. And after it many more words follow.")]
    got = licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    by = {(r.doc_id, r.license): r for r in got}
    assert by[1, "MIT"].missing == ["sublicense"] and by[1, "MIT"].added == []
    assert (by[2, "MIT"].missing, by[2, "MIT"].added) == (["license"], ["licence"])
    assert by[5, "MIT"].missing == [] and (by[5, "MIT"].first_line, by[5, "MIT"].last_line) == (0, 1)
    assert by[6, "CC-BY-4.0"].missing == [] and {r.doc_id for r in got} == {1, 2, 5, 6}



APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\");\n"
          "you may not use this file except in compliance with the License.\n"
          "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n")


def test_license_in_a_longer_paragraph():
    scanner, many = licenses.Scanner(), "Words that say nothing at all. " * 300
    for text, lines in ((APACHE, (0, 1)), ("\n".join(f"# {x}" for x in APACHE.split("\n")), (0, 1)),
                        ("Copyright 2020 Someone\n" + APACHE.replace("\n\n", "\n *\n"), (1, 2)),
                        (many + "\n" + many + "\n" + APACHE + many, (2, 3)),
                        (many + APACHE.replace("\n", " ") + many, (0, 0))):
        (hit,) = scanner.scan(text)
        assert (hit["license"], hit["missing"], hit["added"]) == ("Apache-2.0", [], [])
        assert (hit["first_line"], hit["last_line"]) == lines
    mit = licenses.TEMPLATES[1][1].split()
    wrapped = "\n".join(" * " + " ".join(mit[k:k + 9]) for k in range(0, len(mit), 9))
    hits = scanner.scan(many + "\n" + wrapped + "\n * " + many + "\nAll rights\nreserved.")
    assert [(h["license"], h["missing"], h["added"]) for h in hits] == [("MIT", [], []), ("all-rights-reserved", [], [])]



def test_license_names_are_not_swapped():
    scanner = licenses.Scanner()
    gpl2 = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
            "option) any later version.")
    two = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright "
           "notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must "
           "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
           "documentation and/or other materials provided with the distribution.\n")
    three = two + ("\n3. Neither the name of Example Org nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission.\n")
    gpl3 = "This work is licensed under the GNU General Public License, version 3"
    for text, want in (
            ("Released under the BSD License.", ["BSD"]), ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]),
            (gpl3.replace("3", "2") + ".", ["GPL-2.0-only"]), (gpl2, ["GPL-2.0-or-later"]), (two, ["BSD-2-Clause"]),
            (three, ["BSD-3-Clause"]), (gpl3 + ", or any later version.", ["GPL-3.0-or-later"]),
            (gpl3.replace("General", "Lesser General"), ["LGPL-3.0-only"]), ("Licensed under GPLv3+", ["GPL-3.0-or-later"]),
            ("Licensed under the Foo License, Version 2.0.", []), ("Released under the Foo License.", []),
            ("This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License.",
             ["CC-BY-NC-4.0"]),
            ("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0+", ["MIT", "Apache-2.0", "GPL-2.0-or-later"])):
        assert [h["license"] for h in scanner.scan(text)] == want, text


def test_each_template_is_found_as_itself():
    scanner = licenses.Scanner()
    for name, text, *_ in licenses.TEMPLATES:
        hits = scanner.scan(f"Words before.\n{text}\nWords after.")
        assert [(h["license"], h["missing"], h["added"]) for h in hits] == [(name, [], [])], text


def test_word_hashes_over_blocks(monkeypatch):
    import pyarrow as pa
    texts = ["Aa bb\tcc", "", None, "x" * 50 + " y " + "z" * 70, " lead", "é漢 ok " * 30]
    want = [len((t or "").split()) for t in texts]
    whole, at = textbytes.word_hashes(pa.array(texts))
    assert list(at[1:] - at[:-1]) == want
    monkeypatch.setattr(textbytes, "BLOCK", 16)
    cut, at = textbytes.word_hashes(pa.array(texts))
    assert list(at[1:] - at[:-1]) == want and (cut == whole).all()
