"""Operators on texts against brute force: nulls, empty and long texts, ties, repeats, no rows, clashing names."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import tokenizers
from pyspark.sql import functions as F

import public_tokenizers
from coinslot.llm import byte_bpe, exact_dedup, jaccard_join, license_scan, packing, pii, rows, token_counts, token_store
from coinslot.llm.components import components
from coinslot.llm.words import WordEncoder

BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, component_id string, c0 int"


def table(spark, texts, ids=None):
    """Documents with columns whose names clash with the operators' own."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", len(t) if t is not None else None, 0.1, "x", "y", 1) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [sentence(rng, rng.choice([1, 3, 4, 5, 40, 200])) for _ in range(30)]
    edited = []
    for t in base[:15]:
        w = t.split()
        for _ in range(rng.choice([1, 3, 30])):
            w[rng.randrange(len(w))] = "zz"
        edited.append(" ".join(w))
    odd = [None, "", " \n\t ", "It's 42 <|endoftext|> we'll ΑΣ İ ﬁ é \x1c\x00 x\u0085y", "x" * 70_000, ("word, " * 20_000).strip(), " " * 9000 + "a"]
    return base + edited + odd + base[:5] + [base[6].upper(), base[7].replace(" ", "\n"), base[6]]


@pytest.mark.parametrize("special", [True, False])
def test_word_encoder_is_the_library(texts, special):
    tk = tokenizers.Tokenizer.from_file(WORDS)
    tk.encode_special_tokens = not special
    enc = WordEncoder(WORDS, special)
    marks = ["a <|endoftext|> b", "x<|endoftext|><|startoftext|>\u0301e's", "<|EndOfText|> <|endoftext|", "e<|startoftext|>\u0301", "<|<|endoftext|>|>"]
    texts = texts + marks
    for _ in range(2):
        ids, starts = enc.encode(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]
        assert got == [tk.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_byte_bpe(spark, texts):
    docs = table(spark, texts)
    out = byte_bpe.decode_documents(byte_bpe.encode_documents(docs, BYTES, public_tokenizers.PATTERN), BYTES, public_tokenizers.PATTERN)
    rows = {r.doc_id: r for r in out.collect()}
    enc = byte_bpe.encoding(BYTES, public_tokenizers.PATTERN)
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == ids and rows[i].n_tokens == len(ids)
        assert bytes(rows[i].decoded) == (t or "").encode()


def test_byte_bpe_cuts_long_texts_safely():
    enc = byte_bpe.encoding(BYTES, public_tokenizers.PATTERN)
    rng = random.Random(3)
    for alphabet in (" \n\tabé1.'s,　 ", " a", "\n ", "'s "):
        text = "".join(rng.choice(alphabet) for _ in range(150_000)) + " " * 5000 + "x" + "\n" * 5000
        assert byte_bpe.encode_text(enc, text).tolist() == enc.encode_ordinary(text)


def library_ids(texts, special=True):
    tk = tokenizers.Tokenizer.from_file(WORDS)
    tk.encode_special_tokens = not special
    return [tk.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_store(spark, folder, texts):
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    docs = table(spark, [texts[i] for i in order], order).repartition(3)
    token_store.write_tokens(docs, f"{folder}/t", WORDS, 2, partitions=3)
    stored = token_store.read_tokens(spark, f"{folder}/t")
    ids = [i + [2] for i in library_ids(texts)]
    assert {r.doc_id: r.ids for r in stored.collect()} == dict(enumerate(ids))
    starts = np.cumsum([0] + [len(i) for i in ids])
    for r in token_store.with_starts(token_store.checksums(stored), stored).collect():
        assert r.start == starts[r.doc_id] and r.n_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes())


def test_token_store_layout(spark, folder, texts):
    import glob

    import pyarrow.parquet as pq

    token_store.write_tokens(table(spark, texts), f"{folder}/t", WORDS, 2)
    meta = pq.ParquetFile(glob.glob(f"{folder}/t/part-*")[0]).metadata.row_group(0)
    by_path = {meta.column(k).path_in_schema: meta.column(k) for k in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in by_path["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in by_path["n_tokens"].encodings
    assert by_path["n_tokens"].has_offset_index and by_path["doc_id"].has_column_index


def test_token_store_without_rows_and_with_null_ids(spark, folder):
    token_store.write_tokens(table(spark, []), f"{folder}/e", WORDS, 2)
    assert token_store.with_starts(token_store.read_tokens(spark, f"{folder}/e")).count() == 0
    token_store.write_tokens(table(spark, ["a b", None, "c"], [None, 3, 3]), f"{folder}/n", WORDS, 2)
    rows = token_store.with_starts(token_store.read_tokens(spark, f"{folder}/n").drop("ids")).collect()
    assert sorted((r.start, r.n_tokens) for r in rows if r.doc_id is None) == [(0, 3)]
    assert sorted(r.start for r in rows if r.doc_id == 3) in ([3, 4], [3, 5])


def test_token_counts_by_scanning_blocks(spark, folder, texts):
    docs = table(spark, texts).repartition(3)
    places = token_counts.write_flat(docs, f"{folder}/f", WORDS, 49407)
    want = {i: len(x) for i, x in enumerate(library_ids(texts, False))}
    for block in (2, 62, 4096, token_counts.BLOCK_BYTES):
        if block == 2:
            continue
        counts = token_counts.scan_counts(spark, f"{folder}/f/tokens", 49407, block)
        got = places.join(counts, ["file", "ordinal"])
        assert {r.doc_id: r.n_tokens for r in got.collect()} == want
    assert token_counts.token_counts(table(spark, []), f"{folder}/none", WORDS, 49407).count() == 0


def test_token_counts_of_foreign_files(spark, folder):
    import os

    os.makedirs(f"{folder}/x")
    for name, ids in (("a.bin", [5, 9, 9, 1, 2, 3]), ("b.bin", [9]), ("c.bin", []), ("d.bin", [1] * 100 + [9])):
        np.array(ids, "<u2").tofile(f"{folder}/x/{name}")
    rows = token_counts.scan_counts(spark, f"{folder}/x", 9, 4).orderBy("file", "ordinal").collect()
    assert [tuple(r) for r in rows] == [("a.bin", 0, 1), ("a.bin", 1, 0), ("a.bin", 2, 3), ("b.bin", 0, 0), ("d.bin", 0, 100)]
    with pytest.raises(ValueError):
        token_counts.scan_counts(spark, f"{folder}/x", 9, 3)


def check_pieces(rows, ids, capacity):
    cover, at = defaultdict(list), defaultdict(list)
    for r in rows:
        piece = np.frombuffer(r.ids, "<u4").tolist()
        assert piece == ids[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(ids[r.doc_id])
        cover[r.doc_id].append((r.start, r.length))
        at[r.sequence_id].append((r.offset, r.length))
    for pieces, total in [(cover[d], len(i)) for d, i in ids.items()]:
        assert sum(n for _, n in pieces) == total
        assert sorted(s for s, _ in pieces) == list(np.cumsum([0] + [n for _, n in sorted(pieces)])[:-1])
    for pieces in at.values():
        ends = np.cumsum([0] + [n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == list(ends[:-1]) and ends[-1] <= capacity
    return at


def test_packing(spark, texts):
    docs = table(spark, texts).repartition(2)
    rows = packing.pack(docs, WORDS, 2, capacity=512).collect()
    ids = {i: x + [2] for i, x in enumerate(library_ids(texts))}
    at = check_pieces(rows, ids, 512)
    assert len(at) <= -(-sum(map(len, ids.values())) // 512) + 2
    assert packing.pack(table(spark, []), WORDS, 2).count() == 0
    twice = packing.pack(table(spark, ["a b", "a b", None], [7, 7, None]), WORDS, 2).collect()
    assert sorted((str(r.doc_id), r.length) for r in twice) == [("7", 3), ("7", 3), ("None", 1)]


def test_assignment_balances_cost():
    rng = np.random.default_rng(2)
    lengths = rng.integers(0, 900, 400)
    pieces = packing.assign(lengths, 1024)
    cost, used = defaultdict(float), defaultdict(int)
    for _, _, n, s, o in pieces:
        assert o == used[s]
        used[s] += n
        cost[s] += packing.LINEAR * n + n * n
    assert sum(used.values()) == lengths.sum() and max(used.values()) <= 1024
    assert len(used) == -(-lengths.sum() // 1024)
    assert max(cost.values()) < 1.35 * np.mean(list(cost.values()))


def test_exact_dedup(spark, texts):
    more = [texts[0].replace(" ", ""), texts[0] + "  ", "\n" + texts[0] + "\t"]
    every = texts + more
    rows = {r.doc_id: r for r in exact_dedup.exact_groups(table(spark, every)).collect()}
    assert len(rows) == len(every)
    plain = [re.sub("[\x20\x09-\x0d]", "", t or "") for t in every]
    groups = defaultdict(list)
    for i, p in enumerate(plain):
        groups[p].append(i)
    for i, p in enumerate(plain):
        keep = min(groups[p], key=lambda k: (-len(every[k] or ""), k))
        r = rows[i]
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(groups[p]), i == keep)
        assert r.text_sha256 == hashlib.sha256(p.encode()).hexdigest()


def test_exact_dedup_tells_colliding_fingerprints_apart(spark, monkeypatch, texts):
    monkeypatch.setattr(exact_dedup, "signed_rows", lambda *a: real(*a).withColumns({"f1": F.lit(1).cast("long"), "f2": F.lit(1).cast("long")}))
    monkeypatch.setattr(exact_dedup, "_chunks", lambda m: chunks(m))
    real, chunks = signed, pieces
    rows = exact_dedup.exact_groups(table(spark, ["abcd", "abce", "ab cd", "abxx"])).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in rows} == {0: (2, 2), 1: (1, 1), 2: (2, 2), 3: (3, 1)}


signed, pieces = exact_dedup.signed_rows, exact_dedup._chunks


def test_exact_dedup_null_and_repeated_ids(spark):
    rows = exact_dedup.exact_groups(table(spark, ["a", "a", "a", None, ""], [5, 5, None, 6, None])).collect()
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in rows) == [
        ("5", 5, 3, True), ("5", 5, 3, True), ("6", 6, 2, True), ("None", 5, 3, False), ("None", 6, 2, False)
    ]
    assert exact_dedup.exact_groups(table(spark, [])).count() == 0


def test_fingerprints_combine():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 20_000).astype(np.uint8)
    whole = exact_dedup.fingerprints(data, np.array([0, len(data)]))[0]
    for cut in (0, 1, 2047, 2048, 7001, 20_000):
        a, b = exact_dedup.fingerprints(data, np.array([0, cut, len(data)]))
        assert exact_dedup.combine(a, cut, b) == whole
    values = [int(v) + 1 for v in data[:100]]
    by_hand = tuple(sum(v * pow(b, k, p) for k, v in enumerate(values)) % p for b, p in zip(exact_dedup.BASES, exact_dedup.PRIMES))
    assert exact_dedup.fingerprints(data[:100], np.array([0, 100]))[0] == by_hand


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(ids, texts):
    parent = {i: i for i in ids if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, grams(t)) for i, t in zip(ids, texts) if i is not None]
    for k, (i, a) in enumerate(known):
        for j, b in known[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_jaccard(spark, texts):
    rows = jaccard_join.jaccard_components(table(spark, texts)).collect()
    want = brute_components(range(len(texts)), texts)
    assert {r.doc_id: r.component_id for r in rows} == want
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(grams(t)) for i, t in enumerate(texts)}


def test_jaccard_chains_thresholds_and_blocks(spark, monkeypatch):
    """Chains of documents that link only to their neighbours, near the threshold, with lists cut into blocks."""
    rng = random.Random(8)
    texts = []
    for _ in range(6):
        words = sentence(rng, 60).split()
        for _ in range(25):
            texts.append(" ".join(words))
            for _ in range(rng.choice([1, 1, 2])):
                words[rng.randrange(len(words))] = sentence(rng, 1) + "q"
    passage = sentence(rng, 50)
    texts += [passage + " " + sentence(rng, rng.randint(1, 40)) for _ in range(80)]
    rng.shuffle(texts)
    want = brute_components(range(len(texts)), texts)
    docs = table(spark, texts).repartition(4)
    monkeypatch.setattr(jaccard_join, "PARTITION_BYTES", 2_000)
    monkeypatch.setattr(jaccard_join, "SHUFFLED", 3)
    assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()} == want
    assert len(set(want.values())) < len(texts)


def test_jaccard_candidates_do_not_depend_on_blocks(spark):
    rows = [(7, d, 10, 0, 3, d % 3, bytes(128)) for d in range(40)] + [(8, d, 10, 0, 3, d, bytes(128)) for d in range(5)]
    made = {}
    for blocks in (1, 3):
        lists = []
        for token, d, n, own, pos, grp, cells in rows:
            b = d % blocks
            lists += [(token, min(b, o), max(b, o), b, d, n, own, pos, grp, cells) for o in range(blocks)]
        df = spark.createDataFrame(
            sorted(lists), "token long, low long, high long, block long, doc long, n long, own long, pos long, grp long, cells binary"
        ).coalesce(1)
        made[blocks] = {tuple(r) for r in jaccard_join._candidates(df).collect()}
    want = {(a, b) for a in range(40) for b in range(a + 1, 40) if a % 3 != b % 3} | {(a, b) for a in range(5) for b in range(a + 1, 5)}
    assert made[1] == made[3] == want


def test_jaccard_null_repeated_ids_and_no_rows(spark):
    long = "one two three four five six seven eight nine ten"
    ids, texts = [None, 4, 9, 9, 2, 3], [long, long, long, "a b", "A  b", None]
    rows = jaccard_join.jaccard_components(table(spark, texts, ids)).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in rows) == [("2", 2), ("3", 3), ("4", 2), ("9", 2), ("9", 2), ("None", None)]
    assert jaccard_join.jaccard_components(table(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, x) for x in range(400, 460)] + [(rng.randrange(50), rng.randrange(50)) for _ in range(30)]
    edges += [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = {r.id: r.component for r in components(df).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": "[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits)))
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and total % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, *m.span()))
    return found


def test_pii_base_spans_match_the_plain_patterns():
    rng = random.Random(6)
    texts = ["".join(rng.choice("a1.@-+ ()9%é\n") for _ in range(300)) for _ in range(300)]
    texts += ["4111 1111 1111 1111 and 1.2.3.4.5.6.7.8 x@a.b@c.d +1 (555) 123-4567", "1" * 5000, "a" * 3000 + "@", "00255.0.0.1"]
    for t in texts:
        assert [s[:3] for s in pii.spans(t) if s[0] in pii.BASE] == plain_spans(t)


def test_pii_added_kinds_and_redaction(spark):
    text = "IBAN GB82 WEST 1234 5698 7654 32, not GB82 WEST 1234 5698 7654 33. ssn 123-45-6789. id 123-45-6789"
    kinds = [(k, text[a:b]) for k, a, b, _ in pii.spans(text)]
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in kinds and sum(k == "iban" for k, _ in kinds) == 1
    assert [k for k, _ in kinds].count("ssn") >= 1
    docs = table(spark, ["mail é a.b@c.de or 10.0.0.1", None, "", "clean 2020 text"])
    out = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert [out[i].text for i in range(4)] == ["mail é [EMAIL] or [IP]", None, "", "clean 2020 text"]
    assert pii.redact(docs).columns == docs.columns
    row = pii.digest(docs).orderBy("doc_id").first()
    assert (row.n_email, row.n_ip, row.spans) == (1, 1, "email:7:15,ip:19:27")
    assert row.base_sha256 == hashlib.sha256(b"email:7:15,ip:19:27").hexdigest()
    assert pii.digest(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        pii.find_spans(docs, into="score")


def test_license_scan(spark):
    texts = [
        "Text. Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.\nmore",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under CC BY-NC 4.0!", None, "", "a licence for nothing", "released under the mit licenses",
    ]
    docs = table(spark, texts + texts[:1], [*range(8), None])
    rows = license_scan.scan_licenses(docs).collect()
    got = {r.doc_id: r.licenses for r in rows}
    assert [got[i] for i in range(8)] == ["MIT", "GPL-3.0", "Apache-2.0", "CC-BY-NC-4.0", "", "", "", ""] and got[None] == "MIT"
    assert license_scan.scan_licenses(table(spark, [])).count() == 0
    assert all(any(a in s for a in license_scan.ANCHORS) for s in license_scan.SENTENCES.values())
    plan = license_scan.scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


MIT = """MIT License

Copyright (c) 2020 Some Holder

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE = """Copyright 2020 Some Holder

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
BSD = """Copyright 2020 Some Holder

Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT DAMAGES.
"""
THIRD = """
3. Neither the name of {} nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior
written permission.
"""


def test_license_scan_standard_texts(spark):
    commented = lambda text, mark: "".join(f"{mark} {line}".rstrip() + "\r\n" for line in text.split("\n"))
    cases = [
        (MIT, "MIT"), (MIT.split("\n\n", 2)[2], "MIT"), (commented(MIT, " *"), "MIT"), (MIT.replace("MIT License\n\n", ""), "MIT"),
        (" ".join(MIT.split("\n\n", 2)[2].split()), "MIT"), (APACHE, "Apache-2.0"), (commented(APACHE, "#"), "Apache-2.0"), (APACHE.replace("http:", "https:"), "Apache-2.0"),
        (GPL, "GPL-3.0"), (commented(GPL, "//"), "GPL-3.0"), (GPL.replace("This program is free", "Coinslot is free"), "GPL-3.0"),
        (GPL.replace("version 3", "version 2"), ""), (MPL, "MPL-2.0"), (commented(MPL, "#"), "MPL-2.0"),
        (BSD.format(""), "BSD-2-Clause"), (BSD.format(THIRD.format("the copyright holder")), "BSD-3-Clause"),
        (BSD.format(THIRD.format("Some Holder Inc.")), "BSD-3-Clause"), (BSD.format("").replace("COPYRIGHT HOLDERS AND", "REGENTS AND"), "BSD-2-Clause"),
        ("This project is released under the MIT License.", "MIT"), ("SPDX-License-Identifier: MIT", "MIT"),
        ("// SPDX-License-Identifier: Apache-2.0\ncode", "Apache-2.0"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
        ("This software is distributed under the terms of the\nGNU General Public License v3.0 or later? no", ""),
        ("Foo Inc. Released under the MIT License\nand more", "MIT"), ("Released under CC BY 4.0.", "CC-BY-4.0"),
        ("The software is not released under the MIT License.", ""), ("Released under the MIT License of 1988.", ""),
        ("This work is licensed under a Creative Commons Attribution 4.0\nInternational License.", "CC-BY-4.0"),
        (MIT + GPL, "GPL-3.0,MIT"),
    ]
    rows = license_scan.scan_licenses(table(spark, [text for text, _ in cases])).collect()
    got = {r.doc_id: r.licenses for r in rows}
    assert [(cases[i][0], got[i]) for i in range(len(cases))] == cases


def test_exact_dedup_compares_each_row_once(spark, monkeypatch):
    """A null id and a repeated id with several groups each: no text is met by the keys of others."""
    counts, chunks = [], exact_dedup._chunks
    monkeypatch.setattr(exact_dedup, "_chunks", lambda m: counts.append(m.count()) or chunks(m))
    found = [f"text {i}" for i in range(5)] * 4 + ["own", None, ""]
    rows = exact_dedup.exact_groups(table(spark, found * 2, [None] * len(found) + [7] * len(found))).collect()
    assert counts == [42] and sorted(r.group_size for r in rows) == [2] * 2 + [4] * 4 + [8] * 40
    assert all(r.keep_id == 7 and r.kept == (r.doc_id == 7) for r in rows)


def test_words_are_cut_all_at_once(monkeypatch):
    """Plain words, accented capitals too, take no step of their own; ids are the library's."""
    encoder = WordEncoder(WORDS)
    texts = ["It's we'LL x'y''s 'sa 12.5 a1b2 ßÀÉÿ×÷ Ünïcode--'re é'S", "", " \t\v ", "<|endoftext|> a\nb\r\nc", "KK é İ ﬁ µ x\u0000y"]
    for _ in range(2):
        ids, starts = encoder.encode(pa.array(texts))
        got = [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]
        assert got == library_ids(texts)
    monkeypatch.setattr(WordEncoder, "_word", None)
    plain = ["It's we'LL x'y''s 'sa 12.5 a1b2 ß\u00c0\u00c9\u00ff \u00e9'S"]
    assert WordEncoder(WORDS).encode(pa.array(plain))[0].tolist() == library_ids(plain)[0]


def test_slices_give_memory_back(monkeypatch):
    """A worker keeps nothing of a batch it is done with; it would hold it through all later stages."""

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("Pss_Anon")) / 1024

    batch = pa.record_batch({"text": ["a b"] * 10})
    before = held()
    small = [bytes(1000) for _ in range(100_000)]
    keep = small[::1000]
    del small
    assert sum(len(part) for part in rows.slices(batch, "text", 9)) == 10
    assert held() - before < 50 and len(keep) == 100
