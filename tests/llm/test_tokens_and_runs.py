"""Merges by proposal, alignment of two tokenizers and periodic runs, against the libraries and brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

import public_tokenizers
from coinslot.llm import greedy_bpe, periodic_runs, queries, token_alignment
from coinslot.session import materialise

MERGES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, ids string, groups string, runs string, chunk string, h int, words string, n_tokens int, score double"
SIGNS = "aabbcdeenrstu  \n\t.,'-_0129éßñÅΩЖ漢字ิ‍  \u0085\x1c\x00😀▁İﬁ"


def table(spark, texts, ids=None):
    """Documents with columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "x", "x", "x", "x", 1, "x", 2, 0.5) for i, t in zip(range(len(texts)) if ids is None else ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["the", "The", "banana", "we'll", "IT'S", "don't've", "internationalisation", "ababababab", "zzzzzzz", "12345", "x1y2", "naïve", "漢字かな", "--==>>", " a"]
    sentences = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    noise = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(1, 80))) for _ in range(400)]
    odd = [
        None, "", " ", "  ", "   a", "a   ", "\n\n a\t", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "a<|endoftext|>'s  <|endoftext|",
        "<s> x </s> <unk> <0x41> ▁▁", "x" * 30_000, "ab" * 20_000, " " * 20_000 + "a", ("word, " * 20_000).strip(), "'" * 999, "́é",
    ]
    return sentences + noise + odd + sentences[:3] + odd[7:9]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_greedy_encoder_is_the_library(spark, texts):
    tk = tokenizers.Tokenizer.from_file(MERGES)
    tk.no_truncation(), tk.no_padding()
    encoded = greedy_bpe.encode_documents(table(spark, texts), MERGES)
    rows = {r.doc_id: r for r in greedy_bpe.decode_documents(encoded, MERGES).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        ids = tk.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == ids, repr(t)[:200]
        assert rows[i].n_tokens == len(ids)
        assert rows[i].decoded == tk.decode(ids, skip_special_tokens=False)


def test_greedy_encoder_merges_only_words_that_fail(monkeypatch):
    calls = []
    merge = greedy_bpe.MergeTable.merge
    monkeypatch.setattr(greedy_bpe.MergeTable, "merge", lambda self, piece: calls.append(piece) or merge(self, piece))
    enc = greedy_bpe.GreedyEncoder(MERGES, True)
    pieces = [p.encode() for p in (" the", " house", " is", " old")]
    ids, starts = enc.table.encode_pieces(pieces)
    assert not calls
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [enc.table.merge(p) for p in pieces]


def test_greedy_pairs_are_tested_rightly():
    """Random pieces over few letters: proposals fail often, and the test of pairs decides like the merges."""
    rng = random.Random(11)
    enc = greedy_bpe.GreedyEncoder(MERGES, True)
    pieces = ["".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 14))).encode() for _ in range(20_000)]
    ids, starts = enc.table.encode_pieces(pieces)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [enc.table.merge(p) for p in pieces]


def test_greedy_encoder_forgets_without_a_change(spark, texts, monkeypatch):
    whole = greedy_bpe.GreedyEncoder(MERGES, True).encode([t or "" for t in texts])
    monkeypatch.setattr(greedy_bpe, "REMEMBERED_BYTES", 50)
    enc = greedy_bpe.GreedyEncoder(MERGES, True)
    parts = [enc.encode([t or ""])[0] for t in texts]
    assert np.array_equal(whole[0], np.concatenate(parts))


def test_greedy_rows_that_repeat_null_ids_and_no_rows(spark):
    docs = table(spark, ["a b", "a b", None], [1, 1, None])
    rows = greedy_bpe.decode_documents(greedy_bpe.encode_documents(docs, MERGES), MERGES).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded) for r in rows) == [("1", 2, "a b"), ("1", 2, "a b"), ("None", 0, "")]
    assert greedy_bpe.decode_documents(greedy_bpe.encode_documents(docs.limit(0), MERGES), MERGES).count() == 0


def aligned_plainly(texts):
    """Rows of op12 by the libraries on whole texts and sets of bytes."""
    tk = tokenizers.Tokenizer.from_file(MERGES)
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = greedy_bpe.byte_letters()
    found, total = [], Counter()
    for t in texts:
        groups, links = [], []
        if t:
            a = tk.encode(" " + t, add_special_tokens=False).ids
            b = sp.encode(t)
            a_bytes = [bytes(letters[c] for c in tk.id_to_token(i)) for i in a]
            b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + t).encode():
                a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
                common = sorted(set(a_ends) & set(b_ends))
                i = j = 0
                for end in common:
                    p, q = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
                    groups.append((a[i:p], b[j:q]))
                    starts_a, starts_b = [0, *a_ends], [0, *b_ends]
                    links += [
                        (a[x], b[y]) for x in range(i, p) for y in range(j, q)
                        if max(starts_a[x], starts_b[y]) < min(a_ends[x], b_ends[y])
                    ]
                    i, j = p, q
            else:
                a = b = []
            total.update(links)
            found.append((len(a), len(b), groups, links))
        else:
            found.append((0, 0, [], []))
    most = Counter()
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    rows = []
    for n_a, n_b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((n_a, n_b, len(groups), len(links), text, sum(total[p] == most[p[1]] for p in links), sum(total[p] for p in links)))
    return rows


@pytest.mark.parametrize("chunk", [token_alignment.CHUNK_BYTES, 300])
def test_alignment(spark, texts, monkeypatch, chunk):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", chunk)
    short = [t for t in texts if t is None or len(t) < 1000] + ["word, " * 2000, "x" * 3000]
    both = token_alignment.Tokens(MERGES, PIECES)
    made = [token_alignment.align_chunk(both, short[i : i + 7])["groups"] for i in range(0, len(short), 7)]
    expected = aligned_plainly(short)
    assert [g for part in made for g in part] == [e[4] for e in expected]
    aligned = materialise(token_alignment.align_documents(table(spark, short), MERGES, PIECES), "aligned")
    rows = {r.doc_id: r for r in token_alignment.score_links(aligned).collect()}
    got = [(r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in (rows[i] for i in range(len(short)))]
    assert got == expected


def test_alignment_piece_encoder_is_the_library(texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids, starts = token_alignment.PieceEncoder(PIECES).encode([f" {t}" if t else "" for t in texts])
    for t, a, b in zip(texts, starts[:-1], starts[1:]):
        if t and sp.decode(sp.encode(t)) == t:
            assert ids[a:b].tolist() == sp.encode(t), repr(t)[:200]


def test_alignment_meets_a_unit_once(texts, monkeypatch):
    """Only what is new in a chunk is encoded and aligned; known units are put together from memory."""
    tokens, aligned = [], token_alignment.irregular
    monkeypatch.setattr(token_alignment, "irregular", lambda a, b: tokens.append(len(a)) or aligned(a, b))
    both = token_alignment.Tokens(MERGES, PIECES)
    first = token_alignment.align_chunk(both, texts)
    assert 0 < sum(tokens) < first["n_a"].sum()
    tokens.clear()
    again = token_alignment.align_chunk(both, texts[::-1])
    assert not tokens
    assert again["groups"] == first["groups"][::-1]
    assert all(np.array_equal(first[c], again[c]) for c in ("keys", "counts"))


@pytest.mark.parametrize("bound", [50, 20_000])
def test_alignment_forgets_without_a_change(texts, monkeypatch, bound):
    parts = [texts[i : i + 20] for i in range(0, len(texts), 20)] * 2
    both = token_alignment.Tokens(MERGES, PIECES)
    expected = [token_alignment.align_chunk(both, part) for part in parts]
    monkeypatch.setattr(token_alignment, "REMEMBERED_BYTES", bound)
    monkeypatch.setattr(token_alignment, "BLOCK", 100)
    both = token_alignment.Tokens(MERGES, PIECES)
    for part, whole in zip(parts, expected):
        got = token_alignment.align_chunk(both, part)
        assert all(np.array_equal(got[c], whole[c]) for c in whole)


def test_alignment_units_have_the_tokens_of_their_text():
    """Cuts next to white space of all kinds, contractions, digits and signs, against the libraries on whole texts."""
    rng = random.Random(12)
    tk = tokenizers.Tokenizer.from_file(MERGES)
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    both = token_alignment.Tokens(MERGES, PIECES)
    plain = [*"aebst  \n\t.,;)'-07éß", "'s", "'re", " 'll", "\n's", "\n\n", "   ", " the", "der "]
    odd = [*"\r\x0b\x0c\x1c\x85\xa0漢字Жñ😀\u3000\x00", "\r\n", ");\r", "<|endoftext|>", "</s>"]
    for k in range(4000):
        text = " " + "".join(rng.choice(plain + odd * (k % 2)) for _ in range(rng.randint(1, 30)))
        found = token_alignment.units(text)
        assert "".join(found) == text
        a = both.a.encode(found, is_pretokenized=True, add_special_tokens=False).ids
        assert a == tk.encode(text, add_special_tokens=False).ids, repr(text)
        assert both.b.encode(found)[0].tolist() == sp.encode(text[1:]), repr(text)


def test_alignment_groups_follow_both_ends():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 80)
        a = np.array(sorted({n, *(k for k in range(1, n) if rng.random() < 0.8)}))
        b = np.array(sorted({n, *(k for k in range(1, n) if rng.random() < rng.choice([0.1, 0.8, 0.99]))}))
        common, expected, i, j = set(a.tolist()) & set(b.tolist()), [], 0, 0
        for end in sorted(common):
            p, q = a.tolist().index(end) + 1, b.tolist().index(end) + 1
            if (p - i, q - j) != (1, 1):
                expected.append([i, p, j, q])
            i, j = p, q
        assert token_alignment.irregular(a, b).tolist() == expected


def test_alignment_rows_that_repeat_null_ids_and_no_rows(spark):
    docs = table(spark, ["a b", "a b", None, "c"], [1, 1, None, None])
    aligned = materialise(token_alignment.align_documents(docs, MERGES, PIECES), "aligned")
    rows = token_alignment.score_links(aligned).collect()
    assert sorted((str(r.doc_id), r.n_links) for r in rows) == [("1", 2), ("1", 2), ("None", 0), ("None", 1)]
    empty = materialise(token_alignment.align_documents(docs.limit(0), MERGES, PIECES), "aligned")
    assert token_alignment.score_links(empty).count() == 0


def runs_plainly(words, least=12):
    """All runs: for every period the maximal stretches, kept if no divisor-like smaller period holds on them."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                stretch = words[i : j + q]
                smallest = next(p for p in range(1, q + 1) if all(x == y for x, y in zip(stretch, stretch[p:])))
                if smallest == q:
                    found[i, j - i + q, q] = True
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed_plainly(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def words_of(text):
    return [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]


@pytest.fixture(scope="module")
def repeated():
    rng = random.Random(8)
    made = []
    for _ in range(400):
        kind = rng.random()
        letters = "ab" if kind < 0.4 else "abcdefghij"
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            unit = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 13, 16, 17, 31, 33, 70]))]
            times = rng.choice([2, 3, 4, 9])
            words += (unit * times)[: rng.randint(len(unit), len(unit) * times)]
            words += [rng.choice(letters) for _ in range(rng.randint(0, 9))]
        made.append(rng.choice([" ", "\n", " \t "]).join(words))
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    odd = [None, "", " \n ", "a", "a " * 11, "a " * 12, "x y " * 12, "x\x1cy z " * 6, " ".join(fib[-1]), "é ü " * 40]
    return made + odd + made[:2]


def test_runs(spark, repeated):
    rows = {r.doc_id: r for r in periodic_runs.periodic_runs(table(spark, repeated)).collect()}
    for i, t in enumerate(repeated):
        runs = runs_plainly(words_of(t))
        assert [tuple(r) for r in rows[i].runs] == runs, t
        assert rows[i].collapsed == collapsed_plainly(words_of(t), runs)


def test_runs_do_not_depend_on_hashes(monkeypatch, repeated):
    """All hashes equal: every hit is measured word by word."""
    monkeypatch.setattr(periodic_runs, "_hashes", lambda codes, words: np.zeros(len(codes) - words + 1, np.uint64))
    for t in repeated[:60]:
        words, counts = periodic_runs.word_lists(pa.array([t], pa.string()))
        runs, _ = periodic_runs.find_runs(words, counts)
        assert [tuple(r) for r in runs.tolist()] == runs_plainly(words_of(t))


def test_runs_of_very_long_texts():
    rng = random.Random(2)
    unit = [f"w{rng.randrange(10**9)}" for _ in range(30_000)]
    noise = [f"v{i % 5000}x{i % 4999}" for i in range(100_000)]
    words = noise[:50_000] + unit * 3 + noise[50_000:] + ["z"] * 100_000
    found, counts = periodic_runs.word_lists(pa.array([" ".join(words)]))
    runs, _ = periodic_runs.find_runs(found, counts)
    assert runs.tolist() == [[50_000, 90_000, 30_000], [190_000, 100_000, 1]]


def test_runs_query(spark, tmp_path, repeated):
    """The planted circles and the digests of the registered query, from its contract."""
    ids = list(range(len(repeated)))
    table(spark, repeated, ids).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, t in zip(ids, repeated):
        words, h = words_of(t), zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
            planted += 1
        runs = runs_plainly(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        expected = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None)
        r = rows[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == expected
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode())
        assert r.collapsed_sha256 == sha(collapsed_plainly(words, runs).encode())
    assert planted > 10


def test_runs_rows_that_repeat_null_ids_and_no_rows(spark):
    docs = table(spark, ["b " * 12, "b " * 12, None], [1, 1, None])
    rows = periodic_runs.periodic_runs(periodic_runs.planted(docs)).collect()
    assert sorted((str(r.doc_id), len(r.runs), r.collapsed) for r in rows) == [("1", 1, "b"), ("1", 1, "b"), ("None", 0, "")]
    assert periodic_runs.periodic_runs(periodic_runs.planted(docs.limit(0))).count() == 0
