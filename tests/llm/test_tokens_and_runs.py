"""Byte-level BPE, alignment of tokenizers and periodic runs: against the libraries, brute force, and odd rows."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from waybill.llm import alignment, bpe, queries, runs  # noqa: E402
from waybill.llm.shared import Landing  # noqa: E402

SF = "/root/testdata/sf0.01"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", " \t\n", "a", "  a  b ", "a▁b", "x\ty\n\nz  ", "漢字 😀 á", "<s>a</s>", "<|endoftext|> <unk>\0", "é\x85b\xa0 c\x1cd",
    "don't 'll we'RE", "a" * 5000, " " * 3000, "ab " * 20_000, "a b c d " * 40, "a b c d " * 40,
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names clash with those inside the operators."""
    rows = [(i, t, "x", 1, 2, [3], "y") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, row long, pair long, pairs array<int>, value string").repartition(3)


def documents():
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] for r in rows}


# --- byte-level BPE ------------------------------------------------------------------------------------------


def tiktoken_of(path):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_agrees_with_tiktoken_on_mixtures_and_all_kinds_of_characters():
    reference, mine = tiktoken_of(RANKS), bpe.bpe_of(RANKS, PATTERN)
    rng = random.Random(2)
    bits = ["a", "the", "  ", "\n", "'s", "'", "é", "漢", "1", "$$", "\t", "\x1c", "\x85", " ", "😀", "ing", "RE", "zq", "==", "-", "<|endoftext|>"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    points = [c for c in [*range(0x3100), *range(0x3100, 0x110000, 97)] if not 0xD800 <= c < 0xE000]
    texts += [f"a{c}b 1{c}2 {c}{c}x'{c}. {c}" for c in map(chr, points)]
    for text in texts:
        ids = mine.encode(text)
        assert list(memoryview(ids).cast("I")) == reference.encode_ordinary(text), repr(text)
        assert mine.decode(ids) == text.encode()


def test_bpe_of_another_vocabulary_and_a_token_that_merging_does_not_reach(tmp_path):
    other = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    reference, mine = tiktoken_of(other), bpe.bpe_of(other, PATTERN)
    for text in documents().values():
        assert list(memoryview(mine.encode(text or "")).cast("I")) == reference.encode_ordinary(text or "")
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"abc", b"abcd"]  # bc comes first, so abcd needs abc + d; xyz has no parts
    tokens.append(b"xyz")
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + f" {i}\n".encode() for i, t in enumerate(tokens)))
    reference, mine = tiktoken_of(path), bpe.bpe_of(str(path), PATTERN)
    for text in ("xyz", "xyzz", " xyz", "abcd", "ab abcdabc", "bcbc"):
        assert list(memoryview(mine.encode(text)).cast("I")) == reference.encode_ordinary(text)


def test_bpe_with_a_small_memory_and_long_texts(monkeypatch):
    reference = tiktoken_of(RANKS)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 3000)
    monkeypatch.setattr(bpe, "CUTS_AT_ONCE", 50)
    mine = bpe.ByteBpe(bpe.read_ranks(RANKS), PATTERN)
    for text in [t or "" for t in ODD] + list(documents().values())[:100]:
        ids = mine.encode(text)
        assert list(memoryview(ids).cast("I")) == reference.encode_ordinary(text)
        assert mine.decode(ids) == text.encode()
        assert mine.remembered.size <= 1500 and all(len(cut) <= bpe.LONG_CUT for cut in mine.remembered.known)


def test_bpe_queries(spark):
    reference = tiktoken_of(RANKS)

    def digests(text):
        ids = np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    want = {i: digests(t) for i, t in documents().items()}
    assert {r[0]: tuple(r[1:]) for r in queries.op11_byte_bpe(spark, SF).collect()} == want
    docs = frame(spark, ODD, [None, 1, 1, *range(3, len(ODD))])
    found = bpe.decoded(bpe.encoded(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert sorted(bytes(r.content) for r in found) == sorted((t or "").encode() for t in ODD)
    assert bpe.decoded(bpe.encoded(docs.limit(0), RANKS, PATTERN), RANKS, PATTERN).collect() == []
    nothing = bpe.decoded(spark.createDataFrame([(1, None)], "doc_id int, ids binary"), RANKS, PATTERN).collect()
    assert [(r.doc_id, bytes(r.ids), bytes(r.content)) for r in nothing] == [(1, b"", b"")]


# --- alignment -----------------------------------------------------------------------------------------------


def brute_alignment(text, a, b):
    """(n_a, n_b, n_groups, groups, times of each linked pair) by the libraries and two loops."""
    if not text:
        return 0, 0, 0, "", {}
    sides = []
    for side in (a, b):
        ids = side.encode_all([" " + text])[0]
        parts = [side.spelling.bytes_of[i] for i in ids]
        if b"".join(parts) != b" " + text.encode():
            return 0, 0, 0, "", {}
        ends = np.cumsum([len(p) for p in parts]).tolist()
        sides.append(list(zip(ids, [0, *ends], ends)))
    shared = sorted({e for _, _, e in sides[0]} & {e for _, _, e in sides[1]})
    groups, times, at = [], collections.Counter(), 0
    for end in shared:
        here = [[t for t in side if at <= t[1] and t[2] <= end] for side in sides] if len(shared) < 400 else None
        if here is None:
            here = [side[: next((k for k, t in enumerate(side) if t[2] > end), len(side))] for side in sides]
            sides = [side[len(part) :] for side, part in zip(sides, here)]
        groups.append("|".join(",".join(str(t[0]) for t in part) for part in here))
        times.update((x[0], y[0]) for x in here[0] for y in here[1] if max(x[1], y[1]) < min(x[2], y[2]))
        at = end
    n_a, n_b = (sum(g.split("|")[k].count(",") + 1 for g in groups) for k in (0, 1))
    return n_a, n_b, len(groups), ";".join(groups), dict(times)


def brute_scores(texts):
    a, b, _ = alignment._tools(A_FILE, B_FILE)
    each = [brute_alignment(t, a, b) for t in texts]
    count = collections.Counter(p for e in each for p in e[4])
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(n, highest.get(x, 0))
    return [
        (n_a, n_b, n, sum(t.values()), sum(m for p, m in t.items() if count[p] == highest[p[0]]), sum(m * count[p] for p, m in t.items()),
         hashlib.sha256(g.encode()).hexdigest() if n_a else "")
        for n_a, n_b, n, g, t in each
    ]


def test_follow_comes_to_the_end_of_long_chains():
    n = 1000
    assert (alignment.follow(np.minimum(np.arange(n) + 1, n - 1)) == n - 1).all()
    assert alignment.follow(np.empty(0, np.int64)).tolist() == []


@pytest.mark.parametrize("segment", [1 << 20, 40])
def test_alignment_of_batches(monkeypatch, segment):
    monkeypatch.setattr(alignment, "SEGMENT_BYTES", segment)
    tools = alignment._tools(A_FILE, B_FILE)
    texts = ODD + list(documents().values())[:40]
    found = {k: v.to_pylist() for k, v in alignment._aligned_batch(texts, *tools).items()}
    for k, text in enumerate(texts):
        times = {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(found["pairs"][k], found["times"][k])}
        got = (found["n_a"][k], found["n_b"][k], found["n_groups"][k], found["groups"][k], times)
        assert got == brute_alignment(text, *tools[:2]), text
        assert found["n_links"][k] == sum(times.values())


def test_sides_agree_with_the_libraries_on_whole_texts():
    import sentencepiece
    import tokenizers

    a, b, _ = alignment._tools(A_FILE, B_FILE)
    byte_level, pieces = tokenizers.Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    byte_level.encode_special_tokens = True
    texts = [t for t in ODD if t] + [t for t in list(documents().values())[:300] if t]
    for side, whole in ((a, lambda t: byte_level.encode(" " + t, add_special_tokens=False).ids), (b, pieces.encode)):
        for text, mine in zip(texts, alignment.tokens_of(side, texts)):
            ids = whole(text)
            if b"".join(side.spelling.bytes_of[i] for i in ids) == b" " + text.encode():
                assert mine.tolist() == ids, text
            else:
                assert mine is None, text
    assert alignment.tokens_of(b, ["a▁b", "c"])[0] is None


def test_cuts_of_equal_hashes_are_told_apart(monkeypatch):
    """With hashes of four bits cuts are mixed up all the time; texts are then encoded whole."""
    a, b = alignment.ByteLevelSide(A_FILE), alignment.PieceSide(B_FILE)
    texts = [t for t in list(documents().values())[:20] if t]
    want = [alignment.tokens_of(side, texts) for side in (a, b)]
    for side, right in zip((alignment.ByteLevelSide(A_FILE), alignment.PieceSide(B_FILE)), want):
        real = side.hasher.hashes
        monkeypatch.setattr(side.hasher, "hashes", lambda *given, real=real: real(*given) & np.uint64(15))
        assert all(np.array_equal(x, y) for x, y in zip(alignment.tokens_of(side, texts), right))


def test_alignment_scores(spark):
    texts = ODD + list(documents().values())[:60]
    want = sorted(brute_scores(texts))
    docs = frame(spark, texts)

    def scores(df, most):
        rows = alignment.aligned(df, A_FILE, B_FILE).withColumn("sha", queries.F.when(queries.F.col("n_a") > 0, queries.F.sha2("groups", 256)).otherwise(""))
        rows = alignment.link_scores(rows.drop("groups"), Landing(spark, "alignment"), most)
        return rows.select("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha")

    for most in (500_000, 20, 0):  # all pairs frequent, some, none
        assert sorted(map(tuple, scores(docs, most).collect())) == want
    assert scores(docs.limit(0), 20).collect() == []


def test_alignment_query(spark):
    docs = documents()
    want = dict(zip(docs, brute_scores(docs.values())))
    found = queries.op12_token_alignment(spark, SF)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == want


# --- periodic runs -------------------------------------------------------------------------------------------


def brute_runs(words, shortest=6, times=4):
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - start
            smaller = any(words[start : start + size - p] == words[start + p : start + size] for p in range(1, q))
            if size >= max(shortest, times * q) and not smaller:
                out.append((start, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(rng, n):
    for _ in range(n):
        letters = "abcd"[: rng.randint(1, 4)]
        words = [rng.choice(letters) for _ in range(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 3)):
            part = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
            words += (part * 9)[: rng.randint(0, len(part) * 6)] + [rng.choice(letters) for _ in range(rng.randint(0, 5))]
        yield words


@pytest.mark.parametrize("shortest, times", [(6, 4), (1, 3), (12, 5)])
def test_runs_against_brute_force(shortest, times):
    rng = random.Random(times)
    for _ in range(300):
        texts = list(periodic_texts(rng, rng.randint(1, 4)))
        bounds = np.cumsum([0] + [len(t) for t in texts])
        codes = np.array([ord(w) for t in texts for w in t], np.int64)
        want = [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t, shortest, times)]
        assert list(map(tuple, runs.find_runs(codes, bounds, shortest, times).tolist())) == want
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(9, np.int64), np.array([0, 9]), times=2)


def test_runs_of_odd_rows(spark):
    texts = [*ODD, *(" \n".join(t) for t in periodic_texts(random.Random(7), 50)), "é é é é é é\x0bé", "x " * 9 + "Y " + "x " * 9]
    found = runs.periodic_runs(frame(spark, texts, [None, 1, 1, *range(3, len(texts))])).collect()
    want = []
    for t in texts:
        words = WORD.findall(t or "")
        if len(words) > 10_000:
            assert set(words) == {"ab"}
            each = [(0, len(words), 1)]
        else:
            each = brute_runs(words)
        want.append((len(words), each, collapsed(words, each)))
    assert sorted((r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found) == sorted(want)
    empty = runs.periodic_runs(frame(spark, texts).limit(0))
    assert empty.columns == ["doc_id", "n_words", "runs", "collapsed"] and empty.collect() == []


def test_runs_query(spark):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want, planted = {}, 0
    for i, text in documents().items():
        words, h = WORD.findall(text or ""), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        found = brute_runs(words) if n < 600 else [tuple(r[1:]) for r in runs.find_runs(np.unique(words, return_inverse=True)[1], np.array([0, n])).tolist()]
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if found else None
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
        want[i] = (len(found), *best, milli, sha(lines), sha(collapsed(words, found)))
    assert planted > 50
    assert {r[0]: tuple(r[1:]) for r in queries.op13_periodic_runs(spark, SF).collect()} == want
