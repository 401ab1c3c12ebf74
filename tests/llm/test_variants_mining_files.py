"""Spelling variants, hard negatives and token files against brute force and round trips."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm import helpers as H

from propyield.llm import hard_negatives as M
from propyield.llm import spelling as S
from propyield.llm import token_files as T
from propyield.session import scratch_path

# ------------------------------------------------------------------ spelling


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(rows, min_length=5, min_count=3):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(H.UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}
    near = {w: [x for x in n if distance_one(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(spark, rows, **kw):
    docs = H.documents(spark, rows).withColumns({c: F.lit(1) for c in ("word", "n", "half", "block", "form")})
    out = S.spelling_variants(docs, **kw)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = out.collect()
    assert len(got) == len({r.word for r in got})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


@pytest.mark.parametrize("block", [S.BLOCK, 60])
def test_spelling_against_brute_force(spark, block):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abé", k=rng.randint(4, 9))) for _ in range(500)] + ["x" * 3000, "x" * 3001, "x" * 2999 + "y"]
    rows = [(rng.randint(0, 40), " ".join(rng.choices(vocabulary, weights=[1 + i % 37 for i in range(len(vocabulary))], k=60)))
            for _ in range(300)]
    rows += [(None, "Abaab ABAAB, abaab"), (1, None), (2, ""), (2, "..."), (7, "Ābcdef " * 4)]
    want = variants(rows)
    assert found(spark, rows, block=block) == want
    assert sum(v[0] is not None for v in want.values()) > 20 and max(v[3] for v in want.values()) > 3


def test_spelling_of_short_words_and_chains(spark):
    rows = [(1000 + i, " ".join(w * 1 for w, k in (("a", 30), ("ab", 12), ("b", 3), ("abc", 5), ("abcd", 2), ("q", 1)) for _ in range(k)))
            for i in range(1)]
    want = variants(rows, 1, 1)
    assert found(spark, rows, min_length=1, min_count=1) == want
    assert want["abcd"][1] == "a"
    assert found(spark, []) == {}


words = st.text("ab", min_size=1, max_size=9)


@settings(max_examples=200, deadline=None)
@given(st.sets(words, min_size=1, max_size=40))
def test_position_index(vocabulary):
    """Every pair at distance one is found in exactly one of the shared groups."""
    got = Counter()
    for ending in (False, True):
        groups = defaultdict(list)
        for w in sorted(vocabulary):
            for half in {(len(w) - 1) // 2, len(w) // 2}:
                form = w[::-1] if ending else w
                groups[half, form[:half]].append((w, form))
        for (half, _), held in groups.items():
            index = S.PositionIndex([f for _, f in held], half)
            for w, f in held:
                hit = index.near(f, ending)
                got.update((w, x) for i, (x, _) in enumerate(held) if hit >> i & 1)
    assert got == Counter((a, b) for a in vocabulary for b in vocabulary if distance_one(a, b))


# ------------------------------------------------------------------ hard negatives


def mined(rows, positives=5, negatives=10, low=30, high=90):
    """Rows of the contract, by comparing every anchor with every row."""
    good, seen = [], set()
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or x - x != 0 for x in v):
            continue
        if vec_id % 7 == 0:
            label = (label + 1) % 10
        row = (vec_id, label, tuple(v))
        if row not in seen:
            seen.add(row)
            good.append((vec_id, label, [int(np.floor(256 * x)) for x in v], row))
    out = []
    for a in good:
        if a[0] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2], strict=True)), r[0], r[1]) for r in good
                        if r[3] != a[3] and len(r[2]) == len(a[2]))
        for s, p, _ in [x for x in scored if x[2] == a[1]][:positives]:
            fit = [x for x in scored if x[2] != a[1] and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a[0], p, k, n, -s, -t) for k, (t, n, _) in enumerate(fit, 1)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int, score string, block int, windows int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("block_bytes", [M.BLOCK_BYTES, 3000])
def test_mining_against_brute_force(spark, block_bytes):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * 0.4 + 0.3], int(rng.integers(0, 10))) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6, i % 3) for i in range(120)]  # ties
    rows += rows[90:130] + [rows[100]] * 5  # repeated rows
    rows += [(200, [0.25] * 6, 4), (200, [0.5, 0.125, 0.25, 0.0, 0.0, 1.0], 4), (300, [-0.5] * 6, 1)]  # other rows of one id
    rows += [(2000, [0.5, 0.5], 1), (2001, [0.5, 0.5], 1), (2002, [0.25, 0.5], 2), (2100, [], 1), (2101, [], 1), (2103, [], 2)]
    rows += [(2200, None, 1), (2300, [0.5, None, 0.5, 0.5, 0.5, 0.5], 1), (2400, [float("nan")] * 6, 1),
             (2500, [float("inf")] * 6, 1), (2600, [0.5] * 6, None), (None, [0.5] * 6, 1)]
    want = mined(rows)
    q = M.quantised(vectors(spark, rows).withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
    out = M.hard_negatives(q, lambda c: c % 100 == 0, block_bytes=block_bytes)
    assert sorted(map(tuple, out.collect())) == want and len(want) > 100


def test_mining_report_and_empty_tables(spark):
    rows = [(i, [0.1 * (i % 7), 0.3, 0.01 * i], i % 4) for i in range(150)]
    rows = [(i, [float(np.float32(x)) for x in v], c) for i, v, c in rows]
    out = M.mining_report(vectors(spark, rows))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, out.collect())) == mined(rows)
    assert M.mining_report(vectors(spark, [])).collect() == []
    assert M.mining_report(vectors(spark, [(100, [0.5], 1)])).collect() == []


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for scale in (1e2, 1e7, 1e8, 2.0 ** 40):
        a, b = (np.floor(rng.normal(size=(n, 5)) * scale) for n in (3, 4))
        want = [[min(max(sum(int(x) * int(y) for x, y in zip(r, c, strict=True)), -M._LAST), M._LAST) for c in b] for r in a]
        assert M.products(a, b).tolist() == want


@given(st.lists(st.tuples(st.integers(-2**62, 2**62), st.booleans(), st.integers(-2**63, 2**63 - 1)), min_size=2))
def test_packed_keys_sort_as_their_rows(rows):
    by_key = sorted(rows, key=lambda r: M.packed(-5, 9, *r))
    assert by_key == sorted(rows, key=lambda r: (-r[0], r[1], r[2]))


@given(st.integers(-10**6, 10**6))
def test_windows(score):
    lo, hi = M.window(score)
    for s in range(lo - 2, lo + 3):
        assert (s >= lo) == (30 * score <= 100 * s)
    for s in range(hi - 2, hi + 3):
        assert (s <= hi) == (100 * s <= 90 * score)


# ------------------------------------------------------------------ token files


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.booleans())
def test_planes_round_trip(ids, bits):
    ids = np.array(ids, dtype="<u4")
    planes = T.planes_of(ids, bits)
    assert len(planes) == (32 if bits else 4)
    assert T.ids_of(planes, len(ids), bits).tolist() == ids.tolist()


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def encode(vocabulary):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(vocabulary)
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


ODD = [None, "", " ", "plain words here", "  two  spaces \n\n\n and lines\t\ttabs ", "café naïve 你好 \U0001f600    x",
       "<|endoftext|> is text", "don't we'll I'M 12 345 a1b2", "x" * 5000, "word " * 3000, "\x00\x01﻿", "1 2 3 " * 50]


@pytest.mark.parametrize(("size", "known"), [(1, 3), (3, 10**6), (64, 200), (T.PART, T.KNOWN)])
def test_parts_of_a_text_encode_alike(encode, vocabulary, monkeypatch, size, known):
    monkeypatch.setattr(T, "PART", size)
    rng = random.Random(size)
    texts = [*ODD, *("".join(rng.choices("ab1' \n\t .,é\x1c\x85\xa0\u3000\u200b", weights=[9] * 5 + [2] * 11, k=200)) for _ in range(300))]
    texts += [" ".join(rng.choices(["word", "don't", "\nline", "x1.", "é"], k=60)) for _ in range(20)]
    for text in texts:
        if text:
            assert "".join(T.text_parts(text, size)) == text
            assert "\0" in text or T.marked(text, T.is_odd(text)).replace("\0", "") == text
    got = list(T.Coder(vocabulary, known).ids_of_texts(texts))
    assert [x.tolist() for x in got] == [encode(t)[:-1] for t in texts]


def expected(rows, encode):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = encode(text)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_against_the_library(spark, encode, vocabulary):
    rows = [(3 * i - 7, t) for i, t in enumerate(ODD)] + [(1000 + i, f"text number {i} " * (i % 50)) for i in range(300)] + [(None, "no id")]
    random.Random(2).shuffle(rows)
    docs = H.documents(spark, rows).withColumns({c: F.lit(1) for c in ("start", "ids", "place", "h", "part")})
    path = scratch_path(spark, "token-files")
    out = T.token_files_report(docs, vocabulary, path)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    got = sorted(map(tuple, out.collect()), key=lambda r: r[1])
    assert got == expected(rows, encode)
    manifest = T.read_manifest(spark, path, group=2).orderBy("part").collect()
    assert [m.start for m in manifest] == [sum(x.ids for x in manifest[:i]) for i in range(len(manifest))]
    assert sum(m.docs for m in manifest) == len(rows)
    assert T.token_files_report(docs.limit(0), vocabulary, scratch_path(spark, "token-files")).collect() == []


def test_token_files_with_repeated_ids_and_rows(spark, encode, vocabulary):
    texts = ["one text", "another one", "one text", None]
    rows = [(5, t) for t in texts * 40] + [(1, "first"), (9, "last"), (9, "last")]
    out = T.token_files_report(H.documents(spark, rows), vocabulary, scratch_path(spark, "token-files"))
    got = sorted(map(tuple, out.collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [1] + [5] * 160 + [9, 9]
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter((r[0], r[2], r[3]) for r in expected(rows, encode))
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]


@pytest.mark.parametrize("bits", [False, True])
def test_ranges_are_read_by_the_chunk_index(spark, encode, vocabulary, bits):
    rows = [(i, f"text number {i} " * (1 + i % 30)) for i in range(100)]
    path = scratch_path(spark, "token-files")
    docs = H.documents(spark, rows).withColumn("doc_id", F.format_string("%03d", "doc_id"))
    T.write_token_files(docs.coalesce(1), vocabulary, path, end_id=7, bits=bits, block=64)
    back = T.read_token_files(spark, path, "string").orderBy("start").collect()
    every = [i for _, t in rows for i in [*encode(t)[:-1], 7]]
    assert [r.doc_id for r in back] == [f"{i:03d}" for i, _ in rows]
    assert np.frombuffer(b"".join(r.ids for r in back), dtype="<u4").tolist() == every
    for m in T.read_manifest(spark, path).collect():
        with T.open_input(f"{path}/files/{m.file}") as f:
            reader = T.PlaneReader(f)
            assert reader.bits == bits and max(reader.counts) == 64 and len(reader.counts) > 1
            read = []
            whole, reader.block = reader.block, lambda i: (read.append(i), whole(i))[1]
            for a, b in [(0, 1), (63, 65), (100, 100), (130, 400), (m.ids - 3, m.ids)]:
                read.clear()
                assert reader.ids(a, b).tolist() == every[m.start + a:m.start + b]
                assert len(read) <= (b - a) // 64 + 2


def test_damaged_files_are_refused(spark, vocabulary, tmp_path):
    path = str(tmp_path / "files")
    T.write_token_files(H.documents(spark, [(1, "some text of a few words")]), vocabulary, path)
    (m,) = T.read_manifest(spark, path).collect()
    file = tmp_path / "files" / "files" / m.file
    good = file.read_bytes()
    file.write_bytes(good[:-3])
    with T.open_input(str(file)) as f, pytest.raises(ValueError, match="cut short"):
        T.PlaneReader(f)
    file.write_bytes(good)
    with T.open_input(str(file)) as f:
        reader = T.PlaneReader(f)
        reader.sums[0] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            reader.block(0)


def test_a_vocabulary_without_special_tokens(encode, vocabulary):
    import json

    bare = json.loads(vocabulary) | {"added_tokens": []}
    coder = T.Coder(json.dumps(bare))
    assert coder.joint is None
    texts = [t for t in ODD if t and "<|" not in t]
    assert [x.tolist() for x in coder.ids_of_texts(texts)] == [encode(t)[:-1] for t in texts]
