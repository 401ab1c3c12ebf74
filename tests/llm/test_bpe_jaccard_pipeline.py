"""Encoding against tiktoken, the near-copy join against all pairs, the pipeline's stages."""

import hashlib
import random
from collections import Counter
import struct

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from propyield.llm import bpe, jaccard
from propyield.llm.queries import QUERIES
from tests.llm import helpers as H

RANKS = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
TIK = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SPLIT = bpe.splitter(P.PATTERN)

TEXTS = [
    None, "", " ", "\n", "Hello world", "it's we'll I'M", "a  b   c", "tab\there", "x\n\ny\n z", " lead", "trail ", "\n\n",
    "nbsp\u00a0here\u2003wide", "null\x00byte", "ümläut straße ñandú 日本語 🎉🎉", "1234567 ³½", "don't 'quote' \"x\"!!!",
    "a" * 700, "xyz" * 300, " " * 500 + "w", "!?" * 400, "thhaenati ononwhther ouatinst", "Zürich\r\nBern", "\x1c\x1d a\x85b",
    "e\u0301 combining", "<|endoftext|>",
]


def want(text):
    ids = TIK.encode_ordinary(text or "")
    return len(ids), H.sha(struct.pack(f"<{len(ids)}I", *ids)), H.sha(text or "")


def test_encoding_equals_tiktoken(spark):
    rng = random.Random(1)
    rows = list(enumerate(TEXTS)) + [(100 + i, " ".join("".join(rng.choice("th he an in ou éa".split()) for _ in range(rng.randint(1, 6)))
                                     for _ in range(80))) for i in range(30)] + [(None, "no id"), (4, "Hello world")]
    docs = H.documents(spark, rows).withColumn("ids", F.lit(1)).withColumn("others", F.lit(2))
    got = bpe.bpe_report(docs, RANKS, P.PATTERN).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(text[r.doc_id]), repr(text[r.doc_id])
        assert r.round_trip
    apart = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS)
    assert apart.where(F.sha2("decoded", 256) != F.col("text_sha256")).isEmpty()


def test_words_outside_the_dictionary_are_folded_in_their_row(spark, monkeypatch):
    monkeypatch.setattr(bpe.build_dictionary, "__defaults__", (3, 2))
    docs = H.documents(spark, list(enumerate(TEXTS)))
    for r in bpe.bpe_report(docs, RANKS, P.PATTERN).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(TEXTS[r.doc_id])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é\n\t\u00a0'sTl1!.\x00日", max_size=40))
def test_chunks_never_cut_a_match(text):
    chunks = bpe.chunks_of(text, SPLIT)
    assert "".join(chunks) == text
    assert [i for c in chunks for i in TIK.encode_ordinary(c)] == TIK.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="thean onis1!é", min_size=1, max_size=60))
def test_long_merge_equals_tiktoken(text):
    for w in SPLIT.findall(text):
        assert bpe.merge_long(w.encode(), RANKS) == TIK.encode_ordinary(w)


def near_copies(rng, groups, vocabulary, low=5, high=80):
    rows, i = [], 0
    for size in groups:
        base = [rng.choice(vocabulary) for _ in range(rng.randint(low, high))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((i, " ".join(w)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_SEEN", 2 + seed)
    if seed == 2:  # every round of chosen members before the last step
        monkeypatch.setattr(jaccard, "COSTLY", 0)
        monkeypatch.setattr(jaccard, "ROUNDS", 3)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = near_copies(rng, [1] * 60 + [2, 3, 5, 8] * 6 + [60], vocabulary)
    passage = " ".join(rng.choice(vocabulary) for _ in range(20))
    rows += [(5000 + i, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30)))) for i in range(60)]
    rows += [(6000, None), (6001, " \n"), (6002, "one two"), (6003, "ONE\ttwo"), (6004, "one two three"), (6005, "")]
    docs = H.documents(spark, rows).withColumn("node", F.lit(1)).withColumn("gid", F.lit(2))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.ngram_components(docs).collect()}
    assert got == H.jaccard_components(rows)


def test_chain_of_links_is_one_component(spark):
    words = [f"c{i}" for i in range(160)]
    rows = [(i, " ".join(words[i * 3:i * 3 + 60])) for i in range(25)]
    got = {r.doc_id: r.component_id for r in jaccard.ngram_components(H.documents(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in H.jaccard_components(rows).items()} and set(got.values()) == {0}


def test_links_through_rows_without_an_id(spark):
    words = [f"c{i}" for i in range(100)]
    a, n, b = " ".join(words[:90]), " ".join(words[5:95]), " ".join(words[10:])  # a and b link through n alone
    docs = H.documents(spark, [(1, a), (None, n), (2, b), (None, "x y z u v w"), (None, "x y z u v w"), (None, None)])
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.ngram_components(docs).collect()]
    assert Counter(got) == Counter([(1, 86, 1), (None, 86, 1), (2, 86, 1), (None, 2, None), (None, 2, None), (None, 0, None)])
    with_id = H.documents(spark, [(1, a), (3, n), (2, b)])
    assert {r.component_id for r in jaccard.ngram_components(with_id).collect()} == {1}
    kept = jaccard.one_of_each(docs).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, a), (None, "x y z u v w"), (None, None)])


def test_one_document_of_each_group(spark):
    same = " ".join(f"w{i}" for i in range(40))
    rows = [(3, same), (1, same), (1, same), (9, same + " more"), (4, None), (None, same), (5, ""), (6, "else entirely"), (6, "something other")]
    docs = H.documents(spark, rows)
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())
    # both texts of id 6 stay: they share an id, not a word; the row without an id is a copy
    assert got == [(False, 1), (False, 4), (False, 5), (False, 6), (False, 6)]


def test_texts_that_share_an_id_are_kept_each_by_its_own(spark):
    t, u, v = (" ".join(f"{c}{i}" for i in range(40)) for c in "tuv")
    rows = [(3, t), (7, t), (7, u), (7, u), (7, " "), (0, "one text"), (0, "and another"), (0, v), (8, v + " more"), (None, t)]
    docs = H.documents(spark, rows).withColumn("row", F.lit(1)).withColumn("id", F.lit(2))
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    want = [(0, "and another"), (0, "one text"), (0, v), (3, t), (7, " "), (7, u)]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=lambda x: (x[0] is not None, x)) == want


@pytest.mark.parametrize("name", ["op1_bpe", "op4_jaccard", "pipeline"])
def test_empty_tables(spark, scratch, name):
    H.documents(spark, []).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    assert queries()[name](spark, scratch).count() == 0


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert ("pipeline" in oracle_sql()) == (corpus_pipeline.ORACLE_SQL is not None)


def test_pipeline_stages_take_effect(spark, scratch):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(300):
        w = [rng.choice(vocabulary) for _ in range(40)]
        bad = i % 6 == 0
        if bad:
            w.insert(5, "grumbold")
        rows.append((i, " ".join(w), rng.choice("abc")))
        labels.append((i, 1, int(bad)))
    rows += [(1000 + i, rows[1][1], "a") for i in range(30)] + [(2000, rows[2][1] + " me@mail.example.com", "b"), (2001, None, "c")]
    H.documents(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, scratch)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{scratch}/{name}")
        docs = spark.read.parquet(f"{scratch}/{name}")
        seen[name] = docs.collect()
    kept = {r.doc_id for r in seen["toxicity"]}
    assert kept == {i for i, *_ in rows} - {i for i, _, y in labels if y}
    text = {i: t for i, t, _ in rows}
    comp = H.jaccard_components([(i, text[i]) for i in kept])
    assert {r.doc_id for r in seen["ngram_jaccard_join"]} == {i for i, (n, c) in comp.items() if not n or c == i}
    assert all("@" not in (r.text or "") for r in seen["pii"]) and len(seen["pii"]) == len(seen["ngram_jaccard_join"])
    assert all(r.n_chars == len(r.text) for r in seen["pii"] if r.text is not None)
    final = {r.doc_id: r.text for r in seen["mixing"]}
    for r in seen["byte_level_bpe"]:
        ids = list(struct.unpack(f"<{r.n_tokens}I", r.ids))
        assert ids == TIK.encode_ordinary(final[r.doc_id]) and r.round_trip
        assert r.decoded_sha256 == hashlib.sha256(final[r.doc_id].encode()).hexdigest()
    assert sorted(r.doc_id for r in seen["byte_level_bpe"]) == sorted(r.doc_id for r in seen["mixing"])


def test_each_merge_has_one_place_in_the_table():
    pairs, table = bpe.last_pairs(RANKS), bpe.pair_table(RANKS)
    low = max(RANKS.values()) + 1
    got = {}
    for left, at in enumerate(table["shift"]):
        for right in range(low) if left % 997 == 0 else ():
            if at + right < len(table["owner"]) and table["owner"][at + right] == left:
                got[left, right] = table["rank"][at + right] + low
    assert got == {p: r for p, r in pairs.items() if p[0] % 997 == 0} and got
    for (left, right), rank in pairs.items():
        at = table["shift"][left] + right
        assert table["owner"][at] == left and table["rank"][at] == rank - low


def test_bytes_without_a_rank_are_refused():
    few = {b"a": 0, b"b": 1, b"ab": 2}
    assert bpe.Starts(few)([b"ab", None]).to_pylist() == [[None, None, 0, -1, 1, None, None], []]
    with pytest.raises(ValueError):
        bpe.Starts(few)([b"ac"])


def test_letters_are_found_without_a_search():
    find = bpe.word_finder(P.PATTERN)
    for chunk in (" abc", "abc", " ", "", "\nabc", " it's", "  ab", " ab1", " äb", "a b", " \n", "'s"):
        assert find(chunk) == SPLIT.findall(chunk)
    assert bpe.word_finder(r"[ab]| ?\p{L}+")("cab") == ["cab"] and bpe.word_finder(r"[ab]| ?\p{L}+")("ac") == ["a", "c"]


def test_frequent_shingles_and_their_order(spark):
    texts = ["a b c d e f g", "a b c d e f h", "x y z u v w", "q", None, ""] * 5
    docs = H.documents(spark, list(enumerate(texts))).coalesce(1)
    want = Counter(int(h) for t in texts for h in jaccard.shingle_set(t.encode() if t else None, jaccard._WordHashes()))
    tokens, rank = jaccard.frequent_shingles(docs)
    assert set(tokens.tolist()) == {t for t, n in want.items() if n >= jaccard.HOT_SEEN}
    assert [want[t] for t in tokens[rank.argsort()].tolist()] == sorted(want.values())
