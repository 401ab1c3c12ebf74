"""Language model, language identification, toxicity and neighbours, with edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from propyield.llm import ann, hmm, langid, toxicity
from propyield.llm.queries import QUERIES
from tests.llm import helpers as H

DOG = "the dog ran over the green hill and saw the red fox".split()
CHAT = "le chat noir dort sur la table et mange une souris".split()


def two_languages(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice((DOG, CHAT)[i % 2]) for _ in range(rng.randint(5, 40)))) for i in range(n)]


def test_base_scores_and_columns(spark):
    rows = two_languages(150) + [(900, None), (901, ""), (902, "zzz unseen words"), (903, "x" * 3000), (903, "x" * 3000), (None, "le chat")]
    docs = H.documents(spark, rows).withColumn("codes", F.lit(1)).withColumn("row", F.lit(2))
    got = sorted(tuple(r)[:6] for r in hmm.hmm_scores(docs, states=2, rounds=2).fillna(-1, ["doc_id"]).collect())
    want = sorted((-1 if i is None else i, *rest) for i, *rest in H.base_scores(rows))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert (g[0], g[2], g[3], g[4]) == w[:4] and g[5] == pytest.approx(w[4], rel=1e-9)


def test_training_helps_on_held_out_texts(spark):
    docs = H.documents(spark, two_languages(600))
    s = hmm.hmm_scores(docs, states=3, rounds=5).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert s[0] > s[1] * 0.9  # log10 values: nearer to zero by more than a tenth


def test_forward_equals_the_sum_over_paths():
    from itertools import product

    rng = np.random.default_rng(0)
    counts = rng.integers(1, 9, hmm.CLASSES).astype(float)
    m = hmm.initial(counts, 3)
    m.start = np.array([0.5, 0.3, 0.2])
    texts = [rng.integers(0, hmm.CLASSES, n) for n in (1, 4, 2, 5)]
    for c, got in zip(texts, hmm.log10_likelihood(m, texts), strict=True):
        total = 0.0
        for path in product(range(3), repeat=len(c)):
            p = m.start[path[0]] * m.emit[c[0], path[0]]
            for a, b, x in zip(path, path[1:], c[1:], strict=False):
                p *= m.step[a, b] * m.emit[x, b]
            total += p
        assert got == pytest.approx(np.log10(total))


def test_expected_counts_add_up_and_rounds_raise_the_likelihood():
    rng = np.random.default_rng(4)
    texts = [np.append(rng.integers(0, 40, n) + 60 * (i % 2), hmm.END) for i, n in enumerate(rng.integers(1, 700, 60))]
    counts = np.bincount(np.concatenate(texts), minlength=hmm.CLASSES).astype(float)
    m = hmm.initial(counts, 2)
    before = None
    for _ in range(5):
        starts, trans, emits = hmm.expected_counts(m, texts)
        assert starts.sum() == pytest.approx(len(texts))
        assert emits.sum() == pytest.approx(sum(map(len, texts)))
        np.testing.assert_allclose(emits.sum(axis=1), counts, atol=1e-6)
        m = hmm.renewed(starts, trans, emits, counts)
        now = hmm.log10_likelihood(m, texts).sum()
        assert before is None or now > before - 1.0
        before = now


def test_word_probabilities_sum_to_one_in_a_shared_class():
    c, v = 17.0, 4
    counts = [9, 5, 2, 1]
    assert sum((n + 1) / (c + v + 1) for n in counts) + 1 / (c + v + 1) == pytest.approx(1)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.standard_normal(16) * rng.uniform(0.5, 2)).tolist(), 0) for i in range(1500)]
    rows += [(2000 + i, [1.0] * 16, 1) for i in range(40)]  # equal vectors
    rows += [(3000, None, 0), (3020, [0.0] * 16, 0), (3040, [float("nan")] * 16, 0), (3060, [None] + [1.0] * 15, 0),
             (3080, [1.0, 2.0], 0), (None, [1.0] * 16, 0)]
    got = ann.neighbours_report(vectors(spark, rows).withColumn("score", F.lit(1)).withColumn("rank", F.lit(1))).collect()
    ok = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v, _ in rows[:1540]]
    ids, m = np.array([i for i, _ in ok]), np.stack([v for _, v in ok])
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in by.items():
        s = (m * m[ids == q][0]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:20]
        found.sort()
        assert [x[0] for x in found] == list(range(1, 21))
        for _, v, score in found:
            assert score == pytest.approx(s[ids == v][0], abs=1e-12)
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        hits += len({x[1] for x in found} & set(ids[order].tolist()))
        if 2000 <= q < 2040:
            twins = [i for i in range(2000, 2040) if i != q and s[ids == i][0] > 0]
            best = [v for _, v, sc in found if sc == s[ids == q][0]]
            assert best == twins[:len(best)]
    assert hits >= 0.9 * 20 * len(by)


def test_few_vectors_return_all(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(5)]
    got = ann.neighbours_report(vectors(spark, rows)).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [
        (0, i + 1, i + 1) for i in range(4)]
    assert ann.neighbours_report(vectors(spark, [])).count() == 0


def test_blocks_do_not_change_what_is_found(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist(), 0) for i in range(400)]
    is_query = lambda c: c % 20 == 0
    got = ann.nearest(vectors(spark, rows), is_query, index_bytes=8 * 8 * 90).collect()
    m = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    found = sum(len({r.vec_id for r in got if r.query_id == q} & set([j for j in np.argsort(-(m @ m[q])) if j != q][:20]))
                for q in range(0, 400, 20))
    assert len(got) == 400 and found >= 0.9 * 400


def test_repeated_query_rows_and_hot_ids(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.standard_normal(6).tolist(), 0) for i in range(200)]
    once = sorted(tuple(r) for r in ann.neighbours_report(vectors(spark, rows)).where("query_id = 20").collect())
    assert len(once) == 20
    again = ann.neighbours_report(vectors(spark, [*rows, rows[20], rows[20]])).where("query_id = 20").collect()
    assert sorted(map(tuple, again)) == once  # searched once; none of its own id
    # another vector under a query's id is searched for itself, beside the first
    other = ann.neighbours_report(vectors(spark, [*rows, (20, [3.0] * 6, 0)])).where("query_id = 20").collect()
    assert len(other) == 40 and Counter(r["rank"] for r in other) == dict.fromkeys(range(1, 21), 2)
    assert len(set(once) & set(map(tuple, other))) >= 10  # windows depend on the largest norm of the table
    # a placeholder id on a third of the rows, and one vector on many: no block takes them all
    hot = rows + [(-1, rng.standard_normal(6).tolist(), 0) for _ in range(150)] + [(-2, [0.1] * 6, 0)] * 150
    got = ann.nearest(vectors(spark, hot), lambda c: c % 20 == 0, index_bytes=6 * 8 * 50).collect()
    ids, m = np.array([r[0] for r in hot]), np.array([r[1] for r in hot], dtype=np.float32).astype(float)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r.score)
    assert set(by) == set(range(0, 200, 20))
    for q, scores in by.items():
        want = sorted((m[ids != q] @ m[ids == q][0]).tolist(), reverse=True)[:20]
        assert len(scores) == 20 and sum(np.isclose(sorted(scores, reverse=True), want)) >= 15


def test_every_length_of_vectors_is_searched(spark):
    rows = [(20 * i, [float(i + 1), 1.0], 0) for i in range(3)] + [(20 * i, [1.0, 2.0, float(i)], 0) for i in range(5, 9)] + [(200, [1.0], 0)]
    got = Counter(r.query_id for r in ann.neighbours_report(vectors(spark, rows)).collect())
    assert got == {0: 2, 20: 2, 40: 2, 100: 3, 120: 3, 140: 3, 160: 3}


def labelled(n, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(DOG + CHAT) for _ in range(rng.randint(10, 60))]
        bad = i % 5 == 0
        if bad:
            for _ in range(rng.choice([1, 1, 6])):
                w.insert(rng.randrange(len(w)), rng.choice(["grumbold", "Snarfle,", "vexo" + rng.choice("abcdefgh") + "xx"]))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_texts(spark):
    docs, labels = labelled(700)
    frame = H.documents(spark, docs).withColumn("toxic", F.lit("clash")).withColumn("grade", F.lit(9))
    first = spark.createDataFrame([x for x in labels if x[0] < 500] + labels[:3], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, first)
    assert np.all(np.diff(model.thetas) > 0)
    got = {r.doc_id: r for r in toxicity.score_toxicity(frame, model).collect()}
    held = [x for x in labels if x[0] >= 500]
    assert sum(got[i].toxic == bool(y) for i, _, y in held) >= 0.98 * len(held)
    for r in got.values():
        assert 0 <= r.p_severe <= r.p_toxic <= 1 and r.severity == pytest.approx(r.p_toxic + r.p_severe)
    severe = [got[i].severity for i, t in docs if i % 5 == 0 and t.count("grumbold") + t.count("Snarfle") + t.count("vexo") > 4]
    mild = [got[i].severity for i, t in docs if i % 5 == 0 and t.count("grumbold") + t.count("Snarfle") + t.count("vexo") == 1]
    assert np.mean(severe) > np.mean(mild)
    kept = toxicity.without_toxic(frame, model)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.toxic}


def test_toxicity_edge_rows(spark):
    docs, labels = labelled(200)
    rows = docs + [(1000, None), (1001, ""), (1002, "grumbold " * 20000), (1003, "dog " * 20000), (None, "grumbold"), (5, docs[5][1])]
    frame = H.documents(spark, rows)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(frame, toxicity.fit(frame, lab)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.toxic for r in got}
    assert not by[1000] and not by[1001] and by[1002] and not by[1003] and by[None]
    nothing = toxicity.fit(frame, lab.where("toxic = 0"))
    assert not any(r.toxic or r.severity for r in toxicity.score_toxicity(frame, nothing).collect())
    assert toxicity.without_toxic(frame, nothing).count() == len(rows)


def test_toxicity_against_brute_force(spark):
    docs, labels = labelled(300)
    frame = H.documents(spark, docs)
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))

    def features(text):
        out = set()
        for w in {x.strip(".,;:!?\"'()[]{}<>*#$%&|-_") for x in H.words(text)} - {""}:
            out |= {"=" + w} | {"^" + w[:n] for n in (4, 5, 6) if len(w) >= n}
        return out

    toxic = {i: y for i, _, y in labels}
    by_text = {}
    for i, t in docs:
        by_text[t] = max(by_text.get(t, 0), toxic[i])
    n, bad = len(by_text), sum(by_text.values())
    seen = Counter((f, y) for t, y in by_text.items() for f in features(t))
    want = set()
    for f in {f for f, _ in seen}:
        a, b = seen[f, 1], seen[f, 0]
        c, d = bad - a, n - bad - b
        if a + b >= 4 and n * (a * d - b * c) ** 2 >= toxicity.MIN_CHI2 * (a + b) * max(c + d, 0) * bad * (n - bad) and c + d:
            want.add(f)
    assert {f.decode() for f in model.features} == want and len(want) > 8
    weight = {f.decode(): w for f, w in zip(model.features, model.weights, strict=True)}
    for r in toxicity.score_toxicity(frame, model).collect():
        z = sum(weight.get(f, 0.0) for f in features(dict(docs)[r.doc_id]))
        p = [1 / (1 + math.exp(min(35, max(-35, t - z)))) for t in model.thetas]
        assert r.p_toxic == pytest.approx(p[0], abs=1e-9) and r.p_severe == pytest.approx(p[1], abs=1e-9)
        assert r.grade == sum(x >= 0.5 for x in p) and r.toxic == (p[0] >= 0.5)


def test_the_sample_is_bounded_by_rows_not_ids(spark):
    rows = [(7, f"text number {i}") for i in range(4000)] + [(i, "other") for i in range(100, 200)]
    labels = spark.createDataFrame([(7, 1, 1)] + [(i, 1, 0) for i in range(100, 200)], "doc_id long, quality int, toxic int")
    docs = H.documents(spark, rows)
    assert toxicity.labelled_sample(docs, labels, 2).count() <= 2
    assert toxicity.labelled_sample(docs, labels, 50).count() <= 50
    assert toxicity.labelled_sample(docs, labels, 10_000).count() == 4001
    first, second = (sorted(map(tuple, toxicity.labelled_sample(d, labels, 300).collect())) for d in (docs, docs.repartition(5)))
    assert first == second


def test_sparse_rows_multiply_as_dense_ones():
    rng = np.random.default_rng(3)
    x = (rng.random((40, 9)) < 0.3).astype(float)
    s = toxicity.SparseRows([np.flatnonzero(r).tolist() for r in x], 9)
    w, z = rng.normal(size=9), rng.normal(size=40)
    assert np.allclose(s @ w, x @ w) and np.allclose(s.T @ z, x.T @ z) and s.T.shape == (9, 40)
    grade = rng.integers(0, 3, 40)
    for a, b in zip(toxicity.fit_ordinal(x, grade), toxicity.fit_ordinal(s, grade), strict=True):
        assert np.allclose(a, b, atol=1e-4)


def test_ordinal_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    x = (rng.random((300, 6)) < 0.4).astype(np.float64)
    true = np.array([2.0, -1.0, 1.5, 0.0, 0.5, -2.0])
    u = rng.logistic(size=300)
    grade = (x @ true + u > 0.5).astype(int) + (x @ true + u > 2.0).astype(int)
    w, theta = toxicity.fit_ordinal(x, grade, l2=1e-6, steps=500)

    def likelihood(w, theta):
        s = 1 / (1 + np.exp(-(x @ w)[:, None] + theta))
        edge = np.concatenate([np.ones((300, 1)), s, np.zeros((300, 1))], axis=1)
        return np.log(edge[np.arange(300), grade] - edge[np.arange(300), grade + 1]).mean()

    best = likelihood(w, theta)
    for j in range(6):
        for d in (-0.05, 0.05):
            v = w.copy()
            v[j] += d
            assert likelihood(v, theta) < best
    for d in (-0.05, 0.05):
        assert likelihood(w, theta + np.array([d, 0])) < best and likelihood(w, theta + np.array([0, d])) < best


def test_visible_text():
    html = ('<html lang="fr"><head><title>t</title></head><body><script>var a="<p>no</p>";</script><nav>menu</nav>'
            '<!-- gone <b>gone</b> --><div class="ad">ad</div><p>Bon &amp; <b>beau</b></p>3 < 4')
    assert langid.visible_text(html).split() == ["Bon", "&", "beau", "3", "<", "4"]
    assert langid.visible_text(None) == "" and langid.visible_text("plain") == "plain"
    assert len(langid.visible_text("<" * 200_000)) <= 400_000


def test_visible_text_of_open_elements():
    def words(html):
        return langid.visible_text(html).split()

    assert words("<html><head><title>t</title><meta x><script>'<p>no'</script><body><p>Bon <b>beau</b>") == ["Bon", "beau"]
    assert words("<head><!-- a <p> b --><style>s</style><p>one<nav>menu</nav> two") == ["one", "two"]
    assert words("<head><link x>plain words</head> more") == ["plain", "words", "more"]
    for name in ("nav", "noscript", "template", "script", "style"):
        assert words(f"one <{name}> two <p>three") == ["one", "two", "three"]
        assert words(f"one <{name}> two <p></{name}>three") == ["one", "three"]
    assert words("one <div class=ad> two <p>three") == ["one", "two", "three"]
    assert words("3 < 4 and more words <p>x") == ["3", "<", "4", "and", "more", "words", "x"]
    assert words("<!doctype html><?php x?>a<!-- if b > c -->d <!-- < e --> f") == ["a", "d", "f"]


def test_language_of_pages(spark):
    docs = spark.createDataFrame([(i, " ".join(w * 20), l) for i, (w, l) in enumerate([(DOG, "en"), (CHAT, "fr")])]
                                 + [(8, None, "en"), (9, "x", None)], "doc_id long, text string, lang string")
    page = lambda w, lang="": f'<html lang="{lang}"><body><p>{" ".join(w)}</p>'
    rows = [(i, f"https://a.site.fr/{i}", page(CHAT, "fr")) for i in range(30)]
    rows += [(100 + i, f"https://b.site.uk/{i}", page(DOG, "en")) for i in range(30)]
    rows += [(200, "https://a.site.fr/x", page([], "fr")), (201, "https://b.site.uk/y", None), (202, None, page(DOG)),
             (203, "no url", ""), (204, "https://a.site.fr/z", page(DOG * 3, "en")), (0, rows[0][1], rows[0][2]), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("lang", F.lit("x"))
    got = langid.identify(pages, docs).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert all(by[i].lang == "fr" for i in range(30)) and all(by[100 + i].lang == "en" for i in range(30))
    # no text: the host, its suffix and the declared language decide; clear text overrules its host
    assert by[200].lang == "fr" and by[201].lang == "en" and by[202].lang == "en" and by[204].lang == "en"
    assert all(0 < r.probability <= 1 for r in got)
    nothing = langid.identify(pages, docs.where("lang is null"))
    assert nothing.count() == len(rows) and nothing.where("lang is not null").isEmpty()


def fused(rows, docs):
    """page_id -> probability of each language, by comparing every page with all others."""
    langs = sorted({l for _, t, l in docs if t is not None and l is not None})
    grams = {l: Counter() for l in langs}
    for _, t, l in docs:
        if t is not None and l is not None:
            grams[l].update(langid.trigrams(t.encode()).tolist())
    total = {l: sum(c.values()) + 0.5 * langid.BUCKETS for l, c in grams.items()}

    def softmax(ll):
        e = [math.exp(x - max(ll)) for x in ll]
        return [x / sum(e) for x in e]

    pages = []
    for page_id, url, html in rows:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        host = m[1].lower() if m and re.fullmatch("[A-Za-z0-9._-]+", m[1]) else ""
        t = langid.trigrams(langid.visible_text(html).encode()).tolist()
        ll = [sum(math.log((grams[l][b] + 0.5) / total[l]) for b in t) * min(1.0, langid.TEMPER / max(len(t), 1)) for l in langs]
        m = re.search(r"<html lang=\"([a-z]{2})\"", html or "")
        labels = host.split(".")
        pages.append({"id": page_id, "host": host, "site": ".".join(labels[-2:]), "suffix": labels[-1],
                      "declared": m[1] if m else "", "ll": ll, "vote": softmax(ll)})
    every = [sum(p["vote"][i] for p in pages) for i in range(len(langs))]
    out = {}
    for p in pages:
        others = lambda key: [q["vote"] for q in pages if q is not p and q[key] == p[key]]
        prior = [(x + langid.TABLE_PULL) / (sum(every) + len(langs) * langid.TABLE_PULL) for x in every]
        for key, pull in (("site", langid.SITE_PULL), ("host", langid.HOST_PULL)):
            seen = others(key)
            prior = [(sum(v[i] for v in seen) + pull * x) / (len(seen) + pull) for i, x in enumerate(prior)]
        score = [x + math.log(prior[i]) + sum(math.log((sum(v[i] for v in others(key)) + 0.5) / (every[i] + 1)) for key in ("suffix", "declared"))
                 for i, x in enumerate(p["ll"])]
        out[p["id"]] = dict(zip(langs, softmax(score), strict=True))
    return out


def test_language_against_brute_force(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices(w, k=30)), l) for i, (w, l) in enumerate([(DOG, "en"), (CHAT, "fr"), (DOG[:4] + CHAT[:4], "de")] * 4)]
    rows = [(i, f"http://{rng.choice(['a', 'b', 'c'])}.{rng.choice(['x', 'y'])}.{rng.choice(['fr', 'uk'])}/{i}",
             f'<html lang="{rng.choice(["fr", "en", ""])}"><p>{" ".join(rng.choices(DOG + CHAT, k=rng.choice([0, 1, 3, 12])))}</p>') for i in range(60)]
    rows += [(100, None, None), (101, "nothing", ""), (102, "http://A.X.FR/", None)]
    want = fused(rows, docs)
    got = langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"),
                          spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows)
    for r in got:
        best = max(want[r.page_id].values())
        assert want[r.page_id][r.lang] >= best - 1e-4 and abs(r.probability - best) < 1e-3


def test_three_hundred_languages(spark, monkeypatch):
    rng = random.Random(6)
    words = [["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(6)] for _ in range(300)]
    docs = spark.createDataFrame([(i, " ".join(w * 3), f"l{i:03d}") for i, w in enumerate(words)], "doc_id long, text string, lang string")
    langs, table = langid.train(docs)
    assert len(langs) == 300 and table.shape == (300, langid.BUCKETS)
    found = langid.trigrams(" ".join(words[299]).encode())
    assert langs[int(table[:, found].sum(axis=1).argmax())] == "l299"
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 299)
    with pytest.raises(ValueError, match="more than 299 languages"):
        langid.train(docs)


@pytest.mark.parametrize("name", ["op2_hmm", "op6_language", "op10_toxicity"])
def test_empty_tables(spark, scratch, name):
    H.documents(spark, []).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{scratch}/pages.parquet")
    assert QUERIES[name](spark, scratch).count() == 0
