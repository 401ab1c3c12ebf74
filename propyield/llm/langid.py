"""Language of web pages by fusing Bayesian evidence.

For each page and language l:

    log P(l | page) ~ temper * log P(text | l) + log P(declared | l)
                      + log P(suffix | l) + log P_host(l)

* text: hashed byte trigrams, counted over all labelled documents per language;
* declared: the ``lang`` attribute of the html tag, P(declared | l) counted over all
  pages against the language that the text alone suggests;
* suffix: the last label of the host name, counted in the same way;
* host: prior of the host's languages, smoothed towards its site (last two labels),
  which is smoothed towards the prior over all pages. A page's own vote is taken out
  of the counts it meets, so no page confirms itself.

All counts are grouped aggregations (a hot host is summed within tasks first); what
returns to the pages is joined by host, site, suffix or declared language.

Defined cases: null or empty html has no text evidence and is judged by the rest; a
null or broken url has no host (""), its suffix is ""; a missing attribute is "";
with no labelled documents there is no language and ``lang`` is null; equal rows give
equal rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propyield.llm.common import map_batches
from propyield.session import scratch_path

#: Hash buckets of byte trigrams: the model holds this many counts per language.
BUCKETS = 1 << 15
#: Languages of the model, at most (a bound for the broadcast); more labels are an error.
MAX_LANGUAGES = 512
#: Trigrams of a text count as this many independent ones at most.
TEMPER = 60.0
#: Pseudo-counts that pull a host to its site, and a site to all pages.
HOST_PULL, SITE_PULL, TABLE_PULL = 8.0, 20.0, 1.0

_LANG = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})(?![A-Za-z])", re.IGNORECASE)
_HIDDEN = {"script", "style", "nav", "noscript", "template"}
#: Tags that leave a head open; any other one, or text of its own, ends it.
_IN_HEAD = {"", "!--", "head", "html"} | {
    end + x for end in ("", "/") for x in ("title", "meta", "link", "base", "script", "style", "noscript", "template")}
_VOID = re.compile(r"\bclass\s*=\s*[\"']?ad\b")
_NAME = re.compile(r"/?[A-Za-z][A-Za-z0-9]*|!--")


def _name(piece: str) -> str | None:
    """The tag that opens ``piece``: "" for other markup, None if the piece is text."""
    m = _NAME.match(piece)
    return m[0].lower() if m else "" if piece.startswith(("!", "/", "?")) else None


def visible_text(html: str | None) -> str:
    """The text of a page without tags, scripts, styles, head, navigation and ads.

    A head ends at its end tag, at the first tag that no head holds or at text of its own.
    Other elements are hidden only if their end tag follows somewhere; a ``<`` that opens
    no tag is text. Each piece of the page is looked at twice.
    """
    if not html:
        return ""
    pieces = html.split("<")
    names = [None, *map(_name, pieces[1:])]
    last = {n: i for i, n in enumerate(names) if n and n[0] == "/"}
    out, until, head = [], None, False
    for i, (piece, name) in enumerate(zip(pieces, names, strict=True)):
        tag, closed, text = piece.partition(">")
        if until == "-->" or (until is None and name == "!--"):
            _, closed, text = piece.partition("-->")
            until = None if closed else "-->"
        elif until is not None:
            if name != until:
                continue
            until = None
        elif name is None:
            closed, text = "<", "<" * (i > 0) + piece
        else:
            head = name == "head" or (head and name in _IN_HEAD)
            hides = name in _HIDDEN or (head and name == "title") or (name == "div" and _VOID.search(tag))
            if hides and last.get("/" + name, 0) > i:
                until = "/" + name
        if until is None and closed and not (head and not text.strip()):
            head = False
            out.append(text)
    return unescape(" ".join(out))


def trigrams(text: bytes) -> np.ndarray:
    """The bucket of each byte trigram of lower-cased, space-framed text."""
    b = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, dtype=np.int64)
    h = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((h * np.uint32(2654435761)) >> np.uint32(32 - 15)).astype(np.int64)


def language_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, bucket, n: byte trigrams of all labelled documents."""
    rows = (docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("text"))
            .where("lang is not null and text is not null"))

    def fn(langs, texts):
        counts: dict[str, np.ndarray] = {}
        for lang, text in zip(langs, texts, strict=True):
            if lang not in counts:
                counts[lang] = np.zeros(BUCKETS, dtype=np.int64)
            counts[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        out = {"lang": [], "bucket": [], "n": []}
        for lang, c in counts.items():
            hit = np.flatnonzero(c)
            out["lang"] += [lang] * len(hit)
            out["bucket"] += hit.tolist()
            out["n"] += c[hit].tolist()
        return out

    return map_batches(rows, fn, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages and log P(bucket | language): 32768 numbers for each language."""
    spark = docs.sparkSession
    path = scratch_path(spark, "language-counts")
    language_counts(docs).write.parquet(path)
    counts = spark.read.parquet(path)
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are labelled; clean the labels or raise MAX_LANGUAGES")
    table = np.full((len(langs), BUCKETS), 0.5, dtype=np.float32)
    if langs:
        got = counts.toArrow()
        row = {x: i for i, x in enumerate(langs)}
        table[[row[x] for x in got["lang"].to_pylist()], got["bucket"].to_numpy()] += got["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=1, dtype=np.float64, keepdims=True)).astype(np.float32)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host.rlike(r"^[a-z0-9._-]+$"), host).otherwise(F.lit(""))


def page_evidence(pages: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """page_id, host, site, suffix, declared, ll (log-likelihood by language), vote."""
    spread = pages.sparkSession.sparkContext.broadcast(table)

    def fn(ids, hosts, htmls):
        model = spread.value
        declared, lls, votes = [], [], []
        for html in htmls:
            m = _LANG.search(html or "")
            declared.append(m[1].lower() if m else "")
            t = trigrams(visible_text(html).encode("utf-8", "replace"))
            if len(t) and len(langs):
                ll = model[:, t].sum(axis=1, dtype=np.float64) * (min(1.0, TEMPER / len(t)))
                ll = ll - ll.max()
            else:
                ll = np.zeros(len(langs))
            lls.append(ll.tolist())
            p = np.exp(ll)
            votes.append((p / p.sum()).tolist() if len(p) else [])
        return {"page_id": ids, "host": hosts, "declared": declared, "ll": lls, "vote": votes}

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = map_batches(pages.select("page_id", host_of(F.col("url")).alias("host"), "html"), fn,
                       f"page_id {kind}, host string, declared string, ll array<double>, vote array<double>")
    labels = F.split("host", r"\.")
    return (rows.withColumn("suffix", F.element_at(labels, -1))
            .withColumn("site", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, probability, text_lang, declared, host, suffix for every page."""
    spark = pages.sparkSession
    langs, table = train(docs)
    if not langs:
        return page_evidence(pages, langs, table).select(
            "page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
            F.lit(None).cast("string").alias("text_lang"), "declared", "host", "suffix")
    # the pages are read once; what follows needs only these narrow rows
    path = scratch_path(spark, "page-evidence")
    page_evidence(pages, langs, table).write.parquet(path)
    ev = spark.read.parquet(path)
    n = len(langs)

    def votes(key: str) -> DataFrame:
        sums = F.array(*[F.sum(F.col("vote")[i]) for i in range(n)])
        return ev.groupBy(key).agg(sums.alias(f"{key}_votes"))

    whole = ev.agg(F.array(*[F.coalesce(F.sum(F.col("vote")[i]), F.lit(0.0)) for i in range(n)]).alias("v")).first()["v"]
    total = F.array(*[F.lit(float(x)) for x in whole])
    joined = ev
    for key in ("host", "site", "suffix", "declared"):
        joined = joined.join(votes(key), key)
    at = lambda c, i: F.get(F.col(c), i)
    rest = lambda c, i: F.greatest(F.lit(0.0), at(c, i) - at("vote", i))  # noqa: E731  without the page's own vote

    def smoothed(counts: str, parent: Column, pull: float) -> Column:
        size = F.aggregate(F.col(counts), F.lit(0.0), lambda a, x: a + x) - 1.0
        return F.transform(parent, lambda p, i: (rest(counts, i) + pull * p) / (F.greatest(size, F.lit(0.0)) + pull))

    everything = float(sum(whole))
    table_prior = F.transform(total, lambda x: (x + TABLE_PULL) / (everything + n * TABLE_PULL))
    step = joined.withColumn("p_table", table_prior)
    step = step.withColumn("p_site", smoothed("site_votes", F.col("p_table"), SITE_PULL))
    step = step.withColumn("p_host", smoothed("host_votes", F.col("p_site"), HOST_PULL))

    def given(counts: str, i: Column) -> Column:
        # P(value | language) = pages of the language with the value / pages of the language
        return F.log((rest(counts, i) + 0.5) / (F.get(total, i) + 1.0))

    fused = F.transform(F.col("ll"), lambda x, i: x + F.log(at("p_host", i)) + given("suffix_votes", i) + given("declared_votes", i))
    step = step.withColumn("s", fused)
    step = step.withColumn("e", F.transform("s", lambda x: F.exp(x - F.array_max("s"))))
    names = F.array(*[F.lit(x) for x in langs])
    first = lambda c: F.get(names, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    return step.select(
        "page_id", first(F.col("s")).alias("lang"),
        (F.lit(1.0) / F.aggregate("e", F.lit(0.0), lambda a, x: a + x)).alias("probability"),
        first(F.col("ll")).alias("text_lang"), "declared", "host", "suffix")
