"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, digit
cues (two digits with at most one space or hyphen between, a dot and a digit, a
plus and a digit), URL schemes and words that announce an account number. Each
anchor is handed to the deterministic local parser of its kind, which expands to
the left and right over the characters that kind may hold, never back over an
earlier span of the kind, and validates what it found (octets, Luhn, IBAN).

Kinds, in the order that breaks ties of equal starts: ``email ip card phone``
(the base kinds) and ``url account``. Offsets count code points, ends exclusive.
Every parser is linear in the text, so very long texts and long runs are safe.

Defined cases: a null text has no spans; an empty table gives an empty result;
equal rows give equal rows; extra columns are ignored by ``pii_spans`` and kept by
``mask_pii``.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from propyield.llm.common import fresh, map_batches, span_digest

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
_ORDER = {k: i for i, k in enumerate(KINDS)}

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_SCHEME = frozenset(string.ascii_letters + string.digits + "+.-")
_DIGITS = frozenset(string.digits)
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL_REST = re.compile(r"[A-Za-z0-9._~:/?#@!$&'()*+,;=%\[\]-]++")
_ACCOUNT = re.compile(r"[\x20]?(?:no|nr|number)?[.:#\x20]{0,3}((?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|[0-9]{8,17})(?![A-Za-z0-9]))")

#: Words before an account number, each found in lower, upper and title case.
ACCOUNT_CUES = ("account", "acct", "iban", "konto", "compte", "cuenta")


_BUILT: list = []  # the automaton, made once in each Python worker


def _automaton():
    if _BUILT:
        return _BUILT[0]
    import ahocorasick

    a = ahocorasick.Automaton()
    digits = string.digits
    for sep in ("", " ", "-"):
        for x, y in product(digits, digits):
            a.add_word(x + sep + y, ("card", len(sep) + 2))
    for x in digits:
        a.add_word("." + x, ("ip", 2))
        a.add_word("+" + x, ("phone", 2))
    a.add_word("@", ("email", 1))
    a.add_word("://", ("url", 3))
    for cue in ACCOUNT_CUES:
        for form in {cue, cue.upper(), cue.title()}:
            a.add_word(form, ("account", len(form)))
    a.make_automaton()
    _BUILT.append(a)
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def iban(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _back(text: str, at: int, floor: int, allowed: frozenset) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of one text, by start, then kind as listed."""
    if not text:
        return []
    spans: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)  # the end of what each kind has consumed
    for last, (kind, width) in _automaton().iter(text):
        at, floor = last - width + 1, done[kind]
        if at < floor:
            continue
        if kind == "email":
            start = _back(text, at, floor, _LOCAL)
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                spans.append((kind, start, m.end()))
                done[kind] = m.end()
        elif kind == "ip":
            start = _back(text, at, floor, _DIGITS)
            if start < at and (m := _IP.match(text, start)):
                done[kind] = m.end()
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                    spans.append((kind, start, m.end()))
        elif kind == "card":
            m = _CARD.match(text, at)
            done[kind] = m.end()
            number = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(number) <= 19 and luhn(number):
                spans.append((kind, at, m.end()))
        elif kind == "phone":
            if m := _PHONE.match(text, at):
                done[kind] = m.end()
                if 10 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    spans.append((kind, at, m.end()))
        elif kind == "url":
            start = _back(text, at, floor, _SCHEME)
            while start < at and not text[start].isalpha():
                start += 1
            m = _URL_REST.match(text, last + 1)
            if start < at and m:
                end = m.end()
                while end > last + 1 and text[end - 1] in ".,;:!?)'":
                    end -= 1
                done[kind] = m.end()
                if end > last + 1:
                    spans.append((kind, start, end))
        elif m := _ACCOUNT.match(text, last + 1):
            done[kind] = m.end()
            if m[1][0] in _DIGITS or iban(m[1]):
                spans.append((kind, m.start(1), m.end(1)))
    return sorted(spans, key=lambda s: (s[1], _ORDER[s[0]]))


def mask_text(text: str | None) -> str | None:
    """``text`` with every span (joined where they overlap) replaced by ``<KIND>``."""
    spans = find_spans(text)
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and its spans ``array<struct<kind,start,end,value>>``."""
    def fn(ids, texts):
        return {"doc_id": ids, "spans": [
            [{"kind": k, "start": a, "end": b, "value": t[a:b]} for k, a, b in find_spans(t)]
            for t in texts]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(f"`{id_col}`", f"`{text_col}`"), fn,
                       f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int,value:string>>")


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` masked; all other columns unchanged."""

    @pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(mask_text, na_action="ignore")

    name = fresh("masked")
    return (docs.withColumn(name, masked(F.col(f"`{text_col}`")))
            .select(*[(F.col(name) if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns]))


def pii_report(docs: DataFrame) -> DataFrame:
    """The digest of ``pii_spans``: counts of the base kinds, their hash, all spans."""
    return span_digest(pii_spans(docs), BASE_KINDS)
