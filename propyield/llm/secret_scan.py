"""Secrets in text: assigned values, access keys, hex strings and high-entropy strings.

Candidates are strings found by pattern. A sliding window then moves over each long
candidate; the counts of its characters are updated as one enters and one leaves,
so its Shannon entropy (per character class: hex, base 64) costs O(1) a step. Windows
over the class's threshold join into an ``entropy`` span; of a span that holds a string
of the allow list, windows that touch that string do not count.

Kinds, in the order that breaks ties: ``assign access hex`` (base) and ``entropy``.
Offsets count code points, ends exclusive. A null text has no spans, an empty table
gives an empty result, equal rows give equal rows, extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from propyield.llm.common import map_batches, span_digest

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")
_ORDER = {k: i for i, k in enumerate(KINDS)}

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""",
    re.IGNORECASE | re.ASCII)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}+")
_LONG = re.compile(r"[A-Za-z0-9+/_=-]{16,}+")
_HEX = re.compile(r"[0-9a-f]{16,}+")

#: Window length and the entropy (bits) a window must reach, by character class.
WINDOW = 20
THRESHOLDS = {"hex": 3.0, "base64": 3.6}
_CLASS = {"hex": re.compile(r"[0-9a-fA-F]{20,}+"), "base64": re.compile(r"[A-Za-z0-9+/_=-]{20,}+")}

#: Strings that look random but are not secrets (fixed values).
ALLOW = ("0123456789abcdef", "abcdefghijklmnop", "ABCDEFGHIJKLMNOP", "EXAMPLE", "example",
         "placeholder", "xxxxxxxx", "XXXXXXXX", "deadbeef")
_ALLOW = re.compile(f"(?=({'|'.join(ALLOW)}))")


def _bits(total: float, n: int) -> float:
    return math.log2(n) - total / n


def _clogc(c: int) -> float:
    return c * math.log2(c) if c else 0.0


def hot_windows(s: str, window: int = WINDOW, threshold: float = 3.6) -> list[tuple[int, int]]:
    """Joined stretches of ``s`` covered by windows whose entropy reaches ``threshold``."""
    if len(s) < window:
        return []
    counts: dict[str, int] = {}
    total = 0.0  # sum of c * log2(c) over the window's characters
    out: list[list[int]] = []
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += _clogc(n + 1) - _clogc(n)
        counts[c] = n + 1
        if i >= window:
            old = s[i - window]
            n = counts[old]
            total += _clogc(n - 1) - _clogc(n)
            counts[old] = n - 1
        if i >= window - 1 and _bits(total, window) >= threshold - 1e-9:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1][1] = i + 1
            else:
                out.append([start, i + 1])
    return [(a, b) for a, b in out]


def _mixed(s: str) -> bool:
    """At least a digit and a letter: plain words are never random strings."""
    return any(c.isdigit() for c in s) and any(c.isalpha() for c in s)


def _unlisted(s: str, threshold: float) -> list[tuple[int, int]]:
    """What is left of the hot stretch ``s`` without windows that touch the allow list.

    A listed string goes on over the letters or digits that follow it in order.
    """
    if not any(a in s for a in ALLOW):
        return [(0, len(s))]
    out, at = [], 0
    for m in [*_ALLOW.finditer(s), None]:
        out += [(at + a, at + b) for a, b in hot_windows(s[at:m.start() if m else None], WINDOW, threshold)]
        if m:
            end = m.end(1)
            while end < len(s) and ord(s[end]) == ord(s[end - 1]) + 1:
                end += 1
            at = max(at, end)
    return out


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of one text, by start, then kind as listed."""
    if not text:
        return []
    spans: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        spans += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    for m in _LONG.finditer(text):
        spans += [("hex", h.start(), h.end()) for h in _HEX.finditer(text, m.start(), m.end())]
        stretches = set()
        for name, shape in _CLASS.items():
            for c in shape.finditer(text, m.start(), m.end()):
                if _mixed(c[0]):
                    stretches |= {(c.start() + a + x, c.start() + a + y)
                                  for a, b in hot_windows(c[0], WINDOW, THRESHOLDS[name])
                                  for x, y in _unlisted(c[0][a:b], THRESHOLDS[name])}
        end = -1
        for a, b in sorted(stretches, key=lambda x: (x[0], -x[1])):
            if b > end and _mixed(text[a:b]):
                spans.append(("entropy", a, b))
                end = b
    return sorted(spans, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and its spans ``array<struct<kind,start,end,value>>``."""
    def fn(ids, texts):
        return {"doc_id": ids, "spans": [
            [{"kind": k, "start": a, "end": b, "value": t[a:b]} for k, a, b in find_secrets(t)]
            for t in texts]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(f"`{id_col}`", f"`{text_col}`"), fn,
                       f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int,value:string>>")


def secret_report(docs: DataFrame) -> DataFrame:
    """The digest of ``secret_spans``: counts of the base kinds, their hash, all spans."""
    return span_digest(secret_spans(docs), BASE_KINDS)
