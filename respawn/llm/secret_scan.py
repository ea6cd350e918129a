"""Secret scans: fixed patterns, and high-entropy strings found by a sliding window.

Patterns (leftmost, not overlapping within a kind): assigned passwords and tokens, access keys,
long hex runs. On top of them, candidate strings (long runs of base64 characters) are read
through a window of ``WINDOW`` characters for each character class. The window's Shannon
entropy is kept up by incremental counts: one character in, one out, and the sum of n log n over
the counts changes in two terms. Windows at or above the class's threshold are united to spans of
kind ``entropy``; the allow list drops what only looks random.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from math import log2

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract: kinds in order, patterns, and which group must have how many characters.
#: An access key or hex run that is too short has no part that is long enough, so there the least
#: length stands in the pattern; a hex match is always a whole run.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": (re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]{12,}"), 0, 16),
    "hex": (re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}"), 0, 32),
}
ENTROPY = "entropy"

WINDOW = 20
#: Character classes: their characters, and the entropy in bits from which a window counts.
CLASSES = {
    "hex": (re.compile(r"(?<![0-9a-fA-F])[0-9a-fA-F]{20,}"), 3.0),
    "base64": (re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"), 3.9),
}
#: What is no secret however random it looks: matched against the whole candidate.
ALLOWED = [re.compile(p) for p in (
    r"[0-9]+(?:[-_/][0-9]+)*",  # numbers, dates
    r"[a-z]+[0-9]{1,4}",  # a word with a number
    r"(.)\1*",  # one character again and again
    r"(?:0123456789|abcdefghijklmnopqrstuvwxyz|ABCDEFGHIJKLMNOPQRSTUVWXYZ|[+/])+",  # alphabets
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUIDs
    r"(?:sha256|sha384|sha512|md5)[-_=].*",  # checksums that say so
)]
#: Words, paths and slugs of letters only are allowed if their parts look like words: one case, capitals at the start
#: of parts, vowels, and no long run of consonants.
LETTERS = re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z]+)*=*")
WORDS = re.compile(r"[a-z]+|[A-Z]+|[A-Z]?[a-z]{2,}(?:[A-Z][a-z]{2,})*")
VOWELS, LEAST_VOWELS, CONSONANTS = re.compile("[aeiouyAEIOUY]"), 0.2, re.compile("[^aeiouyAEIOUY]{8}")
#: A run of an address: white space, quotes, commas, semicolons and brackets end it. Behind one of the marks a candidate belongs to the
#: address, unless it stands in the user part (name:password@).
RUN = re.compile(r"""[^\s"'`,;<>(){}\[\]]+""")
ADDRESS = re.compile(r"https?://|www\.|@")
USER_PART = re.compile(r"[^/?#@]*@")
_TERM = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """(start, end) of the matches of each kind that are long enough."""
    low = text.lower()
    hinted = {"assign": any(w in low for w in ("passw", "secret", "token", "api")), "access": "AKIA" in text}
    return {kind: [m.span() for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least] if hinted.get(kind, True) else []
            for kind, (pattern, group, least) in PATTERNS.items()}


def entropy_windows(string: str, threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """The union of the windows whose entropy is at or above the threshold."""
    if len(string) < window:
        return []
    counts: dict[str, int] = {}
    total, spans, most = 0.0, [], window * (log2(window) - threshold) + 1e-9  # entropy = log2(w) - sum(n log n) / w
    terms = _TERM if window == WINDOW else [0.0] + [n * log2(n) for n in range(1, window + 1)]
    for i, c in enumerate(string):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += terms[n + 1] - terms[n]
        if i >= window:
            old = string[i - window]
            n = counts[old]
            counts[old] = n - 1
            total += terms[n - 1] - terms[n]
        if i >= window - 1 and total <= most:
            lo = i - window + 1
            if spans and lo <= spans[-1][1]:
                spans[-1] = spans[-1][0], i + 1
            else:
                spans.append((lo, i + 1))
    return spans


def looks_like_words(string: str) -> bool:
    """Whether every part of a string of letters is a word or joined words by its case and vowels."""
    parts = re.findall("[A-Za-z]+", string)
    letters = "".join(parts)
    return (all(WORDS.fullmatch(p) for p in parts) and len(VOWELS.findall(letters)) >= LEAST_VOWELS * len(letters)
            and not any(CONSONANTS.search(p) for p in parts))


def addresses(text: str) -> list[tuple[int, int]]:
    """(start, end) of what follows the first mark of an address up to the end of its run."""
    if "@" not in text and "www." not in text and "://" not in text:
        return []
    found = ((ADDRESS.search(text, *run.span()), run.end()) for run in RUN.finditer(text))
    return [(mark.end(), end) for mark, end in found if mark]


def _allowed(text: str, lo: int, hi: int, own: list[tuple[int, int]]) -> bool:
    string = text[lo:hi]
    if any(p.fullmatch(string) for p in ALLOWED) or LETTERS.fullmatch(string) and looks_like_words(string):
        return True
    k = bisect_right(own, (lo, len(text) + 1)) - 1
    if k < 0 or lo >= own[k][1]:
        return False
    # the user part is what an "@" ends before the path begins
    return USER_PART.match(text, hi, own[k][1]) is None or "/" in text[own[k][0]:lo]


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Spans of high entropy in the candidates of all classes, those on the allow list left out."""
    found, own = set(), None
    for pattern, threshold in CLASSES.values():
        for m in pattern.finditer(text):
            own = addresses(text) if own is None else own
            if not _allowed(text, *m.span(), own):
                found.update((m.start() + a, m.start() + b) for a, b in entropy_windows(m[0], threshold))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans by start, then kind as listed; end exclusive, in code points."""
    base = base_spans(text)
    spans = [(a, k, b) for k, kind in enumerate(KINDS) for a, b in base[kind]]
    spans += [(a, len(KINDS), b) for a, b in entropy_spans(text)]
    return [((*KINDS, ENTROPY)[k], a, b) for a, k, b in sorted(spans)]


def secret_scan(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with the column ``out``: an array of (kind, start, end) for the whole text.

    All rows and columns stay (a column named ``out`` is replaced); repeated rows are scanned alike. Null and
    empty texts have none, very long texts are scanned whole, an empty table gives no rows. Entropy spans may
    overlap the others; those stay as they are.
    """
    @F.pandas_udf("array<struct<kind: string, start: int, end: int>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)] if t else [] for t in texts.tolist()], dtype=object)

    return docs.withColumn(out, run.asNondeterministic()(F.col(text_col)))  # evaluated once for all uses


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans are replaced as one."""
    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in batches:
            out = []
            for t, own in zip(texts.tolist(), spans.tolist()):
                at, parts = 0, []
                for a, b in sorted((s["start"], s["end"]) for s in (own if own is not None else [])):
                    if a >= at:
                        parts += [t[at:a], mark]
                    at = max(at, b)
                out.append(t if t is None or not parts else "".join(parts) + t[at:])
            yield pd.Series(out, dtype=object)

    return docs.withColumn(text_col, run(F.col(text_col), F.col(spans_col)))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (id_col, n_assign, n_access, n_hex, base_sha256, spans).

    Other columns aren't read, whatever their names; otherwise the cases of ``secret_scan`` hold.
    """
    rows = secret_scan(docs.select(id_col, text_col), text_col)
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"] != ENTROPY)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(id_col, *(count(k) for k in KINDS), F.sha2(named(base), 256).alias("base_sha256"), named(F.col("secrets")).alias("spans"))
