"""Language ID: scripts narrow the candidates, word scores and a Viterbi path label spans.

A word is a run of letters, lower-cased. Its score for a language is the log-likelihood of its
features (the word itself and its letter trigrams, with word ends) under that language's smoothed
counts. The script of its first letter narrows the candidates: languages never seen in that
script pay ``OTHER_SCRIPT``; a script that no language was seen in says nothing.
The Viterbi path over all words of a text, paying ``SWITCH`` for each change of language, cuts
the text into spans. The language with the most letters on the path is the text's language.

Counts are learned on at most ``SAMPLE`` documents of each language (those of the smallest id
hashes); every text is labelled whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respawn.llm.common import others, slices

SAMPLE = 3000
BUCKETS = 1 << 17
SMOOTH = 0.3
SWITCH = 12.0
OTHER_SCRIPT = 25.0
#: A script counts for a language from this share of its words on.
SCRIPT_SHARE = 0.005
UNKNOWN = "und"
#: Languages of a model, at most: it holds BUCKETS numbers for each, is fitted on the driver and broadcast.
LANGUAGES = 128
#: Words whose scores a Python worker remembers, and characters and words labelled at once.
MEMORY = 1 << 18
SLICE = 1 << 22
BLOCK = 1 << 19

#: First code points of Unicode script ranges, in order, and the scripts.
RANGES = [(0x0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"),
          (0x700, "Other"), (0x900, "Devanagari"), (0x980, "Bengali"), (0xA00, "Gurmukhi"), (0xA80, "Gujarati"), (0xB00, "Oriya"),
          (0xB80, "Tamil"), (0xC00, "Telugu"), (0xC80, "Kannada"), (0xD00, "Malayalam"), (0xD80, "Sinhala"), (0xE00, "Thai"),
          (0xE80, "Lao"), (0xF00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
          (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x1900, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
          (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0xA000, "Other"),
          (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"),
          (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF00, "Latin"),
          (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"), (0x32000, "Other")]
SCRIPTS = sorted({name for _, name in RANGES})
_STARTS = np.array([start for start, _ in RANGES])
_SCRIPT = np.array([SCRIPTS.index(name) for _, name in RANGES])
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The lower-case words: runs of letters; number signs and letter numbers, which the pattern takes too, part them."""
    found = _WORD.findall(text.lower())
    return found if all(map(str.isalpha, found)) else [w for _, w in _placed(text)]


def _placed(text: str) -> list[tuple[int, str]]:
    """(start, word) of the words of a text."""
    out = []
    for m in _WORD.finditer(text.lower()):
        if m[0].isalpha():
            out.append((m.start(), m[0]))
            continue
        letters = "".join(c if c.isalpha() else " " for c in m[0])
        out += [(m.start() + w.start(), w[0]) for w in re.finditer(r"\S+", letters)]
    return out


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of the words, one after the other, and where each word's begin."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    code = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes + 2)
    tri = (code[:-2] * np.uint64(0x9E3779B1) + code[1:-1]) * np.uint64(0x85EBCA77) + code[2:]
    tri = tri[(code[:-2] != 3) & (code[1:-1] != 3)]
    # the whole word: a polynomial of its letters
    place = np.arange(len(code)) - np.repeat(ends - sizes - 2, sizes + 2)
    whole = np.add.reduceat((code + np.uint64(31)) * _powers(int(place.max()) + 1)[place], ends - sizes - 2)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    out = np.empty(int(sizes.sum()) + len(words), dtype=np.uint64)
    first = np.zeros(len(out), dtype=bool)
    first[starts] = True
    out[first], out[~first] = whole, tri
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((out >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64), starts


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, 0x100000001B3, dtype=np.uint64))


def _scripts(words: list[str]) -> np.ndarray:
    return _SCRIPT[np.searchsorted(_STARTS, np.fromiter((ord(w[0]) for w in words), dtype=np.int64, count=len(words)), "right") - 1]


class Model:
    """Log-probabilities (bucket, language) and which scripts each language is written in."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=0, keepdims=True)
        self.table = np.log((counts + SMOOTH) / (total + SMOOTH * len(counts))).astype(np.float32)
        seen = scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(axis=0, keepdims=True))
        self.seen = seen | ~seen.any(axis=1, keepdims=True)
        self.known = seen.any(axis=1)
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.langs)), dtype=np.float32)

    def indexes(self, words: list[str]) -> np.ndarray:
        """Rows of ``self.scores`` for the words, scoring those not met before."""
        if len(self.at) > MEMORY:
            self._forget()
        if new := list(set(words).difference(self.at)):
            buckets, starts = _features(new)
            scripts = _scripts(new)
            own = np.add.reduceat(self.table[buckets], starts, axis=0)
            own = own * self.known[scripts, None] - OTHER_SCRIPT * ~self.seen[scripts]
            own -= own.max(axis=1, keepdims=True)
            self.at.update(zip(new, range(len(self.scores), len(self.scores) + len(new))))
            self.scores = np.concatenate([self.scores, own])
        return np.fromiter(map(self.at.__getitem__, words), dtype=np.int64, count=len(words))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from rows with id, text and language; about ``sample`` documents a language at most.

    Documents of a language are taken by the hash of their id: below sample / n of its range, n the language's
    (approximate) number of distinct ids. Rows that repeat an id count once, with the smallest text. The ``LANGUAGES`` languages of most
    documents are learned (ties by name), of those only the ones that have a word; without any, all texts are ``und``.
    """
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.xxhash64(id_col).alias("h"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("body"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.01).alias("n"))
    cut = sizes.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()  # one row a language
    if not cut:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS), 0)))
    upto = F.create_map(*(F.lit(x) for r in cut for x in (r["lang"], min(1.0, sample / max(1, r["n"])))))
    place = F.pmod(F.col("h"), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                if words := [w for text in part["body"] for w in words_of(text)]:
                    n = np.bincount(_features(words)[0], minlength=BUCKETS)
                    s = np.bincount(_scripts(words), minlength=len(SCRIPTS))
                    both = np.concatenate([n, s])
                    at = np.flatnonzero(both)
                    yield pd.DataFrame({"lang": lang, "bucket": at, "n": both[at]})

    drawn = rows.where(place < F.try_element_at(upto, F.col("lang"))).groupBy("lang", "h").agg(F.min("body").alias("body")).select("lang", "body")
    found = drawn.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(found["lang"]))
    both = np.zeros((BUCKETS + len(SCRIPTS), len(langs)))  # BUCKETS + scripts numbers a language
    both[found["bucket"].to_numpy(dtype=np.int64), found["lang"].map(langs.index).to_numpy(dtype=np.int64)] = found["n"]
    return Model(langs, both[:BUCKETS], both[BUCKETS:])


def viterbi(emissions: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word; texts of ``sizes`` words lie one after the other.

    All texts advance together, longest first. Ties stay with the current language, then go to
    the first.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    running = len(sizes) - np.searchsorted(sizes[::-1], np.arange(int(sizes[0])), "right")  # texts with a word t
    come = np.empty((len(emissions), emissions.shape[1]), dtype=bool)
    source = np.zeros(len(emissions), dtype=np.int8 if emissions.shape[1] < 128 else np.int32)
    v = emissions[starts].astype(np.float64)
    for t in range(1, len(running)):
        n = running[t]
        at, now = starts[:n] + t, v[:n]
        source[at] = best = now.argmax(axis=1)
        other = now[np.arange(n), best][:, None] - switch
        come[at] = moved = now < other
        v[:n] = np.where(moved, other, now) + emissions[at]
    labels = np.empty(len(emissions), dtype=np.int64)
    state = v.argmax(axis=1)
    for t in range(len(running) - 1, -1, -1):
        n = running[t]
        at = starts[:n] + t
        labels[at] = state[:n]
        if t:
            state[:n] = np.where(come[at, state[:n]], source[at], state[:n])
    return labels


def label(model: Model, texts: list[str]) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """(language, share of the letters, spans (language, start, end)) of each text.

    The spans cover the text; a span begins where its first word begins.
    """
    out: list = []
    for part in slices(texts, SLICE):  # bounds the words held at once
        out += _label(model, texts[part])
    return out


def _label(model: Model, texts: list[str]) -> list:
    out: list = [(UNKNOWN, 0.0, [])] * len(texts)
    if not model.langs:
        return out
    words = [words_of(t) for t in texts]
    todo = sorted((i for i in range(len(texts)) if words[i]), key=lambda i: len(words[i]))
    while todo:
        block, held = [], 0
        while todo and (not block or held + len(words[todo[-1]]) <= BLOCK):
            held += len(words[todo[-1]])
            block.append(todo.pop())
        flat = [w for i in block for w in words[i]]
        sizes = np.array([len(words[i]) for i in block])
        at = model.indexes(flat)
        labels = viterbi(model.scores[at], sizes)
        letters = np.fromiter(map(len, flat), dtype=np.float64, count=len(flat))
        ends = np.cumsum(sizes)
        k = len(model.langs)
        share = np.bincount(np.repeat(np.arange(len(block)), sizes) * k + labels, letters, len(block) * k).reshape(-1, k)
        share /= share.sum(axis=1, keepdims=True)
        for i, lo, hi, own in zip(block, ends - sizes, ends, share):
            path = labels[lo:hi]
            cuts = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist()]
            if len(cuts) > 1:
                places = [start for start, _ in _placed(texts[i])]
                edges = [0, *(min(places[c], len(texts[i])) for c in cuts[1:]), len(texts[i])]
            else:
                edges = [0, len(texts[i])]
            best = int(own.argmax())
            out[i] = model.langs[best], float(own[best]), [(model.langs[path[c]], a, b) for c, a, b in zip(cuts, edges, edges[1:])]
    return out


def identify(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and lang_spans (language, start, end in code points).

    ``prefix`` is put before the new names; columns that already have those names are replaced.

    ``und`` with score 0 and no spans for null texts, texts without a letter, and if nothing was
    learned. Ties go to the language first in order. All rows and columns stay; the text alone
    decides. A word of a few letters seldom outweighs the switching penalty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers a language

    names = [f"{prefix}{c}" for c in ("lang_pred", "score", "lang_spans")]

    @F.pandas_udf("pred string, score double, spans array<struct<lang: string, start: int, end: int>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = label(shared.value, [t or "" for t in texts.tolist()])
        return pd.DataFrame({"pred": [x[0] for x in found], "score": [x[1] for x in found],
                             "spans": [[dict(zip(("lang", "start", "end"), s)) for s in x[2]] for x in found]})

    once = run.asNondeterministic()  # so that a filter on the result doesn't run it again
    named = docs.withColumn("__lang_id", once(F.col(text_col)))
    fields = ("pred", "score", "spans")
    return named.select(*others(docs, *names), *(F.col("__lang_id")[f].alias(n) for f, n in zip(fields, names)))


def held_out(id_col: str = "doc_id"):
    """True for the ids that training leaves out; null ids count as not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", prefix: str = "") -> DataFrame:
    """Learn from the labelled rows that aren't held out, then ``identify`` all rows.

    Rows with a null id aren't learned from.
    """
    known = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
    found = identify(docs, fit(known, id_col, text_col, lang_col), text_col, prefix)
    return found.withColumn(f"{prefix}held_out", held_out(id_col))
