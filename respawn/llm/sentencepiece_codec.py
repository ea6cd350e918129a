"""SentencePiece BPE encoding by suffix-array matching, and decoding.

Encoding: spaces become U+2581 and one is put in front. No piece continues past a word (a run of
U+2581 only begins one), so texts fall into words and a batch needs each distinct word once:

1. The batch's new words are concatenated, with separators, into one indexed text.
2. Its suffix array is sorted by as many characters as the longest piece has (packed into 64-bit keys).
3. Every piece of the vocabulary is binary-searched for the range of suffixes it starts.
4. Each occurrence is an edge (start, end, piece); the edges are sorted by their end's position.
5. Relaxation from left to right, all words in step: an edge is kept if its start is reached and
   the last piece there may stand before this one, that is, if merging the two side by side
   by rank leaves them as they are. Exactly one piece survives at each position, and the path
   back from the end of a word is its BPE encoding. Characters of no piece become byte pieces.

Runs of spaces have pieces that all rank last; they are filled from the left.
The model file is read with the installed library; nothing else of it is used.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respawn.llm.common import others, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters indexed at once, and words a Python worker remembers.
BLOCK = 1 << 18
MEMORY = 1 << 19


class Vocabulary:
    """The pieces of a BPE model with byte fallback, and its suffix-array matcher."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        text = {i: model.id_to_piece(i) for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.runs = {len(p): i for i, p in text.items() if set(p) == {SPACE}}
        self.raw = [b""] * len(ids)  # what each id stands for
        for i, piece in text.items():
            self.raw[i] = piece.encode().replace(SPACE.encode(), b" ")
        for b, i in self.bytes.items():
            self.raw[i] = bytes([b])
        self.score = {i: model.get_score(i) for i in text}
        self.id = {p: i for i, p in text.items()}
        self._rank_pieces({i: p for i, p in text.items() if set(p) != {SPACE} or len(p) == 1})
        self._pack_pieces()
        self._forget()
        self.splitter = re.compile(" *[^ \n]+| +|\n" if "\n" not in self.letters else " *[^ ]+| +")

    # -- what merging does to two neighbours ------------------------------------------------

    def _rank_pieces(self, text: dict[int, str]) -> None:
        """Ranks (0 merges first) and, for each piece that merging yields, its last merge."""
        order = sorted(text, key=lambda i: (-self.score[i], i))
        self.rank = np.full(max(text) + 1, len(order) + 1, dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        for i, p in text.items():
            if len(p) == 1:
                self.rank[i] = -1
        self.left, self.right = (np.full(max(text) + 1, -1, dtype=np.int64) for _ in range(2))
        pairs, self.pieces = [], []
        for i in order:
            p = text[i]
            halves = [(a, b, i) for n in range(1, len(p)) if (a := self.id.get(p[:n])) in text and (b := self.id.get(p[n:])) in text]
            pairs += halves
            if len(p) == 1:
                self.pieces.append(i)
            elif (last := self._merge(p)) is not None:
                self.left[i], self.right[i] = last
                self.pieces.append(i)
        pairs = np.array(sorted((a << 32 | b, c) for a, b, c in pairs), dtype=np.int64)
        self.pair, self.joined = pairs[:, 0].copy(), pairs[:, 1].copy()

    def _merge(self, piece: str) -> tuple[int, int] | None:
        """The last two parts that merge into the piece; None if merging doesn't yield it."""
        parts = list(piece)
        while len(parts) > 2:
            found = [(self.rank[i], n) for n in range(len(parts) - 1) if (i := self.id.get(parts[n] + parts[n + 1])) is not None and i < len(self.rank)]
            if not found:
                return None
            n = min(found)[1]
            parts[n:n + 2] = [parts[n] + parts[n + 1]]
        both = tuple(self.id.get(p) for p in parts)
        return None if None in both else both

    def beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the letters of pieces a and b side by side leaves exactly a, b.

        Looks at the two ends that touch as they grow: undoing the later of the two last merges
        gives the pair that touched just before it. If some such pair could merge ahead of the
        merge that changed it, the border would have gone.
        """
        a, b = a.copy(), b.copy()
        good, todo = np.ones(len(a), dtype=bool), np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max)  # the merge that ended this pair
        strict = np.zeros(len(a), dtype=bool)  # the right side's merge loses a tie to the border on its left
        while len(todo):
            x, y = a[todo], b[todo]
            key = x << 32 | y
            at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            rank = np.where(self.pair[at] == key, self.rank[self.joined[at]], np.iinfo(np.int64).max)
            lost = (rank < limit[todo]) | ((rank == limit[todo]) & strict[todo])
            good[todo[lost]] = False
            # undo the later merge; on equal ranks the right one, which happened second
            rx, ry = self.rank[x], self.rank[y]
            undo_left = rx > ry
            more = ~lost & ((rx >= 0) | (ry >= 0))
            lx, ly = todo[more & undo_left], todo[more & ~undo_left]
            limit[lx], strict[lx] = self.rank[a[lx]], False
            a[lx] = self.right[a[lx]]
            limit[ly], strict[ly] = self.rank[b[ly]], True
            b[ly] = self.left[b[ly]]
            todo = todo[more]
        return good

    # -- suffix-array matching --------------------------------------------------------------

    def _pack_pieces(self) -> None:
        text = [self.raw[i].decode() for i in self.pieces]
        self.letters = {c: n for n, c in enumerate(sorted(set("".join(text))), 1)}
        self.pieces, self.size = np.array(self.pieces, dtype=np.int32), np.array([len(t) for t in text], dtype=np.int32)
        self.longest = int(self.size.max())
        self.spelled = np.zeros((len(text), self.longest), dtype=np.uint16)
        for n, t in enumerate(text):
            self.spelled[n, :len(t)] = [self.letters[c] for c in t]
        self.codes = np.zeros(0x110000, dtype=np.uint16)
        self.codes[[ord(c) for c in self.letters]] = list(self.letters.values())

    @staticmethod
    def _bound(keys: list[np.ndarray], goal: list[np.ndarray], right: bool) -> np.ndarray:
        """Binary search of all goals at once in rows sorted by the keys."""
        lo, hi = np.zeros(len(goal[0]), dtype=np.int64), np.full(len(goal[0]), len(keys[0]))
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            at = np.minimum(mid, len(keys[0]) - 1)
            less, same = np.zeros(len(at), dtype=bool), np.ones(len(at), dtype=bool)
            for key, wanted in zip(keys, goal):
                own = key[at]
                less |= same & (own < wanted)
                same &= own == wanted
            go = open_ & (less | same if right else less)
            lo, hi = np.where(go, mid + 1, lo), np.where(open_ & ~go, mid, hi)
        return lo

    def edges(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every occurrence of every piece in the indexed text."""
        present = np.flatnonzero(np.bincount(code, minlength=len(self.letters) + 1)[1:]) + 1
        small = np.zeros(len(self.letters) + 1, dtype=np.uint64)  # the letters of this text only
        small[present] = np.arange(1, len(present) + 1)
        bits = 8 if len(present) < 255 else 16
        each = 64 // bits
        words = -(-self.longest // each)
        fits = np.flatnonzero((small[self.spelled] > 0).sum(axis=1) == self.size)

        def packed(rows: list[np.ndarray]) -> list[np.ndarray]:
            rows = [r << np.uint64(bits * (each - 1 - k % each)) for k, r in enumerate(rows)]
            return [np.bitwise_or.reduce(rows[k:k + each]) for k in range(0, len(rows), each)]

        spelled = small[self.spelled[fits]].T
        pad = np.arange(words * each)[:, None] >= self.size[fits]
        spelled = np.concatenate([spelled, np.zeros((words * each - self.longest, len(fits)), dtype=np.uint64)])
        low, high = packed(list(spelled)), packed(list(np.where(pad, np.uint64((1 << bits) - 1), spelled)))
        span = np.concatenate([small[code], np.zeros(words * each, dtype=np.uint64)])
        window = packed([span[k:len(span) - each + 1 + k] for k in range(each)])[0]
        keys = [window[each * k:each * k + len(code)] for k in range(words)]
        suffixes = np.lexsort(keys[::-1])
        keys = [k[suffixes] for k in keys]
        first, last = self._bound(keys, low, False), self._bound(keys, high, True)
        times = last - first
        which = np.repeat(np.arange(len(times), dtype=np.int32), times)
        place = np.arange(len(which), dtype=np.int32) + np.repeat((first - np.cumsum(times) + times).astype(np.int32), times)
        start = suffixes.astype(np.int32)[place]
        return start, start + self.size[fits][which], self.pieces[fits][which]

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """BPE of words that at most one space begins: all ids in a row, and how many a word has."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        char = np.frombuffer("\0".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = self.codes[char]
        begins = np.cumsum(sizes + 1) - sizes - 1
        code[begins[1:] - 1] = 0  # separators match nothing
        start, end, piece = self.edges(code)
        offset = np.arange(len(char) + 1) - np.repeat(begins, np.append(sizes[:-1] + 1, sizes[-1] + 1))
        longest = int(sizes.max())
        place = offset.astype(np.uint16 if longest < 1 << 16 else np.int64)
        order = np.argsort(place[end], kind="stable")  # by position in the word: all words advance together
        start, end, piece = start[order], end[order], piece[order]
        cuts = np.searchsorted(place[end], np.arange(1, longest + 2))
        lone = np.flatnonzero(code == 0)  # characters of no piece: an edge of their own
        lone = lone[np.argsort(place[lone], kind="stable")]
        lone_cuts = np.searchsorted(place[lone], np.arange(0, longest + 1))
        last = np.full(len(char) + 1, -1, dtype=np.int64)  # the piece that ends here; -2: such a character
        origin = np.full(len(char) + 1, -1, dtype=np.int64)
        for step in range(1, longest + 1):
            own = slice(cuts[step - 1], cuts[step])
            s, e, p = start[own], end[own], piece[own]
            before = last[s]
            free = (offset[s] == 0) | (before == -2)  # nothing before it can merge with it
            ok = free | (before >= 0)
            check = np.flatnonzero(ok & ~free)
            if len(check):
                keys, at = np.unique(before[check] << 32 | p[check].astype(np.int64), return_inverse=True)
                ok[check] = self.beside(keys >> 32, keys & 0xFFFFFFFF)[at]
            last[e[ok]], origin[e[ok]] = p[ok], s[ok]
            own = lone[lone_cuts[step - 1]:lone_cuts[step]]
            last[own + 1], origin[own + 1] = -2, own
        taken, at = np.zeros(len(char) + 1, dtype=bool), begins + sizes
        while len(at):  # back along every path at once
            taken[at] = True
            at = origin[at]
            at = at[offset[at] > 0]
        nodes = np.flatnonzero(taken)
        ids = last[nodes]
        if (ids == -2).any():
            raw = [[self.bytes[b] for b in chr(char[n - 1]).encode("utf-8", "replace")] if i == -2 else [i] for n, i in zip(nodes.tolist(), ids.tolist())]
            nodes = np.repeat(nodes, list(map(len, raw)))
            ids = np.fromiter(chain.from_iterable(raw), dtype=np.int64)
        owner = np.searchsorted(begins, nodes - 1, "right") - 1
        return ids, np.bincount(owner, minlength=len(words))

    # -- texts ----------------------------------------------------------------------------

    def _run(self, n: int) -> list[int]:
        """A run of n spaces: the leftmost two merge, and grow while there is a piece for it."""
        parts: list[int] = []
        for _ in range(n):
            parts.append(1)
            while len(parts) > 1 and parts[-2] + parts[-1] in self.runs:
                parts[-2:] = [parts[-2] + parts[-1]]
        return [self.runs[p] for p in parts]

    def _forget(self) -> None:
        self.word: dict[str, int] = {}
        self.flat, self.first, self.count = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def _remember(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.word.update(zip(words, range(len(self.first), len(self.first) + len(words))))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.flat = np.concatenate([self.flat, ids])

    def learn(self, words: set[str]) -> None:
        """Encode words not met before and remember them."""
        plain = {w for w in words if not w.startswith("  ") and w != " "}
        runs = words - plain
        bare = {w: w.lstrip(" ") for w in runs}
        todo = list(plain | {f" {b}" for b in bare.values() if b and f" {b}" not in self.word})
        while todo:
            block, held = [], 0
            while todo and (not block or held + len(todo[-1]) <= BLOCK):
                held += len(todo[-1]) + 1
                block.append(todo.pop())
            self._remember(block, *self._encode_words(block))
        for w, b in bare.items():  # the last space belongs to the word, if a piece takes it
            run, own = len(w) - len(b), np.zeros(0, dtype=np.int64)
            if b:
                n = self.word[f" {b}"]
                own, run = self.flat[self.first[n]:self.first[n] + self.count[n]], run - 1
                if own[0] == self.runs[1]:
                    own, run = own[1:], run + 1
            ids = np.concatenate([np.array(self._run(run), dtype=np.int64), own])
            self._remember([w], ids, np.array([len(ids)]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.word) > MEMORY:
            self._forget()
        split = [self.splitter.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(split)).difference(self.word))
        at = np.fromiter(map(self.word.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=sum(map(len, split)))
        counts = self.count[at]
        ends = np.cumsum(counts)
        ids = self.flat[np.repeat(self.first[at] - ends + counts, counts) + np.arange(int(counts.sum()))].astype(np.int32)
        cuts = np.concatenate([[0], ends])[np.cumsum(list(map(len, split)), dtype=np.int64)]
        return np.split(ids, cuts[:-1]) if texts else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, control ids vanish."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: Characters of text encoded together; results leave the worker slice by slice.
SLICE = 1 << 21


def encode(docs: DataFrame, text_col: str = "text", model: str = MODEL, out: str = "ids") -> DataFrame:
    """``docs`` with the column ``out``: the piece ids of the whole text (null for a null text,
    none for an empty one). All rows and columns stay."""
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = vocabulary(model)
        for texts in batches:
            found = texts.tolist()
            for part in slices([t or "" for t in found], SLICE):
                ids = own.encode([t or "" for t in found[part]])
                yield pd.Series([None if t is None else x for t, x in zip(found[part], ids)], dtype=object)

    return docs.withColumn(out, run(F.col(text_col)))


def decode(rows: DataFrame, ids_col: str = "ids", model: str = MODEL, out: str = "decoded") -> DataFrame:
    """``rows`` with the column ``out``: the text of the ids, null for null ids.

    Gives back what was encoded, but for U+2581, which comes back as a space, and lone
    surrogates, which can't be stored.
    """
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = vocabulary(model)
        for ids in batches:
            yield pd.Series([None if x is None else own.decode(x.tolist()) for x in ids], dtype=object)

    return rows.withColumn(out, run(F.col(ids_col)))


def encode_and_check(docs: DataFrame, text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``docs`` with ids, n_ids, decoded_sha256 and round_trip: encoded, decoded and compared in one
    pass. All four are null for a null text. Columns that already have those names are replaced."""
    @F.pandas_udf("ids array<int>, n_ids int, decoded_sha256 string, round_trip boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = vocabulary(model)
        for texts in batches:
            found = texts.tolist()
            for part in slices([t or "" for t in found], SLICE):
                out = []
                for text, ids in zip(found[part], own.encode([t or "" for t in found[part]])):
                    back = None if text is None else own.decode(ids.tolist())
                    out.append((None,) * 4 if text is None else (ids, len(ids), hashlib.sha256(back.encode("utf-8", "replace")).hexdigest(), back == text))
                yield pd.DataFrame(out, columns=["ids", "n_ids", "decoded_sha256", "round_trip"]).astype({"n_ids": "Int32", "round_trip": "boolean"})

    if not os.path.exists(model):
        raise FileNotFoundError(model)
    kept = others(docs, "ids", "n_ids", "decoded_sha256", "round_trip")
    return docs.withColumn("__tokens", run.asNondeterministic()(F.col(text_col))).select(*kept, "__tokens.*")
