import hashlib
import random
import re
import zlib

import helpers
from conftest import SF_SMALL
from respawn.llm import periodic_runs as op


def brute(words, min_words=12):
    """All runs by trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(min_words, 2 * q) and not any(
                    all(words[k] == words[k + r] for k in range(i, i + length - r)) for r in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts_of(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        kind = rng.randrange(4)
        if kind == 0:
            yield [str(rng.randrange(2)) for _ in range(rng.randrange(60))]
        elif kind == 1:
            yield [str(rng.randrange(50)) for _ in range(rng.randrange(80))]
        elif kind == 2:  # nested repeats
            part = [str(rng.randrange(3)) for _ in range(rng.randrange(1, 8))]
            inner = part * rng.randrange(1, 5) + [str(rng.randrange(3))]
            yield [str(rng.randrange(3))] * rng.randrange(4) + inner * rng.randrange(1, 5) + part
        else:
            yield ["x"] * rng.randrange(40) + [str(rng.randrange(2)) for _ in range(5)] + ["x"] * rng.randrange(40)


def test_runs_equal_brute_force():
    texts = [[w.encode() for w in t] for t in texts_of(1, 600)]
    assert op.find_runs(texts) == [brute(t) for t in texts]
    for least in (2, 3, 5):
        assert op.find_runs(texts[:200], least) == [brute(t, least) for t in texts[:200]]


def reference(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = [r for r in fast(words)]
    gone = set()
    for s, m, q in runs:
        gone.update(range(s + q, s + m))
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def fast(words):
    """Brute force over the equal pairs of each period, for whole documents."""
    import numpy as np
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    seq = np.array([ids[w] for w in words], dtype=np.int64)
    n, out = len(seq), []
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[0], (seq[:-q] == seq[q:]).astype(np.int8), [0]])
        change = np.flatnonzero(np.diff(same))
        for i, j in zip(change[::2].tolist(), change[1::2].tolist()):
            length = j + q - i
            if length >= max(12, 2 * q) and not any((seq[i:i + length - r] == seq[i + r:i + length]).all() for r in range(1, q)):
                out.append((i, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in op.run_report(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        assert got[r.doc_id] == reference(r.doc_id, r.text)
    assert len(got) == docs.count() and sum(r[1] > 0 for r in got.values()) > 5


def test_odd_rows(spark):
    rows = [tuple(r) for r in op.run_report(helpers.odd(spark)).collect()]
    want = [reference(r[0], r[1]) for r in helpers.ODD if len(r[1] or "") < 60000]
    rest = [r for r in rows if r[0] != 5]
    assert sorted(map(str, rest)) == sorted(map(str, want))
    long = [r for r in rows if r[0] == 5][0]
    assert long[:6] == (5, 1, 0, 20000, 1, 20000000)  # one run of period 1 over the whole text


def test_all_columns_stay_and_names_clash(spark):
    docs = helpers.odd(spark)
    got = op.periodic_runs(docs)
    assert got.columns == [*docs.columns, "runs", "collapsed"] and got.count() == docs.count()
    from pyspark.sql import functions as F
    clash = helpers.clashing(docs).withColumn("runs", F.lit("x")).withColumn("Collapsed", F.lit("x"))
    assert sorted(map(str, op.periodic_runs(clash).select("doc_id", "runs", "collapsed").collect())) == sorted(
        map(str, got.select("doc_id", "runs", "collapsed").collect()))
    assert op.run_report(clash).count() == docs.count()
    assert op.run_report(helpers.empty(spark)).collect() == []
    assert "__runs" in op.periodic_runs(docs, prefix="__").columns


def test_only_ascii_white_space_parts_words(spark):
    text = " ".join(["a\u00a0b"] * 12)  # a no-break space is part of a word
    assert [tuple(r) for r in op.periodic_runs(helpers.docs(spark, [(1, text, None, None, None)])).first().runs] == [(0, 12, 1)]


def test_texts_of_a_block_do_not_meet():
    texts = [[w.encode() for w in t] for t in texts_of(2, 100)]
    assert [op.find_runs([t])[0] for t in texts] == op.find_runs(texts)
