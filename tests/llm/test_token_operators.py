"""Alignment, packing and whitening against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from itinera.llm import alignment, packing, vocab, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, a string, n_a long, slice string, length string, task string"
ODD = [(1, None), (2, ""), (3, "   "), (4, "<|endoftext|> </s> <0x41>"), (4, "<|endoftext|> </s> <0x41>"), (None, "no id"),
       (6, "\u2581 mark"), (7, "tab\t\r\n \u3000x\x1c  y\n\n  z "), (8, "Z\u00fcrich \U0001F600 \u4e2d\u6587 e\u0301"), (9, "word " * 30_000), (10, "x" * 20_000)]


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame([(i, t, "x", 5, "x", "x", "x") for i, t in ODD], SCHEMA)
    return odd.unionByName(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 100 doc_id", "text", "source a"), True)


@pytest.fixture(scope="module")
def first():
    t = Tokenizer.from_file(vocab.BYTE_BPE)
    t.encode_special_tokens = True
    return t


def group_by_key(rows, key, value):
    out = defaultdict(list)
    for r in rows:
        out[key(r)].append(value(r))
    return out


def aligned(texts, first):
    """By loops over tokens: (n_a, n_b, n_groups, n_links, n_best, count_sum, sha) of every text."""
    second = sentencepiece.SentencePieceProcessor(model_file=vocab.PIECE_BPE)
    to_byte = vocab.byte_of_char()
    rows, counts = [], Counter()
    for t in texts:
        ids = [first.encode(" " + t, add_special_tokens=False).ids, second.encode(t)] if t else [[], []]
        raw = [[bytes(to_byte[c] for c in first.id_to_token(i)) for i in ids[0]],
               [bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i)
                else second.id_to_piece(i).replace("\u2581", " ").encode() for i in ids[1]]]
        if any(b"".join(x) != (" " + (t or "")).encode() for x in raw):
            ids, raw = [[], []], [[], []]
        ends = [np.cumsum([0, *map(len, x)]).tolist() for x in raw]
        i = j = 0
        links, groups, now = [], [], ([], [])
        while i < len(ids[0]):
            links.append((ids[0][i], ids[1][j]))
            a, b = ends[0][i + 1], ends[1][j + 1]
            if a <= b:
                now[0].append(str(ids[0][i]))
                i += 1
            if b <= a:
                now[1].append(str(ids[1][j]))
                j += 1
            if a == b:
                groups.append("|".join(map(",".join, now)))
                now = ([], [])
        counts.update(links)
        rows.append((len(ids[0]), len(ids[1]), groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(a, b, len(g), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for a, b, g, x in rows]


def test_alignment(docs, first, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 50_000)          # several slices, and texts longer than one
    source = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *x) for r, x in zip(source, aligned([r.text for r in source], first)))
    got = Counter(map(tuple, alignment.align(docs).collect()))
    assert got == want


def test_alignment_empty(docs):
    assert alignment.align(docs.filter("false")).collect() == []
    bare = alignment.align(docs.filter("doc_id in (1, 2, 6)")).collect()         # no tokens in the whole slice
    assert sorted(map(tuple, bare)) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 6)]


def test_vocabulary_is_that_of_the_library(first):
    own = vocab.ByteLevel(vocab.read_bytes(vocab.BYTE_BPE))
    rnd = np.random.default_rng(5)
    signs = list("aB1\u00e9 \t\n!'s\u2026\u00a0\u3000\x1c\x85\u4e2d\u0301\U0001F600  \r;tionre")
    for n in rnd.integers(0, 60, 3000):
        text = "".join(rnd.choice(signs, n))
        assert own.of(text) == first.encode(text, add_special_tokens=False).ids


def test_best_fit_decreasing():
    rnd = np.random.default_rng(1)
    for _ in range(150):
        window = int(rnd.choice([8, 16, 50, 64]))
        lengths = rnd.choice(np.arange(1, window + 1), min(window, int(rnd.integers(1, 20))), replace=False)
        counts = {int(n): int(rnd.integers(1, 30)) for n in lengths}
        rooms = []                                          # one by one, each to the tightest window
        for n in sorted(counts, reverse=True):
            for _ in range(counts[n]):
                fit = [k for k, room in enumerate(rooms) if room >= n]
                if fit:
                    rooms[min(fit, key=lambda k: rooms[k])] -= n
                else:
                    rooms.append(window - n)
        filled = defaultdict(list)
        for n, runs in group_by_key(packing.best_fit_decreasing(counts, window), lambda r: r[0], lambda r: r[1:]).items():
            for rank in range(counts[n]):
                start, window_at, each, base = [r for r in runs if r[0] <= rank][-1]
                filled[window_at + (rank - start) // each].append((base + (rank - start) % each * n, n))
        for parts in filled.values():
            ends = np.cumsum([0, *(n for _, n in sorted(parts))])
            assert [at for at, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= window
        assert sorted(filled) == list(range(len(rooms)))
        assert sorted(window - sum(n for _, n in parts) for parts in filled.values()) == sorted(rooms)


def test_packing(docs, first):
    rows = packing.pack(docs, window=512).collect()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = np.array([*first.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((r.doc_id, k, len(ids[k:k + 512]), zlib.crc32(ids[k:k + 512].tobytes()), len(ids)) for k in range(0, len(ids), 512))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    used = group_by_key(rows, lambda r: r.sequence_id, lambda r: (r.offset, r.length))
    for parts in used.values():
        ends = np.cumsum([0, *(n for _, n in sorted(parts))])
        assert [at for at, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 512
    assert sorted(used) == list(range(len(used)))
    assert sum(n for x in used.values() for _, n in x) > 0.98 * 512 * len(used)


def test_packing_empty(docs):
    assert packing.pack(docs.filter("false")).collect() == []


def test_spectrum_follows_its_rows():
    rnd = np.random.default_rng(2)
    for x in (rnd.normal(size=(300, 24)) * 200 + 1e5, rnd.integers(0, 3, (200, 6)) * 1.0, np.ones((40, 5)),
              np.repeat(rnd.normal(size=(3, 12)), 30, 0), np.eye(9)[rnd.integers(0, 9, 90)]):
        one, two = whitening.Spectrum(x.shape[1]), whitening.Spectrum(x.shape[1])
        for k, row in enumerate(x):
            (one if k % 3 else two).add(row)
        one.merge(two)
        off = x - x.mean(0)
        assert np.abs(one.vectors @ np.diag(one.values) @ one.vectors.T - off.T @ off).max() < 1e-6 * max(1, (off ** 2).sum())
        assert np.abs(one.vectors.T @ one.vectors - np.eye(x.shape[1])).max() < 1e-9


def whitened_rows(vectors, components=8):
    x = np.floor(1024 * np.asarray(vectors, float)) + 100000
    n, sums = len(x), x.sum(0)
    cov = (x - sums / n).T @ (x - sums / n) / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    return n, deviation, (x - sums / n) @ v / np.sqrt(e), e / np.trace(cov)


def test_whitening(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    source = {r.vec_id: r.embedding for r in df.collect()}
    extra = spark.createDataFrame([(-1, None), (-2, [1.0, None] * 32), (-3, [float("nan")] * 64), (-4, [float("inf")] * 64), (-5, [])],
                                  "vec_id long, embedding array<float>")
    rows = whitening.whiten(df.select("vec_id", "embedding").unionByName(extra).selectExpr("*", "'x' n", "'y' whitened").repartition(7)).collect()
    n, deviation, white, explained = whitened_rows(list(source.values()))
    assert len(rows) == 8 * n and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-8
    at = {v: k for k, v in enumerate(source)}
    for c in range(8):
        mine = [r for r in rows if r.component == c + 1]
        got = np.array([r.whitened for r in mine])
        want = white[[at[r.vec_id] for r in mine], c]
        assert np.abs(got * np.sign(got @ want) - want).max() < 1e-7
        assert {r.n for r in mine} == {n} and abs(mine[0].explained / explained[c] - 1) < 1e-9
        assert all(r.deviation == deviation[at[r.vec_id]] for r in mine)


def test_whitening_odd_tables(spark):
    kind = "vec_id long, embedding array<double>"
    run = lambda rows: whitening.whiten(spark.createDataFrame(rows, kind)).collect()
    assert run([]) == []
    same = run([(1, [1.0, 2.0])] * 3)
    assert len(same) == 6 and {(r.whitened, r.explained, r.identity_error, r.deviation) for r in same} == {(None, None, None, 0)}
    two = run([(1, [1.0, 2.0]), (2, [3.0, 1.0]), (None, [0.0, 0.0, 5.0]), (4, [2.0, 0.0, 1.0])])
    assert Counter((r.vec_id, r.n) for r in two) == {(1, 2): 2, (2, 2): 2, (None, 2): 3, (4, 2): 3}
    assert all((r.whitened is None) == (r.component > 1) for r in two)
    assert sorted(round(r.whitened, 9) for r in two if r.component == 1) == [-1, -1, 1, 1]
    huge = run([(1, [1e300, 0.0]), (2, [-1e300, 1.0])])
    assert {r.deviation for r in huge} == {None} and all(r.n == 2 for r in huge)


def test_deviations_are_exact():
    x = np.array([[100001.0, 99000.0], [2.0 ** 40, 5.0]])
    sums = [int(Decimal(100001) + 2 ** 40), 99005]
    assert whitening.deviations(x, 2, sums) == [sum((2 * int(c) - s) ** 2 for c, s in zip(r, sums)) if
                                                sum((2 * int(c) - s) ** 2 for c, s in zip(r, sums)) < 2 ** 63 else None for r in x]
