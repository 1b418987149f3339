"""The training-data operators against brute force on small fixtures and driver tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from itinera.llm import ann, decontam, langid, licences, minhash, pieces, pii, quality, repeats, sharding

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"
LONG = "word " * 3000 + "mail me at a.b@c.example.org or +1 (377) 555-0271, card 4539578763621486, ip 10.0.0.255"
ODD = [(1, None), (2, ""), (3, "   "), (4, LONG), (4, LONG), (5, "Zwölf Boxkämpfer … 😀 x@y.zz 256.1.1.1"), (None, "no id here"),
       (7, "Released under the MIT License. CC BY-NC 4.0; GNU General Public License, GNU General Public License"),
       (8, "1234 5678 9012 3456 7 and +12345678"), (9, "▁ odd \t marks\n▁▁")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, None, None, 0.5) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "word " * 20), (2, "no id here"), (3, None), (None, "odd marks"), (2, "no id here")],
                                 "item_id long, text string")


def base_spans(t):
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]

    def ok(k, v):
        d = re.sub("[^0-9]", "", v)
        if k == "ip":
            return all(int(p) <= 255 for p in v.split("."))
        if k == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            return 16 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0
        return k != "phone" or 8 <= len(d) <= 15

    return [(k, m.start(), m.end()) for k, p in kinds for m in re.finditer(p, t or "") if ok(k, m.group())]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))


def test_pii_base_spans(odd):
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == len(ODD)
    want = Counter((i, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(t)).encode()).hexdigest()) for i, t in ODD)
    assert Counter((r.doc_id, r.base_sha256) for r in rows) == want


def test_pii_masks(odd):
    rows = {r.doc_id: r for r in pii.mask_personal_data(odd).collect()}
    assert rows[4].text.endswith("mail me at [EMAIL] or [PHONE], card [CARD], ip [IP]") and rows[4].n_chars == len(rows[4].text)
    assert rows[1].text is None and rows[2].text == ""


def test_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard_documents(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    where = {}
    for r in rows:
        assert where.setdefault(texts[r.doc_id], r.shard) == r.shard
        assert r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_lpt_counts_is_the_heap():
    loads, plain = [5.0, 0.0, 9.0], [5.0, 0.0, 9.0]
    taken = sharding.lpt_counts(loads, 2.0, 50)
    for _ in range(50):
        plain[plain.index(min(plain))] += 2.0
    assert sorted(loads) == sorted(plain) and sum(taken) == 50


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.95 * got.count()
    none = docs.select("doc_id", F.lit("12 -").alias("text"), "lang")
    assert {tuple(r) for r in langid.identify(none).select("lang_pred", "score").collect()} == {("und", 0.0)}


def test_licences(odd):
    rows = {r.doc_id: r for r in licences.scan(odd).collect()}
    r, w = rows[7], words(dict(ODD)[7])
    starts = [i for p in ("gnu general public license", "cc by", "mit license") for i in range(len(w))
              if w[i:i + len(p.split())] == p.split()]
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(starts), min(starts), max(starts))
    assert r.base_labels == "cc-by,gpl,mit" and r.labels == "cc-by,cc-by-nc,gpl,mit" and r.score == 1.0
    assert rows[1].n_words == 0 and rows[1].first_word is None and rows[1].labels == ""


def test_decontamination(odd, items):
    rows = decontam.decontaminate(odd, items).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert by[4].n_hit == 3000 and by[4].contaminated and by[4].n_items == 1
    assert by[None].n_hit == 3 and by[None].items_sha256 == hashlib.sha256(b"2").hexdigest()
    assert by[9].n_hit == 2 and by[9].n_items == 0 and not by[1].contaminated


def test_near_duplicates(odd):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert {(r.doc_id, r.component_id, r.kept) for r in rows} >= {(1, 1, True), (4, 4, True), (None, None, True)}
    assert sorted(r.doc_id or 0 for r in minhash.keep_one_of_each(odd).collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9]


@pytest.mark.parametrize("block, first_bands", [(512, 4), (4, 4), (3, 1)])
def test_near_duplicates_over_many_blocks(spark, monkeypatch, block, first_bands):
    """Groups far larger than a block, and texts that share buckets without being linked."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "FIRST_BANDS", first_bands)
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(3):
        base = [f"w{x}" for x in rng.integers(0, 500, 120)]
        for k in range(24):
            t = list(base)
            for at in rng.integers(0, 120, k % 6):
                t[at] = f"n{rng.integers(0, 10 ** 6)}"
            texts.append(" ".join(t))
    texts += ["too short", "too short", "Too Short", texts[0].upper(), None]
    rows = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    own = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                low, high = sorted((own[i], own[j]))
                own = [low if x == high else x for x in own]
    assert len(set(own)) > 5
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(sets[i]), own[i]) for i in range(len(texts))}


def test_threshold_of_the_stage(spark):
    """104 shingles each, 93 in common: 93 / 115 = 0.809, linked by the stage and not by op6."""
    base = [f"w{i}" for i in range(108)]
    other = base[:97] + [f"n{i}" for i in range(11)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(other))], "doc_id long, text string")
    assert sorted(r.component_id for r in minhash.near_duplicates(docs).collect()) == [1, 2]
    assert [r.doc_id for r in minhash.keep_one_of_each(docs).collect()] == [1]
    assert (minhash.least_equal((85, 100)), minhash.least_equal((80, 100))) == (82, 72)


def test_one_of_each_without_or_with_repeated_ids(spark):
    def text(word, changed=0):
        return " ".join([f"{word}{i}" for i in range(120 - changed)] + [f"x{i}" for i in range(changed)])

    rows = [(None, text("a")), (None, text("a", 2)), (None, text("b")),      # near copies without an id, and another
            (1, text("c")), (2, text("c", 2)), (2, text("d")),               # id 2: a near copy of 1, and its own text
            (3, text("e")), (3, text("f")), (3, text("f")),                  # id 3: two texts of its own, one twice
            (4, None), (4, None), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.text) for r in minhash.keep_one_of_each(docs).collect())
    near = [k for k in got if k in {(None, text("a")), (None, text("a", 2))}]
    assert len(near) == 1 and set(got.values()) == {1}
    assert set(got) == {near[0], (None, text("b")), (1, text("c")), (2, text("d")), (3, text("e")), (3, text("f")),
                        (4, None), (None, None), (None, "")}


def test_shingle_hashes_match_sets():
    for t in ["a b c d e f a b c d e f", "A b", "x", " \t", "one two three four five"]:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        want = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        assert len(minhash.shingles(t)) == len(want)


def brute_repeats(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + 200] for b in raw for i in range(len(b) - 199))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        out.append((len(b), sum(gone), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [50_000, 2])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    passage = "".join(chr(97 + int(x)) for x in np.random.default_rng(1).integers(0, 26, 260))
    texts = [passage, "x" + passage, "é" * 300, passage[:199], None, "", "aa" + passage[:220] + "bb", LONG[:900], LONG[:900]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(repeats.remove_repeats(docs).collect())
    assert [(r.n_bytes, r.n_removed, r.kept_sha256) for r in rows] == brute_repeats(texts)


def test_nearest(spark):
    rng = np.random.default_rng(2)
    vecs = [(i, [float(x) for x in rng.normal(size=8).round(1)]) for i in range(300)]
    vecs += [(300, None), (400, [0.0] * 8), (500, [float("nan")] * 8), (7, vecs[7][1])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.filter("vec_id % 100 = 0"), 10, query_block=2, base_block=50).collect()
    for q in (0, 100, 200):
        want = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(vecs[q][1], v)))), i) for i, v in vecs[:300] if i != q)[:10]
        assert [(r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == [i for _, i in want]
    assert {r.query_id for r in got} == {0, 100, 200}


def test_pieces(odd):
    rows = pieces.round_trip(odd).collect()
    assert len(rows) == len(ODD) and all(r.exact for r in rows)
    m = pieces.model(pieces.MODEL)
    for unit in ["▁Hello", "▁▁x", "ñandú", "▁中\x01q"]:
        best = [(0.0, [])]
        for e in range(1, len(unit) + 1):
            now = (best[e - 1][0] + m.fallback, [*best[e - 1][1], *(m.byte_ids[b] for b in unit[e - 1].encode())])
            for k in range(1, e + 1):
                if (hit := m.score.get(unit[e - k:e])) and best[e - k][0] + hit[1] >= now[0]:
                    now = (best[e - k][0] + hit[1], [*best[e - k][1], hit[0]])
            best.append(now)
        assert m.viterbi(unit) == best[-1][1]


def test_pieces_pass_and_parts_agree(odd, monkeypatch):
    """One pass gives what encode and decode give; clashing names are replaced; generations of the cache change nothing."""
    clash = odd.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    one = pieces.encode_and_decode(clash)
    two = pieces.decode(pieces.encode(odd))
    assert sorted(one.columns) == sorted(two.columns)
    assert sorted(map(repr, one.select(two.columns).collect())) == sorted(map(repr, two.collect()))
    m, small = pieces.model(pieces.MODEL), pieces.PieceModel(pieces.MODEL)
    monkeypatch.setattr(pieces, "CACHE", 2)
    for _, t in ODD * 2:
        assert small.encode(t or "").tolist() == m.encode(t or "").tolist()


def test_quality(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify_quality(docs, labels).join(labels, "doc_id").filter("held_out")
    assert got.filter("predicted = quality").count() >= 0.85 * got.count()
    assert quality.classify_quality(odd, labels.limit(0)).filter("score = 1.0").count() == len(ODD)


def test_quality_prior_is_the_corpus_own(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    one = quality.learnable(labels, "quality")
    n0, n1 = (one.filter(F.col("y") == y).count() for y in (0, 1))
    most = (10, 10)
    assert n0 >= 10 and n1 > n0
    net = quality.train(docs, labels, most=most)
    assert abs(quality.prior_shift(one, quality.TRAIN_ROWS)) < 1e-9 or n1 > quality.TRAIN_ROWS[1]
    monkeypatch.setattr(quality, "prior_shift", lambda one, most: 0.0)
    plain = quality.train(docs, labels, most=most)
    assert abs(float(net.p["c"][0] - plain.p["c"][0]) - np.log(n1 / n0)) < 1e-4


def test_training_takes_one_text_of_an_id(spark):
    learn = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2][:6]
    rows = [(learn[0], f"copy {k}", "en") for k in range(50)] + [(i, f"text {i}", "en") for i in learn[1:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.training_texts(docs, 4).collect()
    assert len(got) == len({r.doc_id for r in got}) == 4
    assert len(langid.training_texts(docs, 800).collect()) == len(learn)
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(learn)], "doc_id long, quality int")
    got = quality.training_rows(docs, quality.learnable(labels, "quality"), (1500, 4500)).collect()
    assert sorted(r.doc_id for r in got) == learn


def test_empty_tables(empty, items):
    assert sharding.shard_documents(empty).count() == 0
    assert decontam.decontaminate(empty, items).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert repeats.remove_repeats(empty).count() == 0
    assert licences.scan(empty).count() == 0
    assert pii.find_personal_data(empty).count() == 0
    assert langid.identify(empty).count() == 0
    assert pieces.round_trip(empty).count() == 0


def test_stage_drops_contaminated_texts_not_their_ids(spark):
    """Rows without an id, or with a repeated one, go by their own text."""
    item = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = " ".join(f"v{i}" for i in range(40))
    rows = [(None, item, "a"), (None, clean, "b"), (5, item, "c"), (5, clean, "d"), (5, clean, "e"), (6, None, "f"), (7, "", "g"), (8, "x " + item, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bad_id string")
    kept = decontam.keep_uncontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.bad_id for r in kept.collect()) == ["b", "d", "e", "f", "g"]
    assert decontam.keep_uncontaminated(docs, items.limit(0)).count() == len(rows)
    assert decontam.keep_uncontaminated(docs.limit(0), items).count() == 0


def test_pieces_leave_columns_and_session_alone(spark, odd):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = odd.select("doc_id", "text").withColumn("n_pieces", F.lit("mine")).withColumn("decoded_text", F.lit("too"))
    out = pieces.tokenised(docs)
    assert out.columns == ["doc_id", "text", "n_pieces", "decoded_text", "piece_ids", "n_pieces_2", "exact"]
    rows = out.collect()
    assert len(rows) == len(ODD) and {(r.n_pieces, r.decoded_text) for r in rows} == {("mine", "too")}
    assert all(r.n_pieces_2 == len(r.piece_ids or []) and r.exact for r in rows)
    assert before == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    assert pieces.tokenised(docs.limit(0)).count() == 0


def test_nearest_of_queries_that_share_an_id(spark):
    base = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 6)], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(100, [1.1, 1.0]), (100, [4.9, 1.0]), (100, [4.9, 1.0])], "vec_id long, embedding array<double>")
    got = sorted((r.rank, r.vec_id) for r in ann.nearest(base, asked, k=2).collect())
    assert got == [(1, 1), (1, 5), (2, 2), (2, 4)]
    assert ann.nearest(base.limit(0), asked, k=2).collect() == [] == ann.nearest(base, asked.limit(0), k=2).collect()
    assert len(ann.nearest(base, base.limit(1), k=50).collect()) == 4          # fewer candidates than k
