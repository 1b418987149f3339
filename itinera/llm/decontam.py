"""Benchmark decontamination by a prefix-filtered set join.

Every item becomes windows of ``WINDOW`` consecutive words (a shorter item is
one window), every window a set of shingles (``SHINGLE`` words, fewer only for
items that have fewer).  A window that occurs contains all of its shingles, so
one shingle is a sufficient prefix: the rarest one by its count in all
documents.  Document positions are joined with the windows on that shingle, the
window's place must lie inside the document (positional and length bounds), and
its words are compared exactly.

A bitmap of fixed size (``BITS``) over the shingles' hashes drops nearly all
document positions before the shuffle; the join behind it is exact whatever the
bitmap lets through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import WORD, cut, table, words_of

WINDOW, SHINGLE = 13, 3
BITS = 1 << 20


def shingle(words: list[Column]) -> Column:
    return F.xxhash64(F.lit(len(words)), *words)


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """item_id, words, win: a row for each window of each item with words."""
    w = items.select("item_id", words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    return (w.withColumn("n", n).withColumn("s", F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)))
            .select("item_id", F.slice("w", F.col("s"), F.col("n")).alias("words"))
            .withColumn("win", F.array_join("words", " ")))


def window_shingles(windows: DataFrame) -> DataFrame:
    """win, words, k, rel, tok: every shingle of every distinct window."""
    w = windows.select("win", "words").distinct().withColumn("k", F.least(F.size("words"), F.lit(SHINGLE)))
    w = w.withColumn("rel", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("k"))))
    tok = F.when(F.col("k") == 1, shingle([F.col("words")[F.col("rel")]]))
    for k in range(2, SHINGLE + 1):
        tok = tok.when(F.col("k") == k, shingle([F.col("words")[F.col("rel") + j] for j in range(k)]))
    return w.withColumn("tok", tok)


def _is_set(bits: Column, tok: Column) -> Column:
    at = tok.bitwiseAND(BITS - 1)
    word = F.get(bits, F.shiftrightunsigned(at, 6).cast("int"))
    return F.call_function("getbit", word, at.bitwiseAND(63).cast("int")) == 1


def bitmap(tokens: DataFrame) -> Column:
    """Scalar subquery: BITS bits, set at the tokens' hashes, as an array of longs."""
    at = tokens.select(F.col("tok").bitwiseAND(BITS - 1).alias("b"))
    words = (at.groupBy(F.shiftright("b", 6).alias("i"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("bits")))
    dense = tokens.sparkSession.range(BITS // 64).withColumnRenamed("id", "i").join(words, "i", "left")
    return dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", F.coalesce("bits", F.lit(0)).alias("bits")))),
                                 lambda x: x["bits"])).scalar()


def marked(docs: DataFrame, sizes: list[int], tokens: DataFrame, window: int) -> DataFrame:
    """doc_id, m: the number of words and the positions whose shingle may be among
    ``tokens``, each with up to ``window`` words to either side.

    Beyond the last full shingle the hashes mean nothing; the exact comparison drops
    them.  The words are bound as a lambda variable: as a column, the optimiser may
    copy the split into every shingle.
    """
    bits = F.col("bits")

    def places(words, k):
        every = F.transform(words, lambda word, i: F.struct(
            i.alias("pos"), shingle([word, *[F.get(words, i + j) for j in range(1, k)]]).alias("tok")))
        return F.filter(every, lambda s: _is_set(bits, s["tok"]))

    def whole(words):
        def near(s):
            left = F.least(s["pos"], F.lit(window - 1))
            return F.struct(s["pos"].alias("pos"), s["tok"].alias("tok"), left.alias("left"),
                            F.slice(words, s["pos"] - left + 1, left + window).alias("near"))

        seen = F.concat(F.array().cast("array<struct<pos:int,tok:bigint>>"), *[places(words, k) for k in sizes])
        return F.struct(F.size(words).cast("long").alias("n_words"), F.transform(seen, near).alias("seen"))

    rows = docs.select("doc_id", "text", bitmap(tokens).alias("bits"))
    return rows.select("doc_id", F.transform(F.array(words_of(F.col("text"))), whole)[0].alias("m"))


def occurrences(docs: DataFrame, windows: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id, n_words), and each place where a window stands
    (row, start, len, win)."""
    parts = cut(window_shingles(windows))
    sizes = sorted(r["k"] for r in parts.select("k").distinct().collect())          # at most SHINGLE values
    tokens = parts.select("tok").distinct()
    # explode_outer: explode would add a filter that splits every text once more
    counts = (marked(docs, sizes, tokens, window).select(F.explode_outer("m.seen.tok").alias("tok"))
              .groupBy("tok").agg(F.count(F.lit(1)).alias("n")).join(tokens, "tok", "left_semi"))
    # windows with a shingle that no document has cannot occur
    ranked = parts.join(counts, "tok", "left").groupBy("win", "words", "k").agg(
        F.min(F.coalesce("n", F.lit(0))).alias("least"), F.min(F.struct("n", "tok", "rel")).alias("rarest"))
    prefix = cut(ranked.filter(F.col("least") > 0).select("win", F.size("words").alias("len"), "rarest.tok", "rarest.rel"))

    rows = cut(marked(docs, sizes, prefix.select("tok").distinct(), window).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "m"))
    rows = rows.select("row", "doc_id", "m.n_words", "m.seen")
    at = F.col("left") - F.col("rel")
    found = (rows.select("row", F.inline("seen")).join(prefix, "tok")
             .filter((at >= 0) & (at + F.col("len") <= F.size("near")))
             .filter(F.array_join(F.slice("near", F.greatest(at, F.lit(0)) + 1, F.col("len")), " ") == F.col("win"))
             .select("row", (F.col("pos") - F.col("rel")).alias("start"), "len", "win"))
    return rows.select("row", "doc_id", "n_words"), found


def covered(spans: Column) -> Column:
    """Number of positions in the union of (start, end) spans, sorted by start."""
    def add(s, x):
        new = F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["to"]))
        return F.struct((s["n"] + new).alias("n"), F.greatest(s["to"], x["end"]).alias("to"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), add, lambda s: s["n"])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    Null and empty texts have no words; items without words or id are left out of
    the list (words of an item without id still count as hit); repeated items and
    rows change nothing but give a row each; an empty benchmark hits nothing.
    Only doc_id, text and item_id, text are read.
    """
    windows = cut(item_windows(items, window))
    rows, found = occurrences(docs, windows, window)
    found = cut(found)
    hit = found.groupBy("row").agg(
        covered(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end"))))).cast("long").alias("n_hit"))
    named = (found.select("row", "win").distinct()
             .join(windows.select("win", F.col("item_id").cast("string").alias("item")).distinct(), "win")
             .groupBy("row").agg(F.collect_set("item").alias("ids")))
    out = rows.join(hit.join(named, "row"), "row", "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("items_sha256"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def keep_uncontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with the columns they had.  A row goes by its
    own text: rows that share an id, or have none, stay where their texts are clean.  Null and
    empty texts stay; an empty table gives no rows, an empty benchmark keeps all."""
    own = F.struct(F.col("doc_id"), F.xxhash64("text").alias("key")).alias("doc_id")
    bad = cut(decontaminate(docs.select(own, "text"), items).filter("contaminated").select(
        F.col("doc_id.doc_id").alias("bad_id"), F.col("doc_id.key").alias("bad_key")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_key"]), "left_anti")


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          rf"'abcdefghijklmnopqrstuvwxyz'), '{WORD}')")
OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, l, array_to_string(w[s : s + l - 1], ' ') AS win
       FROM (SELECT item_id, w, least(len(w), 13) AS l, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s
             FROM i WHERE len(w) > 0)),
ls AS (SELECT DISTINCT l FROM iw),
dw AS (SELECT rid, s, l, array_to_string(w[s : s + l - 1], ' ') AS win
       FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, ls WHERE len(w) >= l)),
o AS (SELECT rid, s, dw.l, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.l = iw.l),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + l)) AS p FROM o) GROUP BY rid),
n AS (SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
      FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM o WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN n USING (rid)
"""
