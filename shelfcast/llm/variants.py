"""Spelling variants: words one edit apart, found by pivotal grams, and the forms they lead to.

* Words are the letter runs of whole texts with their counts (``words_of``).
* Grams are ordered by their number of words, rare first (ties: by the gram). A word's prefix
  is its first three bigrams in that order, with all repeats of the third. Among
  them dynamic programming picks two disjoint ones of least total number of
  words: the pivots. One edit spoils at most one of two disjoint
  bigrams, so of two near words the one whose prefix ends first has a pivot that
  the other holds in its prefix.
* Position limits: lengths differ by at most one, and an unspoilt pivot moves by
  nothing (edit behind it) or by the difference in length (edit before it). That
  aligns the words; the edit lies in one half of the shorter word, so the other half is equal
  at its place. Gram, place, both lengths and that half are the key of the join.
* Pairs that meet are verified by their edit distance.

Keys hold the few words that share a gram, a place and half a word, so no group
grows with a common gram. Pairs and forms are tables; only the gram order (at most
the square of the letters) reaches the driver. Joins are merge joins by hint: Spark
takes a compressed table, or one unfolded by an explode, for far smaller than it is and would
broadcast it through the driver.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ready, written

# What stands between runs of letters, and the upper-case letters that are lowered.
BETWEEN = r"[^A-Za-z\u00C0-\u00FF]++"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGE = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form is at least this many times as frequent as its variant.
RATIO = 2
#: A form chain at least doubles its counts, so it has fewer links than a count has bits.
GUARD = 64
#: (length difference, move of the pivot) of two words one edit apart.
SHIFTS = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))
ENTRY = "array<struct<gram:string,pos:int>>"


def runs_of(docs: DataFrame) -> DataFrame:
    """doc_id (as text; null: empty) and every run of letters of the whole texts, A-Z lowered."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                       F.explode(F.split("text", BETWEEN)).alias("run"))
    return runs.filter("run <> ''").select("doc_id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER))
                       .otherwise(F.col("run")).alias("run"))


def damaged(runs: DataFrame, every: int = DAMAGE) -> DataFrame:
    """(word) with one code point deleted where ``every`` divides the CRC of ``doc_id:run``."""
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def words_of(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; counts are combined before the shuffle."""
    return (words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= least_count))


def gram_order(vocabulary: DataFrame) -> dict[str, tuple[int, int]]:
    """Place in the order and number of words of every bigram."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - 1),
                                         lambda i: F.substring(F.col("word"), i, F.lit(2))))
    counted = vocabulary.select(F.explode(grams).alias("gram")).groupBy("gram").count()
    ordered = sorted(counted.collect(), key=lambda r: (r["count"], r["gram"]))
    return {r["gram"]: (place, r["count"]) for place, r in enumerate(ordered)}


def pivots_of(prefix: list[tuple[int, str]], cost: dict[str, tuple[int, int]]) -> list[tuple[int, str]]:
    """Two disjoint bigrams (pos, gram) of least total cost, by dynamic programming over the places.

    ``single`` is the cheapest bigram that ends before the one at hand;
    ``pair`` the cheapest disjoint two so far. Ties: the earlier ones.
    """
    single, waiting, pair = None, [], None
    for pos, gram in sorted(prefix):
        while waiting and waiting[0][1] <= pos - 2:
            ended = waiting.pop(0)
            single = ended if single is None or ended[0] < single[0] else single
        price = cost[gram][1]
        if single is not None and (pair is None or single[0] + price < pair[0]):
            pair = (single[0] + price, (single[1], single[2]), (pos, gram))
        waiting.append((price, pos, gram))
    return [pair[1], pair[2]]


def signature(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, list[tuple[int, str]], list[tuple[int, str]]]:
    """Where the prefix ends in the gram order, the prefix and the pivots of a word."""
    grams = sorted((order[word[i:i + 2]][0], i, word[i:i + 2]) for i in range(len(word) - 1))
    last = grams[2][0]
    prefix = [(i, g) for place, i, g in grams if place <= last]
    return last, prefix, pivots_of(prefix, order)


def signed(vocabulary: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """word, last, prefix and pivots of every word."""
    def mapped(batches):
        kind = pa.list_(pa.struct([("gram", pa.string()), ("pos", pa.int32())]))
        for batch in batches:
            got = [signature(w, order) for w in batch.column(0).to_pylist()]
            sides = [pa.array([[{"gram": g, "pos": i} for i, g in s[k]] for s in got], kind) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s[0] for s in got], pa.int32()), *sides],
                                             names=["word", "last", "prefix", "pivots"])

    return vocabulary.select("word").mapInArrow(mapped, f"word string, last int, prefix {ENTRY}, pivots {ENTRY}")


def _keys(gram: Column, place: Column, length: Column, shorter: Column, word: Column) -> Column:
    """The two keys of an entry: a gram at its place in a word of ``length``, with either half of the shorter word."""
    half = F.floor(shorter / 2).cast("int")
    rest = shorter - half
    head, tail = F.substring(word, F.lit(1), half), F.substring(word, F.length(word) - rest + 1, rest)
    return F.array(F.xxhash64(F.lit("head"), gram, place, length, shorter, head),
                   F.xxhash64(F.lit("tail"), gram, place, length, shorter, tail))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, b) of all words that differ by exactly one inserted, deleted or replaced code point, in both directions."""
    sides = written(signed(vocabulary, gram_order(vocabulary)), "variant-signatures")
    size = F.length("word")
    entries = sides.select("word", "last", size.alias("size"), F.explode("prefix").alias("e"))
    index = entries.select("word", "last", "size", "e.gram", "e.pos", F.explode(F.array("size", F.col("size") - 1)).alias("shorter"))
    index = index.select(F.explode(_keys(F.col("gram"), F.col("pos"), F.col("size"), F.col("shorter"), F.col("word"))).alias("key"),
                         F.col("word").alias("b"), F.col("last").alias("b_last"))
    moves = F.array(*[F.struct(F.lit(d).alias("longer"), F.lit(m).alias("move")) for d, m in SHIFTS])
    probes = sides.select("word", "last", size.alias("size"), F.explode("pivots").alias("e"))
    probes = probes.select("word", "last", "size", "e.gram", "e.pos", F.explode(moves).alias("s"))
    length = F.col("size") + F.col("s.longer")
    probes = probes.select(F.explode(_keys(F.col("gram"), F.col("pos") + F.col("s.move"), length, F.least("size", length),
                                           F.col("word"))).alias("key"),
                           F.col("word").alias("a"), F.col("last").alias("a_last"))
    met = (probes.join(index.hint("merge"), "key").filter((F.col("a_last") <= F.col("b_last")) & (F.col("a") != F.col("b")))
           .filter(F.levenshtein("a", "b", 1) == 1).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    one = written(met, "variant-pairs")
    return one.unionByName(one.selectExpr("b as a", "a as b"))


def forms_of(vocabulary: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n: the most frequent near word (ties: the least), if it is ``ratio`` times as frequent."""
    near = pairs.join(vocabulary.selectExpr("word as b", "n as b_n").hint("merge"), "b")
    best = near.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("b_n"), F.col("b"))).alias("best"))
    best = best.select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("form"), (-F.col("best.col1")).alias("form_n"))
    joined = vocabulary.join(best.hint("merge"), "word", "left")
    follows = F.col("form_n") >= ratio * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                         F.when(follows, F.col("form")).alias("form"), F.when(follows, F.col("form_n")).alias("form_n"))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: every round of joins doubles the links that are followed."""
    chain = written(forms.filter("form is not null").selectExpr("word", "form as root"), "variant-chain")
    for _ in range(GUARD):
        ahead = chain.selectExpr("word as root", "root as next")
        moved = chain.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                       F.col("next").isNotNull().alias("moved"))
        step = written(moved, "variant-chain")
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        chain = step.select("word", "root")
    raise RuntimeError("form chains did not end")


def grouped(docs: DataFrame, every: int = DAMAGE, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
            ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the documents.

    Null texts have no words, null ids count as empty text; repeated rows count
    each; an empty table or one without frequent words gives an empty result;
    other columns are ignored.
    """
    ready(docs.sparkSession)
    if least_length < 4:
        raise ValueError("words need four code points for a prefix of three bigrams")
    vocabulary = written(words_of(damaged(runs_of(docs), every), least_length, least_count), "variant-words")
    forms = written(forms_of(vocabulary, near_pairs(vocabulary), ratio), "variant-forms")
    joined = forms.join(roots_of(forms).hint("merge"), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
