"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words are counted over whole texts. Two words are near if they differ by one inserted, deleted or
replaced code point. The join is by asymmetric q-chunks: the shorter word (of equal ones each) gives two
disjoint chunks, its first and its last ``q = length div 2`` code points; the other gives its positional grams
of that size. One edit leaves one chunk as it is, and moves it by one place at most, so of the
positional grams only those within that shift of a chunk's place can match and are made: the
first, and the last. A pair that has both chunks counts by its first. Pairs are verified.

Chunks that very many words share would bring all pairs of them. A key with more than ``crowded``
possible pairs isn't joined by itself: as the chunk is the same, the rests differ by the one edit, and
the key gets the rest with one code point left out (and its place, between words of equal length).
Words meet there only if they are near, so the rows grow with the near pairs, whatever the
group's size. No pair is left out.

A word's form is its near word with the most occurrences, if it has at least twice the word's; the forms'
own forms lead to the root. Counts double at each step, so there are no cycles and at most 63 steps, which
are taken in rounds of doubled length.

Defined cases: null and empty texts have no words; a null id reads as the empty text; repeated rows count each
time; ties between forms go to the first in code-point order; no words give no rows. Memory: the words of one text
are held at once. Keys are 64-bit hashes; a collision brings a pair to the verification and no further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waveband.llm.shared import written

LETTERS = r"[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least_n: int = 3,
            slip: int = 97) -> DataFrame:
    """``(word, n)``: the words of at least that length and number.

    One code point is deleted from the runs whose hash with the document's id divides by ``slip``.
    """
    # a deletion only shortens a run, so shorter ones needn't be looked at
    runs = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0)))
    low = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), runs.alias("run")).select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = hashed.select(F.when(F.col("h") % slip == 0, less).otherwise(F.col("run")).alias("word"))
    return word.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def _part(word: str, side: Column, size: Column) -> Column:
    """The first (side 0) or last (side 1) ``size`` code points."""
    return F.when(side == 0, F.col(word).substr(F.lit(1), size)).otherwise(F.col(word).substr(F.length(word) - size + 1, size))


def _rest(word: str, side: Column, size: Column) -> Column:
    """What :func:`_part` leaves."""
    return _part(word, 1 - side, F.length(word) - size)


def _keyed(words: DataFrame) -> DataFrame:
    """A row for each chunk of a word (as ``short``) and each gram that may equal one, with its key.

    ``more`` tells how many code points the longer word of the pair has more, ``size`` is the length of the chunk.
    """
    each = [F.struct(F.lit(short).alias("short"), F.lit(more).alias("more"), F.lit(side).alias("side"))
            for short in (True, False) for more in (0, 1) for side in (0, 1)]
    rows = words.select("word", "n", F.explode(F.array(*each)).alias("x")).select("word", "n", "x.*")
    shorter = F.length("word") - F.when(F.col("short"), 0).otherwise(F.col("more"))
    sized = rows.withColumn("size", F.floor(shorter / 2).cast("int"))
    chunk = _part("word", F.col("side"), F.col("size"))
    return sized.withColumn("key", F.xxhash64(shorter, "more", "side", chunk))


def _by_rest(rows: DataFrame) -> DataFrame:
    """The rows of crowded keys, by the rests without one code point too: words meet there only if they are near."""
    rest, spot = _rest("word", F.col("side"), F.col("size")), F.sequence(F.lit(1), F.length("rest"))
    without = lambda i: F.concat(F.col("rest").substr(F.lit(1), i - 1), F.col("rest").substr(i + 1, F.length("rest")))
    same = F.transform(spot, lambda i: F.struct(i.alias("at"), without(i).alias("left")))
    longer = F.transform(F.array_distinct(F.transform(spot, without)), lambda x: F.struct(F.lit(0).alias("at"), x.alias("left")))
    whole = F.array(F.struct(F.lit(0).alias("at"), F.col("rest").alias("left")))
    keys = F.when(F.col("more") == 0, same).when(F.col("short"), whole).otherwise(longer)
    return rows.withColumn("rest", rest).select("word", "n", "short", "more", "side", "size", "key", F.explode(keys).alias("x")).select(
        "word", "n", "short", "more", "side", "size", F.xxhash64("key", "x.at", "x.left").alias("key"))


def _pairs(rows: DataFrame) -> DataFrame:
    """The near words that meet by key, ``(a, n_a, b, n_b)``, each pair once."""
    short = rows.where("short").select("key", "more", "side", "size", F.col("word").alias("a"), F.col("n").alias("n_a"))
    other = rows.where("NOT short").select(F.col("key").alias("met"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    once = (F.col("more") == 1) | (F.col("a") < F.col("b"))
    first = (F.col("side") == 0) | (F.col("a").substr(F.lit(1), F.col("size")) != F.col("b").substr(F.lit(1), F.col("size")))
    met = short.join(other, (F.col("key") == F.col("met")) & once & first)
    return met.where((F.length("b") == F.length("a") + F.col("more")) & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")


def near_pairs(words: DataFrame, crowded: int = 4096) -> DataFrame:
    """``(a, n_a, b, n_b)``: the pairs of different words ``(word, n)`` that are one edit apart, each once."""
    rows = _keyed(words)
    holders = rows.groupBy("key").agg(F.count_if("short").alias("shorts"), F.count_if(~F.col("short")).alias("others"))
    shared = written(holders.where("shorts > 0 AND others > 0").select("key", (F.col("shorts") * F.col("others") > crowded).alias("crowded")), "keys")
    kept = written(rows.join(shared, "key"), "chunks")
    return _pairs(kept.where("NOT crowded").drop("crowded")).unionByName(_pairs(_by_rest(kept.where("crowded"))))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of every word of ``forms(word, form)``: the last word that the forms lead to."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        following = written(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = following.select("word", "root")
        if following.where("moved").isEmpty():
            return roots


def variants(words: DataFrame, crowded: int = 4096, factor: int = 2) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word of ``words(word, n)``."""
    words = written(words.select("word", "n"), "words")
    pairs = written(near_pairs(words, crowded), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    leads = -F.col("best.minus") >= factor * F.col("n")
    formed = written(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(leads, F.col("best.near")).alias("form"),
            F.when(leads, -F.col("best.minus")).alias("form_n")), "forms")
    roots = _roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
