"""Grouping of spelling variants by PartEnum signatures.

A word is the multiset of its letters: a binary vector with a place for the first ``e``, one for the second and so
on. One inserted or deleted code point changes one place, a replaced one two. The places fall into
``PARTS`` parts by letter, and vectors that differ in at most ``d`` places agree in all but ``d`` parts: every choice
of parts to leave out is a signature, which holds the letters that remain, and near words share one. Words of
equal length are compared with ``d = 2``, words that differ by one letter in length with ``d = 1``. As the edit
lies in one half of the word, a signature also holds the other half as it is written. Words are
equi-joined on signatures and verified by their edit distance, so the links are exact.

All of it is built-in DataFrame functions: occurrences are summed per task before the shuffle, a crowded signature
is an ordinary skewed join key, and roots are found by pointer jumping over written tables. No join is broadcast, as
every table here grows with the vocabulary.

NULL and empty texts hold no words. A NULL id reads as an empty one. Repeated rows count as often as they are
there. An empty table gives no rows. Output columns are fixed, so other columns cannot clash.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import written

CAPITALS = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
SMALL = CAPITALS.lower()
ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
RUN = f"[A-Za-z{ACCENTED[0]}-{ACCENTED[-1]}]+"
#: Frequent letters first, so that dealing them in turn gives parts of like weight.
FREQUENT = "enitraosudlchgmpbvfzjqkwxy"
PARTS = 4
LEAST_LENGTH, LEAST_COUNT = 5, 3
MANIFOLD = 2
SMUDGE = 97


def runs(text: Column) -> Column:
    """The maximal runs of letters of a text, ``A`` to ``Z`` in lower case."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUN), 0)
    return F.transform(
        found,
        # translating code point by code point is slow, and only runs with accents need it
        lambda run: F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, CAPITALS, SMALL)),
    )


def smudged(run: Column, key: Column) -> Column:
    """The run without one code point, if the checksum of key and run says so: misspellings at a known rate."""
    check = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(check, F.length(run).cast("long")).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + F.lit(2), F.length(run)))
    return F.when(F.pmod(check, F.lit(SMUDGE)) == 0, without).otherwise(run)


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text", smudge: bool = True) -> DataFrame:
    """``word`` for every occurrence."""
    found = docs.select(F.col(key).alias("_key"), F.explode(runs(F.col(text))).alias("_run"))
    return found.select((smudged(F.col("_run"), F.col("_key")) if smudge else F.col("_run")).alias("word"))


def vocabulary(words: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough."""
    return words.where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def _left_out(parts: tuple[int, ...]) -> str:
    """The letters of some parts."""
    return "".join(c for i, c in enumerate(FREQUENT + ACCENTED) if i % PARTS in parts)


def _signatures(word: Column, shorter: Column, distance: int) -> list[Column]:
    """A hash for every choice of ``distance`` parts to leave out and each half of the word.

    ``shorter`` is the length of the shorter word of the pairs that the signatures are to find.
    """
    letters = F.array_join(F.array_sort(F.split(word, "")), "")
    half = F.floor(shorter / 2).cast("int")
    halves = [F.substring(word, F.lit(1), half), F.substring(word, F.length(word) - (shorter - half) + 1, F.length(word))]
    return [
        F.xxhash64(F.lit(2 * number + side), shorter, part, F.translate(letters, _left_out(parts), ""))
        for number, parts in enumerate(combinations(range(PARTS), distance))
        for side, part in enumerate(halves)
    ]


def _signed(words: DataFrame, shorter: Column, distance: int) -> DataFrame:
    signatures = F.explode(F.array(*_signatures(F.col("word"), shorter, distance)))
    return words.select(signatures.alias("signature"), "word", "n")


def _dealt(frame: DataFrame) -> DataFrame:
    """The frame, joined by shuffling, whatever its size seems to be.

    Spark goes by the bytes of the compressed files and leaves out what an explode adds: signatures of a vocabulary
    of 8 MB would be broadcast as 800 MB.
    """
    return frame.hint("merge")


def near(words: DataFrame) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b``: every two words (``word``, ``n``) one edit apart, once.

    Letters outside ``FREQUENT`` and ``ACCENTED`` are in no part and so in every signature; ``words`` must hold none.
    """
    length = F.length("word")
    same = _signed(words, length, 2)
    pairs = [
        (same, same, F.col("x.word") < F.col("y.word")),
        (_signed(words, length, 1), _signed(words, length - 1, 1), F.length("x.word") + 1 == F.length("y.word")),
    ]
    found = [
        x.alias("x")
        .join(_dealt(y.alias("y")), (F.col("x.signature") == F.col("y.signature")) & apart & (F.levenshtein("x.word", "y.word", 1) == 1))
        .select(F.col("x.word").alias("a"), F.col("x.n").alias("n_a"), F.col("y.word").alias("b"), F.col("y.n").alias("n_b"))
        for x, y, apart in pairs
    ]
    return reduce(DataFrame.union, found).distinct()


def rooted(links: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of the chain that starts with the link of the word to its ``form``.

    Every round doubles how far a word sees, so chains end after as many rounds as their length has bits.
    """
    known = written(links.select("word", F.col("form").alias("root")))
    while True:
        further = known.select(F.col("word").alias("_at"), F.col("root").alias("_further"))
        seen = known.join(_dealt(further), F.col("root") == F.col("_at"), "left")
        known = written(seen.select("word", F.coalesce("_further", "root").alias("root"), F.col("_at").isNotNull().alias("moved")))
        if not known.where("moved").limit(1).count():
            return known.drop("moved")
        known = known.drop("moved")


def forms(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word (``word``, ``n``: unique words).

    The form of a word is the near word of largest ``n`` (of the smallest ones in code-point order), if it is
    ``MANIFOLD`` times as frequent; the root is where the forms of forms end.
    """
    words = written(words)
    pairs = written(near(words))
    both = pairs.union(pairs.select("b", "n_b", "a", "n_a"))
    best = both.groupBy(F.col("a").alias("_of")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word"))).alias("best")
    )
    has = -F.col("best.less") >= MANIFOLD * F.col("n")
    formed = written(
        words.join(_dealt(best), F.col("word") == F.col("_of"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best.word")).alias("form"),
            F.when(has, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = rooted(formed.where(F.col("form").isNotNull())).withColumnRenamed("word", "_rooted")
    return formed.join(_dealt(roots), F.col("word") == F.col("_rooted"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
