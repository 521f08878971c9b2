"""How filters of documents interact: what each removes in every order, and its fair share.

A document is put down to the set of filters that it fails. Those sets are counted, which
leaves at most 32 rows for each part of the corpus with five filters, and all else follows
from them. The removal game gives each coalition of filters the documents that at least one
of its members removes. Its Hart-Mas-Colell potential is built up coalition by coalition:
the value of the coalition plus the potentials without each member, over the number
of members. The Shapley value of a filter is the potential of all filters less the potential
without that filter, and what a filter removes as a step of an order is the value with it less
the value of the filters before it.

Potentials are kept times the factorial of the members, so they stay whole numbers: with
``Q(S) = |S|! P(S)``, ``Q(S) = (|S| - 1)! v(S) + sum of Q(S without i)``, and the Shapley value
summed over all n! orders is ``Q(all) - n Q(all without i)``.

Everything is native. Texts are reduced to marks and a digest in the first scan; rows are
counted by parts and failed filters before they meet labels, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

MIN_WORDS = 50
DISTINCT_PERCENT = 65  # of the words, at least
CAPITALS_PERCENT = 5  # of the code points, at most

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _few_words(text: Column, words: Column) -> Column:
    return F.size(words) < MIN_WORDS


def _few_distinct(text: Column, words: Column) -> Column:
    return 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words)


def _many_capitals(text: Column, words: Column) -> Column:
    length = F.length(text)
    return 100 * (length - F.length(F.translate(text, _CAPITALS, ""))) > CAPITALS_PERCENT * length


def _symbols(text: Column, words: Column) -> Column:
    return text.rlike(r"[#$%&*|]")


#: Filters that look at one text; each says whether a text fails. ``COPY`` is added behind them.
TEXT_FILTERS: dict[str, Callable[[Column, Column], Column]] = {
    "A": _few_words,
    "B": _few_distinct,
    "C": _many_capitals,
    "D": _symbols,
}
COPY = "E"  # fails if a smaller key has the same text


def failures(
    docs: DataFrame,
    filters: dict[str, Callable[[Column, Column], Column]] = TEXT_FILTERS,
    text: str = "text",
    key: str = "doc_id",
    part: str = "source",
) -> DataFrame:
    """``key``, ``part``, ``failed``, ``count``: how many rows of a key fail which set of filters.

    ``failed`` has bit i set for filter i, the copies last. NULL texts are as empty ones,
    and a NULL part is the empty string. Rows of one key are not copies of each other, and
    a NULL key is neither smaller nor larger than another. Names other than these are not read.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("_part"),
        body.alias("_text"),
    )
    words = F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    split = narrow.withColumn("_words", words)
    marks = [F.when(fails(F.col("_text"), F.col("_words")), F.lit(1 << i)).otherwise(F.lit(0))
             for i, fails in enumerate(filters.values())]
    mask = marks[0]
    for mark in marks[1:]:
        mask = mask.bitwiseOR(mark)
    marked = (
        split.select("_key", "_part", mask.alias("_failed"), F.unhex(F.sha2("_text", 256)).alias("_digest"))
        .groupBy("_key", "_part", "_digest", "_failed")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    marked = stage(marked, "failures")  # narrow; read twice
    first = marked.groupBy("_digest").agg(F.min("_key").alias("_key")).withColumn("_first", F.lit(True))
    copy = F.when(F.col("_key").isNotNull() & F.col("_first").isNull(), F.lit(1 << len(filters)))
    return (
        marked.join(first, ["_digest", "_key"], "left")
        .withColumn("_failed", F.col("_failed").bitwiseOR(F.coalesce(copy, F.lit(0))))
        .groupBy("_key", "_part", "_failed")
        .agg(F.sum("_n").alias("_n"))
        .toDF(key, "part", "failed", "count")
    )


def cells(
    failed: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality", toxic: str = "toxic"
) -> DataFrame:
    """``part``, ``failed`` and, of the documents in it, ``total``, ``good`` and ``toxic`` ones.

    A document is good, or toxic, if any label of its key says so; NULL keys have no labels.
    """
    said = labels.select(
        F.col(f"`{key}`").alias("_key"),
        (F.col(f"`{quality}`") == 1).alias("_good"),
        (F.col(f"`{toxic}`") == 1).alias("_toxic"),
    )
    said = said.filter("_key is not null and (_good or _toxic)").groupBy("_key").agg(
        F.max(F.coalesce("_good", F.lit(False))).alias("_good"),
        F.max(F.coalesce("_toxic", F.lit(False))).alias("_toxic"),
    )
    named = failed.toDF("_key", "part", "failed", "count")
    held = lambda flag: F.sum(F.when(F.col(flag), F.col("count")).otherwise(F.lit(0)))
    return (
        named.join(said, "_key", "left")
        .groupBy("part", "failed")
        .agg(F.sum("count").alias("total"), held("_good").alias("good"), held("_toxic").alias("toxic"))
    )


def _values(measure: str, coalitions: int) -> Column:
    """For each coalition, the documents that a member removes, from the array ``_cells``."""
    met = lambda s: F.filter("_cells", lambda c: c["failed"].bitwiseAND(s) != 0)
    return F.transform(
        F.sequence(F.lit(0), F.lit(coalitions - 1)),
        lambda s: F.aggregate(met(s), F.lit(0).cast("long"), lambda sum_, c: sum_ + c[measure]),
    )


def potentials(values: Column, n: int) -> Column:
    """Of all 2**n coalitions, the potential times the factorial of its members."""
    weights = F.array(*(F.lit(factorial(k)).cast("long") for k in range(n)))

    def grown(known: Column, s: Column) -> Column:
        members = F.bit_count(s)
        own = F.get(weights, members - 1) * F.get(values, s)
        for i in range(n):
            without = F.get(known, s.bitwiseAND(F.lit(~(1 << i))))
            own = own + F.when(s.bitwiseAND(F.lit(1 << i)) != 0, without).otherwise(F.lit(0))
        return F.concat(known, F.array(own))

    empty = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), empty, grown)


def interactions(counted: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from ``cells``.

    ``letters`` names the filters by bit. A part without documents has no rows; every other
    has all orders and steps, zeros included.
    """
    n = len(letters)
    everything = (1 << n) - 1
    folded = counted.groupBy("part").agg(
        F.collect_list(F.struct("failed", "total", "good", "toxic")).alias("_cells")  # 2**n at most
    )
    known = folded.select(
        "part",
        F.aggregate("_cells", F.lit(0).cast("long"), lambda sum_, c: sum_ + c["total"]).alias("_all"),
        *(_values(m, 1 << n).alias(f"_{m}") for m in ("total", "good", "toxic")),
    )
    known = known.withColumn("_potential", potentials(F.col("_total"), n))
    orders = F.lit(["".join(p) for p in permutations(letters)])
    steps = known.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")
    )
    place = [F.instr("filter_order", letter) for letter in letters]
    before = own = F.lit(0)
    for i, at in enumerate(place):
        before = before + F.when(at < F.col("step"), F.lit(1 << i)).otherwise(F.lit(0))
        own = own + F.when(at == F.col("step"), F.lit(1 << i)).otherwise(F.lit(0))
    steps = steps.withColumn("_before", before).withColumn("_own", own)
    value = lambda m, s: F.get(f"_{m}", s)
    gain = lambda m: value(m, F.col("_before") + F.col("_own")) - value(m, F.col("_before"))
    rest = F.lit(everything) - F.col("_own")
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("_all") - value("total", F.col("_before") + F.col("_own"))).alias("kept"),
        gain("total").alias("removed"),
        (value("total", F.col("_own")) - gain("total")).alias("redundant"),
        (value("total", F.lit(everything)) - value("total", rest)).alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        (value("potential", F.lit(everything)) - n * value("potential", rest)).alias("shapley"),
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: dict[str, Callable[[Column, Column], Column]] = TEXT_FILTERS,
    text: str = "text",
    key: str = "doc_id",
    part: str = "source",
) -> DataFrame:
    """All orders of the filters and the copy filter, over the parts of the corpus.

    Empty tables give no rows; repeated rows count each; labels may be missing or repeat.
    """
    counted = cells(failures(docs, filters, text, key, part), labels, key)
    return interactions(counted, "".join(filters) + COPY)
