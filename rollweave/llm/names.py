"""Variant spellings of names, linked by metric-space partitioning and an exact radius join.

The metric space is that of distinct surnames, each as its consonant skeleton, under Levenshtein distance.
Pivots are a net of frequent names: taken in rounds, the most frequent uncovered names first, until every name is
within ``COVER`` of one. A name lives in the cell of its first pivot within ``COVER``, and by the triangle inequality
any name within ``MOST`` of it is within ``COVER + MOST`` of that pivot: boundary names are replicated to the cells
of all earlier pivots that near. In each cell names are joined exactly. Rows then meet by
(name or near name, further attribute), and evidence decides.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.llm.people import agreement, evidence, with_rarity
from rollweave.session import Scratch, cut

COVER = 1  # edits within which a name belongs to a pivot's cell
PIVOTS = 2_048  # names taken as pivots at once: bounds what is broadcast, not how many pivots there are
MOST = 2  # edits of skeletons within which variants are
LONG = 6  # letters of a skeleton from which two edits of any kind make a variant
EDITS = 3  # edits of whole surnames up to which rows are compared
SLICE_ROWS = 200_000  # rows whose blocks are joined at once: bounds the disk that blocks take, all slices are done


def skeleton(name: Column) -> Column:
    """The consonant skeleton of a lower-case surname: what its misspellings mostly leave as it is; '' stays ''."""
    t = F.translate(name, "cqzw", "kksv")
    head = F.regexp_replace(F.substring(t, 1, 1), "[aeiouy]", "a")
    return F.concat(head, F.regexp_replace(F.substring(t, 2, 1_000), "[aeiouyh]", ""))


def variant(a: Column, b: Column) -> Column:
    """Whether two skeletons are variants: within one edit, two if both are long, or the same letters with two of them exchanged."""
    d = F.levenshtein(a, b, MOST)
    letters = lambda x: F.array_sort(F.split(x, ""))
    return (d >= 0) & ((d <= 1) | (F.least(F.length(a), F.length(b)) >= LONG) | (letters(a) == letters(b)))


def _thinned(names: list[str], near: set[tuple[str, str]]) -> list[str]:
    """The names, in order, without those that an earlier one that is kept is near to."""
    beside: dict[str, set[str]] = {}
    for a, b in near:
        beside.setdefault(b, set()).add(a)
    kept: list[str] = []
    taken: set[str] = set()
    for x in names:
        if not beside.get(x, set()) & taken:
            kept.append(x)
            taken.add(x)
    return kept


def pivot_cells(names: DataFrame, pivots: int = PIVOTS, cover: int = COVER) -> DataFrame:
    """``name, n, cell, home``: the cells of each distinct name, its own one first among those that cover it, and replicas in earlier ones.

    ``names``: ``name, n``, rows that carry it. At most ``pivots`` names a round reach the driver and are broadcast; rounds
    end when no name is uncovered, and each covers all its pivots at least. A null name is in no cell.
    """
    spark = names.sparkSession
    tasks = _tasks(names)
    names = names.where("name is not null")
    open_ = names.repartition(tasks, "name")
    met: list[DataFrame] = []
    first = 0
    while True:
        chosen = [r["name"] for r in open_.orderBy(F.desc("n"), "name").limit(pivots).collect()]
        if not chosen:
            break
        some = spark.createDataFrame([(i, x) for i, x in enumerate(chosen)], "i int, pivot string")
        other = F.broadcast(some.select(F.col("i").alias("j"), F.col("pivot").alias("other")))
        near = some.join(other, (F.col("i") < F.col("j")) & (F.levenshtein("pivot", "other", cover) >= 0)).select("pivot", "other").collect()
        kept = _thinned(chosen, {(r["pivot"], r["other"]) for r in near})
        centres = F.broadcast(spark.createDataFrame([(first + i, x) for i, x in enumerate(kept)], "cell int, pivot string"))
        first += len(kept)
        d = F.levenshtein(F.col("name"), F.col("pivot"), cover + MOST)  # -1 beyond
        here = cut(open_.join(centres, d >= 0).select("name", "n", "cell", (d <= cover).alias("covers")))
        met.append(here)
        open_ = cut(open_.join(here.where("covers").select("name").distinct(), "name", "left_anti").repartition(tasks, "name"))
    if not met:
        return names.select("name", "n", F.lit(0).alias("cell"), F.lit(0).alias("home")).limit(0)
    cells = reduce(DataFrame.unionByName, met)
    home = F.min(F.when(F.col("covers"), F.col("cell"))).over(Window.partitionBy("name"))
    return cells.withColumn("home", home).where("cell <= home").select("name", "n", "cell", "home")


def _tasks(df: DataFrame) -> int:
    """Partitions for few bytes with much work, which adaptive execution would put into one."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def near_names(names: DataFrame, pivots: int = PIVOTS, cover: int = COVER) -> DataFrame:
    """``rare, common``: all pairs of different names that are variants, the one with more rows second.

    Each pair comes from one cell only, the home cell of the name whose pivot comes first. Names are distinct; an empty table gives none.
    """
    cells = pivot_cells(names, pivots, cover)
    cells = cut(cells.repartition(_tasks(names), "cell"))
    x = cells.where("cell = home").select("cell", F.col("name").alias("a"), F.col("n").alias("na"))
    y = cells.select("cell", F.col("name").alias("b"), F.col("n").alias("nb"), (F.col("cell") == F.col("home")).alias("own"))
    met = x.join(y, "cell").where((~F.col("own") | (F.col("a") < F.col("b"))) & variant(F.col("a"), F.col("b")))
    a_rare = (F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") > F.col("b"))
    return met.select(F.when(a_rare, F.col("a")).otherwise(F.col("b")).alias("rare"), F.when(a_rare, F.col("b")).otherwise(F.col("a")).alias("common"))


YEARS = 5  # years of a bucket
GAP = 2  # years that two rows about one person may differ by


def _banded(rows: DataFrame, to: str, kept: list[str], near: bool, names: bool) -> DataFrame:
    """``key, kind`` and the kept columns: a row for each block of name ``to`` that a row is in.

    A block is a name together with a first or middle initial and a unit, birth or death; with ``names`` also the name and
    initial alone. A row without a given name is in the blocks of all initials. ``near``: of the side that tries neighbouring
    years too.
    """
    letters = F.filter(F.split(F.concat("gi", F.when(F.col("gi") != "", F.col("mi")).otherwise("")), ""), lambda g: g != "")
    every = F.array(*[F.lit(x) for x in "abcdefghijklmnopqrstuvwxyz"])
    initials = F.when(F.col("gi") == "", every).otherwise(F.array_distinct(letters))
    block = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("long").alias("value"))
    of = lambda x, shift: F.floor((F.col(x) + shift) / YEARS)
    blocks = F.transform("units", lambda u: block("u", u))
    for kind, x in (("b", "birth"), ("d", "death")):
        years = F.array_distinct(F.array(block(kind, of(x, -GAP)), block(kind, of(x, GAP)))) if near else F.array(block(kind, of(x, 0)))
        blocks = F.concat(blocks, F.when(F.col(x).isNull(), F.slice(years, 1, 0)).otherwise(years))
    if names:
        blocks = F.concat(blocks, F.array(block("n", F.lit(0))))
    spread = rows.select(to, *kept, blocks.alias("blocks"), F.explode(initials).alias("initial")).select(to, *kept, "initial", F.explode("blocks").alias("block"))
    return spread.select(F.xxhash64(to, "initial", "block.kind", "block.value").alias("key"), F.col("block.kind").alias("kind"), *kept)


def candidate_parts(scratch: Scratch, features: DataFrame, weights: bool = False, pivots: int = PIVOTS, slice_rows: int = SLICE_ROWS) -> list[DataFrame]:
    """The pairs of ``candidate_pairs`` as kept tables, each pair in one of them by ``id_a``.

    Names are dealt into slices of about ``slice_rows`` rows, and the blocks of one slice are joined and dropped before the
    next. A block belongs to one name, so its size is known in its slice; an id that can be read in several ways may meet
    another in several slices, so what these found is put together at the end.
    """
    rows = features.select("id", "surname", "birth", "death", "gi", "mi", "units", skeleton(F.col("surname")).alias("name"))
    total = features.count()
    slices = max(1, math.ceil(total / slice_rows))
    within = lambda x, i: F.pmod(F.xxhash64(x), F.lit(slices)) == i
    names = scratch.keep(rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")))
    near = scratch.keep(near_names(names, pivots).select(F.col("rare").alias("name"), F.col("common").alias("to")))
    scratch.drop(names)
    best = [F.min("distance").alias("distance"), *[F.min(k).alias(k) for k in "ubdn" * weights]]
    found: list[DataFrame] = []
    for i in range(slices):
        met = _met(rows.where(within("name", i)), rows.join(near.where(within("to", i)), "name"), weights)
        found.append(scratch.keep(met.groupBy("id_a", "id_b").agg(*best)))
        scratch.drop()
    scratch.drop(near)
    bits = reduce(lambda a, b: a + b, [F.coalesce(F.log2(F.lit(total) / F.col(k)), F.lit(0.0)) for k in "ubdn"])
    kept = ["id_a", "id_b", "distance", *[bits.alias("weight")] * weights]
    every = reduce(DataFrame.unionByName, found)
    whole = lambda i: every.where(within("id_a", i)).groupBy("id_a", "id_b").agg(*best) if slices > 1 else every
    parts = [scratch.keep(whole(i).select(*kept)) for i in range(slices)]
    scratch.drop(*found)
    return parts


def _met(same: DataFrame, near: DataFrame, weights: bool) -> DataFrame:
    """``id_a, id_b, distance`` for each block in which two rows meet, and with ``weights`` the rows in it as ``u``, ``b``, ``d`` or ``n``, its kind.

    ``same``: rows by their own ``name``; ``near``: rows by the name ``to`` that theirs is near.
    """
    kept = ["id", "surname", "birth", "death"]
    y = _banded(same, "name", kept, True, True).drop("kind")
    x = _banded(same, "name", kept, False, True).withColumn("same", F.lit(True)).unionByName(_banded(near, "to", kept, False, False).withColumn("same", F.lit(False)))
    if weights:
        y = y.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("key")))
    c = F.col
    agree = lambda v: F.coalesce(F.abs(c(f"x.{v}") - c(f"y.{v}")) <= GAP, F.lit(True))
    d = F.levenshtein(c("x.surname"), c("y.surname"), EDITS)  # -1 beyond
    other = c("x.id") != c("y.id")
    met = x.alias("x").join(y.alias("y"), (c("x.key") == c("y.key")) & other & (~c("x.same") | (c("x.id") < c("y.id"))) & agree("birth") & agree("death") & (d >= 0))
    sizes = [F.when(c("x.kind") == k, c("y.size")).alias(k) for k in "ubdn" * weights]
    return met.select(F.least("x.id", "y.id").alias("id_a"), F.greatest("x.id", "y.id").alias("id_b"), d.alias("distance"), *sizes)


def candidate_pairs(features: DataFrame, weights: bool = False, pivots: int = PIVOTS) -> DataFrame:
    """``id_a, id_b, distance`` of rows with the same or a near name that share an attribute, and whose years don't contradict.

    Surnames are within ``EDITS``. With ``weights`` also ``weight``: the bits by which what they share is rare, the rarest block of
    each kind summed over kinds. Only the side with the rarer name is sent to the blocks of near names.
    """
    return reduce(DataFrame.unionByName, candidate_parts(Scratch(features.sparkSession), features, weights, pivots))


def weighed_pairs(features: DataFrame, pairs: DataFrame) -> DataFrame:
    """``id_a, id_b, score``: the pairs that nothing contradicts, with their evidence beyond chance in bits."""
    joined = pairs.join(features.alias("a"), F.col("id_a") == F.col("a.id")).join(features.alias("b"), F.col("id_b") == F.col("b.id"))
    return joined.select("id_a", "id_b", evidence(F.col("distance")).alias("score")).where("score is not null").groupBy("id_a", "id_b").agg(F.max("score").alias("score"))


def with_rarity_kept(scratch: Scratch, features: DataFrame) -> DataFrame:
    """``people.with_rarity`` as a kept table; the features are read once, though three counts hang on them."""
    read = scratch.keep(features)
    f = scratch.keep(with_rarity(read))
    scratch.drop(read)
    return f


def sure_pairs(scratch: Scratch, features: DataFrame, parts: list[DataFrame], margin: float, chosen: Callable[[DataFrame], DataFrame] = lambda part: part) -> DataFrame:
    """The pairs ``chosen`` of each part that score ``margin`` or more, as one kept table; drops the parts one after the other."""
    scored = []
    for part in parts:
        scored.append(scratch.keep(weighed_pairs(features, chosen(part)).where(F.col("score") >= margin)))
        scratch.drop(part)
    sure = scratch.keep(reduce(DataFrame.unionByName, scored))
    scratch.drop(*scored)
    return sure


def _carried(sure: DataFrame) -> DataFrame:
    """``id_a, id_b, path``: the pairs with a common neighbour, and the bits by which the best one has both its edges right."""
    either = sure.select(F.col("id_a").alias("id"), F.col("id_b").alias("next"), "score").unionByName(sure.select(F.col("id_b").alias("id"), F.col("id_a").alias("next"), "score"))
    x, y = either.select(F.col("id").alias("id_a"), "next", F.col("score").alias("s")), either.select(F.col("id").alias("id_b"), "next", F.col("score").alias("t"))
    path = F.least("s", "t") - F.log2(1 + F.pow(F.lit(2.0), -F.abs(F.col("s") - F.col("t"))))
    return x.join(y, "next").where("id_a < id_b").groupBy("id_a", "id_b").agg(F.max(path).alias("path"))


def propagated(scratch: Scratch, features: DataFrame, sure: DataFrame, margin: float) -> DataFrame:
    """``id_a, id_b, score``: ``sure`` and the pairs that become sure by their neighbours, until none does.

    Each round, every pair that isn't sure but has a sure neighbour in common is scored anew: what its own attributes
    agree in, and the bits by which both edges to the best such neighbour are right (its path stands for the chance
    that the pair alone has to overcome). A pair that any attribute contradicts never becomes sure. Nothing adds up over
    rounds; only the number of new pairs reaches the driver. ``sure`` is a kept table of ``scratch``, and so is the result.
    """
    at = F.levenshtein(F.col("a.surname"), F.col("b.surname"))
    new = sure
    while True:
        # only paths over an edge of the last round can be new
        ends = new.select(F.col("id_a").alias("id")).unionByName(new.select(F.col("id_b").alias("id"))).distinct()
        beside = sure.join(ends.withColumnRenamed("id", "id_a"), "id_a", "left_semi").unionByName(sure.join(ends.withColumnRenamed("id", "id_b"), "id_b", "left_semi")).distinct()
        open_ = scratch.keep(_carried(beside).join(sure, ["id_a", "id_b"], "left_anti"))
        scratch.drop(*[new] * (new is not sure))
        both = open_.join(features.alias("a"), F.col("id_a") == F.col("a.id")).join(features.alias("b"), F.col("id_b") == F.col("b.id")).where(at <= 2 * EDITS)
        new = scratch.keep(both.select("id_a", "id_b", (agreement() + F.col("path")).alias("score")).where(F.col("score") >= margin).groupBy("id_a", "id_b").agg(F.max("score").alias("score")))
        scratch.drop(open_)
        if not new.limit(1).count():
            scratch.drop(new)
            return sure
        before, sure = sure, scratch.keep(sure.unionByName(new))
        scratch.drop(before)


MARGIN = 0.0  # bits above chance from which a pair is sure: it is likelier than not


def link_names(features: DataFrame, margin: float = MARGIN, pivots: int = PIVOTS) -> DataFrame:
    """``id_a, id_b``: all pairs ``id_a < id_b`` of different ids whose rows name the same person.

    A pair is linked if its evidence exceeds what chance gives among the rows of its name by ``margin`` bits, by itself or
    carried by pairs that are (see ``propagated``). ``features``: see ``person_features``. Several rows of one id may
    differ; each is compared.
    """
    scratch = Scratch(features.sparkSession)
    f = with_rarity_kept(scratch, features)
    sure = sure_pairs(scratch, f, candidate_parts(scratch, f, pivots=pivots), margin)
    found = propagated(scratch, f, sure, margin).select("id_a", "id_b")
    scratch.drop(f)
    return found
