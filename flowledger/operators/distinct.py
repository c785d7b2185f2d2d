"""Exact distinct counts of stored days: numbered members in short lists and bitmaps.

A batch stores the distinct members of its keys as rows of text. Folding a day numbers its members once, in a dictionary
that all rollups share, and turns the rows into sets of numbers:

* up to ``FEW`` members of a key and measure are a sorted list in the key's own row of measures;
* more are bitmaps of 32,768 bits, one row for each stretch of numbers.

Counting a folded day adds up list sizes and set bits; no member is read as text or shuffled. Rows of batches that arrive
behind a folding are looked up: a member counts if the dictionary doesn't know it or its key's set doesn't hold it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowledger.operators.rollups import Rollup, merge_measures, merge_members

FEW = 128
BITS = 32_768  # of one bitmap, as Spark's bitmap functions have it
_DICTIONARY = ["day", "kind", "member"]


def list_name(measure: str) -> str:
    return f"{measure}_list"


def kind_of(rollup: Rollup) -> Column:
    """The kind of members a measure counts: the column of the records they come from."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in rollup.uniques.items() for x in pair]), F.col("measure"))


def texts(members: DataFrame) -> DataFrame:
    """The rows of batches among those of a members table."""
    return members.filter(F.col("bits").isNull())


def bitmaps(members: DataFrame) -> DataFrame:
    return members.filter(F.col("bits").isNotNull())


def seen_members(members: DataFrame, rollup: Rollup) -> DataFrame:
    """(day, kind, member) of the rows of text, as often as they are there."""
    return texts(members).select("day", kind_of(rollup).alias("kind"), "member")


def extended(dictionary: DataFrame, seen: DataFrame) -> DataFrame:
    """The dictionary (day, kind, member, number) with numbers for the members it doesn't have yet.

    Numbers known keep their meaning, new ones lie in stretches of their own. Members are dealt to slices of about half
    a stretch and numbered within these, so no task numbers a whole day.
    """
    new = seen.distinct().join(dictionary, _DICTIONARY, "left_anti")
    taken = dictionary.groupBy("day", "kind").agg((F.max(F.bitmap_bucket_number("number"))).alias("taken"))
    slices = new.groupBy("day", "kind").agg(F.ceil(F.count(F.lit(1)) / (BITS // 2)).alias("slices"))
    sizes = slices.join(taken, ["day", "kind"], "left")  # one row for each day and kind
    dealt = new.join(F.broadcast(sizes), ["day", "kind"]).withColumn("slice", F.pmod(F.xxhash64("member"), "slices"))
    rank = F.row_number().over(Window.partitionBy("day", "kind", "slice").orderBy("member")) - 1
    stretch = F.coalesce("taken", F.lit(0)) + F.floor(rank / BITS) * F.col("slices") + F.col("slice")
    numbered = dealt.select(*_DICTIONARY, (stretch * BITS + rank % BITS + 1).cast("bigint").alias("number"))
    return dictionary.select(*_DICTIONARY, "number").unionByName(numbered)


def _numbered(members: DataFrame, dictionary: DataFrame, rollup: Rollup, how: str) -> DataFrame:
    """Distinct (keys, measure, number) of the members that are rows of text."""
    rows = merge_members(texts(members), rollup).withColumn("kind", kind_of(rollup))
    return rows.join(dictionary.select(*_DICTIONARY, "number"), _DICTIONARY, how)


def _listed(measures: DataFrame, rollup: Rollup) -> DataFrame:
    """(keys, measure, number) of the members in lists."""
    lists = F.array(*[F.struct(F.lit(name).alias("measure"), F.col(list_name(name)).alias("numbers")) for name in rollup.uniques])
    return measures.select(*rollup.group_keys, F.inline(lists)).select(*rollup.group_keys, "measure", F.explode("numbers").alias("number"))


def _place(rollup: Rollup) -> Column:
    """A number for a key and measure. Several may share one, so it tells rows apart only where that does no harm."""
    return F.xxhash64(*rollup.group_keys, "measure").alias("place")


def crowded(measures: DataFrame, members: DataFrame, rollup: Rollup) -> DataFrame:
    """(place) of the keys and measures that may have too many members for a list: every row of text and every number
    of a list counts, whether it comes again or not, and those with bitmaps are among them.

    Only numbers are shuffled, added up before, so a busy key sends one row a task.
    """
    lists = F.array(*[F.struct(F.lit(name).alias("measure"), F.size(list_name(name)).alias("n")) for name in rollup.uniques])
    listed = measures.select(*rollup.group_keys, F.inline(lists)).filter("n > 0").select(_place(rollup), "n")
    rows = texts(members).select(_place(rollup), F.lit(1).alias("n")).unionByName(listed)
    rows = rows.unionByName(bitmaps(members).select(_place(rollup), F.lit(FEW + 1).alias("n")))
    return rows.groupBy("place").agg(F.sum("n").alias("n")).filter(F.col("n") > FEW).select("place")


def _held(measures: DataFrame, members: DataFrame, dictionary: DataFrame, places: DataFrame, how: str, rollup: Rollup) -> DataFrame:
    """(keys, measure, number) of the members in rows of text and in lists, of some places only or without these."""
    rows = texts(members).select(*rollup.group_keys, "measure", "member", _place(rollup)).join(places, "place", how)
    numbered = rows.withColumn("kind", kind_of(rollup)).join(dictionary.select(*_DICTIONARY, "number"), _DICTIONARY)
    listed = _listed(measures, rollup).withColumn("place", _place(rollup)).join(places, "place", how)
    return numbered.select(*rollup.group_keys, "measure", "number").unionByName(listed.drop("place"))


def sets(measures: DataFrame, members: DataFrame, dictionary: DataFrame, places: DataFrame, rollup: Rollup) -> DataFrame:
    """(keys, measure, stretch, numbers): the members at crowded places that are not in bitmaps already, as sets of at most
    ``BITS`` numbers.

    Rows of text are looked up as they are, and what several batches or lists have in common is dropped where the sets are
    made, so each member is shuffled once for its number and once for its set. A busy key has a set for each stretch.
    """
    held = _held(measures, members, dictionary, places, "left_semi", rollup)
    place = [*rollup.group_keys, "measure", "stretch"]
    dealt = held.withColumn("stretch", F.bitmap_bucket_number("number")).repartition(*place)
    return dealt.groupBy(*place).agg(F.collect_set("number").alias("numbers"))


def _many(sets: DataFrame, members: DataFrame, rollup: Rollup) -> DataFrame:
    """Keys and measures with too many members for a list."""
    keys = [*rollup.group_keys, "measure"]
    large = sets.groupBy(*keys).agg(F.sum(F.size("numbers")).alias("n")).filter(F.col("n") > FEW).drop("n")
    return large.unionByName(bitmaps(members).select(*keys)).distinct()


def folded_members(sets: DataFrame, members: DataFrame, rollup: Rollup) -> DataFrame:
    """Bitmaps (keys, measure, stretch, bits) of the keys and measures that are too large for lists."""
    keys = [*rollup.group_keys, "measure"]
    rows = sets.join(_many(sets, members, rollup), keys, "left_semi").select(*keys, "stretch", F.explode("numbers").alias("number"))
    made = rows.groupBy(*keys, "stretch").agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    both = made.unionByName(bitmaps(members).select(*keys, "stretch", "bits"))
    return both.groupBy(*keys, "stretch").agg(F.bitmap_or_agg("bits").alias("bits")).withColumn("member", F.lit(None).cast("string"))


def folded_measures(measures: DataFrame, sets: DataFrame, members: DataFrame, dictionary: DataFrame, places: DataFrame, rollup: Rollup) -> DataFrame:
    """Measures of equal keys put together, with the lists of their members. A list has at most ``FEW`` numbers.

    Members away from crowded places go straight to their key's lists; of the sets those follow that turned out small.
    """
    keys = [*rollup.group_keys, "measure"]
    small = sets.join(_many(sets, members, rollup), keys, "left_anti").select(*keys, F.explode("numbers").alias("number"))
    rows = _held(measures, members, dictionary, places, "left_anti", rollup).unionByName(small).repartition(*rollup.group_keys)
    lists = [F.sort_array(F.collect_set(F.when(F.col("measure") == name, F.col("number")))).alias(list_name(name)) for name in rollup.uniques]
    return merge_measures(measures, rollup).join(rows.groupBy(*rollup.group_keys).agg(*lists), list(rollup.group_keys), "left")


def _new_rows(measures: DataFrame, members: DataFrame, dictionary: DataFrame, rollup: Rollup) -> DataFrame:
    """(keys, measure) of each distinct text member that its key's numbered members don't hold."""
    keys = [*rollup.group_keys, "measure"]
    rows = _numbered(members, dictionary, rollup, "left").withColumn("stretch", F.bitmap_bucket_number("number"))
    listed = _listed(measures, rollup).distinct().withColumn("listed", F.lit(True))
    mapped = bitmaps(members).groupBy(*keys, "stretch").agg(F.bitmap_or_agg("bits").alias("bits"))
    place = F.bitmap_bit_position("number")
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (place % 8).cast("int")) == 1
    found = rows.join(listed, [*keys, "number"], "left").join(mapped, [*keys, "stretch"], "left")
    return found.filter(F.col("listed").isNull() & ~F.coalesce(is_set, F.lit(False))).select(*keys)


def distinct_counts(
    measures: DataFrame, members: DataFrame, dictionary: DataFrame, rollup: Rollup, folded: list, late: list, closed: DataFrame | None = None
) -> DataFrame:
    """One row for each key with its exact distinct counts.

    ``folded``: days with numbered members; ``late``: those of them that have rows of text as well, which only these days
    look up. ``closed``: finished counts of closed days. Every part is added up before it is shuffled.
    """
    names, day = list(rollup.uniques), F.col("day")
    is_late = day.isin(late) if late else F.lit(False)
    rows = merge_members(texts(members).filter(~is_late), rollup).select(*rollup.group_keys, "measure")
    if late:
        rows = rows.unionByName(_new_rows(measures.filter(is_late), members.filter(is_late), dictionary.filter(is_late), rollup))
    parts = [rows.select(*rollup.group_keys, *[(F.col("measure") == name).cast("bigint").alias(name) for name in names])]
    if folded:
        own = day.isin(folded)
        parts.append(measures.filter(own).select(*rollup.group_keys, *[F.size(F.coalesce(list_name(name), F.array().cast("array<bigint>"))).cast("bigint").alias(name) for name in names]))
        parts.append(bitmaps(members).filter(own).select(*rollup.group_keys, *[F.when(F.col("measure") == name, F.bitmap_count("bits")).alias(name) for name in names]))
    if closed is not None:
        parts.append(closed.select(*rollup.group_keys, *names))
    together = reduce(DataFrame.unionByName, parts)
    return together.groupBy(*rollup.group_keys).agg(*[F.sum(name).alias(name) for name in names])
