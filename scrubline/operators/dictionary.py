"""Names from dictionary tables: groups by sex and first letters, popularity, one row a lookup.

A dictionary is a DataFrame of any size.  Its names stand in groups by sex and
first two letters, in each by descending weight, with the weights added up.  A
lookup is for a name of a person: a hash chooses a group among those of the sex
that are large enough and begin with another letter, a second one a place in it,
as often as its weight says.  The place is found by an equi-join, since the added
weights are laid out in as many equal cells as the group has names, so that a
cell holds two or three of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubline.functions.hashing import keyed_index
from scrubline.sources.scratch import new_path


class DictionaryError(ValueError):
    pass


@dataclass(frozen=True)
class NameTable:
    """names: (sex, pair, cell, low, high, name), a row for each cell that a name reaches into;
    groups: (sex, letter, k, pair, total, size), the k-th group for names that begin with a letter;
    counts: how many groups a (sex, letter) has."""

    names: DataFrame
    groups: DataFrame
    counts: dict[tuple[str, str], int]


def _letter(name: Column) -> Column:
    """The first letter in upper case; ``-`` for what is no letter from A to Z."""
    first = F.upper(F.substring(name, 1, 1))
    return F.when(first.rlike("^[A-Z]"), first).otherwise(F.lit("-"))


def name_table(entries: DataFrame, least: int = 20) -> NameTable:
    """The table of entries (sex, name, weight long): groups with fewer than ``least`` names are not chosen from.

    A name that stands twice for a sex (in any case), or a weight under 1, is an error.
    """
    spark = entries.sparkSession
    rows = entries.where(F.col("name").isNotNull() & (F.col("name") != "") & F.col("sex").isNotNull())
    again = rows.groupBy("sex", F.lower("name").alias("n")).count().where("count > 1").select("n")
    if few := [r.n for r in again.limit(5).collect()]:
        raise DictionaryError(f"more than once in the dictionary: {', '.join(few)}")
    if rows.where(F.coalesce(F.col("weight"), F.lit(0)) < 1).limit(1).count():
        raise DictionaryError("a weight is under 1")
    pair = F.concat(_letter(F.col("name")), F.lower(F.substring("name", 2, 1)))
    own = Window.partitionBy("sex", "pair")
    order = own.orderBy(F.desc("weight"), "name")
    placed = rows.withColumn("pair", pair).select(
        "sex", "pair", "name", "weight", (F.sum("weight").over(order) - F.col("weight")).alias("low"), F.sum("weight").over(order).alias("high"),
        F.sum("weight").over(own).alias("total"), F.count("*").over(own).alias("size"))
    path = new_path(spark, "dictionary")
    width = F.ceil(F.col("total") / F.col("size"))
    cells = F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))
    placed.select("sex", "pair", "name", "low", "high", "total", "size", F.explode(cells).alias("cell")).write.parquet(path)
    names = spark.read.parquet(path)
    large = names.where("low = 0 AND cell = 0").where(F.col("size") >= least).select("sex", "pair", "total", "size")
    letters = spark.createDataFrame([(c,) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ-"], "letter string")
    # at most 27 times the groups of a sex, which are as many as there are pairs of letters
    other = large.join(F.broadcast(letters), F.substring("pair", 1, 1) != F.col("letter"))
    groups = other.withColumn("k", F.row_number().over(Window.partitionBy("sex", "letter").orderBy("pair")) - 1)
    counts = {(r.sex, r.letter): r.n for r in groups.groupBy("sex", "letter").agg(F.count("*").alias("n")).collect()}
    return NameTable(names.select("sex", "pair", "cell", "low", "high", "name"), groups.select("sex", "letter", "k", "pair", "total", "size"), counts)


def look_up(requests: DataFrame, table: NameTable, salt: str, person: str = "person", word: str = "word", sex: str = "sex", out: str = "surrogate") -> DataFrame:
    """requests plus a name of the dictionary for each row's (person, word, sex): the same for equal
    ones, of the sex, with another first letter, popular ones oftener.  Null where the word or the
    sex is, or where the dictionary has no large enough group.  Joins go by the sizes that Spark sees."""
    if not table.counts:
        return requests.withColumn(out, F.lit(None).cast("string"))
    letter = _letter(F.col(word))
    counts = F.create_map(*[F.lit(x) for (s, c), n in table.counts.items() for x in (f"{s}|{c}", n)])
    n = F.when(F.col(word).isNotNull(), F.try_element_at(counts, F.concat(F.col(sex), F.lit("|"), letter)))
    asked = requests.withColumns({"__letter": letter, "__k": _index(salt + "#group", F.col(person), F.col(word), n)})
    g = table.groups.select(F.col("sex").alias("__s"), F.col("letter").alias("__c"), F.col("k").alias("__g"), F.col("pair").alias("__pair"), "total", "size")
    grouped = asked.join(g, (F.col(sex) == F.col("__s")) & (F.col("__letter") == F.col("__c")) & (F.col("__k") == F.col("__g")), "left")
    grouped = grouped.withColumn("__at", _index(salt + "#place", F.col(person), F.col(word), F.col("total")))
    grouped = grouped.withColumn("__cell", F.floor(F.col("__at") / F.ceil(F.col("total") / F.col("size")))).drop("total", "size")
    names = table.names.select(F.col("sex").alias("__s2"), F.col("pair").alias("__p2"), F.col("cell").alias("__c2"), F.col("low").alias("__low"),
                               F.col("high").alias("__high"), F.col("name").alias(out))
    there = (F.col("__s") == F.col("__s2")) & (F.col("__pair") == F.col("__p2")) & (F.col("__cell") == F.col("__c2"))
    found = grouped.join(names, there & (F.col("__at") >= F.col("__low")) & (F.col("__at") < F.col("__high")), "left")
    return found.drop("__letter", "__k", "__s", "__c", "__g", "__pair", "__at", "__cell", "__s2", "__p2", "__c2", "__low", "__high")


def _index(salt: str, person: Column, word: Column, n: Column) -> Column:
    return keyed_index(salt, person, word, 1 << 31) % n


def surrogates_of(known: DataFrame, fields: list[tuple[str, str]], table: NameTable, salt: str, person: str = "person_id", sex: str = "sex",
                  out: str = "surrogates") -> DataFrame:
    """known (a row a person) plus ``out``, a map from the lower-case words of its name fields to
    names of the dictionary.  fields: (column, layout as ``L,F``).  Last names come from the
    dictionary's sex ``L``, first ones from the row's.  ``names.known_names`` takes such a map."""
    from scrubline.operators.names import typed_words

    words = F.flatten(F.array(*[typed_words(F.col(c), layout, []) for c, layout in fields]))
    each = known.select(F.col(person).alias("__person"), F.col(sex).alias("__sex"), F.explode(words).alias("w")).where("w.kind IS NOT NULL")
    each = each.select("__person", F.col("w.word").alias("__word"), F.when(F.col("w.kind") == "L", F.lit("L")).otherwise(F.col("__sex")).alias("__kind")).distinct()
    found = look_up(each, table, salt, "__person", "__word", "__kind", "__new").where(F.col("__new").isNotNull())
    maps = found.groupBy("__person").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__word", "__new")))).alias(out))
    return known.join(maps, F.col(person) == F.col("__person"), "left").drop("__person")
