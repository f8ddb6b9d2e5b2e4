"""Line dedup across documents: equal lines, and lines one word apart by a deletion-neighbourhood join.

A line's neighbourhood is the line and every variant with one word left out. Two lines are at most one word apart
(one replaced, added or missing) if they share a variant with the same place left out, or one is a variant of the
other. Variants are joined as 64-bit keys, and the words of each pair found are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import text_hash
from stallbook.operators.ordered import split_running_sum
from stallbook.sources.shared import pinned

LEAST_WORDS = 10     # shorter lines are only compared as a whole: one word is too much of them
FILTER_BITS = 1 << 23     # of the bitmap that finds the rows to move: 1 MB
_BLOCK = 256
_ROW = ["id", "r1", "r2"]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once: a lambda's variable isn't copied into its uses."""
    return F.transform(F.array(value), body)[0]


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _odd(text: Column) -> Column:
    """Whether ``text`` has white space other than single spaces between words and newlines.

    Plain searches: one regular expression for all of them takes several times as long, as it tries each at every letter.
    """
    found = F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" "))
    for space in ["\t", "\v", "\f", "\r", "  ", " \n", "\n "]:
        found = found | F.contains(text, F.lit(space))
    return F.coalesce(found, F.lit(False))


def _plain(line: Column, odd: Column) -> Column:
    """A line's words, joined by one space; only texts with odd white space have to be changed for it."""
    return F.when(odd, F.trim(F.regexp_replace(line, "[\\x09-\\x0D\\x20]+", " "))).otherwise(line)


def _halves(line: Column, n: Column) -> Column:
    """Keys of which two lines one word apart share at least one; ``line`` is ``n`` words, joined by one space.

    Let the shorter have c words. The difference lies either behind the first c/2 words or before the last c/2, so
    one of these stretches is equal. A line is the shorter or as long for c = n, the longer for c = n - 1. Stretches
    are hashed as they stand in the line, not as lists of words, which would have to be taken apart.
    """
    def keys(c: Column) -> list[Column]:
        half = (c / 2).cast("int")
        return [F.xxhash64(F.lit("head"), c, F.call_function("substring_index", line, F.lit(" "), half)),
                F.xxhash64(F.lit("tail"), c, F.call_function("substring_index", line, F.lit(" "), -half))]

    return F.array(*keys(n), *keys(n - 1))


def _neighbourhood(words: Column) -> Column:
    """(whole, variants): a hash of the words in their places, and one without each word.

    A sequence's hash is the XOR of its words' hashes with their places. Without word i, the words before it keep
    their places and those after it move up by one, so one pass with two running XORs gives all variants. Blocks
    keep the pass linear in the line's length, as appending copies what is there.
    """
    state = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("here"), F.lit(0).cast("long").alias("moved"),
                     F.array().cast("array<bigint>").alias("out"))

    def word(s: Column, w: Column) -> Column:
        moved = s["moved"].bitwiseXOR(F.xxhash64(w, s["at"] - 1))
        return F.struct((s["at"] + 1).alias("at"), s["here"].bitwiseXOR(F.xxhash64(w, s["at"])).alias("here"),
                        moved.alias("moved"), F.concat(s["out"], F.array(s["here"].bitwiseXOR(moved))).alias("out"))

    def block(s: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(s["at"].alias("at"), s["here"].alias("here"), s["moved"].alias("moved"),
                                           F.array().cast("array<bigint>").alias("out")), word)
        return _let(inner, lambda r: F.struct(r["at"].alias("at"), r["here"].alias("here"), r["moved"].alias("moved"),
                                              F.concat(s["out"], F.array(r["out"])).alias("out")))

    outer = F.struct(state["at"].alias("at"), state["here"].alias("here"), state["moved"].alias("moved"),
                     F.array().cast("array<array<bigint>>").alias("out"))
    blocks = F.transform(F.sequence(F.lit(0), ((F.size(words) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(words, b * _BLOCK + 1, F.lit(_BLOCK)))
    return F.aggregate(blocks, outer, block, lambda s: F.struct(
        s["here"].alias("whole"),
        F.transform(F.flatten(s["out"]), lambda v: v.bitwiseXOR(s["moved"])).alias("variants")))


def _one_word_apart(x: Column, y: Column) -> Column:
    """Whether two lists of words are at most one replacement, addition or removal apart."""
    def added(longer: Column, shorter: Column) -> Column:
        differs = F.zip_with(longer, shorter, lambda a, b: ~a.eqNullSafe(b))
        place = F.array_position(differs, True).cast("int")
        return F.slice(longer, place + 1, F.size(longer)) == F.slice(shorter, place, F.size(longer))

    return F.when(F.size(x) == F.size(y), F.size(F.filter(F.zip_with(x, y, lambda a, b: a != b), lambda d: d)) <= 1) \
        .when(F.size(x) == F.size(y) + 1, added(x, y)).when(F.size(y) == F.size(x) + 1, added(y, x)) \
        .otherwise(F.lit(False))


def _row(documents: DataFrame, id_column: str, text_column: str) -> list[Column]:
    """What tells a document from others: its id and 128 bits of id and text."""
    r1, r2 = text_hash(id_column, text_column)
    return [F.col(id_column).alias("id"), r1.alias("r1"), r2.alias("r2")]


def _lines(rows: DataFrame) -> DataFrame:
    """(id, r1, r2, number, line) for every line with words of ``rows`` (id, r1, r2, text).

    What holds for the whole text is worked out inside the generator: beside it, Spark would do so for every line.
    """
    once = F.struct(F.col("r1").alias("r1"), F.col("r2").alias("r2"), _odd(F.col("text")).alias("odd"))
    each = _let(once, lambda known: F.transform(_split(F.col("text")), lambda line, at: F.struct(
        known["r1"].alias("r1"), known["r2"].alias("r2"), at.alias("number"), _plain(line, known["odd"]).alias("line"))))
    return rows.select("id", F.inline(each)).where("line <> ''")


def _may_be_among(hashes: DataFrame, name: str = "r1") -> Column:
    """Whether a row's hash ``name`` may be one of those in the same column of ``hashes``: never wrongly no.

    A bitmap of ``FILTER_BITS`` bits, whatever the number of hashes, goes to every task. It keeps most rows without a
    part in a join from being moved for it; the join decides.
    """
    at = F.pmod(F.col(name), F.lit(FILTER_BITS))
    word, bit = (at / 64).cast("long"), F.pmod(at, F.lit(64)).cast("int")
    every = hashes.sparkSession.range(FILTER_BITS // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    maps = hashes.select(word.alias("word"), one.alias("bits")).unionAll(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    # Written down, because the plan asks for it in several places.
    known = pinned(maps.agg(F.transform(in_order, lambda part: part["bits"]).alias("known"))).scalar()
    return F.coalesce(F.getbit(F.get(known, word.cast("int")), bit) == 1, F.lit(False))


def _near_earlier(distinct: DataFrame, rows: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that an earlier line is one word apart from; ``distinct`` has h1, h2, first and keys.

    Lines that share no half with another line have no neighbour. Only the others are looked up again with their
    words and emit their variants, numbered in their order, so that what travels is a hash and a number. A group of
    lines that share a variant at one place only names its earliest, so a group of any size gives a row per line.
    """
    keys = distinct.select("h1", F.explode("keys").alias("key"))
    shared = pinned(keys.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
                    .where("low <> high").select("key"))
    met = pinned(keys.where(_may_be_among(shared, "key")).join(shared, "key", "left_semi").select("h1").distinct())
    kept = distinct.where(_may_be_among(met, "h1")).join(met, "h1", "left_semi")
    numbered = split_running_sum(kept.select("h1", "h2", "first", F.lit(1).cast("long").alias("one")), [],
                                 [F.col("first"), F.col("h1"), F.col("h2")], "one", "at")
    crowd = pinned(numbered.select("h1", "h2", "at", "first.*"))
    # Each line's words from the document where it comes first.
    wanted = rows.where(_may_be_among(crowd.select("r1"))).join(crowd.groupBy(*_ROW).agg(
        F.collect_list(F.struct("number", "at")).alias("wanted")).withColumnsRenamed({"id": "of", "r1": "o1", "r2": "o2"}),
        F.col("id").eqNullSafe(F.col("of")) & (F.col("r1") == F.col("o1")) & (F.col("r2") == F.col("o2")))
    taken = wanted.select(_odd(F.col("text")).alias("odd"), _let(_split(F.col("text")), lambda parts: F.transform("wanted", lambda w: F.struct(
        w["at"].alias("at"), F.get(parts, w["number"]).alias("line")))).alias("taken"))
    known = taken.select("odd", F.inline("taken")).dropDuplicates(["at"]).select(
        "at", F.split(_plain(F.col("line"), F.col("odd")), " ").alias("words"))
    known = pinned(known)
    near = known.select("at", _neighbourhood(F.col("words")).alias("near"))
    variants = pinned(near.select("at", F.col("near.whole").alias("whole"), F.posexplode("near.variants").alias("place", "v")))
    # Replaced: the same variant at the same place.
    placed = variants.select("at", F.xxhash64("v", "place").alias("key"))
    earliest = pinned(placed.groupBy("key").agg(F.min("at").alias("early"), F.max("at").alias("late"))
                      .where("early < late").select("key", "early"))
    replaced = placed.where(_may_be_among(earliest, "key")).join(earliest, "key").where("early < at").select(
        F.col("at").alias("late"), "early")
    # Added or missing: one line's variant is the other as a whole.
    whole = pinned(variants.where("place = 0").select(F.col("whole").alias("v"), F.col("at").alias("other")))
    added = variants.where(_may_be_among(whole, "v")).select("at", "v").join(whole, "v").select(
        F.greatest("at", "other").alias("late"), F.least("at", "other").alias("early"))
    pairs = replaced.unionAll(added.where("early < late")).distinct()
    found = (pairs.join(known.select(F.col("at").alias("late"), "words"), "late")
             .join(known.select(F.col("at").alias("early"), F.col("words").alias("others")), "early"))
    apart = found.where(_one_word_apart(F.col("words"), F.col("others"))).select(F.col("late").alias("at")).distinct()
    return crowd.join(apart, "at", "left_semi").select("h1", "h2")


def dedup_lines(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` with repeated lines taken out of the text, and ``__lines_dropped``, how many went.

    Lines end at newlines and are compared by their words, whatever white space lies between. A line goes if an
    equal line stands earlier, or, from LEAST_WORDS words on, a line one word apart. Earlier is by id (null first),
    then by a hash of id and text, then by the line's place. Lines without words stay. All other columns and all
    rows stay, whatever their names, but for a column that is already called ``__lines_dropped``, which is replaced; a
    null text stays null, a text that loses every line becomes empty. Rows that repeat id and text are one document
    and get the same result; an empty table gives an empty result.
    """
    rows = documents.select(*_row(documents, id_column, text_column), F.col(text_column).alias("text"))
    n = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1
    keys = F.when(F.col("n") >= LEAST_WORDS, F.array_distinct(_halves(F.col("line"), F.col("n"))))
    h1, h2 = text_hash("line")
    place = [*_ROW, "number"]
    lines = pinned(_lines(rows).withColumn("n", n).select(*place, h1.alias("h1"), h2.alias("h2"), keys.alias("keys")))
    distinct = pinned(lines.groupBy("h1", "h2").agg(
        F.min(F.struct(*place)).alias("first"), F.count("*").alias("n"), F.first("keys").alias("keys")))
    near = pinned(_near_earlier(distinct.where(F.col("keys").isNotNull()), rows).withColumn("near", F.lit(True)))
    affected = distinct.select("h1", "h2", "first", "n").where((F.col("n") > 1) | _may_be_among(near, "h1"))
    affected = pinned(affected.join(near, ["h1", "h2"], "left").where("n > 1 or near"))
    gone = lines.select(*place, "h1", "h2").where(_may_be_among(affected, "h1")).join(affected, ["h1", "h2"]) \
        .where(F.col("near").isNotNull() | ~F.struct(*place).eqNullSafe(F.col("first")))
    gone = pinned(gone.groupBy(*_ROW).agg(F.collect_set("number").alias("numbers")))

    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                             *_row(documents, id_column, text_column))
    gone = gone.withColumnsRenamed({"id": "of", "r1": "s1", "r2": "s2"})
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("s1") == F.col("r1")) & (F.col("s2") == F.col("r2"))
    text = F.col("row").getField(text_column)

    def rest(parts: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("numbers"))
        return F.array_join(F.transform(places, lambda at: F.get(parts, at)), "\n")

    kept = F.when(F.col("numbers").isNotNull(), _let(_split(text), rest)).otherwise(text)
    columns = [kept.alias(c) if c == text_column else F.col("row").getField(c).alias(c)
               for c in documents.columns if c != "__lines_dropped"]
    columns.append(F.coalesce(F.size("numbers"), F.lit(0)).cast("long").alias("__lines_dropped"))
    # Documents that certainly keep all their lines stay where they are.
    changed = _may_be_among(gone.select(F.col("s1").alias("r1")))
    untouched = whole.where(~changed).withColumn("numbers", F.lit(None).cast("array<int>"))
    return whole.where(changed).join(gone, same, "left").select(*columns).unionAll(untouched.select(*columns))
