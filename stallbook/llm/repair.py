"""Conversation structure repair: weighted CYK over intervals of turns, with insertions.

A conversation is in order when its role initials read ``(s?(ua)+)?``. Turns may be kept, given another role, deleted,
and empty turns inserted; the cheapest edits win, of equally cheap ones those whose initials (D, I, K, R) come first.

The repair grammar has a nonterminal for every pair of states of that pattern ("from after x to after y") and binary
rules from-via, via-to alone, so it is in Chomsky normal form. A cell holds, per nonterminal, the least (cost, audit)
of an interval; a turn's cell is its keep, rerole and delete, closed under insertions on either side; longer
intervals come bottom-up from all their splits. An equally cheap audit is never another's beginning (that would take an
insertion more), so the least of a whole is made of the least of its parts and a long conversation can be parsed as a
tree: charts of ``LEAF`` turns, then charts of ``FAN`` such intervals. Up to ``BLOCK`` turns meet in one task; beyond
that, the blocks' cells are joined in further rounds of Spark jobs. A turn is one letter there; texts stay behind.

Results for odd rows: null roles and texts count as one space. Turns go by number (null first), ties by role, then by
a hash of the text; rows that repeat all of it are interchangeable. Rows with a null id are one conversation. Roles
other than the three are known by their first letter. An empty table gives an empty result. Other columns of the table
are not looked at, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import map_rows, text_hash
from stallbook.operators.ordered import split_running_sum
from stallbook.sources.shared import pinned

LEAF, FAN, BLOCK = 16, 8, 1024
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3      # costs

_STATES = "0SUE"        # before anything, after the system turn, after a user turn, after an assistant turn
_STEPS = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("E", "u"): "U", ("U", "a"): "E"}
_GONE = "x"             # a turn that must be deleted; others are their initial, in upper case when truncated
_WHITE = " \t\n\x0b\x0c\r"

Cell = dict[str, tuple[int, str]]       # from one state to another: (cost, audit)


# --- one conversation ---------------------------------------------------------

def _reachable() -> list[str]:
    pairs = {s + s for s in _STATES} | {p + q for (p, _), q in _STEPS.items()}
    while more := {a[0] + b[1] for a in pairs for b in pairs if a[1] == b[0]} - pairs:
        pairs |= more
    return sorted(pairs)


NONTERMINALS = _reachable()
_BINARY = [(a[0] + b[1], a, b) for a in NONTERMINALS for b in NONTERMINALS if a[1] == b[0]]


def joined(left: Cell, right: Cell, best: Cell | None = None) -> Cell:
    """All binary rules on two neighbouring intervals; keeps what is better in ``best``."""
    best = {} if best is None else best
    for whole, first, second in _BINARY:
        if first in left and second in right:
            (a, b), (c, d) = left[first], right[second]
            known = best.get(whole)
            if known is None or a + c < known[0] or a + c == known[0] and b + d < known[1]:
                best[whole] = (a + c, b + d)
    return best


@cache
def inserted() -> Cell:
    """What insertions alone reach: the cell of an interval without turns."""
    cell: Cell = {s + s: (0, "") for s in _STATES}
    step: Cell = {p + q: (INSERT, "I") for (p, initial), q in _STEPS.items() if initial in "ua"}
    while (further := joined(cell, step, dict(cell))) != cell:
        cell = further
    return cell


def turn_cell(turn: str) -> Cell:
    """The cell of one turn, closed under insertions before and after it."""
    cell: Cell = {s + s: (DELETE, "D") for s in _STATES}
    if turn != _GONE:
        more = TRUNCATED if turn.isupper() else 0
        for (p, initial), q in _STEPS.items():
            if initial == turn.lower():
                cell[p + q] = min((more, "K"), cell.get(p + q, (more, "K")))
            elif initial in "ua":
                cell[p + q] = min((REROLE + more, "R"), cell.get(p + q, (REROLE + more, "R")))
    return joined(joined(inserted(), cell), inserted())


def chart(units: list[Cell]) -> Cell:
    """The cell of all units together: every interval from all its splits, shorter intervals first."""
    cells = {(i, i + 1): cell for i, cell in enumerate(units)}
    for length in range(2, len(units) + 1):
        for i in range(len(units) - length + 1):
            best: Cell = {}
            for split in range(i + 1, i + length):
                joined(cells[i, split], cells[split, i + length], best)
            cells[i, i + length] = best
    return cells[0, len(units)]


@lru_cache(maxsize=20_000)
def _leaf(turns: str) -> Cell:
    return chart([turn_cell(turn) for turn in turns])


def parsed(turns: str) -> Cell:
    """The cell of any number of turns, as a tree of charts."""
    units = [_leaf(turns[k:k + LEAF]) for k in range(0, len(turns), LEAF)] or [inserted()]
    while len(units) > 1:
        units = [chart(units[k:k + FAN]) for k in range(0, len(units), FAN)]
    return units[0]


def cheapest(cell: Cell) -> tuple[int, str]:
    """The (cost, audit) of a whole conversation."""
    return min(cell[whole] for whole in ("00", "0E") if whole in cell)


# --- tables of conversations --------------------------------------------------

_CELL = "first string, last string, illegal long, cell array<struct<whole:string,cost:long,audit:string>>"
_LEGAL = ("su", "ua", "au")


def _packed(cell: Cell) -> list[dict]:
    return [{"whole": whole, "cost": cost, "audit": audit} for whole, (cost, audit) in cell.items()]


def _unpacked(cell: list[dict]) -> Cell:
    return {part["whole"]: (part["cost"], part["audit"]) for part in cell}


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(" "))


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text"))


def faults(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, place, initial, blank, duplicate, truncated) per turn, places from 1; texts stay behind.

    The first fault counts: blank, then the same role and text as an earlier turn, then no sentence's end.
    """
    end = F.rtrim("text", F.lit(_WHITE))
    narrow = _turns(conversations).select(
        "conv_id", "turn", "role", F.substring("role", 1, 1).alias("initial"),
        *[h.alias(f"h{k}") for k, h in enumerate(text_hash("role", "text"))], (end == "").alias("blank"),
        F.right(end, F.lit(1)).isin(".", "!", "?").alias("ended"), F.lit(1).cast("long").alias("one"))
    # ``row`` lets any number of rows that repeat each other be cut into ranges.
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("h0"), F.col("h1"), F.col("row")]
    placed = pinned(split_running_sum(narrow.withColumn("row", F.monotonically_increasing_id()), ["conv_id"], order, "one",
                                      "place"))
    same = (placed.groupBy(F.col("conv_id").alias("of"), F.col("h0").alias("g0"), F.col("h1").alias("g1"))
            .agg(F.min("place").alias("earliest"), F.count("*").alias("times")).where("times > 1"))
    found = placed.join(same, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("h0") == F.col("g0"))
                        & (F.col("h1") == F.col("g1")), "left")
    again = F.coalesce(F.col("place") > F.col("earliest"), F.lit(False))
    blank, ended = F.col("blank"), F.col("ended")
    return found.select("conv_id", "turn", "place", "initial", "blank", (~blank & again).alias("duplicate"),
                        (~blank & ~again & ~ended).alias("truncated"))


def _letter() -> Column:
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    return (F.when(F.col("blank") | F.col("duplicate"), F.lit(_GONE))
            .when(F.col("truncated"), F.upper(known)).otherwise(known))


def _of_blocks(ids: list, blocks: list, turns: list) -> Iterator[tuple]:
    for id_, block, found in zip(ids, blocks, turns):
        found = sorted(found, key=lambda t: t["place"])
        initials = [t["initial"] for t in found]
        illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
        cell = parsed("".join(t["letter"] for t in found))
        yield id_, block, initials[0], initials[-1], illegal, _packed(cell)


def _of_joined(ids: list, blocks: list, parts: list) -> Iterator[tuple]:
    for id_, block, found in zip(ids, blocks, parts):
        found = sorted(found, key=lambda part: part["block"])
        illegal = sum(part["illegal"] for part in found)
        illegal += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(found, found[1:]))
        cell = chart([_unpacked(part["cell"]) for part in found])
        yield id_, block, found[0]["first"], found[-1]["last"], illegal, _packed(cell)


def _of_whole(ids: list, illegal: list, cells: list) -> Iterator[tuple]:
    for id_, wrong, cell in zip(ids, illegal, cells):
        cost, audit = cheapest(_unpacked(cell))
        yield id_, wrong, cost, audit


def parses(found: DataFrame) -> DataFrame:
    """(conv_id, illegal, cost, audit) per conversation, from its ``faults``."""
    type_ = found.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {type_}, block long, {_CELL}"
    turns = found.select("conv_id", F.floor((F.col("place") - 1) / BLOCK).alias("block"),
                         F.struct("place", "initial", _letter().alias("letter")).alias("turn"))
    cells = pinned(map_rows(turns.groupBy("conv_id", "block").agg(F.collect_list("turn")), schema, _of_blocks))
    while (cells.agg(F.max("block").alias("last")).first()["last"] or 0) > 0:
        parts = cells.select("conv_id", F.floor(F.col("block") / FAN).alias("into"),
                             F.struct("block", "first", "last", "illegal", "cell").alias("part"))
        cells = pinned(map_rows(parts.groupBy("conv_id", "into").agg(F.collect_list("part")), schema, _of_joined))
    return map_rows(cells.select("conv_id", "illegal", "cell"),
                    f"conv_id {type_}, illegal long, cost long, audit string", _of_whole)


_NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def summaries(conversations: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation.

    ``every`` may name conversations (conv_id) of which no turn is left; they get zeros and an empty audit.
    """
    found = pinned(faults(conversations))
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = found.groupBy("conv_id").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(name).alias(name) for name in ("blank", "duplicate", "truncated")])
    parse = parses(found).withColumnRenamed("conv_id", "of")
    whole = counts.join(parse, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    if every is not None:
        ids = every.select(F.col("conv_id").alias("of")).distinct()
        whole = ids.join(whole, F.col("conv_id").eqNullSafe(F.col("of")), "left").withColumn("conv_id", F.col("of"))
    return whole.select("conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in _NUMBERS],
                        F.coalesce("audit", F.lit("")).alias("audit"))


_EDITED = "conv_id {0}, place long, edit string, role string, text string, " + ", ".join(f"{n} long" for n in _NUMBERS)


def _edited(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Conversations in order, each its summary and then its turns: the summary again (place -1), then what is left of
    the turns with the inserted ones among them."""
    audit, at, place, shift, id_ = "", 0, 0, 0, None
    rows: list[tuple] = []
    nothing = (None,) * len(_NUMBERS)

    def role() -> str:
        return "assistant" if (place - shift) % 2 else "user"

    def insertions() -> Iterator[tuple]:
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            yield (id_, place, "I", role(), "", *nothing)
            at, place = at + 1, place + 1

    def packed() -> pa.RecordBatch:
        columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        columns = batch.to_pydict()
        numbers = zip(*(columns[name] for name in _NUMBERS))
        for key, is_turn, name, text, known in zip(columns["conv_id"], columns["is_turn"], columns["role"], columns["text"],
                                                   numbers):
            if not is_turn:
                rows.extend(insertions())       # what the conversation before still wants
                id_, audit, at, place = key, text, 0, 0
                shift = (len(audit) - audit.count("D")) % 2     # an odd number of turns begins with the system's
                rows.append((id_, -1, audit, None, None, *known))
                continue
            rows.extend(insertions())
            edit = audit[at]
            at += 1
            if edit != "D":
                rows.append((id_, place, edit, name if edit == "K" else role(), text, *nothing))
                place += 1
            if len(rows) >= 512:
                yield packed()
                rows = []
    rows.extend(insertions())
    if rows:
        yield packed()


def edited(conversations: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Per conversation its summary (place -1, the audit as ``edit``), then its repaired turns by place, in order.

    A conversation's rows lie one after the other in one partition. Texts are shuffled once, and streamed from there.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    summary = pinned(summaries(conversations, every))
    type_ = conversations.schema["conv_id"].dataType.simpleString()
    none = [F.lit(None).cast("long").alias(n) for n in _NUMBERS]
    turns = _turns(conversations).select("conv_id", F.lit(True).alias("is_turn"), "turn", "role", "text",
                                         *[h.alias(f"h{k}") for k, h in enumerate(text_hash("role", "text"))], *none)
    heads = summary.select("conv_id", F.lit(False).alias("is_turn"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"),
                           F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("h0"),
                           F.lit(0).cast("long").alias("h1"), *_NUMBERS)
    order = ["conv_id", "is_turn", F.col("turn").asc_nulls_first(), "role", "h0", "h1"]
    ordered = heads.unionByName(turns).repartition("conv_id").sortWithinPartitions(*order)
    schema = _EDITED.format(type_)
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return (ordered.select("conv_id", "is_turn", "role", "text", *_NUMBERS)
            .mapInArrow(lambda batches: _edited(batches, arrow), schema))


def repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of every conversation after its cheapest repair."""
    return edited(conversations).where("place >= 0").select("conv_id", "place", "edit", "role", "text")


def digests(found: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) from ``edited``.

    The digest runs along with the stream, so no conversation is held whole.
    """
    type_ = found.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *_NUMBERS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["place"] < 0:
                    if summary is not None:
                        done.append((*summary, digest.hexdigest()))
                    summary = (row["conv_id"], *(row[n] for n in _NUMBERS), row["edit"])
                    digest = hashlib.sha256()
                else:
                    digest.update(f"{chr(10) if row['place'] else ''}{row['role']}:{row['text']}".encode())
            if done:
                yield _rows(done)
        if summary is not None:
            yield _rows([(*summary, digest.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in done], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = f"conv_id {type_}, " + ", ".join(f"{n} long" for n in _NUMBERS) + ", audit string, repaired_sha256 string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return found.mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with known faults, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the turn, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes it the user's. Nulls
    count as one space, but for the order of turns.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    marked = _turns(conversations).withColumn("damage", F.crc32(key) % 20).where("damage <> 0")
    damage = F.col("damage")
    text = (F.when(damage == 1, "").when(damage == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(damage == 4, "user").otherwise(F.col("role"))
    copies = F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")
