"""Conversation structure repair by the auction algorithm for shortest paths.

A conversation, its rows by turn, is to have role initials ``(s?(ua)+)?``. Its lattice has a node for
each number of rows read and each state (start, after s, after u, after a); arcs are edits:

    D delete a row, 3; the only way out for a blank or duplicate row
    I insert an empty user or assistant row, 2
    K keep a row whose role fits, 0
    R give a row the role that fits, 2

and a truncated row that stays adds 1. The state says which role fits, so letters lead to one node
each. The auction keeps a path from the start and a price per node, prices never above cost + price
of any arc's end. If the path's last node costs less than its cheapest arc, its price rises to that
and the path contracts; else the path extends along a tight arc (price = cost + price of its end).
Among tight arcs the one of least letter is taken: an arc passed over is tight no more, and prices
only rise, so the path that reaches the end is the cheapest, and of the cheapest the one whose
letters are ASCII-least.

Prices rise by integers from their start values up to the distances, so an auction over a whole long
conversation is quadratic. The lattice is therefore cut every ``BLOCK`` rows: from the last block to
the first, auctions from the four states at a block's begin converge the prices there, which end the
paths of the block before; then each block's path is traced from the state where the one before
ended. Time is linear in the rows, and kept in memory are one byte a row and four prices a block.

Spark deals rows by conversation and sorts them; tasks read them as a stream, so neither the texts of
a long conversation nor all its rows are held at once. A row's text is represented by its SHA-256
until the edits are known.

Defined cases: nulls count as one space (a null text is blank, a null role fits nothing; a null
conv_id is a conversation of its own). Rows are ordered by turn, nulls first, rows of one turn by role
and SHA-256 of the text. An empty table gives an empty result; a conversation without rows has audit
'' and no repaired rows. Very long texts are read once and hashed once. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import arrays as A
from .common import Scratch

SPACES = " \t\n\x0b\x0c\r"
BLOCK = 16  # rows whose lattice one auction covers
FITS = (2, 2, 3, 2)  # the state after the role that fits a state
KEEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})  # state -> role (0 s, 1 u, 2 a) -> state after it
NAMES = {2: "user", 3: "assistant"}
OTHER = 3


def _arcs(role: int, fault: int, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """(letter, cost, rows read, state after), letters ascending. fault: 1 must go, 2 truncated."""
    out = [("D", 3, 1, state), ("I", 2, 0, FITS[state])]
    if fault != 1:
        if role in KEEP[state]:
            out.append(("K", fault // 2, 1, KEEP[state][role]))
        out.append(("R", 2 + fault // 2, 1, FITS[state]))
    return tuple(out)


ARCS = {role * 3 + fault: tuple(_arcs(role, fault, s) for s in range(4)) for role in range(4) for fault in range(3)}
END = tuple((("I", 2, 0, FITS[s]),) if s in (1, 2) else (("", 0, 1, 0), ("I", 2, 0, FITS[s])) for s in range(4))


class Auction:
    """Prices of one block: nodes (rows read, state) as 4 * rows + state, exits with known prices."""

    def __init__(self, arcs: list, exits: tuple[int, ...]):
        self.arcs, self.last = arcs, 4 * len(arcs)
        self.price = [min(exits)] * self.last + list(exits)

    def path(self, state: int) -> tuple[int, str, int]:
        """The distance from a state at the block's begin, the letters of the path and its exit state."""
        price, arcs = self.price, self.arcs
        at, letters = [state], []
        while (node := at[-1]) < self.last:
            row, s = divmod(node, 4)
            best = None
            for letter, cost, step, t in arcs[row][s]:
                to = 4 * (row + step) + t
                total = cost + price[to]
                if best is None or total < best:
                    best, arc, end = total, letter, to
            if price[node] < best:
                price[node] = best
                if len(at) > 1:
                    at.pop()
                    letters.pop()
            else:
                at.append(end)
                letters.append(arc)
        return price[state], "".join(letters), at[-1] - self.last


def cheapest_edits(codes: bytes | bytearray, block: int = BLOCK) -> tuple[int, str]:
    """Least cost and ASCII-least letters for rows given as 3 * role + fault."""
    steps = [*range(0, len(codes), block)] or [0]
    last = steps[-1]

    def auction(lo: int, exits: tuple[int, ...]) -> Auction:
        arcs = [ARCS[c] for c in codes[lo:lo + block]]
        return Auction([*arcs, END] if lo == last else arcs, exits)

    exits = {last: (0, 0, 0, 0)}
    for lo in reversed(steps[1:]):
        a = auction(lo, exits[lo])
        exits[lo - block] = tuple(a.path(s)[0] for s in range(4))
    cost, state, out = None, 0, []
    for lo in steps:
        total, letters, state = auction(lo, exits[lo]).path(state)
        cost = total if cost is None else cost
        out.append(letters)
    return cost, "".join(out)


# ---- rows -------------------------------------------------------------------------------
def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """The rows with seeded faults; a row that is dropped stays, marked, so that its conversation does."""
    part = F.crc32(F.encode(F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn"))), "UTF-8")) % 20
    d = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), _text(F.col("role")).alias("role"),
                    _text(F.col("text")).alias("text"), part.alias("part"))
    text = F.when(F.col("part") == 1, "").when(F.col("part") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return d.select("conv_id", "turn", F.when(F.col("part") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    (F.col("part") == 0).alias("dropped"),
                    F.explode(F.when(F.col("part") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", F.sha2(F.encode("text", "UTF-8"), 256))


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "key")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """Rows of a stream sorted by conversation, and whether a new conversation begins."""
    first, name = True, None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            yield first or row[0] != name, row
            first, name = False, row[0]


def _send(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096, most_bytes: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    out, n = [], 0
    for row in rows:
        out.append(row)
        n += sum(len(x) for x in row if isinstance(x, str))
        if len(out) == most or n > most_bytes:
            yield _send(out, schema)
            out, n = [], 0
    if out:
        yield _send(out, schema)


class _Tally:
    """Faults of one conversation, row by row."""

    def __init__(self, name):
        self.name, self.codes = name, bytearray()
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def add(self, turn, initial, role, fault) -> None:
        self.codes.append(3 * role + (fault if fault < 2 else fault - 1))
        self.blank += fault == 1
        self.duplicate += fault == 2
        self.truncated += fault == 3
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def row(self) -> tuple:
        cost, audit = cheapest_edits(self.codes)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.name, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def audit(rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text, dropped) -> a row a conversation: gaps, blank, duplicate,
    truncated, illegal, cost, audit (the letters of the cheapest edits)."""
    rest = F.rtrim("text", F.lit(SPACES))
    light = _keyed(rows).select("conv_id", "turn", "role", "key", "dropped", (rest == "").alias("blank"),
                                (~F.substring(rest, -1, 1).isin(".", "!", "?")).alias("cut"))
    seen = Window.partitionBy("conv_id", "dropped", "role", "key").orderBy(F.col("turn").asc_nulls_first())
    light = light.withColumn("nth", F.row_number().over(seen))
    fault = F.when(F.col("blank"), 1).when(F.col("nth") > 1, 2).when(F.col("cut"), 3).otherwise(0)
    sent = _ordered(light.select("conv_id", "turn", "role", "key", "dropped", fault.alias("fault"))).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "dropped", "fault")
    kind = rows.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    schema = A.arrow_schema(ddl)

    def rows_of(batches):
        tally = None
        for new, (name, turn, initial, dropped, fault) in _grouped(batches):
            if new:
                if tally:
                    yield tally.row()
                tally = _Tally(name)
            if not dropped:
                tally.add(turn, initial, {"s": 0, "u": 1, "a": 2}.get(initial, OTHER), fault)
        if tally:
            yield tally.row()
    return sent.mapInArrow(lambda batches: _batched(rows_of(batches), schema), ddl)


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows after the audited edits, conversation by conversation in order: conv_id, place (from
    1), edit, role, text. A conversation lies whole and sorted in one partition."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, place long, edit string, role string, text string"
    schema = A.arrow_schema(ddl)
    body = _keyed(rows.filter(~F.col("dropped"))).select("conv_id", "turn", "role", "text", "key", F.lit(1).alias("part"))
    head = audits.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"),
                         F.lit("").alias("key"), F.lit(0).alias("part"))
    sent = head.unionByName(body).repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", F.col("turn").asc_nulls_first(), "role", "key").select("conv_id", "part", "role", "text")

    def rows_of(batches):
        name, letters, at, state, place = None, "", 0, 0, 0

        def inserted():
            nonlocal at, state, place
            while at < len(letters) and letters[at] == "I":
                at, state, place = at + 1, FITS[state], place + 1
                yield name, place, "I", NAMES[state], ""
        for new, (conv, part, role, text) in _grouped(batches):
            if new:
                yield from inserted()
                name, letters, at, state, place = conv, text, 0, 0, 0
                continue
            yield from inserted()
            edit, at = letters[at], at + 1
            if edit == "D":
                continue
            if edit == "R":
                state = FITS[state]
                role = NAMES[state]
            else:
                state = KEEP[state][{"s": 0, "u": 1, "a": 2}[role[:1]]]
            place += 1
            yield name, place, edit, role, text
        yield from inserted()
    return sent.mapInArrow(lambda batches: _batched(rows_of(batches), schema), ddl)


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines; rows as ``repaired`` gives them."""
    ddl = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string"
    schema = A.arrow_schema(ddl)

    def rows_of(batches):
        name, sha = None, None
        for new, (conv, place, _, role, text) in _grouped(batches):
            if new:
                if sha:
                    yield name, sha.hexdigest()
                name, sha = conv, hashlib.sha256()
            sha.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        if sha:
            yield name, sha.hexdigest()
    return rows.mapInArrow(lambda batches: _batched(rows_of(batches), schema), ddl)


def repair_report(conversations: DataFrame) -> DataFrame:
    """Conversations damaged by rule, repaired, and reported: one row for every conv_id."""
    rows = damage(conversations)
    audits = Scratch(conversations.sparkSession).write(audit(rows))
    sums = digests(repaired(rows, audits)).withColumnRenamed("conv_id", "of")
    empty = hashlib.sha256().hexdigest()
    return audits.join(sums, audits.conv_id.eqNullSafe(sums.of), "left").select(
        *audits.columns, F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
