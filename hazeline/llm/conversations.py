"""Conversations whose turns alternate: what is wrong with each, and the cheapest repair.

Turns are taken by number, null first; turns of one number by role and then by the SHA-256 of their text. Null
roles and texts count as one space. A turn's first fault counts: *blank*, no character but ASCII white
space; *duplicate*, role and text of an earlier turn of the conversation; *truncated*, the last character
other than white space is none of ``.!?``. Blank and duplicate turns must go.

The repair (``alignment``) needs one character per turn, so one task works on a conversation's characters
and digests, in one shuffle that carries no text; a second shuffle brings its edits and its texts
together, in order, and streams them. So a conversation that holds a large part of all turns takes one
task long, but memory only for some hundred bytes per turn, and never for its texts. (Its audit is one value and
its hash one chain over all its texts, so that no other task could take part of the latter.)

Null ids are one conversation. An empty table gives an empty result. Repeated rows are turns like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from hazeline.llm.alignment import align

#: White space, as in ``[\x20\x09-\x0D]``.
SPACE = " \t\n\x0b\x0c\r"
#: Initials of roles that may follow each other.
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: Rows and characters of an Arrow batch of results.
BATCH_ROWS, BATCH_CHARS = 5_000, 1 << 22


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(" "))


def damage(
    turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Turns with known faults, chosen by the CRC-32 of ``id:turn``, for tests of a repair.

    Of 20 remainders, 0 marks the turn ``gone``, 1 empties its text, 2 removes its ``.!?``, 3 repeats it and 4
    makes the user its speaker. Returns ``id, turn, role, text, gone``; nulls are one space, but for ids and numbers.
    """
    key = F.concat(_spaced(id_col), F.lit(":"), _spaced(turn_col))
    fate = F.crc32(key.cast("binary")) % 20
    text = (
        F.when(F.col("fate") == 1, F.lit(""))
        .when(F.col("fate") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    plain = turns.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn_col}`").alias("turn"),
        _spaced(role_col).alias("role"), _spaced(text_col).alias("text"), fate.alias("fate"),
    )
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return plain.select(
        "id", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("fate") == 0).alias("gone"), F.explode(times).alias("copy"),
    ).drop("copy")


def _prepared(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, gone_col: str | None) -> DataFrame:
    gone = F.coalesce(F.col(f"`{gone_col}`"), F.lit(False)) if gone_col else F.lit(False)
    picked = turns.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        _spaced(role_col).alias("role"), _spaced(text_col).alias("text"), gone.alias("gone"),
    )
    return picked.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    order = ["id", *first, F.col("turn").asc_nulls_first(), "role", "digest"]
    return rows.repartition("id").sortWithinPartitions(*order)


def _schema(id_type: DataType, longs: Iterable[str], strings: Iterable[str]) -> StructType:
    fields = [StructField("id", id_type)]
    fields += [StructField(name, LongType()) for name in longs]
    return StructType(fields + [StructField(name, StringType()) for name in strings])


class _Batches:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, names: list[str], types: list[pa.DataType]):
        self.schema = pa.schema(list(zip(names, types)))
        self.rows: list[tuple] = []
        self.chars = 0

    def add(self, row: tuple) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += sum(len(value) for value in row if isinstance(value, str))
        if len(self.rows) >= BATCH_ROWS or self.chars >= BATCH_CHARS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            arrays = [pa.array(column, field.type) for column, field in zip(zip(*self.rows), self.schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self.rows, self.chars = [], 0


class _Conversation:
    """What is known of a conversation from the turns read so far."""

    def __init__(self) -> None:
        self.seen: set[tuple[str, bytes]] = set()
        self.turns: list[str] = []
        self.numbers: list[int] = []
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.before: str | None = None

    def add(self, turn: int | None, role: str, digest: bytes, blank: bool, truncated: bool) -> None:
        initial = role[:1]
        self.faults["illegal"] += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        fault = "blank" if blank else "duplicate" if (role, digest) in self.seen else "truncated" if truncated else ""
        self.seen.add((role, digest))
        letter = initial if initial and initial in "sua" else "x"
        if fault:
            self.faults[fault] += 1
            letter = letter.upper() if fault == "truncated" else "-"
        self.turns.append(letter)
        # Turns come in order: the first, the last and their number say all about gaps.
        if turn is not None and (not self.numbers or turn != self.numbers[1]):
            self.numbers = [self.numbers[0], turn, self.numbers[2] + 1] if self.numbers else [turn, turn, 1]

    def report(self) -> tuple:
        gaps = self.numbers[1] - self.numbers[0] + 1 - self.numbers[2] if self.numbers else 0
        cost, audit = align("".join(self.turns))
        return gaps, *self.faults.values(), cost, audit


def audits(
    turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", gone_col: str | None = None,
) -> DataFrame:
    """Per conversation: ``id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``gaps`` counts the numbers missing between the first and the last turn, ``illegal`` neighbours whose roles
    do not follow each other; ``audit`` has the initial of each edit of the cheapest repair. Turns marked in
    ``gone_col`` do not count, but their conversations are listed.
    """
    return _audits(_prepared(turns, id_col, turn_col, role_col, text_col, gone_col))


def _audits(prepared: DataFrame) -> DataFrame:
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    narrow = prepared.select(
        "id", "gone", "turn", "role", "digest", (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    schema = _schema(prepared.schema["id"].dataType, COUNTS, ["audit"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = key = known = None
        for batch in batches:
            if out is None:
                out = _Batches(schema.names, [batch.schema.field("id").type, *[pa.int64()] * 6, pa.string()])
            for number, gone, *turn in zip(*(column.to_pylist() for column in batch.columns)):
                if known is None or number != key:
                    if known is not None:
                        yield from out.add((key, *known.report()))
                    key, known = number, _Conversation()
                if not gone:
                    known.add(*turn)
        if known is not None:
            yield from out.add((key, *known.report()))
            yield from out.rest()

    return _in_order(narrow, "gone").mapInArrow(run, schema)


class _Repair:
    """Applies a conversation's edits to its turns, in order; each call gives what comes next."""

    def __init__(self, audit: str):
        self.audit, self.at, self.expected = audit, 0, "u"

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            yield self._placed("Insert", ROLES[self.expected], "")

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        if edit == "D":
            self.at += 1
        elif edit == "R":
            yield self._placed("Rerole", ROLES[self.expected], text)
        else:
            yield self._placed("Keep", role, text)

    def _placed(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        self.at += 1
        if role[:1] != "s":
            self.expected = "a" if role[:1] == "u" else "u"
        return edit, role, text


def _edited(
    prepared: DataFrame, schema: StructType, types: list[pa.DataType],
    begin: Callable[[tuple], object], place: Callable[[object, tuple[str, str, str]], Iterable[tuple]],
    end: Callable[[object], Iterable[tuple]],
) -> DataFrame:
    """Edits and turns of each conversation together: ``begin`` makes a state of its audit, ``place`` sees each
    turn of the repaired conversation, ``end`` its last. The latter two return rows, without the id."""
    plans = _audits(prepared).withColumn("kind", F.lit(0))
    texts = prepared.filter(~F.col("gone")).drop("gone").withColumn("kind", F.lit(1))
    both = plans.unionByName(texts, allowMissingColumns=True)
    both = _in_order(both.select("id", "kind", *COUNTS, "audit", "turn", "role", "digest", "text"), "kind")
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = key = repair = state = None

        def finish() -> Iterator[pa.RecordBatch]:
            for left in repair.inserts():
                for row in place(state, left):
                    yield from out.add((key, *row))
            for row in end(state):
                yield from out.add((key, *row))

        for batch in batches:
            if out is None:
                out = _Batches(names, [batch.schema.field("id").type, *types])
            columns = {name: batch.column(name).to_pylist() for name in ("id", "kind", "audit", "role", "text")}
            counts = [batch.column(name).to_pylist() for name in COUNTS]
            for at, (number, kind, audit, role, text) in enumerate(zip(*columns.values())):
                if kind == 0:
                    if repair is not None:
                        yield from finish()
                    key, repair = number, _Repair(audit)
                    state = begin((*(values[at] for values in counts), audit))
                    continue
                for turn in repair.turn(role, text):
                    for row in place(state, turn):
                        yield from out.add((key, *row))
        if repair is not None:
            yield from finish()
            yield from out.rest()

    return both.drop("turn", "digest").mapInArrow(run, schema)


def repaired(
    turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", gone_col: str | None = None,
) -> DataFrame:
    """The turns of the repaired conversations: ``id, position, edit, role, text``, numbered from 0."""
    prepared = _prepared(turns, id_col, turn_col, role_col, text_col, gone_col)
    schema = _schema(prepared.schema["id"].dataType, ["position"], ["edit", "role", "text"])

    def begin(report: tuple) -> list[int]:
        return [0]

    def place(state: list[int], turn: tuple[str, str, str]) -> Iterator[tuple]:
        yield state[0], *turn
        state[0] += 1

    return _edited(prepared, schema, [pa.int64(), *[pa.string()] * 3], begin, place, lambda state: ())


def reports(
    turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", gone_col: str | None = None,
) -> DataFrame:
    """``audits`` with ``repaired_sha256``, of the repaired ``role:text`` of each turn, joined by line breaks."""
    prepared = _prepared(turns, id_col, turn_col, role_col, text_col, gone_col)
    schema = _schema(prepared.schema["id"].dataType, COUNTS, ["audit", "repaired_sha256"])

    def begin(report: tuple) -> dict:
        return {"report": report, "hash": hashlib.sha256(), "empty": True}

    def place(state: dict, turn: tuple[str, str, str]) -> Iterable[tuple]:
        _, role, text = turn
        state["hash"].update(f"{'' if state['empty'] else chr(10)}{role}:{text}".encode())
        state["empty"] = False
        return ()

    def end(state: dict) -> Iterator[tuple]:
        yield *state["report"], state["hash"].hexdigest()

    return _edited(prepared, schema, [*[pa.int64()] * 6, pa.string(), pa.string()], begin, place, end)
