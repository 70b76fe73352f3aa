"""Cheapest repair of damaged conversations, by a checkpointed dynamic programme.

The repaired roles must read ``(s?(ua)+)?`` by their initials. Four states tell
how far that has come (nothing yet, after s, after u, after a). The programme
runs over one symbol per row: the kind of its role and its first fault. Going
backward it keeps the vector of the four states' least costs only at every
square root of the number of rows; going forward it computes the vectors
between two checkpoints again and takes, at each step, the ASCII-least letter
that is still on a cheapest path. The letters so far tell the state, so that
choice is the ASCII-least audit.

A conversation may hold any share of all rows. Rows are put in order by one
range sort of narrow rows (no texts), and each range holds one block of a
conversation at most. Blocks of a conversation that spans several ranges are
joined as checkpoints of a higher level: each block gives its least costs from
state to state, one small row per block is folded backward into the vectors at
the blocks' ends, each block then tells where its cheapest path leads from each
state, and folding that forward gives the state in which each block begins.

Texts are moved once, to the task that hashes their conversation row by row in
constant memory: a SHA-256 over a whole conversation cannot be split. The audit
of a conversation is one value, as long as the conversation has rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, map_task, stored, tasks_for

ROWS_PER_TASK = 500_000

# Costs of the edits; an undeleted truncated row costs TRUNCATED more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ENDLESS = 1 << 60

# States, by the last role given.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
AFTER = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
# Rows to insert behind the last one.
LACKING = {START: 0, AFTER_S: 2, AFTER_U: 1, AFTER_A: 0}
END = tuple(INSERT * LACKING[state] for state in STATES)
ROLES = {"u": "user", "a": "assistant"}

# A row's symbol: the place of its role's initial in INITIALS and its fault in FAULTS.
INITIALS = "sua-"
FAULTS = "nbdt"  # none, blank, duplicate, truncated
SYMBOLS = {
    initial + fault: chr(ord("A") + 4 * i + k)
    for i, initial in enumerate(INITIALS)
    for k, fault in enumerate(FAULTS)
}
ROW_OF = {symbol: row for row, symbol in SYMBOLS.items()}
LEGAL = {"su", "ua", "au"}

SPACES = " \t\n\x0b\x0c\r"
REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


# The programme over symbols


def expected(state: int) -> str:
    """The initial that must follow, but for an s at the start."""
    return "a" if state == AFTER_U else "u"


@lru_cache(maxsize=None)
def row_edits(state: int, symbol: str) -> tuple[tuple[str, int, int], ...]:
    """(letter, cost, next state) of the edits of a row, by letter."""
    initial, fault = ROW_OF[symbol]
    found = [("D", DELETE, state)]
    if fault in "nt":
        extra = TRUNCATED if fault == "t" else 0
        wanted = expected(state)
        if initial == wanted:
            found.append(("K", KEEP + extra, AFTER[wanted]))
        elif initial == "s" and state == START:
            found.append(("K", KEEP + extra, AFTER_S))
        found.append(("R", REROLE + extra, AFTER[wanted]))
    return tuple(found)


def above_least(costs: list[int] | tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    """The least cost and the costs above it; what cannot be reached stays endless."""
    least = min(costs)
    return least, tuple(ENDLESS if cost >= ENDLESS // 2 else cost - least for cost in costs)


@lru_cache(maxsize=1 << 16)
def step_back(behind: tuple[int, ...], symbol: str) -> tuple[int, tuple[int, ...]]:
    """From the costs behind a row to those before it: what the least grows by, and the costs above it."""
    costs = [
        min(cost + behind[to] for _, cost, to in row_edits(state, symbol)) for state in STATES
    ]
    for _ in STATES:  # rows inserted before it
        for state in STATES:
            costs[state] = min(costs[state], INSERT + costs[AFTER[expected(state)]])
    return above_least(costs)


@lru_cache(maxsize=1 << 16)
def step_forward(
    state: int, before: tuple[int, ...], grown: int, behind: tuple[int, ...], symbol: str
) -> tuple[str, int]:
    """The least letters on a cheapest path up to and including a row's own, and the state behind it."""
    letters = ""
    while True:
        tight = [
            (letter, to)
            for letter, cost, to in row_edits(state, symbol)
            if cost + behind[to] == before[state] + grown
        ]
        after_insert = AFTER[expected(state)]
        if INSERT + before[after_insert] == before[state]:
            tight.append(("I", after_insert))
        letter, state = min(tight)
        letters += letter
        if letter != "I":
            return letters, state


def backward(symbols: str, ends: tuple[int, ...]) -> tuple[tuple[int, ...], list[tuple[int, ...]]]:
    """The costs before the first row, and the vectors kept at checkpoints, the end's last.

    Checkpoints lie at every square root of the number of rows; their vectors
    are above their least. ``ends`` are the costs behind the last row.
    """
    width = isqrt(len(symbols)) + 1
    least, vector = above_least(ends)
    kept = [vector]
    for at in range(len(symbols) - 1, -1, -1):
        grown, vector = step_back(vector, symbols[at])
        least += grown
        if at % width == 0:
            kept.append(vector)
    return tuple(min(least + cost, ENDLESS) for cost in vector), kept[::-1]


def forward(
    symbols: str, kept: list[tuple[int, ...]], state: int
) -> tuple[str, int]:
    """The ASCII-least cheapest edits of the rows from a state, and the state behind the last row.

    The vectors between two checkpoints are computed again when the walk gets there.
    """
    width = isqrt(len(symbols)) + 1
    found = []
    for number, first in enumerate(range(0, len(symbols), width)):
        part = symbols[first : first + width]
        vectors, growths = [kept[number + 1]], []
        for symbol in reversed(part):
            grown, vector = step_back(vectors[-1], symbol)
            vectors.append(vector)
            growths.append(grown)
        for symbol in part:
            before = vectors.pop()
            letters, state = step_forward(state, before, growths.pop(), vectors[-1], symbol)
            found.append(letters)
    return "".join(found), state


def cheapest_audit(symbols: str) -> str:
    """The audit of a whole conversation."""
    _, kept = backward(symbols, END)
    letters, state = forward(symbols, kept, START)
    return letters + "I" * LACKING[state]


# Rows, blocks and their edits


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the rows that are left after the damage of op12's contract.

    Null roles and texts are one space first; so are null ids and turns where
    they choose the damage, but not in the result.
    """
    key = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    kind = F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20
    plain = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        kind.alias("kind"),
    ).where("kind <> 0")
    return plain.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.expr("sequence(1, if(kind = 3, 2, 1))")).alias("copy"),
    ).drop("copy")


def _rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest); rows of a turn are put in order by the digest of role and text."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    size = F.length("role").cast("string")
    joined = F.concat(size, F.lit(":"), F.col("role"), F.lit(":"), F.col("text"))
    return rows.withColumn("digest", F.unhex(F.md5(joined.cast("binary"))))


def _blocks(rows: DataFrame, rows_per_task: int) -> DataFrame:
    """(conv_id, range_no, symbols, first_row): the rows of a conversation that lie in one range, in order."""
    end = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv_id",
        "turn",
        "digest",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
        F.when(end == "", "b")
        .when(F.substring(end, -1, 1).isin(".", "!", "?"), "n")
        .otherwise("t")
        .alias("fault"),
    )
    parts = tasks_for(rows.count(), rows_per_task)
    order = ["conv_id", "turn", "digest"]
    dealt = narrow.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The partition's number stands in the upper bits, so positions follow the order of all rows.
    dealt = stored(dealt.withColumn("position", F.monotonically_increasing_id()), "turns")
    seen = F.col("fault") != "b"
    firsts = dealt.where(seen).groupBy("conv_id", "digest").agg(F.min("position").alias("position"))
    # Joined by position, so that a text that is repeated very often is no hot key.
    firsts = firsts.select("position", F.lit(True).alias("is_first"))
    symbols = F.create_map(*[F.lit(x) for pair in SYMBOLS.items() for x in pair])
    fault = F.when(seen & F.col("is_first").isNull(), "d").otherwise(F.col("fault"))
    marked = dealt.join(firsts, "position", "left").select(
        "conv_id",
        F.shiftright("position", 33).cast("int").alias("range_no"),
        "position",
        symbols[F.concat("initial", fault)].alias("symbol"),
        F.struct("turn", "digest").alias("key"),
    )
    # At most the rows of a range meet in a group.
    row = F.struct("position", "symbol")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(row)), lambda x: x["symbol"]), "")
    return stored(
        marked.groupBy("conv_id", "range_no").agg(
            joined.alias("symbols"), F.min_by("key", "position").alias("first_row")
        ),
        "turn-blocks",
    )


def _audits(blocks: DataFrame) -> DataFrame:
    """Blocks with their part of the audit."""
    # A range has at most two conversations that go on beyond it.
    many = blocks.groupBy("conv_id").agg(F.count("*").alias("blocks")).where("blocks > 1")
    many = stored(many.select("conv_id"), "long-conversations")
    same = blocks["conv_id"].eqNullSafe(many["conv_id"])

    def alone(batch: pa.RecordBatch) -> dict:
        columns = {name: batch.column(name) for name in batch.schema.names}
        return columns | {"audit": [cheapest_audit(x) for x in columns["symbols"].to_pylist()]}

    single = blocks.join(F.broadcast(many), same, "left_anti")
    schema = _with(blocks, "audit string")
    audited = map_batches(single, alone, schema)
    if many.take(1):
        parts = stored(blocks.join(F.broadcast(many), same, "left_semi"), "long-blocks")
        audited = audited.unionByName(_joined_audits(parts))
    return audited


def _with(df: DataFrame, more: str) -> str:
    return ", ".join([f"{name} {kind}" for name, kind in df.dtypes] + [more])


def _joined_audits(blocks: DataFrame) -> DataFrame:
    """The audits of conversations of several blocks."""
    names = blocks.columns

    def between(batch: pa.RecordBatch) -> dict:
        """Least costs from state to state over a block."""
        rows = []
        for symbols in batch.column("symbols").to_pylist():
            to = [tuple(0 if s == end else ENDLESS for s in STATES) for end in STATES]
            columns = [backward(symbols, ends)[0] for ends in to]
            rows.append([columns[end][state] for state in STATES for end in STATES])
        return {"conv_id": batch.column("conv_id"), "range_no": batch.column("range_no"), "costs": rows}

    def fold_back(batch: pa.RecordBatch) -> dict:
        """The costs at the end of each block of a conversation."""
        found = {"conv_id": [], "range_no": [], "ends": [], "is_last": []}
        for conv_id, parts in zip(batch.column("conv_id").to_pylist(), batch.column("parts").to_pylist()):
            ends = END
            for part in reversed(parts):
                found["conv_id"].append(conv_id)
                found["range_no"].append(part["range_no"])
                found["ends"].append(list(ends))
                found["is_last"].append(part is parts[-1])
                cost = part["value"]
                ends = tuple(
                    min(cost[len(STATES) * state + end] + ends[end] for end in STATES)
                    for state in STATES
                )
        return found

    def walks(batch: pa.RecordBatch) -> dict:
        """Each block's edits from each state, and where they lead."""
        columns = {name: batch.column(name) for name in names}
        audits, exits = [], []
        for symbols, ends in zip(columns["symbols"].to_pylist(), batch.column("ends").to_pylist()):
            _, kept = backward(symbols, tuple(ends))
            found = [forward(symbols, kept, state) for state in STATES]
            audits.append([letters for letters, _ in found])
            exits.append([state for _, state in found])
        return columns | {"audits": audits, "exits": exits, "is_last": batch.column("is_last")}

    def fold_on(batch: pa.RecordBatch) -> dict:
        """The state in which each block begins."""
        found = {"conv_id": [], "range_no": [], "entry": []}
        for conv_id, parts in zip(batch.column("conv_id").to_pylist(), batch.column("parts").to_pylist()):
            state = START
            for part in parts:
                found["conv_id"].append(conv_id)
                found["range_no"].append(part["range_no"])
                found["entry"].append(state)
                state = part["value"][state]
        return found

    def by_conversation(values: DataFrame, column: str) -> DataFrame:
        """One row per conversation, with a value of constant size per block."""
        part = F.struct("range_no", F.col(column).alias("value"))
        return values.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        same = left["conv_id"].eqNullSafe(right["conv_id"]) & (left["range_no"] == right["range_no"])
        return left.join(right, same).drop(right["conv_id"]).drop(right["range_no"])

    costs = map_batches(blocks, between, "conv_id long, range_no int, costs array<long>")
    ends = map_batches(
        by_conversation(costs, "costs"),
        fold_back,
        "conv_id long, range_no int, ends array<long>, is_last boolean",
    )
    walked = map_batches(
        joined(blocks, ends),
        walks,
        _with(blocks, "audits array<string>, exits array<int>, is_last boolean"),
    )
    walked = stored(walked, "block-audits")
    entries = map_batches(
        by_conversation(walked, "exits"), fold_on, "conv_id long, range_no int, entry int"
    )
    lacking = F.array(*[F.lit(LACKING[state]) for state in STATES])
    at = F.col("entry") + 1
    tail = F.expr("repeat('I', lacking)")
    return (
        joined(walked, entries)
        .withColumn(
            "lacking",
            F.when(F.col("is_last"), F.element_at(lacking, F.element_at("exits", at) + 1)).otherwise(0),
        )
        .select(*blocks.columns, F.concat(F.element_at("audits", at), tail).alias("audit"))
    )


class _Conversation:
    """What the rows of a conversation, as they pass by, come to."""

    def __init__(self, conv_id: int | None, gaps: int | None) -> None:
        self.conv_id, self.gaps = conv_id, gaps
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal = self.cost = 0
        self.last_initial = None
        self.audits: list[str] = []
        self.letters: Iterator[str] = iter(())
        self.state = START
        self.hash, self.lines = hashlib.sha256(), 0

    def block(self, symbols: str, audit: str) -> None:
        self.audits.append(audit)
        self.letters = iter(audit)
        faults = iter(symbols)
        for letter in audit:
            if letter == "I":
                self.cost += INSERT
            elif letter == "D":
                self.cost += DELETE
                next(faults)
            else:
                extra = TRUNCATED if ROW_OF[next(faults)][1] == "t" else 0
                self.cost += extra + (KEEP if letter == "K" else REROLE)
        for initial, fault in map(ROW_OF.__getitem__, symbols):
            self.counts[fault] += 1
            if self.last_initial is not None and self.last_initial + initial not in LEGAL:
                self.illegal += 1
            self.last_initial = initial

    def _inserted(self) -> tuple[str, str]:
        initial = expected(self.state)
        self.state = AFTER[initial]
        return ROLES[initial], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The repaired rows up to and including that of a row."""
        for letter in self.letters:
            if letter == "I":
                yield self._inserted()
                continue
            if letter == "D":
                return
            initial = "s" if letter == "K" and role.startswith("s") else expected(self.state)
            self.state = AFTER[initial]
            yield (role if letter == "K" else ROLES[initial]), text
            return

    def rest(self) -> Iterator[tuple[str, str]]:
        for _ in self.letters:
            yield self._inserted()

    def take(self, rows: Iterator[tuple[str, str]]) -> None:
        for role, text in rows:
            line = f"{role}:{text}".encode()
            self.hash.update(b"\n" + line if self.lines else line)
            self.lines += 1

    def report(self) -> tuple:
        counts = [self.counts[fault] for fault in "bdt"]
        audit = "".join(self.audits)
        return self.conv_id, self.gaps, *counts, self.illegal, self.cost, audit, self.hash.hexdigest()


def _streams(conversations: DataFrame, ids: DataFrame | None, rows_per_task: int) -> DataFrame:
    """Per conversation in one task and in this order: its gaps, and for each block its edits and its rows."""
    rows = _rows(conversations)
    turns = rows.select("conv_id", "turn")
    if ids is not None:
        no_turn = F.lit(None).cast("long").alias("turn")
        turns = turns.unionByName(ids.select(F.col("conv_id").cast("long").alias("conv_id"), no_turn))
    wide = F.col("turn").cast("decimal(38,0)")
    span = F.max(wide) - F.min(wide) + 1 - F.count_distinct("turn")
    heads = turns.groupBy("conv_id").agg(
        F.coalesce(span.try_cast("long"), F.lit(0).cast("long")).alias("gaps")
    )
    edits = _audits(_blocks(rows, rows_per_task)).select(
        "conv_id", "first_row.turn", "first_row.digest", "symbols", "audit"
    )
    parts = [
        heads.withColumns({"level": F.lit(0), "kind": F.lit(0)}),
        edits.withColumns({"level": F.lit(1), "kind": F.lit(0)}),
        rows.withColumns({"level": F.lit(1), "kind": F.lit(1)}),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union.repartition("conv_id").sortWithinPartitions(
        "conv_id", "level", "turn", "digest", "kind"
    )


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, Iterator | None]]:
    """Each conversation with its next repaired rows, and with None when it has ended."""
    now = None
    names = ("conv_id", "level", "kind", "gaps", "symbols", "audit", "role", "text")
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in names]
        for conv_id, level, kind, gaps, symbols, audit, role, text in zip(*columns):
            if level == 0:
                if now is not None:
                    yield now, now.rest()
                    yield now, None
                now = _Conversation(conv_id, gaps)
            elif kind == 0:
                now.block(symbols, audit)
            else:
                yield now, now.row(role, text)
    if now is not None:
        yield now, now.rest()
        yield now, None


def repair_report(
    conversations: DataFrame, ids: DataFrame | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The columns of op12's contract for each conversation of rows (conv_id, turn, role, text).

    Rows go by turn, nulls first; rows of the same turn by the MD5 digest of
    their role and text. Null roles and texts are one space. Null ids are one
    conversation. Conversations that stand only in ``ids`` have no rows: zeros,
    an empty audit and the hash of nothing. Repeated rows are duplicates of the
    first. Other columns are not read. An empty table gives an empty result.
    ``gaps`` is 0 where it exceeds a long integer.
    """
    streams = _streams(conversations, ids, rows_per_task)
    names = [field.split()[0] for field in REPORT.split(", ")]

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        done = []
        for conversation, rows in _replayed(batches):
            if rows is not None:
                conversation.take(rows)
                continue
            done.append(conversation.report())
            if len(done) >= 1024:
                yield dict(zip(names, zip(*done)))
                done = []
        if done:
            yield dict(zip(names, zip(*done)))

    return map_task(streams, report, REPORT)


def repaired_rows(conversations: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(conv_id, place, role, text) of the repaired conversations; places count from 0.

    Edge cases as in ``repair_report``.
    """
    streams = _streams(conversations, None, rows_per_task)
    names = ("conv_id", "place", "role", "text")

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        done, place = [], 0
        for conversation, rows in _replayed(batches):
            if rows is None:
                place = 0
                continue
            for role, text in rows:
                done.append((conversation.conv_id, place, role, text))
                place += 1
            if len(done) >= 256:
                yield dict(zip(names, zip(*done)))
                done = []
        if done:
            yield dict(zip(names, zip(*done)))

    return map_task(streams, give, "conv_id long, place long, role string, text string")
