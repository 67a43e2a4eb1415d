"""Repair of conversation structure: the cheapest edits that make turns alternate.

A well-formed conversation is empty, or an optional system turn and then user and assistant turns by pairs:
by initials of roles ``(s?(ua)+)?``. Rows are taken by turn (NULL first; ties by role and text). A row has one fault at
most: blank (nothing but white space), duplicate (role and text stood earlier in the conversation) or truncated (no
``.``, ``!`` or ``?`` at its end). Edits and costs: Keep 0, Rerole (to user or assistant) 2, Delete 3 (the only one for
blank and duplicate rows), Insert an empty user or assistant turn 2; each truncated row that stays costs 1 more.
The audit has the initials of the edits in order; of equally cheap ones the least string is taken.

Method: positions between rows times the four states of the pattern make the edit lattice. A forward heap from the
entry and a reverse heap from the exits meet by Dijkstra's rule; all crossings of the least cost are finished, and
the least concatenation of forward and reverse audit wins. Of two different audits of the same rows and cost neither
begins the other (what is longer would only add insertions, at a cost), so the least parts make the least whole.

Distribution: rows are dealt by ranges of (conversation, turn) and cut into blocks of ``BLOCK`` rows at most, so a
conversation with a third of all rows spreads over tasks. A block inside a longer conversation is searched from every
state it may be entered in to every state it may be left in; only these few paths of a block, not its texts, go to the
task that strings a conversation's blocks together. Whether a row repeats an earlier one is a grouped minimum
joined back. Only `digest` gathers a conversation's repaired text, as one hash over all of it asks for.

Edge cases: NULL roles and texts are one space. Rows with a NULL conversation are one conversation. Equal rows of a
turn are duplicates but the first. Roles count by their first character; an empty one fits nowhere. A conversation
without rows is not in the table; `digest` gives it zeros, an empty audit and the hash of an empty text.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from gridmart.llm.tables import keep

BLOCK = 64

#: States: nothing yet, after system, after user, after assistant. What a role's initial leads to.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
STEP = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
ENDS = (START, ASSISTANT)
#: The role that an inserted or changed row gets in each state.
NEEDED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
LEGAL = frozenset(("su", "ua", "au"))

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
RENAME, REMOVE, ADD, CUT = 2, 3, 2, 1

_SPACES = " \t\n\x0b\x0c\r"
_TEXT, _LONG, _INT = pa.string(), pa.int64(), pa.int32()
_MESSAGE = [("role", _TEXT), ("text", _TEXT)]
_PATH = pa.struct([("entry", _INT), ("exit", _INT), ("cost", _LONG), ("audit", _TEXT)])
_PIECE = pa.struct([("part", _INT), ("block", _INT), ("entry", _INT), ("audit", _TEXT)])
_KEY = [("conv_id", _LONG), ("part", _INT), ("block", _INT)]
_FAULTS = [(name, _LONG) for name in ("blank", "duplicate", "truncated", "illegal")]
BLOCKS = pa.schema(
    [
        *_KEY,
        ("whole", pa.bool_()),
        ("first", _TEXT),
        ("last", _TEXT),
        *_FAULTS,
        ("messages", pa.list_(pa.struct([*_MESSAGE, ("fault", _TEXT)]))),
        ("paths", pa.list_(_PATH)),
    ]
)
CHOICE = pa.schema(
    [("conv_id", _LONG), ("cost", _LONG), ("audit", _TEXT), ("illegal", _LONG), ("pieces", pa.list_(_PIECE))]
)
REPAIRED = pa.schema([*_KEY, ("messages", pa.list_(pa.struct(_MESSAGE)))])


def _spark(schema: pa.Schema) -> StructType:
    return from_arrow_schema(schema, prefer_timestamp_ntz=False)


def _moves(rows: list[tuple[str, str | None]], place: int, state: int) -> Iterator[tuple]:
    """``(letter, cost, place, state)`` of every edit that leads on from a node."""
    needed = STEP[state, NEEDED[state][0]]
    yield "I", ADD, place, needed
    if place == len(rows):
        return
    initial, fault = rows[place]
    yield "D", REMOVE, place + 1, state
    if fault in (BLANK, DUPLICATE):
        return
    extra = CUT if fault == TRUNCATED else 0
    yield "R", RENAME + extra, place + 1, needed
    if (state, initial) in STEP:
        yield "K", extra, place + 1, STEP[state, initial]


def cheapest(rows: list[tuple[str, str | None]], entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """Least cost and least audit from state ``entry`` before ``rows`` to one of ``exits`` after them."""
    n = len(rows)
    back: dict[tuple[int, int], list[tuple]] = {}
    ahead: dict[tuple[int, int], list[tuple]] = {}
    for place in range(n + 1):
        for state in STATES:
            ahead[place, state] = moves = list(_moves(rows, place, state))
            for letter, cost, *to in moves:
                back.setdefault(tuple(to), []).append((letter, cost, place, state))

    # Labels grow at their end in the forward search, so (cost, audit) itself is the order of settling.
    forward = [(0, "", (0, entry))]
    # In the reverse search they grow in front; edges without cost lead from later places to earlier ones.
    reverse = [(0, 0, (n, state)) for state in exits]
    best_back = {(n, state): (0, "") for state in exits}
    settled: dict[tuple[int, int], tuple[int, str]] = {}
    settled_back: dict[tuple[int, int], tuple[int, str]] = {}
    bound: int | None = None

    while forward and reverse and (bound is None or forward[0][0] + reverse[0][0] <= bound):
        if forward[0][0] <= reverse[0][0]:
            cost, audit, node = heapq.heappop(forward)
            if node in settled:
                continue
            settled[node] = cost, audit
            for letter, more, *to in ahead[node]:
                to = tuple(to)
                if to not in settled:
                    heapq.heappush(forward, (cost + more, audit + letter, to))
                if to in settled_back:
                    total = cost + more + settled_back[to][0]
                    bound = total if bound is None else min(bound, total)
            if node in settled_back:
                total = cost + settled_back[node][0]
                bound = total if bound is None else min(bound, total)
        else:
            cost, _, node = heapq.heappop(reverse)
            if node in settled_back or best_back[node][0] != cost:
                continue
            settled_back[node] = cost, audit = best_back[node]
            for letter, more, *of in back.get(node, ()):
                of = tuple(of)
                label = cost + more, letter + audit
                if of not in settled_back and (of not in best_back or label < best_back[of]):
                    best_back[of] = label
                    heapq.heappush(reverse, (label[0], n - of[0], of))
                if of in settled:
                    total = settled[of][0] + label[0]
                    bound = total if bound is None else min(bound, total)
            if node in settled:
                total = settled[node][0] + cost
                bound = total if bound is None else min(bound, total)
    if bound is None:
        return None
    audits = []
    for node, (cost, audit) in settled.items():
        if node in settled_back and cost + settled_back[node][0] == bound:
            audits.append(audit + settled_back[node][1])
        for letter, more, *to in ahead[node]:
            rest = settled_back.get(tuple(to))
            if rest and cost + more + rest[0] == bound:
                audits.append(audit + letter + rest[1])
    return bound, min(audits)


def _fault(text: str, repeated: bool) -> str | None:
    end = text.rstrip(_SPACES)
    if not end:
        return BLANK
    if repeated:
        return DUPLICATE
    return None if end[-1] in ".!?" else TRUNCATED


def _block(conv, part: int, number: int, rows: list[tuple], opens: bool, closes: bool) -> dict:
    """One block: ``opens`` and ``closes`` if the conversation surely begins and ends with it."""
    short = [(role[:1], fault) for role, _, fault in rows]
    entries = (START,) if opens else STATES
    exits = [ENDS] if closes else [(s,) for s in STATES]
    paths = []
    for entry in entries:
        for to in exits:
            found = cheapest(short, entry, to)
            if found:
                paths.append(dict(entry=entry, exit=to[-1], cost=found[0], audit=found[1]))
    faults = [f for _, f in short]
    return dict(
        conv_id=conv,
        part=part,
        block=number,
        whole=opens and closes,
        first=short[0][0],
        last=short[-1][0],
        blank=faults.count(BLANK),
        duplicate=faults.count(DUPLICATE),
        truncated=faults.count(TRUNCATED),
        illegal=sum(a[0] + b[0] not in LEGAL for a, b in zip(short, short[1:])),
        messages=[dict(role=role, text=text, fault=fault) for role, text, fault in rows],
        paths=paths,
    )


def _blocks(size: int):
    """Sorted rows to blocks. The first and the last conversation of a task may go on in another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made: list[dict] = []
        held: list[tuple] = []
        previous = conv = None
        number, opens = 0, False

        def close(closes: bool) -> None:
            nonlocal number, opens, held
            made.append(_block(conv, part, number, held, opens, closes))
            number, opens, held = number + 1, False, []

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(batch.num_columns))
            for row in zip(*columns, strict=True):
                own, turn, role, text, repeated = row
                if held and own != conv:
                    close(True)
                    opens = True
                elif len(held) == size:
                    close(False)
                conv = own
                same = (own, turn, role, text) == previous
                previous = own, turn, role, text
                held.append((role, text, _fault(text, repeated or same)))
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=BLOCKS)
                made = []
        if held:
            close(False)
            yield pa.RecordBatch.from_pylist(made, schema=BLOCKS)

    return run


def _ordered(messages: DataFrame) -> DataFrame:
    """Rows by conversation and turn, with whether an earlier turn has said the same."""
    blank = F.lit(" ")
    rows = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    rows = rows.withColumn("said", said)
    first = rows.groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s")).agg(F.min(turn).alias("earliest"))
    joined = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")))
    order = ("conv_id", "turn", "role", "text")
    return (
        joined.select(*order, (F.col("earliest") < turn).alias("repeated"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )


def blocks(messages: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of all conversations with their cheapest paths (stored)."""
    return keep(_ordered(messages).mapInArrow(_blocks(size), _spark(BLOCKS)), "conversation-blocks")


def _string(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks of longer conversations to the cheapest chain of paths.

    Between blocks one label per state is kept: cost, audit, and the pieces it is made of.
    """
    labels: dict[int, tuple] = {}
    conv, last, illegal, begun = None, "", 0, False

    def result() -> dict:
        cost, audit, chain = min((label for state, label in labels.items() if state in ENDS), key=lambda x: x[:2])
        pieces = []
        while chain:
            chain, piece = chain
            pieces.append(piece)
        return dict(conv_id=conv, cost=cost, audit=audit, illegal=illegal, pieces=pieces[::-1])

    for batch in batches:
        made = []
        for row in batch.to_pylist():
            if not begun or row["conv_id"] != conv:
                if begun:
                    made.append(result())
                conv, last, illegal, begun = row["conv_id"], None, 0, True
                labels = {START: (0, "", None)}
            illegal += last is not None and last + row["first"] not in LEGAL
            last = row["last"]
            new: dict[int, tuple] = {}
            for path in row["paths"]:
                if path["entry"] not in labels:
                    continue
                cost, audit, chain = labels[path["entry"]]
                piece = dict(part=row["part"], block=row["block"], entry=path["entry"], audit=path["audit"])
                label = cost + path["cost"], audit + path["audit"], (chain, piece)
                old = new.get(path["exit"])
                if old is None or label[:2] < old[:2]:
                    new[path["exit"]] = label
            labels = new
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=CHOICE)
    if begun:
        yield pa.RecordBatch.from_pylist([result()], schema=CHOICE)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the chosen edits to the messages they leave."""
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            state, rest, out = row["entry"], iter(row["messages"]), []
            for letter in row["edits"]:
                if letter == "I":
                    message = {"role": NEEDED[state], "text": ""}
                else:
                    message = next(rest)
                    if letter == "D":
                        continue
                    if letter == "R":
                        message["role"] = NEEDED[state]
                out.append(dict(role=message["role"], text=message["text"]))
                state = STEP[state, message["role"][:1]]
            made.append({**{c: row[c] for c in ("conv_id", "part", "block")}, "messages": out})
        yield pa.RecordBatch.from_pylist(made, schema=REPAIRED)



def repair(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From `blocks`: the audit of each conversation, and its repaired messages by blocks.

    The audits have ``conv_id, blank, duplicate, truncated, illegal, cost, audit``; the messages
    ``conv_id, part, block, messages``, in the order of part and block.
    """
    short = found.drop("messages")
    chosen = keep(
        short.filter("NOT whole")
        .select("conv_id", "part", "block", "first", "last", "paths")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "block")
        .mapInArrow(_string, _spark(CHOICE)),
        "chosen",
    )
    counts = ("blank", "duplicate", "truncated", "illegal")
    one = F.col("paths")[0]
    of_one = short.filter("whole").select("conv_id", *counts, one["cost"].alias("cost"), one["audit"].alias("audit"))
    sums = short.filter("NOT whole").groupBy(F.col("conv_id").alias("c")).agg(*(F.sum(c).alias(c) for c in counts))
    of_several = chosen.withColumnRenamed("illegal", "between").join(sums, F.col("conv_id").eqNullSafe(F.col("c")))
    audits = of_one.unionByName(
        of_several.select(
            "conv_id", *counts[:3], (F.col("illegal") + F.col("between")).alias("illegal"), "cost", "audit"
        )
    )
    pieces = chosen.select(F.inline("pieces")).withColumnRenamed("audit", "edits")
    texts = found.select("conv_id", "part", "block", "whole", "messages", "paths")
    edited = (
        texts.filter("whole")
        .select("conv_id", "part", "block", "messages", F.lit(START).alias("entry"), one["audit"].alias("edits"))
        .unionByName(
            texts.filter("NOT whole")
            .join(pieces, ["part", "block"])
            .select("conv_id", "part", "block", "messages", "entry", "edits")
        )
    )
    return audits, edited.mapInArrow(_apply, _spark(REPAIRED))


def damage(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the damage that crc32 of ``conv_id:turn`` picks (NULLs: one space)."""

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    role, text = shown("role"), shown("text")
    rows = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"),
    )
    return rows.drop("copy")


def digest(messages: DataFrame, audits: DataFrame, repaired: DataFrame, all_ids: DataFrame) -> DataFrame:
    """One row per conversation of ``all_ids``: gaps, faults, cost, audit, hash of the repaired conversation.

    A conversation's repaired text is gathered in one row, as its hash runs over all of it.
    """
    turns = messages.groupBy(F.col("conv_id").alias("t")).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")
    )
    said = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    in_order = F.sort_array(F.collect_list(F.struct("part", "block", said.alias("said"))))
    texts = repaired.groupBy(F.col("conv_id").alias("r")).agg(
        F.array_join(F.flatten(in_order["said"]), "\n").alias("whole")
    )
    ids = all_ids.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    own = audits.withColumnRenamed("conv_id", "a")
    zero = F.lit(0).cast("bigint")
    return (
        ids.join(turns, ids.conv_id.eqNullSafe(F.col("t")), "left")
        .join(own, ids.conv_id.eqNullSafe(F.col("a")), "left")
        .join(texts, ids.conv_id.eqNullSafe(F.col("r")), "left")
        .select(
            "conv_id",
            *(F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.sha2(F.coalesce("whole", F.lit("")).cast("binary"), 256).alias("repaired_sha256"),
        )
    )
