"""Conversation structure repair by integer weights over a graph of edits (operator 13).

A conversation's rows are taken by turn (nulls first; of one turn, by role and then by a
digest of the row). A row is ``blank`` without a character other than white space
(0x20, 0x09-0x0D), else ``duplicate`` if role and text stand in an earlier row, else
``truncated`` if its last such character is none of ``.!?``. Edits turn the role initials
into ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 2, Delete 3 (a blank or
duplicate row must go), Insert an empty-text user or assistant row 2; a truncated row that
stays adds 1. Of the cheapest edits the audit, their initials in order, is the ASCII-least.

The search is a minimum over the paths of a graph whose nodes are (rows done, roles so far).
A path weighs one integer: its cost in the high digits, below it the audit in a fixed number
of base-5 digits (D, I, K, R are 1 to 4, the end is padded by zeros), so the least integer is
the cheapest audit and among those the least one. The graph is walked from the end in blocks
of ``BLOCK`` rows; behind a block the audits of the rest stand as one digit, their rank, so
the integers stay short however long a conversation is. All paths of a block end with the
edit of its last row, so none is a prefix of another and ranks compare like the audits.

Texts don't travel for the search. Each row is reduced to a digest and marks; the first
turn of each (conversation, digest) is a partial aggregate joined back; rows are then
dealt out by ranges of (conversation, turn, ...), so that a hot conversation is spread over
tasks, and become one code letter each. The letters of a conversation meet in one task, a
byte a row, as long as the audit that it returns. The texts are dealt by conversation once
and are read in order as a stream, beside their audit; a task holds one batch.

Null roles and texts are one space. A null conversation id is a conversation; null turns come
first and don't count for ``gaps``. Rows that repeat are duplicates; roles with another or no
initial can be reroled or deleted. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Audit letters in ASCII order; a letter's digit is its place, 0 pads the end.
LETTERS, BASE = " DIKR", 5
#: Roles so far: none, s, ... u, ... a. What may end, and what an inserted or reroled row makes of each.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (0, 4, 2, 0)                          # cost of the inserts that lead to a proper end
END_AUDITS = ("", "II", "I", "")
AFTER = (USER, USER, ASSISTANT, USER)        # user, or assistant after a user
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Rows of a block of the search; code letters of one row of pieces.
BLOCK, PIECE = 128, 1 << 16

STATS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_INITIALS, _FAULTS = "suax", ("", "blank", "duplicate", "truncated")


def named(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """The four columns, null roles and texts as one space."""
    return rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(a)
                         for c, a in ((role, "role"), (text, "text"))))


def damage(rows: DataFrame) -> DataFrame:
    """Faults by rule: crc32 of ``conv_id:turn`` modulo 20. 0 drops the row, 1 empties its text, 2 removes
    its ``[.!?]``, 3 repeats it, 4 sets role user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("fault", F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20)
    hurt = rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("copies"), "fault")
    return hurt.where(F.col("fault") != 0).select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")
                                                  ).drop("copy")


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def marks(rows: DataFrame) -> DataFrame:
    """Each row without its text: digest, initial, blank, truncated, and whether an earlier turn has the same."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    has = F.struct(F.col("turn").isNotNull().alias("known"), "turn")      # nulls first
    light = rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("open"))
    firsts = light.groupBy(F.col("conv_id").alias("conv"), F.col("digest").alias("same")).agg(F.min(has).alias("first"))
    return light.join(firsts, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("digest") == F.col("same"))).select(
        *light.columns, (has > F.col("first")).alias("again"))


def _pieces(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Code letters of sorted rows; a row for each conversation, or each ``PIECE`` of it, in this partition."""
        part, seq = TaskContext.get().partitionId(), 0
        conv, letters, turns, first, last, before = None, [], 0, None, None, None

        def piece():
            return pa.RecordBatch.from_arrays(
                [pa.array([conv[0]], kind), pa.array([part], pa.int32()), pa.array([seq], pa.int64()),
                 pa.array(["".join(letters)]), *(pa.array([x], pa.int64()) for x in (turns, first, last))],
                names=["conv_id", "part", "seq", "codes", "turns", "first_turn", "last_turn"])

        for batch in batches:
            for c, turn, digest, initial, blank, open_, again in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if conv != (c,) or len(letters) >= PIECE:
                    if letters:
                        yield piece()
                        seq += 1
                    letters, turns, first, last = [], 0, turn, None
                    before = before if conv == (c,) else None
                    conv = (c,)
                first = turn if first is None else first
                if turn is not None and turn != last:
                    turns, last = turns + 1, turn
                again = again or before == (turn, digest)
                before = (turn, digest)
                fault = 1 if blank else 2 if again else 3 if open_ else 0
                letters.append(chr(65 + 4 * _INITIALS.index(initial) + fault))
        if letters:
            yield piece()
    return run


@lru_cache(maxsize=BLOCK)
def _digits(rows: int) -> tuple[int, int]:
    """Of a block: the weight of cost 1, and that of the first letter's digit. A row has at most
    two inserts before it; one digit more holds the rank of the rest."""
    width = 3 * rows + 1
    return BASE ** width, BASE ** (width - 1)


def _edges(code: str):
    """(letter digit, cost, roles before, roles after) of the edits of one row."""
    initial, fault = divmod(ord(code) - 65, 4)
    for state in range(4):
        yield 1, DELETE, state, state
        if fault in (1, 2):
            continue
        more = TRUNCATED if fault == 3 else 0
        yield 4, REROLE + more, state, AFTER[state]
        if _INITIALS[initial] == "s" and state == EMPTY:
            yield 3, KEEP + more, state, SYSTEM
        elif ROLE.get(AFTER[state], "")[0] == _INITIALS[initial]:
            yield 3, KEEP + more, state, AFTER[state]


EDGES = {chr(65 + i): tuple(_edges(chr(65 + i))) for i in range(16)}


def _spelled(low: int, first: int) -> tuple[str, int]:
    """The letters of a weight's low digits, and the rank that follows them."""
    out = []
    while low:
        digit, low = divmod(low, first)
        out.append(digit)
        low *= BASE
    return "".join(LETTERS[d] for d in out[:-1]), out[-1]


def cheapest(codes: str) -> tuple[int, str]:
    """(cost, audit) of a conversation given by its code letters."""
    ranks = sorted(set(END_AUDITS))
    costs, rank = list(ENDS), [1 + ranks.index(a) for a in END_AUDITS]
    rest = {1 + i: (a, None) for i, a in enumerate(ranks)}      # rank: an audit and what follows it
    for stop in range(len(codes), 0, -BLOCK):
        block = codes[max(0, stop - BLOCK):stop]
        one, first = _digits(len(block))
        weights = [cost * one + r * first for cost, r in zip(costs, rank)]

        def before(letter: int, cost: int, weight: int) -> int:
            high, low = divmod(weight, one)
            return (high + cost) * one + letter * first + low // BASE

        for code in reversed(block):
            row: list[int | None] = [None] * 4
            for letter, cost, state, then in EDGES[code]:
                w = before(letter, cost, weights[then])
                row[state] = w if row[state] is None else min(row[state], w)
            once = [before(2, INSERT, row[AFTER[s]]) for s in range(4)]
            twice = [before(2, INSERT, once[AFTER[s]]) for s in range(4)]
            weights = [min(x) for x in zip(row, once, twice)]
        costs, lows = [w // one for w in weights], [w % one for w in weights]
        order = sorted(set(lows))
        rank, tails = [1 + order.index(x) for x in lows], {}
        for i, low in enumerate(order):
            audit, then = _spelled(low, first)
            tails[1 + i] = (audit, rest[then])
        rest = tails
    out, node = [], rest[rank[EMPTY]]
    while node:
        out.append(node[0])
        node = node[1]
    return costs[EMPTY], "".join(out)


_LEGAL = {"su", "ua", "au"}


def _decided(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each conversation from its pieces in order."""
        conv, codes, turns, least, last = None, [], 0, None, None

        def row():
            text = "".join(codes)
            faults = [0, 0, 0, 0]
            for i in range(16):
                faults[i % 4] += text.count(chr(65 + i))
            initials = text.translate({65 + i: _INITIALS[i // 4] for i in range(16)})
            illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
            cost, audit = cheapest(text)
            gaps = last - least + 1 - turns if turns else 0
            return [conv[0], gaps, *faults[1:], illegal, cost, audit]

        def batch_of(rows):
            kinds = [kind, *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                names=["conv_id", "gaps", *_FAULTS[1:], "illegal", "cost", "audit"])

        rows = []
        for batch in batches:
            for c, piece, n, first, end in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if conv != (c,):
                    if conv:
                        rows.append(row())
                    conv, codes, turns, least, last = (c,), [], 0, None, None
                codes.append(piece)
                if n:
                    turns += n - (first == last)      # one turn's rows may stand in two pieces
                    least, last = first if least is None else least, end
            if len(rows) >= 1000:
                yield batch_of(rows)
                rows = []
        if conv:
            rows.append(row())
            yield batch_of(rows)
    return run


def _arrow_kind(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(rows.schema["conv_id"].dataType)


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``rows``
    (see :func:`named`)."""
    kind, conv = _arrow_kind(rows), f"conv_id {dict(rows.dtypes)['conv_id']}"
    order = ["conv_id", "turn", "role", "digest"]
    marked = materialize(marks(rows), "marks")
    pieces = (marked.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("conv_id", "turn", "digest", "initial", "blank", "open", "again")
              .mapInArrow(_pieces(kind), f"{conv}, part int, seq bigint, codes string, turns bigint, "
                                         "first_turn bigint, last_turn bigint"))
    return (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
            .select("conv_id", "codes", "turns", "first_turn", "last_turn")
            .mapInArrow(_decided(kind), f"{conv}, {STATS}"))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of a sorted stream of audits and rows: ('start', audit row), then ('row', (position, role, text, edit))."""
    left, state, position = iter(()), EMPTY, 0

    def inserted(until_row: bool):
        nonlocal state, position
        for letter in left:
            if letter != "I" and until_row:
                yield letter
                return
            state = AFTER[state]
            position += 1
            yield position, ROLE[state], "", "I"

    for batch in batches:
        for is_row, role, text, *header in zip(*(batch.column(i).to_pylist() for i in range(1, batch.num_columns)),
                                               batch.column(0).to_pylist()):
            if not is_row:
                yield from (("row", x) for x in inserted(False))
                left, state, position = iter(header[-2]), EMPTY, 0
                yield "start", (header[-1], *header[:-1])
                continue
            for x in inserted(True):
                if isinstance(x, tuple):
                    yield "row", x
                elif x != "D":
                    state = SYSTEM if x == "K" and state == EMPTY and role[:1] == "s" else AFTER[state]
                    position += 1
                    yield "row", (position, role if x == "K" else ROLE[state], text, x)
    yield from (("row", x) for x in inserted(False))


def _digests(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        names = ["conv_id", "gaps", *_FAULTS[1:], "illegal", "cost", "audit", "repaired_sha256"]
        rows, header, sha, some = [], None, None, False
        for what, x in _repaired(batches):
            if what == "row":
                sha.update((b"\n" if some else b"") + f"{x[1]}:{x[2]}".encode())
                some = True
                continue
            if header:
                rows.append([*header, sha.hexdigest()])
            header, sha, some = x, hashlib.sha256(), False
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows = []
        if header:
            rows.append([*header, sha.hexdigest()])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    return run


def _rows(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, names = [kind, pa.int64(), *[pa.string()] * 3], ["conv_id", "position", "role", "text", "edit"]
        rows, conv = [], None
        for what, x in _repaired(batches):
            if what == "start":
                conv = x[0]
                continue
            rows.append((conv, *x))
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    return run


def _beside(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Audits and the texts they speak of in one sorted stream: each conversation's audit, then its rows."""
    stats = [c for c in decided.columns if c != "conv_id"]
    texts = rows.select("conv_id", F.lit(True).alias("is_row"), "turn", "role", _digest().alias("digest"), "text")
    heads = decided.select("conv_id", F.lit(False).alias("is_row"), *stats)
    both = texts.unionByName(heads, allowMissingColumns=True)
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "turn", "role", "digest")
            .select("conv_id", "is_row", "role", "text", *stats))


def repaired_digests(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """The audits with ``repaired_sha256``, of the repaired ``role:text`` rows joined by newlines."""
    return _beside(rows, decided).mapInArrow(
        _digests(_arrow_kind(rows)), f"conv_id {dict(rows.dtypes)['conv_id']}, {STATS}, repaired_sha256 string")


def repair(rows: DataFrame, decided: DataFrame | None = None) -> DataFrame:
    """The repaired rows: conv_id, position (from 1), role, text, edit (K, R or I)."""
    decided = audits(rows) if decided is None else decided
    return _beside(rows, decided).mapInArrow(
        _rows(_arrow_kind(rows)),
        f"conv_id {dict(rows.dtypes)['conv_id']}, position bigint, role string, text string, edit string")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The digests of the damaged conversations; one with no row left has zeros, an empty audit and the hash of ''."""
    rows = named(conversations)
    hurt = damage(rows)
    found = repaired_digests(hurt, audits(hurt))
    every = rows.select("conv_id").distinct()
    own = [c for c in found.columns if c != "conv_id"]
    joined = every.join(found.withColumnRenamed("conv_id", "found_id"),
                        F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    none = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return joined.select("conv_id", *(F.coalesce(F.col(c), F.lit(none.get(c, 0))).alias(c) for c in own))
