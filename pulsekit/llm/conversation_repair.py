"""Operator 13: conversation structure repair as a shortest path, found by an auction.

The rows of a conversation, in turn order, and the state of the role pattern
``(s?(ua)+)?`` span a lattice: node (i, s) means that i rows are consumed and the
roles written so far end in state s. Arcs are the edits with integer costs: Keep
0, Rerole to user or assistant 2, Delete 3 (the only edit of a blank or duplicate
row), Insert an empty user or assistant text 2; a truncated row that is not
deleted costs 1 more. Each edit leads from a node to exactly one other.

The auction keeps a path from the origin and a price per node, never above arc
cost plus the price at its end. At the path's last node it takes the best arc:
if the node's price can rise it is raised and the path contracts by one node,
else the path extends. When the path reaches the sink, every arc of every
cheapest path is tight (price = cost + price at its end), so the cheapest edits
are read off the tight arcs, least letter first, backing out of tight arcs that
lead nowhere.

A conversation is cut into windows of ``WINDOW`` rows, since the auction's work
grows with the square of the path. From the last window back, an auction from each
of the four entry states gives the exact costs to the end, which are the sink
arcs of the window before; then the edits are traced from the front.

Hot conversations: texts are never gathered. Equal rows are counted map-side,
faults and duplicates are decided on rows of about 50 bytes (keyed by text
hashes, a skewed join splits), a chunk of 1,024 turn numbers becomes a string
of one character a row, and only these strings meet per conversation, as the
audit (one character an edit, one value a conversation) must. The
texts then stream in order past their audit into the digest, which as a hash of
the whole conversation is one stream by definition, in the memory of one row.

Defined results: null roles and texts count as one space; a null turn comes
before all others; rows of one turn are ordered by role, then by the md5 of
their text, equal rows are adjacent; a null conv_id is a conversation of its own; roles
count by their first character, so an unknown or empty role can only be reroled or
deleted; a text may have any length; of equally cheap edits the ASCII-least
audit is taken; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 32          # rows solved by one auction
CHUNK_TURNS = 1024   # turn numbers gathered into one string of row codes
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
SYSTEM, USER, ASSISTANT, OTHER = range(4)
START, IN_SYSTEM, IN_USER, IN_ASSISTANT = range(4)  # what the roles written so far end in
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1
_NEXT = {(START, SYSTEM): IN_SYSTEM, (START, USER): IN_USER, (IN_SYSTEM, USER): IN_USER,
         (IN_USER, ASSISTANT): IN_ASSISTANT, (IN_ASSISTANT, USER): IN_USER}
_WANTED = {START: USER, IN_SYSTEM: USER, IN_USER: ASSISTANT, IN_ASSISTANT: USER}
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
NAMES = {USER: "user", ASSISTANT: "assistant"}


def row_code(cls: int, fault: int) -> str:
    return chr(65 + 4 * cls + fault)


def _arcs(codes: str, ends: list[int | None], last: bool) -> list[list[tuple[int, int, str]]]:
    """Arcs (cost, node, letter) of a window's lattice, by letter; node 4 * rows + 4 is
    the sink, reached from end state s at cost ``ends[s]`` (None: not a way out)."""
    n = len(codes)
    sink = 4 * n + 4
    out: list[list[tuple[int, int, str]]] = [[] for _ in range(sink + 1)]
    for i in range(n + 1):
        for s in range(4):
            mine, want = out[4 * i + s], _WANTED[s]
            insert = (INSERT, 4 * i + _NEXT[s, want], "I")
            if i == n:
                if ends[s] is not None:
                    mine.append((ends[s], sink, ""))
                if last:  # edits before a later row belong to that row's window
                    mine.append(insert)
                continue
            cls, fault = divmod(ord(codes[i]) - 65, 4)
            mine.append((DELETE, 4 * i + 4 + s, "D"))
            mine.append(insert)
            if fault in (OK, TRUNCATED):
                more = UNFINISHED if fault == TRUNCATED else 0
                if (s, cls) in _NEXT:
                    mine.append((KEEP + more, 4 * i + 4 + _NEXT[s, cls], "K"))
                if cls != want:
                    mine.append((REROLE + more, 4 * i + 4 + _NEXT[s, want], "R"))
    return out


def _auction(arcs: list, price: list[int], origin: int) -> None:
    """Raise ``price`` (feasible: never above cost + price of an arc) until the sink is reached."""
    sink, path = len(arcs) - 1, [origin]
    while path[-1] != sink:
        node = path[-1]
        best, to = min((c + price[j], j) for c, j, _ in arcs[node])
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


def _trace(arcs: list, price: list[int], origin: int) -> tuple[str, int, int]:
    """Letters, cost and end state of the ASCII-least path of tight arcs to the sink."""
    sink, dead = len(arcs) - 1, set()
    path, letters, costs = [origin], [], []
    while path[-1] != sink:
        node = path[-1]
        for c, j, letter in arcs[node]:
            if price[node] == c + price[j] and j not in dead:
                path.append(j)
                letters.append(letter)
                costs.append(c)
                break
        else:
            dead.add(path.pop())
            letters.pop()
            costs.pop()
    return "".join(letters), sum(costs[:-1]), path[-2] % 4


def _solve(codes: str) -> tuple[int, str]:
    cuts = [codes[i:i + WINDOW] for i in range(0, len(codes), WINDOW)] or [""]
    ends: list[int | None] = [0, None, None, 0]  # nothing, or an assistant at the end
    after = [ends]
    for k in range(len(cuts) - 1, 0, -1):
        arcs = _arcs(cuts[k], ends, k == len(cuts) - 1)
        price = [0] * len(arcs)
        for s in range(4):
            _auction(arcs, price, s)
        least = min(price[:4])
        ends = [p - least for p in price[:4]]  # only differences matter
        after.append(ends)
    cost, audit, state = 0, [], START
    for k, cut in enumerate(cuts):
        arcs = _arcs(cut, after[len(cuts) - 1 - k], k == len(cuts) - 1)
        price = [0] * len(arcs)
        _auction(arcs, price, state)
        letters, paid, state = _trace(arcs, price, state)
        audit.append(letters)
        cost += paid
    return cost, "".join(audit)


_solve_short = lru_cache(maxsize=1 << 15)(_solve)  # most conversations are short and alike


def audit_codes(codes: str) -> tuple[int, int, int, int, int, str]:
    """(blank, duplicate, truncated, illegal, cost, audit) of a conversation's row codes."""
    fault = [0, 0, 0, 0]
    illegal, before = 0, None
    for ch in codes:
        cls, f = divmod(ord(ch) - 65, 4)
        fault[f] += 1
        illegal += before is not None and (before, cls) not in _LEGAL
        before = cls
    cost, audit = (_solve_short if len(codes) <= WINDOW else _solve)(codes)
    return fault[BLANK], fault[DUPLICATE], fault[TRUNCATED], illegal, cost, audit


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        solved = [audit_codes(c) for c in batch.column("codes").to_pylist()]
        columns = list(zip(*solved)) if solved else [()] * 6
        yield pa.RecordBatch.from_arrays(
            [batch.column("_key"), batch.column("conv_id"), batch.column("gaps"),
             *[pa.array(x, pa.int64()) for x in columns[:5]], pa.array(columns[5], pa.string())],
            ["_key", "conv_id", "gaps", *_COUNTS, "audit"])


def _key(c: str) -> Column:
    """A text key without nulls: one space for null, which no id's key equals."""
    return F.when(F.col(c).isNull(), " ").otherwise(F.concat(F.lit("="), F.col(c).cast("string")))


def _turn() -> list[Column]:
    return [F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).cast("long").alias("at")]


def _plain_rows(rows: DataFrame) -> DataFrame:
    rows = rows.select(_key("conv_id").alias("_key"), *_turn(), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))
    return rows.withColumn("h", F.md5("text"))


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: _key, conv_id, gaps, fault and illegal counts, cost and audit.

    ``ids`` (conv_id) names conversations to report besides those with rows.
    """
    initial = F.substring("role", 1, 1)
    cls = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(F.length(bare) == 0, BLANK).when(~F.right(bare, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(OK)
    counted = (
        _plain_rows(rows).select("_key", "has_turn", "at", "role", "h", cls.alias("cls"), fault.alias("fault"))
        .groupBy("_key", "has_turn", "at", "role", "h", "cls", "fault").agg(F.count(F.lit(1)).alias("n"))
    )
    # texts at several turns: all but the first turn are duplicates (blank comes before duplicate)
    firsts = (
        counted.where(F.col("fault") != BLANK).groupBy("_key", "role", "h")
        .agg(F.min(F.struct("has_turn", "at")).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
        .drop("turns")
    )
    seen = F.col("first").isNotNull() & (F.struct("has_turn", "at") != F.col("first"))

    def letter(fault: Column) -> Column:
        return F.char(F.lit(65) + 4 * F.col("cls") + fault)

    again = F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE)  # the second and later equal rows
    piece = F.concat(letter(F.when(seen, DUPLICATE).otherwise(F.col("fault"))),
                     F.repeat(letter(again), (F.col("n") - 1).cast("int")))
    chunk = F.when(F.col("has_turn"), F.floor(F.col("at") / CHUNK_TURNS))
    turn = F.when(F.col("has_turn"), F.col("at"))

    def joined(parts: str, order: list[str]) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, parts))), lambda x: x[parts]), "")

    chunks = (
        counted.join(firsts, ["_key", "role", "h"], "left")
        .select("_key", "has_turn", "at", "role", "h", piece.alias("piece"), chunk.alias("chunk"), turn.alias("turn"))
        .groupBy("_key", "has_turn", F.coalesce("chunk", F.lit(0)).alias("chunk"))
        .agg(joined("piece", ["at", "role", "h"]).alias("codes"), F.size(F.collect_set("turn")).alias("turns"),
             F.min("turn").alias("low"), F.max("turn").alias("high"))
    )
    named = (rows.select("conv_id") if ids is None else rows.select("conv_id").union(ids.select("conv_id"))).distinct()
    named = named.select(_key("conv_id").alias("_key"), "conv_id", F.lit(False).alias("has_turn"),
                         F.lit(-1).cast("long").alias("chunk"), F.lit("").alias("codes"), F.lit(0).alias("turns"),
                         F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high"))
    whole = (
        chunks.unionByName(named, allowMissingColumns=True).groupBy("_key")
        .agg(F.max("conv_id").alias("conv_id"), joined("codes", ["has_turn", "chunk"]).alias("codes"),
             F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"))
    )
    kind = dict(rows.dtypes)["conv_id"]
    return whole.mapInArrow(
        _audited, f"_key string, conv_id {kind}, gaps long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string")


class _Repair:
    """Applies an audit to the rows of its conversation as they stream by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _write(self, edit: str, role: str, text: str):
        cls = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
        self.state = _NEXT[self.state, cls]
        return edit, role, text

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._write("I", NAMES[_WANTED[self.state]], "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield self._write(edit, role, text)
        elif edit == "R":
            yield self._write(edit, NAMES[_WANTED[self.state]], text)


def _streamed(solved: DataFrame, rows: DataFrame) -> DataFrame:
    """Each conversation's audit row, then its rows in order, in one partition."""
    lead = solved.withColumn("is_row", F.lit(False))
    body = _plain_rows(rows).withColumn("is_row", F.lit(True))
    both = lead.unionByName(body, allowMissingColumns=True)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(parts, "_key").sortWithinPartitions("_key", "is_row", "has_turn", "at", "role", "h").select(
        "_key", "is_row", "conv_id", "gaps", *_COUNTS, "audit", "role", "text")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_row, repair, sha, any_yet = None, None, None, False

    def add(written) -> None:
        nonlocal any_yet
        for _, role, text in written:
            sha.update((b"\n" if any_yet else b"") + f"{role}:{text}".encode())
            any_yet = True

    def close() -> list:
        if open_row is None:
            return []
        add(repair.inserts())
        return [(*open_row, sha.hexdigest())]

    head = ["conv_id", "gaps", *_COUNTS, "audit"]
    schema = None
    for batch in batches:
        schema = pa.schema([batch.schema.field(c) for c in head] + [pa.field("repaired_sha256", pa.string())])
        done = []
        for is_row, role, text, *lead in zip(*[batch.column(c).to_pylist() for c in ("is_row", "role", "text", *head)]):
            if is_row:
                add(repair.row(role, text))
            else:
                done += close()
                open_row, repair, sha, any_yet = lead, _Repair(lead[-1]), hashlib.sha256(), False
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in done], schema=schema)
    if (done := close()):
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in done], schema=schema)


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, repair, place = None, None, 0
    for batch in batches:
        out = []

        def add(written) -> None:
            nonlocal place
            for edit, role, text in written:
                out.append((conv, place, role, text, edit))
                place += 1

        for is_row, role, text, conv_id, audit in zip(
                *[batch.column(c).to_pylist() for c in ("is_row", "role", "text", "conv_id", "audit")]):
            if is_row:
                add(repair.row(role, text))
            else:
                if repair is not None:
                    add(repair.inserts())
                conv, repair, place = conv_id, _Repair(audit), 0
        kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()]
        names = ["conv_id", "place", "role", "text", "edit"]
        columns = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
    if repair is not None and (tail := list(repair.inserts())):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*[(conv, place + i, r, t, e) for i, (e, r, t) in enumerate(tail)]), kinds)],
            names)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (0, 1, ...), role, text and the edit that wrote the row (K, R or I)."""
    kind = dict(rows.dtypes)["conv_id"]
    return _streamed(audits(rows), rows).mapInArrow(
        _written, f"conv_id {kind}, place long, role string, text string, edit string")


def repair_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (and ``ids``): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, and the sha256 of the repaired ``role:text`` lines."""
    solved = audits(rows, ids)
    kind = dict(rows.dtypes)["conv_id"]
    return _streamed(solved, rows).mapInArrow(
        _digests, f"conv_id {kind}, gaps long, " + ", ".join(f"{c} long" for c in _COUNTS)
        + ", audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The evaluation's damage, by crc32 of ``conv_id:turn`` mod 20 (nulls as one
    space): 0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats the
    row, 4 sets role user."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return (
        conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), draw.alias("draw"))
        .where("draw != 0")
        .select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
                text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1))).alias("_copy"))
        .drop("_copy")
    )
