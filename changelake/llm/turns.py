"""Conversation structure repair by a survivor-coalescence Viterbi search.

A conversation's role initials should read ``s?(ua)+`` or nothing. Each row is kept, given the
role user or assistant, or deleted, and empty turns may be inserted anywhere; the cheapest
edits win, ties by the least string of their initials (D, I, K, R). The search walks the rows
once and keeps the best edits into each of four states (nothing yet, after s, after u, after
a) as a tree of back pointers with reference counts. What no survivor needs is freed, and as
soon as all survivors share an ancestor the edits up to it are final and leave the tree. Equal
costs are settled by comparing the whole unresolved ends of both paths.

Spark's part. Rows that are equal in conversation, turn, role and text are counted first
(map-side), so a repeated row is one row with a number. The rows, without their texts, are dealt
by range in order, so a long conversation lies on several partitions. A conversation within one
partition is searched there; one that spans several is searched from each state it might be
entered in, and the pieces (cost and edits for each way in and out) are put through the same
search, piece by piece. Texts join last, for kept rows alone. Only the hash of a repaired
conversation is sequential by definition: its kept rows stream through one task in order, and
nothing of it is collected.

Order within a conversation: turn (nulls first), role, the text's first 64 characters, the
text's hash. Faults count once a row: blank (no character other than white space), duplicate
(role and text seen earlier), truncated (the last such character is none of . ! ?).

Edge cases: a null role or text is one space; null conversation ids are one conversation;
null turns come first and count for no gap; a role's initial is its first character, compared
exactly; a conversation without rows is given by ``conversations`` alone; an empty table gives an
empty result; columns besides the four named are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.llm.common import stable

#: States: nothing yet, after s, after u, after a. What an initial leads to.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLE = {USER: "user", ASSISTANT: "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
SPACE = r"\x20\x09-\x0D"


class Node:
    """An edit on some survivor's path: the state it leads to, and who still needs it."""

    __slots__ = ("parent", "symbol", "state", "refs", "kids")

    def __init__(self, parent: Node | None, symbol: str, state: int):
        self.parent, self.symbol, self.state, self.refs, self.kids = parent, symbol, state, 0, set()
        if parent:
            parent.refs += 1
            parent.kids.add(self)


class Survivors:
    """The best paths into each state, as far as they differ."""

    def __init__(self, entry: int = EMPTY):
        self.root = Node(None, "", entry)
        self.root.refs = 1
        self.best: dict[int, tuple[int, Node]] = {entry: (0, self.root)}

    def path(self, node: Node) -> str:
        parts = []
        while node is not self.root:
            parts.append(node.symbol)
            node = node.parent
        return "".join(reversed(parts))

    def _less(self, cost: int, node: Node, symbol: str, than: tuple[int, Node, str]) -> bool:
        if cost != than[0]:
            return cost < than[0]
        return self.path(node) + symbol < self.path(than[1]) + than[2]

    def advance(self, moves: Iterable[tuple[int, int, int, str]]) -> None:
        """One row (or piece): moves are (from state, to state, cost, edits)."""
        chosen: dict[int, tuple[int, Node, str]] = {}
        for start, end, price, symbol in moves:
            if start in self.best:
                cost, node = self.best[start]
                if end not in chosen or self._less(cost + price, node, symbol, chosen[end]):
                    chosen[end] = (cost + price, node, symbol)
        old, self.best = self.best, {}
        for state, (cost, node, symbol) in chosen.items():
            self.best[state] = (cost, self._pin(Node(node, symbol, state)))
        for _, node in old.values():
            self._release(node)

    def insert(self) -> None:
        """Empty turns after what is there: into after-u from the other states, then into after-a."""
        for start, end in ((EMPTY, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if start in self.best:
                cost, node = self.best[start]
                held = self.best.get(end)
                if held is None or self._less(cost + INSERT, node, "I", (*held, "")):
                    self.best[end] = (cost + INSERT, self._pin(Node(node, "I", end)))
                    if held:
                        self._release(held[1])

    def prune(self) -> None:
        """Drops states that after-a beats whatever follows: it does all that they can do, at most
        one deletion (of an s row) dearer than from nothing, and no dearer than after s."""
        if ASSISTANT in self.best:
            least = self.best[ASSISTANT][0]
            for state, more in ((EMPTY, DELETE), (SYSTEM, 0)):
                if state in self.best and self.best[state][0] > least + more:
                    self._release(self.best.pop(state)[1])

    def settled(self) -> Iterator[tuple[str, int]]:
        """Takes from the tree the edits that all survivors share: (edits, state they lead to)."""
        while self.root.refs == 1 and self.root.kids:
            (child,) = self.root.kids
            child.parent, self.root = None, child
            yield child.symbol, child.state

    def finish(self, ends: Iterable[int] = (EMPTY, ASSISTANT)) -> tuple[int, list[tuple[str, int]]]:
        """(cost, edits with states left to take) of the best path into one of ``ends``."""
        best: tuple[int, Node, str] | None = None
        for state in ends:
            if state in self.best:
                cost, node = self.best[state]
                if best is None or self._less(cost, node, "", best):
                    best = (cost, node, "")
        cost, node, _ = best
        rest = []
        while node is not self.root:
            rest.append((node.symbol, node.state))
            node = node.parent
        return cost, rest[::-1]

    @staticmethod
    def _pin(node: Node) -> Node:
        node.refs += 1
        return node

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while not node.refs and node is not self.root:
            parent = node.parent
            parent.kids.discard(node)
            parent.refs -= 1
            node = parent


def row_moves(initial: str, forced: bool, truncated: bool) -> list[tuple[int, int, int, str]]:
    """What one row allows: deletion, and unless it must go, keeping it or another role."""
    moves = [(state, state, DELETE, "D") for state in range(4)]
    if not forced:
        more = TRUNCATED if truncated else 0
        for state, leads in enumerate(NEXT):
            if initial in leads:
                moves.append((state, leads[initial], more, "K"))
            moves += [(state, leads[x], REROLE + more, "R") for x in "ua" if x in leads]
    return moves


MOVES = {(i, f, t): row_moves(i, f, t) for i in ("s", "u", "a", "") for f in (False, True) for t in (False, True)}


def _feed(search: Survivors, initial: str, forced: bool, truncated: bool, times: int, last: bool) -> None:
    """A row and, if it is repeated, its copies, which all must go."""
    search.advance(MOVES[initial if initial in ("s", "u", "a") else "", forced, truncated])
    search.insert()
    if times > 1:
        run = "D" * (times - 1)
        search.advance((state, state, DELETE * len(run), run) for state in range(4))
        search.insert()
    if last:
        search.prune()


SEARCHED = "part int, entry int, exit int, cost bigint, edits string, first string, last string, illegal bigint"


def _search(conv_type: pa.DataType):
    """Rows of a partition in order -> for each conversation the best edits, or for one that spans
    partitions its piece's best edits for each way in and out; with the initials at both ends."""

    def run(conv, part, spans, rows):
        searches = [(entry, Survivors(entry), []) for entry in (range(4) if spans else (EMPTY,))]
        for _, search, _ in searches:
            search.insert()
        first = last = None
        illegal = 0
        for initial, forced, truncated, times in rows:
            for _, search, edits in searches:
                _feed(search, initial, forced, truncated, times, not spans)
                edits += (symbol for symbol, _ in search.settled())
            pair = initial + initial
            illegal += (times - 1) * (pair not in ("su", "ua", "au"))
            illegal += last is not None and last + initial not in ("su", "ua", "au")
            first, last = initial if first is None else first, initial
        for entry, search, edits in searches:
            for ends in ([(x,) for x in search.best] if spans else [(EMPTY, ASSISTANT)]):
                cost, rest = search.finish(ends)
                yield conv, part, entry, ends[0] if spans else -1, cost, "".join(edits) + "".join(s for s, _ in rest), first, last, illegal

    def search(batches):
        for conv, part, spans, rows in _runs(batches, ("initial", "forced", "truncated", "times")):
            yield from _table(run(conv, part, spans, rows), (conv_type, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(),
                                                             pa.string(), pa.string(), pa.int64()),
                              ("conv", "part", "entry", "exit", "cost", "edits", "first", "last", "illegal"))

    return _gathered(search)


def _runs(batches, columns):
    """(conv, part, spans, rows) for each run of rows of one conversation and partition. Rows must
    be used up before the next run is asked for."""
    def flat():
        for batch in batches:
            marks = [batch[c].to_pylist() for c in ("conv", "part", "spans")]
            yield from zip(zip(*marks), zip(*(batch[c].to_pylist() for c in columns)))

    for (conv, part, spans), rows in itertools.groupby(flat(), key=lambda x: x[0]):
        yield conv, part, spans, (row for _, row in rows)


def _table(rows, types, names):
    columns = list(zip(*rows))
    if columns:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], list(names))


def _gathered(work, rows: int = 5_000):
    """``work`` with its small batches put together."""
    def gathered(batches):
        held, n = [], 0
        for batch in work(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return gathered


def _chain(conv_type: pa.DataType):
    """Pieces of conversations, sorted by conversation and partition -> the edits of each piece."""

    def chain(batches):
        names = ("entry", "exit", "cost", "edits", "first", "last", "illegal")

        def run(conv, pieces):
            search, parts, done = Survivors(), [], []
            for part, moves in pieces:
                search.advance(m[:4] for m in moves)
                parts.append((part, *moves[0][4:]))
                done += search.settled()
            cost, rest = search.finish()
            entry = EMPTY
            for (part, *ends), (edits, after) in zip(parts, done + rest):
                yield conv, part, entry, -1, cost, edits, *ends
                entry, cost = after, 0                  # the whole cost stands in the first piece's row

        runs = _runs(batches, names)
        for conv, same in itertools.groupby(runs, key=lambda x: x[0]):
            yield from _table(run(conv, ((part, list(rows)) for _, part, _, rows in same)),
                              (conv_type, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()),
                              ("conv", "part", *names))

    return _gathered(chain)


def _apply(conv_type: pa.DataType):
    """A piece's edits (place -1) followed by its rows -> kept and inserted rows, in their new order."""

    def apply(batches):
        def run(conv, part, rows):
            edits, state, out, at = "", EMPTY, 0, 0

            def inserted():
                nonlocal state, at, out
                while at < len(edits) and edits[at] == "I":
                    state = ASSISTANT if state == USER else USER
                    yield conv, part, out, ROLE[state], None, "I"
                    at, out = at + 1, out + 1

            for place, found, entry, row, initial, times in rows:
                if place < 0:
                    edits, state = found, entry
                    continue
                yield from inserted()
                symbol = edits[at]
                if symbol == "K":
                    state = NEXT[state][initial]
                    yield conv, part, out, None, row, "K"
                elif symbol == "R":
                    state = ASSISTANT if state == USER else USER
                    yield conv, part, out, ROLE[state], row, "R"
                at, out = at + 1, out + 1
                if times > 1:                           # the copies, perhaps after insertions
                    yield from inserted()
                    at += times - 1
            yield from inserted()

        for conv, part, _, rows in _runs(batches, ("place", "edits", "entry", "row", "initial", "times")):
            yield from _table(run(conv, part, rows), (conv_type, pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.string()),
                              ("conv", "part", "out", "new_role", "row", "edit"))

    return _gathered(apply)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text) with faults made by the crc32 of ``conv:turn`` modulo 20: 0
    drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it
    the user's. A null is one space, in the key too."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(or_space(conv_col), F.lit(":"), or_space(turn_col)).cast("binary")) % 20
    return rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), or_space(role_col).alias("role"),
                       or_space(text_col).alias("text"), fate.alias("fate")).where("fate <> 0").select(
        "conv", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _identity(*cols: str) -> Column:
    """32 bytes that tell rows apart: each value after its length, nulls as a dash."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")),
                        F.lit("-")) for c in cols]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows without texts, counted, with their faults, in order, written once."""
    bare = rows.select("conv", "turn", "role", _identity("conv", "turn", "role", "text").alias("row"),
                       _identity("role", "text").alias("said"), F.substring("text", 1, 64).alias("start"),
                       (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
                       F.col("text").rlike(rf"[^.!?{SPACE}][{SPACE}]*\z").alias("cut"))
    once = bare.groupBy(*bare.columns).agg(F.count(F.lit(1)).alias("times"))
    once = stable(once)
    # A struct compares nulls first; min() of the bare turn would skip them.
    when = once.groupBy("conv", "said").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select(F.col("conv").alias("c"), F.col("said").alias("s"), "first")
    seen = once.join(when, once.conv.eqNullSafe(when.c) & (once.said == when.s), "left")
    again = F.coalesce(~F.col("first.turn").eqNullSafe(F.col("turn")), F.lit(False))
    marked = seen.select("conv", "turn", "role", "start", "said", "row", "times", "blank",
                         (~F.col("blank") & F.col("first").isNotNull() & again).alias("duplicate"), "cut",
                         F.substring("role", 1, 1).alias("initial"),
                         # Range keys of bounded length whose order agrees with the full order.
                         F.substring("role", 1, 65).alias("role_key"),
                         F.when(F.length("role") <= 64, F.col("start")).otherwise("").alias("start_key"))
    dealt = marked.repartitionByRange("conv", "turn", "role_key", "start_key") \
        .sortWithinPartitions("conv", "turn", "role", "start", "said")
    return stable(dealt.select("conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
                               "turn", "row", "times", "blank", "duplicate", "initial",
                               (F.col("blank") | F.col("duplicate")).alias("forced"), F.col("cut").alias("truncated")))


class Repair:
    """The result: ``edits`` (conv, part, cost, edits, first, last, illegal), one row per piece of a
    conversation; ``rows`` (conv, part, out, role, text, edit), kept and inserted, in order by
    part and out; ``ordered``, the rows before repair with their faults."""

    def __init__(self, ordered: DataFrame, edits: DataFrame, rows: DataFrame):
        self.ordered, self.edits, self.rows = ordered, edits, rows


def repair(rows: DataFrame) -> Repair:
    """Repairs conversations given as rows (conv, turn, role, text) without null roles or texts."""
    conv = rows.schema["conv"].dataType
    sql, arrow = conv.simpleString(), {T.LongType(): pa.int64(), T.IntegerType(): pa.int32()}.get(conv, pa.string())
    ordered = _ordered(rows)
    # Conversations on several partitions: at most one for each border.
    spread = ordered.select("conv", "part").distinct().groupBy("conv").agg(F.count(F.lit(1)).alias("parts")) \
        .where("parts > 1").select(F.col("conv").alias("c"), F.lit(True).alias("across"))
    place = ordered.select("conv", "part", "place", "row", "initial", "forced", "truncated", "times")
    split = place.join(spread, place.conv.eqNullSafe(spread.c), "left_semi").withColumn("spans", F.lit(True))
    whole = place.join(spread, place.conv.eqNullSafe(spread.c), "left_anti").withColumn("spans", F.lit(False))
    whole, split = (df.repartition("conv", "part").sortWithinPartitions("conv", "part", "place")
                    .mapInArrow(_search(arrow), f"conv {sql}, {SEARCHED}") for df in (whole, split))
    pieces = split.withColumn("spans", F.lit(True)).repartition("conv").sortWithinPartitions("conv", "part", "entry", "exit")
    edits = stable(whole.unionByName(pieces.mapInArrow(_chain(arrow), f"conv {sql}, {SEARCHED}")))
    steps = place.select("conv", "part", "place", F.lit(None).cast("string").alias("edits"), F.lit(None).cast("int").alias("entry"),
                         "row", "initial", "times") \
        .unionByName(edits.select("conv", "part", F.lit(-1).cast("bigint").alias("place"), "edits", "entry",
                                  F.lit(None).cast("binary").alias("row"), F.lit(None).cast("string").alias("initial"),
                                  F.lit(1).cast("bigint").alias("times")))
    kept = steps.withColumn("spans", F.lit(False)).repartition("conv", "part").sortWithinPartitions("conv", "part", "place") \
        .mapInArrow(_apply(arrow), f"conv {sql}, part int, out bigint, new_role string, row binary, edit string")
    kept = stable(kept)
    texts = rows.select(_identity("conv", "turn", "role", "text").alias("id"), "role", "text")
    wanted = kept.where("row IS NOT NULL")
    texts = texts.groupBy("id").agg(F.first(F.struct("role", "text")).alias("said"))
    out = wanted.join(texts, wanted.row == texts.id) \
        .select("conv", "part", "out", F.coalesce("new_role", "said.role").alias("role"), "said.text", "edit") \
        .unionByName(kept.where("row IS NULL").select("conv", "part", "out", F.col("new_role").alias("role"), F.lit("").alias("text"), "edit"))
    return Repair(ordered, edits, out)


def hashes(rows: DataFrame) -> DataFrame:
    """(conv, sha256): of each conversation's ``role:text`` lines in order, joined by newlines,
    fed to the hash one row at a time."""
    conv = rows.schema["conv"].dataType
    arrow = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32()}.get(conv, pa.string())

    def digest(batches):
        for conv_id, _, _, lines in _runs(batches, ("role", "text")):
            state, first = hashlib.sha256(), True
            for role, text in lines:
                state.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
            yield from _table([(conv_id, state.hexdigest())], (arrow, pa.string()), ("conv", "sha256"))

    sorted_rows = rows.withColumn("spans", F.lit(False)).repartition("conv").sortWithinPartitions("conv", "part", "out") \
        .select("conv", F.lit(0).alias("part"), "spans", "role", "text")
    return sorted_rows.mapInArrow(_gathered(digest), f"conv {conv.simpleString()}, sha256 string")


def report(conversations: DataFrame, repaired: Repair) -> DataFrame:
    """One row per conversation of ``conversations`` (column conv): its gaps, faults, cost, edits
    and the hash of its repaired text."""
    n = F.col("times")
    faults = repaired.ordered.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("duplicate"), n).when(~F.col("blank"), n - 1).otherwise(0)).alias("duplicate"),
        F.sum((~F.col("forced") & F.col("truncated")).cast("bigint")).alias("truncated"))
    # Pieces meet at their ends: one value a partition, not a row.
    piece = F.struct("part", "first", "last", "illegal", "cost", "edits")
    joined = repaired.edits.groupBy("conv").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    pairs = F.zip_with(F.slice("p", 2, F.size("p")), F.slice("p", 1, F.greatest(F.size("p") - 1, F.lit(0))),
                       lambda b, a: (~F.concat(a["last"], b["first"]).isin("su", "ua", "au")).cast("bigint"))
    add = lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda s, v: s + v)
    joined = joined.select("conv", (add(F.transform("p", lambda x: x["illegal"])) + add(pairs)).alias("illegal"),
                           add(F.transform("p", lambda x: x["cost"])).alias("cost"),
                           F.array_join(F.transform("p", lambda x: x["edits"]), "").alias("audit"))
    ids = conversations.select("conv").distinct()
    out = ids
    for table in (faults, joined, hashes(repaired.rows)):
        named = table.withColumnRenamed("conv", "c")
        out = out.join(named, out.conv.eqNullSafe(named.c), "left").drop("c")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select("conv", *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
