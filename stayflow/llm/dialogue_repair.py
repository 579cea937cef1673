"""Operator 13: repair of conversation structure by a persistent audit DP.

The rows of a conversation, in order of turn, are edited until their role initials read ``(s?(ua)+)?``: Keep costs 0, Rerole (to user or
assistant) 2, Delete 3 (blank and duplicate rows must go), Insert (an empty user or assistant message) 2, and a truncated row
that stays 1 more. The cheapest audit (the edits' initials in order) is found, of equal ones the least in ASCII order.

The DP walks the rows with four states: nothing yet, after system, after user, after assistant. A state keeps its cost and one
linked node per edit; nodes share their prefixes, carry binary-lifting ancestors and a rolling hash of all letters up to
them. Two audits of the same cost are compared by searching their longest common prefix over the ancestors: where hashes differ
the prefixes differ, and where they agree on different nodes the letters are compared. Within one state equal costs never
leave one audit a prefix of the other (what is left would be inserts, which cost), so the least prefix can be kept.

On Spark: damage and faults are column expressions, with one shuffle by conversation and sorts that spill; then each partition is
streamed in order. Edits on which all states agree are final: they go out, and their rows and nodes are let go. So a task
holds the rows since then, not the conversation. A conversation is one stream (its digest is a hash over its whole text in
order), so one that holds a third of all rows takes one task, in bounded memory unless its states never agree (as with
roles that are neither user nor assistant throughout), where rows and nodes are held until the end.

Defined results: a null conversation id, turn, role or text reads as one space in what is hashed and in role and text; rows with a null id
are one conversation, with a null id in the result; null turns come first; rows of one turn follow by role, then text;
repeated rows are duplicates of the first; a conversation without rows after the damage has zeros, an empty audit and
no repaired message; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

MODULUS, BASE = (1 << 61) - 1, 1_000_003
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL_EVERY = 256  # rows between two looks at what all states agree on
OK, BLANK, DUPLICATE, CUT = range(4)
FAULTS = ("blank", "duplicate", "truncated")


class Edit:
    """One edit after another: a node that shares its whole prefix. ``up[k]`` is the node 2**k edits before."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, letter: str, before: "Edit | None"):
        self.letter = letter
        if before is None:  # the empty audit
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * BASE + ord(letter)) % MODULUS
        up, k = [before], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    def at(self, depth: int) -> "Edit":
        """The node of the first ``depth`` edits."""
        node = self
        while node.depth > depth:
            node = node.up[min((node.depth - depth).bit_length(), len(node.up)) - 1]
        return node

    def letters(self) -> str:
        out, node = [], self
        while node.depth:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def shared(a: Edit, b: Edit) -> int:
    """How many edits two audits of one root have in common at their beginning."""
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x.hash != y.hash:
        for k in range(len(x.up) - 1, -1, -1):  # up to the first nodes whose hashes differ
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        x, y = x.up[0], y.up[0]
    same = x.depth
    while x is not y:  # equal hashes on different nodes: compare the letters themselves
        if x.letter != y.letter:
            same = x.depth - 1
        x, y = x.up[0], y.up[0]
    return same


def less(a: Edit, b: Edit) -> bool:
    """Whether the audit of a comes before that of b."""
    if a is b:
        return False
    n = shared(a, b)
    if n == a.depth or n == b.depth:
        return a.depth < b.depth
    return a.at(n + 1).letter < b.at(n + 1).letter


def spoken(state: int) -> int:
    """Who speaks next where a message is inserted or given a new role."""
    return ASSISTANT if state == USER else USER


def kept(state: int, initial: str) -> int | None:
    """The state after a row that keeps its role, or None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


class Audit:
    """The DP over the rows of one conversation. ``live[state]`` is (cost, node) or None."""

    def __init__(self):
        self.live: list[tuple[int, Edit] | None] = [(0, Edit("", None)), None, None, None]
        self._insert()

    @staticmethod
    def _enter(live: list, state: int, cost: int, before: Edit, letter: str) -> bool:
        held = live[state]
        if held is not None and held[0] < cost:
            return False
        node = Edit(letter, before)
        if held is not None and held[0] == cost and not less(node, held[1]):
            return False
        live[state] = (cost, node)
        return True

    def _insert(self) -> None:
        """Inserts between two rows, one after another as long as one helps."""
        todo = [s for s in range(4) if self.live[s]]
        while todo:
            state = todo.pop(0)
            cost, node = self.live[state]
            if self._enter(self.live, spoken(state), cost + INSERT, node, "I"):
                todo.append(spoken(state))

    def row(self, initial: str, fault: int) -> None:
        live: list[tuple[int, Edit] | None] = [None] * 4
        extra = TRUNCATED if fault == CUT else 0
        for state, held in enumerate(self.live):
            if held is None:
                continue
            cost, node = held
            self._enter(live, state, cost + DELETE, node, "D")
            if fault in (BLANK, DUPLICATE):
                continue
            after = kept(state, initial)
            if after is not None:
                self._enter(live, after, cost + KEEP + extra, node, "K")
            self._enter(live, spoken(state), cost + REROLE + extra, node, "R")
        self.live = live
        self._insert()
        # Whatever can follow "nothing yet" or "after system" can follow "after assistant", for 3 more at most (a system row
        # that must go) and for nothing more: a state above that is never part of the cheapest audit.
        best = self.live[ASSISTANT][0]
        for state, more in ((START, DELETE), (SYSTEM, 0)):
            if self.live[state] and self.live[state][0] > best + more:
                self.live[state] = None

    def final(self) -> str:
        """Takes off the edits that all states agree on, once they are half of what is held."""
        nodes = [held[1] for held in self.live if held]
        agreed = min(shared(nodes[0], n) for n in nodes)
        if 2 * agreed < max(n.depth for n in nodes):
            return ""
        out = nodes[0].at(agreed).letters()
        fresh = Edit("", None)
        twins = {id(nodes[0].at(agreed)): fresh}

        def moved(node: Edit) -> Edit:  # shared nodes stay shared
            chain = []
            while node.depth > agreed and id(node) not in twins:
                chain.append(node)
                node = node.up[0]
            twin = twins.get(id(node), fresh)
            for old in reversed(chain):
                twin = twins[id(old)] = Edit(old.letter, twin)
            return twin

        self.live = [held and (held[0], moved(held[1])) for held in self.live]
        return out

    def best(self) -> tuple[int, str]:
        """Cost and remaining edits of the cheapest end, the least of equal ones."""
        empty, full = self.live[START], self.live[ASSISTANT]
        if empty and (empty[0] < full[0] or empty[0] == full[0] and less(empty[1], full[1])):
            return empty[0], empty[1].letters()
        return full[0], full[1].letters()


def audit(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation given as (role initial, fault) per row."""
    dp, done = Audit(), []
    for i, (initial, fault) in enumerate(rows, 1):
        dp.row(initial, fault)
        if i % FINAL_EVERY == 0:
            done.append(dp.final())
    cost, rest = dp.best()
    return cost, "".join([*done, rest])


class Conversation:
    """The rows of one conversation as they stream by. ``say`` gets (edit, turn, role, text) of every message that stays."""

    def __init__(self, say):
        self.say, self.dp, self.state = say, Audit(), START
        self.waiting: deque = deque()
        self.audit: list[str] = []
        self.counts = [0, 0, 0, 0]
        self.illegal = self.rows = self.turns = 0
        self.last = self.low = self.high = None

    def row(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if self.rows and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        self.rows += 1
        self.counts[fault] += 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        self.waiting.append((turn, role, text))
        self.dp.row(initial, fault)
        if self.rows % FINAL_EVERY == 0:
            self._apply(self.dp.final())

    def _apply(self, edits: str) -> None:
        self.audit.append(edits)
        for edit in edits:
            turn, role, text = (None, None, "") if edit == "I" else self.waiting.popleft()
            if edit == "D":
                continue
            self.state = kept(self.state, role[:1]) if edit == "K" else spoken(self.state)
            if edit != "K":
                role = "user" if self.state == USER else "assistant"
            self.say(edit, turn, role, text)

    def end(self) -> list:
        """gaps, blank, duplicate, truncated, illegal, cost, audit."""
        cost, rest = self.dp.best()
        self._apply(rest)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return [gaps, *self.counts[1:], self.illegal, cost, "".join(self.audit)]


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (none null but conv_id and turn), and fault: 0 none, 1 blank, 2 duplicate, 3 truncated. One
    shuffle, by conversation; partitions are in order of conversation and turn."""
    here = rows.repartition(F.col("conv_id"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(nth > 1, DUPLICATE)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(OK))
    return (here.select("conv_id", "turn", "role", "text", fault.alias("fault"), nth.alias("nth"))
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "nth").drop("nth"))


def _plain(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return df.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))


def damage(rows: DataFrame) -> DataFrame:
    """What the contract of the query does to rows by ``crc32(conv_id:turn) % 20``: 0 drops the row, 1 empties its text, 2 takes
    out its [.!?], 3 repeats it, 4 makes it the user's."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hit = F.col("hit")
    return (rows.withColumn("hit", F.crc32(F.encode(key, "UTF-8")) % 20).where(hit != 0)
            .withColumn("text", F.when(hit == 1, "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
            .withColumn("role", F.when(hit == 4, "user").otherwise(F.col("role")))
            .withColumn("copy", F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text"))


def _schema(df: DataFrame, **columns) -> pa.Schema:
    """The id's own type and further columns."""
    return pa.schema([("conv_id", to_arrow_type(df.schema["conv_id"].dataType)), *columns.items()])


def _stream(batches: Iterator[pa.RecordBatch], sink):
    """Every row of sorted batches through its conversation; yields (id, conversation) as each one ends."""
    own, now = None, None
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            columns = [c.to_pylist() for c in batch.slice(lo, 1024).columns]
            for conv, turn, role, text, fault in zip(*columns):
                if now is None or conv != own:
                    if now is not None:
                        yield own, now
                    own, now = conv, Conversation(sink(conv))
                now.row(turn, role, text, fault)
    if now is not None:
        yield own, now


class _Digest:
    """Hash of messages as ``role:text``, one per line."""

    def __init__(self):
        self.sha, self.join = hashlib.sha256(), ""

    def __call__(self, edit, turn, role, text):
        self.sha.update(f"{self.join}{role}:{text}".encode())
        self.join = "\n"


def report(rows: DataFrame) -> DataFrame:
    """One row per conversation with rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ["gaps", *FAULTS, "illegal", "cost"]
    schema = _schema(rows, **dict.fromkeys(counts, pa.int64()), audit=pa.string(), repaired_sha256=pa.string())

    def run(batches):
        held, size = [], 0
        for conv, talk in _stream(batches, lambda _: _Digest()):
            held.append([conv, *talk.end(), talk.say.sha.hexdigest()])
            size += 64 + len(held[-1][7])
            if size > 1 << 20:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*held))), schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*held))), schema)

    return faults(rows).mapInArrow(run, f"conv_id {kind}, {', '.join(c + ' long' for c in counts)}, audit string, repaired_sha256 string")


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired messages: conv_id, nth (from 0), edit (K, R or I), turn (null where inserted), role, text."""
    rows = _plain(df, conv, turn, role, text)
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = _schema(rows, nth=pa.int64(), edit=pa.string(), turn=pa.int64(), role=pa.string(), text=pa.string())

    def run(batches):
        out: list[tuple] = []

        def sink(conv):
            count = iter(range(1 << 62))
            return lambda edit, turn, role, text: out.append((conv, next(count), edit, turn, role, text))

        def flush(least):
            if len(out) > least:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out))), schema)
                out.clear()

        for _, talk in _stream(batches, sink):
            talk.end()
            yield from flush(2048)
        yield from flush(0)

    return faults(rows).mapInArrow(run, f"conv_id {kind}, nth long, edit string, turn long, role string, text string")


def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _plain(spark.read.parquet(f"{sf_dir}/conversations.parquet"), "conv_id", "turn", "role", "text")
    every = rows.select(F.col("conv_id").alias("of")).distinct()
    found = report(damage(rows))
    zero = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return (every.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left")
            .select(F.col("of").alias("conv_id"), *(F.coalesce(F.col(c), F.lit(v).cast("long" if v == 0 else "string")).alias(c) for c, v in zero.items())))
