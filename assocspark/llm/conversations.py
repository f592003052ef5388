"""Repair of the turn structure of conversations by the cheapest edits.

A repaired conversation has role initials ``(s?(ua)+)?``: nothing, or an optional system turn and then user and assistant in turn. Each
message is kept (K, free), given the role user or assistant (R, 2) or deleted (D, 3); empty messages are inserted (I, 2)
anywhere. Blank messages and repeats of an earlier role and text must be deleted; a truncated message that stays costs 1 more.
Of equally cheap edits the least string of initials in ASCII order wins.

The edits are found by a Viterbi search over four states (nothing yet, after s, after u, after a). Messages stream through in
order; each state keeps one survivor, the least of its equals. The survivors' edits form a backpointer tree with reference counts: a
branch without survivors is freed, and what all survivors share is emitted at once, so only unresolved edits are held, not
the conversation. Ties are decided on complete unresolved suffixes: survivors have used up the same messages and end in
one's edit, so none is a prefix of another; their order is carried along as a rank, and a tie between extensions is settled by
that rank and then by the new edits, without rereading the suffixes. A survivor that another one undercuts by more than it
could ever cost to follow the same edits from there is dropped; runs of deletions are held as a count.

Messages are shuffled once, by conversation, and sorted outside memory; a conversation of any length is read once by one task, as its text
and its checksum are sequences, in memory for its unresolved edits.

Defined cases: NULL ids are one conversation; a NULL role or text is one space, a NULL turn comes first and counts in no gap.
Messages with equal turns are ordered by role and text. Roles that begin with another letter than s, u, a can only be given
a role or deleted. A conversation all of whose messages were dropped has zeros and no edits. Repeated rows are messages of
their own (and duplicates). An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1  # costs; to keep is free
LEGAL = {"su", "ua", "au"}
_NEXT = {NOTHING: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
_AFTER = {"s": {NOTHING: SYSTEM}, "u": {s: USER for s in (NOTHING, SYSTEM, ASSISTANT)}, "a": {USER: ASSISTANT}}
_INSERTS = {  # state -> what can be inserted without coming back to a state
    NOTHING: [("", NOTHING), ("I", USER), ("II", ASSISTANT)], SYSTEM: [("", SYSTEM), ("I", USER), ("II", ASSISTANT)],
    USER: [("", USER), ("I", ASSISTANT)], ASSISTANT: [("", ASSISTANT), ("I", USER)],
}
_CLOSING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_FOLLOW = {  # (a, b): what it costs at most to make the edits that follow state b from state a
    (NOTHING, SYSTEM): 0, (NOTHING, USER): 2, (NOTHING, ASSISTANT): 0, (SYSTEM, NOTHING): 4, (SYSTEM, USER): 2, (SYSTEM, ASSISTANT): 4,
    (USER, NOTHING): 5, (USER, SYSTEM): 2, (USER, ASSISTANT): 2, (ASSISTANT, NOTHING): 3, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): 2,
}
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _moves(initial: str | None, truncated: bool) -> list[list[tuple[str, int, int]]]:
    """From each state: edits up to and with one message, the state after it and the cost. Without initial it must go."""
    out = []
    for state in range(4):
        moves = []
        for inserted, here in _INSERTS[state]:
            cost = INSERT * len(inserted)
            moves.append((inserted + "D", here, cost + DELETE))
            if initial is not None:
                moves.append((inserted + "R", _NEXT[here][0], cost + RENAME + TRUNCATED * truncated))
                if here in _AFTER.get(initial, ()):
                    moves.append((inserted + "K", _AFTER[initial][here], cost + TRUNCATED * truncated))
        out.append(moves)
    return out


_MOVES = {(i, t): _moves(i, t) for i in (None, "s", "u", "a", "") for t in (False, True)}


class _Branch:
    """Edits shared by the survivors below it: counts of deletions, and (letters, role, text) of the others."""

    __slots__ = ("parent", "edits", "refs")

    def __init__(self, parent: _Branch | None, refs: int):
        self.parent, self.refs, self.edits = parent, refs, []

    def add(self, letters: str, role: str, text: str) -> None:
        if letters[-1:] != "D":
            self.edits.append((letters, role, text))
            return
        if len(letters) > 1:
            self.edits.append((letters[:-1], None, None))
        self.extend([1])

    def extend(self, edits: list) -> None:
        if edits and isinstance(edits[0], int) and self.edits and isinstance(self.edits[-1], int):
            self.edits[-1] += edits[0]
            edits = edits[1:]
        self.edits.extend(edits)

    def join(self) -> _Branch:
        """Take in the branch above, of which this is the only one below; returns that branch."""
        above = self.parent
        above.extend(self.edits)
        self.edits, self.parent = above.edits, above.parent
        return above


class Viterbi:
    """The cheapest edits of one conversation. ``step`` and ``close`` return the edits that are settled by then."""

    def __init__(self):
        self.root = _Branch(None, 1)
        self.survivors = {NOTHING: (0, 0, self.root)}  # state -> (cost, rank of the edits, branch)
        self.state = NOTHING  # after the edits returned so far

    def step(self, role: str, text: str, must_go: bool, truncated: bool) -> list[tuple[str, str | None, str | None]]:
        initial = None if must_go else role[:1] if role[:1] in _AFTER else ""
        moves, best = _MOVES[initial, truncated and not must_go], {}
        for state, (cost, rank, _) in self.survivors.items():
            for letters, after, more in moves[state]:
                found = (cost + more, rank, letters, state)
                if after not in best or found < best[after]:
                    best[after] = found
        for a in list(best):
            if any(b != a and best[b][0] + _FOLLOW[b, a] < best[a][0] for b in best):
                del best[a]
        heirs: dict[int, list[int]] = {}
        for after, found in best.items():
            heirs.setdefault(found[3], []).append(after)
        branches = {}
        for state, (_, _, branch) in self.survivors.items():
            own = heirs.get(state, [])
            if len(own) == 1:
                branch.add(best[own[0]][2], role, text)
                branches[own[0]] = branch
            elif own:
                branch.refs = len(own)
                for after in own:
                    branches[after] = _Branch(branch, 1)
                    branches[after].add(best[after][2], role, text)
            else:
                self._free(branch)
        order = sorted(best, key=lambda after: best[after][1:3])
        self.survivors = {after: (best[after][0], order.index(after), branches[after]) for after in best}
        return self._settled()

    def _free(self, branch: _Branch) -> None:
        while branch is not None:
            branch.refs -= 1
            if branch.refs:
                return
            branch.edits, branch = [], branch.parent

    def _settled(self) -> list[tuple[str, str | None, str | None]]:
        """Edits that all survivors share; branches with one reference left become one with the branch below."""
        for _, _, branch in self.survivors.values():
            while branch is not None:
                while branch.parent is not None and branch.parent.refs == 1:
                    if branch.join() is self.root:
                        self.root = branch
                branch = branch.parent
        edits, self.root.edits = self.root.edits, []
        return self._shown(edits)

    def _shown(self, edits: list) -> list[tuple[str, str | None, str | None]]:
        out = []
        for edit in edits:
            if isinstance(edit, int):
                out += [("D", None, None)] * edit
                continue
            letters, role, text = edit
            for letter in letters:
                if letter == "K":
                    self.state = _AFTER[role[:1]][self.state]
                    out.append(("K", role, text))
                else:
                    self.state, name = _NEXT[self.state]
                    out.append((letter, name, text if letter == "R" else ""))
        return out

    def close(self) -> tuple[list[tuple[str, str | None, str | None]], int]:
        """The last edits and the whole cost."""
        ends = [(cost + INSERT * len(_CLOSING[s]), rank, _CLOSING[s], s) for s, (cost, rank, _) in self.survivors.items()]
        cost, _, letters, state = min(ends)
        branch, path = self.survivors[state][2], []
        while branch is not None:
            path, branch = branch.edits + path, branch.parent
        return self._shown(path + [(letters, None, None)]), cost


def damaged(messages: DataFrame) -> DataFrame:
    """Messages with damage that follows from a checksum of ``conv_id:turn`` modulo 20; NULLs become one space there and in role and text.

    0: dropped (``present`` is false), 1: empty text, 2: without ``.!?``, 3: twice, 4: role user.
    """
    shown = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    code = F.crc32(F.concat(shown["conv_id"], F.lit(":"), shown["turn"]).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(shown["text"], "[.!?]", "")).otherwise(shown["text"])
    copies = F.when(code == 0, 0).when(code == 3, 2).otherwise(1)
    return messages.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(shown["role"]).alias("role"), text.alias("text"),
        F.explode_outer(F.array_repeat(F.lit(True), copies)).alias("present"),
    ).withColumn("present", F.col("present").isNotNull())


def repair(messages: DataFrame) -> DataFrame:
    """The edits of each conversation in order, and a closing row (``edit`` NULL) with its counts.

    conv_id, edit, role, text (of the message after the edit; NULL where it is deleted); on closing rows gaps, blank, duplicate, truncated, illegal,
    cost. Rows of a conversation follow each other within one partition. ``messages`` has conv_id, turn, role, text, and may
    have ``present``: rows where it is false are not there, but their conversation is.
    """
    present = F.col("present") if "present" in messages.columns else F.lit(True)
    rows = messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), present.alias("present"),
    ).repartition("conv_id")
    same = F.when(F.col("present"), F.sha2(F.concat_ws(":", F.char_length("role"), "role", "text"), 256)).alias("same")
    turn = F.col("turn").asc_nulls_first()
    # one shuffle serves the window, the sort and the search
    earlier = F.row_number().over(Window.partitionBy("conv_id", "same").orderBy(turn))
    inner = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    fault = F.when(~inner, "blank").when(F.col("earlier") > 1, "duplicate")
    fault = fault.when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    rows = rows.select("*", same).withColumn("earlier", earlier).withColumn("fault", fault)
    ordered = rows.sortWithinPartitions("conv_id", turn, "role", "text", "earlier")
    schema = "conv_id long, edit string, role string, text string, " + ", ".join(f"{c} long" for c in _COUNTS)
    return ordered.select("conv_id", "turn", "role", "text", "present", "fault").mapInArrow(_repaired, schema)


_EDITS = pa.schema([("conv_id", pa.int64()), *((c, pa.string()) for c in ("edit", "role", "text")), *((c, pa.int64()) for c in _COUNTS)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _EDITS, strict=True)], schema=_EDITS)


class _Conversation:
    """One conversation on its way through: its search and its counts."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.search = conv_id, Viterbi()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.first = self.last = self.before = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> list[tuple]:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        if fault:
            self.faults[fault] += 1
        return self._rows(self.search.step(role, text, fault in ("blank", "duplicate"), fault == "truncated"))

    def _rows(self, edits: list[tuple]) -> list[tuple]:
        return [(self.conv_id, *edit, *[None] * len(_COUNTS)) for edit in edits]

    def close(self) -> list[tuple]:
        edits, cost = self.search.close()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return [*self._rows(edits), (self.conv_id, None, None, None, gaps, *self.faults.values(), self.illegal, cost)]


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, rows, held = None, [], 0
    for batch in batches:
        for conv_id, turn, role, text, present, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current is None or conv_id != current.conv_id:
                rows += current.close() if current else []
                current = _Conversation(conv_id)
            if present:
                rows += current.add(turn, role, text, fault)
                held += len(text)
            if len(rows) >= 4096 or held > 1 << 20:
                if rows:
                    yield _batch(rows)
                rows, held = [], 0
    if current:
        rows += current.close()
    if rows:
        yield _batch(rows)


def digest(edits: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``: its counts, the initials of its edits, and a checksum of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, sha, written = bytearray(), hashlib.sha256(), False
        for batch in batches:
            out = []
            for conv_id, edit, role, text, *counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if edit is None:
                    out.append((conv_id, *counts, audit.decode(), sha.hexdigest()))
                    audit, sha, written = bytearray(), hashlib.sha256(), False
                    continue
                audit += edit.encode()
                if edit != "D":
                    sha.update(f"{chr(10) if written else ''}{role}:{text}".encode())
                    written = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    kinds = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    schema = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    return edits.mapInArrow(run, schema)
