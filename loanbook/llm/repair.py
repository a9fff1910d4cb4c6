"""Repair of the structure of conversations by cheapest edits, and an audit of them.

Turns are kept, given another role, deleted or inserted until the roles are an optional system turn and then
pairs of user and assistant. The cheapest edits come from a cost table over (turn, state), state being what
has been written so far. Arcs that lie on a cheapest way are ranked by prefix doubling: a node's rank by the
first letter of its least audit, then by 2, 4, 8, ... letters, from the ranks of its two halves; with each rank goes a
pointer over as many letters. The least audit is read off through these pointers. At a node no two arcs have the
same letter, so a least string of letters ends at one node.

Conversations may have any length. A sort by sampled ranges puts all turns in order, and each task cuts them into blocks.
A block's costs from each state to each are a 4 x 4 matrix; a pass over these, one row for each
block, gives the cost from each block's end, and then blocks are ranked in parallel, for every state
that may stand at their beginning. A last pass over the blocks of a conversation follows the states.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loanbook.llm.shared import keep

BLOCK_ROWS, BLOCK_BYTES = 1_024, 1 << 17
#: Turns whose nodes are ranked together.
RANKED_ROWS = 32_768
BATCH_ROWS, SLICE = 2_048, 128
#: White space that leaves a text blank, and the ends of a whole text.
SPACES = " \t\n\v\f\r"
STOPS = (".", "!", "?")
#: Costs of a new role, a deletion, an insertion, and of leaving a truncated turn.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# States: nothing written, system written, user written (an assistant must follow), assistant written.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_NONE = 4
#: The state after a written turn of the role that fits a state: user, or assistant after user.
_FITS = np.array([USER, USER, ASSISTANT, USER])
#: The state after keeping a turn with initial s, u, a or another.
_KEPT = np.array([[SYSTEM, _NONE, _NONE, _NONE], [USER, USER, _NONE, USER], [_NONE, _NONE, ASSISTANT, _NONE], [_NONE] * 4])
#: Cost of ending in a state, and the insertions it takes.
_END = np.array([0, 2 * INSERT, INSERT, 0])
_END_EDITS = ["", "II", "I", ""]
_FAR = 1 << 40
_LETTERS = np.frombuffer(b"\0DIKR", np.uint8)  # in the order of ASCII; 0 ends an audit
_INITIALS = "sua"
_MUST_GO, _OPEN = 4, 8  # beside the kind of the initial in a turn's code


class Blocks:
    """Codes of the turns of several blocks, each with one node before every turn and one at its end."""

    def __init__(self, codes: list[bytes]):
        self.size = np.array([len(c) for c in codes], np.int64)
        self.codes = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
        self.base = np.cumsum(self.size + 1) - (self.size + 1)  # a block's first node
        self.first = np.cumsum(self.size) - self.size  # a block's first turn

    def costs(self, tails: np.ndarray) -> np.ndarray:
        """Least costs [node, state, ...] to the ends of the blocks, which cost tails [block, state, ...]."""
        n_nodes = len(self.codes) + len(self.size)
        out = np.empty((n_nodes, *tails.shape[1:]), np.int64)
        out[self.base + self.size] = tails
        order = np.argsort(-self.size, kind="stable")
        size, base, first = self.size[order], self.base[order], self.first[order]
        for step in range(int(size[0]) if len(size) else 0):
            m = int(np.searchsorted(-size, -step, "left"))  # blocks with more turns than that
            at = size[:m] - 1 - step
            code = self.codes[first[:m] + at]
            after = out[base[:m] + at + 1]
            wide = np.concatenate([after, np.full_like(after[:, :1], _FAR)], axis=1)
            extra = ((code & _OPEN) > 0) * TRUNCATED
            extra = extra.reshape(-1, *[1] * (after.ndim - 1))
            kept = np.take_along_axis(wide, _KEPT[code & 3].reshape(m, 4, *[1] * (after.ndim - 2)), axis=1)
            written = np.minimum(kept, after[:, _FITS] + REROLE) + extra
            go = ((code & _MUST_GO) > 0).reshape(extra.shape)
            best = np.where(go, _FAR, written)
            np.minimum(best, after + DELETE, out=best)
            user = np.minimum(best[:, USER], best[:, ASSISTANT] + INSERT)
            best[:, ASSISTANT] = np.minimum(best[:, ASSISTANT], best[:, USER] + INSERT)
            best[:, USER] = user
            best[:, :USER] = np.minimum(best[:, :USER], user[:, None] + INSERT)
            out[base[:m] + at] = best
        return out

    def audits(self, costs: np.ndarray, starts: list[tuple[int, int]]) -> list[tuple[bytes, int]]:
        """(least audit, state at the block's end) from each start (block, state), by ranks and doubled pointers."""
        n_nodes = len(costs)
        inner = np.ones(n_nodes, bool)
        inner[self.base + self.size] = False
        node = np.flatnonzero(inner)
        here, after = costs[node], costs[node + 1]
        code = self.codes
        wide = np.concatenate([after, np.full((len(node), 1), _FAR)], axis=1)
        state = np.arange(4)
        kept = _KEPT[code & 3]
        extra = (((code & _OPEN) > 0) * TRUNCATED)[:, None]
        stays = ((code & _MUST_GO) == 0)[:, None]
        arcs = [  # by letter: whether it lies on a cheapest way, and the state and node it leads to
            (after + DELETE == here, state, 1),
            (here[:, _FITS] + INSERT == here, _FITS, 0),
            (stays & (np.take_along_axis(wide, kept, axis=1) + extra == here), kept, 1),
            (stays & (after[:, _FITS] + REROLE + extra == here), _FITS, 1),
        ]
        rank = np.zeros((n_nodes, 4), np.int64)
        pointer = np.arange(4 * n_nodes).reshape(n_nodes, 4)
        for letter in range(4, 0, -1):  # the least letter is written last
            on, to, steps = arcs[letter - 1]
            own = np.where(on, letter, rank[node])
            rank[node] = own
            pointer[node] = np.where(on, (node[:, None] + steps) * 4 + to, pointer[node])
        rank, pointer = rank.ravel(), pointer.ravel()
        letters = rank.copy()
        begin = np.array([self.base[b] * 4 + q for b, q in starts], np.int64)
        pointers = []
        while letters[pointer[begin]].any():  # some audit is longer yet
            pointers.append(pointer)
            rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
        pointers.append(pointer)
        owner, at, place = np.arange(len(begin)), begin, np.zeros(len(begin), np.int64)
        for k in range(len(pointers) - 1, -1, -1):
            on = pointers[k][at]
            more = letters[on] > 0
            owner, place = np.concatenate([owner, owner[more]]), np.concatenate([place, place[more] + (1 << k)])
            at = np.concatenate([at, on[more]])
        seen = letters[at] > 0
        owner, at, place = owner[seen], at[seen], place[seen]
        order = np.lexsort((place, owner))
        flat = _LETTERS[letters[at[order]]].tobytes()
        edges = np.searchsorted(owner[order], np.arange(len(begin) + 1))
        return [(flat[a:b], int(e)) for a, b, e in zip(edges[:-1], edges[1:], pointers[-1][begin] % 4)]


def _blocks(rows: int, size: int):
    """Sorted turns to blocks of one conversation, with what has to be counted."""
    schema = pa.schema([("block", pa.int64()), ("codes", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                        *[(c, pa.int64()) for c in ("first_turn", "last_turn", "turns", "n_blank", "n_duplicate", "n_truncated", "illegal")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        own: dict | None = None
        out: list[dict] = []
        repeated = before = None

        def closed():
            nonlocal own, number
            out.append(own | {"block": number, "codes": bytes(own["codes"])})
            number, own = number + 1, None

        def batch():
            fields = pa.schema([pa.field("conv_id", kind), *schema])
            found = pa.RecordBatch.from_pylist(out, fields)
            out.clear()
            return found

        kind, held = pa.int64(), 0
        for b in batches:
            kind = b.schema.field("conv_id").type
            for begin in range(0, b.num_rows, BATCH_ROWS):
                for r in b.slice(begin, BATCH_ROWS).to_pylist():
                    key = r["conv_id"], r["turn"], r["digest"]
                    if not r["is_turn"]:
                        repeated = key
                        continue
                    if own and (own["conv_id"] != r["conv_id"] or len(own["codes"]) >= rows or own["bytes"] >= size):
                        held += own["bytes"]
                        closed()
                        if held >= size:
                            yield batch()
                            held = 0
                    if own is None:
                        own = {"conv_id": r["conv_id"], "codes": bytearray(), "roles": [], "texts": [], "bytes": 0, "first_turn": r["turn"],
                               "last_turn": None, "turns": 0, "n_blank": 0, "n_duplicate": 0, "n_truncated": 0, "illegal": 0}
                    duplicate = not r["blank"] and key in (repeated, before)
                    truncated = r["open"] and not r["blank"] and not duplicate
                    own["n_blank"] += r["blank"]
                    own["n_duplicate"] += duplicate
                    own["n_truncated"] += truncated
                    initial = _INITIALS.find(r["initial"]) if r["initial"] else 3
                    initial = 3 if initial < 0 else initial
                    if own["codes"]:
                        own["illegal"] += not _legal(own["codes"][-1] & 3, initial)
                    own["turns"] += r["turn"] is not None and (not own["turns"] or r["turn"] != own["last_turn"])
                    if own["first_turn"] is None:
                        own["first_turn"] = r["turn"]
                    own["last_turn"] = r["turn"]
                    own["codes"].append(initial | _MUST_GO * (r["blank"] or duplicate) | _OPEN * truncated)
                    own["roles"].append(r["role"])
                    own["texts"].append(r["text"])
                    own["bytes"] += len(r["text"]) + 64
                    before = key
        if own:
            closed()
        if out:
            yield batch()
    return run


def _legal(a: int, b: int) -> bool:
    """su, ua and au may stand together."""
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _sorted_blocks(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, rows: int, size: int) -> DataFrame:
    role, text = F.coalesce(turns[role_col].cast("string"), F.lit(" ")), F.coalesce(turns[text_col].cast("string"), F.lit(" "))
    said = turns.select(turns[conv_col].alias("conv_id"), turns[turn_col].cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    whole = F.rtrim(F.col("text"), F.lit(SPACES))
    said = said.select(
        "conv_id", "turn", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
        F.lit(True).alias("is_turn"), "role", "text", F.substring("role", 1, 1).alias("initial"), (whole == "").alias("blank"),
        (~F.right(whole, F.lit(1)).isin(*STOPS)).alias("open"))
    # What was said in an earlier turn is marked by a row of its own, so texts are not joined.
    each = said.select("conv_id", "digest", "turn").distinct()
    firsts = each.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
    marks = each.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))).where(
        ~F.struct("turn").eqNullSafe(F.col("first"))).select("conv_id", "turn", "digest", F.lit(False).alias("is_turn"))
    order = ["conv_id", "turn", "digest"]
    stream = said.unionByName(marks, allowMissingColumns=True).repartitionByRange(*order).sortWithinPartitions(*order, "is_turn")
    kind = turns.schema[conv_col].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in ("first_turn", "last_turn", "turns", "n_blank", "n_duplicate", "n_truncated", "illegal"))
    return keep(stream.mapInArrow(_blocks(rows, size), f"conv_id {kind}, block long, codes binary, roles array<string>, texts array<string>, {counts}"), "blocks")


def _matrices(batches):
    for batch in batches:
        codes = batch.column("codes").to_pylist()
        if not codes:
            continue
        blocks = Blocks(codes)
        ends = np.where(np.eye(4, dtype=bool), 0, _FAR)[None].repeat(len(codes), axis=0)
        found = blocks.costs(ends)[blocks.base].reshape(len(codes), 16)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), pa.array(list(found), pa.list_(pa.int64()))], ["conv_id", "block", "matrix"])


def _tails(batches):
    """Blocks of conversations from the last to the first: the costs from the end of each."""
    own, tail = (), _END
    for batch in batches:
        blocks, tails = [], []
        for conv, block, matrix in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "matrix"))):
            if own != (conv,):
                own, tail = (conv,), _END
            blocks.append(block)
            tails.append(tail.tolist())
            tail = np.minimum((np.array(matrix).reshape(4, 4) + tail).min(axis=1), _FAR)
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(tails, pa.list_(pa.int64()))], ["b", "tail"])


def _chosen(batches):
    """For each block and each state at its beginning: cost to the conversation's end, least audit and state at the block's end."""
    for batch in batches:
        rows = batch.select(["conv_id", "block", "codes", "tail"]).to_pylist()
        at = 0
        while at < len(rows):
            to, n = at, 0
            while to < len(rows) and (to == at or n + len(rows[to]["codes"]) <= RANKED_ROWS):
                n += len(rows[to]["codes"])
                to += 1
            part = rows[at:to]
            blocks = Blocks([r["codes"] for r in part])
            costs = blocks.costs(np.array([_END if r["tail"] is None else r["tail"] for r in part], np.int64))
            # A conversation in one block begins with nothing written.
            starts = [(b, q) for b, r in enumerate(part) for q in range(1 if r["tail"] is None else 4)]
            found = blocks.audits(costs, starts)
            audits, ends, spent = ([[] for _ in part] for _ in range(3))
            for (b, q), (audit, end) in zip(starts, found):
                audits[b].append(audit.decode())
                ends[b].append(end)
                spent[b].append(int(costs[blocks.base[b], q]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id").slice(at, to - at), batch.column("block").slice(at, to - at), pa.array(audits, pa.list_(pa.string())),
                 pa.array(ends, pa.list_(pa.int32())), pa.array(spent, pa.list_(pa.int64()))],
                ["conv_id", "block", "audits", "ends", "costs"])
            at = to


def _prepared(turns: DataFrame, conversations: DataFrame | None, conv_col: str, turn_col: str, role_col: str, text_col: str,
              rows: int, size: int) -> DataFrame:
    """Per conversation, in order: a row that names it, then for each block its choices and its turns."""
    blocks = _sorted_blocks(turns, conv_col, turn_col, role_col, text_col, rows, size)
    kind = turns.schema[conv_col].dataType.simpleString()
    slim = blocks.select("conv_id", "block", "codes").withColumn("n", F.count("*").over(Window.partitionBy("conv_id")))
    slim = keep(slim, "codes")  # a window row for each block, not each turn
    matrices = slim.where("n > 1").mapInArrow(_matrices, f"conv_id {kind}, block long, matrix array<long>")
    tails = matrices.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block")).mapInArrow(_tails, "b long, tail array<long>")
    choices = slim.join(tails, F.col("block") == F.col("b"), "left").mapInArrow(
        _chosen, f"conv_id {kind}, block long, audits array<string>, ends array<int>, costs array<long>")
    names = turns.select(turns[conv_col].alias("conv_id"))
    if conversations is not None:
        names = names.unionByName(conversations.select(conversations[conv_col].alias("conv_id")))
    names = names.distinct().withColumn("block", F.lit(-1).cast("long"))
    stream = blocks.drop("codes").withColumn("part", F.lit(2))
    for other, part in ((choices, 1), (names, 0)):
        stream = stream.unionByName(other.withColumn("part", F.lit(part)), allowMissingColumns=True)
    return stream.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part")


def _edits(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) of each letter; role and text of what is written, null for a deletion."""
    at = 0
    for letter in audit:
        if letter == "D":
            yield letter, None, None
        elif letter == "K":
            yield letter, roles[at], texts[at]
            state = SYSTEM if state == EMPTY and roles[at][:1] == "s" else int(_FITS[state])
        else:
            state = int(_FITS[state])
            yield letter, "user" if state == USER else "assistant", "" if letter == "I" else texts[at]
        at += letter != "I"


class _Walk:
    """One conversation, block by block."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.choice, self.cost = conv_id, EMPTY, None, 0
        self.counts = dict.fromkeys(("n_blank", "n_duplicate", "n_truncated", "illegal"), 0)
        self.least = self.most = self.last_turn = self.last_role = None
        self.turns = 0

    def add(self, row: dict) -> Iterator[tuple[str, str | None, str | None]]:
        for c in self.counts:
            self.counts[c] += row[c]
        initials = [r[:1] for r in (row["roles"][0], row["roles"][-1])]
        kinds = [_INITIALS.find(x) if x else 3 for x in initials]
        kinds = [3 if k < 0 else k for k in kinds]
        if self.last_role is not None:
            self.counts["illegal"] += not _legal(self.last_role, kinds[0])
        self.last_role = kinds[1]
        if row["first_turn"] is not None:
            self.turns += row["turns"] - (row["first_turn"] == self.last_turn)
            self.least = row["first_turn"] if self.least is None else self.least
            self.most = self.last_turn = row["last_turn"]
        begin = self.state
        if self.choice["first"]:
            self.cost = self.choice["costs"][EMPTY]
        audit = self.choice["audits"][begin]
        self.state = self.choice["ends"][begin]
        yield from _edits(audit, begin, row["roles"], row["texts"])

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from _edits(_END_EDITS[self.state], self.state, [], [])

    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.turns


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Walk, tuple | None]]:
    """(conversation, edit) in order, and (conversation, None) after its last edit."""
    walk = None
    for batch in batches:
        for row in (r for at in range(0, batch.num_rows, SLICE) for r in batch.slice(at, SLICE).to_pylist()):
            if row["part"] == 0:
                if walk:
                    yield from ((walk, e) for e in walk.end())
                    yield walk, None
                walk = _Walk(row["conv_id"])
            elif row["part"] == 1:
                walk.choice = row | {"first": walk.choice is None}
            else:
                yield from ((walk, e) for e in walk.add(row))
    if walk:
        yield from ((walk, e) for e in walk.end())
        yield walk, None


def _flushed(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for r in rows:
        waiting.append(r)
        if len(waiting) == size:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*waiting), schema)], schema=schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*waiting), schema)], schema=schema)


def repaired(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(conv_id, place, edit, role, text): every edit in order; role and text are those written, null for a deletion (D).

    See `audited` for the rules. Conversations without edits give no rows.
    """
    stream = _prepared(turns, None, conv_col, turn_col, role_col, text_col, block_rows, block_bytes)
    kind = to_arrow_type(turns.schema[conv_col].dataType)
    schema = pa.schema([("conv_id", kind), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        def rows():
            place = 0
            for walk, edit in _walks(batches):
                if edit is None:
                    place = 0
                else:
                    yield (walk.conv_id, place, *edit)
                    place += 1
        return _flushed(rows(), schema, BATCH_ROWS)
    name = turns.schema[conv_col].dataType.simpleString()
    return stream.mapInArrow(run, f"conv_id {name}, place long, edit string, role string, text string")


def audited(turns: DataFrame, conversations: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text", block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    Turns come by number, nulls first; equal numbers by the digest of role and text. A turn is blank,
    else a duplicate of an earlier one, else truncated, else whole; blank ones and duplicates must go. audit has
    the letters of the cheapest edits (K kept, R new role, D deleted, I inserted), the least in ASCII of
    several; the digest is that of the written turns, 'role:text' joined by line feeds. gaps are numbers missing between
    the least and the largest. Null roles and texts are one blank; a role without characters or with another initial
    than s, u, a cannot be kept. Null ids are one conversation. ``conversations`` may name more ids, which have zeros, an empty audit and
    the digest of nothing. Long texts and long conversations pass in blocks; the audit, a letter for each edit, is
    held whole. An empty table gives no rows; other columns are not read.
    """
    stream = _prepared(turns, conversations, conv_col, turn_col, role_col, text_col, block_rows, block_bytes)
    kind = to_arrow_type(turns.schema[conv_col].dataType)
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv_id", kind), *[(c, pa.int64()) for c in longs], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches):
        def rows():
            audit, digest, written = bytearray(), hashlib.sha256(), False
            for walk, edit in _walks(batches):
                if edit is None:
                    c = walk.counts
                    yield (walk.conv_id, walk.gaps(), c["n_blank"], c["n_duplicate"], c["n_truncated"], c["illegal"], walk.cost,
                           audit.decode(), digest.hexdigest())
                    audit, digest, written = bytearray(), hashlib.sha256(), False
                    continue
                letter, role, text = edit
                audit += letter.encode()
                if role is not None:
                    digest.update(f"{chr(10) * written}{role}:{text}".encode())
                    written = True
        return _flushed(rows(), schema, BATCH_ROWS)
    name = turns.schema[conv_col].dataType.simpleString()
    return stream.mapInArrow(run, f"conv_id {name}, {', '.join(f'{c} long' for c in longs)}, audit string, repaired_sha256 string")
