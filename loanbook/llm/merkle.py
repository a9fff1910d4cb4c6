"""Merkle manifest of a table: a tree over the rows of each source, a tree over their roots, and a witness for each row.

Runs of 16 consecutive nodes become their parent until one is left. A tree grows by streaming
append: a node joins the open run of its level and takes a partial witness, a reference to that run
and its place. Later siblings join the same run, which extends all witnesses that refer to it; a full run
closes and its parent is appended one level up. Aligned blocks of 16^3 nodes are appended in parallel.
The roots of the blocks are the nodes that the next round appends, and so on to the root; from there
each round hands the witness of a block down to the nodes of that block. A large source thus has many blocks,
and no task holds more than one of them. Partial witnesses (1 to 3 KB a row) never leave a task: the blocks
are appended once for their roots and again, with what lies above them known, for the witnesses.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loanbook.llm.shared import keep

FAN, LEVELS = 16, 3
BLOCK = FAN ** LEVELS
#: Length of a digest in hexadecimal.
HEX = 64
#: Rows that one batch hands on.
BATCH_ROWS = 4_096

_PROOF = "array<struct<place:int,run:string>>"
_MARKERS = f"tree string, block long, subroot string, root string, proof {_PROOF}"
_OUT_PROOF = pa.list_(pa.struct([("place", pa.int32()), ("run", pa.string())]))

_MARKER_FIELDS = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("proof", _OUT_PROOF)])


def _hash(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def row_digest(*columns: Column) -> Column:
    """Digest of a row: each value as its UTF-8 length, ':' and itself, '-' for null."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


class Append:
    """An aligned tree that grows node by node; witnesses[i] lists (run, place) from the i-th node upwards."""

    def __init__(self):
        self.witnesses: list[list[tuple[list[bytes], int]]] = []
        self._open: list[tuple[list[bytes], int]] = [([], 0)]  # of each level: the open run and its first node

    def _join(self, level: int, digest: bytes, begin: int, end: int) -> None:
        if level == len(self._open):
            self._open.append(([], begin))
        run, first = self._open[level]
        for witness in self.witnesses[begin:end]:
            witness.append((run, len(run)))
        run.append(digest)
        if len(run) == FAN:
            self._close(level, first, end)

    def _close(self, level: int, first: int, end: int) -> None:
        run, _ = self._open[level]
        self._open[level] = ([], end)
        self._join(level + 1, _hash(b"".join(run)), first, end)

    def add(self, digest: bytes) -> None:
        n = len(self.witnesses)
        self.witnesses.append([])
        self._join(0, digest, n, n + 1)

    def root(self, levels: int) -> bytes:
        """Close what is open in the lowest levels; the node above them, which ends every witness there."""
        n = len(self.witnesses)
        for level in range(levels):
            if level < len(self._open) and self._open[level][0]:
                self._close(level, self._open[level][1], n)
        for witness in self.witnesses:
            del witness[levels:]
        return self._open[levels][0][0]


def _levels(total: int) -> int:
    """Levels that a block of a tree of so many nodes rises."""
    if total > BLOCK:
        return LEVELS
    return next(h for h in range(LEVELS + 1) if FAN ** h >= total)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (tree, block) after another; they are at most BLOCK and a marker."""
    rows: list[dict] = []
    for batch in batches:
        for begin in range(0, batch.num_rows, BATCH_ROWS):
            for r in batch.slice(begin, BATCH_ROWS).to_pylist():
                if rows and (r["tree"], r["block"]) != (rows[0]["tree"], rows[0]["block"]):
                    yield rows
                    rows = []
                rows.append(r)
    if rows:
        yield rows


def _appended(rows: list[dict]) -> tuple[Append, bytes]:
    tree = Append()
    for r in rows:
        tree.add(r["digest"].encode())
    return tree, tree.root(_levels(rows[0]["total"]))


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for r in rows:
        waiting.append(r)
        if len(waiting) == BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*waiting), schema)], schema=schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*waiting), schema)], schema=schema)


def _roots(batches):
    schema = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("digest", pa.string()), ("total", pa.int64())])

    def rows():
        for group in _grouped(batches):
            _, root = _appended(group)
            yield group[0]["tree"], group[0]["block"], root.decode(), -(-group[0]["total"] // BLOCK)
    return _batched(rows(), schema)


def fold(leaf: bytes, witness: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf and its witness, (place, whole run) from the bottom upwards, give."""
    for place, run in witness:
        leaf = _hash(run[:HEX * place] + leaf + run[HEX * (place + 1):])
    return leaf


def siblings_digest(witness: list[tuple[int, bytes]]) -> bytes:
    """Digest of all siblings on the way to the root, each run from left to right."""
    digest = hashlib.sha256()
    for place, run in witness:
        digest.update(run[:HEX * place])
        digest.update(run[HEX * (place + 1):])
    return digest.hexdigest().encode()


def _witnesses(group: list[dict]) -> Iterator[tuple[dict, list[tuple[int, bytes]]]]:
    """(row, whole witness) of the nodes of a block, whose marker, with the block's own witness, comes first."""
    marker, nodes = group[0], group[1:]
    above = [(p["place"], p["run"].encode()) for p in marker["proof"]]
    tree, _ = _appended(nodes)
    joined: dict[int, bytes] = {}
    for row, witness in zip(nodes, tree.witnesses):
        own = []
        for run, place in witness:
            whole = joined.get(id(run))
            if whole is None:
                whole = joined[id(run)] = b"".join(run)
            own.append((place, whole))
        yield row, own + above


def _handed_down(batches):
    """Witnesses of nodes that are roots of the blocks below: they become the markers there."""
    def rows():
        for group in _grouped(batches):
            for row, witness in _witnesses(group):
                yield (row["tree"], row["position"], group[0]["subroot"], group[0]["root"],
                       [{"place": p, "run": run.decode()} for p, run in witness])
    return _batched(rows(), _MARKER_FIELDS)


def _verified(schema: pa.Schema, with_proof: bool):
    def run(batches):
        def rows():
            for group in _grouped(batches):
                root = group[0]["root"]
                for row, witness in _witnesses(group):
                    leaf = row["digest"] if row["changed"] is None else row["changed"]
                    folded = fold(leaf.encode(), witness).decode()
                    proof = [{"place": p, "run": run.decode()} for p, run in witness] if with_proof else None
                    yield (row["id"], row["digest"], group[0]["subroot"], root, siblings_digest(witness).decode(),
                           folded, folded == root, *[proof] * with_proof)
        return _batched(rows(), schema)
    return run


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (tree, ...) with their position by `order` within the tree and the tree's total, as a written table.

    A sort by sampled ranges cuts a large tree into many parts; counts per part and tree say where each begins.
    """
    sorted_ = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("own"))
    sorted_ = keep(sorted_, "sorted")
    parts = sorted_.groupBy("tree", "part").agg(F.min("own").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("tree").alias("t"), F.col("part").alias("p"), "first", F.sum("n").over(whole).alias("total"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    found = sorted_.join(parts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("part") == F.col("p")))
    return keep(found.select(*rows.columns, (F.col("base") + F.col("own") - F.col("first")).alias("position"), "total"), "numbered")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")


def _ascend(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of nodes (tree, position, digest, total), the last with one node of each tree."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("total")).first()[0] or 0) > 1:  # each round divides the totals by BLOCK
        blocks = rounds[-1].select("tree", F.expr(f"position div {BLOCK}").alias("block"), "position", "digest", "total")
        rounds.append(keep(_dealt(blocks).mapInArrow(_roots, "tree string, position long, digest string, total long"), "roots"))
    return rounds


def _with_markers(nodes: DataFrame, markers: DataFrame, payload: list[str]) -> DataFrame:
    """Nodes of a round with, before those of each block, a marker that holds the witness of the block."""
    own = nodes.select("tree", F.expr(f"position div {BLOCK}").alias("block"), "position", "digest", "total", *payload)
    marks = markers.withColumn("position", F.lit(-1).cast("long"))
    return _dealt(own.unionByName(marks, allowMissingColumns=True))


def _descend(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """Markers (tree, block, subroot, root, proof) for the blocks of the first round; top has those of the trees' roots."""
    markers = top
    for nodes in rounds[-2:0:-1]:
        markers = keep(_with_markers(nodes, markers, []).mapInArrow(
            _handed_down, _MARKERS), "markers")
    return markers


def _heads(batches):
    """Witnesses of the trees' roots, under the names of their trees."""
    def rows():
        for group in _grouped(batches):
            for row, witness in _witnesses(group):
                yield row["name"], 0, row["digest"], group[0]["root"], [{"place": p, "run": run.decode()} for p, run in witness]
    return _batched(rows(), _MARKER_FIELDS)


def manifest(leaves: DataFrame, with_proof: bool = False) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified[, proof]) of leaves (id, tree, digest, changed).

    Leaves of a tree are ordered by id, nulls first, then by digest; trees by name, null
    first. ``changed`` is the digest the row has now, null where it is as it was: folded_root comes from it and the original
    witness, verified says whether that is the root. proof lists, from the leaf upwards, the whole run and the
    leaf's place in it. A lone leaf is its tree's root. Repeated rows are leaves each. An empty table gives no rows.
    """
    first = _numbered(leaves.select("id", "tree", "digest", "changed"), ["id", "digest"])
    rounds = _ascend(first)
    subroots = rounds[-1].select(F.col("tree").alias("name"), "digest")
    # The trees' roots are the nodes of one more tree.
    heads = _numbered(subroots.select(F.lit(None).cast("string").alias("tree"), "name", "digest"), ["name"])
    above = _ascend(heads)
    none = F.array().cast(_PROOF)
    crown = above[-1].select("tree", F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), F.col("digest").alias("root"), none.alias("proof"))
    markers = _descend(above, crown)
    top = keep(_with_markers(heads, markers, ["name"]).mapInArrow(_heads, _MARKERS), "heads")
    markers = _descend(rounds, top)
    kind = leaves.schema["id"].dataType.simpleString()
    schema = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    rows = _with_markers(first, markers, ["id", "changed"])
    arrow = pa.schema([("id", to_arrow_type(rows.schema["id"].dataType)), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                       ("verified", pa.bool_()), *[("proof", _OUT_PROOF)] * with_proof])
    return rows.mapInArrow(_verified(arrow, with_proof), schema + f", proof {_PROOF}" * with_proof)


def document_leaves(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """Leaves of documents: the digest of doc_id, source, lang, n_chars and text of each row.

    ``changed_text`` is the text as it is now, null where it did not change. Nulls, empty and very long texts count
    as they are; other columns are not read.
    """
    def digest(text: Column) -> Column:
        return row_digest(docs.doc_id, docs.source, docs.lang, docs.n_chars, text)
    changed = F.lit(None).cast("string") if changed_text is None else F.when(changed_text.isNotNull(), digest(changed_text))
    return keep(docs.select(docs.doc_id.alias("id"), docs.source.alias("tree"), digest(docs.text).alias("digest"), changed.alias("changed")), "leaves")
