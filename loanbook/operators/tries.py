"""Nearest names by edit distance: sorted blocks of members, each searched as a trie.

Members are dealt by ranges of their text into blocks of about BLOCK. A name first goes to the block
whose prefixes fit it best and gets the nearest member there. Then it goes to every other block that may hold a nearer one:
the prefixes of all blocks, a few for each, are a trie too, and bound the distance to what they begin. So a name meets few
blocks, and in a block only the prefixes that its distance allows. Names meet blocks in groups of a bounded size.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.session import written

#: Members of a block, names that meet it in one group, and prefixes that stand for it at most.
BLOCK, CHUNK, PREFIXES = 10_000, 4_000, 64
#: Prefixes of equal bounds that the search for a first guess follows.
WIDTH = 8
#: Cells of distance tables that a step of a search makes at most, if it follows more than one prefix.
CELLS = 4_000_000
_LAST = np.iinfo(np.int64).max


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text begins (one more at the end)."""
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), begins


def _ranks(idents: pa.ChunkedArray) -> np.ndarray:
    """Ids as numbers; rows without id come last."""
    return idents.fill_null(_LAST).to_numpy().astype(np.int64)


def _spread(low: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ranges, one after the other: the range each belongs to, and the places in it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    begins = np.cumsum(counts) - counts
    return owner, low[owner] + np.arange(len(owner)) - begins[owner]


class Trie:
    """Texts by prefix. After each text further characters may follow, between ``low`` and ``high`` of them.

    A node is a prefix; the sorted rows that begin with it adjoin. ``levels`` holds for the nodes of each length: last
    character, children, rows that end here, least id below, and the range of lengths of what follows below.
    """

    def __init__(self, texts: list[str], idents: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None):
        self.order = np.array(sorted(range(len(texts)), key=texts.__getitem__), dtype=np.int64)
        codes, begins = _codes([texts[i] for i in self.order])
        size = np.diff(begins)
        self.idents = idents[self.order]
        zero = np.zeros(len(texts), np.int64)
        self.low, self.high = (zero if x is None else x[self.order] for x in (low, high))
        self.levels = []
        rows, node = np.arange(len(texts)), zero  # rows of this length at least, and their nodes
        char = parent = zero[:1]
        depth = 0
        while len(rows):
            first = np.flatnonzero(np.diff(node, prepend=-1))
            ends = size[rows] == depth
            level = {
                "char": char, "ends": np.add.reduceat(ends.astype(np.int64), first), "row": rows[first],
                "least": np.minimum.reduceat(self.idents[rows], first),
                "short": np.minimum.reduceat((size + self.low)[rows], first) - depth,
                "long": np.maximum.reduceat((size + self.high)[rows], first) - depth}
            self.levels.append(level)
            nodes = len(first)
            rows, above = rows[~ends], node[~ends]
            if len(rows):
                now = codes[begins[rows] + depth]
                begin = np.ones(len(rows), bool)
                begin[1:] = (above[1:] != above[:-1]) | (now[1:] != now[:-1])
                node, char, parent = np.cumsum(begin) - 1, now[begin], above[begin]
                level["kid"] = np.searchsorted(parent, np.arange(nodes))
                level["kids"] = np.bincount(parent, minlength=nodes)
            else:
                level["kid"] = level["kids"] = np.zeros(nodes, np.int64)
            depth += 1

    def search(self, names: list[str], most: np.ndarray, ident: np.ndarray, width: int | None = None, every: bool = False):
        """(name, row, bound) of the rows whose (bound, id) is less than (``most``, ``ident``) of the name.

        The bound is the least distance to the text and what may follow, so the distance itself if nothing does. Of each
        name the first row by bound and id is given, or ``every`` such row. With a ``width`` only that
        many prefixes of least bound are followed, so the first row may be missed, but never all of them.
        """
        most, ident = most.copy(), ident.copy()
        size = np.array([len(n) for n in names], dtype=np.int64)
        out = [tuple(np.zeros(0, np.int64) for _ in range(3))]
        if self.levels:
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                codes = _codes([names[i] for i in at])[0].reshape(len(at), n)
                m, i = most[at], ident[at]
                out.extend((at[q], row, f) for q, row, f in self._of_length(codes, m, i, width, every))
        q, row, f = (np.concatenate(x) for x in zip(*out))
        if not every:
            by = np.lexsort((row, self.idents[row], f, q))
            by = by[np.flatnonzero(np.diff(q[by], prepend=-1))]
            q, row, f = q[by], row[by], f[by]
        return q, self.order[row], f

    def _of_length(self, codes, most, ident, width, every):
        n = codes.shape[1]
        kind = np.int16 if n + len(self.levels) < 30_000 else np.int32
        step = np.arange(n + 1, dtype=kind)
        left = n - step  # characters of the name that a column leaves over

        def bound(table, short, long):
            short, long = short.astype(np.int32)[:, None], long.astype(np.int32)[:, None]
            return (table + np.maximum(np.maximum(left - long, short - left), 0)).min(axis=1).astype(np.int64)

        def better(q, f, least):
            return (f < most[q]) | ((f == most[q]) & (least < ident[q]))

        cells = max(CELLS // (n + 1), 1)
        every_name = np.arange(len(codes))
        # What is left to follow, the deepest last: level, names, nodes and their last rows of the distance table.
        todo = [(0, part, np.zeros(len(part), np.int64), np.broadcast_to(step, (len(part), n + 1)))
                for part in np.array_split(every_name, math.ceil(len(codes) / cells))]
        while todo:
            depth, q, node, table = todo.pop()
            level = self.levels[depth]
            if not every:  # what was found meanwhile
                ok = better(q, bound(table, level["short"][node], level["long"][node]), level["least"][node])
                q, node, table = q[ok], node[ok], table[ok]
            counts = level["kids"][node]
            if counts.sum() > cells and len(q) > 1 and not (width and q[0] == q[-1]):
                cut = len(q) // 2
                if width:  # the prefixes of a name stay together
                    cut = int(np.searchsorted(q, q[cut])) or int(np.searchsorted(q, q[cut], "right"))
                todo += [(depth, q[x], node[x], table[x]) for x in (slice(cut, None), slice(None, cut))]
                continue
            owner, row = _spread(level["row"][node], level["ends"][node])
            if len(row):
                f = bound(table[owner], self.low[row], self.high[row])
                ok = better(q[owner], f, self.idents[row])
                found, row, f = q[owner][ok], row[ok], f[ok]
                if not every:
                    for k in np.lexsort((-self.idents[row], -f)):  # the best comes last
                        most[found[k]], ident[found[k]] = min((most[found[k]], ident[found[k]]), (f[k], self.idents[row[k]]))
                yield found, row, f
            owner, kid = _spread(level["kid"][node], counts)
            if not len(kid):
                continue
            below = self.levels[depth + 1]
            q, old = q[owner], table[owner]
            table = np.empty_like(old)
            table[:, 0] = old[:, 0] + 1
            np.minimum(old[:, :-1] + (codes[q] != below["char"][kid][:, None]), old[:, 1:] + 1, out=table[:, 1:])
            table -= step
            np.minimum.accumulate(table, axis=1, out=table)
            table += step
            f = bound(table, below["short"][kid], below["long"][kid])
            ok = better(q, f, below["least"][kid])
            if width:
                by = np.lexsort((below["least"][kid], f, q))
                new = np.diff(q[by], prepend=-1) != 0
                begin = np.flatnonzero(new)[np.cumsum(new) - 1]
                ok[by] &= (np.arange(len(by)) - begin < width) & (f[by] == f[by][begin])
            if ok.any():
                todo.append((depth + 1, q[ok], kid[ok], table[ok]))


def prefixes(texts: list[str]) -> list[str]:
    """The longest prefixes of one length of which there are PREFIXES at most."""
    longest, kept = max(map(len, texts)), {""}
    for size in range(1, longest + 1):
        now = {t[:size] for t in texts}
        if len(now) > PREFIXES:
            break
        kept = now
    return sorted(kept)


def _top(block: pa.Table) -> pa.Table:
    """The prefixes of a block with the least id and the lengths of what follows."""
    texts, idents = block["member"].to_pylist(), _ranks(block["ident"])
    size = max(map(len, kept := prefixes(texts)))
    rows = {p: [_LAST, np.iinfo(np.int64).max, 0] for p in kept}
    for t, i in zip(texts, idents.tolist()):
        r = rows[t[:size]]
        rest = max(len(t) - size, 0)
        r[0], r[1], r[2] = min(r[0], i), min(r[1], rest), max(r[2], rest)
    least, low, high = zip(*rows.values())
    return pa.table({"block": pa.array([block["block"][0].as_py()] * len(rows), pa.int32()), "prefix": pa.array(list(rows), pa.string()),
                     "least": pa.array(least, pa.int64()), "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())})


def _router(tops: list[tuple]):
    """Function for mapInArrow: names to the block that fits best, or, if they have a guess, to all others that may be better."""
    block, prefix, least, low, high = zip(*tops)

    def route(batches):
        trie = Trie(list(prefix), np.array(least, np.int64), np.array(low, np.int64), np.array(high, np.int64))
        blocks = np.array(block, np.int64)
        for batch in batches:
            t = pa.Table.from_batches([batch])
            names, home = t["name"].to_pylist(), None
            far = np.full(len(names), _LAST)
            if "block" in t.column_names:
                home = t["block"].to_numpy().astype(np.int64)
                q, row, _ = trie.search(names, t["distance"].to_numpy().astype(np.int64), _ranks(t["ident"]), every=True)
                pairs = np.unique(np.stack([q, blocks[row]], 1)[blocks[row] != home[q]], axis=0)
                q, to = pairs[:, 0], pairs[:, 1]
            else:
                q, row, _ = trie.search(names, far, far, WIDTH)
                to = blocks[row]
            chosen = t.take(pa.array(q)).select([c for c in t.column_names if c != "block"])
            yield from chosen.append_column("block", pa.array(to, pa.int32())).to_batches()

    return route


def _meet(names: pa.Table, members: pa.Table) -> pa.Table:
    """The nearest member of a block for each name, if it is better than the guess that the name may have."""
    texts, idents = names["name"].to_pylist(), members["ident"]
    trie = Trie(members["member"].to_pylist(), _ranks(idents))
    far = np.full(len(texts), _LAST)
    if "distance" in names.column_names:
        q, row, d = trie.search(texts, names["distance"].to_numpy().astype(np.int64), _ranks(names["ident"]))
    else:
        q, row, d = trie.search(texts, far, far, WIDTH)
        most, ident = d, trie.idents[np.argsort(trie.order)][row]
        better, its, less = trie.search([texts[k] for k in q], most, ident)
        row[better], d[better] = its, less
    return pa.table({"name": names["name"].take(pa.array(q)), "block": names["block"].take(pa.array(q)),
                     "distance": pa.array(d, pa.int32()), "ident": idents.take(pa.array(row))})


class Blocks:
    """Members (ident, member) by ranges of their text; what stands for each block reaches the driver."""

    def __init__(self, base: DataFrame, work: str = "blocks"):
        self.parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.work, n = work, max(1, math.ceil(base.count() / BLOCK))
        self.members = written(base.select("ident", "member").repartitionByRange(n, "member").withColumn("block", F.spark_partition_id()), work)
        self.ident = dict(base.dtypes)["ident"]
        self.tops = [tuple(r) for r in self.members.repartition(self.parts, "block").groupBy("block").applyInArrow(
            _top, "block int, prefix string, least long, low long, high long").collect()]

    def _visit(self, routes: DataFrame) -> DataFrame:
        """Names that were sent to blocks, with the best that they find there."""
        routes = written(routes, self.work)
        chunks = routes.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
        left = routes.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("name"), F.col("chunks")).cast("int")).drop("chunks")
        right = self.members.join(chunks, "block").select(
            "block", "ident", "member", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        # Groups are dealt by number: Spark would merge them by their few bytes.
        left, right = (x.repartition(self.parts, "block", "chunk").groupBy("block", "chunk") for x in (left, right))
        return left.cogroup(right).applyInArrow(_meet, f"name string, block int, distance int, ident {self.ident}")

    def nearest(self, names: DataFrame) -> DataFrame:
        """(name, ident, distance) of the member with the least distance to each distinct ``name``; ties go to the least ident."""
        if not self.tops:
            return names.select("name", F.lit(None).cast(self.ident).alias("ident"), F.lit(None).cast("int").alias("distance")).where(F.lit(False))
        route = _router(self.tops)
        there = names.select("name").repartition(self.parts, "name").mapInArrow(route, "name string, block int")
        guesses = written(self._visit(there), self.work)
        others = guesses.repartition(self.parts, "name").mapInArrow(route, f"name string, distance int, ident {self.ident}, block int")
        best = F.struct("distance", F.col("ident").isNull().alias("none"), "ident")  # those without id come last
        return guesses.unionByName(self._visit(others)).groupBy("name").agg(F.min(best).alias("b")).select(
            "name", F.col("b.ident").alias("ident"), F.col("b.distance").alias("distance"))
