"""Near-duplicate documents by an LSH forest of minhash signatures.

1. Each text gives the set of its distinct shingles and a signature of minima. Documents with
   equal sets are one class at once; only one representative of each goes on.
2. The forest is `ORDERS` sorted orders of the signatures. Order t compares the slots of the
   signature in an order of its own, beginning with three slots no other order begins with.
   A global range sort lays each order out over the cluster.
3. Candidates are neighbours: every representative meets the next `NEAR` rows that share at
   least three leading slots. Neighbours have the longest common prefixes, so the depth at
   which rows meet adapts by itself: shallow where a region is sparse, deep where it is dense.
4. In a dense region a row and the text it was copied from can be far apart, so each region
   also has a leader, the row that lies in the most populous regions (a text is closer to its
   copies than these are to each other). All rows of the region meet its leader, at two depths.
5. Candidates are confirmed on the full sets, hub by hub: first the best one of each
   document; then, of the rest, those that still join different components.
6. What neighbours leave out in a dense region is found by an exact join: rows of a region that are
   not in the component of its leader meet all other rows of the region by the rare part of
   their differences from the leader (see `_beyond`).

A pair of similarity 0.75 shares no order's first three slots with probability
(1 - 0.75**3) ** 21 = 0.00001.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanbook.llm.components import components
from loanbook.llm.shared import keep
from loanbook.llm.words import NOT_SPACE, Words, blocks, windows

SLOTS, ORDERS, HEAD, KEY_SLOTS, NEAR = 64, 21, 3, 8, 3
DEEP = 6
#: Members that share one copy of their hub's text.
HUB_MEMBERS = 64

_RNG = np.random.RandomState(75)
_XOR = _RNG.randint(0, 2**32, SLOTS, dtype=np.uint64).astype(np.uint32)
_TIMES = _RNG.randint(0, 2**31, SLOTS, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_ORDER = [
    [*range(HEAD * t, HEAD * t + HEAD),
     *np.random.RandomState(t).permutation([k for k in range(SLOTS) if k // HEAD != t])[:KEY_SLOTS - HEAD]]
    for t in range(ORDERS)
]


def _sketch(size: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b, data, bounds in blocks(texts):
                w = Words(data, bounds, NOT_SPACE)
                s, first = windows(w.hash, w.first, size)
                counts = np.diff(first)
                has = np.flatnonzero(counts)
                low = (s >> np.uint64(32)).astype(np.uint32)
                signature = np.zeros((b - a, SLOTS), np.uint32)
                for k in range(SLOTS if len(has) else 0):
                    v = (low ^ _XOR[k]) * _TIMES[k]
                    v ^= v >> np.uint32(15)
                    signature[has, k] = np.minimum.reduceat(v, first[:-1][has])
                digests, sizes = [], []
                for d in range(b - a):
                    u = np.unique(s[first[d]:first[d + 1]])
                    sizes.append(len(u))
                    digests.append(hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array([x.tobytes() for x in signature.astype(">u4")], pa.binary())],
                    ["doc_id", "n_shingles", "digest", "signature"])
    return run


def _orders(keys: bool):
    """The rows of a representative: its sort keys, or its regions at both depths."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column(0).to_numpy()
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(n, SLOTS)
            for t in range(ORDERS):
                rows = np.zeros((n, 1 + 4 * KEY_SLOTS), np.uint8)
                rows[:, 0] = t
                rows[:, 1:] = np.ascontiguousarray(sig[:, _ORDER[t]]).view(np.uint8).reshape(n, -1)
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x.tobytes() for x in rows], pa.binary()), pa.array(ids)], ["key", "doc"])
                    continue
                for depth in (HEAD, DEEP):
                    part = np.ascontiguousarray(rows[:, :1 + 4 * depth])
                    names = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "big", signed=True)
                             for x in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.int64()), pa.array(np.full(n, depth, np.int32)), pa.array(ids)],
                        ["region", "depth", "doc"])
    return run


def _neighbours(head: int):
    """Pairs of near rows whose keys share `head` bytes (edge false); first and last rows as they are (edge true).

    Rows are (key, doc).
    """
    schema = pa.schema([("edge", pa.bool_()), ("a", pa.int64()), ("b", pa.int64()), ("key", pa.binary())])

    def batch_of(a, b, edges):
        keys, ids = zip(*edges) if edges else ((), ())
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array([False] * n + [True] * len(ids)), pa.array([*a, *ids], pa.int64()), pa.array([*b, *[None] * len(ids)], pa.int64()),
             pa.array([None] * n + list(keys), pa.binary())], schema=schema)

    def run(batches):
        last, seen = [], 0
        for batch in batches:
            rows = last + list(zip(*(batch.column(k).to_pylist() for k in range(2))))
            old = len(last)
            a, b = [], []
            for i in range(old, len(rows)):
                key, doc = rows[i]
                mine = key[:head]
                for j in range(i - 1, max(-1, i - 1 - NEAR), -1):
                    other, friend = rows[j]
                    if other[:head] != mine:
                        break
                    if friend != doc:
                        a.append(min(doc, friend))
                        b.append(max(doc, friend))
            yield batch_of(a, b, rows[old:old + max(0, NEAR - seen)])
            seen += len(rows) - old
            last = rows[-NEAR:]
        if last:
            yield batch_of([], [], last)
    return run


def _near_pairs(keyed: DataFrame, head: int) -> DataFrame:
    """Pairs a < b of rows (key, doc) that are near in the order of their keys and share its head."""
    kind = "edge boolean, a long, b long, key binary"
    sort = keyed.repartitionByRange("key", "doc").sortWithinPartitions("key", "doc")
    near = keep(sort.mapInArrow(_neighbours(head), kind), "near")
    # A few rows of each partition: pairs that the cut between two partitions separates.
    cut = near.where("edge").select("key", F.col("a").alias("doc")).distinct().coalesce(1)
    across = cut.sortWithinPartitions("key", "doc").mapInArrow(_neighbours(head), kind)
    return near.where("not edge").select("a", "b").unionAll(across.where("not edge").select("a", "b"))


def candidates(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, met) of representatives (doc, signature), and (hub, doc): the leaders of a row's dense regions."""
    pairs = _near_pairs(reps.mapInArrow(_orders(True), "key binary, doc long"), 1 + 4 * HEAD)
    regions = reps.mapInArrow(_orders(False), "region long, depth int, doc long")
    # A region of up to NEAR + 1 rows has all its pairs already.
    dense = keep(regions.groupBy("region").agg(F.count("*").alias("n"), F.first("depth").alias("depth"))
                 .where(F.col("n") > NEAR + 1), "dense")
    rows = keep(regions.select("region", "doc").join(dense, "region"), "rows")
    fame = keep(rows.where(F.col("depth") == HEAD).groupBy("doc").agg(F.sum("n").alias("fame")), "fame")
    ranked = rows.select("region", "doc").join(fame, "doc")
    leader = keep(ranked.groupBy("region").agg(F.max(F.struct("fame", (-F.col("doc")).alias("m"))).alias("leader")), "leader")
    led = keep(rows.select("region", "doc").join(leader, "region").where("doc != -leader.m"), "led")
    pairs = pairs.unionAll(led.select(
        F.least("doc", -F.col("leader.m")).alias("a"), F.greatest("doc", -F.col("leader.m")).alias("b")))
    every = led.join(dense.where(F.col("depth") == HEAD).select("region"), "region", "left_semi")
    every = every.select((-F.col("leader.m")).alias("hub"), "doc").distinct()
    return pairs.groupBy("a", "b").agg(F.count("*").alias("met")), every


def _sets(texts, size: int):
    for _, _, data, bounds in blocks(texts):
        w = Words(data, bounds, NOT_SPACE)
        s, first = windows(w.hash, w.first, size)
        for d in range(len(bounds) - 1):
            yield np.unique(s[first[d]:first[d + 1]])


def _beside(size: int):
    """(hub, its set, member, its set) of sorted rows (hub, member, doc, text): the hub's text comes first."""
    def run(batches):
        hub, whole = None, None
        for batch in batches:
            found = []
            columns = [batch.column(k).to_pylist() for k in range(3)]
            for h, member, doc, u in zip(*columns, _sets(batch.column(3), size)):
                if not member:
                    hub, whole = h, u
                elif h == hub:
                    found.append((h, whole, doc, u))
            yield found
    return run


def _confirm(size: int, percent: int):
    def run(batches):
        for found in _beside(size)(batches):
            a, b = [], []
            for hub, whole, doc, u in found:
                common = len(np.intersect1d(whole, u, assume_unique=True))
                if 100 * common >= percent * (len(whole) + len(u) - common):
                    a.append(hub)
                    b.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _hub_by_hub(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Sorted rows (hub, member, doc, text) for pairs (hub, doc) of a written table and texts (doc, text).

    A hub's text goes once to each group of its members, which then pass by it one after
    another: memory holds one hub's set and one batch of rows.
    """
    degree = keep(pairs.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(HUB_MEMBERS)).cast("long").alias("groups")), "degree")
    work = keep(pairs.join(degree, "hub").select(
        "hub", F.pmod(F.xxhash64("doc"), F.col("groups")).alias("part"), F.lit(True).alias("member"), "doc"), "work")
    hubs = work.select("hub", "part").distinct().select("hub", "part", F.lit(False).alias("member"), F.col("hub").alias("doc"))
    need = keep(work.unionAll(hubs), "need")
    return (need.join(texts, "doc").repartition("hub", "part").sortWithinPartitions("hub", "part", "member")
            .select("hub", "member", "doc", "text"))


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of a written table whose full sets are similar enough; the end with more pairs is the hub."""
    both = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    degree = keep(both.groupBy("node").agg(F.count("*").alias("n")), "degree")
    sides = (pairs.join(degree.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
             .join(degree.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b"))
    swap = F.col("na") < F.col("nb")
    oriented = keep(sides.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("hub"),
                                 F.when(swap, F.col("a")).otherwise(F.col("b")).alias("doc")), "oriented")
    return _hub_by_hub(oriented, texts).mapInArrow(_confirm(size, percent), "a long, b long")


def _apart(size: int):
    """The difference of each member's set from its hub's, and the sizes of the two sets."""
    def run(batches):
        for found in _beside(size)(batches):
            rows = [(h, doc, len(whole), len(u), np.setxor1d(whole, u, assume_unique=True).view(np.int64)) for h, whole, doc, u in found]
            first = np.cumsum([0, *(len(r[4]) for r in rows)])
            tokens = np.concatenate([np.zeros(0, np.int64), *(r[4] for r in rows)])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r[k] for r in rows], pa.int64()) for k in range(4)),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(tokens))], ["hub", "doc", "nh", "n", "tokens"])
    return run


def _beyond(every: DataFrame, whole: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components and a common hub: all that are similar enough, and few others.

    every has (hub, doc), whole the components once all of these pairs are decided. Of two rows x, y in
    different components one, x, is not in the hub's, so it is not similar to the hub. With d
    the size of the difference from the hub, n that of the set, and s = d - part * n, two rows are similar
    if their differences share at least (s(x) + s(y)) / 2 tokens. This is over 0, since s(x) > part * nh and
    s(y) >= -part * nh. Tokens are in one order for the hub, rare ones first; if the first common one
    is the i-th of d, no more than 1 + d - i are shared. So y needs only tokens with
    1 + d - i >= (s(y) + part * nh) / 2, about the rarer half, which are seldom common. x needs those with
    1 + d - i >= s(x) - part * n(y), since y's difference holds what is shared. Everything is in whole
    numbers, times 100 + percent.
    """
    up, down = 100 + percent, 100 - percent

    def of(end: str) -> DataFrame:
        return whole.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))

    sides = (every.join(of("doc"), "doc", "left").join(of("hub"), "hub", "left").select(
        "hub", "doc", F.coalesce("cdoc", "doc").alias("c"),
        (F.coalesce("cdoc", "doc") != F.coalesce("chub", "hub")).alias("stray")))
    sides = keep(sides, "sides")
    # Something is left to find where a stray has company of another component.
    open_ = sides.groupBy("hub").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x != y").select("hub")
    sides = keep(sides.join(open_, "hub", "left_semi"), "open")
    apart = keep(_hub_by_hub(sides.select("hub", "doc"), texts).mapInArrow(
        _apart(size), "hub long, doc long, nh long, n long, tokens array<long>"), "apart")
    one = apart.select("hub", "doc", F.explode("tokens").alias("token"))
    usual = keep(one.groupBy("hub", "token").agg(F.count("*").alias("f")).where("f > 1"), "usual")
    shared = one.join(usual, ["hub", "token"]).groupBy("hub", "doc").agg(
        F.sort_array(F.collect_list(F.struct("f", "token"))).alias("shared"))
    d = F.size("tokens").cast("long")
    # Tokens of one row only come first and meet nothing.
    placed = keep(apart.join(shared, ["hub", "doc"]).join(sides, ["hub", "doc"]).select(
        "hub", "doc", "c", "stray", "nh", "n", (up * d - down * F.col("n")).alias("s"), F.size("shared").cast("long").alias("k"),
        F.posexplode("shared")).select(
        "hub", "doc", "c", "stray", "nh", "n", "s", F.col("col.token").alias("token"), (F.col("k") - F.col("pos")).alias("room"))
        .where(f"2 * {up} * room >= s + {down} * nh or (stray and {up} * room >= s - {down} * (100 * n div {percent}))"), "placed")
    x = placed.where("stray").select("hub", "token", *[F.col(k).alias(f"x_{k}") for k in ("doc", "c", "n", "s", "room")])
    y = placed.where(f"2 * {up} * room >= s + {down} * nh").select(
        "hub", "token", "stray", *[F.col(k).alias(f"y_{k}") for k in ("doc", "c", "n", "s", "room")])
    meet = x.join(y, ["hub", "token"]).where(
        f"x_c != y_c and x_s + y_s <= 2 * {up} * least(x_room, y_room) and {percent} * x_n <= 100 * y_n and {percent} * y_n <= 100 * x_n")
    return meet.select(F.least("x_doc", "y_doc").alias("a"), F.greatest("x_doc", "y_doc").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs.

    Words are runs without white space, A-Z in lower case; a document is the set of its
    distinct shingles of `size` words, or of its whole sequence if it has fewer. Documents are
    linked when 100 * intersection >= percent * union. component_id is the smallest id
    reachable; kept marks the row with that id. Null and empty texts have no shingles, link with
    nothing and are kept. Repeated rows of an id and text give equal rows; a row with null id
    links nothing, has a null component_id and is kept. Very long texts are sets of all their shingles. An id is taken as a
    key: where one has several texts, links of the others than the first may be missed. Other columns are not read. An empty table gives
    no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = keep(source.mapInArrow(_sketch(size), "doc_id long, n_shingles long, digest binary, signature binary"),
                    "sketches")
    reps = keep(sketches.where("n_shingles > 0 and doc_id is not null").groupBy("digest")
                .agg(F.min("doc_id").alias("doc"), F.first("signature").alias("signature")), "reps")
    met, every = candidates(reps.select("doc", "signature"))
    met, every = keep(met, "met"), keep(every, "every")
    nodes = keep(met.select(F.col("a").alias("doc")).unionAll(met.select(F.col("b").alias("doc"))).distinct(), "nodes")
    texts = keep(source.join(nodes, source.doc_id == nodes.doc, "left_semi")
                 .select(F.col("doc_id").alias("doc"), "text"), "texts")

    ends = met.select(F.col("a").alias("doc"), F.col("b").alias("other"), "met").unionAll(
        met.select(F.col("b").alias("doc"), F.col("a").alias("other"), "met"))
    best = ends.groupBy("doc").agg(F.max(F.struct("met", (-F.col("other")).alias("m"))).alias("x"))
    first = keep(best.select("doc", (-F.col("x.m")).alias("other"))
                 .select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct(), "first")
    links = keep(confirmed(first, texts, size, percent), "links")
    whole = keep(components(links), "components")

    def of(end: str) -> DataFrame:
        return whole.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))

    rest = keep(met.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
                .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
                .join(first, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = keep(confirmed(rest, texts, size, percent), "links")
        if not more.isEmpty():
            links = links.unionAll(more)
            whole = keep(components(links), "components")
    beyond = keep(_beyond(every, whole, texts, size, percent), "beyond")
    if not beyond.isEmpty():
        more = keep(confirmed(beyond, texts, size, percent), "links")
        if not more.isEmpty():
            whole = keep(components(links.unionAll(more)), "components")
    rows = sketches.select("doc_id", "n_shingles", "digest").join(
        reps.select("digest", F.col("doc").alias("node")), "digest", "left")
    found = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "node", "doc_id"))
    return (rows.join(whole, "node", "left")
            .select("doc_id", "n_shingles", found.cast("long").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
