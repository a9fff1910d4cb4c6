"""Document quality by Bradley-Terry ranking.

A document's worth is a weighted sum of features of its text. For a pair of labelled documents of
which one is better, the probability that it wins is the logistic function of the difference
of worths; the weights maximise the likelihood of the pairs (with a small quadratic penalty).
All labelled rows take part: they are dealt into groups, pairs are formed within a group, and each
Newton step adds up the derivatives of the groups, computed where these are. The worth that best divides all training rows
becomes the threshold. Only sums reach the driver: 2,414 numbers a group of 20,000 rows and step.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loanbook.llm.shared import keep
from loanbook.llm.words import NOT_SPACE, Words, blocks, windows

#: Labelled rows of a group, preference pairs within it at most, and rows of each kind that it has at least, if there are as many.
GROUP_ROWS, PAIRS, LEAST = 20_000, 100_000, 100
FOLDS = 5
#: Scores at the threshold; documents from here on are predicted good.
CUT_SCORE = 0.3
PENALTY = 1.0

_CLASSES = {
    "symbols": b"#*$%&|<>", "marks": b"!?", "stops": b".,;:", "quotes": b"\"'()[]{}", "digits": b"0123456789",
    "capitals": bytes(range(0x41, 0x5B)), "blanks": b" ", "breaks": b"\n",
}
_IN_CLASS = np.zeros((len(_CLASSES), 256), bool)
for _k, _bytes in enumerate(_CLASSES.values()):
    _IN_CLASS[_k, list(_bytes)] = True
NAMES = [*_CLASSES, "foreign", "word_length", "short_words", "long_words", "same_as_before", "distinct", "repeated3",
         "repeated8", "log_words"]


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of NAMES for each text of a block; an empty text has zeros."""
    n = len(bounds) - 1
    out = np.zeros((n, len(NAMES)))
    size = np.maximum(1, np.diff(bounds))

    def per_text(mask: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[edges])

    for k in range(len(_CLASSES)):
        out[:, k] = per_text(_IN_CLASS[k][data], bounds) / size
    at = len(_CLASSES)
    out[:, at] = per_text(data >= 0x80, bounds) / size
    w = Words(data, bounds, NOT_SPACE)
    words = np.maximum(1, w.counts())
    length = w.end - w.start
    out[:, at + 1] = np.diff(np.concatenate([[0], np.cumsum(length)])[w.first]) / words
    out[:, at + 2] = per_text(length <= 3, w.first) / words
    out[:, at + 3] = per_text(length >= 10, w.first) / words
    same = np.zeros(len(w.hash), bool)
    same[1:] = w.hash[1:] == w.hash[:-1]
    same[w.first[:-1][w.counts() > 0]] = False
    out[:, at + 4] = per_text(same, w.first) / words
    for column, run in ((at + 5, 1), (at + 6, 3), (at + 7, 8)):
        h, first = windows(w.hash, w.first, run)
        for d in range(n):
            own = first[d + 1] - first[d]
            if own:
                distinct = len(np.unique(h[first[d]:first[d + 1]]))
                # Long texts have fewer distinct words by nature: Herdan's ratio of logarithms.
                out[d, column] = np.log1p(distinct) / np.log1p(own) if run == 1 else 1 - distinct / own
    out[:, at + 8] = np.log1p(w.counts())
    return out


def _features(batches):
    for batch in batches:
        for a, b, data, bounds in blocks(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(features(data, bounds).tolist(), pa.list_(pa.float64()))],
                ["doc_id", "features"])


def _moments(rows: np.ndarray, good: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Number of rows, of good ones, means and variances of a group, without its borrowed rows."""
    rows, good = rows[own], good[own]
    if not len(rows):
        return np.zeros(2 + 2 * len(NAMES))
    return np.concatenate([[len(rows), good.sum()], rows.mean(axis=0), rows.var(axis=0)])


class Ranking:
    """Weights of standardised features and of their bends, and the threshold."""

    def __init__(self, rows: np.ndarray | None = None, good: np.ndarray | None = None):
        self.mean, self.spread = np.zeros(len(NAMES)), np.ones(len(NAMES))
        self.weights, self.cut = np.zeros(4 * len(NAMES)), None
        if rows is not None and len(rows) and self.fit(lambda f: [f(rows, good, np.ones(len(good), bool))]):
            worth = self.worths(rows)
            order = np.argsort(worth, kind="stable")
            kept_good = 1 - np.cumsum(good[order]) / good.sum()
            cut_bad = np.cumsum(~good[order]) / (~good).sum()
            gain = (kept_good + cut_bad)[:-1]
            gain[worth[order][1:] == worth[order][:-1]] = -1
            best = np.flatnonzero(gain >= gain.max() - 1e-12)
            k = best[len(best) // 2]
            self.cut = (worth[order[k]] + worth[order[k + 1]]) / 2

    def fit(self, over) -> bool:
        """Learn the weights; False without rows of both kinds. ``over(f)``: f(rows, good, own) of each group of rows, in one order."""
        parts = np.array(over(_moments)).reshape(-1, 2 + 2 * len(NAMES))
        n, means, variances = parts[:, :1], parts[:, 2:2 + len(NAMES)], parts[:, 2 + len(NAMES):]
        if not n.sum():
            return False
        self.mean = (n * means).sum(axis=0) / n.sum()
        self.spread = np.sqrt((n * (variances + (means - self.mean) ** 2)).sum(axis=0) / n.sum()) + 1e-6
        if not 0 < parts[:, 1].sum() < n.sum():
            return False
        size = len(self.weights)
        upper = np.triu_indices(size)
        for _ in range(30):  # Newton steps on the penalised logistic loss
            parts = sum(over(self.slope_and_curve))
            slope = parts[:size] - PENALTY * self.weights
            curve = np.zeros((size, size))
            curve[upper] = parts[size:]
            curve = curve + np.triu(curve, 1).T + PENALTY * np.eye(size)
            step = np.linalg.solve(curve, slope)
            self.weights = self.weights + step
            if np.abs(step).max() < 1e-6:
                break
        return True

    def slope_and_curve(self, rows: np.ndarray, good: np.ndarray, own: np.ndarray) -> np.ndarray:
        """First and second derivatives (upper triangle) of the likelihood of a group's pairs."""
        size = len(self.weights)
        better, worse = np.flatnonzero(good), np.flatnonzero(~good)
        if not len(better) or not len(worse):
            return np.zeros(size + size * (size + 1) // 2)
        random = np.random.RandomState(5)
        n = min(PAIRS, len(better) * len(worse))
        x = self._bent(rows)
        # Every worse document is in equally many pairs, each time with another better one.
        gap = x[random.choice(better, n)] - x[np.resize(random.permutation(worse), n)]
        loses = 1 / (1 + np.exp(np.clip(gap @ self.weights, -50, 50)))
        curve = (gap * (loses * (1 - loses))[:, None]).T @ gap
        return np.concatenate([gap.T @ loses, curve[np.triu_indices(size)]])

    def worths(self, rows: np.ndarray) -> np.ndarray:
        return self._bent(rows) @ self.weights

    def _bent(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.spread, -6, 6)
        return np.hstack([z, np.maximum(0, z - 0.5), np.maximum(0, z - 2), np.maximum(0, -z - 1)])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.cut is None:
            return np.full(len(rows), 0.5)
        above = self.worths(rows) - self.cut + np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(above, -50, 50)))


def _score(ranking: Ranking):
    def run(batches):
        for batch in batches:
            rows = np.array(batch.column(1).to_pylist(), float).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ranking.scores(rows))], ["doc_id", "score"])
    return run


def _dealt(labelled: DataFrame, group_rows: int) -> DataFrame:
    """(part, rows): labelled rows (place, doc_id, features, good) in groups of about ``group_rows``, each one row.

    Groups go by the hash of the id. Of a kind with few rows every group borrows some of others, so that all
    groups have pairs; borrowed rows are not ``own``.
    """
    counts = {r.good: r["count"] for r in labelled.groupBy("good").count().collect()}
    groups = max(1, -(-sum(counts.values()) // group_rows))
    copies = F.lit(1)
    for good, n in counts.items():
        copies = F.when(F.col("good") == good, min(groups, max(1, -(-groups * LEAST // n)))).otherwise(copies)
    dealt = labelled.select("*", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    return dealt.groupBy(F.pmod(F.pmod("place", F.lit(groups)) + F.col("copy"), F.lit(groups)).cast("int").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("place", "doc_id", "features", "good", (F.col("copy") == 0).alias("own")))).alias("rows"))


def _groups(batches):
    """(part, features, good, own) of each group, as arrays."""
    for batch in batches:
        for part, rows in zip(batch.column(0), batch.column(1)):
            own = rows.values
            x = own.field("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            yield part.as_py(), x, *(own.field(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("good", "own"))


def _over(groups: DataFrame):
    """Functions of a group run where the groups are; one array for each group comes back, in the order of the groups."""
    def over(f):
        def run(batches):
            for part, *group in _groups(batches):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([f(*group).tolist()], pa.list_(pa.float64()))], ["part", "out"])
        found = groups.mapInArrow(run, "part int, out array<double>").collect()
        return [np.array(r.out) for r in sorted(found, key=lambda r: r.part)]
    return over


def _worths(ranking: Ranking):
    def run(batches):
        for _, x, good, own in _groups(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ranking.worths(x[own])), pa.array(good[own])], ["worth", "good"])
    return run


def threshold(worths: DataFrame) -> float:
    """The worth that best divides all rows (worth, good): the middle of the gap with most good above and others below.

    Of equally good gaps the middle one. Distinct worths are spread by ranges; one row for each range reaches the driver.
    """
    each = worths.groupBy("worth").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    placed = keep(each.repartitionByRange("worth").select("*", F.spark_partition_id().alias("part")), "worths")
    edges = sorted(placed.groupBy("part").agg(F.min("worth").alias("least"), F.sum("g").alias("g"), F.sum("b").alias("b")).collect(),
                   key=lambda r: r.part)
    good, bad = sum(r.g for r in edges), sum(r.b for r in edges)
    bases, g, b = [], 0, 0
    for k, r in enumerate(edges):
        bases.append((r.part, g, b, edges[k + 1].least if k + 1 < len(edges) else None))
        g, b = g + r.g, b + r.b
    base = worths.sparkSession.createDataFrame(bases, "part int, g0 long, b0 long, beyond double")
    order = Window.partitionBy("part").orderBy("worth")
    wide = "decimal(38,0)"
    gain = (F.lit(bad).cast("decimal(18,0)") * (F.lit(good) - F.col("g0") - F.sum("g").over(order)).cast("decimal(18,0)")
            + F.lit(good).cast("decimal(18,0)") * (F.col("b0") + F.sum("b").over(order)).cast("decimal(18,0)")).cast(wide)
    gaps = placed.join(base, "part").select(
        "worth", F.coalesce(F.lead("worth").over(order), "beyond").alias("next"), gain.alias("gain")).where("next is not null")
    top = gaps.agg(F.max("gain")).first()[0]
    if top is None:  # all worths are equal
        return edges[0].least
    best = gaps.where(F.col("gain") == F.lit(top).cast(wide))
    r = best.orderBy("worth").offset(best.count() // 2).limit(1).first()
    return (r.worth + r.next) / 2


def ranked(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
           group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs.

    held_out: crc32 of the id as text is divisible by FOLDS (a null id is not); such rows are not
    learnt from. The fit and the threshold take all other labelled rows, in groups of about group_rows. score is
    0.3 at the threshold and rises with worth; predicted is 1 from there on. Null and empty texts
    have zeros as features and are scored; rows without label or with a null one are only scored; repeated
    rows are scored each; very long texts are measured whole. Without labels of both kinds every score is 0.5. Other columns are not
    read; an empty table gives no rows.
    """
    rows = keep(docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_features, "doc_id long, features array<double>"),
                "features")

    def held(c: str):
        return F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))

    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) == 1).alias("good")).where(
        F.col("good").isNotNull() & F.col("doc_id").isNotNull() & ~held("doc_id"))
    labelled = keep(rows.join(known, "doc_id").withColumn("place", F.xxhash64("doc_id")), "labelled")
    groups = keep(_dealt(labelled, group_rows), "groups")
    ranking = Ranking()
    if ranking.fit(_over(groups)):
        ranking.cut = threshold(keep(groups.mapInArrow(_worths(ranking), "worth double, good boolean"), "worth"))
    return (rows.mapInArrow(_score(ranking), "doc_id long, score double")
            .select("doc_id", held("doc_id").alias("held_out"), "score", (F.col("score") >= CUT_SCORE).cast("int").alias("predicted")))
