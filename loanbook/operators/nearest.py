"""Nearest names by edit distance: an exact index of bounds.

Two names differ by at least as many edits as the characters that one has and the other lacks, in the larger of both
directions, and by at least the difference of their distances to any third name. Names of the index form
a tree: by length, then by the counts of the characters that vary most among them, a few at a time.
A name goes down this tree twice. First it follows only the branches of least bound, and compares
itself with some members where it arrives: the best of these is close to its nearest. Then it
follows every branch whose bound does not exceed that distance, which leaves few; so no name meets all others.
Each step is an equi join of (name, node) with the children of the node.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook.session import written

#: Characters whose counts make up the tree, and how many of them each level adds.
CHARACTERS, LEVELS = 14, (4, 4, 6)
#: Branches that the first descent follows at a level, and members it compares of each leaf at most.
BEAM, SAMPLE = 4, 256
#: Third names that distances to are kept of.
PIVOTS = 3
#: Parts of the children of a node: one node may be met by very many names.
SALT = 16
#: Children of a level that may be broadcast in all their parts; Spark takes these for as few as the children.
FEW_CHILDREN = 20_000


def _count(name: str, char: str) -> Column:
    return F.length(name) - F.length(F.replace(F.col(name), F.lit(char), F.lit("")))


def telling_characters(base: DataFrame, name: str) -> list[str]:
    """The characters whose counts vary most over the names; at most CHARACTERS reach the driver."""
    each = base.select(name, F.explode(F.array_distinct(F.split(name, ""))).alias("char")).where("char <> ''")
    times = (F.length(name) - F.length(F.replace(F.col(name), F.col("char"), F.lit("")))).cast("double")
    sums = each.groupBy("char").agg(F.sum(times).alias("s"), F.sum(times * times).alias("ss"))
    n = base.agg(F.count(F.lit(1)).alias("n"))
    spread = F.col("ss") * n.scalar() - F.col("s") * F.col("s")
    return [r.char for r in sums.select("char", spread.alias("v")).orderBy(F.desc("v"), "char").limit(CHARACTERS).collect()]


class Index:
    """Tables of the tree over ``base`` (ident, member): the children of each node, and the members of each leaf."""

    def __init__(self, base: DataFrame, work: str = "names"):
        self.chars = telling_characters(base, "member")
        self.levels, at = [], 0
        for size in LEVELS:
            self.levels.append(range(at, min(at + size, len(self.chars))))
            at += size
        self.pivots = [r.member for r in base.orderBy(F.xxhash64("member"), "member").limit(PIVOTS).select("member").collect()]
        cells = self._counted(base, "member")
        node = F.col("len").cast("string")
        cells = cells.withColumn("node0", node)
        for k, own in enumerate(self.levels):
            node = F.concat_ws(",", F.col(f"node{k}"), *[F.col(f"c{c}").cast("string") for c in own])
            cells = cells.withColumn(f"node{k + 1}", node)
        columns = ["ident", "member", *[f"p{k}" for k in range(len(self.pivots))], "len", *[f"c{c}" for c in range(len(self.chars))]]
        self.cells = written(cells.select(*columns, *[f"node{k}" for k in range(len(self.levels) + 1)]), work)
        self.lengths = [r.len for r in self.cells.select("len").distinct().collect()]  # one for each length of a name
        self.leaf = f"node{len(self.levels)}"
        self.children = [
            written(self.cells.groupBy(f"node{k}", f"node{k + 1}").agg(
                F.min("ident").alias("least"), *[F.first(f"c{c}").alias(f"k{c}") for c in own],
                F.first(self._upto(k)).alias("kids_sum")), work)
            for k, own in enumerate(self.levels)]
        self.many = [c.count() > FEW_CHILDREN for c in self.children]

    def _upto(self, level: int) -> Column:
        """Number of the characters of this level and those above it."""
        return sum([F.col(f"c{c}") for c in range(self.levels[level].stop)], F.lit(0))

    def _counted(self, df: DataFrame, name: str) -> DataFrame:
        return df.select("*", F.length(name).alias("len"), *[_count(name, c).alias(f"c{k}") for k, c in enumerate(self.chars)],
                         *[F.levenshtein(F.col(name), F.lit(p)).alias(f"p{k}") for k, p in enumerate(self.pivots)])

    def _at_lengths(self, names: DataFrame) -> DataFrame:
        """Each name at every length of the index; more is what it has too many of, bound what that says of the distance."""
        out = names.withColumn("at", F.explode(F.array(*[F.lit(x) for x in sorted(self.lengths)]).cast("array<int>")))
        return out.select("*", F.col("at").cast("string").alias("node"), F.lit(0).alias("more"),
                          (F.col("len") - F.col("at")).alias("gap")).withColumn("bound", F.abs("gap")).drop("at")

    def _down(self, front: DataFrame, level: int) -> DataFrame:
        """The children of the nodes where names are."""
        own = self.levels[level]
        kids = self.children[level].select(
            F.col(f"node{level}").alias("node"), F.col(f"node{level + 1}").alias("child"), "least", "kids_sum", *[f"k{c}" for c in own],
            F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
        kids = kids.hint("merge") if self.many[level] else kids
        more = sum([F.greatest(F.col(f"c{c}") - F.col(f"k{c}"), F.lit(0)) for c in own], F.col("more"))
        met = front.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALT)).cast("int")).withColumn("own_sum", self._upto(level))
        met = met.drop(*[c for c in ("least", "over") if c in front.columns]).join(kids, ["node", "salt"])
        # What it has too few of is `more` less the surplus so far, and in the end the surplus is the gap of the lengths.
        over = F.col("own_sum") - F.col("kids_sum")
        bound = more + F.greatest(F.lit(0), -over, F.col("gap") - over, -F.col("gap"))
        return met.select(*[c for c in front.columns if c not in ("node", "more", "bound", "least", "over")], F.col("child").alias("node"),
                          "least", more.alias("more"), bound.alias("bound"), F.abs(over).alias("over"))

    def first_guesses(self, names: DataFrame) -> DataFrame:
        """(name, ident, distance) of a near member of each name (name, len, c.., p..), by the branches of least bound."""
        front = self._at_lengths(names)
        # Of equal bounds the branch whose counts differ least.
        best = Window.partitionBy("name").orderBy("bound", F.col("more") * 2 + F.col("over"), "least", "node")
        front = front.withColumn("rank", F.row_number().over(Window.partitionBy("name").orderBy("bound", "node"))).where(F.col("rank") <= BEAM)
        for level in range(len(self.levels)):
            front = self._down(front.drop("rank"), level).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= BEAM)
        members = self.cells.groupBy(self.leaf, F.pmod(F.xxhash64("member"), F.lit(SAMPLE)).alias("part")).agg(
            F.min(F.struct("ident", "member")).alias("m"))
        met = front.select("name", "node").join(members, F.col("node") == F.col(self.leaf))
        return met.groupBy("name").agg(F.min(F.struct(F.levenshtein("name", "m.member").alias("distance"), F.col("m.ident").alias("ident"))).alias("g")).select(
            "name", F.col("g.distance").alias("distance"), F.col("g.ident").alias("ident"))

    def candidates(self, names: DataFrame) -> DataFrame:
        """Pairs (name, member, ident, distance, guess) that the bounds leave over, for names that have a guess (distance, guess)."""
        def open_(bound: Column, least: Column) -> Column:
            return bound + F.when(least < F.col("guess"), 0).otherwise(1) <= F.col("distance")

        front = self._at_lengths(names).where(F.col("bound") <= F.col("distance"))
        for level in range(len(self.levels)):
            front = self._down(front, level).where(open_(F.col("bound"), F.col("least")))
        third = [F.abs(F.col(f"p{k}") - F.col(f"m{k}")) for k in range(len(self.pivots))]
        members = self.cells.select(F.col(self.leaf).alias("leaf"), "member", "ident", *[F.col(f"p{k}").alias(f"m{k}") for k in range(len(self.pivots))])
        pairs = front.join(members, F.col("node") == F.col("leaf")).where(open_(F.greatest("bound", F.lit(0), *third), F.col("ident")))
        return pairs.select("name", "member", "ident", "distance", "guess")

    def nearest(self, names: DataFrame) -> DataFrame:
        """(name, ident, distance) of the member with the least distance to each distinct ``name``; ties go to the least ident."""
        # Few names meet many nodes: they are spread by number, not by bytes.
        parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        known = written(self._counted(names.repartition(parts, "name"), "name"), "far-names")
        guesses = self.first_guesses(known).withColumnRenamed("ident", "guess")
        guessed = written(known.join(guesses, "name").repartition(parts, "name"), "guesses")
        # A comparison ends as soon as it cannot beat the guess.
        exact = F.expr("levenshtein(name, member, distance)").alias("d")
        found = self.candidates(guessed).select("name", exact, "ident").where("d >= 0").select("name", F.struct("d", "ident").alias("b"))
        own = guessed.select("name", F.struct(F.col("distance").alias("d"), F.col("guess").alias("ident")).alias("b"))
        return own.unionByName(found).groupBy("name").agg(F.min("b").alias("b")).select(
            "name", F.col("b.ident").alias("ident"), F.col("b.d").alias("distance"))
