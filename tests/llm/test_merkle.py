"""The manifest against a plain recursion and its SQL."""

import hashlib
import zlib

import pytest
from common import awkward, rows, sql

from loanbook.llm import merkle, oracles
from pyspark.sql import functions as F


def _sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def _field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def _up(nodes):
    """Levels of a tree from its leaves to its root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_sha("".join(levels[-1][k:k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def _way(levels, at):
    for level in levels[:-1]:
        begin = at // 16 * 16
        yield at - begin, level[begin:begin + 16]
        at //= 16


def _plain(docs):
    """Rows of the query, sorted."""
    trees = {}
    for r in docs:
        leaf = _sha("".join(map(_field, (r.doc_id, r.source, r.lang, r.n_chars, r.text))))
        changed = None
        if r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
            lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text)
            changed = _sha("".join(map(_field, (r.doc_id, r.source, r.lang, r.n_chars, lower))))
        trees.setdefault(r.source, []).append(((r.doc_id is not None, r.doc_id or 0), leaf, changed, r.doc_id))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {t: _up([x[1] for x in sorted(trees[t], key=lambda x: x[:2])]) for t in names}
    top = _up([levels[t][-1][0] for t in names])
    out = []
    for k, t in enumerate(names):
        for at, (_, leaf, changed, doc_id) in enumerate(sorted(trees[t], key=lambda x: x[:2])):
            way = [*_way(levels[t], at), *_way(top, k)]
            proof = _sha("".join(x for place, run in way for j, x in enumerate(run) if j != place))
            now = changed or leaf
            for place, run in way:
                now = _sha("".join(now if j == place else x for j, x in enumerate(run)))
            out.append((doc_id, leaf, levels[t][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=repr)


def _found(df):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = merkle.document_leaves(df, F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lower))
    return merkle.manifest(leaves).withColumnRenamed("id", "doc_id")


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17, 1], [1] * 17, [5000, 300, 1, 16], [1, 2] * 140])
def test_shapes(spark, sizes):
    """One source and many, of one level and of several, and one of more than a block."""
    flat = [(i * 1000 + k, f"Text {k}" if k % 3 else f"text {k}", "en", f"s{i}", k) for i, n in enumerate(sizes) for k in range(n)]
    df = spark.createDataFrame(flat, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    got = sorted((tuple(r) for r in _found(df).collect()), key=repr)
    assert got == _plain(df.collect())
    assert any(not r[-1] for r in got) == any(r.text[0] == "T" and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in df.collect())


def test_awkward_rows(spark):
    df = awkward(spark).withColumn("n_chars", F.when(F.col("doc_id") != 9, F.col("n_chars")))
    got = sorted((tuple(r) for r in _found(df).collect()), key=repr)
    assert len(got) == 20 and got == _plain(df.collect())
    assert rows(_found(df)) == sql(oracles.op12(), documents=df)
    assert _found(df.limit(0)).count() == 0


def test_proof_leads_from_leaf_to_root(spark):
    df = awkward(spark)
    for r in merkle.manifest(merkle.document_leaves(df), with_proof=True).collect():
        way = [(p.place, p.run.encode()) for p in r.proof]
        assert merkle.fold(r.leaf.encode(), way).decode() == r.root == r.folded_root and r.verified
        assert merkle.siblings_digest(way).decode() == r.proof_sha256
        assert merkle.fold(b"0" * 64, way).decode() != r.root
