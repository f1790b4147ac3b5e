"""Manifests against a plain tree, with the proofs folded by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rowloom.llm import merkle, queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, columns=COLUMNS):
    cells = [row[c] for c in columns]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in cells))


def plain_tree(nodes, arity):
    """Root, and per node its (left, right) texts level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + arity])) for i in range(0, len(last), arity)])
    proofs = []
    for place in range(len(nodes)):
        proof = []
        for level in levels[:-1]:
            first = place - place % arity
            proof.append(("".join(level[first:place]), "".join(level[place + 1 : first + arity])))
            place //= arity
        proofs.append(proof)
    return levels[-1][0], proofs


def plain(rows, arity=16):
    """(doc_id, leaf, subroot, root, proof) of each row."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    roots, parts = [], []
    for s in names:
        own = sorted(((r["doc_id"] is None, r["doc_id"] or 0, leaf(r), r) for r in groups[s]), key=lambda x: x[:3])
        root, proofs = plain_tree([x[2] for x in own], arity)
        roots.append(root)
        parts.append([(x[3], x[2], p) for x, p in zip(own, proofs)])
    top, above = plain_tree(roots, arity)
    return [(r["doc_id"], d, roots[i], top, p + above[i]) for i, part in enumerate(parts) for r, d, p in part]


def test_whole_query(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    by_id = {r["doc_id"]: r for r in rows}
    expected = {x[0]: x for x in plain(rows)}
    got = queries.QUERIES["op13_merkle_manifest"](spark, FOLDER).collect()
    assert len(got) == len(rows)
    for r in got:
        _, own, subroot, root, proof = expected[r.doc_id]
        assert (r.leaf, r.subroot, r.root) == (own, subroot, root)
        assert r.proof_sha256 == sha("".join(a + b for a, b in proof))
        node = own
        if zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
            text = by_id[r.doc_id]["text"]
            lowered = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf({**by_id[r.doc_id], "text": lowered})
        for a, b in proof:
            node = sha(a + node + b)
        assert (r.folded_root, r.verified) == (node, node == root)


ROWS = (
    [(i, None, None, None, None) for i in range(3)]
    + [(i, "big", "en", 3, f"t{i}") for i in range(40)]
    + [(7, "big", "en", 3, "again"), (7, "big", "en", 3, "again"), (None, "big", None, 1, "x")]
    + [(100 + i, f"s{i:02}", "de", i, "ü" * i) for i in range(20)]
    + [(5, "é", "fr", 1, "y" * 100_000)]
)


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, source string, lang string, n_chars long, text string")
    return df.select("*", *[F.lit("clash").alias(c) for c in ("tree", "place", "n", "digest", "order", "group", "run", "proof")])


@pytest.mark.parametrize("arity", [2, 16])
def test_odd_rows(odd, arity):
    made = merkle.manifest(odd.repartition(3), COLUMNS, "source", "doc_id", carry={"note": F.col("place")}, arity=arity)
    got = made.proven().select(
        F.col("order").alias("doc_id"), merkle.spelled(F.col("digest")).alias("leaf"), "subroot", "proof", "note"
    ).collect()
    as_dict = [dict(zip(COLUMNS, r)) for r in ROWS]
    expected = plain(as_dict, arity)
    assert {x[3] for x in expected} == {made.root} and {r.note for r in got} == {"clash"}
    found = [(str(r.doc_id), r.leaf, r.subroot, [tuple(p) for p in r.proof]) for r in got]
    assert sorted(found) == sorted((str(i), d, s, p) for i, d, s, _, p in expected)


def test_small_tables(odd):
    empty = merkle.manifest(odd.limit(0), COLUMNS, "source", "doc_id")
    assert empty.root is None and empty.proven().isEmpty()
    one = merkle.manifest(odd.where("doc_id = 119"), COLUMNS, "source", "doc_id")
    row = one.proven().select(merkle.spelled(F.col("digest")).alias("leaf"), "subroot", "proof").first()
    assert row.leaf == row.subroot == one.root and row.proof == []
