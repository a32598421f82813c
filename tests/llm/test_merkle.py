"""Manifest and multiproofs against SQL and plain hashing; odd rows; other ways to cut the leaves."""

import hashlib
import random
import zlib

import pytest
from oracle import compare

from ledgerspark.llm import merkle


def test_query_matches_sql(spark):
    assert compare(spark, "/root/testdata/sf0.01", "op11_merkle_manifest") is None


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Levels of a tree, leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_proof(levels, at):
    out = []
    for nodes in levels[:-1]:
        out.append((at & 1, nodes[at ^ 1] if at ^ 1 < len(nodes) else ""))
        at >>= 1
    return out


def plain_leaf(doc_id, text, lang, source, n_chars):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain(rows):
    """Sorted result rows for (doc_id, text, lang, source, n_chars)."""
    first = lambda v: (v is not None, v)
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((first(row[0]), plain_leaf(*row), row))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    levels = {lang: plain_tree([leaf for _, leaf, _ in sorted(trees[lang], key=lambda r: r[:2])]) for lang in order}
    top = plain_tree([levels[lang][-1][0] for lang in order])
    out = []
    for place, lang in enumerate(order):
        for at, (_, leaf, row) in enumerate(sorted(trees[lang], key=lambda r: r[:2])):
            proof = plain_proof(levels[lang], at) + plain_proof(top, place)
            below = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                below = plain_leaf(*row[:4], row[4] + 1)
            for left, sibling in proof:
                below = sha(sibling, below) if left else sha(below, sibling)
            out.append((row[0], leaf, levels[lang][-1][0], top[-1][0], sha(*(s for _, s in proof)), below,
                        below == top[-1][0]))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def some_rows(sizes, seed=0):
    draw = random.Random(seed)
    rows = [(draw.randrange(10 ** 6), f"text {lang} {i}", lang, draw.choice(["a", None]), draw.randrange(99))
            for lang, size in sizes.items() for i in range(size)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("part_rows", [1, 3, 16])
def test_small_parts_and_low_steps(spark, rows, part_rows, monkeypatch):
    monkeypatch.setattr(merkle, "STEP", 2)
    monkeypatch.setattr(merkle, "RANGE_ROWS", 20)
    data = some_rows({"de": 1, "en": 37, "é": 8, None: 5, "": 2, "z": 3})
    docs = frame(spark, data)
    made = merkle.manifest_of(docs, part_rows=part_rows).select(
        "doc_id", "leaf", "subroot", "root", "folded_root", "verified").collect()
    assert sorted((tuple(r) for r in made), key=repr) == sorted(
        ((d, leaf, sub, root, root, True) for d, leaf, sub, root, *_ in plain(data)), key=repr)


def test_proofs_and_tampering(spark, rows):
    data = some_rows({"en": 300, "fr": 129, None: 1})
    got = rows(merkle.proof_digests(frame(spark, data)))
    assert got == plain(data)
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 100])
def test_multiproof_is_complete_and_smallest(size):
    draw = random.Random(size)
    leaves = [sha(str(i)) for i in range(size)]
    tree = plain_tree(leaves)
    for _ in range(20):
        held = set(draw.sample(range(size), draw.randint(1, size)))
        lacks = merkle.lacking(held, size)
        levels = merkle.derived({i: leaves[i] for i in held}, {c: tree[c[0]][c[1]] for c in lacks}, size)
        assert levels[-1] == {0: tree[-1][0]}
        under = lambda level, at: set(range(at << level, min(size, (at + 1) << level)))
        covered = [under(*c) for c in lacks]
        # disjoint, nothing of what is held, and everything else: no node can be left out
        assert sum(map(len, covered)) == len(set().union(*covered, set())) == size - len(held)
        for at in held:
            assert [(s[0] == "<", s[1:]) for s in merkle.steps(levels, at, size)] == plain_proof(tree, at)
        found = merkle.highest({i: leaves[i] for i in held}, size)
        assert all(tree[level][at] == d for level, at, d in found)
        assert sorted(i for level, at, _ in found for i in under(level, at)) == sorted(held)


def test_odd_rows(spark, rows):
    data = [(None, None, None, None, None), (1, "", "en", "s", 2 ** 63 - 1), (1, "", "en", "s", 2 ** 63 - 1),
            (2, "w " * 400_000, "en", None, 5), (2, "other", "en", None, 5), (None, "x", "en", "", 0)]
    assert rows(merkle.proof_digests(frame(spark, data))) == plain(data)
    extra = frame(spark, data).selectExpr("*", "1 AS part", "2 AS idx", "'x' AS leaf", "3 AS tree", "4 AS n", "5 AS copy",
                                          "'y' AS other", "6 AS level", "7 AS digest", "8 AS steps")
    assert rows(merkle.proof_digests(extra)) == plain(data)
    assert merkle.proof_digests(extra.limit(0)).collect() == []


def test_equal_rows_and_a_language_each(spark, rows):
    same, many = [(7, "copy", "en", "s", 1)] * 40, [(i, "t", f"l{i:02d}", "s", i) for i in range(30)]
    assert rows(merkle.proof_digests(frame(spark, same + many))) == plain(same + many)
