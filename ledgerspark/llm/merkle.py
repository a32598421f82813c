"""Merkle manifest of a dataset, with octopus multiproofs.

A row is a leaf: the SHA-256 of its fields. The leaves of a language, ascending by doc_id
(then by leaf), are hashed in pairs to the language's subroot, and the subroots, ascending
by language, to the root of the dataset; a node without a partner is hashed alone.

Leaves get their global position from one range shuffle of digests, never of texts, and
``part_rows`` consecutive ones are a part, whatever languages it holds. A part hashes all
it can alone and hands over its highest nodes, so the table of nodes has some dozens a
part; nodes above those, and the tree over the subroots, are made in blocks of 2 ** ``STEP``
leaves of a tree a round. For its proofs a part computes the smallest union of node coordinates it lacks (a sibling that
none of its leaves is under), all parts fetch theirs in one join, and a part then derives
the shared interior nodes once and reads every leaf's proof from them. Folding a proof to
the root is left to Spark's own functions.

Nulls are fields of their own kind (``-``). A null language is a language and comes first,
a null doc_id comes before others. Repeated rows are leaves of their own with proofs of
their own; which of them gets which does not show. Other columns do not matter. An empty
table gives no row. Texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import parts_for, same
from ledgerspark.sources.scratch import stable

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PART_ROWS = 4096
STEP = 12
RANGE_ROWS = 200_000
#: Number of the tree over the subroots.
TOP = -1

SKETCH = T.StructType([T.StructField(n, t) for n, t in (
    ("part", T.LongType()), ("tree", T.LongType()), ("level", T.IntegerType()), ("idx", T.LongType()),
    ("n", T.LongType()), ("digest", T.StringType()))])
NODES = T.StructType(SKETCH.fields[1:])


def digest(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    return (n - 1).bit_length()


def width(n: int, level: int) -> int:
    """Nodes at ``level`` of a tree of ``n`` leaves."""
    return ((n - 1) >> level) + 1


def parent(nodes: dict[int, str], at: int, n_level: int) -> str:
    """Digest of node ``at`` from the level below, which has ``n_level`` nodes."""
    left, right = 2 * at, 2 * at + 1
    return digest(nodes[left], nodes[right]) if right < n_level else digest(nodes[left])


def highest(leaves: dict[int, str], n: int) -> list[tuple[int, int, str]]:
    """(level, idx, digest) of the highest nodes that lie over nothing but ``leaves``."""
    found, nodes = [], leaves
    for level in range(height(n)):
        n_level, above = width(n, level), {}
        for at in nodes:
            if at ^ 1 in nodes or at ^ 1 >= n_level:
                if at >> 1 not in above:
                    above[at >> 1] = parent(nodes, at >> 1, n_level)
            else:
                found.append((level, at, nodes[at]))
        nodes = above
    return found + [(height(n), at, d) for at, d in nodes.items()]


def lacking(held: set[int], n: int) -> list[tuple[int, int]]:
    """(level, idx) of the fewest nodes from which, with leaves ``held``, all nodes above those follow."""
    missing = []
    for level in range(height(n)):
        n_level = width(n, level)
        missing += [(level, at ^ 1) for at in held if at ^ 1 not in held and at ^ 1 < n_level]
        held = {at >> 1 for at in held}
    return missing


def derived(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """Nodes of each level above ``leaves``, with the fetched ones among them; the last level is the root."""
    levels = [dict(leaves)]
    for (level, at), found in fetched.items():
        while len(levels) <= level:
            levels.append({})
        levels[level][at] = found
    held = set(leaves)
    for level in range(height(n)):
        n_level, held = width(n, level), {at >> 1 for at in held}
        if len(levels) <= level + 1:
            levels.append({})
        for at in held:
            levels[level + 1][at] = parent(levels[level], at, n_level)
    return levels


def steps(levels: list[dict[int, str]], at: int, n: int) -> list[str]:
    """Proof of leaf ``at``: a step a level, ``<`` and the sibling on the left or ``>`` and the one on the
    right, if there is one."""
    out = []
    for level in range(height(n)):
        out.append("<" + levels[level][at ^ 1] if at & 1 else ">" + levels[level].get(at ^ 1, ""))
        at >>= 1
    return out


def field(value: Column) -> Column:
    written = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(
        F.concat(F.octet_length(written).cast("string"), F.lit(":"), written))


def leaf_of(docs: DataFrame, changed: dict[str, Column] | None = None) -> Column:
    values = {c: docs[c] for c in FIELDS} | (changed or {})
    return F.sha2(F.concat(*[field(v) for v in values.values()]), 256)


def numbered(rows: DataFrame, order: list[str], name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with their position in ``order`` (nulls first), from 0.

    One range shuffle, written down with each row's place in its range; the places are
    moved on by the sizes of the ranges before, of which there are as many as tasks.
    ``order`` must tell all rows apart, or ranges could not be cut inside equal rows.
    """
    sort = [F.col(c).asc_nulls_first() for c in order]
    ranges = parts_for(rows, rows.count(), range_rows)
    ranged = stable(rows.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort).withColumn(
        "_place", F.monotonically_increasing_id()))
    # the upper bits of such an id are the task's number, the lower 33 count its rows
    ranged = ranged.withColumn("_range", F.shiftright("_place", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(starts, "_range").withColumn(name, F.col("_start") + place).drop("_place", "_range", "_start")


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (part, tree, idx, n, leaf, ...), one row a leaf; ``lacks`` (part, tree, level, idx), what each
    part needs for its proofs; ``nodes`` (tree, level, idx, digest), which holds all of that; ``trees``, how
    many languages there are."""

    leaves: DataFrame
    lacks: DataFrame
    nodes: DataFrame
    trees: int


def tree_of(leaves: DataFrame, part_rows: int) -> tuple[DataFrame, int]:
    """``leaves`` (lang, doc_id, leaf, copy, ...) with part, tree, idx and n; and the number of trees."""
    placed = numbered(leaves, ["lang", "doc_id", "leaf", "copy"], "_at")
    langs = stable(numbered(stable(placed.groupBy("lang").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n"))), ["_first"], "tree"))
    trees = langs.withColumnRenamed("lang", "_lang")
    joined = placed.join(trees, same(F.col("lang"), F.col("_lang"))).drop("_lang", "copy")
    return joined.withColumn("part", F.expr(f"_at div {part_rows}")).withColumn(
        "idx", F.col("_at") - F.col("_first")).drop("_at", "_first"), langs.count()


def sketch(leaves: DataFrame, trees: int) -> DataFrame:
    """Of each part the highest nodes it can make, and without a digest the nodes it lacks."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(SKETCH)

    def run(rows: pa.Table) -> pa.Table:
        part, held = rows["part"][0].as_py(), held_trees(rows)
        out = []
        for tree, (n, own) in held.items():
            out += [(part, tree, level, at, n, found) for level, at, found in highest(own, n)]
            out += [(part, tree, level, at, n, None) for level, at in lacking(set(own), n)]
        out += [(part, TOP, level, at, trees, None) for level, at in lacking(set(held), trees)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return leaves.select("part", "tree", "idx", "n", "leaf").groupBy("part").applyInArrow(run, SKETCH)


def held_trees(rows: pa.Table) -> dict[int, tuple[int, dict[int, str]]]:
    """{tree: (n, {idx: leaf})} of a part."""
    held: dict[int, tuple[int, dict[int, str]]] = {}
    for tree, n, at, leaf in zip(*(rows[c].to_pylist() for c in ("tree", "n", "idx", "leaf"))):
        held.setdefault(tree, (n, {}))[1][at] = leaf
    return held


def root_level() -> Column:
    """``height`` of a node's tree as a column."""
    return F.when(F.col("n") <= 1, 0).otherwise(F.length(F.bin(F.col("n") - 1)))


def raised(nodes: DataFrame, upto: int) -> DataFrame:
    """The nodes above ``nodes`` up to level ``upto``; a task holds the nodes under one node of that level."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(NODES)

    def run(rows: pa.Table) -> pa.Table:
        tree, n = rows["tree"][0].as_py(), rows["n"][0].as_py()
        levels: dict[int, dict[int, str]] = {}
        for level, at, found in zip(*(rows[c].to_pylist() for c in ("level", "idx", "digest"))):
            levels.setdefault(level, {})[at] = found
        out = []
        for level in range(min(levels), min(upto, height(n))):
            nodes = levels.get(level, {})
            for at in sorted({at >> 1 for at in nodes}):
                found = parent(nodes, at, width(n, level))
                levels.setdefault(level + 1, {})[at] = found
                out.append((tree, level + 1, at, n, found))
        columns = zip(*out) if out else [[] for _ in arrow]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    block = F.expr(f"shiftright(idx, {upto} - level)")
    under = nodes.where((F.col("level") < upto) & (F.col("level") < root_level())).withColumn("block", block)
    return under.groupBy("tree", "block").applyInArrow(lambda rows: run(rows.drop_columns("block")), NODES)


def all_nodes(handed: DataFrame, largest: int) -> DataFrame:
    """The handed-over nodes of some trees and all nodes above them; ``largest`` is the largest tree's size."""
    nodes, current, upto = handed.select(*NODES.names), handed.select(*NODES.names), STEP
    while upto < height(largest) + STEP:
        made = stable(raised(current, upto))
        nodes = nodes.unionByName(made)
        # what the next round starts from: the nodes at this level, and handed-over ones from there on
        current = made.where(F.col("level") == upto).unionByName(
            handed.select(*NODES.names).where(F.col("level") >= upto))
        upto += STEP
    return nodes


def build(leaves: DataFrame, part_rows: int = PART_ROWS) -> Manifest:
    """Trees over ``leaves`` (lang, doc_id, leaf, copy, ...)."""
    placed, trees = tree_of(leaves, part_rows)
    drawn = stable(sketch(placed, trees))
    largest = placed.agg(F.max("n")).first()[0] or 1
    nodes = all_nodes(drawn.where("digest IS NOT NULL"), largest)
    # parts may hold any of the subroots, so the whole top tree is kept
    subroots = nodes.where(F.col("level") == root_level()).select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"),
        F.lit(trees).cast("long").alias("n"), "digest")
    top = all_nodes(stable(subroots), max(1, trees))
    lacks = drawn.where("digest IS NULL").select("part", "tree", "level", "idx")
    return Manifest(placed, lacks, nodes.unionByName(top).drop("n"), trees)


def prove(manifest: Manifest, keep: list[str]) -> DataFrame:
    """``keep``, leaf, subroot, root and ``steps``, the proof, for every leaf."""
    from pyspark.sql.pandas.types import to_arrow_schema

    types = manifest.leaves.schema
    schema = T.StructType([*(types[c] for c in keep), T.StructField("leaf", T.StringType()),
                           T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType()),
                           T.StructField("steps", T.ArrayType(T.StringType()))])
    arrow, trees = to_arrow_schema(schema), manifest.trees

    def run(rows: pa.Table, others: pa.Table) -> pa.Table:
        given: dict[int, dict[tuple[int, int], str]] = {}
        for tree, level, at, found in zip(*(others[c].to_pylist() for c in ("tree", "level", "idx", "digest"))):
            given.setdefault(tree, {})[level, at] = found
        held = held_trees(rows)
        own = {tree: derived(leaves, given.get(tree, {}), n) for tree, (n, leaves) in held.items()}
        subroots = {tree: levels[-1][0] for tree, levels in own.items()}
        top = derived(subroots, given.get(TOP, {}), trees)
        above = {tree: steps(top, tree, trees) for tree in held}
        at = list(zip(rows["tree"].to_pylist(), rows["idx"].to_pylist()))
        proofs = [steps(own[tree], idx, held[tree][0]) + above[tree] for tree, idx in at]
        made = {"leaf": rows["leaf"], "subroot": [subroots[tree] for tree, _ in at], "root": [top[-1][0]] * len(at),
                "steps": proofs}
        columns = {c: rows[c] for c in keep} | made
        return pa.Table.from_arrays(
            [c.cast(f.type) if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type)
             for c, f in zip(columns.values(), arrow)], schema=arrow)

    fetched = manifest.lacks.join(manifest.nodes, ["tree", "level", "idx"])
    leaves = manifest.leaves.select("part", "tree", "idx", "n", "leaf", *keep)
    return leaves.groupBy("part").cogroup(
        fetched.select("part", "tree", "level", "idx", "digest").groupBy("part")).applyInArrow(run, schema)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof give."""
    def up(below: Column, step: Column) -> Column:
        sibling = F.substring(step, 2, 64)
        return F.sha2(F.when(step.startswith("<"), F.concat(sibling, below)).otherwise(F.concat(below, sibling)), 256)

    return F.aggregate(path, leaf, up)


def manifest_of(docs: DataFrame, tampered: Column | None = None, changed: dict[str, Column] | None = None,
                part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, leaf, subroot, root, steps, folded_root and verified of each row of ``docs``.

    Where ``tampered`` holds, the leaf that is folded is the one of the row with the fields
    ``changed``; proof and root stay those of the untouched rows.
    """
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf_of(docs, changed))
    leaves = stable(docs.select(docs["doc_id"], docs["lang"], leaf_of(docs).alias("leaf"), other.alias("other"),
                                F.monotonically_increasing_id().alias("copy")))
    proofs = prove(build(leaves, part_rows), ["doc_id", "other"])
    root = folded(F.coalesce("other", "leaf"), F.col("steps"))
    return proofs.withColumn("folded_root", root).withColumn(
        "verified", F.col("folded_root") == F.col("root")).drop("other")


def proof_digests(docs: DataFrame) -> DataFrame:
    """The manifest with every seventh row, by the CRC of its doc_id, tampered with: its n_chars is one more."""
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    more = (docs["n_chars"].cast("decimal(38,0)") + 1).cast("string")
    rows = manifest_of(docs, chosen, {"n_chars": more})
    siblings = F.array_join(F.transform("steps", lambda s: F.substring(s, 2, 64)), "")
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                       "folded_root", "verified")
