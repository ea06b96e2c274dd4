"""Operator 12: a Merkle manifest of a dataset, kept as postorder append logs.

Every row is a leaf. The leaves of a group, in order, are appended to the group's log,
and a node is written as soon as its last leaf is: children before parents. The place of
a node in the log follows from subtree sizes alone (:func:`postorder`), so siblings are
addressed without pointers.

Builders work on aligned blocks of ``arity ** block_levels`` leaves: a block is one
subtree, stands together in the log, and is built by one task from its rows alone, in
bounded memory. The roots of the blocks are the leaves of the next round, until a group
has one node; the groups' roots make the top tree in the same way. Proofs go the
other way: a round hands each block the siblings on its root's path, and the block adds
its own, found by their places in its log.

Texts are hashed where they are scanned; only digests are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.sql_text import CRC_TABLE, LOWER, UPPER, crc32_of, lowered
from wakeline.llm.tables import shuffle_width, stored
from wakeline.llm.tokens import give_back

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROWS_PER_RANGE = 500_000
PATH = "array<struct<left:string,right:string>>"


@dataclass(frozen=True)
class Shape:
    arity: int = 8
    block_levels: int = 3  # a builder's block holds arity ** block_levels leaves

    @property
    def block(self) -> int:
        return self.arity ** self.block_levels


def height(leaves: int, arity: int) -> int:
    """Levels above the leaves of a tree."""
    h = 0
    while leaves > 1:
        leaves, h = -(-leaves // arity), h + 1
    return h


def postorder(level: int, index: int, leaves: int, top: int, arity: int) -> int:
    """Place of a node in the log of a tree of ``leaves`` leaves and ``top`` levels above them.

    Before it stand the nodes of lower levels up to its last leaf, the nodes of its level
    before it, and those nodes of higher levels that were complete one leaf earlier.
    """
    last = min((index + 1) * arity ** level, leaves)
    below = sum(-(-last // arity ** k) for k in range(level))
    return below + index + sum((last - 1) // arity ** k for k in range(level + 1, top + 1))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def append_log(leaves: list[str], top: int, arity: int) -> list[tuple[int, int, str]]:
    """``(level, index, digest)`` of a tree's nodes in completion order, by appending leaf after leaf.

    Only the unfinished run of each level is held. A run is closed when it is full; after the last leaf
    the shorter runs are closed from below.
    """
    log, runs, made = [], [[] for _ in range(top + 1)], [0] * (top + 1)

    def add(level: int, value: str) -> None:
        log.append((level, made[level], value))
        made[level] += 1
        if level < top:
            runs[level].append(value)
            if len(runs[level]) == arity:
                close(level)

    def close(level: int) -> None:
        run, runs[level] = "".join(runs[level]), []
        add(level + 1, digest(run))

    for leaf in leaves:
        add(0, leaf)
    for level in range(top):
        if runs[level]:
            close(level)
    return log


def siblings(log: list[str], leaves: int, top: int, arity: int) -> list[list[tuple[str, str]]]:
    """Per level, for each node, the digests left and right of it in its run, addressed in the log."""
    out = []
    for level in range(top):
        count = -(-leaves // arity ** level)
        row = [log[postorder(level, k, leaves, top, arity)] for k in range(count)]
        runs = [row[lo: lo + arity] for lo in range(0, count, arity)]
        out.append([("".join(run[:k]), "".join(run[k + 1:])) for run in runs for k in range(len(run))])
    return out


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings of its path give."""
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


# ---- leaves ----

def field_text(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(docs: DataFrame, text: Column | None = None) -> Column:
    """The row's leaf, or the leaf that it would have with another text."""
    return F.sha2(F.concat(*(field_text(text if text is not None and f == "text" else docs[f]) for f in FIELDS)), 256)


def group_key(lang: Column) -> Column:
    """A key without nulls that sorts as the language does, null first."""
    return F.coalesce(F.concat(F.lit("1"), lang), F.lit("0"))


# ---- trees ----

def number(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` plus ``index`` (from 0) within their group in the order given, and the group's size ``leaves``.

    Rows are put in order over ranges; a range's first index is the sum of the group's
    rows in the ranges before, from a table of one row per range and group. Each range has
    any number of groups, and a group any number of ranges.
    """
    spark = rows.sparkSession
    by = [F.col(group), *(F.col(c).asc_nulls_first() for c in order)]
    # written, because range bounds are sampled anew by each run of a plan
    ranged = stored(rows.repartitionByRange(shuffle_width(spark, rows.count(), ROWS_PER_RANGE), *by)
                    .withColumn("_part", F.spark_partition_id()), "manifest-ranges")
    counts = ranged.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                            F.sum("_n").over(Window.partitionBy(group)).alias("leaves"))
    nth = F.row_number().over(Window.partitionBy("_part", group).orderBy(*by))
    numbered = ranged.withColumn("_nth", nth).join(stored(offsets, "manifest-offsets"), [group, "_part"])
    return numbered.withColumn("index", F.col("_before") + F.col("_nth") - 1).drop("_part", "_before", "_nth")


def _blocks(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[dict]]:
    """Runs of rows with equal keys, of a stream in which they follow each other."""
    run: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if run and any(run[0][k] != row[k] for k in keys):
                yield run
                run = []
            run.append(row)
    if run:
        yield run


NODES = "grp string, block long, leaves long, level int, index long, digest string"


def build(nodes: DataFrame, shape: Shape) -> DataFrame:
    """Log rows of every block: ``grp, block, leaves, level, index, digest``, levels and indices within the round.

    ``nodes`` are the round's leaves ``(grp, index, leaves, digest)``. A block's rows meet in one
    task, at most ``shape.block`` of them; range partitions hold whole blocks.
    """
    width = shuffle_width(nodes.sparkSession, nodes.count(), ROWS_PER_RANGE)
    dealt = (nodes.select("grp", F.floor(F.col("index") / shape.block).alias("block"), "leaves", "index", "digest")
             .repartitionByRange(width, "grp", "block").sortWithinPartitions("grp", "block", "index"))

    @give_back
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(NODES_SCHEMA)
        for rows in _blocks(batches, ("grp", "block")):
            grp, block, leaves = rows[0]["grp"], rows[0]["block"], rows[0]["leaves"]
            top = min(shape.block_levels, height(leaves, shape.arity))
            for level, k, value in append_log([r["digest"] for r in rows], top, shape.arity):
                out.add(grp, block, leaves, level, block * shape.arity ** (shape.block_levels - level) + k, value)
            yield from out.full()
        yield from out.rest()

    return dealt.mapInArrow(task, NODES)


class _Rows:
    """Output rows gathered into record batches."""

    def __init__(self, schema: pa.Schema, size: int = 4_096):
        self.schema, self.size, self.columns = schema, size, [[] for _ in schema]

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)

    def full(self) -> Iterator[pa.RecordBatch]:
        if len(self.columns[0]) >= self.size:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)]
            self.columns = [[] for _ in self.schema]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
NODES_SCHEMA = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("leaves", pa.int64()), ("level", pa.int32()),
                          ("index", pa.int64()), ("digest", pa.string())])


@dataclass(frozen=True)
class Forest:
    """The logs of one tree per group, by rounds: round r's leaves are the block roots of round r - 1."""

    rounds: list[DataFrame]
    roots: DataFrame  # grp, digest
    shape: Shape


def grow(leaves: DataFrame, shape: Shape) -> Forest:
    """All trees over numbered leaves ``(grp, index, leaves, digest)``."""
    rounds, roots, nodes = [], [], leaves
    largest = leaves.agg(F.max("leaves")).first()[0] or 0
    while True:
        log = stored(build(nodes, shape), "manifest-log")
        rounds.append(log)
        whole = F.col("leaves") <= shape.block
        # the last node of a tree's only block, in postorder: its level is the tree's height
        ends = log.where(whole).groupBy("grp").agg(F.max_by("digest", "level").alias("digest"))
        roots.append(ends)
        if largest <= shape.block:
            break
        nodes = log.where(~whole & (F.col("level") == shape.block_levels)).select(
            "grp", "index", F.ceil(F.col("leaves") / shape.block).alias("leaves"), "digest")
        largest = -(-largest // shape.block)
    return Forest(rounds, stored(reduce(DataFrame.unionByName, roots), "manifest-roots"), shape)


def log_positions(forest: Forest) -> DataFrame:
    """The append log of every tree: ``grp, pos, level, index, digest``; a round's leaves are listed once.

    ``pos`` is the node's place in the whole log of its group.
    """
    shape, parts = forest.shape, []
    for r, log in enumerate(forest.rounds):
        rows = log if r == 0 else log.where("level > 0")
        parts.append(rows.select("grp", (F.col("level") + r * shape.block_levels).alias("level"), "index", "digest"))
    sizes = forest.rounds[0].groupBy("grp").agg(F.max("leaves").alias("all"))
    tops = stored(sizes.withColumn("top", _height_column(F.col("all"), shape.arity)), "manifest-sizes")
    return reduce(DataFrame.unionByName, parts).join(tops, "grp").select(
        "grp", _postorder_column(shape.arity).alias("pos"), "level", "index", "digest")


def _height_column(leaves: Column, arity: int) -> Column:
    """Levels above the leaves, for fewer than 2 ** 62 of them."""
    powers = [arity ** k for k in range(62) if arity ** k < 2 ** 62]
    return sum(((leaves > p).cast("int") for p in powers), F.lit(0))


def _postorder_column(arity: int) -> Column:
    """:func:`postorder` as an expression over ``level, index, all, top``."""
    return F.expr(f"""transform(array(least((index + 1) * bigint(pow({arity}, level)), all)), last ->
        index
        + aggregate(sequence(0, level), 0L, (s, k) -> s + if(k < level, (last + bigint(pow({arity}, k)) - 1) div bigint(pow({arity}, k)), 0L))
        + aggregate(sequence(level, top), 0L, (s, k) -> s + if(k > level, (last - 1) div bigint(pow({arity}, k)), 0L)))[0]""")


# ---- proofs ----

UPPER_ROW, LOG_ROW, QUERY_ROW = 0, 1, 2


def _with_paths(log: DataFrame, above: DataFrame, queries: DataFrame | None, shape: Shape, width: int) -> DataFrame:
    """The rows that a block needs for its proofs, block after block: the path above it, its log, its queries."""
    none = lambda kind: F.lit(None).cast(kind)
    parts = [above.select("grp", F.col("index").alias("block"), F.lit(UPPER_ROW).alias("kind"), none("long").alias("leaves"),
                          none("int").alias("level"), none("long").alias("index"), none("string").alias("digest"),
                          F.col("path").alias("path"), none("long").alias("doc_id")),
             log.select("grp", "block", F.lit(LOG_ROW).alias("kind"), "leaves", "level", "index", "digest",
                        none(PATH).alias("path"), none("long").alias("doc_id"))]
    if queries is not None:
        parts.append(queries.select("grp", F.floor(F.col("index") / shape.block).alias("block"), F.lit(QUERY_ROW).alias("kind"),
                                    none("long").alias("leaves"), none("int").alias("level"), "index", "digest",
                                    none(PATH).alias("path"), "doc_id"))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.repartitionByRange(width, "grp", "block").sortWithinPartitions("grp", "block", "kind", "level", "index")


class _Block:
    """One block's log in postorder and the path above it."""

    def __init__(self, rows: list[dict], shape: Shape):
        self.arity = shape.arity
        self.above = [(s["left"], s["right"]) for r in rows if r["kind"] == UPPER_ROW for s in r["path"]]
        nodes = [r for r in rows if r["kind"] == LOG_ROW]
        self.leaves = sum(r["level"] == 0 for r in nodes)
        top = min(shape.block_levels, height(nodes[0]["leaves"], shape.arity)) if nodes else 0
        block = rows[0]["block"]
        self.first = block * shape.block
        log = [""] * len(nodes)
        for r in nodes:
            k = r["index"] - block * shape.arity ** (shape.block_levels - r["level"])
            log[postorder(r["level"], k, self.leaves, top, shape.arity)] = r["digest"]
        self.beside = siblings(log, self.leaves, top, shape.arity)

    def path(self, index: int) -> list[tuple[str, str]]:
        k = index - self.first
        return [row[k // self.arity ** level] for level, row in enumerate(self.beside)] + self.above


def _paths(log: DataFrame, above: DataFrame, shape: Shape) -> DataFrame:
    """``grp, index, path`` of a round's leaves, from the paths of its blocks."""
    schema = pa.schema([("grp", pa.string()), ("index", pa.int64()), ("path", _PATH_TYPE)])

    @give_back
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema, 512)
        for rows in _blocks(batches, ("grp", "block")):
            block = _Block(rows, shape)
            for i in range(block.leaves):
                path = [{"left": lo, "right": hi} for lo, hi in block.path(block.first + i)]
                out.add(rows[0]["grp"], block.first + i, path)
                yield from out.full()
        yield from out.rest()

    width = shuffle_width(log.sparkSession, log.count(), ROWS_PER_RANGE)
    return _with_paths(log, above, None, shape, width).mapInArrow(task, f"grp string, index long, path {PATH}")


def _downward(forest: Forest, start: DataFrame) -> DataFrame:
    """Paths of the blocks of the first round, ``grp, index, path``, from the paths of the trees' roots."""
    above = start
    for log in forest.rounds[:0:-1]:
        made = _paths(log, above, forest.shape)
        # trees that end in a lower round start there
        rest = start.join(log.select("grp").distinct(), "grp", "left_anti").select("grp", "index", "path")
        above = stored(made.unionByName(rest), "manifest-paths")
    return above


def leaf_paths(forest: Forest, start: DataFrame) -> DataFrame:
    """``grp, index, path`` of all leaves; ``start`` has the path of each tree's root (``grp, index`` 0, ``path``)."""
    return _paths(forest.rounds[0], _downward(forest, start), forest.shape)


def prove(forest: Forest, start: DataFrame, queries: DataFrame) -> DataFrame:
    """``doc_id, grp, leaf, proof_sha256, folded_root`` of query leaves ``(grp, index, doc_id, digest)``.

    ``start`` has the path of each tree's root (``grp, index`` 0, ``path``). The proof is that of the
    leaf that stands in the log; the root is folded from the query's own digest.
    """
    shape = forest.shape
    schema = pa.schema([(c, pa.string()) for c in ("grp", "leaf", "proof_sha256", "folded_root")] + [("doc_id", pa.int64())])

    @give_back
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        for rows in _blocks(batches, ("grp", "block")):
            block = _Block(rows, shape)
            leaf = {r["index"]: r["digest"] for r in rows if r["kind"] == LOG_ROW and r["level"] == 0}
            for r in rows:
                if r["kind"] == QUERY_ROW:
                    path = block.path(r["index"])
                    out.add(r["grp"], leaf[r["index"]], digest("".join(lo + hi for lo, hi in path)), fold(r["digest"], path), r["doc_id"])
            yield from out.full()
        yield from out.rest()

    log = forest.rounds[0]
    width = shuffle_width(log.sparkSession, log.count(), ROWS_PER_RANGE)
    return _with_paths(log, _downward(forest, start), queries, shape, width).mapInArrow(
        task, "grp string, leaf string, proof_sha256 string, folded_root string, doc_id long")


@dataclass(frozen=True)
class Manifest:
    """Numbered leaves, a tree per language, and the top tree over the languages' roots."""

    leaves: DataFrame      # grp, index, leaves, and the columns of the rows given
    trees: Forest
    top_leaves: DataFrame  # lang_key, index, digest
    top: Forest
    root: str | None       # None of an empty table


def make_manifest(rows: DataFrame, shape: Shape = Shape()) -> Manifest:
    """The manifest of stored leaves ``(doc_id, grp, digest, ...)``."""
    leaves = stored(number(rows, "grp", ["doc_id", "digest"]), "manifest-numbered")
    trees = grow(leaves.select("grp", "index", "leaves", "digest"), shape)
    subroots = trees.roots.select(F.lit("").alias("grp"), F.col("grp").alias("lang_key"), "digest")
    top_leaves = stored(number(subroots, "grp", ["lang_key"]), "manifest-top")
    top = grow(top_leaves.select("grp", "index", "leaves", "digest"), shape)
    root = top.roots.first()  # one row
    return Manifest(leaves, trees, top_leaves, top, root and root["digest"])


def manifest(docs: DataFrame, shape: Shape = Shape()) -> Manifest:
    """The manifest of a table: a leaf per row, trees per language, their logs (:func:`log_positions`) and the root."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), group_key(docs["lang"]).alias("grp"), leaf_digest(docs).alias("digest"))
    return make_manifest(stored(rows, "manifest-leaves"), shape)


def verify_rows(docs: DataFrame, changed: Column | None = None, changed_text: Column | None = None,
                shape: Shape = Shape()) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    The tree is that of the rows as they are. Where ``changed`` holds, the root is folded from
    the leaf that the row would have with ``changed_text``; ``verified`` tells whether it equals the root.

    Defined cases: nulls in any column are hashed as ``-`` (a null doc_id comes first in its group, a
    null language is the first group); rows of a group with an equal doc_id are ordered by their leaf, so equal
    rows stand next to each other, each with a place and a proof of its own; an empty text is not a null; a
    lone row is its own root, with the proof of no siblings; an empty table gives an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    leaf = leaf_digest(docs)
    other = leaf if changed is None else F.when(changed, leaf_digest(docs, changed_text)).otherwise(leaf)
    rows = stored(docs.select(docs["doc_id"].cast("long").alias("doc_id"), group_key(docs["lang"]).alias("grp"),
                              leaf.alias("digest"), other.alias("other")), "manifest-leaves")
    m = make_manifest(rows, shape)
    root_path = spark.range(1).select(F.lit("").alias("grp"), F.lit(0).cast("long").alias("index"), F.expr(f"cast(array() as {PATH})").alias("path"))
    named = leaf_paths(m.top, root_path).drop("grp").join(m.top_leaves.select("index", "lang_key"), "index")
    start = stored(named.select(F.col("lang_key").alias("grp"), F.lit(0).cast("long").alias("index"), "path"), "manifest-tree-paths")
    proved = prove(m.trees, start, m.leaves.select("grp", "index", "doc_id", F.col("other").alias("digest")))
    # stored roots, so that Spark knows their bytes and broadcasts them only under its own limit
    return proved.join(m.trees.roots.select("grp", F.col("digest").alias("subroot")), "grp").select(
        "doc_id", "leaf", "subroot", F.lit(m.root).cast("string").alias("root"), "proof_sha256", "folded_root",
        F.coalesce(F.col("folded_root") == F.lit(m.root).cast("string"), F.lit(False)).alias("verified"))


def op12_postorder_manifest(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return verify_rows(docs, changed, F.translate(docs["text"], UPPER, LOWER))


def _op12_sql(levels: int = 8, top_levels: int = 4, arity: int = 8) -> str:
    """Trees level by level; a finished tree's node is carried up. Up to ``arity ** levels`` rows of a language."""
    def field(name: str, value: str) -> str:
        return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(f, text if f == "text" else f) for f in FIELDS) + ")"

    def grown(name: str, n_levels: int) -> str:
        out = []
        for k in range(n_levels):
            out.append(f"""
{name}{k + 1} AS (SELECT g, i // {arity} AS i, (any_value(n) + {arity - 1}) // {arity} AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
  FROM {name}{k} GROUP BY g, i // {arity}),
{name}s{k} AS (SELECT g, i, n, coalesce(string_agg(d, '') OVER (PARTITION BY g, i // {arity} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER (PARTITION BY g, i // {arity} ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}),""")
        return "".join(out)

    steps, prev = [], "q0"
    for name, n_levels in (("t", levels), ("u", top_levels)):
        for k in range(n_levels):
            at = f"q.i // {arity ** k}" if name == "t" else f"q.j // {arity ** k}"
            g = "s.g = q.g" if name == "t" else "true"
            cur = f"{name}q{k}"
            steps.append(f"""
{cur} AS (SELECT q.* REPLACE (q.proof || s.l || s.r AS proof, CASE WHEN s.n = 1 THEN q.cur ELSE sha256(s.l || q.cur || s.r) END AS cur)
  FROM {prev} q JOIN {name}s{k} s ON {g} AND s.i = {at}),""")
            prev = cur
    crc = crc32_of("hex(encode(CAST(doc_id AS VARCHAR)))")
    return f"""
WITH {CRC_TABLE},
base AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS g, {leaf('text')} AS d,
         CASE WHEN {crc} % 3 = 0 THEN {leaf(lowered('text'))} ELSE {leaf('text')} END AS other
  FROM documents, crc_table),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, d) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM base),
t0 AS (SELECT g, i, n, d FROM numbered),{grown("t", levels)}
u0 AS (SELECT '' AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n, d, g AS lang FROM t{levels}),
{grown("u", top_levels).lstrip()}
q0 AS (SELECT b.doc_id, b.d AS leaf, b.g, b.i, u0.i AS j, u0.d AS subroot, b.other AS cur, '' AS proof FROM numbered b JOIN u0 ON u0.lang = b.g),{"".join(steps)}
root AS (SELECT d AS root FROM u{top_levels})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM {prev}, root
"""


OP12_SQL = _op12_sql()
