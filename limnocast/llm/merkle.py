"""A Merkle manifest of a corpus: a digest per row, a tree per group over the order of ids, a tree over the groups.

The place of a leaf in its group is found by rank queries, not by sorting the leaves. Per group and run of 4,096 ids there is
a bitmap of the ids that occur, kept as its non-empty blocks of 512 bits with the number of ones in each. Ids that occur
several times have bit planes: an id of multiplicity 5 stands in planes 0 and 2. The rank of an id is what the runs before
hold (a directory of sums, as a tree of bounded fanout) and what its run holds below it (sums of blocks, and a
popcount within one). Each place is then a key (group, chunk) and a slot of that chunk's array; a
chunk of 3**7 slots is reduced by seven levels in its task, and the chunks' nodes fill the slots of the next pass.
Sibling paths go down the same way, so that a leaf needs one more pass over its chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnocast.session import checkpointed

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes under one parent, and levels that a task reduces at once: a chunk has at most so many slots.
ARITY, LEVELS = 3, 7
SLOTS = ARITY**LEVELS
#: Bits of an id within its bitmap, within a block of it, and per level of the directory of sums.
RUN_BITS, BLOCK_BITS, FAN_BITS = 12, 9, 15
#: The run of null ids, before all others.
NULL_RUN = -(1 << 52)
#: Hex digits of a digest by which leaves of one id are told apart first.
PART_DIGITS = 3
#: Rows in a result batch.
OUT_ROWS = 10_000

RUN, ID = ["part_of", "run"], ["part_of", "run", "low"]


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values: list[Column]) -> Column:
    """The digest of a row as 32 bytes: of each value ``-`` if null, else its number of bytes, ``:`` and itself."""
    text = [v.cast("string") for v in values]
    told = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]
    return F.unhex(F.sha2(F.concat(*told), 256))


def height(number: int) -> int:
    """Levels above ``number`` leaves: those it takes until one node is left."""
    levels, reach = 0, 1
    while reach < number:
        levels, reach = levels + 1, reach * ARITY
    return levels


def grown(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a chunk and of ``levels`` levels above them."""
    rows = [nodes]
    for _ in range(levels):
        nodes = [digest(*nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
        rows.append(nodes)
    return rows


def siblings(rows: list[list[str]], slot: int) -> list[str]:
    """What stands left and right of a slot's node in its run, level by level (left, right, left, right, ...)."""
    path: list[str] = []
    for nodes in rows[:-1]:
        begin = slot - slot % ARITY
        path += ["".join(nodes[begin:slot]), "".join(nodes[slot + 1 : begin + ARITY])]
        slot //= ARITY
    return path


def folded(leaf: str, path: list[str]) -> str:
    for left, right in zip(path[::2], path[1::2], strict=True):
        leaf = digest(left, leaf, right)
    return leaf


def _slots(runs: list[dict]) -> list[str]:
    """The slot array of a chunk from its runs of equal nodes."""
    slots: list[str] = [""] * max(r["upto"] for r in runs)
    for r in runs:
        slots[r["first"] : r["upto"]] = [r["node"].hex()] * (r["upto"] - r["first"])
    return slots


def ranked(classes: DataFrame) -> DataFrame:
    """``classes`` with ``first``, the place of the first copy in its group, and ``total``, the size of the group.

    ``classes`` has one row per (part_of, run, low, node) with ``copies``. Copies and leaves of one id follow each
    other by digest. No window holds more rows than the fanout of the directory, the digits of a digest, or the
    leaves of one id that share those digits.
    """
    spread = classes.withColumn("digits", F.substring(F.hex("node"), 1, PART_DIGITS))
    parts = spread.groupBy(*ID, "digits").agg(F.sum("copies").alias("n"), F.count("*").alias("kinds"))
    of_id = Window.partitionBy(*ID)
    ahead = of_id.orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *ID, "digits",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"),
        F.sum("n").over(of_id).alias("copies"),
        F.sum("kinds").over(of_id).alias("kinds"),
    )
    parts = checkpointed(parts)

    # Bit planes of the multiplicities, as bitmaps of the lows of a run, cut into their non-empty blocks.
    planes = parts.where("ahead = 0").select(
        *ID, F.explode(F.expr("filter(sequence(0, int(log2(copies)) + 1), k -> (shiftright(copies, k) & 1) = 1)")).alias("plane")
    )
    bitmaps = planes.groupBy(*RUN, "plane").agg(F.bitmap_construct_agg(F.col("low").cast("long")).alias("bits"))
    size = 1 << BLOCK_BITS - 3
    cut = F.expr(
        f"filter(transform(sequence(0, {(1 << RUN_BITS - BLOCK_BITS) - 1}), b -> named_struct('block', b, 'plane', plane, "
        f"'bits', substring(bits, b * {size} + 1, {size}), 'ones', bitmap_count(substring(bits, b * {size} + 1, {size})))), x -> x.ones > 0)"
    )
    blocks = bitmaps.select(*RUN, cut.alias("blocks")).groupBy(*RUN).agg(F.flatten(F.collect_list("blocks")).alias("blocks"))
    index = blocks.withColumn("held", F.expr("aggregate(blocks, 0L, (a, x) -> a + shiftleft(x.ones, x.plane))"))
    index = checkpointed(index)
    where = f"low % {1 << BLOCK_BITS}"
    byte = f"int(conv(hex(substring(x.bits, ({where}) div 8 + 1, 1)), 16, 10))"
    inside = f"bitmap_count(substring(x.bits, 1, ({where}) div 8)) + bit_count({byte} & (shiftleft(1, low % 8) - 1))"
    below = F.expr(
        f"aggregate(blocks, 0L, (a, x) -> a + shiftleft(CASE WHEN x.block < low div {1 << BLOCK_BITS} THEN x.ones "
        f"WHEN x.block = low div {1 << BLOCK_BITS} THEN {inside} ELSE 0L END, x.plane))"
    )

    # Leaves that share an id with other leaves.
    tied = spread.join(parts.where("kinds > 1").select(*ID, "digits", "ahead"), [*ID, "digits"])
    before = Window.partitionBy(*ID, "digits").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    tied = tied.select(*ID, "node", (F.col("ahead") + F.coalesce(F.sum("copies").over(before), F.lit(0))).alias("later"))

    directory = index.join(summed(index.select(*RUN, "held")), RUN).select(*RUN, "blocks", "before", "total")
    placed = classes.join(directory, RUN).withColumn("rank", F.col("before") + below).drop("blocks", "before")
    return (
        placed.join(tied, [*ID, "node"], "left")
        .withColumn("first", F.col("rank") + F.coalesce("later", F.lit(0)))
        .drop("rank", "later")
    )


def summed(held: DataFrame) -> DataFrame:
    """``(part_of, run, before, total)``: what the runs before hold and what all hold, by a tree of bounded fanout."""
    levels, table = [], held.withColumnRenamed("run", "at")
    # Three steps of the fanout leave at most 256 nodes of the 53 bits of a run.
    for _ in range(3):
        table = table.withColumn("above", F.shiftright("at", FAN_BITS))
        levels.append(table)
        table = table.groupBy("part_of", F.col("above").alias("at")).agg(F.sum("held").alias("held"))

    def ahead(keys: list[str]) -> Column:
        order = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("held").over(order), F.lit(0))

    out = table.select("part_of", "at", ahead(["part_of"]).alias("before"), F.sum("held").over(Window.partitionBy("part_of")).alias("total"))
    for level in reversed(levels):
        local = level.withColumn("local", ahead(["part_of", "above"]))
        up = out.withColumnRenamed("at", "above")
        out = local.join(up, ["part_of", "above"]).select("part_of", "at", (F.col("before") + F.col("local")).alias("before"), "total")
    return out.withColumnRenamed("at", "run")


def _chunked(nodes: DataFrame, others: list[str]) -> DataFrame:
    """Chunks of slots: ``nodes`` has part_of, total, first, copies, node and ``others``."""
    last = F.col("first") + F.col("copies") - 1
    begin = F.col("chunk") * SLOTS
    runs = nodes.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("first") / SLOTS), F.floor(last / SLOTS))))
    first = F.greatest(F.col("first") - begin, F.lit(0)).cast("int").alias("first")
    upto = F.least(last + 1 - begin, F.lit(SLOTS)).cast("int").alias("upto")
    runs = runs.select("part_of", "total", "chunk", F.struct(first, upto, "node", *others).alias("run"))
    return runs.groupBy("part_of", "total", "chunk").agg(F.collect_list("run").alias("runs"))


def _reduced(chunks: DataFrame, done: int) -> DataFrame:
    """The top node of every chunk; ``done`` levels lie below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            top = []
            for total, runs in zip(batch["total"].to_pylist(), batch["runs"], strict=True):
                levels = min(max(height(total) - done, 0), LEVELS)
                top.append(bytes.fromhex(grown(_slots(runs.as_py()), levels)[-1][0]))
            yield pa.RecordBatch.from_arrays(
                [batch["part_of"], batch["total"], batch["chunk"], pa.array(top, pa.binary())], ["part_of", "total", "first", "node"]
            )

    return chunks.mapInArrow(run, "part_of string, total long, first long, node binary")


def climbed(chunks: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The chunks of every pass, and the one node left of each ``part_of``."""
    passes = [checkpointed(chunks)]
    largest = passes[0].agg(F.max("total")).first()[0] or 0
    while True:
        nodes = _reduced(passes[-1], LEVELS * (len(passes) - 1)).withColumn("copies", F.lit(1))
        if largest <= SLOTS ** len(passes):
            return passes, checkpointed(nodes.select("part_of", "node"))
        passes.append(checkpointed(_chunked(nodes, [])))


def _emit(chunks: DataFrame, paths: DataFrame, done: int, schema: str, rows: Callable) -> DataFrame:
    """``rows(part_of, chunk, subroot, runs, levels, path)`` of every chunk, whose path above is in ``paths``."""
    joined = chunks.join(paths, ["part_of", "chunk"])
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) or [[]] * len(names)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in batch.schema.names}
                above = grown(_slots(row["runs"]), min(max(height(row["total"]) - done, 0), LEVELS))
                for one in rows(row, above):
                    held.append(one)
                    if len(held) >= OUT_ROWS:
                        yield flush()
        yield flush()

    return joined.mapInArrow(run, schema)


def descended(passes: list[DataFrame], top: DataFrame) -> DataFrame:
    """``(part_of, chunk, subroot, path)`` of the chunks of the first pass; ``top`` has the same of the last pass."""
    paths = top

    def children(row: dict, above: list[list[str]]) -> Iterator[tuple]:
        for slot in range(len(above[0])):
            yield row["part_of"], row["chunk"] * SLOTS + slot, row["subroot"], siblings(above, slot) + row["path"]

    for at in range(len(passes) - 1, 0, -1):
        schema = "part_of string, chunk long, subroot string, path array<string>"
        paths = _emit(passes[at], paths, LEVELS * at, schema, children)
    return paths


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    changed: dict[str, Column] | None = None,
    with_path: bool = False,
) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, source, place[, path])`` for each row.

    Leaves are digests of ``fields``. Those of one ``group_col`` ascend by ``id_col``; every three consecutive nodes become
    one, until the group's subroot is left, and the subroots by group (null first, then by bytes) likewise give the root.
    ``proof_sha256`` is the digest of all siblings up to the root, and ``path`` holds them, left and right of each
    level. ``changed`` gives other values of some fields; ``folded_root`` is what the leaf of those gives with
    the siblings of the original, and ``verified`` whether that is the root.

    Null ids come before all others. Rows of one id follow each other by digest; repeated rows are leaves of their own
    at consecutive places, held as one run with a count until the last pass. A null in any field is a ``-``; empty texts
    count 0 bytes. An empty table gives an empty result. Other columns are not read.
    """
    number = F.col(id_col).cast("long")
    rows = docs.select(
        F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col(group_col).cast("string"))).alias("part_of"),
        F.coalesce(F.shiftright(number, RUN_BITS), F.lit(NULL_RUN)).alias("run"),
        F.coalesce(number.bitwiseAND((1 << RUN_BITS) - 1), F.lit(0)).cast("int").alias("low"),
        leaf_of([F.col(c) for c in fields]).alias("node"),
        leaf_of([(changed or {}).get(c, F.col(c)) for c in fields]).alias("bad"),
    )
    classes = rows.groupBy(*ID, "node", F.when(F.col("bad") != F.col("node"), F.col("bad")).alias("bad")).agg(F.count("*").alias("copies"))
    placed = ranked(checkpointed(classes))
    key = F.when(F.col("run") != NULL_RUN, F.shiftleft("run", RUN_BITS) + F.col("low")).alias("key")
    passes, subroots = climbed(_chunked(placed.select("part_of", "total", "first", "copies", "node", "bad", key), ["bad", "key"]))

    # Groups in the order of their names: sorted ranges, and the number of groups in the ranges before.
    dealt = subroots.repartitionByRange("part_of").sortWithinPartitions("part_of")
    dealt = dealt.select("part_of", "node", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at"))
    dealt = checkpointed(dealt)
    ranges = dealt.groupBy("range").agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(0))
    upto = every.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("range", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"), F.sum("n").over(every).alias("total"))
    place = F.col("at").bitwiseAND((1 << 33) - 1) + F.col("before")
    groups = dealt.join(ranges, "range").select(
        F.lit("").alias("part_of"), "total", place.alias("first"), F.lit(1).alias("copies"), "node", F.col("part_of").alias("name")
    )
    tops, last = climbed(_chunked(groups, ["name"]))
    found = last.first()
    root = found["node"].hex() if found else ""

    empty = F.array().cast("array<string>").alias("path")
    above = descended(tops, tops[-1].select("part_of", "chunk", F.lit(root).alias("subroot"), empty))

    def heads(row: dict, levels: list[list[str]]) -> Iterator[tuple]:
        for run in row["runs"]:
            yield run["name"], 0, run["node"].hex(), siblings(levels, run["first"]) + row["path"]

    schema = "part_of string, chunk long, subroot string, path array<string>"
    paths = descended(passes, _emit(tops[0], above, 0, schema, heads))

    def leaves(row: dict, levels: list[list[str]]) -> Iterator[tuple]:
        group = row["part_of"][1:] if row["part_of"] else None
        for run in row["runs"]:
            leaf = run["node"].hex()
            own = run["bad"].hex() if run["bad"] is not None else leaf
            for slot in range(run["first"], run["upto"]):
                path = siblings(levels, slot) + row["path"]
                got = folded(own, path)
                out = (run["key"], leaf, row["subroot"], root, digest(*path), got, got == root, group, row["chunk"] * SLOTS + slot)
                yield (*out, path) if with_path else out

    schema = (
        f"{id_col} long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        f"verified boolean, {group_col} string, place long" + (", path array<string>" if with_path else "")
    )
    return _emit(passes[0], paths, 0, schema, leaves)
