"""Operator 13, a Merkle manifest of a data set by bitmap-rank indexing.

Every row is a leaf: the SHA-256 of its columns.  Per group, the leaves stand in ascending order of their id, every
eight consecutive nodes become their hash until one is left, and the groups' last nodes, ordered by group, are
joined to one root in the same way.

Where a leaf stands is a rank query, not a sort.  A group's ids are a compressed bitmap: one row for each 64-bit
word that has a bit (``bit_or`` of the ids' bits, merged before and after one shuffle).  A directory over the words adds up their
counts in three steps of 16 id bits, so none of its windows is wider than 65,536 rows, whatever a group holds.  An id's
place is its word's count of earlier ids and the popcount of the bits below its own.

From there on only positions count: a node at place p is slot p mod 512 of the array keyed by p div 512.  One
shuffle fills the arrays, which take three levels at once, so levels shrink by 512 a round; paths
come down the same arrays again, with each member's siblings to its left and right.

Defined results: every row is a leaf, repeated rows included; a null id comes after all others; rows of equal id
are ordered by their leaves (by the same ranks, of the digest), equal rows arbitrarily; a null group comes first and is
a group of its own; null values are written as ``-``; a row with a null id is not tampered with; the
proof of a leaf without any sibling is the hash of nothing; an empty table gives an empty result; only the
five named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearwatch.llm.common import byte_column, checkpointed, map_batches

FAN = 8
LEVELS = 3  # that one array holds
BLOCK = FAN**LEVELS
_WORD = 6  # id bits in a word of the bitmap
_STEP = 16  # id bits of a step of the directory
_SALT = 16  # parts that the rows of one word are dealt to if ids repeat
_LAST = (1 << 63) - 1  # stands for a missing id


def leaf_hashes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", group_col: str = "lang",
                number_col: str = "n_chars", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang``, ``leaf`` and ``changed``: the leaf of the row with A-Z of its text lower-cased, where 3
    divides the CRC-32 of its id (else ``leaf``)."""

    def field(value: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    doc = F.col(id_col).cast("bigint")
    # all but the text's bytes in front of them: they go through the hash as they are
    head = F.concat(field(doc.cast("string")), field(F.col(source_col)), field(F.col(group_col)),
                    field(F.col(number_col).cast("string")),
                    F.coalesce(F.concat(F.octet_length(text_col).cast("string"), F.lit(":")), F.lit("-")))
    tampered = F.coalesce(F.crc32(doc.cast("string")) % 3 == 0, F.lit(False))
    source = docs.select(doc.alias("doc_id"), F.col(group_col).alias("lang"), head.alias("head"), tampered.alias("tampered"),
                         F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = byte_column(batch.column(4))
            text, ends = memoryview(data), ends.tolist()
            leaves, changed = [], []
            for head, tampered, a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), ends, ends[1:]):
                begun = hashlib.sha256(head.encode())
                other = begun.copy() if tampered else None
                begun.update(text[a:b])
                leaves.append(begun.hexdigest())
                if other is not None:
                    other.update(bytes(text[a:b]).lower())  # of bytes, lower() takes A-Z only
                changed.append(leaves[-1] if other is None else other.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaves, pa.string()),
                                              pa.array(changed, pa.string())], ["doc_id", "lang", "leaf", "changed"])

    return map_batches(source, run, "doc_id bigint, lang string, leaf string, changed string")


def _directory(counts: DataFrame, group: Sequence[str], key: str, bits: int) -> DataFrame:
    """``counts`` (group, ``key``, ``n``) with ``before``, the sum of ``n`` over smaller keys of the group, and
    ``of``, that over all; keys have ``bits`` bits."""
    if bits <= _STEP:
        whole = Window.partitionBy(*group)
        return counts.withColumn("of", F.sum("n").over(whole)).withColumn(
            "before", F.sum("n").over(whole.orderBy(key)) - F.col("n"))
    above = f"{key}_"
    counts = counts.withColumn(above, F.shiftright(key, _STEP))
    upper = _directory(counts.groupBy(*group, above).agg(F.sum("n").alias("n")), group, above, bits - _STEP)
    inside = F.sum("n").over(Window.partitionBy(*group, above).orderBy(key)) - F.col("n")
    upper = upper.select(*group, above, "of", F.col("before").alias("start"))
    return counts.withColumn("inside", inside).join(upper, [*group, above]).withColumn(
        "before", F.col("start") + F.col("inside")).drop("inside", "start", above)


def with_ranks(rows: DataFrame, group: Sequence[str], number: str) -> DataFrame:
    """``rows`` (checkpointed) with ``rank``: how many rows of their group have a smaller ``number``; ``of``, the
    group's rows; and ``copies``, those of the same number.  No nulls in ``group`` or ``number``."""
    word, bit = F.shiftright(number, _WORD), F.col(number).bitwiseAND(F.lit((1 << _WORD) - 1)).cast("int")
    one = F.expr(f"shiftleft(1L, cast({number} & {(1 << _WORD) - 1} as int))")
    bitmap = rows.groupBy(*group, word.alias("word")).agg(F.bit_or(one).alias("bits"), F.count(F.lit(1)).alias("n"))
    words = checkpointed(_directory(bitmap, group, "word", 64 - _WORD))
    many = words.where(F.col("n") > F.bit_count("bits"))
    lower = F.expr(f"~shiftleft(-1L, cast({number} & {(1 << _WORD) - 1} as int))")
    below = F.col("before") + F.bit_count(F.col("bits").bitwiseAND(lower))
    keys = [*group, "word"]
    if many.isEmpty():
        return rows.withColumn("word", word).join(words.drop("n"), keys).select(
            *rows.columns, below.alias("rank"), "of", F.lit(1).cast("bigint").alias("copies"))
    # a bitmap counts an id once: words with repeated ids (64 at most each) also carry how often they come
    again = rows.withColumn("word", word).join(many.select(*keys), keys, "left_semi").groupBy(
        *keys, bit.alias("bit")).agg((F.count(F.lit(1)) - 1).alias("more")).where("more > 0")
    words = words.join(again.groupBy(*keys).agg(F.collect_list(F.struct("bit", "more")).alias("more")), keys, "left")
    words = words.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALT - 1)))).drop("n")
    dealt = rows.withColumns({"word": word, "salt": F.pmod(F.monotonically_increasing_id(), F.lit(_SALT)).cast("int")})
    summed = "aggregate(filter(coalesce(more, array()), m -> m.bit {op} cast(%s & %d as int)), 0L, (s, m) -> s + m.more)" % (
        number, (1 << _WORD) - 1)
    return dealt.join(words, [*keys, "salt"]).select(
        *rows.columns, (below + F.expr(summed.format(op="<"))).alias("rank"), "of",
        (F.expr(summed.format(op="=")) + 1).alias("copies"))


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (checkpointed) with ``g`` (the group's name that sorts as it should), ``at``, their place in the
    group from 0, and ``of``, the group's size."""
    named = leaves.withColumns({"g": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")),
                                "number": F.coalesce("doc_id", F.lit(_LAST))})
    ranked = checkpointed(with_ranks(named, ["g"], "number"))
    single = ranked.where("copies = 1").drop("copies").withColumnRenamed("rank", "at")
    repeated = ranked.where("copies > 1").drop("copies").withColumnRenamed("rank", "at")
    if repeated.isEmpty():
        return single.drop("number")
    # rows of one id: by the digest's first 60 bits, those without an id last
    digest = F.conv(F.substring("leaf", 1, 15), 16, 10).cast("bigint") + F.when(
        F.col("doc_id").isNull(), F.lit(1 << 60)).otherwise(F.lit(0)).cast("bigint")
    repeated = checkpointed(repeated.withColumnRenamed("of", "whole").withColumn("digest", digest))
    ranked = checkpointed(with_ranks(repeated, ["g", "number"], "digest"))
    ranked = ranked.withColumn("at", F.col("at") + F.col("rank")).drop("rank", "of").withColumnRenamed("whole", "of")
    # rows of one digest are equal: they are counted by the part of the table they lie in
    part = checkpointed(ranked.where("copies > 1").drop("copies").withColumn("part", F.spark_partition_id()))
    keys = ["g", "number", "digest", "leaf", "part"]
    counts = part.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    start = F.sum("n").over(Window.partitionBy("g", "number", "digest").orderBy("leaf", "part")) - F.col("n")
    numbered = part.withColumn("turn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) - 1)
    numbered = numbered.join(counts.withColumn("start", start).drop("n"), keys).withColumn(
        "at", F.col("at") + F.col("start") + F.col("turn"))
    return (single.drop("number").unionByName(ranked.where("copies = 1").select(*single.drop("number").columns))
            .unionByName(numbered.select(*single.drop("number").columns)))


def _joined(nodes: str) -> str:
    return f"sha2(array_join({nodes}, ''), 256)"


def slot_arrays(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``g``, ``at``, ``of``, ``node`` and others) as arrays: ``g``, ``block``, ``of``, ``parent`` (the node
    that the array comes to) and ``members``, each with ``path``: its siblings to the left and right, level by level."""
    own = [c for c in nodes.columns if c not in ("g", "of")]
    blocks = nodes.groupBy("g", F.expr(f"at div {BLOCK}").alias("block")).agg(
        F.max("of").alias("of"), F.sort_array(F.collect_list(F.struct("at", *(c for c in own if c != "at")))).alias("members"))
    blocks = blocks.withColumn("l0", F.expr("transform(members, m -> m.node)")).withColumn("depth", F.expr(
        "CASE WHEN of <= 1 THEN 0 " + " ".join(f"WHEN of <= {FAN**k} THEN {k}" for k in range(1, LEVELS)) + f" ELSE {LEVELS} END"))
    for level in range(1, LEVELS + 1):  # a level is only hashed while the group has several nodes on the one below
        runs = f"transform(sequence(0, (size(l{level - 1}) - 1) div {FAN}), i -> " + _joined(
            f"slice(l{level - 1}, {FAN} * i + 1, {FAN})") + ")"
        blocks = blocks.withColumn(f"l{level}", F.expr(f"CASE WHEN depth >= {level} THEN {runs} ELSE l{level - 1} END"))
    pairs = []
    for level in range(LEVELS):
        slot = f"cast((m.at % {BLOCK}) div {FAN**level} as int)"
        first = f"({slot} div {FAN}) * {FAN}"
        left = f"array_join(slice(l{level}, {first} + 1, {slot} % {FAN}), '')"
        right = f"array_join(slice(l{level}, {slot} + 2, {FAN - 1} - {slot} % {FAN}), '')"
        pairs.append(f"named_struct('left', {left}, 'right', {right})")
    kept = ", ".join(f"m.{c} as {c}" for c in own)
    member = f"struct({kept}, slice(array({', '.join(pairs)}), 1, depth) as path)"
    return blocks.select("g", "block", "of", F.expr(f"l{LEVELS}[0]").alias("parent"),
                         F.expr(f"transform(members, m -> {member})").alias("members"))


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """The rounds of arrays, from ``nodes`` to those with one node a group."""
    rounds = []
    while True:
        rounds.append(checkpointed(slot_arrays(nodes)))
        if rounds[-1].where(F.col("of") > BLOCK).isEmpty():
            return rounds
        nodes = rounds[-1].select("g", F.col("block").alias("at"), F.expr(f"(of - 1) div {BLOCK} + 1").alias("of"),
                                  F.col("parent").alias("node"))


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The members of the first round with their whole paths; ``above``: ``g``, ``upper`` (path of the group's last node) and others."""
    others = [c for c in above.columns if c not in ("g", "upper")]
    for number, arrays in reversed(list(enumerate(rounds))):
        down = arrays.join(above, ["g"] if number == len(rounds) - 1 else ["g", "block"])
        down = down.select("g", *others, "upper", F.inline("members"))
        path = F.concat("path", "upper").alias("upper")
        if number:
            above = down.select("g", F.col("at").alias("block"), path, *others)
        else:
            return down.select(*(c for c in down.columns if c not in ("path", "upper")), path)
    raise ValueError("no rounds")


def _numbered_groups(tops: DataFrame) -> DataFrame:
    """``tops`` (``g``, ``node``) with their place in the order of ``g``; a range of groups to a task."""
    ordered = checkpointed(tops.orderBy("g")).withColumn("part", F.spark_partition_id())
    sizes = {r.part: r["count"] for r in ordered.groupBy("part").count().collect()}  # one row a task
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    if not starts:
        return ordered.select("g", "node", F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("of"))
    start = F.broadcast(ordered.sparkSession.createDataFrame(starts, "part int, start bigint"))
    turn = F.row_number().over(Window.partitionBy("part").orderBy("g")) - 1
    return ordered.withColumn("turn", turn).join(start, "part").select(
        "g", "node", (F.col("start") + F.col("turn")).alias("at"), F.lit(total).cast("bigint").alias("of"))


def merkle_manifest(docs: DataFrame, **columns: str) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified`` and ``path``
    (the siblings as (left, right), level by level) of every row of ``docs``; ``columns`` as of ``leaf_hashes``."""
    leaves = checkpointed(leaf_hashes(docs, **columns))
    rounds = _climb(placed(leaves).withColumnRenamed("leaf", "node"))
    tops = checkpointed(_numbered_groups(rounds[-1].select("g", F.col("parent").alias("node"))))
    over = _climb(tops.select(F.lit("").alias("g"), "at", "of", "node", F.col("g").alias("name")))
    root = over[-1].select("g", F.col("parent").alias("root"))  # one row
    empty = F.array().cast("array<struct<left:string,right:string>>")
    groups = _descend(over, root.withColumn("upper", empty)).select(
        F.col("name").alias("g"), F.col("node").alias("subroot"), "root", "upper")
    found = _descend(rounds, groups)
    folded = F.expr("aggregate(upper, changed, (node, step) -> sha2(concat(step.left, node, step.right), 256))")
    proof = F.expr(_joined("transform(upper, step -> concat(step.left, step.right))"))
    return found.withColumn("folded_root", folded).select(
        "doc_id", "lang", F.col("node").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), F.col("upper").alias("path"))
