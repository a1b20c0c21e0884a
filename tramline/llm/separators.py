"""Token counts of documents from flat token files that have no index: a scan for the end-of-document id.

A file is a sequence of blocks of token ids; documents run on across blocks. Every block is searched in one
vectorised pass and summed up by three numbers: its separators, its tokens, and the tokens behind its last separator.
A prefix scan of those numbers over the blocks of a shard, and of the shards' totals, gives each block what is open
when it begins, so every document is counted where it ends, without reading a block twice or moving it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows, stage
from tramline.llm.wordids import WordIds

BLOCK = 1 << 19  # tokens of a block


def flat_blocks(found: Iterator[tuple], width: int, block: int) -> Iterator[tuple]:
    """Sorted rows ``(shard, key, ids)`` to ``(shard, block, tokens)``, cut wherever a block is full."""
    shard, number, held = None, 0, bytearray()
    size = block * width
    for own, _, ids in found:
        if own != shard:
            if held:
                yield shard, number, bytes(held)
            shard, number, held = own, 0, bytearray()
        held += ids
        while len(held) >= size:
            yield shard, number, bytes(held[:size])
            number += 1
            del held[:size]
    if held:
        yield shard, number, bytes(held)


def write_flat(
    docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame, int]:
    """Flat token files of all texts, one for each task that reads them; the keys in their order; bytes per id.

    Texts stay in the order they are read in, so nothing is shuffled. The end id must not be an id of any text. Null
    and empty texts are a lone end id.
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    width = WordIds(content).dtype.itemsize
    sent = docs.sparkSession.sparkContext.broadcast(content)  # as large as the vocabulary, whatever the input
    kind = docs.schema[key].dataType.simpleString()

    def rows(found):
        words = WordIds(sent.value)
        last = np.array([end], words.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        listed: list[tuple] = []  # lists of keys, which leave between the blocks

        def noted():
            first, keys = 0, []
            for (name,), ids in words.encode_all(found):
                if len(keys) == 10_000:
                    listed.append((shard, None, None, first, keys))
                    first, keys = first + len(keys), []
                keys.append(name)
                yield shard, name, ids + last
            if keys:
                listed.append((shard, None, None, first, keys))

        for own, number, tokens in flat_blocks(noted(), width, BLOCK):
            yield own, number, tokens, None, None
            yield from listed
            listed.clear()
        yield from listed

    both = stage(
        arrow_rows(docs.select(key, text), rows, f"shard int, block int, tokens binary, first long, keys array<{kind}>"), "flat"
    )
    names = both.where("keys is not null").select(
        "shard", "first", F.posexplode("keys").alias("_place", key)
    ).select("shard", (F.col("first") + F.col("_place")).alias("place"), key)
    return both.where("tokens is not null").select("shard", "block", "tokens"), names, width


def count_tokens(blocks: DataFrame, end: int, width: int) -> DataFrame:
    """``shard, place, start, n_tokens`` of every document of a flat file ``(shard, block, tokens)``.

    ``place`` numbers the documents of a shard, ``start`` is the first token's place among all tokens, ``n_tokens``
    leaves the separator out. Tokens behind a shard's last separator are a document too. Empty files have none.
    """

    def rows(found):
        for shard, block, tokens in found:
            ids = np.frombuffer(tokens, f"<u{width}")
            yield shard, block, len(ids), np.flatnonzero(ids == end).tolist()

    # only the separators' places go on, not the tokens
    seen = arrow_rows(blocks, rows, "shard int, block int, _n long, _at array<int>")
    within = Window.partitionBy("shard").orderBy("block")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    # prefix scan: tokens and separators before each block, and where the last separator before it stood
    seen = seen.select(
        "*",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.coalesce(F.sum(F.size("_at")).over(earlier), F.lit(0)).alias("_place"),
        (F.lead("block").over(within).isNull()).alias("_last"),
    )
    seen = seen.withColumn(
        "_open", F.coalesce(F.max(F.col("_before") + F.get("_at", F.size("_at") - 1)).over(earlier) + 1, F.lit(0))
    )
    # what stands behind a shard's last separator ends with the shard
    closed = F.when(F.size("_at") > 0, F.get("_at", F.size("_at") - 1) + 1).otherwise(F.col("_open") - F.col("_before"))
    rest = F.col("_last") & (closed < F.col("_n"))
    stops = F.when(rest, F.concat("_at", F.array(F.col("_n").cast("int")))).otherwise(F.col("_at"))
    shards = blocks.select("shard", (F.length("tokens") / width).cast("long").alias("_n")).groupBy("shard").agg(
        F.sum("_n").alias("_all")
    )
    sums = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    shards = shards.select("shard", F.coalesce(F.sum("_all").over(sums), F.lit(0)).alias("_base"))
    each = seen.select("shard", "_before", "_place", "_open", stops.alias("_stops")).select(
        "shard",
        "_before",
        "_place",
        "_open",
        F.posexplode(
            F.transform(
                "_stops",
                lambda stop, i: F.struct(
                    F.when(i == 0, F.col("_open"))
                    .otherwise(F.col("_before") + F.get("_stops", i - 1) + 1)
                    .alias("from"),
                    (F.col("_before") + stop).alias("to"),
                ),
            )
        ).alias("_i", "_doc"),
    )
    return each.join(shards, "shard").select(
        "shard",
        (F.col("_place") + F.col("_i")).alias("place"),
        (F.col("_base") + F.col("_doc.from")).alias("start"),
        (F.col("_doc.to") - F.col("_doc.from")).alias("n_tokens"),
    )


def document_counts(docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the flat files, scan them, and give ``key, start, n_tokens`` per document."""
    blocks, names, width = write_flat(docs, tokenizer, end, key, text)
    return count_tokens(blocks, end, width).join(names, ["shard", "place"]).select(key, "start", "n_tokens")
