"""Exact duplicates by radix tries: equal texts are found by comparing them whole.

Texts with the same length and content hash form a partition; within it every full byte string is
inserted into a compressed radix trie (Patricia trie) whose terminal nodes hold the owner, the row
that stays. Two rounds keep hot texts apart from single tasks:

1. Each Arrow batch (bounded by Spark in rows and bytes) inserts its own texts; of equal texts one
   representative with their number goes on. A text that is a third of all rows leaves a batch as
   one row. The outcome is written to the shared folder, so nothing later repeats it differently.
2. Representatives whose length and hash occur again are dealt out by these, sorted by length, hash,
   bytes and owner, and inserted into one trie per length and hash. As the byte strings arrive in
   order, a subtree left behind can never receive another string: it is dropped at once and its
   owners have been written out. Memory holds the path to the newest string, whatever the group.

Texts move only where their length and hash occur again: bits of these are sent to the tasks, and a text
without its bit stays where it is. So do the rows that stay, when those that go are taken out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .common import maybe_among, returning


class Node:
    """A trie node: the bytes on the edge to it, children by first byte, and the owner's place."""

    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: int | None = None):
        self.label, self.owner = label, owner
        self.children: dict[int, Node] = {}


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by bisection over slices that compare at memory speed."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Byte strings to owners. ``ordered`` drops every subtree that a sorted insertion leaves."""

    def __init__(self, ordered: bool = False):
        self.root, self.ordered = Node(b""), ordered

    def insert(self, text: bytes, owner: int) -> int:
        """The owner of an equal string inserted before, else ``owner``, which is then stored."""
        node, rest = self.root, text
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                if self.ordered:
                    node.children.clear()
                child = node.children[rest[0]] = Node(rest, owner)
                return owner
            cut = shared_prefix(child.label, rest)
            if cut < len(child.label):
                upper = Node(child.label[:cut])
                child.label = child.label[cut:]
                upper.children[child.label[0]] = child
                node.children[rest[0]] = child = upper
            node, rest = child, rest[cut:]
        if node.owner is None:
            node.owner = owner
        return node.owner


def _number(value) -> tuple:
    """Order of identifiers: null below all numbers."""
    return (value is not None, value or 0)


BATCH_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("rep_row", T.LongType()),
        T.StructField("rep_id", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_sha", T.BinaryType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("hash", T.LongType()),
        T.StructField("copies", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)


def _batch_owners(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """Insert one batch into a trie per length and hash; representatives keep text and count."""
    rows = batch.column("row_id").to_pylist()
    ids = batch.column("doc_id").to_pylist()
    lengths = batch.column("n_bytes").to_pylist()
    hashes = batch.column("hash").to_pylist()
    texts = batch.column("text")
    single: dict[tuple, int] = {}
    tries: dict[tuple, RadixTrie] = {}
    first = list(range(len(rows)))  # place of the first row with the same text
    for place, key in enumerate(zip(lengths, hashes)):
        if key not in single:
            single[key] = place
            continue
        if key not in tries:
            tries[key] = RadixTrie()
            tries[key].insert(texts[single[key]].as_py().encode(), single[key])
        first[place] = tries[key].insert(texts[place].as_py().encode(), place)
    best: dict[int, int] = {}
    copies: dict[int, int] = {}
    for place, owner in enumerate(first):
        copies[owner] = copies.get(owner, 0) + 1
        held = best.get(owner, place)
        best[owner] = max(held, place, key=lambda p: (_number(ids[p]), rows[p]))
    reps = [best[owner] for owner in first]
    is_rep = pa.array([rep == place for place, rep in enumerate(reps)])
    count = pa.array([copies[owner] if best[owner] == place else None for place, owner in enumerate(first)], pa.int64())
    kept_text = pc.if_else(is_rep, texts, pa.scalar(None, texts.type))
    return {
        "rep_row": pa.array([rows[r] for r in reps], pa.int64()),
        "rep_id": pa.array([ids[r] for r in reps], pa.int64()),
        "copies": count,
        "text": kept_text,
    }


def _first_round(payload: T.StructType | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in BATCH_SCHEMA] + (["payload"] if payload is not None else [])
        for batch in batches:
            if batch.num_rows:
                made = _batch_owners(batch)
                yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(n) for n in names], names=names)

    return run


def _second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted representatives: the first of equal texts has the largest identifier and owns them."""
    key, trie = None, RadixTrie(ordered=True)
    for batch in batches:
        rows = batch.column("row_id").to_pylist()
        owners, owner_ids = [], []
        ids = batch.column("doc_id").to_pylist()
        for place, new in enumerate(zip(batch.column("n_bytes").to_pylist(), batch.column("hash").to_pylist())):
            if new != key:
                key, trie = new, RadixTrie(ordered=True)
            owner = trie.insert(batch.column("text")[place].as_py().encode(), (rows[place], ids[place]))
            owners.append(owner[0])
            owner_ids.append(owner[1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), pa.array(owners, pa.int64()), pa.array(owner_ids, pa.int64())],
            names=["rep_row", "owner_row", "owner_id"],
        )


def _met(docs: DataFrame, id_col: str, text_col: str, carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """All rows with their representative, and the owners of representatives whose length and hash occur again."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_sha"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("hash"),
        *([F.struct(*carried).alias("payload")] if carried else []),
    )
    payload = rows.schema["payload"].dataType if carried else None
    schema = T.StructType(BATCH_SCHEMA.fields + ([T.StructField("payload", payload)] if carried else []))
    stored = materialise(rows.mapInArrow(returning(_first_round(payload)), schema), "exact-batches")

    reps = stored.filter("copies is not null")
    again = reps.groupBy("n_bytes", "hash").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    again = materialise(again, "exact-again")
    texts = maybe_among(reps.select("row_id", "doc_id", "n_bytes", "hash", "text"), "hash", again.select("hash"))
    met = (
        texts.filter("_maybe").drop("_maybe").join(again, ["n_bytes", "hash"], "left_semi")
        .repartition("n_bytes", "hash")
        .sortWithinPartitions("n_bytes", "hash", "text", F.desc_nulls_last("doc_id"), F.desc("row_id"))
        .mapInArrow(_second_round, "rep_row long, owner_row long, owner_id long")
    )
    return stored, met


def _owners(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows with their representative, and the representatives with owner and group size."""
    stored, met = _met(docs, id_col, text_col, [])
    reps = stored.filter("copies is not null")
    owned = (
        reps.select(F.col("row_id").alias("rep_row"), F.col("doc_id").alias("rep_id"), "copies")
        .join(met, "rep_row", "left")
        .select(
            "rep_row",
            "copies",
            F.coalesce("owner_row", "rep_row").alias("owner_row"),
            F.when(F.col("owner_row").isNull(), F.col("rep_id")).otherwise(F.col("owner_id")).alias("owner_id"),
        )
    )
    owned = owned.withColumn("group_size", F.sum("copies").over(Window.partitionBy("owner_row")))
    return stored, owned


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the row of equal texts that stays, and the size of the group.

    Columns: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. A null text equals
    the empty one. Of equal texts the largest identifier stays; a null identifier is below every
    number; among repeated rows with the same identifier exactly one is kept. Texts may be of any
    length. An empty table gives an empty result; other columns are ignored.
    """
    stored, owned = _owners(docs, id_col, text_col)
    members = stored.select("row_id", "rep_row", "doc_id", "text_sha")
    return members.join(owned.drop("copies"), "rep_row").select(
        "doc_id",
        F.col("owner_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row_id") == F.col("owner_row")).alias("kept"),
        F.lower(F.hex("text_sha")).alias("text_sha256"),
    )


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns.

    A kept row with a null text comes back with the empty text it counts as.
    """
    carried = [c for c in docs.columns if c != text_col]
    stored, met = _met(docs, id_col, text_col, carried)
    # Of each batch's representatives those go that another one owns; the others' texts stay where they are.
    gone = materialise(met.filter("owner_row <> rep_row").select(F.col("rep_row").alias("row_id")), "exact-gone")
    reps = maybe_among(stored.filter("copies is not null").select("row_id", "text", *["payload"] * bool(carried)), "row_id", gone)
    kept = reps.filter("NOT _maybe").unionByName(reps.filter("_maybe").join(gone, "row_id", "left_anti"))
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("payload")[c].alias(c) for c in docs.columns])
