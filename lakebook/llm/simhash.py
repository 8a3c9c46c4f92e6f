"""SimHash near-dedup: fingerprints, links within a bit distance, components.

A fingerprint takes the majority of each bit over the XXH64 hashes of a text's word
shingles. Fingerprints that differ in few bits are linked through BK-trees: a tree's
children hang at their Hamming distance to the parent, and a search follows only edges
within the radius. No tree holds all fingerprints. Two that differ in at most three
bits agree in one of four 16-bit blocks and, in the other 48 bits, in one of four 12-bit
blocks; so each distinct fingerprint goes to 16 shards by those 28 bits, which hold its
every partner. A shard's tree is sent to the tasks that ask it, and to no others: shards
of over ``SHARD`` members are cut into pieces, and a task meets one piece as a tree and
one as queries. Nothing is gathered by the driver.

Trees report what the components need: a member's link to every tree component that it
reaches, which joins the same fingerprints as all pairs would. Equal fingerprints are
one node from the start, so copies cost nothing.

Defined cases. Null, empty and blank texts: fingerprint zero, linked like any other.
Fewer words than a shingle: the whole sequence is the only shingle. Null ids take part;
a component's id is its smallest id that is not null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebook.llm.components import connected_components
from lakebook.llm.shared import Scratch, all_columns, lookup, releasing, small_batches, stored

SHINGLE, RADIUS, SEED = 3, 3, 42
SHARD = 1024
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text; a bit is set in over half the hashes."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(flat, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hash_one = xxhash.xxh64_intdigest
        hashes = [
            hash_one(flat[a:b], SEED)
            for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        ]
    held = np.array(hashes, dtype="<u8")
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(held), 1 << 16):
        part = held[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * total > len(held), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text.cast("binary"))


class BKTree:
    """Fingerprints under their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.root: list[int] = []  # of each node's component, by node
        self.count = 0

    def _find(self, node: int) -> int:
        while self.root[node] != node:
            self.root[node] = self.root[self.root[node]]
            node = self.root[node]
        return node

    def reached(self, value: int, radius: int) -> set[int]:
        """The components with a node within the radius; stops once it has them all."""
        found: set[int] = set()
        stack = [0] if self.values else []
        while stack:
            node = stack.pop()
            distance = (value ^ self.values[node]).bit_count()
            if distance <= radius:
                found.add(self._find(node))
                if len(found) == self.count:
                    break
            for edge, child in self.children[node].items():
                if distance - radius <= edge <= distance + radius:
                    stack.append(child)
        return found

    def add(self, value: int, radius: int) -> None:
        met = self.reached(value, radius)
        node = len(self.values)
        if node:
            at = 0
            while True:
                edge = (value ^ self.values[at]).bit_count()
                if edge not in self.children[at]:
                    self.children[at][edge] = node
                    break
                at = self.children[at][edge]
        self.values.append(value)
        self.children.append({})
        self.root.append(min(met, default=node))
        for other in met:
            self.root[other] = self.root[node]
        self.count += 1 - len(met)

    def links(self) -> Iterator[tuple[int, int]]:
        for node, value in enumerate(self.values):
            root = self._find(node)
            if root != node:
                yield value, self.values[root]


def _shards(fingerprint_column: str) -> Column:
    """The 16 shard keys: block number, its 16 bits, and 12 bits of the rest."""
    keys = []
    for block in range(4):
        low = 16 * block
        own = f"(shiftrightunsigned({fingerprint_column}, {low}) & 65535L)"
        # The bits above the block move down over it.
        above = "0L" if block == 3 else f"shiftleft(shiftrightunsigned({fingerprint_column}, {low + 16}), {low})"
        rest = f"({above} | ({fingerprint_column} & {(1 << low) - 1}L))"
        for part in range(4):
            twelve = f"(shiftrightunsigned({rest}, {12 * part}) & 4095L)"
            keys.append(f"shiftleft({4 * block + part}L, 28) | shiftleft({own}, 12) | {twelve}")
    return F.expr(f"array({', '.join(keys)})")


def _search(radius: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by shard, tree members first."""
        tree, shard, out = BKTree(), None, []
        for batch in batches:
            batch["fp"] = batch["fp"].to_numpy().view(np.uint64)  # bits, not a sign
            columns = [batch[c].tolist() for c in ("key", "t", "u", "asks", "fp")]
            for key, t, u, asks, fp in zip(*columns, strict=True):
                if (key, t, u) != shard:
                    if t_is_own(shard):
                        out.extend(tree.links())
                    tree, shard = BKTree(), (key, t, u)
                if not asks:
                    tree.add(fp, radius)
                else:
                    out.extend((fp, tree.values[root]) for root in tree.reached(fp, radius))
            if out:
                yield signed(out)
                out = []
        if t_is_own(shard):
            out.extend(tree.links())
        if out:
            yield signed(out)

    def signed(pairs: list[tuple[int, int]]) -> pd.DataFrame:
        return pd.DataFrame(np.array(pairs, dtype=np.uint64).view(np.int64), columns=["x", "y"])

    def t_is_own(shard: tuple | None) -> bool:
        return shard is not None and shard[1] == shard[2]

    return search


def near_links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b), a > b, links between distinct fingerprints that keep every component whole."""
    if radius > 3:
        raise ValueError("the shards find all partners up to a radius of 3")
    keyed = distinct.select("fp", F.explode(_shards("fp")).alias("key"))
    sizes = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shards")
    cut = F.ceil(F.col("n") / shard).cast("int")
    members = (
        keyed.join(lookup(sizes), "key")
        .withColumn("pieces", cut)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
        .select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
        .select(
            "key",
            F.least("own", "other").alias("t"),
            F.greatest("own", "other").alias("u"),
            (F.col("other") < F.col("own")).alias("asks"),
            "fp",
        )
    )
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        members.repartition(partitions, "key", "t", "u")
        .sortWithinPartitions("key", "t", "u", "asks", "fp")
        .mapInPandas(releasing(_search(radius)), "x long, y long")
    )
    return found.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def fingerprint_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id, n_docs) of each distinct fingerprint of ``prints`` (doc_id, fp)."""
    with Scratch(prints.sparkSession):
        distinct = stored(
            prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "fingerprints"
        )
        roots = stored(connected_components(near_links(distinct.select("fp"), radius)), "roots")
        rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
            "fp", "least_id", "n", F.coalesce("root", "fp").alias("root")
        )
        total = rooted.groupBy("root").agg(
            F.min("least_id").alias("component_id"), F.sum("n").alias("n_docs")
        )
        found = rooted.join(stored(total, "totals"), "root")
        return stored(found.select("fp", "root", "component_id", "n_docs"), "components", outlive=True)


def near_duplicates(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS,
) -> DataFrame:
    """One row per document: its fingerprint in hex and the smallest id it can reach."""
    small_batches(frame.sparkSession)
    prints = stored(
        frame.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp")), "prints"
    )
    found = fingerprint_components(prints, radius)
    return prints.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS,
) -> DataFrame:
    """The rows that stay, with all their columns: of each component the smallest id.

    Documents alone in their component keep their place. Of the others each task passes
    on only the best row it has of a component. Null ids come last; rows of a component
    that share the smallest id are told apart by their other columns.
    """
    small_batches(frame.sparkSession)
    columns = all_columns(frame)
    marked = stored(frame.withColumn("_lb_fp", fingerprints(F.col(text), shingle)), "prints")
    prints = marked.select(F.col(id_col).alias("doc_id"), F.col("_lb_fp").alias("fp"))
    groups = stored(
        fingerprint_components(prints, radius).where("n_docs > 1").select(
            F.col("fp").alias("_lb_fp"), F.col("root").alias("_lb_root")
        ),
        "groups",
    )
    joined = marked.join(lookup(groups), "_lb_fp", "left")
    alone = joined.where(F.col("_lb_root").isNull()).select(*columns)
    unordered = (T.MapType, T.VariantType)
    ordered = [c for c, f in zip(columns, frame.schema.fields, strict=True) if not isinstance(f.dataType, unordered)]
    best = (
        joined.where(F.col("_lb_root").isNotNull())
        .groupBy("_lb_root")
        .agg(F.min_by(F.struct(*columns), F.struct(F.col(id_col).isNull(), id_col, *ordered)).alias("_lb_all"))
    )
    return alone.unionByName(best.select("_lb_all.*"))
