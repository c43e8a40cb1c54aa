"""Near-duplicate documents by SimHash, linked through vantage-point trees.

1. **Fingerprints.** A bit is set if it is set in over half of the XXH64 hashes of a
   text's word shingles, repeats included.
2. **Collapse.** Equal fingerprints become one point with their smallest id, by an
   aggregation that combines before it shuffles.  A group of copies of any size is
   one row from here on.
3. **Shards.** A vantage-point tree over a bounded sample of points (``SAMPLE``) cuts
   the Hamming space: a node sends a point to its near side if its distance to the
   vantage point is at most the node's radius.  Leaves are shards, and their number
   grows with the points.  *Every* point has one home shard.  By the triangle
   inequality a partner within ``k`` bits can only lie on the other side of a node
   if the point's own distance is within ``k`` of the radius, so a point also
   visits exactly those shards.  The sample only decides where space is cut, never
   which pairs are found.
4. **Pairs.** Home points of a shard lie in groups of equal distance to two more
   vantage points; a visitor is compared only with the groups that the triangle
   inequality leaves, bit for bit.  Links are exact.
5. **Links.** A shard returns a spanning forest of its links, at most one row for each
   of its points, so dense groups do not emit all their pairs.  The home points of a shard
   are cut into parts and its visitors into sides; every part meets every side.
6. **Components.** Smallest labels spread along links until nothing changes; every
   round is stored in the shared folder.

Defined results: null and empty texts have no words and fingerprint zero, which links
like any other; a null id is never a component's name unless all its ids are null;
repeated rows stay, each with its component; an empty table gives an empty result;
other columns are not read.  Texts are hashed whole, in blocks of shingles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendora.llm.common import ASCII_LOWER, WORD, arrow_map, fresh, sized_broadcast
from vendora.session import settle

SHINGLE = 3
BITS = 3
SEED = 42
# Points that the tree is fitted on (8 bytes each), and points aimed at per shard.
SAMPLE = 65_536
SHARD = 4_096
MIN_SHARDS = 64
# A deeper tree would need a larger sample; beyond this, shards have more parts.
MAX_SHARDS = 4_096
# Home points of one part of a shard, and visitors of one side.
PART = 32_768
SIDE = 262_144
# Shingles hashed at a time.
BLOCK = 65_536
# Most rows of ids and keys that are broadcast: about 10 MB.
BROADCAST_ROWS = 200_000
# Links held before they are folded into a forest.
HELD = 500_000

_WORDS = re.compile(WORD)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = _WORDS.findall((text or "").translate(ASCII_LOWER))
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, BLOCK):
        part = words[start : start + min(BLOCK, n - start) + shingle - 1]
        if shingle == 3 and len(part) > 2:
            texts = map("{} {} {}".format, part, part[1:], part[2:])
        else:
            texts = (" ".join(part[i : i + shingle]) for i in range(max(1, len(part) - shingle + 1)))
        hashes = np.fromiter((digest(t.encode("utf-8", "surrogatepass"), SEED) for t in texts), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Rows ``(id, key, fp)``, one per document; ``key`` tells texts of one id apart,
    ``fp`` holds the 64 bits as a long."""

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
        signed = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), signed], ["id", "key", "fp"])

    given = docs.select(F.col(doc_id).alias("id"), _key(text).alias("key"), F.col(text).cast("string").alias("text"))
    return arrow_map(given, per_batch, f"id {given.schema['id'].dataType.simpleString()}, key long, fp long", "text")


def _key(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


# --- The tree ---------------------------------------------------------------------


def grow(sample: np.ndarray, depth: int, seed: int = 7) -> list[tuple[int, int]]:
    """Vantage point and radius of each inner node, breadth first (children of
    ``i`` are ``2i+1``, the near side, and ``2i+2``).

    The radius halves the node's sample.  Where a sample runs out, any vantage
    point and radius do: shards stay right, only less even."""
    rng = np.random.default_rng(seed)
    nodes: list[tuple[int, int]] = []
    members = [sample]
    for i in range(2**depth - 1):
        own = members[i]
        vantage = np.uint64(own[rng.integers(len(own))] if len(own) else rng.integers(0, 2**63))
        d = np.bitwise_count(own ^ vantage)
        radius = int(np.median(d)) if len(own) else 32
        nodes.append((int(vantage), radius))
        members += [own[d <= radius], own[d > radius]]
        members[i] = own[:0]  # no longer needed
    return nodes


def place(points: np.ndarray, nodes: list[tuple[int, int]], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of ``points``, shard) that the points reach within ``reach`` bits;
    with reach 0, each point's home alone."""
    rows, at = np.arange(len(points)), np.zeros(len(points), np.int64)
    vantages = np.array([v for v, _ in nodes], np.uint64)
    radii = np.array([r for _, r in nodes], np.int64)
    depth = (len(nodes) + 1).bit_length() - 1
    for _ in range(depth):
        d = np.bitwise_count(points[rows] ^ vantages[at]).astype(np.int64)
        near, far = d <= radii[at] + reach, d > radii[at] - reach
        rows, at = np.concatenate([rows[near], rows[far]]), np.concatenate([2 * at[near] + 1, 2 * at[far] + 2])
    return rows, at - len(nodes)


def shards(points: DataFrame, nodes: list[tuple[int, int]], bits: int) -> DataFrame:
    """Rows ``(shard, part, side, fp, home)``: the home points of a shard lie in parts and its visitors in
    sides, and every part meets every side, so that no group holds more than ``PART`` and
    ``SIDE`` points or so, however many a shard has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                fp = _unsigned(batch.column("fp").slice(start, 4096))
                home, at = (np.bincount(place(fp, nodes, reach)[1], minlength=len(nodes) + 1) for reach in (0, bits))
                columns = [pa.array(np.arange(len(home), dtype=np.int32)), pa.array(home), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "homes", "visitors"])

    counted = points.select("fp").mapInArrow(count, "shard int, homes long, visitors long").groupBy("shard")
    parts, sides = np.ones(len(nodes) + 1, np.int64), np.ones(len(nodes) + 1, np.int64)
    for shard, n, m in counted.agg(F.sum("homes"), F.sum("visitors")).collect():  # one row for each shard
        parts[shard], sides[shard] = max(1, -(-n // PART)), max(1, -(-m // SIDE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                fp = _unsigned(batch.column("fp").slice(start, 4096))
                mixed = ((fp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64)
                own, home = _each(*place(fp, nodes, 0), sides)
                rows, at = _each(*place(fp, nodes, bits), parts)
                columns = [
                    np.concatenate([home[0], at[0]]).astype(np.int32),
                    np.concatenate([mixed[own] % parts[home[0]], at[1]]).astype(np.int32),
                    np.concatenate([home[1], mixed[rows] % sides[at[0]]]).astype(np.int32),
                    np.concatenate([fp[own], fp[rows]]).view(np.int64),
                    np.arange(len(own) + len(rows)) < len(own),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "part", "side", "fp", "home"])

    return points.select("fp").mapInArrow(run, "shard int, part int, side int, fp long, home boolean")


def _each(rows: np.ndarray, at: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Every row as often as its shard says, with the shard and a number from 0."""
    n = times[at]
    return np.repeat(rows, n), (np.repeat(at, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


class Forest:
    """Union by smallest root over a fixed list of points."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def flatten(self) -> None:
        while (up := self.root[self.root] != self.root).any():
            self.root[up] = self.root[self.root[up]]

    def add(self, points: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Links between points given by value; empties the list."""
        if held:
            a, b = (np.searchsorted(points, np.concatenate(x)) for x in zip(*held, strict=True))
            self.join(a, b)
            held.clear()

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Both ends of every link (a, b) get one root."""
        while len(a):
            self.flatten()
            x, y = self.root[a], self.root[b]
            differ = x != y
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
        self.flatten()


def links_within(home: np.ndarray, visit: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a shard as (point, a point it hangs together with), one per joined point."""
    everything = np.unique(np.concatenate([home, visit]))
    forest = Forest(len(everything))
    if len(home) and len(everything) > 1:
        # Two vantage points: the first home point and its farthest.
        first = home[0]
        second = home[np.argmax(np.bitwise_count(home ^ first))]
        d1, d2 = (np.bitwise_count(home ^ v).astype(np.int64) for v in (first, second))
        order = np.lexsort((d2, d1))
        home = home[order]
        cell = d1[order] * 65 + d2[order]
        e1, e2 = (np.bitwise_count(visit ^ v).astype(np.int64) for v in (first, second))
        by = np.lexsort((e2, e1))
        visit, there = visit[by], (e1 * 65 + e2)[by]
        cuts = np.flatnonzero(np.diff(there, prepend=-1))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for start, end in zip(cuts, [*cuts[1:], len(visit)], strict=True):
            x, y = divmod(int(there[start]), 65)
            spans = [
                np.arange(*np.searchsorted(cell, [65 * i + max(0, y - bits), 65 * i + min(64, y + bits) + 1]))
                for i in range(max(0, x - bits), min(64, x + bits) + 1)
            ]
            near = home[np.concatenate(spans)]
            step = max(1, 2_000_000 // max(1, len(near)))
            for s in range(start, end if len(near) else start, step):
                mine = visit[s : min(end, s + step)]
                i, j = np.nonzero(np.bitwise_count(mine[:, None] ^ near[None, :]) <= bits)
                a, b = mine[i], near[j]
                new = a != b
                if new.any():
                    held.append((a[new], b[new]))
                if sum(len(x) for x, _ in held) > HELD:
                    forest.add(everything, held)
        forest.add(everything, held)
    joined = np.flatnonzero(forest.root != np.arange(len(everything)))
    return everything[joined], everything[forest.root[joined]]


def shard_links(placed: DataFrame, bits: int) -> DataFrame:
    """Rows ``(a, b)`` that connect, within each part and side of a shard, all points linked there."""

    def per_part(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, home = pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy()
        a, b = links_within(fp[home], fp[~home], bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return placed.groupBy("shard", "part", "side").applyInPandas(per_part, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Rows ``(fp, root)`` for every point with a link; one root per component.

    Labels start at the smallest neighbour; each round a point takes the smallest
    label among its own, its neighbours' and its label's label, so chains
    shorten by half."""
    both = settle(
        links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = settle(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("l")), "labels")
    while True:
        around = both.join(labels.select(F.col("a").alias("b"), "l"), "b").groupBy("a").agg(F.min("l").alias("m"))
        lower = labels.join(around, "a").select("a", F.least("l", "m").alias("l"), F.col("l").alias("old"))
        jump = labels.select(F.col("a").alias("l"), F.col("l").alias("up"))
        new = settle(
            lower.join(jump, "l").select("a", F.least("l", "up").alias("l"), "old"), "labels"
        )
        if new.filter("l <> old").isEmpty():
            return new.select(F.col("a").alias("fp"), F.col("l").alias("root"))
        labels = new.select("a", "l")


def linked(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows ``(fp, root, component_id)`` of all distinct fingerprints of ``fps (id, key, fp)``."""
    points = settle(fps.groupBy("fp").agg(F.min("id").alias("first")), "points")
    n = points.count()
    # About SAMPLE points, chosen by hash; the driver holds no more.
    rows = points.filter(F.pmod(F.xxhash64("fp"), F.lit(max(1, n))) < SAMPLE).select("fp").collect()
    sample = np.array([r.fp for r in rows], np.int64).view(np.uint64)
    depth = (max(MIN_SHARDS, min(MAX_SHARDS, -(-n // SHARD))) - 1).bit_length()
    links = shard_links(shards(points, grow(sample, depth), bits), bits)
    found = components(settle(links, "shard_links"))
    roots = points.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    return settle(roots.join(names, "root").select("fp", "root", "component_id"), "components")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """Per document: its id, fingerprint (16 hex digits) and component (smallest id reachable)."""
    fps = settle(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    return fps.join(linked(fps, bits), "fp").select(
        F.col("id").alias(doc_id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns.

    Null ids come last; texts that share the id are told apart by hash, and of
    rows alike in id and text one stays."""
    id_, key = fresh(docs, "_id", "_key")
    fps = settle(fingerprints(docs, doc_id, text), "fingerprints")
    best = F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))
    copies = settle(fps.groupBy("fp", "id", "key").agg(F.count("*").alias("times")), "copies")
    chosen = (
        copies.join(linked(fps), "fp")
        .groupBy("root")
        .agg(F.min_by(F.struct("id", "key", "times"), best).alias("c"))
        .select("c.id", "c.key", "c.times")
    )
    chosen = settle(chosen, "chosen")
    c, k = copies.alias("c"), chosen.alias("k")
    same = F.col("c.id").eqNullSafe(F.col("k.id")) & (F.col("c.key") == F.col("k.key"))
    named = [F.col("id").alias(id_), F.col("key").alias(key)]
    # Ids and keys of what goes, and of what the table holds more than once, meet the texts.
    gone = sized_broadcast(settle(c.join(k, same, "left_anti").select(*named), "gone"), BROADCAST_ROWS)
    repeated = sized_broadcast(settle(chosen.filter("times > 1").select(*named), "repeated"), BROADCAST_ROWS)
    same = F.col(doc_id).eqNullSafe(F.col(id_)) & (_key(text) == F.col(key))
    kept = docs.join(gone, same, "left_anti")
    alone = kept.join(repeated, same, "left_anti")
    again = kept.join(repeated, same).dropDuplicates([id_, key])
    return alone.unionByName(again.select(*[F.col(f"`{x}`") for x in docs.columns]))
