"""Near duplicates: one-permutation MinHash, banded buckets, star-shaped candidate edges, exact confirmation."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgekit.llm.components import components
from pledgekit.llm.text import field_type, map_texts, mix64, raw, word_hashes
from pledgekit.operators.lookups import spread_lookup
from pledgekit.runtime import stage

# Words per shingle, and the least similarity in percent.
SHINGLE = 5
SIMILARITY = 75
#: Bands and rows per band. Two texts at the least similarity share no bucket with probability (1 - 0.75^6)^64 < 4e-6.
BANDS, ROWS = 64, 6
_SLOT_SEED = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; a text of fewer words has its whole sequence as one."""
    words, firsts = word_hashes(data, offsets)
    n = len(words)
    rolled = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size):
        rolled = mix64(rolled + np.uint64(k + 1)) + words[k : n - size + 1 + k] if len(rolled) else rolled
    rolled = mix64(rolled)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = np.full(1, 0x100 + b - a, np.uint64)
            for k in range(a, b):
                whole = mix64(whole) + words[k]
            out.append(mix64(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


_PROBES: dict[int, np.ndarray] = {}


def _probe(bins: int, block: int) -> np.ndarray:
    """Bins that an empty bin looks into, attempts 64 * block on: a hash of (bin, attempt), the same for all texts."""
    key = bins * 100_000 + block
    if key not in _PROBES:
        attempt = np.arange(64 * block, 64 * block + 64, dtype=np.uint64)[:, None]
        at = np.arange(bins, dtype=np.uint64)[None, :]
        _PROBES[key] = (mix64(mix64(at + _SLOT_SEED) + attempt) % np.uint64(bins)).astype(np.int64)
    return _PROBES[key]


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """One permutation cut into bins, the least hash of each; empty bins are filled by optimal densification."""
    order = np.sort(mix64(shingles ^ _SLOT_SEED))
    at = ((order >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out = np.zeros(bins, np.uint64)
    filled = np.zeros(bins, bool)
    out[at[first]], filled[at[first]] = order[first], True
    empty, block = np.flatnonzero(~filled), 0
    while len(empty):
        probe = _probe(bins, block)[:, empty]
        hit = filled[probe]
        found = hit.any(axis=0)
        out[empty[found]] = out[probe[hit.argmax(axis=0)[found], np.flatnonzero(found)]]
        empty, block = empty[~found], block + 1
    return out


def band_hashes(shingles: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = signature(shingles, bands * rows).reshape(bands, rows)
    total = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        total = mix64(total) + parts[:, k]
    return mix64(total)


#: Edges of one center that are confirmed together, and bounds of a block of unresolved texts.
CHUNK_EDGES = 512
BLOCK_TEXTS, BLOCK_SHINGLES = 1_500, 400_000
#: Columns of the incidence matrix of a block that are multiplied at a time.
BLOCK_COLUMNS = 2_048


def linked(common: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: int = SIMILARITY) -> np.ndarray:
    return 100 * common >= similarity * (left + right - common)


def block_links(sets: list[np.ndarray], similarity: int = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs of positions that connect all linked sets of a block: a spanning forest, not all pairs.

    Common elements of all pairs come from products of the incidence matrix, over the elements that two sets hold.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    rows, column = rows[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    common = np.zeros((n, n), np.float32)
    for start in range(0, int(shared.sum()), BLOCK_COLUMNS):
        a, b = np.searchsorted(column, [start, start + BLOCK_COLUMNS])
        held = np.zeros((n, BLOCK_COLUMNS), np.float32)
        held[rows[a:b], column[a:b] - start] = 1.0
        common += held @ held.T
    label, out = np.arange(n), []
    for i in range(n - 1):
        near = i + 1 + np.flatnonzero(linked(common[i, i + 1 :].astype(np.int64), sizes[i], sizes[i + 1 :], similarity))
        for root in np.unique(label[near]).tolist():
            if root != label[i]:
                out.append((i, int(near[label[near] == root][0])))
                label[label == root] = label[i]
    return out


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(v, "<u8") for v in column.to_pylist()]


def shingle_prints(df: DataFrame, text: str, key: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, n_shingles, print, buckets): size of a text's set, a 128-bit digest of it, and its band hashes.

    The digest and buckets are null for a text without words.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(*raw(part.column("text")))
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        buckets = [band_hashes(s, bands, rows).view(np.int64) if len(s) else None for s in sets]
        columns = [
            part.column("key"),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(buckets, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["key", "n_shingles", "print", "buckets"])

    schema = f"key {field_type(df, key)}, n_shingles bigint, print binary, buckets array<bigint>"
    return map_texts(df, {"key": key, "text": text}, schema, work)


def _set_table(df: DataFrame, wanted: DataFrame, text: str, key: str) -> DataFrame:
    """(node, shingles) of the classes in ``wanted`` (rep, print, node), as little-endian 64-bit hashes.

    Where rows share a key but not a text, the digest tells which of them belongs to the class.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        packed = [s.astype("<u8").tobytes() for s in shingle_sets(*raw(part.column("text")))]
        own = [hashlib.blake2b(s, digest_size=16).digest() == p for s, p in zip(packed, part.column("print").to_pylist(), strict=True)]
        both = pa.RecordBatch.from_arrays([part.column("node"), pa.array(packed, pa.binary())], names=["node", "shingles"])
        return both.filter(pa.array(own, pa.bool_()))

    docs = df.select(F.col(f"`{key}`").alias("rep"), F.col(f"`{text}`").alias("text"))
    chosen = docs.join(wanted, "rep")
    found = map_texts(chosen, {c: c for c in ("node", "print", "text")}, "node bigint, shingles binary", work)
    return found.dropDuplicates(["node"])


def _confirm(edges: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The edges (center, node) whose whole sets are similar enough.

    A center's edges are dealt into chunks that hold its set once each, so a center of many is many small groups.
    """
    counts = edges.groupBy("center").agg(F.ceil(F.count(F.lit(1)) / CHUNK_EDGES).cast("int").alias("chunks"))
    dealt = edges.join(counts, "center").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    members = dealt.join(sets, "node").select("center", "chunk", "node", "shingles")
    every_chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    hubs = counts.select(F.col("center").alias("hub"), every_chunk.alias("part")).join(
        sets.select(F.col("node").alias("hub"), F.col("shingles").alias("hub_shingles")), "hub"
    )

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        keep = np.zeros(left.num_rows, bool)
        own = _sets(left.column("shingles"))
        for hub in _sets(right.column("hub_shingles")):
            for i, other in enumerate(own):
                if not keep[i]:
                    common = len(np.intersect1d(hub, other, assume_unique=True))
                    keep[i] = linked(common, len(hub), len(other), similarity)
        return left.filter(pa.array(keep)).select(["center", "node"])

    return members.groupBy("center", "chunk").cogroup(hubs.groupBy("hub", "part")).applyInArrow(check, "center bigint, node bigint")


def _resolve(groups: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Edges among the members (bucket, node, n_shingles) of unresolved buckets, from blocks of bounded size.

    A bucket of more than a block is dealt into blocks, and each pair of blocks is compared in a task of its own.
    """
    sizes = groups.groupBy("bucket").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.lit(1)
        ).alias("blocks")
    )
    own, other = F.pmod(F.xxhash64("node"), F.col("blocks")), F.col("other")
    rows = (
        groups.join(sizes, "bucket")
        .select("bucket", "node", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("bucket", "node", F.least("own", other).alias("first"), F.greatest("own", other).alias("second"))
        .join(sets, "node")
    )

    def find(table: pa.Table) -> pa.Table:
        nodes = table.column("node").combine_chunks()
        links = block_links(_sets(table.column("shingles")), similarity)
        ends = [pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)]
        return pa.table({"center": nodes.take(ends[0]), "node": nodes.take(ends[1])})

    return rows.groupBy("bucket", "first", "second").applyInArrow(find, "center bigint, node bigint")


def _labelled(rows: DataFrame, column: str, labels: DataFrame, name: str) -> DataFrame:
    """``rows`` with the label of the node in ``column``; a node without one is its own label."""
    own = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return rows.join(own, F.col(column) == F.col("_node"), "left").select(
        *rows.columns, F.coalesce("_label", F.col(column)).alias(name)
    )


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links (center, node): components of the labels that the links connect."""
    between = _labelled(_labelled(links, "center", labels, "a"), "node", labels, "b").select("a", "b")
    more = components(between.filter(F.col("a") != F.col("b")))
    moved = _labelled(labels, "label", more, "_now").select("node", F.col("_now").alias("label"))
    return stage(moved.union(more.join(labels, "node", "left_anti").select("node", "label")), "near-labels")


def class_edges(buckets: DataFrame) -> DataFrame:
    """(node, centers) of the members (bucket, node, center) of all buckets: a member's distinct centers, one a band at most."""
    return buckets.groupBy("node").agg(F.collect_set("center").alias("centers"))


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    similarity: int = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Key, n_shingles, component_id (least key reachable over links) and ``kept`` of every document.

    1. Documents with one and the same set form a class, so copies never meet in a bucket. 2. Classes meet in buckets of
    their bands; a bucket proposes a star: an edge from its least class to each other member, so edges never outnumber
    bucket rows. 3. Edges are confirmed on whole sets: first that to a member's least center, which connects
    most groups; then, of its other centers, only those that are still in another component. 4. Where a bucket still
    holds several components, its other members are compared block by block inside tasks, again on whole
    sets; a block returns a spanning forest, so links that bypass the star are found without listing pairs.
    Components follow from all confirmed edges.

    A text without words (null, empty, blank) has no shingles and is linked with nothing. Repeated rows count as one
    document, and each gets its result. Rows that share a key but not a text count each with their own text. A null key is
    linked with nothing and kept, with a null component.
    """
    kind = field_type(df, key)
    prints = stage(shingle_prints(df, text, key, bands, rows), "near-prints")
    some = prints.filter(F.col("print").isNotNull() & F.col("key").isNotNull())
    # Copies have one set, hence one and the same list of buckets. A class has the number of its staged row.
    copies = some.groupBy("print").agg(
        F.min("key").alias("rep"),
        F.count(F.lit(1)).alias("copies"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("buckets").alias("buckets"),
    )
    classes = stage(copies.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    placed = classes.select("node", "n_shingles", F.explode("buckets").alias("bucket"))
    stars = placed.groupBy("bucket").agg(F.min("node").alias("center"), F.max("node").alias("_last"))
    stars = stars.filter(F.col("center") != F.col("_last")).drop("_last")
    buckets = stage(placed.join(stars, "bucket").filter(F.col("node") != F.col("center")), "near-buckets")
    edges = stage(class_edges(buckets), "near-centers")
    wanted = buckets.select("node").union(buckets.select("center")).distinct()
    wanted = classes.select("rep", "print", "node").join(wanted, "node", "left_semi")
    sets = stage(_set_table(df.filter(F.col(f"`{key}`").isNotNull()), wanted, text, key), "near-sets")

    nearest = edges.select(F.array_min("centers").alias("center"), "node")
    confirmed = stage(_confirm(nearest, sets, similarity), "near-edges")
    labels = components(confirmed.select(F.col("center").alias("a"), F.col("node").alias("b")))
    others = edges.select("node", F.explode(F.filter("centers", lambda c: c != F.array_min("centers"))).alias("center"))
    apart = _labelled(_labelled(others, "center", labels, "a"), "node", labels, "b").filter(F.col("a") != F.col("b"))
    second = stage(_confirm(apart.select("center", "node"), sets, similarity), "near-edges")
    if not second.isEmpty():
        labels = _merged(labels, second)

    members = _labelled(buckets.select("bucket", "node", "n_shingles"), "node", labels, "label")
    open_buckets = (
        members.groupBy("bucket")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            *[F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(38,0)")).alias(f"who{i}") for i in range(2)],
            F.count(F.lit(1)).alias("n"),
        )
        .filter(F.col("low") != F.col("high"))
        # Buckets of the same members need one comparison; two sums of 64-bit hashes and the number tell them apart.
        .groupBy("who0", "who1", "n")
        .agg(F.min("bucket").alias("bucket"))
    )
    groups = members.join(open_buckets.select("bucket"), "bucket", "left_semi").select("bucket", "node", "n_shingles")
    more = stage(_resolve(groups, sets, similarity), "near-more")
    if not more.isEmpty():
        labels = _merged(labels, more)

    # Copies and components may hold most documents, so results come back by a lookup that spreads hot keys.
    tops = _labelled(classes.select("node", "print", "rep", "copies"), "node", labels, "label")
    least = stage(tops.groupBy("label").agg(F.min("rep").alias("component"), F.count(F.lit(1)).alias("n")), "near-least")
    found = spread_lookup(tops, F.col("label"), least, "label", "n", F.xxhash64("node"), ("component",))
    of_class = stage(found.select("print", "copies", "component"), "near-components")
    final = spread_lookup(
        prints.select("key", "n_shingles", "print"), F.col("print"), of_class, "print", "copies", F.xxhash64("key"), ("component",)
    )
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key")).cast(kind)
    return final.select(
        F.col("key").alias(key),
        "n_shingles",
        component.alias("component_id"),
        (F.col("key").isNull() | (F.col("key") == component)).alias("kept"),
    )


def drop_near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", **parameters) -> DataFrame:
    """The rows of ``df`` whose document stands for its component; rows without a key stay.

    Rows that share a key but not a text stay or go together: they stay if one of their texts does.
    """
    verdicts = near_duplicates(df, text, key, **parameters).groupBy(f"`{key}`").agg(F.max("kept").alias("kept"))
    return df.join(verdicts.filter(~F.col("kept")).select(key), key, "left_anti")
