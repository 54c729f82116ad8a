"""Removal of long byte strings that occur more than once in a corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgekit.llm.bwt import long_prefixes
from pledgekit.llm.text import map_texts, mix64, prefix_hashes, raw
from pledgekit.operators.lookups import spread_lookup
from pledgekit.runtime import stage

# Length of the strings in bytes.
LENGTH = 400
#: Bytes of the grams that anchors are chosen by.
GRAM = 64
#: Starts of one text that are looked at together.
SEGMENT = 4 << 20
#: Bytes of passages that are put in order together, most passages of one anchor there, and most tasks for that.
BLOCK_BYTES, BLOCK_PASSAGES, BLOCK_TASKS = 700_000, 1_000, 20_000
_SALT = np.uint64(0x8CB92BA72F3D8DD7)
_TIE_BITS = np.uint64(24)


def anchor_runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[tuple[np.ndarray, ...]]:
    """(first start, last start, anchor, hash) arrays of one text: runs of starts whose strings have one anchor.

    The anchor of a string is its gram of least hash, the leftmost of equals. It depends on the string's bytes
    alone, so equal strings have equal grams at equal places in them.
    """
    out = []
    total = len(data) - length + 1
    window = length - gram + 1
    for begin in range(0, max(total, 0), SEGMENT):
        part = data[begin : min(begin + SEGMENT, total) + length - 1]
        running, inverse = prefix_hashes(part)
        hashes = mix64((running[gram:] - running[:-gram]) * inverse[: len(part) - gram + 1] ^ _SALT)
        # Order by the upper bits of the hash, then by place.
        value = (hashes >> _TIE_BITS << _TIE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        n = len(part) - length + 1
        padded = np.full(-(-len(value) // window) * window, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(value)] = value
        blocks = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:n], ahead[window - 1 : window - 1 + n])
        anchor = (least & ((np.uint64(1) << _TIE_BITS) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.append(first[1:], n) - 1
        at = anchor[first]
        out.append((first + begin, last + begin, at + begin, hashes[at].view(np.int64)))
    return out


def _characters(data: np.ndarray) -> int:
    """Characters that begin in UTF-8 bytes."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _prints(docs: DataFrame, length: int) -> DataFrame:
    """(key, digest, n_bytes, n_chars, sha256, anchors) of every text; ``anchors`` are the hashes of its runs, twice at most."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = raw(part.column("text"))
        anchors, sha, chars = [], [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            runs = anchor_runs(data[a:b], length)
            own, count = np.unique(np.concatenate([r[3] for r in runs] or [np.zeros(0, np.int64)]), return_counts=True)
            anchors.append(np.repeat(own, np.minimum(count, 2)))  # once or more often is all that counts
            sha.append(hashlib.sha256(data[a:b]).hexdigest())
            chars.append(_characters(data[a:b]))
        ends = pa.array(np.cumsum([0, *map(len, anchors)]), pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(anchors)))
        columns = [part.column("key"), part.column("digest"), pa.array(np.diff(offsets)), pa.array(chars, pa.int64()), pa.array(sha), lists]
        return pa.RecordBatch.from_arrays(columns, names=["key", "digest", "n_bytes", "n_chars", "sha256", "anchors"])

    kind = docs.schema["key"].dataType.simpleString()
    schema = f"key {kind}, digest binary, n_bytes bigint, n_chars bigint, sha256 string, anchors array<bigint>"
    return map_texts(docs, {c: c for c in ("key", "digest", "text")}, schema, work)


def _passages(chosen: DataFrame, length: int) -> DataFrame:
    """(digest, starts, passage, anchor, at, bytes): the runs of a text whose anchor occurs again, by passage.

    A passage is the bytes that the strings of a run cover, ``at`` its anchor's place in it. A text that repeats itself
    has a passage once with all its starts. Bytes are given with the first occurrence in a slice only.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = raw(part.column("text"))
        known: set[bytes] = set()
        rows: list[tuple] = []
        for i, wanted in enumerate(part.column("anchors").to_pylist()):
            own = data[offsets[i] : offsets[i + 1]]
            keep, found = np.array(wanted, np.int64), {}
            for first, last, at, hashes in anchor_runs(own, length):
                for k in np.flatnonzero(np.isin(hashes, keep)).tolist():
                    a, inner = int(first[k]), int(at[k] - first[k])
                    piece = own[a : int(last[k]) + length]
                    name = hashlib.blake2b(piece, digest_size=16, salt=inner.to_bytes(8, "little")).digest()
                    if name in found:
                        found[name][0].append(a)
                        continue
                    found[name] = ([a], int(hashes[k]), inner, None if name in known else piece.tobytes())
                    known.add(name)
            rows += [(i, name, *values) for name, values in found.items()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        digests = part.column("digest").take(pa.array(columns[0], pa.int64()))
        kinds = (pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [digests, *[pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True)]],
            names=["digest", "passage", "starts", "anchor", "at", "bytes"],
        )

    schema = "digest binary, passage binary, starts array<bigint>, anchor bigint, at bigint, bytes binary"
    return map_texts(chosen, {c: c for c in ("digest", "text", "anchors")}, schema, work)


def _in_blocks(units: DataFrame, length: int) -> DataFrame:
    """(passage, first, last): runs of starts in passages whose strings occur again in the same group.

    Groups are dealt into blocks of like size; a group is never cut, so equal strings meet in one block.
    """
    size = units.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("group"), F.lit(blocks))

    def find(table: pa.Table) -> pa.Table:
        names, parts = table.column("passage").to_pylist(), table.column("bytes").to_pylist()
        out: list[tuple[bytes, int, int]] = []
        for name, again in zip(names, long_prefixes(parts, length), strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], again.astype(np.int8), [0]])))
            out += [(name, a, b - 1) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
        columns = [pa.array([x[c] for x in out], t) for c, t in enumerate((pa.binary(), pa.int64(), pa.int64()))]
        return pa.table(dict(zip(["passage", "first", "last"], columns, strict=True)))

    return (
        units.select(block.alias("block"), "passage", "bytes")
        # Blocks cost time rather than bytes, so they are dealt by count; a given count is not merged into fewer tasks.
        .repartition(min(blocks, BLOCK_TASKS), "block")
        .groupBy("block")
        .applyInArrow(find, "passage binary, first bigint, last bigint")
    )


def _resolve(passages: DataFrame, length: int) -> DataFrame:
    """(passage, first, last): which starts of the distinct passages hold strings that occur again."""
    window = length - GRAM
    links = passages.select(
        "passage", F.col("passage").alias("unit"), F.lit(0).cast("bigint").alias("shift")
    )
    units = passages.select(
        F.col("passage").alias("unit"),
        F.concat(F.lit("a"), F.col("anchor").cast("string")).alias("group"),
        "bytes",
        "at",
        "n",
        F.lit(0).alias("low"),
        F.lit(window).alias("high"),
    )
    found: list[DataFrame] = []
    while True:
        sizes = stage(units.groupBy("group").agg(F.count(F.lit(1)).alias("members")), "repeat-sizes")
        level = spread_lookup(units, F.col("group"), sizes, "group", "members", F.xxhash64("unit"), ("members",))
        level = stage(level, "repeat-units")
        several = level.filter((F.col("members") > 1) & (F.col("members") <= BLOCK_PASSAGES))
        twice = level.filter(F.col("n") > 1)
        runs = _in_blocks(several.select("group", F.col("unit").alias("passage"), "bytes"), length).union(
            twice.select("unit", F.lit(0).cast("bigint"), (F.length("bytes") - length).cast("bigint"))
        )
        runs = runs.withColumnRenamed("passage", "unit")
        found.append(
            stage(
                links.join(runs, "unit").select(
                    "passage", (F.col("first") + F.col("shift")).alias("first"), (F.col("last") + F.col("shift")).alias("last")
                ),
                "repeat-runs",
            )
        )
        hot = level.filter((F.col("members") > BLOCK_PASSAGES) & (F.col("low") < F.col("high")))
        if hot.isEmpty():
            break
        units, links = _split(hot, links, length)
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


def _split(hot: DataFrame, links: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The next units and links: each hot unit cut in two halves by the distance from start to anchor.

    The strings of one half all cover the bytes from ``low`` before the anchor to ``length - high`` after it; those
    bytes join the group. Where a passage is common to many texts, the half that lies within it is
    the same in all of them and becomes one unit, and only the half across its border stays large; after a
    few halvings a half is a single string.
    """
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    lower = F.struct(F.col("low").alias("low"), middle.alias("high"))
    upper = F.struct((middle + 1).alias("low"), F.col("high").alias("high"))
    halves = hot.select("unit", "group", "bytes", "at", "n", F.explode(F.array(lower, upper)).alias("half"))
    # Starts of the half in the unit: at - high to at - low, as far as the unit has them.
    first = F.greatest(F.col("at") - F.col("half.high"), F.lit(0))
    last = F.least(F.col("at") - F.col("half.low"), F.length("bytes") - length)
    core_start = F.col("at") - F.col("half.low")
    core = F.substring("bytes", (core_start + 1).cast("int"), (F.lit(length) - F.col("half.high") + F.col("half.low")).cast("int"))
    cut = halves.filter(first <= last).select(
        F.col("unit").alias("parent"),
        F.col("half.low").alias("low"),
        F.col("half.high").alias("high"),
        F.md5(F.concat(F.encode("group", "utf-8"), F.encode(F.concat(F.lit(":"), F.col("half.low").cast("string"), F.lit(":")), "utf-8"), core)).alias("group"),
        F.substring("bytes", (first + 1).cast("int"), (last - first + length).cast("int")).alias("bytes"),
        (F.col("at") - first).alias("at"),
        first.cast("bigint").alias("shift"),
        "n",
    )
    named = stage(cut.withColumn("unit", F.unhex(F.md5(F.concat(F.encode(F.concat(F.col("group"), F.col("at").cast("string")), "utf-8"), F.col("bytes"))))), "repeat-halves")
    units = named.groupBy("unit").agg(
        *[F.max(c).alias(c) for c in ("group", "bytes", "at")], F.sum("n").alias("n"), *[F.max(c).alias(c) for c in ("low", "high")]
    )
    steps = named.select(F.col("parent"), F.col("unit").alias("child"), F.col("shift").alias("more"))
    down = links.join(steps, F.col("unit") == F.col("parent")).select(
        "passage", F.col("child").alias("unit"), (F.col("shift") + F.col("more")).alias("shift")
    )
    return units, stage(down, "repeat-links")


def _marked(n: int, firsts: list[int], lasts: list[int], length: int) -> tuple[np.ndarray, int]:
    """Which bytes of a text are covered, and by how many maximal runs."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, firsts, 1)
    np.add.at(change, [b + length for b in lasts], -1)
    covered = np.cumsum(change[:-1]) > 0
    return covered, int(np.count_nonzero(np.diff(covered, prepend=False) & covered))


def remove_repeats(df: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Removes every byte covered by a ``length``-byte string that also starts anywhere else in the corpus.

    Gives two tables: key, digest, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes and kept_chars (characters that
    begin in them) of every document; and digest and ``kept`` (the remaining bytes) of each distinct text that loses something but not everything.

    1. Every string of ``length`` bytes has an anchor chosen by its own bytes, so equal strings meet under one
    anchor hash, and runs of strings share one; anchors are sparse, so little is shuffled. 2. Texts with an anchor that
    occurs again are cut into passages (the bytes under a run). Texts that are equal as a whole count as one, and
    so do equal passages; both are removed whole. 3. Distinct passages under one anchor are put in suffix order, and
    interval expansion on their Burrows-Wheeler transform, stopped at ``length``, tells which strings
    start twice. Anchors with more passages than a block holds are cut in halves by distance from the
    anchor until they fit, so no group is unbounded. 4. Covered bytes are removed from the texts.

    Null and empty texts have no bytes and lose nothing. Rows with equal texts repeat each other, whatever
    their keys. Keys are only carried, so they may be null or repeated.
    """
    docs = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    name = F.coalesce(F.col("key").cast("string"), F.lit(""))
    docs = docs.withColumns({"digest": _digest(F.col("text")), "name": name})
    prints = stage(_prints(docs, length), "repeat-prints")
    classes = prints.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(name).alias("name"))
    classes = stage(classes, "repeat-classes")

    one_of = prints.join(classes, "digest").filter(name == F.col("name")).dropDuplicates(["digest"])
    runs = one_of.select("digest", F.explode("anchors").alias("anchor"))
    again = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).drop("n")
    hits = runs.join(again, "anchor").groupBy("digest").agg(F.collect_set("anchor").alias("anchors"))
    hits = hits.join(classes, "digest")
    chosen = docs.join(hits.withColumnRenamed("name", "rep"), "digest").filter(F.col("name") == F.col("rep"))
    chosen = stage(chosen.select("digest", "text", "anchors", "copies"), "repeat-texts")

    held = stage(_passages(chosen, length), "repeat-passages")
    distinct = held.groupBy("passage").agg(
        F.max("anchor").alias("anchor"), F.max("at").alias("at"), F.max("bytes").alias("bytes"), F.sum(F.size("starts")).alias("n")
    )
    repeated = _resolve(distinct, length)
    spans = (
        held.select("digest", "starts", "passage")
        .join(repeated, "passage")
        .select("digest", "first", "last", F.explode("starts").alias("start"))
        .groupBy("digest")
        .agg(
            F.collect_list(F.col("start") + F.col("first")).alias("firsts"),
            F.collect_list(F.col("start") + F.col("last")).alias("lasts"),
        )
    )
    partly = chosen.filter(F.col("copies") == 1).join(spans, "digest")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            removed, runs, kept, chars = [], [], [], []
            firsts, lasts = batch.column("firsts"), batch.column("lasts")
            for i in range(batch.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                covered, n = _marked(len(own), firsts[i].as_py(), lasts[i].as_py(), length)
                removed.append(int(covered.sum()))
                runs.append(n)
                kept.append(own[~covered].tobytes())
                chars.append(_characters(own[~covered]))
            counts = [pa.array(c, pa.int64()) for c in (removed, runs, chars)]
            columns = [batch.column("digest"), *counts, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "n_removed", "n_spans", "kept_chars", "kept"])

    schema = "digest binary, n_removed bigint, n_spans bigint, kept_chars bigint, kept binary"
    kept = stage(partly.select("digest", "text", "firsts", "lasts").mapInArrow(cut, schema), "repeat-kept")
    losses = kept.select("digest", "n_removed", "n_spans", "kept_chars", F.sha2("kept", 256).alias("rest"))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    lost = F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint")
    report = (
        prints.select("key", "digest", "n_bytes", "n_chars", "sha256")
        .join(classes.select("digest", "copies"), "digest")
        .join(losses, "digest", "left")
        .select(
            F.col("key").alias(key),
            "digest",
            "n_bytes",
            lost.alias("n_removed"),
            F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
            F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("rest", "sha256")).alias("kept_sha256"),
            (F.col("n_bytes") - lost).alias("kept_bytes"),
            F.when(whole, 0).otherwise(F.coalesce("kept_chars", "n_chars")).cast("bigint").alias("kept_chars"),
        )
    )
    return report, kept


def repeat_digest(df: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """The first table of ``remove_repeats``: lengths, spans and a digest of what is left of every document.

    A null or empty text has 0 bytes and the digest of none. Repeated rows repeat each other as a whole; null and
    repeated keys are only carried. An empty table gives no rows. Columns other than key and text are not read.
    """
    report, _ = remove_repeats(df, text, key, length)
    return report.drop("digest")
