"""Best-fit packing of documents into fixed-length token sequences, with certified sequence counts."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgekit.llm.text import field_type, map_texts
from pledgekit.runtime import stage

# Length of a sequence, and the id that ends every document.
SEQUENCE = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
#: Pieces that are packed together in one task.
GROUP_PIECES = 20_000
#: Bytes of words and their ids that a task remembers; longer chunks of a text than a word may be are not kept.
REMEMBERED_BYTES, WORD_CHARS = 64 << 20, 100
MARKS = ".,!?;:"
MARK_SET = frozenset(MARKS)
#: Where no such place is, every full stop and comma of a text is a word of its own. Letters that the tokenizer takes
#: apart may end in a mark, which a stop or comma joins; up to the Latin letters that is the dotted capital I alone.
ODD = re.compile(r"[^\w\s.,]|[.,_]{2}")
TAKEN_APART = re.compile(r"[\u0130\u0250-\U0010ffff]")
#: The same test on the bytes of Latin-1 texts: what may stand there, and stops, commas and underscores as one sign.
PLAIN_BYTES = bytes(i for i in range(256) if re.match(r"[\w\s.,]", chr(i)))
STOPS = bytes(ord(".") if chr(i) in ".,_" else i for i in range(256))


class WordEncoder:
    """Token ids of whole texts, word by word.

    The tokenizer splits at white space and nothing reaches across it, so the ids of a text are those of its
    space-separated chunks in order, and most chunks have been seen before. Texts of Latin-1 letters alone are
    lower-cased first, as the tokenizer does; others are left to it as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.held = 0
        words = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True

    def _ids(self, chunks: Iterable[str]) -> dict[str, bytes]:
        # A chunk of letters is one word to the tokenizer, so many can be encoded as one text and cut at word ends.
        words = [c for c in chunks if c.isalpha() and _latin(c)]
        lines = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
        encoded = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable([e.ids for e in encoded]), "<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) != len(words):
            raise AssertionError("a word of letters was split")
        packed = ids.tobytes()
        found = dict(zip(words, [packed[a:b] for a, b in zip([0, *stops], stops)], strict=True))
        rest = [c for c in chunks if c not in found]
        encoded = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        found |= zip(rest, [np.array(e.ids, "<u4").tobytes() for e in encoded], strict=True)
        return found

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that are not remembered; those of usual length are from now on, within a bound of bytes."""
        # A mark after a letter is a word of its own, so "word." is "word" and ".".
        ended = [c for c in chunks if c[-1:] in MARK_SET and len(c) > 1 and _letter(c[-2])]
        wanted = chunks.difference(ended).union([c[:-1] for c in ended], [c[-1] for c in ended])
        found = self._ids(wanted.difference(self.known))
        for c in ended:
            word, mark = c[:-1], c[-1]
            found[c] = (found.get(word) or self.known[word]) + (found.get(mark) or self.known[mark])
        fresh = found
        if max(map(len, found), default=0) > WORD_CHARS:
            fresh = {c: x for c, x in found.items() if len(c) <= WORD_CHARS}
        size = sum(map(len, fresh)) + sum(map(len, fresh.values())) + 150 * len(fresh)
        if self.held + size > REMEMBERED_BYTES:
            self.known, self.held = {}, 0
        if size <= REMEMBERED_BYTES:
            self.known |= fresh
            self.held += size
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; null is empty."""
        chunks: list[str] = []
        stops = []
        for text in texts:
            text = text or ""
            try:
                narrow = text.encode("latin-1")
            except UnicodeEncodeError:
                odd = ODD.search(text) or TAKEN_APART.search(text)
            else:
                text = text.lower()
                odd = narrow.translate(None, PLAIN_BYTES) or b".." in narrow.translate(STOPS)
            if not odd:
                text = text.replace(".", " .").replace(",", " ,")
            chunks += text.replace("\n", " ").split(" ")
            stops.append(len(chunks))
        ids = list(map(self.known.get, chunks))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            found = self._learn({chunks[i] for i in missing})
            for i in missing:
                ids[i] = found[chunks[i]]
        return [b"".join(ids[start:stop]) for start, stop in zip([0, *stops], stops)]


def _letter(char: str) -> bool:
    """Whether a character is a Latin letter that stays one letter in lower case."""
    return char < "\u0250" and char != "\u0130" and char.isalpha()


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


PIECE_FIELDS = "piece int, start bigint, length bigint, ids binary"


def token_pieces(
    df: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", sequence: int = SEQUENCE
) -> DataFrame:
    """Key, piece, start, length and ``ids`` (little-endian 32-bit) of every whole text.

    A text's ids end with ``END_ID``; null and empty texts have that id alone. Only texts longer than a sequence
    are cut, into pieces of its length and a last one. Repeated rows give pieces each, null keys stay null.
    """
    encoders: list[WordEncoder] = []

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        if not encoders:
            encoders.append(WordEncoder(tokenizer_path))
        end = int(END_ID).to_bytes(4, "little")
        row, piece, start, ids = [], [], [], []
        for i, packed in enumerate(encoders[0].encode(part.column("text").to_pylist())):
            packed += end
            for k, at in enumerate(range(0, len(packed), 4 * sequence)):
                row.append(i)
                piece.append(k)
                start.append(at // 4)
                ids.append(packed[at : at + 4 * sequence])
        keys = part.column("key").take(pa.array(row, pa.int64()))
        length = pa.array([len(x) // 4 for x in ids], pa.int64())
        columns = [keys, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), length, pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "piece", "start", "length", "ids"])

    schema = f"key {field_type(df, key)}, {PIECE_FIELDS}"
    return map_texts(df, {"key": key, "text": text}, schema, work).withColumnRenamed("key", key)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins of ``capacity`` that any packing of ``lengths`` needs."""
    own, counts = np.unique(lengths, return_counts=True)
    return count_bound(own.astype(np.int64), counts.astype(np.int64), capacity)


def count_bound(lengths: np.ndarray, many: np.ndarray, capacity: int) -> int:
    """Fewest bins for so ``many`` pieces of each of the distinct ``lengths``, by dual-feasible functions.

    Two families: lengths above ``capacity - e`` count as full bins and lengths below ``e`` as nothing, for every
    ``e`` up to half a bin; and lengths rounded down to multiples of 1/k of a bin, unless they are exact. The
    sum of a dual-feasible function over all lengths never exceeds the number of bins.
    """
    if not len(lengths):
        return 0
    counts = np.zeros(capacity + 1, np.int64)
    counts[lengths] = many
    sizes = np.arange(capacity + 1, dtype=np.int64)
    number, weight = np.cumsum(counts), np.cumsum(counts * sizes)
    e = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - e]
    middle = weight[capacity - e] - np.where(e > 0, weight[np.maximum(e, 1) - 1], 0)
    best = int(np.max(-(-(large * capacity + middle) // capacity)))
    for k in range(1, 21):
        exact = (k + 1) * sizes % capacity == 0
        value = np.where(exact, k * sizes, (k + 1) * sizes // capacity * capacity)
        best = max(best, int(-(-np.sum(counts * value) // (k * capacity))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins.

    Longest first, each into the open bin with the least room that suffices. Bins are kept by their room, and
    the rooms in use are the bits of one number, so finding the bin takes a shift.
    """
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + size
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, bins
            bins += 1
        where[i], offset[i] = b, capacity - room
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return where, offset, bins


def _pack_groups(pieces: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """Best-fit decreasing in each group; adds bin, offset, the bin's content and whether the group is certified."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("uid", "ascending")])
        lengths = table.column("length").to_numpy()
        where, offset, bins = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(where, weights=lengths, minlength=bins).astype(np.int64)
        certified = bins == lower_bound(lengths, capacity)
        added = {
            "turn": pa.array(np.full(len(where), turn, np.int32)),
            "bin": pa.array(where),
            "offset": pa.array(offset),
            "filled": pa.array(filled[where]),
            "certified": pa.array(np.full(len(where), certified)),
        }
        for name, values in added.items():
            table = table.append_column(name, values)
        return table

    group = F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)).cast("bigint")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    schema = f"{columns}, group bigint, turn int, bin bigint, offset bigint, filled bigint, certified boolean"
    return pieces.withColumn("group", group).groupBy("group").applyInArrow(pack, schema)


def total_bound(held: DataFrame, capacity: int) -> int:
    """``lower_bound`` over all lengths of a table: its counts per length are at most ``capacity`` rows."""
    counts = held.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return 0
    return count_bound(np.array([r.length for r in counts], np.int64), np.array([r.n for r in counts], np.int64), capacity)


def pack(pieces: DataFrame, capacity: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with a ``length`` column) plus ``sequence_id``, ``offset`` and ``certified``.

    Pieces as long as a sequence stand alone. The others are dealt by a hash into groups of about
    ``group_pieces``, each packed by best-fit decreasing in one task of bounded size; copies are dealt apart, so no
    group grows with a hot key. A group whose bin count equals its lower bound is certified: no packing of its
    pieces has fewer bins. Then groups exchange: full bins are kept, and the pieces of all bins with gaps, of
    certified groups too, are dealt anew and packed again, as long as that saves bins and the bins of all groups are
    more than the lower bound of all lengths together. ``certified`` tells whether a piece's last group was
    certified. Every row of ``pieces`` comes back once; an empty table gives no rows. Lengths must be 1 to ``capacity``.
    """
    held = stage(pieces.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    alone = held.filter(F.col("length") == capacity).select(
        *pieces.columns,
        (-1 - F.col("uid")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        F.lit(True).alias("certified"),
    )
    short = held.filter(F.col("length") < capacity)
    n, least = short.count(), total_bound(short, capacity)
    kept: list[DataFrame] = []
    turn, full_bins = 0, 0
    packed = stage(_pack_groups(short, max(1, -(-n // group_pieces)), turn, capacity), "pack-0")
    while True:
        gaps = F.col("filled") < capacity
        # A bin has one piece at offset 0, so bins are counted without a shuffle of distinct rows.
        first = F.col("offset") == 0
        size, open_bins, closed = packed.agg(F.count_if(gaps), F.count_if(gaps & first), F.count_if(~gaps & first)).first()
        if not size or full_bins + closed + open_bins <= least or turn + 1 >= 1 << TURN_BITS:
            break
        again = packed.filter(gaps).select(*short.columns)
        retried = stage(_pack_groups(again, max(1, -(-size // group_pieces)), turn + 1, capacity), f"pack-{turn + 1}")
        if retried.filter(first).count() >= open_bins:
            break
        kept.append(packed.filter(~gaps))
        full_bins += closed
        packed, turn = retried, turn + 1
    tail = [_numbered(part, pieces.columns) for part in [*kept, packed]]
    return reduce(DataFrame.unionAll, [alone, *tail])


#: Bits of an exchange's number, of a group's and of a bin's in a sequence id.
TURN_BITS, GROUP_BITS, BIN_BITS = 10, 29, 24


def _numbered(packed: DataFrame, columns: list[str]) -> DataFrame:
    turn = F.shiftleft(F.col("turn").cast("bigint"), GROUP_BITS + BIN_BITS)
    number = turn + F.shiftleft("group", BIN_BITS) + F.col("bin")
    return packed.select(*columns, number.alias("sequence_id"), "offset", "certified")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token sequences themselves: sequence_id and ``ids``, from pieces packed with their ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return packed.groupBy("sequence_id").agg(ids.alias("ids"))


def pack_digest(
    df: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", capacity: int = SEQUENCE
) -> DataFrame:
    """Where every piece of every document lies, with a checksum in place of its ids.

    Null and empty texts are one piece of one id. Repeated rows are packed each, null keys stay null, an empty table
    gives no rows, and columns other than the key and the text are not read, whatever their names.
    """
    pieces = token_pieces(df, tokenizer_path, text, key, capacity)
    crc = F.crc32("ids").alias("ids_crc32")
    return pack(pieces.select(key, "piece", "start", "length", crc), capacity).select(
        key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"
    )
