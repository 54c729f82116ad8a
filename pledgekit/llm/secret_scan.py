"""Secret scans: fixed patterns, and windows of high entropy over candidate strings."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgekit.llm.text import field_type, map_texts

# The base patterns, the kinds in their order, and the least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run is taken whole, so a run that is too short has no part that is long enough.
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGNED, MIN_ACCESS = 12, 18
BASE_KINDS = ("assign", "access", "hex")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")


@dataclass(frozen=True)
class EntropyClass:
    """Runs of one character class; a window over a run counts from ``bits`` bits per character."""

    kind: str
    run: re.Pattern
    window: int
    bits: float


CLASSES = (
    EntropyClass("hex_entropy", re.compile(r"[0-9A-Fa-f]{20,}"), 20, 3.0),
    EntropyClass("base64_entropy", re.compile(r"[A-Za-z0-9+/_=-]{24,}"), 24, 3.9),
)
KINDS = BASE_KINDS + tuple(c.kind for c in CLASSES)

# Allow-list: what looks random and is no secret. A candidate inside one of these is left alone. A URL ends at
# quotes, separators, brackets, its query or fragment, and the value of a name in its path; of a user in it
# nothing is allowed. Mail addresses are found from their @ sign, so a long text without one costs nothing.
ALLOWED = re.compile(
    r"""https?://(?P<user>[^\s"'`,;|\\^<>()\[\]{}«»“”‘’?#&@/]*@)?(?:[^\s"'`,;|\\^<>()\[\]{}«»“”‘’?#&=]|=(?![A-Za-z0-9+/_-]))*"""
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
)
MAIL_USER, MAIL_HOST = re.compile(r"[\w.+-]"), re.compile(r"[\w-]+\.[\w.-]+")
#: Words that mark the candidate they are part of as made up.
MADE_UP = re.compile("EXAMPLE|example|placeholder")


class _Spans:
    """Spans by start, with the farthest end so far: whether any holds a given span is one search."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        ordered = sorted(spans)
        self.starts = [a for a, _ in ordered]
        self.ends = list(accumulate((b for _, b in ordered), max))

    def hold(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start)
        return at > 0 and self.ends[at - 1] >= end


def allowed_spans(text: str) -> _Spans:
    found = [(m.start(), m.end(), m.end("user") if m["user"] else m.start()) for m in ALLOWED.finditer(text)]
    begins = [a for a, _, _ in found]
    spans = [(inner, b) for _, b, inner in found]
    at = text.find("@")
    while at >= 0:
        before = bisect_right(begins, at) - 1
        if before < 0 or found[before][1] <= at:  # not within a URL
            least = found[before][1] if before >= 0 else 0
            start = at
            while start > least and MAIL_USER.match(text, start - 1):
                start -= 1
            host = MAIL_HOST.match(text, at + 1)
            if start < at and host:
                spans.append((start, host.end()))
        at = text.find("@", at + 1)
    return _Spans(spans)


def _made_up_spans(run: str) -> Callable[[int, int], bool]:
    """Whether the part of a run, between equals signs, that has most of a span holds a word for made-up values."""
    if not MADE_UP.search(run):
        return lambda start, end: False
    parts = [(m.start(), m.end(), bool(MADE_UP.search(m[0]))) for m in re.finditer("[^=]+", run)]
    ends = [b for _, b, _ in parts]

    def test(start: int, end: int) -> bool:
        most, marked = 0, False
        for a, b, made_up in islice(parts, bisect_right(ends, start), None):
            if a >= end:
                break
            if min(b, end) - max(a, start) > most:
                most, marked = min(b, end) - max(a, start), made_up
        return marked

    return test


def _mixed(part: str) -> bool:
    """Words and plain numbers are no secrets: one needs letters and digits."""
    return any(c.isdigit() for c in part) and any(c.isalpha() for c in part)


def entropy_runs(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged spans of the windows of a run whose Shannon entropy reaches ``bits``.

    Moving the window on changes two counts; the entropy is log2(window) - sum(c log2 c) / window, so each step
    updates two terms.
    """
    term = [0.0, *[c * math.log2(c) for c in range(1, window + 2)]]
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    limit = (math.log2(window) - bits) * window + 1e-9
    for at, char in enumerate(run):
        n = counts.get(char, 0)
        total += term[n + 1] - term[n]
        counts[char] = n + 1
        if at >= window:
            left = run[at - window]
            n = counts[left]
            total += term[n - 1] - term[n]
            counts[left] = n - 1
        if at >= window - 1 and total <= limit:
            start = at - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], at + 1)
            else:
                spans.append((start, at + 1))
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("hex", *m.span()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    low = text.lower()  # only to see whether a keyword is there; ASCII letters keep their neighbours
    if any(k in low for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    return found


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; positions are code points, ends exclusive.

    Entropy spans that lie within a base span or an allowed string, or are marked as made up by a word in the
    same run, add nothing and are left out.
    """
    found = base_spans(text)
    allowed: _Spans | None = None
    for cls in CLASSES:
        # Spans of one class do not overlap, so those of earlier kinds are all that can hold them.
        held = _Spans((a, b) for _, a, b in found)
        for m in cls.run.finditer(text):
            if not _mixed(m[0]):
                continue
            made_up = _made_up_spans(m[0])
            for a, b in entropy_runs(m[0], cls.window, cls.bits):
                if made_up(a, b):
                    continue
                a, b = a + m.start(), b + m.start()
                if not _mixed(text[a:b]) or held.hold(a, b):
                    continue
                if allowed is None:
                    allowed = allowed_spans(text)
                if not allowed.hold(a, b):
                    found.append((cls.kind, a, b))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def secret_spans(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and ``spans`` of every whole text.

    A null or empty text has an empty list. Repeated rows are scanned each, null keys stay null, an empty
    table gives no rows. One narrow pass in bounded slices; a row's cost follows its length. What lies in the path of
    a URL is allowed, random or not, unless a base pattern matches it; so tokens in the path of a web hook go unreported.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t or "")]
            for t in part.column("text").to_pylist()
        ]
        return pa.RecordBatch.from_arrays([part.column("key"), pa.array(spans, _SPAN)], names=["key", "spans"])

    schema = f"key {field_type(df, key)}, spans {SPANS}"
    return map_texts(df, {"key": key, "text": text}, schema, work).withColumnRenamed("key", key)


def redact_secrets(df: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every span of a text replaced by ``mark``; overlapping spans become one mark, null stays null."""

    def clean(value: str | None) -> str | None:
        if value is None:
            return None
        out, done = [], 0
        merged: list[list[int]] = []
        for _, a, b in find_secrets(value):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            out += [value[done:a], mark]
            done = b
        return "".join([*out, value[done:]])

    names = {f"c{i}": c for i, c in enumerate(df.columns)}
    at = df.columns.index(text)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        cleaned = pa.array([clean(t) for t in part.column(at).to_pylist()], part.schema.field(at).type)
        return part.set_column(at, part.schema.field(at), cleaned)

    schema = ", ".join(f"{n} {field_type(df, c)}" for n, c in names.items())
    return map_texts(df, names, schema, work, f"c{at}").toDF(*df.columns)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def span_digest(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text.

    Without spans the counts are 0, the digest is that of nothing and the text is empty; null keys stay null, and an
    empty table gives no rows.
    """

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return spans.select(
        key,
        *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_joined(of(*BASE_KINDS)), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
