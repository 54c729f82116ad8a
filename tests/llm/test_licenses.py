"""License scan against brute force over whole texts, and the edge cases its docstring names."""

import collections
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pledgekit.llm import license_scan as scan

SCHEMA = "doc_id bigint, text string, at int, id string, labels int, blocks string, n_words string"
WORD = re.compile("[^\\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, templates=scan.TEMPLATES, percent=scan.CONTAINMENT):
    w = words(text)
    places = {p: [i for i in range(len(w)) if w[i : i + len(p.split())] == p.split()] for p in scan.PHRASES}
    every = sorted(i for own in places.values() for i in own)
    base = {scan.PHRASES[p] for p, own in places.items() if own}
    labels, share, n = set(base), 1.0 if every else 0.0, 0
    for t in templates:
        tokens = set(t.text.split())
        length = len(t.text.split())
        stride = next(s for s in (1, 2, 4, 8, 16, 32, 64) if s >= length)
        for a in range(0, len(w), stride):
            common = len(tokens & set(w[a : a + 2 * stride]))
            if 100 * common >= percent * len(tokens):
                labels, share, n = labels | {t.label}, max(share, common / len(tokens)), n + 1
    ends = (every[0], every[-1]) if every else (None, None)
    return len(w), len(every), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), share, n


COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_blocks")


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    pool = sorted({w for t in scan.TEMPLATES for w in t.words}) + ["the"] * 30 + ["work"] * 30 + ["rien"] * 60

    def prose(n):
        return [r.choice(pool) for _ in range(n)]

    out = [(None, "Licensed under the MIT license"), (None, None), (1, None), (2, ""), (3, " .,-\n\x7f"), (4, "All rights; RESERVED!")]
    out += [(5, "CC-BY"), (5, "cc by"), (5, "cc by"), (6, "all rights all rights reserved reserved cc cc by by CC BY NC 4.0 licensed"),
            (7, "GNU General Public License"), (8, "general public license " * 400), (9, "é ccéby ＣＣ by"), (11, "\u212aey \u0130n CC\u0000By MIT\u212a MIT licen\u017fe"), (12, "released under the m\u0130t license Cc  bY"), (10, "MIT license " * 900)]
    for i, t in enumerate(scan.TEMPLATES):
        own = t.text.split()
        out.append((100 + i, " ".join(prose(r.randrange(40)) + own + prose(20))))
        r.shuffle(own)
        out.append((200 + i, "\n".join(w.upper() + "," for w in own[: len(own) - 1 - i % 2])))  # some words away
        out.append((300 + i, " ".join(w for x in own for w in (x, "gap"))))  # words with gaps
    out += [(400 + i, " ".join(prose(n))) for i, n in enumerate((1, 7, 16, 17, 60, 300, 3000))]
    out.append((500, " ".join(["gap"] * 20_000 + scan.TEMPLATES[1].text.split())))
    return out


def check(spark, rows, **parameters):
    df = spark.createDataFrame([(*x, 1, "clash", 2, "clash", "clash") for x in rows], SCHEMA).repartition(3)
    got = collections.Counter(tuple(x[c] for c in COLUMNS) for x in scan.scan_licenses(df, **parameters).collect())
    assert got == collections.Counter((i, *brute(text, **parameters)) for i, text in rows)
    return got


def test_licenses(spark, rows):
    found = check(spark, rows)
    assert {x for row in found for x in row[6].split(",")} >= {t.label for t in scan.TEMPLATES} | set(scan.PHRASES.values())
    assert any(0 < row[7] < 1 for row in found)


@pytest.mark.parametrize("percent", [1, 50, 75, 100])
def test_any_threshold(spark, rows, percent):
    """Filters lose no block and add none, whatever part of the template must be there."""
    templates = (*scan.TEMPLATES[:4], scan.Template("one", "license"), scan.Template("again", "the work of the work"))
    check(spark, rows, percent=percent, templates=templates)


def test_every_matching_block_is_listed(spark, rows):
    df = spark.createDataFrame([(5, scan.TEMPLATES[0].text + " x" * 8), (6, "x " * 16 + scan.TEMPLATES[0].text)], "doc_id bigint, text string")
    table, order = scan.scan_table(df, "text", "doc_id")
    got = scan.template_matches(table, order).join(table.select("at", "id"), "at").select("id", "stride", "block", "label", "common", "n")
    assert sorted(map(tuple, got.collect())) == [(5, 8, 0, "agpl", 8, 8), (6, 8, 1, "agpl", 8, 8), (6, 8, 2, "agpl", 8, 8)]


def test_no_rows(spark):
    assert scan.scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


def test_native(spark, rows):
    """No Python in the plans, and the texts are never shuffled."""
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
    table, order = scan.scan_table(df, "text", "doc_id")
    for frame in (table, scan.template_matches(table, order), scan.scan_licenses(df)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|ArrowEval|MapIn|CartesianProduct|BroadcastNestedLoop", plan)
    assert "Exchange hash" not in table._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=8), st.integers(1, 100))
def test_needed_words(own, percent):
    t = scan.Template("x", " ".join(own))
    need = t.need(percent)
    assert 100 * need >= percent * len(set(own)) and (need == 1 or 100 * (need - 1) < percent * len(set(own)))
    assert len(own) <= t.stride < 2 * len(own) or t.stride == 1
