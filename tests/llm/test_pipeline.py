"""The corpus pipeline, stage by stage, against brute force on small tables."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pledgekit.llm import packing, secret_scan

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)

    def prose(n):
        return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(n))

    rows, marks = [], []
    for i in range(120):
        text = prose(60)
        if i % 5 == 0:
            text = text.replace(" ", "### ")
        if i % 7 == 1:
            text += " password = 0123456789abcdef"
        rows.append((i, text, "en", "abc"[i % 3] if i % 11 else None, len(text)))
        marks.append((i, int(i % 5 != 0), 0))
        if i % 10 == 3:
            rows.append((500 + i, text + " more", None, "z", None))
    rows += [(900, None, None, None, None), (901, "", "en", "a", 0), (902, prose(6000), "en", "b", 1)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def results(spark, folder):
    """Input and output rows of every stage, each written and read again."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, build) in enumerate(corpus_pipeline.STAGES):
        build(spark, docs, folder).write.parquet(f"{folder}/out{k}")
        after = spark.read.parquet(f"{folder}/out{k}")
        out.append((docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_stages_keep_the_columns(results):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "secret_scan", "mixing", "packing"]
    assert all(columns == ["doc_id", "text", "lang", "source", "n_chars"] for _, _, columns in results[:-1])


def test_classifier_drops_marked_documents_and_keeps_clean_ones(results):
    before, after, _ = results[0]
    kept = collections.Counter(after)
    assert not kept - collections.Counter(before)
    ids = {x.doc_id for x in after}
    assert {x.doc_id for x in before if x.doc_id < 120} - ids == set(range(0, 120, 5))


def test_one_document_of_each_group_stays(results):
    before, after, _ = results[1]
    sets, label = {x.doc_id: shingles(x.text) for x in before}, {x.doc_id: x.doc_id for x in before}
    for a in sorted(sets):
        for b in sorted(sets):
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert sorted(after, key=str) == sorted((x for x in before if label[x.doc_id] == x.doc_id), key=str)
    assert len(after) < len(before)


def test_secrets_are_replaced_and_nothing_else(results):
    before, after, _ = results[2]
    was = {x.doc_id: x for x in before}
    assert len(after) == len(before)
    for x in after:
        assert secret_scan.base_spans(x.text or "") == []
        assert x.n_chars == (None if x.text is None else len(x.text))
        found = secret_scan.find_secrets(was[x.doc_id].text or "")
        assert (x.text == was[x.doc_id].text) == (not found)
        if found:
            pattern = ".+".join(re.escape(p) for p in x.text.split("[secret]"))
            assert re.fullmatch(pattern, was[x.doc_id].text, re.S)


def test_mix_repeats_whole_documents(results):
    before, after, _ = results[3]
    times = collections.Counter(after)
    assert set(times) <= set(before) and max(times.values()) <= 2
    size = collections.Counter()
    for x in before:
        size[x.source] += len(words(x.text))
    total = sum(len(words(x.text)) for x in after)
    assert abs(total - 1.5 * sum(size.values())) <= len(size) * max(len(words(x.text)) for x in before)


def test_packing_holds_every_copy(results):
    before, after, _ = results[4]
    encode = packing.WordEncoder(corpus_pipeline.TOKENIZER).tokenizer.encode
    want = collections.Counter()
    for x in before:
        n = len(encode(x.text or "", add_special_tokens=False).ids) + 1
        want.update((x.doc_id, k, min(2048, n - 2048 * k)) for k in range(-(-n // 2048)))
    assert collections.Counter((x.doc_id, x.piece, x.length) for x in after) == want
    room = collections.defaultdict(list)
    for x in after:
        room[x.sequence_id].append((x.offset, x.offset + x.length))
    assert all(a[1] == b[0] for own in room.values() for a, b in zip(sorted(own), sorted(own)[1:]))
    assert all(min(own)[0] == 0 and max(own)[1] <= 2048 for own in room.values())
    assert len(room) <= packing.lower_bound(np.array([x.length for x in after]), 2048) + 1


def test_extra_columns_may_have_any_name(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["size", "repeats", "key", "score", "kept", "bucket", "row", "c0", "target", "label"]
    docs = docs.withColumns({n: F.lit(7) for n in names}).withColumn("text", F.lit(None).cast("string"))
    for _, build in corpus_pipeline.STAGES[:-1]:
        out = build(spark, docs, folder)
        assert out.columns == docs.columns
        assert all(x.size == x.row == 7 and x.text is None for x in out.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_run_is_the_stages_in_a_row(spark, folder, results):
    found = corpus_pipeline.run(spark, folder).select("doc_id", "piece", F.col("ids_crc32")).collect()
    assert collections.Counter(found) == collections.Counter((x.doc_id, x.piece, x.ids_crc32) for x in results[4][1])
