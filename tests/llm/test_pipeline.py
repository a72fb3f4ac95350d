"""Each pipeline stage against a brute-force form over its own input, on the smallest tables."""

import collections
import hashlib
import os
import re

import pytest

import corpus_pipeline
from touchgrid.llm import pieces

STRIPPED = " \t\n\x0b\x0c\r"


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in re.split(r"[ \t-\r]+", (text or "").lower()) if w]


SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, fn in corpus_pipeline.STAGES:
        done = fn(spark, docs, SF)
        out.append((name, docs.collect(), done.collect(), done.columns))
        docs = spark.createDataFrame(out[-1][2], done.schema)
    return out


def test_columns_and_names(stages):
    assert [s[0] for s in stages] == [n for n, _ in corpus_pipeline.STAGES]
    for _, _, _, columns in stages[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_keeps_clean_documents(stages):
    _, before, after, _ = stages[0]
    kept = {r.doc_id for r in after}
    assert all(re.search(r"[^\W\d_]", r.text or "") for r in after)
    assert len(kept) > 0.95 * len(before)


def test_lines(stages):
    _, before, after, _ = stages[1]
    holders = collections.defaultdict(set)
    for r in before:
        for line in (r.text or "").split("\n"):
            key = lower_ascii(line.strip(STRIPPED))
            if len(key) >= 10:
                holders[key].add(r.doc_id)
    want = {}
    for r in before:
        keep = []
        for line in (r.text or "").split("\n"):
            key = lower_ascii(line.strip(STRIPPED))
            if len(key) < 10 or len(holders[key]) < 2 or min(holders[key]) == r.doc_id:
                keep.append(line)
        want[r.doc_id] = "\n".join(keep)
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_near_copies(stages):
    _, before, after, _ = stages[2]
    sets = {}
    for r in before:
        w = words(r.text)
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids, group = sorted(sets), {i: i for i in sets}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, x in enumerate(ids):
        for y in ids[i + 1:]:
            shared = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 5 * shared >= 4 * (len(sets[x]) + len(sets[y]) - shared):
                a, b = sorted((top(x), top(y)))
                group[b] = a
    assert sorted(r.doc_id for r in after) == [i for i in ids if top(i) == i]


def test_decontamination(spark, stages):
    _, before, after, _ = stages[3]

    def grams(text):
        w = [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    items = [grams(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in before for g in items if g and len(g & grams(r.text)) >= 0.8 * len(g)}
    clean = {r.doc_id for r in before if not any(g & grams(r.text) for g in items)}
    kept = {r.doc_id for r in after}
    assert not leaks & kept and clean <= kept


def test_pieces(stages):
    _, before, after, _ = stages[4]
    table = pieces.PieceTable.load()
    got = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    for r in before:
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        assert got[r.doc_id].n_tokens == len(got[r.doc_id].ids) and max(got[r.doc_id].ids, default=0) < table.size


def test_run_applies_every_stage(spark, stages):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()) == sorted(r.doc_id for r in stages[-1][2])


def test_columns_that_clash(spark):
    """Columns named like what a stage computes come through, and change nothing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    extra = ["kept_text", "n_lines", "N_Dropped", "doc", "body", "gone_id", "words", "chunk", "lang_pred", "score", "a.b"]
    wide = docs.selectExpr("*", *[f"'x{i}' AS `{c}`" for i, c in enumerate(extra)])
    for _, fn in corpus_pipeline.STAGES[:-1]:
        done = fn(spark, wide, SF)
        assert done.columns == wide.columns
        plain = fn(spark, docs, SF)
        assert sorted(map(tuple, done.select(*docs.columns).collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
        assert {tuple(r[-len(extra):]) for r in done.collect()} == {tuple(f"x{i}" for i in range(len(extra)))}
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SF).count() == docs.count()
