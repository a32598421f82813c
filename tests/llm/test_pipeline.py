"""Each stage on its own input against plain work, and the whole."""

import numpy as np
import pytest
import test_packing
import test_simhash
import test_suffix

import corpus_pipeline
from ledgerspark.llm import cotrain, packing, pieces, rules, suffix
from ledgerspark.llm.queries import PIECE_MODEL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows before and after each stage, as {name: (before, after)}."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, FOLDER)
        path = str(tmp_path_factory.mktemp("step") / "rows")
        after.write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = docs.collect(), after.collect()
        docs = after
    return out


def columns(rows):
    return set(rows[0].asDict())


def test_stages_keep_the_columns(steps):
    want = {"doc_id", "text", "lang", "source", "n_chars"}
    for before, after in list(steps.values())[:-1]:
        assert columns(before) == columns(after) == want
        assert 0 < len(after) <= len(before)


def test_rules_stage(spark, steps):
    before, after = steps["quality rules"]
    judged = rules.quality_rules(spark.createDataFrame(before)).collect()
    for r in judged:
        counts = rules.text_counts(next(d.text for d in before if d.doc_id == r.doc_id))
        assert r.base_failed == (counts[0] < 50 or 2 * counts[4] > counts[0])
        assert not (r.kept and (10 * counts[2] > counts[1] or 10 * counts[3] > 3 * counts[5]))
        assert not (r.kept and r.base_failed)
    assert {r.doc_id for r in judged if r.kept} == {r.doc_id for r in after}


def test_classifier_stage(spark, steps):
    before, after = steps["quality classifier"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = cotrain.classify(spark.createDataFrame(before), labels).collect()
    assert {r.doc_id for r in judged if r.kept} == {r.doc_id for r in after}
    clean = {r.doc_id for r in labels.collect() if r.quality and not r.toxic}
    lost = clean & {r.doc_id for r in before} - {r.doc_id for r in after}
    assert len(lost) <= 0.02 * len(clean)


def test_near_dedup_stage(steps):
    before, after = steps["simhash near-dedup"]
    groups = test_simhash.plain_groups([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == {least for _, least in groups.values()}
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text == texts[r.doc_id] for r in after)


def test_passage_stage(steps):
    """Bytes first, then words of what is left, each by a plain table of all windows."""
    before, after = steps["suffix-array dedup"]
    docs = sorted((r.doc_id, r.text) for r in before)
    raw, gone = test_suffix.plain(docs, suffix.LEAST, keep_first=True)
    got, seen, cut = {r.doc_id: r for r in after}, set(), 0
    for (doc_id, _), data, flags in zip(docs, raw, gone):
        left = suffix.kept_bytes(data, [(int(i), int(i) + 1) for i in np.flatnonzero(flags)]).decode("utf-8", "ignore")
        words = left.encode().split()
        if flags.any() and not words:
            assert doc_id not in got
            continue
        repeated = np.zeros(len(words), bool)
        for at in range(len(words) - suffix.LEAST_WORDS + 1):
            window = tuple(words[at:at + suffix.LEAST_WORDS])
            repeated[at:at + suffix.LEAST_WORDS] |= window in seen
            seen.add(window)
        cut += int(repeated.sum())
        want = [w for w, out in zip(words, repeated) if not out]
        if repeated.any() and not want:
            assert doc_id not in got
            continue
        assert got[doc_id].text.encode().split() == want and got[doc_id].n_chars == len(got[doc_id].text)
        assert repeated.any() or got[doc_id].text == left
    assert cut


def test_packing_stage(spark, steps):
    before, after = steps["packing"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    model = pieces.model_of(open(pieces.tokenizer_path(PIECE_MODEL), "rb").read())
    assert {r.doc_id: r.n_tokens for r in after} == {
        r.doc_id: len(model.encode(r.text or "").ids) + 1 for r in before}
    test_packing.check(after, packing.TOKEN_BUDGET)


def test_run_is_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    want = steps["packing"][1]
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def test_odd_documents(spark, tmp_path):
    prose = " ".join(f"word{i} and{i * 7 % 13}" for i in range(90))
    rows = [(None, prose, None, None, None, "x"), (None, prose, None, None, None, "x"), (1, None, "en", "s", 3, "x"),
            (2, "", "en", "s", 0, None), (3, prose + " tail", "en", "s", 5, "y"), (3, prose + " tail", "en", "s", 5, "y"),
            (4, "long " + " ".join(f"w{i}" for i in range(60_000)), "de", None, 9, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty.write.parquet(str(tmp_path / "labels.parquet"))
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
        left = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        # the rows without an id are near copies of row 3, and ids come before nulls
        assert sorted(r.doc_id for r in left) == ([3, 4] if some else [])
