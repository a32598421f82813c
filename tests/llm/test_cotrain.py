"""Co-training: accuracy on labels it never saw, views that teach each other, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from ledgerspark.llm import cotrain

FOLDER = "/root/testdata/sf0.1"


def test_accuracy_on_labels_it_never_saw(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0
    got = cotrain.classify(docs, labels.where(~held))
    rows = got.join(labels.where(held), "doc_id").collect()
    assert got.count() == docs.count()
    toxic = [r for r in rows if r.toxic]
    bad = [r for r in rows if not r.quality]
    clean = [r for r in rows if r.quality and not r.toxic]
    caught = sum(not r.kept for r in toxic) / len(toxic), sum(not r.kept for r in bad) / len(bad)
    lost = sum(not r.kept for r in clean) / len(clean)
    print(len(toxic), len(bad), len(clean), caught, lost)
    assert caught[0] > 0.75 and caught[1] > 0.97 and lost < 0.005
    assert all(0 <= s <= 1 for r in rows for s in (r.bad_score, r.toxic_score, r.score))


def test_views_teach_each_other():
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 2, 3000)
    # few labels, words that say it plainly and a source that says it almost always
    text = [np.unique(np.concatenate([rng.integers(100 + 500 * t, 600 + 500 * t, 6), rng.integers(2000, 2400, 10)])
                      ).astype(np.int32) for t in truth]
    meta = [np.array([t if rng.random() < 0.97 else 1 - t, 50 + rng.integers(0, 9)], np.int32) for t in truth]
    seen = truth.copy()
    seen[60:] = -1
    args = cotrain.Rows.of(text), cotrain.Rows.of(meta)
    alone, taught = (cotrain.co_train(*args, seen, rounds=r) for r in (0, 4))
    right = [((t.scores(*args) >= 0.5) == truth)[60:].mean() for t in (alone, taught)]
    by_text = [(((cotrain.odds(args[0], t.text) > 0) == truth)[60:]).mean() for t in (alone, taught)]
    assert right[1] > 0.96 and by_text[1] >= by_text[0]


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, "x"), (1, "", "en", "s", 0, "x"),
         (2, "word " * 60_000, None, "s", 5, None)],
        "doc_id long, text string, lang string, source string, n_chars long, kept string")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0), (2, 1, 0), (2, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        got = cotrain.classify(docs, some).collect()
        assert len(got) == 4 and all(r.kept for r in got)
        assert [r.kept for r in cotrain.filter_documents(docs, some).select("kept").collect()].count("x") == 3
    assert cotrain.classify(docs.limit(0), labels).collect() == []


def test_all_unlabelled_documents_take_part_and_executors_agree_with_memory(spark):
    # 40 labelled documents; 6,000 without a label, of which one in ten has a word that no label knows
    rows = [(i, f"{'foul' if i % 2 else 'fair'} {'rare' if i % 2 and i % 10 == 1 and i >= 40 else 'plain'}", "en",
             "a" if i % 2 else "b", 9) for i in range(6040)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    known = cotrain.Unlabelled(cotrain.unlabelled_features(docs, labels), "bad")
    assert known.rows.count() == 6000
    got = cotrain.Held({n: cotrain.Rows.from_column(known.rows.toArrow()[n]) for n in cotrain.VIEWS},
                       known.rows.toArrow()["draw"].to_numpy())
    weights = {n: np.zeros(size + 1) for n, (size, _) in cotrain.VIEWS.items()}
    weights["text"][cotrain.word_number(b"foul")] = 9.0
    weights["meta"][cotrain.meta_numbers("en", "a", 9)] = 2.0
    one = cotrain.Round(weights, {"text": np.array([1.0, -4.5]), "meta": np.array([1.0, -3.0])}, {})
    (n, sure), (m, also) = known.sureness([one]), got.sureness([one])
    assert n == m == 6000 and all((sure[k] == also[k]).all() for k in sure)
    assert sure["text", 1].sum() == sure["text", 0].sum() == 3000
    one.set_limits(sure, n, 0.5)
    a, b = known.lessons([one]), got.lessons([one])
    for name in cotrain.VIEWS:
        assert (a[name].yes == b[name].yes).all() and (a[name].no == b[name].no).all()
    # five in a hundred of all 6,000, half of either class
    assert 110 < a["meta"].all_yes < 190 and 110 < a["meta"].all_no < 190
    assert a["text"].yes[cotrain.word_number(b"rare")] > 0
    assert cotrain.LABELLED == 20_000
