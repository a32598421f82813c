"""Decontamination against SQL and plain windows; the automaton against all runs; groups; odd rows."""

import hashlib
import random
import re

import pytest
from oracle import compare

from ledgerspark.llm import decontaminate


def test_query_matches_sql(spark):
    assert compare(spark, "/root/testdata/sf0.01", "op13_benchmark_decontamination") is None


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def plain(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[at:at + size]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                run = tuple(words[at:at + size])
                if run in windows:
                    hit |= set(range(at, at + size))
                    found |= windows[run]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"))


def random_texts(n, vocabulary, least, most, seed):
    draw = random.Random(seed)
    return [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(least, most))) for _ in range(n)]


@pytest.mark.parametrize("words, window", [("ab", 10), ("abc", 4), ("abcdefgh", 3), ("ab", 1)])
def test_few_words_make_many_matches(spark, rows, words, window):
    docs = list(enumerate(random_texts(60, words + "z", 0, 60, 1)))
    items = list(enumerate(random_texts(40, words, 0, 25, 2)))
    got = rows(decontaminate.contamination(*frames(spark, docs, items), window=window))
    assert got == plain(docs, items, window)


@pytest.mark.parametrize("group_words", [60, 200])
def test_groups_of_items_give_the_same(spark, rows, group_words):
    docs = list(enumerate(random_texts(50, "abcdz", 0, 80, 3)))
    items = list(enumerate(random_texts(30, "abcd", 0, 60, 4))) + [(99, "a b"), (99, "d d d"), (7, "c c c c c")]
    docs[0] = (0, items[3][1] + " z " + items[4][1])
    pair = frames(spark, docs, items)
    got = rows(decontaminate.contamination(*pair, window=5, group_words=group_words))
    assert got == plain(docs, items, 5)
    one = decontaminate.find(*pair, ["doc_id"], 5).select("doc_id", "spans", "items")
    many = decontaminate.find(*pair, ["doc_id"], 5, group_words=group_words).select("doc_id", "spans", "items")
    # spans that only touch may be one span or two
    merged = lambda r: (r.doc_id, sorted(i for s in r.spans for i in range(s.start, s.end)), r.items)
    assert sorted(map(merged, one.collect())) == sorted(map(merged, many.collect()))


def test_longest_match():
    draw = random.Random(5)
    items = [[bytes([draw.choice(b"abc")]) for _ in range(draw.randint(1, 30))] for _ in range(12)]
    made = decontaminate.Automaton([(w, i) for i, w in enumerate(items)], window=4)
    runs = {tuple(w[i:j]) for w in items for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    for _ in range(50):
        words = [bytes([draw.choice(b"abcd")]) for _ in range(40)]
        best = max((j - i for i in range(40) for j in range(i + 1, 41) if tuple(words[i:j]) in runs), default=0)
        assert made.match(words)[0] == (best if best >= made.least else made.match(words)[0])
    # no more states than twice the words
    assert len(made.step) <= 2 * sum(map(len, items)) + 1


def test_spans_are_cut_and_covered_documents_go(spark):
    passage = "One, two three FOUR five six seven eight nine ten eleven"
    docs = [(1, f"Before it: {passage}! After it."), (2, passage), (3, "clean text"), (4, None), (5, ""),
            (6, f"x {passage} y " + "w " * 30 + passage.lower() + " tail é")]
    cleaned = decontaminate.clean_documents(*frames(spark, docs, [(1, passage)]), coverage=0.8)
    got = {r.doc_id: r.text for r in cleaned.collect()}
    assert got == {1: "Before it: ! After it.", 3: "clean text", 4: None, 5: "", 6: "x  y " + "w " * 30 + " tail é"}
    kept = decontaminate.clean_documents(*frames(spark, docs, [(1, passage)]), coverage=1.0)
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 6}


def test_odd_rows(spark, rows):
    item = " ".join(f"w{i}" for i in range(12))
    docs = [(None, None), (1, ""), (2, item), (2, item), (3, "!!! ..."), (4, "x " * 200_000 + item), (5, "É é ÉÉ"),
            (6, item.upper() + " y " + item[:20]), (7, " w1\tw2 ")]
    items = [(None, item), (1, item), (1, item), (2, None), (3, ""), (4, "--"), (5, "é"), (6, "W1 w2"), (10, "zz " * 12)]
    docs_frame, items_frame = frames(spark, docs, items)
    assert rows(decontaminate.contamination(docs_frame, items_frame)) == plain(docs, items)
    extra = docs_frame.selectExpr("*", "1 AS _row", "2 AS spans", "'x' AS items", "3 AS n_words", "4 AS row")
    more = items_frame.selectExpr("*", "'w' AS words", "1 AS n", "2 AS at")
    assert rows(decontaminate.contamination(extra, more)) == plain(docs, items)
    assert decontaminate.clean_documents(extra, more).columns == extra.columns
    assert rows(decontaminate.contamination(extra, more.limit(0))) == plain(docs, [])
    assert decontaminate.contamination(extra.limit(0), more).collect() == []
