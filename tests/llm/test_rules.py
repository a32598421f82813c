"""Host rules against SQL and plain counting; shrinkage; odd rows."""

import functools
import operator
from collections import Counter

import pytest
from oracle import compare

from ledgerspark.llm import rules


def test_query_matches_sql(spark):
    assert compare(spark, "/root/testdata/sf0.01", "op3_quality_rules") is None


def plain_repeats(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(covered)


@pytest.mark.parametrize("text", [
    "", "a", "a b", "a b c", "a b c a b c", "a a a", "a a a a", "x y z x y z w", "one two three " * 50,
    "q w e r t y q w e u i o w e u", " a 　 b\x1cc a 　 b\x1cc",
])
def test_repeated_words(text):
    words = rules.words_of(text)
    assert rules.repeat_words(words) == plain_repeats(words)


def test_many_different_words():
    words = [str(i).encode() for i in range(1 << 20)] + [b"x", b"y", b"z"] * 2
    assert rules.repeat_words(words) == 6


def test_counts():
    assert rules.text_counts(" a　b #\n\x0b\n#|x\n a　b #\n\n") == (5, 11, 4, 1, 0, 3)
    assert rules.text_counts(None) == (0, 0, 0, 0, 0, 0)


def test_bad_host_holds_borderline_documents_to_the_soft_limits(spark):
    good, shout = " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}$$$" for i in range(100))
    mild = " ".join([*(f"w{i}" for i in range(98)), "$$$$$$$$", "$$$$$$$$"])
    rows = [(i, shout, "bad") for i in range(60)] + [(100, good, "bad"), (101, mild, "bad")]
    rows += [(200 + i, good, f"h{i % 7}") for i in range(70)] + [(300, mild, "h1"), (301, shout, "h1"), (302, shout, "few")]
    rows += [(400 + i, good, "few") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in rules.quality_rules(docs).collect()}
    # whatever its host, a document that breaks a limit goes
    assert not any(kept[i] for i in range(60)) and not kept[301] and not kept[302]
    # a mild one goes where the host is bad, a good one nowhere
    assert not kept[101] and kept[300] and kept[100] and all(kept[i] for i in range(200, 270))


def test_strictness_follows_the_shrunk_rate(spark):
    rows = [(h, 10, 100, 0, 0, 0, 5) for h in ("a", "b", "c") for _ in range(100)]  # short everywhere
    rows += [("a", 100, 100, 0, 0, 0, 5)] * 100 + [("b", 100, 100, 0, 0, 0, 5)] * 300 + [("c", 100, 100, 0, 0, 0, 5)] * 100
    rows += [("tiny", 10, 100, 0, 0, 0, 5)]
    counted = spark.createDataFrame(rows, "host string, " + ", ".join(f"{c} long" for c in rules.COUNTS))
    got = {r.host: r for r in rules.host_verdicts(counted, "host").collect()}
    rates = [0.5, 0.25, 0.5, 1.0]
    mean = sum(rates) / 4
    var = sum((r - mean) ** 2 for r in rates) / 3
    strength = max(mean * (1 - mean) / var - 1, 1)
    for host, failed, n in (("a", 100, 200), ("b", 100, 400), ("tiny", 1, 1)):
        rate = (failed + mean * strength) / (n + strength)
        assert got[host].short_rate == pytest.approx(rate)
        assert got[host].short_strict == pytest.approx(max(rate / mean, 1), abs=1e-6)
        assert got[host].lines_strict == 1
    assert mean < got["tiny"].short_rate < 1


def test_host_verdicts_act_on_the_test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    counted = rules.count_texts(docs, ["doc_id", "source"])
    with_hosts = rules.judge(counted, rules.host_verdicts(counted, "source"), "source").where("kept").count()
    alone = counted.select((~functools.reduce(operator.or_, rules.broken(rules.Limits()).values())).alias("kept")).where("kept").count()
    assert 0.97 * alone < with_hosts < alone


def test_lines_count_against_lines(spark):
    words = [f"w{i} x{i} y{i} z{i} v{i}" for i in range(30)]
    few, many = "\n".join([*words, *words[:3]]), "\n".join([*words[:20], *words[:12]])
    docs = spark.createDataFrame([(1, few, "s"), (2, many, "s")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    assert (got[1].n_dup_lines, got[1].n_lines) == (3, 33) and (got[2].n_dup_lines, got[2].n_lines) == (12, 32)
    assert not got[2].kept


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(None, None, None, "x", 1), (1, "", "s", None, 2), (2, long, None, "y", 3), (2, long, None, "y", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, host string, n_words long")
    got = rules.quality_rules(docs).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in got) == [
        (0, 0, False), (1, 0, False), (2, 120_000, True), (2, 120_000, True)]
    kept = rules.filter_documents(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == rows[2:]
    for some in (rules.quality_rules(docs.limit(0)), rules.filter_documents(docs.limit(0))):
        assert some.collect() == []
