"""Benchmark decontamination by a generalised suffix automaton of the test items.

The normalised words of the items go into one automaton. The words of a document are
streamed through it; at each word it gives the length of the longest run of words, ending
there, that occurs in some item. A word is hit when it lies in a run of at least ``window``
words, or in a whole item of fewer words. Spans of hit words are cut out of the text, and a
document of which more than a share is hit goes as a whole.

A word that no item has ends every match, so a document's words are looked up first and only
stretches of known words long enough for a match are streamed. All words of a document count
and whole texts are read; documents are never shuffled.

The items' words are counted before anything is sent to the tasks. Up to ``group_words``
make one automaton; more of them are cut into pieces that overlap by ``window`` - 1 words, so
that every window lies in a piece, and dealt into groups of fewer words than that. Each group
has an automaton and a pass of its own and what the passes find is put together by row, so
memory is bounded and the result the same.

Null texts have no words; items without words match nothing. Items with one id are one item,
a null id counts as empty text. Repeated rows are judged alike, extra columns do not matter
and stay in ``clean_documents``. Without documents there is no row, without items no hit.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.sources.scratch import stable

WINDOW = 10
#: Words of one automaton: about 100 MB in a Python worker.
GROUP_WORDS = 200_000
PIECE_WORDS = 2_000
#: A document goes when more than this share of its words is hit.
COVERAGE = 0.5

_OTHER = [c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)]
#: Letters A-Z to a-z, everything else of ASCII but digits and letters to a space.
NORMAL = bytes.maketrans(bytes([*_OTHER, *range(65, 91)]), b" " * len(_OTHER) + bytes(range(97, 123)))

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = [T.StructField("n_words", T.LongType()), T.StructField("longest", T.LongType()),
         T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))]


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


class Automaton:
    """Suffix automaton of several word sequences, each given with the number of its item.

    A state stands for the runs of words that occur at the same places; ``length`` is that
    of its longest run, ``link`` the state of the longest run that has more places.
    """

    def __init__(self, sequences: list[tuple[list[bytes], int]], window: int = WINDOW):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        placed = []
        for words, item in sequences:
            codes = [self.codes.setdefault(w, len(self.codes)) for w in words]
            state = 0
            for code in codes:
                state = self._extended(state, code)
            placed.append((codes, item))
        #: items that have the state's run of ``window`` words, and whole items of fewer words that are the run
        self.window_items: dict[int, set[int]] = {}
        self.whole_items: dict[int, set[int]] = {}
        for codes, item in placed:
            if codes and len(codes) < window:
                self.whole_items.setdefault(self._state_of(codes), set()).add(item)
            for at in range(len(codes) - window + 1):
                self.window_items.setdefault(self._state_of(codes[at:at + window]), set()).add(item)
        shortest = min((self.length[s] for s in self.whole_items), default=window)
        #: no shorter stretch of known words can hold a match
        self.least = min(window, shortest)
        self._wholes = self._whole_suffixes()

    def _extended(self, last: int, code: int) -> int:
        """State of the run of ``last`` and one more word."""
        known = self.step[last].get(code)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, code, known)
        new = self._state({}, self.length[last] + 1, 0)
        at = last
        while at >= 0 and code not in self.step[at]:
            self.step[at][code] = new
            at = self.link[at]
        if at >= 0:
            known = self.step[at][code]
            self.link[new] = known if self.length[known] == self.length[at] + 1 else self._split(at, code, known)
        return new

    def _split(self, at: int, code: int, known: int) -> int:
        """A state for the runs of ``known`` that are no longer than the one through ``at``."""
        copy = self._state(dict(self.step[known]), self.length[at] + 1, self.link[known])
        self.link[known] = copy
        while at >= 0 and self.step[at].get(code) == known:
            self.step[at][code] = copy
            at = self.link[at]
        return copy

    def _state(self, step: dict[int, int], length: int, link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _state_of(self, codes: list[int]) -> int:
        state = 0
        for code in codes:
            state = self.step[state][code]
        return state

    def _whole_suffixes(self) -> dict[int, tuple[tuple[int, int], ...]]:
        """For each state the (length, state) of whole short items among its suffixes, longest first."""
        if not self.whole_items:
            return {}
        found: dict[int, tuple[tuple[int, int], ...]] = {-1: ()}
        for state in sorted(range(len(self.step)), key=self.length.__getitem__):
            above = found[self.link[state]]
            # a whole item is its state's longest run, as no word comes before it at its own place
            found[state] = ((self.length[state], state), *above) if state in self.whole_items else above
        return {s: f for s, f in found.items() if f}

    def match(self, words: list[bytes]) -> tuple[int, list[tuple[int, int]], set[int]]:
        """(longest length matched, spans of hit words, numbers of the items found); lengths below ``least``
        may be left out."""
        codes = np.fromiter(map(self.codes.get, words, [-1] * len(words)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], codes >= 0, [False])).astype(np.int8)))
        longest, spans, states = 0, [], set()
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < self.least:
                continue
            top, ended = self._stream(codes[start:end].tolist(), states)
            longest = max(longest, top)
            for at, size in ended:
                first, last = start + at - size + 1, start + at + 1
                # a match may reach back over earlier spans
                while spans and first <= spans[-1][1]:
                    first = min(first, spans.pop()[0])
                spans.append((first, last))
        items: set[int] = set()
        for state in states:
            items |= self.window_items.get(state, set()) | self.whole_items.get(state, set())
        return longest, spans, items

    def _stream(self, codes: list[int], states: set[int]) -> tuple[int, list[tuple[int, int]]]:
        """(longest length, (place, words hit up to it) where a window or a short item ends); adds what matched."""
        step, link, length, window, wholes = self.step, self.link, self.length, self.window, self._wholes
        state = size = top = 0
        ended = []
        for at, code in enumerate(codes):
            following = step[state].get(code)
            while following is None:
                state = link[state]
                size = length[state]
                following = step[state].get(code)
            state, size = following, size + 1
            if size > top:
                top = size
            hit = 0
            if size >= window:
                within = state
                while length[link[within]] >= window:
                    within = link[within]
                states.add(within)
                hit = size
            if wholes and state in wholes:
                for whole, of in wholes[state]:
                    if whole <= size:
                        states.add(of)
                        hit = max(hit, whole)
            if hit:
                ended.append((at, hit))
        return top, ended


def item_words(items: DataFrame) -> DataFrame:
    """(item_id as text, number, words) of each item with words; equal ids and texts once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [normal_words(t) for t in batch.column(1).to_pylist()]
            kept = [i for i, w in enumerate(words) if w]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array([len(words[i]) for i in kept], pa.int64()),
                 pa.array([b" ".join(words[i]).decode("utf-8", "surrogatepass") for i in kept], pa.string())],
                names=["item_id", "n", "words"])

    return items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").mapInArrow(
        run, "item_id string, n long, words string").distinct()


def pieces_of(words: DataFrame, window: int, piece_words: int, groups: int) -> DataFrame:
    """(group, item_id, words): stretches of ``piece_words`` that overlap by ``window`` - 1 words."""
    each = max(1, piece_words - window + 1)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - window, F.lit(0).cast("long")),
                        F.lit(each).cast("long"))
    cut = words.withColumn("list", F.split("words", " ")).select(
        "item_id", "list", F.explode(starts).alias("at")).select(
        "item_id", "at", F.array_join(F.slice("list", F.col("at").cast("int") + 1, each + window - 1), " ").alias("words"))
    return cut.select(F.pmod(F.xxhash64("item_id", "at", "words"), F.lit(groups)).alias("group"), "item_id", "words")


def automaton_of(rows: list, window: int) -> tuple[Automaton, list[str]]:
    numbers: dict[str, int] = {}
    return Automaton([(r.words.encode("utf-8", "surrogatepass").split(), numbers.setdefault(r.item_id, len(numbers)))
                      for r in rows], window), list(numbers)


def matched(rows: DataFrame, keys: list[str], pieces: list, window: int) -> DataFrame:
    """``keys`` of ``rows`` and what the automaton of ``pieces`` finds in ``text``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*(rows.schema[k] for k in keys), *FOUND])
    arrow = to_arrow_schema(schema)
    # at most the words of one group, as counted before
    shared = rows.sparkSession.sparkContext.broadcast(automaton_of(pieces, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, names = shared.value
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                words = normal_words(batch.column(len(keys))[i].as_py())
                longest, spans, items = automaton.match(words)
                out.append((len(words), longest, [{"start": a, "end": b} for a, b in spans],
                            sorted(names[k] for k in items)))
            found = zip(*out) if out else [[]] * len(FOUND)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keys))),
                 *(pa.array(list(c), f.type) for c, f in zip(found, list(arrow)[len(keys):]))], schema=arrow)

    return rows.select(*keys, "text").mapInArrow(run, schema)


def together(found: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key of what several passes found: a row a pass."""
    def join_spans(spans):
        ordered = F.array_sort(F.flatten(spans))

        def add(done, s):
            last = F.try_element_at(done, F.lit(-1))
            longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
                last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
            return F.when(last.isNull() | (s["start"] > last["end"]), F.concat(done, F.array(s))).otherwise(longer)

        return F.aggregate(ordered, F.array().cast("array<struct<start:bigint,end:bigint>>"), add)

    return found.groupBy(*keys).agg(
        F.max("n_words").alias("n_words"), F.max("longest").alias("longest"), F.collect_list("spans").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).withColumn("spans", join_spans("spans"))


def find(docs: DataFrame, items: DataFrame, keep: list[str], window: int = WINDOW, group_words: int = GROUP_WORDS,
         piece_words: int = PIECE_WORDS) -> DataFrame:
    """``keep``, n_words, longest, spans (of hit words, from 0, end excluded) and items of every row of ``docs``.

    With several groups of items, ``longest`` goes by the pieces and may be below a whole item's.
    """
    words = stable(item_words(items))
    total = words.agg(F.sum("n")).first()[0] or 0
    if total <= group_words:
        return matched(docs, keep, words.select("item_id", "words").collect(), window)
    # pieces are a small part of a group, so hashing them deals groups of much the same size
    groups = math.ceil(1.5 * total / group_words)
    dealt = stable(pieces_of(words, window, max(window, min(piece_words, group_words // 8)), groups))
    rows = stable(docs.select(*keep, "text").withColumn("_row", F.monotonically_increasing_id()))
    passes = None
    for group in range(groups):
        pieces = dealt.where(F.col("group") == group).select("item_id", "words").collect()  # one group's words
        one = matched(rows, ["_row"], pieces, window)
        passes = one if passes is None else passes.unionByName(one)
    return rows.drop("text").join(together(passes, ["_row"]), "_row").drop("_row")


def cut_out(text: str, spans: list) -> str:
    """The text without the spans of its words and what lies inside them."""
    folded = text.encode("utf-8", "surrogatepass").translate(NORMAL)
    places = [m.span() for m in re.finditer(rb"[^ ]+", folded)]
    data, kept, at = text.encode("utf-8", "surrogatepass"), [], 0
    for span in spans:
        kept.append(data[at:places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE,
                    **options) -> DataFrame:
    """``docs`` with the hit spans cut out of ``text``, without documents hit over more than ``coverage`` of their words."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"))
    found = find(rows, items, ["row"], window, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    kept = found.where(n_hit <= coverage * F.col("n_words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            cleaned = [cut_out(t, s) if s else t for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cleaned, pa.string())], names=["row", "cleaned"])

    schema = T.StructType([kept.schema["row"], T.StructField("cleaned", T.StringType())])
    cleaned = kept.select("row", F.col("row.text").alias("text"), "spans").mapInArrow(run, schema)
    return cleaned.select(*[F.col("cleaned").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, a row a row of ``docs``."""
    found = find(docs, items, ["doc_id"], **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
