"""Quality classifier by co-training of a text view and a metadata view.

The text view sees which words a document has and the shape of its characters; the
metadata view sees language, source and length. For each target (bad quality, toxic)
both learn from the labelled documents. In each round, either view labels those of all
unlabelled documents it is surest of, and the other one learns from them too. At the
end each view's log odds are calibrated on labelled documents that no view learned
from, and one more logistic model on the calibrated views gives the score.

The labelled rows are a bounded sample: those ``labelled`` documents with the smallest
hashes of their id; only their word numbers reach the driver. Unlabelled documents are
not sampled. Their word numbers are written down once; a round reads them all twice,
first for a histogram of how sure either view is, which sets the limits, then for the
counts of words and values of the documents beyond these. Only these sums, whose size
is fixed, reach the driver. Counts of both kinds of documents say which words tell and
how much; a common scale of these values and a correction of each are learned from the
labelled rows. Scoring reads all documents whole, in one pass without a shuffle, with
two tables of weights whose size is fixed.

Null and empty texts have no words; null languages, sources and lengths are values of
their own. Several labels of one id are taken at their worst; null labels teach nothing
and a null doc_id is never labelled, by no view either. Without labels of both kinds a target's score is
the share seen (0 if none is), so nothing is rejected. Equal rows get equal scores.
An empty table of documents gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import ASCII_SPACE, map_batches
from ledgerspark.sources.scratch import stable

TARGETS = ("bad", "toxic")
TEXT_SIZE = 1 << 18
META_SIZE = 1 << 12
LABELLED = 20_000
ROUNDS = 3
#: Share of the unlabelled documents that a view labels for the other in a round, by class.
SHARE = 0.05
SURE = 0.98
#: Steps of log odds, from SURE up, that confidence is counted in.
BINS = 4096
BIN_WIDTH = 0.0064
#: Unlabelled documents that are weighed together.
TOGETHER = 1000
#: Twice the log likelihood ratio from which a word or value counts as telling.
LEAST_RATIO = 12.0
CACHE = 400_000
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
EDGES = bytes(b for b in range(33, 127) if not chr(b).isalnum())
SHAPES = 64

_known: dict[bytes, int] = {}


def word_number(word: bytes) -> int:
    """Place of a word, without case and punctuation around it, in the text view's weights."""
    number = _known.get(word)
    if number is None:
        number = SHAPES + zlib.crc32(word.lower().strip(EDGES)) % (TEXT_SIZE - SHAPES)
        if len(_known) >= CACHE:
            _known.clear()
        _known[word] = number
    return number


def shapes(raw: bytes, words: int, distinct: int) -> list[int]:
    """Numbers of the steps that the text's shares of characters and repeated words fall into."""
    letters = max(1, len(raw) - sum(raw.count(c.encode()) for c in ASCII_SPACE))
    shares = (
        20 * (len(raw) - len(raw.translate(None, UPPER))) / letters,
        20 * (len(raw) - len(raw.translate(None, DIGITS))) / letters,
        20 * (len(raw) - len(raw.translate(None, EDGES))) / letters,
        20 * raw.count(b"|") / letters,
        20 * raw.count(b"!") / letters,
        8 * (1 - distinct / max(1, words)),
    )
    return [8 * i + min(7, int(share)) for i, share in enumerate(shares)] + [48 + min(15, words.bit_length())]


def text_numbers(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    distinct = set(words)
    found = set(map(word_number, distinct))
    found.update(shapes(raw, len(words), len(distinct)))
    return np.fromiter(found, np.int32, len(found))


def meta_numbers(lang: str | None, source: str | None, size: int | None) -> np.ndarray:
    step = "none" if size is None else str(int(size).bit_length())
    values = (f"l:{lang}", f"s:{source}", f"n:{step}", f"l:{lang} n:{step}", f"s:{source} l:{lang}")
    return np.array([zlib.crc32(v.encode("utf-8", "surrogatepass")) % META_SIZE for v in values], np.int32)


@dataclass
class Rows:
    """Rows of numbers, one after the other."""

    numbers: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, lists) -> Rows:
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.concatenate(lists) if len(lists) else np.zeros(0, np.int32)
        return cls(flat, np.concatenate(([0], np.cumsum(sizes))))

    @classmethod
    def from_column(cls, column: pa.ChunkedArray) -> Rows:
        return cls.from_array(column.combine_chunks())

    @classmethod
    def from_array(cls, lists: pa.ListArray) -> Rows:
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        return cls(lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))

    def take(self, at: np.ndarray) -> Rows:
        return Rows.of([self.numbers[self.starts[i]:self.starts[i + 1]] for i in at])

    def sums(self, weights: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0.0], np.cumsum(weights[self.numbers], dtype=np.float64)))
        return upto[self.starts[1:]] - upto[self.starts[:-1]]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling(yes: np.ndarray, no: np.ndarray, all_yes: float, all_no: float) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood ratio of each number against independence, and its smoothed log odds ratio."""
    def part(x):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-9)), 0)

    either, total = yes + no, all_yes + all_no
    ratio = 2 * (part(yes) + part(no) + part(all_yes - yes) + part(all_no - no) - part(either) - part(total - either)
                 - part(np.array(all_yes)) - part(np.array(all_no)) + part(np.array(total)))
    return ratio, np.log((yes + 0.5) / (all_yes + 1)) - np.log((no + 0.5) / (all_no + 1))


@dataclass
class Counts:
    """How many documents of either class hold each number, and how many there are."""

    yes: np.ndarray
    no: np.ndarray
    all_yes: float
    all_no: float

    @classmethod
    def none(cls, size: int) -> Counts:
        return cls(np.zeros(size), np.zeros(size), 0.0, 0.0)

    def __add__(self, other: Counts) -> Counts:
        return Counts(self.yes + other.yes, self.no + other.no, self.all_yes + other.all_yes, self.all_no + other.all_no)

    @classmethod
    def of(cls, rows: Rows, truth: np.ndarray, size: int) -> Counts:
        """Of the rows whose ``truth`` is 1 or 0."""
        each = np.repeat(truth, np.diff(rows.starts))
        return cls(np.bincount(rows.numbers[each == 1], minlength=size).astype(float),
                   np.bincount(rows.numbers[each == 0], minlength=size).astype(float),
                   float((truth == 1).sum()), float((truth == 0).sum()))


def fit(rows: Rows, at: np.ndarray, truth: np.ndarray, size: int, only_yes: bool, taught: Counts | None = None,
        steps: int = 200, least: float = LEAST_RATIO, ridge: float = 1e-4) -> np.ndarray:
    """Logistic weights, the last one the constant, over the numbers that tell the classes apart.

    A number counts if its likelihood ratio is at least ``least`` (and it speaks for
    the class, if ``only_yes``); its value is its log odds ratio, both from the rows and
    the counts that the other view ``taught``. Its weight is a scale that all share, which
    is what a number no row holds gets, and a correction of its own.
    """
    rows = rows.take(at)
    each = np.repeat(np.arange(len(at), dtype=np.int32), np.diff(rows.starts))
    found = Counts.of(rows, truth, size) + (taught or Counts.none(size))
    ratio, value = telling(found.yes, found.no, found.all_yes, found.all_no)
    used = (ratio >= least) & ((value > 0) | (not only_yes))
    here = used[rows.numbers]
    place, each = (np.cumsum(used) - 1)[rows.numbers[here]], each[here]
    worth = value[rows.numbers[here]]
    weights = np.zeros(int(used.sum()) + 2)  # corrections, the constant, the scale
    mean, spread = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        guess = sigmoid(np.bincount(each, worth * (weights[place] + weights[-1]), len(at)) + weights[-2])
        slope = (guess - truth) / len(at)
        pull = worth * slope[each]
        gradient = np.concatenate([np.bincount(place, pull, len(weights) - 2) + ridge * weights[:-2],
                                   [slope.sum(), pull.sum() + ridge * weights[-1]]])
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient ** 2
        weights -= 0.05 * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.999 ** step)) + 1e-8)
    out = np.zeros(size + 1)
    out[:-1][used] = (weights[:-2] + weights[-1]) * value[used]
    out[-1] = weights[-2]
    return out


def odds(rows: Rows, weights: np.ndarray) -> np.ndarray:
    return rows.sums(weights[:-1]) + weights[-1]


def logistic(columns: np.ndarray, truth: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a small dense logistic model, the last one the constant, by Newton steps."""
    x = np.column_stack([columns, np.ones(len(columns))])
    weights = np.zeros(x.shape[1])
    penalty = np.diag([ridge * len(x)] * (x.shape[1] - 1) + [1e-9])
    for _ in range(30):
        p = sigmoid(x @ weights)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty,
                               x.T @ (p - truth) + penalty @ weights)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass
class Target:
    """Both views of one target, their calibration, and how they go together."""

    text: np.ndarray
    meta: np.ndarray
    text_fit: np.ndarray
    meta_fit: np.ndarray
    both: np.ndarray

    def scores(self, text: Rows, meta: Rows) -> np.ndarray:
        a = odds(text, self.text) * self.text_fit[0] + self.text_fit[1]
        b = odds(meta, self.meta) * self.meta_fit[0] + self.meta_fit[1]
        return sigmoid(np.column_stack([a, b]) @ self.both[:2] + self.both[2])


def constant(share: float) -> Target:
    level = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    return Target(np.zeros(TEXT_SIZE + 1), np.zeros(META_SIZE + 1), np.array([0.0, 0.0]), np.array([0.0, 0.0]),
                  np.array([0.0, 0.0, level]))


# what a text does not hold says little: its view counts words that speak for the class
VIEWS = {"text": (TEXT_SIZE, True), "meta": (META_SIZE, False)}
OTHER = {"text": "meta", "meta": "text"}
Views = dict[str, Rows]


@dataclass
class Round:
    """Both views in a round, with their calibration, and from where on they label documents: for a view
    and class the lowest step of confidence, and the share of it that is taken."""

    weights: dict[str, np.ndarray]
    lines: dict[str, np.ndarray]
    limits: dict[tuple[str, int], tuple[int, float]]

    def steps(self, views: Views) -> dict[tuple[str, int], np.ndarray]:
        """Step of confidence of each row by view and class, below 0 where the view is not sure."""
        out = {}
        for name, rows in views.items():
            level = np.clip(odds(rows, self.weights[name]) * self.lines[name][0] + self.lines[name][1], -100, 100)
            for value, side in ((1, level), (0, -level)):
                step = np.floor((side - np.log(SURE / (1 - SURE))) / BIN_WIDTH)
                out[name, value] = np.clip(step, -1, BINS - 1).astype(np.int64)
        return out

    def labels(self, views: Views, draw: np.ndarray) -> dict[str, np.ndarray]:
        """Class that each view gives to a row, -1 for none; ``draw`` decides within the lowest step."""
        out = {name: np.full(len(draw), -1) for name in views}
        for (name, value), step in self.steps(views).items():
            low, share = self.limits[name, value]
            out[name][(step > low) | ((step == low) & (draw < share))] = value
        return out

    def set_limits(self, sure: dict[tuple[str, int], np.ndarray], rows: int, share: float) -> None:
        """Each view labels SHARE of the ``rows`` that are left, ``share`` of them as the class."""
        quota = max(1, int(SHARE * rows))
        for (name, value), found in sure.items():
            room = max(1, int(quota * (share if value else 1 - share)))
            above = np.cumsum(found[::-1])[::-1]
            low = int(np.flatnonzero(above >= room).max(initial=0))
            over = int(above[low] - found[low])
            self.limits[name, value] = low, min(1.0, (room - over) / max(1, int(found[low])))


def left(views: Views, draw: np.ndarray, rounds: list[Round]) -> np.ndarray:
    """Rows that no view labelled in ``rounds``."""
    out = np.ones(len(draw), bool)
    for one in rounds:
        for label in one.labels(views, draw).values():
            out &= label < 0
    return out


def sureness(views: Views, draw: np.ndarray, rounds: list[Round]) -> tuple[int, dict[tuple[str, int], np.ndarray]]:
    """Rows that are left before the last of ``rounds``, and how many are at each step of confidence in it."""
    here = left(views, draw, rounds[:-1])
    return int(here.sum()), {key: np.bincount(step[here & (step >= 0)], minlength=BINS)
                             for key, step in rounds[-1].steps(views).items()}


def lessons(views: Views, draw: np.ndarray, rounds: list[Round]) -> dict[str, Counts]:
    """For each view the counts of what the other one labels in the last of ``rounds``."""
    here = left(views, draw, rounds[:-1])
    return {OTHER[name]: Counts.of(views[OTHER[name]], np.where(here, label, -1), VIEWS[OTHER[name]][0])
            for name, label in rounds[-1].labels(views, draw).items()}


@dataclass
class Held:
    """Unlabelled rows in memory."""

    views: Views
    draw: np.ndarray

    def sureness(self, rounds: list[Round]):
        return sureness(self.views, self.draw, rounds)

    def lessons(self, rounds: list[Round]):
        return lessons(self.views, self.draw, rounds)


def co_train(text: Rows, meta: Rows, truth: np.ndarray, rounds: int = ROUNDS, unlabelled=None) -> Target:
    """``truth`` is 1, 0 or -1; one labelled row of five is kept for calibration. Rows of -1 are the
    unlabelled ones, unless ``unlabelled`` has them."""
    known = np.flatnonzero(truth >= 0)
    kept, learned = known[::5], np.setdiff1d(known, known[::5])
    if len(known) < 20 or min(len(np.unique(truth[learned])), len(np.unique(truth[kept]))) < 2:
        return constant(min(0.49, float(truth[known].mean())) if len(known) else 0.0)
    rows = {"text": text, "meta": meta}
    if unlabelled is None:
        rest = np.flatnonzero(truth < 0)
        unlabelled = Held({name: r.take(rest) for name, r in rows.items()}, rest * 0.6180339887498949 % 1)
    taught = {name: Counts.none(size) for name, (size, _) in VIEWS.items()}
    done: list[Round] = []
    for turn in range(rounds + 1):
        weights = {name: fit(rows[name], learned, truth[learned].astype(float), size, only_yes, taught[name])
                   for name, (size, only_yes) in VIEWS.items()}
        lines = {name: logistic(odds(rows[name], weights[name])[kept][:, None], truth[kept]) for name in VIEWS}
        if turn == rounds:
            break
        done.append(Round(weights, lines, {}))
        open_, sure = unlabelled.sureness(done)
        if not open_:
            break
        done[-1].set_limits(sure, open_, float(truth[learned].mean()))
        for name, counts in unlabelled.lessons(done).items():
            taught[name] += counts
    calibrated = np.column_stack([odds(rows[n], weights[n])[kept] * lines[n][0] + lines[n][1] for n in VIEWS])
    return Target(weights["text"], weights["meta"], lines["text"], lines["meta"], logistic(calibrated, truth[kept]))


FEATURES = T.StructType([
    T.StructField("order", T.LongType()), T.StructField("bad", T.IntegerType()), T.StructField("toxic", T.IntegerType()),
    T.StructField("text", T.ArrayType(T.IntegerType())), T.StructField("meta", T.ArrayType(T.IntegerType())),
])


def worst_labels(labels: DataFrame) -> DataFrame:
    """One row of each id; -1 where a label is missing."""
    # a row that says nothing about a target is no label for it
    return labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.max(1 - F.col("quality").cast("int")), F.lit(-1)).alias("bad"),
        F.coalesce(F.max(F.col("toxic").cast("int")), F.lit(-1)).alias("toxic"))


def sampled(docs: DataFrame, labels: DataFrame, labelled: int) -> DataFrame:
    """Features of the labelled sample; -1 where a label is missing."""
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id")
    order = F.xxhash64("doc_id")
    known = worst_labels(labels).join(ids.distinct(), "doc_id", "left_semi").orderBy(order, "doc_id").limit(labelled)
    # at most ``labelled`` rows, so a broadcast is bounded
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").join(F.broadcast(known), "doc_id").select(
        order.alias("order"), "bad", "toxic", "text", "lang", "source", "n_chars")

    def work(batch: pa.RecordBatch):
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        yield {"order": c["order"], "bad": c["bad"], "toxic": c["toxic"],
               "text": [text_numbers(t.as_py()) for t in c["text"]],
               "meta": [meta_numbers(a, b, n) for a, b, n in zip(
                   c["lang"].to_pylist(), c["source"].to_pylist(), c["n_chars"].to_pylist())]}

    return map_batches(rows, work, FEATURES)


NUMBERS = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in VIEWS]


def unlabelled_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """draw, bad, toxic, text, meta of all documents without a label for one of the targets."""
    schema = T.StructType([docs.schema["doc_id"], *NUMBERS])

    def work(batch: pa.RecordBatch):
        yield {"doc_id": batch.column(0), "text": [text_numbers(t.as_py()) for t in batch.column(1)],
               "meta": [meta_numbers(a, b, n) for a, b, n in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]}

    rows = map_batches(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", "lang", "source", "n_chars"),
                       work, schema)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # labels grow with the corpus, so the join is the one of large tables at every size
    return rows.join(worst_labels(labels).hint("merge"), "doc_id", "left").select(
        draw.alias("draw"), *[F.coalesce(t, F.lit(-1)).alias(t) for t in TARGETS], *VIEWS).where("bad < 0 or toxic < 0")


class Unlabelled:
    """All documents without a label for ``target``, weighed on the executors."""

    def __init__(self, features: DataFrame, target: str):
        self.rows = features.where(F.col(target) < 0).select("draw", *VIEWS)

    def added(self, rounds: list[Round], work, schema: T.StructType, keys: list[str]) -> pa.Table:
        """Sums of the rows (keys, yes, no) that ``work`` makes of all that a task reads."""
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, shared = to_arrow_schema(schema), self.rows.sparkSession.sparkContext.broadcast(rounds)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = ((b.slice(at, TOGETHER) for b in batches for at in range(0, b.num_rows, TOGETHER)))
            pieces = (({n: Rows.from_array(p.column(1 + i)) for i, n in enumerate(VIEWS)},
                       p.column(0).to_numpy(zero_copy_only=False)) for p in parts)
            for columns in work(pieces, shared.value):
                yield pa.RecordBatch.from_pydict(columns, schema=arrow)

        sums = [F.sum(c).cast("long").alias(c) for c in schema.names if c not in keys]
        out = self.rows.mapInArrow(run, schema).groupBy(*keys).agg(*sums).toArrow()
        shared.unpersist()
        return out

    def sureness(self, rounds: list[Round]) -> tuple[int, dict[tuple[str, int], np.ndarray]]:
        keys = [(name, value) for name in VIEWS for value in (1, 0)]
        schema = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "step", "n")])

        def work(pieces, rounds):
            rows, total = 0, np.zeros((len(keys), BINS), np.int64)
            for views, draw in pieces:
                some, sure = sureness(views, draw, rounds)
                rows += some
                for i, key in enumerate(keys):
                    total[i] += sure[key]
            key, step = np.nonzero(total)
            yield {"key": np.append(key, -1), "step": np.append(step, 0), "n": np.append(total[key, step], rows)}

        found = self.added(rounds, work, schema, ["key", "step"])
        key, step, n = (found[c].to_numpy() for c in schema.names)
        return int(n[key < 0].sum()), {k: np.bincount(step[key == i], n[key == i], BINS).astype(np.int64)
                                       for i, k in enumerate(keys)}

    def lessons(self, rounds: list[Round]) -> dict[str, Counts]:
        schema = T.StructType([T.StructField(n, T.LongType()) for n in ("view", "number", "yes", "no")])

        def work(pieces, rounds):
            total = {name: Counts.none(size) for name, (size, _) in VIEWS.items()}
            for views, draw in pieces:
                for name, counts in lessons(views, draw, rounds).items():
                    if counts.all_yes or counts.all_no:
                        total[name] += counts
            for i, counts in enumerate(total.values()):
                at = np.flatnonzero(counts.yes + counts.no)
                yield {"view": np.full(len(at) + 1, i), "number": np.append(at, -1),
                       "yes": np.append(counts.yes[at], counts.all_yes).astype(np.int64),
                       "no": np.append(counts.no[at], counts.all_no).astype(np.int64)}

        found = self.added(rounds, work, schema, ["view", "number"])
        view, number, yes, no = (found[c].to_numpy() for c in schema.names)
        out = {}
        for i, (name, (size, _)) in enumerate(VIEWS.items()):
            here, every = (view == i) & (number >= 0), (view == i) & (number < 0)
            out[name] = Counts(np.bincount(number[here], yes[here], size), np.bincount(number[here], no[here], size),
                               float(yes[every].sum()), float(no[every].sum()))
        return out


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> dict[str, Target]:
    rows = sampled(docs, labels, labelled).toArrow()
    _, first = np.unique(rows["order"].to_numpy(), return_index=True)  # one row of each id, in order
    rows = rows.take(pa.array(first))
    text, meta = Rows.from_column(rows["text"]), Rows.from_column(rows["meta"])
    features = stable(unlabelled_features(docs, labels)) if rows.num_rows else None
    return {t: co_train(text, meta, rows[t].to_numpy().astype(np.int64), rounds,
                        None if features is None else Unlabelled(features, t)) for t in TARGETS}


def scored(docs: DataFrame, model: dict[str, Target], keys: list[str]) -> DataFrame:
    """``keys``, the calibrated chances bad_score and toxic_score, score (good and not toxic) and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*[docs.schema[k] for k in keys], *[T.StructField(f"{t}_score", T.DoubleType())
                                                              for t in TARGETS],
                           T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    width = len(keys)

    def work(batch: pa.RecordBatch):
        if not batch.num_rows:
            return
        texts = Rows.of([text_numbers(t.as_py()) for t in batch.column(width)])
        meta = Rows.of([meta_numbers(a, b, n) for a, b, n in zip(
            *(batch.column(width + i).to_pylist() for i in (1, 2, 3)))])
        bad, toxic = (shared.value[t].scores(texts, meta) for t in TARGETS)
        yield {k: batch.column(i) for i, k in enumerate(keys)} | {
            "bad_score": bad, "toxic_score": toxic, "score": (1 - bad) * (1 - toxic),
            "kept": (bad < 0.5) & (toxic < 0.5)}

    return map_batches(docs.select(*keys, *(docs[c].alias(f"_{c}") for c in ("text", "lang", "source", "n_chars"))),
                       work, schema)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, bad_score, toxic_score, score, kept per row of ``docs``."""
    return scored(docs, train(docs, labels, **options), ["doc_id"])


def filter_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that are kept, all columns."""
    model = train(docs, labels, **options)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       *[docs[c] for c in ("text", "lang", "source", "n_chars")])
    return scored(rows, model, ["row"]).where("kept").select("row.*")
