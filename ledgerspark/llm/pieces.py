"""Offset-preserving encoding and decoding with a sentence-piece BPE model file.

The text is normalised by the model's compiled character map: at each position the
longest prefix found in the map's double-array trie is replaced, and the source offset
of every byte written is recorded. Pieces are merged on the normalised text; projecting
their bounds through the recorded offsets gives each piece's span of original bytes.

No piece of a model that splits at white space goes on past a space mark after another
character, and a character that is in no longer piece never merges. The text can be
cut there, and each different stretch is encoded once while a worker's cache lasts, the
new ones of a batch together; a model without these properties is encoded whole. Models with unigram scores, unused or
user-defined pieces are refused. Null texts are empty. Each row is encoded by itself:
repeated rows, ties and other columns have no effect, and nothing is shuffled. An empty
table gives no row.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerspark.llm.common import map_batches

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
CACHE = 300_000
#: Characters of text that are encoded together.
BATCH_CHARS = 1 << 20
#: Stretches above this many characters are merged one by one with a heap.
LONG = 48
NONE = np.int32(2**31 - 1)


def _fields(data: bytes):
    """(field number, value) of a protocol buffer message; numbers raw, the rest as bytes."""
    at, end = 0, len(data)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at:at + size]
            at += size


class CharsMap:
    """Longest-prefix replacement by a compiled map: trie units, then the replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.replacements = blob[4 + size:]
        self.starts = {b for b in range(256) if self._step(self._base(0), b)[0]}

    def _base(self, node: int) -> int:
        unit = self.units[node]
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _step(self, at: int, byte: int) -> tuple[bool, int]:
        at ^= byte
        if at >= len(self.units):
            return False, at
        return (self.units[at] & 0x800000FF) == byte, at

    def longest(self, data: bytes, start: int) -> tuple[bytes, int] | None:
        """(replacement, bytes it replaces) of the longest mapped prefix at ``start``."""
        at, found = self._base(0), None
        for end in range(start, len(data)):
            ok, at = self._step(at, data[end])
            if not ok:
                break
            leaf = self.units[at] >> 8 & 1
            at = self._base(at)
            if leaf:
                found = (self.units[at] & 0x7FFFFFFF, end + 1 - start)
        if found is None:
            return None
        stop = self.replacements.index(b"\0", found[0])
        return self.replacements[found[0]:stop], found[1]


@dataclass(frozen=True)
class Normal:
    """Normalised text and the source offset of each of its bytes, with one more for the end."""

    text: str
    source: np.ndarray


def in_groups(texts: list[str]) -> Iterable[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= BATCH_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


class Known:
    """Encoded stretches: their ids and sizes one after the other, their texts by row."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self.written: list[str] = []
        self.plain: list[str] = []
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)
        self.new: tuple[list[int], list[int], list[int]] = ([], [], [])

    def add(self, text: str, ids: list[int], sizes: list[int], written: str, plain: str) -> None:
        self.at[text] = len(self.written)
        self.new[0].extend(ids)
        self.new[1].extend(sizes)
        self.new[2].append(len(ids))
        self.written.append(written)
        self.plain.append(plain)

    def settle(self) -> None:
        """Puts what was added into the arrays."""
        ids, sizes, counts = self.new
        if counts:
            self.ids = np.concatenate([self.ids, np.array(ids, np.int32)])
            self.sizes = np.concatenate([self.sizes, np.array(sizes, np.int32)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
            self.new = ([], [], [])

    def counts(self, rows: np.ndarray) -> np.ndarray:
        return self.ends[rows + 1] - self.ends[rows]

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, count = self.ends[rows], self.counts(rows)
        total = int(count.sum())
        place = np.arange(total) + np.repeat(first - (np.cumsum(count) - count), count)
        return self.ids[place], self.sizes[place]


class Merges:
    """Merging of many stretches at once: in each round every stretch merges its best pair, leftmost
    of equals. Pairs are looked up in a hash table; a round touches two pairs of a stretch."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)
    BITS = 20

    def __init__(self, scores: dict[str, tuple[float, int]]):
        chars = {c for piece in scores for c in piece}
        self.texts = [*scores, *sorted(chars - scores.keys())]
        number = {text: i for i, text in enumerate(self.texts)}
        self.ids = np.array([scores[t][1] if t in scores else -1 for t in self.texts], np.int32)
        self.sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in self.texts], np.int32)
        self.of_char = np.full(0x110000, -1, np.int32)
        for c in chars:
            self.of_char[ord(c)] = number[c]
        order = {score: rank for rank, score in enumerate(sorted({s for s, _ in scores.values()}, reverse=True))}
        self.rank = np.array([order[scores[t][0]] if t in scores else NONE for t in self.texts], np.int32)
        pairs = {}
        for text in scores:
            for at in range(1, len(text)):
                left, right = number.get(text[:at]), number.get(text[at:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = number[text]
        self._build(pairs)

    def _build(self, pairs: dict[int, int]) -> None:
        size = 1 << self.BITS
        self.keys, self.made = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        keys, made = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32)
        slots, self.reach = self._slot(keys), 0
        while len(keys):
            self.reach += 1
            free = self.keys[slots] < 0
            first = np.zeros(len(keys), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            put = free & first
            self.keys[slots[put]], self.made[slots[put]] = keys[put], made[put]
            keys, made, slots = keys[~put], made[~put], (slots[~put] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * self.FACTOR) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Symbol that each pair makes, -1 if none."""
        keys = left.astype(np.int64) << 32 | right
        out = np.full(len(keys), -1, np.int32)
        slots, open_ = self._slot(keys), np.arange(len(keys))
        for _ in range(self.reach):
            held = self.keys[slots]
            hit = held == keys
            out[open_[hit]] = self.made[slots[hit]]
            on = ~hit & (held >= 0)
            if not on.any():
                break
            open_, keys, slots = open_[on], keys[on], (slots[on] + 1) % len(self.keys)
        return out

    def text_of(self, symbol: int) -> str:
        return self.texts[symbol] if symbol < len(self.texts) else chr(symbol - len(self.texts))

    def run(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all stretches one after the other, and how many each has; a character that is
        in no piece is the number of symbols plus its code."""
        counts = np.array([len(t) for t in stretches], np.int64)
        codes = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbols = self.of_char[codes].astype(np.int64)
        symbols = np.where(symbols < 0, len(self.texts) + codes, symbols)
        done_symbols, done_owner = [], []
        owner = np.repeat(np.arange(len(stretches)), counts)
        made = self._pairs(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            rank = np.where(made >= 0, self.rank[made], NONE)
            start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat(rank, start)
            size = np.diff(np.append(start, len(symbols)))
            live = np.repeat(best < NONE, size)
            done_symbols.append(symbols[~live])
            done_owner.append(owner[~live])
            chosen = np.flatnonzero((rank == np.repeat(best, size)) & live)
            if not len(chosen):
                break
            chosen = chosen[np.concatenate(([True], owner[chosen[1:]] != owner[chosen[:-1]]))]
            symbols[chosen] = made[chosen]
            live[chosen + 1] = False
            # places move by the rows that went before them
            moved = np.cumsum(live) - 1
            symbols, owner, made, chosen = symbols[live], owner[live], made[live], moved[chosen]
            touched = np.concatenate([chosen, chosen[chosen > 0] - 1])
            made[touched] = self._pairs(symbols, owner, touched)
        symbols, owner = np.concatenate([*done_symbols, []]), np.concatenate([*done_owner, []])
        order = np.argsort(owner, kind="stable")
        return symbols[order].astype(np.int64), np.bincount(owner.astype(np.int64), minlength=len(stretches))

    def _pairs(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What the pairs that begin at ``at`` make."""
        out = np.full(len(at), -1, np.int32)
        ok = at + 1 < len(symbols)
        ok[ok] = owner[at[ok]] == owner[at[ok] + 1]
        ok[ok] = np.maximum(symbols[at[ok]], symbols[at[ok] + 1]) < len(self.texts)
        out[ok] = self.lookup(symbols[at[ok]], symbols[at[ok] + 1])
        return out


@dataclass(frozen=True)
class Encoding:
    ids: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    written: str
    decoded: str


class PieceModel:
    def __init__(self, data: bytes):
        self.scores: dict[str, tuple[float, int]] = {}
        self.surface: list[str] = []
        self.bytes_of: dict[int, int] = {}
        self.control: set[int] = set()
        self.charsmap: CharsMap | None = None
        self.dummy, self.squeeze, self.fallback, self.unknown = True, True, False, 0
        kind_of_model = 1
        for number, value in _fields(data):
            if number == 1:
                self._add(dict(_fields(value)))
            elif number == 2:
                spec = dict(_fields(value))
                kind_of_model, self.fallback = spec.get(3, 1), bool(spec.get(35, 0))
                if spec.get(24, 0):
                    raise ValueError("models that treat white space as a suffix are not supported")
            elif number == 3:
                spec = dict(_fields(value))
                self.charsmap = CharsMap(spec[2]) if spec.get(2) else None
                self.dummy, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
                if not spec.get(5, 1):
                    raise ValueError("models that keep spaces unescaped are not supported")
        if kind_of_model != 2:
            raise ValueError("only BPE models are supported")
        self.known = Known()
        self.counted: dict[str, int] = {}

    def _add(self, piece: dict) -> None:
        text, kind, number = piece[1].decode(), piece.get(3, NORMAL), len(self.surface)
        self.surface.append(text)
        if kind == NORMAL:
            self.scores[text] = (struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], number)
        elif kind == BYTE:
            self.bytes_of[number] = int(text[3:5], 16)
        elif kind == UNKNOWN:
            self.unknown = number
        elif kind == CONTROL:
            self.control.add(number)
        else:
            raise ValueError("models with unused or user-defined pieces are not supported")

    @cached_property
    def byte_ids(self) -> list[int]:
        by_value = {v: i for i, v in self.bytes_of.items()}
        return [by_value[b] for b in range(256)]

    @cached_property
    def cuts(self) -> re.Pattern | None:
        """Pattern of the stretches that are encoded by themselves."""
        longer = [p for p in self.scores if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            return None
        alone = "" if any("\n" in p for p in longer) else "\n"
        return re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|{alone}" if alone else ""))

    # normalising

    def normalise(self, text: str) -> Normal:
        if not text:
            return Normal("", np.zeros(1, np.int64))
        if self.charsmap is None and not self.squeeze:
            return self._escape(text)
        data = text.encode("utf-8", "surrogatepass")
        out, source, at = [], [], 0
        previous_space = self.squeeze
        for written, size in self._prefixes(data):
            if previous_space:
                written = written.lstrip(b" ")
            if written:
                escaped = written.replace(b" ", SPACE.encode())
                out.append(escaped)
                source.extend([at] * len(escaped))
                previous_space = written.endswith(b" ")
            if not self.squeeze:
                previous_space = False
            at += size
        joined = b"".join(out)
        if self.squeeze:
            while joined.endswith(SPACE.encode()):
                joined = joined[:-3]
                at = source[len(joined)]
                del source[len(joined):]
            if not joined:
                return Normal("", np.zeros(1, np.int64))
        if self.dummy:
            joined = SPACE.encode() + joined
            source = [source[0]] * 3 + source
        return Normal(joined.decode("utf-8", "surrogatepass"), np.array([*source, at], np.int64))

    def _prefixes(self, data: bytes):
        at = 0
        while at < len(data):
            found = self.charsmap.longest(data, at) if self.charsmap and data[at] in self.charsmap.starts else None
            if found is None:
                lead = data[at]
                size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = data[at:at + size], size
            yield found
            at += found[1]

    def _escape(self, text: str) -> Normal:
        """The identity map: only spaces are written otherwise, three bytes for one."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        sizes = np.where(raw == 32, 3, 1)
        # each byte stands for the first byte of its character
        start = np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, np.arange(len(raw)), 0))
        source = np.repeat(start, sizes)
        lead = [np.zeros(3 if self.dummy else 0, np.int64), source, [len(raw)]]
        return Normal((SPACE if self.dummy else "") + text.replace(" ", SPACE), np.concatenate(lead).astype(np.int64))

    # merging

    @cached_property
    def merges(self) -> Merges:
        return Merges(self.scores)

    def _merge(self, text: str) -> list[str]:
        """Symbols after merging the best pair, leftmost first, until none is a piece."""
        symbols = list(text)
        before = list(range(-1, len(symbols) - 1))
        after = [*range(1, len(symbols)), -1]
        scores, heap = self.scores, []

        def offer(left: int, right: int) -> None:
            known = scores.get(symbols[left] + symbols[right])
            if known:
                heapq.heappush(heap, (-known[0], left, right, len(symbols[left]) + len(symbols[right])))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, size = heapq.heappop(heap)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            if before[left] >= 0:
                offer(before[left], left)
            if after[left] >= 0:
                offer(left, after[left])
        return [s for s in symbols if s]

    def _ids_of(self, symbol: str) -> tuple[list[int], list[int]]:
        """Ids and byte sizes of one symbol; bytes of a character without piece have size 0 but for the last."""
        raw = symbol.encode("utf-8", "surrogatepass")
        piece = self.scores.get(symbol)
        if piece:
            return [piece[1]], [len(raw)]
        if self.fallback:
            return [self.byte_ids[b] for b in raw], [0] * (len(raw) - 1) + [len(raw)]
        return [self.unknown], [len(raw)]

    def _learn(self, stretches: list[str]) -> None:
        """Encodes stretches that are not known yet, all short ones together."""
        short = [t for t in stretches if len(t) <= LONG]
        merges = self.merges
        symbols, counts = merges.run(short)
        single = merges.ids[np.minimum(symbols, len(merges.ids) - 1)]
        plain = (symbols < len(merges.ids)) & (single >= 0)
        odd = set(np.repeat(np.arange(len(short)), counts)[~plain].tolist())
        ids, sizes = single.tolist(), merges.sizes[np.minimum(symbols, len(merges.ids) - 1)].tolist()
        ends = np.cumsum(counts).tolist()
        start = 0
        for number, (text, end) in enumerate(zip(short, ends)):
            if number in odd:
                self._add_by_symbols(text, [merges.text_of(s) for s in symbols[start:end].tolist()])
            else:
                self._remember(text, ids[start:end], sizes[start:end])
            start = end
        for text in stretches:
            if len(text) > LONG:
                self._add_by_symbols(text, self._merge(text))

    def _add_by_symbols(self, text: str, symbols: list[str]) -> None:
        ids, sizes = [], []
        for symbol in symbols:
            more = self._ids_of(symbol)
            ids += more[0]
            sizes += more[1]
        self._remember(text, ids, sizes)

    def _remember(self, text: str, ids: list[int], sizes: list[int]) -> None:
        self.known.add(text, ids, sizes, ",".join(map(str, ids)), self._plain(ids))

    def _numbers(self, stretches: list[str]) -> np.ndarray:
        """Row of each stretch in ``known``."""
        if len(self.known.at) > CACHE:
            self.known = Known()
        new = [t for t in dict.fromkeys(stretches) if t not in self.known.at]
        if new:
            self._learn(new)
            self.known.settle()
        return np.fromiter(map(self.known.at.__getitem__, stretches), np.int64, len(stretches))

    def _stretches(self, text: str) -> list[str]:
        return self.cuts.findall(text) if self.cuts else [text] * bool(text)

    def encode_all(self, texts: list[str]) -> Iterable[Encoding]:
        for group in in_groups(texts):
            normal = [self.normalise(t) for t in group]
            cut = [self._stretches(n.text) for n in normal]
            numbers = self._numbers([s for c in cut for s in c])
            at = 0
            for n, c in zip(normal, cut):
                rows = numbers[at:at + len(c)]
                at += len(c)
                ids, sizes = self.known.gather(rows)
                bounds = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
                rows = rows.tolist()
                decoded = "".join([self.known.plain[r] for r in rows])
                yield Encoding(ids, n.source[bounds[:-1]], n.source[bounds[1:]],
                               ",".join([self.known.written[r] for r in rows]),
                               self._without_lead(decoded, ids[:1].tolist()))

    def encode(self, text: str) -> Encoding:
        return next(iter(self.encode_all([text])))

    def count_all(self, texts: list[str]) -> list[int]:
        """Number of ids of each text."""
        out = []
        for group in in_groups(texts):
            cut = [self._stretches(self._normal_text(t)) for t in group]
            flat = [s for c in cut for s in c]
            if len(self.counted) > CACHE:
                self.counted = {}
            new = [t for t in dict.fromkeys(flat) if t not in self.counted]
            self.counted.update(zip(new, self._counts_of(new)))
            counts = np.fromiter(map(self.counted.__getitem__, flat), np.int64, len(flat))
            upto = np.concatenate(([0], np.cumsum(counts)))
            ends = np.cumsum([len(c) for c in cut])
            out += (upto[ends] - upto[ends - [len(c) for c in cut]]).tolist()
        return out

    def _counts_of(self, stretches: list[str]) -> list[int]:
        merges = self.merges
        symbols, counts = merges.run([t if len(t) <= LONG else "" for t in stretches])
        known = np.minimum(symbols, len(merges.ids) - 1)
        each = np.ones(len(symbols), np.int64)
        odd = (symbols >= len(merges.ids)) | (merges.ids[known] < 0)
        if self.fallback:  # an id for each byte of a character without piece
            each[odd] = [len(merges.text_of(s).encode("utf-8", "surrogatepass")) for s in symbols[odd].tolist()]
        out = np.bincount(np.repeat(np.arange(len(stretches)), counts), each, len(stretches)).astype(np.int64).tolist()
        for i, text in enumerate(stretches):
            if len(text) > LONG:
                out[i] = sum(len(self._ids_of(s)[0]) for s in self._merge(text))
        return out

    def _normal_text(self, text: str) -> str:
        if self.charsmap is not None or self.squeeze:
            return self.normalise(text).text
        return (SPACE if self.dummy and text else "") + text.replace(" ", SPACE)

    # decoding

    def _without_lead(self, text: str, ids) -> str:
        """``text`` without the space put before it; a space that comes from a byte piece stays."""
        first = next((i for i in ids if i not in self.control), None)
        if not (self.dummy or self.squeeze) or first in self.bytes_of or not text.startswith(" "):
            return text
        return text.lstrip(" ") if self.squeeze else text[1:]

    @cached_property
    def shown(self) -> list[str | None]:
        """Text of each normal id."""
        return [None if i in self.bytes_of or i in self.control or i == self.unknown else t.replace(SPACE, " ")
                for i, t in enumerate(self.surface)]

    def _plain(self, ids) -> str:
        """Text of ids; runs of byte pieces are read as UTF-8, a byte that does not fit as U+FFFD."""
        parts = [self.shown[i] for i in ids]
        if None not in parts:
            return "".join(parts)
        out, run = [], bytearray()

        def flush():
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at:at + size]).decode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for number in ids:
            value = self.bytes_of.get(number)
            if value is not None:
                run.append(value)
                continue
            flush()
            if number == self.unknown:
                out.append(" ⁇ ")
            elif number not in self.control:
                out.append(self.surface[number].replace(SPACE, " "))
        flush()
        return "".join(out)

    def decode(self, ids) -> str:
        ids = [int(i) for i in ids]
        return self._without_lead(self._plain(ids), ids)


_models: dict[bytes, PieceModel] = {}


def model_of(data: bytes) -> PieceModel:
    """The parsed model, kept by each worker."""
    key = hashlib.sha256(data).digest()
    if key not in _models:
        _models[key] = PieceModel(data)
    return _models[key]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def shared_model(docs: DataFrame, path: str):
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, begins, ends (original byte spans, end exclusive), decoded per row of ``docs``."""
    shared = shared_model(docs, path)
    numbers = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", numbers), T.StructField("begins", numbers),
                           T.StructField("ends", numbers), T.StructField("decoded", T.StringType())])

    def work(batch: pa.RecordBatch):
        model, at = model_of(shared.value), 0
        for group in in_groups([t.as_py() or "" for t in batch.column(1)]):
            coded = list(model.encode_all(group))
            yield {"doc_id": batch.column(0).slice(at, len(group)), "ids": [c.ids for c in coded],
                   "begins": [c.begin.astype(np.int32) for c in coded],
                   "ends": [c.end.astype(np.int32) for c in coded], "decoded": [c.decoded for c in coded]}
            at += len(group)

    return map_batches(docs.select("doc_id", "text"), work, schema)


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and covered_bytes, the original bytes that the
    spans of all pieces cover."""
    shared = shared_model(docs, path)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
                           T.StructField("covered_bytes", T.LongType())])

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def work(batch: pa.RecordBatch):
        model = model_of(shared.value)
        rows = [(len(c.ids), digest(c.written), digest(c.decoded), int((c.end - c.begin).sum()))
                for c in model.encode_all([t.as_py() or "" for t in batch.column(1)])]
        yield {"doc_id": batch.column(0)} | {
            name: [r[k] for r in rows] for k, name in enumerate(schema.names[1:])}

    return map_batches(docs.select("doc_id", "text"), work, schema)
