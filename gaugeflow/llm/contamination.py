"""Benchmark decontamination: which words of a text stand in a passage of a test question or answer.

Texts and items are cut into the same normalised words. A window is ``width``
consecutive words of an item; an item of fewer words, but not none, is one
window. All windows, as sequences of word numbers, go into one Aho-Corasick
automaton, and each text runs through it once, a megabyte of words at a time,
with the automaton's state kept from one part to the next. A word inside any
occurrence is hit; runs of hit words are given as spans of the original text.

The automaton goes to all tasks, so its size is bounded: items are cut into
pieces of at most ``piece`` words, which overlap by ``width - 1`` words and so
lose no window, and pieces are taken up to ``block`` words at a time. Usual
benchmarks are one block, and texts are then read once, without a shuffle.
Larger ones take one round a block, each reading what the round before has
written; windows hit in any round count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gaugeflow.llm.common import forget, name, stored, type_of, word_chunks

# Fixed value: bytes that words consist of, after A-Z are lower-cased; all others separate words.
WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_FOLD = bytes(b if b in WORD_BYTES else b | 32 if 65 <= b <= 90 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ]
)


@dataclass(frozen=True)
class Settings:
    width: int = 10
    piece: int = 20_000  # words of an item in one piece
    block: int = 200_000  # words of pieces in one automaton; up to width nodes a word


def words(data: bytes) -> Iterator[list[bytes]]:
    """Normalised words of a text, some at a time."""
    return word_chunks(data.translate(_FOLD))


def _pieces(items: DataFrame, id_col: str, text_col: str, s: Settings) -> DataFrame:
    """(id, words): items cut into overlapping runs of words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data in enumerate(b.column(1).cast(pa.large_binary())):
                held: list[bytes] = []
                for some in words(data.as_py() or b""):
                    held += some
                    while len(held) > s.piece + s.width:
                        yield row(b, i, held[: s.piece])
                        del held[: s.piece - s.width + 1]
                if held:
                    yield row(b, i, held)

    def row(b: pa.RecordBatch, i: int, found: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array([found], pa.list_(pa.binary()))], ["id", "words"])

    texts = items.select(name(id_col).alias("id"), name(text_col).cast("string").alias("text"))
    return texts.mapInArrow(cut, f"id {type_of(items, id_col)}, words array<binary>")


def _blocks(pieces: DataFrame, s: Settings) -> Iterator[list[tuple]]:
    """Pieces up to ``block`` words at a time; only one block is on the driver."""
    held, size = [], 0
    for r in pieces.toLocalIterator():
        if held and size + len(r["words"]) > s.block:
            yield held
            held, size = [], 0
        held.append((r["id"], [bytes(w) for w in r["words"]]))
        size += len(r["words"])
    yield held


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


class Windows:
    """The automaton over all windows of a block, and the items that hold each of them."""

    def __init__(self, pieces: list[tuple], width: int):
        self.numbers, self.items, lengths = _Numbers(), [], []
        at: dict[tuple, int] = {}
        for item, found in pieces:
            for w in found:
                if w not in self.numbers:
                    self.numbers[w] = len(self.numbers) + 1
            row = tuple(map(self.numbers.__getitem__, found))
            for i in range(max(1, len(row) - width + 1)):
                window = row[i : i + width]
                k = at.setdefault(window, len(at))
                if k == len(self.items):
                    self.items.append(set())
                    lengths.append(len(window))
                if item is not None:
                    self.items[k].add(item)
        self.lengths = lengths
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for window, k in at.items():
            self.automaton.add_word(window, k)
        if at:
            self.automaton.make_automaton()

    def find(self, data: bytes) -> tuple[int, list[list[int]], set]:
        """Number of words, the runs [first, last] of hit words, and the items of windows that occur."""
        n, runs, seen, scan = 0, [], set(), None
        for some in words(data):
            n += len(some)
            if not self.items:
                continue
            row = tuple(map(self.numbers.__getitem__, some))
            if scan is None:
                scan = self.automaton.iter(row)
            else:
                scan.set(row, False)
            for last, k in scan:
                _add(runs, last - self.lengths[k] + 1, last)
                seen.add(k)
        return n, runs, set().union(*[self.items[k] for k in seen])


def _add(runs: list[list[int]], first: int, last: int) -> None:
    """Add a run that ends no earlier than those there."""
    while runs and runs[-1][1] >= first - 1:
        earlier = runs.pop()
        first, last = min(first, earlier[0]), max(last, earlier[1])
    runs.append([first, last])


def _union(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, last in sorted([*a, *b], key=lambda r: (r[1], r[0])):
        _add(out, first, last)
    return out


def _spans(data: bytes, runs: list[list[int]]) -> list[dict]:
    """Runs of words as offsets in the text, in code points; normalising keeps the place of every byte."""
    if not runs:
        return []
    out, left, start, byte, chars = [], iter(runs), None, 0, 0
    first, last = next(left)
    for i, m in enumerate(_WORD.finditer(data.translate(_FOLD))):
        if i == first:
            chars += len(data[byte : m.start()].decode(errors="replace"))
            byte, start = m.start(), chars
        if i == last:
            chars += len(data[byte : m.end()].decode(errors="replace"))
            byte = m.end()
            out.append({"start": start, "end": chars})
            if (run := next(left, None)) is None:
                break
            first, last = run
    return out


def scan(
    docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", item_text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """The columns of ``docs`` with ``n_words``, ``n_hit``, ``spans`` and ``items``.

    ``text_col`` is the text of ``docs``; ``id_col`` and ``item_text_col`` are columns of ``items``.
    ``spans``: start and end (exclusive) of runs of hit words in the text, in code points.
    ``items``: ids of items with a window in the text, each once, in no order. A null
    text has no words, null items no windows. Windows of an item without an id hit words, but
    aren't listed. Items that share an id count as one, repeated rows of ``docs`` stay and get equal
    results, columns named like the four new ones are replaced. Without items nothing is hit; an empty ``docs`` gives an empty result.
    """
    s, spark = settings, docs.sparkSession
    new = ["n_words", "n_hit", "spans", "items"]
    shown = [c for c in docs.columns if c not in new]
    kept = docs.select(*[name(c).alias(f"c{i}") for i, c in enumerate(shown)], name(text_col).cast("string").alias("t"))
    item_type = items.schema[id_col].dataType
    runs_type = T.ArrayType(T.ArrayType(T.LongType()))
    state = T.StructType([*kept.schema.fields, T.StructField("runs", runs_type), T.StructField("items", T.ArrayType(item_type))])
    out = T.StructType([*kept.schema.fields[:-1], *RESULT.fields, T.StructField("items", T.ArrayType(item_type))])
    runs_kind, spans_kind = pa.list_(pa.list_(pa.int64())), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    text_at = len(shown)

    def step(sent, last: bool, begun: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = Windows(sent.value, s.width)
            for b in batches:
                texts = b.column(text_at).cast(pa.large_binary())
                numbers, runs, ids, spans = [], [], [], []
                for i in range(b.num_rows):
                    data = texts[i].as_py() or b""
                    n, hit, found = windows.find(data)
                    if begun:
                        hit = _union(b.column(text_at + 1)[i].as_py(), hit)
                        found = found.union(b.column(text_at + 2)[i].as_py())
                    numbers.append(n)
                    runs.append(hit)
                    ids.append(list(found))
                    spans.append(_spans(data, hit) if last else None)
                items = pa.array(ids, pa.list_(kind))
                if last:
                    count = [sum(z - a + 1 for a, z in r) for r in runs]
                    more = [pa.array(numbers, pa.int64()), pa.array(count, pa.int64()), pa.array(spans, spans_kind), items]
                    yield pa.RecordBatch.from_arrays([*b.columns[:text_at], *more], out.names)
                else:
                    yield pa.RecordBatch.from_arrays([*b.columns[: text_at + 1], pa.array(runs, runs_kind), items], state.names)

        return run

    kind = to_arrow_type(item_type)
    blocks = _blocks(_pieces(items, id_col, item_text_col, s), s)
    block, path = next(blocks), None
    while True:
        after = next(blocks, None)
        sent = spark.sparkContext.broadcast(block)
        run = step(sent, after is None, path is not None)
        if after is None:
            found = kept.mapInArrow(run, out)
            break
        old = path
        kept, path = stored(kept.mapInArrow(run, state), "contamination")
        if old:
            forget(spark, old)
        block = after
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(shown)], *new)


def keep_clean(docs: DataFrame, items: DataFrame, most: float = 0.0, **columns) -> DataFrame:
    """Rows of ``docs`` of whose words at most the share ``most`` is hit; texts without words stay."""
    numbered = docs.select(*[name(c).alias(f"d{i}") for i, c in enumerate(docs.columns)])
    text = columns.pop("text_col", "text")
    found = scan(numbered, items, text_col=f"d{docs.columns.index(text)}", **columns)
    return found.where(F.col("n_hit") <= F.lit(most) * F.col("n_words")).select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(docs.columns)])
