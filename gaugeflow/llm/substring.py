"""Substring de-duplication: words covered by a window that also starts earlier are removed.

A window is ``width`` consecutive words of one document. It is known by a
128-bit hash: two sums of its word hashes with fixed odd factors per place.

Prefilter. Each task sums up a count-min sketch of its texts, the sketches are
merged segment by segment in Spark, and the merged sketch goes to all tasks. A
window's count is estimated through its *signature*, the smallest hash of the
``gram`` words in a row within it: equal windows have equal signatures at as
many places, so the tally of a signature is never under the count of a window
that has it, and neighbouring windows mostly share one, which leaves about a
seventh of the entries. Counters stop at two, the only question being whether a
window repeats. The sketch has about ``cells`` counters per signature in each of
``depth`` rows, at most ``max_bytes`` in all: that bounds the broadcast. A
sketch that is too small for its input makes the second pass group more windows;
the result stays the same.

Second pass. Only windows estimated repeated are grouped exactly, by hash, with
a minimum that is partly formed before the shuffle, so a passage found in a third
of all documents is no load. A window is removed if it is estimated repeated and
isn't the first of its hash. Documents get the starts of their first windows, at
most one per word, and work the rest out from their own text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.common import name, type_of, word_chunks

SEGMENT = 1 << 20  # counters in a part of the sketch that one group merges
RUN = 1 << 17  # words in work at a time, or one text
FLUSH = 1 << 22  # sketch entries a task holds before it sends them on
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


@dataclass(frozen=True)
class Settings:
    width: int = 20
    gram: int = 8
    depth: int = 3
    cells: int = 4  # counters per expected signature, in each row
    max_bytes: int = 128 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def _factors(seed: int, n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def _sums(words: np.ndarray, seed: int, n: int) -> np.ndarray:
    """Per start the sum of the next n word hashes, each with the factor of its place."""
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j, c in enumerate(_factors(seed, n)):
        out += words[j : j + len(out)] * c
    return out


def _slide(x: np.ndarray, n: int, best) -> np.ndarray:
    """Per start the least (or greatest) of the next n, by doubling."""
    have = 1
    while have * 2 <= n:
        x = best(x[:-have], x[have:])
        have *= 2
    return best(x[: len(x) - (n - have)], x[n - have :]) if n > have else x


class Hashes(dict):
    """Hashes of words, kept between texts up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 5)
        return found

    def of(self, data: bytes) -> np.ndarray:
        parts = [np.fromiter(map(self.__getitem__, words), np.uint64, len(words)) for words in word_chunks(data)]
        return np.concatenate(parts) if len(parts) != 1 else parts[0]


@dataclass(frozen=True)
class Some:
    """Word hashes of texts laid end to end: text i is ``words[edges[i] : edges[i + 1]]``."""

    words: np.ndarray
    edges: np.ndarray

    def starts(self, s: Settings) -> np.ndarray:
        """Whether a window starts at a word; none goes on into the next text."""
        whole = np.zeros(len(self.words) + 1, np.int32)
        n = np.diff(self.edges)
        has = n >= s.width
        np.add.at(whole, self.edges[:-1][has], 1)
        np.add.at(whole, self.edges[1:][has] - s.width + 1, -1)
        return np.cumsum(whole[:-1]) > 0


def _together(texts: list[bytes], hashes: Hashes) -> Iterator[tuple[int, int, Some]]:
    """Texts in runs of some hundred thousand words, so that arrays are worth their cost: (from, to, words)."""
    parts, size, first = [np.empty(0, np.uint64)], 0, 0
    for i, t in enumerate(texts):
        parts.append(hashes.of(t) if t else np.empty(0, np.uint64))
        size += len(parts[-1])
        if size >= RUN or i + 1 == len(texts):
            yield first, i + 1, Some(np.concatenate(parts), np.cumsum([0, *[len(x) for x in parts[1:]]]))
            parts, size, first = [np.empty(0, np.uint64)], 0, i + 1


def _signatures(some: Some, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of windows, their signatures, and the signatures by place: the entries of the sketch."""
    none = np.empty(0, np.uint64)
    if len(some.words) < s.width:
        return np.empty(0, np.int64), none, none
    grams = _mix(_sums(some.words, 3, s.gram)) | np.uint64(1)
    span = s.width - s.gram + 1
    signature = _slide(grams, span, np.minimum)
    valid = some.starts(s)[: len(signature)]
    # a place is an entry if its gram is the least of some window over it
    pad = np.zeros(span - 1, np.uint64)
    marks = grams[_slide(np.concatenate([pad, np.where(valid, signature, 0), pad]), span, np.maximum) == grams]
    at = np.flatnonzero(valid)
    return at, signature[at], marks


def _window_hash(words: np.ndarray, at: np.ndarray, seed: int, s: Settings) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for j, c in enumerate(_factors(seed, s.width)):
        out += words[at + j] * c
    return _mix(out)


def _cells(signature: np.ndarray, row: int, bits: int) -> np.ndarray:
    return _mix(signature + np.uint64(row * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(64 - bits)


def _pack(counts: np.ndarray) -> bytes:
    """Counters 0, 1 or 2 and more, as bits of those that are 2 and more."""
    return np.packbits(counts >= 2).tobytes()


@dataclass
class Sketch:
    """Merged count-min sketch, reduced to: is the counter two or more."""

    bits: int
    rows: list[np.ndarray]

    def repeated(self, signature: np.ndarray) -> np.ndarray:
        found = np.ones(len(signature), bool)
        for r, row in enumerate(self.rows):
            at = _cells(signature, r, self.bits)
            found &= (row[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
        return found


def _build(texts: DataFrame, s: Settings) -> tuple[int, object]:
    """The merged sketch as a broadcast, and the number of bits of its rows."""
    spark = texts.sparkSession
    # words of a text are taken as six bytes on average: that decides the size only
    bytes_in = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    want = max(1, int(bytes_in / 6 * 2 / (s.width - s.gram + 2))) * s.cells
    bits = max(20, min(int(np.ceil(np.log2(want))), int(np.log2(s.max_bytes * 8 / s.depth))))
    per_row = 1 << (bits - 20)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = Hashes(), [], 0
        for b in batches:
            for _, _, some in _together(_bytes(b.column(0)), hashes):
                held.append(_signatures(some, s)[2])
                size += len(held[-1])
                if size >= FLUSH:
                    yield from _parts(np.concatenate(held), s.depth, bits)
                    held, size = [], 0
        if size:
            yield from _parts(np.concatenate(held), s.depth, bits)

    def merge(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SEGMENT, np.uint8)
        for b in parts:
            for raw in b.column("part"):
                at, n = _unpack(raw.as_py())
                counts[at] = np.minimum(counts[at] + n, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([_pack(counts)], pa.binary())], ["segment", "part"]
        )

    sent = texts.select("text").mapInArrow(sketch, "segment int, part binary")
    merged = sent.groupBy("segment").applyInArrow(merge, "segment int, part binary").collect()
    rows = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(s.depth)]
    step = SEGMENT // 8
    for r in merged:
        row, part = divmod(r["segment"], per_row)
        rows[row][part * step : (part + 1) * step] = np.frombuffer(r["part"], np.uint8)
    return bits, spark.sparkContext.broadcast(rows)


def _parts(marks: np.ndarray, depth: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A task's sketch: per segment the counters that aren't zero, as steps between them and whether they're two."""
    segments, parts = [], []
    for row in range(depth):
        at, n = np.unique(_cells(marks, row, bits), return_counts=True)
        edge = np.flatnonzero(np.diff(at >> np.uint64(20))) + 1
        for some, times in zip(np.split(at, edge), np.split(n, edge), strict=True):
            segments.append((row << (bits - 20)) + int(some[0] >> np.uint64(20)))
            parts.append(_squeeze((some & np.uint64(SEGMENT - 1)).astype(np.int64), times))
    yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int32()), pa.array(parts, pa.binary())], ["segment", "part"])


def _squeeze(at: np.ndarray, n: np.ndarray) -> bytes:
    code = np.diff(at, prepend=0) * 2 + (n >= 2)
    small = code.astype("<u2") if code.max() < 1 << 16 else code.astype("<u4")
    return bytes([small.itemsize]) + small.tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1).astype(np.int64)
    return np.cumsum(code >> 1), ((code & 1) + 1).astype(np.uint8)


def _places(texts: DataFrame, id_type: str, s: Settings, bits: int, sent) -> DataFrame:
    """(high, low, id, start) of windows estimated repeated; per task and hash the smallest place only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sketch = Hashes(), Sketch(bits, sent.value)
        for b in batches:
            order = pc.rank(b.column(0), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
            found = []
            for first, _, some in _together(_bytes(b.column(1)), hashes):
                at, signature, _ = _signatures(some, s)
                at = at[sketch.repeated(signature)]
                row = np.searchsorted(some.edges, at, side="right") - 1
                found.append(
                    (_window_hash(some.words, at, 1, s), _window_hash(_mix(some.words), at, 2, s), first + row, at - some.edges[row])
                )
            if not found:
                continue
            high, low, row, at = (np.concatenate(x) for x in zip(*found, strict=True))
            by = np.lexsort((at, order[row], low, high))
            new = np.ones(len(by), bool)
            new[1:] = (high[by[1:]] != high[by[:-1]]) | (low[by[1:]] != low[by[:-1]])
            kept = np.sort(by[new])
            for k in np.split(kept, range(FLUSH // 16, len(kept), FLUSH // 16)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(high[k].view(np.int64)), pa.array(low[k].view(np.int64)),
                        b.column(0).take(pa.array(row[k])), pa.array(at[k].astype(np.int32)),
                    ],
                    ["high", "low", "id", "start"],
                )

    return texts.mapInArrow(run, f"high bigint, low bigint, id {id_type}, start int")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The columns of ``docs``, ``n_words``, ``n_removed`` and ``kept_text``: the kept words, joined by one space.

    Windows are judged on the input. Earlier is a smaller id, or the same id and
    an earlier start; a null id comes first. A null text has no words, a text
    shorter than a window keeps all. Rows that share an id count as one
    document: equal windows at the same start of them are the same window, so
    repeated rows are all kept alike. Columns named like the three new ones are
    replaced. An empty table gives an empty result.
    """
    s = settings
    id_type = type_of(docs, id_col)
    texts = docs.select(name(id_col).alias("id"), name(text_col).cast("string").alias("text"))
    bits, sent = _build(texts, s)
    places = _places(texts, id_type, s, bits, sent)
    # one shuffle: the tasks have formed their minima already
    first = places.repartition("high", "low").groupBy("high", "low").agg(F.min(F.struct("id", "start")).alias("at"))
    mark = F.shiftleft(F.col("at.start").cast("bigint"), 32).bitwiseOR(F.col("low").bitwiseAND(F.lit(0xFFFFFFFF)))
    starts = first.groupBy(F.col("at.id").alias("id")).agg(F.collect_list(mark).alias("starts"))
    new = ["n_words", "n_removed", "kept_text"]
    columns = [c for c in docs.columns if c not in new]
    at = {c: f"c{i}" for i, c in enumerate(columns)}  # names of their own, whatever the columns are called
    shown = docs.select(*[name(c).alias(a) for c, a in at.items()])
    joined = shown.join(starts, F.col(at[id_col]).eqNullSafe(F.col("id")), "left").drop("id")
    fields = [f for f in shown.schema.fields]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    text_at = columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sketch = Hashes(), Sketch(bits, sent.value)
        for b in batches:
            texts, firsts = _bytes(b.column(text_at)), b.column(len(fields))
            numbers, removed, kept = [], [], []
            for first, last, some in _together(texts, hashes):
                covered = _covered(some, firsts.slice(first, last - first), sketch, s)
                gone = np.add.reduceat(np.r_[covered, False], some.edges[:-1], dtype=np.int64) * (np.diff(some.edges) > 0)
                for i in range(first, last):
                    words, lo, hi = texts[i].split(), some.edges[i - first], some.edges[i - first + 1]
                    if gone[i - first]:
                        words = list(compress(words, (~covered[lo:hi]).tolist()))
                    kept.append(b" ".join(words).decode())
                numbers += np.diff(some.edges).tolist()
                removed += gone.tolist()
            columns = [*b.columns[: len(fields)], pa.array(numbers, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return joined.mapInArrow(cut, schema).toDF(*columns, *new)


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def _covered(some: Some, firsts: pa.Array, sketch: Sketch, s: Settings) -> np.ndarray:
    """Whether a word is in a window that also starts earlier; ``firsts``: per text its windows that don't."""
    at, signature, _ = _signatures(some, s)
    at = at[sketch.repeated(signature)]
    edges = np.zeros(len(some.words) + 1, np.int32)
    if len(at):
        low = _window_hash(_mix(some.words), at, 2, s) & np.uint64(0xFFFFFFFF)
        lists = firsts.fill_null([])
        marks = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        base = np.repeat(some.edges[:-1], pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        known = (base + (marks >> 32)) << 32 | (marks & 0xFFFFFFFF)
        gone = at[~np.isin(at.astype(np.int64) << 32 | low.astype(np.int64), known)]
        edges[gone] += 1
        edges[gone + s.width] -= 1
    return np.cumsum(edges[:-1]) > 0


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text, in the same columns.

    Every row stays. A text that loses nothing stays as it is, white space
    included; one that loses words is its kept words joined by one space, empty
    if none are left. ``n_chars``, if there, is counted anew.
    """
    cut = remove_repeats(docs.select(*[name(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]), f"c{docs.columns.index(id_col)}", f"c{docs.columns.index(text_col)}")
    at = docs.columns.index(text_col)
    cut = cut.withColumn(f"c{at}", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col(f"c{at}")))
    if "n_chars" in docs.columns:
        n = docs.columns.index("n_chars")
        cut = cut.withColumn(f"c{n}", F.when(F.col("n_removed") > 0, F.length(f"c{at}").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(f"c{n}")))
    return cut.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
