"""Spelling variants: words that differ by one code point, and the common form each of them is led to.

All neighbours come from a dictionary of trie-node pairs. The prefixes of all
words are the nodes of a forward trie, the suffixes those of a trie of the reversed
words; both are numbered. A word of length k then is a path of k + 1 nodes in either
trie, and each of its places gives pairs of integers (prefix node, suffix node):

* skipping the code point at place i: the nodes before and after it;
* cutting at place i, skipping nothing: the two nodes that meet there.

Two words that share a pair of the first kind are equal but for that code point. A pair
of the first kind that is one of the second kind of another word means that a code point
was inserted; among equal neighbouring code points only the last may be skipped
then, so each such pair of words is found once. A pair determines all but one code point, so a group
of words holds at most one word an alphabet letter and one cut: groups are
bounded, and members get the number and the most frequent of the others without
being paired.

Tries are numbered in parallel. A bounded sample of words serves as borders; all prefixes
of borders are numbered on the driver, and any other prefix lies between two
neighbouring borders with all words that have it, so a task that reads the words
between them in order numbers it by itself, holding one path.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import name, stored

# What a word consists of, and what of it is lower-cased.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PAIRS = "prefix bigint, suffix bigint, id bigint, n bigint, cut boolean, last boolean"
BITS = 36  # of a number within one stretch between borders
ROOT = -1
FLUSH = 1 << 18


@dataclass(frozen=True)
class Settings:
    least_length: int = 6
    least_count: int = 5
    factor: int = 5  # how much more frequent than a word its form is
    sample: int = 20  # words looked at for each border


def words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All words of all texts, lower-cased, as rows with the columns of ``docs`` but the text."""
    rest = [name(c) for c in docs.columns if c != text_col]
    found = F.regexp_extract_all(name(text_col).cast("string"), F.lit(RUN), F.lit(0))
    return docs.select(*rest, F.explode(found).alias("word")).withColumn("word", F.translate("word", UPPER, LOWER))


def damaged(id_col: Column, every: int = 199) -> Column:
    """``word`` without one code point where the crc32 of id and word is a multiple of ``every``; an id of null damages nothing."""
    h = F.crc32(F.concat(id_col.cast("string"), F.lit(":"), F.col("word")).cast("binary"))
    at = (h % F.length("word")).cast("int")
    cut = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return F.when(F.coalesce(h % every == 0, F.lit(False)), cut).otherwise(F.col("word"))


def _borders(vocabulary: DataFrame, parts: int, s: Settings) -> list[str]:
    """Words that cut the vocabulary into about even stretches: a sample of fixed size, the same in every run."""
    some = vocabulary.orderBy(F.xxhash64("word"), "word").limit(parts * s.sample).select("word").collect()
    ordered = sorted(r["word"] for r in some)
    return ordered[s.sample // 2 :: s.sample]


class Numbering:
    """Numbers of trie nodes, for words that come in order within a stretch between two borders."""

    def __init__(self, borders: list[str]):
        self.borders = borders
        self.paths: list[list[int]] = []  # per border the numbers of its prefixes, below zero
        path, lowest = [ROOT], ROOT
        for k, word in enumerate(borders):
            path = path[: (_shared(borders[k - 1], word) if k else 0) + 1]
            new = len(word) + 1 - len(path)
            path = path + list(range(lowest - 1, lowest - 1 - new, -1))
            lowest -= new
            self.paths.append(path)
        self.at, self.next, self.word, self.path = -1, 0, "", [ROOT]

    def nodes(self, word: str) -> list[int]:
        """The numbers of the prefixes of a word, by length; the word is not smaller than the one before, if of the same stretch."""
        at = bisect_right(self.borders, word)
        if at != self.at:
            self.at, self.next, self.word, self.path = at, at << BITS, "", [ROOT]
        path = self.path[: _shared(self.word, word) + 1]
        for k in (at - 1, at):  # prefixes of a border stand in several stretches
            if 0 <= k < len(self.borders):
                common = _shared(self.borders[k], word)
                if common >= len(path):
                    path += self.paths[k][len(path) : common + 1]
        new = len(word) + 1 - len(path)
        path += range(self.next, self.next + new)
        self.next += new
        self.word, self.path = word, path
        return path


def _shared(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _numbered(table: DataFrame, borders: list[str], out: str, keyed: bool) -> DataFrame:
    """Add ``out``, the path of ``word`` in the trie of all words, and with ``keyed`` ``id``, numbers in the order of words."""
    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    kept = table.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [bisect_right(borders, w) for w in b.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], [*kept, "stretch"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, stretch, own = Numbering(borders), -1, 0
        for b in batches:
            ids, paths, edges = [], [], [0]
            for word, at in zip(b.column("word").to_pylist(), b.column("stretch").to_pylist(), strict=True):
                own = own + 1 if at == stretch else 0
                stretch = at
                ids.append(at << BITS | own)
                paths.append(np.array(trie.nodes(word), np.int64))
                edges.append(edges[-1] + len(paths[-1]))
            path = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate(paths) if paths else np.empty(0, np.int64)))
            more = [pa.array(ids, pa.int64())] if keyed else []
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], path, *more], [*kept, out, *(["id"] if keyed else [])])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    placed = table.mapInArrow(place, f"{schema}, stretch bigint")
    ordered = placed.repartition(parts, "stretch").sortWithinPartitions("stretch", "word")
    return ordered.mapInArrow(number, f"{schema}, {out} array<bigint>" + (", id bigint" if keyed else ""))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of nodes of each word, some hundred thousand at a time."""
    for b in batches:
        held, size = [], 0
        for i in range(b.num_rows):
            word = b.column("word")[i].as_py()
            prefix = b.column("prefixes")[i].values.to_numpy()
            suffix = b.column("suffixes")[i].values.to_numpy()[::-1]  # by place: that of the rest of the word
            k, points = len(word), np.frombuffer(word.encode("utf-32-le"), np.uint32)
            last = np.r_[points[:-1] != points[1:], True]
            for a in range(0, 2 * k + 1, FLUSH):  # first the skipped places, then the cuts
                skip, cut = np.arange(min(a, k), min(a + FLUSH, k)), np.arange(max(a, k) - k, max(min(a + FLUSH, 2 * k + 1) - k, 0))
                held.append(
                    (
                        np.r_[prefix[skip], prefix[cut]], np.r_[suffix[skip + 1], suffix[cut]],
                        np.full(len(skip) + len(cut), b.column("id")[i].as_py()), np.full(len(skip) + len(cut), b.column("n")[i].as_py()),
                        np.r_[np.zeros(len(skip), bool), np.ones(len(cut), bool)], np.r_[last[skip], np.ones(len(cut), bool)],
                    )
                )
                size += len(held[-1][0])
                if size >= FLUSH:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)


def _batch(held: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PAIRS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names)


def neighbours(vocabulary: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Of distinct words (word, n): the words with ``id``, in their order, and per id with near words ``n_near`` and ``best``.

    ``best`` is the id of the near word with the largest n, of equal ones the smallest word, and ``best_n`` that n.
    """
    s, spark = settings, vocabulary.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    back = vocabulary.select(F.reverse("word").alias("word"), "n")
    back = _numbered(back, _borders(back, parts, s), "suffixes", keyed=False)
    there = back.select(F.reverse("word").alias("word"), "n", "suffixes")
    known, _ = stored(_numbered(there, _borders(vocabulary, parts, s), "prefixes", keyed=True), "spelling-tries")
    pairs = known.mapInArrow(_pairs, PAIRS)
    member = F.struct("n", (-F.col("id")).alias("minus"), "cut", "last")  # in this order the greatest is the best
    groups = pairs.groupBy("prefix", "suffix").agg(F.sort_array(F.collect_list(member), asc=False).alias("all")).where(F.size("all") > 1)
    only = lambda which: F.filter("all", which)
    groups = groups.select(
        only(lambda m: ~m["cut"]).alias("skips"), only(lambda m: m["last"] & ~m["cut"]).alias("lasts"), F.get(only(lambda m: m["cut"]), F.lit(0)).alias("whole")
    )
    told = lambda me, n, best: F.struct(me["minus"].alias("minus"), n.cast("bigint").alias("n_near"), best["n"].alias("n"), best["minus"].alias("best"))
    skips, lasts, whole = F.col("skips"), F.col("lasts"), F.col("whole")
    first = F.get(skips, F.lit(0))
    rest = F.transform(skips, lambda m: told(m, F.size(skips) - 1, F.when(m["minus"] == first["minus"], F.get(skips, F.lit(1))).otherwise(first)))
    inserted = F.when(whole.isNotNull(), F.concat(F.transform(lasts, lambda m: told(m, F.lit(1), whole)), F.array(told(whole, F.size(lasts), F.get(lasts, F.lit(0))))))
    news = groups.select(F.explode(F.concat(rest, F.coalesce(inserted, F.array()))).alias("m")).select("m.*").where("n_near > 0")
    best = F.max(F.struct("n", "best"))
    near = news.groupBy("minus").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return known.select("id", "word", "n"), near.select((-F.col("minus")).alias("id"), "n_near", F.col("b.n").alias("best_n"), (-F.col("b.best")).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of (id, form): forms are followed by doubling, each round written; n grows along them, so there are no circles."""
    now, _ = stored(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        there = now.select(F.col("id").alias("root"), F.col("root").alias("on"))
        moved = now.join(there, "root", "left").select("id", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved"))
        moved, _ = stored(moved, "spelling-roots")
        now = moved.select("id", "root")
        if not moved.where("moved").limit(1).count():
            return now


def group(vocabulary: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per word of (word, n): form, root, n, n_near, form_n.

    Words are distinct and at least one code point long; rows with a null word are left out. ``form`` is the most
    frequent near word, of equally frequent ones the smallest, if it is ``factor`` times as frequent as the word.
    Words may be of any length. An empty vocabulary gives an empty result.
    """
    vocabulary, _ = stored(vocabulary.where("word IS NOT NULL").select("word", F.col("n").cast("bigint").alias("n")), "spelling-words")
    known, near = neighbours(vocabulary, settings)
    lead = known.join(near, "id", "left").withColumn("form", F.when(F.col("best_n") >= F.lit(settings.factor) * F.col("n"), F.col("best")))
    lead, _ = stored(lead.withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("bigint"))), "spelling-forms")
    led = lead.where("form IS NOT NULL").select("id", "form")
    names = lambda as_: known.select(F.col("id").alias(as_), F.col("word").alias(f"{as_}_word"))
    ends = led.join(_roots(led), "id").join(names("form"), "form").join(names("root"), "root").select("id", "form_word", "root_word")
    return lead.join(ends, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near",
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )


def vocabulary(tokens: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n) of rows with a ``word``: those of enough code points that occur often enough."""
    s = settings
    long = tokens.where(F.length("word") >= s.least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= s.least_count)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = 0, settings: Settings = Settings()) -> DataFrame:
    """Spelling variants among the words of all texts, as ``group`` gives them.

    Texts of null and without words give nothing; repeated rows count as often as they occur; extra columns play no part. With
    ``damage`` one code point is taken out of about one in so many (document, word), to have misspellings to find.
    """
    found = words(docs.select(name(id_col).alias("id"), name(text_col).alias("text")))
    found = found.where(F.length("word") >= settings.least_length)  # losing a code point makes no word longer
    if damage:
        found = found.select(damaged(F.col("id"), damage).alias("word"))
    return group(vocabulary(found, settings), settings)
