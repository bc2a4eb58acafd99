"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Two that differ in at most three bits differ in
at most three bytes, so they share at least five of their eight positional
bytes: the guaranteed minimum. Among any seven positions they share at least
four, so the index lists fingerprints under every four positional bytes of the
first seven (35 lists each). Single-byte lists would hold 1/256 of all
fingerprints and pairs over them would grow with the square of the input; four
bytes together keep a list short. For a pair that meets in a list the shared
positional bytes are tallied, pairs under the minimum are dropped, and the rest
are verified by counting differing bits. All of it stands in the condition of
the join, so only linked pairs leave it, each once: in the first list they share.

Equal fingerprints are grouped before, however many. Lists longer than
``long_list`` (many different near copies) aren't paired: their members meet at
fingerprints within reach. If x and y differ in at most three bits, some value
is at most one bit from x and at most two from y. Every member sends itself to
the 2081 values within two bits, and whoever is there links to the smallest
member at most one bit from the value, if there is one; two that meet there are
at most three bits apart. That is linear in the length of a list and exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import components, name, stored, type_of, word_chunks

SEED = 42
LONG_LIST = 2000
GROUPS = list(combinations(range(7), 4))


def simhash(data: bytes, shingle: int) -> int:
    """The 64-bit fingerprint of a text, as a signed long; 0 without words.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at the white
    space that separates words here. A megabyte of text is in work at a time.
    """
    bits, total, tail, few = np.zeros(64, np.int64), 0, [], []
    for words in word_chunks(data.lower()):
        run = tail + words
        n = len(run) - shingle + 1
        if n > 0:
            digest, join = xxhash.xxh64_intdigest, b" ".join
            hashes = np.array([digest(join(run[i : i + shingle]), SEED) for i in range(n)], ">u8")
            bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
            total += n
        few = run if not total else []
        tail = run[max(0, len(run) - shingle + 1) :]
    if few:
        return int(np.int64(np.uint64(xxhash.xxh64_intdigest(b" ".join(few), SEED)).view(np.int64)))
    return int(np.packbits(2 * bits > total).view(">u8").astype(np.uint64).view(np.int64)[0]) if total else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fingerprint as long) per row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            got = [simhash(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.int64())], [id_col, "fingerprint"])

    schema = f"`{id_col}` {type_of(docs, id_col)}, fingerprint bigint"
    return docs.select(name(id_col), name(text_col).cast("string")).mapInArrow(run, schema)


def _listed(fps: DataFrame) -> DataFrame:
    """(list key, fingerprint): the four bytes, and the number of the four positions in the byte never used."""
    masks = [sum(0xFF << (8 * (7 - p)) for p in g) for g in GROUPS]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    fp = F.col("fp")
    keys = [fp.bitwiseAND(F.lit(m)).bitwiseOR(F.lit(i)) for i, m in enumerate(signed)]
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _linked(a: Column, b: Column, key: Column, most: int) -> Column:
    """Whether a pair that meets in a list is linked, and that is the first list it meets in."""
    differ = a.bitwiseXOR(b)
    same = [(F.shiftrightunsigned(differ, 8 * (7 - p)).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for p in range(8)]
    tally = reduce(lambda x, y: x + y, same)
    shared = reduce(lambda x, y: x + y, [same[p] * F.lit(1 << p) for p in range(7)])
    group = key.bitwiseAND(F.lit(0xFF)).cast("int") + 1
    mine = F.element_at(F.array(*[F.lit(sum(1 << p for p in g)) for g in GROUPS]), group)
    upto = F.element_at(F.array(*[F.lit((2 << g[-1]) - 1) for g in GROUPS]), group)
    return (tally >= 8 - most) & (F.bit_count(differ) <= most) & (shared.bitwiseAND(upto) == mine)


def links(fps: DataFrame, most: int = 3, long_list: int = LONG_LIST) -> DataFrame:
    """Links (a, b) of different fingerprints ``fp``: enough for the same components as all pairs.

    ``fps`` holds every fingerprint once. Pairs from short lists are all pairs
    within ``most`` (3) bits; members of long lists are linked through a third.
    Spark sizes an exploded table like the one before, a 35th or 2081st of its
    rows, and would broadcast it: these joins are merge joins.
    """
    if most != 3:
        raise ValueError("the index is laid out for three bits")
    listed = _listed(fps)
    long, _ = stored(listed.groupBy("key").count().where(F.col("count") > long_list).select("key"), "simhash-long")
    short = listed.join(long, "key", "left_anti")
    a, b = short.alias("x"), short.alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp"))
    pairs = a.hint("merge").join(b, on & _linked(F.col("x.fp"), F.col("y.fp"), F.col("x.key"), most))
    near = pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    # members of long lists
    members = listed.join(long, "key", "left_semi").select("fp").distinct()
    one = [0, *[1 << i for i in range(64)]]
    two = [*one, *[x | y for x, y in combinations(one[1:], 2)]]
    reach = lambda ms: F.explode(F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in ms]))
    at = lambda ms: members.select("fp", reach(ms).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("at"))
    centre = at(one).groupBy("at").agg(F.min("fp").alias("to"))
    met = at(two).hint("merge").join(centre, "at").where(F.col("fp") != F.col("to")).select(F.col("fp").alias("a"), F.col("to").alias("b"))
    return near.unionAll(met.distinct())


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    most: int = 3,
    long_list: int = LONG_LIST,
) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``.

    component_id is the smallest id reachable over links of at most ``most``
    bits, itself included. Rows with equal texts have equal fingerprints and so
    one component; rows that repeat an id each get a row. Null and empty texts
    have fingerprint zero and are linked like any other. A null id is a row
    without an id: it gets the smallest id of its component, null if there is none.
    An empty table gives an empty result.
    """
    marked, _ = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-marked")
    first = marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(name(id_col)).alias("first"))
    first, _ = stored(first, "simhash-first")
    roots, _ = stored(components(links(first.select("fp"), most, long_list), "simhash"), "simhash-roots")
    placed = roots.join(first, roots["node"] == first["fp"]).select("fp", "root", "first")
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    linked = placed.join(least, "root").select("fp", "least")
    home = first.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return marked.join(home, marked["fingerprint"] == home["fp"]).select(
        marked[id_col], marked["fingerprint"], home["component_id"]
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 3) -> DataFrame:
    """The rows of ``docs``, one for each component, in all their columns.

    The row with the smallest id stays; of rows that share that id the one whose
    text has the smallest digest, and one of rows equal in both. Rows without an
    id stay only where the component has no id. Only ids and digests are ranked;
    texts move once, to meet the list of rows that stay.
    """
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # names of their own, whatever the columns are called
    mine = docs.select(*[name(c).alias(a) for c, a in at.items()])
    id_, text = at[id_col], at[text_col]
    digest = F.coalesce(F.md5(text), F.lit(""))
    ids = mine.select(F.struct(F.col(id_).alias("id"), digest.alias("digest")).alias("row"), F.col(text).alias("text"))
    found = near_duplicates(ids, "row", "text", shingle, most)
    rank = Window.partitionBy("component_id").orderBy(F.col("row.id").asc_nulls_last(), "row.digest")
    best = found.withColumn("n", F.row_number().over(rank)).where("n = 1").select(F.col("row.id").alias("b_id"), F.col("row.digest").alias("b_digest"))
    shown = mine.withColumn("digest", digest)
    kept = shown.join(best, F.col(id_).eqNullSafe(F.col("b_id")) & (F.col("digest") == F.col("b_digest")), "left_semi")
    again = Window.partitionBy(id_, "digest").orderBy(F.xxhash64(*[c for c, t in mine.dtypes if not t.startswith("map")]))
    first = kept.withColumn("n", F.row_number().over(again)).where("n = 1")
    return first.select(*[F.col(a).alias(c) for c, a in at.items()])
