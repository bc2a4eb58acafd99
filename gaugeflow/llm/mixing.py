"""Mixing sources to target weights: blocks drawn by multinomial counts and index permutations.

1. Sources get targets: shares by weight, none above ``most`` times its size.
2. Words of a source are packed into blocks of a fixed length: ``block`` words, or
   less for a small source, so that it and its target are ``pieces`` blocks at
   least and a whole number of blocks comes near its target. Documents go to
   chunks by a hash, are laid end to end within a chunk, and the chunk is cut;
   so a source that holds a third of all rows is packed by many tasks.
3. Output shards of ``slots`` slots draw a source for each slot, which makes the
   counts of a shard multinomial. Slots drawn beyond what a source's target
   allows are handed to the sources that fell short, so that totals hold exactly.
4. A source's i-th slot takes block p(i mod n) of its n blocks, p being a
   pseudorandom permutation of the indexes, another one for each time round:
   swap-or-not rounds, which permute any number of indexes without a table.
5. Slots and blocks are joined by (source, index).

Everything is DataFrame expressions. Draws come from hashes of seed, shard and
slot, so reruns agree whatever the partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import name, running_sum, stored, word_array

ROUNDS = 24


@dataclass(frozen=True)
class Settings:
    block: int = 256  # words in a block, at most
    pieces: int = 64  # blocks in a source and in its target, at least, if these have as many words
    slots: int = 1024  # blocks in an output shard
    chunk: int = 256  # blocks that are packed together, about
    most: int = 3  # times a source may be taken
    weights: tuple[int, ...] = (1, 2, 3)  # in the order of sources, repeating
    seed: int = 20


def targets(sizes: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(source, source_size, at, target): ``sizes`` has a row (source, size) per document.

    Sources by code point, null last, get the weights in turn and share the
    total by weight. Where a share is above ``most`` times the size it stops
    there and the excess goes to the others by weight, until none is above: all
    end at one level per unit of weight, or at their limit. One row per source
    is ordered by a single task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in s.weights]), (F.col("at") % len(s.weights) + 1).cast("int"))
    per = per.withColumn("at", at).withColumn("weight", weight)
    cap = F.col("source_size") * s.most
    full = Window.orderBy(cap / F.col("weight"), "at")
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = per.withColumn("level", left / F.sum("weight").over(after))
    open_ = F.when(cap / F.col("weight") > F.col("level"), F.col("level"))
    share = F.least(F.coalesce(F.max(open_).over(whole) * F.col("weight"), cap.cast("double")), cap.cast("double"))
    return level.withColumn("target", share).select("source", "source_size", "at", "target")


def _cells(df: DataFrame, low: str, high: str, width: int) -> DataFrame:
    """A row per stretch of ``width`` that [low, high) touches: an equi-join then finds the interval of a number."""
    cells = F.sequence(F.floor(F.col(low) / width), F.floor((F.col(high) - 1) / width))
    return df.where(F.col(low) < F.col(high)).withColumn("cell", F.explode(cells))


def _within(points: DataFrame, value: str, spans: DataFrame, low: str, high: str, total: int, n: int) -> DataFrame:
    """Join each point with the one interval of ``spans`` that holds it."""
    width = max(1, total // (4 * max(n, 1)))
    cells = _cells(spans, low, high, width)
    met = points.withColumn("cell", F.floor(F.col(value) / width)).join(cells, "cell")
    return met.where((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("cell")


def permuted(index: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0 .. n-1, chosen by ``key``, at ``index``.

    Each round pairs every index with another (their sum is a number drawn for
    the round) and swaps the pair or not by a hash of its larger member.
    """

    def step(x: Column, r: Column) -> Column:
        y = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        swap = F.xxhash64(key, -r, F.greatest(x, y)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, y).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("bigint"), step)


@dataclass(frozen=True)
class Mix:
    """sizes: (id, digest, source, size) of different documents; sources: (source, .., n_blocks, quota);
    pieces: (id, digest, source, block, word, words), the part of a document in a block;
    taken: (shard, slot, source, epoch, block), the mix."""

    sizes: DataFrame
    sources: DataFrame
    pieces: DataFrame
    taken: DataFrame


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    on = [a[c].eqNullSafe(b[c]) for c in columns]
    out = on[0]
    for c in on[1:]:
        out = out & c
    return out


def keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    digest = F.xxhash64(F.coalesce(name(text_col).cast("string"), F.lit("")))
    return docs.select(name(id_col).alias("id"), digest.alias("digest"), name(source_col).alias("source"), name(text_col).alias("text"))


def _numbered(drawn: DataFrame, sources: DataFrame) -> DataFrame:
    """(shard, slot, at, i, quota): a slot is the i-th of its source.

    Spark sizes ``drawn`` by its file, some five bytes a row, and would broadcast
    every slot to save the shuffle of the counts: the join is a merge join.
    """
    counts = running_sum(drawn.groupBy("at", "shard").count(), ["at"], "shard", "count", "before")
    rank = F.row_number().over(Window.partitionBy("at", "shard").orderBy("slot")) - 1
    ranked = drawn.withColumn("rank", rank).hint("merge").join(counts, ["at", "shard"])
    numbered = ranked.join(sources.select("at", "quota"), "at")
    return numbered.select("shard", "slot", "at", (F.col("before") + F.col("rank")).alias("i"), "quota")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", settings: Settings = Settings()
) -> Mix:
    """Draw the mix. Rows equal in id, text and source are one document; a null text has size 0."""
    s, spark = settings, docs.sparkSession
    sized = keyed(docs, id_col, text_col, source_col).select("id", "digest", "source", F.size(word_array(F.col("text"))).cast("bigint").alias("size"))
    sizes, _ = stored(sized.distinct(), "mix-sizes")
    length = F.floor(F.least(F.col("source_size").cast("double"), "target") / s.pieces)
    plan = targets(sizes.select("source", "size"), s)
    plan, _ = stored(plan.withColumn("length", F.greatest(F.lit(1), F.least(F.lit(s.block), length)).cast("bigint")), "mix-targets")
    # blocks
    n_chunks = F.ceil(F.col("source_size") / (F.col("length") * s.chunk))
    chunk = F.when(n_chunks > 1, F.pmod(F.xxhash64("id", "digest", F.lit(s.seed)), n_chunks)).otherwise(F.lit(0))
    there = sizes.join(plan, _same(sizes, plan, ["source"])).select(sizes["id"], "digest", sizes["source"], "size", "length", chunk.cast("bigint").alias("chunk"))
    lay = Window.partitionBy("source", "chunk").orderBy(F.col("id").asc_nulls_last(), "digest").rowsBetween(Window.unboundedPreceding, 0)
    laid = there.where("size > 0").withColumn("end", F.sum("size").over(lay)).withColumn("start", F.col("end") - F.col("size"))
    chunks = there.groupBy("source", "chunk").agg(F.ceil(F.sum("size") / F.max("length")).alias("n"))
    chunks, _ = stored(running_sum(chunks, ["source"], "chunk", "n", "first"), "mix-chunks")
    blocks = F.explode(F.sequence(F.floor(F.col("start") / F.col("length")), F.floor((F.col("end") - 1) / F.col("length"))))
    cut = laid.withColumn("k", blocks)
    low = F.greatest("start", F.col("k") * F.col("length"))
    cut = cut.withColumns({"word": low - F.col("start"), "words": F.least("end", (F.col("k") + 1) * F.col("length")) - low})
    pieces = cut.join(chunks, _same(cut, chunks, ["source", "chunk"])).select(
        "id", "digest", cut["source"], (F.col("first") + F.col("k")).alias("block"), "word", "words"
    )
    # quotas
    per = chunks.groupBy("source").agg(F.sum("n").alias("n_blocks"))
    some = plan.join(per, _same(plan, per, ["source"])).select(plan["source"], "source_size", "at", "target", "n_blocks")
    quota = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("n_blocks") / F.col("source_size"))).otherwise(0)
    some = some.withColumn("quota", F.least(quota.cast("bigint"), F.col("n_blocks") * s.most))
    upto = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sources, _ = stored(some.withColumn("q_high", F.sum("quota").over(upto)).withColumn("q_low", F.col("q_high") - F.col("quota")), "mix-sources")
    n, total = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("quota"), F.lit(0))).first()
    # draws
    slots = spark.range(total).select(F.floor(F.col("id") / s.slots).alias("shard"), F.col("id").alias("slot"))
    slots = slots.withColumn("draw", F.pmod(F.xxhash64(F.lit(s.seed), "shard", "slot"), F.lit(max(total, 1)).cast("bigint")))
    drawn, _ = stored(_within(slots, "draw", sources, "q_low", "q_high", total, n).select("shard", "slot", "at"), "mix-drawn")
    numbered, _ = stored(_numbered(drawn, sources), "mix-numbered")
    # slots beyond a quota go to the sources that fell short
    over = numbered.where("i >= quota").select("shard", "slot")
    spare = running_sum(over.groupBy("shard").count(), [], "shard", "count", "before")
    turn = F.row_number().over(Window.partitionBy("shard").orderBy("slot")) - 1
    over = over.withColumn("turn", turn).join(spare, "shard").select("shard", "slot", (F.col("before") + F.col("turn")).alias("turn"))
    got = numbered.groupBy("at").agg(F.count(F.lit(1)).alias("got"))
    short = sources.join(got, "at", "left").select("at", F.coalesce("got", F.lit(0)).alias("got"), "quota")
    lack = short.withColumn("lack", F.greatest(F.col("quota") - F.col("got"), F.lit(0)))
    lack = lack.withColumn("l_high", F.sum("lack").over(upto)).withColumn("l_low", F.col("l_high") - F.col("lack"))
    filled = _within(over, "turn", lack, "l_low", "l_high", total, n)
    filled = filled.select("shard", "slot", "at", (F.col("got") + F.col("turn") - F.col("l_low")).alias("i"))
    every = numbered.where("i < quota").select("shard", "slot", "at", "i").unionAll(filled)
    every = every.join(sources.select("at", "source", "n_blocks"), "at")
    epoch = F.floor(F.col("i") / F.col("n_blocks"))
    key = F.xxhash64(F.lit(s.seed + 1), "at", "epoch")
    taken = every.withColumn("epoch", epoch).withColumn("key", key)
    taken = taken.withColumn("block", permuted(F.col("i") % F.col("n_blocks"), F.col("n_blocks"), F.col("key")))
    return Mix(sizes, sources, pieces, taken.select("shard", "slot", "source", "epoch", "block"))


def report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", settings: Settings = Settings()
) -> DataFrame:
    """(id, size, source_size, target, taken) per row of ``docs``.

    taken: the words that the mix takes of the document, repeats counted. Rows
    equal in id, text and source are one document, counted once, and show the
    same figures. Null ids and sources are values like others; empty tables give
    no rows.
    """
    m = mix(docs, id_col, text_col, source_col, settings)
    times = m.taken.groupBy("source", "block").agg(F.count(F.lit(1)).alias("times"))
    hit = m.pieces.join(times, _same(m.pieces, times, ["source", "block"]))
    took = hit.groupBy("id", "digest", m.pieces["source"]).agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    rows = keyed(docs, id_col, text_col, source_col).drop("text")
    sized = rows.join(m.sizes, _same(rows, m.sizes, ["id", "digest", "source"])).select(*[rows[c] for c in rows.columns], "size")
    full = sized.join(took, _same(sized, took, ["id", "digest", "source"]), "left").select(
        sized["id"], sized["source"], "size", F.coalesce("taken", F.lit(0)).alias("taken")
    )
    return full.join(m.sources, _same(full, m.sources, ["source"])).select(
        full["id"].alias(id_col), "size", "source_size", "target", F.col("taken").cast("bigint").alias("taken")
    )


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", settings: Settings = Settings()
) -> DataFrame:
    """The mix as documents, in the columns of ``docs``.

    Each time round that takes words of a document gives a row with these words
    (the text as it is where all are taken, else the words joined by one space);
    a document of which nothing is taken gives none. ``n_chars``, if there, is
    counted anew.
    """
    m = mix(docs, id_col, text_col, source_col, settings)
    hit = m.pieces.join(m.taken, _same(m.pieces, m.taken, ["source", "block"]))
    parts = hit.groupBy("id", "digest", m.pieces["source"].alias("source"), "epoch").agg(
        F.sort_array(F.collect_list(F.struct("word", "words"))).alias("parts"), F.sum("words").alias("n")
    )
    k = parts.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), F.col("source").alias("__source"), F.col("parts").alias("__parts"), F.col("n").alias("__n"))
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # names of their own, whatever the columns are called
    mine = docs.select(*[name(c).alias(a) for c, a in at.items()])
    words, text = word_array(F.col(at[text_col])), F.col(at[text_col])
    digest = F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))
    on = F.col(at[id_col]).eqNullSafe(F.col("__id")) & (digest == F.col("__digest")) & F.col(at[source_col]).eqNullSafe(F.col("__source"))
    both = mine.join(k, on).withColumn("__words", words)
    some = F.transform("__parts", lambda p: F.slice("__words", (p["word"] + 1).cast("int"), p["words"].cast("int")))
    text = F.when(F.size("__words") == F.col("__n"), text).otherwise(F.array_join(F.flatten(some), " "))
    new = {text_col: text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return both.select(*[(new[c] if c in new else F.col(a)).alias(c) for c, a in at.items()])
