"""Byte-pair training through an index from pairs to the chunks that hold them.

Counting every pair again for every merge reads the whole chunk table some
thousand times for a useful vocabulary. Here the distinct chunks of the corpus are
indexed once: one row for each chunk and distinct pair in it, sorted by pair,
so that the holders of one pair are a pruned read. A merge then reads the
holders of its pair, rewrites them, writes their new index rows to a folder of its own, with a
row that says so for each pair that a chunk lost, and sums up
by how much it changed the counts of the pairs around it. Of the rows of one pair
and chunk the last one holds. After ``rounds_per_index`` merges the
chunks are indexed anew.

The driver holds the counts of the ``top`` most frequent pairs and of all pairs with a symbol that
is newer than the index. That is enough: a merge lowers the counts of old
pairs and raises only those with its new symbol, so a pair left out cannot
overtake the lowest count taken in. Once the best known pair falls to that
count the index is made again. Ties go to the earliest first occurrence,
which is looked up in the index for the tied pairs alone.

Results equal ``tokens.bpe_train(chunking="word")``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from quarry.operators.tokens import Merge, symbol, training_chunks
from quarry.plans.parallel import spread
from quarry.session import scratch_path, written

#: Merges between two indexes: each reads the folders of those before it.
ROUNDS_PER_INDEX = 24
#: Pairs whose counts are brought to the driver with each index.
TOP = 4096


@dataclass
class Round:
    """One merge: the pair's count, and the chunks that were read and rewritten for it."""
    n: int
    chunks: int


@dataclass
class _Index:
    """An index and the merges since it was made."""
    chunks: DataFrame
    postings: DataFrame
    counts: dict[str, int]
    least: int
    folders: list[str] = field(default_factory=list)


def _pairs(sym: Column) -> Column:
    """All adjacent pairs of a symbol string, overlapping ones too."""
    return F.when(F.length(sym) < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.length(sym) - 1), lambda i: F.substring(sym, i, F.lit(2))))


_CHUNK = ["chunk", "weight", "doc_id", "chunk_pos", "sym"]


def _indexed(chunks: DataFrame, top: int) -> _Index:
    """Index of the chunk table, and the most frequent pairs."""
    postings = chunks.select(F.explode(F.array_distinct(_pairs(F.col("sym")))).alias("pair"), *_CHUNK)
    n_parts = max(1, int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    postings = written(postings.repartitionByRange(n_parts, "pair").sortWithinPartitions("pair"), "pair-index")
    counts = chunks.select("weight", F.explode(_pairs(F.col("sym"))).alias("pair")).groupBy("pair").agg(F.sum("weight").alias("n"))
    best = [(r["pair"], r["n"]) for r in counts.orderBy(F.desc("n"), "pair").limit(top + 1).collect()]
    return _Index(chunks, postings, dict(best[:top]), best[top][1] if len(best) > top else 0)


def _rewritten(index: _Index) -> DataFrame | None:
    """Index rows of the chunks that merges since the index rewrote, with the merge's ``round``."""
    if not index.folders:
        return None
    return _read(index, index.folders)


def _read(index: _Index, folders: list[str]) -> DataFrame:
    schema = StructType([*index.postings.schema.fields, StructField("gone", BooleanType()), StructField("old", StringType()), StructField("round", IntegerType())])
    return index.postings.sparkSession.read.schema(schema).parquet(*folders)


def _present(index: _Index, pairs: list[str] | None) -> DataFrame:
    """Present rows of the chunks that hold one of the pairs, with ``pair``; of all chunks, one row each, for None."""
    later = _rewritten(index)
    if pairs is None:
        if later is None:
            return index.chunks
        last = later.filter("old IS NOT NULL").groupBy("chunk").agg(F.max("round").alias("_last"))
        newest = later.filter("old IS NOT NULL").join(last, "chunk").filter(F.col("round") == F.col("_last"))
        return index.chunks.join(last, "chunk", "left_anti").select(*_CHUNK).unionByName(newest.select(*_CHUNK))
    held = index.postings.filter(F.col("pair").isin(pairs))
    if later is None:
        return held
    rows = held.withColumn("gone", F.lit(False)).withColumn("round", F.lit(-1)).unionByName(later.filter(F.col("pair").isin(pairs)).drop("old"))
    last = rows.groupBy("pair", "chunk").agg(F.max_by(F.struct("weight", "doc_id", "chunk_pos", "sym", "gone"), "round").alias("_l"))
    return last.select("pair", "chunk", "_l.*").filter("NOT gone").drop("gone")


def _earliest(index: _Index, pairs: list[str]) -> str:
    """Of pairs that tie, the one that occurs first by document, chunk and place."""
    places = _present(index, pairs).select("pair", F.struct("doc_id", "chunk_pos", F.expr("instr(sym, pair)")).alias("at"))
    return places.groupBy("pair").agg(F.min("at").alias("at")).orderBy("at").first()["pair"]


def _merge(index: _Index, pair: str, new: str, n_round: int) -> int:
    """Rewrites the pair's holders and brings the counts up to date; the number of holders."""
    changed = _present(index, [pair]).select("chunk", "weight", "doc_id", "chunk_pos", F.replace("sym", F.lit(pair), F.lit(new)).alias("sym"), F.col("sym").alias("old"), F.lit(n_round).alias("round"))
    # A row for each distinct pair of the new string and each that it lost (the merged one at least); the first has the old string too.
    now, before = F.array_distinct(_pairs(F.col("sym"))), F.array_distinct(_pairs(F.col("old")))
    row = lambda gone: lambda p: F.struct(p.alias("pair"), F.lit(gone).alias("gone"))
    each = changed.select("*", F.posexplode(F.concat(F.transform(now, row(False)), F.transform(F.array_except(before, now), row(True)))).alias("_i", "_p"))
    rows = each.withColumn("old", F.when(F.col("_i") == 0, F.col("old"))).select("_p.pair", *_CHUNK, "_p.gone", "old", "round")
    path = scratch_path(index.chunks.sparkSession, f"pairs-{n_round}")
    rows.write.parquet(path)
    index.folders.append(path)
    once = _read(index, [path]).filter("old IS NOT NULL")
    signed = lambda sym, sign: F.transform(_pairs(F.col(sym)), lambda p: F.struct(p.alias("pair"), (F.lit(sign) * F.col("weight")).alias("n")))
    moves = once.select(F.inline(F.concat(signed("old", -1), signed("sym", 1), F.array(F.struct(F.lit("").alias("pair"), F.lit(1).cast("long").alias("n"))))))
    # At most a few rows for each symbol: the pairs beside the merged one, before and after.
    deltas = {r["pair"]: r["n"] for r in moves.groupBy("pair").agg(F.sum("n").alias("n")).filter("n != 0").collect()}
    holders = deltas.pop("", 0)
    for p, n in deltas.items():
        if p in index.counts or new in p:
            index.counts[p] = index.counts.get(p, 0) + n
            if not index.counts[p]:
                del index.counts[p]
    return holders


def bpe_train_indexed(docs: DataFrame, n_merges: int, first_id: int = 256, id_col: str = "doc_id", text_col: str = "text",
                      rounds_per_index: int = ROUNDS_PER_INDEX, top: int = TOP) -> tuple[list[Merge], list[Round]]:
    """``n_merges`` merges learned on words (texts are cut before each space), and what each of them read.

    Each takes the most frequent adjacent pair (ties: the earliest first
    occurrence) and gives it id ``first_id`` plus its number; fewer if no pair is left. NULL texts are empty.
    """
    chunks = training_chunks(spread(docs), id_col, text_col, "word").withColumn("chunk", F.monotonically_increasing_id())
    index = _indexed(written(chunks.select(*_CHUNK), "chunks"), top)
    merges: list[Merge] = []
    rounds: list[Round] = []
    back = {symbol(i): i for i in range(256)}
    while len(merges) < n_merges:
        best = max(index.counts.values(), default=0)
        if not best and not index.least:
            break
        if best <= index.least and index.folders or len(index.folders) == rounds_per_index:
            index = _indexed(written(_present(index, None).select(*_CHUNK), "chunks"), top)
            continue
        if best <= index.least:  # more pairs tie than were taken in
            top *= 2
            index = _indexed(index.chunks, top)
            continue
        tied = [p for p, n in index.counts.items() if n == best]
        pair = tied[0] if len(tied) == 1 else _earliest(index, tied)
        new_id = first_id + len(merges)
        merges.append(Merge(len(merges), back[pair[0]], back[pair[1]], new_id))
        back[symbol(new_id)] = new_id
        rounds.append(Round(best, _merge(index, pair, symbol(new_id), len(merges) - 1)))
    return merges, rounds
