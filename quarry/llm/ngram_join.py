"""N-gram Jaccard self-join by grouped prefix filtering.

A text's set holds the hashes of its distinct word n-grams. Two sets with
Jaccard similarity t or more share a token among their first
``n - ceil(t * n) + 1`` tokens of any order that all sets use. The order
puts rare tokens first:

1. Tokens with a hash in the lowest ``share`` are counted over all texts.
   Those that occur once link nothing. In a second pass, with the repeated
   ones in a bitmap, a set with enough unique tokens to fill its prefix has
   no partner and leaves; the sets that stay are written. Documents with the
   same set become one class.
2. All tokens of the classes that stayed are counted among these, for an
   order by count and hash in which again classes leave.
3. Classes with identical prefixes and size are collapsed into one group.
4. Star pairs: in each prefix token's list every group meets the group with
   the fewest unique tokens. Pairs pass bounds on size, on tokens that occur
   once and on the parity bitmaps of the sets (their differing bits cannot
   outnumber differing tokens), then the whole sets are compared.
5. Groups that are now in one component need not meet again. All other group
   pairs of a list pass the same bounds, are expanded to their members and
   compared. So no link between components is lost, and a list of many
   copies of one text is not expanded into all its pairs.

Components of the links give each document its class id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.bitmaps import bitmap, inside
from quarry.llm.common import checkpointed, id_text, map_slices, written
from quarry.plans.components import connected_components

#: Odd multipliers of the words of an n-gram.
MIX = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
#: Most bits of the bitmap of repeated tokens (32 MB; if it fills up, fewer sets leave early and nothing else changes).
MOST_BITS = 28
PARITY_WORDS = 4
#: Ids in a list that is broadcast (16 MB).
LIST_ROWS = 1_000_000
NO_ID = (1 << 63) - 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def token_set(text: str, k: int) -> np.ndarray:
    """Sorted hashes (signed 64-bit) of the distinct ``k``-word shingles; of the whole sequence with fewer words."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.int64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    m = min(k, len(w))
    h = np.full(len(w) - m + 1, m, np.uint64)
    for j in range(m):
        h += w[j:len(w) - m + 1 + j] * MIX[j]
    return np.unique(_mixed(h).view(np.int64))


def _key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _parity(tokens: np.ndarray) -> np.ndarray:
    bits = np.bincount(tokens & (64 * PARITY_WORDS - 1), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def repeated_tokens(docs: DataFrame, k: int, cut: int) -> tuple[np.ndarray, int]:
    """A bitmap of the tokens below ``cut`` that occur in several texts, and its bits."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [s[: np.searchsorted(s, cut)] for s in (token_set(t or "", k) for t in batch.column("text").to_pylist())]
            tokens, times = np.unique(np.concatenate(low), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(np.minimum(times, 2).astype(np.int8))], names=["token", "times"])

    counted = map_slices(docs.select("text"), kernel, "token bigint, times byte").groupBy("token").agg(F.sum("times").alias("times")).filter("times > 1")
    counted = checkpointed(counted.select("token"))
    bits = min(MOST_BITS, max(16, (counted.count() * 16).bit_length()))
    return bitmap(counted.select(F.expr(f"shiftright(token, 20) & {(1 << bits) - 1}").alias("slot")), bits), bits


def profiles(docs: DataFrame, k: int, percent: int, share: float) -> DataFrame:
    """One row per document: ``doc_id, n, key, p0..p3``, and ``tokens``: its set, or null if too few of it can be shared."""
    cut = int(-(1 << 63) + share * (1 << 64))
    table, bits = repeated_tokens(docs, k, cut)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [token_set(t or "", k) for t in batch.column("text").to_pylist()]
            keys = [_key(s) if len(s) else None for s in sets]
            parity = np.stack([_parity(s) for s in sets])
            stay = []
            for s in sets:
                low = s[: np.searchsorted(s, cut)]
                unique = len(low) - int(inside(shared.value, low >> 20 & ((1 << bits) - 1)).sum())
                stay.append(len(s) > 0 and unique < len(s) + (-percent * len(s)) // 100 + 1)
            offsets = pa.array([None if not y else o for y, o in zip(stay, np.cumsum([0, *(len(s) if y else 0 for s, y in zip(sets, stay))]).tolist())] + [sum(len(s) for s, y in zip(sets, stay) if y)], pa.int32())
            flat = [s for s, y in zip(sets, stay) if y]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()), *(pa.array(parity[:, j]) for j in range(PARITY_WORDS)),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(flat) if flat else [], pa.int64()))],
                names=["doc_id", "n", "key", *(f"p{j}" for j in range(PARITY_WORDS)), "tokens"])

    return map_slices(docs, kernel, "doc_id bigint, n bigint, key bigint, " + ", ".join(f"p{j} bigint" for j in range(PARITY_WORDS)) + ", tokens array<bigint>")


def _possible(a: str, b: str, percent: int) -> Column:
    """Bounds on two profiles (structs with n, u, p0..): whether their sets can be similar enough."""
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    shared = F.least(F.col(f"{a}.n") - F.col(f"{a}.u"), F.col(f"{b}.n") - F.col(f"{b}.u"))
    apart = sum((F.bit_count(F.col(f"{a}.p{j}").bitwiseXOR(F.col(f"{b}.p{j}"))) for j in range(PARITY_WORDS)), F.lit(0))
    return (100 * F.least(f"{a}.n", f"{b}.n") >= percent * F.greatest(f"{a}.n", f"{b}.n")) & (shared * (100 + percent) >= both * percent) & (apart * (100 + percent) <= both * (100 - percent))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``src, dst`` of classes whose whole sets are similar enough."""
    joined = pairs.join(sets.select(F.col("gid").alias("src"), F.col("tokens").alias("a")), "src").join(sets.select(F.col("gid").alias("dst"), F.col("tokens").alias("b")), "dst")
    shared = F.size(F.array_intersect("a", "b"))
    return joined.filter(shared * 100 >= (F.size("a") + F.size("b") - shared) * percent).select("src", "dst")


def _listed(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``rows`` with (``left_semi``) or without (``left_anti``) the ``gid`` of ``ids``, a list counted first: up to ``LIST_ROWS`` of these 8-byte numbers are broadcast, so the sets in ``rows`` stay where they are."""
    ids = checkpointed(ids.select("gid"))
    return rows.join(F.broadcast(ids) if ids.count() <= LIST_ROWS else ids, "gid", how)


def components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: set size and smallest id reachable by links of ``percent`` % similarity or more.

    Null, empty and blank texts have no shingles and are linked with nothing;
    texts with the same set are linked; repeated rows stay repeated; a null id
    counts as larger than all others (and as one document's); an empty table
    gives an empty result; other columns are not carried.
    """
    docs = id_text(docs, id_col, text_col)
    parity = [f"p{j}" for j in range(PARITY_WORDS)]
    share = min(1.0, 1.7 * (100 - percent) / 100)
    profiled = written(profiles(docs, k, percent, share).withColumn("gid", F.monotonically_increasing_id()), "sets")
    able = profiled.filter("n > 0")
    classes = able.groupBy("key").agg(F.min("gid").alias("gid"))
    # A class stays with all its documents, or leaves with them.
    stayed = profiled.filter("tokens IS NOT NULL")
    copies = stayed.select("key", "gid").join(classes.withColumnRenamed("gid", "first"), "key").filter("gid != first")
    sets = _listed(stayed.select("gid", "n", *parity, "tokens"), copies, "left_anti")

    # A partner of a class that stayed has stayed too: what counts is how many of these have a token.
    tokens = sets.select("gid", F.explode("tokens").alias("token"))
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = tokens.join(common, "token").groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("own"))  # of one document
    length = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("long") + 1
    some = sets.select("gid", "n", *parity).join(own, "gid").withColumn("u", F.col("n") - F.size("own"))
    some = some.withColumn("prefix", F.transform(F.slice("own", F.lit(1), F.greatest(length - F.col("u"), F.lit(0)).cast("int")), lambda t: t["token"]))
    some = checkpointed(some.filter((F.size("prefix") > 0) & (100 * (F.col("n") - F.col("u")) >= percent * F.col("n"))).select("gid", "n", "u", *parity, "prefix"))
    sets = written(_listed(profiled.select("gid", "tokens"), some, "left_semi"), "compared")

    # Identical prefix and size; a prefix with a token of its own is like no other.
    alike = F.when(F.col("u") == 0, F.struct("n", F.lit(-1).cast("long").alias("gid"), "prefix")).otherwise(F.struct("n", "gid", F.slice("prefix", 1, 0).alias("prefix")))
    tagged = some.withColumn("alike", F.xxhash64(alike))
    groups = tagged.groupBy("alike").agg(F.min("gid").alias("group"), F.count(F.lit(1)).alias("members"))
    members = checkpointed(tagged.join(groups, "alike").select("gid", "group", "members", F.struct("n", "u", *parity).alias("s"), "prefix"))
    lists = checkpointed(members.filter("gid = group").select("group", "members", "s", F.explode("prefix").alias("token")))

    hubs = lists.groupBy("token").agg(F.min(F.struct("s.u", "group", "s")).alias("hub"), F.count(F.lit(1)).alias("m")).filter("m > 1").select("token", F.col("hub.group").alias("dst"), F.col("hub.s").alias("h"))
    stars = lists.join(hubs, "token").filter((F.col("group") != F.col("dst")) & _possible("s", "h", percent)).select(F.col("group").alias("src"), "dst")
    heads = members.filter("gid = group AND members > 1").select("group", F.col("s").alias("h"))
    inner = members.filter("members > 1 AND gid != group").join(heads, "group").filter(_possible("s", "h", percent)).select(F.col("gid").alias("src"), F.col("group").alias("dst"))
    links = checkpointed(_linked(stars.union(inner).distinct(), sets, percent))
    reached = checkpointed(connected_components(links))

    # What is left: group pairs that may link two components.
    labelled = checkpointed(members.select("gid", "group", "members", "s").join(reached.withColumnRenamed("node", "gid"), "gid", "left").withColumn("component", F.coalesce("component", "gid")))
    parts = labelled.groupBy("group").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    placed = lists.join(parts, "group")
    mixed = placed.groupBy("token").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).filter("l != h").select("token")
    placed = checkpointed(placed.join(mixed, "token", "left_semi"))
    a, b = placed.select("token", F.struct("group", "members", "lo", "hi").alias("a"), F.col("s").alias("sa")), placed.select("token", F.struct("group", "members", "lo", "hi").alias("b"), F.col("s").alias("sb"))
    single = (F.col("a.members") == 1) & (F.col("b.members") == 1)
    apart = (F.col("a.lo") != F.col("b.hi")) | (F.col("a.hi") != F.col("b.lo"))
    sizes = 100 * F.least("sa.n", "sb.n") >= percent * F.greatest("sa.n", "sb.n")
    meet = a.join(b, "token").filter((F.col("a.group") <= F.col("b.group")) & apart & F.when(single, _possible("sa", "sb", percent)).otherwise(sizes)).select(F.col("a.group").alias("ga"), F.col("b.group").alias("gb")).distinct()
    left = labelled.select(F.col("group").alias("ga"), F.col("gid").alias("src"), F.col("component").alias("ca"), F.col("s").alias("sa"))
    right = labelled.select(F.col("group").alias("gb"), F.col("gid").alias("dst"), F.col("component").alias("cb"), F.col("s").alias("sb"))
    rest = meet.join(left, "ga").join(right, "gb").filter((F.col("ca") != F.col("cb")) & ((F.col("ga") != F.col("gb")) | (F.col("src") < F.col("dst"))) & _possible("sa", "sb", percent)).select("src", "dst")
    more = _linked(rest, sets, percent)
    final = connected_components(links.union(more))

    # Ids: the smallest of each class, then of each component, back to the rows of the class.
    smallest = able.groupBy("key").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("smallest")).join(classes, "key")
    named = smallest.join(final.withColumnRenamed("node", "gid"), "gid", "left").withColumn("component", F.coalesce("component", "gid"))
    least = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    by_key = named.join(least, "component").select("key", F.when(F.col("component_id") != NO_ID, F.col("component_id")).alias("component_id"))
    full = able.select("doc_id", "key", F.col("n").alias("n_shingles")).join(by_key, "key").select("doc_id", "n_shingles", "component_id")
    return full.union(profiled.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose id is the smallest of their component (rows under one id are one document)."""
    kept = components(docs, k, percent, id_col, text_col).filter(F.col("component_id").eqNullSafe(F.col("doc_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs[id_col].cast("long").eqNullSafe(kept["_kept"]), "left_semi")
