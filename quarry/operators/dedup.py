"""Exact and near-duplicate removal.

Near duplicates follow the MinHash / LSH scheme: word 5-gram shingles, 160
minimum hashes split into 20 bands of 8, documents sharing any band are
linked, connected components are clusters, and the smallest id of a
cluster is kept. Only ids and hashes travel through these shuffles; the
final removal is an anti join against a list of ids, broadcast when its
measured size allows, so that texts are shuffled only beyond that.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import normalise, normalised_words
from quarry.plans.components import connected_components
from quarry.plans.joins import BROADCAST_MAX_BYTES, null_safe_join, remove_listed
from quarry.plans.ordering import prefix_sum
from quarry.session import checkpointed, written

PRIME = (1 << 31) - 1


@dataclass(frozen=True)
class MinhashConfig:
    # Bands, rows per band and words per shingle of the dedup step.
    num_buckets: int = 20
    hashes_per_bucket: int = 8
    n_grams: int = 5
    seed: int = 1

    @property
    def num_hashes(self) -> int:
        return self.num_buckets * self.hashes_per_bucket


def _md5_int(s: str, digits: int) -> int:
    return int(hashlib.md5(s.encode()).hexdigest()[:digits], 16)


def hash_coefficients(cfg: MinhashConfig = MinhashConfig()) -> list[tuple[int, int]]:
    """``(a_j, b_j)`` of the universal hash family ``(a*h + b) mod (2^31-1)``,
    derived from an MD5 rule so any engine can rebuild them."""
    return [(_md5_int(f"minhash:{cfg.seed}:{j}:a", 8) % (PRIME - 1) + 1,
             _md5_int(f"minhash:{cfg.seed}:{j}:b", 8) % PRIME)
            for j in range(cfg.num_hashes)]


# --- exact -----------------------------------------------------------------

def _text_key(text_col: str) -> Column:
    """Hash of the normalised text; a text without any letter or digit counts as it is."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = normalise(text)
    return F.sha2(F.when(plain == "", F.concat(F.lit("\u0000"), text)).otherwise(plain), 256)


def _one_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of ``keys``, chosen by the row's contents (rows
    that tie are equal); a hash aggregation, so a hot value is one row for
    each task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})).alias("_kept")) if rest else df.distinct()
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.`{c}`").alias(c) for c in df.columns])


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each normalised text: that with the smallest id, NULL last.

    Rows are removed, not ids: an id that occurs again with another text keeps
    that row, and copies under one id, or under no id, leave one row (ties:
    the least row as JSON). Texts are hashed once, to a narrow table of hash
    and id; from it come the ids to remove (an anti join, broadcast when its
    measured size allows, so texts are not shuffled) and the ids that occur
    more than once and have copies, whose few rows are judged row by row."""
    rows = df.select(_text_key(text_col).alias("_h"), F.col(id_col).alias("_id"))
    narrow = written(rows, "text-keys")
    by_id = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"))
    repeated = narrow.groupBy("_h").agg(F.min(by_id).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    copies = narrow.join(repeated, "_h").select("_id", F.col("_first.id").alias("_keep"))
    per_id = copies.groupBy("_id").agg(F.count(F.lit(1)).alias("_copies"), F.count_if(~F.col("_keep").eqNullSafe(F.col("_id"))).alias("_gone"))
    unsure = narrow.join(per_id.select("_id"), "_id", "left_semi").groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_id")
    listed = per_id.filter(F.col("_id").isNotNull()).join(unsure, "_id", "left_anti").filter("_gone > 0").select("_id", F.lit(False).alias("_unsure"))
    listed = written(listed.unionByName(unsure.withColumn("_unsure", F.lit(True))).unionByName(
        per_id.filter(F.col("_id").isNull()).select("_id", F.lit(True).alias("_unsure"))), "ids-with-copies")
    count, size = listed.agg(F.count_if("_unsure"), F.sum(F.octet_length(F.col("_id").cast("string")) + 16)).first()
    small = F.broadcast if (size or 0) <= BROADCAST_MAX_BYTES else (lambda side: side)
    known = small(listed.select(F.col("_id").alias("_listed"), "_unsure"))
    if not count:
        return df.join(known, F.col(id_col) == F.col("_listed"), "left_anti")
    sure = df.join(known, F.col(id_col).eqNullSafe(F.col("_listed")), "left_anti")
    judged = df.join(known.filter("_unsure"), F.col(id_col).eqNullSafe(F.col("_listed")), "left_semi").withColumn("_h", _text_key(text_col))
    judged = judged.join(repeated.select("_h", "_first"), "_h", "left").filter(F.col("_first").isNull() | F.col("_first.id").eqNullSafe(F.col(id_col)))
    return sure.unionByName(_one_of_each(judged.drop("_first"), ["_h", id_col]).select(*df.columns))


# --- shingles and signatures ----------------------------------------------

def with_shingles(df: DataFrame, text_col: str = "text", n: int = 5,
                  out: str = "shingles") -> DataFrame:
    """Adds the distinct word n-grams of the normalised text (empty below n
    words). The word array is materialised as a column first so the n-gram
    lambda indexes it instead of re-splitting the text per position."""
    w = df.withColumn("_w", normalised_words(F.coalesce(F.col(text_col), F.lit(""))))
    k = F.size("_w")
    # n shifted views of the word array, zipped: element i holds words
    # i .. i+n-1 (native array ops; one small lambda joins each n-gram).
    views = [F.slice("_w", j + 1, k - (n - 1)).alias(f"w{j}") for j in range(n)]
    grams = F.transform(F.arrays_zip(*views),
                        lambda z: F.concat_ws(" ", *[z[f"w{j}"] for j in range(n)]))
    return w.withColumn(out, F.array_distinct(
        F.when(k >= n, grams).otherwise(F.array().cast("array<string>")))).drop("_w")


def _minhash_batches(coeffs: list[tuple[int, int]], n: int):
    """Normalised texts to signatures. A closure, so executors need not import this package."""
    a = np.array([c[0] for c in coeffs], dtype=np.int64)
    b = np.array([c[1] for c in coeffs], dtype=np.int64)
    prime, most_bytes = PRIME, 1 << 19

    def run(batches):
        """For about half a million bytes of text at a time. Repeated shingles
        are hashed again: a minimum does not change by them."""
        import hashlib

        import numpy as np
        import pyarrow as pa

        def shingle_hashes(text):
            """First 4 bytes of the MD5 of each run of ``n`` words, in a text with one space between words."""
            gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 32).tolist()
            if not text or len(gaps) < n - 1:
                return []
            starts, ends = [0, *[g + 1 for g in gaps]], [*gaps, len(text)]
            md5 = hashlib.md5
            return [md5(text[s:e]).digest()[:4] for s, e in zip(starts, ends[n - 1:])]

        def signatures(ids, hashes, lens):
            values = np.frombuffer(b"".join(hashes), ">u4").astype(np.int64) % prime
            starts = np.cumsum(lens) - lens
            sig = np.empty((len(lens), len(a)), dtype=np.int64)
            for j in range(len(a)):
                # x mod 2^31 - 1: upper and lower 31 bits are added, twice
                x = values * a[j] + b[j]
                x = (x & prime) + (x >> 31)
                x = (x & prime) + (x >> 31)
                x[x == prime] = 0
                sig[:, j] = np.minimum.reduceat(x, starts)
            offsets = np.arange(0, (len(lens) + 1) * len(a), len(a), dtype=np.int32)
            return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig.reshape(-1)))], ["doc_id", "signature"])

        for batch in batches:
            kept, hashes, lens, size = [], [], [], 0
            for i, text in enumerate(batch.column("plain")):
                text = text.as_buffer().to_pybytes()
                got = shingle_hashes(text)
                if got:
                    kept.append(i)
                    hashes += got
                    lens.append(len(got))
                    size += len(text)
                if size > most_bytes:
                    yield signatures(batch.column("doc_id").take(pa.array(kept)), hashes, np.array(lens))
                    kept, hashes, lens, size = [], [], [], 0
            if kept:
                yield signatures(batch.column("doc_id").take(pa.array(kept)), hashes, np.array(lens))
    return run


def minhash_signatures(df: DataFrame, cfg: MinhashConfig = MinhashConfig(),
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, signature array<bigint>[160])`` for documents with at least
    one shingle. A shingle's hash is 31-bit (first 8 hex digits of its MD5,
    modulo 2^31 - 1). Texts are normalised by JVM expressions; normalised words
    have one space between them, so a shingle is a slice of the text and only
    this text goes to the Arrow kernel, which hashes its slices and applies
    each hash function to all of them in numpy, reduced per document."""
    plain = df.select(F.col(id_col).alias("doc_id"), normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("plain"))
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType),
                           T.StructField("signature", T.ArrayType(T.LongType()))])
    return plain.mapInArrow(_minhash_batches(hash_coefficients(cfg), cfg.n_grams), schema)


def band_keys(signatures: DataFrame, cfg: MinhashConfig = MinhashConfig()) -> DataFrame:
    """``(doc_id, band, bucket)``: bucket = MD5 of the band's 8 minima."""
    r = cfg.hashes_per_bucket
    bands = F.transform(F.sequence(F.lit(0), F.lit(cfg.num_buckets - 1)), lambda k: F.struct(
        k.alias("band"),
        F.md5(F.array_join(F.slice(F.col("signature"), k * r + 1, r), " ")).alias("bucket")))
    return signatures.select("doc_id", F.inline(bands))


def lsh_buckets(keys: DataFrame) -> DataFrame:
    """Buckets holding more than one document: ``band, bucket, n_docs,
    min_doc_id`` (partial aggregation, so a hot bucket costs one row per task)."""
    return (keys.groupBy("band", "bucket")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("min_doc_id"))
            .filter(F.col("n_docs") > 1))


def candidate_edges(keys: DataFrame, buckets: DataFrame | None = None) -> DataFrame:
    """Star edges ``member -> bucket minimum``: linear in bucket size, same
    components as all pairs. The member/bucket join is an equi-join; a hot
    bucket is split by AQE's skew handling. The keys are written once, since
    both sides read them."""
    if buckets is None:
        keys = written(keys, "band-keys")
        buckets = lsh_buckets(keys)
    return (keys.join(buckets.select("band", "bucket", "min_doc_id"), ["band", "bucket"])
            .filter(F.col("doc_id") != F.col("min_doc_id"))
            .select(F.col("doc_id").alias("src"), F.col("min_doc_id").alias("dst"))
            .distinct())


def collapsed_edges(sigs: DataFrame, cfg: MinhashConfig = MinhashConfig()) -> DataFrame:
    """Candidate edges with identical signatures collapsed first.

    Documents with the same signature (exact or normalisation-equal copies)
    fall into the same bucket in every band, so a group of copies holding a
    third of the corpus would be multiplied by the number of bands before
    the bucket join. Instead each signature group links to its smallest id
    (a partial aggregation on the signature hash plus one equi-join), and
    LSH runs over one representative per signature. The components are the
    same: a copy shares every bucket with its representative, and the
    representative is the group's smallest id, so bucket minima agree."""
    h = sigs.select("doc_id", F.md5(F.array_join("signature", " ")).alias("_sh"), "signature")
    reps = h.groupBy("_sh").agg(F.min("doc_id").alias("_rep"))
    # One join serves both outputs (the exchange is reused in the plan).
    j = checkpointed(h.join(reps, "_sh"))
    copies = (j.filter(F.col("doc_id") != F.col("_rep"))
              .select(F.col("doc_id").alias("src"), F.col("_rep").alias("dst")))
    rep_sigs = j.filter(F.col("doc_id") == F.col("_rep")).select("doc_id", "signature")
    return copies.unionByName(candidate_edges(band_keys(rep_sigs, cfg)))


def duplicate_clusters(df: DataFrame, cfg: MinhashConfig = MinhashConfig(),
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, cluster_id)`` for every document linked to another one;
    ``cluster_id`` is the smallest id in its cluster."""
    # Signatures are a stage table (like the signature folder of a staged
    # pipeline): both sides of the bucket join derive from them, so they are
    # written once to the checkpoint folder instead of being hashed twice.
    sigs = checkpointed(minhash_signatures(df, cfg, id_col, text_col))
    cc = connected_components(collapsed_edges(sigs, cfg))
    return cc.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster_id"))


def with_row_keys(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each id and text, with a number ``key`` that ascends by id
    (NULL last), then by a hash of the text. For tables whose ids repeat or
    are missing; costs a shuffle of the texts."""
    marked = df.withColumn("_h", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    single = checkpointed(_one_of_each(marked, ["_h", id_col]))
    order = single.select(F.col(id_col).isNull().alias("_none"), F.col(id_col).alias("_id"), "_h")
    numbered = prefix_sum(order, ["_none", "_id", "_h"], out=key).select(F.col("_id").alias(id_col), "_h", key)
    return null_safe_join(single, numbered, [id_col, "_h"]).drop("_h")


def ids_repeat(df: DataFrame, id_col: str = "doc_id") -> bool:
    """Whether an id occurs twice or is missing."""
    twice = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | F.col(id_col).isNull())
    return not twice.isEmpty()


def minhash_dedup(df: DataFrame, cfg: MinhashConfig = MinhashConfig(),
                  id_col: str = "doc_id", text_col: str = "text",
                  clusters: DataFrame | None = None) -> DataFrame:
    """Keep unclustered documents and the first (smallest id, NULL last) of each
    cluster: a left-anti join on the removal list.

    Rows are removed, not ids: where ids repeat or are missing, rows get
    numbers first (:func:`with_row_keys`), and rows of one id and text count
    as one. ``clusters``, if given, names the rows by ids that are unique."""
    if clusters is None and ids_repeat(df, id_col):
        keyed = with_row_keys(df, "_key", id_col, text_col)
        return minhash_dedup(keyed, cfg, "_key", text_col, duplicate_clusters(keyed, cfg, "_key", text_col)).drop("_key")
    cl = clusters if clusters is not None else duplicate_clusters(df, cfg, id_col, text_col)
    removed = cl.filter(F.col("doc_id") != F.col("cluster_id")).select(
        F.col("doc_id").alias(id_col))
    return remove_listed(df, removed, id_col)


def duplicates_removed(df: DataFrame, cfg: MinhashConfig = MinhashConfig(),
                       id_col: str = "doc_id", text_col: str = "text",
                       clusters: DataFrame | None = None) -> DataFrame:
    """The removed side with its cluster id (ids are unique). The list of
    removed ids is written and measured; up to ``BROADCAST_MAX_BYTES`` it is
    broadcast, so that only rows that go are read on, and no text is shuffled."""
    cl = clusters if clusters is not None else duplicate_clusters(df, cfg, id_col, text_col)
    removed = written(cl.filter(F.col("doc_id") != F.col("cluster_id")).withColumnRenamed("doc_id", id_col), "removed-ids")
    size = removed.agg(F.sum(F.octet_length(F.col(id_col).cast("string")) + 24)).first()[0] or 0
    return df.join(F.broadcast(removed) if size <= BROADCAST_MAX_BYTES else removed, id_col)
