"""Near-duplicate clusters kept between runs.

A collection grows by increments, and comparing each with all of the past
again would shuffle the past every time. The store keeps one document for
each LSH bucket met so far, in a table bucketed by ``(band, bucket)``: new
documents are hashed, shuffled to the same buckets and joined there, so the
stored side is read in place. Sharing a bucket with its stored document is an edge, as is
sharing one with another new document. Clusters of the past are single nodes
in the components of an increment; where it joins some of them, a small table
of renamed clusters says so, and older rows stay as they were written.

Any split of a corpus into increments gives the clusters of one run over all of it:
two documents of one bucket are linked through the document stored for it.
An increment that is run again after a crash, under the same name, adds nothing twice.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.dedup import MinhashConfig, band_keys, collapsed_edges, minhash_signatures
from quarry.plans.components import connected_components
from quarry.session import checkpointed, written

#: Buckets of the stored table; more for a larger collection.
TABLE_BUCKETS = 32


class LshStore:
    """The stored state under ``path``, a shared folder that only this store writes to. Ids are integers and unique over all increments."""

    def __init__(self, spark: SparkSession, path: str, cfg: MinhashConfig = MinhashConfig(), table_buckets: int = TABLE_BUCKETS):
        self.spark, self.path, self.cfg, self.table_buckets = spark, path.rstrip("/"), cfg, table_buckets
        name = hashlib.md5(self.path.encode()).hexdigest()[:12]
        self.bands, self.members = f"quarry_bands_{name}", f"quarry_members_{name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.bands} (band INT, bucket STRING, doc_id BIGINT) USING parquet CLUSTERED BY (band, bucket) INTO {table_buckets} BUCKETS LOCATION '{self.path}/bands'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.members} (doc_id BIGINT, cluster_id BIGINT) USING parquet CLUSTERED BY (doc_id) INTO {table_buckets} BUCKETS LOCATION '{self.path}/members'")

    def _table(self, name: str) -> DataFrame:
        self.spark.sql(f"REFRESH TABLE {name}")
        return self.spark.table(name)

    def _append(self, rows: DataFrame, table: str, *keys: str) -> None:
        rows.repartition(self.table_buckets, *keys).write.insertInto(table)

    def runs(self) -> list[str]:
        """Names of the increments in the store, in order."""
        return [r["run"] for r in self._ledger().orderBy("place").collect()]  # one row for each

    def _ledger(self) -> DataFrame:
        return self._stored("ledger", "run string, place int, renamed string")

    def _stored(self, folder: str, schema: str) -> DataFrame:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")

    def _renamed(self) -> DataFrame:
        """``cluster_id, now`` of the clusters that were joined to others since they were written."""
        last = self._ledger().orderBy(F.desc("place")).first()
        return self._stored(last["renamed"], "cluster_id long, now long") if last else self.spark.createDataFrame([], "cluster_id long, now long")

    def clusters(self) -> DataFrame:
        """``doc_id, cluster_id`` of every document linked to another one; ``cluster_id`` is the smallest id of the cluster."""
        members = self._table(self.members).groupBy("doc_id").agg(F.min("cluster_id").alias("cluster_id"))
        renamed = self._renamed()
        return members.join(renamed, "cluster_id", "left").select("doc_id", F.coalesce("now", "cluster_id").alias("cluster_id"))

    def cross_edges(self, new: DataFrame) -> DataFrame:
        """``src, dst``: new documents (``band, bucket, doc_id``) and the stored document of their bucket; only the new side is shuffled."""
        old = self._table(self.bands).withColumnRenamed("doc_id", "dst")
        return new.join(old.hint("merge"), ["band", "bucket"]).filter("doc_id != dst").select(F.col("doc_id").alias("src"), "dst").distinct()

    def add(self, docs: DataFrame, run: str, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Adds an increment of documents under its name."""
        done = self.runs()
        if run in done:
            return
        sigs = checkpointed(minhash_signatures(docs, self.cfg, id_col, text_col))
        firsts = sigs.groupBy("signature").agg(F.min("doc_id").alias("doc_id"))  # equal signatures share every bucket
        keys = written(band_keys(firsts.select("doc_id", "signature"), self.cfg), "band-keys")
        new = written(keys.groupBy("band", "bucket").agg(F.min("doc_id").alias("doc_id")), "new-buckets")
        # One document of each new bucket stands for the others: in-batch edges link them to it.
        edges = written(self.cross_edges(new).unionByName(collapsed_edges(sigs, self.cfg)), "edges")
        members, renamed = self._table(self.members), self._renamed()
        nodes = edges.select(F.explode(F.array("src", "dst")).alias("doc_id")).distinct()
        known = members.hint("merge").join(nodes, "doc_id").groupBy("doc_id").agg(F.min("cluster_id").alias("cluster_id"))
        known = known.join(renamed, "cluster_id", "left").select("doc_id", F.coalesce("now", "cluster_id").alias("node"))
        node_of = written(nodes.join(known, "doc_id", "left").select("doc_id", F.coalesce("node", "doc_id").alias("node")), "nodes")
        named = edges.join(node_of.toDF("src", "u"), "src").join(node_of.toDF("dst", "v"), "dst").select(F.col("u").alias("src"), F.col("v").alias("dst"))
        component = checkpointed(connected_components(named))
        labelled = node_of.join(component.toDF("node", "component"), "node", "left").select("doc_id", F.coalesce("component", "node").alias("cluster_id"))
        fresh = written(labelled, "members")
        # Clusters of the past that this increment joined, on top of those renamed before.
        joined = component.filter("node != component").join(known.select("node").distinct(), "node", "left_semi").toDF("cluster_id", "now")
        older = renamed.join(joined.toDF("now", "newer"), "now", "left").select("cluster_id", F.coalesce("newer", "now").alias("now"))
        place = len(done)
        name = f"renamed-{place}"
        older.unionByName(joined).groupBy("cluster_id").agg(F.min("now").alias("now")).write.mode("overwrite").parquet(f"{self.path}/{name}")
        self._append(new.join(self._table(self.bands).hint("merge"), ["band", "bucket"], "left_anti").select("band", "bucket", "doc_id"), self.bands, "band", "bucket")
        self._append(fresh.select("doc_id", "cluster_id"), self.members, "doc_id")
        self.spark.createDataFrame([(run, place, name)], "run string, place int, renamed string").coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
