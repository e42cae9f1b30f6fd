"""A stored BM25 index: built once, searched many times without reading the texts again.

An index is a folder of segments. Documents of a segment are cut, as a task reads them, into blocks of at most ``BLOCK``; a row of
its postings holds what one term has in one block (places and counts as arrays) with the largest count and the shortest
length, and rows lie in buckets by the term's hash, sorted by term, so that a search opens the files of its terms only. A row of its
documents holds the ids and lengths of one block. ``append`` adds a segment, ``delete`` a list of documents that earlier segments no
longer have; ``log`` tells how many documents and tokens there are.

A search scores a block as a matrix product of its postings with all queries, and only a block's ``k`` best leave it: postings are
shuffled once, as they are stored, whatever the number of queries. A few queries first read the rows without their arrays: for
each block the most that a document in it can score. The blocks that can score most are scored; the k-th best score found
so is a floor, and of all other blocks only those that can reach it are read. The result is exactly that of scoring every document.

Null texts count as empty, null ids are documents without an id (they can't be deleted). An id that is appended again is a document
beside the old one, unless that was deleted. Queries of any number are answered, in portions of ``ASKED`` cells of (query, term), each of
which reads the index once; queries without terms, or on an empty index, have no rows. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import DoubleType, LongType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from loomwright.session import forget, new_folder, ship_package, written

from .retrieval import B, CELLS, FEW_QUERIES, K1, _query_terms, term_codes
from .windows import top_per_group

#: Documents and characters in a block, buckets of terms, blocks of a query that are scored first, terms that are named in a filter at
#: most, and cells of (query, term) in a portion of queries.
BLOCK, CHARS, BUCKETS, FIRST, NAMED, ASKED = 512, 2_000_000, 64, 8, 2_000, 4_000_000
#: A block's row of term -1 has its documents; the others have a term's places in the block and its counts there.
ROWS = "term long, block long, place array<int>, tf array<int>, most int, least int, doc array<long>, dl array<int>"


def _bucket(term):
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _blocks(rows: DataFrame) -> DataFrame:
    """(doc, text) rows as ``ROWS``; blocks are numbered by task."""
    most, spark_schema = BLOCK, StructType.fromDDL(ROWS)
    schema = to_arrow_schema(spark_schema)

    def made(block: int, ids: list, texts: list) -> pa.RecordBatch:
        codes, who, dl = term_codes(texts)
        by = np.lexsort((who, codes))
        codes, who = codes[by], who[by]
        new = np.ones(len(codes) + 1, bool)
        new[1:-1] = (codes[1:] != codes[:-1]) | (who[1:] != who[:-1])
        at = np.flatnonzero(new)
        tf, codes, who = np.diff(at).astype(np.int32), codes[at[:-1]], who[at[:-1]].astype(np.int32)
        terms, first = np.unique(codes, return_index=True)
        ends = pa.array(np.concatenate([[0], first, [len(codes)]]), pa.int32())
        none = pa.array([0] + [len(ids)] * (len(terms) + 1), pa.int32())
        size = len(terms) + 1
        columns = [
            np.concatenate([[-1], terms]), np.full(size, block),
            pa.ListArray.from_arrays(ends, pa.array(who, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32())),
            np.concatenate([[0], np.maximum.reduceat(tf, first) if len(first) else []]), np.concatenate([[0], np.minimum.reduceat(dl[who], first) if len(first) else []]),
            pa.ListArray.from_arrays(none, pa.array(ids, pa.int64())), pa.ListArray.from_arrays(none, pa.array(dl, pa.int32())),
        ]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c).cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, texts, chars = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (len(ids) == most or chars + len(text or "") > CHARS):
                    yield made(block, ids, texts)
                    block, ids, texts, chars = block + 1, [], [], 0
                ids.append(i)
                texts.append(text)
                chars += len(text or "")
        if ids:
            yield made(block, ids, texts)

    return rows.mapInArrow(run, spark_schema)


def _best_of_block(pairs: list, query: StructField, idf: dict[int, float], avgdl: float, k: int, spark: SparkSession):
    """A function from the rows of one block to (query, doc, score) of those that can be among a query's ``k`` best of the block, and
    the schema of that. ``pairs``: rows (query, term)."""
    names = sorted({r["query"] for r in pairs}, key=lambda q: (q is None, q))
    place = {q: i for i, q in enumerate(names)}
    terms = np.unique(np.array([r["term"] for r in pairs], np.int64))
    asked = np.zeros((len(terms), len(names)))
    asked[np.searchsorted(terms, [r["term"] for r in pairs]), [place[r["query"]] for r in pairs]] = 1.0
    weights = np.array([idf.get(t, 0.0) for t in terms.tolist()])
    shared = spark.sparkContext.broadcast((terms, weights, asked, pa.array(names, to_arrow_type(query.dataType))))
    schema = StructType([query, StructField("doc", LongType()), StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)

    def scored(table: pa.Table) -> pa.Table:
        terms, idf, asked, labels = shared.value
        table = table.combine_chunks()
        code = table["term"].to_numpy()
        own = int(np.flatnonzero(code == -1)[0])
        docs, dl, dead = table["doc"][own].values, table["tf"][own].values.to_numpy(), table["place"][own].values.to_numpy()
        rest = table.filter(pa.array(code != -1)).combine_chunks()
        at = np.searchsorted(terms, rest["term"].to_numpy())
        size = pa.compute.list_value_length(rest["place"]).to_numpy()
        row, where, tf = np.repeat(np.arange(len(size)), size), pa.compute.list_flatten(rest["place"]).to_numpy(), pa.compute.list_flatten(rest["tf"]).to_numpy()
        w = idf[at][row] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl[where] / avgdl))
        s, step = np.zeros((len(dl), asked.shape[1])), max(1, CELLS // max(1, len(at)))
        for a in range(0, len(dl), step):
            here = (where >= a) & (where < a + step)
            part = np.zeros((min(step, len(dl) - a), len(at)))
            part[where[here] - a, row[here]] = w[here]
            s[a : a + step] = part @ asked[at]
        s[dead] = 0.0
        # Scores are rounded later, so what is just below the k-th best stays.
        low = np.partition(s, len(dl) - k, axis=0)[len(dl) - k] - 1e-3 if k < len(dl) else 0.0
        d, q = np.nonzero((s > 0) & (s >= low))
        return pa.Table.from_arrays([labels.take(pa.array(q)), docs.take(pa.array(d)), pa.array(s[d, q])], schema=arrow)

    return scored, schema


class Index:
    """The index in a folder; ``Index.build`` makes one, ``Index(spark, folder)`` opens one."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        ship_package(spark)
        row = spark.read.parquet(f"{self.folder}/log").agg(F.max("segment").alias("last"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.bool_or(F.col("n") < 0).alias("gone")).first()
        self.last, self.n, self.total, self.gone = row["last"], row["n"] or 0, row["total"] or 0, bool(row["gone"])

    @classmethod
    def build(cls, docs: DataFrame, doc_id: str, text: str, folder: str | None = None) -> Index:
        folder = folder or new_folder(docs.sparkSession, "index")
        docs.sparkSession.createDataFrame([(0, 0, 0)], "segment int, n long, total long").write.parquet(f"{folder}/log")
        return cls(docs.sparkSession, folder).append(docs, doc_id, text)

    def _logged(self, segment: int, n: int, total: int) -> Index:
        self.spark.createDataFrame([(segment, n, total)], "segment int, n long, total long").write.mode("append").parquet(f"{self.folder}/log")
        return Index(self.spark, self.folder)

    def append(self, docs: DataFrame, doc_id: str, text: str) -> Index:
        """The index with more documents."""
        segment = self.last + 1
        staged = written(_blocks(docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))), "postings")
        staged.where("term = -1").select("block", "doc", "dl").write.parquet(f"{self.folder}/documents/segment={segment}")
        held = self.spark.read.parquet(f"{self.folder}/documents/segment={segment}")
        length = F.aggregate("dl", F.lit(0).cast("long"), lambda a, x: a + x)
        size = held.agg(F.coalesce(F.sum(F.size("doc")), F.lit(0)).alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("total"), F.count("*").alias("blocks")).first()
        by = staged.where("term <> -1").select("term", "block", "place", "tf", "most", "least", _bucket("term").alias("bucket"))
        # A common term's rows are spread over several files of its bucket.
        spread = F.pmod(F.xxhash64("block"), F.lit(max(1, size["blocks"] // 256)))
        by.repartition("bucket", spread).sortWithinPartitions("bucket", "term", "block").write.partitionBy("bucket").parquet(f"{self.folder}/postings/segment={segment}")
        forget(staged)
        return self._logged(segment, size["n"], size["total"])

    def delete(self, ids: DataFrame, doc_id: str) -> Index:
        """The index without all documents of these ids that it has now."""
        each = self._documents().select("segment", "block", F.posexplode(F.arrays_zip("doc", "dl")).alias("place", "x")).select("segment", "block", "place", "x.*")
        wanted = each.join(ids.select(F.col(doc_id).cast("long").alias("doc")).distinct(), "doc").select("segment", "block", "place", "dl")
        if self.gone:
            wanted = wanted.join(self._dead().select("segment", "block", F.explode("dead").alias("place")), ["segment", "block", "place"], "left_anti")
        gone = written(wanted, "gone")
        gone.write.parquet(f"{self.folder}/deleted/part={self.last}-{self.n}")
        size = gone.agg(F.count("*").alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("total")).first()
        return self._logged(self.last, -size["n"], -size["total"]) if size["n"] else self

    def _documents(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/documents").withColumn("segment", F.col("segment").cast("int"))

    def _dead(self) -> DataFrame:
        """(segment, block, dead): places of a block's deleted documents."""
        return self.spark.read.parquet(f"{self.folder}/deleted").groupBy("segment", "block").agg(F.collect_set("place").alias("dead"))

    def _portion(self, stored: DataFrame, asked: DataFrame, query: StructField, k: int) -> DataFrame:
        """(query, doc, score), scores rounded, among which the ``k`` best documents of each query are."""
        pairs = asked.collect()
        names = sorted({r["term"] for r in pairs})
        if len(names) <= NAMED:
            buckets = self.spark.createDataFrame([(x,) for x in names], "term long").select(_bucket("term").alias("b")).distinct().collect()
            stored = stored.where(F.col("bucket").isin([r["b"] for r in buckets]) & F.col("term").isin(names))
        else:
            stored = stored.join(asked.select("term").distinct(), "term", "left_semi")
        documents, df = self._documents(), F.size("place")
        if self.gone:
            dead = written(self._dead(), "dead")
            documents, live = (x.join(dead, ["segment", "block"], "left") for x in (documents, stored))
            df = F.when(F.col("dead").isNull(), df).otherwise(df - F.size(F.array_intersect("place", "dead")))
        else:
            documents, live = documents.withColumn("dead", F.lit(None).cast("array<int>")), stored
        counts = {r["term"]: r["df"] for r in live.groupBy("term").agg(F.sum(df.cast("long")).alias("df")).collect()}
        idf = {t: float(np.log(1 + (self.n - n + 0.5) / (n + 0.5))) for t, n in counts.items()}
        scored, schema = _best_of_block(pairs, query, idf, self.total / self.n, k, self.spark)
        own = documents.select("segment", "block", F.lit(-1).cast("long").alias("term"), F.coalesce("dead", F.array().cast("array<int>")).alias("place"), F.col("dl").alias("tf"), "doc")

        def of(blocks: DataFrame | None) -> DataFrame:
            here = lambda x: x if blocks is None else x.join(blocks, ["segment", "block"], "left_semi")
            rows = stored.select("segment", "block", "term", "place", "tf", F.lit(None).cast("array<long>").alias("doc"))
            found = here(rows).unionByName(here(own)).groupBy("segment", "block").applyInArrow(scored, schema)
            return found.withColumn("score", F.round("score", 4))

        if len({r["query"] for r in pairs}) > FEW_QUERIES:
            return of(None)
        tf, dl = F.col("most"), F.col("least")
        known = self.spark.createDataFrame([(r["query"], r["term"], idf[r["term"]]) for r in pairs if r["term"] in idf], StructType([query, StructField("term", LongType()), StructField("idf", DoubleType())]))
        bound = F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / (self.total / self.n)))
        most = written(stored.select("term", "segment", "block", "most", "least").join(F.broadcast(known), "term").groupBy("query", "segment", "block").agg(F.sum(bound).alias("bound")), "bounds")
        first = of(top_per_group(most, ["query"], [F.desc("bound"), "segment", "block"], FIRST).select("segment", "block").distinct())
        floor = top_per_group(first, ["query"], [F.desc("score"), "doc"], k).groupBy("query").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
        open_ = most.join(floor, most["query"].eqNullSafe(floor["query"]), "left").where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - 1e-3))
        return of(written(open_.select("segment", "block").distinct(), "open"))

    def search(self, queries: DataFrame, query_id: str, query_text: str, k: int) -> DataFrame:
        """(query, doc, score, place): of each query the ``k`` best documents, scores rounded to 4 places."""
        asked = written(_query_terms(queries, query_id, query_text), "asked")
        size = asked.agg(F.countDistinct("query").alias("q"), F.max(F.col("query").isNull()).alias("null"), F.countDistinct("term").alias("t")).first()
        nothing = asked.select("query", F.lit(None).cast("long").alias("doc"), F.lit(0.0).alias("score"), F.lit(0).alias("place")).limit(0)
        if not size["t"] or not self.n:
            return nothing
        try:
            stored = self.spark.read.parquet(f"{self.folder}/postings").withColumn("segment", F.col("segment").cast("int"))
        except AnalysisException:  # texts without a term leave no files
            return nothing
        portions = -(-(size["q"] + int(size["null"])) * size["t"] // ASKED)
        parts = [asked if portions == 1 else asked.where(F.pmod(F.xxhash64("query"), F.lit(portions)) == p) for p in range(portions)]
        found = [self._portion(stored, part, asked.schema["query"], k) for part in parts if portions == 1 or not part.isEmpty()]
        best = top_per_group(reduce(DataFrame.unionByName, found), ["query"], [F.desc("score"), "doc"], k)
        return best.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc"))).select("query", "doc", "score", "place")
