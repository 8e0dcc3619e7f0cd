"""Topic discovery on cleaned narratives."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casemill.operators import lowrank, tfidf
from casemill.operators.tfidf import TOPICS, TfidfSpec
from casemill.session import discard, materialize

TERMS_PER_TOPIC, TERMS_PER_NAME, EXAMPLES = 12, 4, 3
KEY, TEXT, ABOUT = "complaint_id", "clean_narrative", ("product", "company")


def topic_terms(spark, terms: list[str], components) -> DataFrame:
    """``(topic_id, topic_name, top_terms)`` from the model; the heaviest terms first."""
    rows = []
    for topic, weights in enumerate(components):
        heaviest = [terms[i] for i in sorted(range(len(terms)), key=lambda i: (-weights[i], terms[i]))[:TERMS_PER_TOPIC]]
        rows.append((topic, "; ".join(heaviest[:TERMS_PER_NAME]), ", ".join(heaviest)))
    return spark.createDataFrame(rows, "topic_id int, topic_name string, top_terms string")


def top_values(assigned: DataFrame, column: str, n: int = 5) -> DataFrame:
    """``(topic_id, <column>_distribution)``: the n most frequent values per topic as a map."""
    counts = assigned.filter(F.col(column).isNotNull()).groupBy("topic_id", column).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("topic_id").orderBy(F.desc("n"), column))
    kept = counts.withColumn("rank", rank).filter(F.col("rank") <= n)
    return kept.groupBy("topic_id").agg(F.map_from_entries(F.collect_list(F.struct(column, "n"))).alias(f"{column}_distribution"))


def topic_registry(assigned: DataFrame, names: DataFrame) -> DataFrame:
    """One row per topic: name, terms, volume, frequent products and companies, ids of the best documents.

    ``assigned`` holds one row per document with ``topic_id``, ``topic_score``, product and company. The best
    documents use a rank filter that keeps three rows per topic and task before the shuffle.
    """
    volume = assigned.groupBy("topic_id").agg(F.count(F.lit(1)).alias("volume"))
    order = Window.partitionBy("topic_id").orderBy(F.desc("topic_score"), "complaint_id")
    best = assigned.select("topic_id", "topic_score", "complaint_id").withColumn("rank", F.row_number().over(order)) \
        .filter(F.col("rank") <= EXAMPLES).groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("rank", "complaint_id"))).alias("b"))
    joined = names.join(volume, "topic_id", "left")
    for column in ("product", "company"):
        joined = joined.join(top_values(assigned, column), "topic_id", "left")
    joined = joined.join(best.select("topic_id", F.col("b.complaint_id").alias("representatives")), "topic_id", "left")
    return joined.withColumn("volume", F.coalesce("volume", F.lit(0)))


def discover_topics(docs: DataFrame, n_topics: int = 12, spec: TfidfSpec = TOPICS, max_iter: int = 400,
                    tol: float = 1e-4, seed: int = 42, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(registry, assignments)`` of cleaned narratives; all documents are used. Without a term left all documents belong to the first of the topics, which have no terms.

    Narratives that are counted already are taken as they are. With ``path`` the model is written there; :func:`open_topics` reads it, and :meth:`TopicModel.extended`
    adds documents to it.
    """
    spark = docs.sparkSession
    with tfidf.counted_documents(docs, KEY, TEXT, spec, ABOUT) as counts:
        n_docs = counts.count()
        vocab = tfidf.numbered_vocabulary(counts, spec, "topic_terms", F.lit(n_docs))
        terms = [r["term"] for r in vocab.orderBy("idx").select("term").collect()]
        if not terms:
            assigned = materialize(counts.select(KEY, *ABOUT).withColumns({"topic_id": F.lit(0), "topic_score": F.lit(0.0)}), "topic_assignments")
            return topic_registry(assigned, topic_terms(spark, [], np.zeros((n_topics, 0)))), assigned
        vectors = lowrank.in_batches(tfidf.doc_vectors(counts, vocab, KEY, spec, ABOUT))
    components, _, sums = lowrank.nmf_components(vectors.where("idx IS NOT NULL"), len(terms), n_docs, n_topics, max_iter, tol, seed)
    assigned = assign(vectors, components)
    discard(vectors)
    model = TopicModel(vocab, components, sums, spec)
    if path is not None:
        model.write(path)
    return topic_registry(assigned, topic_terms(spark, terms, components)), assigned


def assign(vectors: DataFrame, components: np.ndarray) -> DataFrame:
    """Documents with topic and score; one without any known term has weight 0 for every topic and falls to the first."""
    return materialize(lowrank.assign_components(vectors, KEY, components, ABOUT).withColumns({
        "topic_id": F.coalesce("topic_id", F.lit(0)), "topic_score": F.coalesce("topic_score", F.lit(0.0)),
    }), "topic_assignments")


@dataclass(frozen=True)
class TopicModel:
    """Vocabulary, components, and the sums that the components follow from, to which those of new documents can be added."""

    vocab: DataFrame
    components: np.ndarray
    sums: lowrank.FactorSums
    spec: TfidfSpec

    def extended(self, docs: DataFrame, rounds: int = 3) -> tuple[TopicModel, DataFrame]:
        """The model after new documents, and their assignments. The documents of before are not read: their sums stay as they were."""
        with tfidf.counted_documents(docs, KEY, TEXT, self.spec, ABOUT) as counts:
            vectors = materialize(tfidf.doc_vectors(counts, self.vocab, KEY, self.spec, ABOUT), "topic_vectors")
        components, total = self.components, self.sums
        for _ in range(rounds):
            total = self.sums + lowrank.factor_sums(vectors.where("idx IS NOT NULL"), components)
            components = total.updated(components)
        assigned = assign(vectors, components)
        discard(vectors)
        return TopicModel(self.vocab, components, total, self.spec), assigned

    def write(self, path: str) -> None:
        """A row per term, and one with the small sums."""
        spark = self.vocab.sparkSession
        rows = pa.table({"idx": pa.array(np.arange(self.components.shape[1], dtype=np.int32)), "weights": pa.array(list(self.components.T)), "products": pa.array(list(self.sums.products))})
        self.vocab.join(spark.createDataFrame(rows), "idx").write.mode("overwrite").parquet(f"{path}/terms")
        spark.createDataFrame([(self.sums.gram.ravel().tolist(), self.sums.length)], "gram array<double>, length double").write.mode("overwrite").parquet(f"{path}/sums")


def open_topics(spark, path: str, spec: TfidfSpec = TOPICS) -> TopicModel:
    """Model from its tables; terms are limited by ``max_features``."""
    terms = spark.read.parquet(f"{path}/terms")
    rows = terms.orderBy("idx").select("weights", "products").toArrow()
    weights, products = (c.combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1) for c in rows.columns)
    sums = spark.read.parquet(f"{path}/sums").first()
    k = weights.shape[1]
    return TopicModel(terms.drop("weights", "products"), weights.T.copy(), lowrank.FactorSums(np.array(sums["gram"]).reshape(k, k), products, sums["length"]), spec)
