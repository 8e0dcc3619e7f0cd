"""What jobs leave on disk while they run and behind them."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemill.operators import hybrid, lowrank, tfidf
from casemill.plans import queries_models, queries_retrieval
from casemill.session import FREE_SHUFFLES, discard, materialize, scratch_root
from casemill.sources import complaints

SF_DIR = "/root/testdata/sf0.001"


def tables(spark) -> set[str]:
    folder = f"{scratch_root(spark)}/casemill/{spark.sparkContext.applicationId}"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def named(found: set[str]) -> set[str]:
    return {name.rsplit("-", 1)[0] for name in found}


def shuffle_bytes(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def some_docs(spark, n: int = 60):
    words = [f"word{i}" for i in range(40)]
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(words, 20)) + " and more text so that it is long enough for a narrative", "M" if i % 2 else "N", "C") for i in range(n)]
    blank = {c: F.lit(None).cast("string") for c in ("issue", "state")} | {"date_received": F.lit(None).cast("timestamp_ntz")}
    return spark.createDataFrame(rows, "complaint_id long, consumer_complaint_narrative string, product string, company string").withColumns(blank)


def test_materialize_frees_its_shuffles_and_discard_its_table(spark):
    before, conf = shuffle_bytes(spark), spark.conf.get(FREE_SHUFFLES)
    written = materialize(spark.range(100_000, numPartitions=4).repartition(7, "id"), "freed")
    assert shuffle_bytes(spark) <= before and spark.conf.get(FREE_SHUFFLES) == conf
    assert written.count() == 100_000 and "freed" in named(tables(spark))
    discard(written)
    assert "freed" not in named(tables(spark))


def test_partial_sums_are_one_for_each_core(spark):
    """A partial sum is as large as a model, so their number must not follow the splits of the documents."""
    vectors = spark.range(640, numPartitions=64).select(F.array(F.lit(0), F.lit(1)).alias("idx"), F.array(F.lit(1.0), F.lit(2.0)).alias("x"))

    def add(rows, total):
        total[0] += rows.x.sum()
        total[1] = 1.0  # one for each partial sum

    before = shuffle_bytes(spark)
    sums = lowrank.sum_by_term(vectors, 2, 1, add)
    assert sums[0, 0] == 640 * 3 and 1 <= sums[1, 0] <= spark.sparkContext.defaultParallelism
    assert shuffle_bytes(spark) <= before


def test_index_leaves_its_own_tables_only(spark, tmp_path):
    before = tables(spark)
    index = hybrid.build_index(some_docs(spark), str(tmp_path / "index"), components=4)
    assert named(tables(spark) - before) == set()
    assert sorted(os.listdir(tmp_path / "index")) == ["docs", "model", "terms", "vectors"] and index.vectors.count() == 60


def test_vectors_of_every_document_keep_their_columns(spark):
    """Documents without a known term stay as rows, without vectors, and need no join."""
    spec = tfidf.TfidfSpec(50, 2)
    docs = spark.createDataFrame([(1, "alpha beta", "a"), (2, "gamma", "b"), (3, "alpha beta beta", None), (4, None, "d"), (None, "alpha", "e")], "id long, text string, c string")
    with tfidf.counted_documents(docs, "id", "text", spec, ["c"]) as counts:
        vocab = tfidf.numbered_vocabulary(counts, spec, "some_terms")
        vectors = materialize(tfidf.doc_vectors(counts, vocab, "id", spec, ["c"]), "some_vectors")
        alone = {r["id"]: (r["idx"], r["x"]) for r in tfidf.doc_vectors(counts, vocab, "id", spec).collect()}
    rows = {r["c"]: r for r in lowrank.with_projection(vectors, np.arange(6.0).reshape(3, 2)).collect()}
    assert set(rows) == {"a", "b", None, "d", "e"} and set(alone) == {1, 3, None}
    assert all(rows[c]["idx"] is None and rows[c]["x"] is None and rows[c]["dense"] is None for c in "bd")
    assert all((rows[c]["idx"], rows[c]["x"]) == alone[i] for c, i in (("a", 1), (None, 3), ("e", None)))
    want = np.array(rows["a"]["x"]) @ np.arange(6.0).reshape(3, 2)[rows["a"]["idx"]]
    assert rows["a"]["dense"] == pytest.approx(want / np.linalg.norm(want))
    assert os.path.basename(counts.scratch_folder) not in tables(spark)


def test_nightly_run_keeps_no_copies_of_texts(spark):
    before = tables(spark)
    assert queries_models.nightly_run(spark, SF_DIR).count()
    assert named(tables(spark) - before) <= {"nightly", "splits", "headers", "repeated_ids", "topic_terms", "topic_assignments", "thresholds", "router_split", "router_terms", "router_predictions"}


def test_nightly_refresh_lands_no_extract_behind(spark):
    before = tables(spark)
    assert queries_models.nightly_refresh(spark, SF_DIR).count()
    assert named(tables(spark) - before) <= {"nightly", "splits", "headers"}


def test_refresh_in_turns_gives_the_same_store(spark, tmp_path, monkeypatch):
    """Months that are rewritten one at a time: rows move between turns, ids and rows without id are merged as in one."""
    def rows(items):
        return complaints.normalize_columns(spark.createDataFrame(items, "complaint_id long, date_received string, issue string"))

    def state(path):
        return sorted(((r.complaint_id, str(r.date_received)[:10], r.issue, r.received_month) for r in complaints.read_store(spark, path).collect()), key=str)

    start = [(i, f"2024-{i % 6 + 1:02d}-05", "a") for i in range(60)] + [(None, "2024-03-01", "n"), (None, None, "undated")]
    window = [(i, f"2024-{(i + i // 10) % 8 + 1:02d}-07", "b") for i in range(0, 90, 3)] + [(3, "2024-01-01", "late"), (6, None, "b"), (None, "2024-03-01", "n"), (None, "2024-07-01", "m"), (None, "2024-07-01", "m")]
    writes = []
    for name, turn in (("whole", 1 << 30), ("turns", 1)):
        monkeypatch.setattr(complaints, "TURN_BYTES", turn)
        complaints.write_store(rows(start), str(tmp_path / name))
        writes.append(len(complaints.turns_of(spark, str(tmp_path / name), ["2024-01", "2024-02", "2024-09"], complaints.current(spark, str(tmp_path / name)))))
        complaints.refresh_store(spark, str(tmp_path / name), rows(window))
    assert state(str(tmp_path / "whole")) == state(str(tmp_path / "turns")) and writes[0] == 1 and writes[1] >= 2
    kept = {i for i in range(60)} - {r[0] for r in window}
    assert {r[0] for r in state(str(tmp_path / "turns")) if r[2] == "a"} == kept
    ids = [r[0] for r in state(str(tmp_path / "turns")) if r[0] is not None]
    assert len(ids) == len(set(ids)) == 60 + 10 and sum(r[0] is None for r in state(str(tmp_path / "turns"))) == 3


def test_fused_search_is_held_against_the_index(spark, tmp_path):
    """``dense_fits`` of index_search sees worse documents, missing ones, and scores that are not those of the vectors."""
    index = hybrid.build_index(some_docs(spark), str(tmp_path / "index"), components=4)
    asked = spark.createDataFrame([(1, "word1 word2 word3"), (2, "word7 narrative"), (3, "unheard")], "question_id long, question string")
    exact, _ = hybrid.retrieve(index, asked, lexical_weight=1.0, dense_weight=0.0)
    fused, trace = hybrid.retrieve(index, asked)
    later = hybrid.retrieve(index, asked, k=16)[0].where("rank > 8").withColumn("rank", F.col("rank") - 8)
    cases = {"right": fused, "worse": later, "missing": fused.where("question_id <> 2 OR rank < 8"), "none": fused.limit(0),
             "dense": fused.withColumn("dense_score", F.col("dense_score") * 0.9), "sum": fused.withColumn("hybrid_score", F.col("hybrid_score") * 0.9)}
    fits = {name: queries_retrieval.fused_fits(index, asked, exact, found, trace).first()["fits"] for name, found in cases.items()}
    assert fits == {name: name == "right" for name in cases}
