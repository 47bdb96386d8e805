import cases
import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_text_operators import hits, kept_lines, linked, toxic_rows

from sparklake.llm import toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, known = toxic_rows()
    rows = [r for r in rows if r[0] < 300] + [(i + 2000, t) for i, t in cases.texts()]
    rows += [(5000 + i, f"a line that many share\n{cases.prose(60, 3000 + i)}") for i in range(12)]
    items = [(1, " ".join(cases.prose(60, 3003).split()[:20])), (2, None)]
    cases.documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(known, "doc_id bigint, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages_do_what_brute_force_does(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path).cache()
        made[name] = docs.collect()
    names = list(made)
    text = lambda name: [(r.doc_id, r.text) for r in made[name]]
    columns = spark.read.parquet(f"{path}/documents.parquet").columns
    assert all(list(made[n][0].asDict()) == columns for n in names[:-1])

    model = toxicity.fit(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    scored = toxicity.score(spark.read.parquet(f"{path}/documents.parquet"), model).where("score < 0.5")
    assert sorted(r[0] for r in scored.select("row.doc_id").collect()) == sorted(i for i, _ in text("toxicity"))
    assert len(made["toxicity"]) < len(rows)

    assert len(made["line_dedup"]) == len(made["toxicity"])
    want = {(i, s) for i, _, _, s in kept_lines(text("toxicity"), counted={t or "" for _, t in text("toxicity")})}
    got = spark.createDataFrame(text("line_dedup"), "i bigint, t string").select("i", F.sha2("t", 256))
    assert {tuple(r) for r in got.collect()} == want
    assert all(r.n_chars == len(r.text) for r in made["line_dedup"])

    stay = {c for _, c in linked(text("line_dedup"), 5, 80, 100).values()}
    assert {i for i, _ in text("near_duplicates")} == stay

    clean = [h[0] for h in hits(text("near_duplicates"), [(str(i), t) for i, t in items]) if not h[-1]]
    assert sorted(i for i, _ in text("decontamination")) == clean and len(clean) < len(stay) + 1
    assert sorted(r.doc_id for r in made["encode"]) == clean and all(r.restored for r in made["encode"])


def test_run_and_empty_tables(spark, folder, tmp_path):
    path, _, _ = folder
    assert corpus_pipeline.run(spark, path).count() > 0
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_documents_without_an_id_stay(spark, folder, tmp_path):
    path, _, _ = folder
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    clean = [cases.prose(80, 9000 + i) for i in range(3)]
    rows = [(i, cases.prose(80, 9100 + i)) for i in range(5)] + [(None, x) for x in [*clean, clean[0], "", None]]
    cases.documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        # of two copies without an id one stays, from the join on
        left = len(rows) - (name in ("near_duplicates", "decontamination"))
        assert docs.count() == left, name
    assert sorted(r.text for r in docs.where("doc_id is null").collect() if r.text) == sorted(clean)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.where("doc_id is null and restored").count() == len(clean) + 2


def test_copies_of_one_text_leave_one_whole(spark, folder, tmp_path):
    path, _, _ = folder
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    text = "\n".join(cases.prose(20, 9500 + i) for i in range(6))
    rows = [(i, text) for i in range(12)] + [(20 + i, f"a line of all\n{cases.prose(60, 9600 + i)}") for i in range(11)]
    cases.documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
    assert [r.doc_id for r in docs.where(F.col("text") == text).collect()] == [0]
    assert docs.count() == 12 and docs.where("text like '%a line of all%'").count() == 0


CLASHES = ["ids", "n_tokens", "restored", "own_ids", "_kept", "id", "row", "score", "kept", "a.b", "component", "digest"]


def test_clashing_columns_pass_all_stages(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(40)
    docs = docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES if "." not in c}).select("*", F.lit("own a.b").alias("a.b"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path).cache()
        if name != "encode":
            assert docs.columns == columns, name
    row = docs.first().asDict()
    assert row["own_own_ids"] == "own ids" and row["own_ids"] == "own own_ids" and row["own_n_tokens"] == "own n_tokens"
    assert all(row[c] == f"own {c}" for c in CLASHES[4:]) and row["restored"] is True
