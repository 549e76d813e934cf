import importlib
import os

import pytest

import __spark_entry__

pytest.importorskip("corpus_pipeline")
import corpus_pipeline as C  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, prose, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('pipeline')}"
    passage = prose("bench", 40)
    rows = []
    for i in range(120):
        text = prose(i, 150, ("en", "de", "fr")[i % 3])
        rows.append((i, text, ("en", "de", "fr")[i % 3], f"src{i % 4}", len(text)))
    near = rows[7][1].split(" ")
    near[3] = "other"
    rows += [(200, " ".join(near).replace("\n", " "), "de", "x", 1), (201, rows[8][1].replace("\n", " ") + " " + passage.replace("\n", " "), "en", "x", 1), (202, "12345 67890 !!! ###", "en", "x", 1), (203, None, None, None, None), (204, rows[7][1].replace("\n", " "), "de", "x", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in C.STAGES:
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        seen[name] = {r["doc_id"]: r for r in rows}
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
    ids = lambda name: set(seen[name])
    assert {202, 203} & ids("language_id") == set() and ids("language_id") >= set(range(120)) | {200, 201, 204}
    assert ids("line_dedup") == ids("language_id")
    # Of a document and its near copies on one line, which line dedup can't see, the first stays.
    assert ids("ngram_jaccard") == ids("line_dedup") - {200, 204}
    assert ids("decontamination") == ids("ngram_jaccard") - {201}
    assert ids("sentencepiece") == ids("decontamination")
    for i, r in seen["sentencepiece"].items():
        assert r["text"] == seen["decontamination"][i]["text"] and r["n_pieces"] == len(r["ids"]) > 0 and r["score"] >= r["second_score"]


def test_run_equals_its_stages(spark, folder):
    got = {r["doc_id"] for r in C.run(spark, folder).collect()}
    assert got == set(range(120))


def test_empty_tables(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(f"file://{tmp_path}/benchmark.parquet")
    assert C.run(spark, f"file://{tmp_path}").count() == 0


def test_repeated_rows_long_texts_and_names_that_clash(spark, prose, tmp_path):
    root = f"file://{tmp_path}"
    rows = [(i, prose(i, 120, ("en", "de")[i % 2]), ("en", "de")[i % 2], "s", 1, 7, 8.0, "t") for i in range(60)]
    rows += [rows[5], rows[5], (70, prose("long", 60_000), "en", "s", 1, 7, 8.0, "t"), (71, None, None, None, None, None, None, None), (None, prose("nameless", 80), "en", "s", 1, 7, 8.0, "t")]
    columns = "doc_id long, text string, lang string, source string, n_chars long, N_Lines int, score double, ids string"
    spark.createDataFrame(rows, columns).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, prose("bench", 40)), (None, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in C.STAGES:
        docs = stage(spark, docs, root)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name == "language_id":
            assert docs.count() == 64
        if name == "line_dedup":
            assert {r["N_Lines"] for r in docs.collect()} == {7}
    kept = {r["doc_id"]: r for r in docs.collect()}
    assert len(kept) == docs.count() == 62 and kept[70]["n_pieces"] > 60_000 and None in kept


def test_registered():
    known = __spark_entry__.queries()
    assert known["pipeline"] is C.run
    assert {int(n[2:].split("_")[0]) for n in known if n.startswith("op")} == set(range(1, 11))


@pytest.mark.parametrize("error", [ModuleNotFoundError, ImportError])
def test_entry_works_without_these_parts(monkeypatch, error):
    real = importlib.import_module

    def broken(name, *more):
        if name in ("spherelake.llm.queries", "corpus_pipeline"):
            raise error(name)
        return real(name, *more)

    monkeypatch.setattr(importlib, "import_module", broken)
    assert not any(n.startswith("op") or n == "pipeline" for n in __spark_entry__.queries())
    assert len(__spark_entry__.queries()) > 140 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_these_parts():
    top = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    for folder, _, names in os.walk(os.path.join(top, "spherelake")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert "spherelake.llm" not in open(os.path.join(folder, n)).read()
