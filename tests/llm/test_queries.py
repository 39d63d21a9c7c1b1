"""Operator queries against their comparison SQL, and the pipeline against planted cases."""

import random
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import check, connect
from fluxsieve.llm import common, pieces, queries

FOLDER = "/root/testdata/sf0.001"
WITH_SQL = sorted(n for n, (_, sql) in queries.QUERIES.items() if sql)
have_tables = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="driver tables are not here")


@have_tables
@pytest.mark.parametrize("name", WITH_SQL)
def test_same_as_sql(spark, name):
    difference, rows, _, _ = check(spark, connect(FOLDER), FOLDER, entry.queries()[name], entry.oracle_sql()[name])
    assert difference is None and rows > 0


def test_every_operator_has_its_query():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with planted copies, near copies, benchmark passages and texts without letters."""
    rng, folder = random.Random(21), str(tmp_path_factory.mktemp("corpus"))
    parts = {"aa": ["ka", "lo", "mi", "ra", "te"], "bb": ["sch", "ung", "ber", "ein", "lich"]}

    def prose(lang, words):
        return [" ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(2, 5))) for _ in range(words))][0]

    bench = [(i, prose("aa", 14)) for i in range(4)]
    clean = {i: (prose(("aa", "bb")[i % 2], 150), ("aa", "bb")[i % 2]) for i in range(60)}
    rows = [(i, t, lang) for i, (t, lang) in clean.items()]
    rows += [(100 + i, clean[i][0].replace(" ", " \n", 3), clean[i][1]) for i in range(12)]  # equal but for white space
    for i in range(12, 24):
        words = clean[i][0].split()
        words[75] = "changed"
        rows.append((200 + i, " ".join(words), clean[i][1]))
    for i, text in bench:
        rows.append((300 + i, prose("aa", 60) + " " + text.upper() + ". " + prose("aa", 60), "aa"))
    rows += [(400, None, None), (401, "", "aa"), (402, "1234 !!", "bb")]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "doc_id", "text", "lang", "'s' AS source", "length(text) AS n_chars").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, clean


def test_pipeline_keeps_clean_documents_and_drops_planted_ones(spark, corpus):
    folder, clean = corpus
    out = {r["doc_id"]: r for r in corpus_pipeline.run(common.session(spark), folder).collect()}
    assert set(out) == set(clean)
    vocabulary = pieces.Vocabulary(queries.PIECE_MODEL)
    assert all(pieces.decode(r["ids"], vocabulary) == clean[i][0] and r["lossless"] for i, r in out.items())


def test_stages_keep_the_columns_and_take_empty_tables(spark, corpus):
    folder, _ = corpus
    docs = common.table(spark, folder, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), folder)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0
